"""Personal data: patterns propose spans, checksums confirm them, context adjusts their scores.

Base kinds and their patterns are fixed by the contract; a base span that its check confirms always
stays. Own kinds (IBAN, social security number, secret) stay if their score, raised or lowered by
words nearby, reaches ``MIN_SCORE``, and if they lie outside the base spans.

Texts are scanned from left to right in linear time also where they hold very long runs of digits
or letters: runs are consumed whole, as no later start within a run that fails can succeed.

Defined cases: a null text is empty; an empty text has no span; rows that repeat a ``doc_id`` come
back as often; an empty table gives an empty result; extra columns are not read, or handed on by
``mask``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: In the order in which spans with one start are listed. The first four are fixed.
BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "iban", "ssn", "secret")

#: Scores of confirmed base spans, which the context can only raise, and of own kinds by their pattern alone.
SCORES = {"email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.6, "iban": 0.8, "ssn": 0.3, "secret": 0.3}
MIN_SCORE = 0.5

#: Context is looked for in so many characters on either side.
NEARBY = 48
RAISE, LOWER = 0.3, 0.4

#: Words nearby that make a kind likelier, and words that make any own kind unlikely.
CONTEXT = {
    "email": re.compile(r"(?i)\b(e-?mail|contact|write|kontakt|correo|courriel)"),
    "ip": re.compile(r"(?i)\b(ip|address|host|server|login|from)\b"),
    "card": re.compile(r"(?i)\b(card|credit|visa|mastercard|karte|tarjeta|carte)\b"),
    "phone": re.compile(r"(?i)\b(phone|call|tel|mobile|fax|telefon|tel[eé]fono|t[eé]l[eé]phone)"),
    "iban": re.compile(r"(?i)\b(iban|account|bank|konto|cuenta|compte)\b"),
    "ssn": re.compile(r"(?i)\b(ssn|social security|sozialversicherung)\b"),
    "secret": re.compile(r"(?i)(api|secret|token|password|passwd|key)"),
}
AGAINST = re.compile(r"(?i)\b(isbn|issn|order|version|serial|part|invoice|example)\b")

DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
NUMBERS = re.compile(r"([0-9]++)(?:\.([0-9]++)\.([0-9]++)\.([0-9]++))?")
DIGITS = re.compile(r"[0-9](?:[ -]?[0-9])++")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
#: What an IBAN may begin: found at every start, as the run may go on behind its end.
IBAN = re.compile(r"(?<![A-Za-z0-9])(?=([A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}))")
#: The characters that an IBAN of a country has; of others every end is tried.
IBAN_LENGTHS = {
    country: n
    for n, countries in {
        15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK",
        21: "CH HR LI LV", 22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL",
        24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM",
        28: "AL AZ BY CY DO GT HU LB NI PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
    }.items()
    for country in countries.split()
}
SSN = re.compile(r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])")
SECRET = re.compile(r"(?<![A-Za-z0-9_-])(?:sk|pk|ghp|AKIA|xox[a-z])[A-Za-z0-9_-]{16,}+")

SPANS = "array<struct<kind:string,start:bigint,end:bigint,score:double>>"


class Span(NamedTuple):
    kind: str
    start: int
    end: int
    score: float


def luhn(digits: str) -> bool:
    """Whether the checksum of a card number is right."""
    doubled = sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return (sum(map(int, digits[::-2])) + doubled) % 10 == 0


def mod97(iban: str) -> bool:
    """Whether the check digits of an IBAN without blanks are right."""
    return int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97 == 1


def emails(text: str) -> Iterator[tuple[int, int]]:
    """From each ``@``: the run of allowed characters before it, and the domain behind it."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        # A run that a later "@" ends begins behind this one.
        domain = DOMAIN.match(text, at + 1) if start < at else None
        done = domain.end() if domain else at + 1
        if domain:
            yield start, done
        at = text.find("@", done)


def ips(text: str) -> Iterator[tuple[int, int]]:
    for m in NUMBERS.finditer(text):
        if m[2] and all(len(part) <= 3 and int(part) <= 255 for part in (p.lstrip("0") or "0" for p in m.groups())):
            yield m.span()


def cards(text: str) -> Iterator[tuple[int, int]]:
    for m in DIGITS.finditer(text):
        if m.end() - m.start() >= 14:
            digits = m[0].replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and luhn(digits):
                yield m.span()


def phones(text: str) -> Iterator[tuple[int, int]]:
    for m in PHONE.finditer(text):
        if 10 <= sum(c.isdigit() for c in m[0]) <= 15:
            yield m.span()


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Confirmed spans of the base kinds, by start, then kind."""
    has_digit = NUMBERS.search(text) is not None
    found = [("email", *s) for s in emails(text)]
    if has_digit:
        found += [("ip", *s) for s in ips(text)]
        found += [("card", *s) for s in cards(text)]
        found += [("phone", *s) for s in phones(text)] if "+" in text else []
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


def ibans(text: str) -> Iterator[tuple[int, int]]:
    """From each start: the country's number of characters, or the longest that the check digits confirm."""
    done = 0
    for m in IBAN.finditer(text):
        start, run = m.start(), m[1]
        if start < done:
            continue
        ends = [i + 1 for i, c in enumerate(run) if c != " "]
        known = IBAN_LENGTHS.get(run[:2])
        for n in (known,) if known else range(len(ends), 14, -1):
            if n > len(ends):
                break
            end = start + ends[n - 1]
            is_whole = not (text[end : end + 1].isascii() and text[end : end + 1].isalnum())
            if is_whole and mod97(text[start:end].replace(" ", "")):
                done = end
                yield start, end
                break


def own_spans(text: str) -> Iterator[tuple[str, int, int]]:
    # Only secrets may have no digit.
    if NUMBERS.search(text):
        for span in ibans(text):
            yield "iban", *span
        for m in SSN.finditer(text):
            yield "ssn", *m.span()
    for m in SECRET.finditer(text):
        yield "secret", *m.span()


def scored(text: str, kind: str, start: int, end: int) -> float:
    """The kind's score, adjusted by the words around the span."""
    before, after = text[max(0, start - NEARBY) : start], text[end : end + NEARBY]
    near = f"{before}\n{after}"
    score = SCORES[kind] + (RAISE if CONTEXT[kind].search(near) else 0)
    if kind not in BASE_KINDS and AGAINST.search(near):
        score -= LOWER
    return round(min(1.0, max(0.0, score)), 6)


def spans(text: str | None) -> list[Span]:
    """All spans of a text by start, then kind; positions are code points, ends exclusive."""
    text = text or ""
    base = base_spans(text)
    found = [Span(*s, scored(text, *s)) for s in base]
    for kind, start, end in own_spans(text):
        score = scored(text, kind, start, end)
        if score >= MIN_SCORE and not any(a < end and start < b for _, a, b in base):
            found.append(Span(kind, start, end, score))
    return sorted(found, key=lambda s: (s.start, KINDS.index(s.kind)))


def masked(text: str | None) -> str | None:
    """The text with each span replaced by its kind; overlapping spans by that of the first."""
    if text is None:
        return None
    out, done = [], 0
    for s in spans(text):
        if s.start >= done:
            out += [text[done : s.start], f"[{s.kind.upper()}]"]
        done = max(done, s.end)
    return "".join(out) + text[done:] if out else text


def find(docs: DataFrame) -> DataFrame:
    """``doc_id, spans`` for every row of ``docs (doc_id, text)``."""
    kind = pa.list_(
        pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())])
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [[s._asdict() for s in spans(t)] for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, kind)], names=["doc_id", "spans"])

    columns = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    return columns.mapInArrow(run, f"doc_id bigint, spans {SPANS}")


def listed(found: Column, kinds: tuple[str, ...] = KINDS) -> Column:
    """``kind:start:end`` of the spans of these kinds, joined by commas."""
    some = F.filter(found, lambda s: s["kind"].isin(*kinds))
    return F.array_join(F.transform(some, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def counted(found: Column, kind: str) -> Column:
    """The number of spans of one kind."""
    return F.size(F.filter(found, lambda s: s["kind"] == kind)).cast("bigint")


def mask(docs: DataFrame) -> DataFrame:
    """``docs`` with personal data in ``text`` replaced by its kind, like ``[EMAIL]``; all columns stay."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index("text")
            texts = pa.array([masked(t) for t in batch.column(at).to_pylist()], pa.string())
            yield batch.set_column(at, batch.schema.field(at), texts)

    return docs.mapInArrow(run, docs.schema)
