"""BPE encoding and decoding of whole texts as the tokenizers library does, by tree concatenation.

Words repeat, so a text is cut into the tokenizer's words, and each distinct one is given to the
library once per worker; the ids of a text are joined from those of its words.

Where text can't be split any further (a word of thousands of letters), its halves are encoded on
their own, and so on down to short pieces. At each join a window of the last tokens on the left and
the first on the right is encoded again, and grows until its outermost tokens are those that both
sides had there. Tokens are an encoding if every two neighbours are the encoding of their own text,
and each pair lies in a side or in the window, so the joined tokens are exactly the library's.

``encode`` spreads long texts over tasks: their words are dealt out in pieces, and a word longer
than a piece in fragments, which are encoded in parallel, a row each, and then joined as above.

Defined cases: a null text is empty, an empty text has no ids and decodes to an empty text; rows
that repeat a ``doc_id`` come back as often; an empty table gives an empty result; extra columns
are not read.
"""

from __future__ import annotations

import json
import re
import unicodedata
from array import array
from collections.abc import Callable, Iterator
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Characters of a piece: longer texts are dealt out.
PIECE = 1 << 15

#: Characters of a word that the library encodes at once.
LEAF = 256

#: Distinct words that a worker remembers before it starts anew.
REMEMBERED = 300_000

#: Characters on whose classes and case the library and Python agree, and which compose with no other.
PLAIN = re.compile("[\t-\r -~¡-¬®-įı-ſ]*")

#: Letters and numbers among them, as the insides of a character class.
_plain = [chr(c) for c in range(0x180) if PLAIN.fullmatch(chr(c))]
LETTERS = "".join(c for c in _plain if unicodedata.category(c)[0] == "L")
NUMBERS = "".join(c for c in _plain if unicodedata.category(c)[0] == "N")

#: How the two kinds of tokenizer cut words (fixed values).
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[{L}]+|[{N}]|[^\s{L}{N}]+"
BYTE_WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _mapped_bytes() -> dict[int, str]:
    """The character that byte-level tokenizers show each byte as: printable ones as they are."""
    shown = [b for b in range(256) if chr(b).isprintable() and b not in (0x20, 0xAD)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


MAPPED = _mapped_bytes()

Tokens = tuple[np.ndarray, np.ndarray]


class Encoder:
    """One tokenizer file in one worker; words are cut as its settings say."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.settings = json.loads(self.tokenizer.to_str())
        self.specials = [t["content"] for t in self.settings["added_tokens"]]
        #: Ids of words seen before, and what they decode to.
        self.known: dict[str, bytes] = {}
        self.texts: dict[str, str] = {}
        self._byte_pairs = None
        self.cut = self._cut_rule()

    def ids(self, text: str) -> np.ndarray:
        return np.frombuffer(self.encoded(text)[0], "<u4")

    def encoded(self, text: str, decode: bool = False) -> tuple[bytes, str]:
        """Ids as little-endian 32-bit integers, and the text they decode to if asked for."""
        # Elsewhere the classes of characters are not proven to be the same for all libraries.
        plain = PLAIN.fullmatch(text) and not any(s in text for s in self.specials)
        if self.cut is None or not plain:
            if plain and self._byte_pairs is not None:
                ids = self._byte_pairs.encode_to_numpy(text)
            else:
                ids = self.words_ids(self.words(text)) if len(text) > LEAF else self.direct(text)
            return ids.tobytes(), self.decoded(ids) if decode else ""
        parts = self.cut(text)
        try:
            ids = b"".join(map(self.known.__getitem__, parts))
        except KeyError:
            self.learn(parts)
            ids = b"".join(map(self.known.__getitem__, parts))
        if not decode:
            return ids, ""
        return ids, " ".join(map(self.texts.__getitem__, parts))

    def learn(self, parts: list[str]) -> None:
        if len(self.known) > REMEMBERED:
            self.known.clear()
            self.texts.clear()
        model = self.tokenizer.model
        for part in set(parts).difference(self.known):
            if len(part) > LEAF:
                long = self.words_ids(self.words(part))
                self.known[part], self.texts[part] = long.tobytes(), self.decoded(long)
            else:
                tokens = model.tokenize(part if part.isascii() else part.encode().decode("latin-1").translate(MAPPED))
                self.known[part] = array("I", [t.id for t in tokens]).tobytes()
                self.texts[part] = " ".join([t.value for t in tokens])

    def _cut_rule(self) -> Callable[[str], list[str]] | None:
        """How to cut plain text into the tokenizer's words, for the kind of tokenizer known here.

        For a plain byte-level one no cut is needed: the same vocabulary serves in a faster library.
        """
        model, steps, before = (self.settings[k] for k in ("model", "normalizer", "pre_tokenizer"))
        if model["type"] != "BPE" or model.get("dropout") or not before:
            return None
        names = [s["type"] for s in steps.get("normalizers", [])] if steps else []
        if names == ["NFC", "Replace", "Lowercase"] and before["type"] == "Sequence" and self.tokenizer.decoder is None:
            cut = before["pretokenizers"][0].get("pattern")
            if cut == {"Regex": WORDS.replace("{L}", r"\p{L}").replace("{N}", r"\p{N}")}:
                # White space between words is dropped, and decoding is token by token.
                found = re.compile(WORDS.replace("{L}", LETTERS).replace("{N}", NUMBERS)).findall
                return lambda text: found(text.lower())
        if steps is None and before["type"] == "ByteLevel" and before["use_regex"] and not before["add_prefix_space"]:
            self._byte_pairs = _byte_pairs(model)
        return None

    def direct(self, text: str) -> np.ndarray:
        """The library's own ids."""
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4")

    def decoded(self, ids: np.ndarray) -> str:
        return self.tokenizer.decode(ids.tolist(), skip_special_tokens=False)

    # Word by word: for long words and for texts with unusual characters.

    @cached_property
    def _bytes(self):
        """The same vocabulary for words that are cut already: no normaliser, no further cuts."""
        from tokenizers import Tokenizer, pre_tokenizers

        settings = dict(self.settings, normalizer=None, added_tokens=[])
        plain = Tokenizer.from_str(json.dumps(settings))
        plain.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        return plain

    @cached_property
    def _inner(self):
        """The model for text within a word, where no word ends."""
        from tokenizers.models import BPE

        model = self.settings["model"]
        return BPE(vocab=model["vocab"], merges=[tuple(m) for m in model["merges"]])

    def words(self, text: str) -> list[str]:
        """The library's words of a text: normalised, and special tokens whole."""
        found = []
        for segment in re.split(f"({'|'.join(map(re.escape, self.specials))})", text) if self.specials else [text]:
            if segment in self.specials:
                found.append(segment)
            elif segment:
                normal = self.tokenizer.normalizer
                segment = normal.normalize_str(segment) if normal else segment
                cuts = self.tokenizer.pre_tokenizer.pre_tokenize_str(segment)
                # A character may be cut into bytes only within a word, so cuts are between characters.
                found += [segment[a:b] for _, (a, b) in cuts]
        return found

    def words_ids(self, words: list[str]) -> np.ndarray:
        short = [w for w in dict.fromkeys(words) if len(w) <= LEAF and w not in self.specials]
        found = self._bytes.encode_batch_fast(short, add_special_tokens=False)
        ids = {w: np.array(e.ids, "<u4") for w, e in zip(short, found, strict=True)}
        for w in words:
            if w in self.specials:
                ids[w] = np.array([self.tokenizer.token_to_id(w)], "<u4")
            elif w not in ids:
                ids[w] = self.tree(self.mapped(w), True)[0]
        return np.concatenate([ids[w] for w in words]) if words else np.zeros(0, "<u4")

    def mapped(self, word: str) -> str:
        """The word as the model sees it: a character for each byte."""
        return self._bytes.pre_tokenizer.pre_tokenize_str(word)[0][0]

    def piece(self, mapped: str, closes: bool) -> Tokens:
        """Ids and ends of the tokens of a piece of a word; ``closes`` if the word ends with it."""
        found = (self._bytes.model if closes else self._inner).tokenize(mapped)
        # The library's offsets count bytes; all but the mark of the word's end stands in the piece.
        ends = np.cumsum([len(t.value) for t in found])
        return np.array([t.id for t in found], "<u4"), np.minimum(ends, len(mapped)).astype(np.int64)

    def tree(self, mapped: str, closes: bool) -> Tokens:
        """The tokens of a piece, from those of its halves."""
        if len(mapped) <= LEAF:
            return self.piece(mapped, closes)
        mid = len(mapped) // 2
        left, right = self.tree(mapped[:mid], False), self.tree(mapped[mid:], closes)
        return joined(self.piece, mapped, left, right, closes)


def joined(
    piece: Callable[[str, bool], Tokens], mapped: str, left: Tokens, right: Tokens, closes: bool
) -> Tokens:
    """The tokens of ``mapped`` from those of its two parts, by windows that grow until both agree."""
    (ids_l, ends_l), (ids_r, ends_r) = left, right
    mid = int(ends_l[-1])
    ends_r = ends_r + mid
    take = 2
    while True:
        i, j = min(take, len(ids_l)), min(take, len(ids_r))
        start = int(ends_l[-i - 1]) if i < len(ids_l) else 0
        end = int(ends_r[j - 1])
        ids, ends = piece(mapped[start:end], closes and end == len(mapped))
        ends = ends + start
        starts = np.concatenate(([start], ends[:-1]))
        same_left = i == len(ids_l) or (ids[0] == ids_l[-i] and ends[0] == ends_l[-i])
        last = int(ends_r[j - 2]) if j > 1 else mid
        same_right = j == len(ids_r) or (ids[-1] == ids_r[j - 1] and starts[-1] == last)
        if same_left and same_right:
            return (
                np.concatenate((ids_l[:-i], ids, ids_r[j:])),
                np.concatenate((ends_l[:-i], ends, ends_r[j:])),
            )
        take *= 2


def _byte_pairs(model: dict):
    """The same vocabulary in the faster tiktoken, or None if its ids don't follow the order of the merges."""
    import tiktoken

    back = {char: byte for byte, char in MAPPED.items()}
    ranks = {bytes(back[c] for c in token): rank for token, rank in model["vocab"].items()}
    merged = ["".join(m) if isinstance(m, list) else m.replace(" ", "") for m in model["merges"]]
    order = [model["vocab"][m] for m in merged]
    if order != sorted(order) or len(ranks) != len(merged) + 256:
        return None
    return tiktoken.Encoding("bytes", pat_str=BYTE_WORDS, mergeable_ranks=ranks, special_tokens={})


@lru_cache(maxsize=4)
def encoder(path: str) -> Encoder:
    """The worker's encoder for this file."""
    return Encoder(path)


FOUND = "doc_id bigint, ids binary, decoded string"
CUT = "text_key string, doc_id bigint, piece int, words array<string>, fragment string, closes boolean"
PIECES = "text_key string, doc_id bigint, piece int, ids binary, ends binary, fragment string, closes boolean"


def encode(docs: DataFrame, path: str, *, piece: int = PIECE) -> DataFrame:
    """``doc_id, ids, decoded`` for every row of ``docs (doc_id, text)``.

    ``ids`` holds little-endian unsigned 32-bit integers, ``decoded`` what they decode to, special
    tokens included. ``path`` must be readable on all executors, as the library is.
    """
    rows = docs.select(F.col("doc_id").cast("bigint"), F.coalesce("text", F.lit("")).alias("text"))
    is_long = F.length("text") > piece

    def short(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path)
        for batch in batches:
            found = [own.encoded(t, decode=True) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([f[0] for f in found], pa.binary()), pa.array([f[1] for f in found], pa.string())],
                names=["doc_id", "ids", "decoded"],
            )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, task, number = encoder(path), TaskContext.get().partitionId(), 0
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                # Rows may repeat a doc_id; a task that is run again gives its rows the same keys.
                key, number = f"{task}-{number}", number + 1
                pieces = [dict(text_key=key, doc_id=doc_id, piece=i, **p) for i, p in enumerate(_dealt(own, text, piece))]
                yield from pa.Table.from_pylist(pieces, _arrow(CUT)).to_batches()

    def in_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path)
        for batch in batches:
            rows = []
            for row in batch.to_pylist():
                words, ends = row.pop("words"), None
                if row["fragment"] is None:
                    ids = own.words_ids(words)
                else:
                    ids, ends = own.tree(row["fragment"], row["closes"])
                rows.append(row | {"ids": ids.tobytes(), "ends": None if ends is None else ends.tobytes()})
            yield from pa.Table.from_pylist(rows, _arrow(PIECES)).to_batches()

    def together(table: pa.Table) -> pa.Table:
        own = encoder(path)
        rows = sorted(table.to_pylist(), key=lambda r: r["piece"])
        ids = np.concatenate([np.zeros(0, "<u4"), *_concatenated(own, rows)]).astype("<u4")
        found = {"doc_id": [rows[0]["doc_id"]], "ids": [ids.tobytes()], "decoded": [own.decoded(ids)]}
        return pa.table(found, _arrow(FOUND))

    pieces = rows.where(is_long).mapInArrow(cut, CUT).repartition("text_key", "piece").mapInArrow(in_pieces, PIECES)
    whole = pieces.groupBy("text_key").applyInArrow(together, FOUND)
    return rows.where(~is_long).mapInArrow(short, FOUND).unionByName(whole)


def _dealt(own: Encoder, text: str, size: int) -> Iterator[dict]:
    """The words of a text in pieces; a word longer than a piece as fragments of its mapped form."""
    held, length = [], 0
    for word in own.words(text):
        if len(word) > size:
            if held:
                yield {"words": held, "fragment": None, "closes": True}
                held, length = [], 0
            mapped = own.mapped(word)
            for at in range(0, len(mapped), size):
                yield {"words": [], "fragment": mapped[at : at + size], "closes": at + size >= len(mapped)}
            continue
        held.append(word)
        length += len(word)
        if length >= size:
            yield {"words": held, "fragment": None, "closes": True}
            held, length = [], 0
    # A text of white space alone has one piece without words.
    yield {"words": held, "fragment": None, "closes": True}


def _concatenated(own: Encoder, rows: list[dict]) -> Iterator[np.ndarray]:
    """The ids of the pieces in order; the fragments of a word are joined as a tree, two by two."""
    open_parts: list[tuple[str, Tokens, bool]] = []
    for row in rows:
        ids = np.frombuffer(row["ids"], "<u4")
        if row["fragment"] is None:
            yield ids
            continue
        open_parts.append((row["fragment"], (ids, np.frombuffer(row["ends"], np.int64)), row["closes"]))
        if row["closes"]:
            while len(open_parts) > 1:
                pairs = [open_parts[i : i + 2] for i in range(0, len(open_parts), 2)]
                open_parts = [_two(own, *p) if len(p) == 2 else p[0] for p in pairs]
            yield open_parts[0][1][0]
            open_parts = []


def _two(own: Encoder, left: tuple, right: tuple) -> tuple[str, Tokens, bool]:
    text = left[0] + right[0]
    return text, joined(own.piece, text, left[1], right[1], right[2]), right[2]


def _arrow(ddl: str) -> pa.Schema:
    kinds = {
        "string": pa.string(), "bigint": pa.int64(), "int": pa.int32(), "binary": pa.binary(),
        "boolean": pa.bool_(), "array<string>": pa.list_(pa.string()),
    }
    return pa.schema([(name, kinds[kind]) for name, kind in (c.split() for c in ddl.split(", "))])
