"""Tokens of two tokenizers aligned by their bytes, with corpus-wide counts of linked ids.

A byte-level BPE (A) encodes a space and the text, a sentencepiece model (B, which adds that space)
the text. Character offsets of A's tokens and the spans of B's pieces (the library's offset mapping,
which stands for its immutable proto of former versions) give coarse cuts. Inside a character of
several bytes, which A's tokens may share and B may spell in byte tokens, the decoded bytes of the
tokens refine them. Places where a token of A and one of B end together cut both into groups; two
tokens whose byte ranges overlap are linked.

A text is cut into units, a run of spaces and line feeds with what follows up to the next such run,
and the marks at the end of a word. No token of A and no piece of B reaches across these cuts (B's
are tested when the file is loaded), so a unit is encoded and aligned once per worker, wherever it
stands. A text with other white space is one unit.

Every document is encoded once and written as places in a list of its block's units, with the links
of these. Over this table every task adds up in how many documents each pair of ids is linked, and
only these partial counts are shuffled; then the documents are scored. The table of pairs follows
the vocabularies more than the corpus; measured below ``BROADCAST_BYTES`` it goes to every task, and
larger ones are joined with the documents' pairs, with the same result.

Defined cases: texts that are null or empty, or that B can't spell byte by byte (such as with the
space sign U+2581 in them), have no tokens: all numbers are zero and the digest is empty. Rows with
null or repeated ids come back as they are, each counted as a document. Memory follows the longest
text. An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import os
import re
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.lineage import materialize
from newsloom.operators.joins import lookup
from newsloom.sizes import BROADCAST_BYTES

#: Units that a worker remembers, and pairs that a task adds up before it hands them on.
REMEMBERED, HELD_PAIRS = 200_000, 1 << 18

#: Texts whose new units are encoded together, and units that a block of documents has but for its last document.
TOGETHER, BLOCK_UNITS = 64, 100_000

#: Bytes of one pair with its numbers in memory.
PAIR_BYTES = 24

#: A run of spaces and line feeds with what follows; marks behind the letters at its end may stand apart.
UNIT = re.compile("[ \n]*[^ \n]+|[ \n]+")
LETTERS, MARKS = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff", "!-/:-@\\[-`{-~"
MARKED_UNIT = re.compile(f"[ \n]*[{LETTERS}]+(?=[{MARKS}]*(?![^ \n]))|[{MARKS}]+(?![^ \n])|[ \n]*[^ \n]+|[ \n]+")
ENDS_IN_MARKS = re.compile(f"[{LETTERS}][{MARKS}]")

#: White space that A's pattern may join with a space or line feed beside it.
OTHER_SPACE = re.compile("[\t\x0b\x0c\r\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")

BYTE_PIECE = re.compile("<0x([0-9A-F]{2})>")

NUMBERS = ("n_a", "n_b", "n_groups", "n_links")
DIGEST = ", ".join(f"{name} bigint" for name in NUMBERS) + ", groups_sha256 string"
RESULT = ["doc_id", *NUMBERS, "groups_sha256", "n_best", "count_sum"]

#: What a block of documents holds: of each document a number or string, and compressed numbers.
LISTED = {"doc_id": pa.int64(), **{name: pa.int64() for name in NUMBERS}, "groups_sha256": pa.string()}
PACKED = {"n_units": "<i4", "units": "<i4", "n_pairs": "<i4", "pairs": "<i8"}
CODEC = "zstd"


def byte_letters() -> dict[str, int]:
    """The byte that each letter of a byte-level vocabulary stands for."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


def common_cuts(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of tokens of either side that end at or before each place where both end."""
    _, at_a, at_b = np.intersect1d(ends_a, ends_b, assume_unique=True, return_indices=True)
    return at_a + 1, at_b + 1


def overlaps(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the tokens whose ranges overlap, from growing ends that meet at last."""
    starts_a = np.concatenate(([0], ends_a[:-1]))
    first = np.searchsorted(ends_b, starts_a, "right")
    n = np.searchsorted(ends_b, ends_a, "left") - first + 1
    return np.repeat(np.arange(len(ends_a)), n), runs(first, n)


def runs(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """``start, start + 1, ...`` for each start, ``length`` numbers each, one after another."""
    ends = np.cumsum(length)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(start - ends + length, length)


def refined(cuts: np.ndarray, shared: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Ends of tokens in bytes: the coarse cuts, and behind tokens that end inside a character the decoded bytes."""
    return np.where(shared, np.cumsum(sizes), cuts)


def _shared(ends: np.ndarray) -> np.ndarray:
    """Whether a token's cut is that of a neighbour too: it then ends inside a character or stands for a part of one."""
    same = ends[1:] <= ends[:-1]
    return np.append(same, False) | np.append(False, same) if len(ends) else same


def spells(units: list[str], ids: np.ndarray, n: np.ndarray, spelt: list[bytes]) -> np.ndarray:
    """Which units the bytes of their tokens spell."""
    ends = np.cumsum(n).tolist()
    return np.array(
        [
            b"".join([spelt[i] for i in ids[end - k : end].tolist()]) == unit.encode()
            for unit, end, k in zip(units, ends, n.tolist(), strict=True)
        ]
    )


class Places(dict):
    """Numbers of units; one that is asked for the first time gets the next and is noted."""

    def __init__(self) -> None:
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, unit: str) -> int:
        self.new.append(unit)
        n = self[unit] = len(self)
        return n


class Aligner:
    """Both tokenizers, and the units met so far."""

    def __init__(self, path_a: str, path_b: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a, self.b = Tokenizer.from_file(path_a), SentencePieceProcessor(model_file=path_b)
        self.a.no_truncation()
        self.a.no_padding()
        self.a.encode_special_tokens = True
        letter = byte_letters()
        spelt = {
            i: bytes(letter[c] for c in word) if set(word) <= letter.keys() else word.encode()
            for word, i in self.a.get_vocab().items()
        }
        self.bytes_a = [spelt.get(i, b"") for i in range(max(spelt) + 1)]
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = [
            bytes([int(m[1], 16)]) if (m := BYTE_PIECE.fullmatch(p)) else p.replace("\u2581", " ").encode() for p in pieces
        ]
        self.sizes_a, self.sizes_b = (np.array([len(x) for x in side]) for side in (self.bytes_a, self.bytes_b))
        of_text = [p for i, p in enumerate(pieces) if not (self.b.is_control(i) or self.b.is_unknown(i) or self.b.is_byte(i))]
        self.cuts = not any("\u2581" in p.lstrip("\u2581") or "\n" in p for p in of_text)
        self.unit = UNIT if any(ENDS_IN_MARKS.search(p) for p in of_text) else MARKED_UNIT
        self.forget()

    def forget(self) -> None:
        self.at = Places()
        self.groups: list[str] = []
        # Of each unit: tokens of A and of B, groups, links, whether it can't be spelt, and where its links begin.
        self.sums = np.zeros((1024, 6), np.int64)
        self.links, self.n_links = np.zeros(4096, np.int64), 0

    def units(self, text: str) -> list[str]:
        whole = " " + text
        return self.unit.findall(whole) if self.cuts and not OTHER_SPACE.search(text) else [whole]

    def learn(self) -> None:
        """Encode and align the units that were given a place since the last time."""
        new, self.at.new = self.at.new, []
        if not new:
            return
        first = len(self.at) - len(new)
        while len(self.at) > len(self.sums):
            self.sums = np.concatenate((self.sums, np.zeros_like(self.sums)))
        self.groups += [""] * len(new)
        self._align(new, np.arange(first, first + len(new)))

    def _align(self, new: list[str], place: np.ndarray) -> None:
        of_a = self.a.encode_batch(new, add_special_tokens=False)
        n_a = np.array([len(e) for e in of_a])
        ids_a = np.array([i for e in of_a for i in e.ids], np.int64)
        cuts_a = np.array([x[1] for e in of_a for x in e.offsets], np.int64)
        # B adds the space that a unit begins with, but for no text. Before other units stands a line feed, which no
        # piece holds, and what is spelt for it and the added space is left out.
        begins = [u[0] == " " and len(u) > 1 for u in new]
        texts = [u[1:] if s else "\n" + u for u, s in zip(new, begins, strict=True)]
        of_b = self.b.encode(texts, return_type="offset_mapping", num_threads=1)
        out = [0 if s else 2 for s in begins]
        ids_b = np.array([i for e, k in zip(of_b, out, strict=True) for i in (e["ids"][k:] if k else e["ids"])], np.int64)
        cuts_b = np.array([x[1] for e, k in zip(of_b, out, strict=True) for x in (e["offsets"][k:] if k else e["offsets"])], np.int64)
        n_b = np.array([len(e["ids"]) for e in of_b]) - np.array(out)

        whole = "".join(new)
        spelt = whole.encode()
        of_unit_a, of_unit_b = np.repeat(np.arange(len(new)), n_a), np.repeat(np.arange(len(new)), n_b)
        if b"".join([self.bytes_a[i] for i in ids_a]) != spelt or b"".join([self.bytes_b[i] for i in ids_b]) != spelt:
            good = spells(new, ids_a, n_a, self.bytes_a) & spells(new, ids_b, n_b, self.bytes_b)
            self.sums[place[~good], 4] = 1
            if good.any():
                self._align([u for u, g in zip(new, good.tolist(), strict=True) if g], place[good])
            return
        chars = np.concatenate(([0], np.cumsum([len(u) for u in new])))
        # Coarse cuts count characters, those of B from behind the space that it adds, or from before the line feed.
        cuts_a, cuts_b = cuts_a + chars[of_unit_a], cuts_b + (chars[:-1] + np.where(begins, 1, -1))[of_unit_b]
        if not whole.isascii():
            points = np.frombuffer(whole.encode("utf-32-le"), np.uint32)
            bytes_at = np.concatenate(([0], np.cumsum(1 + (points > 0x7F) + (points > 0x7FF) + (points > 0xFFFF))))
            cuts_a, cuts_b = bytes_at[cuts_a], bytes_at[cuts_b]
        ends_a = refined(cuts_a, _shared(cuts_a), self.sizes_a[ids_a])
        ends_b = refined(cuts_b, _shared(cuts_b), self.sizes_b[ids_b])
        cut_a, cut_b = common_cuts(ends_a, ends_b)
        a, b = overlaps(ends_a, ends_b)
        n_links = np.bincount(of_unit_a[a], minlength=len(new))
        n_cuts = np.bincount(of_unit_a[cut_a - 1], minlength=len(new))
        listed = self._listed(ids_a.tolist(), ids_b.tolist(), cut_a.tolist(), cut_b.tolist())
        edges = np.concatenate(([0], np.cumsum(n_cuts))).tolist()
        for at, i, j in zip(place.tolist(), edges, edges[1:], strict=False):
            self.groups[at] = listed[i] if j - i == 1 else ";".join(listed[i:j])
        while self.n_links + len(a) > len(self.links):
            self.links = np.concatenate((self.links, np.zeros_like(self.links)))
        self.links[self.n_links : self.n_links + len(a)] = (ids_a[a] << 32) | ids_b[b]
        self.sums[place] = np.stack([n_a, n_b, n_cuts, n_links, 0 * n_a, self.n_links + np.cumsum(n_links) - n_links], axis=1)
        self.n_links += len(a)

    @staticmethod
    def _listed(ids_a: list[int], ids_b: list[int], cut_a: list[int], cut_b: list[int]) -> list[str]:
        listed, i, j = [], 0, 0
        for to_a, to_b in zip(cut_a, cut_b, strict=True):
            if to_a - i == to_b - j == 1:
                listed.append(f"{ids_a[i]}|{ids_b[j]}")
            else:
                listed.append(",".join(map(str, ids_a[i:to_a])) + "|" + ",".join(map(str, ids_b[j:to_b])))
            i, j = to_a, to_b
        return listed

    def pairs(self, places: np.ndarray) -> np.ndarray:
        """The linked pairs of units, one unit's after another's."""
        of = self.sums[places]
        return self.links[runs(of[:, 5], of[:, 3])]

    def texts(self, texts: list[str | None]) -> Iterator[np.ndarray]:
        """The places of each text's units; empty for texts without tokens.

        They hold until the next ones are asked for.
        """
        none = np.zeros(0, np.int64)
        for at in range(0, len(texts), TOGETHER):
            # Places are given as units are met; what is new is learned for all of these texts at once.
            cut = [list(map(self.at.__getitem__, self.units(t))) if t else [] for t in texts[at : at + TOGETHER]]
            self.learn()
            for units in cut:
                places = np.array(units, np.int64)
                yield none if self.sums[places, 4].any() else places


_ALIGNERS: dict[tuple[str, str], Aligner] = {}


def aligner(path_a: str, path_b: str) -> Aligner:
    """The aligner of this worker, kept from task to task."""
    if (path_a, path_b) not in _ALIGNERS:
        _ALIGNERS[path_a, path_b] = Aligner(path_a, path_b)
    return _ALIGNERS[path_a, path_b]


def blocks(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """Every document encoded once, written in blocks of some documents that each stand for themselves.

    A block has a number, of its documents the ids, the digests, how many units they have and which
    (``units``, as places in the block's own list), and of that list the linked pairs (``n_pairs``, ``pairs``).
    """

    def row(ids: list, digests: list, places: list[np.ndarray], own: Aligner) -> pa.RecordBatch:
        used, units = np.unique(np.concatenate(places), return_inverse=True)
        sizes = [len(x) for x in places]
        held = [ids, *map(list, zip(*digests, strict=True))]
        arrays = [pa.array([x], pa.list_(kind)) for x, kind in zip(held, LISTED.values(), strict=True)]
        numbers = [sizes, units, own.sums[used, 3], own.pairs(used)]
        for values, kind in zip(numbers, PACKED.values(), strict=True):
            plain = np.asarray(values).astype(kind).tobytes()
            arrays.append(pa.array([len(plain).to_bytes(8, "little") + pa.compress(plain, CODEC, asbytes=True)], pa.binary()))
        return pa.RecordBatch.from_arrays([pa.array([uuid.uuid4().int >> 65]), *arrays], names=["block", *LISTED, *PACKED])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = aligner(path_a, path_b)
        ids, digests, held, n = [], [], [], 0
        for batch in batches:
            for at in range(0, len(batch), TOGETHER):
                part = batch.slice(at, TOGETHER)
                for doc_id, places in zip(part.column(0).to_pylist(), own.texts(part.column(1).to_pylist()), strict=True):
                    ids.append(doc_id)
                    digests.append(_digest(own, places))
                    held.append(places)
                    n += len(places)
                if n > BLOCK_UNITS:
                    yield row(ids, digests, held, own)
                    ids, digests, held, n = [], [], [], 0
                    if len(own.at) > REMEMBERED:
                        own.forget()
        if ids:
            yield row(ids, digests, held, own)
        # The worker's next task may be another stage's.
        own.forget()

    fields = ", ".join(
        [f"{name} array<{'string' if kind == pa.string() else 'bigint'}>" for name, kind in LISTED.items()] + [f"{name} binary" for name in PACKED]
    )
    columns = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    return materialize(columns.mapInArrow(run, "block bigint, " + fields), "aligned")


def _documents(batch: pa.RecordBatch) -> Iterator[tuple]:
    """Of each block the number, ids and digests, the documents' units, and the numbers and pairs of the units."""
    for i in range(len(batch)):
        n_units, units, n_pairs, pairs = (_numbers(batch.column(name)[i].as_py(), kind) for name, kind in PACKED.items())
        listed = [batch.column(name)[i].values for name in LISTED]
        yield batch.column("block")[i].as_py(), listed, np.split(units, np.cumsum(n_units)[:-1]), n_pairs, pairs


def _numbers(packed: bytes, kind: str) -> np.ndarray:
    size = int.from_bytes(packed[:8], "little")
    return np.frombuffer(pa.decompress(packed[8:], size, CODEC, asbytes=True), kind)


def _pairs_of(units: np.ndarray, ends: np.ndarray, n_pairs: np.ndarray, pairs: np.ndarray) -> np.ndarray:
    return pairs[runs(ends[units] - n_pairs[units], n_pairs[units])]


def _added(held: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    pairs, where = np.unique(np.concatenate([p for p, _ in held]), return_inverse=True)
    return pairs, np.bincount(where, np.concatenate([c for _, c in held]), len(pairs)).astype(np.int64)


def pair_counts(aligned: DataFrame) -> DataFrame:
    """``pair, n, best``: in how many documents two ids are linked; ``best`` if no id of B has more with the id of A.

    A pair is the id of A in the upper and that of B in the lower 32 bits.
    """

    def out(pairs: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(pairs), pa.array(counts)], names=["pair", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            for _, _, docs, n_pairs, pairs in _documents(batch):
                # Pairs as places in the block's list of distinct ones, counted once per document.
                distinct, place = np.unique(pairs, return_inverse=True)
                ends, counts = np.cumsum(n_pairs), np.zeros(len(distinct), np.int64)
                for units in docs:
                    counts[np.unique(_pairs_of(np.unique(units), ends, n_pairs, place))] += 1
                held.append((distinct[counts > 0], counts[counts > 0]))
                n += len(held[-1][0])
                if n > 4 * HELD_PAIRS:
                    held = [_added(held)]
                    n = len(held[0][0])
                    if n > HELD_PAIRS:
                        yield out(*held[0])
                        held, n = [], 0
        if n:
            yield out(*_added(held))

    partial = aligned.mapInArrow(run, "pair bigint, n bigint")
    counts = materialize(partial.groupBy("pair").agg(F.sum("n").alias("n")), "pair-counts")
    of_a = F.shiftright("pair", 32).alias("a")
    # One row for each id of A: as many as its vocabulary has.
    most = counts.groupBy(of_a).agg(F.max("n").alias("most"))
    ranked = counts.withColumn("a", of_a).join(F.broadcast(most), "a")
    return materialize(ranked.select("pair", "n", (F.col("n") == F.col("most")).alias("best")), "pairs")


def align(docs: DataFrame, path_a: str, path_b: str, *, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``doc_id``, the numbers of tokens, groups and links, the digest of the groups, ``n_best, count_sum`` for every row."""
    aligned = blocks(docs, path_a, path_b)
    counts = pair_counts(aligned)
    small = counts.count() * PAIR_BYTES <= broadcast_bytes
    return _scored(aligned, counts) if small else _joined(aligned, counts)


def _digest(own: Aligner, places: np.ndarray) -> tuple:
    if not len(places):
        return 0, 0, 0, 0, ""
    groups = hashlib.sha256(";".join([own.groups[p] for p in places.tolist()]).encode())
    return *own.sums[places, :4].sum(axis=0).tolist(), groups.hexdigest()


def _scored(aligned: DataFrame, counts: DataFrame) -> DataFrame:
    """The documents scored in place, with a table of pairs that was measured to be small."""
    table = counts.toArrow().sort_by("pair")
    columns = [table.column(name).to_numpy() for name in ("pair", "n", "best")]
    sent = aligned.sparkSession.sparkContext.broadcast(columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, counted, best = sent.value
        for batch in batches:
            for _, digests, docs, n_pairs, pairs in _documents(batch):
                at, of = np.searchsorted(known, pairs), np.repeat(np.arange(len(n_pairs)), n_pairs)
                # Units of texts without tokens have pairs that may not be counted.
                at = np.minimum(at, max(len(known) - 1, 0))
                here = known[at] == pairs if len(known) else np.zeros(0, np.int64)
                at, of = at[here], of[here]
                scores = [np.bincount(of, x[at], len(n_pairs)).astype(np.int64) for x in (best, counted)]
                sums = [pa.array([int(x[units].sum()) for units in docs], pa.int64()) for x in scores]
                yield pa.RecordBatch.from_arrays([*digests, *sums], names=RESULT)

    return aligned.mapInArrow(run, "doc_id bigint, " + DIGEST + ", n_best bigint, count_sum bigint")


def _joined(aligned: DataFrame, counts: DataFrame) -> DataFrame:
    """The same for a table of any size: each document's distinct pairs are joined with it and summed up by document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, _, docs, n_pairs, pairs in _documents(batch):
                ends = np.cumsum(n_pairs)
                for at, units in enumerate(docs):
                    found, often = np.unique(_pairs_of(units, ends, n_pairs, pairs), return_counts=True)
                    columns = [np.full(len(found), block), np.full(len(found), at), found, often]
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["block", "at", "pair", "often"])

    lines = aligned.mapInArrow(run, "block bigint, at bigint, pair bigint, often bigint")
    scores = lookup(lines, counts, "pair", small=False, costly=True).groupBy("block", "at").agg(
        F.sum(F.when(F.col("best"), F.col("often")).otherwise(0)).alias("n_best"),
        F.sum(F.col("often") * F.col("n")).alias("count_sum"),
    )
    documents = F.arrays_zip(*RESULT[:-2])
    digests = aligned.select("block", F.posexplode(documents).alias("at", "of")).select("block", "at", "of.*")
    return digests.join(scores, ["block", "at"], "left").select(
        *RESULT[:-2], *[F.coalesce(c, F.lit(0).cast("bigint")).alias(c) for c in RESULT[-2:]]
    )
