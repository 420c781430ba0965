"""Finding the keywords of a dictionary of any size through their rarest grams.

A gram is a few characters in a row, held as a 64-bit hash. All grams of the corpus are counted once.
Every keyword is filed under that of its grams which the corpus holds least; a keyword with a gram
that the corpus doesn't hold can't occur and is dropped. A text is then read once: its grams are
looked up in a bit set, what passes in the sorted list of the filed grams, and at the places that are
left the keywords filed there are compared with the text, so hashes that collide change nothing.

The filed keywords go to every task in slices of at most ``SLICE_BYTES``; a text is read once per
slice. With one slice a task has all matches of its texts and hands on only what is asked of them. With
several, places become rows, which are joined with the dictionary.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.lineage import materialize
from newsloom.operators.joins import lookup
from newsloom.operators.spotting import Texts, Words, points, together
from newsloom.sizes import BROADCAST_BYTES

#: Characters of a gram; shorter keywords are one gram.
GRAM = 4

#: A keyword's rarest gram is looked for among so many first ones.
FILED_FROM = 256

#: Filed grams that are sent to the tasks at once, and the bytes of one.
SLICE_BYTES, FILED_BYTES = BROADCAST_BYTES, 32

#: Bytes of a filed keyword in a task, besides those of a character.
KEYWORD_BYTES, CHARACTER_BYTES = 160, 9

#: Bits per filed gram in the bit set.
BITS = 16

#: Distinct grams that a task counts before it hands them on, and rows of a batch of places.
COUNTED, ROWS = 1 << 20, 20_000

#: Characters that are compared at a time, and the bits of one.
PACK, POINT_BITS = 3, 21

MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def hashes(codes: np.ndarray, size: int) -> np.ndarray:
    """A hash of the ``size`` characters that begin at each place."""
    n = max(len(codes) - size + 1, 0)
    found = np.full(n, size, np.uint64)
    for j in range(size):
        found = (found ^ codes[j : j + n].astype(np.uint64)) * MULTIPLIER
        found ^= found >> np.uint64(29)
    return found


def packs(codes: np.ndarray) -> np.ndarray:
    """The ``PACK`` characters that begin at each place, in one number."""
    padded = np.append(codes, np.zeros(PACK - 1, np.uint32)).astype(np.uint64)
    found = np.zeros(len(codes), np.uint64)
    for j in range(PACK):
        found |= padded[j : j + len(codes)] << np.uint64(j * POINT_BITS)
    return found


def gram_counts(docs: DataFrame, sizes: Sequence[int], *, text: str = "text") -> DataFrame:
    """``gram, n``: how often the corpus holds each gram of these sizes."""

    def out(grams: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(grams.view(np.int64)), pa.array(counts)], names=["gram", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            for _, texts in together(batch.column(0)):
                ends = np.cumsum(texts.sizes + 1)[texts.row_of] - 1
                for size in sizes:
                    grams = hashes(texts.codes, size)
                    # Not those that run into the mark behind a text.
                    grams = grams[np.arange(len(grams)) + size <= ends[: len(grams)]]
                    held.append(np.unique(grams, return_counts=True))
                    n += len(held[-1][0])
                if n > 4 * COUNTED:
                    held = [_added(held)]
                    n = len(held[0][0])
                    if n > COUNTED:
                        yield out(*held[0])
                        held, n = [], 0
        if n:
            yield out(*_added(held))

    partial = docs.select(F.col(text).cast("string")).mapInArrow(run, "gram bigint, n bigint")
    return partial.groupBy("gram").agg(F.sum("n").alias("n"))


def _added(held: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    grams, where = np.unique(np.concatenate([g for g, _ in held]), return_inverse=True)
    return grams, np.bincount(where, np.concatenate([c for _, c in held]), len(grams)).astype(np.int64)


def keyword_grams(table: DataFrame) -> DataFrame:
    """``kw_id, kw, size, back, gram``: the grams of every keyword, ``back`` characters behind its beginning."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for kw_id, kw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                size = min(len(kw), GRAM)
                grams = hashes(points(kw[: FILED_FROM + GRAM]), size)[:FILED_FROM]
                n = len(grams)
                columns = [pa.array([kw_id] * n, pa.int64()), pa.array([kw] * n, pa.string()), pa.array([size] * n, pa.int32())]
                columns += [pa.array(range(n), pa.int32()), pa.array(grams.view(np.int64))]
                yield pa.RecordBatch.from_arrays(columns, names=["kw_id", "kw", "size", "back", "gram"])

    columns = table.select(F.col("kw_id").cast("bigint"), "kw")
    return columns.mapInArrow(run, "kw_id bigint, kw string, size int, back int, gram bigint")


def filed(docs: DataFrame, table: DataFrame, *, text: str = "text") -> DataFrame:
    """``gram, size, back, kw_id, kw``: every keyword that can occur, under its rarest gram; written."""
    grams = materialize(keyword_grams(table), "keyword-grams")
    sizes = [row["size"] for row in grams.select("size").distinct().collect()]  # GRAM at most
    counts = gram_counts(docs, sorted(sizes), text=text)
    asked = grams.select("gram").distinct()
    # No more than the keywords have; written, as it is measured and joined.
    known = materialize(counts.join(asked, "gram", "left_semi"), "known-grams")
    rarest = F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "back", "gram", "size")).alias("rarest")
    best = lookup(grams, known, "gram", "left").groupBy("kw_id", "kw").agg(rarest).where("rarest.n > 0")
    return materialize(best.select("rarest.gram", "rarest.size", "rarest.back", "kw_id", "kw"), "filed-keywords")


class FiledGrams:
    """The grams of a slice of the dictionary: a bit set, and for each gram how far its keywords reach."""

    def __init__(self, gram: np.ndarray, size: np.ndarray, back: np.ndarray, ahead: np.ndarray):
        order = np.argsort(gram, kind="stable")
        self.gram, self.size, self.back, self.ahead = gram[order], size[order], back[order], ahead[order]
        self.sizes = np.unique(size).tolist()
        #: Whether the gram is all that its keywords are.
        self.alone = (self.back == 0) & (self.ahead == self.size)
        self.shift = np.uint64(64 - max(int(np.ceil(np.log2(max(len(gram) * BITS, 64)))), 6))
        at = self.gram >> self.shift
        bits = np.zeros(1 << (64 - int(self.shift)), bool)
        bits[at] = True
        self.bits = np.packbits(bits, bitorder="little")

    def places(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where in a text filed grams begin, and which."""
        found = []
        for size in self.sizes:
            grams = hashes(codes, size)
            slot = grams >> self.shift
            passed = np.flatnonzero(self.bits[slot >> np.uint64(3)] >> (slot & np.uint64(7)).astype(np.uint8) & 1)
            at = np.minimum(np.searchsorted(self.gram, grams[passed]), len(self.gram) - 1)
            here = (self.gram[at] == grams[passed]) & (self.size[at] == size)
            found.append((passed[here], at[here]))
        place, which = (np.concatenate(x) for x in zip(*found, strict=True))
        return place, which


class FiledKeywords(Words):
    """The keywords of a slice with the grams that they are filed under."""

    def __init__(self, ids: np.ndarray, words: Sequence[str], gram: np.ndarray, size: np.ndarray, back: np.ndarray):
        super().__init__(ids, words)
        order = np.argsort(ids, kind="stable")
        gram, size, self.back = gram[order], size[order], back[order]
        filed_under = np.lexsort((size, gram))
        first = np.append(True, (gram[filed_under][1:] != gram[filed_under][:-1]) | (size[filed_under][1:] != size[filed_under][:-1]))
        starts = np.flatnonzero(first)
        ahead = np.maximum.reduceat((self.length - self.back)[filed_under], starts)
        at = filed_under[starts]
        self.grams = FiledGrams(gram[at], size[at], np.maximum.reduceat(self.back[filed_under], starts), ahead)
        #: By gram: where its keywords begin in the list of all, and how many they are.
        self.filed, self.first, self.many = filed_under, starts, np.diff(np.append(starts, len(gram)))
        self.n_packs = -(-self.length // PACK)
        self.pack_at = np.cumsum(self.n_packs) - self.n_packs
        inside = np.arange(len(self.flat)) - np.repeat(self.at, self.length)
        shift = (inside % PACK * POINT_BITS).astype(np.uint64)
        begins = np.flatnonzero(inside % PACK == 0)
        #: The keywords, and which bits of their last pack count.
        self.packs = np.bitwise_or.reduceat(self.flat.astype(np.uint64) << shift, begins)
        self.masks = np.bitwise_or.reduceat(np.uint64((1 << POINT_BITS) - 1) << shift, begins)

    def found(self, texts: Texts) -> tuple[np.ndarray, np.ndarray]:
        place, which = self.grams.places(texts.codes)
        many = self.many[which]
        ends = np.cumsum(many)
        listed = np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - many - self.first[which], many)
        word = self.filed[listed]
        start = np.repeat(place, many) - self.back[word]
        same = np.flatnonzero((start >= 0) & (start + self.length[word] <= len(texts.codes)))
        packed, found = packs(texts.codes), []
        word, begin = word[same], start[same]
        pack, left = self.pack_at[word], self.n_packs[word]
        place = begin
        # One more pack of all that are the same so far; the mark behind a text is in none of theirs.
        while len(word):
            on = np.flatnonzero((packed[place] & self.masks[pack]) == self.packs[pack])
            word, begin, place, pack, left = word[on], begin[on], place[on] + PACK, pack[on] + 1, left[on] - 1
            done = left == 0
            found.append((begin[done], word[done]))
            on = np.flatnonzero(~done)
            word, begin, place, pack, left = word[on], begin[on], place[on], pack[on], left[on]
        if not found:
            return super().found(texts)
        return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def whole_matcher(docs: DataFrame, table: DataFrame, *, text: str = "text") -> tuple[DataFrame, Words | None]:
    """The filed dictionary, and a matcher with all of it if it was measured to fit one slice."""
    dictionary = filed(docs, table, text=text)
    bytes_of = F.lit(KEYWORD_BYTES).cast("bigint") + CHARACTER_BYTES * F.length("kw")
    measured = dictionary.agg(F.coalesce(F.sum(bytes_of), F.lit(0)).alias("n")).first()["n"]
    if measured > SLICE_BYTES:
        return dictionary, None
    held = dictionary.select("kw_id", "kw", "gram", "size", "back").toArrow()
    if not len(held):
        return dictionary, Words(np.zeros(0, np.int64), [])
    ids, gram, size, back = (held.column(c).to_numpy() for c in ("kw_id", "gram", "size", "back"))
    return dictionary, FiledKeywords(ids, held.column("kw").to_pylist(), gram.view(np.uint64), size, back.astype(np.int64))


def candidates(docs: DataFrame, filed_grams: FiledGrams, *, text: str, key: Sequence[str], once: bool) -> DataFrame:
    """``key, gram, pos, begin, around``: places of filed grams; ``around`` is the text from ``begin`` on.

    With ``once`` the same gram in the same surroundings is a row only once per text.
    """
    sent = docs.sparkSession.sparkContext.broadcast(filed_grams)
    names = [*key, "gram", "pos", "begin", "around"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = sent.value
        for batch in batches:
            held: list[tuple[int, int, int, int, str]] = []
            for row, value in enumerate(batch.column(len(key)).to_pylist()):
                if not value:
                    continue
                place, which = own.places(points(value))
                if once:
                    # What is around a gram that is a keyword by itself is the same everywhere.
                    first = np.zeros(len(which), bool)
                    first[np.unique(which, return_index=True)[1]] = True
                    kept = first | ~own.alone[which]
                    place, which = place[kept], which[kept]
                begin = np.maximum(place - own.back[which], 0)
                spans = zip(which.tolist(), place.tolist(), begin.tolist(), (place + own.ahead[which]).tolist(), strict=True)
                found = [(row, at, pos, start, value[start:end]) for at, pos, start, end in spans]
                if once:
                    found = list({(at, around, pos - start): (row, at, pos, start, around) for row, at, pos, start, around in found}.values())
                held += found
                if len(held) > ROWS:
                    yield out(batch, held)
                    held = []
            if held:
                yield out(batch, held)

    def out(batch: pa.RecordBatch, held: list[tuple]) -> pa.RecordBatch:
        rows, which, pos, begin, around = zip(*held, strict=True)
        grams = sent.value.gram[list(which)].view(np.int64)
        keys = [batch.column(i).take(pa.array(rows, pa.int64())) for i in range(len(key))]
        columns = [*keys, pa.array(grams), pa.array(pos, pa.int64()), pa.array(begin, pa.int64()), pa.array(around, pa.string())]
        return pa.RecordBatch.from_arrays(columns, names=names)

    columns = docs.select(*key, F.col(text).cast("string"))
    kinds = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in key)
    return columns.mapInArrow(run, f"{kinds}, gram bigint, pos bigint, begin bigint, around string")


def occurrences(
    docs: DataFrame,
    table: DataFrame,
    *,
    text: str = "text",
    key: Sequence[str],
    once: bool = False,
    dictionary: DataFrame | None = None,
) -> DataFrame:
    """``key, pos, kw_id, kw``: every occurrence of every keyword of ``table (kw_id, kw)``, overlaps included.

    With ``once`` a text may leave out further occurrences of a keyword it has. Nulls and empty texts hold none.
    ``dictionary`` is the table as it was filed, if it was.
    """
    dictionary = filed(docs, table, text=text) if dictionary is None else dictionary
    per_gram = dictionary.groupBy("gram", "size").agg(
        F.max("back").alias("back"), F.max(F.length("kw") - F.col("back")).alias("ahead")
    )
    slices = -(-per_gram.count() * FILED_BYTES // SLICE_BYTES)
    found = None
    for i in range(max(slices, 1)):
        part = F.pmod(F.col("gram"), F.lit(max(slices, 1))) == i
        held = per_gram.where(part).toArrow()
        if not len(held):
            continue
        columns = [held.column(c).to_numpy() for c in ("gram", "size", "back", "ahead")]
        places = candidates(docs, FiledGrams(columns[0].view(np.uint64), *columns[1:]), text=text, key=key, once=once)
        joined = lookup(places, dictionary.where(part).select("gram", "back", "kw_id", "kw"), "gram", costly=True)
        start = F.col("pos") - F.col("back")
        same = F.substr("around", (start - F.col("begin") + 1).cast("int"), F.length("kw")) == F.col("kw")
        # A keyword that would begin before the text isn't in it.
        matched = joined.where((start >= F.col("begin")) & same).select(*key, start.alias("pos"), "kw_id", "kw")
        found = matched if found is None else found.unionByName(matched)
    if found is None:
        none = docs.select(*key, F.lit(0).cast("bigint").alias("pos"), F.lit(0).cast("bigint").alias("kw_id"), F.lit("").alias("kw"))
        return none.where(F.lit(False))
    return found
