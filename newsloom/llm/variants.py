"""Spelling variants by a bit-sliced position index.

Words of a corpus that differ by one inserted, deleted or replaced letter are near. A word's form is
its near word with the most occurrences (of equals the first in code-point order), if it has
``RATIO`` times as many; its root is the end of the chain of forms.

Which words meet: two near words have m and m or m + 1 letters. The m places are cut into windows;
outside the window that holds the edit both words are equal, before it from the front and behind it
from the back. So every word is filed, as the shorter and as the longer one, under each window with
what stands outside it, and only what stands inside is compared. The edit of a pair is taken to be
where the two first differ, so a pair is found in one window only.

The index: the words of a bucket stand one after another, 64 to a lane. Per place and letter a bit
set tells which words have that letter there. A query takes its letters in turn and tracks four sets,
64 words at a time: words equal so far, and words with one replaced, one missing or one further
letter, for which the place in the word is shifted by one. What is left at the end and has the
right length is near. A task holds ``LANES`` lanes at a time and never a part of a bucket, and hands
on one row per word: how many near words it met and which of them ranks first. No pairs leave it.

Buckets with more than ``HOT_BUCKET`` words are cut: their windows are halved, which files each word
under what its other half is, until none is hot or windows have one place. (A window of one place
holds at most the alphabet and its pairs.) Long words have windows of ``WINDOW`` places, so that work
grows with their length, and what is outside is hashed to 128 bits from running hashes.

Defined cases: a null text has no words; a null ``doc_id`` is an empty one where edits are drawn;
rows that repeat count as often; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.functions.text import let
from newsloom.lineage import materialize
from newsloom.operators.matching import exploded

#: A run of letters (fixed by the contract), and the shortest and rarest word that is looked at.
LETTERS = r"[A-Za-z\x{C0}-\x{FF}]"
MIN_LETTERS, MIN_COUNT = 7, 2

#: One run in so many loses a letter (fixed by the contract).
EDIT_EVERY = 31

#: A form has so many times the occurrences of the word.
RATIO = 10

#: Places of a window of a long word; short words are halved.
WINDOW = 16

#: Buckets with more words than this are cut; above what one place can hold (8,190 words of 90 letters).
HOT_BUCKET = 20_000

#: Lanes of 64 words that a task indexes at a time, but for the rest of the last bucket, and queries times lanes.
LANES, SEARCHED = 1024, 1 << 20

FILED = "key binary, rank bigint, inside string, size int, last boolean"
FOUND = "rank bigint, n_near bigint, best bigint"


def words(docs: DataFrame) -> DataFrame:
    """``word, n``: the words of the corpus, some runs short of a letter, that are long and frequent enough."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    # Shorter runs can't become words; a pattern that starts where a run starts takes all of a run.
    found = F.regexp_extract_all("text", F.lit(f"{LETTERS}{{{MIN_LETTERS},}}"), F.lit(0))
    doc_id = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))

    def drawn(run):
        checksum = F.crc32(F.concat(doc_id, F.lit(":"), run).cast("binary"))
        at = F.pmod(checksum, F.length(run)).cast("int")
        cut = F.concat(F.substr(run, F.lit(1), at), F.substr(run, at + 2, F.length(run)))
        return F.when(F.pmod(checksum, F.lit(EDIT_EVERY)) == 0, cut).otherwise(run)

    runs = docs.select("doc_id", F.translate(F.col("text").cast("string"), upper, lower).alias("text"))
    each = exploded(runs.select("doc_id", found.alias("_runs")), "_runs", "_run", "doc_id")
    return (
        each.select(let(F.col("_run"), drawn).alias("word"))
        .where(F.length("word") >= MIN_LETTERS)
        .groupBy("word")
        .agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("n") >= MIN_COUNT)
    )


def windows(shorter: int) -> list[tuple[int, int]]:
    """The places of a word, or of the shorter of two, cut into windows."""
    n = max(2, -(-shorter // WINDOW))
    edges = [shorter * i // n for i in range(n + 1)]
    return list(zip(edges, edges[1:], strict=False))


def filings(word: str) -> Iterator[tuple[bytes, str, int, bool]]:
    """Of each window the hash of what is outside, the letters inside, its places, and whether it is the last one.

    A word is filed as one with as many letters as the shorter of a pair, and as one with a letter more.
    """
    spelt = word.encode("utf-32-le")
    for shorter in (len(word), len(word) - 1):
        more = len(word) - shorter
        cuts = windows(shorter)
        before, befores = xxhash.xxh3_128(str(shorter).encode()), []
        for at, end in cuts:
            befores.append(before.digest())
            before.update(spelt[4 * at : 4 * end])
        after, afters = xxhash.xxh3_128(b"after"), []
        for at, end in reversed(cuts):
            afters.append(after.digest())
            after.update(spelt[4 * (at + more) : 4 * (end + more)])
        for k, (at, end) in enumerate(cuts):
            outside = xxhash.xxh3_128_digest(befores[k] + afters[-1 - k] + k.to_bytes(4, "little"))
            yield outside, word[at : end + more], end - at, end == shorter


def halved(key: bytes, inside: str, size: int, last: bool) -> Iterator[tuple[bytes, str, int, bool]]:
    """The same filing in two windows of half the places; one place stays as it is."""
    if size < 2:
        yield key, inside, size, last
        return
    half, more = size // 2, len(inside) - size
    outside = lambda mark, text: xxhash.xxh3_128_digest(key + mark + text.encode("utf-32-le"))
    yield outside(b"<", inside[half + more :]), inside[: half + more], half, False
    yield outside(b">", inside[:half]), inside[half:], size - half, last


def filed(ranked: DataFrame) -> DataFrame:
    """Every word of ``ranked (rank, word)`` under each of its windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rank, word in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                rows.extend((key, rank, *rest) for key, *rest in filings(word))
                if len(rows) > 50_000:
                    yield _filed(rows)
                    rows.clear()
        if rows:
            yield _filed(rows)
            rows.clear()

    rows: list[tuple] = []
    return ranked.select("rank", "word").mapInArrow(run, FILED)


def _filed(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.binary(), pa.int64(), pa.string(), pa.int32(), pa.bool_())
    names = [field.split()[0] for field in FILED.split(", ")]
    columns = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True)], names=names)


def _cut(hot: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for key, rank, inside, size, last in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                rows.extend((k, rank, *rest) for k, *rest in halved(key, inside, size, last))
            if rows:
                yield _filed(rows)

    return hot.mapInArrow(run, FILED)


def buckets(ranked: DataFrame, *, hot_bucket: int = HOT_BUCKET) -> DataFrame:
    """The filings of all words, no bucket with more than one place a window above ``hot_bucket`` words."""
    todo, done = materialize(filed(ranked), "filed"), None
    while True:
        sizes = todo.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.max("size").alias("places"))
        hot = materialize(sizes.where((F.col("n") > hot_bucket) & (F.col("places") > 1)).select("key"), "hot-keys")
        # At most rows / hot_bucket keys.
        if hot.isEmpty():
            return todo if done is None else done.unionByName(todo)
        plain = todo.join(hot, "key", "left_anti")
        done = plain if done is None else done.unionByName(plain)
        todo = materialize(_cut(todo.join(hot, "key", "left_semi")), "filed")


class PositionIndex:
    """Bit sets of the words of some buckets: which have a letter at a place.

    ``bucket`` numbers the bucket of each word, in order; ``inside`` holds the letters that are compared.
    """

    def __init__(self, bucket: np.ndarray, inside: list[str]):
        self.bucket = bucket
        starts = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
        sizes = np.diff(np.append(starts, len(bucket)))
        self.n_lanes = -(-sizes // 64)
        self.first_lane = np.cumsum(self.n_lanes) - self.n_lanes
        at = np.arange(len(bucket)) - starts[bucket]
        self.starts, self.lane, self.bit = starts, self.first_lane[bucket] + at // 64, np.uint64(1) << (at % 64).astype(np.uint64)
        self.length = np.array([len(x) for x in inside])
        places = int(self.length.max(initial=0)) + 1
        letters = np.frombuffer("".join(inside).encode("utf-32-le"), np.uint32)
        known, codes = np.unique(letters, return_inverse=True)
        # Place of the letter in its word, and the word it belongs to.
        word = np.repeat(np.arange(len(inside)), self.length)
        place = np.arange(len(letters)) - np.repeat(np.cumsum(self.length) - self.length, self.length)
        self.codes = np.full((len(inside), places), len(known))  # one code more, of no letter
        self.codes[word, place] = codes
        total = int(self.n_lanes.sum())
        self.sets = np.zeros((places + 1, len(known) + 1, total), np.uint64)
        np.bitwise_or.at(self.sets, (place, codes, self.lane[word]), self.bit[word])
        self.of_length = np.zeros((places + 2, total), np.uint64)
        np.bitwise_or.at(self.of_length, (self.length, self.lane), self.bit)

    def near(self, query: np.ndarray, lane: np.ndarray) -> np.ndarray:
        """Of each query and lane the words that differ by one edit from the query, as bits."""
        full = ~np.uint64(0)
        equal = np.full(len(query), full)
        replaced, missing, further = (np.zeros(len(query), np.uint64) for _ in range(3))
        length, out = self.length[query], np.zeros(len(query), np.uint64)
        for i in range(int(length.max(initial=0)) + 1):
            ended = length == i
            if ended.any():
                of = self.of_length
                at = lane[ended]
                # A letter may be missing, or further, at the end.
                out[ended] = (
                    (replaced[ended] & of[i, at])
                    | (missing[ended] & (of[i - 1, at] if i else np.uint64(0)))
                    | ((further[ended] | equal[ended]) & of[i + 1, at])
                )
            code = self.codes[query, np.minimum(i, self.codes.shape[1] - 1)]
            here = self.sets[i, code, lane]
            before = self.sets[i - 1, code, lane] if i else np.zeros(len(query), np.uint64)
            behind = self.sets[min(i + 1, len(self.sets) - 1), code, lane]
            missing = (missing & before) | equal
            # The word has one letter more before this one, or had one earlier.
            further = (further | equal) & behind
            replaced = (replaced & here) | (equal & ~here)
            equal = equal & here
        return out

    def found(self, size: np.ndarray, last: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of each word how many near words its bucket holds, and the smallest rank of them (-1 without any)."""
        n, best = np.zeros(len(rank), np.int64), np.full(len(rank), np.iinfo(np.int64).max)
        work = np.cumsum(self.n_lanes[self.bucket])
        edges = np.flatnonzero(np.diff(work // SEARCHED)) + 1
        for at, end in zip([0, *edges], [*edges, len(rank)], strict=True):
            words = np.arange(at, end)
            lanes = self.n_lanes[self.bucket[words]]
            query = np.repeat(words, lanes)
            offset = np.arange(len(query)) - np.repeat(np.cumsum(lanes) - lanes, lanes)
            bits = self.near(query, self.first_lane[self.bucket[query]] + offset)
            hit = np.flatnonzero(bits)
            set_bits = np.unpackbits(bits[hit].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            row, bit = np.nonzero(set_bits)
            query = query[hit[row]]
            other = self.starts[self.bucket[query]] + 64 * offset[hit[row]] + bit
            mine = self._here(query, other, size, last)
            query, other = query[mine], other[mine]
            n += np.bincount(query, minlength=len(rank))
            np.minimum.at(best, query, rank[other])
        return n, np.where(n > 0, best, -1)

    def _here(self, a: np.ndarray, b: np.ndarray, size: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Whether one of two near words is the shorter kind of the bucket, and both first differ here, not behind it."""
        long, short = np.where(self.length[a] > self.length[b], a, b), np.where(self.length[a] > self.length[b], b, a)
        columns = np.arange(self.codes.shape[1])
        inside = columns < self.length[short][:, None]
        begins = ((self.codes[long] == self.codes[short]) | ~inside).all(axis=1)
        own = self.length[short] == size[short]
        return own & (last[a] | (self.length[a] == self.length[b]) | ~begins)


def whole_buckets(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.Table]:
    """Tables of about ``least`` rows that cut no bucket, from batches ordered by ``key``."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(map(len, held)) < least:
            continue
        table = pa.Table.from_batches(held)
        keys = table.column("key").combine_chunks()
        ends = keys.slice(1).to_pylist()
        changed = [i + 1 for i, (x, y) in enumerate(zip(keys.slice(0, len(keys) - 1).to_pylist(), ends, strict=True)) if x != y]
        if changed:
            yield table.slice(0, changed[-1])
            held = table.slice(changed[-1]).to_batches()
    if held:
        yield pa.Table.from_batches(held)


def near_words(ranked: DataFrame, *, hot_bucket: int = HOT_BUCKET) -> DataFrame:
    """``rank, n_near, best``: the number of near words and the smallest rank of them, for words that have any."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_buckets(batches, 64 * LANES):
            if not len(table):
                continue
            bucket = table.column("key").combine_chunks().dictionary_encode().indices.to_numpy()
            rank = table.column("rank").to_numpy()
            # A word alone in its bucket is near to none.
            kept = np.flatnonzero(np.bincount(bucket)[bucket] > 1)
            if not len(kept):
                continue
            table, rank = table.take(kept), rank[kept]
            bucket = np.unique(bucket[kept], return_inverse=True)[1]
            index = PositionIndex(bucket, table.column("inside").to_pylist())
            n, best = index.found(table.column("size").to_numpy(), np.array(table.column("last").to_pylist()), rank)
            some = n > 0
            yield pa.RecordBatch.from_arrays(list(map(pa.array, (rank[some], n[some], best[some]))), names=["rank", "n_near", "best"])

    dealt = buckets(ranked, hot_bucket=hot_bucket).repartition("key").sortWithinPartitions("key")
    found = dealt.mapInArrow(run, FOUND)
    return found.groupBy("rank").agg(F.sum("n_near").alias("n_near"), F.min("best").alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """``rank, root`` from ``rank, form``: the end of each chain of forms.

    Chains are halved in each round. As a form has ``RATIO`` times the occurrences, they are short.
    """
    state = materialize(forms.select("rank", F.col("form").alias("to")), "roots")
    while True:
        onward = state.select(F.col("rank").alias("to"), F.col("to").alias("_next"))
        stepped = state.join(onward, "to", "left")
        if stepped.where("_next IS NOT NULL").isEmpty():
            return state.select("rank", F.col("to").alias("root"))
        state = materialize(stepped.select("rank", F.coalesce("_next", "to").alias("to")), "roots")


def ranked_words(counted: DataFrame) -> DataFrame:
    """``rank, word, n``: words numbered by falling occurrences, then in code-point order; written."""
    parts = int(counted.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [F.desc("n"), F.asc("word")]
    ranged = materialize(
        counted.repartitionByRange(parts, *order)
        .sortWithinPartitions(*order)
        # The lower 33 bits number the rows of a partition, the others the ranges.
        .select(F.monotonically_increasing_id().alias("rank"), "word", "n"),
        "ranked-words",
    )
    return ranged


def group(docs: DataFrame, *, hot_bucket: int = HOT_BUCKET) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` for every word of ``docs (doc_id, text)``."""
    ranked = ranked_words(materialize(words(docs), "words"))
    near = near_words(ranked, hot_bucket=hot_bucket)
    best = ranked.select(F.col("rank").alias("best"), F.col("word").alias("_form"), F.col("n").alias("_n"))
    met = ranked.join(near, "rank", "left").join(best, "best", "left")
    has_form = F.col("_n") >= RATIO * F.col("n")
    formed = materialize(
        met.select(
            "rank",
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
            F.when(has_form, F.col("best")).alias("_best"),
            F.when(has_form, F.col("_form")).alias("form"),
            F.when(has_form, F.col("_n")).alias("form_n"),
        ),
        "forms",
    )
    chains = roots(formed.where("_best IS NOT NULL").select("rank", F.col("_best").alias("form")))
    ends = ranked.select(F.col("rank").alias("root"), F.col("word").alias("_root"))
    return (
        formed.join(chains, "rank", "left")
        .join(ends, "root", "left")
        .select("word", "form", F.coalesce("_root", "word").alias("root"), "n", "n_near", "form_n")
    )
