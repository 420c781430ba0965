"""SimHash near-duplicates through a hierarchical index in Gray order.

Every text gets a 64-bit fingerprint. Fingerprints that differ in at most ``max_bits`` bits are
linked, and documents are grouped by the connected components of the links.

Finding the links: two fingerprints that differ in at most three bits agree in one of four blocks
of 16 bits. Each distinct fingerprint goes once to the bucket of each of its blocks, with that
block turned to the front. A task takes its buckets in order, about ``INDEXED`` fingerprints at a
time and never a part of a bucket, and builds one index over them: fingerprints sorted by Gray rank, every ``FAN`` neighbours under a node, and so on upwards. A node keeps the bits
on which all below it agree; bits that a node shares with its parent are kept in the parent only, so
a search adds up differences from the top down and leaves a node, with all below it, as soon as
they pass the limit. Where all below a node of one bucket is certainly within the limit, one link
stands for all.
What leaves the task is a link from each fingerprint to the first of its local group, not pairs.

Buckets with over ``HOT_BUCKET`` fingerprints are cut: of the other 48 bits, two linked fingerprints
agree in one of four blocks of 12, so each of those is a bucket of its own. Nothing is left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.lineage import materialize
from newsloom.llm.components import components
from newsloom.operators.joins import lookup

SHINGLE_WORDS = 3
SEED = 42
MAX_BITS = 3

#: Buckets with more distinct fingerprints than this are cut by further bits.
HOT_BUCKET = 100_000

#: Fingerprints of one index, but for the rest of the last bucket.
INDEXED = 1 << 20

#: Children of an index node; most pairs of a query and its bucket's codes searched at a time.
FAN = 8
SEARCHED = 1 << 21

#: Shingles whose bits are counted at a time.
HASH_BLOCK = 1 << 16


def fingerprint(text: str | None) -> int:
    """The 64-bit fingerprint of a text as an unsigned integer; zero without words.

    Words are split at blanks and control white space, ASCII letters in lower case.
    """
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    width = min(SHINGLE_WORDS, len(words))
    starts = np.concatenate(([0], ends[:-1] + 1))[: len(words) - width + 1].tolist()
    digest = xxhash.xxh64_intdigest
    counts = np.zeros(64, np.int64)
    pairs = list(zip(starts, ends[width - 1 :].tolist(), strict=True))
    for at in range(0, len(pairs), HASH_BLOCK):
        hashes = np.array([digest(joined[a:b], SEED) for a, b in pairs[at : at + HASH_BLOCK]], "<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int32)
    return int(np.packbits(2 * counts > len(pairs), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id, fp`` for every row of ``docs``; ``fp`` holds the 64 bits as a signed bigint.

    A null text counts as empty. Other columns are not read.
    """
    schema = "doc_id bigint, fp bigint"
    columns = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(t) for t in batch.column(1).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found.view(np.int64))], names=["doc_id", "fp"]
            )

    return columns.mapInArrow(run, schema)


def gray_rank(codes: np.ndarray) -> np.ndarray:
    """The place of each code in Gray order, where neighbours differ in one bit."""
    rank = codes.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


class GrayIndex:
    """The index of one task: ``codes`` in buckets, each bucket a run of equal leading bits."""

    def __init__(self, bucket: np.ndarray, codes: np.ndarray):
        """``bucket`` numbers the bucket of each of the ``codes``."""
        self.order = np.lexsort((gray_rank(codes), bucket))
        self.codes = codes[self.order]
        of = bucket[self.order]
        self.first = np.searchsorted(of, of, "left")
        self.last = np.searchsorted(of, of, "right") - 1
        every, some = [self.codes], [self.codes]
        while len(every[-1]) > FAN:
            at = np.arange(0, len(every[-1]), FAN)
            every.append(np.bitwise_and.reduceat(every[-1], at))
            some.append(np.bitwise_or.reduceat(some[-1], at))
        masks = [~(a ^ b) for a, b in zip(every, some, strict=True)]
        self.patterns = every
        # Nodes that lie in one bucket.
        self.whole = [
            self.first[np.arange(len(m)) * FAN**k]
            == self.first[np.minimum((np.arange(len(m)) + 1) * FAN**k, len(codes)) - 1]
            for k, m in enumerate(masks)
        ]
        self.free = [np.bitwise_count(~m) for m in masks]
        # Bits that the parent keeps are not kept again.
        self.own = [
            m & ~masks[k + 1][np.arange(len(m)) // FAN] if k + 1 < len(masks) else m
            for k, m in enumerate(masks)
        ]

    def links(self, max_bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs of positions in the sorted codes whose transitive closure is that of all links."""
        n, top = len(self.codes), len(self.own) - 1
        for level in range(1, top + 1):
            # All below such a node is linked with one another: one chain tells it.
            near = np.flatnonzero((self.free[level] <= max_bits) & self.whole[level])
            below = (near[:, None] * FAN**level + np.arange(FAN**level)).ravel()
            head = np.repeat(near * FAN**level, FAN**level)
            yield head[below < n], below[below < n]
        work = np.cumsum(self.last - np.arange(n) + 1) // SEARCHED
        edges = np.concatenate(([0], np.flatnonzero(np.diff(work)) + 1, [n]))
        for at, end in zip(edges[:-1], edges[1:], strict=True):
            query = np.arange(at, end)
            low = self.first[query] // FAN**top
            width = self.last[query] // FAN**top - low + 1
            query, node = np.repeat(query, width), _runs(low, width)
            away = np.zeros(len(query), np.int64)
            for level in range(top, -1, -1):
                span = FAN**level
                # Only the own bucket, and of a pair only the later one.
                here = (node * span <= self.last[query]) & ((node + 1) * span - 1 > query)
                query, node, away = query[here], node[here], away[here]
                unlike = (self.codes[query] ^ self.patterns[level][node]) & self.own[level][node]
                away = away + np.bitwise_count(unlike)
                here = away <= max_bits
                query, node, away = query[here], node[here], away[here]
                if level == 0:
                    yield query, node
                    break
                sure = (away + self.free[level][node] <= max_bits) & self.whole[level][node]
                yield query[sure], node[sure] * span
                query, node, away = query[~sure], node[~sure], away[~sure]
                children = np.minimum(len(self.own[level - 1]) - node * FAN, FAN)
                query, away = np.repeat(query, children), np.repeat(away, children)
                node = _runs(node * FAN, children)


def _runs(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """``start, start + 1, ...`` for each start, ``length`` numbers each, one after another."""
    ends = np.cumsum(length)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(start - ends + length, length)


def merged(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``root`` after joining the groups of each ``a`` and ``b``; roots are the smallest member."""
    while len(a):
        ra, rb = root[a], root[b]
        apart = ra != rb
        a, b, ra, rb = a[apart], b[apart], ra[apart], rb[apart]
        np.minimum.at(root, np.maximum(ra, rb), np.minimum(ra, rb))
        while True:
            jumped = root[root]
            if np.array_equal(jumped, root):
                break
            root = jumped
    return root


def local_links(bucket: np.ndarray, codes: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions of codes and of the first code of their group, for codes that aren't the first."""
    index = GrayIndex(bucket, codes)
    root = np.arange(len(codes))
    for a, b in index.links(max_bits):
        root = merged(root, a, b)
    moved = np.flatnonzero(root != np.arange(len(codes)))
    return index.order[moved], index.order[root[moved]]


def _turned(fp: Column, block: int) -> Column:
    """The bits turned so that the block of 16 stands in front."""
    if block == 0:
        return fp
    return F.shiftleft(fp, 16 * block).bitwiseOR(F.shiftrightunsigned(fp, 64 - 16 * block))


def _buckets(distinct: DataFrame, hot_bucket: int) -> DataFrame:
    """``fp, code, bucket``: the code is the fingerprint with the bucket's bits in front."""
    fp = F.col("fp")
    blocks = distinct.select(
        "fp",
        F.inline(
            F.array(
                *[F.struct(F.lit(b).alias("block"), _turned(fp, b).alias("code")) for b in range(4)]
            )
        ),
    ).withColumn("bucket", F.col("block") * 65536 + F.shiftrightunsigned("code", 48))
    hot = materialize(
        blocks.groupBy("bucket").count().where(F.col("count") > hot_bucket).select("bucket", F.lit(True).alias("hot")),
        "hot-buckets",
    )
    marked = blocks.join(hot, "bucket", "left")
    plain = marked.where("hot IS NULL").select("fp", "code", F.concat_ws(":", "bucket").alias("bucket"))
    low = F.col("code").bitwiseAND((1 << 48) - 1)
    cut = [
        F.struct(
            F.concat_ws(":", "bucket", F.lit(j), F.shiftrightunsigned(low, 36 - 12 * j).bitwiseAND(4095)).alias("bucket")
        )
        for j in range(4)
    ]
    deeper = marked.where("hot").select("fp", "code", F.inline(F.array(*cut)))
    return plain.unionByName(deeper)


def whole_buckets(batches: Iterator[pa.RecordBatch], least: int = INDEXED) -> Iterator[pa.Table]:
    """Tables of about ``least`` rows that cut no bucket, from batches ordered by ``bucket``."""
    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += len(batch)
        if n < least:
            continue
        table = pa.Table.from_batches(held)
        names = table.column("bucket")
        # What stands before the last bucket, which may go on in the next batch.
        done = pc.index(names, names[-1]).as_py()
        if done:
            yield table.slice(0, done)
            held, n = table.slice(done).to_batches(), n - done
    if n:
        yield pa.Table.from_batches(held)


def links(fps: DataFrame, *, max_bits: int = MAX_BITS, hot_bucket: int = HOT_BUCKET) -> DataFrame:
    """``u, v``: pairs of fingerprints whose transitive closure is that of all links.

    ``max_bits`` is at most three, or the blocks would not find all links.
    """
    if not 0 <= max_bits <= MAX_BITS:
        raise ValueError(f"max_bits must be from 0 to {MAX_BITS}")
    buckets = _buckets(fps.select("fp").distinct(), hot_bucket)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_buckets(batches):
            fp = table.column("fp").to_numpy()
            code = table.column("code").to_numpy().view(np.uint64)
            names = table.column("bucket").combine_chunks().dictionary_encode()
            a, b = local_links(names.indices.to_numpy(), code, max_bits)
            yield pa.RecordBatch.from_arrays([pa.array(fp[a]), pa.array(fp[b])], names=["u", "v"])

    spread = buckets.repartition("bucket").sortWithinPartitions("bucket")
    return spread.mapInArrow(run, "u bigint, v bigint").distinct()


def near_duplicates(docs: DataFrame, *, max_bits: int = MAX_BITS, hot_bucket: int = HOT_BUCKET) -> DataFrame:
    """``doc_id, fp, component_id`` for every row of ``docs (doc_id, text)``.

    ``component_id`` is the smallest ``doc_id`` that can be reached over links, the own one
    included. Texts without words have fingerprint zero and are linked like any others. Rows that
    repeat a ``doc_id`` come back as often. A null ``doc_id`` names no group: its component is the
    smallest id of the others, or null. An empty table gives an empty result.
    """
    fps = materialize(fingerprints(docs), "fingerprints")
    distinct = fps.groupBy("fp").agg(F.min("doc_id").alias("first_id"))
    roots = components(links(fps, max_bits=max_bits, hot_bucket=hot_bucket))
    rooted = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn(
        "root", F.coalesce("root", "fp")
    )
    smallest = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = materialize(lookup(rooted, smallest, "root").select("fp", "component_id"), "named")
    # A fingerprint that a third of all rows share is spread over tasks.
    return lookup(fps, named, "fp").select("doc_id", "fp", "component_id")


def one_of_each(docs: DataFrame, **options) -> DataFrame:
    """One row of each near-duplicate group of ``docs``: that of the smallest ``doc_id``.

    Rows are told apart by ids of their own, written once, so rows whose ``doc_id`` is null or
    repeats are judged by their own texts. Of a group a row without ``doc_id`` stays only if no other
    has one. ``options`` are those of :func:`near_duplicates`.
    """
    row, doc_id = F.struct(*[F.col(f"`{c}`") for c in docs.columns]), F.col("_row.doc_id")
    rows = materialize(docs.select(row.alias("_row"), F.monotonically_increasing_id().alias("_id")), "identified")
    found = near_duplicates(rows.select(F.col("_id").alias("doc_id"), F.col("_row.text").alias("text")), **options)
    members = rows.select("_id", doc_id.isNull().alias("_unnamed"), doc_id.alias("_doc")).join(
        found.select(F.col("doc_id").alias("_id"), "component_id"), "_id"
    )
    firsts = members.groupBy("component_id").agg(F.min(F.struct("_unnamed", "_doc", "_id")).alias("_first"))
    kept = firsts.select(F.col("_first._id").alias("_id"))
    return rows.join(kept, "_id", "left_semi").select("_row.*")
