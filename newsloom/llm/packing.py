"""Packing token sequences: shortest-pack-first over the length histogram.

Every text is encoded and closed with id 0. Its tokens are cut into blocks of a full sequence, each
a sequence of its own, and a rest. The rests are counted by length, and the histogram, at most
``SIZE - 1`` numbers, is all that is packed: lengths are placed longest first, each into the open
pack with the fewest tokens if it fits there, else into a new one; packs of one composition are one
pattern with a count. Then patterns are joined back to documents by rank: the r-th rest of a length
takes the r-th place that the patterns have for that length.

Ranks need no sort: each task numbers its own rests by length while it encodes, the counts of all
tasks are summed up by length, and a rest's rank is its number plus the counts of earlier tasks.

Defined cases: a null text is empty and an empty text is the closing id alone; rows that repeat a
``doc_id`` are packed each on its own; equal lengths are ranked by task, then by place in the input;
an empty table gives an empty result; extra columns are not read.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from newsloom.lineage import materialize
from newsloom.llm.tree_bpe import encoder

#: Tokens of a sequence, and the id that closes a document.
SIZE = 1024
CLOSING = 0

PIECES = (
    "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
    "sequence_id bigint, offset bigint"
)


def pack(histogram: dict[int, int], size: int = SIZE) -> list[tuple[int, tuple[int, ...]]]:
    """Patterns ``(count, lengths)`` that hold ``histogram[length]`` pieces of each length."""
    open_packs: dict[int, list[tuple[int, tuple[int, ...]]]] = defaultdict(list)
    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left:
            held = min((f for f, packs in open_packs.items() if packs), default=size)
            if held + length > size:
                # None has room, so new packs take as many of this length as they hold.
                per_pack = size // length
                full, odd = divmod(left, per_pack)
                if full:
                    open_packs[per_pack * length].append((full, (length,) * per_pack))
                if odd:
                    open_packs[odd * length].append((1, (length,) * odd))
                break
            count, lengths = open_packs[held].pop()
            taken = min(count, left)
            left -= taken
            open_packs[held + length].append((taken, (*lengths, length)))
            if count > taken:
                open_packs[held].append((count - taken, lengths))
    return [p for f in sorted(open_packs) for p in open_packs[f]]


def places(patterns: list[tuple[int, tuple[int, ...]]]) -> tuple[dict[int, np.ndarray], int]:
    """For each length the places that patterns have for it, and the number of sequences.

    A place is a row ``first rank, first sequence, offset``: piece ``first rank + i`` of this length
    goes to sequence ``first sequence + i`` at this offset, up to the next row's first rank.
    """
    rows, ranks, sequence = defaultdict(list), defaultdict(int), 0
    for count, lengths in patterns:
        offset = 0
        for length in lengths:
            rows[length].append((ranks[length], sequence, offset))
            ranks[length] += count
            offset += length
        sequence += count
    return {length: np.array(r, np.int64) for length, r in rows.items()}, sequence


CUT = (
    "doc_id bigint, doc_tokens bigint, crcs array<bigint>, part int, "
    "blocks_before bigint, rest int, rest_number bigint, ids binary"
)


def encoded(docs: DataFrame, path: str, *, size: int = SIZE, keep_ids: bool = False) -> DataFrame:
    """Every text's tokens, cut: checksums of its blocks and rest, and its numbers within the task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, part = encoder(path), TaskContext.get().partitionId()
        blocks, numbers = 0, [0] * size
        closing = CLOSING.to_bytes(4, "little")
        for batch in batches:
            columns: list[list] = [[] for _ in range(8)]
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids = own.encoded(text)[0] + closing
                full, rest = divmod(len(ids) // 4, size)
                crcs = [zlib.crc32(ids[at : at + 4 * size]) for at in range(0, len(ids), 4 * size)]
                row = (doc_id, len(ids) // 4, crcs, part, blocks, rest, numbers[rest], ids if keep_ids else None)
                for column, value in zip(columns, row, strict=True):
                    column.append(value)
                blocks += full
                numbers[rest] += 1
            kinds = (pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.binary())
            names = [c.split()[0] for c in CUT.split(", ")]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names
            )

    columns = docs.select(F.col("doc_id").cast("bigint"), F.coalesce("text", F.lit("")).alias("text"))
    return columns.mapInArrow(run, CUT)


def packed(docs: DataFrame, path: str, *, size: int = SIZE, keep_ids: bool = False) -> DataFrame:
    """A row for every piece of every document: where it is cut from, and its place in a sequence.

    With ``keep_ids`` the column ``ids`` holds the piece's ids as little-endian 32-bit integers.
    Texts are encoded once; what is counted and joined afterwards is a few numbers a document. The
    driver sees the histogram and the patterns, whose size depends on ``size`` only.
    """
    cut = materialize(encoded(docs, path, size=size, keep_ids=keep_ids), "encoded")
    by_part = materialize(
        cut.groupBy("part", "rest").agg(
            F.count(F.lit(1)).alias("n"),
            F.sum(F.floor(F.col("doc_tokens") / size)).cast("bigint").alias("blocks"),
        ),
        "rests",
    )
    histogram = {
        r["rest"]: r["n"]
        for r in by_part.where("rest > 0").groupBy("rest").agg(F.sum("n").alias("n")).collect()  # < size rows
    }
    slots, n_packed = places(pack(histogram, size))

    earlier = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    per_part = by_part.groupBy("part").agg(F.sum("blocks").alias("blocks"))
    first_block = F.coalesce(F.sum("blocks").over(earlier), F.lit(0))  # one row per task of the encoding
    first_rank = F.coalesce(F.sum("n").over(earlier.partitionBy("rest")), F.lit(0))
    starts = by_part.select("part", "rest", first_rank.alias("first_rank"))
    block_starts = per_part.select("part", first_block.alias("first_block"))
    numbered = cut.join(starts.join(block_starts, "part"), ["part", "rest"]).select(
        "doc_id",
        "doc_tokens",
        "crcs",
        "rest",
        (F.col("first_rank") + F.col("rest_number")).alias("rank"),
        (F.col("first_block") + F.col("blocks_before") + n_packed).alias("block"),
        "ids",
    )
    names = [c.split()[0] for c in PIECES.split(", ")] + ["ids"] * keep_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            for doc_id, tokens, crcs, rest, rank, block, ids in zip(
                *[batch.column(i).to_pylist() for i in range(7)], strict=True
            ):
                for i, crc in enumerate(crcs):
                    start, length = i * size, min(size, tokens - i * size)
                    sequence, offset = block + i, 0
                    if length < size:
                        own = slots[rest]
                        first, sequence, offset = own[np.searchsorted(own[:, 0], rank, "right") - 1].tolist()
                        sequence += rank - first
                    piece = (ids[4 * start : 4 * (start + length)],) if keep_ids else ()
                    rows.append((doc_id, start, length, crc, tokens, sequence, offset, *piece))
            columns = list(zip(*rows, strict=True)) or [[] for _ in names]
            kinds = [pa.int64()] * 7 + [pa.binary()] * keep_ids
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    return numbered.mapInArrow(run, PIECES + ", ids binary" * keep_ids)
