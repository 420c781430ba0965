"""Nearest neighbours by randomly rotated one-bit codes.

Every vector is normalised and turned by one random rotation; of each turned coordinate only the
sign is packed into the code, with one number that corrects the estimate: the inner product of the
vector and its code. A query's turned coordinates are rounded to four bits and packed by bit planes,
so the inner product of query and code is a few ANDs and bit counts, and divided by the correction
it estimates the cosine. An error bound from the correction (and the known rounding error) says how
far the truth can be off; vectors whose upper bound reaches the k-th best lower bound are reranked
with the exact cosine of the original vectors.

Queries and vectors meet in blocks of bounded size, dealt to tasks by the pair of block numbers;
each task hands on its k best per query. Work grows with queries times vectors, as the search asks,
but at one bit per coordinate.

Defined cases: vectors that are null, empty, zero, or hold null or non-finite components take no
part, as query or candidate; a query is compared with vectors of its own length only; of rows that
repeat a ``vec_id`` the smallest vector counts; ties go to the smaller ``vec_id``; extra columns are
not read; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from newsloom.lineage import materialize

SEED = 20_240_117

#: Standard deviations of the estimate that the bound allows for; larger means fewer misses.
BOUND = 4.0

#: Vectors and queries of a block.
VECTORS, QUERIES = 8192, 2048

PLANES = 4


def rotation(size: int) -> np.ndarray:
    """The random rotation for vectors of this length, the same everywhere."""
    q, r = np.linalg.qr(np.random.default_rng(SEED + size).standard_normal((size, size)))
    return q * np.sign(np.diag(r))


def packed(bits: np.ndarray) -> np.ndarray:
    """Rows of bits as rows of 64-bit words."""
    padded = np.zeros((len(bits), -(-bits.shape[1] // 64) * 64), np.uint8)
    padded[:, : bits.shape[1]] = bits
    return np.packbits(padded, axis=1).view(np.uint64)


class Codes:
    """Codes and corrections of unit vectors, one a row."""

    def __init__(self, unit: np.ndarray):
        size = unit.shape[1]
        turned = unit @ rotation(size).T
        self.bits = packed(turned > 0)
        self.ones = np.bitwise_count(self.bits).sum(axis=1, dtype=np.int64)
        #: Inner product of the vector and its code, whose coordinates are +-1/sqrt(size).
        self.correction = np.abs(turned).sum(axis=1) / np.sqrt(size)
        spread = np.sqrt(np.maximum(0.0, 1 - self.correction**2)) / self.correction
        self.error = BOUND * spread / np.sqrt(max(1, size - 1))

    def estimate(self, turned: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Estimated cosines of a turned unit query with all vectors, and how far they may be off."""
        size, steps = len(turned), (1 << PLANES) - 1
        low, step = turned.min(), np.ptp(turned) / steps or 1.0
        level = np.rint((turned - low) / step).astype(np.uint8)
        dot = np.zeros(len(self.bits), np.int64)
        for plane in range(PLANES):
            words = packed(((level >> plane) & 1)[None, :])
            dot += np.bitwise_count(self.bits & words).sum(axis=1, dtype=np.int64) << plane
        # The rounded query times signs: twice what falls on ones, less the whole.
        signed = 2 * (low * self.ones + step * dot) - (low * size + step * level.sum(dtype=np.int64))
        lost = np.abs(turned - (low + step * level)).sum() / np.sqrt(size)
        return signed / np.sqrt(size) / self.correction, self.error + lost / self.correction


def search(
    query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, vectors: np.ndarray, k: int
) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each query its id and the ids and cosines of its ``k`` best vectors, the own id left out."""
    norms = np.sqrt((vectors * vectors).sum(axis=1))
    codes = Codes(vectors / norms[:, None])
    query_norms = np.sqrt((queries * queries).sum(axis=1))
    turned = (queries / query_norms[:, None]) @ rotation(queries.shape[1]).T
    for i, query_id in enumerate(query_ids):
        guess, error = codes.estimate(turned[i])
        other = ids != query_id
        lower = np.where(other, guess - error, -np.inf)
        wanted = other
        if len(ids) > k:
            wanted = other & (guess + error >= np.partition(lower, -k)[-k])
        at = np.flatnonzero(wanted)
        cosine = (vectors[at] * queries[i]).sum(axis=1) / (norms[at] * query_norms[i])
        best = np.lexsort((ids[at], -cosine))[:k]
        yield int(query_id), ids[at][best], cosine[best]


def usable(vectors: DataFrame, id_column: str, column: str) -> DataFrame:
    """``vec_id, vec`` as doubles, for vectors that take part."""
    doubles = F.col(column).cast("array<double>")
    finite = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return (
        vectors.select(F.col(id_column).cast("bigint").alias("vec_id"), doubles.alias("vec"))
        .where(F.col("vec_id").isNotNull() & F.col("vec").isNotNull())
        .where(finite & F.exists("vec", lambda x: x != 0))
        .groupBy("vec_id")
        .agg(F.min("vec").alias("vec"))
    )


def nearest(
    vectors: DataFrame,
    *,
    every: int,
    k: int,
    id_column: str = "vec_id",
    column: str = "embedding",
    block: tuple[int, int] = (VECTORS, QUERIES),
) -> DataFrame:
    """``query_id, rank, vec_id, score`` of the ``k`` nearest vectors of every query.

    Queries are the rows whose id is divisible by ``every``; candidates are all other rows.
    """
    rows = materialize(usable(vectors, id_column, column), "vectors").withColumn("size", F.size("vec"))
    is_query = F.col("vec_id") % every == 0
    counts = rows.agg(F.count(F.lit(1)).alias("n"), F.count_if(is_query).alias("queries")).first()
    n_blocks = -(-counts["n"] // block[0]) or 1
    n_query_blocks = -(-counts["queries"] // block[1]) or 1

    def dealt(df: DataFrame, own: str, n_own: int, other: str, n_other: int) -> DataFrame:
        """Each row in its own block, once for every block of the other side."""
        number = F.pmod(F.xxhash64("vec_id"), F.lit(n_own)).cast("int").alias(own)
        return df.select("*", number, F.explode(F.sequence(F.lit(0), F.lit(n_other - 1))).alias(other))

    key = ("size", "block", "query_block")
    left = dealt(rows.where(is_query), "query_block", n_query_blocks, "block", n_blocks)
    right = dealt(rows, "block", n_blocks, "query_block", n_query_blocks)

    def matrix(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        vec = table.column("vec").combine_chunks()
        rows = vec.flatten().to_numpy(zero_copy_only=False).reshape(len(vec), -1)
        # Scaled by a power of two, which changes no cosine, so that no square overflows.
        _, exponent = np.frexp(np.abs(rows).max(axis=1, initial=0))
        return table.column("vec_id").to_numpy(), np.ldexp(rows, -exponent[:, None])

    def best(queries: pa.Table, candidates: pa.Table) -> pa.Table:
        columns: list[list] = [[], [], []]
        if len(queries) and len(candidates):
            for query_id, ids, scores in search(*matrix(queries), *matrix(candidates), k):
                columns[0].append(np.full(len(ids), query_id, np.int64))
                columns[1].append(ids)
                columns[2].append(scores)
        joined = [np.concatenate(c) if c else np.zeros(0) for c in columns]
        return pa.table(
            {
                "query_id": pa.array(joined[0], pa.int64()),
                "vec_id": pa.array(joined[1], pa.int64()),
                "score": pa.array(joined[2], pa.float64()),
            }
        )

    found = (
        left.groupBy(*key)
        .cogroup(right.groupBy(*key))
        .applyInArrow(best, "query_id bigint, vec_id bigint, score double")
    )
    order = W.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
