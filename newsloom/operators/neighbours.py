"""The exact nearest vectors of many words at once, with whole groups left out by a bound.

Vectors are normalised once, with float64 components scaled by the largest one first, and filed under
the nearest of some centres; any centres give the same result. A group keeps its radius, the largest
angle between a member and its centre. As angles obey the triangle inequality, no member of a group
is nearer to a word than the angle to the centre less the radius.

Groups are packed into bins of a bounded number of vectors. First every word is compared with its own
bin; the k-th best is a bound that the result can only beat. Then it goes to all other bins with a group
that the bound doesn't leave out, and there it is compared with such groups only. A task holds the words
of one bin and the vectors of another, so its memory is bounded too where the bound leaves out nothing, and
a vector is copied once per bin and not once per group. What leaves a task are the k best per word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from newsloom.lineage import materialize

#: Centres at most, and members of a part of a group at most on average; a bin has twice as many at most.
CENTRES, PART = 1024, 20_000

#: Words compared with a bin at a time, and copies of words sent on at a time.
ASKED, COPIES = 256, 1 << 15

#: What rounding may add to an angle.
SLACK = 1e-6

#: What the order of a sum may change in a cosine.
ROUNDING = 1e-11

FOUND = "asked long, neighbour long, similarity double"


def _matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Lists of numbers as rows."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def normalised(vectors: DataFrame, word: str, vector: str) -> DataFrame:
    """``id, unit``: vectors of length one, zero vectors as they are; null and non-finite ones are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [np.array(x, float) for x in batch.column(1).to_pylist()]
            units = []
            for row in rows:
                largest = np.abs(row).max(initial=0)
                row = row / largest if largest else row
                units.append(row / np.linalg.norm(row) if largest else row)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(units, pa.list_(pa.float64()))], names=["id", "unit"])

    values = F.col(vector).cast("array<double>")
    whole = values.isNotNull() & ~F.exists(values, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    columns = vectors.where(F.col(word).isNotNull() & F.coalesce(whole, F.lit(False)))
    return columns.select(F.col(word).cast("bigint").alias("id"), values.alias("unit")).mapInArrow(
        run, "id bigint, unit array<double>"
    )


def centres_of(units: DataFrame, n: int) -> np.ndarray:
    """Some of the vectors, those with the smallest hashes: a bounded number, and only a matter of speed."""
    rows = units.orderBy(F.xxhash64("id"), "id").limit(n).toArrow().column("unit").to_pylist()
    return np.array(rows, float)


def _angle(cosine: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(cosine, -1, 1))


def filed(units: DataFrame, centres: np.ndarray, part: int) -> DataFrame:
    """``id, unit, grp, part, angle``: each vector under its nearest centre; written."""
    sent = units.sparkSession.sparkContext.broadcast(centres)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = _matrix(batch.column(1))
            cosines = rows @ sent.value.T
            nearest = cosines.argmax(axis=1)
            angles = _angle(cosines[np.arange(len(rows)), nearest])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(nearest, pa.int64()), pa.array(angles)], names=["id", "unit", "grp", "angle"]
            )

    each = units.mapInArrow(run, "id bigint, unit array<double>, grp bigint, angle double")
    each = materialize(each, "grouped-vectors")
    sizes = each.groupBy("grp").agg(F.count(F.lit(1)).alias("_n"))
    # One row per centre.
    parts = F.ceil(F.col("_n") / part)
    return each.join(F.broadcast(sizes), "grp").select(
        "id", "unit", "grp", F.pmod(F.xxhash64("id"), parts).alias("part"), "angle"
    )


def packed(members: DataFrame, centres: np.ndarray, part: int) -> tuple[DataFrame, dict[str, np.ndarray]]:
    """``id, unit, grp, bin``, and of each part of a group: ``grp``, its centre's place, ``bin`` and ``radius``."""
    sizes = members.groupBy("grp", "part").agg(F.count(F.lit(1)).alias("n"), F.max("angle").alias("radius"))
    rows = sizes.orderBy("grp", "part").collect()  # one row per centre and per ``part`` vectors
    grp, number, n, radius = (np.array([r[c] for r in rows]) for c in ("grp", "part", "n", "radius"))
    # Groups that are near one another in one direction at least are next to one another.
    middle = centres - centres.mean(axis=0)
    along = (middle @ np.linalg.svd(middle, full_matrices=False)[2][0])[grp]
    order = np.lexsort((number, grp, along))
    bins = np.empty(len(rows), np.int64)
    bins[order] = (np.cumsum(n[order]) - n[order]) // part
    cells = pa.table({"grp": pa.array(grp, pa.int64()), "part": pa.array(number, pa.int64()), "bin": pa.array(bins)})
    dealt = members.join(F.broadcast(members.sparkSession.createDataFrame(cells)), ["grp", "part"])
    return dealt.select("id", "unit", "grp", "bin"), {"grp": grp, "bin": bins, "radius": radius}


def _near(units: np.ndarray, worst: np.ndarray, cells: dict[str, np.ndarray], centres: np.ndarray) -> np.ndarray:
    """For each word the parts of groups that may hold something as similar as ``worst``; all if that is nan."""
    least = np.where(np.isnan(worst), 4.0, _angle(np.nan_to_num(worst)))
    lowest = np.maximum(_angle(units @ centres[cells["grp"]].T) - cells["radius"], 0)
    return lowest <= least[:, None] + SLACK


def _few_copies(ids: np.ndarray, units: np.ndarray, k: int) -> np.ndarray:
    """The rows without those of which k + 1 equal ones with smaller ids are there: they are nobody's k best."""
    bits = np.ascontiguousarray(units + 0.0).view(np.dtype((np.void, max(units.shape[1], 1) * 8))).ravel()
    which = np.unique(bits, return_inverse=True)[1]
    order = np.lexsort((ids, which))
    new = np.append(True, which[order][1:] != which[order][:-1])
    # Rows of one id count once.
    steps = np.cumsum(np.append(True, new[1:] | (ids[order][1:] != ids[order][:-1])))
    return np.sort(order[steps - np.maximum.accumulate(np.where(new, steps, 0)) <= k])


def _searched(words: DataFrame, members: DataFrame, k: int, cells: object, keys: list[str]) -> DataFrame:
    """``asked, neighbour, similarity``: the k best members of each bin for the words sent there."""

    def run(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        names = ("asked", "neighbour", "similarity")
        found = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
        if len(left) and len(right):
            left = left.sort_by("grp")
            words, asked, worst = left.column("id").to_numpy(), _matrix(left.column("unit")), left.column("worst").to_numpy()
            ids, units, grp = right.column("id").to_numpy(), _matrix(right.column("unit")), right.column("grp").to_numpy()
            kept = _few_copies(ids, units, k)
            kept = kept[np.argsort(grp[kept], kind="stable")]
            ids, units, grp = ids[kept], units[kept], grp[kept]
            parts, centres = cells.value
            for at in range(0, len(words), ASKED):
                some = slice(at, at + ASKED)
                near = np.unique(parts["grp"][_near(asked[some], worst[some], parts, centres).any(axis=0)])
                on = np.flatnonzero(np.isin(grp, near))
                if len(on):
                    held = (ids, units) if len(on) == len(ids) else (ids[on], units[on])
                    found.append(_compared(words[some], asked[some], worst[some], *held, k))
        return pa.table(dict(zip(names, (np.concatenate(c) for c in zip(*found, strict=True)), strict=True)))

    # Columns of their own, as both may come from one table.
    words = words.select(*[F.col(c).alias(c) for c in words.columns])
    return words.groupBy(*keys).cogroup(members.groupBy(*keys)).applyInArrow(run, FOUND)


def _compared(
    words: np.ndarray, asked: np.ndarray, worst: np.ndarray, ids: np.ndarray, units: np.ndarray, k: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The k best members for each word, of equal ones those with the smallest ids; those below ``worst`` may be missing."""
    cosines = asked @ units.T
    by_id = np.argsort(ids, kind="stable")
    first, last = (np.searchsorted(ids[by_id], words, side) for side in ("left", "right"))
    for i in np.flatnonzero(first < last):
        cosines[i, by_id[first[i] : last[i]]] = -np.inf
    low = np.where(np.isnan(worst), -2.0, worst)
    many = np.flatnonzero((cosines >= low[:, None] - ROUNDING).sum(axis=1) > 4 * k)
    if len(many) and len(ids) > k:
        low[many] = np.maximum(low[many], np.partition(cosines[many], len(ids) - k, axis=1)[:, len(ids) - k])
    found = []
    close = cosines >= np.maximum(low[:, None], -2.0) - ROUNDING
    ends = np.cumsum(close.sum(axis=1))
    # Some rows at a time: each has k, or more where many are equal.
    start = 0
    while start < len(words):
        stop = max(int(np.searchsorted(ends, (ends[start - 1] if start else 0) + COPIES, "right")), start + 1)
        row, member = np.nonzero(close[start:stop])
        row += start
        # Summed in one fixed way, so that a pair has the same similarity wherever it is met.
        similarity = (asked[row] * units[member]).sum(axis=1)
        order = np.lexsort((ids[member], -similarity, row))
        row, member, similarity = row[order], member[order], similarity[order]
        begins = np.flatnonzero(np.append(len(row) > 0, row[1:] != row[:-1])) if len(row) else row
        rank = np.arange(len(row)) - np.repeat(begins, np.diff(np.append(begins, len(row))))
        best = rank < k
        found.append((words[row[best]], ids[member[best]], similarity[best]))
        start = stop
    return tuple(np.concatenate(c) for c in zip(*found, strict=True))


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("asked").orderBy(F.desc("similarity"), "neighbour")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def nearest_many(
    vectors: DataFrame,
    asked: DataFrame,
    k: int = 10,
    *,
    word: str = "word",
    vector: str = "vector",
    centres: int = CENTRES,
    part: int = PART,
) -> DataFrame:
    """``word, rank, neighbour, similarity``: the k most similar other words of each asked word, exactly.

    Words are bigints that name one vector each; ``asked`` may hold as many as the table. A word
    without a vector is an error. Vectors are read once.
    """
    units = materialize(normalised(vectors, word, vector), "unit-vectors")
    chosen = centres_of(units, centres)
    wanted = asked.select(F.col(word).cast("bigint").alias("id")).distinct()
    missing = wanted.join(units.select("id"), "id", "left_anti").first()
    if missing:
        raise ValueError(f"{missing['id']} not in vocabulary")
    if not len(chosen):
        return units.select(F.col("id").alias("word"), F.lit(0).alias("rank"), F.col("id").alias("neighbour"), F.lit(0.0).alias("similarity"))
    members, cells = packed(filed(units, chosen, part), chosen, part)
    sent = units.sparkSession.sparkContext.broadcast((cells, chosen))
    words = members.join(wanted, "id", "left_semi")
    unbound = words.withColumn("worst", F.lit(float("nan")))
    close = materialize(_best(_searched(unbound, members, k, sent, ["bin"]), k), "first-neighbours")
    bound = close.groupBy("asked").agg(F.count(F.lit(1)).alias("n"), F.min("similarity").alias("worst"))
    # Without k others there is no bound: everything is compared.
    worst = bound.select(F.col("asked").alias("id"), F.when(F.col("n") >= k, F.col("worst")).alias("worst"))
    bounded = words.join(worst, "id", "left").select(
        "id", "unit", "grp", F.col("bin").alias("home"), F.coalesce("worst", F.lit(float("nan"))).alias("worst")
    )

    def routes(batch: pa.RecordBatch) -> np.ndarray:
        """Which other bins each word is sent to."""
        parts, centres = sent.value
        near = _near(_matrix(batch.column("unit")), batch.column("worst").to_numpy(), parts, centres)
        to = np.zeros((len(batch), int(parts["bin"].max()) + 1), bool)
        for number in np.unique(parts["bin"]):
            to[:, number] = near[:, parts["bin"] == number].any(axis=1)
        to[np.arange(len(batch)), batch.column("home").to_numpy()] = False
        return to

    def met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, number = np.nonzero(routes(batch))
            pairs = np.unique(np.stack([batch.column("home").to_numpy()[row], number]), axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(pairs[0], pa.int64()), pa.array(pairs[1], pa.int64())], names=["home", "bin"])

    def routed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, number = np.nonzero(routes(batch))
            for at in range(0, len(row), COPIES):
                some = slice(at, at + COPIES)
                yield batch.take(pa.array(row[some])).append_column("bin", pa.array(number[some], pa.int64()))

    # No more rows than pairs of bins.
    pairs = materialize(bounded.mapInArrow(met, "home bigint, bin bigint").distinct(), "bin-pairs")
    to = "id bigint, unit array<double>, grp bigint, home bigint, worst double, bin bigint"
    found = _searched(bounded.mapInArrow(routed, to), members.join(pairs, "bin"), k, sent, ["home", "bin"])
    found = _best(close.drop("rank").unionByName(found), k)
    return found.select(F.col("asked").alias("word"), "rank", "neighbour", "similarity")
