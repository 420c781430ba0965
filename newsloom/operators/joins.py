"""Joining a large table with a table that may or may not be small."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.lineage import materialize
from newsloom.sizes import fits_broadcast

#: A join key with more rows than this is spread over several tasks.
HOT_ROWS = 2_000_000


def lookup(
    big: DataFrame,
    side: DataFrame,
    on: str,
    how: str = "inner",
    *,
    small: bool | None = None,
    hot_rows: int | None = None,
    costly: bool = False,
) -> DataFrame:
    """Join ``big`` with ``side`` (inner or left): broadcast if measured small, else spread.

    ``small`` passes on a bound the caller has already proven, so that ``side`` is not computed
    a second time just to be measured. ``costly`` is for :func:`spread_join`.
    """
    if fits_broadcast(side) if small is None else small:
        return big.join(F.broadcast(side), on, how)
    return spread_join(big, side, on, how, hot_rows=hot_rows, costly=costly)


def spread_join(
    big: DataFrame,
    side: DataFrame,
    on: str,
    how: str = "inner",
    *,
    hot_rows: int | None = None,
    costly: bool = False,
) -> DataFrame:
    """A shuffled equi-join in which no key of ``big`` lands in one task whole.

    Keys are counted first. A key with n rows is cut into ``ceil(n / hot_rows)`` parts and its
    rows in ``side`` are repeated for each part; all other keys are joined as they are. As ``big`` is
    read twice, a ``costly`` one is written first.
    """
    hot_rows = HOT_ROWS if hot_rows is None else hot_rows
    big = materialize(big, "joined") if costly else big
    hot = materialize(
        big.where(F.col(on).isNotNull())
        .groupBy(on)
        .agg(F.count(F.lit(1)).alias("_n"))
        .where(F.col("_n") > hot_rows)
        .select(on, F.ceil(F.col("_n") / hot_rows).cast("int").alias("_parts")),
        "hot-keys",
    )
    # At most total rows / hot_rows keys; Catalyst sees the real size of the written table.
    parts = F.coalesce(F.col("_parts"), F.lit(1))
    # Stable if a task is run again, and different for equal rows of different tasks.
    row_hash = F.xxhash64(F.spark_partition_id(), *[F.col(f"`{c}`") for c in big.columns])
    left = big.join(hot, on, "left").select(
        *big.columns, F.pmod(row_hash, parts).cast("int").alias("_part")
    )
    right = side.join(hot, on, "left").select(
        *side.columns, F.explode(F.sequence(F.lit(0), parts - 1)).alias("_part")
    )
    return left.join(right, [on, "_part"], how).drop("_part")
