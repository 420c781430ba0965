"""Connected components of a graph whose links are a table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.lineage import materialize


def components(links: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``links (u, v)``; the root is the component's smallest node.

    Large-star and small-star steps in turn: each node hands its larger neighbours, then its smaller
    ones, to the smallest it knows. Paths shrink by about half in each round, and a round is only
    joins and minima over the links. Each round is written to the shared folder, so a lost executor
    repeats no earlier round. Links that repeat or lead to themselves do no harm; null ends are left
    out; without links the result is empty.
    """
    links = links.where("u IS NOT NULL AND v IS NOT NULL")
    links = materialize(
        links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct(),
        "links",
    )
    state = _state(links)
    while state[0]:
        links = materialize(_small_star(_large_star(links)), "links")
        before, state = state, _state(links)
        if state == before:
            break
    roots = links.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return links.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)


def _state(links: DataFrame) -> tuple:
    row = links.agg(F.count(F.lit(1)), F.expr("sum(cast(xxhash64(u, v) AS decimal(20, 0)))")).first()
    return tuple(row)


def _large_star(links: DataFrame) -> DataFrame:
    both = links.select("u", "v").union(links.select("v", "u"))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    moved = both.where("v > u").join(least, "u")
    return moved.select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    least = links.groupBy("u").agg(F.min("v").alias("m"))
    moved = links.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", "m")).distinct()
