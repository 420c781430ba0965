"""Line dedup by site-relative frequency.

For every host the pages that hold a line are divided by the host's page total, and lines above a
boilerplate ratio are dropped from the host's pages. Exact copies of a page within its host count
as one page, above and below the fraction, so that the lines of a page that was fetched many times
are not taken for the site's boilerplate.

A line is what stands between line feeds; it is compared by its 64-bit hash. Lines without a word are never
dropped and not counted. Defined cases: a null host is a host of its own; a null text stays null
and holds no line; rows that repeat a ``doc_id`` are rows like any others; a page that loses all
lines has an empty text; an empty table gives an empty result; extra columns are handed on, but for
those named like the two that are added, which are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.lineage import materialize
from newsloom.llm.hosts import host_key
from newsloom.operators.joins import lookup

#: A line on more than this share of the host's pages is boilerplate ...
RATIO = 0.1

#: ... if it is on as many pages at least: two pages may be near copies of one another, which tells nothing of the host.
MIN_PAGES = 3

HAS_WORD = r"[^\x20\x09-\x0D]"

ADDED = ("n_lines", "n_dropped")


def lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def boilerplate(pages: DataFrame, *, ratio: float = RATIO, min_pages: int = MIN_PAGES) -> DataFrame:
    """``host, lines``: hashes of each host's boilerplate lines, for hosts that have any.

    ``pages`` has ``host, text`` without nulls. As a page counts for a line once, a host has at
    most (mean number of lines of a page) / ratio such lines, so its list is short.
    """
    with_word = F.filter(lines(F.col("text")), lambda line: line.rlike(HAS_WORD))
    hashes = F.transform(F.array_distinct(with_word), lambda line: F.xxhash64(line))
    page = F.xxhash64("text").alias("page")
    totals = (
        pages.select("host", page).distinct().groupBy("host").agg(F.count(F.lit(1)).alias("total"))
    )
    held = (
        # The outer form, as the optimizer would compute the array twice for the other.
        pages.select("host", page, F.explode_outer(hashes).alias("line"))
        .where("line IS NOT NULL")
        .distinct()
        .groupBy("host", "line")
        .agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("n") >= min_pages)
    )
    return (
        held.join(totals, "host")
        .where(F.col("n") > F.col("total") * ratio)
        .groupBy("host")
        .agg(F.collect_list("line").alias("lines"))
    )


def drop_boilerplate(
    docs: DataFrame, *, host: str = "source", ratio: float = RATIO, min_pages: int = MIN_PAGES
) -> DataFrame:
    """``docs`` with ``text`` less its host's boilerplate lines, and ``n_lines, n_dropped`` added.

    The hosts' lines are broadcast if they were measured to be small; otherwise texts are joined
    with them by host, and hosts with many pages are cut into parts.
    """
    text, key = F.col("text"), host_key(F.col(f"`{host}`"))
    pages = docs.where(text.isNotNull()).select(key.alias("host"), text)
    found = materialize(
        boilerplate(pages, ratio=ratio, min_pages=min_pages).withColumnRenamed("host", "_host"), "boilerplate"
    )
    # In a struct the input's columns can't clash with those that are needed meanwhile.
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), key.alias("_host"))
    every = lines(F.col("_row.text"))
    is_dropped = lambda line: F.array_contains("lines", F.xxhash64(line)) & line.rlike(HAS_WORD)
    kept = F.when(F.col("lines").isNull(), every).otherwise(F.filter(every, lambda x: ~is_dropped(x)))
    cut = lookup(rows, found, "_host", "left").select(
        "_row",
        kept.alias("_kept"),
        F.when(F.col("_row.text").isNull(), 0).otherwise(F.size(every)).cast("bigint").alias("n_lines"),
    )
    n_kept = F.when(F.col("_kept").isNull(), 0).otherwise(F.size("_kept"))
    columns = [
        F.array_join("_kept", "\n").alias(c) if c == "text" else F.col(f"_row.`{c}`")
        for c in docs.columns
        if c not in ADDED
    ]
    return cut.select(*columns, "n_lines", (F.col("n_lines") - n_kept).cast("bigint").alias("n_dropped"))
