"""Term dictionary, inverse frequency and term weights.

All operators take the output of :func:`newsloom.operators.matching.with_terms`: one row per
document with its ``terms``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newsloom.functions import text as T
from newsloom.lineage import materialize
from newsloom.operators.joins import lookup
from newsloom.operators.lexicon import Lexicon
from newsloom.operators.matching import Key, exploded

#: Vocabularies up to this size are tested for inside a row.
MAX_VOCABULARY = 20_000


def numbered(df: DataFrame, group: Column, order: list[str], name: str) -> DataFrame:
    """Number rows from 0 by ``group`` and then ``order``.

    Rows are ranked within their group; only one row per group, its size, is summed up in one
    place. ``group`` must be a coarser form of the same order.
    """
    grouped = df.withColumn("_group", group)
    before = Window.orderBy("_group").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        grouped.groupBy("_group")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select("_group", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    )
    within = F.row_number().over(Window.partitionBy("_group").orderBy(*order))
    return (
        grouped.withColumn("_rank", within)
        .join(offsets, "_group")
        .select(*df.columns, (F.col("_offset") + F.col("_rank") - 1).cast("int").alias(name))
    )


def numbered_by_range(df: DataFrame, order: list[str], name: str) -> DataFrame:
    """Number rows from 0 by ``order``, whatever the values look like.

    Rows are cut into ranges of about equal size, so no task gets more than its share; only one
    number per range is summed up in one place. Rows are written once with their ranks, so that
    all parts of the plan see the same ranges.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranked = materialize(
        df.repartitionByRange(parts, *order)
        .sortWithinPartitions(*order)
        # The lower 33 bits number the rows of a partition.
        .select(
            *df.columns,
            F.spark_partition_id().alias("_range"),
            F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1).alias("_rank"),
        ),
        "ranked",
    )
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        ranked.groupBy("_range")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    )
    # One row per range: as many as shuffle partitions, whatever the input.
    return ranked.join(F.broadcast(offsets), "_range").select(
        *df.columns, (F.col("_offset") + F.col("_rank")).cast("int").alias(name)
    )


def term_dictionary(tokenized: DataFrame) -> DataFrame:
    """``term_id, term``: the distinct terms, numbered from 0 in ascending order."""
    terms = materialize(exploded(tokenized, "terms", "term").distinct(), "terms")
    return numbered_by_range(terms, ["term"], "term_id").select("term_id", "term")


def label_dictionary(docs: DataFrame, *, label: str = "label", key: str = "doc_id") -> DataFrame:
    """``label_id, label``: the distinct labels, numbered from 0 by first appearance."""
    first = docs.groupBy(F.col(label).alias("label")).agg(F.min(key).alias("_first"))
    order = Window.orderBy("_first", "label")  # one row per label
    return first.select(
        (F.row_number().over(order) - 1).cast("int").alias("label_id"), "label"
    )


def count_rows(df: DataFrame) -> Column:
    """The number of rows, as a scalar subquery."""
    return df.agg(F.count(F.lit(1))).scalar()


def custom_idf(tokenized: DataFrame) -> DataFrame:
    """``term, occurrences, idf``: documents divided by all occurrences of the term, no log."""
    counts = (
        exploded(tokenized, "terms", "term")
        .groupBy("term")
        .agg(F.count(F.lit(1)).alias("occurrences"))
    )
    return counts.withColumn("idf", count_rows(tokenized) / F.col("occurrences"))


def document_ratio(tokenized: DataFrame) -> DataFrame:
    """``term, n_docs, ratio``: the share of documents whose terms include the term."""
    counts = (
        exploded(tokenized.select(F.array_distinct("terms").alias("_once")), "_once", "term")
        .groupBy("term")
        .agg(F.count(F.lit(1)).alias("n_docs"))
    )
    return counts.withColumn("ratio", F.col("n_docs") / count_rows(tokenized))


def small_vocabulary(idf: DataFrame, lexicon: Lexicon) -> list[str] | None:
    """The terms of a written idf table, if the dictionary bounds them; else None."""
    if lexicon.words is None or len(lexicon.words) > MAX_VOCABULARY:
        return None
    return [row["term"] for row in idf.select("term").collect()]


def tfidf(
    tokenized: DataFrame,
    idf: DataFrame,
    *,
    key: Key = ("doc_id",),
    small: bool | None = None,
    vocabulary: list[str] | None = None,
) -> DataFrame:
    """``key, term, weight``: share of the term among the known terms of the text, times idf.

    Terms without an idf are dropped before the share is taken: in the row if the terms of
    ``idf`` are given as a short ``vocabulary``, else by a join and a sum per key. ``small``
    says that ``idf`` is bounded by a dictionary measured to be small.
    """
    if vocabulary is not None:
        known = F.filter("terms", lambda term: term.isin(vocabulary))
        return tfidf_in_corpus(tokenized.withColumn("terms", known), idf, key=key, small=small)
    counts = tokenized.select(*key, F.inline(T.term_counts(F.col("terms"))))
    known = lookup(counts, idf.select("term", "idf"), "term", small=small)
    total = F.sum("n").over(Window.partitionBy(*key))
    return known.select(*key, "term", (F.col("n") / total * F.col("idf")).alias("weight"))


def tfidf_in_corpus(
    tokenized: DataFrame, idf: DataFrame, *, key: Key = ("doc_id",), small: bool | None = None
) -> DataFrame:
    """:func:`tfidf` for the documents ``idf`` was taken from: all terms are known.

    The total is then the length of the term list, and nothing is shuffled.
    """
    counts = tokenized.select(
        *key, F.size("terms").alias("_total"), F.inline(T.term_counts(F.col("terms")))
    )
    known = lookup(counts, idf.select("term", "idf"), "term", small=small)
    return known.select(
        *key, "term", (F.col("n") / F.col("_total") * F.col("idf")).alias("weight")
    )
