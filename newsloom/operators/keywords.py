"""Keyword statistics over documents."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.functions import text as T
from newsloom.operators import spotting
from newsloom.operators.lexicon import Lexicon
from newsloom.operators.matching import (
    ROW,
    Key,
    exploded,
    identified,
    keyword_positions,
    matcher_of,
    with_keywords,
    without_overlaps,
)


def document_frequency(
    docs: DataFrame, lexicon: Lexicon, *, text: str = "text", key: Key = ("doc_id",)
) -> DataFrame:
    """``n, kw``: in how many documents each keyword occurs, rarest first, never zero."""
    if lexicon.has_few:
        hits = exploded(with_keywords(docs, lexicon, text=text, key=key), "keywords", "kw")
    else:
        dictionary, matcher = matcher_of(docs, lexicon, text=text)
        if matcher:
            counts = spotting.document_counts(docs, matcher, text=text)
            return counts.groupBy("kw").agg(F.sum("n").alias("n")).select("n", "kw").orderBy("n", "kw")
        rows = identified(docs.select(text))
        found = keyword_positions(rows, dictionary, text=text, key=(ROW,), once=True)
        hits = found.select(ROW, "kw").distinct()
    return hits.groupBy("kw").agg(F.count(F.lit(1)).alias("n")).select("n", "kw").orderBy("n", "kw")


def keyword_occurrences(
    docs: DataFrame, lexicon: Lexicon, *, text: str = "text", key: Key = ("doc_id",)
) -> DataFrame:
    """``key, kw, n``: how often each contained keyword occurs in a text, without overlap."""
    if lexicon.has_few:
        counts = T.keyword_counts(F.col(text), lexicon.words)
        return docs.where(F.col(text).isNotNull()).select(*key, F.inline(counts))
    dictionary, matcher = matcher_of(docs, lexicon, text=text)
    if matcher:
        return spotting.keyword_rows(docs, matcher, text=text, key=key)
    rows = identified(docs.select(*key, text))
    found = keyword_positions(rows, dictionary, text=text, key=(ROW,))
    apart = without_overlaps(found.select(ROW, "pos", "kw"), [ROW, "kw"])
    counts = apart.groupBy(ROW, "kw").agg(F.count(F.lit(1)).alias("n"))
    return rows.select(ROW, *key).join(counts, ROW).select(*key, "kw", "n")


def pair_count(
    docs: DataFrame, pairs: Sequence[tuple[str, str]], *, text: str = "text"
) -> DataFrame:
    """``kw, other_kw, n``: documents that contain both keywords, for the pairs asked for.

    One scan and one row per task, without the table of all pairs.
    """
    both = [F.count_if(T.contains_both(F.col(text), a, b)).alias(f"n{i}")
            for i, (a, b) in enumerate(pairs)]
    rows = [F.struct(F.lit(a).alias("kw"), F.lit(b).alias("other_kw"), F.col(f"n{i}").alias("n"))
            for i, (a, b) in enumerate(pairs)]
    return docs.agg(*both).select(F.inline(F.array(*rows)))
