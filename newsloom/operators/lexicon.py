"""The keyword dictionary."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import cached_property

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.functions import patterns
from newsloom.functions import text as T
from newsloom.operators.joins import lookup

#: Dictionaries up to these sizes are compiled into one pattern; larger ones are joined.
MAX_WORDS = 200_000
MAX_BYTES = 2 * 1024 * 1024
MAX_NESTING = 150

#: What a lookup gives for an unknown keyword and for an unknown index (fixed values).
UNKNOWN_INDEX = -1
UNKNOWN_KEYWORD = "oops"


@dataclass(frozen=True)
class Lexicon:
    """Keywords with their positions: ``table`` has ``kw_id int, kw string``, unique both ways.

    ``words`` holds the same keywords in order if the dictionary was measured to be small
    enough for a pattern, and is None otherwise.
    """

    table: DataFrame
    words: tuple[str, ...] | None = field(default=None, repr=False)

    @classmethod
    def from_words(cls, spark: SparkSession, words: Sequence[str]) -> Lexicon:
        """From a list: empty entries are dropped, of a repeated one the last position counts."""
        last = {kw: i for i, kw in enumerate(words) if kw}
        return cls._from_rows(spark, sorted((i, kw) for kw, i in last.items()))

    @classmethod
    def _from_rows(cls, spark: SparkSession, rows: list[tuple[int, str]]) -> Lexicon:
        ids, words = zip(*rows, strict=True) if rows else ((), ())
        local = pa.table({"kw_id": pa.array(ids, pa.int32()), "kw": pa.array(words, pa.string())})
        return cls(spark.createDataFrame(local), _if_compilable(words))

    @classmethod
    def from_table(cls, table: DataFrame) -> Lexicon:
        """From ``(kw_id, kw)`` rows of any number; collected only if measured to be small."""
        kept = (
            table.where(F.col("kw") != "")
            .groupBy("kw")
            .agg(F.max("kw_id").cast("int").alias("kw_id"))
            .select("kw_id", "kw")
        )
        size = kept.agg(
            F.count(F.lit(1)).alias("n"),
            F.coalesce(F.sum(F.octet_length("kw")), F.lit(0)).alias("bytes"),
        ).first()
        if size["n"] > MAX_WORDS or size["bytes"] > MAX_BYTES:
            return cls(kept)
        rows = kept.collect()  # bounded by the check above
        return cls._from_rows(table.sparkSession, sorted(map(tuple, rows)))

    @cached_property
    def is_small(self) -> bool:
        """Whether tables with at most one row per keyword may be broadcast."""
        return self.words is not None

    @property
    def has_few(self) -> bool:
        """Whether column expressions find the keywords; more are found by tasks that hold them."""
        return self.words is not None and len(self.words) <= T.FEW_KEYWORDS

    def index_of(self, keywords: DataFrame, kw: str = "kw") -> DataFrame:
        """Add ``kw_id``, -1 for keywords that are not in the dictionary."""
        named = self.table.select(F.col("kw").alias(kw), "kw_id")
        joined = lookup(keywords, named, kw, "left", small=self.is_small)
        return joined.withColumn("kw_id", F.coalesce("kw_id", F.lit(UNKNOWN_INDEX)))

    def keyword_at(self, positions: DataFrame, kw_id: str = "kw_id") -> DataFrame:
        """Add ``kw``, "oops" for positions that are not in the dictionary."""
        named = self.table.select(F.col("kw_id").alias(kw_id), "kw")
        joined = lookup(positions, named, kw_id, "left", small=self.is_small)
        return joined.withColumn("kw", F.coalesce("kw", F.lit(UNKNOWN_KEYWORD)))

    def size(self) -> DataFrame:
        """The number of distinct keywords, as ``n``."""
        return self.table.agg(F.count_distinct("kw").alias("n"))


def _if_compilable(words: Sequence[str]) -> tuple[str, ...] | None:
    if len(words) > MAX_WORDS or sum(len(w.encode()) for w in words) > MAX_BYTES:
        return None
    try:
        if patterns.nesting(patterns.longest_first(words)) > MAX_NESTING:
            return None
    except RecursionError:
        return None
    return tuple(words)
