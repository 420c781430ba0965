"""The corpus pipeline: from raw documents to packed training sequences.

Every stage takes what the one before it kept; all but the last return the columns of documents,
whose ``n_chars`` is the length of the text as it then is.

Defined cases: null and empty texts fail the quality rules and go there; of rows that repeat a
``doc_id`` each is judged by its own text, and those that stay are documents of their own up to
packing, which names pieces by ``doc_id``; rows without a ``doc_id`` are rows like any others; a text
is read whole, however long; an empty table gives an empty result; columns beside those of documents
are handed on up to packing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.lineage import materialize
from newsloom.llm import host_rules, packing, pii, simhash, site_lines
from newsloom.llm.queries import tokenizer_path


def _recounted(docs: DataFrame, columns: list[str]) -> DataFrame:
    """``docs`` with these columns, ``n_chars`` counted anew."""
    counted = docs.withColumn("n_chars", F.length("text").cast("bigint"))
    return counted.select(*columns)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules."""
    return host_rules.keep_good(docs)


def boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents less the lines that are boilerplate of their host."""
    return _recounted(site_lines.drop_boilerplate(docs), docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose fingerprints of three-word shingles link at three bits."""
    return simhash.one_of_each(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data masked."""
    return _recounted(pii.mask(docs), docs.columns)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' pieces in training sequences."""
    return packing.packed(docs, tokenizer_path("byte_bpe_50k.json"))


STAGES = [
    ("quality rules", quality),
    ("line dedup", boilerplate),
    ("SimHash near-dedup", near_duplicates),
    ("PII", personal_data),
    ("packing", sequences),
]

#: Tokenizing, XXH64 and the connected components have no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; what each returns is written and read back for the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
