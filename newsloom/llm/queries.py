"""The operators as queries over the given tables, with production parameters, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.llm import (
    alignment,
    host_rules,
    licenses,
    packing,
    passages,
    pii,
    rotated_codes,
    simhash,
    site_lines,
    tree_bpe,
    urls,
    variants,
    wrappers,
)

Query = Callable[[SparkSession, str], DataFrame]

#: Every how manyth vector is a query, and how many neighbours it gets (fixed by the contract).
QUERY_EVERY, NEIGHBOURS = 50, 5


def tokenizer_path(name: str) -> str:
    """The place of a public tokenizer's file."""
    import public_tokenizers

    return str(public_tokenizers.path(name))


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases and texts of every document."""
    return licenses.scan(_table(spark, sf_dir, "documents"))


def op2_simhash_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate group of every document."""
    found = simhash.near_duplicates(_table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every page's URL."""
    return urls.judge(_table(spark, sf_dir, "pages"))


def op4_nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nearest vectors of every fiftieth vector."""
    return rotated_codes.nearest(
        _table(spark, sf_dir, "embeddings"), every=QUERY_EVERY, k=NEIGHBOURS
    )


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality measures and verdict of every document."""
    return host_rules.judge(_table(spark, sf_dir, "documents"))


def op6_bpe_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every document's ids and of what they decode to."""
    found = tree_bpe.encode(
        _table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json")
    )
    return found.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's pieces and their places in sequences."""
    return packing.packed(_table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without its host's boilerplate lines."""
    cleaned = site_lines.drop_boilerplate(_table(spark, sf_dir, "documents"))
    return cleaned.select("doc_id", "n_lines", "n_dropped", "text")


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document."""
    docs = _table(spark, sf_dir, "documents")
    model = passages.train(docs, _table(spark, sf_dir, "labels"))
    return passages.score(docs, model).select(
        "doc_id",
        passages.held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of every document."""
    found = pii.find(_table(spark, sf_dir, "documents"))
    counts = [pii.counted(F.col("spans"), kind).alias(f"n_{kind}") for kind in pii.BASE_KINDS]
    base = pii.listed(F.col("spans"), pii.BASE_KINDS)
    return found.select(
        "doc_id",
        *counts,
        F.sha2(base.cast("binary"), 256).alias("base_sha256"),
        pii.listed(F.col("spans")).alias("spans"),
    )


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every frequent word with its near words, its form and its root."""
    return variants.group(_table(spark, sf_dir, "documents"))


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's tokens of two tokenizers, aligned."""
    return alignment.align(
        _table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model")
    )


def op13_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return wrappers.extract(_table(spark, sf_dir, "pages"))


def all_queries() -> dict[str, Query]:
    own = (
        op1_license_scan,
        op2_simhash_groups,
        op3_url_filter,
        op4_nearest_vectors,
        op5_quality_rules,
        op6_bpe_roundtrip,
        op7_packing,
        op8_line_dedup,
        op9_quality_classifier,
        op10_pii,
        op11_spelling_variants,
        op12_token_alignment,
        op13_main_text,
    )
    return {f.__name__: f for f in own}
