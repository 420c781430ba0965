"""Reading documents, dictionaries and matrices from text files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from newsloom.operators.joins import lookup
from newsloom.operators.matrix import sparse_entries
from newsloom.operators.terms import numbered

BYTE_ORDER_MARK = "\ufeff"


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, text``: one document per line; ids are unique and follow path and order of lines."""
    return _placed_lines(spark, path).select(
        F.col("place").alias("doc_id"), F.col("value").alias("text")
    )


def read_labelled(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, label, text, line`` from tab-separated lines; ``line`` follows path and order.

    Fields beyond the third are ignored. An empty label is null. Lines with fewer than three
    fields or an empty text are left out here; :func:`rejected_lines` gives them.
    """
    fields = F.split("value", "\t", 4)
    return (
        _placed_lines(spark, path)
        .select(fields.alias("f"), F.col("place").alias("line"))
        .where(F.get("f", F.lit(2)) != "")
        .select(
            F.get("f", F.lit(0)).alias("doc_id"),
            F.nullif(F.get("f", F.lit(1)), F.lit("")).alias("label"),
            F.get("f", F.lit(2)).alias("text"),
            "line",
        )
    )


def rejected_lines(spark: SparkSession, path: str) -> DataFrame:
    """``line, value``: the lines of a labelled file that :func:`read_labelled` leaves out."""
    return (
        _placed_lines(spark, path)
        .where(F.coalesce(F.get(F.split("value", "\t", 4), F.lit(2)), F.lit("")) == "")
        .select(F.col("place").alias("line"), "value")
    )


def read_dictionary(spark: SparkSession, path: str) -> DataFrame:
    """``kw_id, kw``: the first space-separated token of each line with the line's position.

    A byte order mark is stripped and lines without a keyword are dropped, without changing
    the positions of the others. ``Lexicon.from_table`` takes the last of repeated keywords.
    """
    lines = _numbered_lines(spark, path)
    clean = F.regexp_replace("value", f"^{BYTE_ORDER_MARK}", "")
    return lines.select(
        F.col("line").alias("kw_id"), F.get(F.split(clean, " "), F.lit(0)).alias("kw")
    ).where(F.col("kw") != "")


def read_segmented(spark: SparkSession, path: str) -> DataFrame:
    """``tokens``: lines split at single spaces; empty tokens are kept except at the end."""
    return spark.read.text(path).select(F.split(F.rtrim("value"), " ").alias("tokens"))


def read_sparse_rows(spark: SparkSession, path: str) -> DataFrame:
    """``row, entries``: lines of numbers as sparse rows, with ids in the order of lines."""
    return _placed_lines(spark, path).select(
        F.col("place").alias("row"),
        sparse_entries(_numbers("value")).alias("entries"),
    )


def read_matrix(spark: SparkSession, path: str) -> DataFrame:
    """``row, col, value``: lines of numbers as cells, zeros included, rows numbered from 0."""
    return _numbered_lines(spark, path).select(
        F.col("line").alias("row"), F.posexplode(_numbers("value")).alias("col", "value")
    )


def _named(path: str, name_contains: str | None) -> str:
    """The files and folders under a path, or those whose name holds some text, chosen when they are listed."""
    if not name_contains:
        return path
    literal = "".join("\\" + c if c in "\\{}[]*?" else c for c in name_contains)
    return f"{path.rstrip('/')}/*{literal}*"


def read_whole_files(
    spark: SparkSession, path: str, *, name_contains: str | None = None
) -> DataFrame:
    """``path, content``: one row per file, for files that each fit in memory.

    With ``name_contains`` only files, and folders with all their files, whose name holds that text;
    others are neither opened nor listed. It is an error if there are none.
    """
    return spark.read.text(_named(path, name_contains), wholetext=True).select(
        F.col("_metadata.file_path").alias("path"), F.col("value").alias("content")
    )


def read_lines_with_path(
    spark: SparkSession, path: str, *, name_contains: str | None = None
) -> DataFrame:
    """``path, text``: lines with the file they come from, chosen in the same way; files of any size are split."""
    return spark.read.text(_named(path, name_contains)).select(
        F.col("_metadata.file_path").alias("path"), F.col("value").alias("text")
    )


def tab_field(content: Column, n: int) -> Column:
    """The n-th tab-separated field, from 0; null if there are fewer."""
    return F.get(F.split(content, "\t"), F.lit(n))


def _numbers(line: str) -> Column:
    return F.transform(F.split(F.rtrim(line), " "), lambda n: n.cast("double"))


def _placed_lines(spark: SparkSession, path: str) -> DataFrame:
    """``place, value``: lines with numbers that are unique and follow path, then order of lines.

    Spark deals files to tasks by size, so a row's place in its task says nothing about the order
    of files. The splits, a row each, are sorted by path and start; a line's number is that of its
    split, then its place in the task, which grows along a split. Lines are not shuffled.
    """
    lines = spark.read.text(path).select(
        "value",
        F.col("_metadata.file_path").alias("_path"),
        F.col("_metadata.file_block_start").alias("_start"),
        F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1).alias("_at"),
    )
    order = Window.orderBy("_path", "_start")
    splits = lines.select("_path", "_start").distinct().select(
        F.struct("_path", "_start").alias("_split"), (F.row_number().over(order) - 1).cast("bigint").alias("_number")
    )
    placed = lookup(lines.withColumn("_split", F.struct("_path", "_start")), splits, "_split")
    return placed.select(
        (F.shiftleft("_number", 33) + F.col("_at")).alias("place"), "value"
    )


def _numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    lines = spark.read.text(path).select(
        "value",
        F.struct("_metadata.file_path", "_metadata.file_block_start").alias("_split"),
        F.monotonically_increasing_id().alias("_order"),
    )
    return numbered(lines, F.col("_split"), ["_order"], "line").select("line", "value")
