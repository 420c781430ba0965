"""Matrices as tables.

A matrix is a table of cells ``row, col, value`` without zeros, or a table of sparse rows
``row, entries`` with ``entries array<struct<col, value>>``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.operators.joins import lookup

#: A right-hand matrix up to this many cells goes to every task as one array.
MAX_LOCAL_CELLS = 1_000_000


def sparse_entries(values: Column) -> Column:
    """Dense values as ``array<struct<col, value>>`` without zeros."""
    cells = F.transform(
        values,
        lambda v, i: F.struct(i.alias("col"), v.cast("double").alias("value")),
    )
    return F.filter(cells, lambda cell: cell["value"] != 0)


def cells(rows: DataFrame) -> DataFrame:
    """Sparse rows as cells."""
    return rows.select("row", F.inline("entries"))


def transpose(matrix: DataFrame) -> DataFrame:
    """Rows become columns; no data moves."""
    return matrix.select(F.col("col").alias("row"), F.col("row").alias("col"), "value")


def shape(matrix: DataFrame) -> DataFrame:
    """``n_rows, n_cols``: one more than the highest indices of the cells that are there.

    Cells without zeros don't show zero rows and columns at the end; see :func:`dense_shape`.
    """
    return matrix.agg(
        (F.coalesce(F.max("row"), F.lit(-1)) + 1).cast("bigint").alias("n_rows"),
        (F.coalesce(F.max("col"), F.lit(-1)) + 1).cast("bigint").alias("n_cols"),
    )


def dense_shape(rows: DataFrame, values: str) -> DataFrame:
    """``n_rows, n_cols`` of a matrix whose rows are arrays, zeros included."""
    return rows.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.coalesce(F.max(F.size(values)), F.lit(0)).cast("bigint").alias("n_cols"),
    )


def matmul(a: DataFrame, b: DataFrame, *, small: bool | None = None) -> DataFrame:
    """The product of two cell tables of any size, as cells.

    ``b`` is broadcast if measured to be small. Otherwise both are shuffled on the inner index,
    and an index that many cells of ``a`` share is spread over several tasks.
    """
    left = a.select("row", F.col("col").alias("_inner"), F.col("value").alias("_a"))
    right = b.select(F.col("row").alias("_inner"), "col", F.col("value").alias("_b"))
    return (
        lookup(left, right, "_inner", small=small)
        .groupBy("row", "col")
        .agg(F.sum(F.col("_a") * F.col("_b")).alias("value"))
    )


def multiply_rows(
    rows: DataFrame, b: DataFrame, *, b_shape: tuple[int, int] | None = None
) -> DataFrame:
    """Sparse rows times a small matrix: ``row, values`` with ``values array<double>``.

    Each row is finished where it is read: no join and no shuffle of ``rows``. A ``b`` above
    the limit takes the way of :func:`matmul` first. ``b_shape`` is needed where ``b`` ends with
    rows or columns of zeros. An entry of ``rows`` beyond the rows of ``b`` is an error; with a
    ``b`` without columns every row of the product is empty.
    """
    n_rows, n_cols = b_shape or shape(b).first()
    widest = rows.agg(F.max(F.array_max(F.transform("entries", lambda e: e["col"])))).first()[0]
    if widest is not None and widest >= n_rows:
        raise ValueError(f"the left matrix has {widest + 1} columns or more, the right one {n_rows} rows")
    if not n_cols:
        return rows.select("row", F.array().cast("array<double>").alias("values"))
    if n_rows * n_cols > MAX_LOCAL_CELLS:
        return _gather(rows, matmul(cells(rows), b, small=False), n_cols)
    columns = F.sequence(F.lit(0), F.lit(n_cols - 1))
    dense = (
        b.groupBy("row")
        .agg(F.map_from_entries(F.collect_list(F.struct("col", "value"))).alias("_cells"))
        .select(
            "row",
            F.transform(columns, lambda j: F.coalesce(F.col("_cells")[j], F.lit(0.0))).alias("_v"),
        )
    )
    zeros = F.array_repeat(F.lit(0.0), n_cols)
    index = b.sparkSession.range(n_rows).select(F.col("id").cast("int").alias("row"))
    local = (
        index.join(dense, "row", "left")
        .agg(F.sort_array(F.collect_list(F.struct("row", F.coalesce("_v", zeros).alias("v")))))
        .scalar()["v"]
    )

    def add(total: Column, cell: Column) -> Column:
        row = F.coalesce(F.get(F.col("_b"), cell["col"]), zeros)
        return F.zip_with(total, row, lambda t, v: t + cell["value"] * v)

    return rows.withColumn("_b", local).select(
        "row", F.aggregate("entries", zeros, add).alias("values")
    )


def _gather(rows: DataFrame, product: DataFrame, n_cols: int) -> DataFrame:
    found = product.groupBy("row").agg(
        F.map_from_entries(F.collect_list(F.struct("col", "value"))).alias("_cells")
    )
    columns = F.sequence(F.lit(0), F.lit(n_cols - 1))
    values = F.transform(columns, lambda j: F.coalesce(F.col("_cells")[j], F.lit(0.0)))
    return rows.select("row").join(found, "row", "left").select("row", values.alias("values"))
