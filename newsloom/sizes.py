"""Measured sizes: what may be broadcast or held in one expression, and what must not."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: A table is broadcast only if it was measured to be no larger than this.
BROADCAST_BYTES = 64 * 1024 * 1024


def _row_bytes(df: DataFrame) -> Column:
    total = F.lit(16)
    for field in df.schema.fields:
        col = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            total = total + F.coalesce(F.octet_length(col), F.lit(0)) + 8
        elif isinstance(field.dataType, T.ArrayType):
            total = total + F.coalesce(8 * F.size(col), F.lit(0)) + 8
        else:
            total = total + 8
    return total.cast("bigint")


def measured_bytes(df: DataFrame) -> int:
    """Size of the table's rows; one aggregation over it."""
    return df.agg(F.coalesce(F.sum(_row_bytes(df)), F.lit(0)).alias("n")).first()["n"]


def fits_broadcast(df: DataFrame, limit: int | None = None) -> bool:
    return measured_bytes(df) <= (BROADCAST_BYTES if limit is None else limit)
