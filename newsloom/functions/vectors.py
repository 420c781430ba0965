"""Column expressions on sparse ML vectors."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def sparse_entries(vector: str, index: str, value: str) -> Column:
    """The entries that a sparse vector stores, as ``array<struct<index, value>>``.

    Work follows the entries there are, not the length of the vector. A dense vector stores no
    indices and gives null.
    """
    stored = F.unwrap_udt(F.col(vector))
    pairs = F.arrays_zip(stored["indices"].alias("i"), stored["values"].alias("v"))
    return F.transform(pairs, lambda e: F.struct(e["i"].alias(index), e["v"].alias(value)))
