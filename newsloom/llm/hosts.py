"""Hosts as join keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def host_key(host: Column) -> Column:
    """The host as a string that is never null; a null host is a host of its own."""
    return F.when(host.isNull(), F.lit("-")).otherwise(F.concat(F.lit("+"), host.cast("string")))
