"""What the jobs need between runs, saved as tables under one manifest.

A version's tables are written first, each under a folder that nothing else uses; its manifest, one line of JSON in a
folder of its own, is written last and makes the version visible. A version that was left half-written has no
manifest and is never loaded. Loading compares each table's schema with the manifest, and the dictionary's rows with
the hash that was taken when it was saved, as all other tables refer to its positions.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsloom.lineage import materialize

DICTIONARY = "dictionary"


def table_hash(table: DataFrame) -> str:
    """A hash of the rows of a table, whatever their order."""
    row = F.xxhash64(*[F.col(f"`{c}`") for c in sorted(table.columns)]).cast("decimal(20, 0)")
    found = table.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(row), F.lit(0)).alias("total")).first()
    return f"{found['n']}:{found['total']}"


def _lines(spark: SparkSession, folder: str) -> list[dict]:
    """The manifests in a folder; only files of finished writes are there."""
    try:
        rows = spark.read.text(f"{folder}/*/part-*").collect()  # one line per version or batch
    except AnalysisException as error:
        if "PATH_NOT_FOUND" in str(error):
            return []
        raise
    return [json.loads(row["value"]) for row in rows]


def _publish(spark: SparkSession, folder: str, line: dict) -> None:
    one = spark.range(1).select(F.lit(json.dumps(line)).alias("value"))
    one.coalesce(1).write.text(f"{folder}/{uuid.uuid4().hex}")


@dataclass(frozen=True)
class Artifact:
    """A loaded version: its tables by name, and constants."""

    version: int
    tables: Mapping[str, DataFrame]
    constants: Mapping[str, object] = field(default_factory=dict)

    def __getitem__(self, name: str) -> DataFrame:
        return self.tables[name]


def save(path: str, tables: Mapping[str, DataFrame], **constants: object) -> int:
    """Write the tables as the next version of an artifact and publish it; the version's number."""
    spark = next(iter(tables.values())).sparkSession
    version = max((line["version"] for line in _lines(spark, f"{path}/manifests")), default=0) + 1
    held = {}
    for name, table in tables.items():
        folder = f"{path}/tables/{name}-{uuid.uuid4().hex}"
        table.write.parquet(folder)
        held[name] = {"folder": folder, "schema": table.schema.json()}
        if name == DICTIONARY:
            held[name]["hash"] = table_hash(spark.read.parquet(folder))
    _publish(spark, f"{path}/manifests", {"version": version, "tables": held, "constants": constants})
    return version


def load(spark: SparkSession, path: str, version: int | None = None) -> Artifact:
    """The latest version, or the one asked for."""
    lines = {line["version"]: line for line in _lines(spark, f"{path}/manifests")}
    if not lines or version not in (None, *lines):
        raise FileNotFoundError(f"no such version under {path}: {version or 'none is published'}")
    line = lines[max(lines) if version is None else version]
    tables = {}
    for name, held in line["tables"].items():
        schema = T.StructType.fromJson(json.loads(held["schema"]))
        tables[name] = spark.read.parquet(held["folder"])
        found = [(f.name, f.dataType) for f in tables[name].schema.fields]
        if found != [(f.name, f.dataType) for f in schema.fields]:
            raise ValueError(f"{name} has other columns than were saved")
        if "hash" in held and table_hash(tables[name]) != held["hash"]:
            raise ValueError(f"{name} holds other rows than were saved")
    return Artifact(line["version"], tables, line["constants"])


class EdgeStore:
    """Edge counts ``kw_id, other_id, n`` that grow by batches, such as months.

    Every batch has a name and counts once, however often it is added. Batches refer to one
    dictionary, whose hash each of them carries. Counts are added up when they are read;
    :meth:`compact` adds up those that are there once and for all.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def _chosen(self) -> list[dict]:
        """Lines that hold each batch once: of compacted ones those with the most batches."""
        lines = _lines(self.spark, f"{self.path}/manifests")
        chosen, held = [], set()
        for line in sorted(lines, key=lambda x: (-len(x["batches"]), x["folder"])):
            if held.isdisjoint(line["batches"]):
                chosen.append(line)
                held.update(line["batches"])
        return chosen

    def batches(self) -> list[str]:
        """The names of the batches that are in the store."""
        return sorted(name for line in self._chosen() for name in line["batches"])

    def add(self, name: str, counts: DataFrame, dictionary: DataFrame) -> bool:
        """Add a batch's counts; false, and nothing is computed, if it is in the store."""
        chosen = self._chosen()
        if any(name in line["batches"] for line in chosen):
            return False
        digest = table_hash(dictionary)
        if any(line["dictionary"] != digest for line in chosen):
            raise ValueError("the store was filled with another dictionary")
        self._write([name], counts, digest)
        return True

    def _write(self, names: list[str], counts: DataFrame, digest: str) -> None:
        folder = f"{self.path}/counts/{uuid.uuid4().hex}"
        counts.select("kw_id", "other_id", "n").write.parquet(folder)
        _publish(self.spark, f"{self.path}/manifests", {"batches": names, "folder": folder, "dictionary": digest})

    def counts(self) -> DataFrame:
        """``kw_id, other_id, n`` over all batches."""
        folders = [line["folder"] for line in self._chosen()]
        if not folders:
            return self.spark.createDataFrame([], "kw_id bigint, other_id bigint, n bigint")
        rows = self.spark.read.parquet(*folders)
        return rows.groupBy("kw_id", "other_id").agg(F.sum("n").alias("n"))

    def compact(self) -> None:
        """Write the sum of all batches as one; later reads take it in their place."""
        chosen = self._chosen()
        if len(chosen) > 1:
            names = sorted(name for line in chosen for name in line["batches"])
            self._write(names, materialize(self.counts(), "edge-counts"), chosen[0]["dictionary"])
