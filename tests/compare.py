"""Run queries on Spark and their SQL on DuckDB and compare: ``python tests/compare.py [names]``."""

from __future__ import annotations

import math
import os
import sys
import time
from pathlib import Path

import duckdb

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def normal(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(f"{value:.9g}")
    return value


def rows_of(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(normal(row[i]) for i in order) for row in rows), key=repr)


def differences(df, con, sql: str) -> list[str]:
    """Empty if the Spark result and the SQL result hold the same columns and rows."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    expected = rows_of(names, result.fetchall())
    if sorted(names) != sorted(df.columns):
        return [f"columns {sorted(df.columns)} but SQL {sorted(names)}"]
    found = rows_of(df.columns, df.collect())
    if found == expected:
        return []
    unlike = [f"{a} | {b}" for a, b in zip(found, expected, strict=False) if a != b]
    return [f"{len(found)} rows but SQL {len(expected)}", *unlike[:3]]


def main() -> int:
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    sf_dir = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    queries, oracle = entry.queries(), entry.oracle_sql()
    bad = 0
    for name in sys.argv[1:] or queries:
        start = time.time()
        try:
            df = queries[name](spark, sf_dir)
            if name in oracle:
                problems = differences(df, con, oracle[name])
                kind = "ok"
            else:
                problems, kind = [], f"{df.count()} rows, no SQL"
        except Exception as error:  # noqa: BLE001
            problems, kind = [f"{type(error).__name__}: {str(error)[:600]}"], ""
        bad += bool(problems)
        print(f"{name:26s} {time.time() - start:6.2f}s", "; ".join(problems) or kind, flush=True)
    print(f"{bad} differ")
    return bad


if __name__ == "__main__":
    sys.exit(main())
