"""Run a query on Spark and its SQL on DuckDB and compare names, types, rows and values."""

from __future__ import annotations

import glob
import os
from collections import Counter

import duckdb
from pyspark.sql import DataFrame

DUCK_TYPES = {
    "string": "VARCHAR",
    "smallint": "SMALLINT",
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "timestamp": "TIMESTAMP",
    "timestamp_ntz": "TIMESTAMP",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.splitext(os.path.basename(path))[0]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def differences(con, df: DataFrame, sql: str) -> list[str]:
    """Empty when both sides agree; row order and column order do not matter."""
    found = con.execute(sql)
    duck_types = {d[0]: str(d[1]) for d in found.description}
    duck_rows = found.fetchall()
    duck_names = list(duck_types)
    problems = []
    if sorted(df.columns) != sorted(duck_names):
        return [f"columns {sorted(df.columns)} against {sorted(duck_names)}"]
    for name, kind in df.dtypes:
        expected = DUCK_TYPES.get(kind, kind.upper())
        if expected != duck_types[name]:
            problems.append(f"{name}: {expected} against {duck_types[name]}")
    order = [duck_names.index(c) for c in df.columns]
    spark_rows = Counter(tuple(r) for r in df.collect())
    expected_rows = Counter(tuple(r[i] for i in order) for r in duck_rows)
    missing, extra = expected_rows - spark_rows, spark_rows - expected_rows
    if missing or extra:
        problems.append(f"{sum(missing.values())} rows missing, e.g. {list(missing)[:2]}")
        problems.append(f"{sum(extra.values())} rows extra, e.g. {list(extra)[:2]}")
    if not expected_rows:
        problems.append("no rows")
    return problems
