"""Run a registered query and its DuckDB counterpart and compare the rows."""

from __future__ import annotations

import math
from collections import Counter
from pathlib import Path

import duckdb
from pyspark.sql import SparkSession

from tristrata.workload.registry import ORACLES, QUERIES


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 6)
    return value


def _rows(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(r[i]) for i in order) for r in rows)


def _kind(type_name: str) -> str:
    name = type_name.lower()
    names = {"integer": "int", "varchar": "string", "double": "double", "float": "float"}
    return names.get(name, name)


# Operators that no query may need: all pairs of two inputs, or rows in Python.
UNWANTED = ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "InPandas", "ArrowEval")


def differences(spark: SparkSession, sf_dir: str, name: str) -> str | None:
    """What differs between a query and its counterpart, or None."""
    df = QUERIES[name](spark, sf_dir)
    plan = df._jdf.queryExecution().executedPlan().toString()
    unwanted = [u for u in UNWANTED if u in plan]
    if unwanted:
        return f"plan contains {unwanted}"
    got = _rows(df.columns, df.collect())
    cursor = duck(sf_dir).execute(ORACLES[name])
    columns = [d[0] for d in cursor.description]
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} instead of {sorted(columns)}"
    types = {d[0]: _kind(str(d[1])) for d in cursor.description}
    for field in df.schema:
        if _kind(field.dataType.simpleString()) != types[field.name]:
            return f"{field.name}: {field.dataType.simpleString()} instead of {types[field.name]}"
    want = _rows(columns, cursor.fetchall())
    if got == want:
        return None
    return (
        f"{sum(got.values())} rows instead of {sum(want.values())}; "
        f"only here {list((got - want).items())[:3]}, only there {list((want - got).items())[:3]}"
    )
