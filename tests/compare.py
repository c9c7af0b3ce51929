"""Compare a registered query with its checking SQL on one data set."""

from __future__ import annotations

import datetime
import decimal
import glob
import math
import os

import duckdb
from pyspark.sql import DataFrame

KINDS = {
    "tinyint": "int", "smallint": "int", "int": "int", "bigint": "int", "integer": "int",
    "hugeint": "hugeint", "double": "double", "float": "double", "boolean": "boolean",
    "string": "text", "varchar": "text",
}


def kind(type_name: str) -> str:
    return KINDS.get(type_name.lower(), type_name.lower())


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _norm(v):
    if isinstance(v, float):
        return ("f", "nan") if math.isnan(v) else ("f", repr(v + 0.0))
    if isinstance(v, decimal.Decimal):
        return ("d", str(v))
    if isinstance(v, (datetime.date, datetime.datetime)):
        return ("t", v.isoformat())
    return (type(v).__name__, repr(v))


def differences(
    df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str, show: int = 3
) -> tuple[int, list[str]]:
    """Rows found, and what differs in names, kinds of types or values."""
    rel = con.sql(sql)
    names = sorted(df.columns)
    if names != sorted(rel.columns):
        return -1, [f"columns: {sorted(set(names) ^ set(rel.columns))}"]
    out = []
    theirs = dict(zip(rel.columns, (str(t) for t in rel.types)))
    for f in df.schema:
        a, b = kind(f.dataType.simpleString()), kind(theirs[f.name])
        if a != b:
            out.append(f"type of {f.name}: {a} / {b}")
    spark_rows = sorted(tuple(_norm(r[n]) for n in names) for r in df.collect())
    cols = [rel.columns.index(n) for n in names]
    sql_rows = sorted(tuple(_norm(r[i]) for i in cols) for r in rel.fetchall())
    if len(spark_rows) != len(sql_rows):
        out.append(f"rows: {len(spark_rows)} / {len(sql_rows)}")
    if spark_rows != sql_rows:
        bad = [(a, b) for a, b in zip(spark_rows, sql_rows) if a != b]
        out.append(f"values: {len(bad)} rows differ")
        for a, b in bad[:show]:
            out.append(str([(n, x[1], y[1]) for n, x, y in zip(names, a, b) if x != y]))
    return len(spark_rows), out
