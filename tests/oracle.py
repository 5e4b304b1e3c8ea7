"""Runs a query on Spark and its SQL on DuckDB and compares the rows."""

from __future__ import annotations

import math

import duckdb

from lakestar.plans import QUERIES, SQL
from lakestar.plans.tables import NAMES


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in NAMES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def _cell(value):
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return f"{value + 0.0:.9g}"
    return str(value)


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_cell(row[i]) for i in order) for row in rows)


KINDS = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
    "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN",
}


def differences(spark, con, folder: str, name: str) -> list[str]:
    df = QUERIES[name](spark, folder)
    found = [tuple(r) for r in df.collect()]
    cursor = con.execute(SQL[name])
    columns = [d[0] for d in cursor.description]
    kinds = {d[0]: str(d[1]) for d in cursor.description}
    expected = cursor.fetchall()
    out = []
    if sorted(columns) != sorted(df.columns):
        return [f"columns {sorted(df.columns)} != {sorted(columns)}"]
    for field in df.schema.fields:
        want = KINDS.get(field.dataType.simpleString(), field.dataType.simpleString())
        if kinds[field.name] != want and kinds[field.name] != '"NULL"':
            out.append(f"type of {field.name}: {want} != {kinds[field.name]}")
    a, b = _rows(df.columns, found), _rows(columns, expected)
    if len(a) != len(b):
        out.append(f"rows {len(a)} != {len(b)}")
    if a != b:
        diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
        out.append(f"values differ: {diff}")
    if not a:
        out.append("EMPTY")
    return out
