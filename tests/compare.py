"""Run a registered query and its DuckDB twin on one folder and compare them value by value."""

from __future__ import annotations

import math
from datetime import datetime

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

TYPE_FAMILIES = {
    "BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string", "BOOLEAN": "boolean",
    "TIMESTAMP": "timestamp_ntz", "FLOAT": "float",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def canonical(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    if isinstance(value, datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, (list, tuple)):
        return "[" + ",".join(canonical(v) for v in value) + "]"
    return repr(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted("\t".join(canonical(r[i]) for i in order) for r in rows)


def compare(df, sql: str, con) -> tuple[str, int]:
    """("" or what differs, row count)."""
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    types = {d[0]: str(d[1]) for d in cursor.description}
    expected = rows_of(names, cursor.fetchall())
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} vs {sorted(names)}", 0
    mismatched = [
        (c, t, types[c]) for c, t in df.dtypes if TYPE_FAMILIES.get(types[c], types[c]) != t and "[" not in types[c]
    ]
    actual = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if actual != expected:
        only_a = sorted(set(actual) - set(expected))[:3]
        only_b = sorted(set(expected) - set(actual))[:3]
        return f"rows {len(actual)} vs {len(expected)}; spark {only_a}; duckdb {only_b}", len(actual)
    if mismatched:
        return f"types {mismatched}", len(actual)
    return "", len(actual)
