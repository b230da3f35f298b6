"""Compare a query with its SQL twin: columns, row count and values."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for table in TABLES:
        path = Path(sf_dir, f"{table}.parquet")
        if path.exists():
            con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value + 0.0
    return value


def _sorted(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return [names[i] for i in order], sorted(plain, key=repr)


KINDS = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
    "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP",
}


def differences(df, con, sql: str) -> str | None:
    """A description of the first difference, or None."""
    relation = con.sql(sql)
    spark_types = {f.name: KINDS.get(f.dataType.simpleString()) for f in df.schema}
    duck_types = {n: str(t) for n, t in zip(relation.columns, relation.types, strict=True)}
    if spark_types != duck_types:
        return f"types: {spark_types} / {duck_types}"
    names, mine = _sorted(df.columns, [tuple(r) for r in df.collect()])
    _, theirs = _sorted(relation.columns, relation.fetchall())
    if len(mine) != len(theirs):
        return f"rows: {len(mine)} / {len(theirs)}"
    for a, b in zip(mine, theirs, strict=True):
        if a != b:
            return f"{names}: {a} / {b}"
    return None
