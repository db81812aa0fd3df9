"""Run a query next to its SQL and compare columns, types and rows."""

from __future__ import annotations

from collections import Counter

import duckdb

TABLES = "region nation customer supplier part orders lineitem".split()

# Spark type of each column type the queries may return.
TYPES = {"BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string", "DATE": "date", "BOOLEAN": "boolean"}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def check(df, con, sql: str) -> int:
    """Assert equality; returns the number of rows."""
    described = {row[0]: TYPES.get(row[1], row[1]) for row in con.execute(f"DESCRIBE {sql}").fetchall()}
    assert dict(df.dtypes) == described
    names = sorted(described)
    expected = Counter(con.execute(f"SELECT {', '.join(f'\"{n}\"' for n in names)} FROM ({sql}) t").fetchall())
    actual = Counter(tuple(row) for row in df.select(*names).collect())
    assert actual == expected, (list((actual - expected).items())[:3], list((expected - actual).items())[:3])
    return sum(actual.values())
