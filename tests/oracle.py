"""Compare a registered query with its SQL, value by value."""

from __future__ import annotations

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def _sorted(columns: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    picked = [tuple(row[i] for i in order) for row in rows]
    return sorted(picked, key=lambda r: [(v is not None, str(v)) for v in r])


def differences(spark_df, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None when both agree in columns, types of values and values."""
    got_columns = spark_df.columns
    got = _sorted(got_columns, [tuple(r) for r in spark_df.collect()])
    cursor = con.execute(sql)
    want_columns = [d[0] for d in cursor.description]
    want = _sorted(want_columns, cursor.fetchall())
    if sorted(got_columns) != sorted(want_columns):
        return f"columns {sorted(got_columns)} != {sorted(want_columns)}"
    if len(got) != len(want):
        return f"{len(got)} rows, expected {len(want)}"
    for a, b in zip(got, want):
        if a != b or [type(x) for x in a] != [type(x) for x in b]:
            return f"{sorted(got_columns)}: {a} != {b}"
    return None
