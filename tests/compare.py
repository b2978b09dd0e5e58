"""Side-by-side run of a query and its oracle."""

from __future__ import annotations

import duckdb

GIVEN = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in GIVEN:
        connection.execute(
            f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')"
        )
    return connection


def _ordered(columns, rows):
    at = [columns.index(name) for name in sorted(columns)]
    return sorted((tuple(row[i] for i in at) for row in rows), key=repr)


def differences(df, connection, sql: str) -> list[str]:
    """Empty when columns, types (as Python values) and rows agree exactly."""
    expected = connection.execute(sql)
    names = [d[0] for d in expected.description]
    if sorted(names) != sorted(df.columns):
        return [f"columns {sorted(df.columns)} != {sorted(names)}"]
    want = _ordered(names, expected.fetchall())
    got = _ordered(df.columns, [tuple(row) for row in df.collect()])
    if len(want) != len(got):
        return [f"{len(got)} rows != {len(want)}"]
    return [f"{g} != {w}" for g, w in zip(got, want) if repr(g) != repr(w)]
