"""Row-by-row comparison of a Spark result with an oracle query in DuckDB."""

from __future__ import annotations

import datetime as dt
import math
from collections import Counter

import duckdb

TABLES = ("documents", "events", "nation")


def oracle_rows(sf_dir: str, sql: str) -> tuple[list[str], list[tuple]]:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')")
    result = con.execute(sql)
    return [d[0] for d in result.description], result.fetchall()


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value
    if isinstance(value, dt.datetime) and value.tzinfo is not None:
        return value.astimezone(dt.timezone.utc).replace(tzinfo=None)
    return value


def normal(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def differences(df, sf_dir: str, sql: str) -> str | None:
    """None where both give the same rows under the same names."""
    names, expected = oracle_rows(sf_dir, sql)
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} against {sorted(names)}"
    got = normal(df.columns, [tuple(r) for r in df.collect()])
    want = normal(names, expected)
    if got == want:
        return None
    extra, missing = got - want, want - got
    return f"{sum(extra.values())} unexpected such as {list(extra)[:2]}, {sum(missing.values())} missing such as {list(missing)[:2]}"
