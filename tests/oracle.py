"""Run a query and its SQL side by side and report the differences."""

from __future__ import annotations

import datetime
from collections import Counter

import duckdb
from pyspark.sql import DataFrame

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _plain(value):
    if isinstance(value, datetime.datetime) and value.tzinfo is not None:
        return value.astimezone(datetime.timezone.utc).replace(tzinfo=None)
    return value


def spark_rows(df: DataFrame) -> tuple[list[str], Counter]:
    names = sorted(df.columns)
    return names, Counter(tuple(map(_plain, row)) for row in df.select(*names).collect())


def duck_rows(con: duckdb.DuckDBPyConnection, sql: str) -> tuple[list[str], Counter]:
    cursor = con.execute(sql)
    names = [column[0] for column in cursor.description]
    order = sorted(range(len(names)), key=names.__getitem__)
    rows = Counter(tuple(_plain(row[i]) for i in order) for row in cursor.fetchall())
    return [names[i] for i in order], rows


def differences(df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None if both give the same columns and the same rows, bit for bit."""
    ours, theirs = spark_rows(df), duck_rows(con, sql)
    if ours[0] != theirs[0]:
        return f"columns {ours[0]} != {theirs[0]}"
    extra, missing = ours[1] - theirs[1], theirs[1] - ours[1]
    if extra or missing:
        return (
            f"{sum(ours[1].values())} rows against {sum(theirs[1].values())}: "
            f"{sum(extra.values())} extra {list(extra)[:3]}, "
            f"{sum(missing.values())} missing {list(missing)[:3]}"
        )
    return None
