"""Serving tables in a relational database."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


def export_tables(
    tables: Mapping[str, DataFrame],
    url: str,
    *,
    properties: Mapping[str, str] | None = None,
    connections: int = 8,
    batch_size: int = 10_000,
) -> None:
    """Replace each table with its frame, written straight from executors.

    ``numPartitions`` bounds the connections the database has to serve. A task
    that is lost after its commit is run again and inserts its rows twice, so
    the row count is read back and a difference raises; running the export
    again is always safe because it replaces the tables. Rows are counted as they are
    written, and in the database, so neither side is read again.
    """
    options = {**(properties or {}), "batchsize": str(batch_size), "numPartitions": str(connections)}
    for name, frame in tables.items():
        counted = Observation()
        observed = frame.observe(counted, F.count(F.lit(1)).alias("n"))
        observed.write.jdbc(url, name, mode="overwrite", properties=options)
        expected = counted.get["n"]
        # The database counts; one row comes back.
        reader = frame.sparkSession.read.format("jdbc").options(**(properties or {}))
        query = f"SELECT count(*) AS n FROM {name}"
        stored = int(reader.option("url", url).option("query", query).load().first()[0])
        if stored != expected:
            raise RuntimeError(f"{name}: {stored} rows in the database, {expected} written")
