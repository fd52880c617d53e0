"""Silver and gold tables. The format is an argument, Parquet by default."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


class GoldTables(NamedTuple):
    daily_metrics: DataFrame
    symbol_metrics: DataFrame
    market_metrics: DataFrame


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
# Formats that are plain files; the others keep a schema of their own.
FILE_FORMATS = ("parquet", "orc", "json")


def literal(path: str) -> str:
    """The pattern that only ``path`` itself matches: Spark's readers expand patterns."""
    return re.sub(r"([\\{}\[\]*?])", r"\\\1", path)


def read_table(
    spark: SparkSession, path: str, *, fmt: str = "parquet", schema: str | StructType | None = None
) -> DataFrame:
    """Read a table. A declared ``schema`` saves inferring it from the files,
    and lets a table that has no file yet be read as empty."""
    reader = spark.read.format(fmt)
    if schema is not None and fmt in FILE_FORMATS:
        reader = reader.schema(schema)
    return reader.load(literal(path))


def read_if_written(
    spark: SparkSession, path: str, *, schema: str, fmt: str = "parquet"
) -> DataFrame | None:
    """A table, or None if nothing was ever written there."""
    try:
        return read_table(spark, path, fmt=fmt, schema=schema)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def small_frame(spark: SparkSession, rows: Sequence[Sequence], schema: str) -> DataFrame:
    """A frame of a few rows known to the driver, made without a Python worker."""
    names = StructType.fromDDL(schema).names
    text = json.dumps([dict(zip(names, row, strict=True)) for row in rows])
    parsed = F.from_json(F.lit(text), f"array<struct<{schema_fields(schema)}>>")
    return spark.range(1).select(F.inline(parsed))


def schema_fields(schema: str) -> str:
    """``a int, b string`` as the fields of a struct type."""
    fields = StructType.fromDDL(schema).fields
    return ", ".join(f"{field.name}: {field.dataType.simpleString()}" for field in fields)


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder on whatever file system it is; none is no error."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def read_gold(spark: SparkSession, path: str, *, fmt: str = "parquet") -> GoldTables:
    """The three metric tables below one gold folder."""
    return GoldTables(*(read_table(spark, f"{path}/{name}", fmt=fmt) for name in GoldTables._fields))


def register_views(tables: Mapping[str, DataFrame]) -> None:
    """Make tables visible to ``spark.sql`` under the given names."""
    for name, frame in tables.items():
        frame.createOrReplaceTempView(name)


@contextmanager
def run_once(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of what runs inside go as each run ends, not when the driver happens to
    collect its garbage: of a job of many writes, disks hold one write's at a time.

    For frames that are not run again. If one were, Spark would make its files again.
    """
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)


def _save(writer: DataFrameWriter, df: DataFrame, path: str) -> None:
    with run_once(df.sparkSession):
        writer.save(path)


def _writer(
    df: DataFrame, fmt: str, partition_by: Sequence[str], sort_by: Sequence[str], rebalance: bool
) -> DataFrameWriter:
    """Lay rows out for the write.

    The rebalance brings the rows of one partition folder together and splits
    a folder that is too large for one task, so files are neither tiny nor huge
    whatever the skew. Pass ``rebalance=False`` for rows that are already
    together, or for so few folders that each task may write to all of them:
    it saves a shuffle of the whole table. Sorting inside a file narrows the
    min/max statistics that let a later filter skip row groups.
    """
    if partition_by and rebalance:
        df = df.hint("rebalance", *partition_by)
    if sort_by:
        df = df.sortWithinPartitions(*partition_by, *sort_by)
    writer = df.write.format(fmt)
    if fmt == "parquet":
        writer = writer.option("compression", "zstd")
    return writer.partitionBy(*partition_by) if partition_by else writer


def append_table(
    df: DataFrame,
    path: str,
    *,
    fmt: str = "parquet",
    partition_by: Sequence[str] = (),
    sort_by: Sequence[str] = (),
    rebalance: bool = True,
) -> None:
    _save(_writer(df, fmt, partition_by, sort_by, rebalance).mode("append"), df, path)


def replace_table(
    df: DataFrame,
    path: str,
    *,
    fmt: str = "parquet",
    partition_by: Sequence[str] = (),
    sort_by: Sequence[str] = (),
    rebalance: bool = True,
) -> None:
    """Replace the whole table, whatever overwrite mode the session has."""
    writer = _writer(df, fmt, partition_by, sort_by, rebalance)
    _save(writer.option("partitionOverwriteMode", "static").mode("overwrite"), df, path)


def replace_partitions(
    df: DataFrame,
    path: str,
    *,
    partition_by: Sequence[str],
    fmt: str = "parquet",
    sort_by: Sequence[str] = (),
    rebalance: bool = True,
) -> None:
    """Replace the partitions ``df`` has rows for; leave the others alone."""
    writer = _writer(df, fmt, partition_by, sort_by, rebalance)
    _save(writer.option("partitionOverwriteMode", "dynamic").mode("overwrite"), df, path)
