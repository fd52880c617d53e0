"""What the jobs have done: generations, batches, files and their versions.

All records are small tables beside the layers. A batch has its own folder in each of
them, so one that runs again replaces its records too; the row that lets readers or
later runs see something is always written last.

A *file version* is a path with its time and size. The ledger of files is compared with a
listing, so what is new is a path that no batch covers, or one that has changed since. A
batch that reads a later version *supersedes* the file: bars and defects that earlier
batches took from it are no longer read.
"""

from __future__ import annotations

import time
from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from barloom.plans.lake import Lake
from barloom.schemas import SILVER_DDL
from barloom.sources.documents import list_versions
from barloom.sources.tables import (
    append_table,
    read_if_written,
    read_table,
    remove_folder,
    replace_table,
    run_once,
    small_frame,
)

GENERATION = "generation"
BATCH = "ingest_batch"
VERSION = ("modified", "length")
GENERATIONS_DDL = "generation int"
# ``modified`` is in microseconds since the epoch: no time zone can blur it.
VERSIONS_DDL = "path string, source_file string, modified bigint, length bigint"
PENDING_DDL = f"{VERSIONS_DDL}, earlier boolean"
# ``covered`` is when the batch was recorded, in microseconds, too.
FILES_DDL = f"{VERSIONS_DDL}, covered bigint, ingest_batch int, generation int"
SUPERSEDED_DDL = "source_file string, ingest_batch int, generation int"
# A file's bars per month. Zero bars: the month lost those of an earlier version. A batch
# has one row without a file, so that one without any bars is known, too.
# If no two bars of the batch share the lake's key, this key and the range of its symbols;
# else, and in records of before there were these columns, NULL.
SYMBOLS_DDL = "unique_key string, low string, high string"
RUNS_DDL = (
    "source_file string, month date, bars bigint, compacted boolean, "
    f"{SYMBOLS_DDL}, ingest_batch int, generation int"
)
RETIRED_DDL = "path string, retired bigint"
# Tables with a folder per generation.
GENERATIONAL = ("silver", "quarantine", "runs", "files", "superseded")


def generation_folder(path: str, generation: int) -> str:
    return f"{path}/{GENERATION}={generation}"


def batch_folder(path: str, generation: int, batch: int) -> str:
    return f"{generation_folder(path, generation)}/{BATCH}={batch}"


def current_generation(spark: SparkSession, lake: Lake) -> int | None:
    """The last generation that was finished; None if there is none."""
    known = read_if_written(spark, lake.generations, fmt=lake.fmt, schema=GENERATIONS_DDL)
    return None if known is None else known.agg(F.max(GENERATION)).first()[0]


def open_generation(spark: SparkSession, lake: Lake, generation: int) -> None:
    """Let readers switch to a generation; one appended row, the last act of a rebuild."""
    row = small_frame(spark, [(generation,)], GENERATIONS_DDL)
    append_table(row, lake.generations, fmt=lake.fmt)


def clear_generation(spark: SparkSession, lake: Lake, generation: int) -> None:
    """Remove what a rebuild that failed has left of a generation nobody reads."""
    for name in GENERATIONAL:
        remove_folder(spark, generation_folder(getattr(lake, name), generation))


# Files


def listed_versions(
    spark: SparkSession, lake: Lake, folders: list[str] | None = None
) -> DataFrame:
    """The files of bronze, or of some folders there, one row each, by one listing."""
    if folders is not None and not folders:
        return spark.createDataFrame([], VERSIONS_DDL)
    return list_versions(spark, folders or lake.bronze, glob=lake.glob)


def open_folders(spark: SparkSession, lake: Lake, generation: int) -> list[str] | None:
    """Folders of bronze that may still get files; None if all of bronze must be listed.

    A folder directly below bronze, such as a landing run's, is closed once no batch has
    found anything new in it for ``lake.settle``. Only the names of these folders are
    listed here. Where files lie directly in bronze, there is nothing to leave out.
    """
    known = read_if_written(spark, lake.files, fmt=lake.fmt, schema=FILES_DDL)
    if known is None:
        return None
    root = spark._jvm.org.apache.hadoop.fs.Path(lake.bronze)
    system = root.getFileSystem(spark._jsc.hadoopConfiguration())
    base = system.makeQualified(root).toString()
    entries = [
        (entry.getPath(), entry.isDirectory())
        for entry in system.listStatus(root)
        if not entry.getPath().getName().startswith((".", "_"))
    ]
    if not all(folder for _, folder in entries):
        return None
    below = F.col("path").substr(F.lit(len(base) + 2), F.length("path"))
    last = known.where(F.col(GENERATION) == generation).groupBy(
        F.substring_index(below, "/", 1).alias("folder")
    )
    limit = _now() - int(lake.settle.total_seconds() * 1_000_000)
    settled = last.agg(F.max("covered").alias("covered")).where(F.col("covered") <= limit)
    # As many names as bronze has folders.
    closed = {row.folder for row in settled.select("folder").collect()}
    return [path.toString() for path, _ in entries if path.getName() not in closed]


def new_versions(
    spark: SparkSession, lake: Lake, generation: int, *, full: bool = False
) -> DataFrame:
    """Files that no batch of the generation covers in their present version.

    Closed folders are left out, unless the listing is to be ``full``.

    ``earlier`` says that a batch covers another version. Only the last version that was
    read counts: a file that is put back as it once was is new again.
    """
    folders = None if full else open_folders(spark, lake, generation)
    listed = listed_versions(spark, lake, folders)
    known = read_if_written(spark, lake.files, fmt=lake.fmt, schema=FILES_DDL)
    if known is None:
        return listed.withColumn("earlier", F.lit(False))
    last = F.max(F.struct(BATCH, *VERSION)).alias("last")
    covered = known.where(F.col(GENERATION) == generation).groupBy("path").agg(last)
    same = F.lit(True)
    for name in VERSION:
        same = same & F.col(name).eqNullSafe(F.col(f"last.{name}"))
    earlier = F.col("last").isNotNull()
    return (
        listed.join(covered, "path", "left")
        .where(~(earlier & same))
        .select(*listed.columns, earlier.alias("earlier"))
    )


# Batches


def record_run(
    spark: SparkSession,
    lake: Lake,
    generation: int,
    batch: int,
    files: Sequence[Row] | None,
    *,
    compacted: bool = False,
    merged: bool = False,
) -> None:
    """Record a finished batch: files it supersedes, its months, the files it covers.

    Bars are counted in the batch's own folder. ``files`` are the versions it has read,
    as many as one batch takes; None for a compaction. ``compacted`` says that the batch
    has the newest copy of every bar of its months, so that earlier batches are not
    needed for them, and ``merged`` that it has no copies of its own, so none are looked for.
    """
    path = batch_folder(lake.silver, generation, batch)
    bars = read_table(spark, path, fmt=lake.fmt, schema=SILVER_DDL)
    rows = bars.groupBy("source_file", "month").agg(F.count(F.lit(1)).alias("bars"))
    marker = small_frame(spark, [(None, None, 0)], "source_file string, month date, bars bigint")
    rows = rows.unionByName(marker)
    changed = [(row.source_file,) for row in files or () if row.earlier]
    if changed:
        gone = small_frame(spark, changed, "source_file string")
        replace_table(
            gone, batch_folder(lake.superseded, generation, batch), fmt=lake.fmt
        )
        before = read_runs(spark, lake, generation).where(
            (F.col(BATCH) < batch) & (F.col("bars") > 0)
        )
        lost = before.join(F.broadcast(gone), "source_file", "left_semi")
        lost = lost.select("source_file", "month").distinct()
        rows = rows.unionByName(lost.withColumn("bars", F.lit(0).cast("bigint")))
    rows = rows.withColumn("compacted", F.lit(compacted))
    symbols = _symbols(bars, lake, merged)
    for field, value in zip(StructType.fromDDL(SYMBOLS_DDL), symbols, strict=True):
        rows = rows.withColumn(field.name, F.lit(value).cast(field.dataType))
    replace_table(rows.coalesce(1), batch_folder(lake.runs, generation, batch), fmt=lake.fmt)
    if files is not None:
        now = _now()
        read = [(r.path, r.source_file, r.modified, r.length, now) for r in files]
        replace_table(
            small_frame(spark, read, f"{VERSIONS_DDL}, covered bigint"),
            batch_folder(lake.files, generation, batch),
            fmt=lake.fmt,
        )


def unique_key(lake: Lake) -> str:
    return ",".join(lake.key)


def _symbols(
    bars: DataFrame, lake: Lake, merged: bool
) -> tuple[str | None, str | None, str | None]:
    """The lake's key and the least and greatest symbol of a batch without copies, or
    else NULLs. A bar without a complete key may be a copy of any other."""
    if "symbol" not in lake.key:
        return None, None, None
    complete = reduce(and_, (F.col(name).isNotNull() for name in lake.key))
    copies = F.lit(1)
    if not merged:
        bars, copies = bars.groupBy(*lake.key).agg(F.count(F.lit(1)).alias("n")), F.col("n")
    found = bars.agg(
        F.max(F.when(complete, copies)).alias("copies"),
        F.min(complete).alias("complete"),
        F.min("symbol").alias("low"),
        F.max("symbol").alias("high"),
    )
    with run_once(bars.sparkSession):
        found = found.first()
    if found.copies != 1 or not found.complete:
        return None, None, None
    return unique_key(lake), found.low, found.high


def read_runs(spark: SparkSession, lake: Lake, generation: int) -> DataFrame:
    """``source_file``, ``month``, ``bars``, ``compacted`` and ``ingest_batch`` of the
    finished batches of a generation."""
    runs = read_if_written(spark, lake.runs, fmt=lake.fmt, schema=RUNS_DDL)
    if runs is None:
        runs = spark.createDataFrame([], RUNS_DDL)
    return runs.where(F.col(GENERATION) == generation).drop(GENERATION)


def stored_months(spark: SparkSession, lake: Lake, generation: int, limit: int) -> list[Row]:
    """All months with bars: ``month``, ``since`` (the batch it was last compacted in, or
    NULL) and ``last`` (its last batch). None if they are more than ``limit``."""
    runs = read_runs(spark, lake, generation).where("bars > 0")
    since = F.max(F.when(F.col("compacted"), F.col(BATCH))).alias("since")
    months = runs.groupBy("month").agg(since, F.max(BATCH).alias("last"))
    rows = months.limit(limit + 1).collect()
    return rows if len(rows) <= limit else []


def stored_parts(spark: SparkSession, lake: Lake, generation: int, limit: int) -> list[Row]:
    """For each month and batch with bars of it, what ``SYMBOLS_DDL`` names. None if they
    are more than ``limit``."""
    runs = read_runs(spark, lake, generation).where("bars > 0")
    names = StructType.fromDDL(SYMBOLS_DDL).names
    parts = runs.select("month", BATCH, *names).distinct()
    rows = parts.limit(limit + 1).collect()
    return rows if len(rows) <= limit else []


def has_torn_batch(spark: SparkSession, lake: Lake, generation: int) -> bool:
    """Whether silver has a batch without a record, of a run that is at work or has failed."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(generation_folder(lake.silver, generation))
    system = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [entry.getPath().getName() for entry in system.listStatus(folder)]
    written = {int(name.partition("=")[2]) for name in names if name.startswith(f"{BATCH}=")}
    recorded = read_runs(spark, lake, generation).select(BATCH).distinct().collect()
    return not written <= {row[BATCH] for row in recorded}


def newest_batch(spark: SparkSession, lake: Lake, generation: int) -> int | None:
    return read_runs(spark, lake, generation).agg(F.max(BATCH)).first()[0]


def without_superseded(
    spark: SparkSession, lake: Lake, generation: int, stored: DataFrame
) -> DataFrame:
    """Rows of ``stored`` but those that a later version of their file replaces."""
    changed = read_if_written(spark, lake.superseded, fmt=lake.fmt, schema=SUPERSEDED_DDL)
    if changed is None:
        return stored
    changed = changed.where(F.col(GENERATION) == generation)
    last = changed.groupBy(F.col("source_file").alias("_file")).agg(F.max(BATCH).alias("_since"))
    replaced = (F.col("source_file") == F.col("_file")) & (F.col(BATCH) < F.col("_since"))
    return stored.join(last, replaced, "left_anti")


# Retention


def retire(spark: SparkSession, lake: Lake, paths: Sequence[str]) -> None:
    """Note folders that new readers no longer need, to be removed by a later run."""
    if not paths:
        return
    rows = small_frame(spark, [(path, _now()) for path in paths], RETIRED_DDL)
    append_table(rows, lake.retired, fmt=lake.fmt)


def _now() -> int:
    return time.time_ns() // 1000


def sweep(spark: SparkSession, lake: Lake) -> list[str]:
    """Remove the folders that were retired ``lake.retention`` ago or earlier.

    A reader that began before they were retired has had that long to finish. Returns
    what was removed: a folder for each rebuild's table and each month compacted.
    """
    retired = read_if_written(spark, lake.retired, fmt=lake.fmt, schema=RETIRED_DDL)
    if retired is None:
        return []
    rows = [(row.path, row.retired) for row in retired.collect()]
    limit = _now() - int(lake.retention.total_seconds() * 1_000_000)
    due = [path for path, at in rows if at <= limit]
    if due:
        for path in due:
            remove_folder(spark, path)
        rest = [row for row in rows if row[0] not in set(due)]
        replace_table(small_frame(spark, rest, RETIRED_DDL), lake.retired, fmt=lake.fmt)
    return due
