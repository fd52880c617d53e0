"""The batch jobs: documents to silver, silver to gold.

Silver is written in *generations*. A rebuild from all documents writes a new one, in
batches from 0, and readers switch to it when its record, written last, is there: what was
deleted or repaired in bronze is then gone from silver and quarantine too. Batches that
``streaming.ingest_new`` adds belong to the generation that is current. A batch that
runs again replaces its own folder, and reading silver keeps the newest copy of each
bar, so no run can count a bar twice. Folders that a rebuild or a compaction replaces
stay for ``Lake.retention``, so that readers which have begun on them can finish.

Either job lists bronze once. Exactly the file versions of that listing are read, by
their paths, and recorded as covered (see ``plans.ledger``): a file that lands or changes
meanwhile is new to the next run.
"""

from __future__ import annotations

import datetime
from collections import defaultdict
from collections.abc import Iterator, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F

from barloom.operators.bars import (
    explode_bars,
    newest_copy,
    with_local_date,
    with_month,
    with_processed_at,
)
from barloom.operators.filters import trailing
from barloom.operators.metrics import (
    daily_rollup,
    finish_daily,
    finish_market,
    finish_symbol,
    merge_both,
    merge_rollups,
)
from barloom.operators.quality import REJECTED, quarantined, with_reason
from barloom.plans.lake import Lake
from barloom.plans.ledger import (
    BATCH,
    GENERATION,
    GENERATIONAL,
    PENDING_DDL,
    batch_folder,
    clear_generation,
    current_generation,
    generation_folder,
    has_torn_batch,
    listed_versions,
    newest_batch,
    open_generation,
    read_runs,
    record_run,
    retire,
    stored_months,
    stored_parts,
    sweep,
    unique_key,
    without_superseded,
)
from barloom.schemas import QUARANTINE_DDL, SILVER_DDL
from barloom.sources.documents import read_documents
from barloom.sources.tables import (
    read_if_written,
    read_table,
    remove_folder,
    replace_partitions,
    replace_table,
    small_frame,
)

ROLLUP = "daily_rollup"
# Per month: a rollup of each symbol, and of each of its dates.
MONTHS = "month_rollup"
# Which generation and batch gold is up to date with; replaced after each refresh.
PROGRESS = "progress"
PROGRESS_DDL = "generation int, ingest_batch int"
SILVER_ORDER = ("symbol", "datetime")
# Months that a refresh names one by one; if more changed, gold is rebuilt.
MAX_MONTHS = 1_200
# Months times batches whose symbols a reader compares; if there are more, it ranks them.
MAX_PARTS = 50_000
# Bytes and files of one batch, if the caller does not say otherwise.
MAX_BYTES, MAX_FILES = 256 * 2**30, 10_000


def silver_bars(documents: DataFrame, processed_at: Column | None = None) -> DataFrame:
    """Silver rows of a set of documents, still with repeated bars."""
    bars = with_month(with_local_date(explode_bars(documents)))
    return with_processed_at(bars, processed_at)


def _by_dates(rows: DataFrame) -> DataFrame:
    """Rows in ranges of date and symbol, for a write partitioned by month.

    This one shuffle brings the rows of a symbol and date together, for a grouping or
    a ranking by keys that include both, and leaves each task few months, so the
    write needs no rebalance of its own. Spark samples the ranges: a hot date is split
    by symbol.
    """
    return rows.repartitionByRange("date", "symbol")


def _dated(lake: Lake) -> bool:
    """Whether a bar's date and month follow from the key, which names its symbol."""
    return "symbol" in lake.key and bool({"datetime", "date"} & set(lake.key))


def write_silver_batch(
    bars: DataFrame, lake: Lake, generation: int, batch: int, *, rebalance: bool = True
) -> None:
    replace_table(
        bars,
        batch_folder(lake.silver, generation, batch),
        fmt=lake.fmt,
        partition_by=("month",),
        sort_by=SILVER_ORDER,
        rebalance=rebalance,
    )


def write_quarantine_batch(
    spark: SparkSession,
    documents: DataFrame | None,
    lake: Lake,
    generation: int,
    batch: int,
    processed_at: Column | None = None,
) -> None:
    """Replace a batch's defects. ``documents`` are all defective; None if there are none."""
    path = batch_folder(lake.quarantine, generation, batch)
    if documents is None:
        remove_folder(spark, path)
        return
    rows = with_processed_at(quarantined(documents), processed_at)
    replace_table(rows, path, fmt=lake.fmt)


def write_batch(
    spark: SparkSession,
    files: Sequence[Row],
    lake: Lake,
    generation: int,
    batch: int,
    *,
    processed_at: Column | None = None,
    merge_copies: bool = False,
) -> None:
    """The documents of some files to one batch of silver and quarantine, and its record.

    The JSON is parsed straight into silver; defects are counted on the way, and only if
    there are any the files are read again, for quarantine. Nothing else is written.
    """
    raw = read_documents(
        spark, [row.path for row in files], glob=lake.glob, multi_line=lake.multi_line
    )
    documents = with_reason(raw).withColumn("reason", F.coalesce("reason", F.lit("none")))
    defective = F.col("reason") != "none"
    defects = Observation()
    seen = documents.observe(defects, F.max(defective).alias("any"))
    bars = silver_bars(seen.where(~F.col("reason").isin(*REJECTED)), processed_at)
    placed = merge_copies and _dated(lake)
    if placed:
        bars = newest_copy(_by_dates(bars), key=lake.key, implied=("date", "month"))
    elif merge_copies:
        bars = newest_copy(bars, key=lake.key)
    write_silver_batch(bars, lake, generation, batch, rebalance=not placed)
    # NULL if there are no documents at all.
    found = documents.where(defective) if defects.get.get("any", True) else None
    write_quarantine_batch(spark, found, lake, generation, batch, processed_at)
    # The first batch of a rebuild has no earlier ones to be compared with.
    compacted = merge_copies and batch == 0
    record_run(
        spark, lake, generation, batch, files, compacted=compacted, merged=merge_copies
    )


def file_batches(
    found: DataFrame, lake: Lake, max_bytes: int, max_files: int
) -> Iterator[list[Row]]:
    """File versions in order of their paths, one batch after another.

    ``found`` is evaluated once. No more than ``max_files`` rows are on the driver at a
    time; a longer backlog is written down first.
    """
    rows = found.limit(max_files + 1).collect()
    pending = None
    if len(rows) > max_files:
        replace_table(found, lake.pending, fmt=lake.fmt)
        pending = read_table(found.sparkSession, lake.pending, fmt=lake.fmt, schema=PENDING_DDL)
        rows = pending.orderBy("path").limit(max_files).collect()
    while rows:
        batch, size = [], 0
        for row in sorted(rows, key=lambda row: row.path):
            if batch and size + row.length > max_bytes:
                yield batch
                batch, size = [], 0
            batch.append(row)
            size += row.length
        yield batch
        if pending is None:
            return
        rest = pending.where(F.col("path") > batch[-1].path)
        rows = rest.orderBy("path").limit(max_files).collect()


def bronze_to_silver(
    spark: SparkSession,
    lake: Lake,
    *,
    max_bytes_per_batch: int = MAX_BYTES,
    max_files_per_batch: int = MAX_FILES,
    processed_at: Column | None = None,
) -> bool:
    """Rebuild silver from all documents. Returns False if there are none.

    The rebuild is a new generation, which nobody reads before it is complete. The one
    before it is retired then.
    """
    sweep(spark, lake)
    before = current_generation(spark, lake)
    generation = 0 if before is None else before + 1
    found = listed_versions(spark, lake).withColumn("earlier", F.lit(False))
    batch = -1
    for files in file_batches(found, lake, max_bytes_per_batch, max_files_per_batch):
        if batch < 0:
            if len(files) < max_files_per_batch and not any(row.length for row in files):
                return False
            clear_generation(spark, lake, generation)
        batch += 1
        write_batch(
            spark, files, lake, generation, batch, processed_at=processed_at, merge_copies=True
        )
    if batch < 0:
        return False
    open_generation(spark, lake, generation)
    if before is not None:
        tables = (getattr(lake, name) for name in GENERATIONAL)
        retire(spark, lake, [generation_folder(path, before) for path in tables])
    return True


def _stored_silver(spark: SparkSession, lake: Lake) -> DataFrame | None:
    """Silver of the current generation with every copy of a bar, but none from a file's
    earlier versions."""
    generation = current_generation(spark, lake)
    if generation is None:
        return None
    path = generation_folder(lake.silver, generation)
    stored = read_if_written(spark, path, fmt=lake.fmt, schema=SILVER_DDL)
    return None if stored is None else without_superseded(spark, lake, generation, stored)


def read_silver(spark: SparkSession, lake: Lake) -> DataFrame:
    """Silver with the newest copy of each bar; empty if it was never written.

    Filters on ``symbol``, ``date`` and ``month`` reach the scan.
    """
    stored = _stored_silver(spark, lake)
    if stored is None:
        return spark.createDataFrame([], SILVER_DDL).drop(BATCH)
    return _newest(stored, lake, current_generation(spark, lake))


def read_trailing(spark: SparkSession, lake: Lake, code: str) -> DataFrame:
    """The last ``code`` ("5d", "1mo") of silver, counted from its newest bar.

    The newest time is taken from the stored rows of the newest month with bars, which
    the records of the batches name: all copies of a bar have the same time. Only if
    later versions of files have emptied that month, all months are looked at.
    """
    stored = _stored_silver(spark, lake)
    if stored is None:
        return read_silver(spark, lake)
    runs = read_runs(spark, lake, current_generation(spark, lake))
    last = runs.where("bars > 0").agg(F.max("month")).first()[0]
    newest = stored.where(F.col("month") == F.lit(last)).agg(F.max("datetime")).first()[0]
    if newest is None:
        newest = stored.agg(F.max("datetime")).first()[0]
    bars = _newest(stored, lake, current_generation(spark, lake))
    return trailing(bars, code, newest=F.lit(newest))


def read_quarantine(spark: SparkSession, lake: Lake) -> DataFrame:
    """Defective documents of the current generation, in their files' last versions."""
    generation = current_generation(spark, lake)
    stored = None
    if generation is not None:
        path = generation_folder(lake.quarantine, generation)
        stored = read_if_written(spark, path, fmt=lake.fmt, schema=QUARANTINE_DDL)
    if stored is None:
        return spark.createDataFrame([], QUARANTINE_DDL).drop(BATCH)
    # A run that failed before its files were recorded has left what the next one reads again.
    last = stored.groupBy("source_file").agg(F.max(BATCH).alias(BATCH))
    stored = stored.join(last, ["source_file", BATCH], "left_semi")
    return without_superseded(spark, lake, generation, stored).drop(BATCH)


def fragmented_months(spark: SparkSession, lake: Lake, *, min_batches: int = 8) -> list:
    """Months whose bars lie in at least ``min_batches`` batches, since they were last
    compacted; ``MAX_MONTHS`` of them at most, the most fragmented ones."""
    generation = current_generation(spark, lake)
    if generation is None:
        return []
    runs = read_runs(spark, lake, generation).where("bars > 0")
    since = F.coalesce(F.max(F.when(F.col("compacted"), F.col(BATCH))), F.lit(-1))
    last = runs.groupBy(F.col("month").alias("_month")).agg(since.alias("_since"))
    later = runs.join(
        last, F.col("month").eqNullSafe(F.col("_month")) & (F.col(BATCH) >= F.col("_since"))
    )
    counts = later.groupBy("month").agg(F.count_distinct(BATCH).alias("batches"))
    many = counts.where(F.col("batches") >= min_batches).orderBy(F.desc("batches"), "month")
    return [row.month for row in many.limit(MAX_MONTHS).collect()]


def compact_silver(
    spark: SparkSession, lake: Lake, months: Sequence[datetime.date | None]
) -> None:
    """Bring all batches' bars of the given months together in one new batch.

    Only the newest copies are written. The older folders of these months are retired: a
    reader that still finds them prefers the new batch's copies, which are the same bars.
    """
    sweep(spark, lake)
    generation = current_generation(spark, lake)
    if generation is None or not months:
        return
    batch = newest_batch(spark, lake, generation) + 1
    # From the records: every folder that has bars of these months.
    runs = read_runs(spark, lake, generation).where(F.col("bars") > 0)
    folders = runs.where(_in_months(months)).select(BATCH, "month").distinct().collect()
    bars = _newest(_stored_silver(spark, lake).where(_in_months(months)), lake, generation)
    write_silver_batch(bars, lake, generation, batch)
    record_run(spark, lake, generation, batch, None, compacted=True, merged=True)
    retire(
        spark,
        lake,
        [
            f"{batch_folder(lake.silver, generation, row[BATCH])}/month={row.month or _NULL_FOLDER}"
            for row in folders
        ],
    )


# How a partitioned table names the folder of NULL.
_NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"


def _newest(stored: DataFrame, lake: Lake, generation: int) -> DataFrame:
    """The newest copy of each bar. Of two readings of one file the later one counts.

    Months that lie in one batch since they were compacted (or rebuilt) hold no copies:
    they are read as they are, without an exchange, and so is a batch that has no copies
    itself and symbols that lie apart from those of the month's other batches. Only the
    others are ranked, by a window, and batches from before a month's last compaction are
    not read. Date and month follow from the key; as window keys they let filters through.

    While there is a batch without a record, nothing is known of what it has copies of.
    """
    recency = ("ingested_at", "processed_at", BATCH, "source_file")

    def ranked(rows: DataFrame) -> DataFrame:
        return newest_copy(rows, key=lake.key, recency=recency, implied=("date", "month"))

    # A bar's month follows from its time, not from a key of symbols alone.
    if not {"datetime", "date"} & set(lake.key):
        return ranked(stored).drop(BATCH)
    spark = stored.sparkSession
    months = stored_months(spark, lake, generation, MAX_MONTHS)
    torn = has_torn_batch(spark, lake, generation)
    parts = defaultdict(list)
    for part in stored_parts(spark, lake, generation, MAX_PARTS) if months and not torn else ():
        parts[part.month].append(part)

    # Of the folders that are read: what batches, and the months for which it is these.
    plain, copies = defaultdict(list), defaultdict(list)
    for row in months:
        since = -1 if row.since is None else row.since
        if row.last == since and not torn:
            plain[frozenset([since])].append(row.month)
            continue
        alone, others = _apart([p for p in parts[row.month] if p[BATCH] >= since], lake)
        if alone:
            plain[alone].append(row.month)
        if alone and others:
            copies[others].append(row.month)
        if not alone:
            copies[since].append(row.month)
    if not plain and set(copies) <= {-1}:
        return ranked(stored).drop(BATCH)

    def rows_of(some: Mapping[frozenset[int] | int, list]) -> DataFrame:
        """A static choice of folders: some batches, or all from one on."""
        chosen = F.lit(False)
        for batches, named in some.items():
            of = F.col(BATCH)
            of = of >= batches if isinstance(batches, int) else of.isin(sorted(batches))
            chosen = chosen | (_in_months(named) & of)
        return stored.where(F.coalesce(chosen, F.lit(False)))

    if not copies:
        return rows_of(plain).drop(BATCH)
    if not plain:
        return ranked(rows_of(copies)).drop(BATCH)
    return rows_of(plain).unionByName(ranked(rows_of(copies))).drop(BATCH)


def _apart(parts: Sequence[Row], lake: Lake) -> tuple[frozenset[int], frozenset[int]]:
    """Of a month's batches those that share no key with another and have no copies
    themselves, and the others. Nothing is known of a batch that may have copies."""
    batches = frozenset(part[BATCH] for part in parts)
    if any(part.unique_key != unique_key(lake) for part in parts):
        return frozenset(), batches
    groups, reach = [], None
    for part in sorted(parts, key=lambda part: part.low):
        if reach is None or part.low > reach:
            groups.append([])
            reach = part.high
        groups[-1].append(part[BATCH])
        reach = max(reach, part.high)
    alone = frozenset(group[0] for group in groups if len(group) == 1)
    return alone, batches - alone


def _in_months(months: Sequence[datetime.date | None]) -> Column:
    """A static list of partition values, so only those folders are read.

    Bars without a valid time are in the NULL partition.
    """
    listed = F.col("month").isin([month for month in months if month is not None])
    return listed | F.col("month").isNull() if None in months else listed


def changed_months(spark: SparkSession, lake: Lake, *, after_batch: int) -> list | None:
    """Months that batches later than ``after_batch`` have changed, from their records.

    They have bars there, or have superseded a file that had. None if there are more than ``MAX_MONTHS``: garbage times may name any month of
    9,999 years.
    """
    runs = read_runs(spark, lake, current_generation(spark, lake))
    later = runs.where((F.col(BATCH) > after_batch) & F.col("source_file").isNotNull())
    months = [row.month for row in later.select("month").distinct().limit(MAX_MONTHS + 1).collect()]
    return months if len(months) <= MAX_MONTHS else None


def _record_progress(spark: SparkSession, lake: Lake, generation: int, batch: int) -> None:
    row = small_frame(spark, [(generation, batch)], PROGRESS_DDL)
    replace_table(row, lake.gold_table(PROGRESS), fmt=lake.fmt)


def _progress(spark: SparkSession, lake: Lake) -> tuple[int, int] | None:
    """The generation and last batch gold contains; None if gold is not complete."""
    path = lake.gold_table(PROGRESS)
    stored = read_if_written(spark, path, fmt=lake.fmt, schema=PROGRESS_DDL)
    row = None if stored is None else stored.first()
    return None if row is None else (row[GENERATION], row[BATCH])


def _daily(rollups: DataFrame, processed_at: Column | None, scale: int | None) -> DataFrame:
    return with_month(with_processed_at(finish_daily(rollups, scale=scale), processed_at))


def _merge_months(rollups: DataFrame, scale: int | None) -> DataFrame:
    """The level between days and all time: each month's symbols, and each month's dates."""
    return merge_both(rollups, within=("month",), scale=scale)


def _replace_all_time(
    spark: SparkSession, lake: Lake, processed_at: Column | None, scale: int | None
) -> None:
    """The tables that cover all symbols or dates, from the stored rollups of the months:
    one row per symbol and month, or per date."""
    stored = read_table(spark, lake.gold_table(MONTHS), fmt=lake.fmt)
    per_month, per_date = (stored.where(F.col("level") == name) for name in ("symbol", "date"))
    per_symbol = merge_rollups(per_month, ["symbol"], scale=scale)
    for name, frame in (
        ("symbol_metrics", finish_symbol(per_symbol, scale=scale)),
        ("market_metrics", finish_market(per_date, scale=scale)),
    ):
        replace_table(
            with_processed_at(frame, processed_at), lake.gold_table(name), fmt=lake.fmt
        )


def silver_to_gold(
    spark: SparkSession,
    lake: Lake,
    *,
    processed_at: Column | None = None,
    scale: int | None = None,
) -> bool:
    """Rebuild all gold tables. Returns False if silver is empty or not there.

    Silver is read once, into the daily rollup. That table is written out, and
    the three metric tables are computed from it.
    """
    # The batch is named before silver is read: what comes meanwhile is refreshed later.
    generation = current_generation(spark, lake)
    batch = None if generation is None else newest_batch(spark, lake, generation)
    silver = _stored_silver(spark, lake)
    if silver is None or silver.isEmpty():
        return False
    layout = {"fmt": lake.fmt, "partition_by": ("month",), "sort_by": ("symbol",)}
    rollups = with_month(daily_rollup(_by_dates(_newest(silver, lake, generation)), scale=scale))
    replace_table(rollups, lake.gold_table(ROLLUP), rebalance=False, **layout)
    stored = read_table(spark, lake.gold_table(ROLLUP), fmt=lake.fmt)
    daily = _daily(stored, processed_at, scale)
    replace_table(daily, lake.gold_table("daily_metrics"), rebalance=False, **layout)
    replace_table(_merge_months(stored, scale), lake.gold_table(MONTHS), **layout)
    _replace_all_time(spark, lake, processed_at, scale)
    _record_progress(spark, lake, generation, batch)
    return True


def refresh_gold(
    spark: SparkSession,
    lake: Lake,
    months: Sequence[datetime.date | None],
    *,
    processed_at: Column | None = None,
    scale: int | None = None,
) -> None:
    """Bring gold up to date after bars of the given months changed.

    Only those months of silver are read, and only those partitions of the daily tables
    and of the months' rollups are replaced; a month that has no bars any more loses its
    partitions. The symbol and market tables cover all time; they are merged from the
    months' rollups, with one row per symbol and month, not from the days.
    """
    if not months:
        return
    layout = {"fmt": lake.fmt, "partition_by": ("month",), "sort_by": ("symbol",)}
    silver = _stored_silver(spark, lake).where(_in_months(months))
    bars = _newest(silver, lake, current_generation(spark, lake))
    rollups = with_month(daily_rollup(_by_dates(bars), scale=scale))
    emptied = _emptied_months(spark, lake, months)
    for name in (ROLLUP, "daily_metrics", MONTHS):
        for month in emptied:
            remove_folder(spark, f"{lake.gold_table(name)}/month={month or _NULL_FOLDER}")
    replace_partitions(rollups, lake.gold_table(ROLLUP), rebalance=False, **layout)
    stored = read_table(spark, lake.gold_table(ROLLUP), fmt=lake.fmt).where(_in_months(months))
    daily = _daily(stored, processed_at, scale)
    replace_partitions(daily, lake.gold_table("daily_metrics"), rebalance=False, **layout)
    replace_partitions(_merge_months(stored, scale), lake.gold_table(MONTHS), **layout)
    _replace_all_time(spark, lake, processed_at, scale)


def _emptied_months(spark: SparkSession, lake: Lake, months: Sequence) -> list:
    """Of the given months, those that later versions of files have left without a bar."""
    runs = read_runs(spark, lake, current_generation(spark, lake))
    lost = runs.where((F.col("bars") == 0) & F.col("source_file").isNotNull())
    lost = lost.where(_in_months(months)).select("month").distinct()
    candidates = [row.month for row in lost.collect()]
    if not candidates:
        return []
    there = _stored_silver(spark, lake).where(_in_months(candidates)).select("month").distinct()
    kept = {row.month for row in there.collect()}
    return [month for month in candidates if month not in kept]


def update_gold(
    spark: SparkSession,
    lake: Lake,
    *,
    processed_at: Column | None = None,
    scale: int | None = None,
) -> None:
    """Refresh gold with the batches ingested since it was last brought up to date.

    After a rebuild of silver gold is rebuilt too. Progress is recorded last, and
    refreshing again is harmless, so a run that fails half way is made good by the next
    one. Without silver nothing is done.
    """
    generation, done = current_generation(spark, lake), _progress(spark, lake)
    if generation is None:
        return
    newest = newest_batch(spark, lake, generation)
    months = None
    if done is not None and done[0] == generation:
        if newest == done[1]:
            return
        months = changed_months(spark, lake, after_batch=done[1])
    if months is None:
        silver_to_gold(spark, lake, processed_at=processed_at, scale=scale)
        return
    refresh_gold(spark, lake, months, processed_at=processed_at, scale=scale)
    _record_progress(spark, lake, generation, newest)
