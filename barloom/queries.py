"""The operators on the given tables, one query per operator.

Bars are read from ``lineitem`` (one bar per line, a symbol per supplier) and
ticks from ``events`` (a symbol per event type). Queries about documents first
pack those bars into documents and land them in scratch storage.
"""

from __future__ import annotations

import datetime
from collections.abc import Callable
from functools import wraps
from itertools import zip_longest

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.functions.time import epoch_text, month_of, run_key
from barloom.operators import bars as b
from barloom.operators import filters, metrics
from barloom.operators.pack import pack_documents
from barloom.plans.lake import Lake
from barloom.plans.medallion import (
    bronze_to_silver,
    read_quarantine,
    read_silver,
    silver_to_gold,
    update_gold,
)
from barloom.scratch import scratch_folder
from barloom.session import apply_runtime_conf
from barloom.sources.documents import land_documents, list_documents, read_documents
from barloom.sources.tables import (
    append_table,
    read_gold,
    read_table,
    register_views,
    remove_folder,
    replace_table,
)
from barloom.streaming.ingest import ingest_new

Query = Callable[[SparkSession, str], DataFrame]

# Decimals of the prices in the given tables: two, times two rates of two.
SCALE = 6
SYMBOL = "S1"
LOOKUP_DATE = datetime.date(1998, 1, 5)
SPLIT_DATE = datetime.date(1998, 1, 1)
ZONES = ("America/New_York", "Europe/London", "Asia/Tokyo", "Australia/Sydney")
# Documents of a landing run are compressed.
LANDED = {"compression": "gzip"}
LANDED_GLOB = "*.json.gz"

REGISTRY: dict[str, Query] = {}


def query(function: Query) -> Query:
    """Register a query under its name, with the settings it is written for."""

    @wraps(function)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return function(apply_runtime_conf(spark), sf_dir)

    REGISTRY[function.__name__] = run
    return run


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def line_bars(spark: SparkSession, sf_dir: str, *extra: str) -> DataFrame:
    """One bar per order line. (symbol, datetime) repeats."""
    price, tax, discount = F.col("l_extendedprice"), F.col("l_tax"), F.col("l_discount")
    return _table(spark, sf_dir, "lineitem").select(
        F.concat(F.lit("S"), "l_suppkey").alias("symbol"),
        F.col("l_shipdate").cast("timestamp").alias("datetime"),
        F.col("l_shipdate").cast("date").alias("date"),
        price.alias("open"),
        (price * (1 + tax)).alias("high"),
        (price * (1 - discount)).alias("low"),
        (price * (1 - discount) * (1 + tax)).alias("close"),
        F.col("l_quantity").cast("bigint").alias("volume"),
        *extra,
    )


def daily_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One bar per symbol and day, with the metadata a document carries."""
    lines = line_bars(spark, sf_dir, "l_returnflag")
    return lines.groupBy("symbol", "date").agg(
        F.min("datetime").alias("datetime"),
        F.min("open").alias("open"),
        F.max("high").alias("high"),
        F.min("low").alias("low"),
        F.max("close").alias("close"),
        F.sum("volume").alias("volume"),
        F.max("close").alias("adjclose"),
        F.min("l_returnflag").alias("grade"),
    )


def ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "events").select(
        F.col("event_type").alias("symbol"), "ts", "event_id", F.col("value").alias("price")
    )


def _with_meta(bars: DataFrame) -> DataFrame:
    return bars.withColumns(
        {
            "currency": F.lit("USD"),
            "exchange": F.concat(F.lit("X"), F.substring("symbol", -1, 1)),
            "exchange_timezone": F.lit(ZONES[0]),
        }
    )


def _land(spark: SparkSession, bars: DataFrame, name: str) -> str:
    """Land one run of documents per month of the bars."""
    path = scratch_folder(spark, name)
    runs = bars.withColumn("run", run_key(month_of(F.col("date")).cast("timestamp")))
    land_documents(pack_documents(runs, by=["run"]), path, partition_by=["run"])
    return path


def _prices(df: DataFrame, *keys: str) -> DataFrame:
    return df.select(*keys, "open", "high", "low", "close", "volume")


# Aggregations


@query
def daily_metrics(spark, sf_dir):
    return metrics.daily_metrics(line_bars(spark, sf_dir), scale=SCALE)


@query
def symbol_metrics(spark, sf_dir):
    return metrics.symbol_metrics(line_bars(spark, sf_dir), scale=SCALE)


@query
def market_metrics(spark, sf_dir):
    return metrics.market_metrics(line_bars(spark, sf_dir), scale=SCALE)


@query
def mean_of_daily_close(spark, sf_dir):
    daily = metrics.daily_metrics(line_bars(spark, sf_dir), scale=SCALE)
    return metrics.mean_of_daily_close(daily, exact=True)


@query
def weighted_close(spark, sf_dir):
    rollups = metrics.daily_rollup(line_bars(spark, sf_dir), scale=SCALE)
    return metrics.weighted_close(rollups, scale=SCALE)


@query
def silver_count(spark, sf_dir):
    return filters.row_count(line_bars(spark, sf_dir))


# Filters, sorts, limits


@query
def symbol_series(spark, sf_dir):
    """The filter is the operator: one symbol's daily means in time order."""
    daily = metrics.daily_metrics(line_bars(spark, sf_dir), scale=SCALE)
    return filters.symbol_series(daily, SYMBOL).select("symbol", "date", "avg_close")


@query
def symbol_day_lookup(spark, sf_dir):
    """The filter is the operator: one symbol on one date."""
    daily = metrics.daily_metrics(line_bars(spark, sf_dir), scale=SCALE)
    return filters.symbol_on_date(daily, SYMBOL, LOOKUP_DATE)


@query
def date_lookup(spark, sf_dir):
    """The filter is the operator: all symbols on one date."""
    return _prices(filters.on_date(line_bars(spark, sf_dir), LOOKUP_DATE), "symbol", "date")


@query
def top5_preview(spark, sf_dir):
    """The limit is the operator: a stable preview of five rows."""
    rows = _prices(line_bars(spark, sf_dir), "symbol", "date")
    order = [F.desc("close"), "symbol", "date", "open", "high", "low", "volume"]
    return rows.orderBy(*order).limit(5)


@query
def trailing_range(spark, sf_dir):
    return filters.trailing(ticks(spark, sf_dir), "7d", time="ts")


# Bars


@query
def latest_bar(spark, sf_dir):
    """Every tick twice, the second time corrected; the correction wins."""
    first = ticks(spark, sf_dir).withColumn("version", F.lit(1))
    second = first.withColumns({"price": F.col("price") * 2, "version": F.lit(2)})
    return b.newest_copy(first.unionByName(second), key=("symbol", "ts"), recency=("version",))


def _resampled(spark, sf_dir, interval):
    return b.resample(
        ticks(spark, sf_dir), interval, time="ts", tie_breaker="event_id"
    ).withColumn("bar_start", F.col("bar_start").cast("timestamp_ntz"))


@query
def bars_hourly(spark, sf_dir):
    return _resampled(spark, sf_dir, "1h")


@query
def bars_daily(spark, sf_dir):
    return _resampled(spark, sf_dir, "1d")


@query
def bars_weekly(spark, sf_dir):
    return _resampled(spark, sf_dir, "1wk")


@query
def bars_from_hourly(spark, sf_dir):
    """Daily bars from stored hourly ones, and weekly bars from these."""
    path = scratch_folder(spark, "hourly")
    hourly = b.resample(
        ticks(spark, sf_dir), "1h", time="ts", tie_breaker="event_id", mergeable=True
    )
    replace_table(hourly, path)
    daily = b.coarsen(read_table(spark, path, schema=hourly.schema), "1h", "1d")
    weekly = b.coarsen(daily, "1d", "1wk")
    both = daily.withColumn("interval", F.lit("1d")).unionByName(
        weekly.withColumn("interval", F.lit("1wk"))
    )
    return both.drop("open_at", "close_at").withColumn(
        "bar_start", F.col("bar_start").cast("timestamp_ntz")
    )


@query
def local_trade_date(spark, sf_dir):
    """Bars per UTC date and date at the exchange, each row in its own zone."""
    zone = F.element_at(F.array(*map(F.lit, ZONES)), (F.col("user_id") % 4 + 1).cast("int"))
    rows = _table(spark, sf_dir, "events").select(
        F.col("ts").cast("timestamp").alias("datetime"),
        F.col("ts").cast("date").alias("date"),
        zone.alias("exchange_timezone"),
    )
    keys = ("exchange_timezone", "date", "local_date")
    return b.with_local_date(rows).groupBy(*keys).agg(F.count("*").alias("bars"))


# Documents


@query
def bronze_roundtrip(spark, sf_dir):
    """Lines to documents and back: every bar returns, at its own position."""
    bars = line_bars(spark, sf_dir).withColumn("adjclose", F.col("close"))
    path = _land(spark, bars, "roundtrip")
    epoch = F.unix_seconds("datetime")
    returned = b.explode_bars(read_documents(spark, path))
    return _prices(
        returned.withColumns({"epoch": epoch, "datetime_text": epoch_text(epoch)}),
        "symbol",
        "date",
        "epoch",
        "datetime_text",
        "adjclose",
    )


@query
def bronze_metadata(spark, sf_dir):
    path = _land(spark, _with_meta(line_bars(spark, sf_dir)), "metadata")
    rows = b.explode_metadata(read_documents(spark, path))
    return rows.select(
        "symbol",
        "currency",
        "exchange",
        "exchange_timezone",
        "timestamp",
        F.col("source_file").endswith(".json").alias("has_source"),
    )


@query
def bronze_listing(spark, sf_dir):
    """The landing runs found on disk, one per month of the bars."""
    path = _land(spark, line_bars(spark, sf_dir), "listing")
    files = list_documents(spark, path)
    run = F.regexp_extract("path", "/run=([^/]+)/", 1)
    return files.groupBy(run.alias("run")).agg(
        F.min(F.col("path").endswith(".json") & (F.col("length") > 0)).alias("complete")
    )


@query
def quarantine(spark, sf_dir):
    """Damage some documents, add errors, repair some, and see where each of them goes.

    Documents of grade A lose their last character, those of grade R the last
    element of ``open``, in those of grade N the first element is no number or, for
    every second supplier, a time is beyond all calendars. Every supplier adds a
    document with an error. All bars of documents that are not malformed must be in
    silver. Malformed documents of suppliers that end in 0 are repaired before silver
    is built again.
    """
    lake = Lake(scratch_folder(spark, "quarantine"), glob="*.txt")
    packed = pack_documents(daily_bars(spark, sf_dir), by=["grade"])
    text = F.to_json(F.struct("chart"), {"ignoreNullFields": "false"})
    even = F.col("symbol").rlike("[02468]$")
    repaired = F.col("symbol").endswith("0")
    cut = text.substr(F.lit(1), F.length(text) - 1)

    def damaged(malformed):
        return (
            F.when(F.col("grade") == "A", malformed)
            .when(
                F.col("grade") == "R",
                F.regexp_replace(text, r',?[^,\[\]]*\],"high"', r'],"high"'),
            )
            .when(even, F.regexp_replace(text, r'"open":\[[^,\]]*', r'"open":[NaN'))
            .otherwise(F.regexp_replace(text, r'"timestamp":\[', r'"timestamp":[999999999999999,'))
        )

    failed = F.concat(
        F.lit('{"chart":{"result":null,"error":{"code":"Not Found","symbol":"S'),
        F.col("s_suppkey"),
        F.lit('"}}}'),
    )
    errors = _table(spark, sf_dir, "supplier").select(failed.alias("value"))
    for malformed in (cut, F.when(repaired, text).otherwise(cut)):
        landed = packed.select(damaged(malformed).alias("value")).unionByName(errors)
        landed.write.mode("overwrite").text(lake.bronze)
        bronze_to_silver(spark, lake)
    named = F.coalesce(
        "symbol",
        F.get_json_object("error", "$.symbol"),
        F.regexp_extract("raw_text", '"symbol":"([^"]*)"', 1),
    )
    aside = read_quarantine(spark, lake).select(named.alias("symbol"), "reason").distinct()
    kept = read_silver(spark, lake).groupBy("symbol").agg(F.count("datetime").alias("bars"))
    return aside.withColumn("bars", F.lit(0).cast("bigint")).unionByName(
        kept.withColumn("reason", F.lit("none"))
    )


# Tables


@query
def silver_append(spark, sf_dir):
    """Two appends to one table, read back."""
    path = scratch_folder(spark, "append")
    bars = b.with_month(line_bars(spark, sf_dir))
    for part in (F.col("date") < F.lit(SPLIT_DATE), F.col("date") >= F.lit(SPLIT_DATE)):
        append_table(bars.where(part), path, partition_by=["month"], sort_by=["symbol"])
    return _prices(read_table(spark, path), "symbol", "date", "month")


def _stale_and_new(bars):
    """Bars that arrive first, some of them wrong, and bars that arrive later."""
    early = F.col("date") < F.lit(SPLIT_DATE)
    wrong = F.year("date") == SPLIT_DATE.year - 1
    stale = bars.where(early).withColumn("close", F.when(wrong, F.lit(0.0)).otherwise(F.col("close")))
    return stale, bars.where(wrong | ~early)


def _land_run(bars, lake, run):
    documents = pack_documents(bars.withColumn("run", F.lit(run)), by=["run"])
    land_documents(documents, lake.bronze, partition_by=["run"], rebalance=False, **LANDED)


def _ingest_twice(spark, bars, name, after_first=None):
    lake = Lake(scratch_folder(spark, name), glob=LANDED_GLOB)
    stale, new = _stale_and_new(bars)
    _land_run(stale, lake, "19980101_000000")
    ingest_new(spark, lake)
    if after_first is not None:
        after_first(lake)
    _land_run(new, lake, "20020101_000000")
    ingest_new(spark, lake)
    return lake


def _age(spark, path, days):
    """Set the times of all files below ``path`` back."""
    jvm = spark._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    system = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    files = system.listFiles(folder, True)
    while files.hasNext():
        status = files.next()
        time = status.getModificationTime() - days * 86_400_000
        system.setTimes(status.getPath(), time, -1)


def _rewrite(spark, path, source):
    """Put the files of ``source`` in the place of those of ``path``, under their names.

    There may be fewer or more of them: a file for which there is none loses its documents,
    and one that has no place there keeps its own name.
    """
    jvm = spark._jvm
    system = jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())

    def files(folder):
        found = system.listStatus(jvm.org.apache.hadoop.fs.Path(folder))
        paths = [status.getPath() for status in found if not status.getPath().getName().startswith(("_", "."))]
        return sorted(paths, key=lambda p: p.toString())

    for old, new in zip_longest(files(path), files(source)):
        if old is None:
            system.rename(new, jvm.org.apache.hadoop.fs.Path(path, new.getName()))
            continue
        system.delete(old, False)
        if new is None:
            # Not an empty file: a listing leaves these out.
            jvm.java.util.zip.GZIPOutputStream(system.create(old)).close()
        else:
            system.rename(new, old)


@query
def incremental_ingest(spark, sf_dir):
    """Four landings and five runs: each version of a file is read once, corrections win.

    The third landing has bars of its own, in files older than all others, under wrong
    symbols. The fourth rewrites these files, under their names.
    """
    # All landings are made of the same bars: these are grouped once.
    stored = scratch_folder(spark, "bars")
    grouped = daily_bars(spark, sf_dir)
    replace_table(grouped, stored)
    bars = read_table(spark, stored, schema=grouped.schema)
    lake = _ingest_twice(spark, bars, "incremental")
    ingest_new(spark, lake)
    landed = []
    for prefix, root in (("W", lake.bronze), ("L", scratch_folder(spark, "rewritten"))):
        more = bars.withColumn("symbol", F.concat(F.lit(prefix), "symbol"))
        land_documents(pack_documents(more), f"{root}/rewritten", **LANDED)
        landed.append(f"{root}/rewritten")
        if prefix == "W":
            _age(spark, landed[0], 30)
        else:
            remove_folder(spark, stored)
            _rewrite(spark, *landed)
        ingest_new(spark, lake)
    return _prices(read_silver(spark, lake), "symbol", "date")


@query
def silver_date_lookup(spark, sf_dir):
    """One date of silver after two landings; only its month is read."""
    lake = _ingest_twice(spark, daily_bars(spark, sf_dir), "lookup")
    return _prices(filters.on_date(read_silver(spark, lake), LOOKUP_DATE), "symbol", "date")


@query
def gold_partition_overwrite(spark, sf_dir):
    """Gold after a refresh of only the months the second landing touched."""
    lake = _ingest_twice(
        spark,
        daily_bars(spark, sf_dir),
        "refresh",
        lambda lake: update_gold(spark, lake, scale=SCALE),
    )
    update_gold(spark, lake, scale=SCALE)
    return read_gold(spark, lake.gold).daily_metrics.drop("month", "processed_at")


@query
def medallion(spark, sf_dir):
    """Documents to silver to gold, from the stored symbol and market tables."""
    lake = Lake(scratch_folder(spark, "medallion"), glob=LANDED_GLOB)
    _land_run(daily_bars(spark, sf_dir), lake, "20020101_000000")
    bronze_to_silver(spark, lake)
    silver_to_gold(spark, lake, scale=SCALE)
    gold = read_gold(spark, lake.gold)
    per_symbol = gold.symbol_metrics.select(
        F.lit("symbol").alias("level"), F.col("symbol").alias("key"), "avg_close", "avg_volume"
    )
    per_date = gold.market_metrics.select(
        F.lit("date").alias("level"),
        F.col("date").cast("string").alias("key"),
        F.col("market_avg_close").alias("avg_close"),
        F.col("market_avg_volume").alias("avg_volume"),
    )
    return per_symbol.unionByName(per_date)


@query
def gold_replace(spark, sf_dir):
    """A table replaced as a whole: nothing of the first version is left."""
    path = scratch_folder(spark, "replace")
    bars = line_bars(spark, sf_dir)
    replace_table(metrics.symbol_metrics(bars.withColumn("symbol", F.lit("old"))), path)
    replace_table(metrics.symbol_metrics(bars, scale=SCALE), path)
    return read_table(spark, path)


VIEW_SQL = """
SELECT d.symbol, d.date, d.avg_close, m.market_avg_close
FROM daily_metrics d JOIN market_metrics m ON d.date = m.date
WHERE d.avg_close > m.market_avg_close
"""


@query
def gold_sql_view(spark, sf_dir):
    """SQL over the registered tables: closes above the market's mean."""
    rollups = metrics.daily_rollup(line_bars(spark, sf_dir), scale=SCALE)
    per_date = metrics.merge_rollups(rollups, ["date"], scale=SCALE)
    register_views(
        {
            "daily_metrics": metrics.finish_daily(rollups, scale=SCALE),
            "market_metrics": metrics.finish_market(per_date, scale=SCALE),
        }
    )
    return spark.sql(VIEW_SQL)
