"""From documents to bars, and from bars to cleaner or coarser bars."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom.functions.time import (
    calendar_bucket,
    epoch_date,
    epoch_timestamp,
    known_zone,
    local_date,
    month_of,
    nests,
)
from barloom.operators.quality import accepted
from barloom.schemas import META_COLUMNS, PRICE_COLUMNS, VALUE_COLUMNS


def _results(documents: DataFrame) -> DataFrame:
    """One row per chart result of the accepted documents."""
    return accepted(documents).select(
        F.explode("chart.result").alias("r"), "source_file", "ingested_at"
    )


def explode_bars(documents: DataFrame) -> DataFrame:
    """One row per timestamp, with the values at the same array position.

    A single generator over the timestamps drives the rows. Values are looked
    up by position, so a short or absent array gives NULL and never removes or
    multiplies a bar; so does a price that is not a finite number. There is no
    shuffle: each document is unnested where it was read. Its time zone is checked
    once, before that: ``local_zone`` is NULL for a name that does not exist.
    """
    quote = F.get("r.indicators.quote", F.lit(0))
    adjusted = F.get("r.indicators.adjclose", F.lit(0))
    series = _results(documents).select(
        F.col("r.meta").alias("meta"),
        known_zone(F.col("r.meta.exchangeTimezoneName")).alias("local_zone"),
        F.posexplode("r.timestamp").alias("position", "epoch"),
        *(quote[name].alias(name) for name in (*PRICE_COLUMNS, "volume")),
        adjusted["adjclose"].alias("adjclose"),
        "source_file",
        "ingested_at",
    )
    return series.select(
        F.col("meta.symbol").alias("symbol"),
        epoch_timestamp(F.col("epoch")).alias("datetime"),
        epoch_date(F.col("epoch")).alias("date"),
        *(_value(name).alias(name) for name in VALUE_COLUMNS),
        F.col("meta.currency").alias("currency"),
        F.col("meta.exchangeName").alias("exchange"),
        F.col("meta.exchangeTimezoneName").alias("exchange_timezone"),
        "source_file",
        "ingested_at",
        "local_zone",
    )


def _value(name: str) -> Column:
    value = F.get(name, F.col("position"))
    # NaN is above infinity.
    return value if name == "volume" else F.when(F.abs(value) < F.lit(float("inf")), value)


def explode_metadata(documents: DataFrame) -> DataFrame:
    """One row per timestamp with all of the document's metadata."""
    rows = _results(documents).select(
        F.col("r.meta").alias("meta"), F.explode("r.timestamp").alias("epoch"), "source_file"
    )
    return rows.select(
        F.col("meta.symbol").alias("symbol"),
        *(F.col(f"meta.{field}").alias(name) for name, field in META_COLUMNS.items()),
        F.col("epoch").alias("timestamp"),
        "source_file",
    )


def with_local_date(bars: DataFrame) -> DataFrame:
    """Add the trading date at the exchange; ``date`` itself is the UTC date.

    A zone that was checked with its document is taken as it is.
    """
    if "local_zone" in bars.columns:
        zone = F.col("local_zone")
    else:
        zone = known_zone(F.col("exchange_timezone"))
    return bars.withColumn("local_date", local_date(F.col("datetime"), zone)).drop("local_zone")


def with_month(bars: DataFrame) -> DataFrame:
    """Add the column silver and gold are partitioned by."""
    return bars.withColumn("month", month_of(F.col("date")))


def with_processed_at(df: DataFrame, processed_at: Column | None = None) -> DataFrame:
    """Stamp rows; pass one value to give all tables of a run the same stamp."""
    stamp = F.current_timestamp() if processed_at is None else processed_at
    return df.withColumn("processed_at", stamp)


# Rows are compared as text: keep all digits of a time.
_FULL_TIME = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def newest_copy(
    bars: DataFrame,
    *,
    key: Sequence[str] = ("symbol", "datetime"),
    recency: Sequence[str] = ("ingested_at", "source_file"),
    implied: Sequence[str] = (),
) -> DataFrame:
    """Keep the newest row of each key; use (symbol, date) for daily bars.

    Spark ranks within each task before the shuffle and sends on at most one
    row per key and task, so a key with very many copies stays small. Equal
    recency is decided by the remaining columns, which makes the result the
    same on every run. Rows without a complete key cannot be told to be copies
    of each other, so only rows equal in every column are merged there.

    ``implied`` names columns that follow from the key, such as the month of a time:
    they change no group, and let filters on them pass below the ranking.
    """
    incomplete = reduce(or_, (F.col(name).isNull() for name in key))
    whole_row = F.when(incomplete, F.to_json(F.struct(*bars.columns), _FULL_TIME))
    rest = [name for name in bars.columns if name not in (*key, *recency, *implied)]
    order = [F.col(name).desc_nulls_last() for name in (*recency, *rest)]
    also = [name for name in implied if name not in key]
    window = Window.partitionBy(*key, *also, whole_row).orderBy(*order)
    return (
        bars.withColumn("_rank", F.row_number().over(window))
        .where(F.col("_rank") == 1)
        .drop("_rank")
    )


# Above the distance of any two 64-bit numbers.
_TIE_SPAN = Decimal(2 * 10**19)


def _ordering(ticks: DataFrame, time: str, tie_breaker: str) -> Column:
    """A value that orders rows by time, then by the tie-breaker."""
    if ticks.schema[tie_breaker].dataType.typeName() not in ("long", "integer", "short", "byte"):
        return F.struct(time, tie_breaker)
    micros = F.unix_micros(F.col(time).cast("timestamp")).cast("decimal(18,0)")
    # A row without a tie-breaker comes before all others of its time.
    tie = F.coalesce(F.col(tie_breaker).cast("decimal(20,0)"), F.lit(Decimal(-(2**63) - 1)))
    return (micros * F.lit(_TIE_SPAN) + tie).cast("decimal(38,0)")


def resample(
    ticks: DataFrame,
    interval: str,
    *,
    symbol: str = "symbol",
    time: str = "datetime",
    price: str = "price",
    volume: str | None = None,
    tie_breaker: str | None = None,
    mergeable: bool = False,
) -> DataFrame:
    """Bars of a chosen interval ("5m", "1h", "1d", "1wk", "1mo") from ticks.

    Open and close are the values at the first and last time, found inside the
    aggregation, so each task sends one row per bar and a busy symbol needs no
    sort of its ticks in one place. When two ticks of a symbol can share a time,
    name a ``tie_breaker`` column: without it either of them may be taken. A whole
    number is put behind the time in one fixed-width value, which keeps the hash
    aggregation; any other type is compared in a struct, by sorting.

    ``mergeable`` bars keep the places of their open and close in time, as ``open_at`` and
    ``close_at``: coarser bars can be made from them, without the ticks (``coarsen``).
    """
    at = F.col(time) if tie_breaker is None else _ordering(ticks, time, tie_breaker)
    aggregates = [
        F.min_by(price, at).alias("open"),
        F.max(price).alias("high"),
        F.min(price).alias("low"),
        F.max_by(price, at).alias("close"),
        F.count("*").alias("ticks"),
    ]
    if volume is not None:
        aggregates.append(F.sum(volume).alias("volume"))
    if mergeable:
        aggregates += [F.min(at).alias("open_at"), F.max(at).alias("close_at")]
    return ticks.groupBy(
        F.col(symbol).alias("symbol"), calendar_bucket(F.col(time), interval).alias("bar_start")
    ).agg(*aggregates)


def coarsen(bars: DataFrame, fine: str, coarse: str) -> DataFrame:
    """Bars of the interval ``coarse`` from mergeable bars of the interval ``fine``.

    The same as resampling the ticks, and mergeable again. Only intervals that nest can
    be made so: hours to days, days to weeks or months, but not weeks to months.
    """
    if not nests(fine, coarse):
        raise ValueError(f"{coarse!r} is not made of whole {fine!r}")
    extra = [F.sum("volume").alias("volume")] if "volume" in bars.columns else []
    start = calendar_bucket(F.col("bar_start"), coarse).alias("bar_start")
    return bars.groupBy("symbol", start).agg(
        F.min_by("open", "open_at").alias("open"),
        F.max("high").alias("high"),
        F.min("low").alias("low"),
        F.max_by("close", "close_at").alias("close"),
        F.sum("ticks").alias("ticks"),
        *extra,
        F.min("open_at").alias("open_at"),
        F.max("close_at").alias("close_at"),
    )
