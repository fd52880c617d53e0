"""Metric tables.

Everything is computed from one kind of partial result, a *rollup*: sums,
counts and extremes per group. Rollups merge, so the symbol and market tables
can come from the daily rollup, which is far smaller than the bars, and a
refresh of some months need not read the others again. Groups are reduced
inside each task before the shuffle, so a symbol with a third of all bars sends
one row per task and date.

``scale`` selects exact price sums (see ``functions.exact``) with that many
decimals; without it prices are summed as doubles. Use the same ``scale`` to
make, merge and finish a rollup.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.functions.exact import ExactSum

DAILY_KEY = ("symbol", "date")
VOLUME = ExactSum("volume", 0)


def rollup(bars: DataFrame, by: Sequence[str], *, scale: int | None = None) -> DataFrame:
    """Partial results of the bars per group."""
    return bars.groupBy(*by).agg(
        *ExactSum("open", scale).partial(),
        *ExactSum("close", scale).partial(),
        *VOLUME.partial(),
        F.count("open").alias("n_open"),
        F.count("close").alias("n_close"),
        F.count("volume").alias("n_volume"),
        F.count("symbol").alias("n_symbol"),
        F.count("*").alias("data_points"),
        F.max("high").alias("max_high"),
        F.min("low").alias("min_low"),
    )


def daily_rollup(bars: DataFrame, *, scale: int | None = None) -> DataFrame:
    """The rollup the gold tables are made from."""
    return rollup(bars, DAILY_KEY, scale=scale)


def merge_rollups(rollups: DataFrame, by: Sequence[str], *, scale: int | None = None) -> DataFrame:
    """Combine partial results to coarser groups.

    ``distinct_symbols`` counts the symbols of a group when the input has one
    row per symbol within it, as the daily rollup has per date.
    """
    counts = ("n_open", "n_close", "n_volume", "n_symbol", "data_points")
    return rollups.groupBy(*by).agg(
        *ExactSum("open", scale).merge(),
        *ExactSum("close", scale).merge(),
        *VOLUME.merge(),
        *(F.sum(name).alias(name) for name in counts),
        F.max("max_high").alias("max_high"),
        F.min("min_low").alias("min_low"),
        *([] if "symbol" in by else [F.count("symbol").alias("distinct_symbols")]),
    )


def merge_both(
    rollups: DataFrame, *, within: Sequence[str] = (), scale: int | None = None
) -> DataFrame:
    """The daily rollup merged per symbol and per date, in one pass over it.

    ``level`` says which of the two a row is. ``within`` names columns that both are kept
    apart by, such as the month.
    """
    counts = ("n_open", "n_close", "n_volume", "n_symbol", "data_points")
    # Copies of the group columns: a grouping set nulls the ones it leaves out.
    keyed = rollups.withColumns({"_symbol": F.col("symbol")})
    sets = [["symbol", *within], ["date", *within]]
    return keyed.groupingSets(sets, "symbol", "date", *within).agg(
        F.when(F.grouping("symbol") == 0, "symbol").otherwise("date").alias("level"),
        *ExactSum("open", scale).merge(),
        *ExactSum("close", scale).merge(),
        *VOLUME.merge(),
        *(F.sum(name).alias(name) for name in counts),
        F.max("max_high").alias("max_high"),
        F.min("min_low").alias("min_low"),
        F.count("_symbol").alias("distinct_symbols"),
    )


def finish_daily(rollups: DataFrame, *, scale: int | None = None) -> DataFrame:
    """Daily table from the daily rollup; no shuffle."""
    return rollups.select(
        "symbol",
        "date",
        ExactSum("open", scale).mean(F.col("n_open")).alias("avg_open"),
        ExactSum("close", scale).mean(F.col("n_close")).alias("avg_close"),
        "max_high",
        "min_low",
        VOLUME.as_bigint().alias("total_volume"),
        "data_points",
    )


def finish_symbol(rollups: DataFrame, *, scale: int | None = None) -> DataFrame:
    """All-time table from a rollup per symbol."""
    return rollups.select(
        "symbol",
        ExactSum("close", scale).mean(F.col("n_close")).alias("avg_close"),
        F.col("max_high").alias("max_high_all_time"),
        F.col("min_low").alias("min_low_all_time"),
        VOLUME.mean(F.col("n_volume")).alias("avg_volume"),
        F.col("data_points").alias("total_data_points"),
    )


def finish_market(rollups: DataFrame, *, scale: int | None = None) -> DataFrame:
    """Market table from a rollup per date.

    ``symbols_count`` counts bars with a symbol, not symbols; the number of
    symbols is ``distinct_symbols``, present when the rollup was merged from
    the daily one.
    """
    extra = ["distinct_symbols"] if "distinct_symbols" in rollups.columns else []
    return rollups.select(
        "date",
        ExactSum("close", scale).mean(F.col("n_close")).alias("market_avg_close"),
        VOLUME.mean(F.col("n_volume")).alias("market_avg_volume"),
        F.col("n_symbol").alias("symbols_count"),
        *extra,
    )


def daily_metrics(bars: DataFrame, *, scale: int | None = None) -> DataFrame:
    """Per symbol and date: mean open and close, extremes, volume, bars."""
    return finish_daily(daily_rollup(bars, scale=scale), scale=scale)


def symbol_metrics(bars: DataFrame, *, scale: int | None = None) -> DataFrame:
    """Per symbol over all time, straight from the bars in one shuffle."""
    return finish_symbol(rollup(bars, ["symbol"], scale=scale), scale=scale)


def market_metrics(
    bars: DataFrame, *, scale: int | None = None, distinct_symbols: bool = True
) -> DataFrame:
    """Per date over all symbols.

    Counting distinct symbols needs the bars grouped per symbol and date first;
    without it one small shuffle by date is enough.
    """
    if distinct_symbols:
        per_date = merge_rollups(daily_rollup(bars, scale=scale), ["date"], scale=scale)
    else:
        per_date = rollup(bars, ["date"], scale=scale)
    return finish_market(per_date, scale=scale)


def mean_of_daily_close(daily: DataFrame, *, exact: bool = False) -> DataFrame:
    """Per symbol, the unweighted mean of the daily means in the daily table.

    ``exact`` sums the means as decimals with 15 places, so that the result does not
    depend on the order of the rows; otherwise they are averaged as doubles.
    """
    if not exact:
        return daily.groupBy("symbol").agg(F.avg("avg_close").alias("avg_close"))
    total = F.sum(F.col("avg_close").cast("decimal(38,15)")).cast("double")
    return daily.groupBy("symbol").agg(
        F.try_divide(total, F.count("avg_close")).alias("avg_close")
    )


def weighted_close(rollups: DataFrame, *, scale: int | None = None) -> DataFrame:
    """Per symbol, the mean close with every bar weighted equally."""
    merged = merge_rollups(rollups, ["symbol"], scale=scale)
    mean = ExactSum("close", scale).mean(F.col("n_close"))
    return merged.select("symbol", mean.alias("weighted_close"), "n_close")
