"""Metric tables on the small sample, with NULLs, repeats and hot symbols."""

from __future__ import annotations

import datetime
import random

import pytest
from pyspark.sql import functions as F

from barloom.operators import (
    daily_metrics,
    daily_rollup,
    for_symbol,
    market_metrics,
    mean_of_daily_close,
    merge_rollups,
    on_date,
    preview,
    row_count,
    symbol_metrics,
    symbol_on_date,
    symbol_series,
    weighted_close,
    with_month,
    with_processed_at,
)
from barloom.operators.metrics import finish_market, finish_symbol
from tests.samples import DAY1, DAY2, SILVER, SILVER_DDL

SCALES = pytest.mark.parametrize("scale", [None, 2, 6])


@pytest.fixture(scope="module")
def silver(spark):
    return spark.createDataFrame(SILVER, SILVER_DDL)


@pytest.fixture(scope="module")
def ragged(spark):
    """NULL close, NULL symbol, and two bars of one symbol and date."""
    extra = [
        ("OAK", DAY1, 100.0, 200.0, 90.0, None, 10, None),
        (None, DAY1, 1.0, 2.0, 0.5, 1.5, None, 1.5),
    ]
    return spark.createDataFrame(SILVER + extra, SILVER_DDL)


@SCALES
def test_daily(silver, scale):
    rows = daily_metrics(silver, scale=scale)
    assert rows.count() == 6
    row = symbol_on_date(rows, "OAK", DAY1).first()
    assert row.avg_open == 12.5
    assert row.avg_close == 13.5
    assert (row.max_high, row.min_low) == (14.25, 11.75)
    assert (row.total_volume, row.data_points) == (4000, 1)


@SCALES
def test_symbol(silver, scale):
    rows = symbol_metrics(silver, scale=scale)
    assert rows.count() == 3
    row = for_symbol(rows, "OAK").first()
    assert row.avg_close == pytest.approx(14.125, abs=1e-9)
    assert (row.max_high_all_time, row.min_low_all_time) == (15.5, 11.75)
    assert row.avg_volume == 5000.0
    assert row.total_data_points == 2


@SCALES
@pytest.mark.parametrize("distinct", [True, False])
def test_market(silver, scale, distinct):
    rows = market_metrics(silver, scale=scale, distinct_symbols=distinct)
    assert rows.count() == 2
    row = on_date(rows, DAY1).first()
    assert row.market_avg_close == 255.0
    assert row.symbols_count == 3
    assert ("distinct_symbols" in rows.columns) == distinct


@SCALES
def test_counts_differ_in_what_they_count(ragged, scale):
    day = on_date(market_metrics(ragged, scale=scale), DAY1).first()
    assert (day.symbols_count, day.distinct_symbols) == (4, 3)
    row = symbol_on_date(daily_metrics(ragged, scale=scale), "OAK", DAY1).first()
    assert row.data_points == 2
    assert row.avg_close == 13.5
    assert row.avg_open == 56.25
    assert row.total_volume == 4010
    unnamed = daily_metrics(ragged, scale=scale).where("symbol IS NULL").first()
    assert (unnamed.data_points, unnamed.total_volume) == (1, None)


@SCALES
def test_group_without_any_value_is_null(spark, scale):
    bars = spark.createDataFrame([("A", DAY1, *[None] * 6)], SILVER_DDL)
    row = daily_metrics(bars, scale=scale).first()
    assert row.asDict() == {
        "symbol": "A",
        "date": DAY1,
        "avg_open": None,
        "avg_close": None,
        "max_high": None,
        "min_low": None,
        "total_volume": None,
        "data_points": 1,
    }


def test_empty_input_gives_no_groups(spark):
    empty = spark.createDataFrame([], SILVER_DDL)
    assert daily_metrics(empty).isEmpty()
    assert symbol_metrics(empty).isEmpty()
    assert market_metrics(empty).isEmpty()
    assert row_count(empty).first().rows == 0


@SCALES
def test_merged_rollups_equal_direct_results(ragged, scale):
    daily = daily_rollup(ragged, scale=scale)
    merged = finish_symbol(merge_rollups(daily, ["symbol"], scale=scale), scale=scale)
    direct = symbol_metrics(ragged, scale=scale)
    assert merged.exceptAll(direct).isEmpty() and direct.exceptAll(merged).isEmpty()
    total = merge_rollups(daily, ["date"], scale=scale)
    assert finish_market(total, scale=scale).count() == 2


def test_exact_sums_do_not_depend_on_the_partitioning(spark):
    random.seed(7)
    rows = [
        ("A", DAY1, None, None, None, random.randrange(10**11) / 10**6, 2**50 + i, None)
        for i in range(5000)
    ]
    bars = spark.createDataFrame(rows, SILVER_DDL)
    results = {symbol_metrics(bars.repartition(n), scale=6).first()[1:] for n in (1, 3, 16)}
    assert len(results) == 1
    units = sum(round(r[5] * 10**6) for r in rows)
    volume = sum(r[6] for r in rows)
    assert results.pop()[0] == units / 10**6 / 5000
    assert daily_metrics(bars, scale=6).first().total_volume == volume


def test_volume_overflow_raises_instead_of_wrapping(spark):
    rows = [("A", DAY1, *[None] * 4, 2**62, None)] * 4
    bars = spark.createDataFrame(rows, SILVER_DDL)
    assert symbol_metrics(bars).first().avg_volume == 2.0**62
    with pytest.raises(Exception, match="CAST_OVERFLOW|OVERFLOW"):
        daily_metrics(bars).collect()


@pytest.mark.parametrize("exact", [False, True])
def test_mean_of_means_is_not_rounded(spark, exact):
    """One day of three closes whose mean has no end: a scale of prices must not cut it."""
    bars = [("A", DAY1, c, c, c, c, 1, c) for c in (1.0, 1.0, 1.01)]
    bars.append(("A", DAY2, 2.0, 2.0, 2.0, 2.0, 1, 2.0))
    for scale in (None, 2, 6):
        daily = daily_metrics(spark.createDataFrame(bars, SILVER_DDL), scale=scale)
        mean = mean_of_daily_close(daily, exact=exact).first().avg_close
        assert mean == pytest.approx((3.01 / 3 + 2.0) / 2, abs=1e-12)


def test_more_decimals_than_the_scale_are_refused(spark):
    bars = spark.createDataFrame([("A", DAY1, *[1.005] * 4, 1, 1.005)], SILVER_DDL)
    assert daily_metrics(bars, scale=3).first().avg_close == 1.005
    with pytest.raises(Exception, match="2 decimals"):
        daily_metrics(bars, scale=2).collect()
    wrong = spark.createDataFrame([("A", DAY1, *[float("nan")] * 4, 1, None)], SILVER_DDL)
    with pytest.raises(Exception, match="finite"):
        daily_metrics(wrong, scale=2).collect()


@SCALES
def test_mean_of_means_and_weighted_mean(spark, scale):
    day = lambda d, close: ("A", d, close, close, close, close, 1, close)
    bars = spark.createDataFrame([day(DAY1, 1.0), day(DAY1, 2.0), day(DAY2, 9.0)], SILVER_DDL)
    daily = daily_metrics(bars, scale=scale)
    assert mean_of_daily_close(daily).first().avg_close == (1.5 + 9.0) / 2
    row = weighted_close(daily_rollup(bars, scale=scale), scale=scale).first()
    assert (row.weighted_close, row.n_close) == (4.0, 3)


def test_totals_agree_between_tables(silver):
    days, symbols = daily_metrics(silver), symbol_metrics(silver)
    points = days.agg(F.sum("data_points")).first()[0]
    assert points == symbols.agg(F.sum("total_data_points")).first()[0] == silver.count()


def test_serving_selections(silver):
    daily = with_month(daily_metrics(silver))
    assert [r.date for r in symbol_series(daily, "ELM").collect()] == [DAY1, DAY2]
    assert on_date(daily, DAY2).count() == 3
    assert on_date(daily, datetime.date(2011, 12, 8)).isEmpty()
    shown = preview(daily, 2, order_by=[F.desc("avg_close")])
    assert list(shown["symbol"]) == ["YEW", "YEW"]
    assert len(preview(daily, 4)) == 4


def test_one_stamp_for_a_whole_run(silver):
    stamp = F.lit(datetime.datetime(2024, 1, 2, 3, 4, 5))
    rows = with_processed_at(symbol_metrics(silver), stamp)
    assert {r.processed_at for r in rows.collect()} == {datetime.datetime(2024, 1, 2, 3, 4, 5)}
    assert with_processed_at(silver).schema["processed_at"].dataType.simpleString() == "timestamp"
