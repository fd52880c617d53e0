"""Newest copies, resampling, ranges, and the time codes."""

from __future__ import annotations

import datetime
import random

import pytest
from pyspark.sql import functions as F

from barloom.functions import calendar_bucket, run_key, trailing_interval
from barloom.functions.time import nests
from barloom.operators import coarsen, newest_copy, resample, trailing

DDL = "symbol string, datetime timestamp, close double, ingested_at timestamp, source_file string"
T0 = datetime.datetime(2024, 1, 1)
HOUR = datetime.timedelta(hours=1)


def test_newest_copy_wins_and_ties_are_stable(spark):
    rows = [
        ("A", T0, 1.0, T0, "f1"),
        ("A", T0, 2.0, T0 + HOUR, "f1"),
        ("B", T0, 1.0, T0, "f1"),
        ("B", T0, 2.0, T0, "f2"),
        ("C", T0, 1.0, T0, "f1"),
        ("C", T0, 3.0, T0, "f1"),
        ("C", T0, 2.0, T0, "f1"),
    ]
    for partitions in (1, 4):
        bars = spark.createDataFrame(rows, DDL).repartition(partitions)
        kept = {r.symbol: r.close for r in newest_copy(bars).collect()}
        assert kept == {"A": 2.0, "B": 2.0, "C": 3.0}


def test_bars_without_a_key_are_not_merged(spark):
    second = T0 + datetime.timedelta(microseconds=1)
    rows = [
        (None, T0, 1.0, T0, "f"),
        (None, T0, 1.0, T0, "f"),
        (None, T0, 1.0, second, "f"),
        (None, T0, 2.0, T0, "f"),
        ("A", None, 1.0, T0, "f"),
        ("A", None, None, T0, "f"),
    ]
    assert newest_copy(spark.createDataFrame(rows, DDL)).count() == 5


def test_daily_key_merges_runs_that_differ_in_seconds(spark):
    rows = [
        ("A", T0 + datetime.timedelta(seconds=s), float(s), T0 + HOUR * s, "f") for s in (1, 2, 3)
    ]
    bars = spark.createDataFrame(rows, DDL).withColumn("date", F.to_date("datetime"))
    assert newest_copy(bars).count() == 3
    assert [r.close for r in newest_copy(bars, key=("symbol", "date")).collect()] == [3.0]


def test_hot_key_is_reduced_before_the_shuffle(spark):
    """A third of the rows is one key; each task passes on one row of it."""
    bars = spark.range(0, 30_000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, "HOT").otherwise(F.col("id").cast("string")).alias("symbol"),
        F.lit(T0).alias("datetime"),
        F.col("id").cast("double").alias("close"),
        F.lit(T0).alias("ingested_at"),
        F.lit("f").alias("source_file"),
    )
    kept = newest_copy(bars)
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "row_number(), 1, Partial" in plan
    assert kept.count() == 20_001
    assert kept.where("symbol = 'HOT'").first().close == 29_997.0


@pytest.fixture(scope="module")
def ticks(spark):
    random.seed(3)
    rows = [
        (random.choice("AB"), T0 + datetime.timedelta(minutes=random.randrange(5000)), float(i), 1, i)
        for i in range(3000)
    ]
    return rows, spark.createDataFrame(
        rows, "symbol string, datetime timestamp, price double, volume bigint, seq bigint"
    )


@pytest.mark.parametrize("interval, minutes", [("5m", 5), ("1h", 60), ("1d", 1440)])
def test_resample_against_brute_force(ticks, interval, minutes):
    rows, frame = ticks
    groups: dict = {}
    for symbol, time, price, _, seq in rows:
        start = (time - T0) // datetime.timedelta(minutes=minutes)
        groups.setdefault((symbol, start), []).append((time, seq, price))
    expected = {
        (symbol, T0 + start * datetime.timedelta(minutes=minutes)): (
            min(g)[2], max(p for *_, p in g), min(p for *_, p in g), max(g)[2], len(g), len(g),
        )
        for (symbol, start), g in groups.items()
    }
    found = resample(frame, interval, volume="volume", tie_breaker="seq")
    assert {
        (r.symbol, r.bar_start): (r.open, r.high, r.low, r.close, r.ticks, r.volume)
        for r in found.collect()
    } == expected


@pytest.mark.parametrize("fine, coarse", [("5m", "1h"), ("1h", "1d"), ("1h", "1wk"), ("1d", "1mo")])
def test_coarser_bars_equal_those_from_ticks(ticks, fine, coarse):
    _, frame = ticks
    options = {"volume": "volume", "tie_breaker": "seq", "mergeable": True}
    found = coarsen(resample(frame, fine, **options), fine, coarse)
    expected = resample(frame, coarse, **options).select(found.columns)
    assert sorted(map(str, found.collect())) == sorted(map(str, expected.collect()))


def test_only_intervals_that_nest_are_made_coarser(ticks):
    _, frame = ticks
    for fine, coarse in (("1wk", "1mo"), ("7m", "1h"), ("1d", "1h"), ("2d", "1wk"), ("1y", "1mo")):
        with pytest.raises(ValueError, match="whole"):
            coarsen(frame, fine, coarse)
    assert all(nests(a, b) for a, b in (("1mo", "3mo"), ("3mo", "1y"), ("12h", "1mo"), ("1h", "2d")))


def test_calendar_intervals(spark):
    day = spark.sql("SELECT timestamp '2024-05-15 13:00:00' AS t")
    expected = {
        "1d": (5, 15),
        "1wk": (5, 13),
        "1mo": (5, 1),
        "3mo": (4, 1),
        "1y": (1, 1),
    }
    for code, (month, first) in expected.items():
        found = day.select(calendar_bucket(F.col("t"), code).alias("b")).first().b
        assert found == datetime.datetime(2024, month, first)


def test_unknown_codes_are_refused():
    for code in ("1x", "", "d", "0d", "-1d", "1.5h"):
        with pytest.raises(ValueError):
            trailing_interval(code)
    with pytest.raises(ValueError):
        calendar_bucket(F.lit(None), "2mo")


def test_trailing_counts_back_from_the_newest_row(ticks):
    rows, frame = ticks
    newest = max(r[1] for r in rows)
    for code, span in (("30m", datetime.timedelta(minutes=30)), ("1d", datetime.timedelta(days=1))):
        expected = sorted(r for r in rows if r[1] >= newest - span)
        assert sorted(map(tuple, trailing(frame, code).collect())) == expected
    assert trailing(frame, "1mo").count() == len(rows)


def test_run_key(spark):
    row = spark.sql("SELECT timestamp '2024-05-15 13:04:09' AS t").select(run_key(F.col("t")))
    assert row.first()[0] == "20240515_130409"
