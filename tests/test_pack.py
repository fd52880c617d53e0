"""Packing: whole, in order, and bounded however skewed the bars are."""

from __future__ import annotations

import json
from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from barloom.operators import explode_bars, pack, pack_documents
from barloom.sources import land_documents, read_documents

DDL = (
    "symbol string, datetime timestamp, open double, high double, low double, close double, "
    "volume bigint, adjclose double, exchange string"
)
COLUMNS = ("symbol", "epoch", "open", "high", "low", "close", "volume", "adjclose", "exchange")


def frame(spark, rows, partitions=4):
    """Rows are (symbol, epoch, open..adjclose, exchange)."""
    raw = spark.createDataFrame(rows, DDL.replace("datetime timestamp", "epoch bigint"))
    return raw.withColumn("datetime", F.timestamp_seconds("epoch")).repartition(partitions)


def contents(bars):
    rows = bars.withColumn("epoch", F.unix_seconds("datetime")).select(*COLUMNS).collect()
    return Counter(map(tuple, rows))


def returned(spark, documents, folder):
    land_documents(documents, folder)
    return explode_bars(read_documents(spark, folder))


def skewed_rows():
    """A third of the rows is one symbol, a third is copies of one bar."""
    hot = [("HOT", i, 1.0 * i, 2.0, 0.5, 1.5, i, 1.5, "X") for i in range(900)]
    copies = [("COPY", 7, 1.0, 2.0, 0.5, 1.5, 1, 1.5, "X")] * 900
    many = [(f"S{i}", i, 1.0, 2.0, 0.5, 1.5, i, None, "X") for i in range(900)]
    return hot + copies + many


@pytest.fixture(scope="module")
def skewed(spark):
    return frame(spark, skewed_rows(), partitions=9).cache()


def sizes(documents):
    return [
        r.n for r in documents.select(F.size(F.col("chart.result")[0]["timestamp"]).alias("n")).collect()
    ]


def test_round_trip_of_skewed_bars(spark, skewed, folder):
    back = returned(spark, pack_documents(skewed, max_bars=50), folder)
    assert contents(back) == Counter(skewed_rows())


def test_documents_are_bounded_and_ordinary_symbols_stay_whole(skewed):
    documents = pack_documents(skewed, max_bars=50)
    assert max(sizes(documents)) <= 50
    per_symbol = {r.symbol: r["count"] for r in documents.groupBy("symbol").count().collect()}
    assert per_symbol["HOT"] >= 18 and per_symbol["COPY"] >= 18
    assert all(n == 1 for s, n in per_symbol.items() if s.startswith("S"))


@pytest.mark.parametrize("clustered", [False, True])
def test_parts_are_bounded_whatever_the_layout(spark, skewed, clustered):
    """A hot group of 200 times ``max_bars`` rows, also with all its rows in one partition."""
    hot = [("HOT", t % 7, 1.0, 1.0, 1.0, 1.0, t, 1.0, "X") for t in range(4000)]
    rows = frame(spark, hot).unionByName(skewed)
    rows = rows.repartition(3, "symbol") if clustered else rows.repartition(5)
    keys = ["symbol", "exchange"]
    parts = pack._with_part(rows.select(*keys), keys, 20).groupBy(*keys, "_part").count()
    assert parts.where("_part.source >= 0").agg(F.max("count")).first()[0] <= 20
    assert parts.where("_part.source < 0").agg(F.max("count")).first()[0] <= 20


@pytest.mark.parametrize("layout", ["spread", "clustered", "reversed"])
def test_documents_of_a_hot_symbol_follow_each_other_in_time(spark, layout):
    hot = [("HOT", t, 1.0, 1.0, 1.0, 1.0, t, 1.0, "X") for t in range(3000)]
    cold = [("COLD", t, 1.0, 1.0, 1.0, 1.0, t, 1.0, "X") for t in range(40)]
    bars = frame(spark, hot + cold, partitions=6)
    if layout == "clustered":
        bars = bars.repartition(3, "symbol")
    if layout == "reversed":
        bars = bars.orderBy(F.desc("epoch"))
    times = F.col("chart.result")[0]["timestamp"]
    documents = pack_documents(bars, max_bars=100).select("symbol", times.alias("times")).collect()
    ranges = sorted((min(r.times), max(r.times)) for r in documents if r.symbol == "HOT")
    assert all(a[1] < b[0] for a, b in zip(ranges, ranges[1:], strict=False))
    assert sum(len(r.times) for r in documents) == 3040 and max(len(r.times) for r in documents) <= 100
    # Few documents are short: one for each cut and group.
    assert len(ranges) <= 30 + 2 * 4


def test_times_are_in_order_within_a_document(spark):
    rows = [("A", t, float(t), 1.0, 1.0, 1.0, t, 1.0, "X") for t in (5, 3, 9, 1)]
    chart = pack_documents(frame(spark, rows)).first().chart
    assert list(chart.result[0].timestamp) == [1, 3, 5, 9]
    assert list(chart.result[0].indicators.quote[0].open) == [1.0, 3.0, 5.0, 9.0]


def test_document_text_has_the_declared_layout(spark, folder):
    rows = [("A", 1, 1.0, None, 0.5, 1.5, 10, None, "X")]
    documents = pack_documents(frame(spark, rows))
    text = documents.select(F.to_json(F.struct("chart"), {"ignoreNullFields": "false"})).first()[0]
    assert json.loads(text) == {
        "chart": {
            "result": [
                {
                    "meta": {
                        "currency": None,
                        "symbol": "A",
                        "exchangeName": "X",
                        "instrumentType": None,
                        "firstTradeDate": None,
                        "regularMarketTime": None,
                        "timezone": None,
                        "exchangeTimezoneName": None,
                    },
                    "timestamp": [1],
                    "indicators": {
                        "quote": [
                            {"open": [1.0], "high": [None], "low": [0.5], "close": [1.5], "volume": [10]}
                        ],
                        "adjclose": [{"adjclose": [None]}],
                    },
                }
            ],
            "error": None,
        }
    }


def test_landing_a_run_again_replaces_only_that_run(spark, folder):
    bars = frame(spark, [("A", 1, 1.0, 1.0, 1.0, 1.0, 1, 1.0, "X")])
    for run in ("20240101_000000", "20240102_000000", "20240102_000000"):
        packed = pack_documents(bars.withColumn("run", F.lit(run)), by=["run"])
        land_documents(packed, folder, partition_by=["run"])
    assert explode_bars(read_documents(spark, folder)).count() == 2


prices = st.one_of(st.none(), st.floats(allow_nan=False, allow_infinity=False, width=64))
bars = st.lists(
    st.tuples(
        st.one_of(st.none(), st.sampled_from(["A", "B", 'q"u', ""])),
        st.integers(-(10**9), 4 * 10**9),
        *[prices] * 4,
        st.one_of(st.none(), st.integers(-(2**63), 2**63 - 1)),
        prices,
        st.sampled_from(["X", "Y"]),
    ),
    min_size=1,
    max_size=12,
)


@settings(
    max_examples=8,
    deadline=None,
    derandomize=True,
    suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow],
)
@given(rows=bars, max_bars=st.sampled_from([1, 3, 100]))
def test_any_bars_return(spark, folder, rows, max_bars):
    back = returned(spark, pack_documents(frame(spark, rows), max_bars=max_bars), folder)
    assert contents(back) == Counter(rows)


def test_landing_one_packed_run_without_a_second_shuffle_keeps_every_bar(spark, folder):
    rows = skewed_rows()
    packed = pack_documents(frame(spark, rows).withColumn("run", F.lit("20240101_000000")), by=["run"], max_bars=7)
    land_documents(packed, folder, partition_by=["run"], rebalance=False)
    back = explode_bars(read_documents(spark, folder))
    assert back.select("source_file").where(~F.col("source_file").contains("/run=20240101_000000/")).count() == 0
    assert contents(back) == Counter(rows)
