"""What the plans must look like for the work to hold at scale."""

from __future__ import annotations

import datetime

import pytest
from pyspark.sql import functions as F

from barloom.operators import (
    explode_bars,
    for_symbol,
    newest_copy,
    on_date,
    pack_documents,
    resample,
    trailing,
)
from barloom.operators.metrics import daily_metrics, market_metrics, symbol_metrics
from barloom.queries import REGISTRY, line_bars, ticks
from barloom.sources import list_documents, read_documents, replace_table
from tests.samples import document, land, result

SF_DIR = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def read_schema(plan):
    start = plan.index("ReadSchema: struct<") + len("ReadSchema: struct<")
    return {field.split(":")[0] for field in plan[start : plan.index(">", start)].split(",")}


@pytest.fixture(scope="module")
def bars(spark):
    return line_bars(spark, SF_DIR)


def test_aggregates_combine_before_one_shuffle(bars):
    for table in (daily_metrics(bars), symbol_metrics(bars), market_metrics(bars, distinct_symbols=False)):
        plan = plan_of(table)
        assert plan.count("Exchange hashpartitioning") == 1
        assert "partial_sum" in plan
        assert "SortAggregate" not in plan


def test_exact_sums_stay_in_generated_hash_aggregates(bars):
    plan = plan_of(daily_metrics(bars, scale=6))
    assert "SortAggregate" not in plan and "ObjectHashAggregate" not in plan


def test_only_needed_columns_are_read(bars):
    plan = plan_of(market_metrics(bars, distinct_symbols=False))
    unused = {"l_orderkey", "l_partkey", "l_linenumber", "l_returnflag", "l_linestatus"}
    assert not unused & read_schema(plan)
    assert read_schema(plan_of(REGISTRY["silver_count"](bars.sparkSession, SF_DIR))) <= {""}


def test_parsing_has_no_shuffle_and_one_scan(spark, folder):
    land(folder, "a.json", document(result()))
    plan = plan_of(explode_bars(read_documents(spark, folder)))
    assert "Exchange" not in plan and "ArrowEval" not in plan
    assert plan.count("FileScan json") == 1


def test_listing_does_not_open_files(spark, folder):
    land(folder, "a.json", document(result()))
    assert "content" not in read_schema(plan_of(list_documents(spark, folder)))


def test_stored_table_skips_partitions_and_pushes_the_symbol(spark, bars, folder):
    stored = bars.withColumn("month", F.trunc("date", "MM"))
    replace_table(stored, folder, partition_by=["month"], sort_by=["symbol"])
    date = datetime.date(1998, 1, 5)
    plan = plan_of(on_date(for_symbol(spark.read.parquet(folder), "S1"), date))
    partition, pushed = (
        next(line for line in plan.splitlines() if "FileScan" in line).split(marker, 1)[1]
        for marker in ("PartitionFilters:", "PushedFilters:")
    )
    assert "month" in partition.split("]")[0]
    assert "EqualTo(symbol,S1)" in pushed and "EqualTo(date,1998-01-05)" in pushed


def test_date_filter_reaches_the_timestamp_column(bars):
    plan = plan_of(on_date(bars, datetime.date(1998, 1, 5)))
    assert "GreaterThanOrEqual(l_shipdate" in plan


def test_trailing_range_is_a_subquery_not_a_join(spark):
    plan = plan_of(trailing(ticks(spark, SF_DIR), "7d", time="ts"))
    assert "Join" not in plan and "Subquery" in plan


def test_resample_without_ties_is_a_hash_aggregate(spark):
    plan = plan_of(resample(ticks(spark, SF_DIR), "1h", time="ts"))
    assert "HashAggregate" in plan and "SortAggregate" not in plan
    assert plan.count("Exchange hashpartitioning") == 1


def test_newest_copy_ranks_before_its_only_shuffle(spark):
    rows = ticks(spark, SF_DIR).withColumn("version", F.lit(1))
    plan = plan_of(newest_copy(rows, key=("symbol", "ts"), recency=("version",)))
    assert plan.count("Exchange") == 1
    assert "Partial" in plan


def test_packing_without_a_hot_group_sorts_and_joins_nothing(bars):
    plan = plan_of(pack_documents(bars))
    assert "Sort [" not in plan and "Join" not in plan and plan.count("Exchange ") == 1
    cut = plan_of(pack_documents(bars, max_bars=100))
    assert "rangepartitioning" in cut and "RoundRobin" not in cut


def test_silver_and_gold_rows_are_grouped_and_laid_out_by_one_shuffle(bars):
    from barloom.operators import with_month
    from barloom.operators.metrics import daily_rollup
    from barloom.plans.medallion import _by_dates

    rows = with_month(bars.withColumn("ingested_at", F.lit(1)).withColumn("source_file", F.lit("f")))
    for table in (
        newest_copy(_by_dates(rows), key=("symbol", "datetime"), implied=("date", "month")),
        daily_rollup(_by_dates(rows)),
    ):
        plan = plan_of(table)
        assert plan.count("Exchange ") == 1 and "rangepartitioning(date" in plan
