"""The jobs end to end: repeatable, incremental, and safe to fail half way."""

from __future__ import annotations

import dataclasses
import datetime
import json
import os
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from barloom.__main__ import main
from barloom.operators.filters import on_date, trailing
from barloom.plans import (
    Lake,
    bronze_to_silver,
    changed_months,
    compact_silver,
    fragmented_months,
    read_quarantine,
    read_silver,
    read_trailing,
    refresh_gold,
    silver_to_gold,
    sweep,
    update_gold,
)
from barloom.plans import medallion
from barloom.sources import append_table, read_gold, read_table, register_views, replace_table
from barloom.streaming import ingest_new
from tests.samples import document, land, result

JAN, FEB, MAR = (int(datetime.datetime(2024, m, 10, tzinfo=datetime.UTC).timestamp()) for m in (1, 2, 3))
DAY = 86_400


@pytest.fixture
def lake(folder):
    return Lake(folder)


def put(lake, name, *documents):
    land(lake.bronze, name, *documents)


def closes(spark, lake):
    rows = read_silver(spark, lake).collect()
    return sorted((r.symbol, int(r.datetime.replace(tzinfo=datetime.UTC).timestamp()), r.close) for r in rows)


def swept(spark, lake):
    """What is left when the retention has passed."""
    assert sweep(spark, lake) == []
    assert sweep(spark, dataclasses.replace(lake, retention=datetime.timedelta(0)))


def gold_rows(spark, lake):
    gold = read_gold(spark, lake.gold)
    return [sorted(map(str, t.drop("processed_at").collect())) for t in gold]


def test_no_documents_and_no_silver(spark, lake):
    Path(lake.bronze).mkdir(parents=True)
    assert bronze_to_silver(spark, lake) is False
    assert not Path(lake.silver).exists()


def test_empty_silver_writes_no_gold(spark, lake):
    put(lake, "a.json", document(error={"code": "Not Found"}))
    assert bronze_to_silver(spark, lake) is True
    assert silver_to_gold(spark, lake) is False
    assert not Path(lake.gold).exists()


def test_rebuilding_twice_gives_the_same_tables(spark, lake):
    put(lake, "1.json", document(result("A", times=(JAN, JAN + DAY))))
    put(lake, "2.json", document(result("A", times=(JAN, JAN + DAY))), "{bad")
    for _ in range(2):
        bronze_to_silver(spark, lake)
        silver_to_gold(spark, lake)
        assert len(closes(spark, lake)) == 2
        assert read_quarantine(spark, lake).count() == 1
        daily, symbol, market = read_gold(spark, lake.gold)
        assert [r.data_points for r in daily.collect()] == [1, 1]
        assert symbol.first().total_data_points == 2
        assert [r.symbols_count for r in market.collect()] == [1, 1]


def test_each_file_is_ingested_once(spark, lake):
    put(lake, "1.json", document(result("A", times=(JAN, FEB))))
    assert ingest_new(spark, lake) == [1]
    assert ingest_new(spark, lake) == []
    put(lake, "2.json", document(result("B", times=(FEB,))), "{bad")
    assert ingest_new(spark, lake) == [2]
    stored = read_table(spark, lake.silver)
    assert {r.ingest_batch: r["count"] for r in stored.groupBy("ingest_batch").count().collect()} == {
        1: 2,
        2: 1,
    }
    assert [r.reason for r in read_table(spark, lake.quarantine).collect()] == ["malformed"]
    assert changed_months(spark, lake, after_batch=1) == [datetime.date(2024, 2, 1)]


def test_backlog_is_split_into_batches(spark, lake):
    for i in range(3):
        put(lake, f"{i}.json", document(result(f"S{i}", times=(JAN,))))
    assert ingest_new(spark, lake, max_bytes_per_batch=1) == [1, 2, 3]
    assert len(closes(spark, lake)) == 3


def test_correction_in_a_later_batch_wins(spark, lake):
    put(lake, "1.json", document(result("A", times=(JAN,), close=[1.0])))
    ingest_new(spark, lake)
    put(lake, "2.json", document(result("A", times=(JAN,), close=[2.0])))
    ingest_new(spark, lake)
    assert closes(spark, lake) == [("A", JAN, 2.0)]


def test_rebuild_replaces_what_an_earlier_run_parsed(spark, lake, monkeypatch):
    put(lake, "1.json", document(result("A", times=(JAN,), close=[1.0])), "{bad", "{bad")

    right = medallion.silver_bars

    def wrong(documents, processed_at=None):
        return right(documents, processed_at).withColumn("close", F.lit(0.0))

    with monkeypatch.context() as broken:
        broken.setattr(medallion, "silver_bars", wrong)
        ingest_new(spark, lake)
    assert closes(spark, lake) == [("A", JAN, 0.0)]
    first_run = read_quarantine(spark, lake).first()
    bronze_to_silver(spark, lake)
    assert closes(spark, lake) == [("A", JAN, 1.0)]
    swept(spark, lake)
    assert read_table(spark, lake.silver).count() == 1
    assert read_table(spark, lake.quarantine).count() == 2
    found = read_quarantine(spark, lake).collect()
    assert [r.reason for r in found] == ["malformed"] * 2
    assert all(r.processed_at > first_run.processed_at for r in found)


def test_rebuild_drops_what_was_deleted_or_repaired(spark, lake):
    put(lake, "1.json", document(result("A", times=(JAN,), close=[1.0])))
    put(lake, "2.json", document(result("B", times=(JAN,), close=[2.0])))
    put(lake, "3.json", "{bad")
    ingest_new(spark, lake)
    assert [r.reason for r in read_quarantine(spark, lake).collect()] == ["malformed"]
    Path(lake.bronze, "2.json").unlink()
    put(lake, "3.json", document(result("C", times=(FEB,), close=[3.0])))
    bronze_to_silver(spark, lake)
    assert closes(spark, lake) == [("A", JAN, 1.0), ("C", FEB, 3.0)]
    assert read_quarantine(spark, lake).count() == 0
    assert ingest_new(spark, lake) == []


def test_update_after_a_rebuild_rebuilds_gold(spark, lake):
    put(lake, "1.json", document(result("A", times=(JAN,))))
    ingest_new(spark, lake)
    update_gold(spark, lake)
    put(lake, "2.json", document(result("B", times=(FEB,))))
    bronze_to_silver(spark, lake)
    update_gold(spark, lake)
    symbols = read_gold(spark, lake.gold).symbol_metrics.select("symbol").collect()
    assert sorted(r.symbol for r in symbols) == ["A", "B"]


def test_failed_rebuild_leaves_the_last_generation(spark, lake, monkeypatch):
    put(lake, "1.json", document(result("A", times=(JAN,), close=[1.0])), "{bad")
    ingest_new(spark, lake)
    put(lake, "1.json", document(result("A", times=(JAN,), close=[2.0])))

    def fail(*args, **kwargs):
        raise OSError("lost")

    for step in ("write_quarantine_batch", "record_run", "open_generation"):
        with monkeypatch.context() as broken:
            broken.setattr(medallion, step, fail)
            with pytest.raises(OSError):
                bronze_to_silver(spark, lake)
        assert closes(spark, lake) == [("A", JAN, 1.0)]
        assert read_quarantine(spark, lake).count() == 1
    bronze_to_silver(spark, lake)
    assert closes(spark, lake) == [("A", JAN, 2.0)]
    assert read_quarantine(spark, lake).count() == 0


def test_old_files_are_ingested(spark, lake):
    put(lake, "1.json", document(result("A", times=(JAN,))))
    ingest_new(spark, lake)
    put(lake, "2.json", document(result("B", times=(JAN,))))
    past = Path(lake.bronze, "1.json").stat().st_mtime - 8 * DAY
    os.utime(Path(lake.bronze, "2.json"), (past, past))
    assert ingest_new(spark, lake) == [2]
    assert {symbol for symbol, _, _ in closes(spark, lake)} == {"A", "B"}
    assert ingest_new(spark, lake) == []


def test_lookups_in_silver_read_only_their_months(spark, lake):
    put(lake, "1.json", document(result("A", times=(JAN, FEB, MAR), close=[1.0, 2.0, 3.0])))
    ingest_new(spark, lake)
    put(lake, "2.json", document(result("A", times=(FEB, MAR), close=[4.0, 5.0])))
    ingest_new(spark, lake)
    day = on_date(read_silver(spark, lake), datetime.date(2024, 2, 10))
    assert [r.close for r in day.collect()] == [4.0]
    last = read_trailing(spark, lake, "5d")
    assert [r.close for r in last.collect()] == [5.0]
    for found in (day, last):
        plan = found._jdf.queryExecution().executedPlan().toString()
        scans = [line for line in plan.splitlines() if "PartitionFilters" in line]
        assert scans and all("month" in line.split("PartitionFilters")[1] for line in scans)
    assert [r.close for r in trailing(read_silver(spark, lake), "5d").collect()] == [5.0]


def test_compaction_keeps_silver_and_empties_older_batches(spark, lake):
    for name, close in (("1", 1.0), ("2", 2.0), ("3", 3.0)):
        put(lake, f"{name}.json", document(result("A", times=(JAN, FEB), close=[close, close])))
        ingest_new(spark, lake)
    before = closes(spark, lake)
    update_gold(spark, lake)
    gold = gold_rows(spark, lake)
    compact_silver(spark, lake, [datetime.date(2024, 1, 1)])
    assert closes(spark, lake) == before
    swept(spark, lake)
    assert closes(spark, lake) == before
    stored = read_table(spark, lake.silver).groupBy("month").count().collect()
    assert {str(r.month): r["count"] for r in stored} == {"2024-01-01": 1, "2024-02-01": 3}
    assert ingest_new(spark, lake) == []
    update_gold(spark, lake)
    assert gold_rows(spark, lake) == gold


def test_prices_that_are_no_numbers(spark, lake):
    text = json.dumps(document(result("A", times=(JAN, FEB), close=[1.0, 7.5])))
    put(lake, "1.json", text.replace("7.5", "NaN"))
    text = json.dumps(document(result("B", times=(JAN, FEB), open=[2.0, 7.5])))
    put(lake, "2.json", text.replace("7.5", "-Infinity"))
    bronze_to_silver(spark, lake)
    found = read_quarantine(spark, lake).collect()
    assert sorted((r.symbol, r.reason) for r in found) == [("A", "value"), ("B", "value")]
    assert closes(spark, lake)[:2] == [("A", JAN, 1.0), ("A", FEB, None)]
    for scale in (None, 6):
        silver_to_gold(spark, lake, scale=scale)
        market = read_gold(spark, lake.gold).market_metrics.collect()
        assert len(market) == 2 and all(r.market_avg_close < 1e6 for r in market)


def test_update_without_silver_does_nothing(spark, lake):
    Path(lake.bronze).mkdir(parents=True)
    main(["ingest", "--root", lake.root, "--then-gold"])
    assert not Path(lake.gold).exists() and not Path(lake.silver).exists()


def test_formats_that_cannot_hold_the_layout_are_refused(folder):
    with pytest.raises(ValueError, match="delta"):
        Lake(folder, fmt="delta")


def test_pretty_printed_documents_and_one_stamp(spark, folder):
    lake = Lake(folder, multi_line=True)
    put(lake, "1.json", json.dumps(document(result("A", times=(JAN,))), indent=2))
    ingest_new(spark, lake, processed_at=F.lit(datetime.datetime(2024, 5, 6)))
    assert read_silver(spark, lake).first().processed_at == datetime.datetime(2024, 5, 6)
    assert read_quarantine(spark, lake).count() == 0


def test_daily_key_of_a_lake(spark, folder):
    lake = Lake(folder, key=("symbol", "date"))
    put(lake, "1.json", document(result("A", times=(JAN, JAN + 1), close=[1.0, 2.0])))
    bronze_to_silver(spark, lake)
    assert len(closes(spark, lake)) == 1


def test_failed_batch_replaces_what_it_had_written(spark, lake, monkeypatch):
    put(lake, "1.json", document(result("A", times=(JAN, FEB))))

    def fail(*args, **kwargs):
        raise OSError("lost")

    with monkeypatch.context() as broken:
        broken.setattr(medallion, "write_quarantine_batch", fail)
        with pytest.raises(Exception, match="lost"):
            ingest_new(spark, lake)
    assert Path(lake.silver, "generation=0", "ingest_batch=1").exists()
    assert closes(spark, lake) == []
    put(lake, "2.json", document(result("B", times=(MAR,))))
    # The failed batch has no record: its number is used again, for all that is new.
    assert ingest_new(spark, lake) == [1]
    assert read_table(spark, lake.silver).count() == 3


def test_refresh_touches_only_changed_months_and_equals_a_rebuild(spark, lake):
    put(lake, "1.json", document(result("A", times=(JAN, FEB))), document(result("B", times=(FEB,))))
    ingest_new(spark, lake)
    silver_to_gold(spark, lake)

    def january():
        return {
            p: p.stat().st_mtime_ns
            for p in Path(lake.gold, "daily_metrics", "month=2024-01-01").iterdir()
        }

    before = january()
    put(lake, "2.json", document(result("B", times=(FEB, MAR), close=[7.0, 8.0])))
    ingest_new(spark, lake)
    months = changed_months(spark, lake, after_batch=1)
    assert sorted(months) == [datetime.date(2024, 2, 1), datetime.date(2024, 3, 1)]
    refresh_gold(spark, lake, months)
    assert january() == before
    refreshed = gold_rows(spark, lake)
    silver_to_gold(spark, lake)
    assert gold_rows(spark, lake) == refreshed
    refresh_gold(spark, lake, [])
    assert gold_rows(spark, lake) == refreshed


def test_refresh_covers_bars_without_a_valid_time(spark, lake):
    put(lake, "1.json", document(result("A", times=(JAN,))))
    ingest_new(spark, lake)
    silver_to_gold(spark, lake)
    put(lake, "2.json", document(result("A", times=(2**60,))))
    ingest_new(spark, lake)
    months = changed_months(spark, lake, after_batch=1)
    assert months == [None]
    refresh_gold(spark, lake, months)
    refreshed = gold_rows(spark, lake)
    silver_to_gold(spark, lake)
    assert gold_rows(spark, lake) == refreshed
    assert len(refreshed[0]) == 2


def test_one_stamp_over_all_gold_tables(spark, lake):
    put(lake, "1.json", document(result("A", times=(JAN,))))
    stamp = F.lit(datetime.datetime(2024, 5, 6))
    bronze_to_silver(spark, lake, processed_at=stamp)
    silver_to_gold(spark, lake, processed_at=stamp)
    tables = (*read_gold(spark, lake.gold), read_silver(spark, lake))
    assert {t.first().processed_at for t in tables} == {datetime.datetime(2024, 5, 6)}


def test_sql_over_registered_views(spark, lake):
    put(lake, "1.json", document(result("A", times=(JAN, FEB))))
    bronze_to_silver(spark, lake)
    silver_to_gold(spark, lake)
    register_views(read_gold(spark, lake.gold)._asdict() | {"silver": read_silver(spark, lake)})
    row = spark.sql(
        "SELECT count(*) AS n FROM silver s JOIN daily_metrics d USING (symbol, date)"
    ).first()
    assert row.n == 2


def test_update_catches_up_after_a_failed_refresh(spark, lake, monkeypatch):
    put(lake, "1.json", document(result("A", times=(JAN,), close=[1.0])))
    ingest_new(spark, lake)
    update_gold(spark, lake)
    put(lake, "2.json", document(result("A", times=(JAN, FEB), close=[2.0, 3.0])))
    ingest_new(spark, lake)

    def fail(*args, **kwargs):
        raise OSError("lost")

    with monkeypatch.context() as broken:
        broken.setattr(medallion, "_replace_all_time", fail)
        with pytest.raises(OSError):
            update_gold(spark, lake)
    assert ingest_new(spark, lake) == []
    update_gold(spark, lake)
    updated = gold_rows(spark, lake)
    assert read_gold(spark, lake.gold).symbol_metrics.first().avg_close == 2.5
    silver_to_gold(spark, lake)
    assert gold_rows(spark, lake) == updated
    monkeypatch.setattr(medallion, "refresh_gold", fail)
    update_gold(spark, lake)  # nothing new: nothing refreshed


def test_jobs_from_the_command_line(spark, lake):
    put(lake, "1.json", document(result("A", times=(JAN,))))
    main(["ingest", "--root", lake.root, "--then-gold", "--scale", "6"])
    put(lake, "2.json", document(result("B", times=(FEB,))))
    main(["ingest", "--root", lake.root, "--then-gold", "--scale", "6"])
    before = gold_rows(spark, lake)
    assert len(before[1]) == 2
    main(["rebuild", "--root", lake.root, "--scale", "6"])
    assert gold_rows(spark, lake) == before


@pytest.mark.parametrize("fmt", ["parquet", "orc", "json"])
def test_formats_append_and_replace(spark, folder, fmt):
    rows = spark.createDataFrame([("A", 1)], "symbol string, n bigint")
    append_table(rows, folder, fmt=fmt, partition_by=["symbol"])
    append_table(rows, folder, fmt=fmt, partition_by=["symbol"])
    assert read_table(spark, folder, fmt=fmt).count() == 2
    replace_table(rows, folder, fmt=fmt, partition_by=["symbol"])
    assert read_table(spark, folder, fmt=fmt).count() == 1
