"""Listings, versions of files and retention: nothing is lost, nothing read twice."""

from __future__ import annotations

import dataclasses
import datetime
import os
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from barloom.__main__ import main
from barloom.operators import on_date
from barloom.plans import (
    bronze_to_silver,
    compact_silver,
    fragmented_months,
    ledger,
    medallion,
    read_quarantine,
    read_silver,
    read_trailing,
    silver_to_gold,
    sweep,
    update_gold,
)
from barloom.sources import list_versions, read_documents, read_table
from barloom.streaming import ingest_new
from tests.samples import document, result
from tests.test_lake import DAY, FEB, JAN, MAR, closes, gold_rows, lake, put

__all__ = ["lake"]


def after_listing(monkeypatch, action):
    """Do something between the listing of a run and its reading."""
    right = medallion.read_documents

    def read(*args, **kwargs):
        action()
        return right(*args, **kwargs)

    monkeypatch.setattr(medallion, "read_documents", read)


@pytest.mark.parametrize("job", [bronze_to_silver, ingest_new])
def test_a_file_that_lands_between_listing_and_reading(spark, lake, monkeypatch, job):
    put(lake, "a.json", document(result("A", times=(JAN,), close=[1.0])))
    with monkeypatch.context() as during:
        after_listing(during, lambda: put(lake, "b.json", document(result("B", times=(JAN,), close=[2.0]))))
        job(spark, lake)
    assert closes(spark, lake) == [("A", JAN, 1.0)]
    assert len(ingest_new(spark, lake)) == 1
    assert closes(spark, lake) == [("A", JAN, 1.0), ("B", JAN, 2.0)]
    assert ingest_new(spark, lake) == []


def test_a_file_that_changes_between_listing_and_reading(spark, lake, monkeypatch):
    put(lake, "a.json", document(result("A", times=(JAN, FEB), close=[1.0, 1.0])))

    def change():
        put(lake, "a.json", document(result("A", times=(JAN,), close=[2.0])))
        os.utime(Path(lake.bronze, "a.json"), (JAN, JAN))

    with monkeypatch.context() as during:
        after_listing(during, change)
        bronze_to_silver(spark, lake)
    ingest_new(spark, lake)
    assert closes(spark, lake) == [("A", JAN, 2.0)]
    assert ingest_new(spark, lake) == []


NAMES = ["a[1].json", "a1.json", "a?.json", "a*.json", "a {x},y%20.json", "é +#&.json", "in {1}/[x].json", "q\\z.json"]


def test_file_names_are_no_patterns(spark, lake):
    for i, name in enumerate(NAMES):
        Path(lake.bronze, name).parent.mkdir(parents=True, exist_ok=True)
        put(lake, name, document(result(f"S{i}", times=(JAN,), close=[float(i)])))
    expected = sorted((f"S{i}", JAN, float(i)) for i in range(len(NAMES)))
    assert ingest_new(spark, lake) == [1]
    assert closes(spark, lake) == expected
    assert read_table(spark, lake.silver).count() == len(NAMES)
    assert ingest_new(spark, lake) == []
    bronze_to_silver(spark, lake)
    assert closes(spark, lake) == expected
    listed = {r.source_file for r in list_versions(spark, lake.bronze).collect()}
    assert listed == {r.source_file for r in read_documents(spark, lake.bronze).collect()}


def test_a_root_that_looks_like_a_pattern(spark, lake):
    lake = dataclasses.replace(lake, root=f"{lake.root}/[ab]{{1}}")
    put(lake, "1.json", document(result("A", times=(JAN,), close=[1.0])), "{bad")
    ingest_new(spark, lake)
    update_gold(spark, lake)
    assert closes(spark, lake) == [("A", JAN, 1.0)]
    assert len(gold_rows(spark, lake)[0]) == 1


def test_a_rewritten_file_replaces_its_bars(spark, lake):
    put(lake, "1.json", document(result("A", times=(JAN, FEB), close=[1.0, 1.0])))
    put(lake, "2.json", document(result("B", times=(JAN,), close=[3.0])))
    ingest_new(spark, lake)
    update_gold(spark, lake)
    put(lake, "1.json", document(result("A", times=(JAN,), close=[9.0])))
    os.utime(Path(lake.bronze, "1.json"), (JAN, JAN))  # an older time, too, is a change
    assert ingest_new(spark, lake) == [2]
    assert closes(spark, lake) == [("A", JAN, 9.0), ("B", JAN, 3.0)]
    assert [r.close for r in read_trailing(spark, lake, "5d").orderBy("symbol").collect()] == [9.0, 3.0]
    # February has lost its only bar.
    update_gold(spark, lake)
    refreshed = gold_rows(spark, lake)
    assert len(refreshed[0]) == 2 and len(refreshed[2]) == 1
    silver_to_gold(spark, lake)
    assert gold_rows(spark, lake) == refreshed
    assert ingest_new(spark, lake) == []


def test_a_file_put_back_as_it_was_is_new_again(spark, lake):
    first, second = (document(result("A", times=(JAN,), close=[c])) for c in (1.0, 2.0))
    put(lake, "1.json", first)
    os.utime(Path(lake.bronze, "1.json"), (JAN, JAN))
    ingest_new(spark, lake)
    put(lake, "1.json", second)
    ingest_new(spark, lake)
    put(lake, "1.json", first)
    os.utime(Path(lake.bronze, "1.json"), (JAN, JAN))
    assert ingest_new(spark, lake) == [3]
    assert closes(spark, lake) == [("A", JAN, 1.0)]


def test_a_repaired_file_leaves_quarantine(spark, lake):
    put(lake, "1.json", "{bad")
    put(lake, "2.json", "{bad", document(result("B", times=(JAN,), close=[3.0])))
    ingest_new(spark, lake)
    assert read_quarantine(spark, lake).count() == 2
    put(lake, "1.json", document(result("A", times=(JAN,), close=[1.0])))
    ingest_new(spark, lake)
    [left] = read_quarantine(spark, lake).collect()
    assert left.source_file.endswith("2.json")
    assert closes(spark, lake) == [("A", JAN, 1.0), ("B", JAN, 3.0)]


def test_a_run_that_failed_before_its_files_were_recorded(spark, lake, monkeypatch):
    put(lake, "1.json", "{bad", document(result("A", times=(JAN,), close=[1.0])))
    right = ledger.replace_table

    def fail(frame, path, **options):
        if path.startswith(lake.files):
            raise OSError("lost")
        right(frame, path, **options)

    with monkeypatch.context() as broken:
        broken.setattr(ledger, "replace_table", fail)
        with pytest.raises(OSError):
            ingest_new(spark, lake)
    assert len(ingest_new(spark, lake)) == 1
    assert closes(spark, lake) == [("A", JAN, 1.0)] and read_quarantine(spark, lake).count() == 1
    assert ingest_new(spark, lake) == []


def test_a_rewritten_file_replaces_compacted_bars(spark, lake):
    for day in range(3):
        put(lake, f"{day}.json", document(result("A", times=(JAN + day * DAY,), close=[float(day)])))
        ingest_new(spark, lake)
    january = datetime.date(2024, 1, 1)
    assert fragmented_months(spark, lake, min_batches=3) == [january]
    assert fragmented_months(spark, lake, min_batches=4) == []
    compact_silver(spark, lake, [january])
    assert fragmented_months(spark, lake, min_batches=2) == []
    put(lake, "1.json", document(result("A", times=(FEB,), close=[7.0])))
    ingest_new(spark, lake)
    expected = [("A", JAN, 0.0), ("A", JAN + 2 * DAY, 2.0), ("A", FEB, 7.0)]
    assert closes(spark, lake) == expected
    compact_silver(spark, lake, [january])
    sweep(spark, dataclasses.replace(lake, retention=datetime.timedelta(0)))
    assert closes(spark, lake) == expected


def test_readers_outlive_a_rebuild_and_a_compaction(spark, lake):
    put(lake, "1.json", document(result("A", times=(JAN,), close=[1.0])), "{bad")
    ingest_new(spark, lake)
    opened, defects = read_silver(spark, lake), read_quarantine(spark, lake)
    put(lake, "1.json", document(result("A", times=(JAN,), close=[2.0])))
    bronze_to_silver(spark, lake)
    assert [r.close for r in opened.collect()] == [1.0] and defects.count() == 1
    assert closes(spark, lake) == [("A", JAN, 2.0)]
    opened = read_silver(spark, lake)
    compact_silver(spark, lake, [datetime.date(2024, 1, 1)])
    assert [r.close for r in opened.collect()] == [2.0]
    # What was retired goes with a later run, not before its time.
    ingest_new(spark, lake)
    assert Path(ledger.generation_folder(lake.silver, 0)).exists()
    ingest_new(spark, dataclasses.replace(lake, retention=datetime.timedelta(0)))
    assert not Path(ledger.generation_folder(lake.silver, 0)).exists()
    assert closes(spark, lake) == [("A", JAN, 2.0)]
    assert sweep(spark, lake) == []


def test_a_rebuild_in_batches_and_after_a_failed_one(spark, lake, monkeypatch):
    for i in range(5):
        put(lake, f"{i}.json", document(result(f"S{i}", times=(JAN,), close=[float(i)])))
    expected = [(f"S{i}", JAN, float(i)) for i in range(5)]

    def fail(*args, **kwargs):
        raise OSError("lost")

    with monkeypatch.context() as broken:
        broken.setattr(medallion, "open_generation", fail)
        with pytest.raises(OSError):
            bronze_to_silver(spark, lake, max_files_per_batch=1)
    assert closes(spark, lake) == []
    # Fewer batches this time: the failed run's must not be read.
    Path(lake.bronze, "4.json").unlink()
    bronze_to_silver(spark, lake, max_files_per_batch=2)
    assert closes(spark, lake) == expected[:4]
    assert ingest_new(spark, lake) == []


def test_backlogs_are_cut_by_files_and_bytes(spark, lake):
    rows = [(f"p{i:02}", f"s{i}", i, 10, False) for i in range(7)]
    found = spark.createDataFrame(rows, ledger.PENDING_DDL)
    cut = lambda size, files: [
        [r.path for r in batch] for batch in medallion.file_batches(found, lake, size, files)
    ]
    names = [r[0] for r in rows]
    assert cut(1000, 7) == [names]
    assert cut(1000, 3) == [names[:3], names[3:6], names[6:]]
    assert cut(25, 100) == [names[:2], names[2:4], names[4:6], names[6:]]
    assert cut(25, 3) == [names[:2], [names[2]], names[3:5], [names[5]], [names[6]]]
    assert list(medallion.file_batches(found.where(F.lit(False)), lake, 1, 1)) == []


def test_a_trailing_range_after_the_newest_month_was_emptied(spark, lake):
    put(lake, "1.json", document(result("A", times=(JAN,), close=[1.0])))
    put(lake, "2.json", document(result("A", times=(MAR,), close=[2.0])))
    ingest_new(spark, lake)
    put(lake, "2.json", document(result("A", times=(JAN + DAY,), close=[3.0])))
    ingest_new(spark, lake)
    assert sorted(r.close for r in read_trailing(spark, lake, "5d").collect()) == [1.0, 3.0]


def test_closed_folders_are_not_listed(spark, lake):
    for run in ("1", "2"):
        Path(lake.bronze, f"run={run}").mkdir(parents=True)
        put(lake, f"run={run}/a.json", document(result(f"S{run}", times=(JAN,), close=[1.0])))
    assert ledger.open_folders(spark, lake, 0) is None  # nothing is known yet
    ingest_new(spark, lake)
    hasty = dataclasses.replace(lake, settle=datetime.timedelta(0))
    names = lambda of: sorted(Path(f).name for f in ledger.open_folders(spark, of, 0))
    assert names(lake) == ["run=1", "run=2"] and names(hasty) == []
    Path(lake.bronze, "run=3 [x]").mkdir()
    put(lake, "run=3 [x]/a.json", document(result("S3", times=(JAN,), close=[1.0])))
    put(lake, "run=1/late.json", document(result("S4", times=(JAN,), close=[1.0])))
    assert names(hasty) == ["run=3 [x]"]
    ingest_new(spark, hasty)
    assert {symbol for symbol, _, _ in closes(spark, lake)} == {"S1", "S2", "S3"}
    assert ingest_new(spark, hasty) == []
    ingest_new(spark, hasty, full_listing=True)
    assert {symbol for symbol, _, _ in closes(spark, lake)} == {"S1", "S2", "S3", "S4"}
    # Within the time to settle a late file needs no full listing.
    put(lake, "run=2/late.json", document(result("S5", times=(JAN,), close=[1.0])))
    assert len(ingest_new(spark, lake)) == 1
    # With files directly in bronze everything is listed.
    put(lake, "root.json", document(result("S6", times=(JAN,), close=[1.0])))
    assert ledger.open_folders(spark, hasty, 0) is None
    assert len(ingest_new(spark, hasty)) == 1


def executed(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_settled_months_are_read_without_an_exchange(spark, lake):
    put(lake, "1.json", document(result("A", times=(JAN, FEB), close=[1.0, 1.0])))
    put(lake, "2.json", document(result("A", times=(JAN,), close=[2.0])))
    os.utime(Path(lake.bronze, "1.json"), (JAN, JAN))
    bronze_to_silver(spark, lake)
    plan = executed(read_silver(spark, lake))
    assert "Exchange" not in plan and "Window" not in plan
    assert closes(spark, lake) == [("A", JAN, 2.0), ("A", FEB, 1.0)]
    # Another month in another batch: only that month is ranked.
    put(lake, "3.json", document(result("A", times=(FEB, MAR), close=[3.0, 3.0])))
    ingest_new(spark, lake)
    expected = [("A", JAN, 2.0), ("A", FEB, 3.0), ("A", MAR, 3.0)]
    both = read_silver(spark, lake)
    assert closes(spark, lake) == expected
    january = executed(on_date(both, datetime.date(2024, 1, 10)))
    assert "Window" in executed(both)
    assert [r.close for r in on_date(both, datetime.date(2024, 1, 10)).collect()] == [2.0]
    assert "ingest_batch" in january
    # Compacted together, all lies in one batch per month, and old folders are not read.
    compact_silver(spark, lake, [datetime.date(2024, 2, 1), datetime.date(2024, 3, 1)])
    plan = executed(read_silver(spark, lake))
    assert "Exchange" not in plan and closes(spark, lake) == expected
    update_gold(spark, lake)
    before = gold_rows(spark, lake)
    silver_to_gold(spark, lake)
    assert gold_rows(spark, lake) == before
    # A later version of a file in a settled month.
    put(lake, "2.json", document(result("A", times=(MAR,), close=[4.0])))
    ingest_new(spark, lake)
    assert closes(spark, lake) == [("A", FEB, 3.0), ("A", MAR, 4.0)]


def test_settled_months_with_other_keys_and_no_times(spark, lake):
    lake = dataclasses.replace(lake, key=("symbol", "date"))
    put(lake, "1.json", document(result("A", times=(JAN, JAN + 5, 2**60), close=[1.0, 2.0, 3.0])))
    bronze_to_silver(spark, lake)
    assert "Exchange" not in executed(read_silver(spark, lake))
    assert sorted(r.close for r in read_silver(spark, lake).collect()) == [2.0, 3.0]
    put(lake, "2.json", document(result("A", times=(2**60, FEB), close=[5.0, 6.0])))
    ingest_new(spark, lake)
    assert sorted(r.close for r in read_silver(spark, lake).collect()) == [2.0, 3.0, 5.0, 6.0]


def test_compaction_from_the_command_line(spark, lake):
    for i in range(2):
        put(lake, f"{i}.json", document(result("A", times=(JAN, FEB), close=[float(i), 1.0])))
        main(["ingest", "--root", lake.root, "--full-listing"])
    main(["compact", "--root", lake.root, "--min-batches", "2", "--retention", "0"])
    assert fragmented_months(spark, lake, min_batches=2) == []
    assert closes(spark, lake) == [("A", JAN, 1.0), ("A", FEB, 1.0)]
    main(["ingest", "--root", lake.root, "--retention", "0"])
    assert read_table(spark, lake.silver).count() == 2


def test_batches_of_symbols_that_lie_apart_are_read_without_an_exchange(spark, lake):
    put(lake, "1.json", document(result("A", times=(JAN, FEB), close=[1.0, 1.0])))
    ingest_new(spark, lake)
    put(lake, "2.json", document(result("C", times=(JAN, FEB), close=[2.0, 2.0])))
    put(lake, "3.json", document(result("D", times=(JAN,), close=[3.0])))
    ingest_new(spark, lake)
    plan = executed(read_silver(spark, lake))
    assert "Exchange hashpartitioning" not in plan and "Window" not in plan
    expected = [("A", JAN, 1.0), ("A", FEB, 1.0), ("C", JAN, 2.0), ("C", FEB, 2.0), ("D", JAN, 3.0)]
    assert closes(spark, lake) == expected
    # A correction between C and D: only these batches are ranked, and only in January.
    put(lake, "4.json", *(document(result(s, times=(JAN,), close=[c])) for s, c in (("CC", 4.0), ("D", 5.0))))
    ingest_new(spark, lake)
    both = read_silver(spark, lake)
    assert "Window" in executed(both)
    assert closes(spark, lake) == [*expected[:4], ("CC", JAN, 4.0), ("D", JAN, 5.0)]
    assert "Window" not in executed(on_date(both, datetime.date(2024, 2, 10)))
    # A later version of a file, under a symbol that lies apart from all others.
    put(lake, "1.json", document(result("Z", times=(JAN,), close=[6.0])))
    ingest_new(spark, lake)
    rest = [("C", JAN, 2.0), ("C", FEB, 2.0), ("CC", JAN, 4.0), ("D", JAN, 5.0)]
    assert closes(spark, lake) == [*rest, ("Z", JAN, 6.0)]
    compact_silver(spark, lake, [datetime.date(2024, 1, 1)])
    assert closes(spark, lake) == [*rest, ("Z", JAN, 6.0)]


def test_a_batch_with_copies_of_its_own_is_ranked(spark, lake):
    put(lake, "1.json", document(result("A", times=(JAN, FEB), close=[1.0, 1.0])))
    put(lake, "2.json", document(result("A", times=(JAN,), close=[2.0])))
    os.utime(Path(lake.bronze, "1.json"), (JAN, JAN))
    ingest_new(spark, lake)
    put(lake, "3.json", document(result("B", times=(JAN,), close=[3.0])))
    ingest_new(spark, lake)
    assert closes(spark, lake) == [("A", JAN, 2.0), ("A", FEB, 1.0), ("B", JAN, 3.0)]
    # By the day the bars of one batch are copies, though their times differ.
    put(lake, "4.json", document(result("D", times=(JAN, JAN + 1), close=[4.0, 5.0])))
    ingest_new(spark, lake)
    daily = dataclasses.replace(lake, key=("symbol", "date"))
    assert [r.symbol for r in read_silver(spark, daily).orderBy("symbol", "date").collect()] == ["A", "A", "B", "D"]
    assert len(closes(spark, lake)) == 5


def test_bars_without_a_symbol_or_a_time_are_no_reason_to_skip_the_ranking(spark, lake):
    values = {"close": [1.0, 2.0, 2.0], "adjclose": None}
    values |= {name: [None] * 3 for name in ("open", "high", "low", "volume")}
    nameless = document(result(None, times=(JAN,), close=[3.0]))
    put(lake, "1.json", document(result("A", times=(JAN, 2**60, 2**60), **values)), nameless, nameless)
    ingest_new(spark, lake)
    put(lake, "2.json", document(result("B", times=(JAN,), close=[4.0])))
    ingest_new(spark, lake)
    # Rows without a complete key are merged only if they are equal in every column.
    assert sorted(r.close for r in read_silver(spark, lake).collect()) == [1.0, 2.0, 3.0, 4.0]


def test_records_of_before_symbols_were_kept_are_ranked(spark, lake, monkeypatch):
    with monkeypatch.context() as before:
        before.setattr(ledger, "_symbols", lambda *args: (None, None, None))
        put(lake, "1.json", document(result("A", times=(JAN,), close=[1.0])))
        ingest_new(spark, lake)
    put(lake, "2.json", document(result("A", times=(JAN,), close=[2.0])))
    ingest_new(spark, lake)
    assert closes(spark, lake) == [("A", JAN, 2.0)]
    monkeypatch.setattr(medallion, "MAX_PARTS", 1)
    assert closes(spark, lake) == [("A", JAN, 2.0)]


def test_only_silver_and_defects_are_written_of_what_is_parsed(spark, lake):
    put(lake, "1.json", document(result("A", times=(JAN,), close=[1.0])))
    ingest_new(spark, lake)
    put(lake, "2.json", document(result("B", times=(JAN,), close=[2.0])), "{bad")
    ingest_new(spark, lake)
    layers = {p.name for p in Path(lake.root).iterdir()}
    assert layers == {"bronze", "silver", "quarantine", "runs", "files", "generations"}
    assert [r.ingest_batch for r in read_table(spark, lake.quarantine).collect()] == [2]
    assert [r.raw_text for r in read_quarantine(spark, lake).collect()] == ["{bad"]
    assert closes(spark, lake) == [("A", JAN, 1.0), ("B", JAN, 2.0)]


@pytest.mark.parametrize("job", [ingest_new, bronze_to_silver])
def test_a_batch_without_a_record_is_ranked_with_all_others(spark, lake, monkeypatch, job):
    put(lake, "1.json", document(result("A", times=(JAN,), close=[1.0])))
    job(spark, lake)
    put(lake, "2.json", document(result("B", times=(JAN,), close=[2.0])))
    ingest_new(spark, lake)
    put(lake, "1.json", document(result("A", times=(JAN,), close=[9.0])))
    right = ledger.replace_table

    def fail(frame, path, **options):
        if path.startswith(lake.runs):
            raise OSError("lost")
        right(frame, path, **options)

    with monkeypatch.context() as broken:
        broken.setattr(ledger, "replace_table", fail)
        with pytest.raises(OSError):
            ingest_new(spark, lake)
    expected = [("A", JAN, 9.0), ("B", JAN, 2.0)]
    assert closes(spark, lake) == expected
    assert len(ingest_new(spark, lake)) == 1
    assert closes(spark, lake) == expected


@pytest.mark.parametrize("files", [(3, 2), (2, 3), (2, 2)])
def test_rewritten_landings_of_other_numbers_of_files(spark, folder, files):
    from barloom.operators import pack_documents
    from barloom.plans import Lake
    from barloom.queries import LANDED, LANDED_GLOB, _rewrite
    from barloom.sources import land_documents

    lake = Lake(f"{folder}/lake", glob=LANDED_GLOB)
    landed = []
    for prefix, n, root in zip("WL", files, (lake.bronze, f"{folder}/new"), strict=True):
        rows = [(f"{prefix}{i}", datetime.datetime(2024, 1, 10), float(i)) for i in range(n)]
        bars = spark.createDataFrame(rows, "symbol string, datetime timestamp, close double")
        landed.append(f"{root}/rewritten")
        documents = pack_documents(bars).repartitionByRange(n, "symbol")
        land_documents(documents, landed[-1], **LANDED)
        assert len(list(Path(landed[-1]).glob("*.json.gz"))) == n
        if prefix == "L":
            _rewrite(spark, *landed)
        ingest_new(spark, lake)
    assert sorted((r.symbol, r.close) for r in read_silver(spark, lake).collect()) == [
        (f"L{i}", float(i)) for i in range(files[1])
    ]
