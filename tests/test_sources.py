"""Export over JDBC against a stand-in, session settings, scratch folders.

No database may be started here, so the export is checked for what it asks
Spark to write, not against a real database.
"""

from __future__ import annotations

import pytest
from pyspark.sql import DataFrameReader, DataFrameWriter

from barloom.scratch import scratch_folder
from barloom.session import (
    RUNTIME_CONF,
    apply_runtime_conf,
    build_session,
    delta_conf,
    object_store_conf,
)
from barloom.sources import (
    append_table,
    export_tables,
    land_documents,
    read_documents,
    read_table,
    replace_table,
)


@pytest.fixture
def database(monkeypatch):
    """Records writes; a read returns what was last written, or ``override``."""
    state = {"writes": [], "stored": {}, "override": None, "queries": []}

    def write(self, url, table, mode=None, properties=None):
        state["writes"].append((url, table, mode, properties))
        state["stored"][table] = len(self._df.collect())

    def load(self):
        query = self.asked["query"]
        state["queries"].append(query)
        n = state["override"] or state["stored"][query.rsplit(" ", 1)[1]]
        return self._spark.createDataFrame([(n,)], "n bigint")

    def option(self, key, value):
        self.asked = getattr(self, "asked", {}) | {key: value}
        return self

    monkeypatch.setattr(DataFrameWriter, "jdbc", write)
    monkeypatch.setattr(DataFrameReader, "option", option)
    monkeypatch.setattr(DataFrameReader, "load", load)
    return state


def test_export_replaces_each_table_from_executors(spark, database):
    tables = {"daily_metrics": spark.range(5), "symbol_metrics": spark.range(2)}
    export_tables(tables, "jdbc:x:y", properties={"user": "u"}, connections=3)
    assert [(w[1], w[2]) for w in database["writes"]] == [
        ("daily_metrics", "overwrite"),
        ("symbol_metrics", "overwrite"),
    ]
    assert database["queries"] == [
        "SELECT count(*) AS n FROM daily_metrics",
        "SELECT count(*) AS n FROM symbol_metrics",
    ]
    assert database["writes"][0][3] == {"user": "u", "batchsize": "10000", "numPartitions": "3"}


def test_export_reports_rows_inserted_twice(spark, database):
    database["override"] = 6
    with pytest.raises(RuntimeError, match="6 rows in the database, 5 written"):
        export_tables({"daily_metrics": spark.range(5)}, "jdbc:x:y")


def test_runtime_settings_are_applied(spark):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    apply_runtime_conf(spark)
    assert all(spark.conf.get(key) == value for key, value in RUNTIME_CONF.items())
    assert build_session("again").conf.get("spark.sql.session.timeZone") == "UTC"


def test_connector_settings():
    conf = object_store_conf("store:9000", "k", "s")
    assert conf["spark.hadoop.fs.s3a.endpoint"] == "http://store:9000"
    assert conf["spark.hadoop.fs.s3a.path.style.access"] == "true"
    assert object_store_conf("s", "k", "s", tls=True)["spark.hadoop.fs.s3a.endpoint"] == "https://s"
    assert "spark.sql.extensions" in delta_conf()


class StandIn:
    """As much of a session as the scratch folder looks at."""

    def __init__(self, master, checkpoint_dir=None):
        self.conf = {"spark.checkpoint.dir": checkpoint_dir} if checkpoint_dir else {}
        self.sparkContext = self
        self.master = master


def test_scratch_is_below_the_shared_folder_when_there_is_one():
    cluster = StandIn("yarn", "hdfs://shared/tmp/")
    first, second = scratch_folder(cluster, "x"), scratch_folder(cluster, "x")
    assert first.startswith("hdfs://shared/tmp/x-") and first != second


def test_scratch_is_local_only_for_a_local_session():
    assert scratch_folder(StandIn("local[8]"), "x").startswith("/tmp/run-")
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch_folder(StandIn("yarn"), "x")


def shuffle_files(spark):
    blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {blocks.apply(i).getName() for i in range(blocks.size()) if blocks.apply(i).getName().startswith("shuffle_")}


def test_shuffle_files_go_with_their_write(spark, folder):
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, kept = spark.conf.get(key), shuffle_files(spark)
    rows = spark.range(1000).selectExpr("id % 7 AS k", "id").groupBy("k").agg({"id": "sum"}).toDF("k", "n")
    replace_table(rows, f"{folder}/table")
    append_table(rows, f"{folder}/table")
    land_documents(rows.selectExpr("named_struct('k', k) AS chart"), f"{folder}/landed")
    replace_table(rows, f"{folder}/parts", partition_by=["k"])
    assert not shuffle_files(spark) - kept
    assert spark.conf.get(key) == before
    # A frame can still be written twice, and read after that.
    assert read_table(spark, f"{folder}/table").count() == 14 and rows.count() == 7
    assert sorted(r.n for r in rows.collect()) == sorted(r.n for r in read_table(spark, f"{folder}/parts").collect())


def test_compressed_documents_are_read_by_their_ending(spark, folder):
    documents = spark.sql("SELECT named_struct('result', null, 'error', 'none') AS chart")
    land_documents(documents, folder, compression="gzip")
    assert read_documents(spark, folder).count() == 0
    assert [r.chart.error for r in read_documents(spark, folder, glob="*.json.gz").collect()] == ["none"]
