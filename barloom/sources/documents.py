"""Chart documents on disk: list them, read them, land them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.schemas import DOCUMENT_DDL, RAW_TEXT
from barloom.sources.tables import literal, run_once


def _listed(spark: SparkSession, path: str | list[str], glob: str) -> DataFrame:
    """``content`` is never selected, so no file is opened."""
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", glob)
        .option("recursiveFileLookup", True)
        .load(literal(path) if isinstance(path, str) else [literal(p) for p in path])
    )


def list_documents(spark: SparkSession, path: str, *, glob: str = "*.json") -> DataFrame:
    """Path, time and size of every document file below ``path``."""
    return _listed(spark, path, glob).select("path", "modificationTime", "length")


def list_versions(
    spark: SparkSession, path: str | list[str], *, glob: str = "*.json"
) -> DataFrame:
    """The versions of the files below a folder, or several: what tells one from another.

    ``source_file`` is the path as documents name it, ``modified`` the time in microseconds
    since the epoch.
    """
    return _listed(spark, path, glob).select(
        "path",
        F.col("_metadata.file_path").alias("source_file"),
        F.unix_micros("modificationTime").alias("modified"),
        "length",
    )


def document_options(*, glob: str = "*.json", multi_line: bool = False) -> dict[str, object]:
    """Options shared by the batch and the streaming reader."""
    return {
        "pathGlobFilter": glob,
        "recursiveFileLookup": True,
        "multiLine": multi_line,
        "mode": "PERMISSIVE",
        "columnNameOfCorruptRecord": RAW_TEXT,
    }


def with_provenance(raw: DataFrame) -> DataFrame:
    """Add the file each document came from and when that file was written."""
    return raw.select(
        "chart",
        RAW_TEXT,
        F.col("_metadata.file_path").alias("source_file"),
        F.col("_metadata.file_modification_time").alias("ingested_at"),
    )


def read_documents(
    spark: SparkSession,
    path: str | list[str],
    *,
    glob: str = "*.json",
    multi_line: bool = False,
) -> DataFrame:
    """All documents below ``path``, a folder or a list of files, in one scan, one row per document.

    One document per line by default, so large files are split between tasks;
    ``multi_line`` reads pretty-printed files, one whole file per task. Paths are taken
    literally, whatever characters a file name has.
    """
    raw = (
        spark.read.schema(DOCUMENT_DDL)
        .options(**document_options(glob=glob, multi_line=multi_line))
        .json(literal(path) if isinstance(path, str) else [literal(p) for p in path])
    )
    return with_provenance(raw)


def land_documents(
    documents: DataFrame,
    path: str,
    *,
    partition_by: Sequence[str] = (),
    rebalance: bool = True,
    compression: str = "none",
) -> None:
    """Write documents as JSON lines, replacing only the folders written to.

    With ``partition_by=("run",)`` each landing run has its own folder, so a
    repeated run overwrites itself. The rebalance splits a folder that holds
    much of the data between tasks and gives a small one a single file. Pass
    ``rebalance=False`` for documents of a single folder that come straight from
    ``pack_documents``: its grouping has spread them already, and each task writes
    one file, without a second shuffle of all documents.

    With ``compression="gzip"`` the files end in ``.json.gz``, which a ``Lake`` has to name
    as its ``glob``. Such a file is read by one task.
    """
    options = {"ignoreNullFields": False, "compression": compression}
    if not partition_by:
        with run_once(documents.sparkSession):
            documents.select("chart").write.options(**options).mode("overwrite").json(path)
        return
    chosen = documents.select("chart", *partition_by)
    if rebalance:
        chosen = chosen.hint("rebalance", *partition_by)
    writer = chosen.write.options(**options).option("partitionOverwriteMode", "dynamic")
    with run_once(documents.sparkSession):
        writer.mode("overwrite").partitionBy(*partition_by).json(path)
