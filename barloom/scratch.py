"""Where a job may write intermediate tables."""

from __future__ import annotations

import functools
import tempfile
import uuid

from pyspark.sql import SparkSession


@functools.cache
def _local_base() -> str:
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new folder name under the shared folder of ``spark.checkpoint.dir``.

    A machine-local folder is used only when the session itself is local: on a
    cluster the other machines could not read what was written there.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        base = _local_base()
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
