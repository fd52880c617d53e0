"""Read each landed file once, in as many batches as it takes, then stop."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession

from barloom.plans.lake import Lake
from barloom.plans.ledger import (
    current_generation,
    new_versions,
    newest_batch,
    open_generation,
    sweep,
)
from barloom.plans.medallion import MAX_BYTES, MAX_FILES, file_batches, write_batch


def ingest_new(
    spark: SparkSession,
    lake: Lake,
    *,
    max_bytes_per_batch: int = MAX_BYTES,
    max_files_per_batch: int = MAX_FILES,
    processed_at: Column | None = None,
    full_listing: bool = False,
) -> list[int]:
    """Ingest the files landed or changed since the last run; returns the batches written.

    One listing is compared by path, time and size with the versions that finished
    batches cover, so a file counts as new however old it is, and a version is read once.
    A later version replaces the bars and defects of the earlier ones. A batch's files
    are recorded last: one that failed half way is found again, and its folder replaced.
    The limits keep a backlog from becoming one batch.

    Folders in which nothing new was found for ``lake.settle`` are not listed; a file that
    lands there later is found by a run with ``full_listing``.
    """
    sweep(spark, lake)
    current = current_generation(spark, lake)
    generation = 0 if current is None else current
    found = new_versions(spark, lake, generation, full=full_listing)
    # Batch 0 belongs to a full rebuild.
    batch = newest_batch(spark, lake, generation) or 0
    written: list[int] = []
    for files in file_batches(found, lake, max_bytes_per_batch, max_files_per_batch):
        batch += 1
        write_batch(spark, files, lake, generation, batch, processed_at=processed_at)
        if current is None:
            open_generation(spark, lake, generation)
            current = generation
        written.append(batch)
    return written
