"""Helpers shared by the corpus operators."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from barloom.scratch import scratch_folder

#: Bytes of text that one numpy step works on; longer texts are taken alone.
STEP_BYTES = 2 << 20


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: its lineage is cut."""
    path = scratch_folder(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def keyed(slim: DataFrame, columns: str) -> StructType:
    """A schema of ``slim``'s column ``id``, in its own type, and of ``columns``."""
    key = StructField("id", slim.schema["id"].dataType)
    return StructType([key, *StructType.fromDDL(columns).fields])


def named(columns: list[str]) -> list[Column]:
    """Columns by their whole names, also those with a dot in them."""
    return [F.col(f"`{name.replace('`', '``')}`") for name in columns]


def remainder(column: str, divisor: int):
    """crc32 of a number written as text, modulo ``divisor``."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % divisor


def steps(
    batches: Iterator[pa.RecordBatch], text: str, max_bytes: int = STEP_BYTES
) -> Iterator[pa.RecordBatch]:
    """Slices of the batches with at most ``max_bytes`` of text, or one row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch[text]), 0).to_numpy(False))
        start, done = 0, 0
        while start < batch.num_rows:
            stop = max(start + 1, int(np.searchsorted(ends, done + max_bytes, "right")))
            yield batch.slice(start, stop - start)
            start, done = stop, int(ends[stop - 1])


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts in a row, and where each text starts and the last ends.

    A null is an empty text.
    """
    column = pc.fill_null(column, "").cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64)
    offsets = offsets[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


#: Bytes that separate words: the complement of ``[^\x20\x09-\x0D]``.
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True


def word_spans(
    data: np.ndarray, offsets: np.ndarray, inside: np.ndarray = ~SPACE
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and text number of every longest run of ``inside`` bytes in a text."""
    flag = np.zeros(len(data) + 2, np.int8)
    flag[1:-1] = inside[data]
    step = np.diff(flag)
    starts, ends = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
    # A word ends where its text ends, even if the next text begins with a word.
    cuts = offsets[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < len(data))]
    cuts = np.unique(cuts[(flag[cuts] == 1) & (flag[cuts + 1] == 1)])
    if len(cuts):
        starts, ends = np.sort(np.append(starts, cuts)), np.sort(np.append(ends, cuts))
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def mix(value: np.ndarray) -> np.ndarray:
    """A well-spread 64-bit hash of 64-bit numbers."""
    value = value.astype(np.uint64, copy=True)
    value ^= value >> np.uint64(30)
    value *= np.uint64(0xBF58476D1CE4E5B9)
    value ^= value >> np.uint64(27)
    value *= np.uint64(0x94D049BB133111EB)
    value ^= value >> np.uint64(31)
    return value


_BASE = 0x9E3779B97F4A7C15 | 1
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}
_BYTE = mix(np.arange(1, 257, dtype=np.uint64))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    size = 1 << max(16, (n + 1).bit_length())
    if size not in _POWERS:
        _POWERS.clear()
        out = []
        for base in (_BASE, pow(_BASE, -1, 1 << 64)):
            row = np.full(size, base, np.uint64)
            row[0] = 1
            out.append(np.multiply.accumulate(row))
        _POWERS[size] = (out[0], out[1])
    return _POWERS[size]


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes of each span: equal bytes, equal hash."""
    up, down = _powers(len(data))
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * up[: len(data)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))
