"""Token ids in binary files, coded in 64-bit words.

A word holds a selector in its top four bits and as many ids, of equal width, as fit
in the other sixty. An id that needs more than sixty bits is an escape: its word holds
the place of the id in a list of full 64-bit numbers. Words are chosen greedily within
blocks of ``BLOCK`` ids, all blocks of a file side by side.

A file image is little-endian:

    magic "S8B1", version, blocks, documents, escapes, words      (uint64 each, after it)
    per document   ids
    per block      first word, ids                                (and one end entry)
    escapes, words

As Spark writes no raw binary files to every store, the images are rows of a table:
``part`` and ``file`` order them, ``image`` is the file. Documents lie in ascending
order of their id.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barloom.llm.common import steps, stored
from barloom.llm.tokens import with_end, word_ids

MAGIC = int.from_bytes(b"S8B1", "little")
BLOCK = 1024
#: Ids after which a file is closed.
FILE_IDS = 1 << 20

# Ids per word and bits per id, by selector. Selector 0 is an escape.
COUNTS = np.array([1, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1], np.int64)
WIDTHS = np.array([0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60], np.int64)
PAYLOAD = np.uint64((1 << 60) - 1)


def _lanes(selector: int) -> np.ndarray:
    return (np.arange(COUNTS[selector]) * WIDTHS[selector]).astype(np.uint64)


def pack_words(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words, the first word of each block (and the end), and escapes of ``ids``."""
    ids = ids.astype(np.uint64)
    n = len(ids)
    # Bits of each id: exact for all 64 bits, unlike a logarithm in floating point.
    bits = np.ones(n, np.int64)
    for step in (32, 16, 8, 4, 2, 1):
        bits += step * (ids >> (bits + step - 1).astype(np.uint64) > 0)
    place = np.arange(n)
    block_end = np.minimum((place // BLOCK + 1) * BLOCK, n)
    selector = np.zeros(n, np.int64)
    for s in range(len(COUNTS) - 1, 0, -1):
        wide = np.where(bits > WIDTHS[s], place, n)
        next_wide = np.minimum.accumulate(wide[::-1])[::-1]
        fits = np.minimum(next_wide, block_end) - place >= COUNTS[s]
        selector[fits] = s
    after = place + COUNTS[selector]

    used = np.zeros(n, bool)
    at = np.arange(0, n, BLOCK)
    stop = np.minimum(at + BLOCK, n)
    while len(at):
        used[at] = True
        at = after[at]
        going = at < stop
        at, stop = at[going], stop[going]
    heads = np.flatnonzero(used)
    kinds = selector[heads]
    words = kinds.astype(np.uint64) << np.uint64(60)
    for s in range(1, len(COUNTS)):
        rows = np.flatnonzero(kinds == s)
        values = ids[heads[rows, None] + np.arange(COUNTS[s])] << _lanes(s)
        words[rows] |= np.bitwise_or.reduce(values, axis=1)
    escaped = np.flatnonzero(kinds == 0)
    words[escaped] |= np.arange(len(escaped), dtype=np.uint64)
    first = np.append(np.searchsorted(heads, np.arange(0, n, BLOCK)), len(words))
    return words, first.astype(np.uint64), ids[heads[escaped]]


def unpack_words(words: np.ndarray, escapes: np.ndarray) -> np.ndarray:
    """The ids of ``words``."""
    kinds = (words >> np.uint64(60)).astype(np.int64)
    ends = np.cumsum(COUNTS[kinds])
    out = np.zeros(int(ends[-1]) if len(ends) else 0, np.uint64)
    heads = ends - COUNTS[kinds]
    for s in range(1, len(COUNTS)):
        rows = np.flatnonzero(kinds == s)
        mask = np.uint64((1 << int(WIDTHS[s])) - 1)
        out[heads[rows, None] + np.arange(COUNTS[s])] = (words[rows, None] >> _lanes(s)) & mask
    rows = np.flatnonzero(kinds == 0)
    out[heads[rows]] = escapes[(words[rows] & PAYLOAD).astype(np.int64)]
    return out


def write_image(ids: np.ndarray, counts: np.ndarray) -> bytes:
    """A file image of documents with ``counts`` ids each."""
    words, first, escapes = pack_words(ids)
    blocks = np.append(np.full(len(first) - 1, BLOCK), 0)
    if len(first) > 1:
        blocks[-2] = len(ids) - BLOCK * (len(first) - 2)
    index = np.stack([first, blocks.astype(np.uint64)], axis=1)
    head = np.array([MAGIC, 1, len(first) - 1, len(counts), len(escapes), len(words)], np.uint64)
    parts = (head, counts.astype(np.uint64), index.ravel(), escapes, words)
    return b"".join(part.astype("<u8").tobytes() for part in parts)


class Image:
    """A file image, read."""

    def __init__(self, image: bytes):
        data = np.frombuffer(image, "<u8")
        magic, version, self.blocks, docs, escapes, words = map(int, data[:6])
        if magic != MAGIC or version != 1:
            raise ValueError("not a file of this format")
        at = 6
        self.counts, at = data[at : at + docs].astype(np.int64), at + docs
        self.index, at = data[at : at + 2 * self.blocks + 2].reshape(-1, 2), at + 2 * self.blocks + 2
        self.escapes, at = data[at : at + escapes], at + escapes
        self.words = data[at : at + words]
        if len(self.words) != words:
            raise ValueError("the file is cut short")

    def ids(self, first_block: int = 0, last_block: int | None = None) -> np.ndarray:
        """The ids of some blocks, without decoding others."""
        last_block = self.blocks if last_block is None else last_block
        start, end = int(self.index[first_block, 0]), int(self.index[last_block, 0])
        return unpack_words(self.words[start:end], self.escapes)


def write_token_files(
    docs: DataFrame, tokenizer: str, end_id: int, *, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The table of file images of all texts, in ascending order of ``id_col``.

    Columns: ``part``, ``file``, ``ids`` (array of ``id_col``), ``n_ids``, ``image``.
    Each document ends with ``end_id``; a null text has only that. Null ids come first,
    rows with equal ids are ordered by their text, and an empty table has no files.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = word_ids(tokenizer)
        file, keys, chunks, counts, held = 0, [], [], [], 0

        def close() -> pa.RecordBatch:
            nonlocal file, keys, chunks, counts, held
            image = write_image(np.concatenate(chunks), np.concatenate(counts))
            part = pa.array([file, held], pa.int64())
            ids = pa.concat_arrays(keys)
            row = pa.RecordBatch.from_arrays(
                [
                    part[:1],
                    pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids),
                    part[1:],
                    pa.array([image], pa.binary()),
                ],
                ["file", "ids", "n_ids", "image"],
            )
            file, keys, chunks, counts, held = file + 1, [], [], [], 0
            return row

        for batch in steps(batches, "text"):
            ids, ends = with_end(*words.ids(batch["text"]), end_id)
            keys.append(batch["id"])
            chunks.append(ids)
            counts.append(np.diff(ends))
            held += len(ids)
            if held >= FILE_IDS:
                yield close()
        if keys:
            yield close()

    slim = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    # The text's hash parts equal ids, so that one id cannot fill a task.
    ordered = slim.repartitionByRange("id", F.xxhash64("text")).sortWithinPartitions("id", "text")
    schema = f"file long, ids array<{slim.schema['id'].dataType.simpleString()}>, n_ids long, image binary"
    files = ordered.mapInArrow(run, schema)
    return files.withColumn("part", F.spark_partition_id())


def read_token_files(files: DataFrame, *, id_col: str = "doc_id") -> DataFrame:
    """Per document of the images: ``id_col``, ``start``, ``n_tokens``, ``ids_crc32``.

    ``start`` counts the ids of all documents before it, over all files in order.
    """
    totals = files.groupBy("part").agg(F.sum("n_ids").alias("n"))
    # One row for each partition that was written.
    base = F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    parts = totals.select("part", F.coalesce(base, F.lit(0)).alias("base"))
    order = Window.partitionBy("part").orderBy("file")
    before = F.sum("n_ids").over(order.rowsBetween(Window.unboundedPreceding, -1))
    starts = files.select("part", "file", F.coalesce(before, F.lit(0)).alias("inner"))
    starts = starts.join(parts, "part").select(
        "part", "file", (F.col("base") + F.col("inner")).alias("id_start")
    )
    # Written, so that the planner knows its size when it chooses how to join.
    starts = stored(starts, "starts")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                image = Image(batch["image"][i].as_py())
                ids = image.ids().astype("<u4")
                ends = np.append(0, np.cumsum(image.counts))
                crcs = [zlib.crc32(ids[a:b]) for a, b in zip(ends, ends[1:], strict=False)]
                key = pc.list_flatten(batch["ids"].slice(i, 1))
                start = ends[:-1] + batch["id_start"][i].as_py()
                yield pa.RecordBatch.from_arrays(
                    [key, pa.array(start), pa.array(image.counts), pa.array(crcs, pa.int64())],
                    ["id", "start", "n_tokens", "ids_crc32"],
                )

    kind = files.schema["ids"].dataType.elementType.simpleString()
    schema = f"id {kind}, start long, n_tokens long, ids_crc32 long"
    placed = files.join(starts, ["part", "file"]).select("ids", "id_start", "image")
    return placed.mapInArrow(run, schema).withColumnRenamed("id", id_col)


def token_files(
    docs: DataFrame, tokenizer: str, end_id: int, *, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Write all texts to files in the shared folder and read them back."""
    files = write_token_files(docs, tokenizer, end_id, id_col=id_col, text_col=text_col)
    return read_token_files(stored(files, "tokens"), id_col=id_col)
