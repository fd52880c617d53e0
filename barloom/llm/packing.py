"""Packing documents into sequences: shortest pack first, over the length histogram.

Documents are cut into pieces of at most a sequence. Only the histogram of piece
lengths reaches the driver (as many rows as a sequence has tokens): from the longest
length to the shortest, pieces go to the packs with the most room left, many at once,
as packs filled alike are one pattern with a count. A pattern then takes a run of ranks
of each of its lengths, and pieces find their place by their rank within their length.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Mapping
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barloom.llm.common import keyed, steps, stored
from barloom.llm.tokens import with_end, word_ids

#: Cells in which ranks are counted: each holds about this share of the pieces.
CELLS = 4096


class Run(NamedTuple):
    """``times`` pieces of a length in each of ``packs`` sequences, from rank ``rank`` on."""

    length: int
    rank: int
    packs: int
    times: int
    sequence: int
    offset: int


def pack_histogram(histogram: Mapping[int, int], size: int) -> list[Run]:
    """Where the pieces of each length go, by their rank within the length."""
    # For each room left: patterns with that room, each a count and a list of
    # (length, times).
    room: list[list[tuple[int, tuple]]] = [[] for _ in range(size + 1)]
    most = 0

    def put(space: int, packs: int, pattern: tuple) -> None:
        nonlocal most
        room[space].append((packs, pattern))
        most = max(most, space)

    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        if not 0 < length <= size:
            raise ValueError(f"a piece of {length} does not fit a sequence of {size}")
        while left:
            while most and not room[most]:
                most -= 1
            if most < length:
                # New packs. Each takes one piece; the roomiest come again in turn.
                put(size - length, left, ((length, 1),))
                break
            packs, pattern = room[most].pop()
            taken = min(packs, left)
            if taken < packs:
                room[most].append((packs - taken, pattern))
            times = 1
            if taken == packs and not room[most]:
                # The only roomiest packs stay so until they are as full as the next.
                below = next((s for s in range(most - 1, length - 1, -1) if room[s]), length - 1)
                times = max(1, min(left // packs, (most - max(below, length - 1)) // length))
            last, again = pattern[-1]
            grown = (
                (*pattern[:-1], (last, again + times))
                if last == length
                else (*pattern, (length, times))
            )
            space = most - times * length
            left -= taken * times
            put(space, taken, grown)
    runs, ranks, sequence = [], dict.fromkeys(histogram, 0), 0
    for patterns in room:
        for packs, pattern in patterns:
            offset = 0
            for length, times in pattern:
                runs.append(Run(length, ranks[length], packs, times, sequence, offset))
                ranks[length] += packs * times
                offset += length * times
            sequence += packs
    return runs


def ranked(pieces: DataFrame, key: str, order: list[str]) -> DataFrame:
    """``pieces`` with ``rank``: places from 0 among the rows of equal ``key``.

    ``key`` has a bounded number of values. A key with many rows is divided by a hash
    of ``order``; rows are counted per part, and only parts are put in a row, so no
    task orders all rows of a key. Both tables sent to all tasks are bounded: one row
    per key, and at most ``CELLS`` more per part.
    """
    total = max(pieces.count(), 1)
    parts = F.ceil(F.count(F.lit(1)) * F.lit(float(CELLS)) / F.lit(float(total)))
    sizes = pieces.groupBy(key).agg(parts.alias("_parts"))
    rows = pieces.join(F.broadcast(sizes), key).withColumn(
        "_part", F.pmod(F.xxhash64(*order), F.col("_parts"))
    )
    earlier = Window.partitionBy(key).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    before = (
        rows.groupBy(key, "_part")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select(key, "_part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    )
    within = F.row_number().over(Window.partitionBy(key, "_part").orderBy(*order))
    return (
        rows.withColumn("_rank", within)
        .join(F.broadcast(before), [key, "_part"])
        .withColumn("rank", F.col("_before") + F.col("_rank") - 1)
        .drop("_parts", "_part", "_rank", "_before")
    )


def cut_documents(
    docs: DataFrame,
    tokenizer: str,
    end_id: int,
    size: int,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    with_ids: bool = True,
) -> DataFrame:
    """Pieces of at most ``size`` ids of every text, each text ended by ``end_id``.

    Columns: ``id_col``, ``start``, ``length``, ``ids_crc32``, ``doc_tokens`` and, if
    asked for, ``ids``. A null text has only ``end_id``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = word_ids(tokenizer)
        for batch in steps(batches, "text"):
            ids, ends = with_end(*words.ids(batch["text"]), end_id)
            counts = np.diff(ends)
            pieces = -(-counts // size)
            owner = np.repeat(np.arange(len(counts)), pieces)
            number = np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            starts = number * size
            lengths = np.minimum(size, counts[owner] - starts)
            places = ends[owner] + starts
            raw = ids.astype("<u4")
            crcs = [zlib.crc32(raw[a : a + n]) for a, n in zip(places, lengths, strict=True)]
            columns = {
                "id": batch["id"].take(pa.array(owner)),
                "start": pa.array(starts),
                "length": pa.array(lengths),
                "ids_crc32": pa.array(crcs, pa.int64()),
                "doc_tokens": pa.array(counts[owner]),
            }
            if with_ids:
                bounds = pa.array(np.append(places, len(ids)), pa.int32())
                columns["ids"] = pa.ListArray.from_arrays(bounds, pa.array(ids, pa.int32()))
            yield pa.RecordBatch.from_arrays([*columns.values()], [*columns])

    slim = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    columns = "start long, length long, ids_crc32 long, doc_tokens long"
    schema = keyed(slim, columns + (", ids array<int>" if with_ids else ""))
    return slim.mapInArrow(run, schema).withColumnRenamed("id", id_col)


def pack_pieces(pieces: DataFrame, size: int, order: list[str]) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``: no gaps, little padding.

    ``pieces`` is read several times, so it should be a written table. It has a column
    ``length``; ``order`` names columns that tell pieces apart. Rows equal in all of
    them are interchangeable.
    """
    histogram = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}
    runs = np.array(sorted(pack_histogram(histogram, size)), np.int64).reshape(-1, len(Run._fields))
    # Bounded: the patterns of a histogram of ``size`` lengths.
    shared = pieces.sparkSession.sparkContext.broadcast(runs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        length, first, packs, _, sequence, offset = shared.value.T
        starts = np.searchsorted(length, np.arange(size + 2))
        for batch in batches:
            lengths, ranks = batch["length"].to_numpy(), batch["rank"].to_numpy()
            found = np.zeros(len(ranks), np.int64)
            for value in np.unique(lengths):
                rows = lengths == value
                lo, hi = starts[value], starts[value + 1]
                found[rows] = lo + np.searchsorted(first[lo:hi], ranks[rows], "right") - 1
            time, copy = np.divmod(ranks - first[found], packs[found])
            yield pa.RecordBatch.from_arrays(
                [
                    batch["row"],
                    pa.array(sequence[found] + copy),
                    pa.array(offset[found] + time * lengths),
                ],
                ["row", "sequence_id", "offset"],
            )

    key = F.struct(*pieces.columns).alias("row")
    rows = ranked(pieces, "length", order).select(key, "length", "rank")
    kind = rows.schema["row"].dataType.simpleString()
    placed = rows.mapInArrow(run, f"row {kind}, sequence_id long, offset long")
    return placed.select("row.*", "sequence_id", "offset")


def pack_documents(
    docs: DataFrame,
    tokenizer: str,
    end_id: int,
    size: int = 4096,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    with_ids: bool = True,
) -> DataFrame:
    """Every text in pieces, each with its sequence and its place there.

    A null or empty text is a piece of one id, repeated rows are pieces of their own,
    other columns are ignored, and an empty table gives no rows. Texts longer than a
    sequence are cut into full ones and a rest.
    """
    pieces = cut_documents(
        docs, tokenizer, end_id, size, id_col=id_col, text_col=text_col, with_ids=with_ids
    )
    return pack_pieces(stored(pieces, "pieces"), size, [id_col, "start"])
