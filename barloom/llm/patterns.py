"""Packing whole documents into as few sequences as can be, by patterns of few lengths.

Only the histogram of piece lengths reaches the driver (as many rows as a sequence has
tokens). There all *patterns* are listed, sets of up to ``FEW`` lengths that fill a
sequence exactly, and repeat counts are fitted to the histogram by non-negative least
squares, rounded, and fitted again to what is left. The residual, which no pattern fits,
is packed best fit first, longest pieces first. Pieces find their sequence by their rank
within their length.

Ranks need no order over all rows: a task counts the pieces of each length that it cuts,
and the counts of earlier tasks are added by a join on task and length.
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

#: Lengths in a pattern at most; three only up to sequences of ``LONG`` tokens, as their
#: number grows with the square of the size (350,000 at 2,048).
FEW, LONG = 3, 4096
#: Patterns that keep a repeat count after a fit: it bounds what is sent to all tasks.
KEPT = 20_000
#: Steps of a fit, and fits with one weighting.
STEPS, FITS = 150, 2


class Run(NamedTuple):
    """``times`` pieces of a length in each of ``packs`` sequences, from rank ``rank`` on."""

    length: int
    rank: int
    packs: int
    times: int
    sequence: int
    offset: int


def list_patterns(lengths: np.ndarray, size: int) -> np.ndarray:
    """All ways to fill ``size`` by up to ``FEW`` of the ascending ``lengths``.

    One row per pattern: places in ``lengths``, longest first, ``len(lengths)`` for none.
    """
    none = len(lengths)
    place = np.full(size + 1, -1)
    place[lengths] = np.arange(none)
    found = [np.full((int(place[size] >= 0), FEW), none)]
    found[0][:, 0] = place[size]
    for i in range(none - 1, -1, -1):
        rest = size - lengths[i]
        if rest <= 0:
            continue
        # The second is no longer than the first, the third no longer than the second.
        second = np.arange(np.searchsorted(lengths, min(rest, lengths[i]), "right"))
        third = rest - lengths[second]
        if size > LONG:
            second = second[third == 0]
            third = third[third == 0]
        third = np.where(third == 0, none, np.where(third <= lengths[second], place[third], -1))
        fits = third >= 0
        rows = np.full((int(fits.sum()), FEW), none)
        rows[:, 0], rows[:, 1], rows[:, 2] = i, second[fits], third[fits]
        found.append(rows)
    return np.concatenate(found)


def fit_counts(patterns: np.ndarray, amounts: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Repeat counts by non-negative least squares, by accelerated projected gradients.

    The residual of each length is weighted. Coordinates are scaled by how often their
    pattern's lengths occur, so that one step length fits all of them.
    """
    m = len(amounts)
    square = np.append(weights**2, 0.0)
    flat = patterns.ravel()
    often = np.bincount(flat, minlength=m + 1).astype(float)
    # A pattern's row sum of the normal matrix bounds what a step can overshoot.
    scale = 1.0 / np.maximum((square * often)[patterns].sum(axis=1), 1e-300)
    unit = max(float(amounts.max()), 1.0)
    goal = np.append(amounts / unit, 0.0)
    x = np.zeros(len(patterns))
    ahead, pace = x, 1.0
    for _ in range(STEPS):
        made = np.bincount(flat, np.repeat(ahead, FEW), minlength=m + 1)
        step = (square * (goal - made))[patterns].sum(axis=1)
        new = np.maximum(ahead + scale * step / FEW, 0.0)
        faster = (1 + np.sqrt(1 + 4 * pace * pace)) / 2
        ahead = new + (pace - 1) / faster * (new - x)
        x, pace = new, faster
    return x * unit


def round_counts(patterns: np.ndarray, counts: np.ndarray, amounts: np.ndarray) -> np.ndarray:
    """Whole counts that use no length more often than it occurs; ``amounts`` is used up.

    Fractions are carried from a pattern to the next one of nearly the same lengths.
    """
    total = np.floor(np.cumsum(counts) + 0.5)
    wanted = np.diff(total, prepend=0.0).astype(np.int64)
    for p in np.flatnonzero(wanted).tolist():
        row = [i for i in patterns[p].tolist() if i < len(amounts)]
        most = min(int(amounts[i]) // row.count(i) for i in row)
        wanted[p] = min(int(wanted[p]), most)
        for i in row:
            amounts[i] -= wanted[p]
    return wanted


def _grouped(row: list[int]) -> tuple[tuple[int, int], ...]:
    return tuple((length, row.count(length)) for length in sorted(set(row), reverse=True))


def pack_residual(histogram: Mapping[int, int], size: int) -> list[tuple[int, tuple]]:
    """Best fit, longest first: counts of packs and their (length, times).

    Packs that are filled alike are one group, so the work grows with the lengths, not
    with the pieces.
    """
    room: list[list[tuple[int, tuple]]] = [[] for _ in range(size + 1)]
    for length in sorted(histogram, reverse=True):
        left, space = histogram[length], length
        while left:
            while space < size and not room[space]:
                space += 1
            # The fullest packs with room, or new ones. A pack that still fits another
            # piece of the length is then the best fit for it.
            packs, pattern = room[space].pop() if room[space] else (left, ())
            times = min(space // length, left)
            filled = min(packs, left // times)
            if filled < packs and (pattern or space < size):
                room[space].append((packs - filled, pattern))
            room[space - times * length].append((filled, (*pattern, (length, times))))
            left -= filled * times
    return [group for groups in room for group in groups]


def _packings(lengths: np.ndarray, amounts: np.ndarray, size: int) -> Iterator[list[tuple]]:
    """Packings of the histogram after each fit: counts of packs and their (length, times)."""
    every = list_patterns(lengths, size)
    # What a piece left over costs: short ones find room more easily than long ones.
    for weights in (np.where(lengths * 8 < size, 0.4, 1.0), np.maximum(lengths / size, 0.01)):
        groups: list[tuple[int, tuple]] = []
        left, patterns = amounts.copy(), every
        for _ in range(FITS):
            there = np.append(left > 0, True)
            patterns = patterns[there[patterns].all(axis=1)]
            if len(patterns):
                counts, chosen = fit_counts(patterns, left, weights), patterns
                if len(patterns) > KEPT:
                    chosen = patterns[np.sort(np.argpartition(-counts, KEPT)[:KEPT])]
                    counts = fit_counts(chosen, left, weights)
                whole = round_counts(chosen, counts, left)
                for p in np.flatnonzero(whole).tolist():
                    row = [int(lengths[i]) for i in chosen[p] if i < len(lengths)]
                    groups.append((int(whole[p]), _grouped(row)))
            rest = {int(n): int(k) for n, k in zip(lengths, left, strict=True) if k}
            yield groups + pack_residual(rest, size)


def pack_lengths(histogram: Mapping[int, int], size: int) -> list[Run]:
    """Where the pieces of each length go, by their rank within the length.

    Of the packings after each fit the first one with the fewest sequences is taken; the
    search ends when none can be smaller.
    """
    if any(not 0 < length <= size for length in histogram):
        raise ValueError(f"pieces must have 1 to {size} tokens")
    if not histogram:
        return []
    lengths = np.array(sorted(histogram), np.int64)
    amounts = np.array([histogram[i] for i in lengths.tolist()], np.int64)
    least = -(-int(amounts @ lengths) // size)
    best, fewest = None, None
    for groups in _packings(lengths, amounts, size):
        packs = sum(count for count, _ in groups)
        if fewest is None or packs < fewest:
            best, fewest = groups, packs
        if fewest == least:
            break
    runs, ranks, sequence = [], dict.fromkeys(lengths.tolist(), 0), 0
    for packs, pattern in best:
        offset = 0
        for length, times in pattern:
            runs.append(Run(length, ranks[length], packs, times, sequence, offset))
            ranks[length] += packs * times
            offset += length * times
        sequence += packs
    return runs


def cut_whole(
    docs: DataFrame,
    tokenizer: str,
    end_id: int,
    size: int,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    with_ids: bool = True,
) -> DataFrame:
    """Pieces of every text, each text ended by ``end_id``; only longer ones are cut.

    Columns: ``id_col``, ``piece`` (from 0), ``start``, ``length``, ``ids_crc32`` and, if
    asked for, ``ids``; besides ``_task`` and ``_place``, the piece's place among those
    of its length that the task has cut.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = word_ids(tokenizer)
        seen = np.zeros(size + 1, np.int64)
        for batch in steps(batches, "text"):
            ids, ends = with_end(*words.ids(batch["text"]), end_id)
            counts = np.diff(ends)
            pieces = -(-counts // size)
            owner = np.repeat(np.arange(len(counts)), pieces)
            number = np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            starts = number * size
            lengths = np.minimum(size, counts[owner] - starts)
            order = np.argsort(lengths, kind="stable")
            _, first, same = np.unique(lengths[order], return_index=True, return_counts=True)
            place = np.empty(len(lengths), np.int64)
            place[order] = np.arange(len(order)) - np.repeat(first, same)
            place += seen[lengths]
            seen += np.bincount(lengths, minlength=size + 1)
            at = ends[owner] + starts
            raw = ids.astype("<u4")
            crcs = [zlib.crc32(raw[a : a + n]) for a, n in zip(at, lengths, strict=True)]
            columns = {
                "id": batch["id"].take(pa.array(owner)),
                "piece": pa.array(number, pa.int32()),
                "start": pa.array(starts),
                "length": pa.array(lengths),
                "ids_crc32": pa.array(crcs, pa.int64()),
                "_place": pa.array(place),
            }
            if with_ids:
                bounds = pa.array(np.append(at, len(ids)), pa.int32())
                columns["ids"] = pa.ListArray.from_arrays(bounds, pa.array(ids, pa.int32()))
            yield pa.RecordBatch.from_arrays([*columns.values()], [*columns])

    slim = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    columns = "piece int, start long, length long, ids_crc32 long, _place long"
    schema = keyed(slim, columns + (", ids array<int>" if with_ids else ""))
    pieces = slim.mapInArrow(run, schema).withColumnRenamed("id", id_col)
    return pieces.withColumn("_task", F.spark_partition_id())


def place_pieces(pieces: DataFrame, size: int) -> DataFrame:
    """Pieces of ``cut_whole`` with ``sequence_id`` and ``offset``, gapless from 0.

    ``pieces`` must be a written table, as its tasks' numbers have to stay. The counts
    that are joined have one row for each task and length, so pieces of a hot length are
    as many keys as tasks cut them.
    """
    counts = stored(pieces.groupBy("length", "_task").agg(F.count(F.lit(1)).alias("_n")), "counts")
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("_n").alias("n")).collect()}
    runs = np.array(sorted(pack_lengths(histogram, size)), np.int64).reshape(-1, len(Run._fields))
    # Bounded: a few rows for each of KEPT patterns and each length, twice over.
    shared = pieces.sparkSession.sparkContext.broadcast(runs)
    earlier = Window.partitionBy("length").orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select(
        "length", "_task", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before")
    )

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

    kept = [c for c in pieces.columns if c not in ("_task", "_place")]
    rows = pieces.join(before, ["length", "_task"]).select(
        F.struct(*kept).alias("row"), "length", (F.col("_before") + F.col("_place")).alias("rank")
    )
    kind = rows.schema["row"].dataType.simpleString()
    placed = rows.mapInArrow(run, f"row {kind}, sequence_id long, offset long")
    return placed.select("row.*", "sequence_id", "offset")


def pack_whole(
    docs: DataFrame,
    tokenizer: str,
    end_id: int,
    size: int = 2048,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    with_ids: bool = True,
) -> DataFrame:
    """Every text, whole if it fits a sequence, with its sequence and its place there.

    A longer text is cut into full sequences and a rest. A null or empty text is a piece
    of one id; repeated rows, null ids included, are pieces of their own; other columns
    are ignored whatever their names; an empty table gives no rows. Pieces of equal
    length are interchangeable, so ties need no order.
    """
    pieces = cut_whole(
        docs, tokenizer, end_id, size, id_col=id_col, text_col=text_col, with_ids=with_ids
    )
    return place_pieces(stored(pieces, "whole-pieces"), size)
