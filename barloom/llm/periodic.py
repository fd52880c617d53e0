"""Periodic runs of words: maximal pairs from the bottom-up LCP-interval tree.

A run with period p and length L is the maximal pair of its first place and the one p
later, whose common words are L - p; no other pairs of a distance so small against their
common words exist but those of a run and a multiple of its period. So runs are read off
the pairs and need no extension: a pair's left words differ and its right words differ.

For the texts of one step, all at once: suffixes are ranked by prefix doubling, ranks of
all steps are kept, and give the common words of neighbours in the suffix array. Only
texts in which some ``floor`` words come twice are taken, ``floor`` being the least that
the two places of a run have in common, and only intervals of that depth.

The intervals are closed bottom up. Each holds its places in text order, each with its
left word, which is its class. When two children are joined, a place of the smaller one
is compared with the neighbours that it gets in the larger one, and makes a maximal pair
with one of another class. More need not be looked at: an occurrence between the two
places of a run's pair would give the run a smaller period.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.llm.common import keyed, mix, span_hashes, steps, utf8, word_spans

#: Fewer places than this are put into a list one by one, more by merging.
ONE_BY_ONE = 16


def _floor(min_length: int, exponent: int) -> int:
    """The least number of words that the two places of a run's pair have in common."""
    return min(max((exponent - 1) * p, min_length - p) for p in range(1, max(min_length, 2)))


def _repeating(words: np.ndarray, ends: np.ndarray, floor: int) -> np.ndarray:
    """Texts in which some ``floor`` words come twice; by hash, so a few more."""
    counts = np.diff(ends)
    text = np.repeat(np.arange(len(counts)), counts)
    grams = mix(text.astype(np.uint64) + np.uint64(1))
    marks = mix(words.astype(np.uint64) + np.uint64(1))
    for k in range(min(floor, len(words))):
        factor = np.uint64(pow(0x9E3779B97F4A7C15, k + 1, 1 << 64))
        grams[: len(marks) - k] += marks[k:] * factor
    grams = grams[np.arange(len(words)) + floor <= ends[1:][text]]
    text = text[np.arange(len(words)) + floor <= ends[1:][text]]
    order = np.argsort(grams)
    same = grams[order[1:]] == grams[order[:-1]]
    return np.unique(text[order[1:][same]])


def _suffixes(words: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The suffix array of all texts, text after text, and common words of neighbours."""
    n = len(words)
    counts = np.diff(ends)
    text = np.repeat(np.arange(len(counts)), counts)
    stop = ends[1:][text]
    key = text * (int(words.max()) + 1) + words
    live = np.argsort(key, kind="stable")
    key = key[live]
    rank, old = np.zeros(n, np.int64), np.zeros(n, np.int64)
    levels, step = [], 1
    while True:
        # ``live`` in order of ``key``, which refines the groups of equal ``old``.
        place = np.arange(len(live))
        first = np.append(True, key[1:] != key[:-1]) if len(live) else np.zeros(0, bool)
        group = np.append(True, old[1:] != old[:-1]) if len(live) else np.zeros(0, bool)
        shift = np.maximum.accumulate(np.where(first, place, 0))
        shift -= np.maximum.accumulate(np.where(group, place, 0))
        rank[live] = old + shift
        levels.append(np.append(rank, -1).astype(np.int32))
        single = first & np.append(first[1:], True)
        live = live[~single]
        if not len(live):
            break
        ahead = live + step
        second = np.where(ahead < stop[live], rank[np.minimum(ahead, n - 1)], -1) + 1
        key = rank[live] * (n + 1) + second
        order = np.argsort(key, kind="stable")
        live, key = live[order], key[order]
        old = rank[live]
        step *= 2
    array = np.empty(n, np.int64)
    array[rank] = np.arange(n)
    # Equal ranks of level k are 2^k equal words of one text; -1 and other texts differ.
    common = np.zeros(n - 1, np.int64)
    for k in range(len(levels) - 1, -1, -1):
        level = levels.pop()
        equal = level[array[:-1] + common] == level[array[1:] + common]
        common[equal] += 1 << k
    return array, common


class _Pairs:
    """Maximal pairs of one text whose distance is small enough, by start and length."""

    def __init__(self, left: dict[int, int], min_length: int, exponent: int):
        self.left, self.min_length, self.exponent = left, min_length, exponent
        self.periods: dict[tuple[int, int], int] = {}

    def _pair(self, a: int, b: int, depth: int) -> None:
        period = b - a
        if (self.exponent - 1) * period <= depth and depth + period >= self.min_length:
            if self.left[a] != self.left[b]:
                # A multiple of a run's period has its start and length, too.
                key = (a, depth + period)
                if period < self.periods.get(key, period + 1):
                    self.periods[key] = period

    def _join(self, one: list[int], other: list[int], depth: int) -> list[int]:
        """The places of two children of an interval of ``depth``, in text order."""
        small, large = sorted((one, other), key=len)
        for place in small:
            k = bisect_left(large, place)
            if k:
                self._pair(large[k - 1], place, depth)
            if k < len(large):
                self._pair(place, large[k], depth)
        if len(small) < ONE_BY_ONE:
            for place in small:
                insort(large, place)
        else:
            large += small
            large.sort()  # two sorted runs are merged
        return large

    def climb(self, places: list[int], common: list[int]) -> None:
        """Close the intervals of a part of the suffix array, the deepest ones first."""
        open_ones: list[tuple[int, list[int]]] = []
        for place, depth in zip(places, [*common, 0], strict=True):
            node = [place]
            while open_ones and open_ones[-1][0] > depth:
                inner, before = open_ones.pop()
                node = self._join(before, node, inner)
            if open_ones and open_ones[-1][0] == depth:
                node = self._join(open_ones.pop()[1], node, depth)
            open_ones.append((depth, node))


def find_runs(
    words: np.ndarray, ends: np.ndarray, min_length: int, exponent: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Text, start, length and period of all runs, in order of text, start and period.

    ``words`` are numbers from 0, ``ends`` where each text's words start and the last end.
    """
    none = np.zeros(0, np.int64)
    floor = _floor(min_length, exponent)
    some = _repeating(words, ends, floor)
    if not len(some):
        return none, none, none, none
    counts = np.diff(ends)[some]
    inner = np.append(0, np.cumsum(counts))
    shift = np.repeat(ends[some] - inner[:-1], counts)
    words = words[np.arange(len(shift)) + shift]
    array, common = _suffixes(words, inner)

    deep = common >= floor
    part = np.append(0, np.cumsum(~deep))
    inside = np.append(deep, False) | np.append(False, deep)
    places, part = array[inside], part[inside]
    if not len(places):
        return none, none, none, none
    # A part can hold a run's pair only if its nearest places are near enough.
    order = np.lexsort((places, part))
    gaps = np.diff(places[order])
    gaps[np.diff(part[order]) > 0] = len(words)
    heads = np.flatnonzero(np.append(True, np.diff(part) > 0))
    least = np.minimum.reduceat(np.append(gaps, len(words)), heads)
    depths = np.append(np.where(deep, common, 0), 0)[inside]
    most = np.maximum.reduceat(depths, heads)
    tails = np.append(heads[1:], len(places))
    chosen = np.flatnonzero(least * (exponent - 1) <= most)

    first = np.zeros(len(words), bool)
    first[inner[:-1]] = True
    left = np.where(first, -1, np.roll(words, 1))
    found = []
    for k in chosen.tolist():
        rows = slice(heads[k], tails[k])
        some_places = places[rows].tolist()
        pairs = _Pairs(dict(zip(some_places, left[places[rows]].tolist(), strict=True)), min_length, exponent)
        pairs.climb(some_places, depths[rows][:-1].tolist())
        found += [(start, length, period) for (start, length), period in pairs.periods.items()]
    if not found:
        return none, none, none, none
    table = np.array(found, np.int64)
    # Parts of the suffix array may meet one run at different multiples of its period.
    table = table[np.lexsort((table[:, 2], table[:, 1], table[:, 0]))]
    fresh = np.append(True, (np.diff(table[:, :2], axis=0) != 0).any(axis=1))
    table = table[fresh]
    table = table[np.lexsort((table[:, 2], table[:, 0]))]
    text = np.searchsorted(inner, table[:, 0], "right") - 1
    return some[text], table[:, 0] - inner[text], table[:, 1], table[:, 2]


def _collapsed(raw: bytes, starts: list[int], lengths: list[int], periods: list[int]) -> bytes:
    # ``split`` parts bytes at the same six characters as ``SPACE``.
    words = raw.split()
    if not starts:
        return b" ".join(words)
    kept = np.ones(len(words), bool)
    for start, length, period in zip(starts, lengths, periods, strict=True):
        kept[start + period : start + length] = False
    return b" ".join(words[i] for i in np.flatnonzero(kept).tolist())


def periodic_runs(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_length: int = 6,
    exponent: int = 4,
) -> DataFrame:
    """The runs of every text, and the text with each of them brought to one period.

    A run is a stretch of at least ``min_length`` words, and of ``exponent`` (2 or more)
    times its smallest period, that cannot be extended. Columns: ``id_col``, ``n_words``,
    ``runs`` (array of ``start``, ``length``, ``period`` by start, then period) and
    ``collapsed``: the words that no run holds after its first period, joined by one space.

    A null or empty text has no words, no runs and an empty ``collapsed``. Repeated rows
    and null ids are rows of their own; other columns are ignored whatever their names;
    an empty table gives no rows. A text is worked on whole, in one task: its memory is
    some hundred bytes a word of those texts that repeat words at all.
    """
    if exponent < 2 or min_length < 2:
        raise ValueError("a run has two periods and two words at least")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, "text"):
            data, offsets = utf8(batch["text"])
            starts, ends, text = word_spans(data, offsets)
            _, words = np.unique(span_hashes(data, starts, ends), return_inverse=True)
            bounds = np.searchsorted(text, np.arange(batch.num_rows + 1))
            owner, *columns = find_runs(words, bounds, min_length, exponent)
            at = np.searchsorted(owner, np.arange(batch.num_rows + 1))
            raw = data.tobytes()
            some = [column.tolist() for column in columns]
            collapsed = [
                _collapsed(
                    raw[offsets[i] : offsets[i + 1]], *(column[at[i] : at[i + 1]] for column in some)
                )
                for i in range(batch.num_rows)
            ]
            runs = pa.StructArray.from_arrays(
                [pa.array(column, pa.int64()) for column in columns], ["start", "length", "period"]
            )
            yield pa.RecordBatch.from_arrays(
                [
                    batch["id"],
                    pa.array(np.diff(bounds)),
                    pa.ListArray.from_arrays(pa.array(at, pa.int32()), runs),
                    pa.array(collapsed, pa.binary()).cast(pa.string()),
                ],
                ["id", "n_words", "runs", "collapsed"],
            )

    slim = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    runs = "array<struct<start: long, length: long, period: long>>"
    schema = keyed(slim, f"n_words long, runs {runs}, collapsed string")
    return slim.mapInArrow(run, schema).withColumnRenamed("id", id_col)
