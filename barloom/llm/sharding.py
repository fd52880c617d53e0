"""Shards of near equal size: contiguous runs of atomic groups, cut at the minimax.

Documents with equal texts form one group, which no cut divides. Groups are taken
in the order of their text's SHA-256. The smallest feasible shard capacity is found
by binary search, each trial by a greedy check over prefix sums.

The search never lists all groups. It works on *cells*, runs of groups that share a
prefix of the hash: at first 4,096 of them. A cell with one group is atomic. Two
bounds enclose the best capacity: one that may cut other cells anywhere, and one
that may not cut them at all. While they differ, only the cells that a cut can fall
into are divided further, sixteen-fold, by one aggregation. So the answer is the
optimum over groups, and what reaches the driver is a bounded list of cells.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from itertools import accumulate
from typing import NamedTuple

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barloom.llm.common import stored

#: Hex digits of the first cells.
DIGITS = 3
HEX = "0123456789abcdef"


class Cell(NamedTuple):
    prefix: str
    size: int
    atomic: bool


def _greedy(sums: list[int], capacity: int, shards: int) -> list[int] | None:
    """Cell numbers where each shard ends, filled in turn; None if they don't suffice."""
    at, ends = 0, []
    for _ in range(shards):
        end = bisect_right(sums, sums[at] + capacity) - 1
        ends.append(end)
        if end == len(sums) - 1:
            return ends
        if end == at:
            return None
        at = end
    return None


def _fluid(cells: list[Cell], sums: list[int], capacity: int, shards: int) -> list[int] | None:
    """As ``_greedy``, in bytes, if cells that are not atomic could be cut anywhere."""
    at, ends = 0, []
    for _ in range(shards):
        target = at + capacity
        if target >= sums[-1]:
            return [*ends, sums[-1]]
        cell = bisect_right(sums, target) - 1
        end = sums[cell] if cells[cell].atomic else target
        if end <= at:
            return None
        at = end
        ends.append(at)
    return None


def _smallest(low: int, high: int, fits) -> int:
    while low < high:
        middle = (low + high) // 2
        if fits(middle):
            high = middle
        else:
            low = middle + 1
    return low


def bounds(cells: list[Cell], shards: int) -> tuple[int, int]:
    """Capacities below and above the best one: equal once it is known."""
    sums = [0, *accumulate(c.size for c in cells)]
    least = max([-(-sums[-1] // shards), *(c.size for c in cells if c.atomic)])
    low = _smallest(least, sums[-1], lambda c: _fluid(cells, sums, c, shards) is not None)
    high = _smallest(low, sums[-1], lambda c: _greedy(sums, c, shards) is not None)
    return low, high


def undecided(cells: list[Cell], shards: int, low: int, high: int) -> list[str]:
    """Prefixes of the cells in which a cut of the best partition can fall."""
    sums = [0, *accumulate(c.size for c in cells)]
    chosen, early = set(), 0
    for late in _fluid(cells, sums, high, shards) or []:
        # At capacity ``low`` with no cell cut, a shard ends no later than any other way.
        early = sums[bisect_right(sums, early + low) - 1]
        first = max(0, bisect_right(sums, early) - 1)
        last = min(len(cells) - 1, bisect_left(sums, late))
        chosen.update(c.prefix for c in cells[first : last + 1] if not c.atomic)
    return sorted(chosen)


def cuts(cells: list[Cell], shards: int, capacity: int) -> list[str]:
    """Where shards 1, 2, ... begin: none above ``capacity``, each near its even share."""
    sums = [0, *accumulate(c.size for c in cells)]
    # latest[m]: the first cell from which ``m`` shards can hold the rest.
    latest = [len(cells)]
    for _ in range(shards):
        latest.append(bisect_left(sums, sums[latest[-1]] - capacity))
    at, found = 0, []
    for left in range(shards - 1, 0, -1):
        share = sums[at] + (sums[-1] - sums[at]) // (left + 1)
        end = bisect_left(sums, share)
        if end > at and share - sums[end - 1] < sums[end] - share:
            end -= 1
        at = max(at, latest[left], min(end, bisect_right(sums, sums[at] + capacity) - 1))
        if at >= len(cells):
            break
        found.append(cells[at].prefix)
    return found


def _cells(slim: DataFrame, digits: int, inside: list[str] | None = None) -> list[Cell]:
    if inside is not None:
        slim = slim.filter(F.substring("_key", 1, digits - 1).isin(inside))
    mark = F.xxhash64("_key")
    rows = (
        slim.select(F.substring("_key", 1, digits).alias("prefix"), "size", mark.alias("mark"))
        .groupBy("prefix")
        .agg(
            F.sum("size").alias("size"),
            (F.min("mark") == F.max("mark")).alias("atomic"),
        )
        .collect()
    )
    return sorted(Cell(r["prefix"], r["size"], r["atomic"]) for r in rows)


def best_cuts(slim: DataFrame, shards: int) -> list[str]:
    """Where shards 1, 2, ... begin in the minimax partition of the groups of ``slim``."""
    cells = _cells(slim, DIGITS)
    if not cells:
        return []
    while True:
        low, high = bounds(cells, shards)
        open_cells = undecided(cells, shards, low, high) if low < high else []
        if not open_cells:
            return cuts(cells, shards, high)
        inner = []
        # Cells of one length at a time: those that were divided alike.
        for digits in sorted({len(p) for p in open_cells}):
            inner += _cells(slim, digits + 1, [p for p in open_cells if len(p) == digits])
        gone = set(open_cells)
        cells = sorted([*(c for c in cells if c.prefix not in gone), *inner])


def shard_documents(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shards: int = 24
) -> DataFrame:
    """Each document's shard and its place there.

    Returns ``id_col``, ``size`` (UTF-8 bytes of the text plus 8), ``text_crc32``,
    ``law`` (``bytes``), ``shard``, ``slot`` (gapless from 0 in a shard, by text hash,
    then id) and ``grown_shard`` (null). A null text counts as empty. Rows that are
    repeated in full each get a slot; a null id sorts first. An empty table gives no
    rows, other columns are ignored. If one group exceeds a fair share, its shard is as
    large as that group, and the others share the rest evenly.

    Slots are numbered within small cells of about a 4,096th of the rows, and cells are
    then placed one after another, so that no task orders a whole shard. A cell with
    more rows, as that of a text with very many copies, is divided by a hash of the id.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    slim = stored(
        docs.select(
            F.col(id_col),
            (F.octet_length(text) + 8).cast("long").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            F.sha2(text, 256).alias("_key"),
        ),
        "shards",
    )
    starts = best_cuts(slim, shards)
    shard = F.lit(0)
    for start in starts:
        shard = shard + (F.col("_key") >= start).cast("int")
    slim = slim.withColumns({"shard": shard, "_cell": F.substring("_key", 1, DIGITS)})

    rows = slim.count()
    parts = F.ceil(F.count(F.lit(1)) * F.lit(float(len(HEX) ** DIGITS)) / F.lit(float(max(rows, 1))))
    crowded = slim.groupBy("_cell").agg(parts.alias("_parts")).filter("_parts > 1")
    # At most 4,096 cells, so the table to send is bounded whatever the input.
    placed = slim.join(F.broadcast(crowded), "_cell", "left").withColumn(
        "_part", F.pmod(F.xxhash64(id_col), F.coalesce("_parts", F.lit(1)))
    )
    cell = ["shard", "_cell", "_part"]
    # Parts add up to no more than twice the cells, plus those divided by a cut.
    before = (
        placed.groupBy(*cell)
        .agg(F.count(F.lit(1)).alias("_n"))
        .select(
            *cell,
            F.coalesce(
                F.sum("_n").over(
                    Window.partitionBy("shard")
                    .orderBy("_cell", "_part")
                    .rowsBetween(Window.unboundedPreceding, -1)
                ),
                F.lit(0),
            ).alias("_before"),
        )
    )
    rank = F.row_number().over(Window.partitionBy(*cell).orderBy("_key", id_col))
    return (
        placed.withColumn("_rank", rank)
        .join(F.broadcast(before), cell)
        .select(
            id_col,
            "size",
            "text_crc32",
            F.lit("bytes").alias("law"),
            "shard",
            (F.col("_before") + F.col("_rank") - 1).alias("slot"),
            F.lit(None).cast("int").alias("grown_shard"),
        )
    )
