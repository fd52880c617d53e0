"""Near-duplicate embeddings: PCA-ordered comparison of tiles within a label.

Vectors are scaled to length one and turned to the axes of largest variance, which
leaves every cosine as it is. Leading coordinates then hold most of a difference, so

* a tile (neighbours in an order along the first axes) is compared only with tiles
  whose boxes in the leading coordinates come near enough;
* two tiles' products are summed over a few leading coordinates at a time. What the rest
  can still add is bounded by the lengths of both suffixes, and a row or column that
  cannot reach the threshold any more is dropped. Products that the bound leaves are
  completed, and those near the threshold are recomputed from the vectors as given.

Equal vectors are one class, compared once. A pair of tiles gives the links of each of
their vectors as a count, and of the links themselves only a spanning forest: enough for
the components, and never more than there are vectors in the two tiles.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType

from barloom.llm.common import stored
from barloom.llm.components import components

#: Vectors in a tile, those of it that are compared at a time, and axes that tiles are
#: ordered and bounded by.
TILE = 4096
BLOCK = 1024
LEAD = 8
#: Tiles on the one side of a task that looks for tiles near each other.
BOXES = 512
#: Coordinates added between two tests of the bound.
STEP = 8
#: Rounding of a product of unit vectors stays far below this.
SLACK = 1e-9


def _stack(column: pa.Array) -> np.ndarray:
    return np.array([row.values.to_numpy() for row in column], float)


def unit_rows(x: np.ndarray) -> np.ndarray:
    """Rows scaled to length one; none is zero."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def covariance_axes(units: DataFrame) -> np.ndarray:
    """Axes of the unit vectors by falling variance, from their second moments.

    Each task adds up the moments of its vectors; the sums have a fixed size.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            x = _stack(batch["unit"])
            total = x.T @ x + (0 if total is None else total)
        if total is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(total.size)), pa.array(total.ravel())], ["place", "moment"]
            )

    sums = units.select("unit").mapInArrow(run, "place long, moment double")
    # A square of the vectors' length, as two columns of numbers.
    found = sums.groupBy("place").agg(F.sum("moment").alias("moment")).toArrow()
    size = round(found.num_rows ** 0.5)
    moments = np.zeros(size * size)
    moments[found["place"].to_numpy()] = found["moment"].to_numpy()
    return np.linalg.eigh(moments.reshape(size, size))[1][:, ::-1]


def compare_tiles(
    x: np.ndarray, y: np.ndarray, threshold: float
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows, columns and cosines of all pairs of the tiles that may reach ``threshold``."""
    rows, columns = np.arange(len(x)), np.arange(len(y))
    x_left = np.sqrt(np.cumsum((x * x)[:, ::-1], axis=1)[:, ::-1])
    y_left = np.sqrt(np.cumsum((y * y)[:, ::-1], axis=1)[:, ::-1])
    total = np.zeros((len(x), len(y)))
    size = x.shape[1]
    for start in range(0, size, STEP):
        stop = min(size, start + STEP)
        total += x[rows, start:stop] @ y[columns, start:stop].T
        if stop < size:
            possible = total + np.outer(x_left[rows, stop], y_left[columns, stop])
            possible = possible >= threshold - SLACK
        else:
            possible = total >= threshold - SLACK
        keep_rows, keep_columns = possible.any(axis=1), possible.any(axis=0)
        if not (keep_rows.all() and keep_columns.all()):
            rows, columns = rows[keep_rows], columns[keep_columns]
            total = total[np.ix_(keep_rows, keep_columns)]
            possible = possible[np.ix_(keep_rows, keep_columns)]
        if not len(rows):
            break
    at_row, at_column = np.nonzero(possible) if len(rows) else ([], [])
    return rows[at_row], columns[at_column], total[at_row, at_column]


def forest(a: np.ndarray, b: np.ndarray, nodes: int) -> list[int]:
    """Places of the links that join what earlier links did not."""
    parent = list(range(nodes))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    kept = []
    for place, (i, j) in enumerate(zip(a.tolist(), b.tolist(), strict=True)):
        i, j = root(i), root(j)
        if i != j:
            parent[max(i, j)] = min(i, j)
            kept.append(place)
    return kept


def _tiled(units: DataFrame, axes: np.ndarray) -> DataFrame:
    """``node``, ``label``, turned ``unit``, and ``cell``: where it lies on the first axes."""
    shared = units.sparkSession.sparkContext.broadcast(axes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            turned = _stack(batch["unit"]) @ shared.value
            bounds = pa.array(np.arange(len(turned) + 1) * turned.shape[1], pa.int32())
            lists = pa.ListArray.from_arrays(bounds, pa.array(turned.ravel()))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], lists], [*batch.schema.names[:-1], "unit"]
            )

    kind = units.schema["label"].dataType.simpleString()
    given = units.schema["vector"].dataType.simpleString()
    columns = f"node long, label {kind}, copies long, vector {given}, unit array<double>"
    return units.select("node", "label", "copies", "vector", "unit").mapInArrow(run, columns)


def _with_tiles(turned: DataFrame) -> DataFrame:
    """``tile``: at most about ``TILE`` neighbours of one label in the order of the axes.

    A label's vectors are first divided by the first axis at its quantiles, and these
    by the second axis; quantiles are sketched, so no task orders a whole label.
    """
    axis = lambda k: F.coalesce(F.get("unit", F.lit(k)), F.lit(0.0))
    sizes = turned.groupBy("label").agg(F.count(F.lit(1)).alias("n"))
    sizes = sizes.withColumn("cuts", F.greatest(F.ceil(F.sqrt(F.col("n") / TILE)), F.lit(1)))
    sketch = lambda k: F.percentile_approx(axis(k), F.lit(_CUTS), F.lit(1000))
    first = turned.groupBy("label").agg(sketch(0).alias("marks")).join(sizes, "label")
    first = stored(first.select("label", "cuts", "marks"), "marks")
    place = F.size(F.filter("marks", lambda mark: mark < axis(0)))
    strip = F.floor(place * F.col("cuts") / (len(_CUTS) + 1)).alias("strip")
    strips = turned.join(first, "label").withColumn("strip", strip)
    second = strips.groupBy("label", "strip").agg(sketch(1).alias("marks2"))
    second = stored(second, "marks")
    place = F.size(F.filter("marks2", lambda mark: mark < axis(1)))
    part = F.floor(place * F.col("cuts") / (len(_CUTS) + 1))
    # A part with many near copies is divided by a hash; its tiles are all compared.
    tiles = strips.join(second, ["label", "strip"]).withColumn("part", part)
    crowd = tiles.groupBy("label", "strip", "part").agg(F.ceil(F.count(F.lit(1)) / TILE).alias("more"))
    crowd = stored(crowd, "crowd")
    tiles = tiles.join(crowd, ["label", "strip", "part"])
    tile = F.struct("label", "strip", "part", F.pmod(F.xxhash64("node"), F.col("more")).alias("more"))
    return tiles.select("node", "label", "copies", "vector", "unit", F.xxhash64(tile).alias("tile"))


def compare_blocks(
    x: np.ndarray, y: np.ndarray, threshold: float, own: bool
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """As ``compare_tiles``, a block against a block at a time; ``own``: each pair once.

    Within a tile, rows are first put in the order of the first axis, and blocks whose
    boxes are too far apart are left out.
    """
    orders = [np.argsort(t[:, 0], kind="stable") for t in (x, y)]
    parts = [[o[i : i + BLOCK] for i in range(0, len(o), BLOCK)] for o in orders]
    reach = 2 - 2 * threshold + SLACK
    found = []
    for i, rows in enumerate(parts[0]):
        a = x[rows]
        for j, columns in enumerate(parts[1]):
            if own and j < i:
                continue
            b = y[columns]
            low, high = np.maximum(a.min(0), b.min(0)), np.minimum(a.max(0), b.max(0))
            if (np.maximum(low - high, 0) ** 2).sum() > reach:
                continue
            at, to, cosine = compare_tiles(a, b, threshold)
            if own and i == j:
                some = at < to
                at, to, cosine = at[some], to[some], cosine[some]
            found.append((rows[at], columns[to], cosine))
    if not found:
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(0)
    return tuple(np.concatenate(part) for part in zip(*found, strict=True))


_CUTS = [k / 256 for k in range(1, 256)]


def _tile_pairs(tiled: DataFrame, threshold: float) -> DataFrame:
    """Pairs of tiles of a label whose boxes in the leading coordinates come near enough."""
    axis = lambda k: F.get("unit", F.lit(k))
    low = [F.min(axis(k)).alias(f"low{k}") for k in range(LEAD)]
    high = [F.max(axis(k)).alias(f"high{k}") for k in range(LEAD)]
    boxes = stored(tiled.groupBy("label", "tile").agg(*low, *high), "boxes")
    # A label of many tiles is divided: each part has some of them on the one side, and
    # all of them on the other.
    parts = boxes.groupBy("label").agg(F.ceil(F.count(F.lit(1)) / BOXES).cast("int").alias("parts"))
    sized = boxes.join(parts, "label")
    a = sized.withColumn("part", F.pmod(F.xxhash64("tile"), F.col("parts")).cast("int")).alias("a")
    b = sized.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).alias("b")
    gap = F.lit(0.0)
    for k in range(LEAD):
        apart = F.greatest(
            F.col(f"a.low{k}") - F.col(f"b.high{k}"), F.col(f"b.low{k}") - F.col(f"a.high{k}"), F.lit(0.0)
        )
        gap = gap + F.coalesce(apart * apart, F.lit(0.0))
    # Of unit vectors with this cosine the squared distance is 2 - 2 * threshold.
    near = gap <= 2 - 2 * threshold + SLACK
    pairs = a.join(
        b,
        (F.col("a.label") == F.col("b.label"))
        & (F.col("a.part") == F.col("b.part"))
        & (F.col("a.tile") <= F.col("b.tile"))
        & near,
    )
    return pairs.select(F.col("a.tile").alias("tile"), F.col("b.tile").alias("other"))


def near_duplicate_vectors(
    vectors: DataFrame,
    *,
    threshold: float = 0.98,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
) -> DataFrame:
    """``id_col``, ``n_links``, ``component_id`` and ``kept`` of every vector.

    Two vectors of equal label are linked if their cosine, in double precision, is at
    least ``threshold``. ``n_links`` counts the others linked directly, ``component_id``
    is the smallest id that links lead to, and ``kept`` says that it is the vector's own.

    A vector that is null, empty or zero, holds nulls or non-finite numbers, or has no
    label, is linked with nothing; nor are vectors of different lengths. Repeated rows
    are vectors of their own. A null id is no smallest one: its row is not kept where links
    lead to another id, and kept, with a null component, where they do not. An empty
    table gives no rows.
    """
    # Float vectors travel as they are; whatever is computed from them is in doubles.
    floats = vectors.schema[vector_col].dataType == ArrayType(FloatType(), True)
    vector = F.col(vector_col) if floats else F.col(vector_col).cast("array<double>")
    fine = (
        F.col(label_col).isNotNull()
        & (F.size(vector) > 0)
        & F.forall(vector, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
        & F.exists(vector, lambda v: v != 0)
    )
    slim = vectors.select(
        F.col(id_col).alias("id"),
        F.when(F.coalesce(fine, F.lit(False)), F.col(label_col)).alias("label"),
        F.when(F.coalesce(fine, F.lit(False)), vector).alias("vector"),
    )
    slim = stored(slim, "vectors")
    # Lengths are kept apart by the label, with which they are compared.
    label = F.struct("label", F.size("vector").alias("size"))
    key = F.sha2(F.to_json(F.struct(label, "vector")), 256)
    fine_rows = slim.filter("vector is not null").withColumn("key", key)
    classes = fine_rows.groupBy("key").agg(
        F.min("id").alias("id"),
        F.min(F.struct(label.alias("label"), "vector")).alias("least"),
        F.count(F.lit(1)).alias("copies"),
    )
    doubles = F.col("vector").cast("array<double>")
    biggest = F.array_max(F.transform(doubles, F.abs))
    scaled = F.transform(doubles, lambda v: v / biggest)
    length = F.sqrt(F.aggregate("scaled", F.lit(0.0), lambda s, v: s + v * v))
    units = (
        classes.select("key", "id", "least.*", "copies")
        .withColumn("node", F.monotonically_increasing_id())
        .withColumn("scaled", scaled)
        .withColumn("length", length)
        .withColumn("unit", F.transform("scaled", lambda v: v / F.col("length")))
        .drop("scaled", "length")
    )
    units = stored(units, "units")
    found = []
    for size in sorted(r[0] for r in units.select("label.size").distinct().collect()):
        found.append(_linked(units.filter(F.col("label.size") == size), threshold))
    if not found:
        return slim.select(
            F.col("id").alias(id_col),
            F.lit(0).cast("long").alias("n_links"),
            F.col("id").alias("component_id"),
            F.lit(True).alias("kept"),
        )
    links = found[0]
    for more in found[1:]:
        links = links.unionByName(more)
    links = stored(links, "links")
    degree = links.groupBy("node").agg(F.sum("others").alias("others"))
    group = components(links.filter("other is not null").select(F.col("node").alias("a"), F.col("other").alias("b")))
    joined = units.select("node", "key", "id", "copies").join(degree, "node", "left")
    joined = joined.join(group, "node", "left").withColumn("component", F.coalesce("component", "node"))
    joined = stored(joined, "joined")
    heads = joined.groupBy("component").agg(F.min("id").alias("component_id"))
    classes = joined.join(heads, "component").select(
        "key",
        (F.coalesce("others", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        "component_id",
    )
    keyed = slim.select("id", F.when(F.col("vector").isNotNull(), key).alias("key"))
    return keyed.join(classes, "key", "left").select(
        F.col("id").alias(id_col),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "id").alias("component_id"),
        F.col("id").eqNullSafe(F.coalesce("component_id", "id")).alias("kept"),
    )


def _linked(units: DataFrame, threshold: float) -> DataFrame:
    """``node`` with ``others``, the vectors linked in a pair of tiles, or a link to ``other``.

    Tiles travel as the vectors were given, and are turned again where they are compared.
    """
    axes = covariance_axes(units)
    shared = units.sparkSession.sparkContext.broadcast(axes)
    tiled = stored(_with_tiles(_tiled(units, axes)), "tiles")
    pairs = stored(_tile_pairs(tiled, threshold), "pairs")

    def compare(batches: list[pa.Table]) -> pa.Table:
        left, right = batches
        own = left["tile"][0] == right["tile"][0] if len(left) and len(right) else False
        u, v = (_stack(t["vector"].combine_chunks()) for t in (left, right))
        x, y = (unit_rows(t) @ shared.value for t in (u, v))
        rows, columns, cosine = compare_blocks(x, y, threshold, own)
        # Close to the threshold the cosine is taken from the vectors as they are given.
        close = np.flatnonzero(np.abs(cosine - threshold) <= SLACK)
        if len(close):
            u, v = u[rows[close]], v[columns[close]]
            exact = (u * v).sum(1) / (np.sqrt((u * u).sum(1)) * np.sqrt((v * v).sum(1)))
            cosine[close] = exact
            some = cosine >= threshold
            rows, columns = rows[some], columns[some]
        x_node, y_node = left["node"].to_numpy(), right["node"].to_numpy()
        x_copies, y_copies = left["copies"].to_numpy(), right["copies"].to_numpy()
        x_others = np.bincount(rows, y_copies[columns], len(x)).astype(np.int64)
        y_others = np.bincount(columns, x_copies[rows], len(y)).astype(np.int64)
        kept = forest(rows, columns + (0 if own else len(x)), len(x) + len(y))
        linked = (np.flatnonzero(x_others), np.flatnonzero(y_others))
        node = np.concatenate([x_node[linked[0]], y_node[linked[1]], x_node[rows[kept]]])
        others = np.concatenate([x_others[linked[0]], y_others[linked[1]], np.zeros(len(kept), np.int64)])
        other = pa.concat_arrays(
            [pa.nulls(len(node) - len(kept), pa.int64()), pa.array(y_node[columns[kept]], pa.int64())]
        )
        return pa.Table.from_arrays([pa.array(node), pa.array(others), other], ["node", "others", "other"])

    columns = ["node", "copies", "vector", "tile"]
    here = F.xxhash64("a", "b").alias("pair")
    ends = pairs.select(F.col("tile").alias("a"), F.col("other").alias("b"))
    left = ends.select("a", "b", F.col("a").alias("tile")).join(tiled.select(*columns), "tile")
    right = ends.select("a", "b", F.col("b").alias("tile")).join(tiled.select(*columns), "tile")
    # Aliases, as the two sides of a cogroup may not share columns.
    left, right = (side.select(here, *(F.col(c).alias(c) for c in columns)) for side in (left, right))
    cogrouped = left.groupBy("pair").cogroup(right.groupBy("pair"))
    return cogrouped.applyInArrow(
        lambda a, b: compare([a, b]), "node long, others long, other long"
    )
