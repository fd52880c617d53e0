"""Near-duplicate texts: ProbMinHash signatures, banding, exact verification.

A text is its shingles of five words, weighted by how often it holds them. Two texts'
similarity is the probability Jaccard index of the weights, which is the chance that
two ProbMinHash registers agree. Each shingle is a Poisson process whose rate is its
weight; its arrivals fall on random registers, which keep the earliest. A shingle ends
as soon as its next arrival is later than all registers of its text.

Registers are cut into bands. Different texts with an equal band are candidates, and
the index is computed exactly for them. To link a group, not all its pairs are needed:

1. In each bucket every text is compared with the bucket's first one, and the links
   found give first components.
2. Texts that buckets connect, linked or not, are a family. A family that is one
   component is done. Of others all texts are compared, in tiles: registers first, and
   exactly where enough of them agree, unless the two are connected already. Tiles
   follow the components, and two tiles of one component are not compared.

So no link between components is lost, copies are never paired, and of the pairs only
those that join components leave a task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from barloom.llm.common import mix, named, span_hashes, steps, stored, utf8, word_spans
from barloom.llm.components import components

WORDS = 5
THRESHOLD = 0.8
#: Registers, and bands they are cut into. At an index of 0.8 a pair shares no band with
#: probability (1 - 0.8 ** 4) ** 24, three in a million.
REGISTERS, BANDS = 96, 24
#: Registers that must agree before a pair is compared exactly. Of a pair with an index
#: of 0.8 some 77 agree, with a deviation of four.
AGREE = 60
#: Texts in a tile.
TILE = 512
_GOLDEN = 0x9E3779B97F4A7C15
_WEIGHTS = mix(np.arange(201, 201 + WORDS, dtype=np.uint64)) | np.uint64(1)


def shingles(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text number, hash and count of every different shingle, by text.

    A text with fewer words than a shingle has one, of all its words.
    """
    starts, ends, text = word_spans(data, offsets)
    words = span_hashes(data, starts, ends)
    counts = np.bincount(text, minlength=len(offsets) - 1)
    first = np.cumsum(counts) - counts
    long = np.flatnonzero(text[WORDS - 1 :] == text[: max(0, len(text) - WORDS + 1)])
    hashes = np.zeros(len(long), np.uint64)
    for k in range(WORDS):
        hashes += words[long + k] * _WEIGHTS[k]
    short = np.flatnonzero((counts > 0) & (counts < WORDS))
    extra = np.zeros(len(short), np.uint64)
    for k in range(WORDS - 1):
        has = counts[short] > k
        extra[has] += words[first[short[has]] + k] * _WEIGHTS[k]
    owner = np.concatenate([text[long], short])
    hashes = mix(np.concatenate([hashes, extra]))
    _, at, count = np.unique(
        mix(hashes + mix(owner.astype(np.uint64))), return_index=True, return_counts=True
    )
    order = np.argsort(owner[at], kind="stable")
    return owner[at][order], hashes[at][order], count[order]


def signatures(owner: np.ndarray, hashes: np.ndarray, counts: np.ndarray, texts: int) -> np.ndarray:
    """Registers of each text (text, register); zero if it has no shingle."""
    time = np.full(texts * REGISTERS, np.inf)
    kept = np.zeros(texts * REGISTERS, np.uint64)
    active = np.arange(len(owner))
    now = np.zeros(len(owner))
    turn = 0
    while len(active):
        turn += 1
        random = mix(hashes[active] + np.uint64(turn * _GOLDEN % (1 << 64)))
        uniform = ((random >> np.uint64(11)).astype(float) + 0.5) * 2.0**-53
        now[active] -= np.log(uniform) / counts[active]
        register = (mix(random) >> np.uint64(32)) * np.uint64(REGISTERS) >> np.uint64(32)
        at = owner[active] * REGISTERS + register.astype(np.int64)
        arrival = now[active]
        np.minimum.at(time, at, arrival)
        first = arrival == time[at]
        kept[at[first]] = hashes[active[first]]
        latest = time.reshape(texts, REGISTERS).max(axis=1)
        active = active[arrival < latest[owner[active]]]
    return kept.reshape(texts, REGISTERS)


def bands(registers: np.ndarray) -> np.ndarray:
    """One number per text and band."""
    rows = REGISTERS // BANDS
    parts = registers.reshape(len(registers), BANDS, rows)
    total = np.zeros((len(registers), BANDS), np.uint64)
    for k in range(rows):
        total = mix(total + parts[:, :, k])
    return mix(total + np.arange(1, BANDS + 1, dtype=np.uint64)).view(np.int64)


def probability_jaccard(
    a: np.ndarray, a_count: np.ndarray, b: np.ndarray, b_count: np.ndarray
) -> float:
    """The index of two sets of hashes, sorted, with counts."""
    _, at_a, at_b = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    if not len(at_a):
        return 0.0
    x, y = a_count[at_a] / a_count.sum(), b_count[at_b] / b_count.sum()
    # Sum over shared d of 1 / sum over all e of max(x_e / x_d, y_e / y_d). With shared
    # shingles by x / y, those before d count by y, the others by x.
    order = np.argsort(x / y, kind="stable")
    x, y = x[order], y[order]
    only_x, only_y = 1 - x.sum(), 1 - y.sum()
    y_before = np.cumsum(y) - y + only_y
    x_after = x[::-1].cumsum()[::-1] + only_x
    return float((1 / (x_after / x + y_before / y)).sum())


def _sign(docs: DataFrame, keep: list[str], id_col: str, text_col: str) -> DataFrame:
    """``row``, ``id``, ``text``, its SHA-256 ``key``, its ``bands`` (null without words)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, "text"):
            owner, hashes, counts = shingles(*utf8(batch["text"]))
            found = bands(signatures(owner, hashes, counts, batch.num_rows))
            empty = np.bincount(owner, minlength=batch.num_rows) == 0
            lists = pa.ListArray.from_arrays(
                pa.array(np.arange(batch.num_rows + 1) * BANDS, pa.int32()),
                pa.array(found.ravel()),
                mask=pa.array(empty),
            )
            yield pa.RecordBatch.from_arrays([*batch.columns, lists], [*batch.schema.names, "bands"])

    text = F.col(text_col).cast("string")
    slim = docs.select(
        F.struct(*named(keep)).alias("row"),
        F.col(id_col).alias("id"),
        text.alias("text"),
        F.sha2(text, 256).alias("key"),
    )
    schema = StructType([*slim.schema.fields, *StructType.fromDDL("bands array<long>").fields])
    signed = slim.mapInArrow(run, schema)
    return signed.withColumn("node", F.monotonically_increasing_id())


def _verify(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """``a``, ``b`` and their ``similarity``; ``sets`` has each node's hashes and counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = [batch[n] for n in ("hashes", "counts", "b_hashes", "b_counts")]
            found = [
                probability_jaccard(*(part[i].values.to_numpy() for part in lists))
                for i in range(batch.num_rows)
            ]
            yield pa.RecordBatch.from_arrays(
                [batch["a"], batch["b"], pa.array(found, pa.float64())], ["a", "b", "similarity"]
            )

    other = sets.select(
        F.col("node").alias("b"), F.col("hashes").alias("b_hashes"), F.col("counts").alias("b_counts")
    )
    joined = pairs.join(sets.withColumnRenamed("node", "a"), "a").join(other, "b")
    columns = ["a", "b", "hashes", "counts", "b_hashes", "b_counts"]
    return joined.select(*columns).mapInArrow(run, "a long, b long, similarity double")


def _sets(signed: DataFrame, nodes: DataFrame) -> DataFrame:
    """Sorted shingle hashes, with counts, of the texts of ``nodes``; a byte per register."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, "text"):
            owner, hashes, counts = shingles(*utf8(batch["text"]))
            order = np.lexsort((hashes.view(np.int64), owner))
            bounds = pa.array(np.searchsorted(owner, np.arange(batch.num_rows + 1)), pa.int32())
            values = (hashes.view(np.int64)[order], counts[order].astype(np.int32))
            found = signatures(owner, hashes, counts, batch.num_rows)
            sketch = [row.tobytes() for row in found.astype(np.uint8)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch["node"],
                    *(pa.ListArray.from_arrays(bounds, pa.array(v)) for v in values),
                    pa.array(sketch, pa.binary()),
                ],
                ["node", "hashes", "counts", "sketch"],
            )

    texts = signed.select("node", "text").join(nodes, "node", "left_semi")
    return texts.mapInArrow(
        run, "node long, hashes array<long>, counts array<int>, sketch binary"
    )


def _links(signed: DataFrame, reps: DataFrame) -> DataFrame:
    """Links between nodes of different texts: enough of them to give all components."""
    entries = reps.select("node", F.explode("bands").alias("bucket"))
    shared = entries.groupBy("bucket").agg(F.min("node").alias("first"), F.count("*").alias("n"))
    members = stored(
        entries.join(shared.filter("n > 1").drop("n"), "bucket"), "buckets"
    )
    sets = stored(_sets(signed, members.select("node").distinct()), "shingles")
    stars = members.filter("node > first").select(F.col("first").alias("a"), F.col("node").alias("b"))
    tested = stored(_verify(stars.distinct(), sets), "tested")
    links = tested.filter(F.col("similarity") >= THRESHOLD).select("a", "b")

    label = stored(components(links), "labels")
    family = components(stars).withColumnRenamed("component", "family")
    nodes = (
        family.join(label, "node", "left")
        .select("family", "node", F.coalesce("component", "node").alias("label"))
    )
    return links.union(_family_links(stored(nodes, "families"), sets))


def _tiles(nodes: DataFrame) -> DataFrame:
    """``nodes`` of families of several labels, with their ``tile``.

    A label's nodes lie in one tile, or in several of their own if they are many.
    """
    families = nodes.groupBy("family").agg(
        F.ceil(F.count(F.lit(1)) / TILE).alias("tiles"), (F.min("label") < F.max("label")).alias("open")
    )
    open_families = stored(families.filter("open").drop("open"), "open")
    placed = nodes.join(open_families, "family").withColumn(
        "place", F.pmod(F.xxhash64("label"), F.col("tiles"))
    )
    crowd = placed.groupBy("family", "place").agg(F.ceil(F.count(F.lit(1)) / TILE).alias("parts"))
    part = F.pmod(F.xxhash64("node"), F.col("parts"))
    tile = F.xxhash64("family", "place", part.alias("part")).alias("tile")
    return placed.join(stored(crowd, "crowd"), ["family", "place"]).select(
        "family", "node", "label", tile
    )


def _family_links(nodes: DataFrame, sets: DataFrame) -> DataFrame:
    """Links between texts of a family that have different labels: a forest per tile pair."""
    tiled = stored(_tiles(nodes).join(sets, "node"), "tiles")
    spans = tiled.groupBy("family", "tile").agg(
        F.min("label").alias("low"), F.max("label").alias("high")
    )
    spans = stored(spans, "spans")
    a, b = spans.alias("a"), spans.alias("b")
    one = (F.col("a.low") == F.col("b.high")) & (F.col("a.high") == F.col("b.low"))
    pairs = a.join(
        b, (F.col("a.family") == F.col("b.family")) & (F.col("a.tile") <= F.col("b.tile")) & ~one
    ).select(F.col("a.tile").alias("a"), F.col("b.tile").alias("b"))
    pairs = stored(pairs, "pairs")

    def compare(left: pa.Table, right: pa.Table) -> pa.Table:
        own = left["tile"][0] == right["tile"][0]
        sides = [t.combine_chunks() for t in ((left,) if own else (left, right))]
        whole = pa.concat_tables(sides).combine_chunks()
        nodes, labels = whole["node"].to_numpy(), whole["label"].to_numpy()
        sketch = np.frombuffer(b"".join(whole["sketch"].to_pylist()), np.uint8)
        sketch = sketch.reshape(-1, REGISTERS)
        n, split = len(nodes), 0 if own else left.num_rows
        agree = np.zeros((n if own else split, n - split), np.uint8)
        for k in range(REGISTERS):
            agree += sketch[: len(agree), None, k] == sketch[None, split:, k]
        x, y = np.nonzero(agree >= AGREE)
        order = np.argsort(-agree[x, y].astype(int), kind="stable")
        x, y = x[order], y[order] + split
        some = (x < y) & (labels[x] != labels[y])
        _, root = np.unique(labels, return_inverse=True)
        hashes, counts = (whole[c].combine_chunks() for c in ("hashes", "counts"))
        found = []
        for i, j in zip(x[some].tolist(), y[some].tolist(), strict=True):
            if root[i] == root[j]:
                continue
            parts = [c[k].values.to_numpy() for k in (i, j) for c in (hashes, counts)]
            if probability_jaccard(*parts) >= THRESHOLD:
                root[root == root[j]] = root[i]
                found.append((i, j))
        found = np.array(found, np.int64).reshape(-1, 2)
        return pa.Table.from_arrays([pa.array(nodes[found[:, k]]) for k in (0, 1)], ["a", "b"])

    columns = ["node", "label", "tile", "hashes", "counts", "sketch"]
    pair = F.xxhash64("a", "b").alias("pair")
    left = pairs.withColumn("tile", F.col("a")).join(tiled.select(*columns), "tile")
    right = pairs.withColumn("tile", F.col("b")).join(tiled.select(*columns), "tile")
    # Aliases, as the two sides of a cogroup may not share columns.
    left, right = (side.select(pair, *(F.col(c).alias(c) for c in columns)) for side in (left, right))
    return left.groupBy("pair").cogroup(right.groupBy("pair")).applyInArrow(compare, "a long, b long")


def near_duplicates(
    docs: DataFrame,
    *,
    keep: list[str],
    id_col: str = "doc_id",
    text_col: str = "text",
    as_row: bool = False,
) -> DataFrame:
    """The columns ``keep`` of every document, ``component_id`` and ``kept``.

    With ``as_row`` the kept columns are one struct, ``row``: they may then have any
    names, also those of the results.

    Documents with equal texts are one class; classes with a similarity of at least 0.8
    are linked, and links are followed. ``component_id`` is the smallest id reachable,
    ``first_id`` the smallest with an equal text, and ``kept`` holds for one row of each
    component, one with its smallest id, also where rows are repeated in full.

    Null texts and texts without words are linked with nothing and all kept. Null ids
    come last in their component. An empty table gives no rows.
    """
    signed = stored(_sign(docs, keep, id_col, text_col), "signed")
    ordered = F.struct(F.col("id").isNull().alias("void"), "id", "node", "bands").alias("least")
    reps = stored(
        signed.filter("bands is not null").groupBy("key").agg(F.min(ordered).alias("least"))
        .select("key", "least.id", "least.node", "least.bands"),
        "texts",
    )
    found = components(stored(_links(signed, reps), "links"))
    labelled = reps.join(found, "node", "left").select(
        "key", "id", "node", F.coalesce("component", "node").alias("component")
    )
    labelled = stored(labelled, "labelled")
    least = F.min(F.struct(F.col("id").isNull().alias("void"), "id", "node")).alias("least")
    heads = labelled.groupBy("component").agg(least).select(
        "component", F.col("least.id").alias("component_id"), F.col("least.node").alias("head")
    )
    texts = labelled.join(heads, "component").select(
        "key", F.col("id").alias("first_id"), "component_id", "head"
    )
    slim = signed.withColumn("key", F.when(F.col("bands").isNotNull(), F.col("key")))
    return slim.select("row", "id", "node", "key").join(texts, "key", "left").select(
        "row" if as_row else "row.*",
        F.coalesce("first_id", "id").alias("first_id"),
        F.coalesce("component_id", "id").alias("component_id"),
        (F.col("node") == F.coalesce("head", "node")).alias("kept"),
    )
