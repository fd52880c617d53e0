"""Toxicity by FTRL-proximal logistic regression over hashed features of words.

Features of a text are its different words, pairs of neighbours, pairs with one word
left out between, and first letters of longer words (so that forms of one stem share a
weight), each hashed to one of ``2 ** BITS`` places. Every coordinate has its own
learning rate, and L1 keeps the weights of features that carry nothing at zero, so
that the model is a short list of places and weights.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom.llm.common import keyed, mix, span_hashes, steps, stored, utf8, word_spans

BITS = 20
#: Letters of a word's beginning, in bytes.
STEM_BYTES = (4, 5)
#: Most labelled documents of either class that the model is trained on, most bytes of
#: text of either class, and the longest text that is learned from.
SAMPLE, SAMPLE_BYTES, LONGEST = 4000, 64 << 20, 1 << 20
#: Chosen on a given table, on a split inside the rows that are learned from.
ALPHA, BETA, L2, EPOCHS = 0.5, 1.0, 0.1, 8
#: Strengths of L1 to choose from, by the root of the number of examples: what features
#: without meaning add up to grows with it. The second is taken if there are too few
#: examples of either class to choose by.
STRENGTHS, FEW = (0.16, 0.33, 0.66), 20
#: The bias of a model without any example: nothing is called toxic.
NO_EXAMPLES = -2.0

LETTER = np.zeros(256, bool)
LETTER[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


def lower(data: np.ndarray) -> np.ndarray:
    """The bytes with A-Z and the capitals of Latin-1 in lower case."""
    after = np.append(0, data[:-1]) == 0xC3
    capital = (data >= 0x41) & (data <= 0x5A) | after & (data >= 0x80) & (data <= 0x9E) & (data != 0x97)
    return data + np.where(capital, 32, 0).astype(np.uint8)


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Text number and place of every feature, repeated as often as it occurs."""
    data = lower(data)
    starts, ends, text = word_spans(data, offsets, LETTER)
    words = span_hashes(data, starts, ends)
    hashes, owners = [words], [text]
    for gap, salt in ((1, 1), (2, 2)):
        same = np.flatnonzero(text[gap:] == text[:-gap])
        hashes.append(mix(words[same] * np.uint64(3) + words[same + gap] + np.uint64(salt)))
        owners.append(text[same])
    for n in STEM_BYTES:
        long = np.flatnonzero(ends - starts > n)
        hashes.append(mix(span_hashes(data, starts[long], starts[long] + n) + np.uint64(n)))
        owners.append(text[long])
    places = np.concatenate(hashes) >> np.uint64(64 - BITS)
    return np.concatenate(owners), places.astype(np.int64)


def fit_ftrl(examples: list[tuple[np.ndarray, int]], l1: float) -> np.ndarray:
    """Weights of all places after ``EPOCHS`` rounds; the last one is the bias.

    While a weight is zero, its sum moves by less than one for each example and round. So
    a place of too few examples cannot pass ``l1``, and is left out from the start.
    """
    often = np.bincount(np.concatenate([at for at, _ in examples]), minlength=1 << BITS)
    known = np.flatnonzero(often * EPOCHS > l1)
    dense = np.full(1 << BITS, -1)
    dense[known] = np.arange(len(known))
    bias = len(known)
    rows = []
    for at, label in examples:
        at = dense[at]
        rows.append((np.append(at[at >= 0], bias), label))
    z, n = np.zeros(bias + 1), np.zeros(bias + 1)
    strength = np.append(np.full(bias, l1), 0.0)

    def weights(at) -> np.ndarray:
        shrunk = np.sign(z[at]) * np.maximum(np.abs(z[at]) - strength[at], 0)
        return -shrunk / ((BETA + np.sqrt(n[at])) / ALPHA + L2)

    for epoch in range(EPOCHS):
        for i in np.random.default_rng(epoch).permutation(len(rows)):
            at, label = rows[i]
            w = weights(at)
            error = probability(w.sum()) - label
            grown = n[at] + error * error
            z[at] += error - (np.sqrt(grown) - np.sqrt(n[at])) / ALPHA * w
            n[at] = grown
    found = np.zeros((1 << BITS) + 1)
    found[np.append(known, 1 << BITS)] = weights(np.arange(bias + 1))
    return found


def probability(total):
    return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def log_loss(weight: np.ndarray, examples: list[tuple[np.ndarray, int]]) -> float:
    said = probability(np.array([weight[at].sum() + weight[-1] for at, _ in examples]))
    label = np.array([label for _, label in examples])
    return float(-np.log(np.where(label == 1, said, 1 - said)).mean())


def choose_strength(examples: list[tuple[np.ndarray, int]]) -> float:
    """The strength with the least loss on every fourth example, learned from the others."""
    held, rest = examples[::4], [e for i, e in enumerate(examples) if i % 4]
    if any(sum(label == c for _, label in part) < FEW for part in (held, rest) for c in (0, 1)):
        return STRENGTHS[1]
    losses = [log_loss(fit_ftrl(rest, s * len(rest) ** 0.5), held) for s in STRENGTHS]
    return STRENGTHS[int(np.argmin(losses))]


def train(examples: list[tuple[np.ndarray, int]]) -> tuple[np.ndarray, np.ndarray]:
    """Places and weights of the model; the place past the last is the bias."""
    if not examples:
        return np.array([1 << BITS]), np.array([NO_EXAMPLES])
    found = fit_ftrl(examples, choose_strength(examples) * len(examples) ** 0.5)
    at = np.flatnonzero(found)
    return at, found[at]


def labelled_sample(docs: DataFrame, labels: DataFrame, learn: Column, each: int) -> DataFrame:
    """At most ``each`` documents of either label, with ``toxic``; by a hash of the id.

    A document labelled more than once is toxic if any label says so. Of rows that share
    an id one text is taken, the one with the least hash. The sample is bounded in bytes,
    too: no text of over ``LONGEST``, and no more than ``SAMPLE_BYTES`` of either label.
    """
    known = (
        labels.filter(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & learn)
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
        .withColumn("_order", F.xxhash64("doc_id"))
    )
    picks = [
        known.filter(F.col("toxic") == label).orderBy("_order", "doc_id").limit(each)
        for label in (0, 1)
    ]
    chosen = stored(picks[0].unionByName(picks[1]), "labelled")
    # No more than twice ``each`` rows, so the table to send is bounded.
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select("doc_id", text.alias("text")).filter(F.octet_length("text") <= LONGEST)
    rows = rows.join(F.broadcast(chosen), "doc_id")
    one = rows.groupBy("doc_id", "toxic", "_order").agg(F.min_by("text", F.xxhash64("text")).alias("text"))
    one = stored(one, "sample")
    place = Window.partitionBy("toxic").orderBy("_order", "doc_id")
    held = F.sum(F.octet_length("text").cast("long")).over(place.rowsBetween(Window.unboundedPreceding, 0))
    some = one.select("doc_id", "toxic", "_order", held.alias("_held")).filter(F.col("_held") <= SAMPLE_BYTES)
    return one.join(F.broadcast(some.select("doc_id")), "doc_id")


def learn_weights(sample: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Train in one task on a bounded sample (columns ``_order``, ``text``, ``toxic``)."""

    def to_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, "text"):
            text, places = features(*utf8(batch["text"]))
            pairs = np.unique((text << BITS) | places)
            bounds = np.searchsorted(pairs >> BITS, np.arange(batch.num_rows + 1))
            lists = pa.ListArray.from_arrays(
                pa.array(bounds, pa.int32()), pa.array(pairs & ((1 << BITS) - 1), pa.int32())
            )
            yield pa.RecordBatch.from_arrays(
                [batch["_order"], batch["toxic"], lists], ["_order", "toxic", "places"]
            )

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = []
        for batch in batches:
            orders, toxic = batch["_order"].to_pylist(), batch["toxic"].to_pylist()
            for i in range(batch.num_rows):
                rows.append((orders[i], toxic[i], batch["places"][i].values.to_numpy()))
        # The order of arrival differs from run to run; that of the hash does not.
        rows.sort(key=lambda row: (row[0], row[1], row[2].tobytes()))
        at, weight = train([(places, label) for _, label, places in rows])
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(weight)], ["place", "weight"])

    listed = sample.select("_order", F.col("toxic").cast("int").alias("toxic"), "text").mapInArrow(
        to_features, "_order long, toxic int, places array<int>"
    )
    model = listed.repartition(1).mapInArrow(fit, "place long, weight double").collect()
    return (
        np.array([row["place"] for row in model], np.int64),
        np.array([row["weight"] for row in model], float),
    )


def score_texts(
    docs: DataFrame,
    model: tuple[np.ndarray, np.ndarray],
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``id_col`` and ``score``, from 0 to 1, of each whole text.

    A null or empty text has only the bias. Repeated rows are scored each, other columns
    are ignored, and an empty table gives no rows.
    """
    # Bounded by 2 ** BITS places; far fewer have a weight.
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight = np.zeros((1 << BITS) + 1)
        weight[shared.value[0]] = shared.value[1]
        for batch in steps(batches, "text"):
            text, places = features(*utf8(batch["text"]))
            some = weight[places] != 0
            pairs = np.unique((text[some] << BITS) | places[some])
            total = weight[-1] + np.bincount(
                pairs >> BITS, weight[pairs & ((1 << BITS) - 1)], batch.num_rows
            )
            score = probability(total)
            yield pa.RecordBatch.from_arrays([batch["id"], pa.array(score)], ["id", "score"])

    slim = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return slim.mapInArrow(run, keyed(slim, "score double")).withColumnRenamed("id", id_col)


def toxicity(docs: DataFrame, labels: DataFrame, learn: Column) -> DataFrame:
    """``doc_id`` and ``score`` of all documents, learned from labels where ``learn`` holds.

    Without labels of any document all scores are equal and below 0.5.
    """
    return score_texts(docs, learn_weights(labelled_sample(docs, labels, learn, SAMPLE)))
