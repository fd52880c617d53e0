"""The toxicity model: its sample, its strength of L1, and what it leaves out."""

from __future__ import annotations

import random

import numpy as np
from pyspark.sql import functions as F

from barloom.llm import toxicity as t


def plain_ftrl(examples, l1):
    """One coordinate after the other, in dictionaries, over all places."""
    z, n, bias = {}, {}, 1 << t.BITS

    def weight(at):
        value = z.get(at, 0.0)
        strength = 0 if at == bias else l1
        if abs(value) <= strength:
            return 0.0
        shrunk = value - strength if value > 0 else value + strength
        return -shrunk / ((t.BETA + n[at] ** 0.5) / t.ALPHA + t.L2)

    for epoch in range(t.EPOCHS):
        for i in np.random.default_rng(epoch).permutation(len(examples)):
            places, label = [*examples[i][0].tolist(), bias], examples[i][1]
            weights = [weight(at) for at in places]
            error = 1 / (1 + np.exp(-sum(weights))) - label
            for at, w in zip(places, weights, strict=True):
                before = n.get(at, 0.0)
                n[at] = before + error * error
                z[at] = z.get(at, 0.0) + error - (n[at] ** 0.5 - before**0.5) / t.ALPHA * w
    return {at: weight(at) for at in z if weight(at)}


def examples_of(count, seed):
    rng = random.Random(seed)
    found = []
    for _ in range(count):
        label = rng.random() < 0.3
        places = set(rng.sample(range(400), 12)) | ({1000 + rng.randrange(3)} if label else set())
        found.append((np.array(sorted(places)), int(label)))
    return found


def test_fit_equals_a_plain_one():
    examples = examples_of(120, 1)
    for l1 in (0.0, 3.0, 20.0):
        found = t.fit_ftrl(examples, l1)
        expected = plain_ftrl(examples, l1)
        assert np.flatnonzero(found).tolist() == sorted(expected)
        assert np.allclose([found[at] for at in expected], [*expected.values()])


def test_l1_is_chosen_and_leaves_few_weights():
    examples = examples_of(600, 2)
    assert t.choose_strength(examples) in t.STRENGTHS
    assert t.choose_strength(examples[:30]) == t.STRENGTHS[1]
    at, _ = t.train(examples)
    # The three places that mean something, the bias, and hardly anything else.
    assert {1000, 1001, 1002, 1 << t.BITS} <= set(at.tolist()) and len(at) < 40


def test_sample_is_bounded_in_rows_and_bytes(spark, monkeypatch):
    docs = [(i, f"text {i}") for i in range(100)] + [(3, "again"), (4, None)] * 300 + [(200, "x" * 500), (201, "y" * 90)]
    docs = spark.createDataFrame(docs, "doc_id long, text string").repartition(7)
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(202)], "doc_id long, toxic int")
    monkeypatch.setattr(t, "LONGEST", 100)
    rows = t.labelled_sample(docs, labels, F.lit(True), 1000).collect()
    assert sorted(r.doc_id for r in rows) == [*range(100), 201]
    assert len(t.labelled_sample(docs, labels, F.lit(True), 10).collect()) <= 20
    monkeypatch.setattr(t, "SAMPLE_BYTES", 70)
    rows = t.labelled_sample(docs, labels, F.lit(True), 1000).collect()
    for label in (0, 1):
        assert 0 < sum(len(r.text) for r in rows if r.toxic == label) <= 70
