"""Columns of any name pass the pipeline; ids that repeat are learned from once."""

from __future__ import annotations

import random
import tempfile

from pyspark.sql import functions as F

import corpus_pipeline
from barloom.llm import components as c
from barloom.llm.langid import language_sample
from barloom.llm.neardup import near_duplicates

NAMES = [
    "kept", "n_words", "base_failed", "entropy", "component_id", "first_id", "sequence_id", "a.b", "row", "id",
    "group", "octave", "key", "bands", "node", "score", "lang_pred", "letter", "start", "length", "offset", "c`d",
]


def test_columns_of_any_name_pass_all_stages(spark):
    rng = random.Random(1)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 6)))
    rows = []
    for i in range(60):
        text = " ".join(word() for _ in range(rng.randint(40, 90)))
        rows.append((i, text, "en", "s", len(text), *(f"{name} {i}" for name in NAMES)))
    rows.append((60, *rows[3][1:]))
    rows.append((61, "few words", *rows[3][2:]))
    ddl = "doc_id long, text string, lang string, source string, n_chars int, "
    ddl += ", ".join(f"`{name.replace('`', '``')}` string" for name in NAMES)
    docs = spark.createDataFrame(rows, ddl)
    left = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        left = stage(spark, left, "")
        assert left.columns == docs.columns
        path = tempfile.mkdtemp(prefix="run-", dir="/tmp") + "/stage"
        left.write.parquet(path)
        left = spark.read.parquet(path)
    assert sorted(map(tuple, left.collect())) == sorted(rows[:60])
    packed = corpus_pipeline.packing(spark, left, "")
    assert {r.doc_id for r in packed.collect()} == set(range(60))


def test_repeated_ids_are_sampled_once(spark):
    rows = [(1, "the same words", "en")] * 300 + [(2, "und noch eines", "de")] * 300 + [(2, "other words", "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(5)
    found = sorted((r.doc_id, r.lang, r.text) for r in language_sample(docs, F.lit(True)).collect())
    assert found == [(1, "en", "the same words"), (2, "de", "und noch eines"), (2, "en", "other words")]


def test_components_with_hubs(spark, monkeypatch):
    monkeypatch.setattr(c, "HUB", 5)
    rng = random.Random(4)
    edges = [(0, i) for i in range(1, 300)] + [(999, i) for i in range(400, 450)] + [(450, 449), (299, 500)]
    edges += [(1000 + i, 1000 + rng.randrange(i + 1)) for i in range(80)]
    rng.shuffle(edges)
    low = {i: i for edge in edges for i in edge}
    for _ in range(len(low)):
        before = dict(low)
        for a, b in edges:
            low[a] = low[b] = min(low[a], low[b])
        if low == before:
            break
    found = {r.node: r.component for r in c.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    alone = {i for i in low if all(a == b for a, b in edges if i in (a, b))}
    assert found == {i: v for i, v in low.items() if i not in alone}


def test_near_copies_as_rows(spark):
    text = " ".join(f"w{i}" for i in range(30))
    docs = spark.createDataFrame([(2, text, True), (1, text, False)], "doc_id long, text string, kept boolean")
    found = near_duplicates(docs, keep=docs.columns, as_row=True)
    assert {r.row.doc_id: (r.kept, r.row.kept) for r in found.collect()} == {1: (True, False), 2: (False, True)}
