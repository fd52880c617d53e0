"""What the language network learns from, and the pipeline where it learns nothing."""

from __future__ import annotations

from collections import Counter

from pyspark.sql import functions as F

import corpus_pipeline
from barloom.llm import langid


def test_every_language_keeps_its_part_of_the_sample(spark, monkeypatch):
    monkeypatch.setattr(langid, "ALL", 1200)
    monkeypatch.setattr(langid, "EACH", 100)
    sizes = {f"l{k:02}": 20 + 3 * k * k for k in range(60)}
    docs = spark.range(sum(sizes.values())).withColumnRenamed("id", "doc_id")
    ends, total = [], 0
    for lang, n in sizes.items():
        total += n
        ends.append((total, lang))
    lang = F.lit(None).cast("string")
    for end, name in reversed(ends):
        lang = F.when(F.col("doc_id") < end, name).otherwise(lang)
    sample = langid.language_sample(docs.select("doc_id", lang.alias("lang"), F.lit("a b").alias("text")), F.lit(True))
    found = Counter(r.lang for r in sample.select("lang").collect())
    assert sum(found.values()) <= 1200 and set(found) == set(sizes)
    assert all(5 <= n <= 45 for n in found.values())


def test_the_pipeline_keeps_a_corpus_without_languages(spark):
    texts = [(1, "words of a text"), (2, "12 34"), (3, None), (4, "")]
    docs = spark.createDataFrame([(i, t, None) for i, t in texts], "doc_id long, text string, lang string")
    found = corpus_pipeline.language(spark, docs, "")
    assert [tuple(r) for r in found.collect()] == [(1, "words of a text", None)]
