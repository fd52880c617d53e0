"""Periodic runs against brute force over all periods and stretches."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from barloom.llm import queries
from barloom.llm.periodic import find_runs, periodic_runs


def smallest_period(words):
    return next(q for q in range(1, len(words) + 1) if words[q:] == words[: len(words) - q])


def plain_runs(words, min_length=6, exponent=4):
    """Every longest stretch of every period, of which the period is the smallest one."""
    found = set()
    n = len(words)
    for p in range(1, n // exponent + 1):
        i = 0
        while i + p < n:
            end = i
            while end + p < n and words[end] == words[end + p]:
                end += 1
            stretch = words[i : end + p]
            if len(stretch) >= max(min_length, exponent * p) and smallest_period(stretch) == p:
                found.add((i, len(stretch), p))
            i = end + 1
    return sorted(found, key=lambda r: (r[0], r[2]))


def by_text(texts, min_length=6, exponent=4):
    names = sorted({w for t in texts for w in t})
    number = {w: i for i, w in enumerate(names)}
    words = np.array([number[w] for t in texts for w in t], np.int64)
    ends = np.append(0, np.cumsum([len(t) for t in texts]))
    found = [[] for _ in texts]
    for text, *run in zip(*(c.tolist() for c in find_runs(words, ends, min_length, exponent)), strict=True):
        found[text].append(tuple(run))
    return found


@pytest.mark.parametrize("seed", range(8))
def test_runs_equal_brute_force(seed):
    rng = random.Random(seed)
    texts = []
    for _ in range(120):
        letters = "ab"[: rng.choice([1, 2])] if rng.random() < 0.5 else "abcdef"
        text = [rng.choice(letters) for _ in range(rng.randint(0, 70))]
        for _ in range(rng.randint(0, 3)):
            block = [rng.choice(letters) for _ in range(rng.randint(1, 7))]
            at = rng.randint(0, len(text))
            text[at:at] = (block * 9)[: rng.randint(1, 9 * len(block))]
        texts.append(text)
    assert by_text(texts) == [plain_runs(t) for t in texts]
    assert by_text(texts, 2, 2) == [plain_runs(t, 2, 2) for t in texts]
    assert by_text(texts, 9, 3) == [plain_runs(t, 9, 3) for t in texts]


def test_runs_within_runs_and_neighbours():
    block = list("aaaaaab")
    texts = [block * 5, list("ab") * 6 + list("a") * 7, ["a"] * 300, (list("ab") * 4 + ["c"]) * 6]
    # The same words in two texts that follow each other are no run.
    texts += [["x"] * 3, ["x"] * 5, list("xyxyxyx"), list("yxyxyxy")]
    assert by_text(texts) == [plain_runs(t) for t in texts]


def test_a_million_equal_words():
    words = np.zeros(1_000_000, np.int64)
    found = [c.tolist() for c in find_runs(words, np.array([0, len(words)]), 6, 4)]
    assert found == [[0], [0], [1_000_000], [1]]


def damaged(doc_id, text):
    """As the contract words it, one word after another."""
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is None or h % 10 or not words:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def expected(doc_id, text):
    words = damaged(doc_id, text)
    runs = plain_runs(words)
    best = max(runs, key=lambda r: (r[1] * 10**9 // r[2], -r[0], -r[2]), default=None)
    gone = {i for s, n, p in runs for i in range(s + p, s + n)}
    lines = "".join(f"{s},{n},{p}\n" for s, n, p in runs)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    best = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    return (doc_id, len(runs), *best, sha(lines), sha(kept))


COLUMNS = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


def test_query_on_odd_texts(spark, folder):
    rng = random.Random(2)
    rows = [(i, " ".join(rng.choice("abc") * rng.randint(1, 2) for _ in range(rng.randint(0, 90)))) for i in range(150)]
    rows += [(1000 + i, "the same words again " * 6) for i in range(40)]
    rows += [(None, "no id " * 8), (None, None), (2000, None), (2001, ""), (2002, " \n\t"), (2003, "été\u00a0x y " * 9)]
    rows += [(2004, "a " * 30_000), (7, "twice"), (7, "twice")]
    ddl = "doc_id long, text string, runs int, id long, start long, length long, period long, words string, n_runs int"
    docs = spark.createDataFrame([(*r, 1, 2, 3, 4, 5, "w", 6) for r in rows], ddl).repartition(3)
    docs.write.parquet(f"{folder}/documents.parquet")
    found = queries.op12_periodic_runs(spark, folder).select(*COLUMNS).collect()
    small = [r for r in rows if len(r[1] or "") < 1000]
    key = lambda r: tuple(str(v) for v in r)
    assert sorted((tuple(r) for r in found if r.doc_id != 2004), key=key) == sorted(
        (expected(*r) for r in small), key=key
    )
    [long] = [r for r in found if r.doc_id == 2004]
    assert (long.start, long.length, long.period) == (0, 30_000, 1)


def test_query_on_a_given_table(spark):
    sf_dir = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    found = {r.doc_id: tuple(r) for r in queries.op12_periodic_runs(spark, sf_dir).select(*COLUMNS).collect()}
    some = [i for i, t in texts.items() if len((t or "").split()) < 600]
    assert {i: found[i] for i in some} == {i: expected(i, texts[i]) for i in some}


def test_collapsed_texts_and_empty_tables(spark):
    docs = spark.createDataFrame([(1, "go  a b a b a b a b a b end"), (2, "one\ttwo")], "doc_id long, text string")
    found = {r.doc_id: (r.n_words, r.collapsed) for r in periodic_runs(docs).collect()}
    assert found == {1: (12, "go a b end"), 2: (2, "one two")}
    assert periodic_runs(docs.where(F.lit(False))).isEmpty()
    with pytest.raises(ValueError, match="two periods"):
        periodic_runs(docs, exponent=1)
