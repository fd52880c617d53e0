"""Near-duplicate vectors: few dimensions, null ids, links across tiles."""

from __future__ import annotations

import numpy as np
import pytest

from barloom.llm import embdedup
from barloom.llm.embdedup import compare_blocks, near_duplicate_vectors


def plain(rows, threshold=0.98):
    """Per place of ``rows`` (id, vector, label): its links, and its component's least id."""
    unit = [np.array(v, float) / np.linalg.norm(v) for _, v, _ in rows]
    n = len(rows)
    links = [
        [j for j in range(n) if j != i and rows[i][2] == rows[j][2] and unit[i] @ unit[j] >= threshold]
        for i in range(n)
    ]
    group = list(range(n))
    for _ in range(n):
        new = [min([group[i], *(group[j] for j in links[i])]) for i in range(n)]
        if new == group:
            break
        group = new
    least = {}
    for i in range(n):
        if rows[i][0] is not None:
            least[group[i]] = min(rows[i][0], least.get(group[i], rows[i][0]))
    return [(rows[i][0], len(links[i]), least.get(group[i]), rows[i][0] == least.get(group[i])) for i in range(n)]


def found(spark, rows, kind="float"):
    table = spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>, label int")
    return sorted(map(tuple, near_duplicate_vectors(table.repartition(3)).collect()), key=str)


@pytest.mark.parametrize("size", [1, 2, 3, 7, 9])
def test_vectors_of_few_dimensions(spark, size):
    rng = np.random.default_rng(size)
    rows = [(i, rng.normal(size=size).round(2).tolist(), i % 2) for i in range(40)]
    rows = [(i, v if any(v) else [1.0] * size, g) for i, v, g in rows]
    assert found(spark, rows, "double") == sorted(plain(rows), key=str)


def test_null_ids_hide_no_others(spark):
    one, near, far = [1.0, 2.0, 3.0, 4.0], [1.0, 2.0, 3.0, 4.1], [-4.0, 1.0, 0.0, 2.0]
    rows = [(None, one, 1), (5, one, 1), (7, near, 1), (None, far, 1), (None, far, 1), (9, far, 2)]
    assert found(spark, rows) == sorted(plain(rows), key=str)
    assert [r for r in found(spark, rows) if r[0] == 5] == [(5, 2, 5, True)]


def test_links_across_tiles_of_one_label(spark, monkeypatch):
    monkeypatch.setattr(embdedup, "TILE", 16)
    monkeypatch.setattr(embdedup, "BOXES", 2)
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(12, 6))
    rows = [
        (int(i), (centres[i % 12] + rng.normal(size=6) * 0.12).astype(np.float32).tolist(), 0) for i in range(300)
    ]
    expected = plain(rows)
    assert len({c for _, _, c, _ in expected}) < 200 and sum(n for _, n, _, _ in expected) > 1000
    assert found(spark, rows) == sorted(expected, key=str)


@pytest.mark.parametrize("own", [False, True])
def test_blocks_of_a_tile_equal_all_products(own, monkeypatch):
    monkeypatch.setattr(embdedup, "BLOCK", 7)
    rng = np.random.default_rng(3)
    x = rng.normal(size=(50, 5)) * 0.3 + rng.choice([-1, 1], size=(50, 1))
    y = x if own else rng.normal(size=(31, 5)) * 0.3 + 1
    x, y = (t / np.linalg.norm(t, axis=1, keepdims=True) for t in (x, y))
    rows, columns, cosine = compare_blocks(x, y, 0.9, own)
    pairs = [tuple(sorted(p)) if own else p for p in zip(rows.tolist(), columns.tolist(), strict=True)]
    products = x @ y.T
    expected = {(i, j) for i in range(len(x)) for j in range(len(y)) if products[i, j] >= 0.9 and (not own or i < j)}
    assert set(pairs) == expected and len(pairs) == len(expected)
    assert np.allclose(cosine, products[rows, columns])
