"""Packing by fitted patterns: whole pieces, no gaps, few sequences."""

from __future__ import annotations

import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from barloom.llm.patterns import fit_counts, list_patterns, pack_lengths, pack_residual, pack_whole

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")


def test_patterns_are_all_ways_to_fill_a_sequence():
    lengths = np.array([1, 2, 3, 5, 6, 9, 10])
    found = {tuple(sorted(int(lengths[i]) for i in row if i < 7)) for row in list_patterns(lengths, 10)}
    there = lengths.tolist()
    expected = {(10,)} | {(a, b) for a in there for b in there if a <= b and a + b == 10}
    expected |= {(a, b, c) for a in there for b in there for c in there if a <= b <= c and a + b + c == 10}
    assert found == expected and len(list_patterns(lengths, 10)) == len(expected)


def test_fit_reaches_a_histogram_that_patterns_can_make():
    lengths = np.array([2, 3, 4, 6, 8])
    patterns = list_patterns(lengths, 10)
    made = np.bincount(patterns.ravel(), np.repeat(np.arange(1.0, len(patterns) + 1), 3), 6)[:5]
    counts = fit_counts(patterns, made * 1000, np.ones(5))
    again = np.bincount(patterns.ravel(), np.repeat(counts, 3), 6)[:5]
    assert (counts >= 0).all() and again == pytest.approx(made * 1000, rel=0.01)


@pytest.mark.parametrize("seed", range(6))
def test_packs_hold_every_piece_and_are_few(seed):
    rng = random.Random(seed)
    size = rng.choice([16, 100, 512])
    histogram = {n: rng.choice([1, 3, 50, 4000]) for n in rng.sample(range(1, size + 1), size // 3)}
    runs = pack_lengths(histogram, size)
    there, filled, ranks = Counter(), Counter(), {}
    for r in runs:
        assert r.rank == ranks.get(r.length, 0)
        ranks[r.length] = r.rank + r.packs * r.times
        there[r.length] += r.packs * r.times
        for pack in {r.sequence, r.sequence + r.packs - 1}:
            assert filled[pack] == r.offset
            filled[pack] += r.times * r.length
    assert there == Counter(histogram) and max(filled.values()) <= size
    packs = max(r.sequence + r.packs for r in runs)
    plain = sum(count for count, _ in pack_residual(histogram, size))
    assert packs <= 1.03 * plain + 2


def test_one_length_takes_as_many_as_fit():
    assert sum(count for count, _ in pack_residual({3: 10}, 10)) == 4
    assert pack_lengths({}, 10) == []
    with pytest.raises(ValueError, match="1 to 10"):
        pack_lengths({11: 1}, 10)


def test_whole_documents(spark):
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 6)))
    texts = [(1, ""), (2, None), (3, " ".join(word() for _ in range(5_000))), (None, "no id"), (None, "no id")]
    # A third of the rows on one null id.
    texts += [(None, "the same words here") for _ in range(60)]
    texts += [(10 + i, " ".join(word() for _ in range(rng.randint(1, 200)))) for i in range(120)]
    names = "piece int, start long, length long, row string, id long, _task int, rank long, sequence_id long"
    rows = [(i, t, 1, 2, 3, "x", 4, 5, 6, 7) for i, t in texts]
    docs = spark.createDataFrame(rows, f"doc_id long, text string, {names}").repartition(5)
    found = pack_whole(docs, WORD_BPE, 0, 256).collect()
    tokenizer = Tokenizer.from_file(WORD_BPE)
    ids = {t: [*tokenizer.encode(t or "", add_special_tokens=False).ids, 0] for _, t in texts}
    expected = Counter()
    for i, t in texts:
        for piece, start in enumerate(range(0, len(ids[t]), 256)):
            part = np.array(ids[t][start : start + 256], "<u4")
            expected[i, piece, start, len(part), zlib.crc32(part.tobytes()), tuple(part.tolist())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32, tuple(r.ids)) for r in found) == expected
    used = {}
    for r in found:
        used.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in used.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= 256
    least = -(-sum(r.length for r in found) // 256)
    assert len(used) <= least + 2
    assert pack_whole(docs.where("false"), WORD_BPE, 0).isEmpty()
