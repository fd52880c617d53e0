"""The corpus operators on small tables: edge cases, and brute force where SQL has no words."""

from __future__ import annotations

import hashlib
import random
import tempfile
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__ as contract
import corpus_pipeline
from barloom.llm import queries
from barloom.llm.common import documents
from barloom.llm.components import components
from barloom.llm.embdedup import near_duplicate_vectors
from barloom.llm.fertility import quality_rules
from barloom.llm.langid import detect_languages
from barloom.llm.neardup import near_duplicates
from barloom.llm.packing import pack_documents
from barloom.llm.ppm import ORDER, score_documents
from barloom.llm.sharding import shard_documents
from barloom.llm.simple8b import token_files
from barloom.llm.toxicity import toxicity
from tests.llm.test_small import naive_ppm, naive_score

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
DDL = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    # Names that operators use inside.
    "id long, node long, bucket long, label string, size long, key string, row string"
)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 6)))
    base = [word() for _ in range(120)]
    near = list(base)
    near[60] = "changed"
    texts = [
        (1, " ".join(base)), (2, " ".join(base)), (3, " ".join(near)), (4, ""), (5, None), (6, "few words"),
        (7, " ".join(word() for _ in range(30_000))), (8, " ".join(base)), (9, "few words"), (9, "few words"),
        (10, "\n".join(["a line of words that comes again"] * 20)), (11, "12 34"), (None, "no id here at all"),
    ]
    texts += [(100 + i, " ".join(word() for _ in range(rng.randint(20, 90)))) for i in range(30)]
    langs = ["en", "de", None]
    return [(i, t, langs[n % 3], None, None, 1, 2, 3, "x", 5, "k", "r") for n, (i, t) in enumerate(texts)]


@pytest.fixture(scope="module")
def docs(spark, rows):
    path = tempfile.mkdtemp(prefix="run-", dir="/tmp") + "/docs"
    spark.createDataFrame(rows, DDL).repartition(3).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DDL)


def ids_of(text, end):
    tokenizer = Tokenizer.from_file(WORD_BPE)
    return np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, end], "<u4")


def test_sharding(docs, rows, empty):
    found = shard_documents(docs, shards=4).collect()
    assert Counter(r.doc_id for r in found) == Counter(r[0] for r in rows)
    for shard in {r.shard for r in found}:
        slots = sorted(r.slot for r in found if r.shard == shard)
        assert slots == list(range(len(slots)))
    home = {}
    for r in found:
        assert home.setdefault(r.text_crc32, r.shard) == r.shard
    sizes = {r[0]: len((r[1] or "").encode()) + 8 for r in rows}
    assert all(r["size"] == sizes[r.doc_id] for r in found)
    assert shard_documents(empty).isEmpty()


def test_token_files(docs, rows, empty):
    found = sorted(token_files(docs, WORD_BPE, 1).collect(), key=lambda r: r.start)
    order = [r.doc_id for r in found]
    assert order == sorted(order, key=lambda i: -1 if i is None else i)
    texts = {r[0]: r[1] for r in rows}
    start = 0
    for r in found:
        ids = ids_of(texts[r.doc_id], 1)
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    assert token_files(empty, WORD_BPE, 1).isEmpty()


def test_packing(docs, rows, empty):
    found = pack_documents(docs, WORD_BPE, 2, 512).collect()
    texts = {r[0]: r[1] for r in rows}
    used, pieces = {}, Counter()
    for r in found:
        ids = ids_of(texts[r.doc_id], 2)
        part = ids[r.start : r.start + r.length]
        assert (list(r.ids), r.doc_tokens) == (part.tolist(), len(ids))
        assert r.ids_crc32 == zlib.crc32(part.tobytes())
        used.setdefault(r.sequence_id, []).append((r.offset, r.length))
        pieces[r.doc_id] += r.length
    for parts in used.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= 512
    copies = Counter(r[0] for r in rows)
    assert pieces == {i: n * len(ids_of(texts[i], 2)) for i, n in copies.items()}
    assert pack_documents(empty, WORD_BPE, 2).isEmpty()


def test_bpe(docs, rows):
    found = contract.queries()["op4_bpe"]
    assert found is queries.op4_bpe
    from barloom.llm.bpe import bpe_decode, bpe_encode

    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    back = bpe_decode(bpe_encode(docs, path, public_tokenizers.PATTERN), path)
    texts = {r[0]: (r[1] or "").encode() for r in rows}
    assert all(bytes(r.decoded) == texts[r.doc_id] for r in back.collect())


def test_quality(docs, rows, empty):
    found = {r.doc_id: r for r in quality_rules(docs, PIECES, keep=["doc_id"]).collect()}
    assert not found[1].base_failed and found[1].kept
    assert all(found[i].base_failed and not found[i].kept for i in (4, 5, 6, 10, 11))
    assert found[5].n_words == 0 and found[10].n_dup_lines == 19
    kept = quality_rules(docs, PIECES, keep=docs.columns).select(docs.columns)
    assert kept.schema == docs.schema and kept.count() == len(rows)
    assert quality_rules(empty, PIECES, keep=["doc_id"]).isEmpty()


def test_quality_bands_reject_symbols(spark):
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 6)))
    rows = []
    for i in range(600):
        words = [word() for _ in range(rng.randint(60, 500))]
        rows.append((i, " ".join(w + "%%%" if i < 12 else w for w in words), "en"))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    found = {r.doc_id: r.kept for r in quality_rules(docs, PIECES, keep=["doc_id"]).collect()}
    assert not any(found[i] for i in range(12)) and all(found[i] for i in range(12, 600))


def test_languages(spark, docs, empty):
    rng = random.Random(6)
    make = lambda parts: " ".join("".join(rng.choices(parts, k=3)) for _ in range(30))
    rows = [(i, make(["the", "ing", "and"]), "en") for i in range(80)]
    rows += [(100 + i, make(["sch", "ung", "ein"]), "de") for i in range(80)]
    rows += [(300, None, "en"), (301, "12 34", "de"), (302, make(["the", "ing"]), None)]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    learn = F.col("doc_id") % 4 != 2
    found = detect_languages(table, learn, F.struct("doc_id")).collect()
    said = {r.id.doc_id: r.lang_pred for r in found}
    assert said[300] == said[301] == "und" and said[302] == "en"
    assert all(said[i] == lang for i, _, lang in rows if i < 200)
    assert all(0 <= r.score <= 1 for r in found)
    assert detect_languages(empty, F.lit(True), F.struct("doc_id")).isEmpty()
    assert detect_languages(docs, F.lit(True), F.struct("doc_id")).count() == docs.count()


def test_toxicity(spark, docs, empty):
    rng = random.Random(7)
    rows, marks = [], []
    for i in range(200):
        words = [f"w{rng.randrange(50)}" for _ in range(25)]
        if i % 4 == 0:
            words[rng.randrange(25)] = "zounds"
        rows.append((i, " ".join(words)))
        marks.append((i, 1 if i % 4 == 0 else 0))
    marks += [(None, 1), (3, None), (9999, 1)]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame(marks, "doc_id long, toxic int")
    learn = F.col("doc_id") % 5 != 0
    scored = {r.doc_id: r.score for r in toxicity(table, labels, learn).collect()}
    assert all((scored[i] >= 0.5) == (i % 4 == 0) for i in scored)
    assert toxicity(empty, labels, learn).isEmpty()
    nothing = labels.where("doc_id < 0")
    assert all(r.score < 0.5 for r in toxicity(docs, nothing, F.lit(True)).collect())


def test_ppm_equals_a_plain_model(docs, rows, empty):
    held = F.coalesce(F.col("doc_id") % 7 == 2, F.lit(True))
    some = docs.filter("doc_id is null or doc_id <> 7")
    found = score_documents(some, ~held).collect()
    used = [r for r in rows if r[0] != 7]
    train = [r[1] or "" for r in used if r[0] is not None and r[0] % 7 != 2]
    seen = naive_ppm(train, ORDER)
    tokens = Counter(w for t in train for w in [*t.lower().split(), None])
    n, v = sum(tokens.values()), len(tokens)
    texts = {r[0]: r[1] or "" for r in used}
    assert len(found) == len(used)
    for r in found:
        text = texts[r.doc_id]
        own = [*text.lower().split(), None]
        assert (r.n_tokens, r.train_tokens) == (len(own), n)
        assert r.n_known == sum(tokens[w] > 0 for w in own)
        base = sum(np.log10((tokens[w] + 1) / (n + v + 1)) for w in own)
        assert r.base_score == pytest.approx(base, rel=1e-9)
        assert r.score == pytest.approx(naive_score(seen, text, ORDER), rel=1e-9)
    assert score_documents(empty, F.lit(True)).isEmpty()
    untrained = score_documents(some, F.lit(False)).filter("doc_id = 6").first()
    assert untrained.score == pytest.approx(-10 * np.log10(257))


def test_near_duplicates(docs, rows, empty):
    found = near_duplicates(docs, keep=docs.columns)
    kept = Counter(r.doc_id for r in found.filter("kept").collect())
    assert kept == Counter({r[0]: 1 for r in rows if r[0] not in (2, 3, 8, 9)})
    said = {r.doc_id: (r.first_id, r.component_id) for r in found.collect()}
    assert said[8] == (1, 1) and said[3] == (3, 1) and said[9] == (6, 6) and said[4] == (4, 4)
    assert found.select(docs.columns).schema == docs.schema
    assert near_duplicates(empty, keep=["doc_id"]).isEmpty()


def test_a_family_of_near_copies_equals_brute_force(spark):
    rng = random.Random(11)
    base = [f"w{rng.randrange(10**6)}" for _ in range(80)]
    rows = []
    for i in range(160):
        words = list(base)
        for at in rng.sample(range(80), rng.choice([0, 1, 2, 3, 6, 12])):
            words[at] = f"x{rng.randrange(10**6)}"
        rows.append((i, " ".join(words)))
    sets = [{tuple(t.split()[k : k + 5]) for k in range(76)} for _, t in rows]
    parent = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                low, high = sorted((parent[i], parent[j]))
                parent = [low if p == high else p for p in parent]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: r.component_id for r in near_duplicates(docs, keep=["doc_id"]).collect()}
    assert found == dict(enumerate(parent))


def test_vectors_equal_brute_force(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(300, 16)).astype(np.float32)
    x[100:180] = x[:80] + rng.normal(size=(80, 16)).astype(np.float32) * 0.05
    x[200:240] = x[0]
    rows = [(i, x[i].tolist(), int(i % 3)) for i in range(300)]
    rows += [
        (300, None, 1), (301, [0.0] * 16, 1), (302, [1.0, None] * 8, 1), (303, [float("nan")] * 16, 1),
        (304, x[0].tolist(), None), (305, [], 1), (306, x[0, :8].tolist(), 0), (0, x[0].tolist(), 0),
    ]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    found = Counter(tuple(r) for r in near_duplicate_vectors(table).collect())
    fine = [(i, np.array(v, float), g) for i, v, g in rows if i < 300]
    fine += [(306, x[0, :8].astype(float), 0)]
    unit = [v / np.sqrt((v * v).sum()) for _, v, _ in fine]
    links = [
        [j for j in range(len(fine)) if j != i and fine[i][2] == fine[j][2]
         and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= 0.98]
        for i in range(len(fine))
    ]
    low = [row[0] for row in fine]
    while True:
        new = [min([low[i], *(low[j] for j in links[i])]) for i in range(len(fine))]
        if new == low:
            break
        low = new
    expected = Counter((fine[i][0], len(links[i]), low[i], fine[i][0] == low[i]) for i in range(len(fine)))
    expected.update((i, 0, i, True) for i in range(300, 306))
    assert found == expected
    assert near_duplicate_vectors(table.where("vec_id < 0")).isEmpty()


def test_pipeline_stages_keep_columns_and_take_effect(spark, docs, empty):
    left = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = left.count()
        left = _written(stage(spark, left, ""))
        assert left.schema == docs.schema, name
        assert left.count() <= before
    kept = {r.doc_id for r in left.collect()}
    assert 1 in kept and 7 in kept and not kept & {2, 3, 4, 5, 6, 8, 10, 11}
    packed = corpus_pipeline.packing(spark, left, "").collect()
    assert {r.doc_id for r in packed} == kept
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, "").isEmpty()


def _written(df):
    path = tempfile.mkdtemp(prefix="run-", dir="/tmp") + "/stage"
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def test_every_operator_is_registered(spark):
    names = contract.queries()
    for number in range(1, 14):
        assert sum(name.startswith(f"op{number}_") for name in names) == 1
    assert names["pipeline"] is corpus_pipeline.run


def test_held_out_accuracy(spark):
    """On the given tables: languages and toxicity outside what was learned from."""
    sf_dir = "/root/testdata/sf0.01"
    docs = documents(spark, sf_dir).select("doc_id", "lang")
    found = queries.op6_language_id(spark, sf_dir).join(docs, "doc_id").where("held_out")
    assert found.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0] > 0.97
    sf_dir = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    scored = queries.op2_toxicity(spark, sf_dir).join(labels, "doc_id").where("held_out")
    rates = {r.toxic: r.rate for r in scored.groupBy("toxic").agg(F.avg("predicted").alias("rate")).collect()}
    assert rates[1] >= 0.8 and rates[0] < 0.01


def test_digests_of_the_bpe_query(spark):
    sf_dir = "/root/testdata/sf0.001"
    found = queries.op4_bpe(spark, sf_dir).collect()
    texts = {r.doc_id: r.text or "" for r in documents(spark, sf_dir).collect()}
    assert len(found) == len(texts)
    for r in found:
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


def test_components_of_chains_stars_and_cycles(spark):
    rng = random.Random(12)
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 120)] + [(200, 201), (201, 200)]
    edges += [(rng.randrange(300, 400), rng.randrange(300, 400)) for _ in range(60)] + [(500, 500)]
    rng.shuffle(edges)
    low = {i: i for edge in edges for i in edge}
    for _ in range(len(low)):
        for a, b in edges:
            low[a] = low[b] = min(low[a], low[b])
    table = spark.createDataFrame(edges, "a long, b long")
    found = {r.node: r.component for r in components(table).collect()}
    alone = {i for i in low if all(a == b for a, b in edges if i in (a, b))}
    assert found == {i: c for i, c in low.items() if i not in alone}
    assert components(table.where("a < 0")).isEmpty()


def test_quality_bands_reach_rare_languages_and_sparse_lengths(spark):
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 6)))
    text = lambda n, mark="": " ".join(word() + mark for _ in range(n))
    rows = [(i, text(rng.randint(60, 500)), "en") for i in range(300)]
    rows += [(1000 + i, text(rng.randint(60, 500)), "fi") for i in range(4)]
    rows += [(2000, text(200), None), (2001, text(1200), "en"), (2002, text(1300), "en")]
    clean = len(rows)
    # A rare language, one of its own, none, and a length that few texts have.
    junk = [(200, "fi"), (200, "sw"), (200, None), (800, "en")]
    rows += [(3000 + i, text(n, "%%%"), lang) for i, (n, lang) in enumerate(junk)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    found = {r.doc_id: r.kept for r in quality_rules(docs, PIECES, keep=["doc_id"]).collect()}
    assert not any(found[i] for i, _, _ in rows[clean:])
    assert all(found[i] for i, _, _ in rows[:clean])


def test_quality_bands_of_characters_and_bytes_reject(spark):
    rng = random.Random(9)
    make = lambda letters: "".join(rng.choice(letters) for _ in range(rng.randint(3, 6)))
    rows = [(i, " ".join(make("abcdefgh") for _ in range(rng.randint(100, 400))), "en") for i in range(300)]
    odd = [make("abcdefgh") if i % 6 else "ༀ" for i in range(200)]
    rows += [(300, " ".join(make("qxzjkvwy") for _ in range(200)), "en"), (301, " ".join(odd), "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    found = {r.doc_id: r for r in quality_rules(docs, PIECES, keep=["doc_id"]).collect()}
    assert 0.1 < found[301].byte_share < 0.3
    assert not found[300].kept and not found[301].kept
    assert all(found[i].kept for i in range(300))
