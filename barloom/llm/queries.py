"""The corpus operators on the given tables, with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from barloom.llm.bpe import bpe_decode, bpe_encode
from barloom.llm.common import documents, remainder
from barloom.llm.embdedup import near_duplicate_vectors
from barloom.llm.fertility import quality_rules
from barloom.llm.langid import detect_languages
from barloom.llm.neardup import near_duplicates
from barloom.llm.oracles import LLM_ORACLES as LLM_ORACLES
from barloom.llm.packing import pack_documents
from barloom.llm.patterns import pack_whole
from barloom.llm.periodic import periodic_runs
from barloom.llm.ppm import score_documents
from barloom.llm.repair import conversation_digests, repair_conversations
from barloom.llm.sharding import shard_documents
from barloom.llm.simple8b import token_files
from barloom.llm.toxicity import toxicity

LLM_REGISTRY = {}


def query(fn):
    LLM_REGISTRY[fn.__name__] = fn
    return fn


def _ids_digest(ids: str):
    """Count and SHA-256 of an array of ids."""
    text = F.concat_ws(",", F.col(ids).cast("array<string>"))
    return F.struct(
        F.size(ids).cast("long").alias("n_tokens"), F.sha2(text, 256).alias("ids_sha256")
    )


@query
def op1_embedding_near_dedup(spark, sf_dir):
    """Links and components of all vectors within their label."""
    return near_duplicate_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


@query
def op2_toxicity(spark, sf_dir):
    """Toxicity of every text, learned from labels outside the held-out fifth."""
    held_out = remainder("doc_id", 5) == 0
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    scored = toxicity(documents(spark, sf_dir), labels, ~held_out)
    return scored.select(
        "doc_id",
        held_out.alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


@query
def op3_minhash_near_dedup(spark, sf_dir):
    """The class of near copies of every document."""
    return near_duplicates(documents(spark, sf_dir), keep=["doc_id"])


@query
def op4_bpe(spark, sf_dir):
    """Ids of every text by a public rank file, decoded again; as digests."""
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    encoded = bpe_encode(documents(spark, sf_dir), path, public_tokenizers.PATTERN)
    # Digests of the ids go along with the document's id, so one pass makes both.
    known = F.struct("doc_id", _ids_digest("ids").alias("ids")).alias("key")
    decoded = bpe_decode(encoded.select(known, "ids"), path, id_col="key")
    return decoded.select(
        "key.doc_id", "key.ids.*", F.sha2("decoded", 256).alias("decoded_sha256")
    )


@query
def op5_ppm_scores(spark, sf_dir):
    """Scores of every text, learned outside the held-out seventh."""
    held_out = remainder("doc_id", 7) == 2
    return score_documents(documents(spark, sf_dir), ~held_out).withColumn("held_out", held_out)


@query
def op6_language_id(spark, sf_dir):
    """The language of every text, learned outside the held-out quarter."""
    held_out = remainder("doc_id", 4) == 2
    found = detect_languages(documents(spark, sf_dir), ~held_out, F.struct("doc_id"))
    return found.select("id.doc_id", "lang_pred", "score").withColumn("held_out", held_out)


@query
def op7_token_files(spark, sf_dir):
    """Every text's ids written to binary files in id order, and read back."""
    return token_files(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"), 1)


@query
def op8_packing(spark, sf_dir):
    """Every text's pieces in sequences of 4,096 tokens."""
    path = public_tokenizers.path("word_bpe_49k.json")
    return pack_documents(documents(spark, sf_dir), path, 2, with_ids=False)


@query
def op9_quality_rules(spark, sf_dir):
    """Base counts and the verdict of tokeniser fertility for every document."""
    path = public_tokenizers.path("piece_bpe_32k.model")
    return quality_rules(documents(spark, sf_dir), path, keep=["doc_id"])


@query
def op10_sharding(spark, sf_dir):
    """24 shards of near equal size, equal texts together."""
    return shard_documents(documents(spark, sf_dir))


def _damaged(conversations):
    """Turns with faults planted by their numbers; a null is one space. ``there`` is false
    for a turn that is dropped."""
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    name = F.concat(blank("conv_id"), F.lit(":"), blank("turn"))
    code = F.crc32(name.cast("binary")) % 20
    text = F.when(code == 1, "").when(code == 2, F.regexp_replace(blank("text"), "[.!?]", ""))
    times = F.when(code == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return conversations.select(
        "conv_id",
        "turn",
        F.when(code == 4, "user").otherwise(blank("role")).alias("role"),
        text.otherwise(blank("text")).alias("text"),
        (code != 0).alias("there"),
        F.explode(times).alias("time"),
    )


@query
def op11_conversation_repair(spark, sf_dir):
    """The cheapest repair of every conversation after planted damage, as digests."""
    turns = _damaged(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
    return conversation_digests(repair_conversations(turns, present=F.col("there")))


def _with_planted_runs(docs):
    """Texts of a tenth of the documents, whose words from one on repeat the first of them."""
    code = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    draw = F.call_function("div", code, F.lit(10))
    words = F.when(code % 10 == 0, F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0)))
    rows = docs.select("doc_id", "text", words.alias("words"), draw.alias("draw"))
    rows = rows.withColumn("n", F.size("words").cast("long"))
    rows = rows.withColumn("a", F.col("draw") % F.greatest("n", F.lit(1)))
    rest = F.col("n") - F.col("a")
    rows = rows.withColumn("p", 1 + F.call_function("div", rest, 3 + F.col("draw") % 8))
    part = lambda start, length: F.slice("words", start.cast("int"), length.cast("int"))
    times = F.call_function("div", rest, F.col("p")) + 1
    tail = F.flatten(F.array_repeat(part(F.col("a") + 1, F.col("p")), times.cast("int")))
    planted = F.slice(F.concat(part(F.lit(1), F.col("a")), tail), F.lit(1), F.col("n").cast("int"))
    text = F.when(F.col("n") > 0, F.concat_ws(" ", planted)).otherwise(F.col("text"))
    return rows.select("doc_id", text.alias("text"))


@query
def op12_periodic_runs(spark, sf_dir):
    """Runs of repeated words in every text, planted ones among them, and their digests."""
    found = periodic_runs(_with_planted_runs(documents(spark, sf_dir)))
    # The greatest exact exponent first; runs are in order of start and period.
    better = lambda a, b: a["length"] * b["period"] - b["length"] * a["period"]
    order = lambda a, b: F.when(better(a, b) != 0, -F.signum(better(a, b)).cast("int")).otherwise(
        F.when(a["start"] != b["start"], F.signum(a["start"] - b["start"]).cast("int")).otherwise(
            F.signum(a["period"] - b["period"]).cast("int")
        )
    )
    best = F.get(F.array_sort("runs", order), F.lit(0))
    line = lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])
    lines = F.transform("runs", lambda r: F.concat(line(r), F.lit("\n")))
    rows = found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        best.alias("best"),
        F.sha2(F.concat_ws("", lines), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
    milli = F.call_function("div", 1000 * F.col("best.length"), F.col("best.period"))
    return rows.select(
        "doc_id", "n_runs", "best.*", milli.alias("exponent_milli"), "runs_sha256", "collapsed_sha256"
    )


@query
def op13_pattern_packing(spark, sf_dir):
    """Every text in sequences of 2,048 tokens, whole where it fits."""
    path = public_tokenizers.path("word_bpe_49k.json")
    return pack_whole(documents(spark, sf_dir), path, 0, with_ids=False)
