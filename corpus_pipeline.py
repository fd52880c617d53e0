"""From raw documents to packed sequences, in four stages.

Each stage takes the session, the documents that its predecessor kept, and the folder
of tables; all but the last return the columns they were given.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.llm.common import documents, named, stored
from barloom.llm.fertility import quality_rules
from barloom.llm.langid import UNKNOWN, detect_languages
from barloom.llm.neardup import near_duplicates
from barloom.llm.packing import pack_documents

#: A stated language is doubted if another one is at least so likely.
DOUBT = 0.9


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the tokeniser's fertility keep."""
    path = public_tokenizers.path("piece_bpe_32k.model")
    return quality_rules(docs, path, keep=docs.columns, as_row=True).filter("kept").select("row.*")


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a known language; those without one get the one they are in.

    Rejected are texts without a letter, and those that are surely in another language
    than is stated. If no document has a language, none can be learned: all texts with a
    letter are kept, and their language stays null.
    """
    found = detect_languages(docs, F.lit(True), F.struct(*named(docs.columns)))
    letter = F.coalesce(F.col("id.text").rlike(r"\p{L}"), F.lit(False))
    # Of a text with a letter, ``UNKNOWN`` says that nothing was learned.
    said = F.when(F.col("lang_pred") != UNKNOWN, F.col("lang_pred"))
    other = (F.col("id.lang") != said) & (F.col("score") >= DOUBT)
    kept = found.filter(letter & ~F.coalesce(other, F.lit(False)))
    filled = F.coalesce("id.lang", said).alias("lang")
    return kept.select(*(filled if c == "lang" else F.col("id")[c].alias(c) for c in docs.columns))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one with the smallest id."""
    return near_duplicates(docs, keep=docs.columns, as_row=True).filter("kept").select("row.*")


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document lies in sequences of 4,096 tokens."""
    return pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), 2, with_ids=False)


STAGES = [
    ("quality rules", quality),
    ("language id", language),
    ("near dedup", near_dedup),
    ("packing", packing),
]

#: The first stage measures by a tokeniser's vocabulary, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over all documents; each result is written and read again."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
