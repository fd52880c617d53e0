"""Language-model scores: prediction by partial matching over bytes.

The model predicts each byte, and the end of the text, from the up to ``ORDER`` bytes
before it. A context gives a symbol its share of what followed the context in the
training texts, and keeps a share for what never did, by as many as it has different
symbols (escape method C). After an escape the next shorter context decides, without the
symbols that the longer one would have given (exclusion); below the empty context all
remaining symbols are equally likely. A text's score is the sum of its log10
probabilities.

The trie of contexts lies in a table: one row per string of ``ORDER + 1`` symbols that
occurs, nine bits a symbol. As every shorter count is a sum of longer ones, and the
symbols of a context follow its shorter contexts too, escapes and exclusions come from
joins of that table with its own sums. So the model is as large as the corpus makes it
and lies on no single machine. Texts are scored in buckets: a bucket's table, of the
strings and words that it holds, comes with its texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom.llm.common import span_hashes, steps, stored, utf8, word_spans

ORDER = 4
SYMBOLS = 257  # bytes and the end
END, START, WIDTH = 256, 257, 9
#: Bytes of text in a bucket; a longer text is a bucket of its own.
BUCKET_BYTES = 48 << 20
#: The key of the end as a token of the base.
END_KEY = 0


def grams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The last ``ORDER + 1`` symbols at every symbol of every text; where texts start."""
    n = len(offsets) - 1
    ends = offsets + np.arange(n + 1)
    symbols = np.full(len(data) + n, END, np.int64)
    place = np.arange(len(data)) + np.repeat(np.arange(n), np.diff(offsets))
    symbols[place] = data
    codes = symbols.copy()
    inside = np.arange(len(symbols)) - np.repeat(ends[:-1], np.diff(ends))
    for back in range(1, ORDER + 1):
        earlier = np.full(len(symbols), START, np.int64)
        earlier[back:] = symbols[:-back]
        earlier[inside < back] = START
        codes |= earlier << (WIDTH * back)
    return codes, ends


def _counted(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    keys, back = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
    counts = np.bincount(back, np.concatenate([c for _, c in parts]))
    return keys, counts.astype(np.int64)


def _step_counts(keys: np.ndarray, learn: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each key once, with how often it occurs where ``learn`` holds."""
    out = []
    for some, weight in ((learn, 1), (~learn, 0)):
        values = np.sort(keys[some])
        first = np.flatnonzero(np.diff(values, prepend=values[:1] - 1))
        out.append((values[first], weight * np.diff(np.append(first, len(values)))))
    return _counted(out)


def _token_keys(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Key and text number of all tokens: words, and an end for each text."""
    lowered = data + np.where((data >= 0x41) & (data <= 0x5A), 32, 0).astype(np.uint8)
    starts, ends, text = word_spans(lowered, offsets)
    n = len(offsets) - 1
    keys = np.append(span_hashes(lowered, starts, ends).view(np.int64), np.full(n, END_KEY))
    return keys, np.append(text, np.arange(n))


def _bucketed(docs: DataFrame, learn: Column, id_col: str, text_col: str) -> DataFrame:
    """``id``, ``text``, ``learn`` and ``bucket``: neighbours share a bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held = 0, 0
        for batch in steps(batches, "text"):
            size = pc.sum(pc.binary_length(batch["text"])).as_py() or 0
            if held and held + size > BUCKET_BYTES:
                number, held = number + 1, 0
            held += size
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.full(batch.num_rows, number))],
                [*batch.schema.names, "number"],
            )

    slim = docs.select(
        F.col(id_col).alias("id"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
        F.coalesce(learn, F.lit(False)).alias("learn"),
    )
    kind = slim.schema["id"].dataType.simpleString()
    # Small neighbouring splits are one partition, so that buckets fill.
    whole = slim.mapInArrow(run, f"id {kind}, text string, learn boolean, number long")
    bucket = F.spark_partition_id().cast("long") * (1 << 24) + F.col("number")
    return whole.withColumn("bucket", bucket).drop("number")


def _bucket_counts(texts: DataFrame) -> DataFrame:
    """Per bucket every ``key`` it holds, of words or not, and ``n`` in training texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, parts = None, {True: [], False: []}

        def close() -> Iterator[pa.RecordBatch]:
            for word, found in parts.items():
                keys, counts = _counted(found)
                found.clear()
                columns = [np.full(len(keys), bucket), np.full(len(keys), word), keys, counts]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c) for c in columns], ["bucket", "word", "key", "n"]
                )

        for batch in _by_bucket(steps(batches, "text")):
            now = batch["bucket"][0].as_py()
            if bucket is not None and now != bucket:
                yield from close()
            bucket = now
            data, offsets = utf8(batch["text"])
            learn = batch["learn"].to_numpy(zero_copy_only=False)
            codes, ends = grams(data, offsets)
            parts[False].append(_step_counts(codes, np.repeat(learn, np.diff(ends))))
            keys, text = _token_keys(data, offsets)
            parts[True].append(_step_counts(keys, learn[text]))
            for found in parts.values():
                if len(found) > 16:
                    found[:] = [_counted(found)]
        if bucket is not None:
            yield from close()

    return texts.mapInArrow(run, "bucket long, word boolean, key long, n long")


def _by_bucket(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        buckets = batch["bucket"].to_numpy()
        cuts = [0, *(np.flatnonzero(np.diff(buckets)) + 1).tolist(), len(buckets)]
        for a, b in zip(cuts, cuts[1:], strict=False):
            yield batch.slice(a, b - a)


def _symbols(k: int) -> int:
    """A mask of the last ``k`` symbols of a code."""
    return (1 << (WIDTH * k)) - 1


def log_probabilities(counts: DataFrame) -> DataFrame:
    """``key`` and ``value`` (log10 probability) of every string in ``counts`` (key, n).

    Rows with ``n`` 0 are strings to score that the model never saw.
    """
    # seen[k]: strings of k + 1 symbols; a prefix of k of them is a context of order k.
    seen = {ORDER: counts.filter("n > 0")}
    for k in range(ORDER - 1, -1, -1):
        short = F.col("key").bitwiseAND(_symbols(k + 1)).alias("key")
        seen[k] = seen[k + 1].select(short, "n").groupBy("key").agg(F.sum("n").alias("n"))
        seen[k] = stored(seen[k], f"order{k}")
    table = counts.select("key", "n")
    for k in range(ORDER, -1, -1):
        context = F.shiftright("key", WIDTH)
        grouped = seen[k].withColumn("context", context)
        total = [F.sum("n").alias(f"total{k}"), F.count(F.lit(1)).alias(f"kinds{k}")]
        if k:
            # What the symbols of this context count in the next shorter one.
            lower = seen[k - 1].select(F.col("key").alias("short"), F.col("n").alias("below"))
            grouped = grouped.withColumn("short", F.col("key").bitwiseAND(_symbols(k)))
            grouped = grouped.join(_small(lower, k - 1), "short")
            total.append(F.sum("below").alias(f"below{k}"))
        contexts = grouped.groupBy("context").agg(*total).withColumnRenamed("context", f"c{k}")
        own = seen[k].select(F.col("key").alias(f"s{k}"), F.col("n").alias(f"n{k}"))
        masked = F.col("key").bitwiseAND(_symbols(k + 1))
        table = table.withColumns({f"s{k}": masked, f"c{k}": F.shiftright(masked, WIDTH)})
        # Contexts of order k are as many as strings of k symbols.
        table = table.join(_small(own, k), f"s{k}", "left").join(_small(contexts, k - 1), f"c{k}", "left")
    log = lambda part, whole: F.log10(part / whole)
    # lower[k]: the value below a context of order k + 1 that has escaped, without its
    # symbols; plain[k]: the value from order k on, if no longer context was known.
    unknown = -F.log10(F.lit(float(SYMBOLS)) - F.coalesce("kinds0", F.lit(0)))
    lower, plain = unknown, unknown
    for k in range(ORDER + 1):
        n, total, kinds = F.col(f"n{k}"), F.col(f"total{k}"), F.col(f"kinds{k}")
        found = F.when(n.isNotNull(), log(n, total + kinds)).when(
            total.isNotNull(), log(kinds, total + kinds) + lower
        )
        plain = F.coalesce(found, plain)
        if k < ORDER:
            rest = total - F.col(f"below{k + 1}")
            fresh = kinds - F.col(f"kinds{k + 1}")
            lower = (
                F.when(n.isNotNull(), log(n, rest + fresh))
                .when(fresh > 0, log(fresh, rest + fresh) + lower)
                .otherwise(lower)
            )
    return table.select("key", plain.alias("value"))


def _small(table: DataFrame, order: int) -> DataFrame:
    """Strings of up to two symbols are at most 258 * 258: they are sent to all tasks."""
    return F.broadcast(table) if order < 2 else table


def score_documents(
    docs: DataFrame, learn: Column, *, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Scores of all whole texts by models learned from those where ``learn`` holds.

    Columns: ``id_col``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``,
    ``score``. The base is the add-one unigram model of lower-cased words and an end.
    Words and the end are known by 64-bit hashes.

    A null text is empty: its only token is the end. Repeated rows are scored, and
    learned from, each. With nothing to learn from, all symbols are equally likely. An
    empty table gives no rows; other columns are ignored.
    """
    texts = stored(_bucketed(docs, learn, id_col, text_col), "texts")
    held = stored(_bucket_counts(texts), "counts")
    strings = held.filter("not word")
    model = log_probabilities(
        stored(strings.groupBy("key").agg(F.sum("n").alias("n")), "strings")
    )
    same = Window.partitionBy("key")
    words = held.filter("word").select(
        "bucket",
        "word",
        "key",
        F.sum("n").over(same).cast("double").alias("value"),
        # Each word is counted in the bucket where it comes first.
        (F.row_number().over(same.orderBy("bucket")) == 1).alias("first"),
    )
    valued = strings.join(model, "key").select("bucket", "word", "key", "value", F.lit(False).alias("first"))

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        right = right.sort_by("key")
        is_word = right["word"].to_numpy()
        keys, values = right["key"].to_numpy(), right["value"].to_numpy()
        word_keys, counts = keys[is_word], values[is_word]
        gram_keys, logs = keys[~is_word], values[~is_word]
        first = right["first"].to_numpy()[is_word]
        rows = []
        for batch in steps(iter(left.to_batches()), "text"):
            data, offsets = utf8(batch["text"])
            codes, ends = grams(data, offsets)
            logged = logs[np.searchsorted(gram_keys, codes)]
            tokens, text = _token_keys(data, offsets)
            count = counts[np.searchsorted(word_keys, tokens)]
            size = batch.num_rows
            rows.append(
                pa.RecordBatch.from_arrays(
                    [
                        batch["id"],
                        pa.array(np.bincount(text, minlength=size)),
                        pa.array(np.bincount(text[count > 0], minlength=size)),
                        pa.array(np.bincount(text, np.log10(count + 1), size)),
                        pa.array(np.add.reduceat(logged, ends[:-1])),
                        pa.array(np.ones(size, bool)),
                    ],
                    names,
                )
            )
        # One row for the bucket: its share of the training words, and of different ones.
        own = first & (counts > 0)
        share = pa.Table.from_pydict(
            {
                "id": pa.nulls(1, left.schema.field("id").type),
                "n_tokens": [int(counts[own].sum())],
                "n_known": [int(own.sum())],
                "logs": [0.0],
                "score": [0.0],
                "text": [False],
            },
            schema=rows[0].schema if rows else None,
        )
        return pa.concat_tables([pa.Table.from_batches(rows), share])

    names = ["id", "n_tokens", "n_known", "logs", "score", "text"]
    kind = texts.schema["id"].dataType.simpleString()
    schema = f"id {kind}, n_tokens long, n_known long, logs double, score double, text boolean"
    tables = words.unionByName(valued)
    scored = stored(
        texts.groupBy("bucket").cogroup(tables.groupBy("bucket")).applyInArrow(score, schema), "scored"
    )
    tokens, kinds = scored.filter("not text").agg(F.sum("n_tokens"), F.sum("n_known")).first()
    tokens, kinds = tokens or 0, kinds or 0
    base = F.col("logs") - F.col("n_tokens") * float(np.log10(tokens + kinds + 1))
    return scored.filter("text").select(
        F.col("id").alias(id_col),
        "n_tokens",
        "n_known",
        F.lit(tokens).cast("long").alias("train_tokens"),
        base.alias("base_score"),
        "score",
    )
