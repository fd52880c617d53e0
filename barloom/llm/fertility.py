"""Quality rules: base counts of words, and tokeniser fertility with rejection bands.

A public vocabulary with byte fallback measures each text: characters per token, the
share of tokens that stand for single bytes, and the entropy of its tokens in bits.
Entropy and fertility depend on language and length, so their bands are set per
language (per script where the language is not given) and per doubling of the token
count, from the quartiles over all different texts; where these are few, also from
neighbouring lengths and from all texts. Text that repeats markup or
symbols between its words has too little entropy for its length; text in no known
language costs too many tokens; text in no known script falls back to bytes.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.llm.common import keyed, mix, named, SPACE, span_hashes, steps, stored, utf8, word_spans

#: Words in a window that counts as repeated.
WINDOW = 8
#: Bands are this many deviations wide; the README gives what they reject.
ENTROPY_WIDTH, CHARS_WIDTH, BYTES_WIDTH = 4.0, 6.0, 5.0
#: Measures with a band (characters per token as a logarithm): the least deviation, the
#: deviation where nothing is known, what groups then differ by, and drift per octave.
BANDED = {
    "entropy": (0.02, 0.15, 0.15, 0.05),
    "log_chars": (0.005, 0.04, 0.1, 0.01),
    "byte_share": (0.02, 0.02, 0.1, 0.01),
}
#: Texts that what is known from further away counts for: next to the texts of one length
#: in a group, and next to a whole group.
PRIOR_TEXTS, PRIOR_GROUP = 10, 3
#: A neighbouring octave counts for at most so many texts, and each further one for less.
ENOUGH, FADE = 50, 0.2
#: A variance is at most so many times what the neighbours or all texts have.
WIDEST = 9.0
#: Doublings of the token count: more than a text can have.
OCTAVES = 40

SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True
CONTINUES = np.zeros(256, bool)
CONTINUES[0x80:0xC0] = True

MEASURES = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "n_tokens long, chars_per_token double, byte_share double, entropy double"
)
_WEIGHTS = mix(np.arange(101, 101 + WINDOW, dtype=np.uint64)) | np.uint64(1)


def _per_text(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    return np.diff(np.append(0, np.cumsum(flags))[offsets])


def base_counts(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """The counts of each text that need no vocabulary.

    Windows and lines are compared within a text by 64-bit hashes.
    """
    n = len(offsets) - 1
    starts, ends, text = word_spans(data, offsets)
    hashes = span_hashes(data, starts, ends)

    repeated = np.zeros(len(starts) + 1, np.int64)
    inner = np.flatnonzero(text[WINDOW - 1 :] == text[: max(0, len(text) - WINDOW + 1)])
    if len(inner):
        windows = np.zeros(len(inner), np.uint64)
        for k in range(WINDOW):
            windows += hashes[inner + k] * _WEIGHTS[k]
        windows = mix(windows + mix(text[inner].astype(np.uint64)))
        _, back, counts = np.unique(windows, return_inverse=True, return_counts=True)
        again = inner[counts[back] > 1]
        np.add.at(repeated, again, 1)
        np.add.at(repeated, again + WINDOW, -1)
    covered = np.cumsum(repeated[:-1]) > 0

    line_of = np.append(0, np.cumsum(data == 0x0A))
    # A word's line: the text and how many line ends stand before the word.
    owner = line_of[starts] + text
    first = np.flatnonzero(np.diff(owner, prepend=-1))
    breaks = np.flatnonzero(data == 0x0A)
    at = np.searchsorted(breaks, starts[first])
    line_start = np.maximum(np.append(-1, breaks)[at] + 1, offsets[text[first]])
    line_end = np.minimum(np.append(breaks, len(data))[at], offsets[text[first] + 1])
    lines = mix(span_hashes(data, line_start, line_end) + mix(text[first].astype(np.uint64)))
    _, kept = np.unique(lines, return_index=True)
    lines_of = text[first]

    in_words = ~SPACE[data]
    return {
        "n_words": np.bincount(text, minlength=n),
        "word_chars": _per_text(in_words & ~CONTINUES[data], offsets),
        "n_symbols": _per_text(SYMBOLS[data], offsets),
        "n_dup_lines": np.bincount(lines_of, minlength=n)
        - np.bincount(lines_of[kept], minlength=n),
        "n_repeat_words": np.bincount(text[covered], minlength=n),
    }


@lru_cache(maxsize=2)
def _pieces(path: str) -> tuple[sentencepiece.SentencePieceProcessor, np.ndarray]:
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return model, np.array([model.is_byte(i) for i in range(model.get_piece_size())])


def fertility(texts: list[str], path: str) -> dict[str, np.ndarray]:
    """Tokens of each text's words, the share of byte tokens, and the entropy in bits."""
    model, is_byte = _pieces(path)
    rows = []
    for ids in model.encode([" ".join(text.split()) for text in texts], num_threads=1):
        ids = np.array(ids, np.int64)
        counts = np.bincount(ids)
        counts = counts[counts > 0]
        total = max(1, len(ids))
        entropy = np.log2(total) - (counts * np.log2(counts)).sum() / total
        rows.append((len(ids), is_byte[ids].sum() / total, max(0.0, entropy)))
    rows = np.array(rows, float).reshape(-1, 3)
    return {
        "n_tokens": rows[:, 0].astype(np.int64),
        "byte_share": rows[:, 1],
        "entropy": rows[:, 2],
    }


def measure(docs: DataFrame, key: Column, path: str, *, text_col: str = "text") -> DataFrame:
    """``id`` (the value of ``key``) and the measures of each whole text; a null has no words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, "text"):
            found = base_counts(*utf8(batch["text"]))
            found |= fertility([text or "" for text in batch["text"].to_pylist()], path)
            found["chars_per_token"] = found["word_chars"] / np.maximum(1, found["n_tokens"])
            names = [column.split()[0] for column in MEASURES.split(", ")]
            yield pa.RecordBatch.from_arrays(
                [batch["id"], *(pa.array(found[name]) for name in names)], ["id", *names]
            )

    slim = docs.select(key.alias("id"), F.col(text_col).cast("string").alias("text"))
    return slim.mapInArrow(run, keyed(slim, MEASURES))


def base_failed() -> Column:
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def _residuals(lines: dict[str, list[float]]) -> list[Column]:
    """Each measure less what all texts of its length have: a line within each octave."""
    at = lambda name: F.array(*(F.lit(v) for v in lines[name]))[F.col("octave")]
    step = F.col("length") - at("length")
    return [(F.col(v) - at(v) - at(f"{v}_slope") * step).alias(v) for v in BANDED]


def _curve(found: list) -> dict[str, list[float]]:
    """Per octave: the middle length, and a line for each measure.

    ``found``: medians of an octave's texts. An octave of few texts is drawn to the line
    that its neighbours give.
    """
    octave, n = (np.array([row[k] for row in found], float) for k in ("octave", "texts"))
    x = np.array([row["length"][1] for row in found])
    lines: dict[str, list[float]] = {}
    for o in range(OCTAVES):
        near = np.minimum(n, ENOUGH) * FADE ** np.abs(octave - o)
        own = octave == o
        lines.setdefault("length", []).append(float(x[own][0] if own.any() else o))
        for v in BANDED:
            y = np.array([row[v][1] for row in found])
            level, slope = 0.0, 0.0
            if len(found):
                w = near / near.sum()
                dx = x - w @ x
                slope = (w * dx) @ y / ((w * dx) @ dx + 0.05)
                other = np.where(own, 0, near)
                level = y[own][0] if own.any() else 0.0
                if other.sum():
                    w = other / other.sum()
                    step = np.clip(lines["length"][o] - w @ x, -1.5, 1.5)
                    share = n[own].sum() / (n[own].sum() + PRIOR_TEXTS)
                    level = share * level + (1 - share) * (w @ y + slope * step)
            lines.setdefault(v, []).append(float(level))
            lines.setdefault(f"{v}_slope", []).append(float(slope))
    return lines


def _variances(found: list) -> dict[str, list[float]]:
    """Per octave and measure: the variance of all texts' residuals, drawn to the usual one."""
    octave, n = (np.array([row[k] for row in found], float) for k in ("octave", "texts"))
    out: dict[str, list[float]] = {v: [] for v in BANDED}
    for o in range(OCTAVES):
        own = n[octave == o].sum()
        near = np.minimum(n, ENOUGH) * FADE ** np.abs(octave - o) * (octave != o)
        far = near @ np.abs(octave - o) / near.sum() if near.sum() else 0.0
        for v, (_, usual, _, drift) in BANDED.items():
            var = np.array([_variance(row[v]) for row in found])
            prior = (near @ var + PRIOR_TEXTS * usual**2) / (near.sum() + PRIOR_TEXTS)
            ours = min(var[octave == o].sum(), WIDEST * prior)
            pooled = (own * ours + ENOUGH * prior) / (own + ENOUGH)
            out[v].append(float(pooled + PRIOR_TEXTS / (own + PRIOR_TEXTS) * (far * drift) ** 2))
    return out


def _variance(quartiles):
    return ((quartiles[2] - quartiles[0]) / 1.349) ** 2


def bands(measured: DataFrame) -> DataFrame:
    """Per ``group`` and ``octave`` with a text that passes the base rules: its band.

    Texts that fail the base rules do not count. Copies count once. Every group and octave
    has a band: its own median and spread are drawn to those of the neighbouring octaves
    of the group, and these to the curve of all texts over the length, the more the fewer
    texts there are. What groups differ by then widens the band.
    """
    quartiles = lambda names: [
        F.percentile_approx(v, [0.25, 0.5, 0.75], 1000).alias(v) for v in names
    ]
    texts = stored(
        measured.filter(~base_failed())
        .groupBy("group", "octave", "mark", "length", *BANDED)
        .agg(F.count(F.lit(1)).alias("copies")),
        "texts",
    )
    count = F.count(F.lit(1)).alias("texts")
    # A row per octave: at most OCTAVES.
    lines = _curve(texts.groupBy("octave").agg(count, *quartiles(["length", *BANDED])).collect())
    rest = texts.select("group", "octave", *_residuals(lines))
    usual = _variances(rest.groupBy("octave").agg(count, *quartiles(BANDED)).collect())
    cells = stored(
        rest.groupBy("group", "octave")
        .agg(count, *quartiles(BANDED))
        .select(
            "group",
            "octave",
            "texts",
            *(F.col(v)[1].alias(f"{v}_mid") for v in BANDED),
            *(_variance(F.col(v)).alias(f"{v}_var") for v in BANDED),
        ),
        "cells",
    )
    weight = F.least("texts", F.lit(ENOUGH))
    apart = cells.agg(
        F.sum(weight).alias("texts"),
        *(F.sum(weight * F.col(f"{v}_mid") ** 2).alias(v) for v in BANDED),
    ).first()

    # Neighbours within a group: OCTAVES rows at most on either side of the join.
    names = [f"{v}_{k}" for v in BANDED for k in ("mid", "var")]
    other = cells.select(
        "group",
        F.col("octave").alias("_other"),
        F.least("texts", F.lit(ENOUGH)).alias("_texts"),
        *(F.col(name).alias(f"_{name}") for name in names),
    )
    gap = F.abs(F.col("octave") - F.col("_other"))
    w = F.when(gap > 0, F.col("_texts") * F.pow(F.lit(FADE), gap)).otherwise(F.lit(0.0))
    pooled = (
        cells.join(other, "group")
        .groupBy("group", "octave")
        .agg(
            F.sum(w).alias("near"),
            F.sum(w * gap).alias("_gap"),
            *(F.sum(w * F.col(f"_{name}")).alias(f"_{name}") for name in names),
            *(F.first(name).alias(name) for name in ["texts", *names]),
        )
    )
    near, texts_ = F.col("near"), F.col("texts")
    mean = lambda name: F.when(near > 0, F.col(name) / near).otherwise(F.lit(0.0))
    group_share = near / (near + PRIOR_GROUP)
    own = texts_ / (texts_ + F.least(F.lit(float(PRIOR_TEXTS)), near + PRIOR_GROUP))
    shrunk = lambda var, prior, n: (
        n * F.least(var, WIDEST * prior) + ENOUGH * prior
    ) / (n + ENOUGH)
    columns = []
    for v, (least, _, between, drift) in BANDED.items():
        differ = ((apart[v] or 0) + PRIOR_TEXTS * between**2) / ((apart["texts"] or 0) + PRIOR_TEXTS)
        prior = group_share * mean(f"_{v}_mid")
        # A few texts do not show a spread: one of three would set it.
        usual_var = F.array(*map(F.lit, usual[v]))[F.col("octave")]
        near_var = shrunk(mean(f"_{v}_var"), usual_var, near)
        var = shrunk(F.col(f"{v}_var"), near_var, texts_) + (1 - own) * (
            group_share * (mean("_gap") * drift) ** 2 + (1 - group_share) * differ
        )
        columns += [
            (own * F.col(f"{v}_mid") + (1 - own) * prior).alias(f"{v}_mid"),
            F.greatest(F.sqrt(var), F.lit(least)).alias(f"{v}_dev"),
        ]
    limits = stored(pooled.select("group", "octave", *columns), "bands")
    # The deviations of every row from its band, in deviations of the band.
    return measured.select(
        "*", F.struct(*_residuals(lines)).alias("rest")
    ).join(limits, ["group", "octave"], "left")


def quality_rules(
    docs: DataFrame,
    path: str,
    *,
    keep: list[str],
    text_col: str = "text",
    lang_col: str | None = "lang",
    as_row: bool = False,
) -> DataFrame:
    """The columns ``keep`` of every document, its measures, ``base_failed`` and ``kept``.

    With ``as_row`` the kept columns are one struct, ``row``: they may then have any
    names, also those of the measures.

    ``base_failed``: under 20 words, or over 30 of 100 words lie in 8-word windows that
    the text holds twice. Other documents are kept unless a measure is outside the band
    of their language and length: entropy too low, characters per token far from the
    median, or far more byte tokens than usual. Without a language the group is the
    script of the first letter's block; Chinese characters and kana are one. A language and
    length of few different texts is judged by its neighbours and by all texts, see
    ``bands``.

    A null text has no words. Repeated rows are judged each, and an empty table gives no
    rows.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    letter = F.regexp_extract(text, r"\p{L}", 0)
    block = (F.ascii(letter) / 1024).cast("int")
    block = F.when(block.between(12, 39), 12).otherwise(block)
    block = F.concat(F.lit("script "), block.cast("string"))
    lang = F.col(lang_col).cast("string") if lang_col else F.lit(None).cast("string")
    key = F.struct(
        F.struct(*named(keep)).alias("row"),
        F.coalesce(lang, block).alias("group"),
        F.xxhash64(text).alias("mark"),
    )
    names = [column.split()[0] for column in MEASURES.split(", ")]
    length = F.log2(F.greatest("n_tokens", F.lit(1)))
    measured = stored(
        measure(docs, key, path, text_col=text_col).select(
            "id.*",
            *names,
            length.alias("length"),
            F.floor(length).cast("int").alias("octave"),
            F.log(F.greatest("chars_per_token", F.lit(1e-3))).alias("log_chars"),
        ),
        "quality",
    )
    off = lambda v: (F.col(f"rest.{v}") - F.col(f"{v}_mid")) / F.col(f"{v}_dev")
    outside = (
        (off("entropy") < -ENTROPY_WIDTH)
        | (F.abs(off("log_chars")) > CHARS_WIDTH)
        | (off("byte_share") > BYTES_WIDTH)
    )
    kept = ~base_failed() & ~F.coalesce(outside, F.lit(False))
    return bands(measured).select(
        "row" if as_row else "row.*", *names, base_failed().alias("base_failed"), kept.alias("kept")
    )
