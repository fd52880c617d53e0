"""Language identification: a bidirectional gated recurrent network over bytes.

Two gated recurrent units read each window of a text's bytes, one forwards and one
backwards. At every byte both states together give a probability for each language;
the document's probabilities are the mean over all its bytes. The network is trained in
numpy by backpropagation through time, on windows of a bounded sample of documents.

Gates and candidate are piecewise linear, so that a byte costs few operations.
"""

from __future__ import annotations

import io
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.llm.common import keyed, steps, stored, utf8

HIDDEN = 8
#: Bytes that the network reads at a time; texts are cut into such windows.
WINDOW = 128
#: Windows read side by side.
BATCH = 4096
#: Training: documents of each language, and of all; windows of each; their bytes.
EACH, ALL, WINDOWS, LENGTH = 1000, 20_000, 4, 64
STEPS, TRAIN_BATCH, RATE = 300, 256, 0.005

UNKNOWN = "und"


class Network:
    """Weights by name: kind, part and direction.

    Kinds: ``in`` (a row per byte value), ``state`` and ``out``. Parts: update gate ``z``,
    reset gate ``r``, candidate ``c``. Directions: ``f`` and ``b``. Each part has arrays
    of its own, so that all work is on contiguous memory.
    """

    def __init__(self, langs: list[str], weights: dict[str, np.ndarray]):
        self.langs, self.w = langs, weights

    @classmethod
    def new(cls, langs: list[str]) -> Network:
        random, h, w = np.random.default_rng(7), HIDDEN, {}
        for d in "fb":
            # Gates are linear from 0 to 1. At first a state changes slowly.
            for part, middle, scale in (("z", 0.25, 0.25), ("r", 0.5, 0.25), ("c", 0.0, 1.0)):
                w[f"in_{part}{d}"] = random.normal(middle, 0.3 * scale, (256, h))
                w[f"state_{part}{d}"] = random.normal(0, scale * h**-0.5, (h, h))
            w[f"out_{d}"] = random.normal(0, 0.3, (h, len(langs)))
        w["bias"] = np.zeros(len(langs))
        return cls(langs, {k: v.astype(np.float32) for k, v in w.items()})

    def dump(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, langs=np.array(self.langs), **self.w)
        return out.getvalue()

    @classmethod
    def load(cls, data: bytes) -> Network:
        found = np.load(io.BytesIO(data))
        return cls(found["langs"].tolist(), {k: found[k] for k in found.files if k != "langs"})

    def _read(self, x: np.ndarray, d: str, logits: np.ndarray, tape: list | None) -> None:
        """Run direction ``d`` over bytes ``x`` (time, window), adding to ``logits``."""
        w = self.w
        parts = [(w[f"in_{part}{d}"], w[f"state_{part}{d}"]) for part in "zrc"]
        out = w[f"out_{d}"]
        s = np.zeros((x.shape[1], HIDDEN), out.dtype)
        z, r, c, u = (np.empty_like(s) for _ in range(4))
        for t in range(len(x)) if d == "f" else range(len(x) - 1, -1, -1):
            for gate, (inputs, state) in zip((z, r), parts, strict=False):
                np.take(inputs, x[t], axis=0, out=gate)
                gate += np.matmul(s, state, out=u)
                np.clip(gate, 0, 1, out=gate)
            inputs, state = parts[2]
            np.matmul(s, state, out=u)
            np.take(inputs, x[t], axis=0, out=c)
            if tape is not None:
                tape.append((t, s.copy(), z.copy(), r.copy(), u.copy()))
            u *= r
            c += u
            np.clip(c, -1, 1, out=c)
            if tape is not None:
                tape[-1] += (c.copy(),)
            c -= s
            c *= z
            s += c
            logits[t] += s @ out

    def probabilities(self, x: np.ndarray, tapes: dict | None = None) -> np.ndarray:
        """Probabilities at each byte of ``x``: (time, window, language)."""
        logits = np.empty((*x.shape, len(self.langs)), self.w["bias"].dtype)
        logits[:] = self.w["bias"]
        for d in "fb":
            self._read(x, d, logits, None if tapes is None else tapes.setdefault(d, []))
        np.clip(logits, -40, 40, out=logits)
        np.exp(logits, out=logits)
        total = logits[..., 0].copy()
        for k in range(1, len(self.langs)):
            total += logits[..., k]
        np.reciprocal(total, out=total)
        logits *= total[..., None]
        return logits

    def gradients(self, x: np.ndarray, mask: np.ndarray, label: np.ndarray) -> dict[str, np.ndarray]:
        """Of the mean cross-entropy over bytes where ``mask`` holds."""
        tapes: dict[str, list] = {}
        wrong = self.probabilities(x, tapes)
        wrong[:, np.arange(x.shape[1]), label] -= 1
        wrong *= (mask / mask.sum())[:, :, None]
        grads = {k: np.zeros_like(v) for k, v in self.w.items()}
        grads["bias"] += wrong.sum(axis=(0, 1))
        for d in "fb":
            state = {part: self.w[f"state_{part}{d}"] for part in "zrc"}
            out = self.w[f"out_{d}"]
            ds = np.zeros((x.shape[1], HIDDEN), out.dtype)
            for t, s, z, r, uc, c in reversed(tapes[d]):
                grads[f"out_{d}"] += (s + z * (c - s)).T @ wrong[t]
                ds = ds + wrong[t] @ out.T
                dc = ds * z * (np.abs(c) < 1)
                below = {"z": ds * (c - s) * ((z > 0) & (z < 1)), "r": dc * uc * ((r > 0) & (r < 1))}
                below["c"] = dc
                ds = ds * (1 - z)
                for part, da in below.items():
                    np.add.at(grads[f"in_{part}{d}"], x[t], da)
                    du = da * r if part == "c" else da
                    grads[f"state_{part}{d}"] += s.T @ du
                    ds += du @ state[part].T
        return grads


def train(langs: list[str], x: np.ndarray, lengths: np.ndarray, label: np.ndarray) -> Network:
    """A network from windows ``x`` (window, byte), their lengths and language numbers."""
    net = Network.new(langs)
    first = {k: np.zeros_like(v) for k, v in net.w.items()}
    second = {k: np.zeros_like(v) for k, v in net.w.items()}
    mask = (np.arange(x.shape[1]) < lengths[:, None]).astype(np.float32)
    random, order = np.random.default_rng(0), np.zeros(0, np.int64)
    for step in range(1, STEPS + 1):
        if not len(order):
            order = random.permutation(len(x))
        rows, order = order[:TRAIN_BATCH], order[TRAIN_BATCH:]
        grads = net.gradients(x[rows].T.copy(), mask[rows].T, label[rows])
        rate = RATE * min(1.0, 2 * (1 - step / (STEPS + 1)))
        for k, g in grads.items():  # Adam
            first[k] += 0.1 * (g - first[k])
            second[k] += 0.01 * (g * g - second[k])
            scale = rate / (1 - 0.9**step) * (1 - 0.99**step) ** 0.5
            net.w[k] -= (scale * first[k] / (np.sqrt(second[k]) + 1e-8)).astype(np.float32)
    return net


def windows(data: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, ...]:
    """All texts' bytes in windows (window, byte), zero-filled; each one's length and text."""
    sizes = np.diff(offsets)
    count = -(-sizes // size)
    text = np.repeat(np.arange(len(sizes)), count)
    number = np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count)
    lengths = np.minimum(size, sizes[text] - number * size)
    padded = np.append(data, np.zeros(size, np.uint8))
    x = padded[(offsets[text] + number * size)[:, None] + np.arange(size)]
    x[np.arange(size) >= lengths[:, None]] = 0
    return x, lengths, text


def language_sample(docs: DataFrame, learn: Column) -> DataFrame:
    """About ``EACH`` documents of every language, ``ALL`` at most; by a hash of the id.

    If ``ALL`` is too few for that, every language gets an equal part of it. Rows that
    share id and language are one document, with the text of the least hash.
    """
    known = docs.filter(learn & F.col("lang").isNotNull() & (F.length("text") > 0))
    slim = known.select("doc_id", "lang", F.xxhash64("doc_id").alias("_order")).distinct()
    counts = stored(slim.groupBy("lang").agg(F.count(F.lit(1)).alias("_n")), "languages")
    each = min(float(EACH), ALL / max(1, counts.count()))
    # A document's place among those of its language, as far as the hash tells.
    place = F.abs(F.shiftright("_order", 1)) * 2.0 / float(1 << 63) * F.col("_n")
    chosen = stored(
        slim.join(counts, "lang")
        .withColumn("_place", place)
        .filter(F.col("_place") <= each)
        .orderBy("_place", "doc_id", "lang")
        .limit(ALL)
        .select("doc_id", "lang", "_order"),
        "sample",
    )
    # At most ``ALL`` rows, so the table to send is bounded.
    rows = known.select("doc_id", "text", "lang").join(F.broadcast(chosen), ["doc_id", "lang"])
    text = F.min_by("text", F.xxhash64("text")).alias("text")
    return rows.groupBy("doc_id", "lang", "_order").agg(text)


def learn_network(sample: DataFrame) -> bytes:
    """Train in one task on a bounded sample (columns ``_order``, ``text``, ``lang``)."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, "text"):
            data, offsets = utf8(batch["text"])
            orders = batch["_order"].to_numpy()
            rows, order, lang = [], [], []
            for i in range(batch.num_rows):
                text = data[offsets[i] : offsets[i + 1]]
                random = np.random.default_rng(abs(int(orders[i])))
                for at in random.integers(0, max(1, len(text) - LENGTH + 1), WINDOWS):
                    rows.append(text[at : at + LENGTH].tobytes())
                    order.append(int(orders[i]))
                    lang.append(batch["lang"][i].as_py())
            yield pa.RecordBatch.from_arrays(
                [pa.array(order), pa.array(lang), pa.array(rows, pa.binary())],
                ["order", "lang", "bytes"],
            )

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = sorted(
            (order, lang, data)
            for batch in batches
            for order, lang, data in zip(*(c.to_pylist() for c in batch.columns), strict=True)
        )
        if rows:
            langs = sorted({lang for _, lang, _ in rows})
            label = np.array([langs.index(lang) for _, lang, _ in rows])
            lengths = np.array([len(data) for _, _, data in rows])
            x = np.frombuffer(b"".join(d.ljust(LENGTH, b"\0") for _, _, d in rows), np.uint8)
            net = train(langs, x.reshape(-1, LENGTH), lengths, label)
            yield pa.RecordBatch.from_arrays([pa.array([net.dump()], pa.binary())], ["model"])

    pieces = sample.select("_order", "lang", "text").mapInArrow(
        cut, "order long, lang string, bytes binary"
    )
    found = pieces.repartition(1).mapInArrow(fit, "model binary").collect()
    return bytes(found[0]["model"]) if found else Network.new([UNKNOWN]).dump()


def identify(
    docs: DataFrame, model: bytes, key: Column, *, text_col: str = "text"
) -> DataFrame:
    """``id`` (the value of ``key``), ``lang_pred`` and ``score`` of each whole text.

    ``lang_pred`` is ``und``, with score 0, for a null text or one without a letter.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = Network.load(shared.value)
        for batch in steps(batches, "text"):
            x, lengths, text = windows(*utf8(batch["text"]), WINDOW)
            pooled = np.zeros((batch.num_rows, len(net.langs)))
            for start in range(0, len(x), BATCH):
                part = slice(start, start + BATCH)
                probable = net.probabilities(x[part].T.copy())
                probable[np.arange(WINDOW)[:, None] >= lengths[part]] = 0
                total = probable.reshape(WINDOW, -1).sum(axis=0).reshape(-1, len(net.langs))
                for k in range(len(net.langs)):
                    pooled[:, k] += np.bincount(text[part], total[:, k], batch.num_rows)
            pooled /= np.maximum(pooled.sum(axis=1, keepdims=True), 1e-300)
            best = pooled.argmax(axis=1)
            unknown = ~batch["letter"].to_numpy(zero_copy_only=False).astype(bool)
            lang = np.where(unknown, UNKNOWN, np.array(net.langs)[best])
            score = np.where(unknown, 0.0, pooled.max(axis=1))
            yield pa.RecordBatch.from_arrays(
                [batch["id"], pa.array(lang.tolist(), pa.string()), pa.array(score)],
                ["id", "lang_pred", "score"],
            )

    text = F.col(text_col).cast("string")
    letter = F.coalesce(text.rlike(r"\p{L}"), F.lit(False))
    slim = docs.select(key.alias("id"), text.alias("text"), letter.alias("letter"))
    return slim.mapInArrow(run, keyed(slim, "lang_pred string, score double"))


def detect_languages(docs: DataFrame, learn: Column, key: Column) -> DataFrame:
    """Languages of all documents, learned from ``lang`` of those where ``learn`` holds.

    Needs columns ``doc_id``, ``text`` and ``lang``. Rows without a language or text are
    not learned from; if none is left, every language is ``und``. Repeated rows are
    judged each, and an empty table gives no rows.
    """
    return identify(docs, learn_network(language_sample(docs, learn)), key)
