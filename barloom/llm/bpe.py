"""Byte-level BPE: encode texts to token ids by a rank file, and decode them again.

A rank file lists tokens as bytes with their ranks; merging takes the pair of least
rank first. The same result is reached in linear time without merging:

* An Aho-Corasick automaton over the tokens, bytes mapped to Latin-1 characters,
  finds the longest token at each place.
* A sequence of tokens is the merged one exactly if no two neighbours would have
  merged across their border. That is a property of the two tokens alone, found by
  walking back through the merges at the border, and remembered per pair.
* Where the longest token is not compatible with the one before it, the next shorter
  one is tried; if none fits, the token before is taken back.

All new pieces of a step first take the longest match everywhere, in one automaton
pass; only those with an incompatible pair are searched one by one. Pieces met
before come from a cache of bounded size.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.llm.common import keyed, steps

#: Pieces kept in each half of a worker's cache, and pairs kept.
CACHE_PIECES = 200_000
CACHE_PAIRS = 1_000_000
#: Documents decoded at a time.
DECODE_ROWS = 256
#: A character outside Latin-1, so outside every token.
BORDER = "Ā"
_NEVER = 1 << 62


class Vocabulary:
    """Tokens of a rank file, and what the encoder derives from them."""

    def __init__(self, path: str):
        with open(path, "rb") as lines:
            pairs = (line.split() for line in lines if line.strip())
            self.ranks = {base64.b64decode(token): int(rank) for token, rank in pairs}
        self.bytes = {rank: token for token, rank in self.ranks.items()}
        self.longest = max(map(len, self.ranks))
        self.automaton = ahocorasick.Automaton()
        self.left: dict[int, int] = {}
        self.right: dict[int, int] = {}
        for token, rank in self.ranks.items():
            self.automaton.add_word(token.decode("latin-1"), rank)
            if len(token) > 1:
                self.left[rank], self.right[rank] = self._parts(token)
        self.automaton.make_automaton()
        self.shorter = {
            rank: next(
                (self.ranks[token[:n]] for n in range(len(token) - 1, 0, -1) if token[:n] in self.ranks),
                None,
            )
            for token, rank in self.ranks.items()
        }
        self.size = max(self.bytes) + 1
        self.lengths = np.zeros(self.size, np.int64)
        self.lengths[list(self.bytes)] = [len(token) for token in self.bytes.values()]
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.data = np.frombuffer(b"".join(self.bytes[i] for i in sorted(self.bytes)), np.uint8)
        self._apart: dict[int, bool] = {}

    def _parts(self, token: bytes) -> tuple[int, int]:
        """The last two tokens merged to make ``token``."""
        parts = [token[i : i + 1] for i in range(len(token))]
        while len(parts) > 2:
            ranks = [self.ranks.get(a + b, _NEVER) for a, b in zip(parts, parts[1:], strict=False)]
            best = min(ranks)
            at = ranks.index(best)
            if best == _NEVER:
                raise ValueError(f"token {token!r} cannot be merged from other tokens")
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return self.ranks[parts[0]], self.ranks[parts[1]]

    def apart(self, a: int, b: int) -> bool:
        """Whether ``a`` and then ``b`` stay two tokens in the merged text."""
        key = a * self.size + b
        known = self._apart.get(key)
        if known is None:
            if len(self._apart) >= CACHE_PAIRS:
                self._apart.clear()
            known = self._apart[key] = self._stay_apart(a, b)
        return known

    def _stay_apart(self, a: int, b: int) -> bool:
        # Back in time: a merge happens at the time of its rank. ``x`` and ``y`` are
        # what stands at the border until ``x_ends`` and ``y_ends``.
        x, y, x_ends, y_ends = a, b, _NEVER, _NEVER
        while True:
            rank = self.ranks.get(self.bytes[x] + self.bytes[y])
            # Of equal ranks the one more to the left merges first.
            if rank is not None and rank < x_ends and rank <= y_ends:
                return False
            if x in self.right and (x > y or y not in self.left):
                x, x_ends = self.right[x], x
            elif y in self.left:
                y, y_ends = self.left[y], y
            else:
                return True

    def search(self, piece: str) -> list[int]:
        """Ids of one piece (bytes as Latin-1), by search from the longest matches."""
        if (whole := self.ranks.get(piece.encode("latin-1"))) is not None:
            return [whole]
        longest: dict[int, int] = {}
        for end, token in self.automaton.iter(piece):
            longest[end + 1 - len(self.bytes[token])] = token
        ids: list[int] = []
        at, dead, token = 0, set(), longest[0]
        while at < len(piece):
            while token is not None:
                end = at + len(self.bytes[token])
                if end not in dead and (not ids or self.apart(ids[-1], token)):
                    break
                token = self.shorter[token]
            if token is None:
                dead.add(at)
                last = ids.pop()
                at -= len(self.bytes[last])
                token = self.shorter[last]
            else:
                ids.append(token)
                at = end
                token = longest.get(at)
        return ids

    def encode(self, pieces: list[str]) -> list[np.ndarray]:
        """Ids of many pieces (bytes as Latin-1, none empty)."""
        joined = BORDER.join(pieces)
        found = np.array(
            [x for pair in self.automaton.iter_long(joined) for x in pair], np.int64
        ).reshape(-1, 2)
        ids, starts = found[:, 1], found[:, 0] + 1 - self.lengths[found[:, 1]]
        ends = np.cumsum([len(piece) + 1 for piece in pieces])
        owner = np.searchsorted(ends, starts, "right")
        covered = np.bincount(owner, self.lengths[ids], len(pieces)).astype(np.int64)
        wrong = covered != np.array([len(piece) for piece in pieces])
        inner = np.flatnonzero(owner[1:] == owner[:-1])
        pairs, back = np.unique(ids[inner] * self.size + ids[inner + 1], return_inverse=True)
        apart = np.array([self.apart(*divmod(pair, self.size)) for pair in pairs.tolist()], bool)
        wrong[owner[inner[~apart[back]]]] = True
        out = np.split(ids, np.searchsorted(owner, np.arange(1, len(pieces))))
        for i in np.flatnonzero(wrong).tolist():
            out[i] = np.array(self.search(pieces[i]))
        return out

    def decode(self, ids: np.ndarray) -> np.ndarray:
        """The bytes of the ids, one after another."""
        lengths = self.lengths[ids]
        ends = np.cumsum(lengths)
        shift = np.repeat(self.starts[ids] - ends + lengths, lengths)
        return self.data[shift + np.arange(len(shift))]


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


class Pieces:
    """Ids of pieces of text, remembered: what was not used for long is dropped."""

    def __init__(self, words: Vocabulary):
        self.words, self.new, self.old = words, {}, {}

    def learn(self, pieces: set[str]) -> None:
        """Afterwards ``new`` holds all ``pieces``."""
        if len(self.new) > CACHE_PIECES:
            self.old, self.new = self.new, {}
        missing = pieces.difference(self.new)
        for piece in missing & self.old.keys():
            self.new[piece] = self.old[piece]
        fresh = list(missing.difference(self.old))
        latin = [piece.encode("utf-8").decode("latin-1") for piece in fresh]
        if fresh:
            for piece, ids in zip(fresh, self.words.encode(latin), strict=True):
                self.new[piece] = ids.astype(np.int32).tobytes()


@lru_cache(maxsize=2)
def _pieces(path: str) -> Pieces:
    return Pieces(vocabulary(path))


def bpe_encode(
    docs: DataFrame, path: str, pattern: str, *, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``id_col`` and ``ids`` (array of int): each whole text in token ids.

    ``pattern`` splits a text into pieces that are encoded separately; there are no
    special tokens. A null or empty text has an empty array. Repeated rows are encoded
    each, other columns are ignored, an empty table gives no rows.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, cache = regex.compile(pattern).findall, _pieces(path)
        for batch in steps(batches, "text"):
            found = [split(text) if text else [] for text in batch["text"].to_pylist()]
            cache.learn(set().union(*found))
            get = cache.new.__getitem__
            rows = [b"".join(map(get, pieces)) for pieces in found]
            ends = np.cumsum([0, *map(len, rows)]) // 4
            ids = pa.array(np.frombuffer(b"".join(rows), np.int32))
            yield pa.RecordBatch.from_arrays(
                [batch["id"], pa.ListArray.from_arrays(pa.array(ends, pa.int32()), ids)],
                ["id", "ids"],
            )

    slim = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return slim.mapInArrow(run, keyed(slim, "ids array<int>")).withColumnRenamed("id", id_col)


def bpe_decode(
    encoded: DataFrame, path: str, *, id_col: str = "doc_id", ids_col: str = "ids"
) -> DataFrame:
    """``id_col`` and ``decoded`` (binary): the bytes that the ids stand for.

    A null or empty array has no bytes. Ids outside the rank file raise an error.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary(path)
        for whole in batches:
            for start in range(0, whole.num_rows, DECODE_ROWS):
                batch = whole.slice(start, DECODE_ROWS)
                counts = pc.fill_null(pc.list_value_length(batch["ids"]), 0).to_numpy(False)
                ids = batch["ids"].flatten().to_numpy(zero_copy_only=False)
                data = words.decode(ids)
                sizes = np.cumsum(np.append(0, words.lengths[ids]))
                ends = sizes[np.cumsum(np.append(0, counts))]
                raw = pa.Array.from_buffers(
                    pa.binary(),
                    batch.num_rows,
                    [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(data)],
                )
                yield pa.RecordBatch.from_arrays([batch["id"], raw], ["id", "decoded"])

    slim = encoded.select(F.col(id_col).alias("id"), F.col(ids_col).alias("ids"))
    return slim.mapInArrow(run, keyed(slim, "decoded binary")).withColumnRenamed("id", id_col)

