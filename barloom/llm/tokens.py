"""Token ids of whole texts by a public tokenizer file that drops white space.

The tokenizer never joins anything across ASCII white space, so a text's ids are those
of its words, one after another; nor across the border between a letter and a full
stop or the like, nor does it tell ASCII capitals from small letters. Words are known by
a 64-bit hash of their bytes; only words that a worker has not seen lately go through
the library, many in one call.
"""

from __future__ import annotations

import os
from functools import lru_cache

import numpy as np
import pyarrow as pa
from tokenizers import Tokenizer

from barloom.llm.common import span_hashes, utf8, word_spans

#: Words that a worker remembers; beyond it, it starts anew.
CACHE_WORDS = 1_000_000
#: Words given to the library in one text.
CALL_WORDS = 4096
#: How the file marks the last token of a run of letters.
WORD_END = "</w>"

STOP = np.zeros(256, bool)
STOP[list(b".,!?;:")] = True
CAPITAL = np.zeros(256, bool)
CAPITAL[0x41:0x5B] = True
LETTER = CAPITAL.copy()
LETTER[0x61:0x7B] = True
#: Second bytes of the letters of Latin-1 after 0xC3.
LATIN = np.zeros(256, bool)
LATIN[0x80:0xC0] = True
LATIN[[0x97, 0xB7]] = False


def _all(flags: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    sums = np.append(0, np.cumsum(flags, dtype=np.int64))
    return sums[ends] - sums[starts] == ends - starts


class WordIds:
    """Ids per word, as arrays sorted by the words' hashes."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a Spark task is one thread
        self.tokenizer = Tokenizer.from_file(path)
        special = self.tokenizer.get_added_tokens_decoder()
        self.border = min(special, default=None)
        self.border_text = special[self.border].content if special else ""
        self.specials = [token.content for token in special.values()]
        self.last = np.zeros(max([*self.tokenizer.get_vocab().values()]) + 1, bool)
        self.last[[i for t, i in self.tokenizer.get_vocab().items() if t.endswith(WORD_END)]] = True
        self._clear()

    def _clear(self) -> None:
        self.keys = np.zeros(0, np.uint64)
        self.starts = self.lengths = np.zeros(0, np.int64)
        self.pool = np.zeros(0, np.int32)

    def _encode(self, words: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]

    def _encode_each(self, words: list[str]) -> list[np.ndarray]:
        """Ids of any words."""
        if not self.specials or any(s in word for word in words for s in self.specials):
            return [np.array(ids, np.int32) for ids in self._encode(words)]
        # A special token parts words as a white space does, and marks where.
        rows = []
        for start in range(0, len(words), CALL_WORDS):
            [ids] = self._encode([self.border_text.join(words[start : start + CALL_WORDS])])
            first, *more = np.split(
                np.array(ids, np.int32), np.flatnonzero(np.array(ids) == self.border)
            )
            rows += [first, *(row[1:] for row in more)]
        return rows

    def _encode_runs(self, words: list[str]) -> list[np.ndarray]:
        """Ids of words of nothing but letters: each ends with its only last token."""
        rows = []
        for start in range(0, len(words), CALL_WORDS):
            part = words[start : start + CALL_WORDS]
            [ids] = self._encode([" ".join(part)])
            ids = np.array(ids, np.int32)
            found = np.split(ids, np.flatnonzero(self.last[ids])[:-1] + 1)
            rows += found if len(found) == len(part) else self._encode_each(part)
        return rows

    def _learn(self, keys: np.ndarray, words: list[str], runs: np.ndarray) -> None:
        rows: list = [None] * len(words)
        for some, encode in ((runs, self._encode_runs), (~runs, self._encode_each)):
            at = np.flatnonzero(some).tolist()
            for i, ids in zip(at, encode([words[i] for i in at]), strict=True):
                rows[i] = ids
        lengths = np.array([*map(len, rows)])
        starts = len(self.pool) + np.cumsum(lengths) - lengths
        at = np.searchsorted(self.keys, keys)
        self.keys = np.insert(self.keys, at, keys)
        self.starts = np.insert(self.starts, at, starts)
        self.lengths = np.insert(self.lengths, at, lengths)
        self.pool = np.concatenate([self.pool, *rows])

    def ids(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and where each text's ids start and the last end."""
        data, offsets = utf8(texts)
        starts, ends, text = word_spans(data, offsets)
        before = np.append(0, data[:-1]).astype(np.uint8)
        latin = LATIN[data] & (before == 0xC3)
        letter = LETTER[data] | latin
        cut = np.flatnonzero(STOP[data[1:]] & letter[:-1]) + 1
        # A text that begins with a stop is cut there already.
        cut = cut[~np.isin(cut, starts)]
        starts, ends = np.sort(np.append(starts, cut)), np.sort(np.append(ends, cut))
        text = np.searchsorted(offsets, starts, "right") - 1
        # ASCII words in small letters. Special tokens begin with another character.
        plain = _all(LETTER[data] | STOP[data], starts, ends)
        small = np.flatnonzero(CAPITAL[data])
        small = small[plain[np.searchsorted(starts, small, "right") - 1]]
        data = data.copy()
        data[small] += 32

        keys, first, back = np.unique(
            span_hashes(data, starts, ends), return_index=True, return_inverse=True
        )
        if len(self.keys) > CACHE_WORDS:
            self._clear()
        at = np.searchsorted(self.keys, keys)
        known = at < len(self.keys)
        known[known] = self.keys[at[known]] == keys[known]
        if not known.all():
            new = first[~known]
            raw = data.tobytes()
            spans = zip(starts[new].tolist(), ends[new].tolist(), strict=True)
            lead = (data == 0xC3) & np.append(latin[1:], False)
            runs = _all(letter | lead, starts[new], ends[new])
            self._learn(keys[~known], [raw[a:b].decode("utf-8") for a, b in spans], runs)
            at = np.searchsorted(self.keys, keys)
        lengths, places = self.lengths[at][back], self.starts[at][back]
        stops = np.cumsum(lengths)
        shift = np.repeat(places - stops + lengths, lengths)
        ids = self.pool[shift + np.arange(len(shift))]
        words_before = np.searchsorted(text, np.arange(len(offsets)))
        return ids, np.append(0, stops)[words_before]


@lru_cache(maxsize=2)
def word_ids(path: str) -> WordIds:
    return WordIds(path)


def with_end(ids: np.ndarray, ends: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """The same with ``end_id`` after each text."""
    return np.insert(ids, ends[1:], end_id), ends + np.arange(len(ends))
