"""Token ids of whole texts by a public tokenizer, computed word by word and kept for words that return.

The vocabulary's normaliser and pre-tokenizer never join characters across white space, nor ASCII letters, digits and other
ASCII signs with each other (but for contractions and special tokens: a word with an apostrophe or `<|` is taken whole), and
they ignore case. So a text's ids are the ids of such parts one after another; tests compare with the library on whole texts.
"""

from __future__ import annotations

import os
import zlib
from struct import pack

import numpy as np
import pandas as pd

from . import bytesops as B

#: Words whose ids one Python worker keeps.
KEPT_WORDS = 600_000


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


_KIND = np.full(256, 4, np.uint8)  # 1: ASCII letter, 2: digit, 3: other ASCII sign, 4: part of a longer character
_KIND[:128] = 3
_KIND[48:58] = 2
_KIND[65:91] = _KIND[97:123] = 1


def parts(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bytes with A-Z lower-cased but in words taken whole; starts and ends of parts; the first part of each row (n+1)."""
    start, end, rows = B.word_spans(data, off)
    odd = data == 0x27
    odd[:-1] |= (data[:-1] == 0x3C) & (data[1:] == 0x7C)
    odds = np.concatenate([[0], np.cumsum(odd)])
    whole = odds[end] > odds[start]
    kind = _KIND[data]
    cut = np.zeros(len(data), bool)
    cut[1:] = (kind[1:] < 4) & (kind[:-1] < 4) & ((kind[1:] != kind[:-1]) | (kind[1:] == 2))
    cut &= ~B.SPACE[data]
    cut[1:] &= ~B.SPACE[data[:-1]]
    low = B.LOWER[data]
    for i, j in zip(start[whole], end[whole]):
        cut[i:j] = False
        low[i:j] = data[i:j]
    cut[start] = True
    close = np.zeros(len(data) + 1, bool)
    close[end] = True
    inner = cut.copy()
    inner[start] = False
    close[:-1] |= inner
    start, end = np.flatnonzero(cut), np.flatnonzero(close)
    return low, start, end, np.searchsorted(start, off)


class WordEncoder:
    """Encodes rows of bytes into token ids with the tokenizers library."""

    _made: dict[str, WordEncoder] = {}

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.library = Tokenizer.from_file(path)
        self.model = self.library.model
        self.kept: dict[int, bytes] = {}

    @classmethod
    def of(cls, path: str) -> WordEncoder:
        """One per worker process and vocabulary."""
        if path not in cls._made:
            cls._made[path] = cls(path)
        return cls._made[path]

    def encode(self, data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids (uint32) and the n+1 offsets of the rows in them."""
        data, start, end, rows = parts(data, off)
        if not len(start):
            return np.zeros(0, np.uint32), np.zeros(len(off), np.int64)
        codes, distinct = pd.factorize(B.span_hash(B.prefix_sums(data), start, end))
        keys = distinct.tolist()
        if len(self.kept) > KEPT_WORDS:
            self.kept.clear()
        new = [i for i, k in enumerate(keys) if k not in self.kept]
        if new:
            first = np.full(len(keys), -1)
            first[codes[::-1]] = np.arange(len(codes))[::-1]
            whole, at, rest = data.tobytes(), first[new], []
            for i, a, b in zip(new, start[at].tolist(), end[at].tolist()):
                word = whole[a:b]
                if word.isalpha():  # of ASCII small letters only: the library's model itself
                    self.kept[keys[i]] = pack(f"<{len(t := self.model.tokenize(word.decode()))}I", *[x.id for x in t])
                else:
                    rest.append((i, word.decode("utf-8", "replace")))
            for (i, _), e in zip(rest, self.library.encode_batch_fast([w for _, w in rest], add_special_tokens=False)):
                self.kept[keys[i]] = pack(f"<{len(e.ids)}I", *e.ids)
        found = [self.kept[k] for k in keys]
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
        flat = np.frombuffer(b"".join(found), np.uint32)
        starts = np.concatenate([[0], np.cumsum(sizes)])[:-1]
        ids = flat[B.ranges(starts[codes], sizes[codes])]
        return ids, np.concatenate([[0], np.cumsum(sizes[codes])])[rows]


def with_end(ids: np.ndarray, off: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """The same rows with end_id after each."""
    out = np.full(len(ids) + len(off) - 1, end_id, np.uint32)
    out[np.arange(len(ids)) + B.row_of(off)] = ids
    return out, off + np.arange(len(off))


def crc(ids: np.ndarray) -> int:
    return zlib.crc32(np.ascontiguousarray(ids, "<u4").tobytes())
