"""Phrase search over the bytes of whole Arrow batches: one automaton of all phrases, walked from all places at once.

A phrase is matched without case; an apostrophe stands for both kinds; at an edge that is a letter or digit a word begins or ends
(plain: of ASCII letters, digits and _, so that a long s at an edge is none).
The automaton is a table of states by byte. A place is a start while the bytes from it spell a prefix of some phrase, so each step
looks only at the places that are left, and a batch costs its bytes plus the prefixes it holds, whatever it is made of.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_ASCII_WORD = np.zeros(256, bool)
_ASCII_WORD[[ord("_"), *range(48, 58), *range(65, 91), *range(97, 123)]] = True
_ASCII_WHITE = np.zeros(256, bool)
_ASCII_WHITE[[0x20, *range(9, 14)]] = True
_PLAIN_WHITE = _ASCII_WHITE.copy()
_PLAIN_WHITE[11] = False
#: White space beyond ASCII.
WIDE_WHITE = "".join(map(chr, [0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))
_WORD = re.compile(r"\w")


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column and the n+1 offsets of its rows; a null is empty."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    column = pc.fill_null(column, "") if column.null_count else column
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    wide = pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    return (np.frombuffer(data, np.uint8)[off[0] : off[-1]] if data is not None else np.zeros(0, np.uint8)), off - off[0]


def white(data: np.ndarray, plain: bool = False) -> np.ndarray:
    """Whether each byte is of a white space character; plain: of one of `[\\t\\n\\f\\r ]`."""
    if plain:
        return _PLAIN_WHITE[data]
    out = _ASCII_WHITE[data]
    for lead in {c.encode()[0] for c in WIDE_WHITE}:
        at = np.flatnonzero(data == lead)
        for c in (c.encode() for c in WIDE_WHITE if c.encode()[0] == lead):
            here = at[at + len(c) <= len(data)]
            for j, b in enumerate(c[1:], 1):
                here = here[data[here + j] == b]
            for j in range(len(c)):
                out[here + j] = True
    return out


def _character(data: np.ndarray, at: int, forward: bool) -> str:
    """The character that begins at a byte, or the one that ends before it."""
    raw = bytes(data[at : at + 4] if forward else data[max(0, at - 4) : at])
    text = raw.decode("utf-8", "ignore")
    return text[:1] if forward else text[-1:]


def is_word(data: np.ndarray, at: np.ndarray, low: np.ndarray, high: np.ndarray, forward: bool, plain: bool = False) -> np.ndarray:
    """Whether the character from (or before) each place is one of a word (plain: of ASCII); nothing lies beyond the rows' ends low and high."""
    inside = at < high if forward else at > low
    byte = np.zeros(len(at), np.uint8)
    byte[inside] = data[at[inside] - (0 if forward else 1)]
    out = _ASCII_WORD[byte] & inside
    for i in [] if plain else np.flatnonzero(inside & (byte >= 0x80)):
        out[i] = bool(_WORD.match(_character(data, int(at[i]), forward)))
    return out


class Automaton:
    """Phrases by number, in the order in which one is preferred to another that starts at the same place."""

    def __init__(self, phrases: list[str]):
        self.phrases = phrases
        rows: list[np.ndarray] = [np.full(256, -1, np.int32)]
        ends: list[int] = [-1]

        def child(node: int, byte: int) -> int:
            if rows[node][byte] < 0:
                rows[node][byte] = len(rows)
                rows.append(np.full(256, -1, np.int32))
                ends.append(-1)
            return int(rows[node][byte])

        for k, phrase in enumerate(phrases):
            node = 0
            for c in phrase.lower():
                forms = {c, c.upper()} | set({"'": "\u2019", "s": "\u017f", "k": "\u212a"}.get(c, ""))
                first, *rest = sorted(f.encode() for f in forms)
                start, node = node, node
                for b in first:
                    node = child(node, b)
                for form in rest:  # other spellings of the character lead to the same state
                    at = start
                    for b in form[:-1]:
                        at = child(at, b)
                    rows[at][form[-1]] = node
            if ends[node] < 0:
                ends[node] = k
        self.table, self.ends = np.stack(rows), np.array(ends, np.int32)
        self.open = (self.table >= 0).any(axis=1)
        self.first_word = np.array([p[0].isalnum() for p in phrases])
        self.last_word = np.array([p[-1].isalnum() for p in phrases])
        two = np.zeros((256, 256), bool)
        for a in np.flatnonzero(self.table[0] >= 0):
            two[a] = self.table[self.table[0][a]] >= 0
        self.two = two.reshape(-1)

    def find(self, data: np.ndarray, off: np.ndarray, bounded: bool = True, plain: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(row, phrase, start, end) of all matches in order of start, overlapping ones too; bounded: at word edges only (plain: of ASCII words)."""
        if len(data) < 2:
            return (np.zeros(0, np.int64),) * 4
        start = np.flatnonzero(self.two[(data[:-1].astype(np.uint16) << 8) | data[1:]])
        if bounded and self.first_word.all():
            start = start[(start == 0) | ~_ASCII_WORD[data[start - 1]] | (plain & (data[start] >= 0x80)) | np.isin(start, off)]
        row = np.searchsorted(off, start, "right") - 1
        state, at, live = self.table[0][data[start]], start + 1, np.arange(len(start))
        high = off[row + 1]
        found = []
        while len(live):
            done = self.ends[state] >= 0
            if done.any():
                found.append((live[done], self.ends[state[done]], at[done]))
            keep = self.open[state] & (at < high[live])
            live, state, at = live[keep], state[keep], at[keep]
            state = self.table[state, data[at]]
            keep = state >= 0
            live, state, at = live[keep], state[keep], at[keep] + 1
        if not found:
            return (np.zeros(0, np.int64),) * 4
        which, phrase, end = (np.concatenate(x) for x in zip(*found))
        begin, r = start[which], row[which]
        if bounded:
            low, high = off[r], off[r + 1]
            first = is_word(data, begin, low, high, False, plain) != is_word(data, begin, low, high, True, plain)
            last = is_word(data, end, low, high, False, plain) != is_word(data, end, low, high, True, plain)
            fine = (first | ~self.first_word[phrase]) & (last | ~self.last_word[phrase])
            begin, r, phrase, end = begin[fine], r[fine], phrase[fine], end[fine]
        order = np.lexsort((phrase, begin))
        return r[order], phrase[order].astype(np.int64), begin[order], end[order]


def apart(start: np.ndarray, end: np.ndarray, group: np.ndarray | None = None) -> np.ndarray:
    """Places of intervals, given in order of start, that are kept when one that starts before the last kept end is dropped."""
    if group is None and len(start) and (start[1:] >= end[:-1]).all():
        return np.arange(len(start))
    keep, reach = [], {}
    for i, (a, b, g) in enumerate(zip(start.tolist(), end.tolist(), [0] * len(start) if group is None else group.tolist())):
        if a >= reach.get(g, -1):
            keep.append(i)
            reach[g] = b
    return np.array(keep, np.int64)
