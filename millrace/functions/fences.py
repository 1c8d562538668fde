"""Code in markdown by its lines: a line that opens with three backticks or tildes begins a block, one like it ends it."""

from __future__ import annotations

import re

import numpy as np

_MARK = re.compile(rb"^[ \t]*(?:```|~~~)", re.M)
_NAME = re.compile(r"[\w+#.-]*")
_PAIRS = re.compile(rb"```[^`]*```|`[^`\n]+`")


def fences(text: bytes, bare_close: bool) -> list[tuple[int, int, int, int]]:
    """(opening line's start, first code byte, code's end, block's end); bare_close: a line with more than the mark ends no block.

    A block without an end runs to the text's end; a block's end is that of its closing line, without the line break."""
    out, opened = [], None
    for m in _MARK.finditer(text):
        stop = text.find(b"\n", m.end())
        stop = len(text) if stop < 0 else stop
        if opened is None:
            opened = m.start(), min(stop + 1, len(text)), stop < len(text)
        elif not bare_close or not text[m.end() : stop].strip(b" \t"):
            out.append((opened[0], opened[1], m.start(), stop))
            opened = None
    if opened is not None:
        out.append((opened[0], opened[1], len(text), len(text)))
    return out


def blocks(text: str) -> list[dict]:
    """{language, code, line} of each block; line: that of its first line of code."""
    raw, out, line, at = text.encode(), [], 1, 0
    for start, first, end, _ in fences(raw, bare_close=True):
        if raw[first - 1 : first] != b"\n":
            continue  # the text ends with the opening line
        info = raw[start:first].decode().strip(" \t\n")[3:].lstrip(" \t")
        line, at = line + raw.count(b"\n", at, first), first
        out.append({"language": _NAME.match(info)[0], "code": raw[first:end].decode(), "line": line})
    return out


def blank_code(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """The bytes with code blocks, then inline code, replaced by spaces; line breaks stay."""
    marked = np.unique(np.searchsorted(off, np.flatnonzero((data == 0x60) | (data == 0x7E)), "right") - 1)
    if not len(marked):
        return data
    out = data.copy()

    def blank(a: int, b: int) -> None:
        out[a:b][out[a:b] != 0x0A] = 0x20

    for r in marked.tolist():
        low = int(off[r])
        for start, _, _, end in fences(out[low : off[r + 1]].tobytes(), bare_close=False):
            blank(low + start, low + end)
        ticks = np.flatnonzero((out[low : off[r + 1]] == 0x60) | (out[low : off[r + 1]] == 0x0A))
        kinds, i = out[low + ticks] == 0x60, 0
        while i + 1 < len(ticks):  # a pair of backticks of one line with something between
            if kinds[i] and kinds[i + 1] and ticks[i + 1] > ticks[i] + 1:
                blank(low + ticks[i], low + ticks[i + 1] + 1)
                i += 2
            else:
                i += 1
    return out


def blank_pairs(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """The bytes with all from three backticks to three, or from one to one of its line, replaced by spaces; line breaks too."""
    marked = np.unique(np.searchsorted(off, np.flatnonzero(data == 0x60), "right") - 1)
    if not len(marked):
        return data
    out = data.copy()
    for r in marked.tolist():
        low = int(off[r])
        for m in _PAIRS.finditer(data[low : off[r + 1]].tobytes()):
            out[low + m.start() : low + m.end()] = 0x20
    return out
