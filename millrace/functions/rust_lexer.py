"""Tokens of Rust code. Only the lexer and the reading of single types and paths are here; what they mean is found by joins and windows.

Kinds: id (identifiers and keywords), life, lit (any literal, its text a double quote), p (punctuation), doc and inner (documentation of
what follows or encloses), note (other comments), end (one a block, last; its text is `error` where a literal or comment never ends).
"""

from __future__ import annotations

import re

import numpy as np

#: Punctuation of several characters that is one token; `>>` is two, so that types close one bracket at a time.
_SIMPLE = re.compile(r"""[ \t\r\n\f\v]+|(?P<note>//[^\n]*)|(?P<block>/\*)|(?P<raw>(?:[bc]?r)(?P<hash>\#*)")|(?P<text>[bc]?")|(?P<char>b?'(?:\\.[^'\n]*|[^'\\\n])')|(?P<life>'[^\W\d]\w*)
|(?P<id>(?:r\#)?[^\W\d]\w*)|(?P<num>\d(?:[\w]|\.(?=\d))*)|(?P<p>\.\.=|\.\.\.|\.\.|->|=>|::|==|!=|<=|&&|\|\||[^\w\s])|(?P<odd>.)""", re.X | re.S)  # fmt: skip
_TEXT_END = re.compile(r'(?:\\.|[^"\\])*"', re.S)
_BLOCK_EDGE = re.compile(r"/\*|\*/")


def _comment(text: str) -> str:
    if text.startswith(("//!", "/*!")):
        return "inner"
    if text.startswith("///") and not text.startswith("////") or text.startswith("/**") and not text.startswith(("/***", "/**/")):
        return "doc"
    return "note"


def tokens(code: str) -> tuple[list[int], list[str], list[str]]:
    """Lines (from 1), kinds and texts of the tokens, the `end` last."""
    at, places, kinds, texts, error = 0, [], [], [], False
    while at < len(code):
        m = _SIMPLE.match(code, at)
        kind, start, at = m.lastgroup, at, m.end()
        if kind is None:
            continue
        text = m[0]
        if kind == "hash":  # the innermost named group of a raw string's opening
            kind = "raw"
        if kind == "note":
            kind = _comment(text)
        elif kind == "block":
            depth = 1
            while depth and (edge := _BLOCK_EDGE.search(code, at)):
                depth, at = depth + (1 if edge[0] == "/*" else -1), edge.end()
            error = bool(depth)
            kind, text = _comment(code[start : start + 5]), ""
        elif kind == "raw":
            stop = code.find('"' + m["hash"], at)
            error, at = stop < 0, stop + 1 + len(m["hash"])
        elif kind == "text":
            close = _TEXT_END.match(code, at)
            error, at = close is None, close.end() if close else at
        elif kind == "odd":
            error = True
        if error:
            break
        if kind in ("raw", "text", "char", "num"):
            kind, text = "lit", '"'
        elif kind in ("doc", "inner", "note"):
            text = ""
        places.append(start)
        kinds.append(kind)
        texts.append(text.removeprefix("r#"))
    breaks = np.flatnonzero(np.frombuffer(code.encode("utf-32-le", "replace"), np.uint32) == 10)
    lines = (np.searchsorted(breaks, [*places, len(code)], "left") + 1).tolist()
    return lines, [*kinds, "end"], [*texts, "error" if error else ""]


def _segments(words: list[str]) -> tuple[list[str], list[list[str]]] | None:
    """Names of a path's segments and the generic arguments of its last one; None if words are no path."""
    names, args, i = [], [], 0
    words = words[1:] if words[:1] == ["::"] else words
    while i < len(words):
        if not (words[i][0].isalpha() or words[i][0] == "_"):
            return None
        names.append(words[i])
        args, i = [], i + 1
        if words[i : i + 2] == ["::", "<"]:
            i += 1
        if i < len(words) and words[i] == "<":
            depth, angle, part = 0, 0, []
            for j in range(i, len(words)):
                w = words[j]
                angle += (w == "<") - (w == ">")
                depth += (w in "([{") - (w in ")]}")
                if not angle:
                    break
                if j > i and w == "," and angle == 1 and not depth:
                    args.append(part)
                    part = []
                elif j > i:
                    part.append(w)
            args.append(part)
            i = j + 1
        if i < len(words) and words[i] != "::":
            return (names, args) if words[i] == "+" else None
        i += 1
    return (names, args) if names else None


def error_of_result(words: list[str]) -> tuple[str, str] | None:
    """(text, boxed or named; its name) of the error of a `Result` type, None if it is none: `Result<T>` names itself, `m::Result<T>` `m::Error`."""
    path = _segments(words)
    if not path or path[0][-1] != "Result":
        return None
    names, args = path
    args = [a for a in args if a and not a[0].startswith("'")]
    if len(args) == 2:
        return _classified(args[1])
    if len(args) != 1 or names[-2:-1] == ["fmt"]:
        return None
    return "named", f"{names[-2]}::Error" if len(names) > 1 else "Result"


def _classified(words: list[str]) -> tuple[str, str]:
    if words[0] == "&":
        rest = [w for w in words[1:] if not w.startswith("'") and w != "mut"]
        path = _segments(rest)
        name = path[0][-1] if path else "reference"
        return ("text", "&str") if name == "str" else ("named", name)
    path = _segments(words)
    if not path:
        return "named", "unnamed type"
    name = path[0][-1]
    if name == "Error" and len(path[0]) > 1:
        return "named", f"{path[0][-2]}::Error"
    return ("text", name) if name == "String" else ("boxed", name) if name == "Box" else ("named", name)


def implementation(words: list[str]) -> tuple[str, str] | None:
    """(trait, type) by last names of the head of an `impl … for …`."""
    angle, cut, start = 0, None, 0
    for i, w in enumerate(words):
        angle += (w == "<") - (w == ">")
        if not angle and w == ">" and not start and cut is None and words[0] == "<":
            start = i + 1
        elif not angle and w == "for" and words[i + 1 : i + 2] != ["<"]:
            cut = i
        elif not angle and w == "where":
            words = words[:i]
            break
    if cut is None:
        return None
    first = words[start:cut]
    of, to = _segments(first[1:] if first[:1] == ["!"] else first), _segments(words[cut + 1 :])
    return (of[0][-1], to[0][-1]) if of and to else None
