"""Markdown: cleaning, sections, fenced blocks and header comments.

What a regular expression or a fold over an array can say is a Column expression. Steps that look from line to line (joining
hard-wrapped lines, fences, cutting sections) are Arrow functions over whole columns; the first works on a table of all lines of a batch.
"""

from __future__ import annotations

import re
from functools import reduce
from itertools import groupby

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as Y

from . import automaton, fences, fixed
from .text import strip

_WHITE = "".join(map(chr, [*range(9, 14), 0x20])) + automaton.WIDE_WHITE
_FENCE = re.compile(f"[{_WHITE}]*(?:```|~~~)")
_REFERENCE = re.compile(fixed.REFERENCE_LINK.encode())
_NUMBERED = re.compile(r"\d+[.)]\s")
#: Bytes of text whose lines are looked at together.
_PART = 1 << 20


def lines(text: Column) -> Column:
    """The lines without their ends; an empty last line is none."""
    found = F.transform(F.split(text, "\n"), lambda x: F.regexp_replace(x, r"\r$", ""))
    return F.when(F.endswith(text, F.lit("\n")) | (text == ""), F.slice(found, 1, F.size(found) - 1)).otherwise(found)


def front_matter_title(text: Column) -> Column:
    """The first title of a leading `---` block, unquoted; null if there is none."""
    head = F.regexp_extract(text, r"(?dsm)\A---[^\S\n]*\n(.*?)(?:^---[^\S\n]*$|\z)", 1)
    title = F.regexp_replace(strip(F.regexp_extract(head, r"(?dm)^title:([^\n]*)$", 1)), "^[\"']+|[\"']+$", "")
    return F.when(title != "", title)


def strip_front_matter(text: Column) -> Column:
    """Without a leading `---` block; one that is not closed stays."""
    return F.regexp_replace(text, r"(?ds)\A---[^\S\n]*\n(?:|.*?\n)---[^\S\n]*(?:\n|\z)", "")


def strip_comments(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)<!--.*?-->", "")


def strip_anchors(text: Column) -> Column:
    """Headings without a closing `{#id}`."""
    return F.regexp_replace(text, "(?dU)" + fixed.HEADING_ANCHOR, "$1")


def strip_shortcodes(line: Column) -> Column:
    """A line with `{{...}}` blanked, to its end where unclosed, and without white space at its end."""

    def blank(part: Column) -> Column:
        close = F.instr(part, "}}")
        n = F.when(close > 0, close + 1).otherwise(F.length(part))
        return F.when(F.startswith(part, F.lit("{{")), F.concat(F.repeat(F.lit(" "), n), F.substring(part, n + 1, F.length(part)))).otherwise(part)

    parts = F.split(line, r"(?<!\{)(?=\{\{)")
    return F.regexp_replace(F.array_join(F.transform(parts, blank), ""), r"(?U)\s+\z", "")


def decode_entities(text: Column) -> Column:
    return reduce(lambda t, e: F.replace(t, F.lit(e[0]), F.lit(e[1])), fixed.ENTITIES, text)


def strip_html(line: Column) -> Column:
    """A line without tags of known elements; breaks and paragraph ends leave a space; entities are decoded."""
    name = lambda tag: F.lower(F.regexp_extract(tag, r"^</?([A-Za-z0-9]*)", 1))
    gap = lambda tag: F.startswith(tag, F.lit("<br")) | F.startswith(tag, F.lit("</p")) | (tag == "<p>")
    kept = F.transform(F.regexp_extract_all(line, F.lit("<[^>]*>"), F.lit(0)), lambda t: F.when(~name(t).isin(fixed.HTML_ELEMENTS), t).when(gap(t), " ").otherwise(""))
    between = F.split(line, "<[^>]*>")
    return decode_entities(F.array_join(F.zip_with(between, kept, lambda a, b: F.concat(a, F.coalesce(b, F.lit("")))), ""))


def is_blank(line: Column) -> Column:
    return strip(line) == ""


def collapse_blank_lines(text: Column) -> Column:
    """Of each run of blank lines, the first."""
    found = lines(text)
    before = F.concat(F.array(F.lit("-")), F.slice(found, F.lit(1), F.greatest(F.size(found) - 1, F.lit(0))))
    kept = F.filter(F.arrays_zip(found.alias("line"), before.alias("before")), lambda x: ~is_blank(x["line"]) | ~is_blank(x["before"]))
    return F.array_join(F.transform(F.slice(kept, F.lit(1), F.size(found)), lambda x: x["line"]), "\n")


def bound(value: Column, of) -> Column:
    """of(value), with value made once and not for each use."""
    return F.element_at(F.transform(F.array(value), of), 1)


def from_first(found: Column, stop) -> Column:
    """The lines from the first for which `stop` holds; none if it never does."""
    at = F.array_position(F.transform(found, stop), True)
    return F.when(at > 0, F.slice(found, F.greatest(at, F.lit(1)).cast("int"), F.size(found))).otherwise(F.array().cast("array<string>"))


def _first_after(flags: np.ndarray, at: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The first place from `at` on with a flag, `end` if there is none before it."""
    places = np.append(np.flatnonzero(flags), len(flags))
    return np.minimum(places[np.searchsorted(places, at)], end)


def _line_table(data: np.ndarray, off: np.ndarray) -> dict[str, np.ndarray]:
    """The lines of all rows: row, start, end, lead (its first ink), and classes fenced, definition, joins (to the kept line before)."""
    breaks = np.flatnonzero(data == 0x0A)
    start = np.union1d(off[:-1][off[:-1] < off[1:]], breaks + 1)
    start = start[(start < len(data)) & (len(data) > 0)]
    row = np.searchsorted(off, start, "right") - 1
    inside = start < off[row + 1]
    start, row = start[inside], row[inside]
    stop = _first_after(data == 0x0A, start, off[row + 1])
    end = stop - ((stop < off[row + 1]) & (stop > start) & (data[np.maximum(stop - 1, 0)] == 0x0D)).astype(np.int64)
    blanks = automaton.white(data)
    lead = _first_after(~blanks, start, end)
    byte = lambda k: np.where(lead + k < end, np.append(data, 0)[np.minimum(lead + k, len(data))], 0)
    head, second, third = byte(0), byte(1), byte(2)
    empty = lead >= end
    mark = np.isin(head, [0x60, 0x7E]) & (head == second) & (head == third)
    before = np.cumsum(mark) - mark
    first = np.concatenate([[True], row[1:] != row[:-1]]) if len(row) else np.zeros(0, bool)
    opened = before - np.repeat(before[first], np.diff(np.append(np.flatnonzero(first), len(row))))
    fenced = mark | (opened % 2 == 1)
    raw = data.tobytes()
    definition = np.zeros(len(row), bool)
    for i in np.flatnonzero(~fenced & (head == 0x5B)).tolist():  # [label]: something, indented by three at most
        close = raw.find(b"]", lead[i] + 1, end[i])
        definition[i] = close > lead[i] + 1 and raw[close + 1 : close + 2] == b":" and close + 2 < end[i] and not blanks[close + 2 : end[i]].all() and len(raw[start[i] : lead[i]].decode()) <= 3
    bullet = np.isin(head, [0x2D, 0x2A, 0x2B]) & (lead + 1 < end) & np.append(blanks, False)[np.minimum(lead + 1, len(data))]
    starts = np.isin(head, [0x23, 0x3E, 0x7C, 0x3C]) | bullet
    for i in np.flatnonzero(~starts & ~fenced & (((head >= 48) & (head < 58)) | (head >= 0x80))).tolist():
        starts[i] = bool(_NUMBERED.match(raw[lead[i] : end[i]].decode()))
    last = np.maximum.accumulate(np.where(~definition, np.arange(len(row)), -1))
    prior = np.concatenate([[-1], last[:-1]]) if len(row) else last
    some = prior >= 0
    some[some] = row[prior[some]] == row[some]
    takes = ~fenced & ~empty & ~np.isin(head, [0x23, 0x7C])
    joins = some & ~fenced & ~empty & ~starts & ~definition
    joins[joins] = takes[prior[joins]]
    return {"row": row, "start": start, "end": end, "lead": lead, "fenced": fenced, "definition": definition, "joins": joins}


def _whole(parts: list[bytes], is_code: list[bool]) -> str:
    joined = b"".join(parts)
    if b"][" in joined:
        runs = groupby(zip(parts, is_code), key=lambda x: x[1])
        joined = b"".join(piece if c else _REFERENCE.sub(rb"\1", piece) for c, piece in ((c, b"".join(p for p, _ in run)) for c, run in runs))
    return joined.decode()


def _tidied(data: np.ndarray, off: np.ndarray, valid: list[bool]) -> pa.Array:
    raw, t = data.tobytes(), _line_table(data, off)
    rows: list[list[bytes]] = [[] for _ in range(len(off) - 1)]
    code: list[list[bool]] = [[] for _ in range(len(off) - 1)]
    for row, start, end, lead, fenced, definition, joins in zip(*(x.tolist() for x in t.values())):
        if joins:
            rows[row] += [b" ", raw[lead:end]]
            code[row] += [False, False]
        elif not definition:
            rows[row] += [b"\n", raw[start:end]] if rows[row] else [raw[start:end]]
            code[row] += [fenced] * (len(rows[row]) - len(code[row]))
    return pa.array([_whole(p, c) if ok else None for p, c, ok in zip(rows, code, valid)], pa.string())


@F.arrow_udf(Y.StringType())
def tidy_prose(text: pa.Array) -> pa.Array:
    """Outside fences: link definitions go, reference links become their text, hard-wrapped lines are joined.

    The table of lines takes many times the bytes it is made of, so a batch is looked at in parts of whole texts."""
    (data, off), valid, out, lo = automaton.text_bytes(text), text.is_valid().to_pylist(), [], 0
    while lo < len(off) - 1:
        hi = max(lo + 1, int(np.searchsorted(off, off[lo] + _PART, "right")) - 1)
        out.append(_tidied(data[off[lo] : off[hi]], off[lo : hi + 1] - off[lo], valid[lo:hi]))
        lo = hi
    return pa.concat_arrays(out) if out else pa.array([], pa.string())


def clean(text: Column) -> Column:
    """The whole cleaning, in order: front matter, a title for texts without a heading, comments, anchors, shortcodes, HTML, tidying, blank lines."""
    body, title = strip_front_matter(text), front_matter_title(text)
    titled = F.when(title.isNotNull() & ~body.rlike(r"(?dm)^##? "), F.concat(F.lit("# "), title, F.lit("\n\n"), body)).otherwise(body)
    plain = F.transform(lines(strip_anchors(strip_comments(titled))), lambda x: strip_html(strip_shortcodes(x)))
    return collapse_blank_lines(tidy_prose(F.array_join(plain, "\n")))


def without_numbering(heading: Column) -> Column:
    return strip(F.regexp_replace(heading, r"^[0-9.:]+", ""))


def chapter_title(text: Column, origin: Column) -> Column:
    """The first level-one heading, else the first level-two heading, else the file's name."""
    stem = F.regexp_replace(F.element_at(F.split(origin, "/"), -1), r"(?<=.)\.[^.]*$", "")
    one, two = (F.regexp_extract_all(text, F.lit(rf"(?dm)^{mark} ([^\n]*)$"), F.lit(1)) for mark in ("#", "##"))
    return F.coalesce(*[without_numbering(F.get(x, F.lit(0))) for x in (one, two)], F.translate(stem, "-_", "  "))


def _cut(text: str, marks: tuple[str, ...], first: str) -> list[tuple[str, str]]:
    out, heading, body, fenced = [], first, [], False
    for line in [x.removesuffix("\r") for x in text.removesuffix("\n").split("\n")] if text else []:
        mark = next((m for m in marks if line.startswith(m)), None)
        if _FENCE.match(line):
            fenced = not fenced
        elif mark and not fenced:
            out.append((heading, "".join(body)))
            heading, body = re.sub(r"^[0-9.:]+", "", line[len(mark) :]).strip(_WHITE), []
            continue
        body.append(line + "\n")
    return [*out, (heading, "".join(body))]


@F.pandas_udf(Y.ArrayType(Y.StructType([Y.StructField("heading", Y.StringType()), Y.StructField("body", Y.StringType())])))
def sections(text: pd.Series, title: pd.Series) -> pd.Series:
    """Sections at level-one and level-two headings outside fences; over-long ones are cut again at level three; blank ones go."""

    def of(t: str | None, first: str | None) -> list[dict] | None:
        if t is None:
            return None
        whole = _cut(t, ("# ", "## "), first or "")
        fine = [p for h, b in whole for p in (_cut(b, ("### ",), h) if len(b.encode()) > fixed.MAX_SECTION_BYTES else [(h, b)])]
        return [{"heading": h, "body": body} for h, b in fine if (body := b.strip(_WHITE))]

    return pd.Series([of(t, c) for t, c in zip(text, title)], dtype=object)


def passage(chapter: Column, heading: Column, body: Column) -> Column:
    """A section that reads by itself."""
    return F.when(heading == chapter, F.concat(F.lit("# "), chapter, F.lit("\n\n"), body)).otherwise(F.concat(F.lit("# "), chapter, F.lit("\n\n## "), heading, F.lit("\n\n"), body))


def header_comment(source: Column, marker: str) -> Column:
    """The comment lines that open a source file, without their markers; null if it does not open with a comment."""
    found = from_first(F.transform(lines(source), strip), lambda x: (x != "") & ~F.startswith(x, F.lit("#!")))
    ends = F.array_position(F.transform(found, lambda x: F.startswith(x, F.lit(marker))), False)
    block = F.when(ends > 0, F.slice(found, F.lit(1), F.greatest(ends - 1, F.lit(0)).cast("int"))).otherwise(found)
    comment = strip(F.array_join(F.transform(block, lambda x: strip(F.substring(x, len(marker) + 1, 1 << 30))), "\n"))
    return F.when(comment != "", comment)


def extension(path: Column) -> Column:
    return F.regexp_extract(path, r"[^/]\.([^./]+)$", 1)


def code_example(source: Column, path: Column) -> Column:
    """{instruction, response} of a source file that opens with a comment, by its extension; else null."""
    cases = [(ext, F.struct(F.concat(F.lit(f"Write a {name} program for this:\n\n"), header_comment(source, mark)).alias("instruction"), F.concat(F.lit(f"```{tag}\n"), F.regexp_replace(source, r"(?U)\s+\z", ""), F.lit("\n```")).alias("response"))) for ext, (name, tag, mark) in fixed.LANGUAGES.items()]
    found = F.coalesce(*[F.when(extension(path) == ext, made) for ext, made in cases])
    return F.when(found["instruction"].isNotNull(), found)


def path_kind(path: Column) -> Column:
    """What a file of a book repository is: chapter, notes, code or ignored."""
    name = F.element_at(F.split(path, "/"), -1)
    hidden = F.exists(F.split(path, "/"), lambda x: F.startswith(x, F.lit(".")) | x.isin(fixed.IGNORED_FOLDERS))
    kind = F.when(extension(name) == "md", F.when(name.isin(fixed.NOTES_FILES), "notes").otherwise("chapter"))
    return F.when(hidden, "ignored").otherwise(F.coalesce(kind, F.when(extension(name).isin(list(fixed.LANGUAGES)), "code"), F.lit("ignored")))


_BLOCKS = Y.ArrayType(Y.StructType([Y.StructField("language", Y.StringType()), Y.StructField("code", Y.StringType()), Y.StructField("line", Y.IntegerType())]))


@F.arrow_udf(_BLOCKS)
def fenced_blocks(text: pa.Array) -> pa.Array:
    """{language, code, line} of each fenced block, backtick or tilde; an unclosed one runs to the end. line: that of its first code line."""
    kind = pa.list_(pa.struct([("language", pa.string()), ("code", pa.string()), ("line", pa.int32())]))
    marked = pc.or_(pc.match_substring(text, "```"), pc.match_substring(text, "~~~")).to_pylist()
    return pa.array([None if m is None else fences.blocks(t) if m else [] for t, m in zip((text[i].as_py() if m else None for i, m in enumerate(marked)), marked)], kind)


def rust_blocks(text: Column) -> Column:
    """The blocks that are marked as Rust, or are unmarked and read like it."""
    words = r"\b(?:" + "|".join(fixed.RUST_WORDS) + r")\b"
    return F.filter(fenced_blocks(text), lambda b: b["language"].isin("rust", "rs") | ((b["language"] == "") & b["code"].rlike(words)))
