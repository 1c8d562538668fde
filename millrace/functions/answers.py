"""Answers: stock phrases with their places, and claims about the code, over whole Arrow batches of texts.

Places are bytes and hits must not overlap. Phrases are found by one automaton; of the rhythm tricks three begin with words that an
automaton finds as well, the fourth (three sentences of one word) is followed from dot to dot. Only rows in which such words stand are
looked at by a pattern. A null text is an empty one.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as Y

from . import automaton, fixed
from .automaton import Automaton
from .fences import blank_code, blank_pairs

CATEGORIES = [*fixed.SLOP_PHRASES, "rhythm_trick"]
RULES = ["no_unwrap", "error_enum", "pub_docs", "no_body_comments", "no_index_loops"]
_PHRASES = Automaton([p for of in fixed.SLOP_PHRASES.values() for p in of])
_CATEGORY = np.array([k for k, of in enumerate(fixed.SLOP_PHRASES.values()) for _ in of])
_WHITE = "[" + "".join(map(chr, [*range(9, 14), 0x20])) + automaton.WIDE_WHITE + "]"
_SENTENCES = 2  # of RHYTHM_PATTERNS, the one that no word begins
#: By `plain`: with words and white space of all scripts, or of ASCII as the patterns say in SQL (RE2); case is folded alike, so that a
#: long s is of a word there, but no edge of one.
_RHYTHM = {
    False: [re.compile(p.replace(r"\s", _WHITE)) for p in fixed.RHYTHM_PATTERNS],
    True: [re.compile(p.replace(r"\s", r"[\t\n\f\r ]").replace(r"\w", "[0-9A-Z_a-z]").replace(r"\b", r"(?a:\b)")) for p in fixed.RHYTHM_PATTERNS],
}
_OPENINGS = Automaton(["not because", "it's", "it is", "this is", "that's", "no "])
_OPENINGS.last_word[:] = False  # what follows is for the pattern to tell
_OPENS = np.array([0, 1, 1, 1, 1, 3])  # the pattern that each may begin
_CLAIMS = [(rule, re.compile(p.replace(r"\s", _WHITE), re.I)) for rule, p in fixed.CLAIMS]
#: In every claim stands one of these.
_CLAIM_WORDS = Automaton(["unwrap", "expect", "custom error enum", "pub", "no comments", "no index", "adher", "compl", "conform", "follow", "satisfies", "meets"])
#: Bytes of text that are looked at together.
_PART = 4 << 20


class _Row:
    """One row's prose as characters, with the byte at which each begins."""

    def __init__(self, data: np.ndarray, plain: bool):
        self.text = data.tobytes().decode("utf-8", "replace")
        if plain:  # letters that Python, but not SQL, takes for an i where case is ignored; to the patterns they are like any other beyond ASCII
            self.text = self.text.replace("\u0130", "\u00e9").replace("\u0131", "\u00e9")
        self.at = np.append(np.flatnonzero((data & 0xC0) != 0x80), len(data))

    def char(self, byte: int) -> int:
        return int(np.searchsorted(self.at, byte))


def _one_word_sentences(data: np.ndarray, off: np.ndarray, plain: bool) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of three sentences in a row that are one capitalised ASCII word each."""
    none = np.zeros(0, np.int64)
    if len(data) < 2:
        return none, none
    low = (data >= 97) & (data <= 122)
    begin = np.flatnonzero((data[:-1] >= 65) & (data[:-1] <= 90) & low[1:])
    stops = np.append(np.flatnonzero(~low), len(data))
    dot = stops[np.searchsorted(stops, begin + 1)]
    row_end = off[np.searchsorted(off, begin, "right")]
    fine = dot < row_end
    fine[fine] = data[dot[fine]] == 0x2E
    begin, dot, row_end = begin[fine], dot[fine], row_end[fine]
    ink = np.append(np.flatnonzero(~automaton.white(data, plain)), len(data))
    after = ink[np.searchsorted(ink, dot + 1)]
    follows = np.searchsorted(begin, after)
    chained = (after > dot + 1) & (after < row_end) & (follows < len(begin))
    chained[chained] = begin[follows[chained]] == after[chained]
    one = np.flatnonzero(chained)
    one = one[chained[follows[one]]]
    one = one[~automaton.is_word(data, begin[one], off[np.searchsorted(off, begin[one], "right") - 1], row_end[one], False, plain)]
    return begin[one], dot[follows[follows[one]]] + 1


def _openings(data: np.ndarray, off: np.ndarray, rows: dict[int, _Row], plain: bool):
    """(pattern, start, end) of the rhythm tricks that begin with given words."""
    row, which, start, end = _OPENINGS.find(data, off, plain=plain)
    found = {}
    for r, p, a in zip(row.tolist(), _OPENS[which].tolist(), start.tolist()):
        x = rows.get(r)
        if x is None:
            x = rows[r] = _Row(data[off[r] : off[r + 1]], plain)
        m = _RHYTHM[plain][p].match(x.text, x.char(a - int(off[r])))
        if m:
            found[p, a] = int(off[r]) + int(x.at[m.end()])
    keys = sorted(found, key=lambda k: k[1])
    return np.array([k[0] for k in keys], np.int64), np.array([k[1] for k in keys], np.int64), np.array([found[k] for k in keys], np.int64)


def _found(prose: np.ndarray, off: np.ndarray, plain: bool) -> tuple:
    """Of rows of bytes without code: hits (row, category, start, end), em dashes, words, claims (row, place in CLAIMS, start, end).

    plain: hits of one pattern may overlap those of another."""
    rows: dict[int, _Row] = {}
    _, phrase, start, end = _PHRASES.find(prose, off, plain=plain)
    group, parts = _CATEGORY[phrase], []
    keep = automaton.apart(start, end, group)  # each category by itself, as each pattern by itself, then all of them
    parts.append((group[keep], start[keep], end[keep]))
    pattern, start, end = _openings(prose, off, rows, plain)
    keep = automaton.apart(start, end, pattern)
    parts.append((np.full(len(keep), len(CATEGORIES) - 1), start[keep], end[keep]))
    start, end = _one_word_sentences(prose, off, plain)
    keep = automaton.apart(start, end)
    parts.append((np.full(len(keep), len(CATEGORIES) - 1), start[keep], end[keep]))
    category, start, end = (np.concatenate(x) for x in zip(*parts))
    order = np.lexsort((category, start))
    if not plain:
        order = order[automaton.apart(start[order], end[order])]
    category, start, end = category[order], start[order], end[order]
    inside = lambda at: np.searchsorted(off, at, "right") - 1

    dashes = np.flatnonzero(prose == 0xE2)
    dashes = dashes[dashes + 2 < len(prose)]
    dashes = dashes[(prose[dashes + 1] == 0x80) & (prose[dashes + 2] == 0x94)]
    ink = ~automaton.white(prose, plain)
    first = ink.copy()
    first[1:] &= ~ink[:-1]
    heads = off[:-1][off[:-1] < off[1:]]
    first[heads] = ink[heads]
    n = len(off) - 1
    claims = []
    for r in np.unique(_CLAIM_WORDS.find(prose, off, bounded=False)[0]).tolist():
        x = rows.get(r) or _Row(prose[off[r] : off[r + 1]], plain)
        claims += sorted((r, int(x.at[m.start()]), k, int(x.at[m.end()])) for k, (_, p) in enumerate(_CLAIMS) for m in p.finditer(x.text))
    return (inside(start), category, start, end), np.bincount(inside(dashes), minlength=n), np.bincount(inside(np.flatnonzero(first)), minlength=n), claims


def _struct(**fields) -> Y.StructType:
    return Y.StructType([Y.StructField(n, t) for n, t in fields.items()])


_HIT = _struct(category=Y.StringType(), text=Y.StringType(), start=Y.IntegerType(), end=Y.IntegerType())
_CLAIM = _struct(text=Y.StringType(), start=Y.IntegerType(), rule=Y.StringType())
_FACTS = _struct(hits=Y.ArrayType(_HIT), em_dashes=Y.IntegerType(), words=Y.IntegerType(), claims=Y.ArrayType(_CLAIM))


def _texts(data: np.ndarray, start, end) -> pa.Array:
    return pa.array([bytes(data[a:b]).decode("utf-8", "replace") for a, b in zip(start, end)], pa.string())


def _lists(n: int, row, fields: dict[str, pa.Array]) -> pa.Array:
    ends = np.concatenate([[0], np.cumsum(np.bincount(np.asarray(row, np.int64), minlength=n))]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.StructArray.from_arrays(list(fields.values()), list(fields)))


def facts_of(column: pa.Array, plain: bool = False) -> pa.StructArray:
    """The facts of every row of a column of texts; plain: as the patterns say in SQL, with words and white space of ASCII, code from
    backticks to backticks, and hits as they stand once code is blank, those of one pattern over those of another."""
    data, off = automaton.text_bytes(column)
    parts, lo = [], 0
    while lo < len(off) - 1:
        hi = max(lo + 1, int(np.searchsorted(off, off[lo] + _PART, "right")) - 1)
        part, at = data[off[lo] : off[hi]], off[lo : hi + 1] - off[lo]
        prose = blank_pairs(part, at) if plain else blank_code(part, at)
        (row, category, start, end), dashes, words, claims = _found(prose, at, plain)
        r, c, rule, e = zip(*claims) if claims else ((), (), (), ())
        hits = {
            "category": pa.array([CATEGORIES[k] for k in category], pa.string()), "text": _texts(prose if plain else part, start, end),
            "start": pa.array((start - at[row]).astype(np.int32)), "end": pa.array((end - at[row]).astype(np.int32)),
        }
        base = [int(at[x]) for x in r]
        said = {"text": _texts(part, [a + b for a, b in zip(base, c)], [a + b for a, b in zip(base, e)]), "start": pa.array(c, pa.int32()), "rule": pa.array([fixed.CLAIMS[k][0] for k in rule], pa.string())}
        n = hi - lo
        parts.append(pa.StructArray.from_arrays([_lists(n, row, hits), pa.array(dashes.astype(np.int32)), pa.array(words.astype(np.int32)), _lists(n, r, said)], ["hits", "em_dashes", "words", "claims"]))
        lo = hi
    return pa.concat_arrays(parts) if parts else pa.array([], pa.struct([("hits", pa.list_(pa.struct([("category", pa.string()), ("text", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))), ("em_dashes", pa.int32()), ("words", pa.int32()), ("claims", pa.list_(pa.struct([("text", pa.string()), ("start", pa.int32()), ("rule", pa.string())])))]))


@F.arrow_udf(_FACTS)
def slop_check(text: pa.Array) -> pa.Array:
    """Hits in text order without overlaps, em dashes, words and claims of the prose; code does not count."""
    return facts_of(text)


@F.arrow_udf(Y.ArrayType(_HIT))
def hits_plain(text: pa.Array) -> pa.Array:
    """Hits of each pattern by itself, with words, their edges, white space and code as SQL (RE2) reads the patterns."""
    return facts_of(text, plain=True).field("hits")


@F.arrow_udf(Y.ArrayType(_HIT))
def hits_apart(hits: pa.Array) -> pa.Array:
    """Of each list of hits those that do not overlap: in order of start, then of category, each from the end of the last one kept."""
    flat, row = pc.list_flatten(hits), pc.list_parent_indices(hits).to_numpy()
    start, end = (flat.field(f).to_numpy().astype(np.int64) for f in ("start", "end"))
    order = np.lexsort((pc.index_in(flat.field("category"), pa.array(CATEGORIES)).to_numpy(), start, row))
    order = order[automaton.apart(start[order], end[order], row[order])]
    kept = flat.take(pa.array(order))
    return _lists(len(hits), row[order], dict(zip(("category", "text", "start", "end"), kept.flatten())))


def slop_of(text: str) -> dict:
    """The facts of one text."""
    return facts_of(pa.array([text], pa.string()))[0].as_py()


def slop_score(found: Column) -> Column:
    return F.size(found["hits"]) + (found["em_dashes"] >= fixed.EM_DASH_LIMIT).cast("int")


def false_claims(claims: Column, rules: Column) -> Column:
    """Claims that the verdicts (a map by rule) contradict: of a rule that fails, or of all rules when any fails."""
    any_fails = F.exists(F.map_values(rules), lambda v: v == "fail")
    return F.filter(claims, lambda c: F.coalesce(F.when(c["rule"].isNull(), any_fails).otherwise(rules[c["rule"]] == "fail"), F.lit(False)))
