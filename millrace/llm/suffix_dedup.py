"""Suffix-array removal of passages that repeat across documents (operator 9).

Every byte is removed that a SPAN-byte string covers which also starts in a document with a smaller doc_id.

1. Documents with the same bytes are found by SHA-256: all but the smallest doc_id are covered whole. The rest goes on.
2. Anchors: every SPAN-byte string has one, the first of its GRAM-byte strings with the smallest hash. Equal strings have equal
   anchors, and reach SIDE bytes beyond them on one side at least. So only anchors that another document has with the same bytes
   beside it matter.
3. Neighbouring starts with the same anchor make a stretch; each start belongs to one stretch. The stretches of such anchors are
   dealt out, by anchor, into shards; equal ones are first merged within a task under their smallest doc_id.
4. Each shard merges equal stretches again, then builds the suffix array of the different ones (Larsson-Sadakane refinement of
   groups, in numpy) and common prefixes of neighbours (Kasai, one lane a stretch); runs of neighbours that share SPAN bytes are
   equal strings. An anchor with many stretches is dealt over several shards: each hands on its sorted distinct strings,
   divided into as many ranges of a hash; a range of all shards is merged by binary search of one shard's strings in another's,
   and each shard is told which of its strings a smaller doc_id has elsewhere.
5. The spans found for a document are merged, and the rest of its bytes is kept.

Defined cases: a null text has no bytes; texts under SPAN bytes are kept whole; repeated rows with equal doc_ids remove nothing
from each other and are returned each; so are rows that repeat a doc_id with other texts, each with its own spans; rows with a
null doc_id are kept whole and take no part; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import bytesops as B
from .scratch import keys_join, pieces, release, sized_join, stored

SPAN = 50
GRAM = 20
#: Bytes beside an anchor that a repeated string must share on one side or the other.
SIDE = (SPAN - GRAM) // 2
#: Stretches of one anchor that a shard takes; an anchor with more is dealt over several shards.
ANCHOR_ROWS = 4_096
BUCKET_BYTES = 12 << 20
#: Shards of stretches for each bucket: a suffix array takes many times the bytes it orders.
SHARDS = 4
HELD_BYTES = 10 << 20
#: Text bytes whose stretches a task holds before it hands them on.
STRETCH_BYTES = 5 << 20


def gram_hashes(data: np.ndarray, width: int = GRAM) -> np.ndarray:
    """Hash of the bytes [i, i + width) for every i; rows are not kept apart."""
    if len(data) < width:
        return np.zeros(0, np.uint64)
    c = B.prefix_sums(data)
    return B.mix((c[width:] - c[:-width]) * B.powers(B.UNSTEP, len(data))[: len(data) - width + 1])


def window_minima(h: np.ndarray, width: int) -> np.ndarray:
    reach = 1
    while reach * 2 <= width:
        h = np.minimum(h[:-reach], h[reach:])
        reach *= 2
    return np.minimum(h[: len(h) - (width - reach)], h[width - reach :]) if width > reach else h


def anchor_places(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of all anchors, ascending, their gram hashes and rows."""
    if len(data) < SPAN:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64)
    h, width = gram_hashes(data), SPAN - GRAM + 1
    least = window_minima(h, width)
    inside = np.zeros(len(least) + 1, np.int64)
    long = np.diff(off) >= SPAN
    inside[off[:-1][long]] += 1
    inside[off[1:][long] - SPAN + 1] -= 1
    least = np.where(np.cumsum(inside[:-1]) > 0, least, B.U(0))
    edge = np.zeros(width - 1, np.uint64)
    most = ~window_minima(~np.concatenate([edge, least, edge]), width)
    at = np.flatnonzero(most == h)
    row = np.searchsorted(off, at, "right") - 1
    whole = at + GRAM <= off[row + 1]
    return at[whole], h[at[whole]], row[whole]


def anchors(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct anchors of each row with 16-bit hashes of the SIDE bytes before and after them (0: fewer bytes there), and the
    row of each. A repeated string reaches SIDE bytes beyond its anchor on one side at least."""
    at, h, row = anchor_places(data, off)
    c, sides = B.prefix_sums(data), []
    for start, fits in ((at - SIDE, at - SIDE >= off[row]), (at + GRAM, at + GRAM + SIDE <= off[row + 1])):
        start = np.where(fits, start, 0)
        sides.append(np.where(fits, B.span_hash(c, start, np.minimum(start + SIDE, len(data))) % B.U(65535) + B.U(1), B.U(0)).astype(np.uint16))
    h = B.mix(h)  # minima crowd at the small end; mixed again, they spread over all buckets
    order = np.lexsort((sides[1], sides[0], h, row))
    h, left, right, row = h[order], sides[0][order], sides[1][order], row[order]
    fresh = np.ones(len(h), bool)
    fresh[1:] = (h[1:] != h[:-1]) | (left[1:] != left[:-1]) | (right[1:] != right[:-1]) | (row[1:] != row[:-1])
    return h[fresh], left[fresh], right[fresh], row[fresh]


def stretches(at: np.ndarray, h: np.ndarray, row: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last start (last < first: none) of the SPAN-byte strings that each anchor is the anchor of."""
    reach = SPAN - GRAM
    first, last = np.maximum(off[row], at - reach), np.minimum(at, off[row + 1] - SPAN)
    for back in (True, False):
        left = np.arange(len(at))
        for k in range(1, reach + 1):  # the nearest anchor before that is no larger, and after that is smaller
            other = left - k if back else left + k
            left, other = left[(other >= 0) & (other < len(at))], other[(other >= 0) & (other < len(at))]
            near = (np.abs(at[other] - at[left]) <= reach) & (row[other] == row[left])
            left, other = left[near], other[near]
            stop = h[other] <= h[left] if back else h[other] < h[left]
            i, j = left[stop], other[stop]
            if back:
                first[i] = np.maximum(first[i], at[j] + 1)
            else:
                last[i] = np.minimum(last[i], at[j] - reach - 1)
            left = left[~stop]
            if not len(left):
                break
    return first, last


def with_another(h: np.ndarray, side: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Marks entries whose hash and side another document has too."""
    order = np.lexsort((doc, side, h))
    a, s, d = h[order], side[order], doc[order]
    fresh = np.ones(len(a), bool)
    fresh[1:] = (a[1:] != a[:-1]) | (s[1:] != s[:-1])
    at = np.flatnonzero(fresh)
    out = np.zeros(len(h), bool)
    if len(at):
        sizes = np.diff(np.append(at, len(a)))
        out[order] = np.repeat((d[at] != d[at + sizes - 1]) & (s[at] > 0), sizes)
    return out


def shared_anchors(docs: DataFrame, buckets: int) -> DataFrame:
    """(doc_id, anchors, many): of each document, the packed anchors that another one has too, ascending, and how many have each."""

    def emit(batches):
        held, size = [], 0

        def flush():
            h, left, right, doc = (np.concatenate(x) for x in zip(*held))
            order = np.argsort(h, kind="stable")
            h, left, right, doc = h[order], left[order], right[order], doc[order]
            base = int(doc.min()) if len(doc) else 0
            doc = doc - base
            doc = doc.astype(np.uint32) if len(doc) and doc.max() < 1 << 32 else doc
            b, cut = B.by_bucket(h, buckets)
            return pa.record_batch({"bucket": pa.array(b), "base": pa.array(np.full(len(b), base)), "wide": pa.array(np.full(len(b), doc.itemsize == 8)), **{k: B.blobs([x[i:j] for i, j in zip(cut, cut[1:])]) for k, x in (("h", h), ("before", left), ("after", right), ("doc", doc))}})

        for b in B.slices(batches):
            h, left, right, row = anchors(*B.raw(b.column("text")))
            held.append((h, left, right, b.column("doc_id").to_numpy()[row]))
            size += b.column("text").nbytes
            if size > HELD_BYTES:
                yield flush()
                held, size = [], 0
        if held:
            yield flush()

    def meet(table: pa.Table) -> pa.Table:
        h = B.joined(table.column("h"), np.uint64)
        rows = zip(table.column("doc").to_pylist(), table.column("wide").to_pylist(), table.column("base").to_pylist())
        doc = np.concatenate([np.frombuffer(d, np.int64 if wide else np.uint32).astype(np.int64) + base for d, wide, base in rows])
        left, right = B.joined(table.column("before"), np.uint16), B.joined(table.column("after"), np.uint16)
        keep = with_another(h, left, doc) | with_another(h, right, doc)
        h, doc = h[keep], doc[keep]
        order = np.lexsort((doc, h))
        h, doc = h[order], doc[order]
        fresh = np.ones(len(h), bool)
        fresh[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
        h, doc = h[fresh], doc[fresh]
        run = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]])) if len(h) else np.zeros(0, np.int64)
        many = np.repeat(np.diff(np.append(run, len(h))), np.diff(np.append(run, len(h))))
        order = np.lexsort((doc, B.mix(doc.view(np.uint64))))
        h, doc, many = h[order], doc[order], many[order].astype(np.int32)
        at = np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1]])) if len(doc) else np.zeros(0, np.int64)
        ends = np.append(at, len(doc))
        b, cut = B.by_bucket(B.mix(doc[at].view(np.uint64)), buckets)
        parts = list(zip(cut, cut[1:]))
        B.give_back()
        return pa.table({"bucket": pa.array(b), "docs": B.blobs([np.repeat(doc[at[i:j]], np.diff(ends[i : j + 1])) for i, j in parts]), "anchors": B.blobs([h[ends[i] : ends[j]] for i, j in parts]), "many": B.blobs([many[ends[i] : ends[j]] for i, j in parts])})

    def gather(table: pa.Table) -> pa.Table:
        doc, h, many = (B.joined(table.column(n), t) for n, t in (("docs", np.int64), ("anchors", np.uint64), ("many", np.int32)))
        order = np.lexsort((h, doc))
        doc, h, many = doc[order], h[order], many[order]
        at = np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1]])) if len(doc) else np.zeros(0, np.int64)
        ends = np.append(at[1:], len(doc)) if len(doc) else at
        B.give_back()
        return pa.table({"doc_id": pa.array(doc[at]), "anchors": B.blobs([h[i:j] for i, j in zip(at, ends)]), "many": B.blobs([many[i:j] for i, j in zip(at, ends)])})

    rows = docs.select("doc_id", "text").mapInArrow(emit, "bucket long, base long, wide boolean, h binary, before binary, after binary, doc binary")
    met = rows.repartition(buckets, "bucket").groupBy("bucket").applyInArrow(meet, "bucket long, docs binary, anchors binary, many binary")
    return met.groupBy("bucket").applyInArrow(gather, "doc_id long, anchors binary, many binary")


def suffix_array(text: np.ndarray, end: np.ndarray, depth: int) -> np.ndarray:
    """Order of all suffixes by their first `depth` bytes, then by place; a suffix stops at `end` of its row, ends sort first.

    Larsson-Sadakane: suffixes start in groups of equal beginnings (seven bytes); each round sorts only groups of more than one
    by the group of the suffix that follows the known prefix, which doubles the prefix."""
    n = len(text)
    codes = np.zeros(n + 7, np.uint64)
    codes[:n] = text.astype(np.uint64) + B.U(1)
    left = end - np.arange(n)
    key = np.zeros(n, np.uint64)
    for j in range(7):
        key = key << B.U(9) | np.where(left > j, codes[j : n + j], B.U(0))
    order = np.argsort(key, kind="stable")
    group = np.zeros(n, np.int64)

    def regroup(at, keys):
        """Number groups by the place of their first member; at: places in order, ascending."""
        fresh = np.ones(len(at), bool)
        fresh[1:] = keys[1:] != keys[:-1]
        first = at[np.maximum.accumulate(np.where(fresh, np.arange(len(at)), 0))]
        group[order[at]] = first
        single = fresh & np.append(fresh[1:], True)
        return at[~single]

    open_ = regroup(np.arange(n), key[order])
    known = 7
    while known < depth and len(open_):
        members = order[open_]
        after = np.where(left[members] > known, group[np.minimum(members + known, n - 1)] + 1, 0)
        key = group[members] << 32 | after  # a shard has far fewer than 2**31 bytes
        way = np.argsort(key, kind="stable")
        order[open_] = members[way]
        open_ = regroup(open_, key[way])
        known *= 2
    return order


def common_prefixes(text: np.ndarray, end: np.ndarray, order: np.ndarray, lane: np.ndarray, depth: int) -> np.ndarray:
    """Bytes, up to `depth`, that each suffix in order shares with the one before it.

    Kasai: going to the next suffix of a row loses one shared byte at most. lane: starts of the rows, which go side by side."""
    n = len(text)
    before = np.full(n, -1, np.int64)
    before[order[1:]] = order[:-1]
    shared = np.zeros(n, np.int64)
    at, h = lane.copy(), np.zeros(len(lane), np.int64)
    while len(at):
        other = before[at]
        h[other < 0] = 0
        grow = np.flatnonzero(other >= 0)
        while len(grow):
            i, j = at[grow] + h[grow], other[grow] + h[grow]
            fits = (h[grow] < depth) & (i < end[at[grow]]) & (j < end[other[grow]])
            grow, i, j = grow[fits], i[fits], j[fits]
            grow = grow[text[i] == text[j]]
            h[grow] += 1
        shared[at] = h
        on = at + 1 < end[at]
        at, h = at[on] + 1, np.maximum(0, h[on] - 1)
    return shared[order]


def equal_strings(parts: list[bytes], depth: int = SPAN) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of all strings of `depth` bytes in parts, in sorted order: the part, the start in it, and the number of its class."""
    text = np.frombuffer(b"".join(parts), np.uint8)
    sizes = np.array([len(p) for p in parts], np.int64)
    ends = np.cumsum(sizes)
    lane = (ends - sizes)[sizes > 0]
    end = np.repeat(ends, sizes)
    order = suffix_array(text, end, int(sizes.max(initial=0)))  # to the end of rows, as common_prefixes relies on
    shared = common_prefixes(text, end, order, lane, depth)
    whole = end[order] - order >= depth
    number = np.cumsum(shared < depth)[whole]
    at = order[whole]
    part = np.repeat(np.arange(len(parts)), sizes)[at]
    return part, at - (ends - sizes)[part], number


STRETCHES = "bucket long, anchor long, salt int, ways int, docs binary, sizes binary, content binary, counts binary, places binary, gone boolean"


def stretch_rows(candidates: DataFrame, buckets: int, anchor_rows: int = ANCHOR_ROWS) -> DataFrame:
    """Packed stretches of the shared anchors of rows (doc_id, which, text, anchors, many): different ones (docs, sizes, content; counts
    and places: where each starts), a row for each shard that has some. A place is which << 32 plus the start in the text.

    Rows with gone are of documents that repeat a smaller doc_id's stretches: all their strings go."""

    def emit(batches):
        held, size = [], 0

        def flush():
            anchor, ways, check, doc, place, length, content = (np.concatenate(x) for x in zip(*held))
            begin = np.cumsum(length) - length
            order = np.lexsort((place, doc, check, anchor))
            anchor, ways, check, doc, place, length, begin = (x[order] for x in (anchor, ways, check, doc, place, length, begin))
            fresh = np.ones(len(anchor), bool)
            fresh[1:] = (anchor[1:] != anchor[:-1]) | (check[1:] != check[:-1])
            least = doc[np.maximum.accumulate(np.where(fresh, np.arange(len(doc)), 0))]
            bucket = (anchor >> B.U(32)).astype(np.int64) * buckets >> 32
            hot = ways > 1
            salt = np.where(hot, least % ways, 0)
            hot_anchor = np.where(hot, anchor.view(np.int64), 0)
            for gone in (False, True):
                k = np.flatnonzero((doc != least) == gone)
                k = k[np.lexsort((k, salt[k], hot_anchor[k], bucket[k]))]
                if not len(k):
                    continue
                new = np.ones(len(k), bool)
                new[1:] = (bucket[k][1:] != bucket[k][:-1]) | (hot_anchor[k][1:] != hot_anchor[k][:-1]) | (salt[k][1:] != salt[k][:-1])
                rows = np.flatnonzero(new)
                one = fresh[k] | gone
                one[rows] = True
                first = np.flatnonzero(one)
                counts = np.diff(np.append(first, len(k)))
                cut, ends = np.searchsorted(first, np.append(rows, len(k))), np.append(rows, len(k))
                out = {n: [] for n in ("docs", "sizes", "content", "counts", "places")}
                for i, j, a, b in zip(cut, cut[1:], ends, ends[1:]):
                    x = k[first[i:j]]
                    out["docs"].append(doc[x])
                    out["sizes"].append(length[x].astype(np.uint8))
                    out["content"].append(np.zeros(0, np.uint8) if gone else content[B.ranges(begin[x], length[x])])
                    out["counts"].append(counts[i:j].astype(np.int32))
                    out["places"].append(place[k[a:b]])
                x = k[rows]
                yield pa.record_batch({
                    "bucket": pa.array(bucket[x]), "anchor": pa.array(hot_anchor[x]), "salt": pa.array(salt[x].astype(np.int32)), "ways": pa.array(ways[x].astype(np.int32)),
                    **{n: B.blobs(v) for n, v in out.items()}, "gone": pa.array(np.full(len(x), gone)),
                })

        for b in B.slices(batches):
            data, off = B.raw(b.column("text"))
            at, h, row = anchor_places(data, off)
            first, last = stretches(at, h, row, off)
            h, ways = B.mix(h), np.zeros(len(at), np.int64)
            edges = np.searchsorted(row, np.arange(b.num_rows + 1))
            for k, (known, many) in enumerate(zip(b.column("anchors").to_pylist(), b.column("many").to_pylist())):
                i, j = edges[k], edges[k + 1]
                known, many = np.frombuffer(known, np.uint64), np.frombuffer(many, np.int32)
                spot = np.minimum(np.searchsorted(known, h[i:j]), len(known) - 1)
                ways[i:j] = np.where(known[spot] == h[i:j], -(-many[spot] // anchor_rows), 0)
            use = np.flatnonzero((ways > 0) & (last >= first))
            row, first, stop = row[use], first[use], last[use] + SPAN
            held.append((
                h[use], ways[use], B.span_hash(B.prefix_sums(data), first, stop), b.column("doc_id").to_numpy()[row],
                (b.column("which").to_numpy().astype(np.int64)[row] << 32) + first - off[row], stop - first, data[B.ranges(first, stop - first)],
            ))
            size += b.column("text").nbytes
            if size > STRETCH_BYTES:
                yield from flush()
                held, size = [], 0
        if held:
            yield from flush()

    return candidates.mapInArrow(emit, STRETCHES)


def joined_stretches(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """docs, sizes, content, counts, places of all packed rows, one after another."""
    kinds = {"docs": np.int64, "sizes": np.uint8, "content": np.uint8, "counts": np.int32, "places": np.int64}
    docs, sizes, content, counts, places = (B.joined(table.column(n), t) for n, t in kinds.items())
    return docs, sizes.astype(np.int64), content, counts.astype(np.int64), places


SPANS = "kind int, bucket long, anchor long, salt int, docs binary, sizes binary, content binary, counts binary, places binary, until binary"


def _row(**values) -> pa.Table:
    types = dict(kind=pa.int32(), bucket=pa.int64(), anchor=pa.int64(), salt=pa.int32(), docs=pa.binary(), sizes=pa.binary(), content=pa.binary(), counts=pa.binary(), places=pa.binary(), until=pa.binary())
    return pa.table({n: pa.array([v.tobytes() if isinstance(v := values.get(n), np.ndarray) else v], t) for n, t in types.items()})


def span_rows(doc: np.ndarray, first: np.ndarray, last: np.ndarray, buckets: int) -> pa.Table:
    """Rows of kind 0: packed docs, first and last starts of removed strings, a row for each bucket of documents."""
    key = B.mix(doc.view(np.uint64))
    order = np.argsort(key, kind="stable")
    b, cut = B.by_bucket(key[order], buckets)
    rows = [_row(kind=0, bucket=int(k), docs=doc[x], places=first[x], until=last[x]) for k, i, j in zip(b, cut, cut[1:]) for x in [order[i:j]]]
    return pa.concat_tables(rows) if rows else _row(kind=0).slice(0, 0)


def _runs(part: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(part, first, last) of the runs of following numbers `at` within a part."""
    order = np.lexsort((at, part))
    part, at = part[order], at[order]
    fresh = np.ones(len(part), bool)
    fresh[1:] = (part[1:] != part[:-1]) | (at[1:] != at[:-1] + 1)
    i = np.flatnonzero(fresh)
    return part[i], at[i], at[np.append(i[1:], len(at)) - 1] if len(i) else at


def _placed(part: np.ndarray, first: np.ndarray, last: np.ndarray, docs: np.ndarray, counts: np.ndarray, places: np.ndarray, order: np.ndarray, of: np.ndarray):
    """Spans of runs within parts, at all places of the stretches that are the part: stretches `order`, ascending by their part `of`."""
    lo, hi = np.searchsorted(of, part), np.searchsorted(of, part, "right")
    run = np.repeat(np.arange(len(part)), hi - lo)
    stretch = order[B.ranges(lo, hi - lo)]
    begin = np.cumsum(counts) - counts
    k = np.repeat(np.arange(len(run)), counts[stretch])
    place = places[B.ranges(begin[stretch], counts[stretch])]
    return docs[stretch][k], place + first[run][k], place + last[run][k]


def shard_spans(buckets: int):
    def shard(table: pa.Table) -> pa.Table:
        """One shard: spans of strings that a smaller doc_id has in this shard; of an anchor's one of several shards also its
        sorted distinct strings (kind 1, a row for each range) and its stretches (kind 2)."""
        gone = np.array(table.column("gone").to_pylist())
        docs, sizes, _, counts, places = joined_stretches(table.filter(pa.array(gone)))
        doc, n = np.repeat(docs, counts), np.repeat(sizes, counts)
        out = [span_rows(doc, places, places + n - SPAN, buckets)]
        table = table.filter(pa.array(~gone))
        if not table.num_rows:
            return out[0]
        ways = table.column("ways")[0].as_py()
        docs, sizes, content, counts, places = joined_stretches(table)
        off = np.concatenate([[0], np.cumsum(sizes)])
        coded = pa.Array.from_buffers(pa.large_binary(), len(sizes), [None, pa.py_buffer(off.astype(np.int64)), pa.py_buffer(content)]).dictionary_encode()
        parts, of = coded.dictionary.to_pylist(), coded.indices.to_numpy().astype(np.int64)
        order = np.lexsort((docs, of))
        least = docs[order[np.searchsorted(of[order], np.arange(len(parts)))]]
        later = docs > least[of]  # the whole stretch is that of a smaller doc_id
        n = np.repeat(sizes, counts)
        again = np.repeat(later, counts)
        out.append(span_rows(np.repeat(docs, counts)[again], places[again], (places + n - SPAN)[again], buckets))
        part, at, number = equal_strings(parts)
        first = np.flatnonzero(np.concatenate([[True], number[1:] != number[:-1]])) if len(number) else np.zeros(0, np.int64)
        low = np.minimum.reduceat(least[part], first) if len(first) else least[:0]
        hit = np.repeat(low, np.diff(np.append(first, len(part)))) < least[part] if len(first) else np.zeros(0, bool)
        keep = order[~later[order]]
        out.append(span_rows(*_placed(*_runs(part[hit], at[hit]), docs, counts, places, keep, of[keep]), buckets))
        if ways > 1:
            anchor, salt = table.column("anchor")[0].as_py(), table.column("salt")[0].as_py()
            text = np.frombuffer(b"".join(parts), np.uint8)
            begin = np.concatenate([[0], np.cumsum([len(p) for p in parts])])[:-1][part[first]] + at[first]
            way = (B.span_hash(B.prefix_sums(text), begin, begin + SPAN) % B.U(ways)).astype(np.int64)
            for w in np.unique(way):
                k = way == w
                out.append(_row(kind=1, bucket=int(w), anchor=anchor, salt=salt, content=text[B.ranges(begin[k], np.full(k.sum(), SPAN))], docs=low[k]))
            one = np.repeat(~later, counts)
            out.append(_row(kind=2, anchor=anchor, salt=salt, docs=docs[~later], sizes=sizes[~later].astype(np.uint8), content=content[np.repeat(~later, sizes)], counts=counts[~later].astype(np.int32), places=places[one]))
        B.give_back()
        return pa.concat_tables(out)

    return shard


def merged_strings(table: pa.Table) -> pa.Table:
    """A range of all shards of an anchor, two at a time: one's strings are found in the other's by binary search. Each shard
    gets back its strings that a smaller doc_id has elsewhere."""
    salts = table.column("salt").to_pylist()
    runs = [(np.frombuffer(s, f"S{SPAN}"), np.frombuffer(d, np.int64)) for s, d in zip(table.column("content").to_pylist(), table.column("docs").to_pylist())]
    own = runs

    def merge(one, two):
        (a, da), (b, db) = one, two
        k = np.searchsorted(a, b)
        same = a[np.minimum(k, len(a) - 1)] == b
        da = da.copy()
        da[k[same]] = np.minimum(da[k[same]], db[same])
        return np.insert(a, k[~same], b[~same]), np.insert(da, k[~same], db[~same])

    while len(runs) > 1:
        runs = [merge(runs[i], runs[i + 1]) if i + 1 < len(runs) else runs[i] for i in range(0, len(runs), 2)]
    strings, least = runs[0]
    anchor, out = table.column("anchor")[0].as_py(), []
    for salt, (s, d) in zip(salts, own):
        low = least[np.searchsorted(strings, s)]
        k = low < d
        if k.any():
            out.append(_row(kind=3, anchor=anchor, salt=salt, content=np.frombuffer(s[k].tobytes(), np.uint8), docs=low[k]))
    return pa.concat_tables(out) if out else _row(kind=3).slice(0, 0)


def foreign_spans(buckets: int):
    def find(own: pa.Table, told: pa.Table) -> pa.Table:
        """Spans of a shard's strings that a smaller doc_id has in other shards."""
        if not own.num_rows or not told.num_rows:
            return span_rows(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64), buckets)
        known, low = np.frombuffer(B.joined(told.column("content"), np.uint8).tobytes(), f"S{SPAN}"), B.joined(told.column("docs"), np.int64)
        order = np.argsort(known)
        known, low = known[order], low[order]
        docs, sizes, content, counts, places = joined_stretches(own)
        starts = np.maximum(0, sizes - SPAN + 1)
        part, at = np.repeat(np.arange(len(sizes)), starts), B.ranges(np.zeros(len(sizes), np.int64), starts)
        begin = (np.cumsum(sizes) - sizes)[part] + at
        mine = np.lib.stride_tricks.sliding_window_view(content, SPAN)[begin].reshape(-1).view(f"S{SPAN}")
        k = np.minimum(np.searchsorted(known, mine), len(known) - 1)
        hit = (known[k] == mine) & (low[k] < docs[part])
        order = np.arange(len(docs))
        return span_rows(*_placed(*_runs(part[hit], at[hit]), docs, counts, places, order, order), buckets)

    return find


def _numbered(docs: DataFrame, meta: DataFrame) -> DataFrame:
    """docs (doc_id, text, ...) with `which`: 0, or the number of the text among the different ones of its doc_id."""
    again = stored(meta.where("doc_id is not null").groupBy("doc_id").agg(F.min("mark").alias("a"), F.max("mark").alias("b")).where("a < b").select("doc_id"), "again")
    if again.isEmpty():
        return docs.withColumn("which", F.lit(0))
    several = keys_join(meta, again, "doc_id", "left_semi").select("doc_id", "mark").distinct()
    several = stored(several.select("doc_id", "mark", (F.row_number().over(Window.partitionBy("doc_id").orderBy("mark")) - 1).alias("which")), "several")
    marked = docs.withColumn("mark", F.xxhash64(F.coalesce("text", F.lit(""))))
    return keys_join(marked, several, ["doc_id", "mark"], "left").withColumn("which", F.coalesce("which", F.lit(0))).drop("mark")


def merged_runs(spans: DataFrame, buckets: int) -> DataFrame:
    """(doc_id, runs): packed starts and ends of the removed bytes of each document, apart and ascending (places)."""

    def merge(table: pa.Table) -> pa.Table:
        doc, first, last = (B.joined(table.column(n), np.int64) for n in ("docs", "places", "until"))
        order = np.lexsort((first, doc))
        doc, first, end = doc[order], first[order], last[order] + SPAN
        step = np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1]])) if len(doc) else np.zeros(0, np.int64)
        out = []
        for i, j in zip(step, np.append(step[1:], len(doc))):
            reach = np.maximum.accumulate(end[i:j])
            fresh = np.ones(j - i, bool)
            fresh[1:] = first[i + 1 : j] > reach[:-1]
            a = np.flatnonzero(fresh)
            out.append(np.stack([first[i:j][a], reach[np.append(a[1:], j - i) - 1]], axis=1))
        return pa.table({"doc_id": pa.array(doc[step]), "runs": B.blobs(out)})

    packed = spans.where("kind = 0").select("bucket", "docs", "places", "until")
    return packed.repartition(buckets, "bucket").groupBy("bucket").applyInArrow(merge, "doc_id long, runs binary")


def with_runs(docs: DataFrame, then: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str, anchor_rows: int = ANCHOR_ROWS) -> DataFrame:
    """What `then` makes, as `schema`, of batches of docs with `__runs`: packed starts and ends of the bytes that each row's text
    loses; null if none. It goes in the pass that finds the runs: a second one would take another Python worker a task, and
    workers stay, with their memory, beside those of later stages.

    docs has doc_id (long) and text; other columns stay."""
    plain = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    meta = stored(plain.select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("sha"), F.xxhash64("text").alias("mark")), "bytes")
    buckets = pieces(meta.agg(F.sum("n_bytes").alias("b")).first()["b"] or 0, BUCKET_BYTES, 8)
    least = meta.where("doc_id is not null").groupBy("sha").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most")).where("least < most").select("sha", "least")
    numbered = _numbered(plain.where("doc_id is not null"), meta)
    marks = keys_join(meta, stored(least, "least"), "sha", "inner").where("least < doc_id").select("doc_id", "mark", "n_bytes").distinct()
    copies = stored(marks, "copies")
    own = keys_join(numbered.withColumn("mark", F.xxhash64("text")), copies.select("doc_id", "mark"), ["doc_id", "mark"], "left_anti").drop("mark")
    found = stored(shared_anchors(own, buckets), "anchors")
    wanted = stored(found.select("doc_id"), "wanted")
    candidates = keys_join(own, wanted, "doc_id", "left_semi").join(found, "doc_id")
    keys = ["bucket", "anchor", "salt"]
    dealt = stretch_rows(candidates, SHARDS * buckets, anchor_rows).repartition(SHARDS * buckets, *keys)
    spans = stored(dealt.groupBy(*keys).applyInArrow(shard_spans(buckets), SPANS), "spans")
    release(found, wanted)
    strings = spans.where("kind = 1")
    all_spans = spans
    if not strings.isEmpty():
        told = strings.groupBy("anchor", "bucket").applyInArrow(merged_strings, SPANS)
        hot = spans.where("kind = 2").groupBy("anchor", "salt").cogroup(told.groupBy("anchor", "salt")).applyInArrow(foreign_spans(buckets), SPANS)
        all_spans = spans.unionByName(hot)
    runs = stored(merged_runs(all_spans, buckets), "runs")
    release(spans)
    numbered = _numbered(docs, meta)

    def whole(batches):
        for b in batches:
            yield pa.record_batch({"doc_id": b.column("doc_id"), "mark": b.column("mark"), "__whole": B.blobs([np.array([0, n]) for n in b.column("n_bytes").to_pylist()])})

    lost = copies.where(F.col("n_bytes") >= SPAN).mapInArrow(whole, "doc_id long, mark long, __whole binary")
    lost = stored(lost.select("doc_id", F.col("mark").alias("__mark"), "__whole"), "whole")
    rows = sized_join(numbered, runs.withColumnRenamed("runs", "__found"), "doc_id", "left", "__found")
    rows = keys_join(rows.withColumn("__mark", F.xxhash64(F.coalesce("text", F.lit("")))), lost, ["doc_id", "__mark"], "left")

    def own_runs(batches):
        for b in batches:
            out = []
            for which, found, all_ in zip(b.column("which").to_pylist(), b.column("__found").to_pylist(), b.column("__whole").to_pylist()):
                pairs = np.frombuffer(all_ if all_ is not None else found or b"", np.int64)
                if all_ is None and len(pairs):
                    pairs = pairs[pairs >> 32 == which] - (which << 32)
                out.append(pairs.tobytes() if len(pairs) else None)
            yield pa.record_batch([*(b.column(n) for n in names), pa.array(out, pa.binary())], names=[*names, "__runs"])

    names = docs.columns
    return rows.select(*names, "which", "__found", "__whole").mapInArrow(lambda batches: then(own_runs(batches)), schema)


def kept_bytes(data: np.ndarray, runs: bytes) -> np.ndarray:
    """Marks the bytes of a text that stay."""
    keep = np.ones(len(data), bool)
    for a, b in np.frombuffer(runs, np.int64).reshape(-1, 2):
        keep[a:b] = False
    return keep


def remove_repeats(docs: DataFrame, anchor_rows: int = ANCHOR_ROWS) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every row of docs."""

    def cut(batches):
        for b in B.slices(batches):
            data, off = B.raw(b.column("text"))
            removed, spans, shas = [], [], []
            for k, runs in enumerate(b.column("__runs").to_pylist()):
                text = data[off[k] : off[k + 1]]
                if runs:
                    keep = kept_bytes(text, runs)
                    removed.append(len(text) - int(keep.sum()))
                    text = text[keep]
                else:
                    removed.append(0)
                spans.append(len(runs or b"") // 16)
                shas.append(hashlib.sha256(text).hexdigest())
            yield pa.record_batch({"doc_id": b.column("doc_id"), "n_bytes": pa.array(np.diff(off)), "n_removed": pa.array(removed, pa.int64()), "n_spans": pa.array(spans, pa.int64()), "kept_sha256": pa.array(shas, pa.string())})

    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    return with_runs(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), cut, schema, anchor_rows)


def op9_suffix_array_dedup(spark, sf_dir: str) -> DataFrame:
    return remove_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
