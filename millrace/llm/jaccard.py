"""N-gram Jaccard join by vertical partitioning (operator 8).

A document is the set of its distinct five-word shingles (64-bit hashes). Two documents link when 100 * |A & B| >= 75 * |A | B|.

1. Documents with the same set form a class; only its representative, the smallest doc_id, goes on.
2. The shingle order is cut into fragments (ranges of hashes). Each fragment's inverted list tells which of its shingles at
   least two sets have; a set's shared shingles are summed over the fragments. An overlap holds shared shingles only, and a
   link needs an overlap of t = ceil(0.75 |A|). The first fragments (PROBE of the order) are counted for all sets: one with more
   than |A| - t unshared shingles there links with nothing and goes no further. The other fragments are counted for the rest.
   HEAVY shingles (found in the first pass by their count within a task's share) are shared for certain: they go straight to
   their documents and never meet in one fragment.
3. Of a set with s >= t shared shingles any link shares one of the first s - t + 1, rarer shingles first.
4. Candidates come in rounds. First, sets are paired with the smallest doc_id that has the same minimum of a hash function, for
   a few functions: that joins most groups of near copies by stars. Then, for each such leading shingle that sets of different
   components have, one set a component is compared with one of another; last, every pair of sets of different components
   whose sizes and places in the order allow a link. So no link between components is lost, and a group of n near copies
   costs some n comparisons.
5. A comparison joins the fragments of both sets, counts their overlaps separately and sums them for each pair.

Defined cases: null and empty texts, and texts without words, have an empty set and link with nothing; fewer than five words
are one shingle; repeated rows are returned each; rows with a null doc_id are returned with component_id null and take no
part; rows that repeat a doc_id with other texts are one node, whose links are those of the smallest text, and of equal sets; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import bytesops as B
from .components import components
from .scratch import keys_join, pieces, release, stored, text_bytes

WIDTH = 5
#: Sets with a shingle within HELD_BYTES of text that make it heavy, and most heavy shingles that are told to all tasks.
HEAVY = 48
MOST_HEAVY = 1_000_000
#: Share of the shingle order that is counted for all sets, in eighths.
PROBE = 3
#: Fragments of a comparison.
FRAGMENTS = 4
#: Hash functions of the first round, and most rounds of one set a component.
FUNCTIONS = 4
TURNS = 3
#: Text bytes whose shingles one fragment holds.
FRAGMENT_BYTES = 12 << 20
#: Text bytes that a task sums up before it hands on.
HELD_BYTES = 10 << 20
LOW = B.U(PROBE << 61)


def sets_of(batch: pa.RecordBatch, width: int = WIDTH):
    words, rows = B.word_hashes(*B.raw(batch.column("text")))
    return B.shingle_sets(words, rows, width)


def least_overlap(n: Column) -> Column:
    """ceil(0.75 n): the overlap that a set of n shingles needs with any set that it links with."""
    return ((3 * n + 3) / 4).cast("long")


def links(common: Column, na: Column, nb: Column) -> Column:
    return 100 * common >= 75 * (na + nb - common)


def signatures(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """doc_id, n_shingles, n_low (of them in the PROBE part) and two sums that equal sets share, for every row (real); other
    rows hold (heavy, counts): packed shingles of HEAVY different sets within a task's share."""

    def sign(batches):
        held, size = [], 0

        def heavy():
            _, first = np.unique(np.concatenate([s for s, _, _ in held]), return_index=True)
            sets = [h[i:j] for _, h, off in held for i, j in zip(off, off[1:])]
            h, n = np.unique(np.concatenate([sets[k] for k in first]), return_counts=True)
            keep = n >= HEAVY
            none = pa.array([0], pa.int64())
            return pa.record_batch({"doc_id": none, "n_shingles": none, "n_low": none, "s1": none, "s2": none, "real": pa.array([False]), "heavy": B.blobs([h[keep]]), "counts": B.blobs([n[keep].astype(np.int64)])})

        for b in B.slices(batches):
            h, off = sets_of(b, width)
            sums = []
            for salt in (0x51, 0xA7):
                c = np.zeros(len(h) + 1, np.uint64)
                np.cumsum(B.mix(h + B.U(salt)), out=c[1:])
                sums.append(c[off[1:]] - c[off[:-1]])
            low = np.concatenate([[0], np.cumsum(h < LOW)])
            none = pa.nulls(len(off) - 1, pa.binary())
            yield pa.record_batch({
                "doc_id": b.column("doc_id"), "n_shingles": pa.array(np.diff(off)), "n_low": pa.array(low[off[1:]] - low[off[:-1]]),
                "s1": pa.array(sums[0].view(np.int64)), "s2": pa.array(sums[1].view(np.int64)), "real": pa.array(np.ones(len(off) - 1, bool)), "heavy": none, "counts": none,
            })
            held.append((sums[0], h, off))
            size += b.column("text").nbytes
            if size > HELD_BYTES:
                yield heavy()
                held, size = [], 0
        if held:
            yield heavy()

    return docs.select("doc_id", "text").mapInArrow(sign, "doc_id long, n_shingles long, n_low long, s1 long, s2 long, real boolean, heavy binary, counts binary")


def heavy_shingles(signs: DataFrame) -> np.ndarray:
    """(h, rank) of the heavy shingles, ascending by h; the MOST_HEAVY commonest if there are more."""

    def unpack(batches):
        for b in batches:
            yield pa.record_batch({"h": pa.array(B.joined(b.column("heavy"), np.int64)), "c": pa.array(B.joined(b.column("counts"), np.int64))})

    rows = signs.where(~F.col("real") & (F.octet_length("heavy") > 0)).select("heavy", "counts").mapInArrow(unpack, "h long, c long")
    got = rows.groupBy("h").agg(F.sum("c").alias("c")).orderBy(F.desc("c"), "h").limit(MOST_HEAVY).toArrow()
    h, c = got.column("h").to_numpy().view(np.uint64), got.column("c").to_numpy()
    order = np.argsort(h)
    return np.rec.fromarrays([h[order], (128 + np.log2(np.maximum(1, c[order]))).astype(np.uint8)], names="h,rank")


def shared_shingles(docs: DataFrame, heavy: np.ndarray, low: bool, count: int, buckets: int) -> DataFrame:
    """(bucket, docs, counts, h, rank): the shingles of the PROBE part, or of the rest, that another document has too, packed by
    document, a row for each fragment and bucket of documents; rank is 2 to 127 by the number of sets, from 128 for heavy ones."""
    shared = docs.sparkSession.sparkContext.broadcast(heavy)  # at most MOST_HEAVY rows

    def emit(batches):
        known = shared.value
        held, size = [], 0

        def flush():
            h, doc = (np.concatenate(x) for x in zip(*held))
            rank = np.zeros(len(h), np.uint8)
            if len(known):
                at = np.minimum(np.searchsorted(known.h, h), len(known) - 1)
                rank = np.where(known.h[at] == h, known.rank[at], 0).astype(np.uint8)
            # a heavy shingle goes by its document, any other by its hash (mixed, for the part's hashes are one range)
            key = B.mix(np.where(rank > 0, doc.view(np.uint64), h))
            order = np.argsort(key, kind="stable")
            h, doc, rank, key = h[order], doc[order], rank[order], key[order]
            base = int(doc.min()) if len(doc) else 0
            wide = bool(len(doc)) and int(doc.max()) - base >= 1 << 32
            doc = (doc - base).astype(np.int64 if wide else np.uint32)
            b, cut = B.by_bucket(key, count)
            return pa.record_batch({"fragment": pa.array(b), "base": pa.array(np.full(len(b), base)), "wide": pa.array(np.full(len(b), wide)), **{k: B.blobs([x[i:j] for i, j in zip(cut, cut[1:])]) for k, x in (("h", h), ("doc", doc), ("rank", rank))}})

        for b in B.slices(batches):
            h, off = sets_of(b)
            take = (h < LOW) == low
            held.append((h[take], b.column("doc_id").to_numpy()[B.row_of(off)][take]))
            size += b.column("text").nbytes
            if size > HELD_BYTES:
                yield flush()
                held, size = [], 0
        if held:
            yield flush()

    def meet(table: pa.Table) -> pa.Table:
        h, rank = B.joined(table.column("h"), np.uint64), B.joined(table.column("rank"), np.uint8)
        rows = zip(table.column("doc").to_pylist(), table.column("wide").to_pylist(), table.column("base").to_pylist())
        doc = np.concatenate([np.frombuffer(d, np.int64 if wide else np.uint32).astype(np.int64) + base for d, wide, base in rows])
        order = np.argsort(h, kind="stable")
        h, rank, doc = h[order], rank[order].astype(np.int64), doc[order]
        at = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]])) if len(h) else np.zeros(0, np.int64)
        sizes = np.diff(np.append(at, len(h)))
        rank = np.where(rank > 0, rank, np.repeat(np.minimum(sizes, 127), sizes))
        keep = rank > 1
        h, rank, doc = h[keep], rank[keep].astype(np.uint8), doc[keep]
        order = np.lexsort((doc, B.mix(doc.view(np.uint64))))
        h, rank, doc = h[order], rank[order], doc[order]
        at = np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1]])) if len(doc) else np.zeros(0, np.int64)
        b, cut = B.by_bucket(B.mix(doc[at].view(np.uint64)), buckets)
        sizes, ends = np.diff(np.append(at, len(doc))).astype(np.int32), np.append(at, len(doc))
        B.give_back()
        return pa.table({
            "bucket": pa.array(b), "docs": B.blobs([doc[at[i:j]] for i, j in zip(cut, cut[1:])]), "counts": B.blobs([sizes[i:j] for i, j in zip(cut, cut[1:])]),
            "h": B.blobs([h[ends[i] : ends[j]] for i, j in zip(cut, cut[1:])]), "rank": B.blobs([rank[ends[i] : ends[j]] for i, j in zip(cut, cut[1:])]),
        })

    rows = docs.select("doc_id", "text").mapInArrow(emit, "fragment long, base long, wide boolean, h binary, doc binary, rank binary")
    return rows.repartition(count, "fragment").groupBy("fragment").applyInArrow(meet, "bucket long, docs binary, counts binary, h binary, rank binary")


def shared_counts(parts: DataFrame) -> DataFrame:
    """(doc, k): how many shared shingles the parts have of each document."""

    def add(table: pa.Table) -> pa.Table:
        docs, which = np.unique(B.joined(table.column("docs"), np.int64), return_inverse=True)
        return pa.table({"doc": pa.array(docs), "k": pa.array(np.bincount(which, weights=B.joined(table.column("counts"), np.int32), minlength=len(docs)).astype(np.int64))})

    return parts.select("bucket", "docs", "counts").groupBy("bucket").applyInArrow(add, "doc long, k long")


def gathered(parts: DataFrame) -> DataFrame:
    """(doc, h, rank): the packed shared shingles of each document, from all fragments."""

    def gather(table: pa.Table) -> pa.Table:
        docs, counts, h, rank = (B.joined(table.column(n), t) for n, t in (("docs", np.int64), ("counts", np.int32), ("h", np.uint64), ("rank", np.uint8)))
        doc = np.repeat(docs, counts)
        order = np.argsort(doc, kind="stable")
        h, rank, doc = h[order], rank[order], doc[order]
        at = np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1]])) if len(doc) else np.zeros(0, np.int64)
        ends = np.append(at[1:], len(doc)) if len(doc) else at
        B.give_back()
        return pa.table({"doc": pa.array(doc[at]), "h": B.blobs([h[i:j] for i, j in zip(at, ends)]), "rank": B.blobs([rank[i:j] for i, j in zip(at, ends)])})

    return parts.groupBy("bucket").applyInArrow(gather, "doc long, h binary, rank binary")


def shared_sets(parts: DataFrame, sizes: DataFrame) -> DataFrame:
    """(doc, n, s, h, lead, least) of the sets that may link: packed shared shingles ascending, the first s - t + 1 in the
    global order, and the minimum of each hash function."""

    def build(batches):
        for b in batches:
            hs, leads, least = [], [], []
            for n, h, rank in zip(b.column("n").to_pylist(), b.column("h").to_pylist(), b.column("rank").to_pylist()):
                h, rank = np.frombuffer(h, np.uint64), np.frombuffer(rank, np.uint8)
                t = -(-3 * n // 4)
                leads.append(h[np.lexsort((h, rank))[: len(h) - t + 1]])
                hs.append(np.sort(h))
                least.append([int(B.mix(h ^ B.U(0x9E3779B97F4A7C15 * (k + 1) & (1 << 64) - 1)).min().view(np.int64)) for k in range(FUNCTIONS)])
            sizes = [len(h) for h in hs]
            yield pa.record_batch({"doc": b.column("doc"), "n": b.column("n"), "s": pa.array(sizes, pa.int64()), "h": B.blobs(hs), "lead": B.blobs(leads), "least": pa.array(least, pa.list_(pa.int64()))})
        B.give_back()

    # merged, not broadcast: a shuffle parts the two passes, which in one task would take two Python workers, and workers stay
    sizes = sizes.select(F.col("doc_id").alias("doc"), F.col("n_shingles").alias("n")).hint("merge")
    found = gathered(parts).join(sizes, "doc").where(F.octet_length("rank") >= least_overlap(F.col("n")))
    return found.select("doc", "n", "h", "rank").mapInArrow(build, "doc long, n long, s long, h binary, lead binary, least array<long>")


def leading_shingles(sets: DataFrame) -> DataFrame:
    """(h, doc, n, s, place): the leading shingles of each set with their place in its order."""

    def unpack(batches):
        for b in batches:
            k = np.array([len(x) // 8 for x in b.column("lead").to_pylist()], np.int64)
            cols = {c: pa.array(np.repeat(b.column(c).to_numpy(), k)) for c in ("doc", "n", "s")}
            yield pa.record_batch({"h": pa.array(B.joined(b.column("lead"), np.int64)), **cols, "place": pa.array(B.ranges(np.zeros(len(k), np.int64), k))})
        B.give_back()

    return sets.select("doc", "n", "s", "lead").mapInArrow(unpack, "h long, doc long, n long, s long, place long")


def segments(sets: DataFrame) -> DataFrame:
    """(doc, fragment, part): the fragments of each set."""

    def cut(batches):
        edges = (np.arange(1, FRAGMENTS, dtype=np.uint64) * B.U((1 << 64) // FRAGMENTS)).astype(np.uint64)
        for b in batches:
            doc, fragment, part = [], [], []
            for d, h in zip(b.column("doc").to_pylist(), b.column("h").to_pylist()):
                h = np.frombuffer(h, np.uint64)
                at = np.concatenate([[0], np.searchsorted(h, edges), [len(h)]])
                for k in np.flatnonzero(np.diff(at)):
                    doc.append(d)
                    fragment.append(int(k))
                    part.append(h[at[k] : at[k + 1]])
            yield pa.record_batch({"doc": pa.array(doc, pa.int64()), "fragment": pa.array(fragment, pa.int32()), "part": B.blobs(part)})
        B.give_back()

    return sets.select("doc", "h").mapInArrow(cut, "doc long, fragment int, part binary")


def verified(pairs: DataFrame, parts: DataFrame) -> DataFrame:
    """Stored (u, v, ru, rv): the stored pairs (a, b, na, nb, ra, rb) that link; parts are the stored segments."""
    names = pairs.columns

    def overlap(batches):
        for batch in batches:
            common = np.zeros(batch.num_rows, np.int64)
            for k, (x, y) in enumerate(zip(batch.column("x"), batch.column("y"))):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                if len(x) > len(y):
                    x, y = y, x
                at = np.minimum(np.searchsorted(y, x), len(y) - 1)
                common[k] = np.count_nonzero(y[at] == x)
            yield pa.record_batch([*(batch.column(n) for n in names), pa.array(common)], names=[*names, "met"])
        B.give_back()

    left = parts.select(F.col("doc").alias("b"), "fragment", F.col("part").alias("y"))
    right = parts.select(F.col("doc").alias("a"), "fragment", F.col("part").alias("x"))
    both = pairs.join(left, "b").join(right, ["a", "fragment"]).select(*names, "x", "y")
    sums = both.mapInArrow(overlap, ", ".join(f"{n} long" for n in names) + ", met long").groupBy(*names).agg(F.sum("met").alias("met"))
    return stored(sums.where(links(F.col("met"), F.col("na"), F.col("nb"))).select(F.col("a").alias("u"), F.col("b").alias("v"), F.col("ra").alias("ru"), F.col("rb").alias("rv")), "links")


def _paired(one: str, other: str) -> list[Column]:
    """Columns a, b, na, nb, ra, rb (a < b) of two structs (doc, n, s, place, root)."""
    first = F.col(f"{one}.doc") < F.col(f"{other}.doc")
    return [F.when(first, F.col(f"{x}.{c}")).otherwise(F.col(f"{y}.{c}")).alias(name) for c, names in (("doc", "ab"), ("n", ("na", "nb")), ("root", ("ra", "rb"))) for name, x, y in ((names[0], one, other), (names[1], other, one))]


def _may_link(one: str, other: str) -> Column:
    """Sizes and places of a common shingle allow a link: what follows it in the order is the most that can be common."""
    rest = F.least(F.col(f"{one}.s") - F.col(f"{one}.place"), F.col(f"{other}.s") - F.col(f"{other}.place"))
    return links(rest, F.col(f"{one}.n"), F.col(f"{other}.n"))


def _open(state: DataFrame) -> DataFrame:
    """Stored rows of the shingles that sets of different components have."""
    spread = state.groupBy("h").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low < high").select("h")
    return stored(state.join(spread, "h"), "open")


def _merged(state: DataFrame, edges: DataFrame) -> DataFrame:
    """state with the roots after the links between components (ru, rv)."""
    roots = stored(components(edges.select(F.col("ru").alias("u"), F.col("rv").alias("v"))), "roots").select(F.col("node").alias("root"), F.col("root").alias("now"))
    return keys_join(state, roots, "root", "left").withColumn("root", F.coalesce("now", "root")).drop("now")


def all_links(sets: DataFrame) -> DataFrame:
    """Enough links (u, v) between stored shared sets for the components of all links."""
    parts = stored(segments(sets), "segments")
    keys = sets.select("doc", "n", F.posexplode("least").alias("k", "m"))
    stars = keys.groupBy("k", "m").agg(F.min(F.struct("doc", "n")).alias("p"), F.max("doc").alias("most")).where(F.col("p.doc") < F.col("most")).select("k", "m", "p")
    near = keys.join(stars, ["k", "m"]).where(F.col("p.doc") < F.col("doc"))
    near = near.select(F.col("p.doc").alias("a"), F.col("doc").alias("b"), F.col("p.n").alias("na"), F.col("n").alias("nb"), F.col("p.doc").alias("ra"), F.col("doc").alias("rb"))
    pairs = stored(near.where(links(F.least("na", "nb"), F.col("na"), F.col("nb"))).distinct(), "pairs")
    found = [verified(pairs, parts)]
    release(pairs)
    state = _open(_merged(leading_shingles(sets).withColumn("root", F.col("doc")), found[0]))
    row = F.struct("doc", "n", "s", "place", "root")
    for turn in range(TURNS + 1):
        if state.isEmpty():
            break
        if turn < TURNS:  # one set a component, against that of one component
            one = state.groupBy("h", "root").agg(F.min_by(row, F.struct(F.xxhash64("doc", F.lit(turn)), "doc")).alias("x"))
            other = one.groupBy("h").agg(F.min_by("x", F.struct(F.xxhash64("root", F.lit(turn)), "root")).alias("y"))
            both = one.join(other, "h")
        else:  # every pair left; sets of the largest component of a shingle are not paired with each other
            largest = state.groupBy("h", "root").count().groupBy("h").agg(F.max_by("root", F.struct("count", "root")).alias("main"))
            rows = state.join(largest, "h").select("h", row.alias("x"), (F.col("root") == F.col("main")).alias("major"))
            minor = rows.where("not major").select("h", F.col("x").alias("y"))
            both = rows.join(minor, "h").where(F.col("major") | (F.col("x.doc") < F.col("y.doc")))
        both = both.where((F.col("x.root") != F.col("y.root")) & _may_link("x", "y"))
        pairs = stored(both.select(*_paired("x", "y")).distinct(), "pairs")
        if pairs.isEmpty():
            if turn < TURNS:
                continue
            break
        found.append(verified(pairs, parts))
        release(pairs)
        if turn < TURNS and not found[-1].isEmpty():
            before, state = state, _open(_merged(state, found[-1]))
            release(before)
    release(parts)
    out = found[0].select("u", "v")
    for more in found[1:]:
        out = out.unionByName(more.select("u", "v"))
    return out


def join_documents(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """doc_id, n_shingles, component_id of every row of docs (doc_id, text)."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    count = pieces(text_bytes(docs), FRAGMENT_BYTES, 8)
    found = stored(signatures(docs, width), "signatures")
    heavy = heavy_shingles(found)
    signs = found.where("real").select("doc_id", "n_shingles", "n_low", "s1", "s2")
    known = signs.where(F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0))
    classes = known.groupBy("s1", "s2", "n_shingles").agg(F.min("doc_id").alias("class"))
    member = stored(known.select("doc_id", "s1", "s2", "n_shingles").distinct().join(classes, ["s1", "s2", "n_shingles"]).select("doc_id", "class"), "classes")
    copies = stored(member.groupBy("doc_id").agg(F.min("class").alias("class")).where("class < doc_id").select("doc_id"), "copies")
    own = keys_join(docs.where("doc_id is not null"), copies, "doc_id", "left_anti")
    sizes = keys_join(known.select("doc_id", "n_shingles", "n_low"), copies, "doc_id", "left_anti")
    again = stored(known.groupBy("doc_id").count().where("count > 1").select("doc_id"), "again")
    if not again.isEmpty():
        once = stored(keys_join(own, again, "doc_id", "left_semi").groupBy("doc_id").agg(F.min("text").alias("text")), "once")
        own = keys_join(own, again, "doc_id", "left_anti").unionByName(once)
        sizes = keys_join(sizes, again, "doc_id", "left_anti").unionByName(signatures(once, width).where("real").select("doc_id", "n_shingles", "n_low"))
    low = stored(shared_shingles(own, heavy, True, pieces(count * PROBE, 8), count), "low-shingles")
    n = F.col("n_shingles")
    shared = shared_counts(low)
    hopeful = sizes.join(shared, sizes["doc_id"] == shared["doc"], "left").where(F.col("n_low") - F.coalesce("k", F.lit(0)) <= n - least_overlap(n))
    hopeful = stored(hopeful.select("doc_id", "n_shingles"), "hopeful")
    high = shared_shingles(keys_join(own, hopeful.select("doc_id"), "doc_id", "left_semi"), heavy, False, pieces(count * (8 - PROBE), 8), count)
    parts = low.unionByName(high)
    sets = stored(shared_sets(parts, hopeful), "shared-sets")
    release(low, hopeful)
    edges = all_links(sets)
    release(sets)
    same = member.where("class < doc_id").select(F.col("doc_id").alias("u"), F.col("class").alias("v"))
    roots = stored(components(edges.unionByName(same)), "roots")
    out = signs.join(roots, signs["doc_id"] == roots["node"], "left")
    return out.select("doc_id", "n_shingles", F.coalesce("root", "doc_id").alias("component_id"))


def op8_ngram_jaccard_join(spark, sf_dir: str) -> DataFrame:
    return join_documents(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
