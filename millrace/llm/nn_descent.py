"""Approximate nearest neighbours by NN-descent and greedy graph search (operator 5).

1. Rows with the same vector form a node (its smallest vec_id); vectors that are null, zero, or hold a null or non-finite
   component, or whose size is not the commonest one, take no part.
2. The first neighbour lists come from blocks of vectors that stand together when ordered by the signs of random projections,
   once for each of PROJECTIONS orders.
3. NN-descent: each node's neighbours and a sample of the nodes that have it as neighbour are joined with their vectors and
   compared with each other; a pair closer than a list's last entry enters that list. Rounds end when under SETTLED of all list
   entries change. All nodes are indexed; only the reverse neighbours are sampled (REVERSE a node), as the method has it.
4. Queries search the graph greedily: the best EXPAND candidates not yet expanded are, until the best BEAM all are; a query
   that is settled takes no part in further steps.
5. The best nodes are scored in double precision on the original vectors, and nodes expanded to their rows.

Recall against brute force is measured in the tests and given in the README. Defined cases: a query that takes no part has no
rows; with fewer than k candidates all come; repeated vec_ids count once, with the smallest vector; an empty table gives no
rows; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import bytesops as B
from .scratch import pieces, release, sized_join, stored

NEIGHBOURS = 30
REVERSE = 30
PROJECTIONS = 5
BLOCK = 160
ROUNDS = 8
SETTLED = 0.02
BEAM = 320
EXPAND = 80
#: Nodes of one bucket.
BUCKET = 4_000
LISTS = "bucket int, id long, ids binary, sims binary"


def usable(rows: DataFrame) -> DataFrame:
    """Stored (vec_id, vector: packed doubles) of the rows that take part."""
    fine = F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()
    wide = rows.where(fine).select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v"))
    wide = wide.where(~F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists("v", lambda x: x != 0))
    sizes = wide.groupBy(F.size("v").alias("s")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "s").limit(1).collect()
    wide = wide.where(F.size("v") == (sizes[0]["s"] if sizes else 0))

    def packed(batches):
        for b in batches:
            flat = np.asarray(b.column("v").flatten().to_numpy(zero_copy_only=False), np.float64)
            size = len(flat) // max(1, b.num_rows)
            yield pa.record_batch({"vec_id": b.column("vec_id"), "vector": B.blobs(list(flat.reshape(b.num_rows, size)))})

    return stored(wide.mapInArrow(packed, "vec_id long, vector binary").groupBy("vec_id").agg(F.min("vector").alias("vector")), "vectors")


def matrix(column: pa.Array, dtype=np.float32) -> np.ndarray:
    flat = B.joined(column, dtype)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 1)


def unit(vectors: np.ndarray) -> np.ndarray:
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return (scaled / np.linalg.norm(scaled, axis=1, keepdims=True)).astype(np.float32)


def best(owner: np.ndarray, other: np.ndarray, sim: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each owner the k most similar distinct others, in order."""
    order = np.lexsort((other, owner))
    owner, other, sim = owner[order], other[order], sim[order]
    fresh = np.ones(len(owner), bool)
    fresh[1:] = (owner[1:] != owner[:-1]) | (other[1:] != other[:-1])
    owner, other, sim = owner[fresh], other[fresh], sim[fresh]
    order = np.lexsort((other, -sim, owner))
    owner, other, sim = owner[order], other[order], sim[order]
    first = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]])) if len(owner) else np.zeros(0, np.int64)
    place = np.arange(len(owner)) - np.repeat(first, np.diff(np.append(first, len(owner))))
    keep = place < k
    return owner[keep], other[keep], sim[keep]


def as_lists(bucket: np.ndarray | int, owner: np.ndarray, other: np.ndarray, sim: np.ndarray) -> pa.Table:
    at = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]])) if len(owner) else np.zeros(0, np.int64)
    ends = np.append(at[1:], len(owner)) if len(owner) else at
    buckets = np.full(len(at), bucket, np.int32) if np.isscalar(bucket) else bucket[at].astype(np.int32)
    return pa.table({"bucket": pa.array(buckets), "id": pa.array(owner[at], pa.int64()), "ids": B.blobs([other[i:j] for i, j in zip(at, ends)]), "sims": B.blobs([sim[i:j].astype(np.float32) for i, j in zip(at, ends)])})


def flat_lists(table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    sizes = np.array([len(x) // 8 for x in table.column("ids").to_pylist()], np.int64)
    owner = np.repeat(np.asarray(table.column("id").to_numpy()), sizes)
    return owner, B.joined(table.column("ids"), np.int64), B.joined(table.column("sims"), np.float32)


def bucket_of(ids: np.ndarray, buckets: int) -> np.ndarray:
    return (B.mix(ids.astype(np.int64).view(np.uint64)) % np.uint64(buckets)).astype(np.int32)


def merged(lists: DataFrame, k: int) -> DataFrame:
    def merge(table: pa.Table) -> pa.Table:
        return as_lists(table.column("bucket")[0].as_py(), *best(*flat_lists(table), k))

    return lists.groupBy("bucket").applyInArrow(merge, LISTS)


def first_lists(nodes: DataFrame, buckets: int, size: int, seed: int = 11) -> DataFrame:
    planes = np.random.default_rng(seed).normal(size=(PROJECTIONS, 14, size)).astype(np.float32)

    def keys(batches):
        for b in batches:
            v = matrix(b.column("vec"))
            for t in range(PROJECTIONS):
                signs = (v @ planes[t].T) > 0
                gray = np.cumsum(signs, axis=1) % 2  # neighbours in this order differ in few signs
                key = gray @ (1 << np.arange(14)[::-1])
                yield pa.record_batch({"t": pa.array(np.full(len(v), t, np.int32)), "key": pa.array(key.astype(np.int64)), "id": b.column("id"), "vec": b.column("vec")})

    def blocks(batches):
        held: dict[int, list] = {}

        def compare(ids, v):
            s = v @ v.T
            np.fill_diagonal(s, -2)
            k = min(NEIGHBOURS, len(ids) - 1)
            top = np.argpartition(-s, k - 1, axis=1)[:, :k] if k else np.zeros((len(ids), 0), np.int64)
            owner = np.repeat(ids, k)
            out = as_lists(bucket_of(owner, buckets), owner, ids[top.ravel()], np.take_along_axis(s, top, axis=1).ravel())
            return out.to_batches()

        for b in batches:
            t = b.column("t").to_numpy()
            for k in np.unique(t):
                m = b.filter(pa.array(t == k))
                held.setdefault(int(k), []).append((m.column("id").to_numpy(), matrix(m.column("vec"))))
            for k in list(held):
                ids, v = np.concatenate([x[0] for x in held[k]]), np.concatenate([x[1] for x in held[k]])
                while len(ids) >= 2 * BLOCK:
                    yield from compare(ids[:BLOCK], v[:BLOCK])
                    ids, v = ids[BLOCK:], v[BLOCK:]
                held[k] = [(ids, v)]
        for parts in held.values():
            ids, v = parts[0]
            if len(ids) > 1:
                yield from compare(ids, v)

    ordered = nodes.mapInArrow(keys, "t int, key long, id long, vec binary").repartitionByRange(pieces(buckets, 1), "t", "key", "id").sortWithinPartitions("t", "key", "id")
    return merged(ordered.mapInArrow(blocks, LISTS), NEIGHBOURS)


def pairs_both_ways(graph: DataFrame, buckets: int) -> DataFrame:
    """(v, u): each node with its neighbours and a sample of the nodes that have it as a neighbour."""

    def turn(batches):
        for b in batches:  # one row for each bucket of the nodes pointed at
            owner, other, _ = flat_lists(b)
            v, u, back = np.concatenate([owner, other]), np.concatenate([other, owner]), np.repeat([False, True], len(owner))
            k = bucket_of(v, buckets)
            order = np.argsort(k, kind="stable")
            cut = np.append(np.flatnonzero(np.diff(k[order], prepend=-1)), len(k))
            parts = [order[i:j] for i, j in zip(cut, cut[1:])]
            yield pa.record_batch({"bucket": pa.array(k[order][cut[:-1]]), **{n: B.blobs([x[p] for p in parts]) for n, x in (("v", v), ("u", u), ("back", back))}})

    def choose(table: pa.Table) -> pa.Table:
        owner, other, back = B.joined(table.column("v"), np.int64), B.joined(table.column("u"), np.int64), B.joined(table.column("back"), bool)
        rank = B.mix(owner[back].view(np.uint64) * B.STEP ^ other[back].view(np.uint64)).astype(np.float64)
        kept = best(owner[back], other[back], rank, REVERSE)
        v, u = np.concatenate([owner[~back], kept[0]]), np.concatenate([other[~back], kept[1]])
        order = np.lexsort((u, v))
        v, u = v[order], u[order]
        fresh = np.ones(len(v), bool)
        fresh[1:] = (v[1:] != v[:-1]) | (u[1:] != u[:-1])
        return pa.table({"v": pa.array(v[fresh]), "u": pa.array(u[fresh])})

    return graph.mapInArrow(turn, "bucket int, v binary, u binary, back binary").groupBy("bucket").applyInArrow(choose, "v long, u long")


def with_vectors(pairs: DataFrame, on: str, table: DataFrame, then: str) -> DataFrame:
    """pairs joined with a node table (id, ...) on a column, the rows of each `then` standing together in order."""
    out = sized_join(pairs, table.withColumnRenamed("id", on), on, "inner", "vec")
    return out.repartition(then).sortWithinPartitions(then)


def descend(graph: DataFrame, nodes: DataFrame, buckets: int) -> tuple[DataFrame, DataFrame]:
    """Lists of pairs found closer than the lists' last entries, merged with the lists; and the stored table that they need."""
    last = graph.select("id", F.col("sims")).mapInArrow(_last, "id long, last float")
    known = stored(nodes.join(last, "id").select("id", "vec", "last"), "node-vectors")

    def compare(batches):
        held = None
        for b in batches:
            table = pa.Table.from_batches([b]) if held is None else pa.concat_tables([held, pa.Table.from_batches([b])])
            v = table.column("v").to_numpy()
            cut = int(np.searchsorted(v, v[-1])) if (np.diff(v) >= 0).all() else len(v)
            held = table.slice(cut)
            yield from local(table.slice(0, cut))
        if held is not None and held.num_rows:
            yield from local(held)

    def local(table):
        if not table.num_rows:
            return
        v, u, last_of = table.column("v").to_numpy(), table.column("u").to_numpy(), table.column("last").to_numpy()
        vectors = matrix(table.column("vec"))
        at = np.flatnonzero(np.concatenate([[True], v[1:] != v[:-1]]))
        owners, others, sims = [], [], []
        for i, j in zip(at, np.append(at[1:], len(v))):
            s = vectors[i:j] @ vectors[i:j].T
            np.fill_diagonal(s, -2)
            x, y = np.nonzero(s > last_of[i:j, None])
            owners.append(u[i:j][x])
            others.append(u[i:j][y])
            sims.append(s[x, y])
        found = best(np.concatenate(owners), np.concatenate(others), np.concatenate(sims), NEIGHBOURS)
        yield from as_lists(bucket_of(found[0], buckets), *found).to_batches()

    pairs = pairs_both_ways(graph, buckets)
    found = with_vectors(pairs, "u", known, "v").select("v", "u", "vec", "last").mapInArrow(compare, LISTS)
    return merged(graph.unionByName(found), NEIGHBOURS), known


def _last(batches):
    for b in batches:
        sims = [np.frombuffer(x, np.float32) for x in b.column("sims").to_pylist()]
        yield pa.record_batch({"id": b.column("id"), "last": pa.array([float(s[-1]) if len(s) >= NEIGHBOURS else -2.0 for s in sims], pa.float32())})


def build_graph(nodes: DataFrame, buckets: int, size: int) -> DataFrame:
    graph = stored(first_lists(nodes, buckets, size), "graph")
    for _ in range(ROUNDS):
        after, known = descend(graph, nodes, buckets)
        after = stored(after, "graph")
        release(known)
        both = graph.select("id", F.col("ids").alias("a")).join(after.select("id", F.col("ids").alias("b")), "id")
        changed = both.mapInArrow(_changed, "n long, m long").agg(F.sum("n").alias("n"), F.sum("m").alias("m")).first()
        release(graph)
        graph = after
        if not changed["m"] or changed["n"] < SETTLED * changed["m"]:
            break
    return graph


def _changed(batches):
    for b in batches:
        n = [len(np.setdiff1d(np.frombuffer(y, np.int64), np.frombuffer(x, np.int64))) for x, y in zip(b.column("a").to_pylist(), b.column("b").to_pylist())]
        yield pa.record_batch({"n": pa.array([sum(n)], pa.int64()), "m": pa.array([sum(len(y) // 8 for y in b.column("b").to_pylist())], pa.int64())})


def search(starts: DataFrame, graph: DataFrame, nodes: DataFrame, buckets: int) -> DataFrame:
    """Greedy search of the nodes `starts` (id) in the graph: LISTS of the best found, a node itself included."""
    near = pairs_both_ways(graph, buckets).groupBy("v").agg(F.collect_list("u").alias("near"))
    near = stored(near.withColumnRenamed("v", "u"), "near")
    own = stored(nodes.join(starts, "id"), "queries")
    groups = pieces(own.count(), BUCKET)
    state = stored(own.select("id", F.lit(0).cast("int").alias("bucket")).mapInArrow(_opening(groups), LISTS + ", done binary"), "search")

    while True:  # ends: each step expands nodes that were not, and a beam gives room to closer nodes only
        frontier = stored(state.mapInArrow(_frontier, "q long, u long"), "frontier")
        if frontier.isEmpty():
            break
        met = frontier.join(near, "u").select("q", F.explode("near").alias("u")).distinct()
        scored = sized_join(met, nodes.withColumnRenamed("id", "u"), "u", "inner", "vec").join(own.select(F.col("id").alias("q"), F.col("vec").alias("qvec")), "q")
        found = scored.select("q", "u", "vec", "qvec").mapInArrow(_scores(groups), LISTS)
        after = stored(state.groupBy("bucket").cogroup(found.groupBy("bucket")).applyInArrow(_advance, LISTS + ", done binary"), "search")
        release(state, frontier)
        state = after
    return state


def _opening(groups: int):
    def opening(batches):
        for b in batches:
            ids = b.column("id").to_numpy()
            yield pa.record_batch({"bucket": pa.array(bucket_of(ids, groups)), "id": b.column("id"), "ids": B.blobs([ids[i : i + 1] for i in range(len(ids))]), "sims": B.blobs([np.ones(1, np.float32)] * len(ids)), "done": B.blobs([np.zeros(1, bool)] * len(ids))})

    return opening


def _frontier(batches):
    for b in batches:
        q, u = [], []
        for i, ids, done in zip(b.column("id").to_pylist(), b.column("ids").to_pylist(), b.column("done").to_pylist()):
            open_ = np.frombuffer(ids, np.int64)[~np.frombuffer(done, bool)][:EXPAND]
            q += [i] * len(open_)
            u += open_.tolist()
        yield pa.record_batch({"q": pa.array(q, pa.int64()), "u": pa.array(u, pa.int64())})


def _scores(groups: int):
    def scores(batches):
        for b in batches:
            sim = (matrix(b.column("vec")) * matrix(b.column("qvec"))).sum(axis=1)
            q = b.column("q").to_numpy()
            found = best(q, b.column("u").to_numpy(), sim, 1 << 30)
            yield from as_lists(bucket_of(found[0], groups), *found).to_batches()

    return scores


def _advance(state: pa.Table, found: pa.Table) -> pa.Table:
    owner, other, sim = flat_lists(state)
    done = B.joined(state.column("done"), bool)
    expanded = {}
    for i in state.column("id").to_pylist():
        expanded[i] = set()
    first = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]])) if len(owner) else np.zeros(0, np.int64)
    for a, b in zip(first, np.append(first[1:], len(owner))):
        open_ = other[a:b][~done[a:b]][:EXPAND]
        expanded[owner[a]] = {*other[a:b][done[a:b]].tolist(), *open_.tolist()}
    more = flat_lists(found)
    kept = best(np.concatenate([owner, more[0]]), np.concatenate([other, more[1]]), np.concatenate([sim, more[2]]), BEAM)
    out = as_lists(state.column("bucket")[0].as_py() if state.num_rows else 0, *kept)
    flags = [np.array([x in expanded[i] for x in np.frombuffer(ids, np.int64).tolist()], bool) for i, ids in zip(out.column("id").to_pylist(), out.column("ids").to_pylist())]
    return out.append_column("done", B.blobs(flags))


def _scaled(vectors: np.ndarray) -> np.ndarray:
    """Each vector times a power of two, which is exact and leaves the cosine as it is, so that no square leaves the range."""
    return np.ldexp(vectors, -np.frexp(np.abs(vectors).max(axis=1, keepdims=True))[1])


def nearest(rows: DataFrame, queries: DataFrame, k: int = 5) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest rows of each query (vec_id of a row of rows), itself left out."""
    spark = rows.sparkSession
    result = "query_id long, rank int, vec_id long, score double"
    vectors = usable(rows)
    if vectors.isEmpty():
        return spark.createDataFrame([], result)
    place = F.row_number().over(Window.partitionBy("vector").orderBy("vec_id"))
    members = stored(vectors.join(vectors.groupBy("vector").agg(F.min("vec_id").alias("id")), "vector").select("vec_id", "id"), "members")
    few = stored(vectors.select("vec_id", "vector", place.alias("p")).where(F.col("p") <= k + 1).drop("vector").join(members, "vec_id"), "few-members")
    nodes = vectors.join(members.select("id").distinct().withColumnRenamed("id", "vec_id"), "vec_id").select(F.col("vec_id").alias("id"), "vector")

    def normed(batches):
        for b in batches:
            yield pa.record_batch({"id": b.column("id"), "vec": B.blobs(list(unit(matrix(b.column("vector"), np.float64))))})

    nodes = stored(nodes.mapInArrow(normed, "id long, vec binary"), "nodes")
    size = len(nodes.first()["vec"]) // 4
    buckets = pieces(nodes.count(), BUCKET)
    graph = build_graph(nodes, buckets, size)
    asked = stored(queries.select(F.col("vec_id").cast("long").alias("vec_id")).distinct().join(members, "vec_id"), "asked")
    found = search(asked.select("id").distinct(), graph, nodes, buckets)

    def unpack(batches):
        for b in batches:
            owner, other, sim = best(*flat_lists(b), 3 * k + 1)
            yield pa.record_batch({"id": pa.array(owner), "near": pa.array(other)})

    near = found.mapInArrow(unpack, "id long, near long")
    pairs = asked.withColumnRenamed("vec_id", "query_id").join(near, "id").join(few.select("vec_id", F.col("id").alias("near")), "near").where("vec_id != query_id")
    pairs = pairs.join(vectors.select(F.col("vec_id").alias("query_id"), F.col("vector").alias("x")), "query_id").join(vectors.select("vec_id", F.col("vector").alias("y")), "vec_id")

    def cosine(batches):
        for b in batches:
            x, y = _scaled(matrix(b.column("x"), np.float64)), _scaled(matrix(b.column("y"), np.float64))
            score = (x * y).sum(axis=1) / (np.sqrt((x * x).sum(axis=1)) * np.sqrt((y * y).sum(axis=1)))
            yield pa.record_batch({"query_id": b.column("query_id"), "vec_id": b.column("vec_id"), "score": pa.array(score)})

    scored = pairs.select("query_id", "vec_id", "x", "y").mapInArrow(cosine, "query_id long, vec_id long, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return scored.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def op5_nn_descent(spark, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    return nearest(rows, rows.where("vec_id % 50 = 0"))
