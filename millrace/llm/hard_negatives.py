"""Hard negatives by bit-sliced integer products (operator 13).

Components become the integers floor(256 * x). A block of candidates is held as bit planes: component c is -2**m + sum of 2**b times
bit b. An anchor's product with the planes, most significant first, gives its scores up to an interval that the planes not yet read
leave open: (2**b - 1) times the sum of the anchor's negative components to the same times that of its positive ones. A pair is
dropped once its interval cannot qualify; while many pairs are left a plane is one matrix product, later one row product a pair.
All sums are integers, held where they are exact (float32, float64, or Python integers for huge components).

1. Rows of the same vector and label become one candidate with its smallest vec_ids, as many as a list can take.
2. Anchors, GROUP_BYTES of them a pass, are broadcast to the candidate blocks; each task keeps its best lists and sends only these.
3. First pass: rows of the anchor's label, at least as good as its k-th best so far. Second: rows of other labels whose interval meets
   a positive's range [80 %, 100 %], at least as good as the k-th best of that range so far.

Defined cases: rows with a null vec_id, label or vector, or a null or non-finite component take no part; repeated vec_ids count
once, with the smallest label, then vector; only vectors of the same size meet; equal scores are ordered by vec_id; an anchor
without positives, and a positive without negatives, has no rows; an empty table gives no rows; extra columns are ignored. A
component or score that passes 64 bits is an error, as in SQL.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import bytesops as B
from .scratch import pieces, release, stored

POSITIVES, NEGATIVES, LOW, HIGH = 5, 5, 80, 100
#: Candidates and anchors of a block; bytes of the anchors of a pass.
BLOCK, ANCHORS, GROUP_BYTES = 4096, 512, 8 << 20
#: Share of pairs under which pairs are followed one by one, and how many of them at once.
SPARSE, PAIRS = 0.1, 1 << 15
BLOCKS = "dim int, place long, width int, vectors binary, labels binary, counts binary, ids binary, scores binary"


def usable(rows: DataFrame, turned: int | None = 7, labels: int = 10) -> DataFrame:
    """(vec_id, label, dim, vector) of the rows that take part; where vec_id is divisible by `turned` the label is the next one."""
    x = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), F.col("embedding").cast("array<double>").alias("v"))
    x = x.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull() & ~F.exists("v", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf"))))
    if turned:
        x = x.withColumn("label", F.when(F.col("vec_id") % turned == 0, (F.col("label") + 1) % labels).otherwise(F.col("label")))

    def packed(batches):
        for b in batches:
            v = b.column("v")
            dim = np.diff(v.offsets.to_numpy())
            flat = np.floor(256 * np.asarray(v.flatten().to_numpy(zero_copy_only=False), np.float64))
            if len(flat) and np.abs(flat).max() >= 2.0**63:
                raise OverflowError("a component passes 64 bits")
            ends = np.concatenate([[0], np.cumsum(dim)])
            yield pa.record_batch({"vec_id": b.column("vec_id"), "label": b.column("label"), "dim": pa.array(dim.astype(np.int32)), "vector": B.blobs([narrow(flat[i:j].astype(np.int64)) for i, j in zip(ends[:-1], ends[1:])])})

    return x.mapInArrow(packed, "vec_id long, label long, dim int, vector binary").groupBy("vec_id").agg(F.min(F.struct("label", "dim", "vector")).alias("row")).select("vec_id", "row.*")


def narrow(v: np.ndarray) -> np.ndarray:
    """The same integers in the fewest bytes; equal vectors give equal bytes."""
    most = max(int(v.max()), -1 - int(v.min())) if len(v) else 0
    return v.astype(np.int16 if most < 1 << 15 else np.int32 if most < 1 << 31 else np.int64)


def candidates(rows: DataFrame, keep: int) -> DataFrame:
    """Stored blocks of distinct (vector, label), each with its `keep` smallest vec_ids; of copies each task sends on no more than `keep`."""
    near = rows.withColumn("rank", F.row_number().over(Window.partitionBy("dim", "vector", "label").orderBy("vec_id"))).where(F.col("rank") <= keep)
    nodes = near.groupBy("dim", "vector", "label").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    return stored(nodes.coalesce(pieces(rows.count(), BLOCK, 8)).mapInArrow(lambda batches: _blocks(batches, BLOCK), BLOCKS), "candidate-blocks")


def anchor_blocks(anchors: DataFrame) -> DataFrame:
    """Stored blocks of anchors (vec_id, label, dim, vector, ids, scores); ids: the vec_id, once for each score if there are any.
    The high half of place is the pass."""
    size = anchors.agg(F.sum(F.octet_length("vector") + 64).alias("b")).first()["b"] or 0
    rows = anchors.repartition(pieces(size, GROUP_BYTES))
    return stored(rows.mapInArrow(lambda batches: _blocks(batches, ANCHORS), BLOCKS), "anchor-blocks")


def _blocks(batches, most: int):
    """Rows of one size in blocks of at most `most`, in order of labels."""
    held: dict[int, list[dict]] = {}
    place, n = TaskContext.get().partitionId(), 0

    def block(dim, rows):
        rows.sort(key=lambda r: r["label"])
        vectors = np.stack([np.frombuffer(r["vector"], f"i{len(r['vector']) // max(1, dim) or 2}").astype(np.int64) for r in rows])
        v = narrow(vectors.reshape(-1))
        return pa.record_batch({
            "dim": pa.array([dim], pa.int32()), "place": pa.array([place << 32 | n], pa.int64()), "width": pa.array([v.itemsize], pa.int32()), "vectors": B.blobs([v]), "labels": B.blobs([np.array([r["label"] for r in rows], np.int64)]),
            "counts": B.blobs([np.array([len(r["ids"]) for r in rows], np.int32)]), "ids": B.blobs([np.array([i for r in rows for i in r["ids"]], np.int64)]), "scores": B.blobs([np.array([s for r in rows for s in r.get("scores") or ()], np.int64)]),
        })

    for b in batches:
        for r in b.to_pylist():
            group = held.setdefault(r["dim"], [])
            group.append(r)
            if len(group) == most:
                yield block(r["dim"], held.pop(r["dim"]))
                n += 1
    for dim, rows in held.items():
        yield block(dim, rows)
        n += 1


class Block:
    def __init__(self, row: dict, side: str):
        self.labels = np.frombuffer(row[f"{side}_labels"], np.int64)
        self.vectors = np.frombuffer(row[f"{side}_vectors"], f"i{row[f'{side}_width']}").reshape(len(self.labels), row["dim"]).astype(np.int64)
        self.counts = np.frombuffer(row[f"{side}_counts"], np.int32).astype(np.int64)
        self.ids = np.frombuffer(row[f"{side}_ids"], np.int64)
        self.first = np.cumsum(self.counts) - self.counts
        self.scores = np.frombuffer(row[f"{side}_scores"], np.int64)


def sliced(anchors: np.ndarray, others: np.ndarray, dense, sparse) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, column, score) of the pairs that neither dense(low, high) on whole tables of intervals nor sparse(row, low, high) on
    single pairs has dropped after any bit plane."""
    m = 0 if not others.size else max(int(others.max()).bit_length(), (-1 - int(others.min())).bit_length() if others.min() < 0 else 0)
    bound = np.abs(anchors.astype(np.float64)).sum(axis=1).max(initial=0) * 2.0 ** (m + 2)
    kind = np.float32 if bound < 1 << 24 else np.float64 if bound < 1 << 53 else object
    a = anchors.astype(kind)
    up, down = np.maximum(a, 0).sum(axis=1), np.minimum(a, 0).sum(axis=1)
    two = 2 if kind is object else kind(2)
    others = others.astype(object) if kind is object else others
    shifted = others + (1 << m)
    total = np.repeat((a.sum(axis=1) * -(two**m))[:, None], len(others), axis=1)
    alive = np.ones(total.shape, bool)
    b = m
    while b >= 0:
        total += (a @ ((shifted >> b) & 1).astype(kind).T) * two**b
        rest = two**b - 1
        alive &= dense(total + (rest * down)[:, None], total + (rest * up)[:, None])
        b -= 1
        if alive.sum() <= SPARSE * alive.size:
            break
    row, col = np.nonzero(alive)
    score = total[row, col]
    del total, alive
    while b >= 0 and len(row):
        for i in range(0, len(row), PAIRS):
            part = slice(i, i + PAIRS)
            score[part] += (a[row[part]] * ((shifted[col[part]] >> b) & 1).astype(kind)).sum(axis=1) * two**b
        rest = two**b - 1
        keep = sparse(row, score + rest * down[row], score + rest * up[row])
        row, col, score = row[keep], col[keep], score[keep]
        b -= 1
    if kind is object and len(score) and not -(1 << 63) <= min(score) <= max(score) < 1 << 63:
        raise OverflowError("a score passes 64 bits")
    return row, col, score.astype(np.int64)


def first_k(key: np.ndarray, ids: np.ndarray, score: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each key the k highest scores, ties by smaller ids, in order."""
    order = np.lexsort((ids, -score, key))
    key, ids, score = key[order], ids[order], score[order]
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
    keep = np.arange(len(key)) - np.repeat(first, np.diff(np.append(first, len(key)))) < k
    return key[keep], ids[keep], score[keep]


def kth(key: np.ndarray, score: np.ndarray, k: int, n: int) -> np.ndarray:
    """The k-th highest score of each key 0 .. n-1, minus infinity where there are fewer."""
    out = np.full(n, -np.inf, object if len(score) and np.abs(score).max() >= 1 << 53 else np.float64)
    key, _, score = first_k(key, np.zeros(len(key), np.int8), score, k)
    last = np.concatenate([key[1:] != key[:-1], [True]]) if len(key) else np.zeros(0, bool)
    full = last & (np.bincount(key, minlength=n)[key] == k) if len(key) else last
    out[key[full]] = score[full].astype(out.dtype)
    return out


class Lists:
    """The best lists of an anchor block so far: key, vec_id, score."""

    def __init__(self, keys: int, k: int):
        self.keys, self.k = keys, k
        self.key = self.ids = self.score = np.zeros(0, np.int64)

    def least(self) -> np.ndarray:
        return kth(self.key, self.score, self.k, self.keys)

    def add(self, key, ids, score) -> None:
        self.key, self.ids, self.score = first_k(*(np.concatenate(x) for x in ((self.key, key), (self.ids, ids), (self.score, score))), self.k)


def expanded(other: Block, row, col, score) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs with every vec_id of their candidates."""
    n = other.counts[col]
    return np.repeat(row, n), other.ids[B.ranges(other.first[col], n)], np.repeat(score, n)


def find_positives(anchor: Block, other: Block, lists: Lists) -> None:
    k = lists.k
    for label in np.intersect1d(anchor.labels, other.labels):
        mine, theirs = (slice(np.searchsorted(x.labels, label), np.searchsorted(x.labels, label, "right")) for x in (anchor, other))
        least = lists.least()[mine]

        def dense(low, high):
            nonlocal least
            if low.shape[1] > k and low.dtype != object:  # one of the best k + 1 may be the anchor itself
                least = np.maximum(least, np.partition(low, -(k + 1), axis=1)[:, -(k + 1)])
            return high >= least[:, None]

        row, col, score = sliced(anchor.vectors[mine], other.vectors[theirs], dense, lambda row, low, high: high >= least[row])
        row, ids, score = expanded(other, row + mine.start, col + theirs.start, score)
        fine = ids != anchor.ids[row]
        lists.add(row[fine], ids[fine], score[fine])


def find_negatives(anchor: Block, other: Block, lists: Lists, low_share: int, high_share: int) -> None:
    """Keys of lists: an anchor's row and the place of a positive's score among its scores."""
    n = len(anchor.labels)
    wide = lists.keys // n
    scores = anchor.scores.tolist()
    kind = object if max(map(abs, scores), default=0) >= 1 << 53 else np.float64
    ceiling, floor = np.full((n, wide), -np.inf, kind), np.full((n, wide), np.inf, kind)
    who, at = np.repeat(np.arange(n), anchor.counts), B.ranges(np.zeros(n, np.int64), anchor.counts)
    ceiling[who, at] = [s * high_share // 100 for s in scores]
    floor[who, at] = [-(-s * low_share // 100) for s in scores]
    need = np.maximum(floor, lists.least().reshape(n, wide))
    lowest, highest = need.min(axis=1), ceiling.max(axis=1)
    same = anchor.labels[:, None] == other.labels[None, :]

    def dense(low, high):
        return (high >= lowest[:, None]) & (low <= highest[:, None]) & ~same

    def sparse(row, low, high):
        keep = np.zeros(len(row), bool)
        for j in range(wide):
            sure = (low >= floor[row, j]) & (high <= ceiling[row, j])
            if low.dtype != object:
                need[:, j] = np.maximum(need[:, j], kth(row[sure], low[sure], lists.k, n))
            keep |= (high >= need[row, j]) & (low <= ceiling[row, j])
        return keep

    row, ids, score = expanded(other, *sliced(anchor.vectors, other.vectors, dense, sparse))
    for j in range(wide):
        fine = (score >= floor[row, j]) & (score <= ceiling[row, j])
        lists.add(row[fine] * wide + j, ids[fine], score[fine])


def best_lists(blocks: DataFrame, anchors: DataFrame, kind: str, k: int, wide: int, shares: tuple[int, int] = (LOW, HIGH)) -> DataFrame:
    """Stored (anchor_id, positive_score, vec_id, score): each task's best lists of every anchor, one pass a group of anchors."""
    named = lambda df, side: df.select("dim", *[F.col(c).alias(f"{side}_{c}") for c in df.columns if c != "dim"])
    last = anchors.agg(F.max(F.shiftright("place", 32))).first()[0]

    def score(batches):
        found: dict[int, tuple[Block, Lists]] = {}
        for b in batches:
            for i in range(b.num_rows):
                row = b.slice(i, 1).to_pylist()[0]
                if row["a_place"] not in found:
                    made = Block(row, "a")
                    found[row["a_place"]] = made, Lists(len(made.labels) * wide, k)
                anchor, lists = found[row["a_place"]]
                if kind == "positives":
                    find_positives(anchor, Block(row, "c"), lists)
                else:
                    find_negatives(anchor, Block(row, "c"), lists, *shares)
        for anchor, lists in found.values():
            at = lists.key // wide
            if kind == "positives":
                who, of = anchor.ids[at], pa.nulls(len(at), pa.int64())
            else:  # ids of an anchor of the second pass stand once a score
                who, of = anchor.ids[anchor.first[at]], pa.array(anchor.scores[anchor.first[at] + lists.key % wide])
            yield pa.record_batch({"anchor_id": pa.array(who), "positive_score": of, "vec_id": pa.array(lists.ids), "score": pa.array(lists.score)})
        B.give_back()

    out = None
    for p in range(0 if last is None else last + 1):
        group = F.broadcast(named(anchors.where(F.shiftright("place", 32) == p), "a"))
        part = stored(named(blocks, "c").join(group, "dim").mapInArrow(score, "anchor_id long, positive_score long, vec_id long, score long"), kind)
        out = part if out is None else out.unionByName(part)
    return out


def mine_negatives(rows: DataFrame, positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH, every: int = 100, turned: int | None = 7) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score."""
    used = stored(usable(rows, turned), "vectors")
    blocks = candidates(used, max(positives + 1, negatives))
    anchors = used.where(F.col("vec_id") % every == 0)
    ranked = lambda df, *keys: df.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("score"), "vec_id")))
    none = rows.sparkSession.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    first = anchor_blocks(anchors.withColumn("ids", F.array("vec_id")).withColumn("scores", F.lit(None).cast("array<long>")))
    found = best_lists(blocks, first, "positives", positives, 1)
    if found is None:
        return none
    near = stored(ranked(found, "anchor_id").where(F.col("rank") <= positives).select("anchor_id", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")), "positives")
    scores = near.groupBy(F.col("anchor_id").alias("vec_id")).agg(F.sort_array(F.collect_set("positive_score"), asc=False).alias("scores"))
    second = anchors.join(scores, "vec_id").withColumn("ids", F.transform("scores", lambda _: F.col("vec_id")))
    found = best_lists(blocks, anchor_blocks(second), "negatives", negatives, positives, (low, high))
    if found is None:
        return none
    hard = ranked(found, "anchor_id", "positive_score").where(F.col("rank") <= negatives)
    return near.join(hard, ["anchor_id", "positive_score"]).select("anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mine_negatives(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
