"""Best-fit packing of token pieces into sequences by linear grouping (operator 4).

The plan needs only the histogram of piece lengths, so its cost does not grow with the corpus:
1. large lengths are cut into groups of equal cardinality and rounded up to the longest of their group;
2. the configuration programme over these few sizes is solved by column generation (knapsack over the capacity) and rounded down;
3. actual pieces take the places of the rounded ones, longest first within a group;
4. the pieces left over and the small ones follow by best fit, longest first, into the room that remains.
Sequences with the same content lengths are kept as runs, so a plan is a table of (length, first rank, first sequence, offset).
Spark then ranks the pieces of each length and looks every piece's place up.

Defined cases: a null text is an empty one and yields one piece, its end id; rows with a null or repeated doc_id are packed
like any others; pieces of equal length are interchangeable; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import bisect

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import bytesops as B
from .scratch import keys_join, stored
from .tokens import WordEncoder, crc, default_vocabulary, with_end

CAPACITY = 2048
END_ID = 0
#: Ways to group that are tried until one needs no more sequences than the tokens fill: number of groups; lengths above this
#: share of the capacity are large; configurations are used if their rounded lengths fill at least this share of the capacity.
SETTINGS = ((48, 0.4, 1.0), (48, 0.34, 0.995), (24, 0.5, 0.98), (48, 0.2, 1.0), (48, 0.1, 0.98))
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, task int, nth long"


def cut_pieces(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """One row per piece, with the task that made it and its number among that task's pieces of its length."""

    def cut(batches):
        encoder = WordEncoder.of(vocabulary)
        seen = np.zeros(capacity + 1, np.int64)
        task = TaskContext.get().partitionId()
        for b in B.slices(batches):
            ids, off = with_end(*encoder.encode(*B.raw(b.column("text"))), end_id)
            sizes = np.diff(off)
            n = -(-sizes // capacity)
            row = np.repeat(np.arange(len(n)), n)
            piece = B.ranges(np.zeros(len(n), np.int64), n)
            start = piece * capacity
            length = np.minimum(capacity, sizes[row] - start)
            at = off[row] + start
            order = np.argsort(length, kind="stable")
            nth = np.empty(len(order), np.int64)
            counts = np.bincount(length, minlength=capacity + 1)
            nth[order] = B.ranges(seen[counts > 0], counts[counts > 0])
            seen += counts
            yield pa.record_batch({
                "doc_id": b.column("doc_id").take(pa.array(row)), "piece": pa.array(piece.astype(np.int32)), "start": pa.array(start), "length": pa.array(length),
                "ids_crc32": pa.array([crc(ids[i : i + k]) for i, k in zip(at, length)], pa.int64()), "task": pa.array(np.full(len(row), task, np.int32)), "nth": pa.array(nth),
            })
        encoder.kept.clear()
        B.give_back()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(cut, PIECES)


def configurations(sizes: np.ndarray, demand: np.ndarray, capacity: int, rounds: int = 500) -> list[tuple[np.ndarray, float]]:
    """Column generation for min sum(x), sum(x_j * pattern_j) >= demand, patterns within the capacity."""
    m = len(sizes)
    basis = np.diag(capacity // sizes).astype(float)
    x = np.linalg.solve(basis, demand.astype(float))
    for _ in range(rounds):
        price = np.linalg.solve(basis.T, np.ones(m))
        worth, last = np.zeros(capacity + 1), np.full(capacity + 1, -1)
        useful = np.flatnonzero(price > 1e-12)
        s, p = sizes[useful], price[useful]
        if not len(s):
            break
        for c in range(int(s.min()), capacity + 1):
            k = int(np.searchsorted(s, c, "right"))
            options = worth[c - s[:k]] + p[:k]
            best = int(options.argmax())
            if options[best] > worth[c - 1]:
                worth[c], last[c] = options[best], best
            else:
                worth[c] = worth[c - 1]
        if worth[capacity] <= 1 + 1e-5:
            break
        column, c = np.zeros(m), capacity
        while c > 0:
            if last[c] < 0 or worth[c] == worth[c - 1]:
                c -= 1
                continue
            column[useful[last[c]]] += 1
            c -= s[last[c]]
        move = np.linalg.solve(basis, column)
        open_ = move > 1e-9
        if not open_.any():
            break
        step = np.where(open_, x / np.where(open_, move, 1), np.inf)
        out = int(step.argmin())
        x = np.maximum(0, x - move * step[out])
        x[out] = step[out]
        basis[:, out] = column
    return [(basis[:, j].astype(int), float(x[j])) for j in np.argsort(-x) if x[j] >= 1]


class Plan:
    """Places for counts[length] pieces of each length: `moves` of (length, first rank, count, first sequence, offset)."""

    def __init__(self, counts: np.ndarray, capacity: int, groups: int, large: float, full: float):
        self.full = full
        self.capacity, self.sequences, self.moves = capacity, 0, []
        self.left = counts.astype(np.int64).copy()
        self.rank = np.zeros(capacity + 1, np.int64)
        self.room: dict[int, list[tuple[int, int]]] = {}  # by free room: runs of sequences
        self.rooms: list[int] = []
        self._grouped(groups, int(capacity * large))
        for length in range(capacity, 0, -1):
            self._best_fit(length)

    def _take(self, length: int, count: int, first: int, offset: int) -> None:
        self.moves.append((length, int(self.rank[length]), count, first, offset))
        self.rank[length] += count
        self.left[length] -= count

    def _open(self, room: int, run: tuple[int, int]) -> None:
        if room not in self.room:
            self.room[room] = []
            bisect.insort(self.rooms, room)
        self.room[room].append(run)

    def _grouped(self, groups: int, above: int) -> None:
        lengths = np.flatnonzero(self.left[: self.capacity])  # full pieces need no plan
        lengths = lengths[lengths > above]
        total = int(self.left[lengths].sum())
        if not total:
            return
        number = np.minimum(groups - 1, (np.cumsum(self.left[lengths]) - 1) * groups // total)
        members = [lengths[number == g][::-1] for g in np.unique(number)]
        sizes = np.array([g[0] for g in members])
        demand = np.array([self.left[g].sum() for g in members])
        for pattern, x in configurations(sizes, demand, self.capacity):
            if pattern @ sizes < self.full * self.capacity:
                continue
            runs = [(self.sequences, int(x), 0)]
            self.sequences += int(x)
            for g in np.flatnonzero(pattern)[::-1]:
                for _ in range(pattern[g]):
                    after = []
                    for first, count, used in runs:
                        for length in members[g]:
                            n = int(min(count, self.left[length]))
                            if n:
                                self._take(int(length), n, first, used)
                                after.append((first, n, used + int(length)))
                                first, count = first + n, count - n
                            if not count:
                                break
                        if count:
                            after.append((first, count, used))
                    runs = after
            for first, count, used in runs:
                self._open(self.capacity - used, (first, count))

    def _best_fit(self, length: int) -> None:
        while self.left[length]:
            at = bisect.bisect_left(self.rooms, length)
            if at == len(self.rooms):
                fresh = int(-(-self.left[length] // (self.capacity // length)))
                self._open(self.capacity, (self.sequences, fresh))
                self.sequences += fresh
                continue
            room = self.rooms[at]
            first, count = self.room[room].pop()
            n = int(min(count, self.left[length]))
            if n < count:
                self.room[room].append((first + n, count - n))
            if not self.room[room]:
                del self.room[room]
                self.rooms.pop(at)
            self._take(length, n, first, self.capacity - room)
            if room > length:
                self._open(room - length, (first, n))

    def table(self) -> np.ndarray:
        return np.array(sorted(self.moves), np.int64).reshape(-1, 5)


def best_plan(counts: np.ndarray, capacity: int = CAPACITY) -> Plan:
    """The plan of the fewest sequences among those of SETTINGS."""
    least, best = -(-int(counts @ np.arange(len(counts))) // capacity), None
    for setting in SETTINGS:
        plan = Plan(counts, capacity, *setting)
        if best is None or plan.sequences < best.sequences:
            best = plan
        if best.sequences == least:
            break
    return best


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Give every piece of a stored piece table its sequence_id and offset."""
    per = pieces.groupBy("task", "length").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1))
    per = stored(per.select("task", "length", "n", F.coalesce(before, F.lit(0)).alias("before")), "packing-ranks")
    counts = np.zeros(capacity + 1, np.int64)
    for r in per.groupBy("length").agg(F.sum("n").alias("n")).collect():  # at most `capacity` rows
        counts[r["length"]] = r["n"]
    table = best_plan(counts, capacity).table()
    shared = pieces.sparkSession.sparkContext.broadcast(table)  # as many rows as the histogram needs, whatever the corpus
    names = [c for c in pieces.columns if c not in ("task", "nth")]

    def place(batches):
        t = shared.value
        keys = t[:, 0] << 44 | t[:, 1]
        for b in batches:
            length, rank = b.column("length").to_numpy(), b.column("rank").to_numpy()
            k = np.searchsorted(keys, length << 44 | rank, "right") - 1
            yield pa.record_batch({n: b.column(n) for n in names} | {"sequence_id": pa.array(t[k, 3] + rank - t[k, 1]), "offset": pa.array(t[k, 4])})

    ranked = keys_join(pieces, per.drop("n"), ["task", "length"], "inner").select(*names, (F.col("before") + F.col("nth")).alias("rank"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.select(*names).schema)
    return ranked.mapInArrow(place, f"{schema}, sequence_id long, offset long")


def pack_documents(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    return pack(stored(cut_pieces(docs, vocabulary or default_vocabulary()), "pieces"))


def op4_packing(spark, sf_dir: str) -> DataFrame:
    return pack_documents(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
