"""Curation: examples from documents, drops with reasons, flags, caps and reports.

Operators take and return DataFrames of examples (seq, id, source, origin, instruction, response).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions import fixed
from millrace.functions import text as T

from .scratch import kept


def examples(documents: DataFrame) -> DataFrame:
    return documents.select(
        F.col("doc_id").alias("seq"), F.col("doc_id").alias("id"), "source", F.concat_ws("/", "source", F.col("doc_id").cast("string")).alias("origin"), F.lit("").alias("instruction"), F.coalesce("text", F.lit("")).alias("response")
    )


def with_reason(rows: DataFrame, least: int = fixed.MIN_CHARS) -> DataFrame:
    """seq, id, source, origin, chars, tokens and `reason`: short, duplicate (a later copy of one that is not short), or null.

    Lengths and the key's hash are taken where the text is read; no text is shuffled. First copies are a grouped minimum, so that
    a key that very many rows share is summed up within tasks first. Of rows of one key the first by seq, then id, source and origin
    stays (nulls first); of rows that are the same in all of these one stays. A null instruction or response is empty."""
    empty = lambda c: F.coalesce(F.col(c), F.lit(""))
    chars = F.length(empty("instruction")) + F.length(empty("response"))
    names = ["seq", "id", "source", "origin"]
    slim = rows.select(*names, chars.alias("chars"), F.floor(chars / 4).cast("long").alias("tokens"), F.sha2(T.dedup_key(empty("instruction"), empty("response")), 256).alias("key"))
    slim = slim.groupBy(*names, "chars", "tokens", "key").agg(F.count(F.lit(1)).alias("copies"))  # rows that nothing tells apart
    first = slim.where(F.col("chars") >= least).groupBy("key").agg(F.min(F.struct(*names)).alias("first"))
    slim = slim.join(first, "key", "left").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    stays = (F.col("copy") == 1) & F.struct(*names).eqNullSafe(F.col("first"))
    return slim.withColumn("reason", F.when(F.col("chars") < least, "short").when(~stays, "duplicate")).select(*names, "chars", "tokens", "reason")


def source_report(kept: DataFrame) -> DataFrame:
    """Examples, estimated tokens and long examples per source, and in total."""
    out = kept.rollup("source").agg(F.count(F.lit(1)).alias("examples"), F.sum("tokens").alias("tokens"), F.count_if(F.col("tokens") > fixed.LONG_TOKENS).alias("long_examples"), F.grouping("source").alias("g"))
    return out.select(F.when(F.col("g") == 1, "total").otherwise(F.col("source")).alias("source"), "examples", "tokens", "long_examples")


def skip_report(dropped: DataFrame) -> DataFrame:
    """Drops per reason, all reasons named, with zeros."""
    reasons = dropped.sparkSession.createDataFrame([(i, r) for i, r in enumerate(fixed.SKIP_REASONS)], "position int, reason string")
    counts = dropped.groupBy("reason").agg(F.count(F.lit(1)).alias("k"))
    return F.broadcast(reasons).join(counts, "reason", "left").select("position", "reason", F.coalesce("k", F.lit(0)).alias("n"))


def separate_flagged(rows: DataFrame, flags: DataFrame) -> DataFrame:
    """Adds `flagged`: the example's id has a reviewed flag."""
    marks = flags.select("id").distinct().withColumn("flagged", F.lit(True))
    return rows.join(marks, "id", "left").withColumn("flagged", F.coalesce("flagged", F.lit(False)))


def first_per_group(rows: DataFrame, group: str, order: list, k: int) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy(group).orderBy(*order))
    return rows.withColumn("rank", rank).where(F.col("rank") <= k)


#: Undecided rows of a group that one task folds; of a group with more, rounds decide until it has no more than these.
FOLD = 200_000
#: Rows that a block of a round stands for.
BLOCK = 1 << 16
_END = (1 << 63) - 1


def in_line(rows: DataFrame, *order, parts: int | None = None) -> DataFrame:
    """rows, stored, with `__pos`: numbers that ascend in the order (nulls first, then by all columns), split wherever there are many."""
    by = [F.col(c).asc_nulls_first() for c in order] + [F.xxhash64(*rows.columns)]
    ranged = rows.repartitionByRange(parts, *by) if parts else rows.repartitionByRange(*by)
    return kept(ranged.sortWithinPartitions(*by).withColumn("__pos", F.monotonically_increasing_id()), "line")


def capped(rows: DataFrame, group: str, order: str, size: str, cap: int, fold_rows: int = FOLD, block: int = BLOCK) -> DataFrame:
    """Greedy cap: in order, a row that does not fit is skipped and later ones still tried.

    Rows are put in line by (group, order) once; groups within the cap stay as they are. A group over it has some room. Of its undecided
    rows those that are no larger than the room are taken up to the first that no longer fits: found by sums of blocks, and by single
    rows in the one block where the sum passes the room. That row is skipped, and the next round goes on behind it with the smaller room.
    Once a group has at most `fold_rows` undecided rows that could fit, one task ends it.

    Defined cases: a null group is a group; a null size is 0 and sizes are not negative; rows of one (group, order) are tried one by one,
    smaller ones first; an empty table gives no rows."""
    line = in_line(rows.withColumn("__size", F.coalesce(F.col(size).cast("long"), F.lit(0))), group, order, "__size")
    over = line.groupBy(F.col(group).alias("__g")).agg(F.sum("__size").alias("all"), F.min("__pos").alias("gid"), F.max("__pos").alias("last")).where(F.col("all") > cap)
    over = kept(over.select("__g", "gid"), "over")
    if over.isEmpty():
        return line.drop("__pos", "__size")
    work = kept(line.join(over, F.col(group).eqNullSafe(F.col("__g"))).select("gid", F.col("__pos").alias("pos"), F.col("__size").alias("size")), "work")
    state = kept(over.select("gid", F.lit(-1).cast("long").alias("after"), F.lit(cap).cast("long").alias("room")), "state")
    taken = None
    ordered = Window.partitionBy("gid").orderBy("at")

    def also(found: DataFrame) -> DataFrame:
        return found if taken is None else taken.unionByName(found)

    while not state.isEmpty():
        left = work.join(state, "gid").where((F.col("pos") > F.col("after")) & (F.col("size") <= F.col("room")))
        many = kept(left.groupBy("gid").agg(F.count(F.lit(1)).alias("n")), "left")
        few = left.join(many.where(F.col("n") <= fold_rows), "gid", "left_semi")
        taken = also(kept(few.groupBy("gid").applyInArrow(_folded, "gid long, first long, last long, most long"), "taken"))
        left = left.join(many.where(F.col("n") > fold_rows), "gid", "left_semi").withColumn("at", F.floor(F.col("pos") / block))
        sums = left.groupBy("gid", "at").agg(F.sum("size").alias("sum"), F.max("room").alias("room")).withColumn("so_far", F.sum("sum").over(ordered))
        passed = sums.where(F.col("so_far") > F.col("room")).groupBy("gid").agg(F.min(F.struct("at", (F.col("so_far") - F.col("sum")).alias("before"))).alias("b")).select("gid", "b.*")
        inner = left.join(passed, ["gid", "at"]).withColumn("so_far", F.col("before") + F.sum("size").over(Window.partitionBy("gid").orderBy("pos")))
        stop = inner.where(F.col("so_far") > F.col("room")).groupBy("gid").agg(F.min(F.struct("pos", (F.col("so_far") - F.col("size")).alias("used"))).alias("s"))
        ended = kept(state.join(many.where(F.col("n") > fold_rows), "gid", "left_semi").join(stop, "gid", "left").select("gid", F.col("after").alias("first"), F.coalesce("s.pos", F.lit(_END)).alias("last"), F.col("room").alias("most"), "s.used"), "round")
        taken = also(ended.drop("used"))
        state = kept(ended.where(F.col("used").isNotNull()).select("gid", F.col("last").alias("after"), (F.col("most") - F.col("used")).alias("room")), "state")
    rounds = taken.groupBy("gid").agg(F.collect_list(F.struct("first", "last", "most")).alias("rounds"))
    fits = F.exists("rounds", lambda r: (F.col("pos") > r["first"]) & (F.col("pos") < r["last"]) & (F.col("size") <= r["most"]))
    skipped = work.join(rounds, "gid", "left").where(~F.coalesce(fits, F.lit(False))).select(F.col("pos").alias("__pos"))
    return line.join(skipped, "__pos", "left_anti").drop("__pos", "__size")


def _folded(rows: pa.Table) -> pa.Table:
    """Of one group's undecided rows: the stretches (first, last) in which what is no larger than `most` is taken."""
    rows = rows.sort_by("pos")
    pos, sizes = rows.column("pos").to_numpy(), rows.column("size").to_numpy()
    after, room, out = int(rows.column("after")[0].as_py()), int(rows.column("room")[0].as_py()), []
    i = 0
    while i < len(pos):
        fits = np.flatnonzero(sizes[i:] <= room) + i
        sums = np.cumsum(sizes[fits])
        n = int(np.searchsorted(sums, room, "right"))
        last = int(pos[fits[n]]) if n < len(fits) else _END
        out.append((after, last, room))
        room -= int(sums[n - 1]) if n else 0
        after, i = last, int(fits[n]) + 1 if n < len(fits) else len(pos)
    first, last, most = zip(*out)
    return pa.table({"gid": pa.array([rows.column("gid")[0].as_py()] * len(out), pa.int64()), "first": pa.array(first, pa.int64()), "last": pa.array(last, pa.int64()), "most": pa.array(most, pa.int64())})


def runs(rows: DataFrame, value: str, order: str, block: int = BLOCK) -> DataFrame:
    """Numbers runs of equal values in order (gaps and islands): `run` from 1, `place` from 0.

    Rows are put in line, about `block` of them a range; ranges are looked at side by side, and only what each begins and ends with is put
    in one row of ranges. Defined cases: rows without a place come first; rows of one place are ordered by all their columns; a null
    value is a value like others; an empty table gives no rows."""
    names = rows.columns
    line = in_line(rows, order, value, parts=max(1, -(-rows.count() // block)))
    rows = line.withColumn("__b", F.shiftright("__pos", 33)).withColumn("__at", F.col("__pos").bitwiseAND((1 << 33) - 1) + 1)
    w = Window.partitionBy("__b").orderBy("__pos")
    rows = rows.withColumn("__before", F.lag(value).over(w))
    ends = rows.groupBy("__b").agg(F.max_by(F.struct(value), "__pos").alias("last"), F.count(F.lit(1)).alias("n"))
    line = Window.partitionBy().orderBy("__b")
    ends = ends.select("__b", F.lag("last").over(line).alias("__last"), (F.coalesce(F.sum("n").over(line), F.lit(0)) - F.col("n")).alias("__rows"))
    rows = rows.join(ends, "__b")
    change = F.when(F.col("__at") > 1, ~F.col("__before").eqNullSafe(F.col(value))).otherwise(F.col("__last").isNull() | ~F.col("__last")[value].eqNullSafe(F.col(value)))
    rows = rows.withColumn("__change", change).withColumn("__number", F.col("__rows") + F.col("__at"))
    rows = rows.withColumns({"__runs": F.sum(F.col("__change").cast("long")).over(w), "__start": F.max(F.when(F.col("__change"), F.col("__number"))).over(w)})
    sums = rows.groupBy("__b").agg(F.max("__runs").alias("r"), F.max("__start").alias("s"))
    before = line.rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("__b", F.coalesce(F.sum("r").over(before), F.lit(0)).alias("__base"), F.max("s").over(before).alias("__earlier"))
    rows = rows.join(sums, "__b")
    return rows.select(*names, (F.col("__base") + F.col("__runs")).alias("run"), (F.col("__number") - F.coalesce("__start", "__earlier")).alias("place"))


def teachable(rows: DataFrame, chars: int = 800, excluded: list[str] | None = None) -> DataFrame:
    name = F.lower(F.element_at(F.split("origin", "/"), -1))
    fine: Column = (F.length("response") >= chars) & ~T.any_of(name, fixed.PAPERWORK)
    return rows.where(fine & ~F.col("source").isin(excluded or []))
