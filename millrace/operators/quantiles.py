"""Exact quantiles of groups of any size: the value of a rank is found by counting in ranges that narrow round by round.

A round cuts each open range into BINS parts of equal width and counts the rows of each, with its least and greatest value; the part that
holds the rank is the next range, from its least to its greatest value. A range of one value is an answer, and so no group's values are
ever held together: tasks hold counts of parts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .scratch import kept

BINS = 256
#: Open ranks up to which they are sent to where the rows lie.
_FEW = 100_000


def _near(state: DataFrame) -> DataFrame:
    return F.broadcast(state) if state.count() <= _FEW else state


def _part(value: Column, low: Column, high: Column) -> Column:
    """The part of [low, high] in which a value lies; halves first, so that no difference passes the largest double."""
    width = high / 2 - low / 2
    return F.when(width > 0, F.least(F.lit(BINS - 1), F.floor((value / 2 - low / 2) / width * BINS).cast("int"))).otherwise(F.when(value > low, BINS - 1).otherwise(0))


def quantiles(rows: DataFrame, groups: list[str], value: str, shares: dict[str, float]) -> DataFrame:
    """groups, n, and a column by name for each share (0 to 1) with the interpolated quantile of a numeric column.

    Defined cases: null values are left out (a group without any has n = 0 and null quantiles), NaN is greater than all numbers, a null
    group is a group, an empty table gives no rows (without groups one row of nulls)."""
    slim = rows.select(*groups, F.col(value).cast("double").alias("__v"))
    ends = slim.groupBy(*groups).agg(F.count("__v").alias("__n"), F.count_if(F.isnan("__v")).alias("__nans"), F.min("__v").alias("__low"), F.max(F.when(~F.isnan("__v"), F.col("__v"))).alias("__high"))
    ends = kept(ends.withColumn("__g", F.monotonically_increasing_id()), "ends")
    at = {name: F.greatest(F.lit(0), F.col("__n") - 1) * F.lit(share) for name, share in shares.items()}
    ranks = F.array_distinct(F.flatten(F.array(*[F.array(F.floor(x), F.ceil(x)) for x in at.values()])))
    numbers = slim.where(F.col("__v").isNotNull() & ~F.isnan("__v"))
    named = lambda df: numbers.join(df, _same(groups, numbers, df)) if groups else numbers.crossJoin(df)
    whole = ends.where(F.col("__n") > F.col("__nans")).select("__g", *[F.col(c).alias(f"__by_{c}") for c in groups], "__low", "__high")
    first = named(_near(whole)).select("__g", "__v", _part(F.col("__v"), F.col("__low"), F.col("__high")).alias("__part"))
    counts = kept(first.groupBy("__g", "__part").agg(F.count(F.lit(1)).alias("__k"), F.min("__v").alias("__least"), F.max("__v").alias("__most")), "parts")
    open_ = ends.select("__g", *[F.col(c).alias(f"__by_{c}") for c in groups], (F.col("__n") - F.col("__nans")).alias("__m"), F.explode(ranks).alias("__rank")).where("__rank < __m").drop("__m").withColumn("__before", F.lit(0).cast("long"))
    found = None
    by = ["__g"]
    while True:
        below = F.coalesce(F.sum("__k").over(Window.partitionBy(*by).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        at_parts = counts.withColumn("__below", below)
        state = open_.join(at_parts, by).where((F.col("__rank") >= F.col("__before") + F.col("__below")) & (F.col("__rank") < F.col("__before") + F.col("__below") + F.col("__k")))
        state = kept(state.select("__g", *[f"__by_{c}" for c in groups], "__rank", (F.col("__before") + F.col("__below")).alias("__before"), F.col("__least").alias("__low"), F.col("__most").alias("__high")), "ranges")
        done = state.where(F.col("__low") == F.col("__high")).select("__g", "__rank", F.col("__low").alias("__v"))
        found = done if found is None else found.unionByName(done)
        open_ = state.where(F.col("__low") < F.col("__high"))
        if open_.isEmpty():
            break
        inside = named(_near(open_)).where(F.col("__v").between(F.col("__low"), F.col("__high")))
        by = ["__g", "__rank"]
        counts = inside.select(*by, "__v", _part(F.col("__v"), F.col("__low"), F.col("__high")).alias("__part")).groupBy(*by, "__part").agg(F.count(F.lit(1)).alias("__k"), F.min("__v").alias("__least"), F.max("__v").alias("__most"))
        open_ = open_.drop("__low", "__high")
    values = found.groupBy("__g").agg(F.map_from_entries(F.collect_list(F.struct("__rank", "__v"))).alias("__of"))
    out = ends.join(values, "__g", "left")
    of = lambda r: F.when(r < F.col("__n") - F.col("__nans"), F.col("__of")[r]).when(F.col("__n") > 0, F.lit(float("nan")))
    columns = []
    for name, x in at.items():
        low, high = of(F.floor(x)), of(F.ceil(x))
        columns.append(F.when(F.floor(x) == F.ceil(x), low).when(low == high, low).otherwise((F.ceil(x) - x) * low + (x - F.floor(x)) * high).alias(name))
    return out.select(*groups, F.col("__n").alias("n"), *columns)


def _same(groups: list[str], left: DataFrame, right: DataFrame) -> Column:
    on = F.lit(True)
    for c in groups:
        on = on & left[c].eqNullSafe(right[f"__by_{c}"])
    return on
