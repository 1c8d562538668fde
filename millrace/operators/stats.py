"""Evaluation statistics in closed form."""

from __future__ import annotations

from math import lgamma, log, pi

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def wilson(hits: Column, n: Column, z: float = 1.96) -> tuple[Column, Column]:
    p, zz = hits / n, z * z
    centre, spread = (p + zz / (2 * n)) / (1 + zz / n), z * F.sqrt(p * (1 - p) / n + zz / (4 * n * n)) / (1 + zz / n)
    return centre - spread, centre + spread


def _log_factorial(n: Column) -> Column:
    """ln n!: a table for small n, Stirling's series beyond."""
    small = F.array(*[F.lit(lgamma(k + 1)) for k in range(16)])
    x = n.cast("double") + 1
    series = (x - 0.5) * F.log(x) - x + F.lit(log(2 * pi) / 2) + 1 / (12 * x) - 1 / (360 * F.pow(x, 3)) + 1 / (1260 * F.pow(x, 5))
    return F.when(n < 16, F.get(small, F.least(n, F.lit(15)).cast("int"))).otherwise(series)


#: Terms of a binomial tail that are added up, from its largest on; enough for some ten million discordant pairs.
TAIL = 20_000


def sign_test(less: Column, more: Column) -> Column:
    """Exact two-sided binomial p of the discordant counts (McNemar's exact test); 1 if there are none."""
    n, k = less + more, F.least(less, more)
    largest = F.exp(_log_factorial(n) - _log_factorial(k) - _log_factorial(n - k) - n * F.lit(log(2)))
    start = F.struct(F.lit(1.0).alias("t"), F.lit(0.0).alias("s"))
    step = lambda a, i: F.struct((a["t"] * (k - i) / (n - k + i + 1)).alias("t"), (a["s"] + a["t"]).alias("s"))
    tail = F.aggregate(F.sequence(F.lit(0), F.least(k, F.lit(TAIL)).cast("int")), start, step)["s"]
    return F.when(n == 0, 1.0).otherwise(F.least(F.lit(1.0), 2 * largest * tail))


def kappa(rows: DataFrame, a: str, b: str) -> DataFrame:
    """Cohen's kappa of two 0/1 columns."""
    x = rows.agg(F.count(F.lit(1)).alias("n"), F.avg((F.col(a) == F.col(b)).cast("double")).alias("po"), F.avg(F.col(a).cast("double")).alias("pa"), F.avg(F.col(b).cast("double")).alias("pb"))
    chance = F.col("pa") * F.col("pb") + (1 - F.col("pa")) * (1 - F.col("pb"))
    return x.select("n", F.round((F.col("po") - chance) / (1 - chance), 9).alias("kappa"))


def contamination(items: DataFrame, texts: DataFrame, width: int = 13) -> DataFrame:
    """item_id, grams, found: distinct word n-grams of each item, and those that some text holds.

    The texts' grams are only hashed and probed against the items' distinct ones; no text is shuffled."""

    def grams(column: str) -> Column:
        def of(words: Column) -> Column:
            return F.transform(F.sequence(F.lit(1), F.size(words) - width + 1), lambda i: F.xxhash64(F.slice(words, i, width)))

        words = F.filter(F.split(F.lower(F.col(column)), r"\s+"), lambda w: w != "")
        return F.element_at(F.transform(F.array(words), lambda w: F.when(F.size(w) >= width, of(w))), 1)

    own = items.select("item_id", F.explode_outer(F.array_distinct(grams("text"))).alias("h"))
    keys = own.select("h").distinct()
    bound = 1_000_000
    keys = F.broadcast(keys) if keys.limit(bound + 1).count() <= bound else keys
    met = texts.select(F.explode(grams("text")).alias("h")).join(keys, "h", "left_semi").distinct().withColumn("met", F.lit(1))
    return own.join(met, "h", "left").groupBy("item_id").agg(F.count("h").alias("grams"), F.count("met").alias("found"))
