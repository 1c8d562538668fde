"""Benchmark decontamination by template canonicalisation (operator 6), with DataFrame functions only.

Texts become templates: lower-cased words, with numbers (and a unit after one) and names (runs of capitalised words that do not
begin a sentence) each replaced by one typed placeholder. Windows of WINDOW template tokens are hashed at every position of benchmark items and
of documents, and joined: every shared run of WINDOW tokens or more is met. Documents that meet an item are then compared. On
each alignment (difference of the positions) a placeholder's item value must always stand for the same value in the document:
that is how a re-parameterised question reads, whereas windows that only look alike do not agree. A word put in or left out
moves the later windows to another alignment, so the item's positions covered by neighbouring alignments are counted together
too. A document leaks an item if consistent windows on one alignment, or on neighbouring ones, cover COVERAGE of the item's
windows.

An item of fewer tokens than a window is one window of its own length, and documents have windows of each such length that
occurs; one without a plain word is compared by its values, for its template alone would be in nearly every document.
Defined cases: null and empty texts, and items without tokens, match nothing; a number of more than AT_ONCE parts is several;
repeated document rows give one result row; rows with a null id take no part; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .scratch import keys_join, stored

WINDOW = 8
COVERAGE = 0.5
#: Share of the slots on an alignment that must be consistent.
CONSISTENT = 0.8
UNITS = "km|cm|mm|m|kg|mg|g|lb|lbs|oz|l|ml|mph|kmh|s|sec|seconds|min|minutes|h|hours|days|weeks|months|years|dollars|euros|cents|percent|miles|feet|inches|meters|metres|grams|liters|litres"
#: Small words within a name.
PARTICLES = "al|bin|da|de|del|della|den|der|di|dos|du|la|van|von"
#: Most tokens by which one alignment may differ from the next one that is counted with it; less than a window.
DRIFT = WINDOW - 1
#: Words of a name, and parts of a number, that one match takes: a pattern's depth must not grow with the text.
AT_ONCE = 24
_NAME, _END = "\u0004", "\u0005"


def marked_tokens(text: Column) -> Column:
    """Lower-cased words, names and numbers. A run of names is one token with a mark in front, a number and its unit are one too."""
    run = rf"\p{{Lu}}(?<=[^.!?\s]\s{{1,3}}\p{{Lu}})\p{{Ll}}+\p{{L}}*(?:\s{{1,3}}(?:(?:{PARTICLES})\s{{1,3}}){{0,2}}\p{{Lu}}\p{{Ll}}+\p{{L}}*){{0,{AT_ONCE}}}"
    named = F.regexp_replace(F.translate(text, _NAME + _END, "  "), run, f"{_NAME}$0{_END}")
    named = F.regexp_replace(named, rf"{_END}(\s{{1,3}}){_NAME}", "$1")  # a longer run is matched in parts
    number = rf"\p{{N}}+(?:[.,]\p{{N}}+){{0,{AT_ONCE}}}(?:\s{{0,2}}(?:{UNITS})(?![\p{{L}}\p{{N}}]))?"
    found = F.regexp_extract_all(F.lower(named), F.lit(rf"{_NAME}[^{_END}]+|{number}|\p{{L}}+"), F.lit(0))
    return F.transform(found, lambda t: F.when(_slot(t).isNotNull(), F.regexp_replace(t, r"\s+", " ")).otherwise(t))


def _slot(token: Column) -> Column:
    """The placeholder of a marked token, or null for a plain word."""
    return F.when(token < F.lit(_END), F.lit(_NAME)).when(token < F.lit(":"), F.lit("0"))


def template(tokens: Column) -> Column:
    return F.transform(tokens, lambda t: F.coalesce(_slot(t), t))


def _bound(value: Column, of) -> Column:
    """of(value), with value made once and not for each use."""
    return F.element_at(F.transform(F.array(value), of), 1)


def window_hashes(tokens: Column, length: int) -> Column:
    """Hashes of the windows of `length` tokens at positions 0, 1, ...; none if there are fewer tokens."""

    def of(codes: Column, values: Column | None = None) -> Column:
        def one(i: Column) -> Column:
            h = F.xxhash64(F.slice(codes, i, length))
            if values is None:
                return h
            return F.when(F.exists(F.slice(tokens, i, length), lambda t: _slot(t).isNull()), h).otherwise(F.xxhash64(F.slice(values, i, length), F.lit(0)))

        starts = F.sequence(F.lit(1), F.greatest(F.lit(1), F.size(tokens) - (length - 1)))
        return F.when(F.size(tokens) >= length, F.transform(starts, one)).otherwise(F.array().cast("array<bigint>"))

    codes = F.transform(template(tokens), lambda t: F.xxhash64(t))
    if length == WINDOW:
        return _bound(codes, lambda c: of(c))
    return _bound(codes, lambda c: _bound(F.transform(tokens, lambda t: F.xxhash64(t)), lambda v: of(c, v)))


def benchmark_windows(items: DataFrame) -> DataFrame:
    """item_id, at (position from 0), inside, length, h, n_windows, tokens of the window.

    Within a sentence an item's capitalised first word reads as a name, so its first window is given in that reading too
    (`inside`); there the word itself must be the document's."""
    rows = items.where("item_id is not null and text is not null").dropDuplicates(["item_id", "text"])
    first = marked_tokens(F.col("text"))
    within = F.slice(marked_tokens(F.concat(F.lit("a "), F.ltrim("text"))), 2, 1 << 30)
    rows = rows.select("item_id", first.alias("first"), within.alias("within"))
    rows = rows.select("item_id", F.posexplode(F.array("first", "within")).alias("reading", "tokens"), F.get("first", F.lit(0)).alias("word"))
    rows = rows.where((F.col("reading") == 0) | (F.get("tokens", F.lit(0)) != F.col("word")))
    rows = rows.select("item_id", (F.col("reading") == 1).alias("inside"), "tokens", F.least(F.size("tokens"), F.lit(WINDOW)).alias("length")).where("length > 0")
    hashes = F.coalesce(*[F.when(F.col("length") == n, window_hashes(F.col("tokens"), n)) for n in range(1, WINDOW + 1)])
    out = rows.withColumn("hashes", hashes).select("item_id", "inside", "tokens", "length", F.size("hashes").alias("n_windows"), F.posexplode("hashes").alias("at", "h"))
    return out.where("not inside or at = 0").select("item_id", "at", "inside", "length", "h", "n_windows", F.expr("slice(tokens, at + 1, length)").alias("item_tokens"))


def document_windows(docs: DataFrame, lengths: list[int]) -> DataFrame:
    """doc_id, h of the windows of all lengths; only hashes meet the items."""
    hashes = _bound(marked_tokens(F.col("text")), lambda t: F.concat(*[window_hashes(t, n) for n in lengths]))
    return docs.select("doc_id", F.explode(hashes).alias("h"))


def placed_windows(docs: DataFrame, lengths: list[int]) -> DataFrame:
    """doc_id, place (position from 0), h, tokens of the window."""
    rows = docs.select("doc_id", marked_tokens(F.col("text")).alias("tokens"))

    def placed(n: int) -> Column:
        return F.transform(window_hashes(F.col("tokens"), n), lambda h, i: F.struct(i.alias("place"), F.lit(n).alias("length"), h.alias("h")))

    rows = rows.select("doc_id", "tokens", F.explode(F.concat(*map(placed, lengths))).alias("w")).select("doc_id", "tokens", "w.*")
    return rows.select("doc_id", "place", "h", F.expr("slice(tokens, place + 1, length)").alias("doc_tokens"))


def find_leaks(docs: DataFrame, items: DataFrame) -> DataFrame:
    """doc_id, item_id, coverage, n_slots, slots_consistent, at (first token of the match): the pairs that leak."""
    docs = docs.where("doc_id is not null and text is not null").select("doc_id", "text")
    windows = stored(benchmark_windows(items), "windows")
    keys = windows.select("h").distinct()
    lengths = sorted(r["length"] for r in windows.select("length").distinct().collect()) or [WINDOW]  # bounded: WINDOW values
    met = keys_join(document_windows(docs, lengths), stored(keys, "window-keys"), "h", "inner")
    wanted = stored(met.select("doc_id").distinct(), "met")
    found = keys_join(docs, wanted, "doc_id", "left_semi").dropDuplicates(["doc_id", "text"])
    hits = keys_join(placed_windows(found, lengths), windows, "h", "inner", 100_000).withColumn("shift", F.col("place") - F.col("at"))
    hits = hits.where(~F.col("inside") | (F.get("item_tokens", F.lit(0)) == F.get("doc_tokens", F.lit(0))))
    hits = stored(hits, "window-hits")
    pair = ["doc_id", "item_id"]
    # Candidates: single alignments, those from each one to DRIFT more, and chains of alignments at most DRIFT apart.
    shifts = hits.groupBy(*pair, "shift").agg(F.countDistinct("at").alias("weight"))
    order = Window.partitionBy(*pair).orderBy("shift")
    fresh = F.coalesce(F.col("shift") - F.lag("shift").over(order) > DRIFT, F.lit(True))
    shifts = shifts.withColumn("fresh", fresh.cast("int")).withColumn("chain", F.sum("fresh").over(order))
    spans = F.transform(F.sequence(F.lit(0), F.lit(DRIFT)), lambda k: F.struct(F.lit(1).alias("kind"), (F.col("shift") - k).cast("long").alias("key")))
    single = F.struct(F.lit(0).alias("kind"), F.col("shift").cast("long").alias("key"))
    chain = F.struct(F.lit(2).alias("kind"), F.col("chain").cast("long").alias("key"))
    shifts = shifts.withColumn("alone", F.count(F.lit(1)).over(Window.partitionBy(*pair, "chain")) == 1)
    shifts = shifts.select(*pair, "shift", "weight", F.explode(F.when(F.col("alone"), F.array(single)).otherwise(F.concat(F.array(single, chain), spans))).alias("c"))
    # Each position of the item counts once in a candidate, at its place on the alignment with most windows.
    placed = hits.join(shifts.select(*pair, "shift", "weight", "c.*"), [*pair, "shift"])
    best = F.max_by(F.struct("place", "shift", "item_tokens", "doc_tokens", "n_windows"), F.struct("weight", -F.col("shift")))
    placed = stored(placed.groupBy(*pair, "kind", "key", "at").agg(best.alias("m")).select(*pair, "kind", "key", "at", "m.*"), "placed-hits")
    union = [*pair, "kind", "key"]
    slots = placed.select(*union, F.explode(F.arrays_zip("item_tokens", "doc_tokens")).alias("t")).where(_slot(F.col("t.item_tokens")).isNotNull())
    slots = slots.groupBy(*union, "t.item_tokens").agg(F.countDistinct("t.doc_tokens").alias("values"))
    slots = slots.groupBy(*union).agg(F.count(F.lit(1)).alias("n_slots"), F.count_if(F.col("values") == 1).alias("slots_consistent"))
    covered = placed.groupBy(*union).agg(F.count(F.lit(1)).alias("k"), F.max("n_windows").alias("n"), F.min("place").alias("at"))
    both = covered.join(slots, union, "left").select(
        *union, (F.col("k") / F.col("n")).alias("coverage"), F.coalesce("n_slots", F.lit(0)).alias("n_slots"), F.coalesce("slots_consistent", F.lit(0)).alias("slots_consistent"), "at"
    )
    good = both.where((F.col("coverage") >= COVERAGE) & (F.col("slots_consistent") >= CONSISTENT * F.col("n_slots")))
    best = good.groupBy(*pair).agg(F.max_by(F.struct("coverage", "n_slots", "slots_consistent", "at"), F.struct("coverage", -F.col("kind"), -F.col("key"))).alias("b"))
    return best.select(*pair, "b.*")


def clean_documents(docs: DataFrame, items: DataFrame) -> DataFrame:
    """docs without the rows that leak an item."""
    leaks = stored(find_leaks(docs, items).select("doc_id").distinct(), "leaks")
    return keys_join(docs, leaks, "doc_id", "left_anti")


def op6_decontamination(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return find_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text"))
