"""The whole training set in one pass: train rows and flagged rows are written, and the report comes from what was counted on the way.

Examples are read once. Short ones are counted and left out, copies are reduced to the first of each text within tasks before anything
is shuffled, flags are joined, and one write deals rows to `kind=train` and `kind=slop`. Counts by source, reason and span category are
taken by observations on the rows as they pass.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from millrace.functions import fixed
from millrace.functions import text as T

#: Flags up to which they are sent to the examples.
_FEW = 200_000


def _of_category(name: str):
    return lambda span: span["category"] == name


def build(examples: DataFrame, flags: DataFrame, folder: str, sources: list[str], preferences: DataFrame | None = None, skipped: dict[str, int] | None = None, least: int = fixed.MIN_CHARS) -> dict:
    """Writes folder/examples/kind=train and kind=slop (these with their flag's note and spans) and folder/preferences as JSON lines.

    examples: (seq, id, source, origin, instruction, response), in order of seq; flags: (id, note, spans: array of {category, text});
    skipped: counts of reasons found by the readers. Returns the report's counts: `sources` (name, examples, tokens, long) in the order
    given, zeros included, what has none of these names under `other`; `left_out` in report order; `spans` by category; `preferences`;
    and `unmatched`, a DataFrame of the flags that no kept example has.

    Defined cases: null texts are empty; of equal texts the first by seq, id, source and origin stays, nulls first, of rows that are the
    same in all of these one; flags repeated for an id count once; flags that are null match nothing; empty tables give zeros."""
    text = lambda c: F.coalesce(F.col(c), F.lit("")).alias(c)
    rows = examples.select("seq", "id", "source", "origin", text("instruction"), text("response"))
    rows = rows.withColumn("chars", F.length("instruction") + F.length("response"))
    read, passed = Observation(), Observation()
    rows = rows.observe(read, F.count_if(F.col("chars") < least).alias("short")).where(F.col("chars") >= least)
    names = ["seq", "id", "source", "origin"]
    whole = F.struct(*names, "instruction", "response", "chars")
    first = rows.groupBy(F.sha2(T.dedup_key(F.col("instruction"), F.col("response")), 256).alias("key")).agg(F.min_by(whole, F.struct(*names)).alias("r"), F.count(F.lit(1)).alias("copies"))
    once = flags.where(F.col("id").isNotNull()).groupBy("id").agg(F.min(F.struct("note", "spans")).alias("flag"))
    marked = first.select("r.*", "copies").join(F.broadcast(once) if once.count() <= _FEW else once, "id", "left")
    train, tokens = F.col("flag").isNull(), F.floor(F.col("chars") / 4)
    of = lambda s: (F.col("source") == s) if s is not None else ~F.coalesce(F.col("source").isin(sources), F.lit(False))
    counts = [F.sum(F.col("copies") - 1).alias("duplicate"), F.count_if(~train).alias("flagged")]
    for k, s in enumerate([*sources, None]):
        counts += [F.count_if(train & of(s)).alias(f"n{k}"), F.sum(F.when(train & of(s), tokens)).alias(f"t{k}"), F.count_if(train & of(s) & (tokens > fixed.LONG_TOKENS)).alias(f"l{k}")]
    spans = F.coalesce("flag.spans", F.array().cast("array<struct<category:string,text:string>>"))
    counts += [F.sum(F.size(F.filter(spans, _of_category(c)))).alias(f"s{k}") for k, c in enumerate(fixed.SPAN_CATEGORIES)]
    marked = marked.observe(passed, *counts)
    out = marked.select("seq", "id", "source", "origin", "instruction", "response", "flag.note", "flag.spans", F.when(train, "train").otherwise("slop").alias("kind"))
    out.write.mode("overwrite").option("ignoreNullFields", "true").partitionBy("kind").json(f"{folder}/examples")
    short, found = read.get, {k: v or 0 for k, v in passed.get.items()}
    pairs = 0
    if preferences is not None:
        kept = Observation()
        preferences.observe(kept, F.count(F.lit(1)).alias("n")).write.mode("overwrite").option("ignoreNullFields", "true").json(f"{folder}/preferences")
        pairs = kept.get["n"]
    left = {r: 0 for r in fixed.SKIP_REASONS} | (skipped or {}) | {"short": short["short"], "duplicate": found["duplicate"], "flagged": found["flagged"]}
    taken = examples.sparkSession.read.schema(f"id {once.schema['id'].dataType.simpleString()}, kind string").json(f"{folder}/examples").where("kind = 'slop'").select("id")
    return {
        "sources": [(s or "other", found[f"n{k}"], found[f"t{k}"], found[f"l{k}"]) for k, s in enumerate([*sources, None])], "left_out": list(left.items()),
        "spans": [(c, found[f"s{k}"]) for k, c in enumerate(fixed.SPAN_CATEGORIES)], "preferences": pairs, "unmatched": once.select("id", "flag.note").join(taken, "id", "left_anti"),
    }


def report_rows(spark, built: dict) -> DataFrame:
    """position, section, name, n, tokens of a build's report: sources with a total, what was left out, spans, preference pairs."""
    sources = [x for x in built["sources"] if x[0] != "other" or x[1]]
    rows = [("source", s, n, t) for s, n, t, _ in sources] + [("source", "total", sum(x[1] for x in sources), sum(x[2] for x in sources))]
    rows += [("left out", r, n, None) for r, n in built["left_out"]] + [("span", c, n, None) for c, n in built["spans"]] + [("preferences", "pairs", built["preferences"], None)]
    return spark.createDataFrame([(k, *r) for k, r in enumerate(rows)], "position int, section string, name string, n long, tokens long")
