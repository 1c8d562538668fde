"""Review of answers: suggestions by rule and field, and a phrase marked wherever it stands."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions import fixed
from millrace.functions import text as T


def suggestions(rows: DataFrame, fields: tuple[str, ...] = ("instruction", "response")) -> DataFrame:
    """rows without their texts, with field, rule, category and match: of each rule the first phrase that a field's lower-cased text holds,
    and in responses the habit of em dashes. Nothing is suggested for a reviewer's own sources (`source`, if rows have it). A null text
    holds nothing."""
    if "source" in rows.columns:
        rows = rows.where(~F.coalesce(F.col("source").isin(fixed.OWN_SOURCES), F.lit(False)))
    found = []
    for field in fields:
        low = F.lower(field)
        found += [F.struct(F.lit(field).alias("field"), F.lit(rule).alias("rule"), F.lit(fixed.SUGGESTION_CATEGORIES.get(rule, rule)).alias("category"), F.coalesce(*[F.when(F.contains(low, F.lit(p)), p) for p in phrases]).alias("match")) for rule, phrases in fixed.SUGGESTION_RULES.items()]
        if field == "response":
            dashes = F.regexp_count(field, F.lit("—"))
            habit = F.when(dashes >= fixed.EM_DASH_LIMIT, F.concat(dashes.cast("string"), F.lit(" em dashes")))
            found.append(F.struct(F.lit(field).alias("field"), F.lit("em_dash_habit").alias("rule"), F.lit("rhythm_trick").alias("category"), habit.alias("match")))
    kept = [c for c in rows.columns if c not in fields]
    return rows.select(*kept, F.explode(F.array(*found)).alias("s")).select(*kept, "s.*").where("match IS NOT NULL")


def phrases(marks: DataFrame) -> DataFrame:
    """text, category, n of the phrases of marks (id, pos, text, category): one a lower-cased text of MIN_PHRASE characters or more, in the
    spelling and category of the first mark by id and pos. Null texts are left out."""
    rows = marks.withColumn("text", T.strip(F.col("text"))).where(F.length("text") >= fixed.MIN_PHRASE)
    first = F.struct("id", "pos")
    return rows.groupBy(F.lower("text").alias("key")).agg(F.min_by("text", first).alias("text"), F.min_by("category", first).alias("category"), F.count(F.lit(1)).alias("n")).drop("key")


def marked(records: DataFrame, flags: DataFrame, phrase: str, category: str) -> tuple[DataFrame, DataFrame]:
    """A phrase marked in every answer that holds it, whatever its case: the new spans, and one row of `matched` and `added`.

    records: (id, response); flags: (id, note, spans: array of {field, text, category}). New spans: (id, note, field, text, category) with
    the text as the answer spells it at its first place; answers whose flag has the phrase in that field already are matched only.
    note: that of a flag made for it, null where the example has a flag. A phrase of fewer than MIN_PHRASE characters is an error."""
    needle = phrase.strip().lower()
    if len(needle) < fixed.MIN_PHRASE:
        raise ValueError(f"a phrase needs at least {fixed.MIN_PHRASE} characters")
    at = F.instr(F.lower("response"), needle)
    found = records.where(at > 0).select("id", F.substring("response", at, F.lit(len(needle))).alias("text"))
    same = F.exists(F.coalesce("spans", F.array().cast("array<struct<field:string,text:string,category:string>>")), lambda s: (s["field"] == "response") & (T.ascii_lower(s["text"]) == T.ascii_lower(F.col("text"))))
    one = flags.groupBy("id").agg(F.flatten(F.collect_list("spans")).alias("spans"))
    joined = found.join(one, "id", "left").withColumn("present", F.coalesce(same, F.lit(False)))
    note = F.when(F.col("spans").isNull(), F.lit(f"{fixed.PHRASE_NOTE} {phrase.strip()}"))
    new = joined.where(~F.col("present")).select("id", note.alias("note"), F.lit("response").alias("field"), "text", F.lit(category).alias("category"))
    return new, joined.agg(F.count(F.lit(1)).alias("matched"), F.count_if(~F.col("present")).alias("added"))


def remaining(planned: DataFrame, written: DataFrame) -> DataFrame:
    """Planned conversations (key, …) whose key is not among those written (key): what a resumed run has left to do."""
    return planned.join(written.where(F.col("key").isNotNull()).select("key").distinct(), "key", "left_anti")
