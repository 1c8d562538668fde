"""Scores of answers and their summary."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions import fixed
from millrace.functions import answers as A
from millrace.functions import markdown as M

from .code import code_rules


def rolled_up(verdicts: Column, rule: str) -> Column:
    """Over all blocks: fail if any fails, else pass if any passes, else n/a."""
    has = lambda v: F.exists(verdicts, lambda x: F.coalesce(x[rule] == v, F.lit(False)))
    return F.when(has("fail"), "fail").when(has("pass"), "pass").otherwise("n/a")


def score(rows: DataFrame, text: str = "text") -> DataFrame:
    """rows without their text, with slop, n_blocks, n_parsed, rules (a verdict each), all_rules (null without code) and false_claims.

    `rows` has a unique `id`. Texts are read where they lie: phrases and claims come from one pass, code leaves them as tokens, and what
    is shuffled are the other columns with facts and verdicts."""
    facts = rows.select(*[c for c in rows.columns if c != text], A.slop_check(F.col(text)).alias("slop"))
    blocks = rows.select("id", F.posexplode(M.rust_blocks(F.col(text))["code"]).alias("block", "code"))
    per = code_rules(blocks).groupBy("id").agg(F.collect_list("verdicts").alias("v"), F.count(F.lit(1)).alias("n_blocks"), F.count_if("parsed").alias("n_parsed"))
    rules = F.create_map(*[x for r in A.RULES for x in (F.lit(r), rolled_up(F.col("v"), r))])
    per = per.select("id", "n_blocks", "n_parsed", rules.alias("rules"))
    out = facts.join(per, "id", "left").withColumns({"n_blocks": F.coalesce("n_blocks", F.lit(0)), "n_parsed": F.coalesce("n_parsed", F.lit(0))})
    none = F.create_map(*[x for r in A.RULES for x in (F.lit(r), F.lit("n/a"))])
    out = out.withColumn("rules", F.coalesce("rules", none))
    fine = (F.col("n_parsed") == F.col("n_blocks")) & ~F.exists(F.map_values("rules"), lambda v: v == "fail")
    return out.withColumn("all_rules", F.when(F.col("n_blocks") > 0, fine)).withColumn("false_claims", A.false_claims(F.col("slop.claims"), F.col("rules"))).withColumn("slop", F.struct("slop.hits", "slop.em_dashes", "slop.words"))


def summary(scored: DataFrame) -> DataFrame:
    """One row of counters: answers, code, rules (passed and applied), prose, claims, and hits by category."""
    rule = lambda r: F.col("rules")[r]
    measures = [
        F.count(F.lit(1)).alias("answers"), F.count_if(F.col("n_blocks") > 0).alias("with_code"), F.sum("n_blocks").alias("blocks"), F.sum("n_parsed").alias("parsed_blocks"), F.count_if(F.col("all_rules")).alias("all_rules"),
        F.count_if(A.slop_score(F.col("slop")) == 0).alias("clean_prose"), F.sum(F.size("slop.hits")).alias("slop_hits"), F.count_if(F.col("slop.em_dashes") >= fixed.EM_DASH_LIMIT).alias("em_dash_habit"),
        F.sum("slop.words").alias("words"), F.count_if(F.size("false_claims") > 0).alias("false_claims"),
    ]
    measures += [m for r in A.RULES for m in (F.count_if(rule(r) == "pass").alias(f"{r}_passed"), F.count_if(rule(r) != "n/a").alias(f"{r}_applied"))]
    hits = lambda c: F.filter("slop.hits", lambda h: h["category"] == c)
    measures += [F.sum(F.size(hits(c))).alias(f"hits_{c}") for c in A.CATEGORIES]
    return scored.agg(*measures)


def rates(summed: DataFrame, label: str) -> DataFrame:
    """The summary's row of text cells: percentages with halves to even, one decimal per thousand words, a dash for none."""
    whole = lambda n, d: F.bround(F.col(n).cast("decimal(28,6)") * 100 / F.col(d), 0).cast("long")
    percent = lambda n, d: F.when(F.col(d) > 0, F.concat(whole(n, d).cast("string"), F.lit("%"))).otherwise("–")
    tenths = F.bround(F.col("slop_hits").cast("decimal(28,6)") * 10_000 / F.col("words"), 0).cast("long")
    cells = [F.lit(label).alias("run"), F.col("answers").cast("string").alias("n"), F.col("with_code").cast("string"), percent("parsed_blocks", "blocks").alias("parses"), percent("all_rules", "with_code").alias("all_rules")]
    cells += [F.concat(percent(f"{r}_passed", f"{r}_applied"), F.lit(" of "), F.col(f"{r}_applied").cast("string")).alias(r) for r in A.RULES]
    cells += [
        percent("false_claims", "answers").alias("false_claims"), percent("clean_prose", "answers").alias("clean_prose"),
        F.when(F.col("words") > 0, F.concat((tenths / 10).cast("long").cast("string"), F.lit("."), F.pmod(tenths, F.lit(10)).cast("string"))).otherwise("–").alias("slop_per_thousand"),
        percent("em_dash_habit", "answers").alias("em_dash_habit"), F.when(F.col("answers") > 0, F.floor(F.col("words") / F.col("answers")).cast("string")).otherwise("–").alias("words_per_answer"),
    ]
    return summed.select(*cells)
