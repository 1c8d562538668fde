"""Conversations: pairing, turn numbers and question checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions import text as T


def turns(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role (human or assistant), text, stripped; system turns and blank assistant turns are left out."""
    role = F.when(F.col("role") == "user", "human").otherwise(F.col("role"))
    rows = conversations.select("conv_id", "turn", role.alias("role"), T.strip(F.coalesce("text", F.lit(""))).alias("text"))
    return rows.where("role in ('human', 'assistant') and not (role = 'assistant' and text = '')")


def pairs(rows: DataFrame) -> DataFrame:
    """conv_id, pair, question, answer: a pair opens at a human turn after none or an assistant one; texts join by blank lines."""
    w = Window.partitionBy("conv_id").orderBy("turn")
    before = F.lag("role").over(w)
    opens = ((F.col("role") == "human") & (before.isNull() | (before == "assistant"))).cast("int")
    numbered = rows.withColumn("opens", opens).withColumn("pair", F.sum("opens").over(w)).where("pair > 0")

    def gather(role: str):
        found = F.array_sort(F.collect_list(F.when((F.col("role") == role) & (F.col("text") != ""), F.struct("turn", "text"))))
        return F.array_join(F.transform(found, lambda x: x["text"]), "\n\n")

    return numbered.groupBy("conv_id", "pair").agg(gather("human").alias("question"), gather("assistant").alias("answer"))


def repeats(questions: DataFrame) -> DataFrame:
    """Overlap of each question with the one before it in its conversation (conv_id, turn, text)."""
    w = Window.partitionBy("conv_id").orderBy("turn")
    rows = questions.withColumn("words", T.overlap_words(F.col("text"))).withColumn("earlier", F.lag("words").over(w))
    return rows.where("earlier is not null").select("conv_id", "turn", T.jaccard(F.col("words"), F.col("earlier")).alias("overlap"))
