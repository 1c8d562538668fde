"""Conversation queries."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from millrace.functions import fixed
from millrace.functions import text as T
from millrace.operators import chat as H

from .curate import _literal
from .registry import query, table

_TURNS = r"""t AS (SELECT conv_id, turn, CASE role WHEN 'user' THEN 'human' ELSE role END AS role, regexp_replace(coalesce(text, ''), '^\s+|\s+$', '', 'g') AS text FROM conversations),
u AS (SELECT * FROM t WHERE role IN ('human', 'assistant') AND NOT (role = 'assistant' AND text = ''))"""


@query(f"""WITH {_TURNS}, o AS (SELECT *, CASE WHEN role = 'human' AND coalesce(lag(role) OVER (PARTITION BY conv_id ORDER BY turn), 'assistant') = 'assistant' THEN 1 ELSE 0 END AS opens FROM u),
n AS (SELECT *, sum(opens) OVER (PARTITION BY conv_id ORDER BY turn) AS pair FROM o)
SELECT conv_id, CAST(pair AS BIGINT) AS pair, coalesce(string_agg(text, chr(10) || chr(10) ORDER BY turn) FILTER (WHERE role = 'human' AND text <> ''), '') AS question,
coalesce(string_agg(text, chr(10) || chr(10) ORDER BY turn) FILTER (WHERE role = 'assistant'), '') AS answer FROM n WHERE pair > 0 GROUP BY conv_id, pair""")
def chat_pairs(spark, sf):
    return H.pairs(H.turns(table(spark, sf, "conversations")))


@query("SELECT conv_id, turn, CAST(row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS INT) AS number FROM conversations")
def chat_turn_numbers(spark, sf):
    rows = table(spark, sf, "conversations")
    return rows.select("conv_id", "turn", F.row_number().over(Window.partitionBy("conv_id").orderBy("turn")).alias("number"))


@query("SELECT conv_id, string_agg(text, chr(10) ORDER BY turn) AS system FROM conversations WHERE role = 'system' GROUP BY conv_id")
def chat_system_messages(spark, sf):
    rows = table(spark, sf, "conversations").where("role = 'system'").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "text"))).alias("m"))
    return rows.select("conv_id", F.array_join(F.transform("m", lambda x: x["text"]), "\n").alias("system"))


_REPLIES = [(1, 'Question: "How do I pin a thread?"'), (2, ""), (3, "How?\nWhy?"), (4, "Tell me."), (5, "What does the author mean?"), (6, "Is it worth noting that it's worth noting?"), (7, "Q: Why " + "x" * 230 + "?"), (8, "Which allocator is faster?")]


@query(f"""WITH r AS (SELECT id, CASE WHEN starts_with(x, 'Question:') THEN substr(x, 10) WHEN starts_with(x, 'Q:') THEN substr(x, 3) ELSE x END AS y FROM (SELECT id, trim(reply) AS x FROM (VALUES {_literal(_REPLIES)}) v(id, reply))),
q AS (SELECT id, trim(regexp_replace(trim(y), '^["“”'']+|["“”'']+$', '', 'g')) AS question FROM r)
SELECT id, question, CASE WHEN question = '' THEN 'empty' WHEN contains(question, chr(10)) THEN 'not one line' WHEN NOT ends_with(question, '?') THEN 'not a question' WHEN length(question) > 220 THEN 'too long'
WHEN contains(lower(question), 'the author') THEN 'mentions the source' WHEN contains(lower(question), 'it''s worth noting') THEN 'slop' END AS rejection FROM q""")
def chat_question_check(spark, sf):
    rows = spark.createDataFrame(_REPLIES, "id int, reply string").withColumn("question", T.question_of(F.col("reply")))
    return rows.select("id", "question", T.question_rejection(F.col("question")).alias("rejection"))


@query(r"""WITH q AS (SELECT conv_id, turn, list_distinct(list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'), lambda w: strlen(w) >= 3)) AS w FROM conversations WHERE role = 'user'),
p AS (SELECT *, lag(w) OVER (PARTITION BY conv_id ORDER BY turn) AS e FROM q)
SELECT conv_id, turn, round(CASE WHEN len(list_distinct(list_concat(w, e))) > 0 THEN len(list_intersect(w, e)) / len(list_distinct(list_concat(w, e))) ELSE 0 END, 9) AS overlap FROM p WHERE e IS NOT NULL""")
def chat_question_overlap(spark, sf):
    rows = table(spark, sf, "conversations").where("role = 'user'").select("conv_id", "turn", F.coalesce("text", F.lit("")).alias("text"))
    return H.repeats(rows).withColumn("overlap", F.round("overlap", 9))


@query("""WITH s AS (SELECT conv_id, turn, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn) AS k FROM conversations) SELECT conv_id, turn FROM s WHERE k > 1""")
def chat_repeated_turns(spark, sf):
    """Turns that an earlier one of the same role in the conversation says word for word."""
    rank = F.row_number().over(Window.partitionBy("conv_id", "role", "text").orderBy("turn"))
    return table(spark, sf, "conversations").withColumn("k", rank).where("k > 1").select("conv_id", "turn")


_SAID = ["'Question: \"' || substr(t, 1, 50) || '?\"'", "''", "'one' || chr(10) || substr(t, 1, 40) || '?'", "substr(t, 1, 60) || '.'", "'What does the author mean by ' || substr(t, 1, 20) || '?'", "'Is it worth noting that ' || substr(t, 1, 20) || ', a game changer?'", "substr(t, 1, 230) || '?'", "'Q: Which ' || substr(t, 1, 30) || '?'"]
_SAID_SQL = "CASE (conv_id + turn) % 8 " + " ".join(f"WHEN {k} THEN {x}" for k, x in enumerate(_SAID)) + " END"
_SLOP_SQL = " OR ".join("regexp_matches(question, '" + T.phrase_pattern(p).replace("'", "''") + "')" for p in fixed.SLOP_PHRASES.values())
_EDGE = "regexp_replace({}, '^\\s+|\\s+$', '', 'g')"


@query(f"""WITH r AS (SELECT conv_id, turn, {_EDGE.format(_SAID_SQL)} AS x FROM (SELECT conv_id, turn, replace(text, chr(10), ' ') AS t FROM conversations WHERE text IS NOT NULL)),
q AS (SELECT conv_id, turn, {_EDGE.format("regexp_replace(" + _EDGE.format("regexp_replace(x, '^(?:Question:|Q:)', '')") + ", '^[\"“”'']+|[\"“”'']+$', '', 'g')")} AS question FROM r)
SELECT conv_id, turn, CASE WHEN question = '' THEN 'empty' WHEN contains(question, chr(10)) THEN 'not one line' WHEN NOT ends_with(question, '?') THEN 'not a question' WHEN length(question) > {fixed.MAX_QUESTION} THEN 'too long'
WHEN {" OR ".join(f"contains(lower(question), '{w}')" for w in fixed.SOURCE_WORDS)} THEN 'mentions the source' WHEN {_SLOP_SQL} THEN 'slop' END AS rejection FROM q""")
def chat_question_reasons(spark, sf):
    """Replies made of all turns, in eight forms, and why each cannot be a question."""
    rows = table(spark, sf, "conversations").where(F.col("text").isNotNull()).select("conv_id", "turn", F.replace("text", F.lit("\n"), F.lit(" ")).alias("t"))
    rows = rows.withColumn("reply", F.expr(_SAID_SQL.replace("chr(10)", "char(10)")))
    return rows.select("conv_id", "turn", T.question_rejection(T.question_of(F.col("reply"))).alias("rejection"))
