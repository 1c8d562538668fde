"""Queries over streamed replies, and evaluation rates."""

from __future__ import annotations

import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from millrace.operators import replies as R
from millrace.operators import research as N
from millrace.streaming import sieve

from .registry import query, table


@query("SELECT conv_id AS reply, string_agg(coalesce(text, ''), '' ORDER BY turn) AS content FROM conversations GROUP BY conv_id")
def replies_contents(spark, sf):
    """Text pieces put together (here: turns as pieces)."""
    return R.contents(table(spark, sf, "conversations").select(F.col("conv_id").alias("reply"), F.col("turn").alias("seq"), F.col("text").alias("content")))


@query("SELECT conv_id % 7 AS reply, turn AS index, string_agg(role, '' ORDER BY conv_id) AS name, string_agg(coalesce(text, ''), '' ORDER BY conv_id) AS arguments FROM conversations WHERE turn < 8 GROUP BY ALL")
def replies_calls(spark, sf):
    """Tool-call pieces put together by index, indexes beyond the eighth left out."""
    rows = table(spark, sf, "conversations")
    return R.calls(rows.select((F.col("conv_id") % 7).alias("reply"), F.col("conv_id").alias("seq"), F.col("turn").alias("index"), F.col("role").alias("name"), F.col("text").alias("arguments")))


@query("SELECT user_id AS reply, event_id AS seq, row_number() OVER (PARTITION BY user_id, event_type, props ORDER BY event_id) > 1 AS ran FROM events")
def replies_repeated_calls(spark, sf):
    """Calls that an earlier one with the same name and arguments makes needless (here: events as calls)."""
    made = table(spark, sf, "events").select(F.col("user_id").alias("reply"), F.col("event_id").alias("seq"), F.col("event_type").alias("name"), F.col("props").alias("arguments"))
    return R.repeated_calls(made).select("reply", "seq", "ran")


@query("""WITH r AS (SELECT user_id AS reply, min(value) - 1 AS s, min(value) AS a, max(value) AS b, count(*) AS n FROM events GROUP BY user_id)
SELECT reply, round(a - s, 3) AS first_token_s, round((n - 1) / nullif(b - a, 0), 2) AS decode_rate, round(n / nullif(b - s, 0), 2) AS whole_rate FROM r""")
def replies_timing(spark, sf):
    """Time to the first token, decode rate and whole rate (here: event values as times)."""
    rows = table(spark, sf, "events").withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("user_id")))
    return R.timing(rows.select(F.col("user_id").alias("reply"), (F.col("value") - 1).alias("started"), F.col("value").alias("at"), F.col("n").alias("tokens")))


@query("""SELECT event_id AS id, greatest(event_id % 50, CAST(regexp_extract(props, '\\d+') AS BIGINT)) AS output_tokens, 0::BIGINT AS input_tokens FROM events""")
def replies_token_counts(spark, sf):
    """The largest counts that a reply's chunks name."""
    text = F.concat(F.lit('{"completion_tokens": '), F.col("event_id") % 50, F.lit('} "output_tokens" :'), F.regexp_extract("props", r"\d+", 0), F.lit(","))
    return table(spark, sf, "events").select(F.col("event_id").alias("id"), R.largest_count(text, ["completion_tokens", "output_tokens"]).alias("output_tokens"), R.largest_count(text, ["prompt_tokens", "input_tokens"]).alias("input_tokens"))


_SAID = [(1, 'Look: <tool_call>{"name": "search", "arguments": {"q": "x"}}</tool_call> done'), (2, "<TOOL_CALL><function=read><parameter=url> http://a </parameter><parameter=n>2</parameter></function></tool_call>"), (3, "no call < here"), (4, 'a <tool_call>{"tool": "t"}'), (5, "b <tool_call>broken"), (6, '<tool_call>{"name": ""}</tool_call>!')]


@query("""SELECT * FROM (VALUES (1, 'Look:  done', 'search', '{"q":"x"}'), (2, '', 'read', '{"url":"http://a","n":"2"}'), (3, 'no call < here', NULL, NULL), (4, 'a ', 't', '{}'), (5, 'b broken', NULL, NULL), (6, '!', NULL, NULL)) v(id, shown, name, arguments)""")
def replies_text_calls(spark, sf):
    """Tool calls written in the text, in tags or as JSON. The SQL states the expected rows."""
    rows = spark.createDataFrame(_SAID, "id int, t string").select("id", R.visible_text(F.col("t")).alias("shown"), F.explode_outer(R.text_calls(F.col("t"))).alias("c"))
    return rows.select("id", "shown", "c.name", "c.arguments")


def _chunks(spark):
    unit = "the same forty bytes again and again, o. "
    rows = [(1, k, f"piece {k} {k * k} of some text", None) for k in range(40)] + [(2, k, unit, None) for k in range(10)] + [(3, k, "x" if k < 2 else " " * 1_100, None) for k in range(4)] + [(4, k, "", None) for k in range(130)] + [(5, k, None, unit * 3) for k in range(4)] + [(6, k, "".join(random.Random(k).choices("abcdefgh", k=900)), None) for k in range(60)]
    return spark.createDataFrame(rows, "reply long, seq long, content string, reasoning string")


@query("SELECT * FROM (VALUES (2, 5, 'repeated'), (3, 2, 'blank'), (4, 127, 'empty'), (5, 1, 'repeated'), (6, 54, 'size')) v(reply, seq, reason)")
def replies_guard(spark, sf):
    """Where replies that loop, run blank or empty, or grow too long are stopped. The SQL states the expected rows."""
    return R.guard(_chunks(spark))


@query("""WITH s AS (SELECT conv_id, count(*) FILTER (WHERE contains(text, 'a')) AS rule, count(*) AS n, avg(1000.0 * (length(text) - length(replace(text, ' ', ''))) / nullif(length(text), 0)) AS d FROM conversations WHERE role = 'assistant' GROUP BY conv_id)
SELECT round(sum(rule) / sum(n), 9) AS compliance, round(avg(d), 6) AS density_mean, count(*) AS answers FROM s""")
def stats_rates(spark, sf):
    """Rule compliance as a ratio of sums, density as a mean of answers' means (here: answers with an a, spaces per thousand characters)."""
    said = table(spark, sf, "conversations").where("role = 'assistant'")
    spaces = F.length("text") - F.length(F.replace("text", F.lit(" "), F.lit("")))
    per = said.groupBy("conv_id").agg(F.count_if(F.contains("text", F.lit("a"))).alias("rule"), F.count(F.lit(1)).alias("n"), F.avg(1000.0 * spaces / F.nullif(F.length("text"), F.lit(0))).alias("d"))
    return per.agg(F.round(F.sum("rule") / F.sum("n"), 9).alias("compliance"), F.round(F.avg("d"), 6).alias("density_mean"), F.count(F.lit(1)).alias("answers"))


@query("""WITH a AS (SELECT conv_id, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS k FROM conversations WHERE role = 'assistant')
SELECT CAST(k AS INT) AS turn, count(*) AS answers, round(avg(CASE WHEN length(text) > 60 THEN 1.0 ELSE 0.0 END), 9) AS kept FROM a GROUP BY k""")
def stats_rule_retention(spark, sf):
    """Share of answers that keep a rule, by the turn they come at (here: over 60 characters)."""
    place = F.row_number().over(Window.partitionBy("conv_id").orderBy("turn"))
    rows = table(spark, sf, "conversations").where("role = 'assistant'").select(place.alias("turn"), (F.length("text") > 60).cast("double").alias("kept"))
    return rows.groupBy("turn").agg(F.count(F.lit(1)).alias("answers"), F.round(F.avg("kept"), 9).alias("kept"))


@query(r"""SELECT source, round(avg(CASE WHEN regexp_matches(text, '[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}') THEN 1.0 ELSE 0.0 END), 9) AS leaks, round(avg(CASE WHEN regexp_matches(lower(text), '\b(i can.?t|i cannot|unable to)\b') THEN 1.0 ELSE 0.0 END), 9) AS refusals FROM documents GROUP BY source""")
def stats_leaks_and_refusals(spark, sf):
    share = lambda c: F.round(F.avg(c.cast("double")), 9)
    return table(spark, sf, "documents").groupBy("source").agg(share(F.col("text").rlike(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}")).alias("leaks"), share(F.lower("text").rlike(r"\b(i can.?t|i cannot|unable to)\b")).alias("refusals"))


@query("""WITH d AS (SELECT CAST(quality - toxic AS DOUBLE) AS x FROM labels WHERE quality IS NOT NULL AND toxic IS NOT NULL) SELECT round(avg(x), 9) AS mean, true AS low_near, true AS high_near FROM d""")
def stats_bootstrap(spark, sf):
    """Mean difference of two labels, and whether its resampled interval is that of the normal distribution but for a tenth of its half width."""
    rows = table(spark, sf, "labels").where("quality is not null and toxic is not null").select(F.col("doc_id").alias("id"), (F.col("quality") - F.col("toxic")).cast("double").alias("difference"))
    spread = rows.agg((1.96 * F.stddev_pop("difference") / F.sqrt(F.count(F.lit(1)))).alias("half"))
    out = R.bootstrap(rows).crossJoin(F.broadcast(spread))  # one row each
    near = lambda c, sign: F.abs(F.col(c) - (F.col("mean") + sign * F.col("half"))) < F.col("half") / 10
    return out.select(F.round("mean", 9).alias("mean"), near("low", -1).alias("low_near"), near("high", 1).alias("high_near"))


@query("""WITH x AS (SELECT count(*) FILTER (WHERE quality > toxic) AS wins, count(*) FILTER (WHERE quality < toxic) AS losses, count(*) FILTER (WHERE quality = toxic) AS ties FROM labels)
SELECT wins, losses, ties, round((wins + ties / 2) / (wins + losses + ties), 9) AS win_rate FROM x""")
def stats_win_rate(spark, sf):
    """How often the one label is over the other."""
    rows = table(spark, sf, "labels").select(F.col("quality").alias("one"), F.col("toxic").alias("other"))
    return R.win_rate(rows).select("wins", "losses", "ties", F.round("win_rate", 9).alias("win_rate"))


@query("""SELECT conv_id * 1000 + turn AS reply, md5('Before ' || text || ' after') AS shown_md5, 1 AS calls, '{"turn": "' || turn || '"}' AS arguments, conv_id % 1000 AS output_tokens FROM conversations WHERE text IS NOT NULL""")
def replies_sieved(spark, sf):
    """Turns as streamed replies in chunks of seven characters, a tool call within each and a count at its end."""
    rows = table(spark, sf, "conversations").where(F.col("text").isNotNull()).select((F.col("conv_id") * 1000 + F.col("turn")).alias("reply"), "conv_id", "turn", "text")
    call = F.concat(F.lit("<tool_call>\n<function=look>\n<parameter=turn>"), "turn", F.lit("</parameter>\n</function>\n</TOOL_CALL>"))
    rows = rows.select("reply", F.concat(F.lit("Before "), "text", call, F.lit(" after")).alias("t"), F.concat(F.lit('{"usage": {"completion_tokens": '), F.col("conv_id") % 1000, F.lit("}}")).alias("raw"))
    chunks = rows.select("reply", "t", "raw", F.explode(F.sequence(F.lit(0), F.floor((F.greatest(F.length("t"), F.length("raw")) - 1) / 7))).alias("seq"))
    chunks = chunks.select("reply", "seq", *[F.substring(c, F.col("seq").cast("int") * 7 + 1, F.lit(7)).alias(n) for c, n in (("t", "content"), ("raw", "raw"))], F.lit(False).alias("ended"))
    of = lambda kind, c: F.when(F.col("kind") == kind, F.struct("number", c))
    out = sieve.sieved_whole(chunks).groupBy("reply").agg(F.sort_array(F.collect_list(of("text", "text"))).alias("t"), F.count_if(F.col("kind") == "call").cast("int").alias("calls"), F.max(F.when(F.col("kind") == "call", F.col("arguments"))).alias("arguments"), F.max("output_tokens").alias("output_tokens"))
    return out.select("reply", F.md5(F.array_join(F.transform("t", lambda x: x["text"]), "")).alias("shown_md5"), "calls", "arguments", "output_tokens")


_ROUND_SQL = """c AS (SELECT conv_id, turn, CASE turn % 3 WHEN 0 THEN '' WHEN 1 THEN substr(text, 1, 20) ELSE text END AS c, (conv_id + turn) % 3 AS calls, CASE WHEN conv_id % 2 = 0 THEN 1 ELSE 0 END AS fresh,
CASE WHEN (conv_id + turn) % 7 = 5 THEN 'loop' END AS stop, turn >= 4 AS out, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS n FROM conversations),
e AS (SELECT *, CASE WHEN stop IS NOT NULL THEN CASE WHEN b = 0 THEN 'stuck' ELSE 'cut' END WHEN b = 0 AND calls = 0 THEN 'nothing' WHEN b = 0 OR (b < 1024 AND calls > 0 AND fresh > 0) THEN 'calls' ELSE 'answer' END AS turn_ FROM (SELECT *, strlen(trim(coalesce(c, ''))) AS b FROM c))"""


@query(f"""WITH RECURSIVE {_ROUND_SQL}, r AS (SELECT DISTINCT conv_id, CAST(0 AS BIGINT) AS n, 'researching' AS state, 1 AS k, NULL::VARCHAR AS why FROM e
UNION ALL SELECT e.conv_id, e.n, CASE WHEN turn_ = 'answer' THEN 'answered' WHEN turn_ = 'cut' THEN 'stopped' WHEN state = 'researching' THEN CASE WHEN turn_ = 'calls' AND k < 8 AND NOT out THEN 'researching' WHEN turn_ = 'stuck' THEN 'answering without thinking' ELSE 'answering' END
WHEN turn_ = 'stuck' THEN CASE WHEN state = 'answering' AND k < 3 THEN 'answering without thinking' ELSE 'stopped' END WHEN k < 3 THEN state ELSE 'unanswered' END,
CASE WHEN turn_ IN ('answer', 'cut') THEN 0 WHEN state = 'researching' THEN CASE WHEN turn_ = 'calls' AND k < 8 AND NOT out THEN k + 1 ELSE 1 END WHEN turn_ = 'stuck' THEN CASE WHEN state = 'answering' AND k < 3 THEN k + 1 ELSE 0 END WHEN k < 3 THEN k + 1 ELSE 0 END, stop
FROM r JOIN e ON e.conv_id = r.conv_id AND e.n = r.n + 1 WHERE state IN ('researching', 'answering', 'answering without thinking'))
SELECT conv_id AS answer, CAST(n AS INT) AS rounds, state, k AS round, CASE WHEN state = 'stopped' THEN why END AS reason FROM r QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY n DESC) = 1""")
def replies_outcomes(spark, sf):
    """How answers ended: the turns of conversations as rounds, with calls and stops by their numbers."""
    c, t = F.col("conv_id"), F.col("turn")
    content = F.when(t % 3 == 0, "").when(t % 3 == 1, F.substring("text", 1, 20)).otherwise(F.col("text"))
    rows = table(spark, sf, "conversations").select(c.alias("answer"), t.alias("seq"), content.alias("content"), ((c + t) % 3).alias("calls"), F.when(c % 2 == 0, 1).otherwise(0).alias("new_calls"), F.when((c + t) % 7 == 5, "loop").alias("stop"), (t >= 4).alias("out_of_searches"))
    return N.outcomes(rows)
