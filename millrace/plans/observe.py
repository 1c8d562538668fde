"""Telemetry queries: the dashboard panels and capacity arithmetic.

`events` stands for the request log: path is the event type, who and client come from the user, times from value, and the
status, the limiter's mark and token counts from the number in props.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import quantiles as Q

from .registry import query, table

_REQUESTS = """r AS (SELECT ts, event_type AS path, user_id AS who, 'c' || (user_id % 40) AS client, 'm' || (k % 3) AS model, 'agent/' || (k % 5) AS user_agent, CAST(CASE WHEN k % 17 = 0 THEN 401 WHEN k % 13 = 0 THEN 503 ELSE 200 END AS INT) AS status,
k % 11 = 0 AS limited, value * 10 AS total_ms, value AS first_byte_ms, k % 7 AS output_tokens FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events))"""
MODEL_PATHS = ["click", "view"]


def requests(spark, sf):
    k = F.get_json_object("props", "$.k").cast("long")
    rows = table(spark, sf, "events").withColumn("k", k)
    return rows.select(
        "ts", F.col("event_type").alias("path"), F.col("user_id").alias("who"), F.concat(F.lit("c"), F.col("user_id") % 40).alias("client"), F.concat(F.lit("m"), F.col("k") % 3).alias("model"), F.concat(F.lit("agent/"), F.col("k") % 5).alias("user_agent"),
        F.when(F.col("k") % 17 == 0, 401).when(F.col("k") % 13 == 0, 503).otherwise(200).alias("status"), (F.col("k") % 11 == 0).alias("limited"), (F.col("value") * 10).alias("total_ms"), F.col("value").alias("first_byte_ms"), (F.col("k") % 7).alias("output_tokens"),
    )


def _minute():
    return F.date_trunc("minute", F.col("ts")).cast("timestamp_ntz")


@query(f"""WITH {_REQUESTS} SELECT count(*) AS requests, count(*) FILTER (WHERE path IN ('click','view')) AS model_requests, count(DISTINCT client) AS clients, count(*) FILTER (WHERE status = 401) AS unauthorised,
count(*) FILTER (WHERE limited) AS limited, count(*) FILTER (WHERE status >= 500) AS errors FROM r""")
def dash_totals(spark, sf):
    """Panels 1 to 6 in one pass."""
    return requests(spark, sf).agg(
        F.count(F.lit(1)).alias("requests"), F.count_if(F.col("path").isin(MODEL_PATHS)).alias("model_requests"), F.countDistinct("client").alias("clients"),
        F.count_if(F.col("status") == 401).alias("unauthorised"), F.count_if("limited").alias("limited"), F.count_if(F.col("status") >= 500).alias("errors"),
    )


@query(f"WITH {_REQUESTS} SELECT date_trunc('minute', ts) AS minute, path, count(*) AS n FROM r GROUP BY 1, 2")
def dash_requests_per_minute(spark, sf):
    return requests(spark, sf).groupBy(_minute().alias("minute"), "path").agg(F.count(F.lit(1)).alias("n"))


@query(f"WITH {_REQUESTS} SELECT date_trunc('minute', ts) AS minute, model, count(*) AS n FROM r WHERE path IN ('click','view') GROUP BY 1, 2")
def dash_models_per_minute(spark, sf):
    return requests(spark, sf).where(F.col("path").isin(MODEL_PATHS)).groupBy(_minute().alias("minute"), "model").agg(F.count(F.lit(1)).alias("n"))


@query(f"WITH {_REQUESTS} SELECT model, round(sum(output_tokens) * 1000.0 / sum(total_ms - first_byte_ms), 6) AS tokens_per_second FROM r WHERE output_tokens > 0 AND total_ms > first_byte_ms GROUP BY model")
def dash_output_rate(spark, sf):
    rows = requests(spark, sf).where("output_tokens > 0 and total_ms > first_byte_ms")
    return rows.groupBy("model").agg(F.round(F.sum("output_tokens") * 1000.0 / F.sum(F.col("total_ms") - F.col("first_byte_ms")), 6).alias("tokens_per_second"))


@query(f"WITH {_REQUESTS} SELECT date_trunc('minute', ts) AS minute, model, round(quantile_cont(total_ms, 0.95), 6) AS p95 FROM r WHERE path IN ('click','view') AND NOT limited GROUP BY 1, 2")
def dash_p95_by_model(spark, sf):
    """Exact within a minute and model, which bounds a group; over longer spans take approx_percentile."""
    rows = requests(spark, sf).where(F.col("path").isin(MODEL_PATHS) & ~F.col("limited")).groupBy(_minute().alias("minute"), "model")
    return rows.agg(F.round(F.percentile("total_ms", F.lit(0.95)), 6).alias("p95"))


@query(f"WITH {_REQUESTS} SELECT date_trunc('minute', ts) AS minute, model, round(quantile_cont(first_byte_ms, 0.5), 6) AS p50 FROM r WHERE path IN ('click','view') AND NOT limited GROUP BY 1, 2")
def dash_p50_first_byte(spark, sf):
    rows = requests(spark, sf).where(F.col("path").isin(MODEL_PATHS) & ~F.col("limited")).groupBy(_minute().alias("minute"), "model")
    return rows.agg(F.round(F.percentile("first_byte_ms", F.lit(0.5)), 6).alias("p50"))


@query(f"WITH {_REQUESTS} SELECT path, count(*) AS n, count(*) FILTER (WHERE status = 401) AS unauthorized, count(*) FILTER (WHERE status >= 500) AS failed, round(quantile_cont(total_ms, 0.5), 6) AS p50 FROM r GROUP BY path")
def dash_by_route(spark, sf):
    """The median of a route, which may hold most of the log, is found by counting in ranges."""
    rows = requests(spark, sf)
    counts = rows.groupBy("path").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("status") == 401).alias("unauthorized"), F.count_if(F.col("status") >= 500).alias("failed"))
    middle = Q.quantiles(rows, ["path"], "total_ms", {"p50": 0.5}).select(F.col("path").alias("route"), F.round("p50", 6).alias("p50"))
    return counts.join(middle, F.col("path").eqNullSafe(F.col("route"))).drop("route")


@query(f"WITH {_REQUESTS} SELECT client, count(*) AS n, count(DISTINCT path) AS paths, max(user_agent) AS agent FROM r GROUP BY client ORDER BY n DESC, client LIMIT 50")
def dash_top_clients(spark, sf):
    """The top 50; ties go to the smaller name."""
    return requests(spark, sf).groupBy("client").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("path").alias("paths"), F.max("user_agent").alias("agent")).orderBy(F.desc("n"), "client").limit(50)


@query(f"WITH {_REQUESTS} SELECT who, count(*) FILTER (WHERE path IN ('click','view')) AS asked, count(*) FILTER (WHERE limited) AS refused, CAST(sum(output_tokens) AS BIGINT) AS tokens FROM r GROUP BY who")
def dash_per_person(spark, sf):
    return requests(spark, sf).groupBy("who").agg(F.count_if(F.col("path").isin(MODEL_PATHS)).alias("asked"), F.count_if("limited").alias("refused"), F.sum("output_tokens").alias("tokens"))


@query(f"WITH {_REQUESTS} SELECT CAST(status AS VARCHAR) AS status, count(*) AS n FROM r GROUP BY 1")
def dash_by_status(spark, sf):
    return requests(spark, sf).groupBy(F.col("status").cast("string").alias("status")).agg(F.count(F.lit(1)).alias("n"))


@query(f"WITH {_REQUESTS} SELECT path AS server, round(avg(CASE WHEN status < 500 THEN 100.0 ELSE 0.0 END), 6) AS up, max(total_ms) AS latency_ms FROM r GROUP BY path")
def dash_uptime(spark, sf):
    return requests(spark, sf).groupBy(F.col("path").alias("server")).agg(F.round(F.avg(F.when(F.col("status") < 500, 100.0).otherwise(0.0)), 6).alias("up"), F.max("total_ms").alias("latency_ms"))


@query(f"WITH {_REQUESTS} SELECT date_trunc('minute', ts) AS minute, min(total_ms) AS least FROM r WHERE path = 'view' GROUP BY 1")
def dash_least_per_minute(spark, sf):
    return requests(spark, sf).where("path = 'view'").groupBy(_minute().alias("minute")).agg(F.min("total_ms").alias("least"))


@query(f"WITH {_REQUESTS} SELECT path, status, count(*) AS n FROM r WHERE NOT (path = 'view' AND status < 400) GROUP BY path, status")
def dash_logged_polls(spark, sf):
    """Successful polls are not logged; failed ones are."""
    return requests(spark, sf).where("not (path = 'view' and status < 400)").groupBy("path", "status").agg(F.count(F.lit(1)).alias("n"))


@query("""SELECT p_brand AS model_id, CAST(sum(p_size) AS BIGINT) AS bytes, count(*) AS files FROM part GROUP BY p_brand ORDER BY bytes, model_id""")
def capacity_variants(spark, sf):
    return table(spark, sf, "part").groupBy(F.col("p_brand").alias("model_id")).agg(F.sum("p_size").alias("bytes"), F.count(F.lit(1)).alias("files")).orderBy("bytes", "model_id")


@query("""WITH s AS (SELECT * FROM (VALUES ('a', 32, 8, 4, 1024, 1), ('b', 0, 12, 2, 512, 4), ('c', 24, 0, 8, 0, 2)) v(model, full_layers, sliding_layers, per_token, win, slots)), c AS (SELECT unnest([8192, 4096, 2048, 1024, 512, 256]) AS ctx)
SELECT model, CAST(ctx AS INT) AS ctx, CAST((full_layers * ctx + sliding_layers * least(ctx, win)) * per_token * slots AS BIGINT) AS bytes, (full_layers * ctx + sliding_layers * least(ctx, win)) * per_token * slots <= 500000 AS fits FROM s, c""")
def capacity_kv_cache(spark, sf):
    """Cache bytes over the halving series of contexts, and whether they fit."""
    shapes = spark.createDataFrame([("a", 32, 8, 4, 1024, 1), ("b", 0, 12, 2, 512, 4), ("c", 24, 0, 8, 0, 2)], "model string, full_layers long, sliding_layers long, per_token long, win long, slots long")
    series = F.transform(F.sequence(F.lit(0), F.lit(5)), lambda i: F.shiftright(F.lit(8192), 0) / F.pow(F.lit(2), i)).cast("array<int>")
    rows = shapes.withColumn("ctx", F.explode(series))
    total = (F.col("full_layers") * F.col("ctx") + F.col("sliding_layers") * F.least(F.col("ctx").cast("long"), "win")) * F.col("per_token") * F.col("slots")
    return rows.select("model", "ctx", total.alias("bytes"), (total <= 500_000).alias("fits"))


@query("SELECT who, strftime(to_timestamp(created) AT TIME ZONE 'UTC', '%Y-%m-%d %H:%M:%SZ') AS created FROM (VALUES ('a', 0), ('b', 1700000000), ('c', 951782400)) v(who, created)")
def people_created(spark, sf):
    rows = spark.createDataFrame([("a", 0), ("b", 1700000000), ("c", 951782400)], "who string, created long")
    return rows.select("who", F.date_format(F.timestamp_seconds("created"), "yyyy-MM-dd HH:mm:ss'Z'").alias("created"))
