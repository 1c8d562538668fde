"""Model catalogue queries: files, sizes, contexts, recipes."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from millrace.functions import fixed
from millrace.operators import models as K

from .curate import _literal
from .registry import query, table

_FILES = [
    ("a/one", "m-Q4_K_M.gguf", 40), ("a/one", "m-Q8_0-00001-of-00002.gguf", 50), ("a/one", "m-Q8_0-00002-of-00002.gguf", 45), ("a/one", "mmproj-x.gguf", 9), ("a/one", "draft/m-draft-Q4_K_M.gguf", 3),
    ("b/two", "model-1.safetensors", 70), ("b/two", "model-2.safetensors", 71), ("b/two", "config.json", 1), ("c/three", "x-Q6_K.gguf", 30), ("c/three", "x-Q6_K-00001-of-00001.gguf", 31), ("c/three", "x-MXFP4.gguf", 12), ("d/four", "readme.md", 0),
]
_FILES_SQL = f"f AS (SELECT * FROM (VALUES {_literal(_FILES)}) v(repo, path, size)), g AS (SELECT *, regexp_replace(regexp_replace(regexp_extract(path, '[^/]*$'), '-\\d{{5}}-of-\\d{{5}}\\.gguf$', ''), '\\.gguf$', '') AS model_id FROM f WHERE ends_with(path, '.gguf') AND NOT regexp_matches(path, '{fixed.GGUF_HELPER}'))"


def _files(spark):
    return spark.createDataFrame(_FILES, "repo string, path string, size long")


@query(f"WITH {_FILES_SQL} SELECT repo, model_id, CAST(sum(size) AS BIGINT) AS bytes, count(*) AS parts FROM g GROUP BY repo, model_id")
def models_variants(spark, sf):
    return K.variants(_files(spark)).orderBy("repo", "bytes")


@query(f"""WITH {_FILES_SQL}, t AS (SELECT repo, nullif(CAST(sum(CASE WHEN ends_with(path, '.safetensors') THEN size ELSE 0 END) AS BIGINT), 0) AS tensors FROM f GROUP BY repo), s AS (SELECT repo, min(b) AS smallest FROM (SELECT repo, model_id, CAST(sum(size) AS BIGINT) AS b FROM g GROUP BY ALL) GROUP BY repo)
SELECT repo, tensors, smallest FROM t LEFT JOIN s USING (repo)""")
def models_weights(spark, sf):
    return K.weights(_files(spark))


@query(f"""WITH {_FILES_SQL}, q AS (SELECT repo, path, size, q, k FROM g, (SELECT unnest({fixed.QUANTS}) AS q, generate_subscripts({fixed.QUANTS}, 1) AS k) WHERE regexp_matches(path, '(^|[^A-Z0-9])' || q || '(_XL)?[.-]')),
p AS (SELECT repo, q, k, coalesce(min(size) FILTER (WHERE NOT contains(path, '-of-')), sum(size)) AS bytes FROM q GROUP BY ALL), r AS (SELECT *, row_number() OVER (PARTITION BY repo ORDER BY bytes > 60, CASE WHEN bytes > 60 THEN bytes ELSE k END) AS n FROM p)
SELECT repo, q AS quant, CAST(bytes AS BIGINT) AS bytes FROM r WHERE n = 1""")
def models_best_quant(spark, sf):
    """The first quantisation in order of preference within 60, else the smallest."""
    return K.best_quant(_files(spark), 60)


_PATHS = [("a/b.gguf",), ("../x",), ("/etc/x",), ("a/../b",), ("m-00002-of-00003.gguf",), ("m-00001-of-00003.gguf",), ("eagle-x.gguf",), ("sub/eagle_head.gguf",), ("beagle-x.gguf",)]


@query(rf"""SELECT path, NOT (starts_with(path, '/') OR regexp_matches(path, '(^|/)\.\.(/|$)')) AS inside, ends_with(path, '.gguf') AND NOT regexp_matches(path, '{fixed.GGUF_HELPER}') AS model, ends_with(path, '.gguf') AND NOT regexp_matches(path, '{fixed.GGUF_HELPER}') AND (NOT contains(path, '-of-') OR contains(path, '-00001-of-')) AS first_part FROM (VALUES {", ".join(f"('{x[0]}')" for x in _PATHS)}) v(path)""")
def models_paths(spark, sf):
    rows = spark.createDataFrame(_PATHS, "path string")
    return rows.select("path", K.stays_inside(F.col("path")).alias("inside"), K.is_model_file(F.col("path")).alias("model"), K.is_first_part(F.col("path")).alias("first_part"))


_CONFIGS = [
    ("plain", {"num_hidden_layers": 4, "num_attention_heads": 8, "hidden_size": 64, "max_position_embeddings": 4096, "vocab_size": 1000}),
    ("nested", {"text_config": {"layer_types": ["full_attention", "sliding_attention", "sliding_attention", "linear_attention"], "num_attention_heads": 4, "num_key_value_heads": 2, "head_dim": 16, "sliding_window": 512, "max_position_embeddings": 8192}, "vocab_size": 5000}),
    ("hybrid", {"hybrid_override_pattern": "M-M*-M*", "num_attention_heads": 2, "head_dim": 32, "max_position_embeddings": 1024, "quantization_config": {"kv_cache_scheme": {"num_bits": 8}}}),
]


def _shapes(spark):
    rows = spark.createDataFrame([(n, json.dumps(c)) for n, c in _CONFIGS], "name string, config string")
    return rows.select("name", K.kv_shape(F.col("config")).alias("s"))


@query("""WITH c AS (SELECT name, c::JSON AS c, coalesce(c::JSON->'text_config', c::JSON) AS t FROM (VALUES """ + _literal([(n, json.dumps(c)) for n, c in _CONFIGS]) + """) v(name, c)),
n AS (SELECT name, c, t, coalesce((t->>'num_attention_heads')::BIGINT, 1) AS heads, CASE WHEN (t->'layer_types') IS NOT NULL THEN len(list_filter((t->'layer_types')::VARCHAR[], lambda x: x = 'full_attention')) WHEN (t->>'hybrid_override_pattern') IS NOT NULL THEN length(t->>'hybrid_override_pattern') - length(replace(t->>'hybrid_override_pattern', '*', '')) ELSE coalesce((t->>'num_hidden_layers')::BIGINT, 0) END AS full_, CASE WHEN (t->'layer_types') IS NOT NULL THEN len(list_filter((t->'layer_types')::VARCHAR[], lambda x: x = 'sliding_attention')) ELSE 0 END AS slide FROM c),
d AS (SELECT *, coalesce((t->>'num_key_value_heads')::BIGINT, heads) AS kv, coalesce((t->>'head_dim')::BIGINT, (t->>'hidden_size')::BIGINT // heads) AS dim, (coalesce((c->'quantization_config'->'kv_cache_scheme'->>'num_bits')::BIGINT, 16) + 7) // 8 AS each FROM n)
SELECT name, CAST(full_ * 2 * kv * dim * each AS BIGINT) AS full_bytes, CAST(slide * 2 * kv * dim * each AS BIGINT) AS sliding_bytes, coalesce((t->>'sliding_window')::BIGINT, 0) AS "window", (t->>'max_position_embeddings')::BIGINT AS max_context, coalesce((t->>'vocab_size')::BIGINT, (c->>'vocab_size')::BIGINT) AS vocab FROM d""")
def models_shapes(spark, sf):
    """Cache shapes from configurations: layer lists, attention patterns, quantised caches."""
    return _shapes(spark).select("name", "s.*")


@query("""WITH p AS (SELECT p_partkey AS id, p_size * 1000000 AS weight, 1 + p_size % 4 AS slots, 20000000 + p_partkey % 7 * 5000000 AS room FROM part), c AS (SELECT id, weight, slots, room, 4096 // CAST(pow(2, k) AS BIGINT) AS ctx FROM p, range(0, 13) r(k)),
f AS (SELECT id, max(ctx) FILTER (WHERE weight + 1024 * ctx * slots <= room) AS largest FROM c GROUP BY id)
SELECT id, largest, CASE WHEN weight + 1024 * 4096 * slots <= room THEN 'fits at max' WHEN weight <= room THEN 'fits, smaller context' ELSE 'too big' END AS word FROM p JOIN f USING (id)""")
def models_fit(spark, sf):
    """The largest of a context and its halves that fits the memory, and the word for it (here: parts as models)."""
    rows = table(spark, sf, "part").select(F.col("p_partkey").alias("id"), (F.col("p_size") * 1_000_000).cast("long").alias("weight"), (1 + F.col("p_size") % 4).cast("long").alias("slots"), (20_000_000 + F.col("p_partkey") % 7 * 5_000_000).alias("room"))
    shape = F.struct(F.lit(1024).cast("long").alias("full_bytes"), F.lit(0).cast("long").alias("sliding_bytes"), F.lit(0).cast("long").alias("window"), F.lit(4096).cast("long").alias("max_context"))
    rows = rows.withColumn("s", shape)
    cost = F.col("weight") + K.cache_bytes(F.col("s"), F.lit(4096), F.col("slots"))
    return rows.select("id", K.largest_context(F.col("s"), F.col("weight"), F.col("slots"), F.col("room")).alias("largest"), K.fit_word(cost, F.col("weight"), F.col("room")).alias("word"))


@query("""SELECT o_orderkey AS id, format('{:.1f} GB', o_totalprice * 100000 / 1e9) AS size, format('{:,}', o_orderkey * 1000) AS tokens, CAST(least(8192, o_orderkey // 2) // 2 * 1000 * 6 AS BIGINT) AS workspace,
CASE WHEN CAST(least(8192, o_orderkey // 2) // 2 * 1000 * 6 AS BIGINT) <= 3000000 THEN 'known to build' WHEN CAST(least(8192, o_orderkey // 2) // 2 * 1000 * 6 AS BIGINT) >= 9000000 THEN 'likely to fail' ELSE 'untested' END AS outlook, CASE WHEN o_orderkey >= 1 + o_orderkey % 5 THEN o_orderkey // (1 + o_orderkey % 5) END AS slot_context FROM orders""")
def models_words(spark, sf):
    """Sizes and counts in words, draft workspace and its outlook, context of a slot (here: orders as figures)."""
    k = F.col("o_orderkey")
    rows = table(spark, sf, "orders").withColumn("w", K.draft_workspace(k, F.lit(8192), F.lit(1000)))
    return rows.select(k.alias("id"), K.gigabytes(F.col("o_totalprice") * 100_000).alias("size"), K.thousands(k * 1000).alias("tokens"), F.col("w").alias("workspace"), K.outlook(F.col("w"), F.lit(3_000_000), F.lit(9_000_000)).alias("outlook"), K.slot_context(k, 1 + k % 5).alias("slot_context"))


@query("SELECT * FROM (VALUES (1, 4096::BIGINT), (2, 2560::BIGINT)) v(id, bytes)")
def models_gguf_cache(spark, sf):
    """Cache bytes a token from file metadata. The SQL states the expected rows."""
    rows = spark.createDataFrame([(1, 4, [4], 64, 64), (2, 4, [4, 0, 0, 6], 64, 64)], "id int, blocks long, heads array<long>, k long, v long")
    return rows.select("id", K.gguf_kv_bytes(F.col("blocks"), F.col("heads"), F.col("k"), F.col("v")).alias("bytes"))


_PAGES, _FAMILIES = [("Google/Gemma4.md",), ("Qwen/Qwen3.5.md",), ("a/b/Deep.md",), (".github/Gemma4.md",), ("Top.md",), ("X/ab.md",)], [("gemma4",), ("qwen3_5_moe",), ("ab",), ("gemma",)]


@query(f"""WITH p AS (SELECT path, lower(regexp_replace(regexp_replace(regexp_extract(path, '[^/]*$'), '\\.md$', ''), '[^A-Za-z0-9]', '', 'g')) AS page FROM (VALUES {", ".join(f"('{x[0]}')" for x in _PAGES)}) v(path) WHERE regexp_matches(path, '^[^./][^/]*/[^/]*\\.md$')),
f AS (SELECT family, lower(regexp_replace(family, '[^A-Za-z0-9]', '', 'g')) AS w FROM (VALUES {", ".join(f"('{x[0]}')" for x in _FAMILIES)}) v(family)) SELECT family, path FROM p, f WHERE length(page) >= 3 AND length(w) >= 3 AND (contains(page, w) OR contains(w, page))""")
def models_recipes(spark, sf):
    return K.matching_recipes(spark.createDataFrame(_PAGES, "path string"), spark.createDataFrame(_FAMILIES, "family string"))


@query("""WITH r AS (SELECT user_id AS host, event_id AS k, sum(CAST(floor(value) AS BIGINT)) OVER w AS b, sum(CAST(floor(value) AS BIGINT) + event_id % 9 + 1) OVER w AS t FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id)), d AS (SELECT host, k, b - lag(b) OVER w AS b, t - lag(t) OVER w AS t FROM r WINDOW w AS (PARTITION BY host ORDER BY k))
SELECT host, k AS "at", round(100.0::DOUBLE * greatest(b, 0) / t, 1) AS busy FROM d WHERE t > 0""")
def models_busy_percent(spark, sf):
    """Processor time between readings (here: running sums of event values)."""
    from pyspark.sql import Window

    w = Window.partitionBy("user_id").orderBy("event_id")
    ticks = F.floor("value").cast("long")
    rows = table(spark, sf, "events").select(F.col("user_id").alias("host"), F.col("event_id").alias("at"), F.sum(ticks).over(w).alias("busy_ticks"), F.sum(ticks + F.col("event_id") % 9 + 1).over(w).alias("total_ticks"))
    return K.busy_percent(rows)


_REPLY = json.dumps([{"type": "file", "path": "a.gguf", "size": 5}, {"type": "directory", "path": "d"}, {"type": "file", "path": "../x", "size": 1}, {"type": "file", "path": "d/b.json"}])


@query("SELECT * FROM (VALUES ('r', 'a.gguf', 5::BIGINT), ('r', 'd/b.json', 0::BIGINT)) v(repo, path, size)")
def models_hub_files(spark, sf):
    """Files of a listing that stay in their folder. The SQL states the expected rows."""
    return K.hub_files(spark.createDataFrame([("r", _REPLY)], "repo string, reply string"))
