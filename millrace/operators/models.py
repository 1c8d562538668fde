"""Model files, memory for contexts, and what fits."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as Y

from millrace.functions import fixed


def is_model_file(path: Column) -> Column:
    """A model rather than a helper of one."""
    return F.endswith(path, F.lit(".gguf")) & ~path.rlike(fixed.GGUF_HELPER)


def is_first_part(path: Column) -> Column:
    return is_model_file(path) & (~F.contains(path, F.lit("-of-")) | F.contains(path, F.lit("-00001-of-")))


def model_id(path: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.element_at(F.split(path, "/"), -1), fixed.GGUF_PART, ""), r"(?:\.gguf)+$", "")


def stays_inside(path: Column) -> Column:
    """A relative path without `..`."""
    return (path != "") & ~F.startswith(path, F.lit("/")) & ~path.rlike(r"(^|/)\.\.?(/|$)")


def hub_files(replies: DataFrame) -> DataFrame:
    """path, size of the files in JSON lists (reply) that stay in their folder."""
    rows = replies.select(*[c for c in replies.columns if c != "reply"], F.explode(F.from_json("reply", "array<struct<type:string,path:string,size:bigint>>")).alias("f"))
    return rows.where((F.col("f.type") == "file") & stays_inside(F.col("f.path"))).select(*[c for c in replies.columns if c != "reply"], "f.path", F.coalesce("f.size", F.lit(0)).alias("size"))


def variants(files: DataFrame) -> DataFrame:
    """repo, model_id, bytes, parts of each quantisation."""
    return files.where(is_model_file(F.col("path"))).groupBy("repo", model_id(F.col("path")).alias("model_id")).agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("parts"))


def weights(files: DataFrame) -> DataFrame:
    """repo, tensors (sum of the tensor files), smallest (of the variants); null where there are none."""
    tensors = files.groupBy("repo").agg(F.nullif(F.sum(F.when(F.endswith("path", F.lit(".safetensors")), F.col("size")).otherwise(0)), F.lit(0)).alias("tensors"))
    return tensors.join(variants(files).groupBy("repo").agg(F.nullif(F.min("bytes"), F.lit(0)).alias("smallest")), "repo", "left")


def best_quant(files: DataFrame, room: int) -> DataFrame:
    """repo, quant, bytes: the first quantisation in order of preference that fits in `room`, else the smallest.

    Of a quantisation's files, an unsplit one (the smallest) is taken before the parts of a split one."""
    quant = F.coalesce(*[F.when(F.element_at(F.split("path", "/"), -1).rlike(rf"(?<![A-Z\d]){q}(?:_XL)?(?=[.-])"), F.lit(k)) for k, q in enumerate(fixed.QUANTS)])
    split = F.contains("path", F.lit("-of-"))
    per = files.where(is_model_file(F.col("path"))).select("repo", "size", quant.alias("k"), split.alias("split")).where("k is not null").groupBy("repo", "k")
    per = per.agg(F.coalesce(F.min(F.when(~F.col("split"), F.col("size"))), F.sum("size")).alias("bytes"))
    best = per.groupBy("repo").agg(F.min(F.when(F.col("bytes") <= room, F.struct(F.col("k").cast("long").alias("o"), "k", "bytes"))).alias("fits"), F.min(F.struct(F.col("bytes").alias("o"), "k", "bytes")).alias("least"))
    found = F.coalesce("fits", "least")
    return best.select("repo", F.element_at(F.array(*map(F.lit, fixed.QUANTS)), found["k"] + 1).alias("quant"), found["bytes"].alias("bytes"))


def kv_shape(config: Column) -> Column:
    """Of a JSON configuration: full and sliding cache bytes a token, window, longest context, vocabulary."""
    text = F.coalesce(*[F.get_json_object(config, f"$.{s}") for s in ("text_config", "language_config", "llm_config")], config)
    number = lambda k: F.get_json_object(text, f"$.{k}").try_cast("bigint")
    types = F.from_json(F.get_json_object(text, "$.layer_types"), "array<string>")
    named = lambda n: F.size(F.filter(types, lambda t: t == n)).cast("long")
    pattern = F.get_json_object(text, "$.hybrid_override_pattern")
    stars = F.length(pattern) - F.length(F.replace(pattern, F.lit("*"), F.lit("")))
    full = F.when(types.isNotNull(), named("full_attention")).when(pattern.isNotNull(), stars.cast("long")).otherwise(F.coalesce(number("num_hidden_layers"), F.lit(0)))
    sliding = F.when(types.isNotNull(), named("sliding_attention")).otherwise(0)
    heads = F.greatest(F.coalesce(number("num_attention_heads"), F.lit(1)), F.lit(1))
    kv = F.coalesce(number("num_key_value_heads"), heads)
    dim = F.coalesce(number("head_dim"), F.floor(F.coalesce(number("hidden_size"), F.lit(0)) / heads).cast("long"))
    bits = F.coalesce(F.get_json_object(config, "$.quantization_config.kv_cache_scheme.num_bits").try_cast("bigint"), F.lit(16))
    each = F.ceil(bits / 8).cast("long")
    return F.struct(
        (full * 2 * F.coalesce(number("num_global_key_value_heads"), kv) * F.coalesce(number("global_head_dim"), dim) * each).cast("long").alias("full_bytes"),
        (sliding * 2 * kv * dim * each).cast("long").alias("sliding_bytes"), F.coalesce(number("sliding_window"), F.lit(0)).alias("window"),
        F.coalesce(number("max_position_embeddings"), F.get_json_object(config, "$.max_position_embeddings").try_cast("bigint")).alias("max_context"),
        F.coalesce(number("vocab_size"), F.get_json_object(config, "$.vocab_size").try_cast("bigint")).alias("vocab"),
    )


def cache_bytes(shape: Column, context: Column, slots: Column) -> Column:
    return (shape["full_bytes"] * context + shape["sliding_bytes"] * F.least(context, shape["window"])) * slots


def context_choices(longest: Column, least: int = 1) -> Column:
    """The longest context and its halves down to `least`."""
    return F.filter(F.transform(F.sequence(F.lit(0), F.lit(62)), lambda k: F.floor(longest / F.pow(F.lit(2.0), k)).cast("long")), lambda c: c >= max(1, least))


def usable(available: Column, freed: Column, keep: Column, limit: Column) -> Column:
    free = F.greatest(available + freed - keep, F.lit(0))
    return F.least(free, F.coalesce(limit, free))


def largest_context(shape: Column, weight: Column, slots: Column, room: Column) -> Column:
    return F.get(F.filter(context_choices(shape["max_context"]), lambda c: weight + cache_bytes(shape, c, slots) <= room), F.lit(0))


def fit_word(cost_at_longest: Column, weight: Column, room: Column) -> Column:
    return F.when(cost_at_longest <= room, "fits at max").when(weight <= room, "fits, smaller context").when(weight.isNotNull(), "too big").otherwise("size unknown")


@F.arrow_udf(Y.StringType())
def _one_decimal(x: pa.Array) -> pa.Array:
    """Numbers with one decimal, by their exact binary values and halves to even; format_string rounds their shortest digits, halves up."""
    return pa.array([None if v is None else f"{v:.1f}" for v in x.to_pylist()], pa.string())


def gigabytes(n: Column) -> Column:
    return F.concat(_one_decimal(n / F.lit(1e9)), F.lit(" GB"))


def thousands(n: Column) -> Column:
    return F.format_number(n, 0)


def draft_workspace(context: Column, prompt: Column, vocab: Column) -> Column:
    return (F.floor(F.least(prompt, F.floor(context / 2)) / 2) * vocab * fixed.LM_HEAD_BYTES).cast("long")


def outlook(workspace: Column, built: Column, failed: Column) -> Column:
    return F.when(workspace <= built, "known to build").when(workspace >= failed, "likely to fail").otherwise("untested")


def gguf_kv_bytes(blocks: Column, kv_heads: Column, key_length: Column, value_length: Column) -> Column:
    """Cache bytes a token of layers with kv_heads heads each (an array: one entry a layer; 0: no attention)."""
    per_layer = F.aggregate(kv_heads, F.lit(0).cast("long"), lambda a, h: a + h)
    heads = F.when(F.size(kv_heads) == 1, F.get(kv_heads, F.lit(0)) * blocks).otherwise(per_layer)
    return 2 * heads * (key_length + value_length)


def slot_context(context: Column, parallel: Column) -> Column:
    slots = F.when(parallel > 0, parallel).otherwise(1)
    return F.when(context >= slots, F.floor(context / slots).cast("long"))


def _plain(text: Column) -> Column:
    return F.lower(F.regexp_replace(text, "[^A-Za-z0-9]", ""))


def matching_recipes(pages: DataFrame, families: DataFrame) -> DataFrame:
    """family, path: pages one folder deep whose name and the family contain one another, three characters at least.

    Families are few and given to every task; pages are read once."""
    fine = F.endswith("path", F.lit(".md")) & (F.size(F.split("path", "/")) == 2) & ~F.startswith("path", F.lit("."))
    rows = pages.where(fine).select("path", _plain(F.regexp_replace(F.element_at(F.split("path", "/"), -1), r"(?:\.md)+$", "")).alias("page"))
    wanted = families.select("family", _plain(F.col("family")).alias("wanted")).where(F.length("wanted") >= 3)
    known = [r for r in wanted.limit(1_001).collect()]  # the families asked for: a handful; more are joined
    if len(known) > 1_000:
        return rows.join(wanted, (F.length("page") >= 3) & (F.contains("page", F.col("wanted")) | F.contains("wanted", F.col("page")))).select("family", "path")
    hits = [F.when(F.contains("page", F.lit(r["wanted"])) | F.contains(F.lit(r["wanted"]), F.col("page")), F.lit(r["family"])) for r in known]
    return rows.where(F.length("page") >= 3).select("path", F.explode(F.array_compact(F.array(*hits))).alias("family")).select("family", "path") if hits else rows.select(F.lit("").alias("family"), "path").limit(0)


def busy_percent(readings: DataFrame) -> DataFrame:
    """host, at, busy: percent of processor time between one reading (busy, total) and the next, one decimal."""
    w = Window.partitionBy("host").orderBy("at")
    rows = readings.withColumns({"b": F.col("busy_ticks") - F.lag("busy_ticks").over(w), "t": F.col("total_ticks") - F.lag("total_ticks").over(w)})
    return rows.where("t > 0").select("host", "at", F.round(100.0 * F.greatest("b", F.lit(0)) / F.col("t"), 1).alias("busy"))
