"""Streamed replies: assembly, tool calls in text, repeated calls, timing, token counts, and the guard against loops."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions import automaton, fixed

from .scratch import kept
from .stats import sign_test


def _joined(order: str, piece: Column) -> Column:
    return F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.coalesce(piece, F.lit("")).alias("p")))), lambda x: x["p"]), "")


def contents(chunks: DataFrame) -> DataFrame:
    """reply, content: the text pieces (reply, seq, content) of each reply in order."""
    return chunks.groupBy("reply").agg(_joined("seq", F.col("content")).alias("content"))


def calls(pieces: DataFrame) -> DataFrame:
    """reply, index, name, arguments: the pieces (reply, seq, index, name, arguments) of each tool call; indexes of MAX_CALLS and more are left out."""
    return pieces.where(F.col("index") < fixed.MAX_CALLS).groupBy("reply", "index").agg(_joined("seq", F.col("name")).alias("name"), _joined("seq", F.col("arguments")).alias("arguments"))


def repeated_calls(made: DataFrame) -> DataFrame:
    """Calls (reply, seq, name, arguments) with `ran`: an earlier call of the reply has the same name and arguments."""
    w = Window.partitionBy("reply", "name", "arguments").orderBy("seq")
    return made.withColumn("ran", F.row_number().over(w) > 1)


def timing(chunks: DataFrame) -> DataFrame:
    """Of each reply (reply, started, at, tokens; times in seconds): first token, decode rate and whole rate; null without two times."""
    rows = chunks.groupBy("reply").agg(F.min("started").alias("s"), F.min("at").alias("first"), F.max("at").alias("last"), F.max("tokens").alias("n"))
    span = F.nullif(F.col("last") - F.col("first"), F.lit(0.0))
    return rows.select("reply", F.round(F.col("first") - F.col("s"), 3).alias("first_token_s"), F.round((F.col("n") - 1) / span, 2).alias("decode_rate"), F.round(F.col("n") / F.nullif(F.col("last") - F.col("s"), F.lit(0.0)), 2).alias("whole_rate"))


def largest_count(text: Column, names: list[str]) -> Column:
    """The largest number after one of the JSON names, or 0."""
    found = F.regexp_extract_all(text, F.lit('"(?:' + "|".join(names) + r')"\s*:\s*(\d+)'), F.lit(1))
    return F.coalesce(F.array_max(F.transform(found, lambda x: x.cast("bigint"))), F.lit(0))


def visible_text(text: Column) -> Column:
    """A reply without its tool calls; a block that is not closed is hidden if it reads as a call."""
    whole = F.regexp_replace(text, r"(?is)<tool_call[^>]*>.*?</tool_call>", "")
    tail = F.regexp_extract(whole, r"(?is)<tool_call[^>]*>(.*)\z", 1)
    opened = whole.rlike(r"(?is)<tool_call[^>]*>")
    return F.when(~opened, whole).otherwise(F.concat(F.regexp_replace(whole, r"(?is)<tool_call[^>]*>.*\z", ""), F.when(_call(tail)["name"].isNull(), tail).otherwise("")))


def _call(block: Column) -> Column:
    bare = F.trim(block)
    get = lambda *keys: F.coalesce(*[F.get_json_object(bare, f"$.{k}") for k in keys])
    keys = F.transform(F.regexp_extract_all(bare, F.lit(r"(?is)<parameter=([^>]*)>(.*?)(?:</parameter>|\z)"), F.lit(1)), lambda x: F.trim(x))
    values = F.transform(F.regexp_extract_all(bare, F.lit(r"(?is)<parameter=([^>]*)>(.*?)(?:</parameter>|\z)"), F.lit(2)), lambda x: F.trim(x))
    pairs = F.filter(F.arrays_zip(keys.alias("key"), values.alias("value")), lambda p: p["key"] != "")
    tagged = F.to_json(F.map_from_entries(pairs))
    is_json = F.startswith(bare, F.lit("{"))
    name = F.trim(F.when(is_json, get("name", "tool")).otherwise(F.regexp_extract(bare, r"(?is)<function=([^>]*)>", 1)))
    arguments = F.when(is_json, F.coalesce(get("arguments", "parameters", "args"), F.lit("{}"))).otherwise(tagged)
    return F.struct(F.nullif(name, F.lit("")).alias("name"), arguments.alias("arguments"))


def text_calls(text: Column) -> Column:
    """{name, arguments} of the tool calls written in a reply, in tags or as JSON; the last block may be unclosed."""
    blocks = F.regexp_extract_all(text, F.lit(r"(?is)<tool_call[^>]*>(.*?)(?:</tool_call>|\z)"), F.lit(1))
    return F.filter(F.transform(blocks, _call), lambda c: c["name"].isNotNull())


def ends_in_copies(data: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Whether the bytes up to each of `ends` end in copies of one unit, of the widths and numbers in REPEATS.

    Where bytes equal those `width` before them for a stretch of (copies - 1) widths, the stretch and the unit before it are copies."""
    out = np.zeros(len(ends), bool)
    for (low, high), copies in fixed.REPEATS:
        for width in range(low, min(high, len(data) // copies) + 1):
            other = np.flatnonzero(data[width:] != data[:-width]) + width  # places that break a stretch
            broken = np.concatenate([[width - 1], other])[np.searchsorted(other, ends, "left")]
            out |= (ends - 1 - broken >= width * (copies - 1)) & (ends >= width * copies)
    return out


def _channel(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Of one channel's chunks: at which the blank bytes in a row pass the bound, and which end in copies."""
    raw = [(t or "").encode() for t in texts]
    ends = np.cumsum([len(r) for r in raw])
    data = np.frombuffer(b"".join(raw), np.uint8)
    said = np.array([t is not None for t in texts])
    ink = np.where(automaton.white(data), -1, np.arange(len(data)))
    blank = np.arange(len(data)) - np.maximum.accumulate(ink) if len(data) else ink
    over = np.concatenate([[0], np.cumsum(blank >= fixed.MAX_BLANK)])
    blanks = over[ends] > over[np.concatenate([[0], ends[:-1]])]
    return blanks & said, ends_in_copies(data, ends) & said


def guard(chunks: DataFrame) -> DataFrame:
    """reply, seq, reason: the first chunk (reply, seq, content, reasoning) at which a reply must stop: size, empty, blank or repeated.

    A reply is bounded by its size limit: of one that is longer, only the chunks up to the limit are looked at, so one is a small group."""

    def watch(table: pa.Table) -> pa.Table:
        table = table.sort_by("seq")
        content, reasoning = table.column("content").to_pylist(), table.column("reasoning").to_pylist()
        size = np.cumsum([len((c or "").encode()) + len((r or "").encode()) for c, r in zip(content, reasoning)])
        n = min(len(size), int(np.searchsorted(size, fixed.MAX_ROUND, "right")) + 1)
        content, reasoning = content[:n], reasoning[:n]
        said = np.array([c is not None or r is not None for c, r in zip(content, reasoning)])
        full = np.array([bool(c) or bool(r) for c, r in zip(content, reasoning)])
        quiet = np.cumsum(said & ~full)  # chunks that say nothing, since the last one that says something
        since = quiet - np.maximum.accumulate(np.where(full, quiet, 0))
        checks = [("size", size[:n] > fixed.MAX_ROUND), ("empty", said & ~full & (since >= fixed.MAX_EMPTY))]
        for texts in (content, reasoning):
            blanks, copies = _channel(texts)
            checks += [("blank", blanks), ("repeated", copies)]
        first = min(((int(np.argmax(hit)), k) for k, (_, hit) in enumerate(checks) if hit.any()), default=None)
        keys = table.slice(first[0], 1) if first else table.slice(0, 0)
        return pa.table({"reply": keys.column("reply"), "seq": keys.column("seq"), "reason": pa.array([checks[first[1]][0]] if first else [], pa.string())})

    return chunks.select("reply", "seq", "content", "reasoning").groupBy("reply").applyInArrow(watch, "reply long, seq long, reason string")


#: Parts of the distinct differences, and resamples that a task draws at once.
_PARTS, _AT_ONCE = 32, 500


def bootstrap(pairs: DataFrame, resamples: int = 10_000, seed: int = 7, level: float = 0.95) -> DataFrame:
    """mean, low, high of the paired differences (id, difference): percentile interval over resamples of as many pairs.

    A resample is a multinomial draw of counts over the histogram of distinct differences, so its cost follows them and not the pairs:
    counts are drawn over parts of the histogram first, then within each part. Draws depend on the seed and the histogram alone. Null
    and NaN differences are left out; without any there is one row of nulls."""
    fine = pairs.where(F.col("difference").isNotNull() & ~F.isnan("difference")).select(F.col("difference").cast("double").alias("d"))
    bars = kept(fine.groupBy("d").agg(F.count(F.lit(1)).alias("n")).withColumn("part", F.pmod(F.xxhash64("d"), F.lit(_PARTS)).cast("int")), "histogram")
    sizes = np.zeros(_PARTS, np.int64)
    for r in bars.groupBy("part").agg(F.sum("n").alias("n")).collect():
        sizes[r["part"]] = r["n"]
    total = int(sizes.sum())

    def draw(rows: pa.Table) -> pa.Table:
        part = rows.column("part")[0].as_py()
        order = np.argsort(rows.column("d").to_numpy())
        d, n = rows.column("d").to_numpy()[order], rows.column("n").to_numpy()[order]
        many = np.random.default_rng(seed).multinomial(total, sizes / total, resamples)[:, part]
        rng, sums = np.random.default_rng((seed, part)), np.empty(resamples)
        step = max(1, min(_AT_ONCE, (4 << 20) // len(d)))
        for i in range(0, resamples, step):
            sums[i : i + step] = rng.multinomial(many[i : i + step], n / n.sum()) @ d
        return pa.table({"k": np.arange(resamples), "s": sums})

    means = bars.groupBy("part").applyInArrow(draw, "k long, s double").groupBy("k").agg((F.sum("s") / max(total, 1)).alias("m"))
    edge = (1 - level) / 2
    ends = means.agg(F.percentile("m", F.lit(edge)).alias("low"), F.percentile("m", F.lit(1 - edge)).alias("high"))  # of `resamples` rows
    return bars.agg((F.sum(F.col("d") * F.col("n")) / F.sum("n")).alias("mean")).crossJoin(F.broadcast(ends))  # one row each


def win_rate(pairs: DataFrame) -> DataFrame:
    """wins, losses, ties, win_rate (a tie is half a win; null without pairs) and p of the two-sided sign test, of pairs (one, other)."""
    counts = pairs.where("one is not null and other is not null").agg(F.count_if(F.col("one") > F.col("other")).alias("wins"), F.count_if(F.col("one") < F.col("other")).alias("losses"), F.count_if(F.col("one") == F.col("other")).alias("ties"))
    rate = (F.col("wins") + F.col("ties") / 2) / F.nullif(F.col("wins") + F.col("losses") + F.col("ties"), F.lit(0))
    return counts.withColumn("win_rate", rate).withColumn("p", sign_test(F.least("wins", "losses"), F.greatest("wins", "losses")))
