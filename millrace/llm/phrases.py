"""Phrase collocations by Apriori passes, one a phrase length (operator 11).

1. Words are counted by language. A word's key is a 64-bit hash of language and word; the words themselves travel with the counts
   and are compared where they meet, and the passes start again with another seed should two share a key.
2. The pass of length k broadcasts the frequent phrases of length k-1 as a filter of FILTER_BITS bits, two a phrase, whatever their
   number, and emits a phrase of k words only when both of its phrases of k-1 words may be frequent. What the filter lets through
   wrongly is counted like the rest and dropped by its count, so results are exact. A phrase's key is the keys of its words.
3. Tasks add up what they emit by sorting, FLUSH phrases at a time, and send one row a bucket of hashes; a bucket's rows are summed.
4. A candidate's cuts are scored from the level tables; a candidate is dropped for a phrase one word longer (of a phrase longer
   still, the phrase between is at least as frequent, so that one suffices).

Defined cases: a null or empty text has no words; a null lang is `und`; rows count as often as they stand there; texts of any
length are walked whole; equal scores are ordered by frequency, then by the phrase's bytes; an empty table gives no rows; other
columns, doc_id among them, are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import bytesops as B
from .scratch import BROADCAST_BYTES, keys_join, pieces, release, stored, text_bytes

U = np.uint64
LEAST, LONGEST, INSIDE, TOP = 10, 3, 50, 2000
#: Occurrences that a task holds before it adds them up and sends them on.
FLUSH = 3_000_000
#: Text bytes a bucket stands for.
BUCKET_BYTES = 8 << 20
FILTER_BITS = 27
BREAK = np.zeros(256, bool)
BREAK[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
GAP = BREAK.copy()
GAP[[0x20, 0x09]] = True


def words_of(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and rows of all words, and whether a word and the one after it stand in one piece."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)
    ink = ~GAP[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[off] = True
    first = ink.copy()
    first[1:] &= ~ink[:-1] | edge[1:-1]
    last = ink.copy()
    last[:-1] &= ~ink[1:] | edge[1:-1]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    row = np.searchsorted(off, start, "right") - 1
    breaks = np.cumsum(BREAK[data], dtype=np.int32)[start]
    together = np.zeros(len(start), bool)
    together[:-1] = (breaks[1:] == breaks[:-1]) & (row[1:] == row[:-1])
    return start, end, row, together


def word_keys(low: np.ndarray, start: np.ndarray, end: np.ndarray, salt: np.ndarray, seed: int) -> np.ndarray:
    """64-bit keys of the byte strings [start, end), each in the language that its salt stands for."""
    codes = B.mix((np.arange(1, 257, dtype=U) + U(257 * seed)) * B.STEP)
    sums = np.zeros(len(low) + 1, U)
    np.cumsum(codes[low] * B.powers(B.STEP, len(low)), out=sums[1:])
    spans = (sums[end] - sums[start]) * B.powers(B.UNSTEP, len(sums))[start] + (end - start).astype(U)
    return B.mix(B.mix(spans) + salt)


def lang_salt(lang: str, seed: int) -> int:
    return int.from_bytes(hashlib.blake2b(f"{seed} {lang}".encode(), digest_size=8).digest(), "little")


def keyed(batches: Iterator[pa.RecordBatch], seed: int):
    """Of each slice of (text, lang): lower-cased bytes, starts, ends, languages, each word's language, keys, togetherness."""
    for b in B.slices(batches):
        data, off = B.raw(b.column("text"))
        low = B.LOWER[data]
        start, end, row, together = words_of(low, off)
        langs = b.column("lang").dictionary_encode()
        names = langs.dictionary.to_pylist()
        salt = np.array([lang_salt(x, seed) for x in names], U)
        at = langs.indices.to_numpy(zero_copy_only=False)[row].astype(np.int32)
        yield low, start, end, names, at, word_keys(low, start, end, salt[at] if len(at) else np.zeros(0, U), seed), together


def folded(keys: np.ndarray) -> np.ndarray:
    """One hash of each row of word keys."""
    h = keys[:, 0]
    for j in range(1, keys.shape[1]):
        h = B.mix(h * B.STEP + keys[:, j])
    return h


def summed(h: np.ndarray, keys: np.ndarray, counts: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes, keys and sums of counts (or of ones) of the distinct rows of keys, in order of hashes."""
    if not len(h):
        return h, keys, np.zeros(0, np.int64)
    order = np.argsort(h, kind="stable")
    fresh = np.ones(len(h), bool)
    fresh[1:] = h[order[1:]] != h[order[:-1]]
    at = np.flatnonzero(fresh)
    if (keys[order] != keys[order[at]].repeat(np.diff(np.append(at, len(h))), axis=0)).any():  # two phrases under one hash
        order = np.lexsort((*keys.T, h))
        fresh[1:] = (keys[order[1:]] != keys[order[:-1]]).any(axis=1)
        at = np.flatnonzero(fresh)
    sums = np.diff(np.append(at, len(h))) if counts is None else np.add.reduceat(counts[order], at)
    return h[order[at]], keys[order[at]], sums


class Words:
    """Distinct words with counts and languages: concatenated bytes, sizes, keys, all as arrays."""

    def __init__(self):
        self.names: dict[str, int] = {}
        self.held: list[tuple[np.ndarray, ...]] = []
        self.size = 0

    def add(self, key, counts, lang, sizes, data, names):
        place = np.array([self.names.setdefault(x, len(self.names)) for x in names], np.int32)
        self.held.append((key, counts, place[lang] if len(lang) else lang, sizes, data))
        self.size += len(key)

    def total(self):
        """key, count, lang, sizes, data of distinct words in order of keys; whether a key stands for two words."""
        key, counts, lang, sizes, data = (np.concatenate(x) for x in zip(*self.held))
        order = np.argsort(key, kind="stable")
        fresh = np.ones(len(key), bool)
        fresh[1:] = key[order[1:]] != key[order[:-1]]
        at = np.flatnonzero(fresh)
        starts = np.cumsum(sizes) - sizes
        first = order[at].repeat(np.diff(np.append(at, len(key))))
        clash = bool((sizes[order] != sizes[first]).any() or (lang[order] != lang[first]).any())
        if not clash:
            again = order[~fresh]
            clash = bool((data[B.ranges(starts[again], sizes[again])] != data[B.ranges(starts[first[~fresh]], sizes[again])]).any())
        sums = np.add.reduceat(counts[order], at) if len(at) else counts
        keep = order[at]
        return key[keep], sums, lang[keep], sizes[keep], data[B.ranges(starts[keep], sizes[keep])], clash


WORD_ROWS = "bucket int, langs array<string>, keys binary, counts binary, lang binary, sizes binary, data binary, clash boolean"
GRAM_ROWS = "bucket int, keys binary, counts binary"


def _word_rows(words: Words, buckets: int) -> pa.RecordBatch:
    key, counts, lang, sizes, data, clash = words.total()
    b, at = B.by_bucket(key, buckets)
    ends = np.concatenate([[0], np.cumsum(sizes)])
    cut = lambda x, dtype: B.blobs([x[i:j].astype(dtype) for i, j in zip(at[:-1], at[1:])])
    return pa.record_batch({
        "bucket": pa.array(b.astype(np.int32)), "langs": pa.array([list(words.names)] * len(b), pa.list_(pa.string())), "keys": cut(key, U), "counts": cut(counts, np.int64),
        "lang": cut(lang, np.int32), "sizes": cut(sizes, np.int32), "data": B.blobs([data[ends[i] : ends[j]] for i, j in zip(at[:-1], at[1:])]), "clash": pa.array([clash] * len(b), pa.bool_()),
    })


def binary_keys(keys: np.ndarray) -> pa.Array:
    """Rows of word keys as binary values, eight bytes a word."""
    n, k = keys.shape
    return pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer((np.arange(n + 1, dtype=np.int32) * 8 * k).tobytes()), pa.py_buffer(np.ascontiguousarray(keys).tobytes())])


def strings(data: np.ndarray, sizes: np.ndarray) -> pa.Array:
    off = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    return pa.Array.from_buffers(pa.string(), len(sizes), [None, pa.py_buffer(off.tobytes()), pa.py_buffer(data.tobytes())])


def word_level(docs: DataFrame, buckets: int, least: int, seed: int) -> DataFrame:
    """(key, h, lang, word, f) of words with f >= least; one row more a bucket and language with a null key: f of all its words."""

    def emit(batches):
        words = Words()
        for low, start, end, names, lang, key, _ in keyed(batches, seed):
            order = np.argsort(key, kind="stable")
            fresh = np.ones(len(key), bool)
            fresh[1:] = key[order[1:]] != key[order[:-1]]
            at = np.flatnonzero(fresh)
            one = order[at]
            sizes = end[one] - start[one]
            words.add(key[one], np.diff(np.append(at, len(key))), lang[one], sizes, low[B.ranges(start[one], sizes)], names)
            if words.size > FLUSH // 4:
                yield _word_rows(words, buckets)
                words = Words()
        if words.size:
            yield _word_rows(words, buckets)
        B.give_back()

    def meet(rows: pa.Table) -> pa.Table:
        words = Words()
        for r in rows.to_batches(max_chunksize=1):
            x = {c: r.column(c)[0].as_py() for c in r.schema.names}
            words.add(np.frombuffer(x["keys"], U), np.frombuffer(x["counts"], np.int64), np.frombuffer(x["lang"], np.int32), np.frombuffer(x["sizes"], np.int32).astype(np.int64), np.frombuffer(x["data"], np.uint8), x["langs"])
        key, counts, lang, sizes, data, clash = words.total()
        names = np.array(list(words.names), object)
        n = np.bincount(lang, weights=None, minlength=len(names)) > 0
        totals = np.array([counts[lang == i].sum() for i in np.flatnonzero(n)], np.int64)
        keep = counts >= least
        starts = np.cumsum(sizes) - sizes
        data = data[B.ranges(starts[keep], sizes[keep])]
        few = len(totals)
        out = {
            "key": pa.concat_arrays([binary_keys(key[keep][:, None]), pa.nulls(few, pa.binary())]), "h": pa.array(np.append(key[keep].view(np.int64), np.zeros(few, np.int64))), "lang": pa.array([*names[lang[keep]], *names[n]], pa.string()),
            "word": pa.concat_arrays([strings(data, sizes[keep]), pa.nulls(few, pa.string())]), "f": pa.array(np.append(counts[keep], totals)), "clash": pa.array(np.full(keep.sum() + few, clash or any(rows.column("clash").to_pylist()))),
        }
        B.give_back()
        return pa.table(out)

    return docs.mapInArrow(emit, WORD_ROWS).groupBy("bucket").applyInArrow(meet, "key binary, h long, lang string, word string, f long, clash boolean")


def key_filter(spark: SparkSession, level: DataFrame, bits: int = FILTER_BITS):
    """A broadcast filter of 2 ** bits bits, two of them set by each h of a level; its size does not depend on the level's."""
    mask = F.lit((1 << bits) - 1)
    slots = level.select(F.explode(F.array(F.col("h").bitwiseAND(mask), F.shiftrightunsigned("h", 32).bitwiseAND(mask))).alias("s"))
    cells = slots.groupBy(F.shiftright("s", 6).cast("int").alias("cell")).agg(F.bit_or(F.expr("shiftleft(1L, int(s & 63))")).alias("v")).toArrow()
    out = np.zeros(1 << (bits - 6), U)
    out[cells.column("cell").to_numpy()] = cells.column("v").to_numpy().view(U)
    return spark.sparkContext.broadcast(out)


def may_hold(cells: np.ndarray, h: np.ndarray) -> np.ndarray:
    mask = U(len(cells) * 64 - 1)
    out = np.ones(len(h), bool)
    for s in (h & mask, (h >> U(32)) & mask):
        out &= (cells[s >> U(6)] >> (s & U(63))) & U(1) != 0
    return out


def gram_level(docs: DataFrame, k: int, shorter, buckets: int, least: int, seed: int) -> DataFrame:
    """(key, h, f) of phrases of k words with f >= least; shorter: the broadcast filter of the phrases of k - 1 words."""

    def rows(h, keys):
        h, keys, counts = summed(h, keys, None)
        b, at = B.by_bucket(h, buckets)
        return pa.record_batch({"bucket": pa.array(b.astype(np.int32)), "keys": B.blobs([keys[i:j] for i, j in zip(at[:-1], at[1:])]), "counts": B.blobs([counts[i:j].astype(np.uint32) for i, j in zip(at[:-1], at[1:])])})

    def emit(batches):
        cells, held, size = shorter.value, [], 0
        for _, _, _, _, _, key, together in keyed(batches, seed):
            n = len(key) - k + 1
            if n < 1:
                continue
            part = np.lib.stride_tricks.sliding_window_view(key, k - 1)
            alive = may_hold(cells, folded(part))
            for j in range(k - 2):
                alive &= together[j : j + len(alive)]
            good = alive[:-1] & alive[1:] & together[:n]
            keys = np.lib.stride_tricks.sliding_window_view(key, k)[good]
            held.append((folded(keys), keys))
            size += len(keys)
            if size > FLUSH:
                yield rows(*map(np.concatenate, zip(*held)))
                held, size = [], 0
        if size:
            yield rows(*map(np.concatenate, zip(*held)))
        B.give_back()

    def meet(table: pa.Table) -> pa.Table:
        keys = B.joined(table.column("keys"), U).reshape(-1, k)
        h, keys, counts = summed(folded(keys), keys, B.joined(table.column("counts"), np.uint32).astype(np.int64))
        keep = counts >= least
        out = pa.table({"key": binary_keys(keys[keep]), "h": pa.array(h[keep].view(np.int64)), "f": pa.array(counts[keep])})
        B.give_back()
        return out

    return docs.mapInArrow(emit, GRAM_ROWS).groupBy("bucket").applyInArrow(meet, "key binary, h long, f long")


def levels(docs: DataFrame, least: int = LEAST, longest: int = LONGEST) -> tuple[dict[int, DataFrame], DataFrame]:
    """Stored level tables by phrase length (that of words also has lang and word), and (lang, n)."""
    spark = docs.sparkSession
    rows = docs.select("text", F.coalesce("lang", F.lit("und")).alias("lang"))
    buckets = pieces(text_bytes(rows), BUCKET_BYTES, 8)
    for seed in range(100):
        words = stored(word_level(rows, buckets, least, seed), "words")
        if not words.agg(F.max("clash")).first()[0]:
            break
        release(words)
    found = {1: words.where(F.col("key").isNotNull()).select("key", "h", "lang", "word", "f")}
    for k in range(2, longest + 1):
        shorter = key_filter(spark, found[k - 1])
        found[k] = stored(gram_level(rows, k, shorter, buckets, least, seed), f"phrases{k}")
        shorter.destroy()
    return found, words.where(F.col("key").isNull()).groupBy("lang").agg(F.sum("f").alias("n"))


def scored(found: dict[int, DataFrame], k: int, inside: int = INSIDE) -> DataFrame:
    """(key, a, l, r, score) of the candidates of k words that no longer candidate drops."""

    def look(df, j, at, name):
        part = found[j].select(F.col("key").alias("part"), F.col("f").alias(name))
        piece = F.substring("key", 8 * at + 1, 8 * j).alias("part")
        return keys_join(df.withColumn("part", piece), part, "part", "inner", BROADCAST_BYTES // 100).drop("part")

    out = found[k].select("key", F.col("f").alias("a"))
    if k + 1 in found:
        longer = found[k + 1].select(F.explode(F.array(F.substring("key", 1, 8 * k), F.substring("key", 9, 8 * k))).alias("key"), "f").groupBy("key").agg(F.max("f").alias("longer"))
        out = out.join(longer, "key", "left").where("longer IS NULL OR 100 * longer < %d * a" % inside).drop("longer")
    for j in range(1, k):
        out = look(look(out, j, 0, f"l{j}"), k - j, j, f"r{j}")
    cuts = [
        F.struct(F.expr(f"(CAST(a AS DECIMAL(16,0)) * CAST(a AS DECIMAL(16,0)) * 1000000BD) div (CAST(l{j} AS DECIMAL(16,0)) * CAST(r{j} AS DECIMAL(16,0)))").alias("score"), F.lit(j).alias("k"), F.col(f"l{j}").alias("l"), F.col(f"r{j}").alias("r"))
        for j in range(1, k)
    ]
    return out.withColumn("cut", F.array_min(F.array(*cuts))).select("key", "a", "cut.l", "cut.r", "cut.score")


def mine_phrases(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, inside: int = INSIDE, top: int = TOP) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score of each language's first `top` phrases of 2 to `longest` words."""
    found, totals = levels(docs, least, longest)
    names = found[1].select("key", "lang", "word")
    look = lambda df, at, keep: keys_join(df.withColumn("part", F.substring("key", 8 * at + 1, 8)), names.select(F.col("key").alias("part"), *keep), "part", "left", BROADCAST_BYTES // 100).drop("part")
    every = None
    for k in range(2, longest + 1):
        each = scored(found, k, inside)
        every = each if every is None else every.unionByName(each)
    order = [F.desc("score"), F.desc("a")]
    best = look(every, 0, ["lang"]).withColumn("place", F.rank().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("place") <= top)
    best = stored(best.drop("place"), "best-phrases")  # ties at the border included
    for at in range(longest):
        best = look(best, at, [F.col("word").alias(f"w{at}")])
    phrases = best.withColumn("phrase", F.concat_ws(" ", *[f"w{at}" for at in range(longest)]))
    ranked = phrases.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order, "phrase")).cast("long")).where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op11_phrase_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mine_phrases(spark.read.parquet(f"{sf_dir}/documents.parquet"))
