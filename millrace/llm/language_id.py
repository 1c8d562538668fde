"""Language identification by prediction by partial matching (operator 10).

For each language a context tree of depth three over bytes is learned from all training texts; escapes follow method C with
exclusion, so each context's probabilities sum to one. The frozen tree is held as sorted arrays, one an order, of the code
lengths (bits) of the bytes seen after each context seen and of the contexts' escapes; a text's exact code length is the sum
over all its bytes.

Bytes: A-Z and the capitals of Latin-1 (UTF-8 C3 80-9E) are lower-cased, ASCII white space is one byte, digits are one; all
others stand for themselves, however rare.

Defined cases: a null text, or one without a letter, is `und` with score 0; so is every text when there is nothing to learn
from; ties go to the language that sorts first; repeated rows are each learned and each returned; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import bytesops as B
from .scratch import stored

ORDER = 3
#: Texts that cost no less than so many equally likely symbols have no language for the pipeline.
SYMBOLS = 48
#: Distinct contexts of one language that a task holds before it passes them on.
HELD = 2_000_000
FOLD = np.arange(256, dtype=np.uint8)
FOLD[65:91] += 32
FOLD[B.SPACE] = 32
FOLD[49:58] = 48


def fold(data: np.ndarray) -> np.ndarray:
    return B.lower_latin1(data, FOLD[data])


def contexts(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Each byte with its three predecessors (highest), as one number; before a text come three spaces."""
    s = fold(data).astype(np.uint32)
    pad = np.full(len(s) + ORDER, 32, np.uint32)
    pad[ORDER:] = s
    out = (pad[:-3] << 24) | (pad[1:-2] << 16) | (pad[2:-1] << 8) | s
    starts = off[:-1]
    sizes = np.diff(off)
    for k in range(ORDER):  # the first three bytes of each text
        at = starts[sizes > k] + k
        ctx = np.zeros(len(at), np.uint32)
        for j in range(ORDER, 0, -1):
            ctx = (ctx << 8) | (s[at - j] if k - j >= 0 else np.uint32(32))
        out[at] = (ctx << 8) | s[at]
    return out


def _summed(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys and the sums of their counts."""
    k, inverse = np.unique(np.concatenate(keys), return_inverse=True)
    n = np.zeros(len(k), np.int64)
    np.add.at(n, inverse, np.concatenate(counts))
    return k, n


def context_counts(docs: DataFrame) -> DataFrame:
    """(lang, part, idx, n): counts of every context and byte seen over all rows of docs."""

    def count(batches):
        held: dict[str, tuple[np.ndarray, np.ndarray]] = {}

        def packed(lang):
            keys, n = held.pop(lang)
            part = (keys * np.uint32(2654435761)) >> np.uint32(26)  # 64 hashed parts, each summed by itself
            order = np.argsort(part, kind="stable")
            cut = np.flatnonzero(np.diff(part[order].astype(np.int64), prepend=-1))
            idx, ns = np.split(keys[order], cut[1:]), np.split(n[order], cut[1:])
            return pa.record_batch({"lang": pa.array([lang] * len(cut)), "part": pa.array(part[order][cut].astype(np.int64)), "idx": B.blobs(idx), "n": B.blobs(ns)})

        for b in B.slices(batches):
            langs = b.column("lang").to_pylist()
            data, off = B.raw(b.column("text"))
            idx = contexts(data, off)
            names = sorted(set(langs))
            which = np.array([names.index(x) for x in langs])
            for k, lang in enumerate(names):
                new = np.unique(idx[np.repeat(which == k, np.diff(off))], return_counts=True)
                if not len(new[0]):
                    continue
                if lang not in held:
                    if len(held) >= 8:  # bounded memory: the oldest goes out
                        yield packed(next(iter(held)))
                    held[lang] = new
                else:
                    held[lang] = _summed([held[lang][0], new[0]], [held[lang][1], new[1]])
                if len(held[lang][0]) > HELD:
                    yield packed(lang)
        while held:
            yield packed(next(iter(held)))
        B.give_back()

    def add(table: pa.Table) -> pa.Table:
        keys, n = _summed([B.joined(table.column("idx"), np.uint32)], [B.joined(table.column("n"), np.int64)])
        return pa.table({"lang": table.column("lang")[:1], "part": table.column("part")[:1], "idx": B.blobs([keys]), "n": B.blobs([n])})

    schema = "lang string, part long, idx binary, n binary"
    return docs.select("lang", "text").mapInArrow(count, schema).groupBy("lang", "part").applyInArrow(add, schema)


def tree(keys: np.ndarray, counts: np.ndarray) -> list[tuple[np.ndarray, ...]]:
    """For orders 0 to ORDER: contexts with a byte, its bits, contexts, bits of their escapes; method C with exclusion.

    What a context has seen, its shorter one has seen too, so the mass left after exclusion follows from the bytes seen."""
    levels = [(keys, counts)]
    for d in range(ORDER - 1, -1, -1):
        levels.append(_summed([levels[-1][0] & np.uint32((1 << 8 * (d + 1)) - 1)], [levels[-1][1]]))
    out, lower, p = [], None, None
    for d, (k, n) in enumerate(reversed(levels)):
        ctx, first, kinds = np.unique(k >> np.uint32(8), return_index=True, return_counts=True)
        below = np.full(len(k), 1 / 256) if lower is None else p[np.searchsorted(lower, k & np.uint32((1 << 8 * d) - 1))]
        total = np.add.reduceat(n, first) if len(n) else n
        open_ = 1.0 - np.add.reduceat(below, first) if len(n) else below
        p = n / np.repeat(total + np.where(kinds == 256, 0, kinds), kinds)
        lower = k
        escape = kinds / (total + kinds) / np.maximum(open_, 1e-15)
        out.append((k, -np.log2(p).astype(np.float32), ctx, -np.log2(escape).astype(np.float32)))
    return out


def code_lengths(levels: list[tuple[np.ndarray, ...]], keys: np.ndarray) -> np.ndarray:
    """Bits of each byte after its context; what a context has not seen costs its escape and is coded one order lower."""
    bits, left = np.zeros(len(keys)), np.arange(len(keys))
    for d in range(ORDER, -1, -1):
        known, own, ctx, escape = levels[d]
        q = keys[left] & np.uint32((1 << 8 * (d + 1)) - 1)
        i = np.minimum(np.searchsorted(known, q), len(known) - 1)
        hit = known[i] == q
        bits[left[hit]] += own[i[hit]]
        left, c = left[~hit], q[~hit] >> np.uint32(8)
        j = np.minimum(np.searchsorted(ctx, c), len(ctx) - 1)
        met = ctx[j] == c
        bits[left[met]] += escape[j[met]]
    bits[left] += 8.0
    return bits


def train(docs: DataFrame) -> dict:
    """Learn from all rows of docs (text, lang), neither null: {langs, trees}."""
    found: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}
    for r in stored(context_counts(docs), "ppm").toLocalIterator():  # the contexts seen, which texts of one language soon repeat
        found.setdefault(r["lang"], []).append((np.frombuffer(r["idx"], np.uint32), np.frombuffer(r["n"], np.int64)))
    langs = sorted(found)
    return {"langs": langs, "trees": [tree(*_summed(*zip(*found.pop(lang)))) for lang in langs]}


def classify(docs: DataFrame, model: dict, keep: list[str | Column]) -> DataFrame:
    """`keep` columns of every row plus lang_pred, score (posterior of the prediction) and bits_per_byte under its tree."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)  # the contexts seen
    chosen = docs.select(*keep)
    names = chosen.columns
    rows = docs.select(*keep, F.when(F.col("text").rlike(r"\p{L}"), F.col("text")).alias("__text"))

    def score(batches):
        m = shared.value
        for b in B.slices(batches, "__text"):
            data, off = B.raw(b.column("__text"))
            sizes = np.diff(off)
            pred, best, per = np.array(["und"] * len(sizes), object), np.zeros(len(sizes)), np.zeros(len(sizes))
            if m["langs"] and len(data):
                keys, idx = np.unique(contexts(data, off), return_inverse=True)
                bits = np.zeros((len(m["langs"]), len(sizes)))
                for k in range(len(m["langs"])):
                    run = np.concatenate([[0.0], np.cumsum(code_lengths(m["trees"][k], keys)[idx])])
                    bits[k] = run[off[1:]] - run[off[:-1]]
                top = bits.argmin(axis=0)
                full = sizes > 0
                pred[full] = np.array(m["langs"], object)[top[full]]
                weights = np.exp2(np.maximum(bits.min(axis=0) - bits, -1000.0))
                best[full] = (1.0 / weights.sum(axis=0))[full]
                per[full] = bits.min(axis=0)[full] / sizes[full]
            cols = {n: b.column(n) for n in names}
            yield pa.record_batch(cols | {"lang_pred": pa.array(pred, pa.string()), "score": pa.array(best), "bits_per_byte": pa.array(per)})

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in chosen.schema)
    return rows.mapInArrow(score, f"{schema}, lang_pred string, score double, bits_per_byte double")


def in_fold(modulus: int, remainder: int, key: str = "doc_id") -> Column:
    return F.pmod(F.crc32(F.col(key).cast("string").cast("binary")), F.lit(modulus)) == remainder


def training_rows(docs: DataFrame) -> DataFrame:
    held = F.coalesce(in_fold(4, 2), F.lit(False))
    return docs.where(~held & F.col("lang").isNotNull() & F.col("text").isNotNull()).select("text", "lang")


def predict_languages(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every row of documents, learned from the rows that are not held out."""
    model = train(training_rows(docs))
    return classify(docs, model, ["doc_id", in_fold(4, 2).alias("held_out")]).drop("bits_per_byte")


def op10_language_id(spark, sf_dir: str) -> DataFrame:
    return predict_languages(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang"))
