"""Toxicity by multiple-instance learning (operator 3).

A document is a bag of sentences. A sentence's score is a logistic function of the words and word beginnings in it, a document's score is the
noisy-or of its sentences, 1 - prod(1 - p). Only document labels are learned from; the sentence scores then locate the
offending sentences. A word is a run of ASCII letters (lower-cased) or bytes of 0x80 and up, so digits and decorating signs
do not hide it, and capitals of Latin-1 count as small letters; a sentence ends at `.`, `!`, `?` or a line break, and after `longest` words at the latest.

The classifier is fitted on a bounded sample of labelled rows, `TRAIN_DOCS` of each label, chosen by a hash of the doc_id and
weighted back; every text is scored whole.

Defined cases: null and empty texts are bags without sentences and score the background probability that labelled training
documents without any known word have; repeated rows are returned each; doc_ids with conflicting labels count as toxic;
without labelled rows every score is 0; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import bytesops as B
from .language_id import in_fold
from .scratch import keys_join, stored

#: Most labelled documents of each label that the classifier is fitted on.
TRAIN_DOCS = 4_000
MIN_DOCS = 3
STEMS = (4, 6)
LONGEST = 40
THRESHOLD = 0.3

_LETTER = np.zeros(256, bool)
_LETTER[97:123] = True
_LETTER[128:] = True
_STOP = np.zeros(256, bool)
_STOP[[0x2E, 0x21, 0x3F, 0x0A, 0x0D]] = True
_TO_SPACE = B.LOWER.copy()
_TO_SPACE[~_LETTER[B.LOWER]] = 32


def bags(data: np.ndarray, off: np.ndarray, longest: int = LONGEST):
    """Features and the sentence number of each, the row of each sentence, and the byte span of each sentence.

    A word's features are the word itself and its first four and six bytes."""
    low = B.lower_latin1(data, _TO_SPACE[data])
    start, end, rows = B.word_spans(low, off)
    sums = B.prefix_sums(low)
    stops = np.concatenate([[0], np.cumsum(_STOP[data])])
    row = B.row_of(rows)
    place = stops[start]
    fresh = np.ones(len(start), bool)
    fresh[1:] = (place[1:] != place[:-1]) | (row[1:] != row[:-1])
    first = np.maximum.accumulate(np.where(fresh, np.arange(len(start)), 0))
    fresh |= (np.arange(len(start)) - first) % longest == 0
    sentence = np.cumsum(fresh) - 1
    at = np.flatnonzero(fresh)
    last = np.append(at[1:], len(start)) - 1 if len(at) else at
    features, which = [B.span_hash(sums, start, end)], [sentence]
    for n in STEMS:
        long = end - start > n
        features.append(B.span_hash(sums, start[long], start[long] + n) ^ B.U(n))
        which.append(sentence[long])
    return np.concatenate(features), np.concatenate(which), row[at], start[at], end[last] if len(at) else start[at]


def sample(labelled: DataFrame, most: int) -> DataFrame:
    """About `most` rows of each label of (doc_id, toxic) with the weight that undoes it; the same rows each time, by a hash of the doc_id."""
    n = {r["toxic"]: r["n"] for r in labelled.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    share = F.lit(1.0)
    for label, count in n.items():
        share = F.when(F.col("toxic") == label, min(1.0, most / count)).otherwise(share)
    chosen = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < share * (1 << 30)
    return labelled.where(chosen).withColumn("weight", 1.0 / share)


def fit(sampled: DataFrame, rounds: int = 300, rate: float = 0.5, l1: float = 2e-5) -> dict:
    """Fit on rows (text, toxic, weight), none null; full-batch Adagrad on the weighted noisy-or likelihood.

    Features of fewer than MIN_DOCS sampled documents, or no commoner in toxic ones than by chance, are left out."""

    def features(batches):
        for b in B.slices(batches):
            data, off = B.raw(b.column("text"))
            found, sentence, row, _, _ = bags(data, off)
            pair = np.unique(np.rec.fromarrays([sentence, found])) if len(found) else np.rec.fromarrays([sentence, found])
            cuts = np.searchsorted(pair.f0, np.concatenate([[0], np.cumsum(np.bincount(row, minlength=len(off) - 1))]))
            first = np.searchsorted(row, np.arange(len(off) - 1))
            yield pa.record_batch({
                "toxic": b.column("toxic"), "weight": b.column("weight"),
                "features": B.blobs([pair.f1[i:j] for i, j in zip(cuts, cuts[1:])]),
                "sentences": B.blobs([(pair.f0[i:j] - f).astype(np.int32) for i, j, f in zip(cuts, cuts[1:], first)]),
            })

    got = sampled.select("text", "toxic", "weight").mapInArrow(features, "toxic int, weight double, features binary, sentences binary").toArrow()
    y = got.column("toxic").to_numpy().astype(np.float64)
    if not len(y):
        return {"features": np.zeros(0, np.uint64), "weights": np.zeros(0), "bias": -50.0, "empty": 0.0}
    weight = got.column("weight").to_numpy() / got.column("weight").to_numpy().sum()
    sizes = pc.binary_length(got.column("features")).to_numpy() // 8
    doc = np.repeat(np.arange(len(y), dtype=np.int32), sizes)
    plain = np.array([int(np.frombuffer(x.as_buffer(), np.int32).max(initial=-1)) + 1 for x in got.column("sentences")])
    sentence = B.joined(got.column("sentences"), np.int32)
    flat = B.joined(got.column("features"), np.uint64)
    del got
    vocabulary, ids = np.unique(flat, return_inverse=True)
    del flat
    ids = ids.astype(np.int32)
    pair = np.unique(ids.astype(np.int64) * len(y) + doc)
    feature, of = (pair // len(y)).astype(np.int32), (pair % len(y)).astype(np.int32)
    del pair
    docs = np.bincount(feature, minlength=len(vocabulary))
    rate_toxic = np.bincount(feature, weights=(weight * y)[of], minlength=len(vocabulary)) / np.bincount(feature, weights=weight[of], minlength=len(vocabulary))
    known = np.flatnonzero((docs >= MIN_DOCS) & (rate_toxic > 1.5 * (weight * y).sum()))
    renumber = np.full(len(vocabulary), -1)
    renumber[known] = np.arange(len(known))
    del feature, of
    keep = np.flatnonzero(renumber[ids] >= 0)
    f, d = renumber[ids[keep]], doc[keep].astype(np.int64)
    bag, s = np.unique(d * (1 << 31) + sentence[keep], return_inverse=True)  # sentences without a known feature are left to the bias
    del ids, doc, sentence, keep, d
    of_bag = bag >> 31
    plain = plain - np.bincount(of_bag, minlength=len(y))
    w, bias = np.zeros(len(known)), -6.0
    gw, gb = np.full(len(known), 1e-8), 1e-8
    for _ in range(rounds):
        z = bias + np.bincount(s, weights=w[f], minlength=len(bag))
        p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        p0 = 1 / (1 + np.exp(-bias))
        clean = np.bincount(of_bag, weights=np.log1p(-np.minimum(p, 1 - 1e-9)), minlength=len(y)) + plain * np.log1p(-p0)
        doc_p = np.clip(-np.expm1(clean), 1e-9, 1 - 1e-9)
        pull = weight * (y - doc_p) / doc_p
        slope = -p * pull[of_bag]
        d_w = np.bincount(f, weights=slope[s], minlength=len(known))
        d_b = slope.sum() - p0 * (pull * plain).sum()
        gw, gb = gw + d_w**2, gb + d_b**2
        w, bias = w - rate * d_w / np.sqrt(gw), bias - rate * d_b / np.sqrt(gb)
        w = np.sign(w) * np.maximum(0, np.abs(w) - rate * l1 / np.sqrt(gw))
    bare = sizes == 0
    empty = ((weight * y)[bare].sum() + 0.01 / len(y)) / (weight[bare].sum() + 1 / len(y))
    used = w != 0
    order = np.argsort(vocabulary[known][used])
    return {"features": vocabulary[known][used][order], "weights": w[used][order], "bias": float(bias), "empty": float(empty)}


def sentence_scores(model: dict, data: np.ndarray, off: np.ndarray):
    found, sentence, row, start, end = bags(data, off)
    size = max(1, len(model["features"]))
    at = np.minimum(np.searchsorted(model["features"], found), size - 1)
    hit = model["features"][at] == found if len(model["features"]) else np.zeros(len(found), bool)
    pair = np.unique(sentence[hit] * size + at[hit])
    z = model["bias"] + np.bincount(pair // size, weights=model["weights"][pair % size], minlength=len(row))
    return 1 / (1 + np.exp(-np.clip(z, -30, 30))), row, start, end


def score_documents(docs: DataFrame, model: dict, keep: list, spans: bool = False) -> DataFrame:
    """`keep` columns plus score and, with spans, `sentences`: the byte spans and scores of sentences of THRESHOLD or more."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # proven size: words of at most TRAIN_DOCS documents
    chosen = docs.select(*keep)
    names = chosen.columns

    def score(batches):
        m = shared.value
        for b in B.slices(batches, "__text"):
            data, off = B.raw(b.column("__text"))
            p, row, start, end = sentence_scores(m, data, off)
            clean = np.bincount(row, weights=np.log1p(-np.minimum(p, 1 - 1e-12)), minlength=len(off) - 1)
            bare = np.bincount(row, minlength=len(off) - 1) == 0
            out = {n: b.column(n) for n in names} | {"score": pa.array(np.where(bare, m["empty"], np.clip(-np.expm1(clean), 0.0, 1.0)))}
            if spans:
                found: list[list] = [[] for _ in range(len(off) - 1)]
                for k in np.flatnonzero(p >= THRESHOLD):
                    found[row[k]].append({"start": int(start[k] - off[row[k]]), "end": int(end[k] - off[row[k]]), "score": float(p[k])})
                out["sentences"] = pa.array(found, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())])))
            yield pa.record_batch(out)

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in chosen.schema) + ", score double"
    if spans:
        schema += ", sentences array<struct<start:bigint,end:bigint,score:double>>"
    return docs.select(*keep, F.col("text").alias("__text")).mapInArrow(score, schema)


def score_toxicity(docs: DataFrame, labels: DataFrame, train_docs: int = TRAIN_DOCS, spans: bool = False) -> DataFrame:
    """doc_id, held_out, score, predicted of every row of documents."""
    held = in_fold(4, 2)
    marks = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull()).groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    own = docs.where(~F.coalesce(held, F.lit(False)) & F.col("doc_id").isNotNull()).select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    chosen = stored(sample(stored(marks.where(~in_fold(4, 2)), "marks"), train_docs), "chosen")
    model = fit(keys_join(own, chosen, "doc_id", "inner"))
    out = score_documents(docs, model, ["doc_id", held.alias("held_out")], spans)
    return out.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def op3_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return score_toxicity(docs, spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic"))
