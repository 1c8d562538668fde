"""Language-model scoring with a log-bilinear model trained by noise-contrastive estimation (operator 1).

Tokens are words (A-Z lower-cased) and one end a text. All training tokens are counted: c for each token, N in all, V distinct.

The model predicts a token's class from the classes of the two tokens before it, then the token within its class:
* classes: the commonest words and the end each have their own, other words share one by their last three bytes, if that
  ending is common, or the last class;
* the class model is log-bilinear: the context vector is a position-weighted sum of class vectors, a class's score its product
  with the class vector plus a bias. It is trained in numpy by noise-contrastive estimation on all class triples of all
  training texts, weighted by their counts, in rounds: each task goes over its share of the triples once, and the tasks'
  parameters are averaged by the tokens behind them. Nothing is drawn or left out, and shards follow the size of the texts.
  One batched matrix product then gives the scores of all contexts, which are normalised;
* within a class, counts are discounted by D; what that frees, summed over classes by their probability, is the probability of
  an unknown token. So for every context the probabilities of the V known tokens and of "unknown" sum to one.

Defined cases: null and empty texts are one end; with nothing to learn from, N and V are 0, base_score is 0.5/0.5 = 1 a token
(score 0) and the model's score likewise; repeated rows are each learned and returned; rows with a null doc_id are scored,
with held_out null, and not learned from; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import bytesops as B
from .language_id import in_fold
from .scratch import pieces, stored, text_bytes

OWN = 150
ENDINGS = 40
CLASSES = OWN + ENDINGS + 2
END, OTHER = CLASSES - 2, CLASSES - 1
SIZE = 24
#: Texts start after two tokens of this class, which is only a context.
START = CLASSES
NOISE = 96
ROUNDS = 4
BATCH = 512
#: Shards of the counted triples, at least; more texts have more.
SHARDS = 8
BATCH_BYTES = 12 << 20
HELD_BYTES = 10 << 20
END_HASH = B.mix(np.array([0xE2D], np.uint64))[0]


def tokens(batch: pa.RecordBatch, text: str = "text"):
    """Hashes of all tokens, hashes of their endings, and n+1 offsets; each row closes with the end."""
    data, off = B.raw(batch.column(text))
    start, end, rows = B.word_spans(data, off)
    c = B.prefix_sums(B.LOWER[data])
    words = B.span_hash(c, start, end)
    endings = B.span_hash(c, np.maximum(start, end - 3), end)
    n = len(off) - 1
    out, tails = np.full(len(words) + n, END_HASH, np.uint64), np.full(len(words) + n, END_HASH, np.uint64)
    at = np.arange(len(words)) + B.row_of(rows)
    out[at], tails[at] = words, endings
    return out, tails, rows + np.arange(n + 1)


def token_counts(docs: DataFrame, buckets: int) -> DataFrame:
    """Stored (bucket, h, tail, c): packed hashes, ascending, ending hashes and counts of all tokens of docs (text)."""

    def count(batches):
        held, size = [], 0

        def flush():
            h, tail = (np.concatenate(x) for x in zip(*held))
            keys, first, n = np.unique(h, return_index=True, return_counts=True)
            b, cut = B.by_bucket(keys, buckets)
            tail = tail[first]
            return pa.record_batch({"bucket": pa.array(b), **{k: B.blobs([x[i:j] for i, j in zip(cut, cut[1:])]) for k, x in (("h", keys), ("tail", tail), ("c", n))}})

        for b in B.slices(batches):
            held.append(tokens(b)[:2])
            size += b.column("text").nbytes
            if size > HELD_BYTES:
                yield flush()
                held, size = [], 0
        if held:
            yield flush()

    def add(table: pa.Table) -> pa.Table:
        h, tail, c = (B.joined(table.column("h"), np.uint64), B.joined(table.column("tail"), np.uint64), B.joined(table.column("c"), np.int64))
        order = np.argsort(h, kind="stable")
        at = np.flatnonzero(np.concatenate([[True], h[order][1:] != h[order][:-1]]))
        return pa.table({"bucket": table.column("bucket")[:1], "h": B.blobs([h[order][at]]), "tail": B.blobs([tail[order][at]]), "c": B.blobs([np.add.reduceat(c[order], at)])})

    schema = "bucket long, h binary, tail binary, c binary"
    return stored(docs.select("text").mapInArrow(count, schema).repartition(buckets, "bucket").groupBy("bucket").applyInArrow(add, schema), "counts")


def summary(counts: DataFrame) -> dict:
    """N, V, the tokens seen once and twice, the commonest words and endings: bounded, whatever the corpus."""

    def look(batches):
        for b in batches:
            for h, tail, c in zip(b.column("h").to_pylist(), b.column("tail").to_pylist(), b.column("c").to_pylist()):
                h, tail, c = np.frombuffer(h, np.uint64), np.frombuffer(tail, np.uint64), np.frombuffer(c, np.int64)
                top = np.argsort(-c, kind="stable")[: OWN + 1]
                ends, inverse = np.unique(tail, return_inverse=True)
                sums = np.bincount(inverse, weights=c).astype(np.int64)
                kind = np.concatenate([np.zeros(len(top)), np.ones(len(ends)), np.full(4, 2)]).astype(np.int32)
                key = np.concatenate([h[top].view(np.int64), ends.view(np.int64), np.arange(4)])
                n = np.concatenate([c[top], sums, [c.sum(), len(c), (c == 1).sum(), (c == 2).sum()]])
                yield pa.record_batch({"kind": pa.array(kind), "key": pa.array(key), "n": pa.array(n.astype(np.int64))})

    sums = stored(counts.mapInArrow(look, "kind int, key long, n long").groupBy("kind", "key").agg(F.sum("n").alias("n")), "summary")
    total = {r["key"]: r["n"] for r in sums.where("kind = 2").collect()}
    top = lambda kind, k: np.array([r["key"] for r in sums.where(F.col("kind") == kind).where(F.col("key") != int(np.array([END_HASH]).view(np.int64)[0])).orderBy(F.desc("n"), "key").limit(k).collect()], np.int64).view(np.uint64)
    return {"N": total.get(0, 0), "V": total.get(1, 0), "once": total.get(2, 0), "twice": total.get(3, 0), "words": np.sort(top(0, OWN)), "endings": np.sort(top(1, ENDINGS))}


def classes_of(h: np.ndarray, tail: np.ndarray, info: dict) -> np.ndarray:
    out = np.full(len(h), OTHER, np.int64)
    for keys, values, first in ((info["endings"], tail, OWN), (info["words"], h, 0)):
        if len(keys):
            at = np.minimum(np.searchsorted(keys, values), len(keys) - 1)
            hit = keys[at] == values
            out[hit] = first + at[hit]
    out[h == END_HASH] = END
    return out


def class_totals(counts: DataFrame, info: dict) -> tuple[np.ndarray, np.ndarray]:
    """Tokens and distinct tokens of each class."""

    def total(batches):
        for b in batches:
            n, v = np.zeros(CLASSES, np.int64), np.zeros(CLASSES, np.int64)
            for h, tail, c in zip(b.column("h").to_pylist(), b.column("tail").to_pylist(), b.column("c").to_pylist()):
                k = classes_of(np.frombuffer(h, np.uint64), np.frombuffer(tail, np.uint64), info)
                n += np.bincount(k, weights=np.frombuffer(c, np.int64), minlength=CLASSES).astype(np.int64)
                v += np.bincount(k, minlength=CLASSES)
            yield pa.record_batch({"k": pa.array(np.arange(CLASSES)), "n": pa.array(n), "v": pa.array(v)})

    n, v = np.zeros(CLASSES, np.int64), np.zeros(CLASSES, np.int64)
    for r in counts.mapInArrow(total, "k long, n long, v long").groupBy("k").agg(F.sum("n").alias("n"), F.sum("v").alias("v")).collect():
        n[r["k"]], v[r["k"]] = r["n"], r["v"]
    return n, v


def class_rows(h, tail, rows, info) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each token's class and the classes of the two tokens before it."""
    k = classes_of(h, tail, info)
    one, two = np.full(len(k), START, np.int64), np.full(len(k), START, np.int64)
    one[1:], two[2:] = k[:-1], k[:-2]
    first = rows[:-1]
    one[first] = two[first] = START
    second = first[np.diff(rows) > 1] + 1
    two[second] = START
    return k, one, two


def class_triples(docs: DataFrame, info: dict, shards: int = SHARDS) -> DataFrame:
    """Stored (shard, triple, n): packed counts of (two before, one before, class) over all training texts."""
    wide = CLASSES + 1
    shared = docs.sparkSession.sparkContext.broadcast(info)  # at most OWN + ENDINGS hashes

    def count(batches):
        held, size = [], 0

        def flush():
            keys, n = (np.concatenate(x) for x in zip(*held))
            keys, inverse = np.unique(keys, return_inverse=True)
            n = np.bincount(inverse, weights=n).astype(np.int64)
            shard = (B.mix(keys.astype(np.uint64)) % B.U(shards)).astype(np.int64)
            order = np.argsort(shard, kind="stable")
            cut = np.searchsorted(shard[order], np.arange(shards + 1))
            return pa.record_batch({"shard": pa.array(np.arange(shards, dtype=np.int32)), "triple": B.blobs([keys[order[i:j]].astype(np.int32) for i, j in zip(cut, cut[1:])]), "n": B.blobs([n[order[i:j]] for i, j in zip(cut, cut[1:])])})

        for b in B.slices(batches):
            k, one, two = class_rows(*tokens(b), shared.value)
            held.append(np.unique((two * wide + one) * wide + k, return_counts=True))
            size += b.column("text").nbytes
            if size > HELD_BYTES:
                yield flush()
                held, size = [], 0
        if held:
            yield flush()

    def add(table: pa.Table) -> pa.Table:
        keys, inverse = np.unique(B.joined(table.column("triple"), np.int32), return_inverse=True)
        return pa.table({"shard": table.column("shard")[:1], "triple": B.blobs([keys]), "n": B.blobs([np.bincount(inverse, weights=B.joined(table.column("n"), np.int64)).astype(np.int64)])})

    schema = "shard int, triple binary, n binary"
    return stored(docs.select("text").mapInArrow(count, schema).repartition(shards, "shard").groupBy("shard").applyInArrow(add, schema), "triples")


def fresh_parameters(unigram: np.ndarray) -> dict:
    rng = np.random.default_rng(7)
    wide = CLASSES + 1
    return {
        "context": rng.normal(0, 0.1, (2, wide, SIZE)), "target": rng.normal(0, 0.1, (CLASSES, SIZE)), "bias": np.log(unigram),
        "mix": np.stack([np.eye(SIZE), np.eye(SIZE) * 0.5]),
    }


def train_on(params: dict, triples: np.ndarray, n: np.ndarray, unigram: np.ndarray, seed: int, batch: int = BATCH, rate: float = 0.15) -> dict:
    """Noise-contrastive estimation, once over all triples in mixed order, each weighted by its count; each batch shares NOISE
    classes drawn from the unigram. Common triples are split into several equal parts, so that no batch hangs on one of them."""
    rng = np.random.default_rng(seed)
    p = {k: v.copy() for k, v in params.items()}
    past = {k: np.full(v.shape, 1e-6) for k, v in p.items()}
    wide = CLASSES + 1
    parts = -(-n * len(n) // max(1, int(n.sum())))
    item = rng.permutation(np.repeat(np.arange(len(n)), parts))
    weights = n / parts
    log_noise = np.log(NOISE * unigram)
    for i in range(0, len(item), batch):
        t, w = triples[item[i : i + batch]], weights[item[i : i + batch]]
        w = w / w.sum()
        k, one, two = t % wide, t // wide % wide, t // wide // wide
        noise = rng.choice(CLASSES, NOISE, p=unigram)
        r1, r2 = p["context"][0][one], p["context"][1][two]
        q = r1 @ p["mix"][0] + r2 @ p["mix"][1]
        hit = (q * p["target"][k]).sum(axis=1) + p["bias"][k] - log_noise[k]
        miss = q @ p["target"][noise].T + p["bias"][noise] - log_noise[noise]
        d_hit = (1 / (1 + np.exp(-np.clip(hit, -30, 30))) - 1) * w
        d_miss = 1 / (1 + np.exp(-np.clip(miss, -30, 30))) * w[:, None]
        d_q = d_hit[:, None] * p["target"][k] + d_miss @ p["target"][noise]
        grads = {name: np.zeros_like(v) for name, v in p.items()}
        np.add.at(grads["target"], k, d_hit[:, None] * q)
        np.add.at(grads["target"], noise, d_miss.T @ q)
        np.add.at(grads["bias"], k, d_hit)
        np.add.at(grads["bias"], noise, d_miss.sum(axis=0))
        np.add.at(grads["context"][0], one, d_q @ p["mix"][0].T)
        np.add.at(grads["context"][1], two, d_q @ p["mix"][1].T)
        grads["mix"][0], grads["mix"][1] = r1.T @ d_q, r2.T @ d_q
        for name in p:
            past[name] += grads[name] ** 2
            p[name] -= rate * grads[name] / np.sqrt(past[name])
    return p


def learner(shared, unigram: np.ndarray, turn: int):
    def learn(table: pa.Table) -> pa.Table:
        keys, n = B.joined(table.column("triple"), np.int32).astype(np.int64), B.joined(table.column("n"), np.int64)
        got = train_on(shared.value, keys, n, unigram, turn << 32 | table.column("shard")[0].as_py(), rate=0.2 / (1 + turn))
        group = pa.array([table.column("shard")[0].as_py() % 64], pa.int32())
        return pa.table({"group": group, "n": pa.array([int(n.sum())]), "params": pa.array([np.concatenate([v.ravel() for v in got.values()]).tobytes()], pa.binary())})

    return learn


def train(triples: DataFrame, unigram: np.ndarray, shards: int = SHARDS, rounds: int = ROUNDS) -> dict:
    """Averaged parameters after all rounds. The tasks' parameters are summed by Spark; one set a round passes the driver."""
    params = fresh_parameters(unigram)
    shapes = {k: v.shape for k, v in params.items()}

    def add(table: pa.Table) -> pa.Table:
        n = table.column("n").to_numpy().astype(np.float64)
        flat = sum(np.frombuffer(x.as_buffer(), np.float64) * k for x, k in zip(table.column("params"), n))
        return pa.table({"group": table.column("group")[:1], "n": pa.array([int(n.sum())]), "params": pa.array([(flat / n.sum()).tobytes()], pa.binary())})

    schema = "group int, n long, params binary"
    for turn in range(rounds):
        learn = learner(triples.sparkSession.sparkContext.broadcast(params), unigram, turn)
        spread = triples.where(F.octet_length("triple") > 0).repartition(4 * shards, "shard")  # or small shards are coalesced into one task
        done = spread.groupBy("shard").applyInArrow(learn, schema)
        rows = done.groupBy("group").applyInArrow(add, schema).select(F.lit(0).alias("group"), "n", "params").groupBy("group").applyInArrow(add, schema).collect()
        if not rows:
            break
        flat, at = np.frombuffer(rows[0]["params"], np.float64), 0
        for k, shape in shapes.items():
            params[k] = flat[at : at + int(np.prod(shape))].reshape(shape)
            at += int(np.prod(shape))
    return params


def class_scores(params: dict, freed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """log10 probability of every class, and of an unknown token, in every context (two before * (CLASSES + 1) + one before)."""
    wide = CLASSES + 1
    one = params["context"][0] @ params["mix"][0] @ params["target"].T
    two = params["context"][1] @ params["mix"][1] @ params["target"].T + params["bias"]
    out, unknown = np.zeros((wide * wide, CLASSES), np.float32), np.zeros(wide * wide)
    for t in range(wide):
        z = one + two[t]
        z -= z.max(axis=1, keepdims=True)
        z -= np.log(np.exp(z).sum(axis=1, keepdims=True))
        out[t * wide : (t + 1) * wide] = z / np.log(10)
        with np.errstate(divide="ignore"):
            unknown[t * wide : (t + 1) * wide] = np.log10(np.exp(z) @ freed)
    return out, unknown


def fit(docs: DataFrame, buckets: int) -> dict:
    """Learn from all rows of docs (text): stored counts, their summary and the parameters."""
    counts = token_counts(docs, buckets)
    info = summary(counts)
    n, v = class_totals(counts, info)
    info["discount"] = info["once"] / (info["once"] + 2 * info["twice"]) if info["twice"] else 0.5
    info["n"] = n
    info["freed"] = np.where(n > 0, info["discount"] * v / np.maximum(1, n), 1.0)  # an empty class has no known token
    unigram = (n + 1.0) / (n.sum() + CLASSES)
    shards = max(SHARDS, buckets)
    info["params"] = train(class_triples(docs, info, shards), unigram, shards) if info["N"] else fresh_parameters(unigram)
    info["counts"] = counts
    return info


def score(docs: DataFrame, model: dict, buckets: int) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of docs (doc_id, held_out, batch, text)."""
    shared = docs.sparkSession.sparkContext.broadcast({k: v for k, v in model.items() if k != "counts"})
    placed = docs.repartition(pieces(1, 1, max(8, buckets)), "batch")

    def ask(table: pa.Table) -> pa.Table:
        found = [np.unique(tokens(b)[0]) for b in B.slices(iter(table.to_batches()))]
        h = np.unique(np.concatenate(found))
        b, cut = B.by_bucket(h, buckets)
        return pa.table({"bucket": pa.array(b), "batch": pa.array([table.column("batch")[0].as_py()] * len(b), pa.int64()), "asked": B.blobs([h[i:j] for i, j in zip(cut, cut[1:])])})

    def answer(asked: pa.Table, known: pa.Table) -> pa.Table:
        h, c = B.joined(known.column("h"), np.uint64), B.joined(known.column("c"), np.int64)
        out = []
        for x in asked.column("asked").to_pylist():
            x = np.frombuffer(x, np.uint64)
            if len(h):
                at = np.minimum(np.searchsorted(h, x), len(h) - 1)
                out.append(np.where(h[at] == x, c[at], 0))
            else:
                out.append(np.zeros(len(x), np.int64))
        return pa.table({"batch": asked.column("batch"), "asked": asked.column("asked"), "c": B.blobs(out)})

    def rate(texts: pa.Table, known: pa.Table) -> pa.Table:
        m = shared.value
        if "table" not in m:
            m["table"], m["unknown"] = class_scores(m["params"], m["freed"])
        h, c = B.joined(known.column("asked"), np.uint64), B.joined(known.column("c"), np.int64)
        order = np.argsort(h)
        h, c = h[order], c[order]
        out = []
        for b in B.slices(iter(texts.to_batches())):
            words, tails, rows = tokens(b)
            at = np.searchsorted(h, words)
            own = c[at]
            k, one, two = class_rows(words, tails, rows, m)
            context = two * (CLASSES + 1) + one
            base = np.log10((own + 0.5) / (m["N"] + 0.5 * (m["V"] + 1)))
            with np.errstate(divide="ignore"):
                inner = np.log10(np.maximum(own - m["discount"], 1e-300) / np.maximum(1, m["n"][k]))
            mine = np.where(own > 0, m["table"][context, k] + inner, m["unknown"][context]) if m["N"] else base
            sums = [np.concatenate([[0.0], np.cumsum(x)]) for x in (own > 0, base, mine)]
            per = [s[rows[1:]] - s[rows[:-1]] for s in sums]
            out.append(pa.record_batch({"doc_id": b.column("doc_id"), "held_out": b.column("held_out"), "n_tokens": pa.array(np.diff(rows)), "n_known": pa.array(per[0].astype(np.int64)), "train_tokens": pa.array(np.full(len(rows) - 1, m["N"], np.int64)), "base_score": pa.array(per[1]), "score": pa.array(per[2])}))
        return pa.Table.from_batches(out)

    asked = placed.groupBy("batch").applyInArrow(ask, "bucket long, batch long, asked binary")
    replies = asked.groupBy("bucket").cogroup(model["counts"].groupBy("bucket")).applyInArrow(answer, "batch long, asked binary, c binary")
    schema = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return placed.groupBy("batch").cogroup(replies.groupBy("batch")).applyInArrow(rate, schema)


def score_documents(docs: DataFrame) -> DataFrame:
    size = text_bytes(docs)
    buckets = pieces(size, 4 * BATCH_BYTES, 8)
    held = in_fold(5, 1)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    model = fit(docs.where(~held), buckets)
    batches = pieces(size, BATCH_BYTES, 8)
    rows = docs.select("doc_id", held.alias("held_out"), F.pmod(F.xxhash64("doc_id", F.octet_length("text"), F.substring("text", 1, 64)), F.lit(batches)).alias("batch"), "text")
    return score(rows, model, buckets)


def op1_lm_scoring(spark, sf_dir: str) -> DataFrame:
    return score_documents(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
