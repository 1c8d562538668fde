"""Phrase mining, token counts and hard negatives against brute force, libraries and SQL, and on awkward tables."""

import re
from collections import Counter
from math import floor

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from millrace.llm import hard_negatives, phrases, token_counts
from millrace.llm.queries import ORACLE_SQL, QUERIES

LONG = " ".join(f"word{i % 977} tail{i % 31}" for i in range(12_000))
DOCS = "doc_id long, text string, lang string, source string, n_chars long, key binary, f long, n long, rank int, n_tokens long"
VECTORS = "vec_id long, embedding array<double>, label int, ids long, score long, dim int, vector string"


@pytest.fixture(scope="module")
def awkward(spark):
    texts = {1: None, 2: "", 3: " \n\t ", 4: "A b. a B! a b", 5: LONG, 6: LONG, 7: "é ñ ü, é ñ ü", 8: "the <s> ▁ </s> 漢字\x00 \r\n", 9: "x" * 70_000, 10: " ".join(["the"] * 40)}
    rows = [(k, t, [None, "en", "und"][k % 3], None, None, None, 5, 6, 7, 8) for k, t in texts.items()]
    return spark.createDataFrame([*rows, rows[4], rows[4], (None, "the the the", None, *[None] * 7), (None, None, None, *[None] * 7)], DOCS)


def brute_phrases(rows, least, longest, inside, top):
    """By the definition, over all phrases of each language."""
    f, n = Counter(), Counter()
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(lower)):
            w = re.findall("[^ \t]+", piece)
            n[lang] += len(w)
            for k in range(1, longest + 1):
                f.update((lang, tuple(w[i : i + k])) for i in range(len(w) - k + 1))
    found = {key: c for key, c in f.items() if len(key[1]) > 1 and c >= least}
    out = {}
    for (lang, p), a in found.items():
        cuts = [(1_000_000 * a * a // (f[lang, p[:k]] * f[lang, p[k:]]), k) for k in range(1, len(p))]
        score, k = min(cuts)
        if not any(x == lang and len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1)) and 100 * c >= inside * a for (x, q), c in found.items()):
            out.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), f[lang, p[:k]], f[lang, p[k:]]))
    return {(lang, i + 1, p.decode(), -a, x, y, n[lang], -s) for lang, all_ in out.items() for i, (s, a, p, x, y) in enumerate(sorted(all_)[:top])}


def as_set(df):
    return {tuple(r) for r in df.collect()}


@pytest.mark.parametrize(("least", "longest", "inside", "top"), [(10, 3, 50, 2000), (2, 3, 50, 40), (2, 4, 80, 2000), (2, 5, 20, 15), (3, 2, 50, 2000)])
def test_phrases_match_brute_force(spark, least, longest, inside, top):
    rng = np.random.default_rng(least * longest)
    rows = [(" ".join(rng.choice(["a", "B", "b", "c.", "d,e", "é", "\tf", "g\n"], rng.integers(0, 60))), [None, "und", "en", "de"][i % 4]) for i in range(80)]
    docs = spark.createDataFrame(rows, "text string, lang string").repartition(5)
    got = as_set(phrases.mine_phrases(docs, least, longest, inside, top))
    assert got and got == brute_phrases(rows, least, longest, inside, top)


def test_phrases_awkward(spark, awkward, monkeypatch):
    rows = [(r.text, r.lang) for r in awkward.collect()]
    want = brute_phrases([(t, x) for t, x in rows], 10, 3, 50, 2000)
    assert as_set(phrases.mine_phrases(awkward)) == want and want
    assert phrases.mine_phrases(awkward.limit(0)).collect() == []


def test_phrases_do_not_depend_on_flushes_filters_or_equal_hashes(monkeypatch):
    keys = np.array([[1, 2], [3, 4], [1, 2], [5, 6], [3, 4]], np.uint64)
    same = np.zeros(5, np.uint64)  # all under one hash
    h, k, n = phrases.summed(same, keys, np.array([1, 2, 3, 4, 5]))
    assert dict(zip(map(tuple, k.tolist()), n.tolist())) == {(1, 2): 4, (3, 4): 7, (5, 6): 4} and len(h) == 3
    words = phrases.Words()
    for w in (b"ab", b"ab", b"cd"):
        words.add(np.array([7], np.uint64), np.array([1]), np.array([0], np.int32), np.array([2]), np.frombuffer(w, np.uint8), ["en"])
    assert words.total()[-1]  # two words under one key are seen
    cells = np.zeros(4, np.uint64)
    cells[1] = 1 << 3
    assert phrases.may_hold(cells, np.array([67 | 67 << 32, 67, 66 | 67 << 32], np.uint64)).tolist() == [True, False, False]


def test_phrase_words_stay_in_their_pieces():
    text = "Ab cd, ef. gh\tij\nk  l".encode()
    data = np.frombuffer(text + b"m n", np.uint8)
    start, end, row, together = phrases.words_of(data, np.array([0, len(text), len(text) + 3, len(text) + 3]))
    assert [bytes(data[a:b]).decode() for a, b in zip(start, end)] == ["Ab", "cd", "ef", "gh", "ij", "k", "l", "m", "n"]
    assert together.tolist() == [True, False, False, True, False, True, False, True, False] and row.tolist() == [0] * 7 + [1] * 2


@pytest.mark.parametrize("name", ["op11_phrase_mining", "op13_hard_negatives"])
def test_new_queries_match_sql(name, spark, sf):
    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    df = QUERIES[name](spark, sf)
    rel = con.execute(ORACLE_SQL[name])
    names = [d[0] for d in rel.description]
    got = as_set(df)
    assert got and got == {tuple(r[names.index(c)] for c in df.columns) for r in rel.fetchall()}


@pytest.mark.parametrize("keep", [0, 50, token_counts.TABLE])
def test_token_counts_match_the_library(spark, sf, awkward, keep):
    from sentencepiece import SentencePieceProcessor

    library = SentencePieceProcessor(model_file=token_counts.default_model())
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").unionByName(awkward.select("doc_id", "text")).repartition(20)
    found = docs.collect()
    want = Counter((r.doc_id, len((r.text or "").encode()), n := len(library.encode(r.text or "")), n > 4096) for r in found)
    assert Counter(map(tuple, token_counts.count_tokens(docs, keep=max(1, keep)).collect())) == want
    assert token_counts.count_tokens(awkward.limit(0)).collect() == [] and token_counts.count_tokens(awkward).columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]


def test_token_counts_of_odd_texts_in_chunks(monkeypatch):
    monkeypatch.setattr(token_counts, "CHUNK", 100)
    pre = token_counts.PreTokens.of(token_counts.default_model())
    rng = np.random.default_rng(3)
    bits = ["a", "the ", " ", "\n", ".", "é", "漢", "▁", "<s>", "</s>", "<0x0A>", "\x00", "😀", "1", "://", "İ", "�", "\t", "th", "    "]
    for n in (0, 1, 3, 50, 400, 3000):
        text = "".join(rng.choice(bits, n))
        total = 0
        for _, _, _, part, start, end, h in token_counts.spans([pa.record_batch({"text": pa.array([text])})], pre):
            total += pre.cached(h, start, end, part).sum()
        assert total == len(pre.library.encode(text))


def test_lookup_table_finds_what_it_holds():
    rng = np.random.default_rng(5)
    h = rng.integers(0, 1 << 63, 5000).astype(np.uint64) << np.uint64(3)  # low bits collide
    table = token_counts.Lookup(h[:3000], np.arange(3000))
    got = table.get(h)
    assert got[:3000].tolist() == list(range(3000)) and (got[3000:] == -1).all()
    assert (token_counts.Lookup(h[:0], np.zeros(0, int)).get(h) == -1).all()


def brute_negatives(rows, k=5, low=80, every=100):
    seen = {}
    for vec_id, label, v in rows:
        if vec_id is None or label is None or v is None or any(x is None or not np.isfinite(x) for x in v):
            continue
        v = [floor(256 * x) for x in v]
        label = int(np.fmod(label + 1, 10)) if vec_id % 7 == 0 else label
        seen.setdefault(vec_id, []).append((label, v))
    seen = {i: min(x, key=lambda lv: (lv[0], len(lv[1]), hard_negatives.narrow(np.array(lv[1], np.int64)).tobytes())) for i, x in seen.items()}
    out = set()
    for a in (i for i in seen if i % every == 0):
        scores = {i: sum(x * y for x, y in zip(seen[a][1], v)) for i, (_, v) in seen.items() if i != a and len(v) == len(seen[a][1])}
        order = sorted(scores, key=lambda i: (-scores[i], i))
        for p in [i for i in order if seen[i][0] == seen[a][0]][:k]:
            fine = [i for i in order if seen[i][0] != seen[a][0] and low * scores[p] <= 100 * scores[i] <= 100 * scores[p]]
            out |= {(a, p, r + 1, i, scores[p], scores[i]) for r, i in enumerate(fine[:k])}
    return out


@pytest.mark.parametrize(("size", "scale"), [(8, 1.0), (3, 0.02), (16, 40.0), (5, 2.0**40)])
def test_negatives_match_brute_force(spark, size, scale, monkeypatch):
    """Small blocks, ties, copies and several passes; components of up to 2**27 are summed in Python integers."""
    rng = np.random.default_rng(size)
    monkeypatch.setattr(hard_negatives, "BLOCK", 60)
    monkeypatch.setattr(hard_negatives, "ANCHORS", 3)
    monkeypatch.setattr(hard_negatives, "GROUP_BYTES", 900)
    scale = min(scale, 2.0**19)
    vectors = np.round(rng.normal(size=(700, size)) * scale, 2)
    vectors[rng.integers(0, 700, 250)] = vectors[0]
    rows = [(int(i), int(rng.integers(0, 10)), v.tolist()) for i, v in zip(rng.permutation(2000)[:700], vectors)]
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>").repartition(4)
    got = as_set(hard_negatives.mine_negatives(df))
    assert got and got == brute_negatives(rows)


def test_negatives_awkward(spark):
    nan, inf = float("nan"), float("inf")
    vectors = [(100, [0.5, 0.5], 1), (1, [0.5, 0.4], 1), (2, [0.5, 0.4], 2), (3, [0.45, 0.4], 3), (3, [0.45, 0.4], 3), (4, [nan, 1.0], 1), (5, [inf, 1.0], 1), (6, [None, 1.0], 1), (7, None, 1), (8, [1.0, 1.0], None), (None, [1.0, 1.0], 1), (9, [1.0], 2),
               (200, [0.0, 0.0], 1), (300, [], 1), (11, [], 1), (12, [], 4), (400, [-0.5, -0.5], 9), (3, [0.1, 0.1], 3)]
    rows = [(i, v, label, 1, 2, 3, "x") for i, v, label in vectors]
    df = spark.createDataFrame(rows, VECTORS)
    got = as_set(hard_negatives.mine_negatives(df))
    assert got == brute_negatives([(i, label, v) for i, v, label in vectors]) and {r[0] for r in got} >= {100, 200, 300}
    assert hard_negatives.mine_negatives(df.limit(0)).collect() == []
    assert hard_negatives.mine_negatives(df.where(F.col("vec_id") == 1)).collect() == []


def test_slices_drop_no_pair_that_qualifies():
    rng = np.random.default_rng(9)
    a, c = rng.integers(-900, 900, (20, 12)), rng.integers(-900, 900, (300, 12))
    want = {(i, j, s) for (i, j), s in np.ndenumerate(a @ c.T) if s >= 2_500_000}
    for cut in (0.0, 0.1, 1.0):
        hard_negatives.SPARSE, old = cut, hard_negatives.SPARSE
        try:
            row, col, score = hard_negatives.sliced(a, c, lambda low, high: high >= 2_500_000, lambda row, low, high: high >= 2_500_000)
        finally:
            hard_negatives.SPARSE = old
        found = set(zip(row.tolist(), col.tolist(), score.tolist()))
        assert {x for x in found if x[2] >= 2_500_000} == want and want
