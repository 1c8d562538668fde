"""The ten operators against brute force, round trips and held-out accuracy, and on awkward tables."""

import hashlib
import math
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import queries
from millrace.llm.decontaminate import find_leaks
from millrace.llm.html_text import extract, extract_pages
from millrace.llm.jaccard import join_documents
from millrace.llm.language_id import predict_languages
from millrace.llm.lm_scoring import score_documents
from millrace.llm.nn_descent import nearest
from millrace.llm.packing import best_plan, pack_documents
from millrace.llm.sstable import Shard, ShardWriter, encode_documents, key_of, lookup, write_shards
from millrace.llm.suffix_dedup import remove_repeats
from millrace.llm.tokens import default_vocabulary
from millrace.llm.toxicity import score_toxicity

WORDS = re.compile(rb"[^\x20\x09-\x0D]+")
LONG = " ".join(f"word{i % 977} tail{i % 31}" for i in range(12_000))
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, bucket long, h long, n long, score double"


@pytest.fixture(scope="module")
def documents(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet")


@pytest.fixture(scope="module")
def texts(documents):
    return {r.doc_id: r.text or "" for r in documents.select("doc_id", "text").collect()}


@pytest.fixture(scope="module")
def awkward(spark):
    """Nulls in every column, empty and very long texts, repeated rows, ties, extra columns with clashing names."""
    near = LONG + " and one more"
    texts = {1: None, 2: "", 3: "  \n", 4: "four words stand here", 5: "four words stand here", 6: LONG, 7: near, 8: LONG, 9: "é ñ ü", 10: "12345 !!!", 11: "x" * 60 + "é" + "y" * 60, 12: "x" * 60}
    rows = [(k, t, "en" if k % 2 else None, None, None, 1, 2, 3, None) for k, t in texts.items()]
    return spark.createDataFrame([*rows, rows[5], rows[5], (None, LONG, None, None, None, None, None, None, None), (None, None, None, None, None, None, None, None, None)], SCHEMA)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def lower_words(text):
    return WORDS.findall(bytes(b + 32 if 65 <= b <= 90 else b for b in text.encode()))


def shingles(text):
    w = lower_words(text)
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def components_of(texts):
    sets = {k: shingles(t) for k, t in texts.items()}
    root = {k: k for k in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            common = len(sets[a] & sets[b])
            if common and 100 * common >= 75 * (len(sets[a]) + len(sets[b]) - common):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {k: (len(sets[k]), find(k)) for k in ids}


def texts_of(texts, span=50):
    """Marks of the removed bytes of each text."""
    first = {}
    data = {k: (t or "").encode() for k, t in texts.items()}
    for k in sorted(data):
        for i in range(len(data[k]) - span + 1):
            first.setdefault(data[k][i : i + span], k)
    out = {}
    for k, d in data.items():
        out[k] = np.zeros(len(d), bool)
        for i in range(len(d) - span + 1):
            if first[d[i : i + span]] < k:
                out[k][i : i + span] = True
    return out


def removed_of(texts, span=50):
    out = {}
    for k, gone in texts_of(texts, span).items():
        d = (texts[k] or "").encode()
        spans = int(np.count_nonzero(gone[1:] & ~gone[:-1])) + int(gone[:1].sum())
        out[k] = (len(d), int(gone.sum()), spans, hashlib.sha256(bytes(np.frombuffer(d, np.uint8)[~gone])).hexdigest())
    return out


def encoded(texts):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(default_vocabulary())
    return {k: library.encode(t, add_special_tokens=False).ids for k, t in texts.items()}


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_jaccard_matches_brute_force(documents, texts):
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in join_documents(documents).collect()}
    assert got == components_of(texts)


def test_jaccard_awkward(awkward, nothing):
    got = join_documents(awkward).collect()
    assert len(got) == awkward.count()
    by = {r.doc_id: r.component_id for r in got}
    assert (by[4], by[5], by[6], by[7], by[8], by[1], by[2], by[3], by[None]) == (4, 4, 6, 6, 6, 1, 2, 3, None)
    assert join_documents(nothing).count() == 0


def test_jaccard_large_group_of_near_copies(spark):
    base = [f"w{i}" for i in range(60)]
    rows = [(i, " ".join(base[:30] + [f"own{i}"] + base[30:])) for i in range(150)] + [(1000 + i, f"other{i} text of words that stand alone {i}") for i in range(40)]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in join_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == components_of(dict(rows))


def test_repeats_match_brute_force(documents, texts):
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in remove_repeats(documents).collect()}
    assert got == removed_of(texts)


def test_repeats_random_strings(spark):
    rng = np.random.default_rng(3)
    stock = ["".join(rng.choice(list("ab é"), 90)) for _ in range(6)] + ["a" * 200, "ab" * 70]
    rows = [(i, "".join(s[: int(rng.integers(30, 200))] for s in rng.permutation(stock)[: rng.integers(0, 5)])) for i in range(80)]
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == removed_of(dict(rows))


def test_repeats_of_anchors_on_several_shards(spark):
    rng = np.random.default_rng(4)
    stock = ["".join(rng.choice(list("ab é"), 90)) for _ in range(3)] + ["a" * 120]
    rows = [(i, "".join(stock[int(k)][: int(rng.integers(40, 120))] for k in rng.integers(0, 4, 3)) + f" own{i}") for i in range(60)]
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"), anchor_rows=7).collect()}
    assert got == removed_of(dict(rows))


def test_repeats_of_one_id_with_two_texts(spark):
    a, b = "alpha " * 12, "bravo " * 12
    rows = [(1, a), (2, a + "x" + b), (2, b), (2, "y" * 60), (3, b + a), (3, "y" * 60)]
    got = sorted((r.doc_id, r.n_bytes, r.n_removed) for r in remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == [(1, 72, 0), (2, 60, 0), (2, 72, 0), (2, 145, 72), (3, 60, 60), (3, 144, 144)]


def test_repeats_awkward(awkward, nothing):
    got = remove_repeats(awkward).collect()
    assert len(got) == awkward.count()
    by = {r.doc_id: r for r in got}
    assert (by[8].n_removed, by[7].n_removed, by[7].n_spans) == (len(LONG), len(LONG), 1)
    assert by[6].n_removed == 0 and by[None].n_removed == 0 and by[12].n_removed == 60
    assert remove_repeats(nothing).count() == 0


def test_token_shards_match_the_library(documents, texts):
    want, at = {}, 0
    ids = encoded(texts)
    for k in sorted(ids):
        want[k] = (at, len(ids[k]) + 1, crc([*ids[k], 1]))
        at += len(ids[k]) + 1
    assert {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in encode_documents(documents).collect()} == want


def test_token_shards_lookup(spark, documents, texts, tmp_path):
    path = f"file://{tmp_path}/shards"
    shards = write_shards(documents.select("doc_id", "text"), path)
    keys = spark.createDataFrame([(0,), (7,), (10**9,)], "doc_id long")
    found = lookup(shards, path, keys)
    assert sorted({r.doc_id for r in found.collect()} - {10**9}) == [0, 7]


def test_shard_file_round_trip():
    w = ShardWriter()
    rows = [(i * 3, np.arange(i % 50, dtype=np.uint32) * 1000) for i in range(3000)]
    for k, ids in rows:
        w.add(key_of(k), ids)
    s = Shard(w.finish())
    assert all(len(s.get(k)) == 1 for k, _ in rows[::97]) and not s.get(1) and not s.get(10**12)
    assert sum(1 for _ in s) == len(rows)


def test_token_shards_awkward(awkward, nothing):
    got = encode_documents(awkward).orderBy("start").collect()
    assert len(got) == awkward.count() and got[0].doc_id is None
    assert all(a.start + a.n_tokens == b.start for a, b in zip(got, got[1:]))
    assert encode_documents(nothing).count() == 0


def check_packing(rows, lengths):
    by, sizes = {}, {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
        sizes[r.doc_id] = sizes.get(r.doc_id, 0) + r.length
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    assert sizes == lengths
    return len(by)


def test_packing(documents, texts):
    rows = pack_documents(documents.select("doc_id", "text")).collect()
    ids = {k: [*v, 0] for k, v in encoded(texts).items()}
    n = check_packing(rows, {k: len(v) for k, v in ids.items()})
    assert n <= 1.01 * -(-sum(map(len, ids.values())) // 2048) + 1
    for r in rows:
        piece = ids[r.doc_id][r.start : r.start + r.length]
        assert r.start == 2048 * r.piece and r.ids_crc32 == crc(piece) and len(piece) == r.length


def test_packing_awkward(awkward, nothing):
    assert pack_documents(awkward).count() >= awkward.count()
    assert pack_documents(nothing).count() == 0


def test_packing_plans_beat_no_bound():
    rng = np.random.default_rng(1)
    for _ in range(5):
        counts = np.bincount(rng.integers(1, 2049, 3000), minlength=2049)
        plan = best_plan(counts)
        assert plan.table().shape[0] > 0


def test_lm_scoring(documents, texts):
    got = {r.doc_id: r for r in score_documents(documents).collect()}
    assert len(got) == len(texts)
    held = {k: zlib.crc32(str(k).encode()) % 5 == 1 for k in texts}
    count = {}
    for k, t in texts.items():
        if not held[k]:
            for w in [*lower_words(t), None]:
                count[w] = count.get(w, 0) + 1
    total, kinds = sum(count.values()), len(count)
    for k, t in texts.items():
        tokens = [*lower_words(t), None]
        base = sum(math.log10((count.get(w, 0) + 0.5) / (total + 0.5 * (kinds + 1))) for w in tokens)
        r = got[k]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[k], len(tokens), sum(w in count for w in tokens), total)
        assert math.isclose(r.base_score, base, rel_tol=1e-9)
        assert math.isfinite(r.score) and r.score <= 0
    out = [r for r in got.values() if r.held_out]
    assert sum(r.score for r in out) > sum(r.base_score for r in out)


def test_lm_probabilities_sum_to_one(documents):
    from millrace.llm import lm_scoring as L

    model = L.fit(documents.select("text").where("text is not null"), 8)
    table, unknown = L.class_scores(model["params"], model["freed"])
    some = np.random.default_rng(0).integers(0, len(table), 200)
    known = np.zeros(L.CLASSES)
    for r in model["counts"].collect():
        h, tail, c = (np.frombuffer(r[k], t) for k, t in (("h", np.uint64), ("tail", np.uint64), ("c", np.int64)))
        k = L.classes_of(h, tail, model)
        known += np.bincount(k, weights=(c - model["discount"]) / np.maximum(1, model["n"][k]), minlength=L.CLASSES)
    assert np.allclose(10.0 ** table[some].astype(float) @ known + 10.0 ** unknown[some], 1, atol=1e-5)


def test_lm_scoring_awkward(awkward, nothing):
    got = score_documents(awkward).collect()
    assert len(got) == awkward.count() and all(math.isfinite(r.score) for r in got)
    assert score_documents(nothing).count() == 0


def test_toxicity_held_out(spark):  # sf0.1: a few hundred labels, as sf0.01 has, do not show every offending word
    sf = "/root/testdata/sf0.1"
    got = score_toxicity(spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet"))
    rows = got.join(spark.read.parquet(f"{sf}/labels.parquet").where("toxic is not null"), "doc_id").where("held_out").collect()
    good = sum(r.predicted == r.toxic for r in rows) / len(rows)
    assert good >= 0.95 and all(0 <= r.score <= 1 for r in rows)


def test_toxicity_awkward(spark, awkward, nothing):
    labels = spark.createDataFrame([(6, 1, 1), (6, 1, 0), (4, None, 0), (None, 1, 1), (5, 0, None)], "doc_id long, quality int, toxic int")
    assert score_toxicity(awkward, labels).count() == awkward.count()
    assert score_toxicity(awkward, labels.limit(0)).count() == awkward.count()
    assert score_toxicity(nothing, labels).count() == 0


def test_language_held_out(documents):
    got = predict_languages(documents).collect()
    truth = {r.doc_id: r.lang for r in documents.select("doc_id", "lang").collect()}
    held = [r for r in got if r.held_out and r.lang_pred != "und"]
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) / len(held) >= 0.9


def test_language_of_rare_scripts(spark):
    rng = np.random.default_rng(5)
    stock = {"en": ["plain", "words", "quick", "jumps", "fox!\"#$%", "v&'()*z", "+,-./:;", "<=>?@[", "\\\\]^_`{|}~"], "ru": ["мыло", "рыба", "дома", "этот"], "uk": ["їжак", "ґава", "єнот", "село"]}
    rows = [(i, " ".join(rng.choice(stock[lang], 400 if lang == "en" else 12)), lang) for i, lang in enumerate(["en", "en", "en", "ru", "uk"] * 40)]
    got = [r for r in predict_languages(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect() if r.held_out and rows[r.doc_id][2] != "en"]
    assert len(got) >= 5 and all(r.lang_pred == rows[r.doc_id][2] for r in got)


def test_language_code_lengths_match_plain_ppm():
    from millrace.llm.language_id import code_lengths, contexts, tree

    def keys(text):
        raw = np.frombuffer(text.encode(), np.uint8)
        return contexts(raw, np.array([0, len(raw)]))

    seen, n = np.unique(keys("the cat sat on the mat, и мыло"), return_counts=True)
    count = dict(zip(seen.tolist(), n.tolist()))

    def chance(ctx, d):  # the chances of all 256 bytes after the last d bytes of ctx
        below = chance(ctx, d - 1) if d else [1 / 256] * 256
        c = [0] * 256
        for k, m in count.items():
            if (k >> 8) % 256**d == ctx % 256**d:
                c[k % 256] += m
        if not sum(c):
            return below
        kinds, total = sum(x > 0 for x in c), sum(c)
        rest = sum(b for b, x in zip(below, c) if not x)
        return [x / (total + kinds) if x else kinds / (total + kinds) * b / rest for b, x in zip(below, c)]

    asked = keys("that mат zoo")
    want = [-math.log2(chance(int(k) >> 8, 3)[int(k) % 256]) for k in asked]
    assert np.allclose(code_lengths(tree(seen, n), asked), want, atol=1e-4)


def test_language_awkward(awkward, nothing):
    got = {r.doc_id: r for r in predict_languages(awkward).collect()}
    assert got[1].lang_pred == got[2].lang_pred == got[3].lang_pred == got[10].lang_pred == "und" and got[9].lang_pred == "en"
    assert predict_languages(nothing).count() == 0


def test_nearest_recall(spark, sf):
    rows = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    queries_ = rows.where("vec_id % 50 = 0")
    got = {}
    for r in nearest(rows, queries_).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    all_ = {r.vec_id: np.array(r.embedding, float) for r in rows.collect()}
    ids = np.array(sorted(all_))
    m = np.stack([all_[i] for i in ids])
    m /= np.linalg.norm(m, axis=1, keepdims=True)
    hits = total = 0
    for q in [i for i in ids if i % 50 == 0]:
        s = m @ m[np.searchsorted(ids, q)]
        order = [i for i in np.lexsort((ids, -s)) if ids[i] != q][:5]
        hits += len({int(ids[i]) for i in order} & {v for _, v, _ in got[q]})
        total += 5
        assert [r for r, _, _ in sorted(got[q])] == [1, 2, 3, 4, 5]
        assert all(math.isclose(x[2], s[np.searchsorted(ids, x[1])], abs_tol=1e-9) for x in got[q])
    assert hits / total >= 0.9


def test_nearest_awkward(spark):
    rows = spark.createDataFrame([(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.0, 1.0]), (3, None), (4, [0.0, 0.0]), (5, [float("nan"), 1.0]), (6, [None, 1.0]), (50, [2.0, 0.0]), (None, [1.0, 1.0])], "vec_id long, embedding array<float>")
    got = [(r.query_id, r.rank, r.vec_id) for r in nearest(rows, rows.where("vec_id % 50 = 0")).orderBy("query_id", "rank").collect()]
    assert got == [(0, 1, 1), (0, 2, 50), (0, 3, 2), (50, 1, 0), (50, 2, 1), (50, 3, 2)]
    assert nearest(rows.limit(0), rows.limit(0)).count() == 0


QUESTION = "Alice Moore walked 12 km to the market and bought 7 apples at 3 dollars each, then she met Bob Stone who sold her 12 km of rope. How many dollars did Alice Moore spend on apples that day?"


def test_leaks(spark):
    swapped = QUESTION.replace("12", "31").replace("7", "9").replace(" 3 ", " 8 ").replace("Bob Stone", "Rita Hale").replace("Alice Moore", "Maria Lopez")
    torn = "Nothing here. " + " ".join(w for w in QUESTION.split()[::-1])
    docs = spark.createDataFrame([(1, "Intro text first. " + QUESTION + " And an end."), (2, "Before it. " + swapped), (3, torn), (4, None), (5, ""), (None, QUESTION), (1, "Intro text first. " + QUESTION + " And an end.")], "doc_id long, text string")
    items = spark.createDataFrame([(10, QUESTION), (11, None), (12, ""), (None, "x y z")], "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in find_leaks(docs, items).collect()}
    assert got == {(1, 10), (2, 10)}
    assert find_leaks(docs.limit(0), items).count() == 0 and find_leaks(docs, items.limit(0)).count() == 0


def test_leaks_of_short_items_at_every_place(spark):
    pre = "one more plain line of words".split()
    ten = "which river flows past seven old towns before reaching sea"
    items = [(1, "What is 12 times 7 plus 3?"), (2, " ".join(ten.split()[:8])), (3, " ".join(ten.split()[:9])), (4, ten), (5, "12 km"), (6, "Blue?")]
    docs = [(10 * k + n, " ".join(pre[:n]) + " " + text + " and then it goes on for some more words") for k, text in items for n in range(5)]
    docs += [(100, "so what is 31 times 9 plus 4 after all of this, nobody can tell"), (101, "it was 31 miles to the town and 12 days of rain in all that time")]
    got = {(r.doc_id, r.item_id) for r in find_leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert {(10 * k + n, k) for k, _ in items for n in range(5)} <= got
    assert (100, 1) in got and not [x for x in got if x[0] == 101 or (x[1] in (1, 5, 6) and x[0] != 100 and x[0] // 10 != x[1])]


def test_leaks_of_edited_items(spark):
    left = "the old mill by the quiet river was run for many years by a family that sold flour to"
    right = "and every morning the carts came over the bridge with grain from farms around the wide green valley below"
    text = f"{left} Alice Moore for 12 km of rope {right}"
    edits = {
        1: text.replace("Alice Moore", "Maria"), 2: text.replace("Alice Moore", "Maria del Carmen Lopez Ruiz"), 3: text.replace("12 km", "31"),
        4: text.replace("flour to", "fine flour to"), 5: text.replace("and every", "and so every"), 6: text.replace("rope and", "and"),
        7: " ".join(reversed(text.split())), 8: left, 9: f"{text.replace('and every', 'and so every').replace('12 km', '31 km')}. Then {text.replace('and every', 'and so every').replace('12 km', '47 km')}",
    }
    plain = f"{left} nobody at all in town {right}"
    words = plain.split()
    edits |= {10 + n: " ".join(words[:n] + ["indeed"] * (n - 17) + words[n:]) for n in (18, 20, 22)}
    got = {(r.doc_id, r.item_id) for r in find_leaks(spark.createDataFrame([(k, "See here: " + t) for k, t in edits.items()], "doc_id long, text string"), spark.createDataFrame([(1, text), (2, plain)], "item_id long, text string")).collect()}
    assert {k for k, i in got if i == 1} >= {1, 2, 3, 4, 5, 6, 9} and {k for k, i in got if i == 2} >= {28, 30, 32}
    assert not {k for k, _ in got} & {7, 8}


def test_leaks_in_long_runs_of_names_and_numbers(spark):
    names, numbers = "he met " + "Alpha Beta " * 30_000, ",".join(map(str, range(30_000)))
    docs = spark.createDataFrame([(1, names), (2, numbers), (3, f"{numbers} {QUESTION} {names}"), (4, "é" * 500_000)], "doc_id long, text string")
    got = {(r.doc_id, r.item_id) for r in find_leaks(docs, spark.createDataFrame([(10, QUESTION)], "item_id long, text string")).collect()}
    assert got == {(3, 10)}


def test_leaks_of_table_match_plain_search(spark):
    sf = "/root/testdata/sf0.01"
    docs, items = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/benchmark.parquet")
    got = {r.doc_id for r in find_leaks(docs, items).collect()}
    held = {r.item_id: r.text for r in items.collect()}
    want = {r.doc_id for r in docs.collect() if r.text and any(t in r.text for t in held.values())}
    assert want <= got


def test_html():
    page = "<html><head><title>T</title><style>p{}</style></head><body><h1>Head</h1><p>One <b>two</b><p>Three<br>four<ul><li>a<li>b<ol><li>c</ol></ul><table><tr><th>k<th>value<tr><td>long key<td>1</table><div style='display:none'>no</div><script>no()</script><p hidden>no</p>end &amp; out</body>"
    got = extract(page)
    assert "no" not in got.replace("now", "") and "- a\n- b" in got and "One two\n\nThree\nfour" in got
    assert any(re.fullmatch(r"k +\| value", line.rstrip()) for line in got.split("\n")) and "long key | 1" in got and got.rstrip().endswith("end & out")
    assert extract(None) is None and extract("") == ""


def test_html_of_hostile_pages():
    import time

    start = time.time()
    assert "end" in extract('<a b="x\' ' * 60_000 + "> end")
    assert extract("<a " * 100_000 + "'") and extract("<p \"'>" * 50_000 + "end")
    wide = "<table><tr><td>" + "w" * 5_000 + "</td><td>a</td></tr>" + "<tr><td>x</td><td>y</td></tr>" * 3_000 + "</table>"
    assert len(extract(wide)) < 3 * len(wide)
    assert time.time() - start < 20
    assert extract('<p title="a > b">shown</p><p title="open>too</p>') == "shown\n\ntoo"


def test_html_rendering_of_blocks_and_tables():
    page = "<h2>T</h2><ol><li>a<ul><li>b</ul><li>c</ol><table><tr><td>one<td>2<tr><td>three<td>4</table><pre>x\n  y</pre><p>see <img alt='cat'> &lt;b&gt;<p>a<br>b<dl><dt>k<dd>v</dl><noscript>no</noscript><template>no</template><p style='visibility: hidden'>no</p><select><option>o1<option>o2</select>"
    want = ["T", "1. a", "   - b", "2. c", "one   | 2", "three | 4", "x", "  y", "see cat <b>", "a", "b", "k", "v", "o1", "o2"]
    assert [x for x in extract(page).split("\n") if x] == want


def test_html_awkward(spark):
    rows = [(1, None, None), (2, "u", ""), (3, "u", "<div>" * 5000 + "deep"), (3, "u", "<p>unclosed <b"), (None, "u", "text"), (4, "u", "a " * 200_000)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("clash"))
    assert extract_pages(df, ["page_id"]).count() == len(rows)


@pytest.mark.parametrize("name", ["op6_decontamination", "op7_html_extraction", "op10_language_id"])
def test_registered_queries_run(name, spark, sf):
    assert queries.QUERIES[name](spark, sf).columns
