"""Curation operators against plain Python on small tables."""

import random
from collections import Counter

import pytest

from pyspark.sql import functions as F

from millrace.functions import text as T
from millrace.operators import curate as C


@pytest.mark.parametrize("fold_rows", [C.FOLD, 7, 0])
def test_capped_skips_and_goes_on(spark, fold_rows):
    """By one task a group, by rounds that leave a few rows to a task, and by rounds alone."""
    rng = random.Random(1)
    rows = [(g, k if g != "d" else k // 3, rng.randint(0, 40)) for g in ("a", "b", "c", "d", None) for k in range(60 if g != "c" else 3)]
    got = Counter((r.g, r.k, r.n) for r in C.capped(spark.createDataFrame(rows, "g string, k long, n long").repartition(5), "g", "k", "n", 150, fold_rows, block=4).collect())
    want = Counter()
    for g in ("a", "b", "c", "d", None):
        used = 0
        for k, n in sorted((k, n) for h, k, n in rows if h == g):
            if used + n <= 150:
                used += n
                want[g, k, n] += 1
    assert got == want and {g for g, _, _ in got} == {"a", "b", "c", "d", None}


def test_capped_awkward(spark):
    rows = [("a", 1, 300), ("a", 1, 300), ("a", 2, 100), ("b", None, 600), ("b", 3, None), (None, None, 500), (None, 1, 1)]
    df = spark.createDataFrame(rows, "g string, k long, n long")
    got = Counter(tuple(r) for r in C.capped(df, "g", "k", "n", 500).collect())
    assert got == Counter([("a", 1, 300), ("a", 2, 100), ("b", 3, None), (None, None, 500)])
    assert C.capped(df.limit(0), "g", "k", "n", 500).collect() == []


def test_reasons_of_repeated_rows(spark):
    long = "long enough " * 30
    rows = [(1, 1, "s", "s/1", "", long)] * 3 + [(1, 2, "s", "s/2", "", long), (None, 3, None, None, None, long + "x"), (5, 4, "s", "s", "", None), (6, 5, "s", "s", None, None)]
    got = Counter((r.id, r.reason) for r in C.with_reason(spark.createDataFrame(rows, "seq long, id long, source string, origin string, instruction string, response string")).collect())
    assert got == Counter({(1, None): 1, (1, "duplicate"): 2, (2, "duplicate"): 1, (3, None): 1, (4, "short"): 1, (5, "short"): 1})


def test_runs_of_sparse_tied_and_missing_places(spark):
    rows = [(None, "x"), (None, "x"), (5, "y"), (5, "y"), (5, "x"), (10**15, "x"), (10**17, None), (10**17 + 1, None)]
    got = sorted((r.run, r.place, r.o or 0, r.v or "") for r in C.runs(spark.createDataFrame(rows, "o long, v string"), "v", "o", block=2).collect())
    assert got == [(1, 0, 0, "x"), (1, 1, 0, "x"), (1, 2, 5, "x"), (2, 0, 5, "y"), (2, 1, 5, "y"), (3, 0, 10**15, "x"), (4, 0, 10**17, ""), (4, 1, 10**17 + 1, "")]
    assert C.runs(spark.createDataFrame([], "o long, v string"), "v", "o").collect() == []


def test_runs_over_blocks(spark):
    rng = random.Random(2)
    rows = [(k * 3, rng.choice(["x", "y", None]) if k % 7 else "x") for k in range(100)]
    got = [(r.o, r.run, r.place) for r in C.runs(spark.createDataFrame(rows, "o long, v string"), "v", "o", block=10).orderBy("o").collect()]
    want, run, place = [], 0, 0
    for k, (o, v) in enumerate(rows):
        run, place = (run + 1, 0) if k == 0 or v != rows[k - 1][1] else (run, place + 1)
        want.append((o, run, place))
    assert got == want


def test_fnv1a(spark):
    def plain(text):
        h = 0xCBF29CE484222325
        for b in text.encode():
            h = (h ^ b) * 0x100000001B3 % 2**64
        return f"{h:016x}"

    texts = ["", "a", "é ñ" * 50, "x" * 3000, "a", None]
    got = [r.h for r in spark.createDataFrame([(t,) for t in texts], "t string").coalesce(1).select(T.fnv1a("t").alias("h")).collect()]
    assert got == [None if t is None else plain(t) for t in texts]


def test_with_reason_shuffles_no_text(spark):
    rows = spark.createDataFrame([(1, 1, "s", "s/1", "", "long enough " * 30), (2, 2, "s", "s/2", "", "long  enough " * 30), (3, 3, "s", "s/3", "", "short"), (4, 4, "s", "s/4", "", "short")], "seq long, id long, source string, origin string, instruction string, response string")
    out = C.with_reason(rows)
    assert {r.id: r.reason for r in out.collect()} == {1: None, 2: "duplicate", 3: "short", 4: "short"} and "response" not in out.columns
    assert out.where(F.col("reason").isNull()).count() == 1


def test_build_writes_and_counts_in_one_pass(spark, tmp_path):
    from millrace.operators import build as B

    long = "long enough " * 30
    rows = [(1, "a", "book", "b/1", None, long), (2, "b", "chat", "c/1", "q", long), (3, "a2", "book", "b/2", "", long), (3, "a2", "book", "b/2", "", long), (4, "s", "book", "b/3", "", "short"), (5, "n", None, None, "", long + "x"), (6, "e", "book", "b/4", "", None)]
    df = spark.createDataFrame(rows, "seq long, id string, source string, origin string, instruction string, response string")
    flags = spark.createDataFrame([("b", "bad", [("other", "x"), ("rhythm_trick", "y"), ("other", "z")]), ("b", "bad", []), ("zz", "gone", None), ("s", "short", None), (None, None, None)], "id string, note string, spans array<struct<category:string,text:string>>")
    built = B.build(df, flags, str(tmp_path / "out"), ["chat", "book", "none"], None, {"image": 2})
    assert [x[:2] for x in built["sources"]] == [("chat", 0), ("book", 1), ("none", 0), ("other", 1)] and built["sources"][1][2] == 90
    assert dict(built["left_out"]) == {"safety": 0, "image": 2, "empty": 0, "notes": 0, "no header": 0, "short": 2, "duplicate": 2, "flagged": 1}
    assert {r.id for r in built["unmatched"].collect()} == {"zz", "s"}
    out = spark.read.json(str(tmp_path / "out" / "examples"))
    assert {(r.id, r.kind) for r in out.collect()} == {("a", "train"), ("b", "slop"), ("n", "train")}
    nothing = B.build(df.limit(0), flags.limit(0), str(tmp_path / "none"), ["book"])
    assert nothing["sources"] == [("book", 0, 0, 0), ("other", 0, 0, 0)] and sum(n for _, n in nothing["left_out"]) == 0


def test_teacher_sections(spark):
    from millrace.operators import corpus as O

    head = lambda section: f"<!-- source: s{section} -->\n### User\nQ\n### Assistant\nA\n```rust\nx\n```\n"
    rows = [("e1", head("; section: 1")), ("e2", head("; section: 9")), ("e3", head("")), ("e4", head("; section: 2; licence: bsd")), ("e5", "### User\nQ")]
    sections = [("1", "trpl", "trpl/1", "mit", "t1"), ("2", "go", "go/2", "apache", "t2"), ("1", "trpl", "trpl/1", "mit", "t1"), (None, "x", "x", "x", "x")]
    checked = O.with_sections(O.entry_parts(spark.createDataFrame(rows, "origin string, entry string")), spark.createDataFrame(sections, "id string, source string, origin string, licence string, text string"))
    assert {r.origin: r.error for r in checked.collect()} == {"e1": None, "e2": "unknown section", "e3": None, "e4": None, "e5": "no source"}
    assert {tuple(r) for r in O.conversations_by_source(checked).collect()} == {("trpl", 1), ("go", 1), ("written by the teacher", 1)}
    assert [tuple(r) for r in O.blocks_by_language(checked).collect()] == [("rust", 3, 3)]
    assert {(r.entry, r.origin, r.licence, r.source_text) for r in O.chat_lines(checked).collect()} == {("e1", "trpl/1", "mit", "t1"), ("e3", "e3", None, None), ("e4", "go/2", "bsd", "t2")}
