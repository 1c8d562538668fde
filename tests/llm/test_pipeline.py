"""Each stage of the corpus pipeline on what the one before it kept, against brute force."""

import re

import numpy as np
import pytest
from pyspark.sql import functions as F

pipeline = pytest.importorskip("corpus_pipeline")

from .test_operators import check_packing, components_of, encoded, removed_of, texts_of  # noqa: E402

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def rows_of(df):
    return {r.doc_id: r.text for r in df.collect()}


def cut(text, gone):
    out, raw = [], text.encode()
    for m in re.finditer(r"(?s).", text):
        at = len(text[: m.start()].encode())
        size = len(m[0].encode())
        if not gone[at : at + size].all():
            out.append(raw[at : at + size].decode())
    return "".join(out)


def test_stages_match_brute_force(spark, sf):
    assert [n for n, _ in pipeline.STAGES] == ["language_id", "ngram_jaccard_join", "suffix_array_dedup", "benchmark_decontamination", "best_fit_packing"]
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    extra = spark.createDataFrame([(10_001, None, None, None, None), (10_002, "", "en", "s", 0), (10_003, "123 !!", "en", "s", 6), (10_004, "", None, None, None)], SCHEMA)
    docs = docs.unionByName(extra.select(*docs.columns))
    stages = [f for _, f in pipeline.STAGES]
    one = pipeline.stored(stages[0](spark, docs, sf), "one")
    want = {k: t for k, t in rows_of(docs).items() if t and re.search(r"[^\W\d_]", t)}
    assert rows_of(one) == want and one.columns == docs.columns
    two = pipeline.stored(stages[1](spark, one, sf), "two")
    kept = {k for k, (_, root) in components_of(want).items() if root == k}
    assert set(rows_of(two)) == kept and two.columns == docs.columns
    three = pipeline.stored(stages[2](spark, two, sf), "three")
    held = {k: want[k] for k in kept}
    masks = texts_of(held)
    assert rows_of(three) == {k: cut(t, masks[k]) for k, t in held.items()} and three.columns == docs.columns
    four = pipeline.stored(stages[3](spark, three, sf), "four")
    items = [r.text for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    left = rows_of(four)
    assert left.items() <= rows_of(three).items() and not [k for k, t in left.items() if any(x in t for x in items)]
    gone = {k: t for k, t in rows_of(three).items() if k not in left}
    words = lambda t: {tuple(w[i : i + 5]) for w in [re.findall(r"[a-z]+", t.lower())] for i in range(len(w) - 4)}
    marks = set().union(*map(words, items))
    assert all(words(t) & marks for t in gone.values())
    five = stages[4](spark, four, sf).collect()
    n = check_packing(five, {k: len(v) + 1 for k, v in encoded(left).items()})
    assert n <= 1.02 * sum(len(v) + 1 for v in encoded(left).values()) / 2048 + 1


def test_pipeline_of_nothing(spark, sf):
    docs = spark.createDataFrame([], SCHEMA)
    for _, stage in pipeline.STAGES[:-1]:
        docs = pipeline.stored(stage(spark, docs, sf), "stage")
        assert docs.count() == 0
    assert pipeline.STAGES[-1][1](spark, docs, sf).count() == 0


def test_stages_keep_columns_of_any_name(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").where("doc_id < 60")
    names = ["score", "lang_pred", "bits_per_byte", "which", "mark", "h", "n", "bucket", "item_id", "tokens", "held_out", "component_id", "n_shingles", "least", "a.b"]
    wide = docs
    for k, name in enumerate(names):
        wide = wide.withColumn(name, F.lit(k))
    wide = wide.unionByName(wide.where("doc_id < 3"))
    for _, stage in pipeline.STAGES[:-1]:
        docs, wide = pipeline.stored(stage(spark, docs, sf), "plain"), pipeline.stored(stage(spark, wide, sf), "wide")
        assert wide.columns[-len(names) :] == names and {tuple(r)[-len(names) :] for r in wide.collect()} == {tuple(range(len(names)))}
        assert rows_of(wide) == rows_of(docs)
    assert pipeline.STAGES[-1][1](spark, wide, sf).count() > 0


def test_masks_of_removed():
    masks = texts_of({1: "a" * 60, 2: "a" * 60 + "b"})
    assert not masks[1].any() and np.flatnonzero(~masks[2]).tolist() == [60]


def python_passes(df):
    """The most Python passes that a task of df's last stages has, one in another."""
    most = here = 0
    for line in df._jdf.queryExecution().executedPlan().toString().split("\n"):
        if re.search(r"(?<!Broadcast)Exchange", line):
            here = 0
        here += bool(re.search(r"InArrow|InPandas|EvalPython", line))
        most = max(most, here)
    return most


def test_a_task_has_one_python_pass(spark, sf):
    from millrace.llm import jaccard, suffix_dedup

    docs = spark.read.parquet(f"{sf}/documents.parquet")
    assert python_passes(pipeline.cut_repeated_passages(spark, docs, sf)) == 1
    assert python_passes(suffix_dedup.remove_repeats(docs)) == 1
    parts = spark.createDataFrame([], "bucket long, docs binary, counts binary, h binary, rank binary")
    assert python_passes(jaccard.shared_sets(parts, pipeline.stored(docs.selectExpr("doc_id", "1L AS n_shingles"), "sizes"))) == 1
