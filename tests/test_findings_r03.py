"""Queries on rows of their own against their SQL, one test a finding of round 3."""

import duckdb
import pyarrow as pa

from millrace.functions import markdown as M
from millrace.plans import ORACLE_SQL, QUERIES


def against_sql(spark, tmp_path, name, **tables):
    """The query's rows, after comparing them with its SQL over the given tables (rows and schema of each)."""
    con = duckdb.connect()
    for t, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{t}.parquet")
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{tmp_path}/{t}.parquet/*.parquet'")
    got = QUERIES[name](spark, str(tmp_path))
    rel = con.execute(ORACLE_SQL[name])
    columns = [d[0] for d in rel.description]
    rows = sorted((tuple(r) for r in got.select(*(f"`{c}`" for c in columns)).collect()), key=str)
    assert rows == sorted(rel.fetchall(), key=str)
    return rows


def test_sizes_in_words_round_by_exact_values(spark, tmp_path):
    prices = [500.0 + 1000 * k for k in range(60)] + [0.0, -11500.0, 1e30, float("inf"), float("nan"), None]
    rows = against_sql(spark, tmp_path, "models_words", orders=(list(enumerate(prices, 1)), "o_orderkey long, o_totalprice double"))
    words = {r[0]: r[1] for r in rows}
    assert [words[k] for k in (2, 3, 4, 8, 12, 13)] == ["0.1 GB", "0.2 GB", "0.3 GB", "0.8 GB", "1.1 GB", "1.2 GB"] and words[66] is None


def test_slop_with_words_of_other_scripts(spark, tmp_path):
    texts = ["no ciónrrarque. No pain. No gain.", "no één. No pain.", "édelve into égreat question", "Not because of it.\u00a0Because so. Yes.\u2003Sure.\u2003Fine.", "éYes. Sure. Fine.", "it's\u00a0not just this, it's that", "No\x0bpain. No gain.", None, ""]
    rows = against_sql(spark, tmp_path, "score_slop", documents=([(k * 5 + 6, t) for k, t in enumerate(texts)], "doc_id long, text string"))
    assert (6, "rhythm_trick", "No pain. No gain.", 17) in rows


def test_token_cap_is_that_of_builds(spark, tmp_path):
    texts = [("a", k, f"a{k} " + "x" * 1996) for k in range(30)] + [("b", 40, "b" * 900_000), ("b", 41, "c" * 900_000), ("b", 42, "d" * 600_000), ("b", 43, "e" * 120_000), ("b", 44, "f" * 80_000)]
    rows = against_sql(spark, tmp_path, "curate_token_cap", documents=([(i, t, s) for s, i, t in texts], "doc_id long, text string, source string"))
    assert [i for s, i in rows if s == "a"] == sorted(range(30), key=lambda i: str(("a", i))) and [i for s, i in rows if s == "b"] == [40, 42, 44]


def test_sections_of_whole_documents(spark, tmp_path):
    long = "word " * 1500
    texts = ["Text\n# 3.1 One\r\nA `b` ~ #c\n## \nno name\n### Three\nshort", f"x\n### 1: A\n{long}\n```\n### code\n```\n### B \n{long}\n## Tail\n### C\ny", "a\n ~~~\n# in code\n~~~ x\n#no\n # no\n# src\nsame", "```\n# never closed", "\x0b \n\n", "", None]
    documents = [(k, t, f"src{k}" if k < 6 else None) for k, t in enumerate(texts)] + [(8, "# src\nbody", " src")]
    rows = against_sql(spark, tmp_path, "md_sections", documents=(documents, "doc_id long, text string, source string"))
    assert [sorted(r[2] for r in rows if r[0] == k) for k in (0, 1, 8)] == [["", "One", "Part 0", "src0"], ["A", "B", "Part 1", "Tail", "src1"], ["src", "src"]]


def test_prose_is_tidied_in_parts_of_a_batch(monkeypatch):
    texts = ["A line\nthat goes on [x][y]\n\n```\ncode [a][b]\n```\n" * 40, None, "", "[a]: b\n- item\n  more"] * 2_000
    seen, table = [], M._line_table
    monkeypatch.setattr(M, "_line_table", lambda data, off: seen.append(len(data)) or table(data, off))
    got = M.tidy_prose.func(pa.array(texts, pa.string())).to_pylist()
    assert sum(seen) == sum(len(t or "") for t in texts) and max(seen) <= 1 << 20
    assert got[1:4] == [None, "", "- item more"] and got[0].startswith("A line that goes on x\n\n```\ncode [a][b]\n```\nA line") and got == got[:4] * 2_000


def test_slop_with_code_and_letters_as_its_sql_reads_them(spark, tmp_path):
    texts = [
        "~~~\ngreat question\n~~~\n", "```rust\ngreat question", "a ``` great question ``` delve into", "``great question`` ```\n`delve into", "no `x` pain.", "No pain.```\n``` No gain.", "it's not just `aéb`, it's",
        "becauseſpoiler: ſpoiler:", "hope thiſ helpſ hope thiſ helpſa", "that'ſ not just this, it's", "it's not just this, ıt's that, it's", "it is not only a; İt's; but", "no noı. no no.", None,
    ]
    rows = against_sql(spark, tmp_path, "score_slop", documents=([(k * 5 + 6, t) for k, t in enumerate(texts)], "doc_id long, text string"))
    assert (6, "flattery_filler_opener", "great question", 4) in rows and (36, "rhythm_trick", "it's not just       , it's", 0) in rows


def test_slop_with_letters_that_case_folds_into_words(spark, tmp_path):
    texts = ["no aſb. no x.", "No K9. no ſſ.", "no é. no x.", "aſno b. no c."]
    rows = against_sql(spark, tmp_path, "score_slop", documents=([(k * 5 + 6, t) for k, t in enumerate(texts)], "doc_id long, text string"))
    assert (6, "rhythm_trick", "no aſb. no x.", 0) in rows and (11, "rhythm_trick", "No K9. no ſſ.", 0) in rows


def test_slop_of_rows_that_share_a_doc_id(spark, tmp_path):
    texts = [(6, "delve into a testament to it")] * 3 + [(11, "so: the truth is here"), (11, "at the end of the day"), (-4, "so great question"), (-4, "so great question"), (None, "great question"), (1 << 50, None), (1 << 50, None)]
    texts += [(16, "it's worth noting"), (16, "and it's not just this, it's that, hope this helps"), (16, " " * 31 + "great question")]  # a trick that overlaps the first hit hides no later one
    rows = against_sql(spark, tmp_path, "score_slop", documents=(texts, "doc_id long, text string"))
    assert [r[2:] for r in sorted(rows, key=lambda r: r[3]) if r[0] == 6][:2] == [("delve into", 0), ("a testament to", 11)] and sum(r[0] == 6 for r in rows) == 3
    assert (16, "flattery_filler_opener", "great question", 31) in rows and not any(r[1] == "rhythm_trick" and r[0] == 16 for r in rows)


def test_slop_of_a_whole_table(spark):
    sf, con = "/root/testdata/sf0.1", duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    rows = sorted(con.execute(ORACLE_SQL["score_slop"]).fetchall())
    assert sorted(tuple(r) for r in QUERIES["score_slop"](spark, sf).collect()) == rows
    assert (6854, "rhythm_trick", "No pain. No gain.", 5013) in rows  # behind "no ciónrrarque."
