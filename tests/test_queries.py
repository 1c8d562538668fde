"""Every registered query with SQL against DuckDB on the same tables."""

import math
from pathlib import Path

import duckdb
import pytest

from millrace.plans import ORACLE_SQL, QUERIES


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for p in Path(sf).glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    return con


def plain(v):
    if v is None:
        return "null"
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{v:.9g}"
    return str(v)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(name, spark, sf, duck):
    df = QUERIES[name](spark, sf)
    cols = sorted(df.columns)
    got = sorted(tuple(plain(r[c]) for c in cols) for r in df.collect())
    if name not in ORACLE_SQL:
        return
    rel = duck.execute(ORACLE_SQL[name])
    names = [d[0] for d in rel.description]
    assert sorted(names) == cols
    assert got == sorted(tuple(plain(r[names.index(c)]) for c in cols) for r in rel.fetchall())


def test_suggestions_per_rule_report_dashes(spark, tmp_path):
    spark.createDataFrame([(1, "one — two — three"), (2, "one — dash"), (3, "In summary, no — it is — so")], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["rule"]: (r["n"], r["ids"]) for r in QUERIES["review_suggestions_per_rule"](spark, str(tmp_path)).collect()}
    assert got == {"em_dash_habit": (2, 2), "wrap_up_repeat": (1, 1)}


def test_entry_has_stable_columns(spark):
    import __spark_entry__ as e

    assert e.entry(spark).columns == QUERIES["curate_source_report"](spark, "/root/testdata/sf0.001").columns


def test_library_does_not_import_the_llm_subpackage():
    root = Path(__file__).resolve().parent.parent / "millrace"
    for p in root.rglob("*.py"):
        if p.relative_to(root).parts[0] != "llm":
            assert "millrace.llm" not in p.read_text() and "from .llm" not in p.read_text(), p
