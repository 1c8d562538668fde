"""Markdown cleaning, sections and answer scoring on small texts."""

from pyspark.sql import functions as F

from millrace.functions import answers as A
from millrace.functions import markdown as M
from millrace.operators import answers as score


def one(spark, value, of):
    return spark.createDataFrame([(value,)], "t string").select(of(F.col("t")).alias("x")).first()["x"]


def test_front_matter(spark):
    closed, open_ = '---\ntitle: "A title"\nx: 1\n---\nBody\n', "---\ntitle: T\nno end"
    assert one(spark, closed, M.front_matter_title) == "A title" and one(spark, closed, M.strip_front_matter) == "Body\n"
    assert one(spark, open_, M.front_matter_title) == "T" and one(spark, open_, M.strip_front_matter) == open_
    assert one(spark, "text\n---\n", M.front_matter_title) is None and one(spark, "---\n---\nx", M.strip_front_matter) == "x"


def test_lines_of_markdown(spark):
    assert one(spark, "a {{< x >}} b {{ open", M.strip_shortcodes) == "a " + " " * 9 + " b"
    assert one(spark, "Vec<i32> <b>bold</b><br/>next</p> a &lt; b &amp;lt; <open", M.strip_html) == "Vec<i32> bold next  a < b < <open"
    assert one(spark, "## Head {#id-1}\ntext {#no}", M.strip_anchors) == "## Head\ntext {#no}"
    assert one(spark, "a\n\n \n\nb\n", M.collapse_blank_lines) == "a\n\nb"


def test_clean(spark):
    text = "---\ntitle: Page\n---\nOne\nline [Raw][raw]\n\n[raw]: #raw\n- item\n  goes on\n```\nkeep[a][b]\n\n\nx\n```\n<!-- gone\n -->End"
    assert one(spark, text, M.clean) == "# Page\n\nOne line Raw\n\n- item goes on\n```\nkeep[a][b]\n\nx\n```\nEnd"
    assert one(spark, None, M.clean) is None and one(spark, "", M.clean) == ""


def test_sections(spark):
    chapter = "# 2. Queues\n\nFirst.\n\n## 2.1 Rings\n\nRound.\n\n```sh\n# no heading\n```\n\n## End\n\n## Last\nDone.\n"
    df = spark.createDataFrame([(chapter, "src/ch02-queues.md"), ("plain", "src/my_file-name.md"), ("## Only", "x.md")], "t string, o string")
    rows = df.withColumn("title", M.chapter_title(F.col("t"), F.col("o"))).withColumn("s", M.sections("t", "title")).collect()
    assert [r.title for r in rows] == ["Queues", "my file name", "Only"]
    assert [(s.heading, s.body) for s in rows[0].s] == [("Queues", "First."), ("Rings", "Round.\n\n```sh\n# no heading\n```"), ("Last", "Done.")]
    long = "# B\n\n## L\n\nIntro.\n\n### One\n\n" + "word " * 3000 + "\n\n### Two\n\n" + "word " * 3000
    got = spark.createDataFrame([(long, "B")], "t string, c string").select(M.sections("t", "c").alias("s")).first()["s"]
    assert [s.heading for s in got] == ["L", "One", "Two"]


def test_header_comment(spark):
    rows = [("//! Top.\n//!\n//! More.\nuse x;\n", "a/b.rs"), ("#!/bin/sh\n\n# Title\nx = 1\n", "p.py"), ("fn x() {}", "n.rs"), ("text", "t.txt")]
    got = spark.createDataFrame(rows, "s string, p string").select(M.code_example(F.col("s"), F.col("p")).alias("e")).collect()
    assert got[0].e.instruction == "Write a Rust program for this:\n\nTop.\n\nMore." and got[0].e.response.endswith("use x;\n```")
    assert got[1].e.instruction.endswith("Title") and got[2].e is None and got[3].e is None
    kinds = spark.createDataFrame([(p,) for p in ("a/x.md", "README.md", "a/out/x.md", ".git/x.md", "m.rs", "m.txt")], "p string").select(M.path_kind(F.col("p")).alias("k")).collect()
    assert [r.k for r in kinds] == ["chapter", "notes", "ignored", "ignored", "code", "ignored"]


def test_fenced_blocks(spark):
    text = "x\n```rust\nfn a() {}\n```\n~~~\nplain\n~~~\n```\nlet y = 1;"
    got = one(spark, text, M.fenced_blocks)
    assert [(b.language, b.code, b.line) for b in got] == [("rust", "fn a() {}\n", 3), ("", "plain\n", 6), ("", "let y = 1;", 9)]
    assert len(one(spark, text, M.rust_blocks)) == 2


def test_slop_places_are_bytes_without_overlap():
    got = A.slop_of("é Great question! `great question` It's not just fast, it's worth noting — and — so. No pain. No gain.")
    assert [(h["category"], h["text"], h["start"]) for h in got["hits"]] == [("flattery_filler_opener", "Great question", 3), ("rhythm_trick", "It's not just fast, it's", 36), ("rhythm_trick", "No pain. No gain.", 90)]
    assert got["em_dashes"] == 2


def rules_of(spark, *codes):
    """Verdicts and violations of each code, by the token table."""
    from millrace.operators.code import code_rules

    rows = spark.createDataFrame([(i, 0, c) for i, c in enumerate(codes)], "id long, block int, code string")
    return [r.asDict(True) for r in code_rules(rows).orderBy("id").collect()]


def test_code_rules(spark):
    bad = "use x;\npub fn a() -> Result<u8, String> {\n    // why\n    for i in 0..v.len() { v[i]; }\n    b().unwrap()\n}\n"
    good = '/// Doc.\npub fn a() -> u8 {\n    let s = "// no .unwrap()";\n    for x in s.chars() {}\n    1\n}\n'
    got, fine, broken = rules_of(spark, bad, good, "fn a( {")
    assert got["parsed"] and set(got["verdicts"].values()) == {"fail"} and {v["line"] for v in got["violations"]} == {2, 3, 4, 5}
    assert fine["verdicts"] == {"no_unwrap": "pass", "error_enum": "n/a", "pub_docs": "pass", "no_body_comments": "pass", "no_index_loops": "pass"}
    assert not broken["parsed"] and set(broken["verdicts"].values()) == {"n/a"} and broken["violations"] == []


def failing(found):
    return {r for r, v in found["verdicts"].items() if v == "fail"}


def test_calls_that_may_panic(spark):
    cases = {
        "fn a() { b.unwrap(); }": True, "fn a() { b\n // c\n .unwrap ( ); }": True, "fn a() { b.unwrap_or(1); b.unwrap(1); }": False, "fn a() { b.expect(\"x\"); }": True, "fn a() { b.expect(\"x\", 2); b.expect(); }": False,
        "fn a() { b.expect(f(1, 2),); }": True, "fn a() { assert_eq!(b.unwrap(), 1); }": True, 'fn a() { let s = "x.unwrap()"; /* y.unwrap() */ let r = r#"z".unwrap()"#; }': False, "fn a() { unwrap(); Some(1)::unwrap(); }": False,
    }
    for (code, want), got in zip(cases.items(), rules_of(spark, *cases)):
        assert ("no_unwrap" in failing(got)) == want and got["parsed"], code


def test_loops_over_indices(spark):
    cases = {
        "fn a() { for i in 0..n { f(i); } for j in q { v[i]; } }": False, "fn a() { for i in 0..n { v[i]; } }": True, "fn a() { for i in 0..n { v[w[i + 1]]; } }": True, "fn a() { for i in (0..n).rev() { v[i]; } }": True,
        "fn a() { for i in 0..v.len() {} }": True, "fn a() { for _ in 0..v.len() {} }": True, "fn a() { for i in 0..v.len() - 1 {} }": False, "fn a() { for i in (0..=v.len()).step_by(2) {} }": True, "fn a() { for i in v.iter() { w[i]; } }": False,
        "fn a() { for i in 0..n { v[x.i]; v[i::Z]; vec![i]; } }": False, "fn a() { for mut i in 0..n { v[i]; } }": True, "fn a() { for i in 0..n { for i in 0..m { v[i]; } } }": True, "fn a() { for x in &v[..] { w[x]; } }": False,
        "impl<T> A for B where for<'a> T: C<'a> {}": False, "fn a() { for i in 0..n { println!(\"{}\", v[i]); } }": True, "fn a() { for i in 0..n { } v[i]; }": False, "fn a() { for (i, x) in 0..n { v[i]; } }": False,
    }
    for (code, want), got in zip(cases.items(), rules_of(spark, *cases)):
        assert ("no_index_loops" in failing(got)) == want and got["parsed"], code


def test_error_types(spark):
    full = "#[derive(Debug)]\nenum E { A }\nimpl std::fmt::Display for E {}\nimpl std::error::Error for E {}\n"
    cases = {
        "fn a() -> Result<u8, crate::AppError> { b() }": ("pass", 0), "fn a() -> Result<u8, String> { b() }": ("fail", 1), "fn a() -> Result<u8, &'static str> { b() }": ("fail", 1), "fn a() -> Result<Vec<(u8, u8)>, Box<dyn std::error::Error + Send>> { b() }": ("fail", 1),
        "fn a() -> std::io::Result<u8> { b() }": ("fail", 1), "fn a() -> Result<u8, io::Error> { b() }": ("fail", 1), "fn a() -> fmt::Result { b() }": ("n/a", 0), "fn a() -> u8 { 1 }": ("n/a", 0), full + "fn a() -> Result<u8, E> { b() }": ("pass", 0),
        "enum E { A }\nfn a() -> Result<u8, E> { b() }": ("fail", 1), "enum E { A }\nimpl fmt::Display for E {}\nfn a() -> Result<u8, E> {}": ("fail", 1), "#[derive(Debug, thiserror::Error)]\npub(crate) enum E { A }\nfn a() -> Result<u8, E> {}": ("pass", 0),
        "#[derive(Error)]\nstruct E;\nfn a() -> Result<u8, E> {}": ("fail", 2), "type Result<T> = std::result::Result<T, String>;\nfn a() -> Result<u8> { b() }": ("fail", 1), "type R<T> = Result<T, E>;\nfn a() -> R<u8> {}": ("n/a", 0),
        full + "type Result<T> = std::result::Result<T, E>;\nfn a() -> Result<u8> { b() }": ("pass", 0), "use std::error::Error as StdError;\nenum E { A }\nimpl fmt::Display for E {}\nimpl StdError for E {}\nfn a() -> Result<u8, E> {}": ("pass", 0),
        "impl Iterator for X { fn next() -> Result<u8, String> { b() } }": ("n/a", 0), "impl X { fn next() -> Result<u8, String> { b() } }": ("fail", 1), "trait X { fn next() -> Result<u8, String>; }": ("fail", 1), "use anyhow::Result;\nfn a() {}": ("pass", 0),
        "fn a() { bail!(\"x\") }": ("pass", 0), "fn a() -> Result<u8, String> {}\nfn b() -> Result<u8, String> {}": ("fail", 1), "impl X for Y { type Error = Result<u8, String>; }": ("n/a", 0), "fn a() -> Result<u8, String> where T: Fn() -> u8 {}": ("fail", 1),
        "fn a() -> Result<u8, <T as X>::E> {}": ("pass", 0), "struct S;\nfn a() -> Result<u8, S> {}": ("fail", 1),
    }
    for (code, (verdict, n)), got in zip(cases.items(), rules_of(spark, *cases)):
        assert got["verdicts"]["error_enum"] == verdict and len([v for v in got["violations"] if v["rule"] == "error_enum"]) == n and got["parsed"], (code, got)


def test_comments_and_docs(spark):
    cases = {
        "fn a() {\n /* x /* y */ z */ b() }": {"no_body_comments"}, "// top\nfn a() { b() } // after": set(), "/// doc\npub fn a() { /// inner doc\n b() }": set(), "fn a() { let c = '\"'; let d = '/'; \"// no\"; r##\"/* no \"# \"##; }": set(),
        "struct A { /* field */ b: u8 }": set(), "let x = 1; // a fragment\nfn a() { /* in a fragment */ }": set(), "pub fn a();": {"pub_docs"}, "/// d\n#[inline]\n#[must_use]\npub const fn a() {}": set(), "/** d */\npub struct A;": set(), "//// no\npub struct A;": {"pub_docs"},
        "#[doc = \"d\"]\npub enum A {}": set(), "pub(crate) fn a() {}": set(), "pub use a::b;": set(), "pub mod a;": set(), "pub mod a { }": {"pub_docs"}, "/// d\npub struct A { pub b: u8 }\nimpl A { pub fn c() {} }": {"pub_docs"}, "pub async unsafe fn a() {}": {"pub_docs"}, "/// d\nfn a() {}\npub fn b() {}": {"pub_docs"},
    }
    for (code, want), got in zip(cases.items(), rules_of(spark, *cases)):
        assert failing(got) == want and got["parsed"], (code, got)


def test_hostile_and_odd_code(spark):
    import time

    start = time.time()
    codes = ["fn a(x " * 8_000, "pub fn a() {}\n" * 8_000, "for x in a..b {}\n" * 8_000, "fn f() { for i in 0..n { v[i]; } }\n" * 3_000, "r#\"" * 20_000, "/*" * 20_000, "{[(" * 20_000, "\"\\", "", None, "é ñ 漢", "// only", "fn f() { // x\n" * 5_000 + "}" * 5_000]
    got = rules_of(spark, *codes)
    assert [g["parsed"] for g in got] == [False, True, True, True, False, False, False, False, True, True, True, True, True]
    assert len(got[3]["violations"]) == 3_000 and len(got[1]["violations"]) == 8_000 and time.time() - start < 90
    assert rules_of(spark) == []


def test_scores_and_summary(spark):
    rows = [(1, "Plain words."), (2, "It adheres to the rules.\n```rust\nfn a() { b().unwrap(); }\n```"), (3, "Great question! Done."), (4, None)]
    scored = score.score(spark.createDataFrame(rows, "id int, text string"))
    by = {r.id: r for r in scored.collect()}
    assert by[1].all_rules is None and by[2].all_rules is False and by[2].rules["no_unwrap"] == "fail" and len(by[2].false_claims) == 1
    total = score.summary(scored)
    r = total.first()
    assert (r.answers, r.with_code, r.blocks, r.clean_prose, r.slop_hits, r.false_claims, r.no_unwrap_applied, r.hits_flattery_filler_opener) == (4, 1, 1, 3, 1, 1, 1, 1)
    cells = score.rates(total, "run").first()
    assert (cells.n, cells.no_unwrap, cells.false_claims) == ("4", "0% of 1", "25%")


def test_long_runs_do_not_overflow(spark):
    many = "\n" * 50_000 + "# h\n" * 20_000 + "text"
    got = spark.createDataFrame([(many, "x.py")], "t string, p string").select(F.length(M.clean(F.col("t"))).alias("n"), M.header_comment(F.col("t"), "#").alias("h")).first()
    assert got.n == 1 + len("# h\n" * 20_000 + "text") and got.h.startswith("h\nh")
