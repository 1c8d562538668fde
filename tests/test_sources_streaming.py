"""Readers, writers and the streaming operators on small files."""

import json

import pytest
from pyspark.sql import functions as F

from millrace.functions import text as T
from millrace.sources import readers, sinks
from millrace.streaming import telemetry


def test_jsonl_strict_and_lenient(spark, tmp_path):
    p = tmp_path / "a.jsonl"
    p.write_text('{"id": "1", "instruction": "q"}\n\n{bad\n')
    assert [r.id for r in readers.jsonl(spark, str(p), readers.RECORD, strict=False).collect()] == ["1"]
    with pytest.raises(Exception):
        readers.jsonl(spark, str(p), readers.RECORD).collect()
    assert readers.jsonl(spark, str(tmp_path / "none"), readers.RECORD).count() == 0


def test_jsonl_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("1", "q", None, "s", "o")], readers.RECORD)
    sinks.jsonl(df, str(tmp_path / "out"))
    assert readers.jsonl(spark, str(tmp_path / "out"), readers.RECORD).collect() == df.collect()


def test_chat_export(spark, tmp_path):
    msg = lambda who, *t: {"sender": who, "content": [{"type": k, "text": x} for k, x in t]}
    p = tmp_path / "chat.json"
    p.write_text(json.dumps([{"uuid": "u", "chat_messages": [msg("human", ("text", " a "), ("tool_use", "x")), msg("assistant", ("text", "b"), ("text", "c"))]}]))
    assert [(r.turn, r.role, r.text) for r in readers.chat_export(spark, str(p)).orderBy("turn").collect()] == [(1, "human", "a"), (2, "assistant", "b\n\nc")]


def test_readability_comments_run_to_the_end(spark, tmp_path):
    p = tmp_path / "set.md"
    p.write_text("### Instruction\none\n### Response\ntwo\n---\n<!-- gone -->### Instruction\nthree\n### Response\nfour <!-- open")
    assert [(r.instruction, r.response) for r in readers.readability(spark, str(p)).orderBy("position").collect()] == [("one", "two"), ("three", "four")]


def test_fnv1a(spark):
    def fnv(b):
        h = 0xCBF29CE484222325
        for x in b:
            h = (h ^ x) * 0x100000001B3 % (1 << 64)
        return f"{h:016x}"

    texts = ["", "a", "foobar", "naïve – ok"]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select(T.fnv1a(F.col("t")).alias("h")).collect()
    assert [r.h for r in got] == [fnv(t.encode()) for t in texts]


def test_per_minute_counts_repeats_once(spark, tmp_path):
    rows = [{"at_ms": 60_000 * m + s, "who": "a", "path": "/p"} for m in (1, 2, 40) for s in (1, 2)]
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "1.json").write_text("\n".join(map(json.dumps, rows + rows)))
    q = telemetry.per_minute(telemetry.log_stream(spark, str(tmp_path / "in"))).writeStream.format("memory").queryName("minutes").outputMode("complete").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    assert q.awaitTermination(120)
    assert sorted(r.n for r in spark.table("minutes").collect()) == [2, 2, 2]


DAY = 1_700_000_000_000


def test_limiter_slides(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "1.json").write_text("\n".join(json.dumps({"at_ms": DAY + t, "who": "a"}) for t in (0, 1_000, 2_000, 60_000)))
    q = telemetry.limiter(telemetry.log_stream(spark, str(tmp_path / "in")), 2).writeStream.format("memory").queryName("admitted").outputMode("append").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    assert q.awaitTermination(120)
    assert [(r.at_ms - DAY, r.admitted, r.retry_s) for r in spark.table("admitted").orderBy("at_ms").collect()] == [(0, True, 0), (1000, True, 0), (2000, False, 58), (60000, True, 0)]


def test_limiter_busy_before_spent_and_exempt():
    state = ([], [])
    got = []
    for at, takes in ((0, 5_000), (1_000, 9_000), (2_000, 10), (6_000, 10), (7_000, 10)):
        verdict, retry, *state = telemetry.judged(*state, at, takes, 3, 2)
        got.append((verdict, retry))
    assert got == [("admitted", 0), ("admitted", 0), ("busy", 1), ("admitted", 0), ("spent", 53)]


def test_chat_export_attachments(spark, tmp_path):
    message = {"sender": "human", "content": [{"type": "text", "text": "see"}, {"type": "tool_use"}], "attachments": [{"file_name": "a", "extracted_content": " body "}], "files": [{"file_name": "f.png"}]}
    (tmp_path / "chat.json").write_text(json.dumps([{"uuid": "u", "chat_messages": [message]}]))
    r = readers.chat_export(spark, str(tmp_path / "chat.json")).first()
    assert (r.text, r.hidden, r.files) == ("see\n\nbody", 1, ["f.png"])


def test_question_files_sft_and_runs(spark, tmp_path):
    (tmp_path / "q.txt").write_text("#Question\nWhy?\n#Answer\nSo.\n")
    assert [(r.instruction, r.response) for r in readers.question_files(spark, str(tmp_path / "q.txt")).collect()] == [("Why?", "So.")]
    rows = spark.read.schema(readers.SFT).json(spark.sparkContext.parallelize([json.dumps({"messages": [{"role": "user", "content": "q"}, {"role": "assistant", "content": "a"}], "meta": {"id": "1"}}), json.dumps({"messages": [{"role": "user", "content": "q"}], "meta": {"id": "2"}})]))
    assert {r.id: r.problem for r in readers.sft_records(rows).collect()} == {"1": None, "2": "empty turn"}
    (tmp_path / "run.jsonl").write_text('{"text": "x", "more": 1}\n\n')
    assert [(r.text, r.row) for r in readers.run_records(spark, str(tmp_path / "run.jsonl")).collect()] == [("x", '{"text": "x", "more": 1}')]
    (tmp_path / "bad.jsonl").write_text('{"more": 1}\n')
    with pytest.raises(Exception, match="no field"):
        readers.run_records(spark, str(tmp_path / "bad.jsonl")).collect()


def test_walks(spark, tmp_path):
    for name, body in {"a/book.toml": '[book]\nsrc = "text"', "a/text/one.md": "# One\nx", "a/out/two.md": "y", "a/x.rs": "//! Hi\n" + "x" * 1600, "b/book.toml": "[book]", "a/raw.md": b"\xff\xfe"}.items():
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_bytes(body if isinstance(body, bytes) else body.encode())
    files = readers.whole_files(spark, str(tmp_path))
    assert {r.path for r in files.collect()} == {"a/book.toml", "a/text/one.md", "a/out/two.md", "a/x.rs", "b/book.toml"}
    assert {(r.path, r.kind) for r in readers.book_repository(spark, str(tmp_path)).collect()} == {("a/text/one.md", "chapter"), ("a/x.rs", "code")}
    split = files.select(F.split_part("path", F.lit("/"), F.lit(1)).alias("source"), F.regexp_replace("path", "^[^/]*/", "").alias("path"), "text")
    assert {(r.source, r.folder) for r in readers.book_folders(split).collect()} == {("a", "text"), ("b", "src")}
    manifest = spark.createDataFrame([("a", "code", "mit"), ("b", "code", "mozilla_public")], "source string, kind string, licence string")
    assert [(r.origin, r.language) for r in readers.code_sections(files, manifest).collect()] == [("a/x.rs", "rust")]
    (tmp_path / "t.md").write_text("one\n---\n \n---\ntwo")
    assert [(r.origin, r.entry) for r in readers.teacher_entries(spark, str(tmp_path / "t.md")).orderBy("origin").collect()] == [("t.md#1", "one"), ("t.md#2", "two")]


def test_machine_readings(spark):
    rows = spark.createDataFrame([("h", "MemTotal:  10 kB\nMemAvailable: 4 kB\n", "0.50 1 2 1/2 3", "cpu  1 2 3 4 5 6 7 8 0 0\ncpu0 1")], "host string, meminfo string, loadavg string, stat string")
    r = readers.machine_readings(rows).first()
    assert (r.host, r.memory_total, r.memory_available, r.load, r.busy_ticks, r.total_ticks) == ("h", 10240, 4096, 0.5, 27, 36)


def test_scored_run_flags_and_report(spark, tmp_path):
    from millrace.operators import answers

    (tmp_path / "run.jsonl").write_text('{"text": "Great question!", "n": 1}\n')
    scored = answers.score(readers.run_records(spark, str(tmp_path / "run.jsonl")))
    sinks.scored_run(scored, str(tmp_path / "scored"))
    row = json.loads(spark.read.text(str(tmp_path / "scored")).first()["value"])
    assert row["n"] == 1 and row["score"]["slop"]["hits"][0]["text"] == "Great question"
    sinks.report(answers.rates(answers.summary(scored), "x"), str(tmp_path / "report"))
    assert [r.value for r in spark.read.text(str(tmp_path / "report")).collect()][1].startswith("|---|")
    sinks.flags(spark.createDataFrame([("b", "n"), ("a", "n")], "id string, note string"), str(tmp_path / "flags"))
    assert [r.id for r in spark.read.json(str(tmp_path / "flags")).collect()] == ["a", "b"]


def test_ship_sends_each_batch(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "1.json").write_text(json.dumps({"at_ms": 1, "who": "a"}))
    sent = []
    q = sinks.ship(telemetry.log_stream(spark, str(tmp_path / "in")), lambda df, n: sent.append((n, df.first()["_timestamp"])), str(tmp_path / "cp"), "1 second")
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    assert sent == [(0, 1000)]
