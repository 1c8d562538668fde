"""Growing logs and the sieve of streamed replies."""

import json
import os
import random

import pytest

from millrace.streaming import growing_log, sieve

DAY = 1_700_000_000_000


def line(at, who, **more):
    return json.dumps({"at_ms": at, "who": who, "status": 200, **more}) + "\n"


class Follow:
    """A query over a log, run to what there is each time it is asked."""

    def __init__(self, spark, path, tmp_path, name, **options):
        self.spark, self.path, self.tmp_path, self.name, self.options, self.seen = spark, path, tmp_path, name, options, []

    def new(self):
        lines = growing_log.log_lines(self.spark, str(self.path), **self.options)
        got = []
        q = lines.writeStream.foreachBatch(lambda df, n: got.extend((os.path.basename(r.path), r.at, r.value) for r in df.collect())).option("checkpointLocation", str(self.tmp_path / f"cp-{self.name}")).start()
        try:
            q.processAllAvailable()
        finally:
            q.stop()
        return sorted(got)


def test_only_new_complete_lines_over_restarts_and_rotation(spark, tmp_path):
    path = tmp_path / "requests.jsonl"
    follow = Follow(spark, path, tmp_path, "one")
    assert follow.new() == []  # no file yet
    path.write_text("a\nbb\nhalf")
    assert [x[1:] for x in follow.new()] == [(0, "a"), (2, "bb")]
    assert follow.new() == []
    with path.open("a") as f:
        f.write(" line\r\né ñ\n")
    assert [x[1:] for x in follow.new()] == [(5, "half line"), (16, "é ñ")]
    path.write_text("new\nrest")  # rotated: shorter than what was read
    assert [x[1:] for x in follow.new()] == [(0, "new")]
    path.write_text("")
    assert follow.new() == []
    path.write_text("z\n")
    assert [x[1:] for x in follow.new()] == [(0, "z")]


def test_one_query_goes_on_while_a_log_grows(spark, tmp_path):
    folder = tmp_path / "logs"
    folder.mkdir()
    got = []
    q = growing_log.log_lines(spark, str(folder), splitBytes="7").writeStream.foreachBatch(lambda df, n: got.extend((os.path.basename(r.path), r.value) for r in df.collect())).option("checkpointLocation", str(tmp_path / "cp")).start()
    want = []
    try:
        for k in range(3):
            for name in ("a", "b", ".hidden"):
                with (folder / name).open("a") as f:
                    f.write(f"{name} line {k} {'x' * 11 * k}\n\n")
                if name != ".hidden":
                    want += [(name, f"{name} line {k} {'x' * 11 * k}"), (name, "")]
            q.processAllAvailable()
            assert sorted(got) == sorted(want)
        (folder / "a").write_text("short\n")
        q.processAllAvailable()
        assert sorted(got) == sorted([*want, ("a", "short")])
    finally:
        q.stop()


@pytest.mark.parametrize("split", [1, 3, 10, 1000])
def test_ranges_give_each_line_once(tmp_path, split):
    rng = random.Random(split)
    rows = ["é" * rng.randrange(0, 9) for _ in range(60)]
    (tmp_path / "x").write_text("".join(r + "\n" for r in rows) + "open")
    place = str(tmp_path / "x")
    end = growing_log.complete(place, place, os.path.getsize(place))
    got = [x for at in range(0, end, split) for x in growing_log.lines_of(place, place, at, min(at + split, end))]
    assert [t.decode() for _, t in got] == rows and [a for a, _ in got] == sorted({a for a, _ in got})


def test_records_of_log_lines(spark):
    rows = [line(5, "ada", new_field=[1]).strip(), "not json", "[1]", "7", "{}", ' {"who": "bo"} ', None, '{"at_ms": 1']
    got = growing_log.log_records(spark.createDataFrame([("f", i, r) for i, r in enumerate(rows)], "path string, at long, value string")).orderBy("at").collect()
    assert [(r.at, r.who, r._timestamp) for r in got] == [(0, "ada", 5000), (4, None, 0), (5, "bo", 0)]
    assert [json.loads(r.record) for r in got] == [json.loads(rows[0]) | {"_timestamp": 5000}, {"_timestamp": 0}, {"who": "bo", "_timestamp": 0}]


XML = "<Tool_Call>\n<function=web_search>\n<parameter=query>\nrust jobs\n</parameter>\n<parameter=time>week</parameter>\n</function>\n</tool_call>"
JSON = '<tool_call id=1>{"name": "read", "arguments": {"url": "é"}}</TOOL_CALL>'


def pushed(parts):
    held, is_open, out = "", False, []
    for p in parts:
        held, is_open, more = sieve.sift(held, is_open, p, False)
        out += more
    out += sieve.sift(held, is_open, "", True)[2]
    return "".join(t for t, a in out if a is None), [(t, a) for t, a in out if a is not None]


def test_sieve_gives_the_same_for_every_cut():
    texts = {
        f"Before {XML} between {JSON} after": ("Before  between  after", ["web_search", "read"]), "a < b <tool <tool_cal": ("a < b <tool <tool_cal", []), f"x{XML[:-12]}": ("x", ["web_search"]), "x <tool_call>no call</tool_call> y": ("x  y", []),
        "x <tool_call>never closed": ("x never closed", []), "<tool_call": ("<tool_call", []), '<tool_call>{"name": " "}</tool_call>': ("", []), '<tool_call>{"tool": "t", "args": "raw"}': ("", ["t"]), "": ("", []), "é<TOOL_CALL>{bad</tool_call>ñ": ("éñ", []),
    }
    for text, (shown, names) in texts.items():
        whole = pushed([text])
        assert whole[0] == shown and [n for n, _ in whole[1]] == names, text
        assert pushed(list(text)) == whole
        for i in range(len(text) + 1):
            assert pushed([text[:i], text[i:]]) == whole
    assert json.loads(pushed([XML])[1][0][1]) == {"query": "rust jobs", "time": "week"}


def test_sieve_holds_a_bounded_part(monkeypatch):
    monkeypatch.setattr(sieve, "MAX_HELD", 50)
    monkeypatch.setattr(sieve, "_TAG", sieve.re.compile(r"<tool_call[^>]{0,50}>", sieve.re.I))
    rng = random.Random(3)
    bits = ["<tool_call", ">", "</tool_call>", "x" * 20, "y", "<", '{"name": "n"}', "<function=f>"]
    for _ in range(300):
        text = "".join(rng.choice(bits) for _ in range(rng.randrange(1, 30)))
        whole = pushed([text])
        for step in (1, 3, 17):
            held, is_open, out = "", False, []
            for i in range(0, len(text), step):
                held, is_open, more = sieve.sift(held, is_open, text[i : i + step], False)
                assert len(held) < 50 + 12 + 10 + step
                out += more
            out += sieve.sift(held, is_open, "", True)[2]
            assert ("".join(t for t, a in out if a is None), [(t, a) for t, a in out if a is not None]) == whole, (text, step)


def test_counts_over_chunk_borders():
    raw = '{"usage": {"prompt_tokens" : 120, "completion_tokens":45678}, "x": {"output_tokens": 7}}'
    for step in (1, 2, 5, len(raw)):
        carry, most = "", (0, 0)
        for i in range(0, len(raw), step):
            carry, most = sieve.counted(carry, raw[i : i + step], i + step >= len(raw), most)
        assert most == (120, 45678)


def test_streamed_replies(spark, tmp_path):
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    (tmp_path / "in").mkdir()
    texts = {1: f"Before {XML} between {JSON} after", 2: "plain <tool", 3: f"cut {XML[:40]}"}
    rows = []
    for reply, text in texts.items():
        raw = json.dumps({"completion_tokens": 1000 * reply})
        cuts = [text[i : i + 6] for i in range(0, len(text), 6)]
        rows.append([{"ts": f"2024-01-01 00:00:{k % 60:02d}", "reply": reply, "seq": k, "content": c, "raw": raw[4 * k : 4 * k + 4] if k < len(cuts) - 1 else raw[4 * k :], "ended": k == len(cuts) - 1 and reply != 3} for k, c in enumerate(cuts)])
    q = None
    try:
        stream = spark.readStream.schema("ts timestamp, reply long, seq long, content string, raw string, ended boolean").json(str(tmp_path / "in"))
        q = sieve.sieved(stream).writeStream.format("memory").queryName("sieved").outputMode("append").option("checkpointLocation", str(tmp_path / "cp")).start()
        rows.append([{"ts": "2024-01-02 00:00:00", "reply": 4, "seq": 0, "content": "", "raw": "", "ended": True}])
        for part in range(3):  # a batch holds a third of each reply
            some = [r for chunks in rows for r in chunks[part * len(chunks) // 3 : (part + 1) * len(chunks) // 3]]
            (tmp_path / f"{part}.tmp").write_text("\n".join(json.dumps(r) for r in some))
            os.rename(tmp_path / f"{part}.tmp", tmp_path / "in" / f"{part}.json")
            q.processAllAvailable()
        got = spark.table("sieved").orderBy("reply", "number").collect()
    finally:
        if q:
            q.stop()
        spark.conf.unset("spark.sql.streaming.stateStore.providerClass")
    for reply, text in texts.items():
        mine = [r for r in got if r.reply == reply]
        assert ("".join(r.text for r in mine if r.kind == "text"), [(r.name, r.arguments) for r in mine if r.kind == "call"]) == pushed([text])
        assert [r.number for r in mine] == list(range(len(mine))) and mine[-1].kind == "end" and mine[-1].output_tokens == 1000 * reply
    whole = sieve.sieved_whole(spark.createDataFrame([tuple(r.values()) for c in rows for r in c], "ts string, reply long, seq long, content string, raw string, ended boolean")).orderBy("reply", "number").collect()
    assert {r.reply for r in whole} == {1, 2, 3, 4} and [(r.reply, r.name) for r in whole if r.kind == "call"] == [(r.reply, r.name) for r in got if r.kind == "call"]
