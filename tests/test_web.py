"""The crawl with budgets and page texts against plain Python."""

import random
from collections import deque

from pyspark.sql import functions as F

from millrace.operators import web as W


def plain_crawl(url, pages, links, depth, most, page_chars, total_chars):
    queue, asked, read = deque([(url, 0)]), set(), []
    while queue and len(read) < most:
        at, d = queue.popleft()
        if at in asked:
            continue
        asked.add(at)
        if at in pages:
            read.append((at, d))
            if d < depth:
                queue += [(x, d + 1) for x in links.get(at, [])]
    out, room = [], total_chars
    for n, (at, d) in enumerate(read, 1):
        text = pages[at][:page_chars][:room]
        room -= len(text)
        out.append((n, at, d, text))
    return out


def test_crawl_with_budgets_matches_a_queue(spark):
    rng = random.Random(5)
    for most, depth in ((6, 2), (3, 3), (1, 2), (40, 4)):
        names = [f"u{i}" for i in range(40)]
        pages = {u: u * rng.randrange(1, 9) for u in names if rng.random() < 0.7}
        links = {u: [rng.choice(names) for _ in range(rng.randrange(0, 7))] for u in pages}
        df = spark.createDataFrame([*pages.items(), (None, "x"), ("u0", "zzz")], "url string, text string")
        pages.setdefault("u0", "zzz")
        if len([u for u in pages if u == "u0"]) and pages["u0"] != "zzz":
            pages["u0"] = min(pages["u0"], "zzz")
        rows = [(u, i, x) for u, xs in links.items() for i, x in enumerate(xs)] + [("u1", 99, None)]
        seeds = [(k, u) for k, u in enumerate(names[:12])] + [(0, "u0"), (50, None)]
        got = W.crawl_pages(spark.createDataFrame(seeds, "seed long, url string"), df, spark.createDataFrame(rows, "url string, position int, link string"), depth, most, 9, 30).collect()
        for k, u in enumerate(names[:12]):
            assert sorted((r.number, r.url, r.depth, r.text) for r in got if r.seed == k) == plain_crawl(u, pages, links, depth, most, 9, 30), (k, most)
        assert not [r for r in got if r.seed == 50]


def test_crawl_of_nothing(spark):
    none = spark.createDataFrame([], "seed long, url string")
    assert W.crawl_pages(none, spark.createDataFrame([], "url string, text string"), spark.createDataFrame([], "url string, position int, link string")).collect() == []


def test_entities_and_page_text(spark):
    cases = {
        "a &amp;&lt;b&gt; &apos;&quot;&mdash;&hellip;&nbsp;x": "a &<b> '\"—… x", "&#65;&#x42;&#X43; &#8212; &#x1F600;": "ABC — 😀", "&bogus; &; & &#; &#x; &#55296; &#1114112;": "&bogus; &; & &#; &#x; &#55296; &#1114112;",
        "AT&T; no &toolongname; end&": "AT&T; no &toolongname; end&", "": "", "é&eacute;": "é&eacute;",
    }
    got = spark.createDataFrame([(k,) for k in cases], "t string").select("t", W.decoded(F.col("t")).alias("d")).collect()
    assert {r.t: r.d for r in got} == cases
    page = "<html><head><title>no</title></head><body><!-- no --><script>no()</script><p>One&nbsp;<b>two</b></p>\n<style>no</style>three &amp; four"
    assert spark.createDataFrame([(page,)], "t string").select(W.page_text(F.col("t")).alias("x")).first().x == "One two three & four"
