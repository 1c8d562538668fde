"""Web page and generic join queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import curate as C
from millrace.operators import web as W

from .registry import query, table

_TITLE = r"""trim(regexp_replace(replace(replace(replace(replace(replace(replace(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&nbsp;', ' '), '&amp;', '&'), '\s+', ' ', 'g'))"""


@query(f"SELECT page_id, CASE WHEN t <> '' THEN substr(t, 1, 200) END AS title FROM (SELECT page_id, {_TITLE} AS t FROM pages)")
def web_titles(spark, sf):
    return table(spark, sf, "pages").select("page_id", W.title(F.col("html")).alias("title"))


@query(r"SELECT lower(regexp_extract(url, '^[a-zA-Z]+://([^/:?#]+)', 1)) AS host, count(*) AS n FROM pages GROUP BY 1")
def web_hosts(spark, sf):
    return table(spark, sf, "pages").groupBy(W.host(F.col("url")).alias("host")).agg(F.count(F.lit(1)).alias("n"))


@query(r"""WITH h AS (SELECT page_id, regexp_extract(url, '^([a-zA-Z]+://[^/?#]+)', 1) AS root, regexp_extract_all(html, '(?i)<a\s[^>]*href="([^"]*)"', 1) AS a FROM pages),
e AS (SELECT page_id, root, unnest(a) AS href, generate_subscripts(a, 1) AS pos FROM h), l AS (SELECT page_id, root || regexp_replace(href, '#.*$', '') AS link, min(pos) AS pos FROM e WHERE starts_with(href, '/') AND NOT starts_with(href, '//') AND NOT regexp_matches(href, '^/(login|signup|uas/|account|help|legal)') GROUP BY 1, 2)
SELECT page_id, CAST(row_number() OVER (PARTITION BY page_id ORDER BY pos) - 1 AS INT) AS position, link FROM l QUALIFY position < 24""")
def web_links(spark, sf):
    return W.links(table(spark, sf, "pages"))


@query("""WITH RECURSIVE e AS (SELECT DISTINCT o_custkey AS src, (o_custkey * 7 + o_orderkey % 5) % 1500 AS dst FROM orders), b AS (SELECT 1 AS node, 0 AS depth UNION SELECT e.dst, b.depth + 1 FROM b JOIN e ON b.node = e.src WHERE b.depth < 2)
SELECT CAST(node AS BIGINT) AS node, min(depth) AS depth FROM b GROUP BY node""")
def web_crawl(spark, sf):
    """Breadth-first levels over a table of links (here: customers linked by their orders), each node once."""
    edges = table(spark, sf, "orders").select(F.col("o_custkey").alias("src"), ((F.col("o_custkey") * 7 + F.col("o_orderkey") % 5) % 1500).alias("dst")).distinct()
    return W.crawl(edges, spark.createDataFrame([(1,)], "node long"), 2)


@query(r"""WITH h AS (SELECT page_id, html, regexp_extract_all(html, '(?i)<a\s[^>]*href="([^"]*)"', 1) AS a FROM pages), e AS (SELECT page_id, unnest(a) AS href, generate_subscripts(a, 1) AS pos FROM h),
f AS (SELECT page_id, 'https://h.example' || regexp_replace(href, '#.*$', '') AS link, min(pos) AS pos FROM e WHERE starts_with(href, '/') AND NOT starts_with(href, '//') AND NOT regexp_matches(href, '^/(login|signup|uas/|account|help|legal)') GROUP BY 1, 2),
l AS (SELECT page_id, link, row_number() OVER (PARTITION BY page_id ORDER BY pos) AS position FROM f QUALIFY position <= 24),
p AS (SELECT 'https://h.example' || regexp_replace(a[1], '#.*$', '') AS url, min(page_id) AS page_id FROM h WHERE starts_with(a[1], '/') AND NOT starts_with(a[1], '//') GROUP BY 1), k AS (SELECT url, position, link FROM p JOIN l USING (page_id)),
c1 AS (SELECT page_id AS seed, link AS url, min(position) AS o FROM p JOIN k USING (url) WHERE link <> p.url GROUP BY 1, 2), r1 AS (SELECT seed, url, row_number() OVER (PARTITION BY seed ORDER BY o) + 1 AS number FROM c1 JOIN p USING (url) QUALIFY number <= 6),
c2 AS (SELECT seed, link AS url, min(number * 100 + position) AS o FROM r1 JOIN k USING (url) GROUP BY 1, 2),
r2 AS (SELECT c2.seed, c2.url, m.n + row_number() OVER (PARTITION BY c2.seed ORDER BY c2.o) + 1 AS number FROM c2 JOIN p ON p.url = c2.url JOIN (SELECT seed, count(*) AS n FROM r1 GROUP BY seed) m ON m.seed = c2.seed
  WHERE NOT EXISTS (SELECT 1 FROM c1 WHERE c1.seed = c2.seed AND c1.url = c2.url) AND c2.url <> (SELECT url FROM p q WHERE q.page_id = c2.seed) QUALIFY number <= 6),
r AS (SELECT page_id AS seed, url, 1 AS number, 0 AS depth FROM p UNION ALL SELECT seed, url, number, 1 FROM r1 UNION ALL SELECT seed, url, number, 2 FROM r2),
t AS (SELECT r.*, substr(html, 1, 1500) AS t FROM r JOIN p USING (url) JOIN h USING (page_id)), b AS (SELECT *, coalesce(sum(length(t)) OVER (PARTITION BY seed ORDER BY number ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM t)
SELECT seed, CAST(number AS INT) AS number, url, depth, md5(substr(t, 1, CAST(greatest(0, 5000 - before) AS INT))) AS text_md5 FROM b""")
def web_crawl_budget(spark, sf):
    """A crawl from every page over the pages' own links, all on one host: a page's address is that of its first link. The budgets are
    small enough to bite."""
    pages = table(spark, sf, "pages").withColumn("first", F.get(W.hrefs(F.col("html")), F.lit(0))).where(F.startswith("first", F.lit("/")) & ~F.startswith("first", F.lit("//")))
    pages = pages.withColumn("url", F.concat(F.lit("https://h.example"), F.regexp_replace("first", "#.*$", "")))
    pages = pages.groupBy("url").agg(F.min_by("html", "page_id").alias("html"), F.min("page_id").alias("page_id"))
    links = W.links(pages).join(pages.select("page_id", "url"), "page_id").select("url", "position", "link")
    out = W.crawl_pages(pages.select(F.col("page_id").alias("seed"), "url"), pages.select("url", F.col("html").alias("text")), links, page_chars=1_500, total_chars=5_000)
    return out.select("seed", "number", "url", "depth", F.md5("text").alias("text_md5"))


@query(r"""SELECT page_id, md5(replace(replace(replace(replace(t, '&lt;', '<'), '&#x' || 'E9;', 'é'), '&#8212;', '—'), '&amp;', '&')) AS text_md5 FROM (SELECT page_id, replace(url, '&', '&amp;') || ' &lt; &#xE9; &#8212; &bogus; &#99999999; &' AS t FROM pages)""")
def web_entities(spark, sf):
    """Addresses written with entities, named, in both numeric forms, unknown and unfinished."""
    rows = table(spark, sf, "pages").withColumn("t", F.concat(F.replace("url", F.lit("&"), F.lit("&amp;")), F.lit(" &lt; &#xE9; &#8212; &bogus; &#99999999; &")))
    return rows.select("page_id", F.md5(W.decoded(F.col("t"))).alias("text_md5"))


@query("""SELECT n_name AS nation, count(*) AS orders, round(sum(o_totalprice), 2) AS total FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name""")
def join_orders_by_nation(spark, sf):
    orders = table(spark, sf, "orders").select("o_custkey", "o_totalprice")
    who = table(spark, sf, "customer").select("c_custkey", "c_nationkey").join(F.broadcast(table(spark, sf, "nation").select("n_nationkey", "n_name")), F.col("c_nationkey") == F.col("n_nationkey"))
    return orders.join(who, F.col("o_custkey") == F.col("c_custkey")).groupBy(F.col("n_name").alias("nation")).agg(F.count(F.lit(1)).alias("orders"), F.round(F.sum("o_totalprice"), 2).alias("total"))


@query("SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)")
def join_customers_without_orders(spark, sf):
    return table(spark, sf, "customer").select("c_custkey").join(table(spark, sf, "orders").select("o_custkey"), F.col("c_custkey") == F.col("o_custkey"), "left_anti")


@query("""SELECT l_returnflag, l_linestatus, CAST(count(*) FILTER (WHERE l_discount > 0.05) AS BIGINT) AS discounted, round(sum(l_quantity), 2) AS quantity FROM lineitem GROUP BY 1, 2""")
def agg_conditional_sums(spark, sf):
    return table(spark, sf, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(F.count_if(F.col("l_discount") > 0.05).alias("discounted"), F.round(F.sum("l_quantity"), 2).alias("quantity"))


@query("""SELECT c_mktsegment, c_custkey, CAST(rank AS INT) AS rank FROM (SELECT c_mktsegment, c_custkey, row_number() OVER (PARTITION BY c_mktsegment ORDER BY c_acctbal DESC, c_custkey) AS rank FROM customer) WHERE rank <= 3""")
def window_top_customers(spark, sf):
    return C.first_per_group(table(spark, sf, "customer").select("c_mktsegment", "c_custkey", "c_acctbal"), "c_mktsegment", [F.desc("c_acctbal"), "c_custkey"], 3).drop("c_acctbal")


_REDIRECTS = [("https://h.org/a", "/b"), ("https://h.org/b", "c/../d"), ("https://h.org/l", "/l"), ("https://h.org/x", " "), ("https://h.org/p/q", "../r?s=1")]


@query("SELECT * FROM (VALUES ('https://h.org/a', 'https://h.org/d'), ('https://h.org/b', 'https://h.org/d'), ('https://h.org/l', NULL), ('https://h.org/x', 'https://h.org/x'), ('https://h.org/p/q', 'https://h.org/r?s=1'), ('https://h.org/z', 'https://h.org/z')) v(url, final)")
def web_redirects(spark, sf):
    """Where addresses lead; a loop leads nowhere. The SQL states the expected rows."""
    hops = spark.createDataFrame(_REDIRECTS, "url string, location string")
    return W.final_addresses(hops.select("url").union(spark.createDataFrame([("https://h.org/z",)], "url string")), hops)


_HOSTS = [("a.org", "a.org"), ("www.a.org", "a.org"), ("a.org", "www.a.org"), ("ba.org", "a.org"), ("a.org", "b.org")]


@query("""SELECT one, other, one = other OR ends_with(one, '.' || other) OR ends_with(other, '.' || one) AS same FROM (VALUES ('a.org','a.org'),('www.a.org','a.org'),('a.org','www.a.org'),('ba.org','a.org'),('a.org','b.org')) v(one, other)""")
def web_same_site(spark, sf):
    return spark.createDataFrame(_HOSTS, "one string, other string").withColumn("same", W.same_site(F.col("one"), F.col("other")))
