"""Pages: titles, links and a bounded crawl over a table of pages."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions import fixed
from millrace.functions import text as T

from .scratch import kept


def title(html: Column) -> Column:
    """The first title, entities decoded, white space squeezed, at most 200 characters; null if there is none."""
    found = F.regexp_extract(html, r"(?is)<title[^>]*>(.*?)</title>", 1)
    for entity, sign in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&amp;", "&")):
        found = F.replace(found, F.lit(entity), F.lit(sign))
    squeezed = F.trim(F.regexp_replace(found, r"\s+", " "))
    return F.when(squeezed != "", F.substring(squeezed, 1, 200))


_HREF = r"""(?i)<a\b[^>]*?\bhref\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""
#: Most links of a page that are followed, and redirects.
MOST_LINKS, MOST_REDIRECTS = 24, 3


def hrefs(html: Column) -> Column:
    """Targets of a page's links, in double, single or no quotes."""
    each = [F.regexp_extract_all(html, F.lit(_HREF), F.lit(k)) for k in (1, 2, 3)]
    return F.transform(F.arrays_zip(*[x.alias(n) for n, x in zip("abc", each)]), lambda t: F.concat(t["a"], t["b"], t["c"]))


def host(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, r"^[a-zA-Z]+://([^/:?#]+)", 1))


def path_of(url: Column) -> Column:
    found = F.regexp_extract(url, r"^[a-zA-Z]+://[^/?#]*(/[^?#]*)", 1)
    return F.when(found == "", "/").otherwise(found)


def same_site(one: Column, other: Column) -> Column:
    """Equal hosts, or one a part of the other's domain."""
    return (one == other) | F.endswith(one, F.concat(F.lit("."), other)) | F.endswith(other, F.concat(F.lit("."), one))


def is_chrome(url: Column) -> Column:
    """A login wall, sign-up form or another page without content."""
    return reduce(lambda a, b: a | b, [F.startswith(path_of(url), F.lit(p)) for p in fixed.CHROME_PATHS])


def joined_path(path: Column, relative: Column) -> Column:
    """A relative path from a page's folder; `.` and `..` are resolved."""
    folder = F.regexp_replace(F.regexp_replace(path, r"[?#].*$", ""), r"[^/]*$", "")
    parts = F.filter(F.split(F.concat(folder, F.lit("/"), relative), "/"), lambda p: (p != "") & (p != "."))
    kept = F.aggregate(parts, F.array().cast("array<string>"), lambda a, p: F.when(p == "..", F.slice(a, 1, F.greatest(F.size(a) - 1, F.lit(0)))).otherwise(F.concat(a, F.array(p))))
    return F.concat(F.lit("/"), F.array_join(kept, "/"))


def absolute(href: Column, url: Column) -> Column:
    """Absolute address of a link on a page; null for fragments and other schemes."""
    href = F.trim(href)
    root = F.regexp_extract(url, r"^([a-zA-Z]+://[^/?#]+)", 1)
    return (
        F.when(href.rlike(r"(?i)^https?://"), href)
        .when(F.startswith(href, F.lit("//")), F.concat(F.regexp_extract(url, r"^([a-zA-Z]+:)", 1), href))
        .when(F.startswith(href, F.lit("/")), F.concat(root, href))
        .when(href.rlike(r"^[#?]|^[a-zA-Z][a-zA-Z0-9+.-]*:") | (href == ""), None)
        .otherwise(F.concat(root, joined_path(path_of(url), href)))
    )


def links(pages: DataFrame, most: int = MOST_LINKS) -> DataFrame:
    """page_id, position, link: each page's first distinct absolute links on its own site that lead to content, in order."""
    rows = pages.select("page_id", "url", F.posexplode(hrefs(F.col("html"))).alias("at", "href"))
    rows = rows.withColumn("link", F.regexp_replace(absolute(F.col("href"), F.col("url")), "#.*$", ""))
    rows = rows.where(same_site(host(F.col("link")), host(F.col("url"))) & ~is_chrome(F.col("link")))
    first = rows.groupBy("page_id", "link").agg(F.min("at").alias("at"))
    out = first.withColumn("position", F.row_number().over(Window.partitionBy("page_id").orderBy("at")) - 1).where(F.col("position") < most)
    return out.select("page_id", "position", "link")


def final_addresses(starts: DataFrame, redirects: DataFrame, most: int = MOST_REDIRECTS) -> DataFrame:
    """url, final: where each address (url) leads over redirects (url, location), at most `most` of them; null beyond."""
    now = starts.select("url", F.col("url").alias("final"), F.lit(True).alias("moving"))
    hops = redirects.where("trim(location) != ''").select(F.col("url").alias("final"), "location")
    for _ in range(most + 1):
        now = now.join(hops, "final", "left").select("url", F.coalesce(absolute(F.col("location"), F.col("final")), "final").alias("final"), (F.col("moving") & F.col("location").isNotNull()).alias("moving"))
    return now.select("url", F.when(~F.col("moving"), F.col("final")).alias("final"))


def crawl(edges: DataFrame, seeds: DataFrame, depth: int) -> DataFrame:
    """node, depth: breadth-first levels over edges (src, dst) from seeds (node), each node once at its first level."""
    seen = level = kept(seeds.select("node").distinct().withColumn("depth", F.lit(0)), "level")
    for d in range(1, depth + 1):
        level = kept(level.join(edges, level["node"] == edges["src"]).select(F.col("dst").alias("node")).distinct().join(seen, "node", "left_anti").withColumn("depth", F.lit(d)), "level")
        seen = seen.unionByName(level)
    return seen


#: Bounds of a crawl: how deep, how many pages a seed, characters of a page and of all of a seed's pages.
MAX_DEPTH, MAX_PAGES, MAX_PAGE, MAX_TOTAL = 2, 6, 12_000, 24_000
#: Addresses of a round up to which the table of pages stays where it is.
_FEW = 100_000


def crawl_pages(seeds: DataFrame, pages: DataFrame, links: DataFrame, depth: int = MAX_DEPTH, most: int = MAX_PAGES, page_chars: int = MAX_PAGE, total_chars: int = MAX_TOTAL) -> DataFrame:
    """seed, number (from 1, in the order read), url, depth, text of a crawl from each of seeds (seed, url), all seeds side by side.

    Pages (url, text) are read first come, first served: a seed's queue holds addresses with their places; a round takes as many from its
    front as there is room for pages, leaves out what was asked for before, and puts the links (url, position, link) of the pages it found
    behind the rest. An address without a page costs a place in the queue but no room. Of the texts `page_chars` of each and `total_chars`
    of all are given, in order.

    Defined cases: repeated seeds and addresses count once (of a repeated address the smallest text); null addresses lead nowhere; a null
    text is empty; a seed whose address has no page has no rows; an empty table gives no rows."""
    pages = pages.where(F.col("url").isNotNull()).groupBy("url").agg(F.min(F.coalesce("text", F.lit(""))).alias("text"))
    links = links.select("url", "position", "link").where(F.col("link").isNotNull())
    queue = kept(seeds.where(F.col("url").isNotNull()).select("seed", "url", F.lit(1).cast("long").alias("at"), F.lit(0).alias("depth")).distinct(), "queue")
    asked = read = None
    while True:
        waiting = queue if asked is None else queue.join(asked.select("seed", "url"), ["seed", "url"], "left_anti")
        waiting = waiting.groupBy("seed", "url").agg(F.min(F.struct("at", "depth")).alias("q")).select("seed", "url", "q.*")
        if read is None:
            waiting = waiting.withColumn("have", F.lit(0).cast("long"))
        else:
            waiting = waiting.join(read.groupBy("seed").agg(F.count(F.lit(1)).alias("have")), "seed", "left").withColumn("have", F.coalesce("have", F.lit(0)))
        place = F.row_number().over(Window.partitionBy("seed").orderBy("at"))
        batch = kept(waiting.withColumn("place", place).where(F.col("place") <= most - F.col("have")).drop("place"), "batch")
        n = batch.count()
        if not n:
            break
        found = (F.broadcast(batch) if n <= _FEW else batch).join(pages.select("url"), "url")
        number = F.col("have") + F.row_number().over(Window.partitionBy("seed").orderBy("at"))
        got = kept(found.select("seed", "url", "at", "depth", number.alias("number")), "read")
        asked = batch if asked is None else asked.unionByName(batch)
        read = got if read is None else read.unionByName(got)
        ends = queue.groupBy("seed").agg(F.max("at").alias("end"))
        onward = got.where(F.col("depth") < depth)
        more = (F.broadcast(onward) if n <= _FEW else onward).join(links, "url").join(ends, "seed")
        behind = F.col("end") + F.row_number().over(Window.partitionBy("seed").orderBy("at", "position", "link"))
        queue = queue.unionByName(kept(more.select("seed", F.col("link").alias("url"), behind.alias("at"), (F.col("depth") + 1).alias("depth")), "queue"))
    if read is None:
        read = queue.select("seed", "url", "at", "depth", F.lit(0).cast("long").alias("number")).limit(0)
    out = (F.broadcast(read) if read.count() <= _FEW else read).join(pages, "url").withColumn("text", F.substring("text", 1, page_chars))
    before = F.coalesce(F.sum(F.length("text")).over(Window.partitionBy("seed").orderBy("number").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return out.withColumn("text", F.substring("text", F.lit(1), F.greatest(F.lit(0), total_chars - before).cast("int"))).select("seed", F.col("number").cast("int").alias("number"), "url", "depth", "text")


def page_text(html: Column) -> Column:
    """The text of a page: no scripts, styles, heads or comments; tags part words; entities decoded; white space squeezed."""
    bare = F.regexp_replace(html, r"(?is)<!--.*?-->|<(script|style|head)\b.*?</\1\s*>", " ")
    return T.squeeze(decoded(F.regexp_replace(bare, r"<[^>]*>", " ")))


def decoded(text: Column) -> Column:
    """With named and numeric entities (of at most MAX_ENTITY characters between & and ;) as their characters; unknown ones stay."""
    whole = lambda code: F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")

    def one(part: Column, i: Column) -> Column:
        name = F.regexp_extract(part, r"^([^;&\s]{1,%d});" % fixed.MAX_ENTITY, 1)
        number = F.when(name.rlike(r"^#[xX][0-9a-fA-F]{1,8}$"), F.conv(F.substring(name, 3, 8), 16, 10).cast("long")).when(name.rlike(r"^#[0-9]{1,9}$"), F.substring(name, 2, 9).cast("long"))
        valid = (number >= 0) & (number < 0x110000) & ~number.between(0xD800, 0xDFFF)
        named = F.create_map(*[F.lit(x) for pair in fixed.PAGE_ENTITIES.items() for x in pair])
        sign = F.coalesce(named[name], F.when(valid, whole(number)))
        return F.when(i == 0, part).otherwise(F.coalesce(F.concat(sign, F.substring(part, F.length(name) + 2, F.length(part))), F.concat(F.lit("&"), part)))

    return F.array_join(F.transform(F.split(text, "&", -1), one), "")
