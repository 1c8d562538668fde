"""HTML to text with layout (operator 7).

A tolerant tree builder reads a page's tags (implied ends of p, li, dt/dd, option, table rows, cells and sections; void elements;
raw text of script and style; unclosed and stray tags), visibility rules drop what a browser does not show (head, script, style,
template, noscript, the hidden attribute, aria-hidden is kept, display:none or visibility:hidden in a style attribute, hidden
inputs, comments), and a renderer emits all visible text: blocks on lines of their own, paragraphs, headings, lists, tables and
quotes apart by a blank line, `- ` and `1. ` items indented by depth, table cells padded to the width of their column (PAD at most) and parted
by ` | `, pre with its white space, br as a line break, an image's alt text.

Defined cases: a null page gives null; an empty one an empty text; unknown tags are inline; broken markup is text; an unclosed quote in a tag is a
sign like any other, and every page is read in time in proportion to its length; nesting beyond
DEPTH levels is flattened; repeated rows are returned each; extra columns are ignored.
"""

from __future__ import annotations

import re
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import bytesops as B

OPEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[(?P<cdata>.*?)(?:\]\]>|\Z)|<[!?][^>]*>?|<(?P<close>/)?(?P<name>[A-Za-z][^\s/>]*)", re.S)
STOP = re.compile("[>\"']")
#: Widest column that is padded: a longer cell stands out of its column, so that a table's text stays in proportion to its page.
PAD = 60
ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
HIDING = re.compile(r"display\s*:\s*none|visibility\s*:\s*(?:hidden|collapse)", re.I)
# Element names of the HTML standard, by how they behave.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
UNSEEN = frozenset("head script style template noscript title iframe object audio video canvas datalist noembed noframes".split())
APART = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl table blockquote pre figure hr form fieldset".split())
BLOCK = APART | frozenset("html body div section article header footer main nav aside address li dt dd tr caption thead tbody tfoot details summary figcaption legend option optgroup select center hgroup dialog".split())
# A start tag of the key ends an open element of the values, within the nearest of the barriers.
ENDS = {"li": "li", "dt": "dt dd", "dd": "dt dd", "option": "option", "optgroup": "option optgroup", "tr": "tr td th", "td": "td th", "th": "td th", "thead": "tr td th tbody tfoot", "tbody": "tr td th thead tbody tfoot", "tfoot": "tr td th thead tbody"}
ENDS = {k: frozenset(v.split()) for k, v in ENDS.items()}
BARRIERS = {"li": frozenset("ul ol menu".split()), "dt": frozenset(["dl"]), "dd": frozenset(["dl"]), "option": frozenset(["select"]), "optgroup": frozenset(["select"])}
BARRIERS |= {k: frozenset(["table"]) for k in ("tr", "td", "th", "thead", "tbody", "tfoot")}
ENDS_P = APART | frozenset("div section article header footer main nav aside address ul ol dl center details".split())
DEPTH = 200
SPACES = re.compile(r"[ \t\n\r\f]+")


def tag_end(page: str, at: int, last: dict[str, int]) -> int:
    """Where the tag whose attributes start at `at` ends (its `>`), -1 if nowhere; quoted values may hold `>`, an unclosed quote is
    a sign like any other. last: the last place of `>` and of each quote, so that nothing is searched for that does not come."""
    k = at
    while k <= last[">"] and (m := STOP.search(page, k)):
        if m[0] == ">":
            return m.start()
        k = page.find(m[0], m.end()) + 1 if m.start() < last[m[0]] else m.end()
    return page.find(">", at) if at <= last[">"] else -1


def parse(page: str) -> list:
    """The tree: [name, attributes text, children]; children are strings and such lists."""
    last = {c: page.rfind(c) for c in ">\"'"}
    root: list = ["html", "", []]
    open_ = [root]

    def text(s: str) -> None:
        if s:
            open_[-1][2].append(s)

    def end(names: frozenset, barriers: frozenset) -> None:
        for i in range(len(open_) - 1, 0, -1):
            if open_[i][0] in barriers:
                return
            if open_[i][0] in names:
                del open_[i:]
                return

    at, low = 0, None
    while (m := OPEN.search(page, at)) is not None:
        stop = tag_end(page, m.end(), last) if m["name"] else m.end() - 1
        if stop < 0:  # no tag ends any more: the rest is text
            break
        text(unescape(page[at : m.start()]) if m.start() > at else "")
        at, attrs = stop + 1, page[m.end() : stop]
        if m["cdata"] is not None:
            text(m["cdata"])
        if m["name"] is None:
            continue
        name = m["name"].lower()
        if m["close"]:
            if name == "p" and not any(x[0] == "p" for x in open_):
                open_[-1][2].append(["p", "", []])
            for i in range(len(open_) - 1, 0, -1):
                if open_[i][0] == name:
                    del open_[i:]
                    break
                if open_[i][0] in ("td", "th", "table") and name not in BLOCK | {"td", "th"}:
                    break
            continue
        if name in ENDS:
            end(ENDS[name], BARRIERS[name])
        if name in ENDS_P:
            end(frozenset(["p"]), frozenset(["td", "th", "table", "li", "button"]))
        node: list = [name, attrs, []]
        open_[-1][2].append(node)
        if name in VOID:
            continue
        if name in RAW:
            low = page.lower() if low is None else low
            stop = low.find("</" + name, at)
            stop = len(page) if stop < 0 else stop
            node[2].append(unescape(page[at:stop]) if name in ("textarea", "title") else page[at:stop])
            close = page.find(">", stop)
            at = len(page) if close < 0 else close + 1
        elif len(open_) < DEPTH:
            open_.append(node)
    text(unescape(page[at:]))
    return root


def visible(name: str, attrs: str) -> bool:
    if name in UNSEEN:
        return False
    if not attrs or attrs.isspace():
        return True
    found = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in ATTRIBUTE.finditer(attrs)}
    return not ("hidden" in found or HIDING.search(unescape(found.get("style", ""))) or (name == "input" and found.get("type", "").lower() == "hidden"))


class Lines:
    """Text in the making: words run on in a line, blocks close it, `apart` leaves a blank line before the next."""

    def __init__(self):
        self.out: list[str] = []
        self.line: list[str] = []
        self.gap = self.space = False

    def close(self, apart: bool = False) -> None:
        if line := "".join(self.line).rstrip():
            self.out.append(line)
        self.line, self.space = [], False
        if apart and self.out:
            self.gap = True

    def lines(self, found: list[str]) -> None:
        self.close()
        for line in found:
            if self.gap and self.out:
                self.out.append("")
            self.gap = False
            self.out.append(line)

    def write(self, s: str) -> None:
        s = SPACES.sub(" ", s)
        if s == " " or not s:
            self.space = self.space or (bool(s) and bool(self.line))
            return
        if not self.line and self.gap and self.out:
            self.out.append("")
        self.gap = False
        if self.line and (self.space or s[0] == " "):
            self.line.append(" ")
        self.line.append(s.strip(" "))
        self.space = s[-1] == " "


def render(node: list, out: Lines, depth: int = 0) -> None:
    for child in node[2]:
        if isinstance(child, str):
            out.write(child)
            continue
        name, attrs, kids = child
        if not visible(name, attrs):
            continue
        if name == "br":
            out.close()
        elif name == "hr":
            out.close(True)
        elif name == "img":
            found = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in ATTRIBUTE.finditer(attrs)}
            out.write(unescape(found.get("alt", "")))
        elif name in ("ul", "ol", "menu"):
            out.close(depth == 0)
            number = 0
            for item in kids:
                if isinstance(item, list) and item[0] == "li" and visible(*item[:2]):
                    number += 1
                    inner = within(item, depth + 1)
                    mark = f"{number}. " if name == "ol" else "- "
                    if inner:
                        out.lines([mark + inner[0].lstrip(), *[" " * len(mark) + x if x else x for x in inner[1:]]])
                elif not isinstance(item, str) or not item.isspace():
                    out.lines(within(["", "", [item]], depth + 1))
            out.close(depth == 0)
        elif name == "table":
            out.close(True)
            out.lines(table(child, depth))
            out.close(True)
        elif name == "pre":
            out.close(True)
            out.lines([x.rstrip() for x in plain(child).strip("\n").split("\n")])
            out.close(True)
        elif name in BLOCK:
            out.close(name in APART)
            render(child, out, depth)
            out.close(name in APART)
        else:
            render(child, out, depth)


def within(node: list, depth: int) -> list[str]:
    out = Lines()
    render(node, out, depth)
    out.close()
    return out.out


def plain(node: list) -> str:
    return "".join(x if isinstance(x, str) else ("\n" if x[0] == "br" else plain(x) if visible(*x[:2]) else "") for x in node[2])


def table(node: list, depth: int) -> list[str]:
    rows: list[list[str]] = []
    loose: list[str] = []

    def walk(n: list) -> None:
        for x in n[2]:
            if isinstance(x, str):
                if not x.isspace():
                    loose.append(SPACES.sub(" ", x).strip())
            elif not visible(*x[:2]):
                continue
            elif x[0] == "tr":
                rows.append([])
                walk(x)
            elif x[0] in ("td", "th"):
                if not rows:
                    rows.append([])
                rows[-1].append(" ".join(within(x, depth + 1)).strip())
            elif x[0] == "caption":
                loose.extend(within(x, depth))
            elif x[0] in ("thead", "tbody", "tfoot", "colgroup", "form"):
                walk(x)
            else:
                loose.extend(within(["", "", [x]], depth))

    walk(node)
    widths = [max((len(r[i]) for r in rows if i < len(r)), default=0) for i in range(max(map(len, rows), default=0))]
    return loose + [line for r in rows if (line := " | ".join(c.ljust(min(w, PAD)) for c, w in zip(r, widths)).rstrip())]


def extract(page: str | None) -> str | None:
    if page is None:
        return None
    return "\n".join(within(parse(page), 0))


def title_of(page: str | None) -> str | None:
    if page is None:
        return None
    m = re.search(r"<title[^>]*>(.*?)(?:</title|\Z)", page, re.S | re.I)
    return SPACES.sub(" ", unescape(m[1])).strip() if m else None


def extract_pages(pages: DataFrame, keep: list[str]) -> DataFrame:
    """`keep` columns plus title and text of each row of pages (html)."""
    chosen = pages.select(*keep)
    names = chosen.columns

    def run(batches):
        for b in B.slices(batches, "__html"):
            html = b.column("__html").to_pylist()
            yield pa.record_batch({n: b.column(n) for n in names} | {"title": pa.array(map(title_of, html), pa.string()), "text": pa.array(map(extract, html), pa.string())})

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in chosen.schema)
    return pages.select(*keep, F.col("html").alias("__html")).mapInArrow(run, f"{schema}, title string, text string")


def op7_html_extraction(spark, sf_dir: str) -> DataFrame:
    return extract_pages(spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html"), ["page_id", "url"])
