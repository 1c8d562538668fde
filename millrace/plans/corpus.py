"""Markdown, corpus, teacher and review queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions import fixed
from millrace.functions import markdown as M
from millrace.functions import text as T
from millrace.operators import corpus as C
from millrace.operators import review as V

from .curate import _literal
from .registry import query, table

_STRIP = r"regexp_replace({}, '^\s+|\s+$', '', 'g')"
_NAMES = "|".join(sorted(fixed.HTML_ELEMENTS, key=len, reverse=True))


def _entities(x: str) -> str:
    for entity, sign in fixed.ENTITIES:
        x = f"replace({x}, '{entity}', '{sign.replace(chr(39), chr(39) * 2)}')"
    return x


@query(rf"""WITH l AS (SELECT page_id, unnest(string_split(html, chr(10))) AS line, generate_subscripts(string_split(html, chr(10)), 1) AS i FROM pages),
t AS (SELECT page_id, i, {_entities(f"regexp_replace(regexp_replace(line, '<br(?:[^A-Za-z0-9>][^>]*)?>|</p(?:re)?(?:[^A-Za-z0-9>][^>]*)?>|<p>', ' ', 'g'), '(?i)</?(?:{_NAMES})(?:[^A-Za-z0-9>][^>]*)?>', '', 'g')")} AS x FROM l)
SELECT page_id, md5(string_agg(x, chr(10) ORDER BY i)) AS text_md5 FROM t GROUP BY page_id""")
def md_strip_html(spark, sf):
    """Known tags out of each line, entities decoded."""
    rows = table(spark, sf, "pages").select("page_id", F.transform(F.split("html", "\n"), M.strip_html).alias("x"))
    return rows.select("page_id", F.md5(F.array_join("x", "\n")).alias("text_md5"))


@query("""SELECT doc_id, CASE WHEN doc_id % 3 <> 2 THEN source || ' ' || doc_id END AS title, CASE WHEN doc_id % 3 = 1 THEN md5('---' || chr(10) || 'title: ' || source || ' ' || doc_id || chr(10) || text) ELSE md5(text) END AS body_md5 FROM (SELECT doc_id, source, replace(replace(text, '---', ''), 'title:', '') AS text FROM documents)""")
def md_front_matter(spark, sf):
    """Titles of closed and unclosed front matter, and the text after it."""
    head = F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit('---\ntitle: "'), "source", F.lit(" "), "doc_id", F.lit('"\nlang: x\n---\n')))
    head = head.when(F.col("doc_id") % 3 == 1, F.concat(F.lit("---\ntitle: "), "source", F.lit(" "), "doc_id", F.lit("\n"))).otherwise("")
    plain = F.replace(F.replace("text", F.lit("---"), F.lit("")), F.lit("title:"), F.lit(""))  # no marks but those added
    rows = table(spark, sf, "documents").select("doc_id", F.concat(head, plain).alias("t"))
    return rows.select("doc_id", M.front_matter_title(F.col("t")).alias("title"), F.md5(M.strip_front_matter(F.col("t"))).alias("body_md5"))


@query(r"""WITH l AS (SELECT doc_id, unnest(a) AS line, generate_subscripts(a, 1) AS i FROM (SELECT doc_id, string_split(regexp_replace(text, '\n$', ''), chr(10)) AS a FROM (SELECT doc_id, coalesce(text, '') AS text FROM documents))),
f AS (SELECT *, regexp_matches(line, '^\s*(```|~~~)') AS fence FROM l), c AS (SELECT *, sum(fence::INT) OVER (PARTITION BY doc_id ORDER BY i) % 2 = 1 OR fence AS code FROM f),
k AS (SELECT *, trim(line, ' ' || chr(9) || chr(13)) = '' AS blank FROM c WHERE code OR NOT regexp_matches(line, '^\s{0,3}\[[^\]]+\]:\s*\S')),
j AS (SELECT *, NOT code AND NOT blank AND NOT regexp_matches(line, '^\s*[#|]') AS joins, NOT code AND NOT blank AND NOT regexp_matches(line, '^\s*([#>|<]|[-*+]\s|\d+[.)]\s)') AS may FROM k),
g AS (SELECT *, may AND coalesce(lag(joins) OVER (PARTITION BY doc_id ORDER BY i), false) AS cont FROM j), n AS (SELECT *, sum((NOT cont)::INT) OVER (PARTITION BY doc_id ORDER BY i) AS grp FROM g),
o AS (SELECT doc_id, grp, CASE WHEN bool_or(code) THEN any_value(line) ELSE regexp_replace(string_agg(CASE WHEN cont THEN regexp_replace(line, '^\s+', '') ELSE line END, ' ' ORDER BY i), '\[([^\]\n]+)\]\[[^\]\n]*\]', '\1', 'g') END AS x FROM n GROUP BY doc_id, grp)
SELECT doc_id, md5(string_agg(x, chr(10) ORDER BY grp)) AS text_md5 FROM o GROUP BY doc_id""")
def md_tidy_prose(spark, sf):
    """Hard-wrapped lines joined, link definitions out, reference links as their text."""
    return table(spark, sf, "documents").select("doc_id", F.md5(M.tidy_prose(F.coalesce("text", F.lit("")))).alias("text_md5"))


# White space of Unicode in SQL, and a trim of it.
_SPACE = r"[\s\x{b}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


def _trim(x: str) -> str:
    return f"regexp_replace({x}, '^{_SPACE}+|{_SPACE}+$', '', 'g')"


@query(rf"""WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_trim("coalesce(source, '')")} AS chapter, '# 2. ' || coalesce(source, '') || chr(10) || chr(10) || 'Lead.' || chr(10) || chr(10) || '## 2.1 Part ' || doc_id || chr(10) || coalesce(text, '') || chr(10) || chr(10) || '## 2.2 Empty' AS t FROM documents),
l AS (SELECT r, doc_id, chapter, regexp_replace(unnest(a), '\r$', '') AS line, generate_subscripts(a, 1) AS i FROM (SELECT *, string_split(t, chr(10)) AS a FROM d)),
f AS (SELECT *, regexp_matches(line, '^{_SPACE}*(```|~~~)') AS fence FROM l), c AS (SELECT *, fence OR sum(fence::INT) OVER (PARTITION BY r ORDER BY i) % 2 = 1 AS code FROM f),
h AS (SELECT *, NOT code AND regexp_matches(line, '^##? ') AS top FROM c), s AS (SELECT *, sum(top::INT) OVER (PARTITION BY r ORDER BY i) AS section FROM h),
b AS (SELECT *, sum(CASE WHEN top THEN 0 ELSE strlen(line) + 1 END) OVER (PARTITION BY r, section) AS bytes FROM s),
n AS (SELECT *, top OR (NOT code AND starts_with(line, '### ') AND bytes > {fixed.MAX_SECTION_BYTES}) AS head FROM b), g AS (SELECT *, sum(head::INT) OVER (PARTITION BY r ORDER BY i) AS part FROM n),
p AS (SELECT doc_id, chapter, {_trim("max(CASE WHEN head THEN regexp_replace(regexp_replace(line, '^#+ ', ''), '^[0-9.:]+', '') END)")} AS heading, {_trim("string_agg(CASE WHEN NOT head THEN line END, chr(10) ORDER BY i)")} AS body FROM g GROUP BY r, doc_id, chapter, part)
SELECT doc_id, chapter, heading, md5('# ' || chapter || chr(10) || chr(10) || CASE WHEN heading = chapter THEN '' ELSE '## ' || heading || chr(10) || chr(10) END || body) AS passage_md5 FROM p WHERE body <> ''""")
def md_sections(spark, sf):
    """Chapters made of a lead, a numbered section that whole documents follow, and an empty one, cut and put together as passages."""
    text, source = (F.coalesce(c, F.lit("")) for c in ("text", "source"))
    chapter = F.concat(F.lit("# 2. "), source, F.lit("\n\nLead.\n\n## 2.1 Part "), "doc_id", F.lit("\n"), text, F.lit("\n\n## 2.2 Empty\n"))
    rows = table(spark, sf, "documents").select("doc_id", chapter.alias("t"), F.lit("src/x.md").alias("origin"))
    rows = rows.withColumn("chapter", M.chapter_title(F.col("t"), F.col("origin"))).select("doc_id", "chapter", F.explode(M.sections("t", "chapter")).alias("s"))
    return rows.select("doc_id", "chapter", F.col("s.heading").alias("heading"), F.md5(M.passage(F.col("chapter"), F.col("s.heading"), F.col("s.body"))).alias("passage_md5"))


@query(r"""WITH d AS (SELECT doc_id AS id, replace(replace(text, chr(96) || chr(96) || chr(96), ''), '~~~', '') AS t, ['rust', '', 'c++', 'py'][doc_id % 4 + 1] AS language FROM documents)
SELECT id, language, md5(t || chr(10)) AS code_md5, 3 AS line FROM d UNION ALL SELECT id, '', md5('last ' || id), len(string_split(t, chr(10))) + 6 FROM d WHERE id % 3 = 0""")
def md_fenced_blocks(spark, sf):
    """Documents put between fences, with a block that is never closed behind every third."""
    plain = F.replace(F.replace("text", F.lit("```"), F.lit("")), F.lit("~~~"), F.lit(""))
    mark = F.when(F.col("doc_id") % 2 == 0, "```").otherwise("  ~~~")
    name = F.element_at(F.array(*map(F.lit, ["rust", "", " c++ x", "py, y"])), (F.col("doc_id") % 4 + 1).cast("int"))
    last = F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit("\n\n~~~\nlast "), "doc_id")).otherwise("\nend")
    rows = table(spark, sf, "documents").select(F.col("doc_id").alias("id"), F.concat(F.lit("before\n"), mark, name, F.lit("\n"), plain, F.lit("\n"), mark, F.lit("  "), last).alias("t"))
    rows = rows.select("id", F.explode(M.fenced_blocks(F.col("t"))).alias("b"))
    return rows.select("id", "b.language", F.md5("b.code").alias("code_md5"), "b.line")


_SOURCES = [("//! Counts words.\n//! Twice.\nfn main() {}\n", "a/count.rs"), ("#!/usr/bin/env python\n\n# Reads a file.\nimport os\n", "b/read.py"), ("package x\n", "c/none.go"), ("// Adds.\n__global__ void f() {}\n\n", "d/add.cu"), ("text", "e/x.txt")]


@query(r"""SELECT path, 'Write a ' || language || ' program for this:' || chr(10) || chr(10) || array_to_string(list_transform(list_filter(string_split(source, chr(10)), lambda x: starts_with(x, mark) AND NOT starts_with(x, '#!')), lambda x: trim(substr(x, length(mark) + 1))), chr(10)) AS instruction,
'```' || tag || chr(10) || regexp_replace(source, '\s+$', '') || chr(10) || '```' AS response FROM (VALUES """ + _literal(_SOURCES) + """) v(source, path)
JOIN (VALUES ('rs','Rust','rust','//!'),('go','Go','go','//'),('cu','CUDA','cuda','//'),('py','Python','python','#')) l(ext, language, tag, mark) ON ends_with(path, '.' || ext) WHERE list_has_any(list_transform(string_split(source, chr(10)), lambda x: starts_with(x, mark) AND NOT starts_with(x, '#!')), [true])""")
def curate_code_examples(spark, sf):
    """Source files that open with a comment, as request and answer."""
    rows = spark.createDataFrame(_SOURCES, "source string, path string").select("path", M.code_example(F.col("source"), F.col("path")).alias("e"))
    return rows.where("e is not null").select("path", "e.instruction", "e.response")


_PATHS = [("trpl", "src/ch01.md"), ("trpl", "src/SUMMARY.md"), ("trpl", "other/x.md"), ("airbnb-javascript", "README.md"), ("airbnb-javascript", "css/README.md"), ("system-design-primer", "README-zh.md"), ("system-design-primer", "solutions/a.md"), ("kubernetes-website", "content/en/blog/x.md"), ("kubernetes-website", "content/en/docs/a.markdown"), ("go-website", "_content/doc.md"), ("go-website", "_content/README.md"), ("tigerbeetle", "docs/a.txt"), ("rust-rfcs", "text/0001.md")]


@query(f"""WITH f AS (SELECT * FROM (VALUES {_literal(_PATHS)}) v(source, path)), r AS (SELECT * FROM (VALUES {_literal(fixed.PLAIN_SOURCES)}) p(source, folder) UNION SELECT 'trpl', 'src')
SELECT DISTINCT source, path FROM f JOIN r USING (source) WHERE (folder = '' OR starts_with(path, folder || '/')) AND regexp_matches(path, '\\.(md|markdown)$')
AND (NOT regexp_matches(path, '(^|/)(SUMMARY|README)\\.md$') OR (source IN ('system-design-primer', 'airbnb-javascript') AND regexp_matches(path, '(^|/)README\\.md$')))
AND NOT list_has_any(list_transform([{", ".join(repr(x) for x in fixed.SKIPPED_TREES)}], lambda s: starts_with(source || '/' || path, s)), [true])""")
def curate_prose_files(spark, sf):
    """Files of a corpus that hold prose: below book folders or listed folders, no navigation, no skipped tree."""
    files, books = spark.createDataFrame(_PATHS, "source string, path string"), spark.createDataFrame([("trpl", "src")], "source string, folder string")
    return C.prose_files(files, books)


_MANIFEST = [("src0", "mit"), ("src1", "apache"), ("src1", "bsd")]


@query("""WITH m AS (SELECT source, CASE min(doc_id) % 3 WHEN 0 THEN 'mit' WHEN 1 THEN 'apache' END AS licence FROM documents GROUP BY source)
SELECT doc_id AS id, source, CASE WHEN doc_id % 4 = 0 THEN 'author''s own' ELSE coalesce(licence, 'unknown') END AS licence FROM documents LEFT JOIN m USING (source)""")
def curate_section_licences(spark, sf):
    """Sections with the licence of their source; unknown where the manifest has none."""
    docs = table(spark, sf, "documents")
    first = docs.groupBy("source").agg(F.min("doc_id").alias("k"))
    manifest = first.select("source", F.when(F.col("k") % 3 == 0, "mit").when(F.col("k") % 3 == 1, "apache").alias("licence")).where("licence is not null")
    sections = docs.select(F.col("doc_id").alias("id"), "source", F.when(F.col("doc_id") % 4 == 0, "book").otherwise("corpus").alias("kind"))
    return C.with_licence(sections, manifest).select("id", "source", "licence")


@query("""WITH r AS (SELECT source, doc_id AS id, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS rank FROM documents WHERE length(text) >= 800 AND doc_id NOT IN (SELECT doc_id FROM labels))
SELECT source, count(*) AS picked, min(id) AS first, max(id) AS last FROM r WHERE rank <= 4 GROUP BY source""")
def curate_picked_per_source(spark, sf):
    """Sections not used yet, the first four of each source."""
    rows = table(spark, sf, "documents").select(F.col("doc_id").alias("id"), "source", F.concat_ws("/", "source", F.col("doc_id").cast("string")).alias("origin"), F.col("text").alias("response"))
    picked = C.pick(rows, table(spark, sf, "labels").select(F.col("doc_id").alias("id")), 4)
    return picked.groupBy("source").agg(F.count(F.lit(1)).alias("picked"), F.min("id").alias("first"), F.max("id").alias("last"))


@query("""SELECT doc_id AS id, md5('## ' || source || chr(10) || chr(10) || '<!-- source: ' || source || '; section: ' || doc_id || '; licence: mit -->' || chr(10) || chr(10) || substr(text, 1, 6000) || chr(10) || chr(10)) AS entry_md5 FROM documents""")
def curate_queue_entries(spark, sf):
    rows = table(spark, sf, "documents")
    return rows.select(F.col("doc_id").alias("id"), F.md5(C.queue_entry(F.col("source"), F.col("doc_id").cast("string"), F.lit("mit"), F.col("text"))).alias("entry_md5"))


_REFERENCE_SQL = " OR ".join("contains(t, '" + p.replace("'", "''") + "')" for p in fixed.BOOK_REFERENCES)


@query(f"""WITH p AS (SELECT doc_id, lower(text || CASE WHEN doc_id % 7 = 0 THEN ' As we saw.' ELSE '' END) AS t FROM documents) SELECT doc_id FROM p WHERE NOT ({_REFERENCE_SQL})""")
def distill_reads_as_answer(spark, sf):
    rows = table(spark, sf, "documents").select("doc_id", F.concat("text", F.when(F.col("doc_id") % 7 == 0, " As we saw.").otherwise("")).alias("t"))
    return rows.where(C.reads_as_answer(F.col("t"))).select("doc_id")


@query(rf"""SELECT doc_id, md5({_STRIP.format("text")}) AS answer_md5 FROM (SELECT doc_id, replace(text, '#', '') AS text FROM documents)""")
def distill_answers(spark, sf):
    """Sections without the headings and blank lines that open them."""
    rows = table(spark, sf, "documents").withColumn("text", F.replace("text", F.lit("#"), F.lit("")))
    return rows.select("doc_id", F.md5(C.answer(F.concat(F.lit("# Title\n\n## Part\n \n"), "text"))).alias("answer_md5"))


_PLAN = """r AS (SELECT *, sum(CASE WHEN source IS DISTINCT FROM p THEN 1 ELSE 0 END) OVER (ORDER BY doc_id) AS chapter FROM (SELECT doc_id, source, text, lag(source) OVER (ORDER BY doc_id) AS p FROM documents)),
n AS (SELECT *, row_number() OVER (PARTITION BY chapter ORDER BY doc_id) - 1 AS k FROM r)"""


def _planned(spark, sf):
    return C.plan(table(spark, sf, "documents").select(F.col("doc_id").alias("seq"), F.col("source").alias("origin"), "text"), 3)


@query(f"WITH {_PLAN}, c AS (SELECT source, chapter, k // 3 AS part, count(*) AS n FROM n GROUP BY ALL) SELECT source AS collection, count(*) AS conversations, CAST(sum(n) AS BIGINT) AS turns FROM c GROUP BY source")
def distill_plan_counts(spark, sf):
    """Conversations of at most three sections planned from runs of one origin."""
    return C.plan_counts(_planned(spark, sf))


@query(f"""WITH {_PLAN}, f AS (SELECT CAST(chapter AS BIGINT) AS chapter, CAST(k // 3 AS INT) AS part, source || chr(10) || substr(text, 1, 200) AS s FROM n WHERE k % 3 = 0)
SELECT chapter, part, lower(lpad(to_hex(list_reduce(list_prepend(14695981039346656037::UBIGINT, list_transform(range(1, strlen(s) + 1), lambda i: CAST(('0x' || substr(hex(encode(s)), 2 * i - 1, 2)) AS UBIGINT))),
lambda h, b: CAST((CAST(xor(h, b) AS HUGEINT) * 1099511628211) % 18446744073709551616 AS UBIGINT))), 16, '0')) AS key FROM f""")
def distill_conversation_keys(spark, sf):
    return C.conversation_keys(_planned(spark, sf))


@query(f"""WITH {_PLAN}, w AS (SELECT DISTINCT source || chr(10) || substr(text, 1, 200) AS s FROM documents WHERE doc_id % 2 = 0)
SELECT CAST(chapter AS BIGINT) AS chapter, CAST(k // 3 AS INT) AS part FROM n ANTI JOIN w ON w.s = n.source || chr(10) || substr(n.text, 1, 200) WHERE k % 3 = 0""")
def distill_remaining(spark, sf):
    """Planned conversations that a resumed run still has to write: those whose key is not among the written (here: of documents of even ids)."""
    written = table(spark, sf, "documents").where(F.col("doc_id") % 2 == 0).select(T.fnv1a(F.concat("source", F.lit("\n"), F.substring("text", 1, 200))).alias("key"))
    return V.remaining(C.conversation_keys(_planned(spark, sf)), written).select("chapter", "part")


@query("""WITH s AS (SELECT doc_id AS id, 1 AS position, 'toxic' AS reason FROM labels WHERE toxic = 1 UNION ALL SELECT doc_id, 2, 'poor' FROM labels WHERE quality = 0)
SELECT id, 'auto: ' || string_agg(reason, '; ' ORDER BY position) AS note FROM s WHERE id % 3 <> 0 GROUP BY id""")
def review_apply_suggestions(spark, sf):
    """Flags for suggested examples that have none, with all reasons in order."""
    marks = table(spark, sf, "labels").select(F.col("doc_id").alias("id"), "toxic", "quality")
    rows = marks.where("toxic = 1").select("id", F.lit(1).alias("position"), F.lit("toxic").alias("reason")).unionByName(marks.where("quality = 0").select("id", F.lit(2).alias("position"), F.lit("poor").alias("reason")))
    return C.applied(rows, marks.where("id % 3 = 0").select("id"))


@query("""SELECT doc_id AS id, CASE WHEN doc_id % 2 = 0 THEN 'seen' ELSE 'auto: x' END AS note FROM labels WHERE toxic = 1 AND doc_id % 5 <> 0 UNION ALL SELECT doc_id, 'new' FROM labels WHERE toxic = 0 AND doc_id % 5 = 1""")
def review_set_and_clear_flags(spark, sf):
    """Flags after some are cleared and others set."""
    marks = table(spark, sf, "labels").select(F.col("doc_id").alias("id"), "toxic")
    flags = marks.where("toxic = 1").select("id", F.when(F.col("id") % 2 == 0, "seen").otherwise("auto: x").alias("note"))
    changes = marks.where("(toxic = 1 and id % 5 = 0) or (toxic = 0 and id % 5 = 1)").select("id", F.when(F.col("toxic") == 0, "new").alias("note"))
    return C.with_flag(flags, changes)


@query("""SELECT doc_id AS id, NOT (doc_id % 2 = 1 AND quality = 0) AS reviewed FROM labels""")
def review_reviewed_flags(spark, sf):
    """A flag counts as reviewed unless its note is automatic and it has no spans."""
    rows = table(spark, sf, "labels").select(F.col("doc_id").alias("id"), F.when(F.col("doc_id") % 2 == 1, "auto: why").otherwise("note").alias("note"), F.col("quality").alias("spans"))
    return rows.select("id", C.is_reviewed(F.col("note"), F.col("spans")).alias("reviewed"))


_TITLED = [("readability",), ("book",), ("some-folder_name",), ("éclair-x",), ("",), ("corpus",)]


@query(f"""SELECT source, CASE source WHEN 'readability' THEN 'Your readability pairs' WHEN 'book' THEN 'Your interview books' WHEN 'corpus' THEN 'Open-source books and docs' ELSE upper(substr(replace(replace(source, '-', ' '), '_', ' '), 1, 1)) || substr(replace(replace(source, '-', ' '), '_', ' '), 2) END AS title
FROM (SELECT * FROM (VALUES {", ".join(f"('{x[0]}')" for x in _TITLED)}) v(source) UNION SELECT DISTINCT source FROM documents)""")
def review_source_titles(spark, sf):
    rows = spark.createDataFrame(_TITLED, "source string").unionByName(table(spark, sf, "documents").select("source")).distinct()
    return rows.select("source", C.source_title(F.col("source")).alias("title"))


@query("""WITH h AS (SELECT doc_id AS id, text, substr(text, 1, 600) AS h FROM documents), e AS (SELECT *, length(h) - strpos(reverse(h), chr(10)) AS e FROM h)
SELECT id, md5(CASE WHEN contains(h, chr(10)) AND e > 0 THEN substr(h, 1, e) ELSE h END) AS text_md5, strlen(CASE WHEN contains(h, chr(10)) AND e > 0 THEN substr(h, 1, e) ELSE h END) < strlen(text) AS shortened FROM e""")
def review_shortened(spark, sf):
    """Answers cut at a line, 600 characters at most, and whether they lost bytes."""
    rows = table(spark, sf, "documents").select(F.col("doc_id").alias("id"), "text", C.shortened(F.col("text"), 600).alias("s"))
    return rows.select("id", F.md5("s").alias("text_md5"), (F.octet_length("s") < F.octet_length("text")).alias("shortened"))


_PEOPLE = [("Ada", "ada@host.org"), (" ", "a@b"), ("B\tC", "x@.org"), ("x" * 81, "no at sign"), ("Eve", "e v@host.org"), ("Kim", "@host.org"), ("Lee", "l@host.org."), ("Max", " m@a.b "), ("Ned", "n@a@b.c")]


@query(rf"""SELECT name, email, trim(name) <> '' AND length(trim(name)) <= 80 AND NOT regexp_matches(trim(name), '[\x00-\x1f]') AS name_ok, regexp_matches(trim(email), '^[^@\s]+@[^.\s][^\s]*[^.\s]$') AND contains(substr(trim(email), strpos(trim(email), '@')), '.') AS email_ok FROM (VALUES {_literal(_PEOPLE)}) v(name, email)""")
def people_valid(spark, sf):
    rows = spark.createDataFrame(_PEOPLE, "name string, email string")
    return rows.withColumns({"name_ok": C.valid_name(F.col("name")), "email_ok": C.valid_email(F.col("email"))})


_ENTRIES = [
    ("a#1", "<!-- source: trpl; section: s1; licence: mit -->\n### User\nQ?\n### Assistant\nA.\n### Rejected\nBad.\n"), ("a#2", "### User\nQ\n### Assistant\nA"), ("a#3", "<!-- source: x -->\n### Assistant\nA"), ("a#4", "<!-- source: x -->\n### User\nQ"),
    ("a#5", "<!-- source: x -->\n### User\nQ\n### Rejected\nR\n### Assistant\nA"), ("a#6", "<!-- source: x -->\n### User\n\n### Assistant\nA"), ("a#7", "<!-- source: x -->\ntext"), ("a#8", "<!-- source: y; licence: bsd -->\n### User\nOne\n### Assistant\nTwo\n### User\nThree\n### Assistant\nFour more"),
]


@query("SELECT * FROM (VALUES ('a#1','trpl','s1','mit',2,'Bad.',NULL),('a#2','',NULL,NULL,2,NULL,'no source'),('a#3','x',NULL,NULL,1,NULL,'out of order'),('a#4','x',NULL,NULL,1,NULL,'ends with user'),('a#5','x',NULL,NULL,3,NULL,'rejected not last'),('a#6','x',NULL,NULL,2,NULL,'empty section'),('a#7','x',NULL,NULL,0,NULL,'no turns'),('a#8','y',NULL,'bsd',4,NULL,NULL)) v(origin, source, section, licence, n_turns, rejected, error)")
def teacher_entries(spark, sf):
    """Entries with the first thing that is wrong with each. The SQL states the expected rows."""
    rows = C.entry_parts(spark.createDataFrame(_ENTRIES, "origin string, entry string"))
    return rows.select("origin", "source", "section", "licence", F.size("turns").alias("n_turns"), "rejected", "error")


@query("""WITH t AS (SELECT conv_id, turn, role, text FROM conversations WHERE role <> 'system'), c AS (SELECT conv_id, count(*) AS n, bool_and((role = 'user') = (k % 2 = 1)) AS ordered, bool_or(trim(text) = '') AS blank, sum(length(regexp_replace(text, '^\\s+|\\s+$', '', 'g'))) AS chars
FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS k FROM t) GROUP BY conv_id)
SELECT count(*) AS passed, CAST(sum(n) AS BIGINT) AS turns, count(*) FILTER (WHERE n > 2) AS multi_turn, count(*) AS grounded, 0 AS pairs, CAST(sum(chars) // 4 AS BIGINT) AS tokens FROM c WHERE ordered AND n % 2 = 0 AND NOT blank""")
def teacher_report(spark, sf):
    """Conversations written as teacher entries, read again, and summed."""
    heading = F.when(F.col("role") == "user", "### User\n").otherwise("### Assistant\n")
    turns = table(spark, sf, "conversations").where("role != 'system'").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", F.concat(heading, "text", F.lit("\n")).alias("x")))).alias("x"))
    entry = F.concat(F.lit("<!-- source: conv; section: "), F.col("conv_id").cast("string"), F.lit(" -->\n"), F.array_join(F.transform("x", lambda t: t["x"]), ""))
    return C.teacher_totals(C.entry_parts(turns.select(F.col("conv_id").cast("string").alias("origin"), entry.alias("entry"))))


_TAUGHT_SQL = r"""t AS (SELECT conv_id, turn, role, text FROM conversations WHERE role <> 'system'), c AS (SELECT conv_id, count(*) AS n, bool_and((role = 'user') = (k % 2 = 1)) AS ordered, bool_or(trim(text) = '') AS blank
FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS k FROM t) GROUP BY conv_id), g AS (SELECT conv_id, n FROM c WHERE ordered AND n % 2 = 0 AND NOT blank)"""


def _taught(spark, sf):
    """Conversations as teacher entries with code in their answers; of two in three the section is the document of their number or beyond."""
    code = F.when(F.col("turn") % 2 == 0, F.concat(F.lit("\n```"), F.when(F.col("turn") % 4 == 0, "rust").otherwise("go"), F.lit("\nx\n```"))).otherwise("\n~~~\ny\n~~~")
    heading = F.when(F.col("role") == "user", "### User\n").otherwise("### Assistant\n")
    turns = table(spark, sf, "conversations").where("role != 'system'").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", F.concat(heading, "text", F.when(F.col("role") == "user", "").otherwise(code), F.lit("\n")).alias("x")))).alias("x"))
    section = F.when(F.col("conv_id") % 3 == 0, "").otherwise(F.concat(F.lit("; section: "), F.when(F.col("conv_id") % 3 == 1, F.col("conv_id")).otherwise(-F.col("conv_id")).cast("string")))
    entry = F.concat(F.lit("<!-- source: conv"), section, F.lit(" -->\n"), F.array_join(F.transform("x", lambda t: t["x"]), ""))
    parsed = C.entry_parts(turns.select(F.col("conv_id").cast("string").alias("origin"), entry.alias("entry")))
    sections = table(spark, sf, "documents").select(F.col("doc_id").cast("string").alias("id"), "source", F.concat_ws("/", "source", F.col("doc_id").cast("string")).alias("origin"), F.lit("mit").alias("licence"), "text")
    return C.with_sections(parsed, sections)


@query(f"""WITH {_TAUGHT_SQL} SELECT coalesce(d.source, 'written by the teacher') AS source, count(*) AS conversations FROM g LEFT JOIN documents d ON g.conv_id = d.doc_id AND g.conv_id % 3 = 1 WHERE g.conv_id % 3 = 0 OR d.doc_id IS NOT NULL GROUP BY 1""")
def teacher_sources(spark, sf):
    """Conversations by the source of the section they name; those that name none that exists are errors."""
    return C.conversations_by_source(_taught(spark, sf))


@query(f"""WITH {_TAUGHT_SQL}, b AS (SELECT g.conv_id, CASE WHEN turn % 4 = 0 THEN 'rust' WHEN turn % 2 = 0 THEN 'go' ELSE '' END AS language FROM g JOIN t USING (conv_id) LEFT JOIN documents d ON g.conv_id = d.doc_id AND g.conv_id % 3 = 1 WHERE role = 'assistant' AND (g.conv_id % 3 = 0 OR d.doc_id IS NOT NULL))
SELECT language, count(*) AS blocks, count(DISTINCT conv_id) AS entries FROM b GROUP BY language""")
def teacher_blocks(spark, sf):
    """Code blocks of answers by language."""
    return C.blocks_by_language(_taught(spark, sf))


_SEARCHES = [(1, ["rust jobs", " rust jobs ", "go"], "jobs"), (2, ["who runs it"], "people"), (3, ["plain", ""], "general"), (4, ["career ladder", "x"], "jobs")]


@query("""SELECT * FROM (VALUES (1, 'rust jobs|rust jobs careers|rust jobs linkedin jobs|go'), (2, 'who runs it|who runs it recruiter|who runs it "hiring manager"|who runs it "we are hiring"'), (3, 'plain'), (4, 'career ladder|career ladder job posting|career ladder linkedin jobs|x')) v(id, queries)""")
def web_search_plan(spark, sf):
    """Searches widened by their kind. The SQL states the expected rows."""
    rows = spark.createDataFrame(_SEARCHES, "id int, q array<string>, kind string")
    return rows.select("id", F.array_join(C.search_plan(F.col("q"), F.col("kind")), "|").alias("queries"))


@query("""SELECT doc_id FROM documents WHERE contains(lower(text), 'the ') OR contains(lower(source), 'the ') OR contains(coalesce(lower(lang), 'null'), 'the ')""")
def review_search_lines(spark, sf):
    """Search over whole JSON lines, all fields."""
    return C.raw_matches(table(spark, sf, "documents").select("doc_id", "text", "source", "lang"), "the ").select("doc_id")


@query("SELECT doc_id AS id, kind FROM (SELECT doc_id, unnest([" + ", ".join(f"CASE WHEN regexp_matches(text, '{p}') THEN '{k}' END" for k, p in C.PERSONAL.items()) + "]) AS kind FROM documents) WHERE kind IS NOT NULL")
def review_personal_kinds(spark, sf):
    """Kinds of personal data and secrets in each document."""
    return table(spark, sf, "documents").select(F.col("doc_id").alias("id"), F.explode(C.personal_kinds(F.col("text"))).alias("kind"))


@query("""SELECT conv_id, string_agg(role, ',' ORDER BY turn) AS roles FROM (SELECT *, lag(role) OVER (PARTITION BY conv_id ORDER BY turn) AS p FROM conversations) WHERE role IS DISTINCT FROM p GROUP BY conv_id""")
def chat_role_changes(spark, sf):
    """Roles in order, without repeats next to each other."""
    rows = table(spark, sf, "conversations").groupBy("conv_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("turn", "role"))), lambda x: x["role"]).alias("r"))
    return rows.select("conv_id", F.array_join(C.without_repeats(F.col("r")), ",").alias("roles"))


@query("""WITH h AS (SELECT doc_id AS id, text, substr(text, 1, 300) AS h FROM documents), e AS (SELECT *, length(h) - strpos(reverse(h), chr(10)) AS e FROM h)
SELECT id, md5(CASE WHEN length(text) <= 300 THEN text ELSE (CASE WHEN contains(h, chr(10)) AND e > 0 THEN substr(h, 1, e) ELSE h END) || chr(10) || '[cut]' END) AS text_md5 FROM e""")
def web_cut_pages(spark, sf):
    """Texts cut at a line, with a mark."""
    return table(spark, sf, "documents").select(F.col("doc_id").alias("id"), F.md5(C.cut(F.col("text"), 300)).alias("text_md5"))


@query("SELECT * FROM (VALUES ('A', '2'), ('B', 'x y'), ('C', ''), ('D', 'a=b')) v(k, v)")
def models_settings(spark, sf):
    """KEY=value lines. The SQL states the expected rows."""
    rows = spark.createDataFrame([('# note\nA=1\nB = "x y"\n\nC=\nD=a=b\nA=2\nnone',)], "t string")
    return rows.select(F.explode(C.settings(F.col("t"))).alias("k", "v"))


_PAGES = [("0", "10"), ("-3", "1000"), ("x", ""), ("99", "0"), (None, "7")]


@query("""SELECT start, "limit", least(greatest(coalesce(try_cast(start AS INT), 0), 0), 50) AS from_, least(greatest(coalesce(try_cast("limit" AS INT), 20), 1), 100) AS take FROM (VALUES ('0','10'),('-3','1000'),('x',''),('99','0'),(NULL,'7')) v(start, "limit")""")
def review_page_bounds(spark, sf):
    """Request parameters, lenient and clamped."""
    b = C.page_bounds(F.col("start"), F.col("limit"), F.lit(50))
    return spark.createDataFrame(_PAGES, "start string, limit string").select("start", "limit", b["start"].alias("from_"), b["limit"].alias("take"))
