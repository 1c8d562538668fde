"""Curation and review queries."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from millrace.functions import fixed
from millrace.functions import text as T
from millrace.operators import build as B
from millrace.operators import curate as C
from millrace.operators import review as V
from millrace.operators.scratch import scratch_folder

from .registry import query, table

# SQL of the shared steps. \\s is ASCII in this dialect.
SQUEEZED = r"trim(regexp_replace(coalesce(text, ''), '\s+', ' ', 'g'))"
REASONS = f"""ex AS (SELECT doc_id AS id, source, coalesce(text, '') AS response, {SQUEEZED} AS k FROM documents),
long_ AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY id) AS rn FROM ex WHERE length(response) >= 200),
kept AS (SELECT * FROM long_ WHERE rn = 1)"""
FLAGS = "flags AS (SELECT DISTINCT doc_id AS id FROM labels WHERE toxic = 1 OR quality = 0)"


def _examples(spark, sf):
    return C.examples(table(spark, sf, "documents"))


def _kept(spark, sf):
    return C.with_reason(_examples(spark, sf)).where("reason is null")


def _flags(spark, sf):
    return table(spark, sf, "labels").where("toxic = 1 or quality = 0").select(F.col("doc_id").alias("id"))


@query(f"""WITH {REASONS}, r AS (SELECT source, length(response) // 4 AS t FROM kept)
SELECT coalesce(source, 'total') AS source, count(*) AS examples, CAST(sum(t) AS BIGINT) AS tokens, count(*) FILTER (WHERE t > 8192) AS long_examples FROM r GROUP BY ROLLUP (source)""")
def curate_source_report(spark, sf):
    return C.source_report(_kept(spark, sf))


@query(f"""WITH {REASONS}, names AS (SELECT * FROM (VALUES (0,'safety'),(1,'image'),(2,'empty'),(3,'notes'),(4,'no header'),(5,'short'),(6,'duplicate'),(7,'flagged')) v(position, reason)),
{FLAGS}
SELECT position, reason, CASE reason WHEN 'short' THEN (SELECT count(*) FROM ex WHERE length(response) < 200) WHEN 'duplicate' THEN (SELECT count(*) FROM long_ WHERE rn > 1)
 WHEN 'flagged' THEN (SELECT count(*) FROM kept WHERE id IN (SELECT id FROM flags)) ELSE 0 END AS n FROM names""")
def curate_skip_report(spark, sf):
    rows = C.separate_flagged(C.with_reason(_examples(spark, sf)), _flags(spark, sf))
    reason = F.coalesce("reason", F.when(F.col("flagged"), "flagged"))
    return C.skip_report(rows.select(reason.alias("reason")).where("reason is not null"))


@query(f"""WITH {REASONS}, {FLAGS}
SELECT source, count(*) FILTER (WHERE f.id IS NULL) AS kept, count(*) FILTER (WHERE f.id IS NOT NULL) AS flagged FROM kept LEFT JOIN flags f USING (id) GROUP BY source""")
def curate_flagged_split(spark, sf):
    rows = C.separate_flagged(_kept(spark, sf), _flags(spark, sf))
    return rows.groupBy("source").agg(F.count_if(~F.col("flagged")).alias("kept"), F.count_if("flagged").alias("flagged"))


@query(f"WITH {REASONS}, {FLAGS} SELECT f.id FROM flags f ANTI JOIN kept k ON f.id = k.id")
def curate_unmatched_flags(spark, sf):
    return _flags(spark, sf).distinct().join(_kept(spark, sf), "id", "left_anti").orderBy("id")


_LICENCE = """CASE WHEN contains(t, 'Mozilla Public License') THEN 'mozilla_public' WHEN contains(t, 'PYTHON SOFTWARE FOUNDATION LICENSE VERSION 2') THEN 'python_software_foundation'
WHEN (contains(t, 'Creative Commons') OR contains(t, 'Attribution') OR contains(t, 'CC0 1.0 Universal')) AND (contains(t, 'NonCommercial') OR contains(t, 'NoDerivatives') OR contains(t, 'NoDerivs') OR contains(t, 'ShareAlike') OR contains(t, 'Non-Commercial')) THEN 'creative_commons_restricted'
WHEN contains(t, 'Apache License') THEN 'apache' WHEN contains(t, 'Permission is hereby granted') OR contains(t, 'MIT License') THEN 'mit'
WHEN contains(t, 'Redistribution and use in source and binary forms') THEN 'bsd' WHEN contains(t, 'Creative Commons') OR contains(t, 'Attribution') OR contains(t, 'CC0 1.0 Universal') THEN 'creative_commons'
WHEN contains(t, 'NO-LICENCE-FILE') OR t = '' THEN 'missing' ELSE 'unrecognised' END"""


@query(f"""WITH c AS (SELECT {_LICENCE} AS licence FROM (SELECT coalesce(text, '') AS t FROM documents))
SELECT licence, licence IN ('mit','apache','bsd','creative_commons','python_software_foundation') AS reusable, count(*) AS n FROM c GROUP BY ALL""")
def curate_licences(spark, sf):
    rows = table(spark, sf, "documents").select(T.licence_class(F.coalesce("text", F.lit(""))).alias("licence"))
    return rows.groupBy("licence").agg(F.count(F.lit(1)).alias("n")).withColumn("reusable", T.permits_reuse(F.col("licence")))


_LICENCES = [("a", "MIT License || CC BY NonCommercial Attribution"), ("b", "Attribution-ShareAlike 4.0"), ("c", "Creative Commons Attribution 4.0"), ("d", "Mozilla Public License 2.0 Apache License"), ("e", ""), ("f", "All rights reserved"), ("g", "Permission is hereby granted, free of charge"), ("h", "Redistribution and use in source and binary forms"), ("i", "PYTHON SOFTWARE FOUNDATION LICENSE VERSION 2"), ("j", "NO-LICENCE-FILE"), ("k", "CC0 1.0 Universal")]


@query(f"SELECT k, {_LICENCE} AS licence FROM (VALUES {', '.join(repr(x) for x in _LICENCES)}) v(k, t)")
def curate_licence_cases(spark, sf):
    return spark.createDataFrame(_LICENCES, "k string, t string").select("k", T.licence_class(F.col("t")).alias("licence"))


@query("""WITH r AS (SELECT source, doc_id AS id, length(text) AS chars, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS rank FROM documents WHERE length(text) >= 800)
SELECT source, id, CAST(chars AS INT) AS chars, CAST(rank AS INT) AS rank FROM r WHERE rank <= 3""")
def curate_pick_sections(spark, sf):
    rows = C.teachable(_examples(spark, sf))
    return C.first_per_group(rows.select("source", "id", F.length("response").alias("chars")), "source", ["id"], 3)


@query(f"""WITH RECURSIVE {REASONS}, s AS (SELECT source, id, CAST(length(response) // 4 AS BIGINT) AS size, row_number() OVER (PARTITION BY source ORDER BY id) AS n FROM kept),
w AS (SELECT source, id, n, CASE WHEN size <= {fixed.SOURCE_CAP} THEN size ELSE 0 END AS used, size <= {fixed.SOURCE_CAP} AS keep FROM s WHERE n = 1
UNION ALL SELECT s.source, s.id, s.n, CASE WHEN w.used + s.size <= {fixed.SOURCE_CAP} THEN w.used + s.size ELSE w.used END, w.used + s.size <= {fixed.SOURCE_CAP} FROM w JOIN s ON s.source = w.source AND s.n = w.n + 1)
SELECT source, id FROM w WHERE keep""")
def curate_token_cap(spark, sf):
    """The cap of builds, fixed.SOURCE_CAP tokens a source."""
    rows = _kept(spark, sf).select("source", "id", F.col("tokens").alias("size"))
    return C.capped(rows, "source", "id", "size", fixed.SOURCE_CAP).select("source", "id")


@query("""SELECT doc_id AS id, lower(lpad(to_hex(list_reduce(list_prepend(14695981039346656037::UBIGINT, list_transform(range(1, strlen(s) + 1), lambda i: CAST(('0x' || substr(hex(encode(s)), 2 * i - 1, 2)) AS UBIGINT))),
lambda h, b: CAST((CAST(xor(h, b) AS HUGEINT) * 1099511628211) % 18446744073709551616 AS UBIGINT))), 16, '0')) AS stable_id FROM (SELECT doc_id, text AS s FROM documents)""")
def curate_stable_ids(spark, sf):
    return table(spark, sf, "documents").select(F.col("doc_id").alias("id"), T.fnv1a("text").alias("stable_id"))


_SPANS = [(1, "other"), (1, "rhythm_trick"), (2, "other"), (3, "fake_importance")]
_CATEGORIES = ["fake_importance", "dramatic_setup", "empty_depth_words", "fake_balance_hedging", "flattery_filler_opener", "wrap_up_repeat", "rhythm_trick", "other"]


@query(f"""SELECT c.category, count(s.id) AS n FROM (VALUES {', '.join(f"('{c}')" for c in _CATEGORIES)}) c(category) LEFT JOIN (VALUES {', '.join(repr(x) for x in _SPANS)}) s(id, category) USING (category) GROUP BY c.category""")
def curate_span_counts(spark, sf):
    names = spark.createDataFrame([(c,) for c in _CATEGORIES], "category string")
    spans = spark.createDataFrame(_SPANS, "id int, category string").groupBy("category").agg(F.count(F.lit(1)).alias("n"))
    return names.join(spans, "category", "left").select("category", F.coalesce("n", F.lit(0)).alias("n"))


_SOURCES = [*(f"src{k}" for k in range(20)), "book"]


@query(f"""WITH {REASONS}, {FLAGS}, names AS (SELECT unnest([{', '.join(repr(x) for x in _SOURCES)}]) AS name, unnest(range({len(_SOURCES)})) AS k), t AS (SELECT kept.*, length(response) // 4 AS t FROM kept WHERE id NOT IN (SELECT id FROM flags)),
f AS (SELECT id, id % 7 AS k FROM kept WHERE id IN (SELECT id FROM flags)), c AS (SELECT unnest([{', '.join(repr(x) for x in fixed.SPAN_CATEGORIES)}]) AS name, unnest(range(8)) AS k), w AS (SELECT unnest([{', '.join(repr(x) for x in fixed.SKIP_REASONS)}]) AS name, unnest(range(8)) AS k)
SELECT CAST(k AS INT) AS position, 'source' AS section, name, (SELECT count(*) FROM t WHERE source = name) AS n, CAST((SELECT coalesce(sum(t), 0) FROM t WHERE source = name) AS BIGINT) AS tokens FROM names
UNION ALL SELECT {len(_SOURCES)}, 'source', 'total', (SELECT count(*) FROM t), CAST((SELECT sum(t) FROM t) AS BIGINT)
UNION ALL SELECT CAST(k + {len(_SOURCES) + 1} AS INT), 'left out', name, CASE name WHEN 'short' THEN (SELECT count(*) FROM ex WHERE length(response) < 200) WHEN 'duplicate' THEN (SELECT count(*) FROM long_ WHERE rn > 1) WHEN 'flagged' THEN (SELECT count(*) FROM f) WHEN 'image' THEN 3 ELSE 0 END, NULL FROM w
UNION ALL SELECT CAST(k + {len(_SOURCES) + 9} AS INT), 'span', name, CASE WHEN k < 7 THEN (SELECT count(*) FROM f WHERE f.k = c.k) ELSE (SELECT count(*) FROM f WHERE f.k % 2 = 0) END, NULL FROM c
UNION ALL SELECT {len(_SOURCES) + 17}, 'preferences', 'pairs', (SELECT count(*) FROM benchmark), NULL""")
def curate_build_report(spark, sf):
    """The whole build from documents, labels as flags with spans by id, benchmark items as preference pairs; sources in order, one empty."""
    category = F.get(F.array(*map(F.lit, fixed.SPAN_CATEGORIES)), (F.col("id") % 7).cast("int"))
    other = F.when(F.col("id") % 7 % 2 == 0, F.struct(F.lit("other").alias("category"), F.lit("x").alias("text")))
    flags = _flags(spark, sf).withColumns({"note": F.lit("n"), "spans": F.array_compact(F.array(F.struct(category.alias("category"), F.lit("y").alias("text")), other))})
    pairs = table(spark, sf, "benchmark").select(F.col("text").alias("prompt"), F.lit("a").alias("chosen"), F.lit("b").alias("rejected"))
    return B.report_rows(spark, B.build(_examples(spark, sf), flags, scratch_folder(spark, "build"), _SOURCES, pairs, {"image": 3}))


@query("""SELECT origin, count(*) AS rows, min(position) AS first FROM (SELECT 'document' AS origin, doc_id AS position FROM documents UNION ALL SELECT 'benchmark', item_id FROM benchmark UNION ALL SELECT 'conversation', conv_id FROM conversations) GROUP BY origin""")
def curate_union_sources(spark, sf):
    parts = [table(spark, sf, n).select(F.lit(o).alias("origin"), F.col(c).alias("position")) for n, o, c in (("documents", "document", "doc_id"), ("benchmark", "benchmark", "item_id"), ("conversations", "conversation", "conv_id"))]
    rows = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return rows.groupBy("origin").agg(F.count(F.lit(1)).alias("rows"), F.min("position").alias("first"))


@query("""SELECT run, any_value(source) AS source, min(doc_id) AS first, count(*) AS n FROM (SELECT *, sum(CASE WHEN source IS DISTINCT FROM p THEN 1 ELSE 0 END) OVER (ORDER BY doc_id) AS run FROM
(SELECT doc_id, source, lag(source) OVER (ORDER BY doc_id) AS p FROM documents)) GROUP BY run""")
def chat_chapter_runs(spark, sf):
    rows = C.runs(table(spark, sf, "documents").select("doc_id", "source"), "source", "doc_id")
    return rows.groupBy("run").agg(F.first("source").alias("source"), F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("n"))


@query("SELECT source, count(*) AS n FROM documents GROUP BY source ORDER BY n DESC, source")
def review_source_counts(spark, sf):
    return table(spark, sf, "documents").groupBy("source").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "source")


@query("SELECT lang AS collection, source, count(*) AS n FROM documents GROUP BY lang, source")
def review_collections(spark, sf):
    return table(spark, sf, "documents").groupBy(F.col("lang").alias("collection"), "source").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "collection", "source")


@query("""WITH m AS (SELECT doc_id AS id, row_number() OVER (ORDER BY doc_id) - 1 AS position, count(*) OVER () AS total FROM documents WHERE contains(lower(text), 'idiot'))
SELECT id, CAST(position AS INT) AS position, total FROM m WHERE position >= 5 AND position < 25""")
def review_search_page(spark, sf):
    """Search and page: skip 5, take 20. The page is taken before positions are numbered, so nothing but it is sorted whole."""
    found = table(spark, sf, "documents").where(F.contains(F.lower("text"), F.lit("idiot"))).select(F.col("doc_id").alias("id"))
    page = found.orderBy("id").offset(5).limit(20)
    numbered = page.withColumn("position", (F.row_number().over(Window.partitionBy().orderBy("id")) + 4).cast("int"))
    return numbered.crossJoin(F.broadcast(found.agg(F.count(F.lit(1)).alias("total"))))


_MARKS = [(3, 0, " Great Question ", "flattery"), (1, 1, "great question", "other"), (1, 0, "abc", "other"), (2, 0, "Let that sink in", "drama"), (2, 1, "great question", "flattery")]


@query(f"""SELECT min_by(trim(text), struct_pack(id := id, pos := pos)) AS text, min_by(category, struct_pack(id := id, pos := pos)) AS category, count(*) AS n FROM (VALUES {', '.join(repr(x) for x in _MARKS)}) v(id, pos, text, category)
WHERE length(trim(text)) >= 4 GROUP BY lower(trim(text))""")
def review_phrases(spark, sf):
    return V.phrases(spark.createDataFrame(_MARKS, "id int, pos int, text string, category string")).orderBy(F.desc("n"), "text")


@query("""WITH m AS (SELECT doc_id AS id, unnest([0, 1]) AS pos, unnest([CASE WHEN doc_id % 2 = 0 THEN 'TAG ' ELSE ' tag ' END || split_part(text, ' ', 1), 'x']) AS text, source AS category FROM documents)
SELECT min_by(trim(text), struct_pack(id := id, pos := pos)) AS text, min_by(category, struct_pack(id := id, pos := pos)) AS category, count(*) AS n FROM m WHERE length(trim(text)) >= 4 GROUP BY lower(trim(text))""")
def review_phrase_counts(spark, sf):
    """Marked phrases of all documents (their first words, tagged) by lower-cased text, with the first spelling and category."""
    word = F.concat(F.when(F.col("doc_id") % 2 == 0, "TAG ").otherwise(" tag "), F.split_part("text", F.lit(" "), F.lit(1)))
    rows = table(spark, sf, "documents").select(F.col("doc_id").alias("id"), F.col("source").alias("category"), F.posexplode(F.array(word, F.lit("x"))).alias("pos", "text"))
    return V.phrases(rows)


_ANSWERS = [(1, "Great question! Let's delve into it — really — now."), (2, "It's worth noting that no filler is here."), (3, "<div>In summary</div>"), (4, "plain text"), (5, "HAPPY TO HELP. What a fascinating case."), (6, "one — dash"), (7, "Not because of that. Let that sink in.")]


def _literal(rows) -> str:
    quote = lambda x: "'" + x.replace("'", "''") + "'" if isinstance(x, str) else ("NULL" if x is None else str(x))
    return ", ".join("(" + ", ".join(map(quote, r)) + ")" for r in rows)


def _first_phrase_sql(phrases: list[str]) -> str:
    return "CASE " + " ".join(f"WHEN contains(t, {_literal([(p,)])[1:-1]}) THEN {_literal([(p,)])[1:-1]}" for p in phrases) + " END"


_RULES_SQL = " UNION ALL ".join(f"SELECT id, '{rule}' AS rule, {_first_phrase_sql(phrases)} AS match FROM a" for rule, phrases in fixed.SUGGESTION_RULES.items())


def suggestions(rows):
    """id, rule, match: the first phrase of each rule that lower-cased text holds, and the em-dash habit."""
    low = F.lower("text")
    found = [F.struct(F.lit(rule).alias("rule"), F.coalesce(*[F.when(F.contains(low, F.lit(p)), p) for p in phrases]).alias("match")) for rule, phrases in fixed.SUGGESTION_RULES.items()]
    dashes = F.when(F.regexp_count("text", F.lit("—")) >= fixed.EM_DASH_LIMIT, "—")
    found.append(F.struct(F.lit("em_dash_habit").alias("rule"), dashes.alias("match")))
    return rows.select("id", F.explode(F.array(*found)).alias("s")).select("id", "s.*").where("match is not null")


@query(f"WITH a AS (SELECT id, lower(text) AS t FROM (VALUES {_literal(_ANSWERS)}) v(id, text)) SELECT id, rule, match FROM ({_RULES_SQL} UNION ALL SELECT id, 'em_dash_habit', CASE WHEN length(t) - length(replace(t, '—', '')) >= 2 THEN '—' END FROM a) WHERE match IS NOT NULL")
def review_suggestions(spark, sf):
    return suggestions(spark.createDataFrame(_ANSWERS, "id int, text string"))


@query(f"WITH a AS (SELECT doc_id AS id, lower(text) AS t FROM documents) SELECT rule, count(*) AS n, count(DISTINCT id) AS ids FROM ({_RULES_SQL} UNION ALL SELECT id, 'em_dash_habit', CASE WHEN length(t) - length(replace(t, '—', '')) >= 2 THEN '—' END FROM a) WHERE match IS NOT NULL GROUP BY rule")
def review_suggestions_per_rule(spark, sf):
    rows = suggestions(table(spark, sf, "documents").select(F.col("doc_id").alias("id"), "text"))
    return rows.groupBy("rule").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("id").alias("ids"))


_ADDED_SLOP = ["Great Question!", "It's worth noting — really — that", "in SUMMARY", "plain", "<DIV>no fluff</div>"]
_FIELD_SQL = " UNION ALL ".join(f"SELECT id, source, '{field}' AS field, '{rule}' AS rule, '{fixed.SUGGESTION_CATEGORIES.get(rule, rule)}' AS category, {_first_phrase_sql(phrases).replace('contains(t,', f'contains({field[0]},')} AS match FROM a" for field in ("instruction", "response") for rule, phrases in fixed.SUGGESTION_RULES.items())


@query(f"""WITH b AS (SELECT doc_id AS id, source, {_literal([tuple(_ADDED_SLOP)]).replace('(', '[', 1)[:-1]}] AS x, text FROM documents), a AS (SELECT id, source, lower(x[id % 5 + 1] || '?') AS i, lower(text || ' ' || x[(id + id // 5) % 5 + 1]) AS r FROM b WHERE source <> 'src3')
SELECT id, source, field, rule, category, match FROM ({_FIELD_SQL} UNION ALL SELECT id, source, 'response', 'em_dash_habit', 'rhythm_trick', CASE WHEN length(r) - length(replace(r, '—', '')) >= 2 THEN (length(r) - length(replace(r, '—', ''))) || ' em dashes' END FROM a) WHERE match IS NOT NULL""")
def review_field_suggestions(spark, sf):
    """Suggestions for the requests and answers of all documents but those of a reviewer's own source (src3 stands for one)."""
    added = F.array(*map(F.lit, _ADDED_SLOP))
    rows = table(spark, sf, "documents").select(F.col("doc_id").alias("id"), F.when(F.col("source") == "src3", fixed.OWN_SOURCES[0]).otherwise(F.col("source")).alias("source"), F.concat(F.get(added, (F.col("doc_id") % 5).cast("int")), F.lit("?")).alias("instruction"),
                                                F.concat("text", F.lit(" "), F.get(added, ((F.col("doc_id") + F.floor(F.col("doc_id") / 5)) % 5).cast("int"))).alias("response"))
    return V.suggestions(rows)


@query("""WITH f AS (SELECT doc_id AS id, substr(text, CAST(strpos(lower(text), 'worthless') AS INT), 9) AS t FROM documents WHERE contains(lower(text), 'worthless')), l AS (SELECT DISTINCT doc_id AS id FROM labels)
SELECT f.id, CASE WHEN l.id IS NULL THEN 'phrase: Worthless' END AS note, f.t AS text, (SELECT count(*) FROM f) AS matched, (SELECT count(*) FROM f LEFT JOIN l USING (id) WHERE l.id IS NULL OR f.id % 2 = 1) AS added FROM f LEFT JOIN l USING (id) WHERE l.id IS NULL OR f.id % 2 = 1""")
def review_mark_everywhere(spark, sf):
    """A phrase marked in all answers but those whose flag has it (here: labelled ones of even ids)."""
    flags = table(spark, sf, "labels").select(F.col("doc_id").alias("id"), F.lit("n").alias("note"), F.when(F.col("doc_id") % 2 == 0, F.array(F.struct(F.lit("response").alias("field"), F.lit("WORTHLESS").alias("text"), F.lit("other").alias("category")))).alias("spans"))
    new, counts = V.marked(table(spark, sf, "documents").select(F.col("doc_id").alias("id"), F.col("text").alias("response")), flags, " Worthless ", "other")
    return new.select("id", "note", "text").crossJoin(F.broadcast(counts))  # one row


@query(f"""WITH {REASONS}, {FLAGS} SELECT id FROM flags WHERE id NOT IN (SELECT id FROM kept) AND id NOT IN (SELECT id FROM ex WHERE length(response) < 200)""")
def review_orphan_flags(spark, sf):
    rows = C.with_reason(_examples(spark, sf))
    return _flags(spark, sf).distinct().join(rows.where("reason is null"), "id", "left_anti").join(rows.where("reason = 'short'"), "id", "left_anti").select("id")


@query(f"WITH {FLAGS} SELECT 'documents' AS dataset, count(*) AS records, count(f.id) AS flagged FROM documents d LEFT JOIN flags f ON d.doc_id = f.id")
def review_dataset_info(spark, sf):
    rows = C.separate_flagged(table(spark, sf, "documents").select(F.col("doc_id").alias("id")), _flags(spark, sf))
    return rows.agg(F.lit("documents").alias("dataset"), F.count(F.lit(1)).alias("records"), F.count_if("flagged").alias("flagged"))


@query("SELECT doc_id AS id, substr(text, CAST(strpos(lower(text), 'worthless') AS INT), 9) AS span FROM documents WHERE contains(lower(text), 'worthless')")
def review_mark_phrase(spark, sf):
    """One phrase over all answers, with the spelling found."""
    rows = table(spark, sf, "documents").withColumn("at", F.instr(F.lower("text"), "worthless")).where("at > 0")
    return rows.select(F.col("doc_id").alias("id"), F.substring("text", F.col("at"), F.lit(9)).alias("span"))


@query("""SELECT doc_id AS id, count(*) FILTER (WHERE p) AS hits FROM (SELECT doc_id, unnest([regexp_matches(text, '[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\\.[A-Za-z]{2,}'), regexp_matches(text, '\\b(sk|ghp|AKIA)[-_A-Za-z0-9]{16,}'), regexp_matches(text, '(?i)(password|token)\\s*=')]) AS p FROM documents) GROUP BY doc_id HAVING hits > 0""")
def review_personal_data(spark, sf):
    patterns = [r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}", r"\b(sk|ghp|AKIA)[-_A-Za-z0-9]{16,}", r"(?i)(password|token)\s*="]
    hits = sum((F.col("text").rlike(p).cast("long") for p in patterns), F.lit(0).cast("long"))
    return table(spark, sf, "documents").select(F.col("doc_id").alias("id"), hits.alias("hits")).where("hits > 0")


@query("SELECT source, CAST(dense_rank() OVER (ORDER BY first) AS INT) AS number FROM (SELECT source, min(doc_id) AS first FROM documents GROUP BY source)")
def review_first_seen_numbers(spark, sf):
    first = table(spark, sf, "documents").groupBy("source").agg(F.min("doc_id").alias("first"))
    return first.select("source", F.dense_rank().over(Window.partitionBy().orderBy("first")).alias("number"))
