"""Corpus walks, teachable sections, plans of conversations, and flags from suggestions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions import fixed
from millrace.functions import markdown as M
from millrace.functions import text as T


def starts_with_any(text: Column, heads: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.startswith(text, F.lit(h)) for h in heads])


def file_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def is_prose(source: Column, path: Column) -> Column:
    """A markdown file of a source that is no table of contents, and not in a tree that is left out."""
    name = file_name(path)
    readme = (name == "README.md") & source.isin(fixed.README_IS_CONTENT)
    fine = M.extension(name).isin("md", "markdown") & (~name.isin(fixed.NAVIGATION_FILES) | readme)
    return fine & ~starts_with_any(F.concat_ws("/", source, path), fixed.SKIPPED_TREES)


def prose_files(files: DataFrame, books: DataFrame) -> DataFrame:
    """source, path: prose below a source's book folders (books: source, folder), or below its listed folders, once each."""
    listed = files.sparkSession.createDataFrame(fixed.PLAIN_SOURCES, "source string, folder string")
    roots = books.select("source", "folder").unionByName(listed).distinct()
    inside = (F.col("folder") == "") | F.startswith("path", F.concat("folder", F.lit("/")))
    return files.join(roots, "source").where(inside & is_prose(F.col("source"), F.col("path"))).select("source", "path").distinct()


def with_licence(sections: DataFrame, manifest: DataFrame) -> DataFrame:
    """Sections (kind, source) with their source's licence; unknown if the manifest has none, the author's own for books."""
    known = manifest.select("source", F.col("licence").alias("found")).dropDuplicates(["source"])
    licence = F.when(F.col("kind") == "corpus", F.coalesce("found", F.lit("unknown"))).otherwise("author's own")
    return sections.join(known, "source", "left").withColumn("licence", licence).drop("found")


def pick(sections: DataFrame, used: DataFrame, each: int) -> DataFrame:
    """Of each source the first `each` teachable sections by id that are not used yet."""
    from .curate import first_per_group, teachable

    return first_per_group(teachable(sections).join(used.select("id"), "id", "left_anti"), "source", ["id"], each)


def queue_entry(origin: Column, id_: Column, licence: Column, text: Column) -> Column:
    return F.concat(F.lit("## "), origin, F.lit("\n\n<!-- source: "), origin, F.lit("; section: "), id_, F.lit("; licence: "), licence, F.lit(" -->\n\n"), F.substring(text, 1, fixed.MAX_QUEUE_CHARS), F.lit("\n\n"))


def reads_as_answer(text: Column) -> Column:
    return ~T.any_of(F.lower(text), fixed.BOOK_REFERENCES)


def answer(text: Column) -> Column:
    """A section without the headings and blank lines that open it."""
    return T.strip(F.array_join(M.from_first(M.lines(text), lambda x: ~F.startswith(x, F.lit("#")) & ~M.is_blank(x)), "\n"))


def collection(origin: Column) -> Column:
    return F.split_part(origin, F.lit("/"), F.lit(1))


def plan(passages: DataFrame, turns: int) -> DataFrame:
    """passages (seq, origin, ...) with `chapter` (a run of one origin), `part` (from 0) and `turn` (from 0), `turns` to a part at most.

    Runs are numbered by range: each part of the sorted table counts its own changes of origin, and is given those before it."""
    from .curate import runs

    rows = runs(passages, "origin", "seq")
    return rows.select(*passages.columns, F.col("run").alias("chapter"), F.floor(F.col("place") / turns).cast("int").alias("part"), F.pmod("place", F.lit(turns)).cast("int").alias("turn"))


def plan_counts(planned: DataFrame) -> DataFrame:
    per = planned.groupBy(collection(F.col("origin")).alias("collection"), "chapter", "part").agg(F.count(F.lit(1)).alias("n"))
    return per.groupBy("collection").agg(F.count(F.lit(1)).alias("conversations"), F.sum("n").alias("turns"))


def conversation_keys(planned: DataFrame) -> DataFrame:
    """chapter, part, key: the stable key of each planned conversation, from its first section's origin and first 200 characters."""
    return planned.where("turn = 0").select("chapter", "part", T.fnv1a(F.concat("origin", F.lit("\n"), F.substring("text", 1, 200))).alias("key"))


def reason(rule: Column, category: Column, source: Column, match: Column, field: Column) -> Column:
    quoted = F.concat(F.lit('"'), F.replace(F.replace(match, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"')), F.lit('"'))
    return F.concat(rule, F.lit(" ["), category, F.lit("] in "), source, F.lit(" matched "), quoted, F.lit(" in "), field)


def applied(suggestions: DataFrame, flags: DataFrame) -> DataFrame:
    """id, note: one flag for each suggested id (position, id, reason) without a flag; its note lists the reasons in order."""
    new = suggestions.join(flags.select("id").distinct(), "id", "left_anti")
    listed = F.transform(F.array_sort(F.collect_list(F.struct("position", "reason"))), lambda x: x["reason"])
    return new.groupBy("id").agg(F.concat(F.lit(f"{fixed.AUTO_NOTE} "), F.array_join(listed, "; ")).alias("note"))


def with_flag(flags: DataFrame, changes: DataFrame) -> DataFrame:
    """Flags after changes by id: a row with a null note clears the flag, any other sets it; sorted by id."""
    kept = flags.join(changes.select("id"), "id", "left_anti")
    return kept.unionByName(changes.where("note is not null").select(*flags.columns)).orderBy("id")


def is_reviewed(note: Column, spans: Column) -> Column:
    return ~(F.startswith(note, F.lit(fixed.AUTO_NOTE)) & (spans == 0))


def humanized(name: Column) -> Column:
    spaced = F.translate(name, "-_", "  ")
    return F.concat(F.upper(F.substring(spaced, 1, 1)), F.substring(spaced, 2, 1 << 30))


def source_title(source: Column) -> Column:
    known = F.create_map(*[F.lit(x) for pair in fixed.SOURCE_TITLES.items() for x in pair])
    return F.coalesce(F.try_element_at(known, source), humanized(source))


def shortened(text: Column, most: int) -> Column:
    """The whole lines within `most` characters; a first line that is longer is cut."""
    head = F.substring(text, 1, most)
    end = F.length(head) - F.locate("\n", F.reverse(head))
    return F.when(F.contains(head, F.lit("\n")) & (end > 0), F.substring(head, F.lit(1), end)).otherwise(head)


def valid_name(name: Column) -> Column:
    bare = T.strip(name)
    return (bare != "") & (F.length(bare) <= fixed.MAX_NAME) & ~bare.rlike(r"[\x00-\x1f\x7f-\x9f]")


def valid_email(email: Column) -> Column:
    bare = T.strip(email)
    local, domain = F.regexp_extract(bare, "^([^@]*)@", 1), F.regexp_extract(bare, "^[^@]*@(?s)(.*)$", 1)
    fine = (bare != "") & (F.octet_length(bare) <= fixed.MAX_EMAIL) & ~bare.rlike(r"(?U)\s") & (local != "")
    return fine & (F.octet_length(domain) >= 3) & F.contains(domain, F.lit(".")) & ~F.startswith(domain, F.lit(".")) & ~F.endswith(domain, F.lit("."))


def entry_parts(entries: DataFrame) -> DataFrame:
    """Teacher entries (origin, entry) with source, section, licence, turns (role, content), rejected and error, the first thing wrong.

    Headings split an entry into (heading, content); everything else is read off that array."""
    head = F.regexp_extract("entry", r"(?s)\A\s*<!-- source:(.*?)-->", 1)
    found = F.col("entry").rlike(r"(?s)\A\s*<!-- source:.*?-->")
    body = F.regexp_replace("entry", r"(?s)\A\s*<!-- source:.*?-->", "")
    mark = r"(?dm)^### (?:User|Assistant|Rejected)[^\S\n]*$"
    names = F.transform(F.regexp_extract_all(body, F.lit(mark), F.lit(0)), lambda h: F.lower(F.trim(F.substring(h, 5, 20))))
    texts = F.transform(F.slice(F.split(body, mark), 2, 1 << 30), T.strip)
    parts = F.arrays_zip(names.alias("role"), texts.alias("content"))
    rows = entries.withColumns({"parts": parts, "head": head, "found": found})
    last = F.try_element_at("parts", F.lit(-1))
    rows = rows.withColumn("rejected", F.when(last["role"] == "rejected", last["content"]))
    rows = rows.withColumn("turns", F.when(F.col("rejected").isNotNull(), F.slice("parts", 1, F.size("parts") - 1)).otherwise(F.col("parts")))
    ordered = F.forall(F.transform("turns", lambda t, i: t["role"] == F.when(i % 2 == 0, "user").otherwise("assistant")), lambda x: x)
    error = (
        F.when(~F.col("found"), "no source").when(F.exists("turns", lambda t: t["role"] == "rejected"), "rejected not last").when(F.size("turns") == 0, "no turns")
        .when(~ordered, "out of order").when(F.try_element_at("turns", F.lit(-1))["role"] == "user", "ends with user")
        .when(F.exists("parts", lambda t: t["content"] == ""), "empty section")
    )
    key = lambda k: F.when(F.col("head").rlike(rf";\s*{k}\s*:"), F.trim(F.regexp_extract("head", rf";\s*{k}\s*:([^;]*)", 1)))
    return rows.select(*entries.columns, F.trim(F.split_part("head", F.lit(";"), F.lit(1))).alias("source"), key("section").alias("section"), key("licence").alias("licence"), "turns", "rejected", error.alias("error"))


def teacher_totals(parsed: DataFrame) -> DataFrame:
    """Counts over the entries without an error; tokens: all characters summed, then divided."""
    chars = F.aggregate("turns", F.lit(0), lambda a, t: a + F.length(t["content"]))
    return parsed.where("error is null").agg(
        F.count(F.lit(1)).alias("passed"), F.sum(F.size("turns")).alias("turns"), F.count_if(F.size("turns") > 2).alias("multi_turn"), F.count("section").alias("grounded"), F.count("rejected").alias("pairs"), F.floor(F.sum(chars) / 4).cast("long").alias("tokens")
    )


def with_sections(parsed: DataFrame, sections: DataFrame) -> DataFrame:
    """Entries with `found`, the section (id, source, origin, licence, text) that each names; one that names a section that is not there is
    an error, unless another thing is wrong with it before. Repeated section ids count once."""
    known = sections.where(F.col("id").isNotNull()).groupBy(F.col("id").alias("section")).agg(F.min(F.struct("source", "origin", "licence", "text")).alias("found"))
    out = parsed.join(known, "section", "left")
    missing = F.when(F.col("section").isNotNull() & F.col("found").isNull(), "unknown section")
    return out.withColumn("error", F.coalesce("error", missing))


def conversations_by_source(checked: DataFrame) -> DataFrame:
    """source, conversations of the entries without an error; those without a section are the teacher's own."""
    name = F.coalesce("found.source", F.lit("written by the teacher"))
    return checked.where("error is null").groupBy(name.alias("source")).agg(F.count(F.lit(1)).alias("conversations"))


def blocks_by_language(parsed: DataFrame) -> DataFrame:
    """language, blocks, entries: fenced code in the answers of the entries without an error."""
    answers = parsed.where("error is null").select("origin", F.explode(F.filter("turns", lambda t: t["role"] == "assistant")).alias("t"))
    blocks = answers.select("origin", F.explode(M.fenced_blocks(F.col("t.content"))).alias("b"))
    return blocks.groupBy("b.language").agg(F.count(F.lit(1)).alias("blocks"), F.countDistinct("origin").alias("entries"))


def chat_lines(checked: DataFrame) -> DataFrame:
    """The training lines of the entries without an error: origin and licence from the section where the entry has none of its own."""
    return checked.where("error is null").select(
        F.coalesce("found.origin", "origin").alias("origin"), F.col("origin").alias("entry"), F.col("source").alias("based_on"), "section", F.coalesce("licence", "found.licence").alias("licence"), F.col("found.text").alias("source_text"), F.col("turns").alias("messages"), "rejected",
    )


def widened(query: Column, kind: Column) -> Column:
    """A search query and, for jobs and people, each angle that it does not name; at most MAX_QUERIES."""
    low = F.lower(query)
    many = {k: F.filter(F.array(query, *[F.when(~F.contains(low, F.lit(word)), F.concat(query, F.lit(f" {angle}"))) for angle, word in angles]), lambda x: x.isNotNull()) for k, angles in fixed.ANGLES.items()}
    out = F.array(query)
    for k, made in many.items():
        out = F.when(kind == k, F.slice(made, 1, fixed.MAX_QUERIES)).otherwise(out)
    return out


def search_plan(queries: Column, kind: Column) -> Column:
    """Trimmed distinct queries in order, each widened, distinct again, at most MAX_QUERIES."""
    base = F.array_distinct(F.filter(F.transform(queries, T.strip), lambda q: q != ""))
    return F.slice(F.array_distinct(F.flatten(F.transform(base, lambda q: widened(q, kind)))), 1, fixed.MAX_QUERIES)



def raw_matches(rows: DataFrame, needle: str) -> DataFrame:
    """Rows whose whole JSON line holds the needle, plain or as JSON writes it, in any case; keys and other fields count."""
    raw, low = F.lower(F.to_json(F.struct(*rows.columns), {"ignoreNullFields": "false"})), needle.lower()
    escaped = low.replace("\\", "\\\\").replace('"', '\\"').replace("\n", "\\n").replace("\t", "\\t")
    return rows.where(F.contains(raw, F.lit(low)) | F.contains(raw, F.lit(escaped)))


#: Patterns of personal data and secrets, ours: the survey's source names the kinds only.
PERSONAL = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}", "phone": r"\+\d{1,3}[ -]\d{2,4}[ -]\d{3,4}[ -]?\d{2,4}\b", "key": r"\b(?:sk|ghp|AKIA)[-_A-Za-z0-9]{16,}",
    "private key": r"-----BEGIN [A-Z ]*PRIVATE KEY-----", "password": r"(?i)(?:password|token)\s*=", "bearer": r"(?i)\bbearer\s+[A-Za-z0-9._-]{16,}",
}


def personal_kinds(text: Column) -> Column:
    return F.array_compact(F.array(*[F.when(text.rlike(p), F.lit(k)) for k, p in PERSONAL.items()]))


def without_repeats(items: Column) -> Column:
    """Of following equal items, the first."""
    return F.filter(items, lambda x, i: (i == 0) | ~x.eqNullSafe(F.get(items, i - 1)))


def cut(text: Column, most: int, mark: str = "\n[cut]") -> Column:
    """At most `most` characters, ended at a line, with a mark if something is missing."""
    return F.when(F.length(text) > most, F.concat(shortened(text, most), F.lit(mark))).otherwise(text)


def settings(text: Column) -> Column:
    """KEY=value lines as a map; comments, blank lines and quotes around values go; the last of a key counts."""
    lines = F.filter(F.transform(F.split(text, "\n"), T.strip), lambda x: F.contains(x, F.lit("=")) & ~F.startswith(x, F.lit("#")))
    pairs = F.transform(lines, lambda x: F.struct(F.trim(F.split_part(x, F.lit("="), F.lit(1))).alias("k"), F.regexp_replace(F.trim(F.regexp_replace(x, "^[^=]*=", "")), "^[\"']|[\"']$", "").alias("v")))
    last = F.filter(pairs, lambda p, i: ~F.exists(F.slice(pairs, i + 2, F.size(pairs)), lambda q: q["k"] == p["k"]))
    return F.map_from_entries(last)


def page_bounds(start: Column, limit: Column, total: Column) -> Column:
    """start and limit of a page from request parameters as text: what is no number is as if not sent."""
    n = F.least(F.greatest(F.coalesce(limit.try_cast("int"), F.lit(20)), F.lit(1)), F.lit(100))
    return F.struct(F.least(F.greatest(F.coalesce(start.try_cast("int"), F.lit(0)), F.lit(0)), total).alias("start"), n.alias("limit"))
