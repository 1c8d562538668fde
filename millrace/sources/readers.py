"""Readers of the file shapes that curation takes, as DataFrames."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions import fixed
from millrace.functions import markdown as M
from millrace.functions import text as T
from millrace.operators import corpus as C

RECORD = "id string, instruction string, response string, source string, origin string"
REQUEST = "at_ms long, who string, method string, path string, client string, user_agent string, model string, status int, limited boolean, first_byte_ms long, total_ms long, bytes long, input_tokens long, output_tokens long"
CHAT = "uuid string, chat_messages array<struct<sender:string,content:array<struct<type:string,text:string>>,attachments:array<struct<file_name:string,extracted_content:string>>,files:array<struct<file_name:string>>>>"


def jsonl(spark: SparkSession, path: str, schema: str, strict: bool = True) -> DataFrame:
    """JSON lines. Strict: a bad line is an error; else it is left out. A missing path is an empty table."""
    try:
        return spark.read.schema(schema).json(path, mode="FAILFAST" if strict else "DROPMALFORMED")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def chat_export(spark: SparkSession, path: str) -> DataFrame:
    """One JSON array of conversations: conv_id, turn, role, text of each message (its text blocks and the text of its attachments,
    joined by blank lines), hidden (blocks of other kinds, such as tool use) and files (names of files whose text is not there)."""
    rows = spark.read.schema(CHAT).json(path, multiLine=True).select("uuid", F.posexplode("chat_messages").alias("turn", "m"))
    shown = F.transform(F.filter(F.col("m.content"), lambda c: c["type"] == "text"), lambda c: T.strip(F.coalesce(c["text"], F.lit(""))))
    attached = F.transform(F.coalesce(F.col("m.attachments"), F.array()), lambda a: T.strip(F.coalesce(a["extracted_content"], F.lit(""))))
    parts = F.filter(F.concat(F.coalesce(shown, F.array().cast("array<string>")), attached), lambda t: t != "")
    hidden = F.size(F.filter(F.coalesce(F.col("m.content"), F.array()), lambda c: ~F.coalesce(c["type"] == "text", F.lit(False))))
    files = F.transform(F.coalesce(F.col("m.files"), F.array()), lambda f: f["file_name"])
    return rows.select(F.col("uuid").alias("conv_id"), (F.col("turn") + 1).alias("turn"), F.col("m.sender").alias("role"), F.array_join(parts, "\n\n").alias("text"), hidden.alias("hidden"), files.alias("files"))


def readability(spark: SparkSession, path: str) -> DataFrame:
    """Markdown entries parted by `---` lines: path, position, instruction, response. An unclosed comment runs to the end."""
    rows = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.regexp_replace("value", r"(?s)<!--.*?(?:-->|\z)", "").alias("value"))
    rows = rows.select("path", F.posexplode(F.split("value", "\n---\n")).alias("position", "entry"))
    part = lambda p: T.strip(F.regexp_extract("entry", p, 1))
    return rows.select("path", "position", part(r"(?s)### Instruction\n(.*?)\n### Response").alias("instruction"), part(r"(?s)### Response\n(.*)\z").alias("response")).where("instruction != '' and response != ''")


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """Tab-separated corpus manifest; rows of fewer than five columns are left out."""
    rows = spark.read.csv(path, sep="\t", header=True, quote="", schema="source string, kind string, commit string, licence_file string, licence string")
    return rows.where("licence is not null")


def question_files(spark: SparkSession, path: str) -> DataFrame:
    """`#Question` and `#Answer` parts of whole files: path, instruction, response."""
    rows = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), "value")
    part = lambda p: T.strip(F.regexp_extract("value", p, 1))
    return rows.select("path", part(r"(?s)#Question\n(.*?)\n#Answer\n").alias("instruction"), part(r"(?s)#Question\n.*?\n#Answer\n(.*)\z").alias("response")).where("instruction != '' and response != ''")


SFT = "messages array<struct<role:string,content:string>>, meta struct<id:string,task_type:string>"
DPO = "prompt array<struct<role:string,content:string>>, chosen array<struct<role:string,content:string>>, rejected array<struct<role:string,content:string>>, meta string"


def sft_records(rows: DataFrame) -> DataFrame:
    """id, instruction, response: the first user and assistant messages; `problem` is `empty turn` where one is missing or blank."""
    first = lambda role: F.get(F.filter("messages", lambda m: m["role"] == role), F.lit(0))["content"]
    rows = rows.select(F.col("meta.id").alias("id"), first("user").alias("instruction"), first("assistant").alias("response"))
    blank = (F.coalesce(T.strip(F.col("instruction")), F.lit("")) == "") | (F.coalesce(T.strip(F.col("response")), F.lit("")) == "")
    return rows.withColumn("problem", F.when(blank, "empty turn"))


def preference_pairs(spark: SparkSession, path: str) -> DataFrame:
    """Preference records as they are; a record of another shape is an error."""
    return spark.read.schema(DPO).json(path, mode="FAILFAST")


def run_records(spark: SparkSession, path: str, field: str = "text") -> DataFrame:
    """Lines of a scored run: id (their place), `text` from a field, `row` (the whole line, so unknown fields stay). A line without the field is an error."""
    rows = spark.read.text(path).where("trim(value) != ''")
    found = F.get_json_object("value", f"$.{field}")
    fine = F.coalesce(found, F.raise_error(F.concat(F.lit(f"no field {field} in: "), F.substring("value", 1, 200))).cast("string"))
    return rows.select(F.monotonically_increasing_id().alias("id"), fine.alias("text"), F.col("value").alias("row"))


def whole_files(spark: SparkSession, root: str) -> DataFrame:
    """path (below root), text of all files below a folder that are UTF-8; others are left out."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    base = F.regexp_replace(F.lit(root.rstrip("/")), r"^[a-z]+:/*", "/")
    below = F.substring(F.regexp_replace(F.url_decode(F.col("_metadata.file_path")), r"^[a-z]+:/*", "/"), F.length(base) + 2, F.lit(1 << 20))
    return files.select(below.alias("path"), F.try_validate_utf8(F.col("content").cast("string")).alias("text")).where("text is not null")


def book_repository(spark: SparkSession, root: str) -> DataFrame:
    """path, kind (chapter, notes, code), text of a book repository's files, ignored ones left out."""
    return whole_files(spark, root).withColumn("kind", M.path_kind(F.col("path"))).where("kind != 'ignored'").select("path", "kind", "text")


def book_folders(files: DataFrame) -> DataFrame:
    """source, folder of the book projects among files (source, path, text): a `book.toml` at most four folders deep, and its `src`."""
    toml = files.where((C.file_name(F.col("path")) == "book.toml") & (F.size(F.split("path", "/")) <= 5))
    named = F.regexp_extract("text", r'(?m)^\s*src\s*=\s*"([^"]*)"', 1)
    home = F.regexp_replace("path", r"/?[^/]*$", "")
    return toml.select("source", F.concat_ws("/", F.when(home != "", home), F.when(named != "", named).otherwise("src")).alias("folder"))


def code_sections(files: DataFrame, manifest: DataFrame) -> DataFrame:
    """Source files (path, text; the first folder is the source) of reusable code repositories, of a size that suits one lesson."""
    tag = F.create_map(*[F.lit(x) for pair in fixed.CODE_TAGS.items() for x in pair])
    rows = files.withColumns({"source": C.collection(F.col("path")), "language": F.try_element_at(tag, M.extension(F.col("path")))})
    rows = rows.where(F.col("language").isNotNull() & F.length("text").between(fixed.MIN_CODE_CHARS, fixed.MAX_CODE_CHARS) & ~F.col("path").rlike(r"(^|/)\.git/"))
    fine = manifest.where((F.col("kind") == "code") & T.permits_reuse(F.col("licence"))).select("source", "licence")
    return rows.join(F.broadcast(fine), "source").select(T.fnv1a(F.concat("path", F.lit("\n"), "text")).alias("id"), "source", F.col("path").alias("origin"), "licence", "text", "language")


def teacher_entries(spark: SparkSession, path: str) -> DataFrame:
    """origin (file#number), entry: the entries of markdown files, parted by `---` lines, blank ones left out."""
    rows = spark.read.text(path, wholetext=True).select(F.element_at(F.split("_metadata.file_path", "/"), -1).alias("file"), F.filter(F.split("value", "\n---\n"), lambda e: T.strip(e) != "").alias("e"))
    return rows.select("file", F.posexplode("e").alias("k", "entry")).select(F.concat("file", F.lit("#"), (F.col("k") + 1).cast("string")).alias("origin"), "entry")


def machine_readings(rows: DataFrame) -> DataFrame:
    """Memory (bytes), load and processor ticks out of the text of meminfo, loadavg and stat (columns of those names)."""
    kilobytes = lambda name: F.regexp_extract("meminfo", rf"(?m)^{name}:\s*(\d+)", 1).try_cast("bigint") * 1024
    ticks = F.transform(F.slice(F.split(F.regexp_extract("stat", r"(?m)^cpu\s+([\d ]+)$", 1), " +"), 1, 8), lambda x: x.try_cast("bigint"))
    total = F.aggregate(ticks, F.lit(0).cast("long"), lambda a, x: a + F.coalesce(x, F.lit(0)))
    idle = F.coalesce(F.get(ticks, F.lit(3)), F.lit(0)) + F.coalesce(F.get(ticks, F.lit(4)), F.lit(0))
    keep = [c for c in rows.columns if c not in ("meminfo", "loadavg", "stat")]
    return rows.select(*keep, kilobytes("MemTotal").alias("memory_total"), kilobytes("MemAvailable").alias("memory_available"), F.split_part("loadavg", F.lit(" "), F.lit(1)).try_cast("double").alias("load"), (total - idle).alias("busy_ticks"), total.alias("total_ticks"))
