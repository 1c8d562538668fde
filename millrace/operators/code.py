"""Rules for Rust code over a table of tokens, one row a token.

Brackets are matched by prefix sums: a token's level is the number of brackets open around it, its encloser the bracket itself, and
tokens of one encloser are siblings. Bodies of functions and loops are intervals between a bracket and its partner; whether something
lies in one of many is asked of the largest end among the intervals that began before it, so no pairs are made. What functions return,
types stand for and traits are implemented for is gathered into small tables of names a block and joined on them.

It is a table of tokens, not of a syntax tree: macros are seen as far as their arguments read like code.

Defined cases: rows of blocks with a null code have no tokens but the last and hold nothing; a block whose brackets or literals do not
close is not parsed, and every verdict of it is n/a; (id, block) must be unique; an empty table gives no rows.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as Y

from millrace.functions import rust_lexer
from millrace.functions.answers import RULES

from .scratch import kept

# Crates whose use means that errors are handled, and error types of libraries.
ERROR_CRATES = ["anyhow", "thiserror", "eyre", "color_eyre", "snafu"]
LIBRARY_ERRORS = ["io::Error", "fmt::Error", "ParseIntError", "ParseFloatError", "ParseBoolError", "Utf8Error", "FromUtf8Error", "TryFromIntError", "VarError"]
_ITEMS = ["fn", "struct", "enum", "trait", "type", "const", "static", "mod", "union"]
_STARTS = [*_ITEMS, "pub", "use", "impl", "async", "unsafe", "extern", "macro_rules", "#", "default"]
_NO_VALUE = ["in", "return", "match", "if", "else", "mut", "let", "as", "break", "move", "ref", "while", "for", "const", "dyn", "impl", "where", "pub", "static"]
_OPERATORS = ["+", "-", "*", "/", "%", "|", "&", "^", "<", ">", "as", "==", "!=", "<=", "&&", "||"]
KEY = ["id", "block"]


def tokens(blocks: DataFrame) -> DataFrame:
    """(id, block, pos, line, kind, text) of the tokens of blocks (id, block, code)."""
    kind = blocks.schema["id"].dataType

    def lex(batches):
        for b in batches:
            rows, out = [], ([], [], [], [])
            for i, code in enumerate(b.column("code").to_pylist()):
                lines, kinds, texts = rust_lexer.tokens(code or "")
                rows += [i] * len(lines)
                for column, more in zip(out, (range(len(lines)), lines, kinds, texts)):
                    column.extend(more)
            at = pa.array(rows, pa.int64())
            yield pa.record_batch({"id": b.column("id").take(at), "block": b.column("block").take(at), "pos": pa.array(out[0], pa.int32()), "line": pa.array(out[1], pa.int32()), "kind": pa.array(out[2], pa.string()), "text": pa.array(out[3], pa.string())})

    made = Y.StructType([Y.StructField("id", kind), Y.StructField("block", Y.IntegerType()), Y.StructField("pos", Y.IntegerType()), Y.StructField("line", Y.IntegerType()), Y.StructField("kind", Y.StringType()), Y.StructField("text", Y.StringType())])
    return blocks.select("id", F.col("block").cast("int").alias("block"), "code").mapInArrow(lex, made)


def _text(*words: str) -> Column:
    return F.col("text").isin(*words)


def nested(found: DataFrame) -> DataFrame:
    """Tokens with level, encloser (the pos of the bracket around them, -1 outside), closer (of a bracket: its partner's pos), sibling
    look-ups, and the texts of the tokens before and after. Comments keep their places but are no one's neighbours."""
    opens, closes, remark = _text("(", "[", "{"), _text(")", "]", "}"), F.col("kind").isin("note", "doc", "inner")
    along = Window.partitionBy(*KEY).orderBy("pos")
    so_far = along.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    depth = F.sum(F.when(opens, 1).when(closes, -1).otherwise(0)).over(so_far)
    out = found.withColumn("depth", depth.cast("int")).withColumn("level", F.col("depth") - opens.cast("int"))
    # each bracket stands once more, inside itself, so that the last one of a level is the one around what follows
    marks = F.when(opens, F.array(F.struct(F.lit(False).alias("mark"), "level"), F.struct(F.lit(True).alias("mark"), (F.col("level") + 1).alias("level")))).otherwise(F.array(F.struct(F.lit(False).alias("mark"), "level")))
    out = out.withColumn("m", F.explode(marks)).withColumn("mark", F.col("m.mark")).withColumn("level", F.col("m.level")).drop("m")
    inside = Window.partitionBy(*KEY, "level").orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = out.withColumn("encloser", F.coalesce(F.last(F.when(F.col("mark"), F.col("pos")), ignorenulls=True).over(inside), F.lit(-1))).where(~F.col("mark")).drop("mark")
    # siblings from the end, so that the next of a kind is the last one seen
    back = Window.partitionBy(*KEY, "encloser").orderBy(F.desc("pos")).rowsBetween(Window.unboundedPreceding, -1)
    ahead = lambda when, *what: F.last(F.when(when, F.struct(*what) if len(what) > 1 else F.col(what[0])), ignorenulls=True).over(back)
    out = out.withColumn("partner", F.when(opens, ahead(closes, "pos", "text"))).withColumn("closer", F.col("partner.pos"))
    out = out.withColumns({
        "stop": ahead(_text("{", ";"), "pos", "text", "closer"), "arrow": ahead(_text("->"), "pos"), "where_at": ahead(_text("where"), "pos"), "in_at": ahead(_text("in"), "pos"), "comma": ahead(_text(","), "pos"),
        "operator": ahead(_text(*_OPERATORS), "pos"),
    })
    out = out.withColumn("range", ahead(_text("..", "..="), "pos", "operator"))
    plain = Window.partitionBy(*KEY, "remark").orderBy("pos")
    out = out.withColumn("remark", remark)
    near = {f"p{k}": F.when(~remark, F.lag("text", k).over(plain)) for k in range(1, 5)} | {f"n{k}": F.when(~remark, F.lead("text", k).over(plain)) for k in range(1, 4)}
    near |= {"pk": F.lag("kind").over(plain), "nk": F.lead("kind").over(plain), "item": F.when(_text("["), ahead(F.col("kind").eqNullSafe("id") & _text(*_ITEMS, "impl", "use", "let"), "text", "n1"))}
    first = {k: v for k, v in near.items() if k != "item"}
    return out.withColumns(first).withColumn("item", near["item"])


@F.arrow_udf(Y.StructType([Y.StructField("kind", Y.StringType()), Y.StructField("name", Y.StringType()), Y.StructField("to", Y.StringType())]))
def _read(region: pa.Array, words: pa.Array) -> pa.Array:
    """What a region's tokens say: the error of a result type, or the trait (name) and type (to) of an implementation."""
    out = []
    for r, w in zip(region.to_pylist(), words.to_pylist()):
        found = rust_lexer.implementation(w) if r == "impl" else rust_lexer.error_of_result(w)
        out.append(None if found is None else {"kind": None, "name": found[0], "to": found[1]} if r == "impl" else {"kind": found[0], "name": found[1], "to": None})
    return pa.array(out, pa.struct([("kind", pa.string()), ("name", pa.string()), ("to", pa.string())]))


def _inside(places: DataFrame, intervals: DataFrame) -> DataFrame:
    """Of places (key, pos, …) those strictly inside one of intervals (key, pos, closer), by the largest end begun before each."""
    both = places.withColumn("closer", F.lit(None).cast("int")).unionByName(intervals.select(*KEY, "pos", "closer"), allowMissingColumns=True)
    reach = F.max("closer").over(Window.partitionBy(*KEY).orderBy("pos", F.col("closer").isNull()).rowsBetween(Window.unboundedPreceding, -1))
    return both.withColumn("reach", reach).where(F.col("closer").isNull() & (F.col("reach") > F.col("pos"))).drop("closer", "reach")


def index_loops(t: DataFrame) -> DataFrame:
    """(key, line) of `for` loops over a range that ends with a length, or whose variable stands in an index of the body."""
    at = F.col("in_at") + 1
    loops = t.where((F.col("text") == "for") & (F.col("kind") == "id") & (F.col("n1") != "<") & (F.col("stop.text") == "{") & (F.col("in_at") < F.col("stop.pos")))
    loops = loops.select(*KEY, "pos", "line", F.when((F.col("n2") == "in") & (F.col("nk") == "id"), F.col("n1")).when((F.col("n3") == "in") & F.col("n1").isin("mut", "ref"), F.col("n2")).alias("name"),
                         F.col("stop.pos").alias("open"), F.col("stop.closer").alias("close"), at.alias("head"), F.when((F.col("range.pos") > F.col("in_at")) & (F.col("range.pos") < F.col("stop.pos")), F.col("range")).alias("range"))
    # ranges in brackets that the head begins with, as in (0..n).rev(): by the bracket that encloses them
    bracket = t.where(_text("..", "..=")).groupBy(*KEY, F.col("encloser").alias("head")).agg(F.min(F.struct("pos", "operator")).alias("inner"))
    ends = t.where(_text("{", ")") & (F.col("p1") == ")") & (F.col("p2") == "(") & (F.col("p3") == "len") & (F.col("p4") == ".")).select(*KEY, F.col("pos").alias("end"))
    round_ = t.where((F.col("text") == "(")).select(*KEY, F.col("pos").alias("head"), F.col("closer").alias("head_end"))
    loops = loops.join(bracket.join(round_, [*KEY, "head"]), [*KEY, "head"], "left").withColumn("walk", F.coalesce("range", "inner")).where(F.col("walk").isNotNull())
    loops = loops.withColumn("end", F.when(F.col("range").isNotNull(), F.col("open")).otherwise(F.col("head_end"))).join(ends.withColumn("length", F.lit(True)), [*KEY, "end"], "left")
    to_length = F.coalesce(F.col("length"), F.lit(False)) & (F.col("walk.operator").isNull() | (F.col("walk.operator") > F.col("end")))
    value = (F.col("pk").isin("id", "lit") & ~F.col("p1").isin(_NO_VALUE)) | F.col("p1").isin(")", "]", "?")
    indices = t.where(_text("[") & value).select(*KEY, "pos", "closer")
    words = t.where((F.col("kind") == "id") & ~F.coalesce(F.col("p1").isin(".", "::"), F.lit(False)) & ~F.coalesce(F.col("n1") == "::", F.lit(False)))
    used = _inside(words.select(*KEY, "pos", F.col("text").alias("name")), indices).withColumn("used", F.col("pos"))
    # the next use of each name after a loop's body begins
    asked = loops.select(*KEY, "line", "name", F.col("open").alias("pos"), "close", to_length.alias("to_length"), F.lit(True).alias("loop"))
    both = asked.unionByName(used, allowMissingColumns=True)
    later = F.last("used", ignorenulls=True).over(Window.partitionBy(*KEY, "name").orderBy(F.desc("pos")).rowsBetween(Window.unboundedPreceding, -1))
    indexed = F.col("name").isNotNull() & F.coalesce(later < F.col("close"), F.lit(False))
    return both.withColumn("indexed", indexed).where(F.col("loop") & (F.col("to_length") | F.col("indexed"))).select(*KEY, "line")


def error_facts(t: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Violations (key, line, detail) of the rule on error enums, and the blocks (key) that handle errors."""
    named = lambda what: t.where((F.col("text") == what) & (F.col("kind") == "id") & (F.col("nk") == "id")).select(*KEY, F.col("n1").alias("name")).distinct()
    enums, structs = named("enum"), named("struct")
    # regions whose words are read: types of results, aliases and implementations; none lies in another
    after = F.least(F.col("stop.pos"), F.coalesce(F.when(F.col("where_at") > F.col("arrow"), F.col("where_at")), F.col("stop.pos")))
    returns = t.where((F.col("text") == "fn") & (F.col("nk") == "id") & (F.col("arrow") < F.col("stop.pos"))).select(*KEY, F.col("arrow").alias("from"), after.alias("to"), "line", F.lit("return").alias("region"), F.col("n1").alias("own"), "encloser")
    impls = t.where((F.col("text") == "impl") & (F.col("stop.text") == "{") & ~F.coalesce(F.col("p1").isin("->", ":", "<", ",", "(", "&", "mut", "="), F.lit(False)))
    impls = impls.select(*KEY, F.col("pos").alias("from"), F.col("stop.pos").alias("to"), "line", F.lit("impl").alias("region"), F.lit(None).cast("string").alias("own"), F.col("stop.pos").alias("body"))
    back = Window.partitionBy(*KEY, "encloser").orderBy(F.desc("pos")).rowsBetween(Window.unboundedPreceding, -1)
    equals = t.withColumn("equals", F.last(F.when(_text("="), F.col("pos")), ignorenulls=True).over(back)).where((F.col("text") == "type") & (F.col("nk") == "id") & (F.col("stop.text") == ";") & (F.col("equals") < F.col("stop.pos")))
    aliases = equals.select(*KEY, F.col("equals").alias("from"), F.col("stop.pos").alias("to"), "line", F.lit("alias").alias("region"), F.col("n1").alias("own"), "encloser")
    regions = returns.unionByName(impls, allowMissingColumns=True).unionByName(aliases, allowMissingColumns=True)
    begun = t.where(~F.col("remark")).select(*KEY, "pos", "text").unionByName(regions.select(*KEY, F.col("from").alias("pos"), F.struct("from", "to").alias("r")), allowMissingColumns=True)
    open_ = F.last("r", ignorenulls=True).over(Window.partitionBy(*KEY).orderBy("pos", F.col("r").isNull()).rowsBetween(Window.unboundedPreceding, Window.currentRow))
    words = begun.withColumn("r", open_).where(F.col("text").isNotNull() & (F.col("pos") > F.col("r.from")) & (F.col("pos") < F.col("r.to")))
    words = words.groupBy(*KEY, F.col("r.from").alias("from")).agg(F.transform(F.sort_array(F.collect_list(F.struct("pos", "text"))), lambda x: x["text"]).alias("words"))
    read = kept(regions.join(words, [*KEY, "from"]).withColumn("said", _read("region", "words")).where(F.col("said").isNotNull()).select(*KEY, "line", "region", "own", "encloser", "body", "said.*"), "regions")
    heads = read.where(F.col("region") == "impl").select(*KEY, F.col("body").alias("encloser"), F.lit(True).alias("of_trait"))
    outside = read.where(F.col("region") != "impl").join(heads, [*KEY, "encloser"], "left").where(F.col("of_trait").isNull())
    returned = outside.where(F.col("region") == "return").select(*KEY, "line", "kind", "name")
    alias = outside.where(F.col("region") == "alias").groupBy(*KEY, F.col("own").alias("name")).agg(F.max(F.struct("kind", F.col("name").alias("real"))).alias("alias"))
    # traits by their own names, and what #[derive(Error)] implements
    renames = t.where((F.col("kind") == "id") & (F.col("n1") == "as")).select(*KEY, "pos", "text", F.col("n2").alias("trait"))
    uses = t.where((F.col("text") == "use") & (F.col("kind") == "id")).select(*KEY, "pos", F.col("stop.pos").alias("closer"), F.coalesce(F.when(F.col("n1") == "::", F.col("n2")), F.col("n1")).alias("root"))
    renames = _inside(renames, uses).groupBy(*KEY, "trait").agg(F.max("text").alias("real"))
    derives = t.where((F.col("text") == "[") & (F.col("p1") == "#") & (F.col("n1") == "derive") & F.col("item.text").isin("struct", "enum")).select(*KEY, "pos", "closer", "line", F.col("item.n1").alias("type"))
    last = t.where((F.col("text") == "Error") & F.col("n1").isin(",", ")")).select(*KEY, "pos")
    marks = last.unionByName(derives.withColumn("d", F.struct("closer", "line", "type")).select(*KEY, "pos", "d"), allowMissingColumns=True)
    owner = F.last("d", ignorenulls=True).over(Window.partitionBy(*KEY).orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    derived = marks.withColumn("o", owner).where(F.col("d").isNull() & (F.col("o.closer") > F.col("pos"))).select(*KEY, "o.line", "o.type").distinct()
    impl = read.where(F.col("region") == "impl").select(*KEY, "line", F.col("name").alias("trait"), F.col("to").alias("type")).join(renames, [*KEY, "trait"], "left").select(*KEY, "line", F.coalesce("real", "trait").alias("trait"), "type")
    impl = impl.unionByName(derived.withColumn("trait", F.explode(F.array(F.lit("Display"), F.lit("Error")))))
    errors = impl.where(F.col("trait") == "Error")
    as_struct = errors.join(structs.withColumnRenamed("name", "type"), [*KEY, "type"]).select(*KEY, "line", F.concat("type", F.lit(" is a struct, not an enum")).alias("detail"))
    # each returned error, through one alias, and what is wrong with it
    real = returned.join(alias, [*KEY, "name"], "left").withColumn("to", F.when((F.col("kind") == "named") & F.col("alias").isNotNull(), F.struct(F.col("alias.kind").alias("kind"), F.col("alias.real").alias("name"))).otherwise(F.struct("kind", "name")))
    real = real.select(*KEY, "line", "to.kind", "to.name")
    has = impl.where(F.col("trait").isin("Display", "Error")).groupBy(*KEY, F.col("type").alias("name")).agg(F.sort_array(F.collect_set("trait")).alias("has"))
    real = real.join(enums.withColumn("is_enum", F.lit(True)), [*KEY, "name"], "left").join(structs.withColumn("is_struct", F.lit(True)), [*KEY, "name"], "left").join(has, [*KEY, "name"], "left")
    missing = F.array_except(F.array(F.lit("Display"), F.lit("Error")), F.coalesce("has", F.array().cast("array<string>")))
    detail = (
        F.when(F.col("kind") == "text", F.concat(F.lit("returns Result<_, "), "name", F.lit(">")))
        .when(F.col("kind") == "boxed", "returns Result<_, Box<dyn Error>>")
        .when(F.col("is_enum"), F.when(F.size(missing) > 0, F.concat("name", F.lit(" does not implement "), F.array_join(missing, " or "))))
        .when(F.col("is_struct"), F.concat("name", F.lit(" is a struct, not an enum")))
        .when(F.col("name").isin(LIBRARY_ERRORS), F.concat(F.lit("returns the library error "), "name", F.lit(", not a custom enum")))
    )
    bad = real.withColumn("detail", detail).where(F.col("detail").isNotNull()).groupBy(*KEY, "detail").agg(F.min("line").alias("line")).select(*KEY, "line", "detail")
    crates = uses.where(F.col("root").isin(ERROR_CRATES)).select(*KEY).unionByName(t.where(_text("anyhow", "bail") & (F.col("n1") == "!")).select(*KEY)).unionByName(derived.select(*KEY))
    handles = crates.unionByName(returned.select(*KEY)).unionByName(errors.select(*KEY)).distinct()
    return as_struct.unionByName(bad), handles


def code_rules(blocks: DataFrame) -> DataFrame:
    """(id, block, parsed, verdicts: map of pass, fail, n/a by rule, violations: rule, line, detail) of blocks (id, block, code)."""
    t = kept(nested(tokens(blocks)), "tokens")
    end = F.col("kind") == "end"
    opens = _text("(", "[", "{")
    pair = F.when(F.col("text") == "(", ")").when(F.col("text") == "[", "]").when(F.col("text") == "{", "}")
    wrong = (end & ((F.col("text") == "error") | (F.col("depth") != 0))) | (F.col("depth") < 0) | (opens & ~F.coalesce(F.col("partner.text") == pair, F.lit(False)))
    # a file holds items only: outside brackets, what follows a beginning, a semicolon or a closing brace begins one
    begins = (F.col("encloser") == -1) & ~F.col("remark") & ~end & (F.col("p1").isNull() | F.col("p1").isin(";", "}"))
    stray = begins & ~(F.col("text").isin(_STARTS) | (F.col("n1") == "!"))
    fn_body = (F.col("text") == "fn") & (F.col("nk") == "id") & (F.col("stop.text") == "{")
    item = (F.col("text") == "pub") & (F.col("n1") != "(")
    qualified = F.coalesce(*[F.when(F.col(c).isin(_ITEMS) & (F.col(c) != "const"), F.lit(True)) for c in ("n1", "n2", "n3")], F.col("n1") == "const")
    public = item & qualified & F.col("n1").isin(*_ITEMS, "async", "unsafe", "extern") & ~((F.col("n1") == "mod") & (F.col("n3") == ";"))
    per = t.groupBy(*KEY).agg(
        (~F.bool_or(F.coalesce(wrong, F.lit(False)))).alias("parsed"), (~F.bool_or(F.coalesce(stray, F.lit(False)))).alias("whole"), F.bool_or(F.coalesce(fn_body, F.lit(False))).alias("bodies"), F.bool_or(F.coalesce(public, F.lit(False))).alias("public"),
    )
    violation = lambda df, rule: df.select(*KEY, F.lit(rule).alias("rule"), "line", *(["detail"] if "detail" in df.columns else [F.lit(None).cast("string").alias("detail")]))
    # .unwrap() and .expect(one argument)
    brackets = t.where((F.col("text") == "(") & F.col("p1").isin("unwrap", "expect") & (F.col("p2") == ".")).select(*KEY, "line", F.col("pos").alias("bracket"), F.col("p1").alias("call"), (F.col("n1") == ")").alias("empty"))
    several = t.where((F.col("text") == ",") & (F.col("n1") != ")")).select(*KEY, F.col("encloser").alias("bracket"), F.lit(True).alias("several")).distinct()
    unwraps = brackets.join(several, [*KEY, "bracket"], "left").where(F.when(F.col("call") == "unwrap", F.col("empty")).otherwise(~F.col("empty") & F.col("several").isNull()))
    unwraps = unwraps.withColumn("detail", F.concat(F.lit("."), "call", F.lit("()")))
    # documentation: nothing but attributes stands between it and the item
    ends = F.when(_text(";", "{", "}") & ~F.col("remark"), F.lit(False)).when((F.col("kind") == "doc") | ((F.col("text") == "doc") & (F.col("p1") == "[") & (F.col("p2") == "#")), F.lit(True))
    told = F.last(ends, ignorenulls=True).over(Window.partitionBy(*KEY).orderBy("pos").rowsBetween(Window.unboundedPreceding, -1))
    docs = t.withColumn("told", told).where(public & ~F.coalesce("told", F.lit(False)))
    docs = docs.select(*KEY, "line", F.concat_ws(" ", "text", "n1", "n2").alias("detail"))
    bodies = t.where(fn_body).select(*KEY, F.col("stop.pos").alias("pos"), F.col("stop.closer").alias("closer"))
    remarks = _inside(t.where(F.col("kind") == "note").select(*KEY, "pos", "line"), bodies).join(per.where("whole").select(*KEY), KEY, "left_semi")
    errors, handles = error_facts(t)
    found = violation(unwraps, RULES[0]).unionByName(violation(errors, RULES[1])).unionByName(violation(docs, RULES[2])).unionByName(violation(remarks, RULES[3])).unionByName(violation(index_loops(t), RULES[4]))
    found = found.groupBy(*KEY).agg(F.sort_array(F.collect_list(F.struct("line", "rule", "detail"))).alias("violations"))
    out = per.join(found, KEY, "left").join(handles.withColumn("handles", F.lit(True)), KEY, "left")
    hits = F.when(F.col("parsed"), F.coalesce("violations", F.array().cast("array<struct<line:int,rule:string,detail:string>>"))).otherwise(F.array().cast("array<struct<line:int,rule:string,detail:string>>"))
    applies = {RULES[0]: F.lit(True), RULES[1]: F.coalesce("handles", F.lit(False)), RULES[2]: F.col("public"), RULES[3]: F.col("whole") & F.col("bodies"), RULES[4]: F.lit(True)}
    out = out.withColumn("violations", hits)
    verdict = lambda r: F.when(~F.col("parsed"), "n/a").when(F.exists("violations", lambda v: v["rule"] == r), "fail").when(applies[r], "pass").otherwise("n/a")
    return out.select(*KEY, "parsed", F.create_map(*[x for r in RULES for x in (F.lit(r), verdict(r))]).alias("verdicts"), "violations")
