"""Writers: JSON lines, and a dataset of train rows, drops and report side by side."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def jsonl(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One object a line; null fields are left out."""
    df.write.mode(mode).option("ignoreNullFields", "true").json(path)


def dataset(path: str, **parts: DataFrame) -> None:
    """Each part in a folder of its own under path."""
    for name, part in parts.items():
        jsonl(part, f"{path}/{name}")


def scored_run(scored: DataFrame, path: str) -> None:
    """The rows of a run as they were (`row`, JSON), each with its scores under `score`."""
    whole = F.concat(F.regexp_replace("row", r"\}\s*$", ""), F.lit(',"score":'), F.to_json(F.struct("slop", "n_blocks", "rules", "all_rules", "false_claims")), F.lit("}"))
    scored.select(whole.alias("value")).write.mode("overwrite").text(path)


def flags(rows: DataFrame, path: str) -> None:
    """The flags file, sorted by id."""
    jsonl(rows.orderBy("id"), path)


def report(summed: DataFrame, path: str) -> None:
    """A small table as a markdown table, its rows in their order, one file."""
    names = summed.columns
    cells = F.concat_ws(" | ", *[F.coalesce(F.col(c).cast("string"), F.lit("–")) for c in names])
    one = summed.select(F.concat(F.lit("| "), cells, F.lit(" |")).alias("row")).agg(F.collect_list("row").alias("rows"))  # a report's rows: a handful
    head = F.array(F.lit("| " + " | ".join(names) + " |"), F.lit("|" + "---|" * len(names)))
    one.select(F.array_join(F.concat(head, "rows"), "\n").alias("value")).write.mode("overwrite").text(path)


def history(summed: DataFrame, path: str) -> None:
    """Appends the summary's row to a CSV history."""
    summed.coalesce(1).write.mode("append").csv(path, header=True)


def ship(stream: DataFrame, send: Callable[[DataFrame, int], None], checkpoint: str, every: str = "5 seconds") -> StreamingQuery:
    """Hands each micro-batch to `send`. A batch that fails is given again after a restart, under the same number: `send` must accept it twice."""
    return stream.writeStream.foreachBatch(send).option("checkpointLocation", checkpoint).trigger(processingTime=every).start()
