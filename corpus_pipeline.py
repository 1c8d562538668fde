"""The corpus pipeline: five stages, each written as Parquet and read again as the next one's documents.

1. language ID: documents without a recognisable language go (null, empty or letterless texts, and texts that the best language's
   tree explains no better than uniform symbols);
2. n-gram Jaccard join: one document of each group of near duplicates, the one with the smallest doc_id, stays;
3. suffix-array dedup: passages of 50 bytes and more that stand in a smaller doc_id are cut out of the texts; a character goes only
   with all its bytes;
4. benchmark decontamination: documents that leak a benchmark item go;
5. best-fit packing: the rest is packed into sequences.

Each stage takes (spark, docs, sf_dir). All but the last return the columns of documents, whatever the others are called. Rows with a
null doc_id pass stages 2 to 4.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import bytesops
from millrace.llm.decontaminate import clean_documents
from millrace.llm.jaccard import join_documents
from millrace.llm.language_id import SYMBOLS, classify, train, training_rows
from millrace.llm.packing import pack_documents
from millrace.llm.scratch import keys_join, release, stored
from millrace.llm.suffix_dedup import kept_bytes, with_runs


def _column(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def _numbered(docs: DataFrame, but: tuple[str, ...] = ()) -> list[Column]:
    """The columns of docs under names that no operator uses, in order; those in `but` keep theirs."""
    return [_column(c) if c in but else _column(c).alias(f"__column{i}") for i, c in enumerate(docs.columns)]


def _named(docs: DataFrame, but: tuple[str, ...] = ()) -> list[Column]:
    """The way back: numbered columns under the names of docs."""
    return [_column(c) if c in but else F.col(f"__column{i}").alias(c) for i, c in enumerate(docs.columns)]


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = train(training_rows(docs))
    found = classify(docs, model, _numbered(docs))
    return found.where((F.col("lang_pred") != "und") & (F.col("bits_per_byte") < math.log2(SYMBOLS))).select(*_named(docs))


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    groups = join_documents(docs).where("component_id != doc_id").select("doc_id").distinct()
    return keys_join(docs, stored(groups, "near-copies"), "doc_id", "left_anti")


def _whole_characters(text: bytes, gone: np.ndarray) -> str:
    """The text without the characters all of whose bytes are gone."""
    data = np.frombuffer(text, np.uint8)
    first = np.flatnonzero((data & 0xC0) != 0x80)
    lost = np.minimum.reduceat(gone, first) if len(first) else gone
    return data[~np.repeat(lost, np.diff(np.append(first, len(data))))].tobytes().decode("utf-8", "replace")


def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    own = ("doc_id", "text")
    inner = docs.select(*_numbered(docs, own))
    names = inner.columns

    def cut(batches):
        for b in bytesops.slices(batches):
            out = []
            for text, runs in zip(b.column("text").to_pylist(), b.column("__runs").to_pylist()):
                if runs and text is not None:
                    raw = text.encode()
                    text = _whole_characters(raw, ~kept_bytes(np.frombuffer(raw, np.uint8), runs))
                out.append(text)
            cols = {n: b.column(n) for n in names} | {"text": pa.array(out, pa.string())}
            yield pa.record_batch([cols[n] for n in names], names=names)

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in inner.schema)
    out = with_runs(inner, cut, schema).select(*_named(docs, own))
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def remove_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return clean_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack_documents(docs.select("doc_id", "text"))


STAGES = [
    ("language_id", identify_language),
    ("ngram_jaccard_join", keep_one_of_each_group),
    ("suffix_array_dedup", cut_repeated_passages),
    ("benchmark_decontamination", remove_benchmark_leaks),
    ("best_fit_packing", pack_sequences),
]

#: Trained models, suffix arrays and packing are beyond SQL; the stages are tested against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), []
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
        if before:
            release(*before)
        before = [docs]
    return docs
