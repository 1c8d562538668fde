"""Scalar text functions as Column expressions, inside whole-stage code where Spark allows it."""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as Y

from . import fixed

WHITE = r"(?U)\s+"


def any_of(text: Column, phrases: list[str]) -> Column:
    """True if text holds one of the phrases as it is."""
    return reduce(lambda a, b: a | b, [F.contains(text, F.lit(p)) for p in phrases])


def strip(text: Column) -> Column:
    """Without Unicode white space at both ends."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+\z", "")


def ascii_lower(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def squeeze(text: Column) -> Column:
    """Words parted by single spaces."""
    return F.trim(F.regexp_replace(text, WHITE, " "))


def dedup_key(instruction: Column, response: Column) -> Column:
    return F.concat(squeeze(instruction), F.lit("\n"), squeeze(response))


@F.pandas_udf(Y.StringType())
def fnv1a(text: pd.Series) -> pd.Series:
    """64-bit FNV-1a of the UTF-8 bytes as 16 hex digits; all texts of a batch go side by side, byte by byte."""
    raw = [t.encode() for t in text if t is not None]
    order = sorted(range(len(raw)), key=lambda k: -len(raw[k]))
    sizes = np.array([len(raw[k]) for k in order], np.int64)
    data = np.frombuffer(b"".join(raw[k] for k in order), np.uint8).astype(np.uint64)
    start, h = np.cumsum(sizes) - sizes, np.full(len(raw), 0xCBF29CE484222325, np.uint64)
    for i in range(int(sizes.max(initial=0))):
        n = int(np.searchsorted(-sizes, -i, "left"))  # texts of more than i bytes
        h[:n] = (h[:n] ^ data[start[:n] + i]) * np.uint64(0x100000001B3)
    found = dict(zip(order, h.tolist()))
    made = iter(f"{found[k]:016x}" for k in range(len(raw)))
    return text.map(lambda t: None if t is None else next(made))


def percent(part: Column, whole: Column) -> Column:
    """Whole percent, halves to even; null where the whole is 0."""
    return F.when(whole != 0, F.bround(part.cast("decimal(20,6)") * 100 / whole, 0).cast("int"))


def licence_class(text: Column) -> Column:
    """The licence of a licence file's text; restrictive terms win over permissive ones."""
    creative = any_of(text, ["Creative Commons", "Attribution", "CC0 1.0 Universal"])
    return (
        F.when(F.contains(text, F.lit("Mozilla Public License")), "mozilla_public")
        .when(F.contains(text, F.lit("PYTHON SOFTWARE FOUNDATION LICENSE VERSION 2")), "python_software_foundation")
        .when(creative & any_of(text, fixed.RESTRICTING_TERMS), "creative_commons_restricted")
        .when(F.contains(text, F.lit("Apache License")), "apache")
        .when(any_of(text, ["Permission is hereby granted", "MIT License"]), "mit")
        .when(F.contains(text, F.lit("Redistribution and use in source and binary forms")), "bsd")
        .when(creative, "creative_commons")
        .when(F.contains(text, F.lit("NO-LICENCE-FILE")) | (text == ""), "missing")
        .otherwise("unrecognised")
    )


def permits_reuse(licence: Column) -> Column:
    return licence.isin(fixed.REUSABLE)


def phrase_pattern(phrases: list[str]) -> str:
    """One case-insensitive alternation; apostrophes of both kinds; word boundaries at alphanumeric edges."""

    def one(p: str) -> str:
        body = "".join("['’]" if c == "'" else "\\" + c if not c.isalnum() and c != " " else c for c in p)
        return (r"\b" if p[0].isalnum() else "") + body + (r"\b" if p[-1].isalnum() else "")

    return "(?i)(?:" + "|".join(map(one, phrases)) + ")"


def word_count(text: Column) -> Column:
    return F.size(F.filter(F.split(text, WHITE), lambda w: w != ""))


def question_of(reply: Column) -> Column:
    """A reply without a leading label and surrounding quotes."""
    plain = F.regexp_replace(strip(reply), r"^(?:Question:|Q:)", "")
    return strip(F.regexp_replace(strip(plain), r"^[\"“”']+|[\"“”']+$", ""))


def question_rejection(question: Column) -> Column:
    """Why a question cannot be used, or null."""
    low = F.lower(question)
    slop = reduce(lambda a, b: a | b, [question.rlike(phrase_pattern(p)) for p in fixed.SLOP_PHRASES.values()])
    return (
        F.when(question == "", "empty")
        .when(F.contains(question, F.lit("\n")), "not one line")
        .when(~F.endswith(question, F.lit("?")), "not a question")
        .when(F.length(question) > fixed.MAX_QUESTION, "too long")
        .when(any_of(low, fixed.SOURCE_WORDS), "mentions the source")
        .when(slop, "slop")
    )


def overlap_words(text: Column) -> Column:
    """Distinct lower-cased words of three bytes or more."""
    return F.array_distinct(F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: F.octet_length(w) >= 3))


def jaccard(a: Column, b: Column) -> Column:
    union = F.size(F.array_union(a, b))
    return F.when(union > 0, F.size(F.array_intersect(a, b)) / union).otherwise(0.0)
