"""Tokens, character offsets and B/I/O labels (all narrow: one sentence row in, one out)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.functions.arrays import let
from tagloom.functions.text import escape
from tagloom.operators.token_arrays import located

# --- fixed values: Penn Treebank word-splitting conventions as (pattern, replacement), in order ---
OPENING_QUOTES = [
    ("([«“‘„]|`+)", " $1 "),
    ('^"', "``"),
    ("(``)", " $1 "),
    ("([ (\\[{<])(?:\"|'{2})", "$1 `` "),
    (r"(?i)(')(?!re|ve|ll|m|t|s|d|n)(\w)\b", "$1 $2"),
]
PUNCTUATION = [
    ("([^.])(\\.)([\\])}>\"'»”’ ]*)\\s*$", "$1 $2 $3 "),
    (r"([:,])([^\d])", " $1 $2"),
    ("([:,])$", " $1 "),
    (r"(\.{2,})", " $1 "),
    ("([;@#$%&])", " $1 "),
    ("([?!])", " $1 "),
    ("([^'])' ", "$1 ' "),
    (r"(\*)", " $1 "),
]
BRACKETS = [(r"([\]\[(){}<>])", " $1 "), ("(--)", " $1 ")]
CLOSING_QUOTES = [
    ("([»”’])", " $1 "),
    ("('')", " $1 "),
    ('"', " '' "),
    ("([^' ])('[sS]|'[mM]|'[dD]|') ", "$1 $2 "),
    ("([^' ])('ll|'LL|'re|'RE|'ve|'VE|n't|N'T) ", "$1 $2 "),
]
CONTRACTIONS = [
    (r"(?i)\b(can)(not)\b", " $1 $2 "),
    (r"(?i)\b(d)('ye)\b", " $1 $2 "),
    (r"(?i)\b(gim)(me)\b", " $1 $2 "),
    (r"(?i)\b(gon)(na)\b", " $1 $2 "),
    (r"(?i)\b(got)(ta)\b", " $1 $2 "),
    (r"(?i)\b(lem)(me)\b", " $1 $2 "),
    (r"(?i)\b(more)('n)\b", " $1 $2 "),
    (r"(?i)\b(wan)(na)(?=\s)", " $1 $2 "),
    (r"(?i) ('t)(is)\b", " $1 $2 "),
    (r"(?i) ('t)(was)\b", " $1 $2 "),
]
# --- end of fixed values ---

UNICODE = "(?U)"  # \w, \s, \d and \b as Unicode classes
WORD = r"[\p{L}\p{N}]+|[^\s\p{L}\p{N}]"
TOKENS = "array<struct<form:string,start:int,end:int>>"


def _treebank(text: Column) -> Column:
    for pattern, replacement in OPENING_QUOTES + PUNCTUATION + BRACKETS:
        text = F.regexp_replace(text, UNICODE + pattern, replacement)
    text = F.concat(F.lit(" "), text, F.lit(" "))
    for pattern, replacement in CLOSING_QUOTES + CONTRACTIONS:
        text = F.regexp_replace(text, UNICODE + pattern, replacement)
    return F.filter(F.split(text, UNICODE + r"\s+"), lambda t: t != "")


def token_forms(text: Column, mode: str = "simple") -> Column:
    """Token strings of a sentence: runs of letters/digits and single other characters, or Treebank words."""
    if mode == "simple":
        return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    if mode == "treebank":
        return _treebank(text)
    raise ValueError(f"unknown tokenizer mode: {mode}")


def search_offsets(text: Column, forms: Column, block: int = 64) -> Column:
    """Locate each form in turn, searching on from the end of the one before.

    A form the tokenizer rewrote is not found: it starts at -1 and the search goes on from there,
    that is from near the beginning of the text. Folding in blocks bounds the copying of results.
    """

    def step(acc: Column, form: Column) -> Column:
        start = F.call_function("locate", form, text, acc.next + 1) - 1
        return let(
            start,
            lambda s: F.struct(
                (s + F.length(form)).alias("next"),
                F.array_append(
                    acc.done,
                    F.struct(form.alias("form"), s.alias("start"), (s + F.length(form) - 1).alias("end")),
                ).alias("done"),
            ),
        )

    def chunk(acc: Column, part: Column) -> Column:
        inner = F.aggregate(
            part, F.struct(acc.next.alias("next"), F.array().cast(TOKENS).alias("done")), step
        )
        return let(
            inner,
            lambda r: F.struct(r.next.alias("next"), F.array_append(acc.parts, r.done).alias("parts")),
        )

    def blocks(f: Column) -> Column:
        heads = F.when(F.size(f) > 0, F.sequence(F.lit(1), F.size(f), F.lit(block))).otherwise(
            F.array().cast("array<int>")
        )
        return F.transform(heads, lambda h: F.slice(f, h, F.lit(block)))

    start = F.struct(F.lit(0).alias("next"), F.array().cast(f"array<{TOKENS}>").alias("parts"))
    return let(forms, lambda f: F.flatten(F.aggregate(blocks(f), start, chunk).parts))


def located_tokens(text: Column, mode: str = "simple") -> Column:
    """Tokens with 0-based start and inclusive end.

    Simple mode never rewrites the text, so one pass over its characters tells where every token begins and ends, and no search is
    needed.
    """
    return located(text) if mode == "simple" else search_offsets(text, token_forms(text, mode))


def tokenize(sentences: DataFrame, mode: str = "simple") -> DataFrame:
    """Add ``forms ARRAY<STRING>``."""
    return sentences.withColumn("forms", token_forms(F.col("text"), mode))


def align_offsets(sentences: DataFrame, mode: str = "simple") -> DataFrame:
    """Add ``tokens ARRAY<STRUCT<form,start,end>>``."""
    return sentences.withColumn("tokens", located_tokens(F.col("text"), mode))


def tag_tokens(tokens: Column, spans: Column) -> Column:
    """B/I/O label per token from the first span, in list order, that contains it."""

    def label(token: Column, sp: Column) -> Column:
        hit = F.get(F.filter(sp, lambda s: (token.start >= s.start) & (token.end <= s.end)), F.lit(0))
        return let(
            hit,
            lambda s: F.when(s.isNull(), "O").otherwise(
                F.concat(F.when(token.start == s.start, "B-").otherwise("I-"), s.type)
            ),
        )

    return F.when(F.coalesce(F.size(spans), F.lit(0)) < 1, F.transform(tokens, lambda t: F.lit("O"))).otherwise(
        let(spans, lambda sp: F.transform(tokens, lambda t: label(t, sp)))
    )


def bio_tag(sentences: DataFrame) -> DataFrame:
    """Add ``tags ARRAY<STRING>`` from ``tokens`` and ``spans ARRAY<STRUCT<start,end,type>>``."""
    return sentences.withColumn("tags", tag_tokens(F.col("tokens"), F.col("spans")))


def sanitize(token_features: DataFrame) -> DataFrame:
    """Drop tokens without form or tag; escape line feeds and tabs in forms and features."""
    return (
        token_features.filter((F.col("form") != "") & (F.col("tag") != ""))
        .withColumn("form", escape(F.col("form")))
        .withColumn("features", F.transform("features", escape))
    )
