"""The corpus pipeline: five stages over documents, each written as Parquet and read again by the next.

1. Language identification: documents without a recognisable language go.
2. Line deduplication: lines that stand in ten or more documents go; the text is put together from the others.
3. Jaccard join: of each component of near duplicates (five-word shingles, a similarity of 0.8 or more) the document with the least id stays.
4. Benchmark decontamination: contaminated documents go.
5. Temperature mixing: the documents left are drawn into a mixture (doc_id, source, epoch, start, n_tokens).

Stages 1 to 4 return the columns of documents, further ones included, whatever these are called. Every row is judged by itself: null
ids and repeated rows are kept or dropped like others, and of a group of near duplicates one row stays, even if all have the same id.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.functions.scale import scratch_dir
from tagloom.llm import decontaminate, language, line_dedup, mixing, prefix_tree
from tagloom.llm.common import table

#: Documents whose best language is less likely than this are rejected.
LEAST_SCORE = 0.4
#: Near duplicates share so much of their five-word shingles.
NEAR = prefix_tree.Likeness(5, 4, 5)


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the documents with a language of a likelihood of LEAST_SCORE or more; ``und`` is none."""
    rows = docs.select(F.struct(*[c for c in docs.columns if c != "text"]).alias("doc"), "text")
    found = language.predict(rows, language.learned(docs), keep=["doc", "text"])
    kept = found.filter((F.col("lang_pred") != "und") & (F.col("score") >= LEAST_SCORE))
    return kept.select(*[F.col("text") if c == "text" else F.col("doc").getField(c).alias(c) for c in docs.columns])


def distinct_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Take out common lines; n_chars follows the text. A document that loses all its lines stays, empty."""
    return line_dedup.deduplicate(docs).withColumn("n_chars", F.char_length("text").cast("long")).select(docs.columns)


def distinct_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return prefix_tree.one_of_each(docs, NEAR)


def clean_of_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.remove_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", known_language),
    ("line_dedup", distinct_lines),
    ("ngram_jaccard_join", distinct_documents),
    ("benchmark_decontamination", clean_of_benchmark),
    ("source_mixing", mixture),
]
#: Naive Bayes over hashed n-grams cannot be said in SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, folder = table(spark, sf_dir, "documents"), scratch_dir(spark)
    for k, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{k}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
