"""Word vectors from text files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.errors import AnalysisException

from tagloom.functions.text import BLANK, strip

VECTORS = "word string, vec array<double>"


def first_lines(lines: DataFrame, n: int) -> DataFrame:
    """The first ``n`` rows by ``at`` (file, split, row), without sorting or gathering rows.

    Splits are counted; as each has a line, at most ``n`` counts come to the driver and say how many lines of which split are wanted.
    """
    here = lines.select("at.file", "at.split", "at.row")
    counts = here.groupBy("file", "split").agg(F.count("*").alias("lines"), F.min("row").alias("first")).orderBy("file", "split").limit(n)
    wanted, left = [], n
    for r in counts.collect():
        if left <= 0:
            break
        wanted.append((r["file"], r["split"], r["first"], min(left, r["lines"])))
        left -= r["lines"]
    splits = F.broadcast(lines.sparkSession.createDataFrame(wanted, "file string, split long, first long, wanted long"))
    kept = lines.join(splits, (F.col("at.file") == F.col("file")) & (F.col("at.split") == F.col("split")))
    return kept.filter(F.col("at.row") - F.col("first") < F.col("wanted")).select(*lines.columns)


def read_embeddings(spark: SparkSession, path: str, dim: int = 50, max_vocab: int | None = None) -> DataFrame:
    """``word, vec`` from lines ``word v1 v2 ...``: all, or the first ``max_vocab`` (usual value: 50,000).

    Lines are counted before any are skipped. A line with too few fields or a bad number is skipped;
    of lines with the same word the last one counts. A missing path gives an empty table.
    File, split start and position within the split order the lines; only counts of splits are made to find the first ones.
    """
    try:
        lines = spark.read.text(path).select(
            "value",
            F.struct(
                F.col("_metadata.file_path").alias("file"),
                F.col("_metadata.file_block_start").alias("split"),
                F.monotonically_increasing_id().alias("row"),
            ).alias("at"),
        )
    except AnalysisException:
        return spark.createDataFrame([], VECTORS)
    first = lines if max_vocab is None else first_lines(lines, max_vocab)
    fields = first.select("at", F.split(strip(F.col("value")), f"[{BLANK}]+").alias("f")).filter(F.size("f") > dim)
    numbers = F.transform(F.slice("f", 2, dim), lambda x: x.try_cast("double"))
    return (
        fields.select("at", F.col("f")[0].alias("word"), numbers.alias("vec"))
        .filter(~F.exists("vec", lambda x: x.isNull()))
        .groupBy("word")
        .agg(F.max_by("vec", "at").alias("vec"))
    )
