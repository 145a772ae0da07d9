"""Line deduplication in plain column expressions.

Normalised lines are exploded as two 64-bit hashes (with different seeds, together the identity of a line), counted once per
document, and those of the threshold or more are dropped in every document; the rest is put together by position.
Counting combines on the map side first, so a line that stands in a third of all documents is no hot key. The common lines are
broadcast if they are few by measure; otherwise the lines meet them in a shuffle that salts the heavy ones. What is collected
for one document is its own line positions.

Each row counts as a document of its own. Null or empty text is one empty line; empty lines have no key and stay. A document
whose lines all go keeps the empty text. Rows that agree in id and text get the same answer, null ids included. Only doc_id
and text are read; ``deduplicate`` keeps all other columns as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.functions.scale import lookup_join, settle
from tagloom.llm.common import LOWER, UPPER

THRESHOLD = 10
BLANKS = " \t\n\x0b\x0c\r"
SEED = 7


def line_key(line: Column) -> Column:
    """Blanks stripped at both ends, A-Z in lower case."""
    bare = F.btrim(line, F.lit(BLANKS))
    ascii_only = F.octet_length(bare) == F.char_length(bare)
    return F.when(ascii_only, F.lower(bare)).otherwise(F.translate(bare, UPPER, LOWER))


def _hashes(text: Column) -> Column:
    key = lambda line: F.struct(F.xxhash64(line).alias("a"), F.xxhash64(F.lit(SEED), line).alias("b"))
    return F.transform(
        F.transform(F.split(text, "\n", -1), line_key), lambda k: F.when(F.char_length(k) >= 1, key(k))
    )


def dropped_lines(documents: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """doc_id, text_hash and the ascending positions of lines to drop, for documents that lose any."""
    text = F.coalesce("text", F.lit(""))
    hashed = settle(documents.select("doc_id", F.xxhash64(text).alias("text_hash"), _hashes(text).alias("keys")))
    once = hashed.select(F.explode(F.array_distinct("keys")).alias("key")).filter("key IS NOT NULL")
    common = once.groupBy("key.a", "key.b").agg(F.count("*").alias("n")).filter(F.col("n") >= threshold).drop("n")
    places = hashed.select("doc_id", "text_hash", F.posexplode("keys").alias("pos", "key")).filter("key IS NOT NULL")
    places = places.select("doc_id", "text_hash", "pos", "key.a", "key.b")
    return lookup_join(places, common, ["a", "b"], ["doc_id", "pos"], "inner").groupBy("doc_id", "text_hash").agg(F.sort_array(F.collect_set("pos")).alias("dropped"))


def without_lines(text: Column, dropped: Column) -> Column:
    """The lines between dropped positions, joined again; one slice for each gap, so long texts take linear time."""
    lines = F.split(text, "\n", -1)
    ends = F.concat(dropped, F.array(F.size(lines)))
    gaps = F.transform(ends, lambda end, i: F.struct(end.alias("end"), F.when(i > 0, F.get(ends, i - 1) + 1).otherwise(0).alias("begin")))
    kept = F.flatten(F.transform(gaps, lambda g: F.slice(lines, g["begin"] + 1, g["end"] - g["begin"])))
    return F.when(F.size(dropped) == 0, text).otherwise(F.array_join(kept, "\n"))


def kept_lines(documents: DataFrame, threshold: int = THRESHOLD, carried: list[str] | None = None) -> DataFrame:
    """doc (a struct of the carried columns, by default doc_id), the remaining text, n_lines (before) and n_dropped for every row."""
    marks = dropped_lines(documents, threshold).withColumnsRenamed({"doc_id": "_id", "text_hash": "_hash"})
    rows = documents.select(F.struct(*(carried or ["doc_id"])).alias("doc"), F.col("doc_id").alias("id"), F.coalesce("text", F.lit("")).alias("text"))
    joined = rows.join(marks, F.col("id").eqNullSafe(F.col("_id")) & (F.xxhash64("text") == F.col("_hash")), "left")
    dropped = F.coalesce("dropped", F.array().cast("array<int>"))
    return joined.select(
        "doc", without_lines(F.col("text"), dropped).alias("text"), F.size(F.split("text", "\n", -1)).cast("long").alias("n_lines"),
        F.size(dropped).cast("long").alias("n_dropped"),
    )


def deduplicate(documents: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """documents with the remaining text; all other columns stay, whatever they are called."""
    kept = kept_lines(documents, threshold, [c for c in documents.columns if c != "text"])
    return kept.select(*[F.col("text") if c == "text" else F.col("doc").getField(c).alias(c) for c in documents.columns])


def digest(documents: DataFrame) -> DataFrame:
    kept = kept_lines(documents)
    return kept.select("doc.doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


ORACLE = """
WITH l AS (SELECT rowid AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS a FROM (SELECT row_number() OVER () AS rowid, * FROM documents)),
e AS (SELECT r, doc_id, unnest(a) AS line, generate_subscripts(a, 1) AS pos FROM l),
k AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM e),
c AS (SELECT key FROM k WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT r) >= 10)
SELECT doc_id, count(*) AS n_lines, count(c.key) AS n_dropped, sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (c.key IS NULL), '')) AS kept_sha256
FROM k LEFT JOIN c ON k.key = c.key GROUP BY r, doc_id
"""
