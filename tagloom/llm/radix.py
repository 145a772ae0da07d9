"""Exact deduplication by distributed radix partitioning, most significant bytes first.

All rows begin as one group. A round takes the next bytes of every text of a group as its digit, counts the rows of each
(group, digit) and splits the group by them. Rows that are alone in theirs are singletons and take no further part, and neither do
texts that have ended: rows of a group that end in the same round with the same digit are equal byte for byte, as every byte has
been a digit. So nothing is compared by a digest. Digits grow by the round (FIRST bytes, then GROWTH times as many each time, up to
LONGEST): the first leaves out most unlike texts, and a long text takes few rounds.

Counting combines on the map side, so a group with a third of all rows sends one row from each task. The groups that go on are
written and measured: within the bound they are broadcast and texts do not move; beyond it rows and groups are shuffled and the rows
of a heavy group are salted. Each round is written to shared storage with the bytes that are left, and only of rows that still share
their group. No group comes together in one task or on the driver.

A null text is empty, and equal to other empty ones. Of equal texts the row of the largest doc_id stays; a null id is smaller than any other, and of
rows with that same id one stays. Ids need not be unique: sizes count rows. Only doc_id and text are read by ``digest``; ``drop_copies``
returns the rows that stay with all their columns, whatever these are called. An empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.functions.scale import lookup_join, settle

#: Bytes of the first digit, how much longer each further one is, and the most.
FIRST, GROWTH, LONGEST = 64, 8, 4 << 20


def _cut(rows: DataFrame, size: int) -> DataFrame:
    """The next digit of ``rest`` and whether the text ends with it."""
    return rows.withColumns({"digit": F.substring("rest", 1, size), "ended": F.octet_length("rest") <= size})


def _split(rows: DataFrame, keys: list[str], row_id: list[str], size: int, how: str) -> DataFrame:
    """Rows with the number of the group they share with others (none if alone), and the bytes left to them."""
    cut = _cut(rows, size)
    shared = cut.groupBy(*keys, "digit", "ended").agg(F.count("*").alias("_n")).filter("_n > 1").drop("_n")
    known = lookup_join(cut, shared.withColumn("next", F.monotonically_increasing_id()), [*keys, "digit", "ended"], row_id, how)
    goes_on = F.col("next").isNotNull() & ~F.col("ended")
    return known.withColumn("rest", F.when(goes_on, F.substring(F.col("rest"), F.lit(size + 1), F.octet_length("rest")))).drop(*keys, "digit")


def exact_groups(
    documents: DataFrame, carried: list[str] | None = None, text: Column | None = None, first: int = FIRST, growth: int = GROWTH, longest: int = LONGEST
) -> DataFrame:
    """doc (a struct of the carried columns, by default doc_id), body_sha256, keep_id, group_size and kept for every row.

    ``text`` is what has to be equal, by default the column of that name; a normalised form may be given.
    """
    body = F.coalesce(F.col("text") if text is None else text, F.lit("")).cast("binary")
    rows = documents.select(F.struct(*(carried or ["doc_id"])).alias("doc"), F.col("doc_id").alias("id"), body.alias("rest"))
    rows = rows.withColumn("body_sha256", F.sha2("rest", 256))
    # every row gets its number here, as it is written
    base = settle(_split(rows, [], ["id", "body_sha256"], first, "left").withColumn("row", F.monotonically_increasing_id()), "zstd")
    is_open = F.col("next").isNotNull()
    ended = [base.filter(is_open & F.col("ended")).select("row", F.lit(0).alias("round"), "next")]
    left, size = base.filter(is_open & ~F.col("ended")).select("row", F.col("next").alias("group"), "rest"), first
    while not left.isEmpty():
        size = min(size * growth, longest)
        split = settle(_split(left, ["group"], ["row"], size, "inner"), "zstd")
        ended.append(split.filter("ended").select("row", F.lit(len(ended)).alias("round"), "next"))
        left = split.filter("NOT ended").select("row", F.col("next").alias("group"), "rest")
    classes = ended[0]
    for more in ended[1:]:
        classes = classes.unionAll(more)
    known = base.select("row", "doc", "id", "body_sha256").join(classes, "row", "left")
    known = settle(known)
    chosen = known.filter("next IS NOT NULL").groupBy("round", "next").agg(F.max(F.struct("id", "row")).alias("best"), F.count("*").alias("n"))
    chosen = chosen.select("round", "next", F.col("best.id").alias("best_id"), F.col("best.row").alias("best_row"), "n")
    alone = F.col("n").isNull()
    return lookup_join(known, chosen, ["round", "next"], ["row"]).select(
        "doc", "body_sha256", F.when(alone, F.col("id")).otherwise(F.col("best_id")).alias("keep_id"),
        F.coalesce("n", F.lit(1)).cast("long").alias("group_size"), (alone | (F.col("row") == F.col("best_row"))).alias("kept"),
    )


def drop_copies(documents: DataFrame) -> DataFrame:
    """One row of each group of equal texts, with all columns."""
    return exact_groups(documents, documents.columns).filter("kept").select("doc.*")


def digest(documents: DataFrame) -> DataFrame:
    return exact_groups(documents).select("doc.doc_id", "keep_id", "group_size", "kept", F.col("body_sha256").alias("text_sha256"))


ORACLE = """
SELECT doc_id, max(doc_id) OVER t AS keep_id, count(*) OVER t AS group_size, doc_id = max(doc_id) OVER t AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW t AS (PARTITION BY coalesce(text, ''))
"""
