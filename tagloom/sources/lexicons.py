"""Term lists: from text files, drug records, molecule tables and training annotations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.functions.text import strip


def read_lexicon(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``term``: distinct stripped, lower-cased, non-blank lines."""
    return (
        spark.read.text(path)
        .select(F.lower(strip(F.col("value"))).alias("term"))
        .filter(F.col("term") != "")
        .distinct()
    )


def lexicon_from_drugbank(drugs: DataFrame) -> DataFrame:
    """Sorted distinct names, synonyms and product names of the drugs in group ``approved``.

    Names that differ in case only stay apart; the sort ignores case (then falls back to the name).
    """
    none = F.array().cast("array<string>")
    names = F.concat(
        F.array("name"), F.coalesce("synonyms", none), F.coalesce("products", none)
    )
    return (
        drugs.filter(F.array_contains("groups", "approved"))
        .select(F.explode(names).alias("term"))
        .filter(F.col("term") != "")
        .distinct()
        .orderBy(F.lower("term"), "term")
    )


def lexicon_from_chembl(molecules: DataFrame, synonyms: DataFrame, indications: DataFrame, hierarchy: DataFrame) -> DataFrame:
    """Approved primary molecules with their synonyms in one string.

    Each side table is reduced to what one molecule contributes before the join: the number of its
    qualifying indication and hierarchy rows only multiplies every synonym, so the synonym list is
    repeated that often instead of materialising the fan-out. ``molregno`` of one molecule may thus
    have any number of rows in every table.
    """
    approved = molecules.filter(F.col("max_phase") == 4)
    listed = (
        synonyms.groupBy("molregno", F.col("synonyms").alias("synonym"))
        .agg(F.count("*").alias("copies"))
    )
    phases = indications.groupBy("molregno").agg(
        F.count_if(F.col("max_phase_for_ind").isNull() | (F.col("max_phase_for_ind") == 4)).alias("ind_rows")
    )
    parents = hierarchy.groupBy("molregno").agg(
        F.count_if(F.col("parent_molregno").isNull() | (F.col("parent_molregno") == F.col("molregno"))).alias("par_rows")
    )
    fan_out = F.coalesce("ind_rows", F.lit(1)) * F.coalesce("par_rows", F.lit(1))
    kept = approved.join(phases, "molregno", "left").join(parents, "molregno", "left").filter(fan_out > 0)
    named = kept.join(listed, "molregno", "left").withColumn("copies", F.col("copies") * fan_out)
    # repeat(s || '; ', n) spells one synonym n times; equal synonyms sort next to each other
    run = F.when(
        F.col("synonym").isNotNull(),
        F.concat(F.expr("repeat(concat(synonym, '; '), cast(copies - 1 as int))"), F.col("synonym")),
    )
    return (
        named.withColumn("run", run)
        .groupBy("molregno", "pref_name", "max_phase")
        .agg(F.expr("listagg(run, '; ') WITHIN GROUP (ORDER BY synonym)").alias("synonyms"))
        .select(
            "molregno", "pref_name", F.coalesce("synonyms", F.lit("")).alias("synonyms"),
            F.col("max_phase").alias("approval_phase"),
        )
        .orderBy("pref_name")
    )


def lexicon_from_annotations(gold: DataFrame) -> DataFrame:
    """``type, term, n``: lower-cased entity names per type with their number of mentions."""
    return gold.groupBy("type", F.lower("text").alias("term")).agg(F.count("*").alias("n"))
