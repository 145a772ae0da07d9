"""Views over the driver's tables in the engine's data model, each with its SQL twin in ``oracle.py``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.functions.arrays import exploded, let
from tagloom.functions.scale import by_sentence, fits_broadcast, lookup_join, number_rows, settle, spread, task_count  # noqa: F401
from tagloom.operators.tokens import bio_tag, located_tokens

SPANS = "array<struct<start:int,end:int,type:string>>"
TYPES = ("drug", "brand", "group", "drug_n")
RELATIONS = ("advise", "effect", "mechanism", "int")
MIN_TERM = 8


def pick(names: tuple[str, ...], ix) -> F.Column:
    return F.element_at(F.array(*map(F.lit, names)), (ix % len(names) + 1).cast("int"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V1 ``sid, text``: the non-blank lines of every document."""
    docs = spread(table(spark, sf_dir, "documents").select("doc_id", "text"))
    lines = docs.select("doc_id", F.posexplode(F.split("text", "\n")).alias("line_no", "text"))
    return lines.filter(F.trim("text") != "").select(
        F.concat(F.col("doc_id").cast("string"), F.lit(".s"), F.col("line_no").cast("string")).alias("sid"), "text"
    )


def located(spark: SparkSession, sf_dir: str, clustered: bool = False) -> DataFrame:
    """Sentences with ``tokens``.

    ``clustered`` shuffles the sentence rows once, for jobs that regroup tokens by sentence. Tokens are found before, as the
    function that finds them would lose the partitioning, and travel as one line of forms and their starts.
    """
    found = sentences(spark, sf_dir).select("sid", "text", located_tokens(F.col("text")).alias("tokens"))
    if not clustered:
        return found
    tasks = task_count(table(spark, sf_dir, "documents").select("doc_id", "text"))
    packed = found.select("sid", "text", F.array_join("tokens.form", " ").alias("_forms"), F.col("tokens.start").alias("_starts"))
    # forms hold no space; each ends where its characters do
    forms = F.when(F.size("_starts") > 0, F.split("_forms", " ")).otherwise(F.array().cast("array<string>"))
    tokens = F.zip_with(forms, "_starts", lambda f, s: F.struct(f.alias("form"), s.alias("start"), (s + F.length(f) - 1).alias("end")))
    return by_sentence(packed, tasks).select("sid", "text", tokens.alias("tokens"))


def tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V2 ``sid, tok_ix, form, start, end``."""
    return exploded(located(spark, sf_dir), ["sid"], F.col("tokens"), "t", "tok_ix").select(
        "sid", "tok_ix", "t.form", "t.start", "t.end"
    )


def vocabulary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``term, type``: all words of the benchmark texts, the lists that tokens are looked up in."""
    words = table(spark, sf_dir, "benchmark").select(
        F.explode(F.regexp_extract_all(F.lower("text"), F.lit(r"\p{L}+"), F.lit(0))).alias("term")
    )
    return words.distinct().select("term", pick(TYPES, F.length("term")).alias("type"))


def lexicon(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V3 ``term, type``: long words of the benchmark texts, which make the gold labels."""
    return vocabulary(spark, sf_dir).filter(F.length("term") >= MIN_TERM)


def gold_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V4 ``sid, ent_ix, start, end, type``, the token's own end, its follower's start and the joined forms.

    A lexicon word opens a span that takes in the next token when that begins with a letter.
    """
    shaped = let(
        F.col("tokens"),
        lambda ts: F.transform(
            ts,
            # forms too short for the lexicon end here, before they become rows
            lambda t, i: F.when(F.length(F.lower(t.form)) >= MIN_TERM, F.struct(
                i.alias("ent_ix"), t.form.alias("form"), F.lower(t.form).alias("term"), t.start.alias("start"), t.end.alias("own_end"),
                F.get(ts, i + 1).alias("after"),
            )),
        ),
    )
    rows = located(spark, sf_dir).select("sid", F.inline(F.array_compact(shaped)))
    hits = lookup_join(rows, lexicon(spark, sf_dir), "term", ["sid", "ent_ix"], "inner")
    joined = F.coalesce(F.col("after.form").rlike(r"^\p{L}"), F.lit(False))
    return hits.select(
        "sid", "ent_ix", "start", F.when(joined, F.col("after.end")).otherwise(F.col("own_end")).alias("end"), "type",
        "own_end", F.when(joined, F.col("after.start")).alias("next_start"),
        F.concat_ws(" ", "form", F.when(joined, F.col("after.form"))).alias("text"),
    )


def with_spans(spark: SparkSession, sf_dir: str, clustered: bool = False) -> DataFrame:
    """Sentences with ``tokens`` and ``spans`` (empty where there is none).

    Only sentences that have spans take part in the regrouping; each span list belongs to one sentence.
    """
    spans = settle(
        gold_spans(spark, sf_dir)
        .groupBy("sid")
        .agg(F.sort_array(F.collect_list(F.struct("ent_ix", "start", "end", "type"))).alias("s"))
        .select("sid", F.transform("s", lambda x: F.struct(x.start.alias("start"), x.end.alias("end"), x.type.alias("type"))).alias("spans"))
    )
    side = F.broadcast(spans) if fits_broadcast(spans) else spans
    return located(spark, sf_dir, clustered).join(side, "sid", "left").withColumn(
        "spans", F.coalesce("spans", F.array().cast(SPANS))
    )


def tagged(spark: SparkSession, sf_dir: str, clustered: bool = False) -> DataFrame:
    """Sentences with ``tokens`` and gold ``tags``."""
    return bio_tag(with_spans(spark, sf_dir, clustered)).select("sid", "text", "tokens", "tags")


def degraded(tokens_col, tags_col) -> F.Column:
    """V5 labels of one sentence: gold tags with systematic mistakes."""
    return F.zip_with(
        tokens_col, tags_col,
        lambda t, tag: F.when(F.length(t.form) % 5 == 0, "O")
        .when((F.length(t.form) % 7 == 0) & tag.startswith("I-"), F.concat(F.lit("B-"), F.substring(tag, 3, 1 << 30)))
        .otherwise(tag),
    )


def predicted(spark: SparkSession, sf_dir: str, clustered: bool = False) -> DataFrame:
    """Sentences with ``tokens`` and predicted ``labels``."""
    return tagged(spark, sf_dir, clustered).select("sid", "tokens", degraded(F.col("tokens"), F.col("tags")).alias("labels"))


def predicted_labels(spark: SparkSession, sf_dir: str, clustered: bool = True) -> DataFrame:
    """V5 ``sid, tok_ix, form, start, end, label``."""
    rows = F.arrays_zip(F.col("tokens"), F.col("labels"))
    return exploded(predicted(spark, sf_dir, clustered), ["sid"], rows, "r", "tok_ix").select(
        "sid", "tok_ix", "r.tokens.form", "r.tokens.start", "r.tokens.end", F.col("r.labels").alias("label")
    )


def annotated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sentences with ``entities`` and ``pairs`` (V6) in the annotation model.

    A span over two tokens becomes a two-segment entity, so offset lists are exercised; every
    entity is paired with the one after it in its sentence.
    """
    offset = F.concat_ws(
        ";", F.concat_ws("-", "start", "own_end"), F.when(F.col("next_start").isNotNull(), F.concat_ws("-", "next_start", "end"))
    )
    spans = settle(
        gold_spans(spark, sf_dir).withColumn("offset", offset)
        .groupBy("sid").agg(F.sort_array(F.collect_list(F.struct("ent_ix", "start", "end", "offset", "type"))).alias("s"))
    )
    side = F.broadcast(spans) if fits_broadcast(spans) else spans
    rows = sentences(spark, sf_dir).join(side, "sid", "left").withColumn(
        "s", F.coalesce("s", F.array().cast("array<struct<ent_ix:int,start:int,end:int,offset:string,type:string>>"))
    )
    entities = F.transform(
        "s",
        lambda e: F.struct(
            F.concat_ws(".e", "sid", e.ent_ix).alias("id"), e.offset.alias("offset"), e.type.alias("type"),
            F.substring("text", e.start + 1, e.end - e.start + 1).alias("text"),
        ),
    )
    pairs = F.transform(
        F.arrays_zip(F.slice("s", 1, F.greatest(F.size("s") - 1, F.lit(0))).alias("a"), F.slice("s", 2, F.size("s")).alias("b")),
        lambda z: F.struct(
            F.concat_ws(".p", "sid", z.a.ent_ix).alias("id"),
            F.concat_ws(".e", "sid", z.a.ent_ix).alias("e1"), F.concat_ws(".e", "sid", z.b.ent_ix).alias("e2"),
            ((z.a.ent_ix + z.b.ent_ix) % 3 != 0).cast("string").alias("ddi"),
            pick(RELATIONS, z.a.ent_ix + z.b.ent_ix).alias("type"),
        ),
    )
    return rows.select("sid", "text", entities.alias("entities"), pairs.alias("pairs"))


def term_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``word, vec``: the vector whose id is the word's rank in the sorted vocabulary."""
    ranked, _ = number_rows(vocabulary(spark, sf_dir).select("term"), "term")
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("vec"))
    return ranked.select(F.col("id").alias("vec_id"), F.col("term").alias("word")).join(vectors, "vec_id").select("word", "vec")
