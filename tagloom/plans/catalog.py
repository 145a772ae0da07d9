"""The registered queries: every operator over the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.functions import text as tx
from tagloom.functions.arrays import exploded, strings
from tagloom.functions.scale import scratch_dir, settle
from tagloom.operators import crf, enrich, evaluate as ev, features as ft, naive_bayes as nb
from tagloom.operators import spans as sp
from tagloom.operators import tagger
from tagloom.operators import tokens as tk
from tagloom.plans import runs, views
from tagloom.sources import lexicons, models, rows as rw, vectors, xml
from tagloom.streaming import score as stream

SPAN_KEY = ("sid", "start", "end", "text")
CHEMICAL = ("^[a-z]+(?:ine|ion|ol)$", r"^\d+[A-Za-z]")
AFFIXES = ("anti-", "-ing", "-tion")
#: Labelled sentences ``g4_fit_crf`` is fitted on, about; everything else covers all sentences.
CRF_FIT_ROWS = 300
#: They have converged when ten steps gain less than this part of the loss.
CRF_DELTA = 0.05
#: A best path that is better by more than this is told as the only one.
UNIQUE = 1e-4


# ---------------------------------------------------------------- shared parts


def _forms(s: SparkSession, d: str) -> DataFrame:
    """Distinct forms with their frequency: scalar templates depend on nothing else."""
    return views.tokens(s, d).groupBy("form").agg(F.count("*").alias("n"))


def _rows(s: SparkSession, d: str, clustered: bool = False) -> DataFrame:
    return ft.token_rows(views.tagged(s, d, clustered))


def _basic(s: SparkSession, d: str, clustered: bool = False) -> DataFrame:
    """``token_features`` with basic, character and context templates."""
    return ft.assemble_features(_rows(s, d, clustered))


def _digest(features) -> F.Column:
    return F.md5(F.array_join(features, "\t").cast("binary"))


def _annotated_xml(s: SparkSession, d: str) -> DataFrame:
    path = scratch_dir(s)
    xml.write_annotated_xml(views.annotated(s, d), path)
    return xml.read_annotated_xml(s, path)


def _gold(s: SparkSession, d: str) -> DataFrame:
    """Gold spans as entities whose text is their tokens joined by spaces, the key predictions carry."""
    return views.gold_spans(s, d).select(
        "sid", "start", "end", F.concat_ws("-", "start", "end").alias("offset"), "text", "type"
    )


def _predicted(s: SparkSession, d: str) -> DataFrame:
    return sp.decode_sentences(views.predicted(s, d)).withColumn("offset", F.concat_ws("-", "start", "end"))


def _ner_stats(s: SparkSession, d: str) -> DataFrame:
    return settle(ev.evaluate("NER", _gold(s, d), _predicted(s, d)))


def _rounded(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in ("p", "r", "f1")})


# ---------------------------------------------------------------- sources and sinks


def a1_read_annotated_xml(s, d):
    return _annotated_xml(s, d).select(
        "sid", "text", F.size("entities").alias("n_entities"), F.size("pairs").alias("n_pairs")
    )


def a2_entity_segments(s, d):
    return xml.entity_segments(views.annotated(s, d))


def a3_gold_entities(s, d):
    return xml.gold_entities(views.annotated(s, d))


def a4_gold_relations(s, d):
    return xml.gold_relations(views.annotated(s, d))


def a5_read_lexicon(s, d):
    path = scratch_dir(s)
    words = views.table(s, d, "benchmark").select(F.explode(F.split("text", r"\.")).alias("line"))
    words.select(F.concat(F.lit("\t "), "line", F.lit("  ")).alias("value")).write.text(path)
    return lexicons.read_lexicon(s, path)


def _vector_lines(s, d) -> str:
    """Word vectors as text, in word order, each word's line preceded by one with another vector."""
    path = scratch_dir(s)
    vec = views.term_vectors(s, d)
    lines = vec.select("word", F.explode(F.array(F.lit(0), F.lit(1))).alias("k"), "vec").select(
        "word", "k", F.concat_ws(" ", "word", F.transform("vec", lambda x: (x * F.col("k")).cast("string"))).alias("value")
    )
    lines.orderBy("word", "k").select("value").write.text(path)
    return path


def a6_read_embeddings(s, d):
    vec = vectors.read_embeddings(s, _vector_lines(s, d))
    return vec.select(
        "word", F.size("vec").alias("dim"), F.get("vec", F.lit(0)).alias("first"), F.get("vec", F.lit(49)).alias("last")
    )


def a6_first_vectors(s, d):
    """What the first lines of the file hold, as the vocabulary is usually bounded."""
    return vectors.read_embeddings(s, _vector_lines(s, d), max_vocab=300).select("word", F.get("vec", F.lit(0)).alias("first"))


def a7_write_features(s, d):
    path = scratch_dir(s)
    rw.write_features(ft.assemble_features(_rows(s, d, True)), path, compression="gzip")
    lines = s.read.option("lineSep", "\n\n").text(path)
    return lines.select(
        F.substring_index("value", "\t", 1).alias("sid"),
        F.md5(F.regexp_replace("value", r"^\n+|\n+$", "").cast("binary")).alias("digest"),
    ).filter(F.col("sid") != "")


def a8_read_features(s, d):
    path = scratch_dir(s)
    rw.write_features(_basic(s, d, True), path, compression="gzip")
    return rw.read_features(s, path).select(
        "sid", "tok_ix", "form", "start", "end", "tag", _digest(F.col("features")).alias("digest")
    )


def a9_classification_rows(s, d):
    rows = rw.classification_rows(_basic(s, d))
    return rows.groupBy("tag", _digest(F.col("features")).alias("digest")).agg(F.count("*").alias("n"))


def a10_predictions(s, d):
    path = scratch_dir(s)
    rw.write_predictions(_predicted(s, d).drop("offset"), path)
    return rw.read_predictions(s, path)


def a11_model_round_trip(s, d):
    path = scratch_dir(s)
    models.save_model(nb.fit_naive_bayes(_character_rows(s, d)), path)
    loaded = models.load_model(s, path)
    return loaded.tables["log_prob"].select(
        "feature", "tag", F.round("logp", 6).alias("logp"), F.lit(loaded.kind).alias("kind")
    )


def a11_crf_round_trip(s, d):
    path = scratch_dir(s)
    models.save_model(_counted_chain(s, d), path)
    loaded = models.load_model(s, path)
    rows = loaded.tables["attribute_weights"].select(F.col("attribute").alias("from"), F.col("label").alias("to"), "weight").unionAll(
        loaded.tables["transitions"].select("label_from", "label_to", "weight")
    )
    return rows.select("from", "to", F.round("weight", 6).alias("weight"), F.lit(loaded.kind).alias("kind"))


def a12_lexicon_from_drugbank(s, d):
    parts = views.table(s, d, "part").join(
        views.table(s, d, "lineitem").groupBy(F.col("l_partkey").alias("p_partkey")).agg(
            F.collect_set("l_returnflag").alias("flags")
        ),
        "p_partkey", "left",
    )
    drugs = parts.select(
        F.concat_ws(" ", "p_name", "p_brand").alias("name"),
        F.array(F.lower("p_type"), F.when(F.col("p_size") > 25, "approved").otherwise("withdrawn")).alias("groups"),
        F.transform("flags", lambda f: F.concat_ws(" ", "p_brand", f)).alias("synonyms"),
        F.array(F.upper("p_name")).alias("products"),
    )
    return lexicons.lexicon_from_drugbank(drugs)


def a13_lexicon_from_chembl(s, d):
    part, line = views.table(s, d, "part"), views.table(s, d, "lineitem")
    supplier, nation = views.table(s, d, "supplier"), views.table(s, d, "nation")
    return lexicons.lexicon_from_chembl(
        part.select(F.col("p_partkey").alias("molregno"), F.col("p_name").alias("pref_name"), (F.col("p_size") % 5).alias("max_phase")),
        line.select(F.col("l_partkey").alias("molregno"), F.col("l_returnflag").alias("synonyms")),
        supplier.select(F.col("s_suppkey").alias("molregno"), (F.col("s_nationkey") % 3 + 3).alias("max_phase_for_ind")),
        nation.select(
            F.col("n_nationkey").cast("long").alias("molregno"),
            F.when(F.col("n_regionkey") > 1, F.col("n_nationkey")).otherwise(F.lit(-1)).cast("long").alias("parent_molregno"),
        ),
    )


def a14_lexicon_from_annotations(s, d):
    return lexicons.lexicon_from_annotations(xml.gold_entities(views.annotated(s, d)))


# ---------------------------------------------------------------- tokens and labels


def b1_tokenize(s, d):
    rows = tk.tokenize(views.sentences(s, d))
    return rows.select("sid", F.size("forms").alias("n"), F.array_join("forms", " ").alias("forms"))


def b1_tokenize_treebank(s, d):
    rows = tk.tokenize(views.sentences(s, d), "treebank")
    return rows.select("sid", F.size("forms").alias("n"), F.array_join("forms", " ").alias("forms"))


def b2_align_offsets(s, d):
    return views.tokens(s, d)


def b2_align_offsets_treebank(s, d):
    rows = tk.align_offsets(views.sentences(s, d), "treebank")
    return exploded(rows, ["sid"], F.col("tokens"), "t", "tok_ix").select("sid", "tok_ix", "t.*")


def b3_bio_tag(s, d):
    return views.tagged(s, d).select("sid", F.array_join("tags", " ").alias("tags"))


def b4_sanitize(s, d):
    # forms from the raw HTML lines, so that tabs occur; the empty ones must go
    pages = views.spread(views.table(s, d, "pages"))
    pieces = pages.select(F.col("page_id").cast("string").alias("sid"), F.posexplode(F.split("html", " ")).alias("tok_ix", "form"))
    rows = pieces.select("sid", "tok_ix", "form", F.lit("O").alias("tag"), F.array(ft.keyed("form", F.col("form"))).alias("features"))
    return tk.sanitize(rows).select("sid", "tok_ix", "form", F.array_join("features", "\t").alias("features"))


# ---------------------------------------------------------------- scalar features


def c1_form(s, d):
    return _forms(s, d).select("form", F.lower("form").alias("form_lower"), "n")


def c2_affixes(s, d):
    form = F.col("form")
    return _forms(s, d).select(
        "form", "n",
        *[tx.prefix(form, n).alias(f"pref{n}") for n in ft.AFFIX_LENGTHS],
        *[tx.suffix(form, n).alias(f"suf{n}") for n in ft.AFFIX_LENGTHS],
    )


def c3_char_bigrams(s, d):
    grams = [tx.char_ngram(F.col("form"), ft.NGRAM, k) for k in range(ft.MAX_NGRAMS)]
    return _forms(s, d).select("form", "n", F.concat_ws(" ", *grams).alias("grams"))


def c4_word_shape(s, d):
    return _forms(s, d).select("form", "n", tx.word_shape(F.col("form")).alias("shape"))


def c5_casing(s, d):
    return _forms(s, d).select("form", "n", tx.casing(F.col("form")).alias("casing"))


def c6_flags(s, d):
    # white-space pieces of the raw lines, which keep hyphens and brackets inside
    pieces = views.sentences(s, d).select(F.explode(F.split("text", " ")).alias("form")).groupBy("form").agg(F.count("*").alias("n"))
    form = F.col("form")
    return pieces.select(
        "form", "n", tx.has_digit(form).alias("has_digit"), tx.has_hyphen(form).alias("has_hyphen"),
        tx.has_parenthesis(form).alias("has_parenthesis"), tx.has_bracket(form).alias("has_bracket"),
        tx.is_long(form).alias("is_long"),
    )


def c7_patterns(s, d):
    chem, affix = ft.pattern_templates(F.col("form"), CHEMICAL, AFFIXES)
    return _forms(s, d).select("form", "n", chem.alias("chem"), affix.alias("affix"))


# ---------------------------------------------------------------- context features


def d1_previous(s, d):
    prev = F.col("prev")
    return _rows(s, d).select(
        "sid", "tok_ix", prev.form.alias("form_prev"), prev.lower.alias("form_lower_prev"),
        prev.casing.alias("casing_prev"), ft.bigram(prev, F.col("lower")).alias("bigram"),
    )


def d2_previous2(s, d):
    return _rows(s, d).select(
        "sid", "tok_ix", F.col("prev2.form").alias("form_prev2"),
        ft.trigram(F.col("prev2"), F.col("prev"), F.col("lower")).alias("trigram"),
    )


def d3_next(s, d):
    nxt = F.col("next")
    return _rows(s, d).select(
        "sid", "tok_ix", nxt.form.alias("form_next"), nxt.lower.alias("form_lower_next"), nxt.casing.alias("casing_next")
    )


def d4_next2(s, d):
    # the window form, for tokens that are already rows
    return ft.neighbours_by_window(views.tokens(s, d)).select("sid", "tok_ix", F.col("next2.form").alias("form_next2"))


def d5_boundaries(s, d):
    rows = _rows(s, d)
    return rows.select(
        "sid", "tok_ix", F.col("prev").isNull().alias("bos"), F.col("next").isNull().alias("eos")
    ).filter("bos or eos")


# ---------------------------------------------------------------- enrichment


def e1_fuzzy_lexicon(s, d):
    flagged = enrich.fuzzy_lexicon_join(views.tokens(s, d), views.vocabulary(s, d).select("term"), "similar")
    return flagged.groupBy(F.lower("form").alias("word"), "similar").agg(F.count("*").alias("n"))


def e2_exact_lexicon(s, d):
    flagged = enrich.exact_lexicon_flags(views.tokens(s, d), views.vocabulary(s, d), _names(s, d))
    names = ["in_drug_lexicon", "in_brand_list", "in_group_list", "in_lexicon"]
    return flagged.groupBy(F.lower("form").alias("word"), *names).agg(F.count("*").alias("n"))


def _names(s, d) -> DataFrame:
    """An external list: the words of the conversations."""
    words = views.table(s, d, "conversations").select(
        F.explode(F.regexp_extract_all(F.lower("text"), F.lit(r"\p{L}+"), F.lit(0))).alias("term")
    )
    return words.distinct()


def _tag_table(s, d) -> DataFrame:
    """Forms tagged with the language they occur in most."""
    docs = views.spread(views.table(s, d, "documents").select("text", "lang"))
    words = docs.select(F.explode(F.regexp_extract_all("text", F.lit(r"\p{L}+"), F.lit(0))).alias("form"), F.col("lang").alias("pos"))
    return enrich.tag_table(words)


def e3_pos(s, d):
    tagged = enrich.pos_feature(views.tokens(s, d), _tag_table(s, d))
    return tagged.groupBy("form", "pos").agg(F.count("*").alias("n"))


def _tagger(s, d) -> tagger.TagModel:
    """A tagger of gold labels, which depend on what stands beside a token."""
    return tagger.fit_tagger(views.tagged(s, d).select(F.col("tokens.form").alias("forms"), "tags"))


def e3_fit_tagger(s, d):
    """All counts of the model, and how many moves each order of context foretells best."""
    m, none = _tagger(s, d), F.lit(None).cast("string")
    rows = m.moves.select(F.lit("move").alias("kind"), F.col("before2").alias("a"), F.col("before").alias("b"), "tag", "n")
    rows = rows.unionAll(m.words.select(F.lit("word"), "form", none, "tag", "n")).unionAll(m.endings.select(F.lit("ending"), "ending", none, "tag", "n"))
    return rows.unionAll(tagger.interpolation(m).select(F.lit("order"), F.col("order").cast("string"), none, none, "n"))


def e3_guess_tags(s, d):
    """Tag shares, by their endings, of the words of conversations, seen in documents or not."""
    shares = tagger.guesses(_tagger(s, d), _names(s, d).select(F.col("term").alias("form")))
    return shares.select("form", "tag", F.round("share", 6).alias("share"))


def e3_context_tags(s, d):
    """Every sentence tagged from context."""
    rows = views.located(s, d).select("sid", F.col("tokens.form").alias("forms"))
    found = tagger.tag_sentences(rows, _tagger(s, d))
    return found.select("sid", F.size("pos").alias("n"), F.array_join("pos", " ").alias("path"), F.round("score", 4).alias("score"))


def e4_embedding_bins(s, d):
    rows = enrich.embedding_bins(views.tokens(s, d), views.term_vectors(s, d))
    return rows.groupBy(F.lower("form").alias("word"), F.array_join("embedding", " ").alias("bins")).agg(F.count("*").alias("n"))


def e5_embedding_truncated(s, d):
    rows = enrich.embedding_truncated(views.tokens(s, d), views.term_vectors(s, d))
    long = rows.groupBy(F.lower("form").alias("word"), "embedding").agg(F.count("*").alias("n"))
    exploded = long.select("word", "n", F.posexplode("embedding").alias("i", "f"))
    return exploded.select("word", "n", "i", F.substring_index("f", "=", -1).try_cast("double").alias("value"))


def e6_assemble(s, d):
    return _basic(s, d).select("sid", "tok_ix", F.size("features").alias("n"), _digest(F.col("features")).alias("digest"))


# ---------------------------------------------------------------- Naive Bayes


def _character_rows(s, d) -> DataFrame:
    """Training rows with the scalar templates only."""
    rows = _rows(s, d)
    feats = strings(
        *ft.basic_templates(F.col("form"), F.col("lower")), *ft.character_templates(F.col("form"), F.col("casing"))
    )
    return rows.select("tag", feats.alias("features"))


def f1_boundary_rewrite(s, d):
    return _basic(s, d).select("sid", "tok_ix", _digest(nb.boundary_rewrite(F.col("features"))).alias("digest"))


def f2_feature_map(s, d):
    maps = nb.feature_maps(_basic(s, d).select("features"), {"train": "train", "predict": "predict"})
    both = maps.select(F.explode(F.array(*[F.struct(F.lit(p).alias("phase"), F.col(p).alias("m")) for p in ("train", "predict")])).alias("z"))
    return both.select("z.phase", F.explode("z.m").alias("key", "value")).groupBy("phase", "key").agg(
        F.count("*").alias("n"), F.countDistinct("value").alias("n_values"), F.sum(F.length("value")).alias("n_chars")
    )


def f3_vocabulary(s, d):
    vocab = nb.fit_vocabulary(_basic(s, d).select("tag", "features"))
    return vocab.groupBy(ft.feature_key(F.col("feature")).alias("key")).agg(
        F.count("*").alias("n"), F.sum(F.length("feature")).alias("n_chars")
    )


def _nb_model(s, d):
    return nb.fit_naive_bayes(_basic(s, d).select("tag", "features"))


def f4_fit_naive_bayes(s, d):
    model = _nb_model(s, d)
    scaled = F.round(F.col("logp") * 1_000_000).cast("long")
    pairs = model.tables["log_prob"].groupBy("tag", ft.feature_key(F.col("feature")).alias("key")).agg(
        F.count("*").alias("n"), F.sum(scaled).alias("micro_logp")
    )
    priors = model.tables["prior"].select("tag", F.lit("PRIOR").alias("key"), F.lit(1).cast("long").alias("n"), scaled.alias("micro_logp"))
    defaults = model.tables["default_log"].select("tag", F.lit("DEFAULT").alias("key"), F.lit(1).cast("long").alias("n"), scaled.alias("micro_logp"))
    return pairs.unionByName(priors).unionByName(defaults)


def _nb_labels(s, d) -> DataFrame:
    rows = _basic(s, d, True)
    return nb.predict_naive_bayes(nb.fit_naive_bayes(rows.select("tag", "features")), rows)


def f5_predict_naive_bayes(s, d):
    return _nb_labels(s, d).select("sid", "tok_ix", "label", "score")


# ---------------------------------------------------------------- CRF


def g1_label_distribution(s, d):
    return crf.label_distribution(exploded(views.tagged(s, d), [], F.col("tags"), "tag"))


def g2_class_weights(s, d):
    return crf.class_weights(settle(g1_label_distribution(s, d))).withColumn("weight", F.round("weight", 6))


def g3_sequence_weights(s, d):
    tagged = views.tagged(s, d).select("sid", "tags")
    weights = crf.class_weights(settle(crf.label_distribution(exploded(tagged, [], F.col("tags"), "tag"))))
    return crf.sequence_weights(tagged, weights).select("sid", F.round("weight", 6).alias("weight"))


def _chain_rows(s, d, clustered: bool = False) -> DataFrame:
    """Tokens with all basic, character and context templates."""
    return _basic(s, d, clustered).select("sid", "tok_ix", "form", "start", "end", "tag", "features")


def g4_crf_gradient(s, d):
    """Loss and gradient before the first step, which have a closed form."""
    found = crf.gradient_at_zero(crf.to_sequences(_chain_rows(s, d, True)))
    return found.select("kind", "from", "to", F.round("g", 3).alias("g"))


def g4_fit_crf(s, d):
    share = -(-views.sentences(s, d).count() // CRF_FIT_ROWS)
    chosen = settle(_chain_rows(s, d, True).filter(F.pmod(F.xxhash64("sid"), F.lit(max(1, share))) == 0))
    model = crf.fit_crf(crf.to_sequences(chosen), delta=CRF_DELTA)
    attrs = model.tables["attribute_weights"].select(
        F.col("attribute").alias("from"), F.col("label").alias("to"), F.round("weight", 3).alias("weight")
    )
    trans = model.tables["transitions"].select(F.col("label_from").alias("from"), F.col("label_to").alias("to"), F.round("weight", 3).alias("weight"))
    return attrs.unionByName(trans)


def _counted_chain(s, d) -> models.Model:
    """A chain model whose weights are log counts, so that SQL can restate it."""
    rows = _chain_rows(s, d)
    attrs = exploded(rows, ["tag"], F.col("features"), "attribute").groupBy("attribute", F.col("tag").alias("label")).agg(
        F.count("*").alias("n")
    ).withColumn("weight", F.log(F.col("n") + 1.0))
    seqs = views.tagged(s, d).select(
        F.explode(F.arrays_zip(F.slice("tags", 1, F.greatest(F.size("tags") - 1, F.lit(0))).alias("a"), F.slice("tags", 2, F.size("tags")).alias("b"))).alias("z")
    )
    trans = seqs.groupBy(F.col("z.a").alias("label_from"), F.col("z.b").alias("label_to")).agg(F.log(F.count("*") + 1.0).alias("weight"))
    attrs, trans = settle(attrs), settle(trans)
    labels = sorted(r["label"] for r in attrs.select("label").distinct().collect())
    return models.Model("crf", labels, {"attribute_weights": attrs, "transitions": trans})


def g5_decode_crf(s, d):
    best = crf.decode_sequences(_counted_chain(s, d), _chain_rows(s, d, True).drop("tag"))
    path = F.when(F.col("margin") > UNIQUE, F.array_join("labels", " "))
    return best.select("sid", F.size("labels").alias("n"), F.round("score", 4).alias("score"), path.alias("path"))


# ---------------------------------------------------------------- spans and scores


def h1_bio_decode(s, d):
    return sp.bio_decode(views.predicted_labels(s, d))


def h1_bio_decode_keep_adjacent(s, d):
    return sp.decode_sentences(views.predicted(s, d), drop_adjacent=False)


def i1_instance_sets(s, d):
    return ev.instance_sets(_gold(s, d))


def i2_statistics(s, d):
    return _rounded(ev.statistics(ev.instance_sets(_gold(s, d)), ev.instance_sets(_predicted(s, d))))


def i3_macro_average(s, d):
    return _rounded(ev.macro_average(_ner_stats(s, d)))


def i4_micro_average(s, d):
    return _rounded(ev.micro_average(_ner_stats(s, d)))


def i5_evaluate_relations(s, d):
    """Relations whose first entity was predicted, under the type of the next relation class."""
    gold = xml.gold_relations(views.annotated(s, d))
    guessed = gold.filter(F.length("e1") % 3 != 0).withColumn(
        "type", F.when(F.length("e2") % 4 == 0, F.lit("effect")).otherwise(F.col("type"))
    )
    return _rounded(ev.evaluate("DDI", gold, guessed))


def i6_ablation(s, d):
    rows = settle(runs.extract_features(views.with_spans(s, d), runs.Resources(**_lists(s, d))))
    return _rounded(runs.ablation(rows, rows, settle(_gold(s, d))))


def i7_error_analysis(s, d):
    return ev.error_analysis(_gold(s, d), _predicted(s, d))


# ---------------------------------------------------------------- whole runs


def _resources(s, d) -> runs.Resources:
    return runs.Resources(**_lists(s, d), tags=_tag_table(s, d), embeddings=views.term_vectors(s, d))


def _lists(s, d) -> dict[str, DataFrame]:
    terms = views.vocabulary(s, d)
    return {"approved": terms.filter("type <> 'drug_n'").select("term"), "not_approved": terms.filter("type = 'drug_n'").select("term")}


def j1_extract_features(s, d):
    rows = runs.extract_features(views.with_spans(s, d), _resources(s, d))
    return rows.select("sid", "tok_ix", "tag", F.size("features").alias("n"), _digest(F.col("features")).alias("digest"))


def _in_train(sid: str = "sid") -> F.Column:
    """Each sentence is in one of two halves, by a digest of its id."""
    return F.md5(F.col(sid).cast("binary")) < "8"


def j2_train_and_score(s, d):
    rows = _basic(s, d, True)  # each half is read once, so nothing is written
    model = nb.fit_naive_bayes(rows.filter(_in_train()).select("tag", "features"))
    labels = runs.label_tokens(model, rows.filter(~_in_train()))
    return _rounded(ev.evaluate("NER", _gold(s, d).filter(~_in_train()), runs.entities_of(settle(labels))))


def j2_train_and_score_both(s, d):
    """Both taggers over one half, scored on it and on the other."""
    rows = settle(views.with_spans(s, d))
    entities = F.transform("spans", lambda x: F.struct(
        F.concat_ws(".", "sid", x.start).alias("id"), F.concat_ws("-", x.start, x.end).alias("offset"), x.type.alias("type"),
        F.array_join(F.transform(F.filter("tokens", lambda t: (t.start >= x.start) & (t.end <= x.end)), lambda t: t.form), " ").alias("text"),
    ))
    rows = settle(rows.select("sid", "text", entities.alias("entities")))
    stats = runs.train_and_score(
        rows.filter(_in_train()), rows.filter(~_in_train()), runs.Resources(**_lists(s, d)), mode="simple", delta=CRF_DELTA
    )
    out = None
    for name, table in stats.items():
        one = _rounded(table).withColumn("run", F.lit(name))
        out = one if out is None else out.unionByName(one)
    return out


def _streamed(s, d, model: models.Model, resources: runs.Resources | None = None) -> DataFrame:
    base = scratch_dir(s)
    views.sentences(s, d).write.parquet(f"{base}/in")
    query = stream.score_stream(stream.read_sentence_stream(s, f"{base}/in"), model, f"{base}/out", f"{base}/checkpoint", resources)
    query.awaitTermination()
    return s.read.parquet(f"{base}/out").select("sid", "start", "end", "text", "type")


def j3_score_stream(s, d):
    train = runs.extract_features(views.with_spans(s, d))
    return _streamed(s, d, nb.fit_naive_bayes(train.select("tag", "features")))


def j3_score_stream_lookups(s, d):
    """Naive Bayes with tags, word vectors and both term lists."""
    train = runs.extract_features(views.with_spans(s, d), _resources(s, d))
    return _streamed(s, d, nb.fit_naive_bayes(train.select("tag", "features")), _resources(s, d))


def j3_score_stream_crf(s, d):
    """A chain model whose weights are each label's share of an attribute and of a move, with the same tables."""
    counted = _counted_chain(s, d)
    attrs, moves = counted.tables["attribute_weights"], counted.tables["transitions"].withColumn("n", F.exp("weight") - 1)
    share = lambda rows, key: rows.join(rows.groupBy(key).agg(F.sum("n").alias("all")), key).withColumn("weight", F.col("n") / F.col("all"))
    tables = {"attribute_weights": share(attrs, "attribute").drop("all"), "transitions": share(moves, "label_from").drop("all", "n")}
    return _streamed(s, d, models.Model("crf", counted.labels, tables), _resources(s, d))


def entry(s: SparkSession, d: str) -> DataFrame:
    """Precision, recall and F1 per entity type of decoded labels against gold spans."""
    return _rounded(ev.evaluate("NER", _gold(s, d), _predicted(s, d)))


def _is_query(name: str) -> bool:
    return name[0] in "abcdefghij" and name[1:2].isdigit()


QUERIES = {name: fn for name, fn in list(globals().items()) if callable(fn) and _is_query(name)}
