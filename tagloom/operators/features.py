"""Token feature templates: scalar, context and the assembled list.

``token_rows`` explodes a sentence once, carrying the neighbours each context template needs, so no
window (and no shuffle) is involved; the scalar templates are then plain columns on token rows.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from tagloom.functions import text as tx
from tagloom.functions.arrays import empty_strings, exploded, let

AFFIX_LENGTHS = (3, 4, 5)
NGRAM, MAX_NGRAMS = 2, 5
NEIGHBOURS = ("prev2", "prev", "next", "next2")
WORDS = "array<struct<form:string,lower:string,casing:string>>"

# --- fixed values: feature keys by group, for ablation ---
GROUPS = {
    "lexicon": [
        "fuzzyApprovedDrugsLexicon", "fuzzyNotApprovedDrugsLexicon",
        "inDrugLexicon", "inBrandList", "inGroupList", "inLexicon",
    ],
    "context": [
        "formPrev", "formLowerPrev", "casingPrev", "bigram", "formPrev2", "trigram",
        "formNext", "formLowerNext", "casingNext", "formNext2", "suf3Prev", "suf3Next", "BoS", "EoS",
    ],
    "orthographic": [
        "wordShape", "casing", "hasDigit", "hasHyphen", "hasParenthesis", "hasBracket", "isLongWord",
    ],
    "suffix": ["suf3", "suf4", "suf5"],
}
# --- end of fixed values ---


def token_rows(sentences: DataFrame) -> DataFrame:
    """One row per token: ``sid, tok_ix, form, start, end, tag, casing`` and its four neighbours.

    Needs ``sid`` and ``tokens``; uses ``tags`` when present. Neighbours are structs
    ``<form,lower,casing>``, null beyond the ends of the sentence.
    """
    tags = F.col("tags") if "tags" in sentences.columns else F.array().cast("array<string>")
    described = F.transform(
        "tokens",
        lambda t: F.struct(t.form.alias("form"), F.lower(t.form).alias("lower"), tx.casing(t.form).alias("casing")),
    )

    # lists of the same length side by side, each neighbour a list moved by one or two places
    none, n = F.lit(None), F.size("tokens")
    moved = lambda words, by: F.slice(F.concat(F.array(*[none] * by).cast(WORDS), words), 1, n)
    later = lambda words, by: F.slice(words, by + 1, n)
    beside = let(described, lambda words: F.arrays_zip(
        F.col("tokens").alias("token"), F.slice(F.coalesce(tags, empty_strings()), 1, n).alias("tag"), words.alias("word"),
        moved(words, 2).alias("prev2"), moved(words, 1).alias("prev"), later(words, 1).alias("next"), later(words, 2).alias("next2"),
    ))
    return exploded(sentences.select("sid", beside.alias("_rows")), ["sid"], F.col("_rows"), "r", "tok_ix").select(
        "sid", "tok_ix", "r.word.form", "r.token.start", "r.token.end", "r.tag", "r.word.lower", "r.word.casing", *[f"r.{c}" for c in NEIGHBOURS]
    )


def neighbours_by_window(tokens: DataFrame) -> DataFrame:
    """The same neighbours for data that is already one token per row (windows partitioned by sentence)."""
    w = Window.partitionBy("sid").orderBy("tok_ix")
    described = F.struct("form", F.lower("form").alias("lower"), tx.casing(F.col("form")).alias("casing"))
    return (
        tokens.withColumn("_t", described)
        .select(
            *[c for c in tokens.columns],
            F.col("_t.lower").alias("lower"),
            F.col("_t.casing").alias("casing"),
            F.lag("_t", 2).over(w).alias("prev2"),
            F.lag("_t", 1).over(w).alias("prev"),
            F.lead("_t", 1).over(w).alias("next"),
            F.lead("_t", 2).over(w).alias("next2"),
        )
    )


def keyed(key: str, value: Column) -> Column:
    return F.concat(F.lit(f"{key}="), value)


def flag(key: str, condition: Column) -> Column:
    return F.when(condition, F.lit(f"{key}=true"))


def basic_templates(form: Column, lower: Column) -> list[Column]:
    out = [keyed("form", form), keyed("formLower", lower)]
    for n in AFFIX_LENGTHS:
        out += [keyed(f"pref{n}", tx.prefix(form, n)), keyed(f"suf{n}", tx.suffix(form, n))]
    return out


def character_templates(form: Column, casing: Column) -> list[Column]:
    return [
        *[keyed("char2gram", tx.char_ngram(form, NGRAM, k)) for k in range(MAX_NGRAMS)],
        keyed("wordShape", tx.word_shape(form)),
        keyed("casing", casing),
        flag("hasDigit", tx.has_digit(form)),
        flag("hasHyphen", tx.has_hyphen(form)),
        flag("hasParenthesis", tx.has_parenthesis(form)),
        flag("hasBracket", tx.has_bracket(form)),
        flag("isLongWord", tx.is_long(form)),
    ]


def bigram(prev: Column, lower: Column) -> Column:
    return F.concat(prev.getField("lower"), F.lit("_"), lower)


def trigram(prev2: Column, prev: Column, lower: Column) -> Column:
    return F.concat(prev2.getField("lower"), F.lit("_"), prev.getField("lower"), F.lit("_"), lower)


def context_templates(prev2: Column, prev: Column, nxt: Column, nxt2: Column, lower: Column) -> list[Column]:
    return [
        keyed("formPrev", prev.getField("form")),
        keyed("formLowerPrev", prev.getField("lower")),
        keyed("casingPrev", prev.getField("casing")),
        keyed("bigram", bigram(prev, lower)),
        keyed("formPrev2", prev2.getField("form")),
        keyed("trigram", trigram(prev2, prev, lower)),
        F.when(prev.isNull(), "BoS"),
        keyed("formNext", nxt.getField("form")),
        keyed("formLowerNext", nxt.getField("lower")),
        keyed("casingNext", nxt.getField("casing")),
        keyed("formNext2", nxt2.getField("form")),
        F.when(nxt.isNull(), "EoS"),
    ]


def pattern_templates(form: Column, chemical: Iterable[str] = (), affixes: Iterable[str] = ()) -> list[Column]:
    """``chemPattern`` and ``drugAffix`` from patterns and affixes the caller supplies.

    An affix written ``-x`` is a suffix, ``x-`` a prefix; both are compared in lower case.
    """
    chemical, affixes = list(chemical), list(affixes)
    out = []
    if chemical:
        out.append(flag("chemPattern", form.rlike("|".join(f"(?:{p})" for p in chemical))))
    if affixes:
        low, hit = F.lower(form), F.lit(False)
        for a in affixes:
            hit = hit | (low.endswith(a[1:].lower()) if a.startswith("-") else low.startswith(a.rstrip("-").lower()))
        out.append(flag("drugAffix", hit))
    return out


TOKEN_FEATURES = ["sid", "tok_ix", "form", "start", "end", "tag", "features"]


def assemble_features(
    rows: DataFrame, pos: Column | None = None, embedding: Column | None = None, lexicon: Iterable[Column] = (),
    extra: Iterable[Column] = (),
) -> DataFrame:
    """``token_features`` with templates in fixed order: basic, character, context, pos, embedding, lexicon.

    ``embedding`` is an array column; ``pos`` and ``lexicon`` are (nullable) string columns. Tokens hold
    no white space, so joining on tabs (which skips nulls) and splitting gives the list without a lambda.
    """
    form, lower, casing = F.col("form"), F.col("lower"), F.col("casing")
    parts = basic_templates(form, lower) + character_templates(form, casing) + list(extra) + context_templates(*map(F.col, NEIGHBOURS), lower)
    if pos is not None:
        parts.append(pos)
    if embedding is not None:
        parts.append(embedding)
    features = F.split(F.concat_ws("\t", *parts, *lexicon), "\t")
    return rows.withColumn("features", features).select(*TOKEN_FEATURES)


def feature_key(feature: Column) -> Column:
    """The part before the first ``=`` (the whole feature when there is none)."""
    return F.substring_index(feature, "=", 1)
