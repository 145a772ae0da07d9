"""Small tables that hold the odd cases every operator has to survive."""

from __future__ import annotations

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long, n_words string, spans string, score string, label string"


def documents(spark, texts, langs=None, sources=None):
    """One document per text, ids from 0; further columns clash with the operators' own names."""
    rows = []
    for k, text in enumerate(texts):
        lang = langs[k] if langs else "en"
        source = sources[k] if sources else f"s{k % 3}"
        rows.append((k, text, lang, source, len(text or ""), "x", "y", "z", "w"))
    return spark.createDataFrame(rows, DOCUMENTS).repartition(3)


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}
