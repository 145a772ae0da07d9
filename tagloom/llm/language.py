"""Language identification: multinomial naive Bayes over hashed character n-grams.

Counts of every n-gram bucket and language are summed over all labelled documents (each task sums its own rows first).
The log-probability matrix has a fixed number of buckets times the languages, is broadcast, and batches are scored in
numpy. Texts are lower-cased; characters that are no letters count as one kind of gap.

Null texts and texts without a letter are ``und`` with score 0; so is everything when nothing was learned. Rows with a
null language are not learned from. Ties go to the smaller language name. Repeated rows are learned and answered one by one.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.llm.common import id_bucket, pieces

BUCKETS = 1 << 16
#: A text's evidence counts as at most so many n-grams in its score, so long texts are not all at 1.
EVIDENCE = 64
GAP = 32


@lru_cache(1)
def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def grams(texts: list[str]) -> tuple[list[np.ndarray], list[np.ndarray], np.ndarray]:
    """Buckets of all 2- and 3-grams and the text of each, by order; and which texts have a letter."""
    low = [(t or "").lower() for t in texts]
    chars = np.frombuffer("".join(x + " " for x in low).encode("utf-32-le", "surrogatepass"), np.uint32)
    doc = np.repeat(np.arange(len(low), dtype=np.int32), [len(x) + 1 for x in low])
    letter = _letters()[chars]
    lettered = np.bincount(doc, letter, len(low)) > 0
    c = np.where(letter, chars, GAP).astype(np.uint64)
    buckets, of = [], []
    pair = c[:-1] * np.uint64(0x9E3779B1) + c[1:]
    keep = (letter[:-1] | letter[1:]) & (doc[:-1] == doc[1:])
    for order in (2, 3):
        if order == 3:
            pair = pair[:-1] * np.uint64(0x85EBCA77) + c[2:]
            keep = keep[:-1] & letter[1:-1] & (doc[:-2] == doc[2:])
        h = (pair[keep] + np.uint64(order)) * np.uint64(0x9E3779B97F4A7C15)
        buckets.append((h >> np.uint64(64 - 16)).astype(np.int32))
        of.append(doc[: len(keep)][keep])
    return buckets, of, lettered


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    totals: dict[str, np.ndarray] = {}
    for batch in pieces(batches):
        langs = batch.column("lang").to_pylist()
        names = sorted(set(langs))
        code = np.array([names.index(x) for x in langs], np.int64)
        buckets, of, _ = grams(batch.column("text").to_pylist())
        sums = sum(np.bincount(code[d] * BUCKETS + b, minlength=len(names) * BUCKETS) for b, d in zip(buckets, of, strict=True))
        for k, name in enumerate(names):
            totals[name] = totals.get(name, 0) + sums[k * BUCKETS : (k + 1) * BUCKETS]
    for name, sums in totals.items():
        at = np.flatnonzero(sums)
        yield pa.RecordBatch.from_pydict({"lang": pa.array([name] * len(at), pa.string()), "bucket": pa.array(at, pa.int32()), "n": pa.array(sums[at], pa.int64())})


def fit(labelled: DataFrame) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Languages, log-probabilities by bucket and language, and log-priors.

    What reaches the driver has at most BUCKETS rows for each language, whatever the number of documents.
    """
    rows = labelled.select("lang", "text").filter("lang IS NOT NULL AND text IS NOT NULL")
    counts = rows.mapInArrow(_count, "lang string, bucket int, n bigint").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    docs = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    langs = sorted(counts["lang"].unique())
    table = np.ones((BUCKETS, len(langs)))
    for k, lang in enumerate(langs):
        own = counts[counts["lang"] == lang]
        table[own["bucket"].to_numpy(), k] += own["n"].to_numpy()
    prior = np.log(np.array([docs[x] for x in langs], float) / max(1, sum(docs[x] for x in langs)))
    return langs, np.log(table / table.sum(axis=0)).astype(np.float32), prior


def predict(documents: DataFrame, model: tuple[list[str], np.ndarray, np.ndarray], keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """The columns ``keep`` of documents with lang_pred and score, which those must not hold; only text is looked at."""
    sent = documents.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        langs, table, prior = sent.value
        for batch in pieces(batches):
            n = batch.num_rows
            buckets, of, lettered = grams(batch.column("text").to_pylist())
            sums, number = np.zeros((n, max(1, len(langs)))), np.zeros(n)
            for b, d in zip(buckets, of, strict=True):
                number += np.bincount(d, minlength=n)
                for k in range(len(langs)):
                    sums[:, k] += np.bincount(d, table[b, k], n)
            known = lettered & bool(langs)
            mean = sums / np.maximum(number, 1)[:, None] * np.minimum(np.maximum(number, 1), EVIDENCE)[:, None]
            odds = mean + (prior if langs else 0)
            odds = np.exp(odds - odds.max(axis=1, keepdims=True))
            best = odds.argmax(axis=1)
            score = np.where(known, odds[np.arange(n), best] / odds.sum(axis=1), 0.0)
            yield pa.RecordBatch.from_pydict({
                **{c: batch.column(c) for c in keep}, "lang_pred": pa.array([langs[k] if ok else "und" for k, ok in zip(best, known, strict=True)], pa.string()),
                "score": pa.array(score, pa.float64()),
            })

    schema = documents.select(*keep).schema.add("lang_pred", "string").add("score", "double")
    return documents.select(*dict.fromkeys([*keep, "text"])).mapInArrow(run, schema)


def learned(documents: DataFrame) -> tuple[list[str], np.ndarray, np.ndarray]:
    """The model of the rows that are not held out."""
    return fit(documents.filter(id_bucket("doc_id", 4) != 2))


def digest(documents: DataFrame) -> DataFrame:
    found = predict(documents, learned(documents))
    return found.select("doc_id", (id_bucket("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score")
