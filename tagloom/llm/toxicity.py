"""Toxicity by a weighted finite-state pattern grammar.

A text is cut into clauses. Each word is read by five small transducers: insults (weighted stems), threats, targets,
negation and reported speech. Their composition walks a clause word by word; a hit is emitted under the state it is read in
(plain, negated, reported, aimed at somebody), so whole clauses are scored and not isolated words.

The grammar's closed word classes are given below. The insult stems are learned from labelled rows: beginnings of four and
five letters and whole words that are far more frequent in toxic documents than in others, each copy of a text counted once.
How much each kind of hit counts is a logistic regression on the same rows.

Null and empty texts have no clause and get the score of no hits. Labels that are null or belong to no document are left
out; a document with differing labels counts as toxic. Without toxic labels the score is 0 for all. Only text is scored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.llm.common import id_bucket

#: At most about so many labelled documents are learned from (those of smallest hash).
FIT_ROWS = 200_000
#: A stem must stand in so many different toxic texts, and in this part of them.
SUPPORT, SUPPORT_SHARE = 4, 0.001
#: How many times as frequent in toxic texts as in others.
LIFT = 12.0
STEMS = (4, 5)

# Closed word classes of English, German, French and Spanish.
THREATS = frozenset(
    "kill hurt destroy beat burn murder stab shoot strangle töten schlagen vernichten umbringen verletzen tuer frapper"
    " détruire brûler matar golpear destruir quemar herir".split()
)
TARGETS = frozenset(
    "you your yours yourself he she they them him her du dich dir dein deine ihr euch euer tu toi ton ta tes vous votre vos"
    " tú ti tu tus usted ustedes vosotros".split()
)
NEGATIONS = frozenset("not never no none neither nor nicht nie niemals kein keine pas jamais ne aucun nunca jamás tampoco".split())
REPORTS = frozenset(
    "said says say told wrote writes quoted called claims claimed sagte sagt schrieb behauptet dit disait écrit affirme dijo dice"
    " escribió afirma".split()
)
NEGATION_REACH = 3
CLAUSE = re.compile(r"[.!?;:\n]+")
WORD = re.compile(r"[^\W\d_]+")
FEATURES = ("plain", "negated", "reported", "aimed", "threat", "distinct", "weight", "best_clause", "density")


def stems(word: str) -> list[str]:
    """What a word may be known by: its beginnings, and itself with an end mark."""
    return [word[:n] for n in STEMS if len(word) >= n] + [word + "$"]


class Grammar:
    """The composed transducer: state is (words that negation still reaches, reported, target seen)."""

    def __init__(self, weights: dict[str, float]):
        self.weights = weights
        self.known: dict[str, float] = {}

    def insult(self, word: str) -> float:
        """Weight of the heaviest stem of a word, 0 if it has none."""
        w = self.weights
        best = w.get(word + "$", 0.0)
        for n in STEMS:
            if len(word) >= n and (x := w.get(word[:n], 0.0)) > best:
                best = x
        return best

    def clause(self, words: list[str]) -> list[tuple[str, str, float]]:
        """Hits of a clause as (kind, word, weight)."""
        negated, reported, aimed, hits = 0, False, False, []
        for word in words:
            weight = self.insult(word)
            threat = word in THREATS
            if word in NEGATIONS:
                negated = NEGATION_REACH + 1
            elif word in REPORTS:
                reported = True
            elif word in TARGETS:
                aimed = True
            if weight > 0 or threat:
                kind = "negated" if negated else "reported" if reported else "aimed" if aimed else "plain"
                hits.append(("threat" if threat and weight <= 0 else kind, word, weight))
            negated = max(0, negated - 1)
        if aimed:
            hits = [("aimed" if kind == "plain" else kind, word, weight) for kind, word, weight in hits]
        return hits

    def features(self, text: str | None) -> list[float]:
        kinds: Counter[str] = Counter()
        found, total, best, n = set(), 0.0, 0.0, 0
        low = (text or "").lower()
        words = WORD.findall(low)
        if not any(w in THREATS or self.insult(w) for w in set(words)):
            return [0.0] * len(FEATURES)
        for part in CLAUSE.split(low):
            here = WORD.findall(part)
            n += len(here)
            hits = self.clause(here)
            of = sum(w for kind, _, w in hits if kind != "threat")
            kinds.update(kind for kind, _, _ in hits)
            found.update(word for _, word, w in hits if w > 0)
            total, best = total + of, max(best, of)
        counts = [math.log1p(kinds[k]) for k in FEATURES[:5]]
        return [*counts, math.log1p(len(found)), math.log1p(total), math.log1p(best), math.log1p(100 * sum(kinds.values()) / max(n, 1))]


def _stem_counts(batches: Iterator[pa.RecordBatch], only: frozenset | None) -> Iterator[pa.RecordBatch]:
    sums: dict[int, Counter[str]] = {0: Counter(), 1: Counter()}
    for batch in batches:
        for text, toxic in zip(batch.column("text"), batch.column("toxic").to_pylist(), strict=True):
            words = set(WORD.findall((text.as_py() or "").lower()))
            mine = {s for w in words for s in stems(w)}
            sums[toxic].update(mine & only if only is not None else mine)
    for toxic, counter in sums.items():
        if counter:
            yield pa.RecordBatch.from_pydict({
                "toxic": pa.array([toxic] * len(counter), pa.int32()), "stem": pa.array(list(counter), pa.string()), "n": pa.array(list(counter.values()), pa.int64()),
            })


def learn_stems(rows: DataFrame) -> dict[str, float]:
    """Log-odds of the insult stems. rows: text and toxic, each text once.

    The stems that are kept stand in a given part of the toxic texts at least, which bounds their number.
    """
    sent = rows.sparkSession.sparkContext
    schema = "toxic int, stem string, n bigint"
    size = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    least = max(SUPPORT, math.ceil(SUPPORT_SHARE * size.get(1, 0)))
    counted = rows.filter("toxic = 1").mapInArrow(lambda b: _stem_counts(b, None), schema).groupBy("stem").agg(F.sum("n").alias("n"))
    toxic = {r["stem"]: r["n"] for r in counted.filter(F.col("n") >= least).collect()}
    only = sent.broadcast(frozenset(toxic))
    others = rows.filter("toxic = 0").mapInArrow(lambda b: _stem_counts(b, only.value), schema).groupBy("stem").agg(F.sum("n").alias("n"))
    clean = {r["stem"]: r["n"] for r in others.collect()}
    out = {}
    for stem, n in toxic.items():
        lift = (n / max(1, size[1])) / ((clean.get(stem, 0) + 1) / (size.get(0, 0) + 1))
        if lift >= LIFT:
            out[stem] = math.log(lift)
    return out


def _feature_rows(weights: dict[str, float], schema_id: str, rows: DataFrame, keep: tuple[str, ...]) -> DataFrame:
    sent = rows.sparkSession.sparkContext.broadcast(weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grammar = Grammar(sent.value)
        for batch in batches:
            found = [grammar.features(t.as_py()) for t in batch.column("text")]
            yield pa.RecordBatch.from_pydict({**{c: batch.column(c) for c in keep}, "x": pa.array(found, pa.list_(pa.float64()))})

    return rows.select(*keep, "text").mapInArrow(run, schema_id + ", x array<double>")


def regress(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, rounds: int = 30) -> np.ndarray:
    """Logistic regression by Newton steps; the constant comes last and is not shrunk."""
    z = np.column_stack([x, np.ones(len(x))])
    penalty = np.full(z.shape[1], ridge)
    penalty[-1] = 1e-6
    b = np.zeros(z.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(z @ b, -30, 30)))
        slope = z.T @ (y - p) - penalty * b
        step = np.linalg.solve((z.T * (p * (1 - p))) @ z + np.diag(penalty), slope)
        b += step
        if np.abs(step).max() < 1e-8:
            break
    return b


def fit(documents: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> tuple[dict[str, float], np.ndarray]:
    """Stem weights and regression from labelled documents; labels: doc_id and toxic."""
    known = labels.filter("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    share = max(1, -(-known.count() // fit_rows))
    chosen = known.filter(F.pmod(F.xxhash64("doc_id"), F.lit(share)) == 0)
    seen = documents.select("doc_id", F.xxhash64("text").alias("h")).join(F.broadcast(chosen), "doc_id")
    once = seen.groupBy("h").agg(F.min_by("doc_id", F.struct(-F.col("toxic"), "doc_id")).alias("doc_id"), F.max("toxic").alias("toxic"))
    once = documents.sparkSession.createDataFrame(once.select("doc_id", "toxic").toPandas(), "doc_id bigint, toxic int")
    rows = documents.select("doc_id", "text").join(F.broadcast(once), "doc_id")
    weights = learn_stems(rows)
    data = _feature_rows(weights, "toxic int", rows, ("toxic",)).toPandas()
    if not len(data) or data["toxic"].max() < 1:
        return {}, np.append(np.zeros(len(FEATURES)), -30.0)
    return weights, regress(np.stack(data["x"]), data["toxic"].to_numpy(float))


def score(documents: DataFrame, model: tuple[dict[str, float], np.ndarray]) -> DataFrame:
    """doc_id, score and the grammar's features x (see FEATURES)."""
    weights, b = model
    kind = documents.schema["doc_id"].dataType.simpleString()
    rows = _feature_rows(weights, f"doc_id {kind}", documents, ("doc_id",))
    line = F.lit(float(b[-1]))
    for k in range(len(FEATURES)):
        line = line + F.lit(float(b[k])) * F.get("x", F.lit(k))
    return rows.withColumn("score", 1 / (1 + F.exp(-line)))


def digest(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """Learns only from documents whose id's checksum modulo 3 is not 1."""
    found = score(documents, fit(documents, labels.filter(id_bucket("doc_id", 3) != 1)))
    return found.select("doc_id", (id_bucket("doc_id", 3) == 1).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))
