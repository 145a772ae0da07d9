"""Exact top-k inner product search with a pivot table.

Every vector's distances to a fixed number of pivots are computed once and written as a table. For a query, the largest
difference between its distance and a candidate's distance to any pivot is a lower bound of their distance, and with both
lengths an upper bound of their inner product. In each block the candidates of the highest bounds are evaluated first, then all
whose bound reaches the k-th best of those; the others cannot be among the k best and are never evaluated.

Queries are a stated set: they go out in blocks of bounded size, each block meets every candidate partition once, and only
the k best of each query and partition are shuffled.

Components become floor(64 * x). Vectors that are null or hold null or non-finite components take no part; an empty vector
has score 0 with all others, and vectors of unlike lengths count as filled up with zeros. Rows with a query's own vec_id are
no candidates of it; a query id that stands in several rows is asked once, with its first vector in sort order. Candidate rows
that repeat an id are candidates each. Null ids take no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tagloom.functions.scale import settle

K = 20
SCALE = 64
PIVOTS = 32
#: Vectors among which the pivots are sought (smallest by hash).
PIVOT_SAMPLE = 1024
QUERY_BLOCK = 4096
CANDIDATE_BLOCK = 8192
QUERIES_AT_ONCE = 64
#: So many times k candidates are evaluated before the first mark is set.
FIRST = 4
SLACK = 1e-5


def whole_components(vector: Column) -> Column:
    usable = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.when(usable, F.transform(vector, lambda x: F.floor(x.cast("double") * SCALE).cast("long")))


def spread_pivots(sample: np.ndarray, n: int) -> np.ndarray:
    """Far apart from each other: each is the vector that is farthest from all before it."""
    if not len(sample):
        return np.zeros((1, sample.shape[1] if sample.ndim == 2 else 0))
    picked = [0]
    far = ((sample - sample[0]) ** 2).sum(axis=1)
    while len(picked) < min(n, len(sample)):
        picked.append(int(far.argmax()))
        far = np.minimum(far, ((sample - sample[picked[-1]]) ** 2).sum(axis=1))
    return sample[picked]


def _stack(rows: list, dim: int) -> np.ndarray:
    out = np.zeros((len(rows), dim))
    for k, x in enumerate(rows):
        out[k, : len(x)] = x
    return out


def _distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    square = (x * x).sum(axis=1)[:, None] + (pivots * pivots).sum(axis=1) - 2 * x @ pivots.T
    return np.sqrt(np.maximum(square, 0))


def pivot_table(vectors: DataFrame, pivots: np.ndarray, dim: int) -> DataFrame:
    """vec_id, v, and far: the distances to the pivots."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _stack(batch.column("v").to_pylist(), dim)
            far = pa.array(list(_distances(x, pivots)), pa.list_(pa.float64()))
            yield pa.RecordBatch.from_pydict({"vec_id": batch.column("vec_id"), "v": batch.column("v"), "far": far})

    return vectors.mapInArrow(run, "vec_id bigint, v array<bigint>, far array<double>")


def best_of(
    queries: np.ndarray, query_far: np.ndarray, names: np.ndarray, x: np.ndarray, far: np.ndarray, ids: np.ndarray, k: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Query numbers, candidate places and scores of the k best of a block for each query, and all ties with the k-th.

    First the candidates of the highest bounds are evaluated; their k-th score is the mark that all others' bounds must reach
    to be evaluated at all. Bounds are in single precision with slack in proportion, scores in exact whole numbers.
    """
    size_q, size_x = (queries * queries).sum(axis=1), (x * x).sum(axis=1)
    lower = np.zeros((len(queries), len(x)), np.float32)
    for p in range(far.shape[1]):
        np.maximum(lower, np.abs(query_far[:, p, None] - far[None, :, p]), out=lower)
    both = size_q[:, None] + size_x
    bound = (both - np.square(lower, dtype=np.float64)) / 2 + SLACK * both + 1
    own = names[:, None] == ids
    bound[own] = -np.inf
    scores = np.full(bound.shape, -np.inf)
    first = min(FIRST * k, len(x))
    if first < len(x):
        at = np.argpartition(-bound, first - 1, axis=1)[:, :first]
        np.put_along_axis(scores, at, np.einsum("qd,qmd->qm", queries, x[at]), axis=1)
        scores[own] = -np.inf
        mark = np.partition(scores, len(x) - k, axis=1)[:, len(x) - k] if k <= len(x) else np.full(len(queries), -np.inf)
        reach = (bound >= mark[:, None]) & np.isneginf(scores) & ~own
    else:
        reach = ~own
    columns = np.flatnonzero(reach.any(axis=0))
    if len(columns):
        found = queries @ x[columns].T
        scores[:, columns] = np.where(reach[:, columns], found, scores[:, columns])
    mark = np.partition(scores, len(x) - k, axis=1)[:, len(x) - k] if k <= len(x) else np.full(len(queries), -np.inf)
    q, c = np.nonzero((scores >= mark[:, None]) & ~np.isneginf(scores))
    return q, c, scores[q, c].astype(np.int64)


def _cut(q: np.ndarray, i: np.ndarray, s: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The k best of each query, ties to the smaller id."""
    order = np.lexsort((i, -s, q))
    q, i, s = q[order], i[order], s[order]
    starts = np.flatnonzero(np.append(True, q[1:] != q[:-1])) if len(q) else np.zeros(0, np.int64)
    rank = np.arange(len(q)) - np.repeat(starts, np.diff(np.append(starts, len(q))))
    return q[rank < k], i[rank < k], s[rank < k]


def top_k(vectors: DataFrame, is_query: Column, k: int = K, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id and score: the k highest inner products of every query, ties to the smaller id."""
    whole = vectors.select(F.col(id_col).cast("long").alias("vec_id"), whole_components(F.col(vector_col)).alias("v"))
    whole = whole.dropna()
    dim = whole.agg(F.max(F.size("v"))).first()[0] or 0
    sample = whole.orderBy(F.xxhash64("vec_id"), "vec_id").limit(PIVOT_SAMPLE).collect()
    pivots = spread_pivots(_stack([r["v"] for r in sample], dim), PIVOTS)
    known = settle(pivot_table(whole, pivots, dim))
    queries = known.filter(is_query)
    blocks = max(1, -(-queries.count() // QUERY_BLOCK))
    parts = []
    for b in range(blocks):
        rows = queries.filter(F.pmod(F.xxhash64("vec_id"), F.lit(blocks)) == b).groupBy("vec_id").agg(F.min(F.struct("v", "far")).alias("q"))
        asked = rows.collect()
        sent = known.sparkSession.sparkContext.broadcast((
            [r["vec_id"] for r in asked], _stack([r["q"]["v"] for r in asked], dim), _stack([r["q"]["far"] for r in asked], len(pivots)),
        ))
        parts.append(known.mapInArrow(_searcher(sent, k, dim, len(pivots)), "query_id bigint, vec_id bigint, score bigint"))
    found = parts[0]
    for p in parts[1:]:
        found = found.unionAll(p)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _searcher(sent, k: int, dim: int, n_pivots: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, queries, query_far = sent.value
        names, query_far = np.array(names, np.int64), query_far.astype(np.float32)
        best = tuple(np.zeros(0, np.int64) for _ in range(3))
        for batch in batches:
            for at in range(0, batch.num_rows, CANDIDATE_BLOCK):
                part = batch.slice(at, CANDIDATE_BLOCK)
                ids = part.column("vec_id").to_numpy()
                x, far = _stack(part.column("v").to_pylist(), dim), _stack(part.column("far").to_pylist(), n_pivots).astype(np.float32)
                found = [best]
                for j in range(0, len(names), QUERIES_AT_ONCE):
                    some = slice(j, j + QUERIES_AT_ONCE)
                    q, c, s = best_of(queries[some], query_far[some], names[some], x, far, ids, k)
                    found.append((q + j, ids[c], s))
                best = _cut(*(np.concatenate(f) for f in zip(*found, strict=True)), k)
        q, i, s = best
        yield pa.RecordBatch.from_pydict({"query_id": pa.array(names[q]), "vec_id": pa.array(i), "score": pa.array(s)})

    return run


def digest(embeddings: DataFrame) -> DataFrame:
    return top_k(embeddings, F.col("vec_id") % 20 == 0)


ORACLE = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""
