"""Periodic runs of words, found in tiles for each octave of periods.

A run is a stretch of consecutive words that repeats itself q words on, q being its smallest period, at least LEAST words and TIMES
periods long, and as long as it can be.

1. A document is exploded into overlapping tiles. Octave o has the periods from 2^o to 2^(o+1) - 1. The low octaves share tiles of
   TILE words; each higher octave has tiles of its own that are longer in proportion. Tiles overlap by three of their longest periods.
2. Tiles are solved independently. In octave o every 2^o-th word is a boundary c. What a run with period q in that octave has in a
   tile covers a boundary with two periods from there on, so the boundary's Z-function (how far the words from c + q on repeat those from c on)
   is at least q there. Where it is, and where no smaller period divides the root, the Z-function and its mirror image (the
   same backwards) give the whole stretch: a fragment. Z-functions are evaluated for all boundaries of a piece of text together, by
   hashes of 1, 2, 4, ... words (64 bits).
3. Fragments are shuffled by document and period, and those that overlap by a period are stitched: the next begins a new run where it
   begins less than a period before the end of all earlier ones. Runs that are too short are left out only then.

Texts beyond SPREAD bytes have their tiles dealt over all tasks, so that one very long document is no task of its own; the tiles of
others are solved where they are read, and only fragments are shuffled. What comes together for one document is its own runs.

Null and wordless texts have no runs. Each row is a document; rows that agree in id and text get the same answer, null ids included.
Only doc_id and text are read; an empty table gives an empty one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from fractions import Fraction
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tagloom.functions.arrays import let
from tagloom.functions.scale import lookup_join
from tagloom.llm.common import byte_class, flat, mix, pieces, word_hashes

#: Shortest run, and the least number of its periods.
LEAST, TIMES = 6, 4
#: Words by which tiles of the low octaves follow each other.
TILE = 8192
#: Bytes of text from which tiles are dealt over tasks.
SPREAD = 1 << 20
#: Words of tiles that are solved together.
TOGETHER = 1 << 18
WORD_BYTES = ~byte_class((0x20, 0x20), (0x09, 0x0D))
BLANKS = "[ \\t\\n\\x0B\\f\\r]+"


# ---------------------------------------------------------------- tiles


def tiles(n: int, tile: int = TILE) -> Iterator[tuple[int, int, int, int]]:
    """First word, end, first octave and end of octaves of the tiles of a text of n words."""
    octaves = max(0, n // TIMES).bit_length()
    shared = max(1, (tile // 8).bit_length())
    low = 0
    while low < octaves:
        high = min(octaves, shared) if low == 0 else low + 1
        step, overlap = max(tile, 8 << (high - 1)), 3 << high
        at = 0
        while True:
            yield at, min(n, at + step + overlap), low, high
            if at + step + overlap >= n:
                break
            at += step
        low = high


_TILE = "doc_id {}, text_hash bigint, n int, at int, low int, high int, words binary"


def _tiled(tile: int):
    """Each text as tiles; a word is told apart by 64 bits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            _, _, words, first = word_hashes(*flat(batch.column("text")), WORD_BYTES, fold=False)
            rows = [(k, n, *t) for k, n in enumerate(np.diff(first).tolist()) if n >= LEAST for t in tiles(n, tile)]
            size = 0
            held: list[tuple] = []
            for row in [*rows, None]:
                if held and (row is None or size > TOGETHER):
                    of, n, at, end, low, high = zip(*held, strict=True)
                    take = pa.array(of, pa.int64())
                    yield pa.RecordBatch.from_pydict({
                        "doc_id": batch.column("doc_id").take(take), "text_hash": batch.column("text_hash").take(take),
                        "n": pa.array(n, pa.int32()), "at": pa.array(at, pa.int32()), "low": pa.array(low, pa.int32()), "high": pa.array(high, pa.int32()),
                        "words": pa.array([words[first[k] + a : first[k] + b].tobytes() for k, a, b in zip(of, at, end, strict=True)], pa.binary()),
                    })
                    held, size = [], 0
                if row is not None:
                    held.append(row)
                    size += row[3] - row[2]

    return run


# ---------------------------------------------------------------- boundaries of a tile


@lru_cache(1)
def _least_factor(bits: int) -> np.ndarray:
    """The smallest prime factor of each number below 2^bits."""
    least = np.arange(1 << bits)
    for p in range(2, int(2 ** (bits / 2)) + 1):
        if least[p] == p:
            own = least[p * p :: p]
            own[own > p] = np.minimum(own[own > p], p)
    return least


class Repeats:
    """Words of several tiles, one after the other, each closed by a symbol that stands nowhere else, with hashes of 2^k words."""

    def __init__(self, words: np.ndarray, longest: int):
        self.n = len(words)
        x = np.concatenate([words, mix(np.arange(4, dtype=np.uint64) + np.uint64(1 << 62))])
        self.ahead = [x]
        while 1 << len(self.ahead) <= longest:
            step = 1 << (len(self.ahead) - 1)
            beyond = np.concatenate([x[step:], mix(np.arange(step, dtype=np.uint64) + np.uint64((len(self.ahead) << 40) + 5))])
            x = mix(x * np.uint64(0x9E3779B97F4A7C15) + beyond)
            self.ahead.append(x)

    def same(self, a: np.ndarray, b: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Whether the ``length`` words from a on are those from b on."""
        out = length <= 0
        level = np.frexp(np.maximum(length, 1))[1] - 1
        for k in np.unique(level[~out]).tolist():
            own = np.flatnonzero(~out & (level == k))
            x, i, j, end = self.ahead[k], a[own], b[own], length[own] - (1 << k)
            out[own] = (x[i] == x[j]) & (x[i + end] == x[j + end])
        return out

    def z(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many words from a on equal those from b on, b being the later."""
        out = np.zeros(len(a), np.int64)
        for k in reversed(range(len(self.ahead))):
            x, i, j = self.ahead[k], a + out, b + out
            inside = j < self.n
            out += (inside & (x[np.minimum(i, self.n - 1)] == x[np.minimum(j, self.n - 1)])).astype(np.int64) << k
        return out

    def z_back(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many words before a equal those before b."""
        out = np.zeros(len(a), np.int64)
        for k in reversed(range(len(self.ahead))):
            x, i, j = self.ahead[k], a - out - (1 << k), b - out - (1 << k)
            out += ((i >= 0) & (x[np.maximum(i, 0)] == x[np.maximum(j, 0)])).astype(np.int64) << k
        return out


def fragments(words: np.ndarray, ends: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Tile number, period, first word and end (within the tile) of all fragments.

    ``words`` are the tiles one after the other, each followed by one free place; tile k ends at ``ends[k]``, its octaves are low to high.
    """
    none = (np.zeros(0, np.int64),) * 4
    if not len(ends):
        return none
    begins = np.concatenate([[0], ends[:-1] + 1])
    words = words.copy()
    words[ends] = mix(np.arange(len(ends), dtype=np.uint64) + np.uint64(1 << 61))
    at = Repeats(words, int((ends - begins).max()))
    four = at.ahead[min(2, len(at.ahead) - 1)][: len(words)]
    octaves, out = int(high.max()), []
    least = _least_factor(max(octaves, 2))
    for o in range(int(low.min()), octaves):
        block = 1 << o
        rows = len(words) // block
        grid = four[: rows * block].reshape(rows, block)
        hit = np.flatnonzero((grid[1:] == grid[:-1, :1]).ravel())
        c, q = hit // block * block, hit % block + block
        of = np.searchsorted(ends, c)
        fits = (low[of] <= o) & (o < high[of])
        c, q, of = c[fits], q[fits], of[fits]
        fits = c + 2 * q <= ends[of]
        c, q, of = c[fits], q[fits], of[fits]
        fits = at.same(c, c + q, q)
        c, q, of = c[fits], q[fits], of[fits]
        rest, whole = q.copy(), np.ones(len(q), bool)
        while len(more := np.flatnonzero(rest > 1)):
            p = least[rest[more]]
            own = q[more] // p
            whole[more] &= ~at.same(c[more], c[more] + own, q[more] - own)
            rest[more] //= p
            rest[more[~whole[more]]] = 1
        c, q, of = c[whole], q[whole], of[whole]
        start = c - at.z_back(c, c + q)
        out.append((of, q, start - begins[of], c + q + at.z(c, c + q) - begins[of]))
    found = np.unique(np.concatenate([np.stack(part) for part in out], axis=1), axis=1) if out else np.zeros((4, 0), np.int64)
    return tuple(found)


def _solved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in pieces(batches, "words", 8 * TOGETHER):
        data, cuts = flat(batch.column("words"))
        size = np.diff(cuts) // 8
        ends = np.cumsum(size + 1) - 1
        words = np.zeros(int((size + 1).sum()), np.uint64)
        free = np.ones(len(words), bool)
        free[ends] = False
        words[free] = np.frombuffer(data.tobytes(), np.uint64)
        n, at, low, high = (batch.column(c).to_numpy().astype(np.int64) for c in ("n", "at", "low", "high"))
        of, q, start, end = fragments(words, ends, low, high)
        open_ = ((start == 0) & (at[of] > 0)) | ((end == size[of]) & (at[of] + size[of] < n[of]))
        keep = open_ | (end - start >= np.maximum(LEAST, TIMES * q))
        of, q, start, end = of[keep], q[keep], start[keep], end[keep]
        take = pa.array(of)
        yield pa.RecordBatch.from_pydict({
            "doc_id": batch.column("doc_id").take(take), "text_hash": batch.column("text_hash").take(take), "n": pa.array(n[of], pa.int32()),
            "period": pa.array(q, pa.int32()), "start": pa.array(start + at[of], pa.int32()), "end": pa.array(end + at[of], pa.int32()),
        })


# ---------------------------------------------------------------- documents

KEY = ["doc_id", "text_hash", "n"]


def _identified(documents: DataFrame, *columns: str) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    return documents.select("doc_id", F.xxhash64(text).alias("text_hash"), text.alias("text"), *columns)


def find_runs(documents: DataFrame, tile: int = TILE, spread: int = SPREAD) -> DataFrame:
    """doc_id, text_hash (of the text), n (words), period, start and end of every run, word numbers from 0, end exclusive."""
    kind = documents.schema["doc_id"].dataType.simpleString()
    rows = _identified(documents)
    found = "{}, n int, period int, start int, end int".format(f"doc_id {kind}, text_hash bigint")
    cut = lambda part: part.mapInArrow(_tiled(tile), _TILE.format(kind))
    long = F.octet_length("text") > spread
    dealt = cut(rows.filter(long)).repartition("doc_id", "text_hash", "at", "low")
    pieces_of = cut(rows.filter(~long)).mapInArrow(_solved, found).unionAll(dealt.mapInArrow(_solved, found)).distinct()
    here = Window.partitionBy(*KEY, "period").orderBy("start", "end")
    before = F.max("end").over(here.rowsBetween(Window.unboundedPreceding, -1))
    new = (before.isNull() | (F.col("start") > before - F.col("period"))).cast("int")
    stitched = pieces_of.withColumn("new", new).withColumn("run", F.sum("new").over(here))
    runs = stitched.groupBy(*KEY, "period", "run").agg(F.min("start").alias("start"), F.max("end").alias("end")).drop("run")
    return runs.filter(F.col("end") - F.col("start") >= F.greatest(F.lit(LEAST), F.lit(TIMES) * F.col("period")))


_SUMMARY = "doc_id {}, n_runs bigint, start bigint, length bigint, period bigint, exponent_milli bigint, runs_sha256 string, collapsed_sha256 string"


def _collapsed(text: bytes, runs: list[tuple[int, int, int]]) -> bytes:
    """The words joined by one space, without those that a run repeats."""
    words = text.split()
    if runs:
        drop = np.zeros(len(words) + 1, np.int64)
        for start, length, period in runs:
            drop[start + period] += 1
            drop[start + length] -= 1
        words = [w for w, d in zip(words, np.cumsum(drop[:-1]).tolist(), strict=True) if not d]
    return b" ".join(words)


def _summarised(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in pieces(batches):
        rows = []
        for text, listed in zip(batch.column("text"), batch.column("runs").to_pylist(), strict=True):
            runs = [tuple(map(int, line.split(","))) for line in (listed or "").splitlines()]
            best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
            start, length, period = best or (None, None, None)
            milli = 1000 * length // period if best else None
            body = _collapsed(text.as_py().encode(), runs)
            rows.append((len(runs), start, length, period, milli, hashlib.sha256((listed or "").encode()).hexdigest(), hashlib.sha256(body).hexdigest()))
        names = ("n_runs", "start", "length", "period", "exponent_milli")
        cols = list(zip(*rows, strict=True)) if rows else [[]] * 7
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), *(pa.array(c, pa.int64()) for c in cols[:5]), *(pa.array(c, pa.string()) for c in cols[5:])],
            names=["doc_id", *names, "runs_sha256", "collapsed_sha256"],
        )


def summary(documents: DataFrame, tile: int = TILE, spread: int = SPREAD) -> DataFrame:
    """Per document the number of runs, the run of the greatest exponent, and hashes of all runs and of the text without their repetitions."""
    runs = find_runs(documents, tile, spread).groupBy("doc_id", "text_hash").agg(
        F.sort_array(F.collect_list(F.struct("start", "period", (F.col("end") - F.col("start")).alias("length")))).alias("runs")
    )
    line = lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n"))
    listed = runs.select("text_hash", F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), F.col("doc_id").isNull().alias("no_id"), F.array_join(F.transform("runs", line), "").alias("runs"))
    rows = _identified(documents).withColumns({"id": F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "no_id": F.col("doc_id").isNull()})
    known = lookup_join(rows, listed, ["id", "no_id", "text_hash"], ["id"])
    kind = documents.schema["doc_id"].dataType.simpleString()
    return known.select("doc_id", "text", "runs").mapInArrow(_summarised, _SUMMARY.format(kind))


def with_planted_runs(documents: DataFrame) -> DataFrame:
    """The documents whose id hashes to a multiple of ten get a period from some word on, which depends on the hash; other texts stay."""
    text = F.coalesce("text", F.lit(""))
    chosen = F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), F.lit(10)) == 0
    words = F.when(chosen, F.filter(F.split(text, BLANKS, -1), lambda w: w != "")).otherwise(F.array().cast("array<string>"))

    def planted(w: Column) -> Column:
        h = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
        g, n = F.floor(h / 10).cast("long"), F.size(w).cast("long")
        a = F.pmod(g, F.greatest(n, F.lit(1)))
        p = F.lit(1) + F.floor((n - a) / (F.lit(3) + F.pmod(g, F.lit(8)))).cast("long")
        repeated = F.transform(w, lambda x, i: F.when(i < a, x).otherwise(F.get(w, (a + F.pmod(i - a, p)).cast("int"))))
        return F.when(n > 0, F.array_join(repeated, " ")).otherwise(text)

    return documents.withColumn("text", let(words, planted))


def digest(documents: DataFrame) -> DataFrame:
    return summary(with_planted_runs(documents.select("doc_id", "text")))
