"""Shared parts of the corpus operators: reading tables, cutting Arrow batches, hashing words."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that are laid out at once inside a task; one longer document makes one longer piece.
PIECE_BYTES = 1 << 20
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_bucket(column: str | Column, n: int) -> Column:
    """crc32 of the id as text, modulo n; a null id counts as empty text."""
    col = F.col(column) if isinstance(column, str) else column
    return F.crc32(F.coalesce(col.cast("string"), F.lit("")).cast("binary")) % n


def sum_counts(rows: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    return rows.groupBy(*keys).agg(*[F.sum(v).alias(v) for v in values])


def pieces(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches so that each piece has at most ``limit`` bytes of text, or one row."""
    for batch in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False))
        at = 0
        while at < batch.num_rows:
            done = ends[at - 1] if at else 0
            upto = max(at + 1, int(np.searchsorted(ends, done + limit, side="right")))
            yield batch.slice(at, upto - at)
            at = upto


def flat(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts, one after the other, and where each begins and ends; null is empty."""
    texts = pc.fill_null(texts, "").cast(pa.large_binary())
    _, offsets, data = texts.buffers()
    ends = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    whole = np.frombuffer(data, np.uint8)[ends[0] : ends[-1]] if data is not None and len(ends) else np.zeros(0, np.uint8)
    return whole, ends - (ends[0] if len(ends) else 0)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values evenly."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x7FB5D329728EA185)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x81DADEF4BC2DD44D)
    x ^= x >> np.uint64(33)
    return x


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_LOWERED = np.arange(256, dtype=np.uint8)
_LOWERED[65:91] += 32
_STEP = np.uint64(0xD1342543DE82EF95)
_powers = np.ones(1, np.uint64)


def _power(n: int) -> np.ndarray:
    global _powers
    if len(_powers) < n:
        _powers = np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(max(n, 1024) - 1, _STEP), dtype=np.uint64)])
    return _powers


def lowered(data: np.ndarray) -> np.ndarray:
    """A-Z in lower case; every other byte stays."""
    return _LOWERED[data]


def word_hashes(data: np.ndarray, ends: np.ndarray, is_word: np.ndarray, fold: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words of flat texts: first bytes, ends, 64-bit hashes, and the first word of each text.

    ``is_word`` says of each byte value whether it belongs to words. With ``fold``, A-Z count as a-z. Words never cross texts.
    """
    at = np.flatnonzero(is_word[data])
    if not len(at):
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(0, np.uint64), np.zeros(len(ends), np.int64)
    opens = np.zeros(len(data) + 1, bool)
    opens[ends] = True
    new = opens[at]
    new[1:] |= np.diff(at) != 1
    new[0] = True
    first = np.flatnonzero(new)
    starts = at[first]
    stops = np.append(at[first[1:] - 1], at[-1]) + 1
    within = at - np.repeat(starts, np.diff(np.append(first, len(at))))
    terms = _BYTE[_LOWERED[data[at]] if fold else data[at]] * _power(int(within.max()) + 1)[within]
    return starts, stops, mix(np.add.reduceat(terms, first)), np.searchsorted(starts, ends)


def byte_class(*ranges: tuple[int, int]) -> np.ndarray:
    """Which byte values lie in any of the ranges, ends included."""
    out = np.zeros(256, bool)
    for low, high in ranges:
        out[low : high + 1] = True
    return out
