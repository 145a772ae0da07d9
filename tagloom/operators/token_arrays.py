"""Tokens of many sentences at once, as arrays: the form in which ``located_tokens`` finds them.

One pass over the characters of a batch finds all its tokens. Which characters are letters or digits and which are white space is
asked of the engine's own regular expressions, once a process, so that tokens are those of the pattern ``tokens.WORD``.
"""

from __future__ import annotations

from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

SPACE, WORD, OTHER = 0, 1, 2
#: Bytes of text that are looked at together.
PIECE_BYTES = 4 << 20
POINTS = 0x110000
TOKEN = pa.struct([("form", pa.string()), ("start", pa.int32()), ("end", pa.int32())])


@cache
def _class_runs() -> tuple[bytes, bytes]:
    """Where runs of code points of one class begin, and their classes."""
    points = [c for c in range(POINTS) if not 0xD800 <= c < 0xE000]
    every = SparkSession.active().createDataFrame([("".join(map(chr, points)),)], "c string")
    others = F.regexp_replace(F.regexp_replace("c", r"[\p{L}\p{N}]", "w"), r"[^\sw]", "o")
    drawn = np.frombuffer(every.select(F.regexp_replace(others, r"\s", " ")).first()[0].encode(), np.uint8)
    kinds = np.full(POINTS, OTHER, np.uint8)
    kinds[points] = np.select([drawn == ord(" "), drawn == ord("w")], [SPACE, WORD], OTHER)
    heads = np.concatenate([[0], np.flatnonzero(np.diff(kinds)) + 1])
    return heads.astype(np.int64).tobytes(), kinds[heads].tobytes()


@cache
def _classes(heads: bytes, kinds: bytes) -> np.ndarray:
    """The class of every code point."""
    at = np.frombuffer(heads, np.int64)
    return np.repeat(np.frombuffer(kinds, np.uint8), np.diff(np.append(at, POINTS)))


def _find(data: np.ndarray, cuts: np.ndarray, classes: np.ndarray) -> tuple[np.ndarray, pa.StructArray]:
    """Tokens per text, and all tokens, of texts that lie one after another in ``data`` (UTF-8), parted at ``cuts``."""
    heads = np.flatnonzero((data & 0xC0) != 0x80)  # first bytes of characters
    points = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32)
    kind = classes[points]
    edges = np.searchsorted(heads, cuts)  # the same cuts, counted in characters
    word = kind == WORD
    joined = word[1:] & word[:-1]
    inner = edges[(edges > 0) & (edges < len(kind))]
    joined[inner - 1] = False
    used = kind != SPACE
    first, last = used.copy(), used.copy()
    first[1:] &= ~joined
    last[:-1] &= ~joined
    first, last = np.flatnonzero(first), np.flatnonzero(last)
    places = np.searchsorted(first, edges)
    counts = np.diff(places)
    base = np.repeat(edges[:-1], counts)
    ends = np.append(heads, len(data))
    sizes = ends[last + 1] - ends[first]
    kept = data[np.repeat(used, np.diff(ends))]
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    forms = pa.StringArray.from_buffers(len(sizes), pa.py_buffer(offsets), pa.py_buffer(kept))
    start, end = ((x - base).astype(np.int32) for x in (first, last))
    return counts, pa.StructArray.from_arrays([forms, pa.array(start), pa.array(end)], fields=list(TOKEN))


def _text_bytes(texts: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string array and where its strings begin and end in them."""
    if not len(texts):  # such an array may come without offsets
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = texts.buffers()
    cuts = np.frombuffer(offsets, np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    held = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return held[cuts[0] : cuts[-1]], cuts - cuts[0]


def locate(texts: pa.Array, classes: np.ndarray) -> pa.Array:
    """``tokens`` of each text; null for a null one."""
    if not len(texts):
        return pa.array([], pa.list_(TOKEN))
    null = texts.is_null().to_numpy(zero_copy_only=False)
    data, cuts = _text_bytes(texts.cast(pa.string()).fill_null(""))
    counts, parts, at = [], [], 0
    while at < len(texts):
        to = max(at + 1, int(np.searchsorted(cuts, cuts[at] + PIECE_BYTES, "right")) - 1)
        n, tokens = _find(data[cuts[at] : cuts[to]], cuts[at : to + 1] - cuts[at], classes)
        counts.append(n)
        parts.append(tokens)
        at = to
    offsets = np.concatenate([[0], np.cumsum(np.concatenate(counts))]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.concat_arrays(parts), pa.list_(TOKEN), mask=pa.array(null))


def located(text: Column) -> Column:
    """``ARRAY<STRUCT<form,start,end>>`` of a text column, by one pass over each batch."""
    runs = _class_runs()

    @arrow_udf("array<struct<form:string,start:int,end:int>>")
    def tokens(texts: pa.Array) -> pa.Array:
        return locate(texts, _classes(*runs))

    # the optimizer may not move the function into a lambda or repeat it
    return tokens.asNondeterministic()(text)
