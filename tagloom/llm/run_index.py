"""Removal of long repeated byte strings with run-length indexes.

Every byte that lies in a string of WINDOW bytes which also starts anywhere else in the corpus is removed.

1. Windows are dealt by content. The GRAM-byte string of least hash inside a window (the first of equals) is its anchor and
   gives its key, so equal windows have equal keys wherever they stand. Neighbouring windows of one anchor form a segment; a
   hash of its bytes names it. No window stands twice in a segment.
2. Keys that stand once in the corpus cannot repeat and are left out. Of the others, each distinct segment is fetched once and
   goes to the task of its key, with the number of its copies. Keys with very many segments are split by a second key of
   the same kind.
3. A task builds, for some MB of segments at a time, the Burrows-Wheeler transform of their text, run-compressed, with the
   suffix positions at both ends of every run as samples. Between samples matching statistics follow from their neighbour, as
   they only fall by one for each byte; at samples they are found by comparison. Streaming them along the text gives for every
   position the longest match elsewhere; those of WINDOW or more are marked.
4. Marks go back to all copies of a segment, are merged for each document, and the marked bytes are cut out.

Nothing is collected for a key or a repeated passage: its copies are counted with partial sums, and the joins that bring marks
back are split by Spark where they are skewed. What is collected for one document is its own segments and spans.

Null texts are empty. Rows are documents of their own, so repeated rows remove each other; rows that agree in id and text get
one answer, null ids included. Texts below WINDOW bytes are never touched. Only doc_id and text are read. The remaining
bytes need not be valid text, so they come as binary.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.functions.scale import settle
from tagloom.llm.common import _BYTE, flat, mix, pieces

WINDOW = 200
GRAM = 32
#: Bytes of one run-length index.
INDEX_BYTES = 2 << 20
#: Keys with more occurrences are split by a second key.
HOT = 5000
_STEP = 0x9E6C63D0876A9A35


# ---------------------------------------------------------------- dealing windows by content


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """A hash of the GRAM bytes from each position on, by doubling."""
    x, n, power = _BYTE[data], 1, _STEP
    while n < GRAM:
        x = x[:-n] * np.uint64(power) + x[n:]
        n, power = 2 * n, power * power & (2**64 - 1)
    return x


def least_inside(order: np.ndarray, span: int) -> np.ndarray:
    """The least of ``span`` values from each position on."""
    n = len(order) - span + 1
    rows = -(-len(order) // span)
    padded = np.full(rows * span, np.uint64(2**64 - 1))
    padded[: len(order)] = order
    blocks = padded.reshape(rows, span)
    left = np.minimum.accumulate(blocks, axis=1).ravel()
    right = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(right[:n], left[span - 1 : span - 1 + n])


def segments(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Key, text number, first window (from the beginning of the text) and number of windows of every segment."""
    none = np.zeros(0, np.int64)
    if len(data) < WINDOW:
        return none.astype(np.uint64), none, none, none
    order = mix(gram_hashes(data))
    where = np.arange(len(order), dtype=np.uint64)  # the first of equal ones is taken: half of the bits are the place
    where |= order & np.uint64(0xFFFFFFFF00000000)
    anchor = (least_inside(where, WINDOW - GRAM + 1) & np.uint64(0xFFFFFFFF)).astype(np.int64)
    size = np.diff(ends)
    inside = np.zeros(len(data) + 1, np.int8)
    long = size >= WINDOW
    np.add.at(inside, ends[:-1][long], 1)
    np.add.at(inside, ends[1:][long] - WINDOW + 1, -1)
    at = np.flatnonzero(np.cumsum(inside)[: len(anchor)])
    if not len(at):
        return none.astype(np.uint64), none, none, none
    new = np.ones(len(at), bool)
    new[1:] = (np.diff(at) != 1) | (anchor[at[1:]] != anchor[at[1:] - 1])
    first = np.flatnonzero(new)
    start, count = at[first], np.diff(np.append(first, len(at)))
    text = np.searchsorted(ends, start, side="right") - 1
    return order[anchor[start]], text, start - ends[text], count


def _occurrences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in pieces(batches):
        data, ends = flat(batch.column("text"))
        key, text, start, count = segments(data, ends)
        raw, at = data.tobytes(), start + ends[text]
        names = [xxhash.xxh3_64_intdigest(raw[a:b]) for a, b in zip(at.tolist(), (at + count + WINDOW - 1).tolist(), strict=True)]
        take = pa.array(text)
        yield pa.RecordBatch.from_pydict({
            "key": pa.array(key.view(np.int64)), "name": pa.array(np.array(names, np.uint64).view(np.int64)),
            "doc_id": batch.column("doc_id").take(take), "text_hash": batch.column("text_hash").take(take),
            "start": pa.array(start, pa.int32()), "n": pa.array(count, pa.int32()),
        })


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts are compressed before they are shuffled to their marks."""
    pack = zstandard.ZstdCompressor(level=1).compress
    for batch in pieces(batches):
        body = pa.array([pack(t.as_py().encode()) for t in batch.column("text")], pa.binary())
        yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "text_hash": batch.column("text_hash"), "packed": body})


def _second_keys(raw: bytes, key: int, n: int) -> list[tuple[int, int, int]]:
    """Split a segment by the least other gram under another order: (key, first window, windows)."""
    grams = gram_hashes(np.frombuffer(raw, np.uint8))
    order = mix(grams ^ np.uint64(0xA24BAED4963EE407))
    order[mix(grams) == np.array(key, np.int64).view(np.uint64)] = np.uint64(2**64 - 1)
    least = least_inside(order, WINDOW - GRAM + 1)[:n]
    cuts = np.append(0, np.flatnonzero(np.diff(least)) + 1)
    keys = mix(least[cuts] + np.array(key, np.int64).view(np.uint64)).view(np.int64)
    return list(zip(keys.tolist(), cuts.tolist(), np.diff(np.append(cuts, n)).tolist(), strict=True))


def _fetched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    unpack = zstandard.ZstdDecompressor().decompress
    for batch in pieces(batches, "packed"):
        rows = []
        for packed, wanted in zip(batch.column("packed"), batch.column("wanted").to_pylist(), strict=True):
            raw = unpack(packed.as_py())
            for w in wanted:
                own = raw[w["start"] : w["start"] + w["n"] + WINDOW - 1]
                for deal, at, n in _second_keys(own, w["key"], w["n"]) if w["hot"] else [(w["key"], 0, w["n"])]:
                    rows.append((deal, w["key"], w["name"], w["copies"], at, own[at : at + n + WINDOW - 1]))
        cols = list(zip(*rows, strict=True)) if rows else [[]] * 6
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary())
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=["deal", "key", "name", "copies", "at", "body"])


# ---------------------------------------------------------------- the run-length index


def suffix_order(text: np.ndarray) -> np.ndarray:
    """Suffix array by prefix doubling from eight symbols on; only what is still tied is sorted again."""
    n = len(text)
    packed = np.zeros(n, np.uint64)
    padded = np.concatenate([text.astype(np.uint64) + np.uint64(1), np.zeros(8, np.uint64)])
    for k in range(7):  # seven symbols of nine bits
        packed = (packed << np.uint64(9)) | padded[k : k + n]
    order = np.argsort(packed)
    new = np.append(True, packed[order[1:]] != packed[order[:-1]])
    rank = np.empty(n, np.int64)
    group = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    rank[order] = group
    depth = 7
    while True:
        lone = new & np.append(new[1:], True)
        tied = np.flatnonzero(~lone)
        if not len(tied):
            return order
        at = order[tied]
        beyond = at + depth
        second = np.where(beyond < n, rank[np.minimum(beyond, n - 1)] + 1, 0)
        by = np.argsort(rank[at] * np.int64(n + 2) + second)
        at, second = at[by], second[by]
        order[tied] = at
        fresh = np.append(True, (rank[at[1:]] != rank[at[:-1]]) | (second[1:] != second[:-1]))
        rank[at] = np.maximum.accumulate(np.where(fresh, tied, 0))
        new[tied] = fresh
        depth *= 2


def common_length(text: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Length of the longest common prefix of the suffixes at a and b."""
    padded = np.concatenate([text.astype(np.uint16), np.full(4, 0xFFFF, np.uint16)])
    four = padded[:-3].astype(np.uint64)
    for k in (1, 2, 3):
        four |= padded[k : k + len(four)].astype(np.uint64) << np.uint64(16 * k)
    n, out, open_ = len(text), np.zeros(len(a), np.int64), np.arange(len(a))
    while len(open_):
        x, y = a[open_] + out[open_], b[open_] + out[open_]
        ok = (x + 4 <= n) & (y + 4 <= n)
        open_, x, y = open_[ok], x[ok], y[ok]
        open_ = open_[four[x] == four[y]]
        out[open_] += 4
    alive = np.arange(len(a))
    for _ in range(3):
        x, y = a[alive] + out[alive], b[alive] + out[alive]
        ok = (x < n) & (y < n)
        alive = alive[ok][text[x[ok]] == text[y[ok]]]
        out[alive] += 1
    return out


class RunIndex:
    """Run-compressed Burrows-Wheeler transform of a text with suffix samples at both ends of every run."""

    def __init__(self, text: np.ndarray):
        order = suffix_order(text)
        before = np.where(order > 0, text[order - 1].astype(np.int32), -1)
        head = np.append(True, before[1:] != before[:-1])
        tail = np.append(head[1:], True)
        self.text, self.symbols, self.lengths = text, before[head], np.diff(np.append(np.flatnonzero(head), len(text)))
        self.heads, self.tails = order[head], order[tail]

    def _stream(self, samples: np.ndarray, length: np.ndarray) -> np.ndarray:
        at_sample = np.full(len(self.text), -1, np.int64)
        at_sample[samples] = length
        known = np.flatnonzero(at_sample >= 0)
        last = known[np.cumsum(at_sample >= 0) - 1]
        return at_sample[last] - (np.arange(len(self.text)) - last)

    def matching_statistics(self) -> np.ndarray:
        """For every position, the length of the longest string from there on that also begins at another position.

        A run's head and the tail of the run before are neighbours, so one comparison is the sample of both.
        """
        shared = common_length(self.text, self.heads[1:], self.tails[:-1])
        return np.maximum(self._stream(self.heads, np.append(0, shared)), self._stream(self.tails, np.append(shared, 0)))


def repeated_starts(bodies: list[bytes]) -> list[np.ndarray]:
    """For each body, at which of its windows a string of WINDOW bytes begins that stands elsewhere in the bodies, too."""
    ends = np.cumsum([0, *(len(b) + 1 for b in bodies)])
    text = np.zeros(ends[-1], np.uint16)
    symbols = np.frombuffer(b"\0".join(bodies) + b"\0", np.uint8).astype(np.uint16) + 1
    symbols[ends[1:] - 1] = 0
    text[:] = symbols
    match = RunIndex(text).matching_statistics()
    return [match[a : b - WINDOW] >= WINDOW for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]


_MARKS = pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())]))


def _marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by the key they are dealt by, then by name; an index ends between keys."""
    held: list[tuple] = []
    size, last = 0, None

    def done() -> pa.RecordBatch:
        rows = []
        for (key, name, copies, at, body), hit in zip(held, repeated_starts([h[4] for h in held]), strict=True):
            if copies > 1:
                hit = np.ones(len(body) - WINDOW + 1, bool)
            edge = np.diff(np.concatenate([[0], hit.astype(np.int8), [0]]))
            spans = [{"a": int(a) + at, "b": int(b) + at + WINDOW - 1} for a, b in zip(np.flatnonzero(edge == 1), np.flatnonzero(edge == -1), strict=True)]
            if spans:
                rows.append((key, name, spans))
        cols = list(zip(*rows, strict=True)) if rows else [[]] * 3
        return pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], _MARKS)], names=["key", "name", "marks"])

    for batch in batches:
        cols = [batch.column(c).to_pylist() for c in ("deal", "key", "name", "copies", "at", "body")]
        for deal, *row in zip(*cols, strict=True):
            if size >= INDEX_BYTES and deal != last:
                yield done()
                held, size = [], 0
            if deal == last and held and held[-1][:4] == tuple(row[:4]):
                continue  # fetched from each of several equal rows
            held.append(tuple(row))
            size += len(row[4])
            last = deal
    if held:
        yield done()


# ---------------------------------------------------------------- documents


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    unpack = zstandard.ZstdDecompressor().decompress
    for batch in pieces(batches, "packed"):
        spans, kept, sizes = [], [], []
        for packed, marks in zip(batch.column("packed"), batch.column("marks").to_pylist(), strict=True):
            raw, merged = unpack(packed.as_py()), []
            for m in sorted((m["a"], m["b"]) for m in marks or []):
                if merged and m[0] <= merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], m[1])
                else:
                    merged.append(list(m))
            at, left = 0, []
            for a, b in merged:
                left.append(raw[at:a])
                at = b
            kept.append(b"".join([*left, raw[at:]]))
            sizes.append(len(raw))
            spans.append([{"a": a, "b": b} for a, b in merged])
        yield pa.RecordBatch.from_pydict({
            "doc_id": batch.column("doc_id"), "n_bytes": pa.array(sizes, pa.int64()), "spans": pa.array(spans, _MARKS), "kept": pa.array(kept, pa.binary()),
        })


def remove_repeats(documents: DataFrame, hot: int = HOT) -> DataFrame:
    """doc_id, n_bytes, spans (removed byte ranges a to b, end exclusive) and kept (the remaining bytes)."""
    kind = documents.schema["doc_id"].dataType.simpleString()
    rows = documents.select("doc_id", F.xxhash64("text", F.octet_length("text")).alias("text_hash"), F.coalesce("text", F.lit("")).alias("text"))
    places = settle(rows.mapInArrow(_occurrences, f"key bigint, name bigint, doc_id {kind}, text_hash bigint, start int, n int"))
    # written first, so that Spark can split a key with very many places in the join
    keys = settle(places.groupBy("key").agg(F.count("*").alias("m")).filter("m > 1").select("key", (F.col("m") > hot).alias("hot")))
    shared = settle(places.join(keys, "key"))
    once = settle(shared.groupBy("key", "name").agg(
        F.min(F.struct("doc_id", "text_hash", "start", "n")).alias("one"), F.count("*").alias("copies"), F.first("hot").alias("hot")
    ))
    # a key with one distinct segment needs no index: its copies are whole repeats
    several = once.groupBy("key").agg(F.count("*").alias("names")).filter("names > 1").select("key")
    whole = once.join(several, "key", "left_anti").select("key", "name", F.array(F.struct(F.lit(0).alias("a"), (F.col("one.n") + WINDOW - 1).alias("b"))).alias("marks"))
    wanted = once.join(several, "key").groupBy(F.col("one.doc_id").alias("_id"), F.col("one.text_hash").alias("_hash")).agg(
        F.collect_list(F.struct("key", "name", "copies", "hot", "one.start", "one.n")).alias("wanted")
    )
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_hash") == F.col("_hash"))
    packed = rows.mapInArrow(_packed, f"doc_id {kind}, text_hash bigint, packed binary")
    source = packed.join(wanted, same).select("packed", "wanted")
    bodies = source.mapInArrow(_fetched, "deal bigint, key bigint, name bigint, copies bigint, at int, body binary")
    dealt = bodies.repartition("deal").sortWithinPartitions("deal", "key", "name", "at")
    marks = dealt.mapInArrow(_marked, "key bigint, name bigint, marks array<struct<a:int,b:int>>")
    found = shared.join(settle(marks.unionAll(whole)), ["key", "name"]).select(
        F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"),
        F.explode(F.transform("marks", lambda m: F.struct((m["a"] + F.col("start")).alias("a"), (m["b"] + F.col("start")).alias("b")))).alias("mark"),
    )
    per_document = found.groupBy("_id", "_hash").agg(F.collect_list("mark").alias("marks"))
    return packed.join(per_document, same, "left").select("doc_id", "packed", "marks").mapInArrow(
        _cut, f"doc_id {kind}, n_bytes bigint, spans array<struct<a:int,b:int>>, kept binary"
    )


def digest(documents: DataFrame) -> DataFrame:
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["b"] - s["a"])
    return remove_repeats(documents).select(
        "doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256")
    )
