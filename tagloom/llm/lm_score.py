"""Cross-entropy difference scores.

A target model (labelled good documents) and a background model (all other documents) share one vocabulary and one smoothing, so
their losses are comparable token by token. All words of the corpus are known and every bigram has its own exact count, so what
is counted grows with the corpus. Probabilities interpolate bigram, unigram and uniform. A document's score is the mean over its
words of target loss minus background loss: the lower, the more target-like.

Documents are written in blocks of about BLOCK_BYTES of text. What a block counts (cells: bigrams, words and words that precede)
is summed inside the block, cut by hash ranges and sent to these; a range holds about BUCKET_CELLS cells whatever the size of the
corpus, sums what blocks sent and returns the sums to them in the order of their cells. So a cell travels once for each block, a
frequent one has no more rows than there are blocks, and no task or driver holds a model. A fit may instead know only the most
frequent words (all others are one unknown word) and hash bigrams into slots. Words and cells are identified by 62 to 64 bits.

Null and wordless texts have 0 words and losses and score 0. Labels of no document, null labels and ids are ignored; repeated
rows are counted and scored one by one. Without target documents the target model is uniform. Only doc_id and text are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.functions.scale import lookup_join, settle
from tagloom.llm.common import byte_class, flat, mix, pieces, word_hashes

#: Bytes of text of a block, and about how many cells a hash range holds.
BLOCK_BYTES = 16 << 20
BUCKET_CELLS = 1 << 21
#: Share of bigram, unigram and uniform probability.
WEIGHTS = (0.6, 0.35, 0.05)
WORD_BYTES = byte_class((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF))
#: Stands before the first word of a text where words are known by their hashes.
START = np.uint64(0xA24BAED4963EE407)
PAIR, WORD, BEFORE = (np.uint64(k) for k in range(3))


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Number the rows' blocks; a document longer than a block is one."""
    block, size = TaskContext.get().partitionId() << 32, 0
    for batch in pieces(batches):
        n = pc.sum(pc.binary_length(batch.column("text"))).as_py() or 0
        if size and size + n > BLOCK_BYTES:
            block, size = block + 1, 0
        size += n
        yield batch.append_column("block", pa.array(np.full(batch.num_rows, block, np.int64)))


def blocked(rows: DataFrame) -> DataFrame:
    """doc_id, text and target with a block, written so that blocks stay the same."""
    kind = rows.schema["doc_id"].dataType.simpleString()
    return settle(rows.select("doc_id", "text", "target").mapInArrow(_blocks, f"doc_id {kind}, text string, target boolean, block bigint"), "zstd")


class Counts:
    """Keys with their counts in the background and the target, summed as they come."""

    def __init__(self):
        self.keys, self.n = ([], []), ([], [])

    def add(self, keys: np.ndarray, target: np.ndarray) -> None:
        for kind, mine in enumerate((~target, target)):
            found, n = np.unique(keys[mine], return_counts=True)
            self.keys[kind].append(found)
            self.n[kind].append(n)

    def held(self) -> int:
        return sum(map(len, self.keys[0])) + sum(map(len, self.keys[1]))

    def summed(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Sorted keys, background counts, target counts."""
        none = np.zeros(0, np.uint64)
        keys = np.unique(np.concatenate([none, *self.keys[0], *self.keys[1]]))
        sums = []
        for kind in (0, 1):
            at = np.searchsorted(keys, np.concatenate([none, *self.keys[kind]]))
            sums.append(np.bincount(at, np.concatenate([np.zeros(0), *self.n[kind]]), len(keys)).astype(np.int64))
        return keys, *sums


def _words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def done() -> pa.RecordBatch:
        words, b, t = counts.summed()
        return pa.RecordBatch.from_pydict({"word": pa.array(words.view(np.int64)), "b": pa.array(b), "t": pa.array(t)})

    counts = Counts()
    for batch in pieces(batches):
        _, _, words, first = word_hashes(*flat(batch.column("text")), WORD_BYTES)
        counts.add(words, np.repeat(batch.column("target").to_numpy(zero_copy_only=False).astype(bool), np.diff(first)))
        if counts.held() > 4_000_000:
            yield done()
            counts = Counts()
    yield done()


class Coder:
    """Numbers words. With a vocabulary: 0 to V - 1 known, V unknown, V + 1 the start of a text; without, a word is its hash.

    ``unknown`` is the number of known words. Bigrams are numbered apart, or share a number of slots.
    """

    def __init__(self, words: np.ndarray | None, unknown: int, slots: int | None = None):
        self.words, self.unknown, self.slots = words, unknown, slots

    def pairs(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Word numbers, those before them, the numbers of both together, and the first word of each text."""
        _, _, word, first = word_hashes(*flat(texts), WORD_BYTES)
        start = START
        if self.words is not None:
            start = np.uint64(self.unknown + 1)
            if len(self.words):
                near = np.minimum(np.searchsorted(self.words, word), len(self.words) - 1)
                word = np.where(self.words[near] == word, near, self.unknown).astype(np.uint64)
            else:
                word = np.zeros(len(word), np.uint64)
        before = np.empty_like(word)
        before[1:] = word[:-1]
        before[first[:-1][first[:-1] < first[1:]]] = start
        pair = mix(mix(before + np.uint64(1)) + word)
        return word, before, pair if self.slots is None else pair % np.uint64(self.slots), first

    def block(self, texts: list[pa.Array]) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
        """The sorted cells of a block, which of them are the bigram, the word and the preceding word of each word, and the words of each text.

        Words and bigrams are told apart once; a preceding word is looked up as the word before.
        """
        found = [self.pairs(t) for t in texts]
        word, before, pair = (np.concatenate([np.zeros(0, np.uint64), *(f[k] for f in found)]) for k in range(3))
        n = np.concatenate([np.zeros(0, np.int64), *(np.diff(f[3]) for f in found)])
        words, at_word = np.unique(word, return_inverse=True)
        pairs, at_pair = np.unique(pair, return_inverse=True)
        start = START if self.words is None else np.uint64(self.unknown + 1)
        at_before = np.concatenate([[len(words)], at_word[:-1]]) if len(word) else at_word
        at_before[before == start] = len(words)
        cell = lambda of, kind: (mix(of) & ~np.uint64(3)) | kind
        cells = np.concatenate([cell(pairs, PAIR), cell(words, WORD), cell(np.append(words, start), BEFORE)])
        order = np.argsort(cells)
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        return cells[order], [place[at_pair], place[len(pairs) + at_word], place[len(pairs) + len(words) + at_before]], n


def _pack(numbers: np.ndarray) -> bytes:
    """Compressed byte by byte: first all lowest bytes, and so on."""
    return zstandard.compress(np.ascontiguousarray(numbers.view(np.uint8).reshape(-1, 8).T).tobytes(), 1)


def _unpack(packed: bytes, kind: type = np.int64) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(packed), np.uint8)
    return np.ascontiguousarray(planes.reshape(8, -1).T).reshape(-1).view(kind)


SLICE = "bucket bigint, block bigint, want boolean, cells binary, b binary, t binary"


def _slices(sent, buckets: int, want: bool, counted: bool):
    """What each block counts, cut into hash ranges."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        borders = np.array([(j << 64) // buckets for j in range(1, buckets)], np.uint64)
        held: list[pa.RecordBatch] = []

        def done() -> Iterator[pa.RecordBatch]:
            cells, at, n = sent.value.block([part.column("text") for part in held])
            target = np.repeat(np.concatenate([part.column("target").to_numpy(zero_copy_only=False).astype(bool) for part in held]), n)
            all_, t = (sum(np.bincount(a, minlength=len(cells)) for a in own) for own in (at, [a[target] for a in at]))
            b = all_ - t
            if not counted:
                b, t = np.zeros_like(b), np.zeros_like(t)
            cuts = np.concatenate([[0], np.searchsorted(cells, borders), [len(cells)]])
            for j in np.flatnonzero(np.diff(cuts)).tolist():
                own = slice(cuts[j], cuts[j + 1])
                gaps = np.diff(cells[own], prepend=np.uint64(0))
                yield pa.RecordBatch.from_pydict({
                    "bucket": pa.array([j], pa.int64()), "block": held[0].column("block").slice(0, 1), "want": pa.array([want]),
                    "cells": pa.array([_pack(gaps)], pa.binary()), "b": pa.array([_pack(b[own])], pa.binary()), "t": pa.array([_pack(t[own])], pa.binary()),
                })

        for batch in pieces(batches):
            of = batch.column("block").to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(of)) + 1).tolist(), len(of)]
            for a, z in zip(cuts[:-1], cuts[1:], strict=True):
                if held and of[a] != held[0].column("block")[0].as_py():
                    yield from done()
                    held = []
                held.append(batch.slice(a, z - a))
        if held:
            yield from done()

    return run


def _summed(slices: pa.Table) -> pa.Table:
    """Sum the cells of a hash range over all blocks; slices that want it get the sums in the order of their cells."""
    cells = [np.cumsum(_unpack(c.as_py(), np.uint64), dtype=np.uint64) for c in slices.column("cells")]
    known, at = np.unique(np.concatenate(cells), return_inverse=True)
    ends = np.cumsum([len(c) for c in cells])
    want = slices.column("want").to_numpy()
    out = {}
    for side in ("b", "t"):
        sums = np.bincount(at, np.concatenate([_unpack(n.as_py()) for n in slices.column(side)]), len(known)).astype(np.int64)
        out[side] = pa.array([_pack(own) for own, w in zip(np.split(sums[at], ends[:-1]), want, strict=True) if w], pa.binary())
    return slices.filter(pa.array(want)).select(["bucket", "block"]).append_column("b", out["b"]).append_column("t", out["t"])


class Models:
    """What both models count: the fitted documents in blocks, and how many words each side has."""

    def __init__(self, coder: Coder, documents: DataFrame, blocks: DataFrame, total: tuple[int, int]):
        self.coder, self.documents, self.blocks, self.total = coder, documents, blocks, total


def fit(documents: DataFrame, labels: DataFrame, vocabulary_size: int | None = None, slots: int | None = None) -> Models:
    """labels: doc_id and quality, 1 marks the target; every document so labelled counts there.

    Only a vocabulary of a given size reaches the driver: the most frequent words, of equally frequent ones those of smaller hash.
    """
    good = labels.filter("quality = 1 AND doc_id IS NOT NULL").select("doc_id").distinct().withColumn("target", F.lit(True))
    rows = lookup_join(documents.select("doc_id", "text"), good, "doc_id", ["doc_id", "text"])
    blocks = blocked(rows.select("doc_id", "text", F.coalesce("target", F.lit(False)).alias("target")))
    counts = blocks.select("text", "target").mapInArrow(_words, "word bigint, b bigint, t bigint").groupBy("word").agg(F.sum("b").alias("b"), F.sum("t").alias("t"))
    if vocabulary_size is not None:
        counts = settle(counts)
    known, *total = counts.agg(F.count("*"), F.coalesce(F.sum("b"), F.lit(0)), F.coalesce(F.sum("t"), F.lit(0))).first()
    words = None
    if vocabulary_size is not None:
        top = counts.orderBy(F.desc(F.col("b") + F.col("t")), "word").limit(vocabulary_size).select("word").collect()
        words = np.sort(np.array([r["word"] for r in top], np.int64).view(np.uint64))
        known = len(words)
    return Models(Coder(words, known, slots), documents, blocks, tuple(total))


def _losses(sent, total: tuple[int, int]):
    """Score the documents of a block with the sums returned to it."""

    def loss(side: int, sums: np.ndarray, at: list[np.ndarray], known: int) -> np.ndarray:
        two, one, flat_ = WEIGHTS
        pair, word, before = (sums[k].astype(np.float64) for k in at)
        return -np.log(two * np.minimum(pair, before) / np.maximum(before, 1) + one * word / max(total[side], 1) + flat_ / (known + 1))

    def run(documents: pa.Table, back: pa.Table) -> pa.Table:
        coder = sent.value
        back = back.sort_by("bucket")
        sums = [np.concatenate([np.zeros(0, np.int64), *(_unpack(n.as_py()) for n in back.column(side))]) for side in ("b", "t")]
        parts = list(pieces(documents.combine_chunks().to_batches()))
        _, at, n = coder.block([part.column("text") for part in parts])
        of = np.repeat(np.arange(len(n)), n)
        b, t = (np.bincount(of, loss(k, sums[k], at, coder.unknown), len(n)) / np.maximum(n, 1) for k in (0, 1))
        found = {"n_words": pa.array(n, pa.int64()), "target_loss": pa.array(t), "background_loss": pa.array(b), "score": pa.array(t - b)}
        return pa.table({"doc_id": documents.column("doc_id"), **found})

    return run


def score(documents: DataFrame, models: Models) -> DataFrame:
    """doc_id, n_words, target_loss, background_loss and score, their difference; means over the words.

    Documents that are not those of the fit only ask for sums and add nothing to them.
    """
    sent = documents.sparkSession.sparkContext.broadcast(models.coder)
    buckets = sum(models.total) // BUCKET_CELLS + 1
    same = documents is models.documents
    asked = models.blocks if same else blocked(documents.select("doc_id", "text", F.lit(False).alias("target")))
    sliced = lambda rows, want, counted: rows.select("text", "target", "block").mapInArrow(_slices(sent, buckets, want, counted), SLICE)
    slices = sliced(models.blocks, same, True)
    if not same:
        slices = slices.unionAll(sliced(asked, True, False))
    back = slices.groupBy("bucket").applyInArrow(_summed, "bucket bigint, block bigint, b binary, t binary")
    kind = documents.schema["doc_id"].dataType.simpleString()
    found = asked.select("doc_id", "text", "block").groupBy("block").cogroup(back.groupBy("block"))
    return found.applyInArrow(_losses(sent, models.total), f"doc_id {kind}, n_words bigint, target_loss double, background_loss double, score double")


def digest(documents: DataFrame, labels: DataFrame) -> DataFrame:
    return score(documents, fit(documents, labels))
