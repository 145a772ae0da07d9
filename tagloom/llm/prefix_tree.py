"""Jaccard join of n-gram sets with prefix trees.

A document's set are the hashes of its distinct word shingles, in one global order (that of the hashes). Shingle length and least
similarity are a ``Likeness``, by default 3 words and 0.9. Equal sets are one class from the start. Two sets of the least Jaccard
similarity differ in few elements, so when the hash range is cut into one part more than they may differ in, at least one part
holds the same elements in both. The number of parts depends on the size level; levels are so wide that linked sets are at most
one level apart, and every set is cut for its own level and the next. Where low similarities make parts small, there are spare
parts: as many more agree, so a set with no more empty parts than that need not be found by them, and the few with more also
meet on their first elements. Empty parts are never met on. Sets that agree in some part are candidates; nothing that links is
missed.

Agreement in a part is not enough, as passages that many texts share bring it as well. The sets of a part first meet with their odd
sketches (the parities of hash buckets, one to two bits an element); parts that the same sets agree in count once. Sketches never
differ in more places than sets do, so only sets whose sketches are near stay connected, and the connected pieces are the groups.
What is still very large (WHOLE blocks) meets part by part. A group beyond BLOCK sets is cut into blocks and
every pair of blocks is a group. A group's sets are stored in a path-compressed trie. A set is looked up by a walk that shares
the overlap along common prefixes and leaves a subtree when the remaining lengths cannot reach the needed overlap. Sets of a
component with more than half of a group need not be looked up, since all others are. What comes out are links that span the
components, so no group emits all its pairs.

Null and wordless texts have no set and are a component of their own; so is a row with a null id. Fewer words than a shingle has
are one shingle. Repeated rows and equal texts share a component. Only doc_id and text are read.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from functools import lru_cache, partial
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.core.broadcast import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.functions.scale import lookup_join, settle
from tagloom.llm.common import byte_class, flat, mix, pieces, word_hashes
from tagloom.llm.components import connected_components

#: Sets of one trie, and how many tries' worth of sets of one connected piece meet as such.
BLOCK = 2000
WHOLE = 16
#: Words are runs of anything but blanks.
WORD_BYTES = ~byte_class((0x20, 0x20), (0x09, 0x0D))
CHUNK = 64
#: Words of sketches compared at a time.
COMPARED = 1 << 18
#: Bits by which marks are first counted.
FOLD = 40
#: Bits that tell which folds are shared, at most, and bytes of them a task makes at a time.
MOST_BITS = 1 << 28
CHUNK_BYTES = 1 << 16
#: Ids of texts to be read again are broadcast up to this size by measure.
FETCH_BYTES = 16 << 20


class Likeness(NamedTuple):
    """Words of a shingle, and the least Jaccard similarity as a fraction."""

    ngram: int = 3
    over: int = 9
    under: int = 10


CONTRACT = Likeness()


@lru_cache(4)
def levels(like: Likeness = CONTRACT) -> np.ndarray:
    """Where size levels begin: each reaches to 1 / similarity of its first size, so linked sizes are at most one level apart."""
    out = [1]
    while out[-1] < 1 << 40:
        out.append(out[-1] * like.under // like.over + 1)
    return np.array(out)


@lru_cache(4096)
def parts(level: int, like: Likeness = CONTRACT) -> tuple[np.ndarray, np.ndarray, int]:
    """Inner borders of the hash range at a level, a number for each part, and how many parts are spare."""
    _, p, q = like
    most = 2 * (int(levels(like)[level + 1]) - 1) * (q - p) // (p + q)
    spare = int(4 * most * math.exp(-(p + q) / (2 * (q - p)) * (p / q) ** 2))
    n = most + 1 + spare
    borders = np.array([(j << 64) // n for j in range(1, n)], np.uint64)
    return borders, mix(np.arange(n, dtype=np.uint64) + np.uint64((level + 1) << 40)), spare


def shingle_sets(texts: pa.Array, ngram: int = CONTRACT.ngram) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    _, _, w, first = word_hashes(*flat(texts), WORD_BYTES)
    if len(w) >= ngram:
        s = w[: len(w) - ngram + 1]
        for k in range(1, ngram):
            s = mix(s * np.uint64((0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)[(k - 1) % 2]) + w[k : len(w) - ngram + 1 + k])
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if b - a >= ngram:
            out.append(np.unique(s[a : b - ngram + 1]))
        elif b > a:
            short = w[a : a + 1]
            for k in range(a + 1, b):
                short = mix(short) + w[k : k + 1]
            out.append(mix(short + np.uint64(b - a)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def class_of(tokens: np.ndarray) -> int:
    """64 bits that stand for a set."""
    return int((mix(mix(tokens) + np.uint64(3)).sum(dtype=np.uint64) + np.uint64(len(tokens))).view(np.int64))


def signatures(tokens: np.ndarray, like: Likeness = CONTRACT) -> np.ndarray:
    """One number for each part of the set at its level and the next that is not empty; sets of one part need none, they are equal or apart.

    If one of two linked sets has no more empty parts than there are spare ones, some part that is not empty agrees. Sets with more
    meet each other on their first elements: as many as one has beyond the least overlap, and one more.
    """
    level = int(np.searchsorted(levels(like), len(tokens), side="right")) - 1
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(tokens), dtype=np.uint64)])
    out, sparse = [], False
    for at in (level, level + 1):
        borders, numbers, spare = parts(at, like)
        if len(borders):
            cuts = np.concatenate([[0], np.searchsorted(tokens, borders), [len(tokens)]])
            empty = np.diff(cuts) == 0
            out.append(mix(np.diff(sums[cuts]) ^ numbers)[~empty])
            sparse |= int(empty.sum()) > spare
    if sparse:
        out.append(mix(tokens[: len(tokens) + 1 + -len(tokens) * like.over // like.under] + np.uint64(1)))
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def odd_sketch(tokens: np.ndarray) -> bytes:
    """One bit for each of at least as many hash buckets as there are elements: whether it holds an odd number of them."""
    bits = 1 << max(6, (len(tokens) - 1).bit_length())
    odd = np.bincount((tokens & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def folded(odd: np.ndarray, words: int) -> np.ndarray:
    """The sketches, one a row, as they would be with fewer buckets."""
    while odd.shape[1] > words:
        half = odd.shape[1] // 2
        odd = odd[:, :half] ^ odd[:, half:]
    return odd


def near_pieces(sizes: np.ndarray, odds: list[bytes], like: Likeness = CONTRACT) -> np.ndarray:
    """A piece number for each set; all sets that may have the least similarity by their sizes and sketches share one."""
    _, p, q = like
    words = np.array([len(odd) // 8 for odd in odds])
    tables = {w: (at := np.flatnonzero(words == w), np.frombuffer(b"".join(odds[k] for k in at), np.uint64).reshape(len(at), w)) for w in set(words.tolist())}
    piece = np.arange(len(sizes))
    for w, (at, odd) in tables.items():
        for wider, (others, table) in tables.items():
            if wider < w or p * sizes[others].min() > q * sizes[at].max():
                continue
            table, size = folded(table, w), sizes[others]
            step = max(1, COMPARED // table.size)
            for n in range(0, len(at), step):
                own = sizes[at[n : n + step], None]
                differ = np.bitwise_count(odd[n : n + step, None, :] ^ table).sum(axis=2, dtype=np.int64)
                near = ((p + q) * differ <= (q - p) * (size + own)) & (p * np.maximum(size, own) <= q * np.minimum(size, own))
                for k in np.flatnonzero(near.sum(axis=1) > (wider == w)).tolist():
                    joined, mine = piece[others[near[k]]], piece[at[n + k]]
                    if (joined != mine).any():
                        piece[np.isin(piece, joined)] = mine
    return piece


def _sketch(like: Likeness, marked: bool, kept: Broadcast | None, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each text's set, with its size or its marks, of these only what ``kept`` has a bit for."""
    for batch in pieces(batches):
        sets = shingle_sets(batch.column("text"), like.ngram)
        out = {"doc_id": batch.column("doc_id"), "set": pa.array([class_of(s) if len(s) else None for s in sets], pa.int64())}
        if marked:
            marks = [signatures(s, like) if len(s) else np.zeros(0, np.uint64) for s in sets]
            marks = marks if kept is None else [m[has_bit(kept.value, m)] for m in marks]
            ends = np.cumsum([0, *map(len, marks)])
            out["marks"] = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(marks).view(np.int64)))
        else:
            out["n_shingles"] = pa.array([len(s) for s in sets], pa.int64())
            out["odd"] = pa.array([odd_sketch(s) if len(s) else None for s in sets], pa.binary())
        yield pa.RecordBatch.from_pydict(out)


def has_bit(bits: np.ndarray, marks: np.ndarray) -> np.ndarray:
    at = marks & np.uint64(8 * len(bits) - 1)
    return (bits[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8) & 1).astype(bool)


def _chunks_of_bits(size: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Bits of the marks' folds, in chunks of ``size`` bytes; a task has all folds of its chunks."""
    found: dict[int, np.ndarray] = {}
    for batch in batches:
        chunk, bit = (batch.column(c).to_numpy() for c in ("chunk", "bit"))
        for c in np.unique(chunk).tolist():
            at = bit[chunk == c]
            np.bitwise_or.at(found.setdefault(c, np.zeros(size, np.uint8)), at >> 3, (1 << (at & 7)).astype(np.uint8))
    yield pa.RecordBatch.from_pydict({"chunk": pa.array(list(found), pa.int64()), "bits": pa.array([b.tobytes() for b in found.values()], pa.binary())})


def bits_of(shared: DataFrame, most: int = MOST_BITS) -> np.ndarray | None:
    """One bit for the low bits of each fold, about 16 bits a fold; none where ``most`` bits leave less than four."""
    n = shared.count()
    if 4 * n > most:
        return None
    bits = min(most, 1 << max(6, (16 * n).bit_length()))
    size = min(bits // 8, CHUNK_BYTES)
    at = F.col("fold").bitwiseAND(F.lit(bits - 1))
    folds = shared.select(F.floor(at / (8 * size)).cast("long").alias("chunk"), (at % (8 * size)).alias("bit"))
    out = np.zeros(bits // 8, np.uint8)
    for row in folds.repartition("chunk").mapInArrow(partial(_chunks_of_bits, size), "chunk bigint, bits binary").collect():
        out[row["chunk"] * size : (row["chunk"] + 1) * size] = np.frombuffer(row["bits"], np.uint8)
    return out


def _packed(like: Likeness, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts travel compressed, which takes less than their sets; one that is not of the wanted set (ids may repeat) is left out."""
    pack = zstandard.ZstdCompressor(level=1).compress
    for batch in pieces(batches):
        sets = shingle_sets(batch.column("text"), like.ngram)
        right = [k for k, (want, s) in enumerate(zip(batch.column("set").to_pylist(), sets, strict=True)) if len(s) and class_of(s) == want]
        own = batch.take(pa.array(right, pa.int64()))
        body = pa.array([pack(t.encode()) for t in own.column("text").to_pylist()], pa.binary())
        yield own.drop_columns(["text"]).append_column("packed", body)


class Trie:
    """Path-compressed trie of sets in lexicographic order, as arrays; long edges are chains of CHUNK elements.

    A node has its edge ``tokens[start:end]``, its depth before the edge, the smallest and largest size of the sets below, its
    children (one after the other) and its members, the sets that end there.
    """

    def __init__(self, sets: list[np.ndarray], like: Likeness = CONTRACT):
        self.over, self.both = like.over, like.over + like.under
        order = sorted(range(len(sets)), key=lambda k: sets[k].astype(">u8").tobytes())
        sizes = np.array([len(sets[k]) for k in order])
        todo, rows, members, edges, at_edge = [(0, len(order), 0, 0)], [], [], [], 0
        made = 0
        while made < len(todo):
            low, high, depth, end = todo[made]
            made += 1
            edge = sets[order[low]][depth : min(end, depth + CHUNK)] if len(order) else np.zeros(0, np.uint64)
            depth_after, first, first_member = depth + len(edge), len(todo), len(members)
            if depth_after < end:
                todo.append((low, high, depth_after, end))
            else:
                at = low
                while at < high and sizes[at] == end:
                    members.append(order[at])
                    at += 1
                while at < high:
                    head, upto = sets[order[at]][end], at + 1
                    while upto < high and sets[order[upto]][end] == head:
                        upto += 1
                    one, other = sets[order[at]], sets[order[upto - 1]]
                    n = min(len(one), len(other))
                    apart = np.flatnonzero(one[end:n] != other[end:n])
                    todo.append((at, upto, end, end + int(apart[0]) if len(apart) else n))
                    at = upto
            own = sizes[low:high]
            rows.append((at_edge, at_edge + len(edge), depth, own.min() if len(own) else 0, own.max() if len(own) else 0, first, len(todo), first_member, len(members)))
            edges.append(edge)
            at_edge += len(edge)
        self.start, self.end, self.depth, self.low, self.high, self.child, self.child_end, self.member, self.member_end = np.array(rows, np.int64).T
        self.members = np.array(members, np.int64)
        known, dense = np.unique(np.concatenate([*edges, *sets]), return_inverse=True)
        self.tokens = dense[:at_edge]
        cuts = np.cumsum([at_edge, *map(len, sets)])
        self.sets = [dense[cuts[k] : cuts[k + 1]] for k in range(len(sets))]
        self.inside = np.zeros(len(known), bool)

    def linked(self, k: int) -> np.ndarray:
        """The sets with the least Jaccard similarity or more to set ``k``, itself included.

        All branches are walked together, one edge at a time: what was shared along a prefix goes on to its children, and
        branches whose remaining lengths cannot reach the needed overlap end.
        """
        x = self.sets[k]
        s, found = len(x), []
        self.inside[x] = True
        front, shared = np.zeros(1, np.int64), np.zeros(1, np.int64)
        while len(front):
            a, n = self.start[front], self.end[front] - self.start[front]
            off = np.cumsum(n) - n
            hits = self.inside[self.tokens[np.arange(n.sum()) + np.repeat(a - off, n)]]
            sums = np.concatenate([[0], np.cumsum(hits)])
            shared = shared + sums[off + n] - sums[off]
            depth = self.depth[front] + n
            rest = s - np.where(n > 0, np.searchsorted(x, self.tokens[np.maximum(a + n - 1, 0)], side="right") if len(self.tokens) else 0, 0)
            best = np.clip(depth + rest, self.low[front], self.high[front])
            alive = self.both * (shared + np.minimum(rest, best - depth)) >= self.over * (s + best)
            front, shared, depth = front[alive], shared[alive], depth[alive]
            ends = (self.member_end[front] > self.member[front]) & (self.both * shared >= self.over * (s + depth))
            found += [self.members[self.member[f] : self.member_end[f]] for f in front[ends]]
            number = self.child_end[front] - self.child[front]
            off = np.cumsum(number) - number
            shared = np.repeat(shared, number)
            front = np.arange(number.sum()) + np.repeat(self.child[front] - off, number)
        self.inside[x] = False
        return np.concatenate(found) if found else np.zeros(0, np.int64)


class Forest:
    def __init__(self, n: int):
        self.up, self.size = list(range(n)), [1] * n

    def find(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, a: int, b: int) -> None:
        a, b = self.find(a), self.find(b)
        if a != b:
            self.up[a] = b
            self.size[b] += self.size[a]


def links(sets: list[np.ndarray], block: list[int] | None = None, like: Likeness = CONTRACT) -> Forest:
    """Components of the sets under the least similarity; with ``block``, only pairs from different blocks are compared."""
    trie, forest = Trie(sets, like), Forest(len(sets))
    for k in range(len(sets)):
        if 2 * forest.size[forest.find(k)] > len(sets):
            continue
        for m in trie.linked(k).tolist():
            if block is None or block[m] != block[k]:
                forest.join(k, m)
    return forest


def _linked(like: Likeness, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by group; each set is told the least set it is linked to within the group."""
    key, names, sets, of = None, [], [], []
    unpack = zstandard.ZstdDecompressor().decompress

    def done() -> pa.RecordBatch:
        forest = links(sets, of if key[1] != key[2] else None, like)
        least: dict[int, int] = {}
        for k, name in enumerate(names):
            r = forest.find(k)
            least[r] = min(least.get(r, name), name)
        rows = [(name, least[forest.find(k)]) for k, name in enumerate(names) if least[forest.find(k)] != name]
        return pa.RecordBatch.from_pydict({"a": pa.array([a for a, _ in rows], pa.int64()), "b": pa.array([b for _, b in rows], pa.int64())})

    for batch in batches:
        cols = [batch.column(c).to_pylist() for c in ("route", "i", "j", "set", "own")]
        for (*here, name, own), packed in zip(zip(*cols, strict=True), batch.column("packed"), strict=True):
            if here != key:
                if len(names) > 1:
                    yield done()
                key, names, sets, of = here, [], [], []
            names.append(name)
            sets.append(shingle_sets(pa.array([unpack(packed.as_py()).decode()]), like.ngram)[0])
            of.append(own)
    if len(names) > 1:
        yield done()


def _near(like: Likeness, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by group; each set is told the least set that its sketch connects it to within the group."""
    key, names, sizes, odds = None, [], [], []

    def done() -> pa.RecordBatch:
        name, piece = np.array(names, np.int64), near_pieces(np.array(sizes, np.int64), odds, like)
        least = np.full(len(name), np.iinfo(np.int64).max)
        np.minimum.at(least, piece, name)
        moved = least[piece] != name
        return pa.RecordBatch.from_pydict({"a": pa.array(name[moved]), "b": pa.array(least[piece][moved])})

    for batch in batches:
        for *here, name, size, odd in zip(*[batch.column(c).to_pylist() for c in ("route", "i", "j", "set", "n_shingles", "odd")], strict=True):
            if here != key:
                if len(names) > 1:
                    yield done()
                key, names, sizes, odds = here, [], [], []
            names.append(name)
            sizes.append(size)
            odds.append(odd)
    if len(names) > 1:
        yield done()


def _cells(groups: DataFrame) -> DataFrame:
    """Each set (of a group route cut into n blocks) in all pairs of blocks that hold its own."""
    cells = groups.withColumn("own", F.pmod(F.xxhash64("set"), F.col("n")).cast("int"))
    cells = cells.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("n") - 1)))
    return cells.select("route", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "set", "own")


def _by_mark(hits: DataFrame, block: int) -> DataFrame:
    """Sets meet by their marks. How many sets have a mark stands in each hit (``m``), so nothing is counted or joined anew."""
    return hits.select(F.col("mark").alias("route"), "set", F.ceil(F.col("m") / block).cast("int").alias("n"))


def _recounted(hits: DataFrame) -> DataFrame:
    """Hits of marks that several of the given sets have, with their number ``m`` among these."""
    members = hits.groupBy("mark").agg(F.count("*").alias("m")).filter("m > 1")
    return hits.drop("m").join(members, "mark")


def _pieces(links: DataFrame) -> DataFrame:
    """set, root, n: the connected piece of each set, and how many sets it has."""
    found = connected_components(links)
    whole = settle(found.select(F.col("node").alias("set"), "root").unionAll(found.select("root", "root").distinct().toDF("set", "root")))
    return whole.join(whole.groupBy("root").agg(F.count("*").alias("n")), "root")


def _told_once(hits: DataFrame) -> DataFrame:
    """The hits of one mark of all those that the same sets have; 64 bits, the least set and their number tell the sets."""
    of = hits.groupBy("mark").agg(F.min("set").alias("least"), F.count("*").alias("m"), F.bit_xor(F.xxhash64("set")).alias("sets"))
    return hits.select("set", "mark", "m").join(of.groupBy("least", "m", "sets").agg(F.min("mark").alias("mark")).select("mark"), "mark")


def _groups(hits: DataFrame, sketch: DataFrame, block: int, like: Likeness) -> DataFrame:
    """route, i, j, set, own: which sets meet in which group; own is the block a set comes from.

    All hits take the same way, whatever the size of the piece their sets are in, so rows grow with the hits.
    """
    told = settle(_told_once(hits))
    odd = sketch.groupBy("set").agg(F.first("n_shingles").alias("n_shingles"), F.first("odd").alias("odd"))
    meet = _cells(_by_mark(told, block)).drop("own").join(odd, "set").select("route", "i", "j", "set", "n_shingles", "odd")
    near = meet.repartition("route", "i", "j").sortWithinPartitions("route", "i", "j").mapInArrow(partial(_near, like), "a bigint, b bigint")
    found = settle(_pieces(near))
    small = found.filter(F.col("n") <= WHOLE * block)
    small = small.select(F.col("root").alias("route"), "set", F.ceil(F.col("n") / block).cast("int").alias("n"))
    vast = found.filter(F.col("n") > WHOLE * block).select("set")
    return _cells(small.unionAll(_by_mark(_recounted(told.join(vast, "set")), block)))


def _hits(sets: DataFrame, marked: Callable[[Broadcast | None], DataFrame], most: int = MOST_BITS) -> DataFrame:
    """set, mark, least, m: the marks that several sets have, the least of these and their number.

    Marks are made twice and never written. They travel once, by FOLD bits, to be counted, and only one of a set's copies sends
    them. Tasks are then told the shared folds as bits, of bounded size, and send the marks that have one; few of these are not
    shared, and they go when marks are told apart. Where there are too many shared folds for that, they are met in a shuffle.
    """
    context = sets.sparkSession.sparkContext
    copied = sets.groupBy("set").agg(F.count("*").alias("n"), F.min("doc_id").alias("one")).filter("n > 1").drop("n")

    def made(kept: Broadcast | None) -> DataFrame:
        each = lookup_join(marked(kept), copied, "set", ["doc_id"]).filter("one IS NULL OR one <=> doc_id")
        return each.select("set", F.explode("marks").alias("mark"))

    fold = F.col("mark").bitwiseAND(F.lit((1 << FOLD) - 1))
    shared = settle(made(None).select(fold.alias("fold")).groupBy("fold").agg(F.count("*").alias("n")).filter("n > 1").select("fold"))
    bits = bits_of(shared, most)
    found = made(None).withColumn("fold", fold).join(shared, "fold") if bits is None else made(context.broadcast(bits))
    met = settle(found.select("set", "mark").distinct())
    least = met.groupBy("mark").agg(F.min("set").alias("least"), F.count("*").alias("m")).filter("m > 1")
    return met.join(least, "mark")


def jaccard_components(documents: DataFrame, block: int = BLOCK, like: Likeness = CONTRACT) -> DataFrame:
    """doc_id, n_shingles and component_id, the least id that links reach."""
    kind = documents.schema["doc_id"].dataType.simpleString()
    rows = documents.select("doc_id", "text")
    sketch = settle(rows.mapInArrow(partial(_sketch, like, False, None), f"doc_id {kind}, set bigint, n_shingles bigint, odd binary"))

    def marked(kept: Broadcast | None) -> DataFrame:
        return rows.mapInArrow(partial(_sketch, like, True, kept), f"doc_id {kind}, set bigint, marks array<bigint>").filter("set IS NOT NULL")

    hits = settle(_hits(sketch.filter("set IS NOT NULL").select("doc_id", "set"), marked))
    one_of = sketch.select("set", "doc_id").dropna().groupBy("set").agg(F.min("doc_id").alias("doc_id"))
    placed = settle(_groups(hits, sketch.filter("set IS NOT NULL"), block, like))
    # a text is read and packed once for its set, whatever the number of cells that set is in
    wanted = placed.select("set").distinct().join(one_of, "set")
    fetched = lookup_join(rows, wanted, "doc_id", ["doc_id"], "inner", FETCH_BYTES)
    packed = fetched.select("set", "text").mapInArrow(partial(_packed, like), "set bigint, packed binary")
    met = placed.join(packed, "set").repartition("route", "i", "j").sortWithinPartitions("route", "i", "j")
    found = met.mapInArrow(partial(_linked, like), "a bigint, b bigint")
    linked = connected_components(found).withColumnsRenamed({"node": "set"})
    first = sketch.select("set", "doc_id").dropna().groupBy("set").agg(F.min("doc_id").alias("first")).join(linked, "set", "left")
    classes = first.select("set", "first", F.coalesce("root", "set").alias("class"))
    least = classes.groupBy("class").agg(F.min("first").alias("component_id"))
    # written first, so that Spark can split a set with very many copies in the last join
    of_set = settle(classes.join(least, "class").select("set", "component_id"))
    known = sketch.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.col("set")).alias("set"))
    return known.join(of_set, "set", "left").select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))


def one_of_each(documents: DataFrame, like: Likeness = CONTRACT) -> DataFrame:
    """The row of the least id of each component, with all columns, whatever these are called.

    Rows get numbers of their own first, so null and repeated ids are judged like others: a null id is greater than any other, and
    of rows with the same id one stays.
    """
    keyed = settle(documents.select(F.struct(*documents.columns).alias("doc"), F.monotonically_increasing_id().alias("doc_id")), "zstd")
    found = jaccard_components(keyed.select("doc_id", F.col("doc.text").alias("text")), like=like)
    named = settle(found.join(keyed.select("doc_id", F.col("doc.doc_id").alias("id")), "doc_id").select("doc_id", "component_id", "id"))
    order = F.struct(F.col("id").isNull().alias("none"), "id", "doc_id")
    best = named.groupBy("component_id").agg(F.min(order).alias("best"), F.count("*").alias("n")).filter("n > 1")
    best = best.select("component_id", F.col("best.doc_id").alias("best"))
    gone = lookup_join(named, best, "component_id", ["doc_id"], "inner").filter("doc_id <> best").select("doc_id", F.lit(True).alias("gone"))
    return lookup_join(keyed, gone, "doc_id", ["doc_id"]).filter("gone IS NULL").select("doc.*")


ORACLE = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^ \t\n\x0B\f\r]+') AS w FROM documents),
g AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')] ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i : i + 2], ' '))) END AS g FROM w),
n AS (SELECT doc_id, CAST(len(g) AS BIGINT) AS n FROM g),
e AS (SELECT doc_id, md5_number(unnest(g)) AS t FROM g),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i FROM e a JOIN e b ON a.t = b.t AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS MATERIALIZED (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * i >= 90 * (x.n + y.n - i)),
u AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT doc_id AS a, doc_id AS b FROM n UNION SELECT r.a, u.b FROM r JOIN u ON r.b = u.a)
SELECT a AS doc_id, any_value(n) AS n_shingles, min(b) AS component_id FROM r JOIN n ON a = doc_id GROUP BY a
"""
