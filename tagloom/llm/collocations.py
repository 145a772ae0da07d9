"""Collocations by set-oriented mining: sorted occurrence relations, extended by merge-joining them with themselves.

The occurrence relation of length k lists where frequent phrases of k words stand, by piece and position; it is written in blocks of
about BLOCK_WORDS words, sorted, so that pieces are told apart by a gap between positions.

1. Words are counted for each block and language, then in all; those that reach the least count are semi-joined back.
2. The relation of length k + 1 is the merge-join of that of length k with itself, by piece and adjacent position: a phrase may only
   be frequent where its first and its last k words are. Phrases, named by the numbers of these two, are counted in the block,
   then grouped and counted in all; frequent groups get a number and are semi-joined to the relation before it is extended: up to
   SENT_BYTES by measure they are broadcast; beyond it they meet the blocks' groups in a shuffle, heavy ones salted, and come
   back to a block as a list of what it holds.
3. A frequent phrase carries the counts of all its beginnings and ends, so every cut is scored without another join. A phrase is
   covered if one that is longer by a word occurs as often; then so does any longer one, as counts only fall with length.

A block has at most one row for a phrase, so no phrase is a hot key. Counts, scores and numbers are exact; the words of a block are told
apart by 64 bits and sent on as text. A text longer than a block goes on in the next, which begins where the last one's phrases may not.

A null text is empty; a null language is ``und``. Each row counts, repeated ones and null ids included. Only text and lang are read. An
empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tagloom.functions.scale import fits_broadcast, lookup_join, settle
from tagloom.llm.common import byte_class, flat, lowered, mix, pieces, sum_counts, word_hashes

LONGEST = 5
LEAST = 100
#: A phrase goes when a longer one with it inside has so many hundredths of its count.
COVERED = 100
TOP = 2000
BLOCK_WORDS = 1 << 20
#: Bytes of text whose words are laid out at once.
READ_BYTES = 1 << 20
#: Frequent groups of one length that are broadcast.
SENT_BYTES = 32 << 20
BREAK_BYTES = byte_class((0x0A, 0x0D)) | np.isin(np.arange(256), np.frombuffer(b".,;:!?", np.uint8))
WORD_BYTES = ~(BREAK_BYTES | byte_class((0x20, 0x20), (0x09, 0x09)))


def _pack(numbers: np.ndarray) -> bytes:
    """64-bit numbers, compressed byte by byte."""
    return zstandard.compress(np.ascontiguousarray(numbers.astype(np.int64).view(np.uint8).reshape(-1, 8).T).tobytes(), 1)


def _unpack(packed: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(packed), np.uint8)
    return np.ascontiguousarray(planes.reshape(8, -1).T).reshape(-1).view(np.int64)


#: A block's relation: where its own words end, positions (as gaps) and codes; and by code the groups and their counts. A single word's
#: name is its language, a tab and the word, which has no tab.
RELATION = "block bigint, own bigint, at binary, item binary, n binary"
WORDS = f"{RELATION}, names array<string>"
GROUPS = f"{RELATION}, first binary, last binary"
#: Below so many ids, two are one 64-bit number.
NARROW = 3_000_000_000


def _relation(block: int, own: int, at: np.ndarray, item: np.ndarray, n: np.ndarray) -> dict[str, pa.Array]:
    return {
        "block": pa.array([block], pa.int64()), "own": pa.array([own], pa.int64()),
        "at": pa.array([_pack(np.diff(at, prepend=0))], pa.binary()), "item": pa.array([_pack(item)], pa.binary()), "n": pa.array([_pack(n)], pa.binary()),
    }


def _read(block_words: int, longest: int):
    """Occurrences of single words: blocks with codes of their own, and the text and language of each code."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        known: dict[int, str] = {}
        size = 0

        def done(own: int) -> Iterator[pa.RecordBatch]:
            at, words = (np.concatenate(x) for x in zip(*held, strict=True))
            names, item = np.unique(words, return_inverse=True)
            n = np.bincount(item[:own], minlength=len(names))
            limit = int(at[own - 1]) + 1
            names = pa.array([[known[x] for x in names.tolist()]], pa.list_(pa.string()))
            yield pa.RecordBatch.from_pydict(_relation(block, limit, at, item, n) | {"names": names})

        for batch in pieces(batches, limit=READ_BYTES):
            data, ends = flat(batch.column("text"))
            starts, stops, words, first = word_hashes(data, ends, WORD_BYTES)
            if not len(words):
                continue
            langs, of_lang = np.unique(np.array(batch.column("lang").to_pylist(), object), return_inverse=True)
            words = mix(words + np.repeat(mix(np.array([hash_of(x) for x in langs], np.uint64))[of_lang], np.diff(first)))
            breaks = np.concatenate([[0], np.cumsum(BREAK_BYTES[data])])[starts]
            opens = np.append(False, breaks[1:] != breaks[:-1])
            opens[first[:-1][first[:-1] < first[1:]]] = True
            at = np.arange(len(words)) + np.cumsum(opens)
            raw = lowered(data).tobytes()
            fresh, where = np.unique(words, return_index=True)
            doc = np.searchsorted(first, where, side="right") - 1
            for name, k, d in zip(fresh.tolist(), where.tolist(), doc.tolist(), strict=True):
                if name not in known:
                    known[name] = f"{langs[of_lang[d]]}\t{raw[starts[k] : stops[k]].decode()}"
            done_words = 0
            while done_words < len(words):
                take = min(len(words) - done_words, block_words - size)
                held.append((at[done_words : done_words + take], words[done_words : done_words + take]))
                size, done_words = size + take, done_words + take
                if size == block_words:
                    # what follows may end phrases that begin here
                    beyond = slice(done_words, done_words + longest - 1)
                    held.append((at[beyond], words[beyond]))
                    held = _shifted(held)
                    yield from done(size)
                    block, held, size = block + 1, [], 0
                    left = set(np.unique(words[done_words:]).tolist())
                    known = {name: v for name, v in known.items() if name in left}
        if size:
            held = _shifted(held)
            yield from done(size)

    return run


def hash_of(name: str) -> int:
    """64 bits of a short text."""
    out = 1469598103934665603
    for byte in name.encode():
        out = ((out ^ byte) * 1099511628211) & (2**64 - 1)
    return out


def _shifted(held: list[tuple[np.ndarray, np.ndarray]]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Positions of one block: those of each part begin beyond the last, with a gap unless they go on."""
    out, end = [], 0
    for k, (at, words) in enumerate(held):
        if not len(at):
            continue
        on = k > 0 and len(held[k - 1][0]) and at[0] - held[k - 1][0][-1] == 1 and at[0] > 0
        out.append((at - at[0] + end + (0 if on else 1), words))
        end = int(out[-1][0][-1]) + 1
    return out


def _extended(row: dict, code: np.ndarray, number: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Keep the occurrences of the frequent groups (codes and their numbers), then merge-join them with themselves by adjacent position."""
    at, item = np.cumsum(_unpack(row["at"])), _unpack(row["item"])
    local = np.full(int(max(item.max(), code.max())) + 1, -1, np.int64)
    local[code] = np.arange(len(code))
    item = local[item]
    at, item = at[item >= 0], item[item >= 0]
    here = np.flatnonzero(np.diff(at) == 1)
    if not len(here):
        return
    at, pair = at[here], item[here] * len(code) + item[here + 1]
    pairs, item = np.unique(pair, return_inverse=True)
    n = np.bincount(item[at < row["own"]], minlength=len(pairs))
    groups = {"first": number[pairs // len(code)], "last": number[pairs % len(code)]}
    yield pa.RecordBatch.from_pydict(_relation(row["block"], row["own"], at, item, n) | {c: pa.array([_pack(v)], pa.binary()) for c, v in groups.items()})


def _extended_by_list(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The frequent groups of a block come as a list."""
    for batch in batches:
        for k in range(batch.num_rows):
            kept = batch.column("kept")[k].values
            yield from _extended({c: batch.column(c)[k].as_py() for c in ("block", "own", "at", "item")}, *(kept.field(c).to_numpy() for c in ("code", "id")))


def _extended_by_table(sent):
    """The frequent groups of all blocks are broadcast: names with their numbers, or pairs of ids, sorted, and how many ids there are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups, numbers, width = sent.value
        for batch in batches:
            for k in range(batch.num_rows):
                row = {c: batch.column(c)[k].as_py() for c in batch.schema.names if c != "names"}
                if width:
                    own = _unpack(row["first"]) * width + _unpack(row["last"])
                    near = np.minimum(np.searchsorted(groups, own), len(groups) - 1)
                    code = np.flatnonzero(groups[near] == own)
                    number = numbers[near[code]]
                else:
                    near = pc.fill_null(pc.index_in(batch.column("names")[k].values, value_set=groups), -1).to_numpy()
                    code = np.flatnonzero(near >= 0)
                    number = numbers[near[code]]
                if len(code):
                    yield from _extended(row, code, number)

    return run


def _words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The words of each block as rows."""
    for batch in batches:
        for k in range(batch.num_rows):
            n = _unpack(batch.column("n")[k].as_py())
            block = np.full(len(n), batch.column("block")[k].as_py())
            yield pa.RecordBatch.from_pydict({"block": block, "code": np.arange(len(n)), "name": batch.column("names")[k].values, "n": n})


def _groups(width: int | None):
    """The groups of each block as rows, two ids as one number if there are ``width`` of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                first, last, n = (_unpack(batch.column(c)[k].as_py()) for c in ("first", "last", "n"))
                block = np.full(len(n), batch.column("block")[k].as_py())
                ids = {"pair": first * width + last} if width else {"first": first, "last": last}
                yield pa.RecordBatch.from_pydict({"block": block, "code": np.arange(len(n)), **ids, "n": n})

    return run


def _frequent(groups: DataFrame, keys: list[str], least: int) -> tuple[DataFrame, int]:
    """Groups with the least count in all blocks together, numbered from 0, and how many they are."""
    counts = sum_counts(groups, keys, ["n"]).filter(F.col("n") >= least)
    kept = settle(counts.withColumn("_id", F.monotonically_increasing_id()))
    part = F.shiftright("_id", 33)
    sizes = kept.groupBy(part.alias("_part")).agg(F.count("*").alias("n")).orderBy("_part").collect()
    firsts = np.cumsum([0, *(r["n"] for r in sizes)]).tolist()
    # one row per partition
    table = groups.sparkSession.createDataFrame([(r["_part"], f) for r, f in zip(sizes, firsts[:-1], strict=True)], "_part long, _first long")
    inside = F.col("_id") - F.shiftleft(part, 33)
    return kept.withColumn("_part", part).join(F.broadcast(table), "_part").withColumn("id", F.col("_first") + inside).drop("_part", "_first", "_id"), firsts[-1]


def _by_list(relation: DataFrame, groups: DataFrame, frequent: DataFrame, keys: list[str]) -> DataFrame:
    """Semi-join in a shuffle: each block gets the codes of its frequent groups and their numbers."""
    kept = lookup_join(groups.select("block", "code", *keys), frequent.select(*keys, "id"), keys, ["block", "code"], "inner")
    kept = kept.groupBy("block").agg(F.collect_list(F.struct("code", "id")).alias("kept"))
    return relation.select("block", "own", "at", "item").join(kept, "block").mapInArrow(_extended_by_list, GROUPS)


def _by_table(relation: DataFrame, frequent: DataFrame, key: str, width: int) -> DataFrame:
    """Semi-join by a broadcast of all frequent groups; the relation stays where it is."""
    rows = frequent.select(key, "id").toArrow()
    groups, numbers = rows.column(key).combine_chunks(), rows.column("id").to_numpy()
    if width:
        order = np.argsort(groups.to_numpy())
        groups, numbers = groups.to_numpy()[order], numbers[order]
    sent = relation.sparkSession.sparkContext.broadcast((groups, numbers, width))
    return relation.mapInArrow(_extended_by_table(sent), GROUPS)


def frequent_phrases(
    documents: DataFrame, longest: int = LONGEST, least: int = LEAST, block_words: int = BLOCK_WORDS, sent_bytes: int = SENT_BYTES
) -> tuple[list[DataFrame], DataFrame]:
    """Tables of the frequent phrases of 1, 2, ... words, and the number of words of each language.

    A table has lang, id, n, phrase, last_word, heads and tails (how often its first and last 1, 2, ... words occur), and from two
    words on first and last, the ids of its first and last words but one.
    """
    rows = documents.select(F.coalesce("text", F.lit("")).alias("text"), F.coalesce("lang", F.lit("und")).alias("lang"))
    relation = settle(rows.mapInArrow(_read(block_words, longest), WORDS), "zstd")
    groups, key, width = relation.select("block", "names", "n").mapInArrow(_words, "block bigint, code bigint, name string, n bigint"), ["name"], 0
    word = F.substring_index("name", "\t", -1)
    lang = F.substring(F.col("name"), F.lit(1), F.char_length("name") - F.char_length(word) - 1)
    total = sum_counts(groups.select(lang.alias("lang"), "n"), ["lang"], ["n"])
    frequent, many = _frequent(groups, key, least)
    found = [frequent.select(lang.alias("lang"), "id", "n", word.alias("phrase"), word.alias("last_word"), F.array("n").alias("heads"), F.array("n").alias("tails"))]
    for _ in range(1, longest):
        if not many:
            extended = relation.sparkSession.createDataFrame([], GROUPS)
        elif len(key) == 1 and fits_broadcast(frequent.select(*key, "id"), sent_bytes):
            extended = _by_table(relation, frequent, key[0], width)
        else:
            extended = _by_list(relation, groups, frequent, key)
        relation, width = settle(extended, "zstd"), many if many < NARROW else 0
        key = ["pair"] if width else ["first", "last"]
        groups = relation.select("block", "first", "last", "n").mapInArrow(_groups(width), f"block bigint, code bigint, {' bigint, '.join(key)} bigint, n bigint")
        frequent, many = _frequent(groups, key, least)
        if width:
            frequent = frequent.withColumns({"first": F.expr(f"pair div {width}"), "last": F.col("pair") % width})
        before = found[-1]
        first = before.select(F.col("id").alias("first"), "lang", F.col("phrase").alias("begin"), "heads")
        last = before.select(F.col("id").alias("last"), "last_word", "tails")
        phrases = lookup_join(lookup_join(frequent, first, "first", ["id"], "inner"), last, "last", ["id"], "inner")
        found.append(settle(phrases.select(
            "lang", "id", "n", "first", "last", F.concat_ws(" ", "begin", "last_word").alias("phrase"), "last_word",
            F.concat("heads", F.array("n")).alias("heads"), F.concat("tails", F.array("n")).alias("tails"),
        )))
    return found, total


def _whole(column: str | Column) -> Column:
    return (F.col(column) if isinstance(column, str) else column).cast("decimal(18,0)")


def collocations(
    documents: DataFrame, longest: int = LONGEST, least: int = LEAST, covered: int = COVERED, top: int = TOP, block_words: int = BLOCK_WORDS,
    sent_bytes: int = SENT_BYTES,
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n and score of each language's best phrases of two words or more."""
    found, total = frequent_phrases(documents, longest, least, block_words, sent_bytes)
    scored = None
    for k in range(2, longest + 1):
        own = found[k - 1].select("lang", "id", "phrase", F.col("n").alias("a"), "heads", "tails")
        if k < longest:
            longer = found[k]
            most = longer.select(F.col("first").alias("id"), "n").unionAll(longer.select(F.col("last").alias("id"), "n")).groupBy("id").agg(F.max("n").alias("_longer"))
            own = own.join(most, "id", "left").filter(F.col("_longer").isNull() | (100 * F.col("_longer") < covered * F.col("a"))).drop("_longer")
        cuts = F.array(*[F.struct(F.get("heads", F.lit(j - 1)).alias("l"), F.get("tails", F.lit(k - j - 1)).alias("r"), F.lit(j).alias("cut")) for j in range(1, k)])
        own = own.select("lang", "phrase", "a", cuts.alias("cuts"))
        scored = own if scored is None else scored.unionAll(own)
    each = lookup_join(scored, total.withColumnRenamed("n", "words"), "lang", ["phrase"], "inner")
    product = (_whole("a") * _whole("words") * F.lit(1000).cast("decimal(4,0)")).alias("product")
    each = each.select("lang", "phrase", "a", F.col("words").alias("n"), product, F.explode("cuts").alias("c")).select("*", "c.*").drop("c")
    each = each.withColumn("score", F.expr("product div (cast(l AS decimal(18,0)) * cast(r AS decimal(18,0)))"))
    lowest = each.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "cut", "l", "r")).alias("c"))
    ranked = lowest.select("lang", "phrase", "a", "c.l", "c.r", "n", "c.score")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return ranked.withColumn("rank", F.row_number().over(order).cast("long")).filter(F.col("rank") <= top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def digest(documents: DataFrame) -> DataFrame:
    return collocations(documents)


ORACLE = r"""
WITH d AS (SELECT row_number() OVER () AS d, coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
p AS (SELECT d, lang, regexp_extract_all(unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')), '[^ \t]+') AS w FROM d),
g AS (SELECT lang, k, list_slice(w, i, i + k - 1) AS g FROM p, range(1, 6) ks(k), range(1, len(w) - k + 2) ns(i)),
f AS MATERIALIZED (SELECT lang, k, array_to_string(g, ' ') AS phrase, any_value(g) AS g, count(*) AS n FROM g GROUP BY 1, 2, 3 HAVING count(*) >= 100),
t AS (SELECT lang, sum(len(w)) AS n FROM p GROUP BY lang),
c AS (SELECT DISTINCT lang, phrase, unnest([array_to_string(g[1 : k - 1], ' '), array_to_string(g[2 : k], ' ')]) AS inside, n FROM f WHERE k > 2),
b AS (SELECT lang, inside, max(n) AS n FROM c GROUP BY 1, 2),
x AS (SELECT f.*, unnest(range(1, k)) AS cut FROM f LEFT JOIN b ON b.lang = f.lang AND b.inside = f.phrase WHERE k > 1 AND (b.n IS NULL OR 100 * b.n < 100 * f.n)),
s AS (SELECT x.lang, x.phrase, x.n AS a, l.n AS l, r.n AS r, t.n AS n, cut, (1000 * x.n::HUGEINT * t.n::HUGEINT) // (l.n::HUGEINT * r.n::HUGEINT) AS score
  FROM x JOIN t USING (lang) JOIN f l ON l.lang = x.lang AND l.phrase = array_to_string(x.g[1 : cut], ' ') JOIN f r ON r.lang = x.lang AND r.phrase = array_to_string(x.g[cut + 1 : x.k], ' ')),
m AS (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) AS o FROM s)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score
FROM m WHERE o = 1 QUALIFY rank <= 2000
"""
