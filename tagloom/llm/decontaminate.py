"""Benchmark decontamination with suffix arrays over the training documents.

Each task lays out its documents in shards and numbers their words by hash. A suffix array holds the word positions at which a
benchmark window could begin at all (its leading words occur together in the benchmark). The benchmark suffixes whose leading
words the shard has are binary-searched in it; a range found holds all verbatim occurrences of the suffix's window. Occurrences
of neighbouring suffixes at neighbouring positions are one match, so each run of them is a verbatim match that cannot be
extended, with its place in the document and in the item. The words that matches cover are the words hit, and of each item a
document keeps its longest match. A document is never cut, so all its matches are found in one task and nothing is shuffled.

What tasks get of the benchmark are word hashes, at most about 16 bytes for each byte of a block, and blocks are bounded.

Null or wordless texts have no hits. Items with no words take no part. One with a null id hits words and counts as an item, but
has no name to list; rows with one item id count as one item. Repeated documents and those with a null id are judged one by one.
Only the named columns are read, so further columns cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.llm.common import byte_class, flat, pieces, word_hashes

WINDOW = 13
#: Benchmark text of one pass; a larger benchmark takes several passes over the documents.
BLOCK_BYTES = 8 << 20
#: Letters and digits of ASCII, and everything beyond ASCII.
WORD_BYTES = byte_class((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF))
LEAD = 3
#: Occurrences that are joined into matches at a time; those of one item stay together.
PAIRS = 1 << 21


class Suffixes:
    """The benchmark suffixes of one block of items that begin with a whole window, with their leading word groups."""

    def __init__(self, items: list[tuple[str | None, str]], window: int):
        texts = pa.array([t for _, t in items], pa.string())
        _, _, self.words, self.first = word_hashes(*flat(texts), WORD_BYTES)
        self.ids, self.sizes = [i for i, _ in items], np.minimum(window, np.diff(self.first))
        number = np.where(self.sizes > 0, np.diff(self.first) - self.sizes + 1, 0)
        self.at = np.arange(number.sum()) + np.repeat(self.first[:-1] - (np.cumsum(number) - number), number)
        self.lead = min([LEAD, *self.sizes[self.sizes > 0].tolist()])
        self.group = _lead([self.words[self.at + i] for i in range(self.lead)])
        self.leads = np.unique(self.group)
        self.sieve = np.zeros(1 << 20, bool)
        self.sieve[self.leads >> np.uint64(44)] = True

    def item(self, at: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.first, at, side="right") - 1


def _lead(columns) -> np.ndarray:
    out = np.zeros_like(columns[0])
    for c in columns:
        out = (out ^ c) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    return out


def _among(sorted_: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Which of the wanted values stand in a sorted array that is not empty."""
    return sorted_[np.minimum(np.searchsorted(sorted_, wanted), len(sorted_) - 1)] == wanted


def suffix_array(words: np.ndarray, stop: np.ndarray, at: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions ``at`` ordered by the ``depth`` words from each on, and those words; 0 stands beyond a text's end."""
    cells = at[:, None] + np.arange(depth)
    keys = np.where(cells < stop[:, None], words[np.minimum(cells, len(words) - 1)], np.uint64(0))
    order = np.lexsort(keys.T[::-1])
    return at[order], keys[order]


def search(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each wanted word sequence the range of suffixes that begin with it."""
    m, bounds = wanted.shape[1], []
    for right in (False, True):
        low, high = np.zeros(len(wanted), np.int64), np.full(len(wanted), len(keys))
        while (open_ := low < high).any():
            mid = np.minimum((low + high) // 2, len(keys) - 1)
            here = keys[mid, :m]
            other = here != wanted
            k = other.argmax(axis=1)
            rows = np.arange(len(wanted))
            below = here[rows, k] < wanted[rows, k]
            if right:
                below |= ~other[rows, k]
            low, high = np.where(open_ & below, mid + 1, low), np.where(open_ & ~below, mid, high)
        bounds.append(low)
    return bounds[0], bounds[1]


class Matches(NamedTuple):
    """Verbatim matches: document and item numbers, first word in each, number of words."""

    doc: np.ndarray
    item: np.ndarray
    start: np.ndarray
    item_start: np.ndarray
    length: np.ndarray


def matches(words: np.ndarray, first: np.ndarray, test: Suffixes) -> Iterator[Matches]:
    """All matches of a window or more between a shard and the benchmark that cannot be extended; those of an item come together."""
    lead = test.lead
    if len(words) < lead or not len(test.leads):
        return
    group = _lead([words[i : len(words) - lead + 1 + i] for i in range(lead)])
    at = np.flatnonzero(test.sieve[group >> np.uint64(44)])
    at = at[_among(test.leads, group[at])]
    if not len(at):
        return
    wanted = test.at[_among(np.unique(group[at]), test.group)]
    size = test.sizes[test.item(wanted)]
    at, keys = suffix_array(words, first[np.searchsorted(first, at, side="right")], at, int(size.max()))
    for n in np.unique(size).tolist():
        suffix = wanted[size == n]
        low, high = search(keys, test.words[suffix[:, None] + np.arange(n)])
        suffix, low, count = (x[high > low] for x in (suffix, low, high - low))
        if not len(suffix):
            continue
        item = test.item(suffix)
        opens = np.flatnonzero(np.diff(item, prepend=-1))
        before = (np.cumsum(count) - count)[opens] // PAIRS
        for rows in np.split(np.arange(len(suffix)), opens[1:][np.diff(before) > 0]):
            yield _joined(at, first, test, suffix[rows], low[rows], count[rows], n)


def _joined(at: np.ndarray, first: np.ndarray, test: Suffixes, suffix: np.ndarray, low: np.ndarray, count: np.ndarray, n: int) -> Matches:
    """Occurrences of windows of n words, as many matches as there are runs of neighbouring ones."""
    inside = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    p, j = at[np.repeat(low, count) + inside], np.repeat(suffix, count)
    doc, item = np.searchsorted(first, p, side="right") - 1, test.item(j)
    order = np.lexsort((p, p - j, item, doc))
    p, j, doc, item = p[order], j[order], doc[order], item[order]
    new = np.ones(len(p), bool)
    new[1:] = (np.diff(p) != 1) | (np.diff(j) != 1) | (np.diff(doc) != 0) | (np.diff(item) != 0)
    opens = np.flatnonzero(new)
    run = np.diff(np.append(opens, len(p)))
    p, j, doc, item = p[opens], j[opens], doc[opens], item[opens]
    return Matches(doc, item, p - first[doc], j - test.first[item], run + n - 1)


def _longest(found: Matches) -> Matches:
    """Of each item in each document the longest match; of equally long ones the first in the document, then in the item."""
    order = np.lexsort((found.item_start, found.start, -found.length, found.item, found.doc))
    doc, item = found.doc[order], found.item[order]
    new = np.ones(len(order), bool)
    new[1:] = (np.diff(doc) != 0) | (np.diff(item) != 0)
    return Matches(*[x[order[new]] for x in found])


def _merged(doc: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Spans that overlap or touch become one; ordered by document and place."""
    if not len(doc):
        return doc, start, end
    order = np.lexsort((start, doc))
    doc, start, end = doc[order], start[order], end[order]
    shift = doc * (int(end.max()) + 1)
    reach = np.maximum.accumulate(shift + end)
    new = np.ones(len(doc), bool)
    new[1:] = (np.diff(doc) != 0) | ((shift + start)[1:] > reach[:-1])
    opens = np.flatnonzero(new)
    return doc[opens], start[opens], (reach - shift)[np.append(opens[1:], len(doc)) - 1]


def _lists(doc: np.ndarray, n: int, fields: dict[str, pa.Array]) -> pa.Array:
    """One list of structs for each of n documents, from rows ordered by document."""
    cuts = np.searchsorted(doc, np.arange(n + 1))
    return pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.StructArray.from_arrays(list(fields.values()), list(fields)))


def _marker(test: Suffixes, carried: Sequence[str], more: bool, seen: bool):
    """more: another block follows, so texts are passed on; seen: an earlier block left spans and matches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            _, _, words, first = word_hashes(*flat(batch.column("text")), WORD_BYTES)
            none = [np.zeros(0, np.int64)]
            spans, kept = [none * 3], [none * 5]
            for found in matches(words, first, test):
                spans.append(_merged(found.doc, found.start, found.start + found.length))
                kept.append(_longest(found))
            doc, start, end = _merged(*[np.concatenate(x) for x in zip(*spans, strict=True)])
            best = Matches(*[np.concatenate(x) for x in zip(*kept, strict=True)])
            best = Matches(*[x[np.argsort(best.doc, kind="stable")] for x in best])
            ids = pa.array([test.ids[k] for k in best.item.tolist()], pa.string())
            place = {c: pa.array(getattr(best, c)) for c in ("item_start", "start", "length")}
            new = {
                "spans": _lists(doc, batch.num_rows, {"start": pa.array(start), "end": pa.array(end)}),
                "matches": _lists(best.doc, batch.num_rows, {"item_id": ids, **place}),
            }
            if seen:
                new = {c: pa.array([a + b for a, b in zip(batch.column(c).to_pylist(), x.to_pylist(), strict=True)], x.type) for c, x in new.items()}
            out = {**{c: batch.column(c) for c in carried}, "n_words": pa.array(np.diff(first), pa.int64()), **new}
            if more and "text" not in carried:
                out["text"] = batch.column("text")
            yield pa.RecordBatch.from_pydict(out)

    return run


def _type(table: DataFrame, column: str) -> str:
    return table.select(column).schema.fields[0].dataType.simpleString()


MATCHES = "array<struct<item_id:string,item_start:bigint,start:bigint,length:bigint>>"


def _one_list(spans: Column) -> Column:
    """Spans of several blocks, ordered; those that overlap or touch become one."""

    def add(done: Column, s: Column) -> Column:
        last = F.element_at(done, -1)
        wider = F.struct(last["start"].alias("start"), F.greatest(last["end"], s["end"]).alias("end"))
        joins = (F.size(done) > 0) & (s["start"] <= F.try_element_at(done, F.lit(-1))["end"])
        return F.when(joins, F.concat(F.slice(done, 1, F.size(done) - 1), F.array(wider))).otherwise(F.concat(done, F.array(s)))

    return F.aggregate(F.array_sort(spans), F.array().cast("array<struct<start:bigint,end:bigint>>"), add)


def find_contamination(
    documents: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES, carried: Sequence[str] = ("doc_id",)
) -> DataFrame:
    """One row per document: the carried columns (by default doc_id), n_words, spans (merged word spans hit), matches and items.

    ``matches`` has the longest verbatim match of each benchmark row that occurs: item_id, item_start, start (first words in item and
    document) and length; ``items`` are the sorted ids of these. The benchmark is a query set: it is read in blocks of at most about
    ``block_bytes``, one pass over the documents each.
    """
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), "text").filter("text IS NOT NULL")
    size = items.agg(F.sum(F.octet_length("text") + 16)).first()[0] or 0
    blocks = size // block_bytes + 1
    rows = documents.select(*dict.fromkeys([*carried, "text"]))
    own = ", ".join(f"`{c}` {_type(documents, c)}" for c in carried)
    schema = f"{own}, n_words bigint, spans array<struct<start:bigint,end:bigint>>, matches {MATCHES}"
    for k in range(blocks):
        block = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k) if blocks > 1 else items
        test = Suffixes([(r["item_id"], r["text"]) for r in block.orderBy("item_id", "text").collect()], window)
        more = k + 1 < blocks
        rows = rows.mapInArrow(_marker(test, carried, more, k > 0), schema + ", text string" * (more and "text" not in carried))
    if blocks > 1:
        rows = rows.withColumn("spans", _one_list(F.col("spans")))
    return rows.withColumn("items", F.array_sort(F.array_distinct(F.transform("matches", lambda m: m["item_id"]))))


def longest_matches(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """item_id, length, doc_id, start, item_start: each item's longest verbatim match in all documents; items without one are left out.

    Of equally long matches that of the least document counts, then the first. Only one row an item and task is shuffled.
    """
    found = find_contamination(documents, benchmark, window, block_bytes).select("doc_id", F.explode("matches").alias("m"))
    place = F.struct((-F.col("m.length")).alias("shorter"), F.col("doc_id").isNull().alias("none"), "doc_id", "m.start", "m.item_start")
    best = found.groupBy(F.col("m.item_id").alias("item_id")).agg(F.min(place).alias("best"))
    return best.select("item_id", (-F.col("best.shorter")).alias("length"), "best.doc_id", "best.start", "best.item_start")


def judged(found: DataFrame) -> DataFrame:
    """Add n_hit, n_items, longest (words of the longest match) and contaminated: some word is hit, and at least one word in twenty."""
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["start"])
    return found.withColumn("n_hit", n_hit).withColumns({
        "n_items": F.size("items").cast("long"), "longest": F.coalesce(F.array_max(F.transform("matches", lambda m: m["length"])), F.lit(0)), "contaminated": (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words")),
    })


def remove_contaminated(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows that are not contaminated, with all their columns, whatever these are called; each is judged by its own text."""
    others = [c for c in documents.columns if c != "text"]
    rows = documents.select(F.struct(*others).alias("doc"), "text")
    kept = judged(find_contamination(rows, benchmark, carried=("doc", "text"))).filter("NOT contaminated")
    return kept.select(*[F.col("text") if c == "text" else F.col("doc").getField(c).alias(c) for c in documents.columns])


def digest(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    return judged(find_contamination(documents, benchmark)).select(
        "doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), "contaminated", "longest"
    )


ORACLE = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bw AS (SELECT item_id, b, n, j, array_to_string(w[j : j + n - 1], ' ') AS g FROM (SELECT item_id, row_number() OVER () AS b, w, least(len(w), 13) AS n, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS j FROM b WHERE len(w) > 0)),
lens AS (SELECT DISTINCT n FROM bw),
dp AS (SELECT doc_id, n, w, unnest(range(1, len(w) - n + 2)) AS p FROM d, lens WHERE len(w) >= n),
dw AS (SELECT doc_id, n, p, array_to_string(w[p : p + n - 1], ' ') AS g FROM dp),
pair AS MATERIALIZED (SELECT doc_id, dw.n, p, item_id, b, j FROM dw JOIN bw ON dw.g = bw.g AND dw.n = bw.n),
hit AS (SELECT DISTINCT doc_id, n, p, item_id FROM pair),
run AS (SELECT doc_id, n - 1 + count(*) AS m FROM (SELECT doc_id, n, b, p - j AS o, p - row_number() OVER (PARTITION BY doc_id, b, p - j ORDER BY p) AS k FROM pair) GROUP BY doc_id, n, b, o, k),
longest AS (SELECT doc_id, max(m) AS longest FROM run GROUP BY 1),
words AS (SELECT doc_id, count(DISTINCT q) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + n)) AS q FROM hit) GROUP BY 1),
it AS (SELECT doc_id, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS ids FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS i FROM hit) GROUP BY 1)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated,
  CAST(coalesce(longest, 0) AS BIGINT) AS longest
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN it USING (doc_id) LEFT JOIN longest USING (doc_id)
"""
