import random

import numpy as np
import pyarrow as pa
import pytest

from tagloom.llm import prefix_tree
from tests.llm.rows import by_id, documents


def shingles(text):
    w = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").translate({c: " " for c in range(9, 14)}).split(" ")
    w = [x for x in w if x]
    if not w:
        return set()
    return {tuple(w[k : k + 3]) for k in range(len(w) - 2)} if len(w) > 2 else {tuple(w)}


def brute(texts):
    sets, up = [shingles(t) for t in texts], list(range(len(texts)))

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * both >= 90 * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((top(a), top(b)))
                up[y] = x
    return [(len(s), top(k)) for k, s in enumerate(sets)]


def corpus(seed):
    r = random.Random(seed)
    text = lambda n: [f"w{r.randint(0, 500)}" for _ in range(n)]
    texts = []
    for n in (1, 2, 3, 8, 9, 10, 11, 12, 20, 40, 41, 60, 120, 300, 301):
        base = text(n)
        texts += [" ".join(base), "\t".join(base).upper() + "\n"]
        for _ in range(6):
            other = list(base)
            for _ in range(max(1, round(n * r.choice([0.005, 0.015, 0.03])))):
                k = r.randrange(len(other))
                other[k : k + r.randint(0, 1)] = text(r.randint(0, 1))
            texts.append(" ".join(other))
        texts.append(" ".join([*base, *text(max(1, n // 9))]))
    chain = text(200)
    for k in range(0, 60, 3):
        texts.append(" ".join(chain[k : k + 140]))
    texts += [None, "", "  \n", "one", "ONE", "one two", "one  two", *[" ".join(text(20)) for _ in range(30)]]
    r.shuffle(texts)
    return texts


@pytest.mark.parametrize(("block", "whole"), [(2000, 16), (4, 16), (4, 1)])
def test_equals_brute_force(spark, monkeypatch, block, whole):
    monkeypatch.setattr(prefix_tree, "WHOLE", whole)
    texts = corpus(block + whole)
    found = by_id(prefix_tree.jaccard_components(documents(spark, texts), block=block))
    assert [tuple(found[k])[1:] for k in range(len(texts))] == brute(texts)


def test_repeated_null_and_empty(spark):
    rows = [(4, "a b c d"), (4, "a b c d"), (2, "A b  c d"), (None, "a b c d"), (7, None)]
    found = prefix_tree.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r["doc_id"] or -1, r["component_id"] or -1, r["n_shingles"]) for r in found) == [(-1, -1, 2), (2, 2, 2), (4, 2, 2), (4, 2, 2), (7, 7, 0)]
    assert prefix_tree.jaccard_components(documents(spark, ["a"]).limit(0)).count() == 0


def test_one_of_each_keeps_columns(spark):
    docs = documents(spark, ["x y z w", "x y z w", "other words here", None])
    kept = prefix_tree.one_of_each(docs)
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} == {0, 2, 3}


def test_linked_sets_agree_in_a_part():
    r = np.random.default_rng(2)
    for _ in range(400):
        n = int(r.integers(2, 400))
        a = np.unique(r.integers(0, 2**63, n).astype(np.uint64) * np.uint64(2))
        drop = int(r.integers(0, max(1, n // 18) + 1))
        b = np.unique(np.concatenate([a[drop:], r.integers(0, 2**63, int(r.integers(0, max(1, n // 18) + 1))).astype(np.uint64)]))
        both = len(np.intersect1d(a, b))
        if len(a) and len(b) and 19 * both >= 9 * (len(a) + len(b)) and not np.array_equal(a, b):
            assert set(prefix_tree.signatures(a).tolist()) & set(prefix_tree.signatures(b).tolist())


def test_other_lengths_and_similarities_equal_brute_force(spark):
    for like in (prefix_tree.Likeness(5, 4, 5), prefix_tree.Likeness(1, 1, 2)):
        texts = corpus(31)
        sets = [prefix_tree.shingle_sets(pa.array([t], pa.string()), like.ngram)[0] for t in texts]
        up = list(range(len(texts)))
        for a in range(len(texts)):
            for b in range(a):
                both = len(np.intersect1d(sets[a], sets[b]))
                if len(sets[a]) and len(sets[b]) and both * like.under >= like.over * (len(sets[a]) + len(sets[b]) - both):
                    old, new = max(up[a], up[b]), min(up[a], up[b])
                    up = [new if u == old else u for u in up]
        found = by_id(prefix_tree.jaccard_components(documents(spark, texts), like=like))
        assert [found[k]["component_id"] for k in range(len(texts))] == up
        assert max(np.bincount(up)) > 5


def test_sketches_never_differ_in_more_places_than_sets():
    r = np.random.default_rng(5)
    draw = lambda n: r.integers(0, 2**64, int(n), dtype=np.uint64)
    for _ in range(300):
        both = draw(r.integers(0, 400))
        a, b = np.unique(np.concatenate([both, draw(r.integers(1, 300))])), np.unique(np.concatenate([both, draw(r.integers(1, 300))]))
        one, other = (np.frombuffer(prefix_tree.odd_sketch(s), np.uint64)[None, :] for s in (a, b))
        words = min(one.shape[1], other.shape[1])
        apart = int(np.bitwise_count(prefix_tree.folded(one, words) ^ prefix_tree.folded(other, words)).sum())
        assert apart <= len(np.setxor1d(a, b)) and 64 * one.shape[1] >= len(a)


def test_pieces_by_sketches_hold_links_and_part_passages():
    r = np.random.default_rng(6)
    passage = r.integers(0, 2**64, 60, dtype=np.uint64)
    sets = []
    for n in r.integers(100, 260, 120).tolist():
        base = np.unique(np.concatenate([passage, r.integers(0, 2**64, n, dtype=np.uint64)]))
        sets += [base, base[: len(base) - len(base) // 12]]
    for like in (prefix_tree.Likeness(5, 4, 5), prefix_tree.CONTRACT):
        sizes = np.array([len(s) for s in sets])
        piece = prefix_tree.near_pieces(sizes, [prefix_tree.odd_sketch(s) for s in sets], like)
        assert all(piece[k] == piece[k + 1] for k in range(0, len(sets), 2)) and np.bincount(piece).max() == 2


def test_shared_marks_are_told_by_bounded_bits(spark):
    folds = [5, 77, 1 << 20, (1 << 39) + 3, (1 << 40) - 1]
    shared = spark.createDataFrame([(f,) for f in folds * 40], "fold long").distinct()
    bits = prefix_tree.bits_of(shared)
    marks = np.arange(1 << 12, dtype=np.uint64)
    assert 8 * len(bits) == 128 and prefix_tree.has_bit(bits, np.array(folds, np.uint64) + np.uint64(1 << 50)).all()
    assert prefix_tree.has_bit(bits, marks).mean() == len({f % 128 for f in folds}) / 128
    many = spark.range(40_000).selectExpr("id * 7919 AS fold")
    assert len(prefix_tree.bits_of(many)) << 3 == 1 << 20 and prefix_tree.bits_of(many, 1 << 17) is None
    assert prefix_tree.has_bit(prefix_tree.bits_of(many, 1 << 18), np.arange(40_000, dtype=np.uint64) * np.uint64(7919)).all()
    assert not prefix_tree.bits_of(shared.limit(0)).any()


def test_bits_and_shuffle_find_the_same_hits(spark):
    rows = [(k, k % 9, [k % 4, 100 + k % 9, (1 << 60) + k % 3, 1000 + k]) for k in range(60)]
    marked = spark.createDataFrame(rows, "doc_id long, set long, marks array<long>")

    def kept(bits):
        some = [(d, s, [m for m in ms if bits is None or prefix_tree.has_bit(bits.value, np.array([m], np.uint64))[0]]) for d, s, ms in rows]
        return spark.createDataFrame(some, marked.schema)

    found = [sorted(map(tuple, prefix_tree._hits(marked.select("doc_id", "set"), kept, most).select("set", "mark", "least").collect())) for most in (1 << 28, 1)]
    assert found[0] == found[1] == sorted({(s, m, min(x[1] for x in rows[:9] if m in x[2])) for _, s, ms in rows[:9] for m in ms if sum(m in x[2] for x in rows[:9]) > 1})


def test_hits_know_how_many_sets_their_mark_has(spark):
    """Sets of wide pieces meet without a count and a join of their own, whose rows would come all at once when a piece gets wide."""
    rows = [(k, k, [k % 4, 100 + k % 9, 1000 + k]) for k in range(60)]
    marked = spark.createDataFrame(rows, "doc_id long, set long, marks array<long>")
    hits = prefix_tree._hits(marked.select("doc_id", "set"), lambda bits: marked, 1).select("set", "mark", "least", "m")
    of = {}
    for _, s, ms in rows:
        for m in ms:
            of.setdefault(m, set()).add(s)
    assert sorted(map(tuple, hits.collect())) == sorted((s, m, min(ss), len(ss)) for m, ss in of.items() if len(ss) > 1 for s in ss)
    given = spark.createDataFrame([(s, m, len(of[m])) for _, s, ms in rows for m in ms if len(of[m]) > 1], "set long, mark long, m long")
    met = prefix_tree._by_mark(given, 4)
    assert "Join" not in met._jdf.queryExecution().optimizedPlan().toString()
    assert {(r["route"], r["n"]) for r in met.collect()} == {(m, -(-len(ss) // 4)) for m, ss in of.items() if len(ss) > 1}


def test_marks_of_the_same_sets_are_told_once(spark):
    of = {1: {1, 2, 3}, 2: {1, 2, 3}, 3: {1, 2}, 4: {1, 3}, 5: {1, 3}, 6: {2, 3}, 7: {1, 2, 4}}
    hits = spark.createDataFrame([(s, m, min(ss), len(ss)) for m, ss in of.items() for s in ss], "set long, mark long, least long, m long")
    told = sorted(map(tuple, prefix_tree._told_once(hits).select("mark", "set", "m").collect()))
    assert told == sorted((m, s, len(of[m])) for m in (1, 3, 4, 6, 7) for s in of[m])


def test_rows_that_meet_grow_with_the_hits_when_pieces_get_wide(spark, monkeypatch):
    """Before, only hits of pieces beyond a block met by their marks: none of the smaller table, all of the larger one."""
    like, met, by_mark = prefix_tree.Likeness(5, 4, 5), [], prefix_tree._by_mark

    def counted(hits, block):
        met.append(hits.count())
        return by_mark(hits, block)

    monkeypatch.setattr(prefix_tree, "_by_mark", counted)
    for n in (40, 200):
        passage = " ".join(f"p{k}" for k in range(40))
        texts = [f"{passage} " + " ".join(f"w{i // 2}x{k}" for k in range(20 - i % 2)) for i in range(n)]
        found = by_id(prefix_tree.jaccard_components(documents(spark, texts), 50, like))
        assert [found[k]["component_id"] for k in range(n)] == [k - k % 2 for k in range(n)]
    assert 0 < met[2] <= 1.5 * 5 * met[0]
