import hashlib
import random
import re

from tagloom.llm import decontaminate
from tests.llm.rows import by_id, documents

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORDS.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def extended(w, p, item, least):
    """The most words from p on that stand anywhere in the item, if there are as many as least."""
    best = 0
    for j in range(len(item)):
        n = 0
        while p + n < len(w) and j + n < len(item) and w[p + n] == item[j + n]:
            n += 1
        best = max(best, n)
    return best if best >= least else 0


def brute(texts, items):
    windows = {}
    for i, t in items:
        w = words(t)
        n = min(13, len(w))
        for k in range(len(w) - n + 1 if n else 0):
            windows.setdefault((n, tuple(w[k : k + n])), set()).add(i if i is None else str(i))
    out = []
    for t in texts:
        w, hit, ids, longest = words(t), set(), set(), 0
        for n in {n for n, _ in windows}:
            for p in range(len(w) - n + 1):
                if found := windows.get((n, tuple(w[p : p + n]))):
                    hit |= set(range(p, p + n))
                    ids |= found
                    longest = max(longest, *(extended(w, p, i, n) for i in (words(t) for _, t in items) if n == min(13, len(i))))
        sha = hashlib.sha256(",".join(sorted(ids - {None})).encode()).hexdigest()
        out.append((len(w), len(hit), len(ids), sha, bool(hit) and 20 * len(hit) >= len(w), longest))
    return out


def case(spark):
    r = random.Random(3)
    text = lambda n: " ".join(r.choice(["ab", "Cd", "é1", "x", "über", "no"]) + r.choice([".", "", "-", "\n"]) for _ in range(n))
    items = [(k, text(r.choice([5, 13, 14, 30, 60]))) for k in range(25)] + [(7, "single"), (100, "Two words"), (101, ""), (102, None), (None, "lonely item")]
    texts = [text(r.randint(0, 400)) for _ in range(40)] + [None, "", "...", "single", "TWO, words", "a single b two  words", "lonely item"]
    texts += [text(50) + " " + items[k][1] + " " + text(9) for k in range(20)] + [items[3][1] * 40, text(60_000) + items[2][1]]
    bench = spark.createDataFrame([(i, t, "e") for i, t in items], "item_id long, text string, doc_id string")
    return texts, items, bench


def test_equals_brute_force(spark):
    texts, items, bench = case(spark)
    found = by_id(decontaminate.digest(documents(spark, texts), bench))
    assert [tuple(found[k])[1:] for k in range(len(texts))] == brute(texts, items)


def test_blocks_of_the_benchmark_agree(spark):
    texts, items, bench = case(spark)
    found = by_id(decontaminate.judged(decontaminate.find_contamination(documents(spark, texts), bench, block_bytes=600)))
    assert [(found[k]["n_hit"], found[k]["n_items"]) for k in range(len(texts))] == [b[1:3] for b in brute(texts, items)]


def test_removal_and_empty_tables(spark):
    texts, items, bench = case(spark)
    docs = documents(spark, texts)
    bad = {k for k, b in enumerate(brute(texts, items)) if b[4]}
    kept = decontaminate.remove_contaminated(docs, bench)
    assert {r["doc_id"] for r in kept.collect()} == set(range(len(texts))) - bad and kept.columns == docs.columns
    assert decontaminate.digest(docs.limit(0), bench).count() == 0
    assert decontaminate.digest(docs, bench.limit(0)).filter("n_hit > 0 OR contaminated").count() == 0


def test_matches_say_where(spark):
    texts, items, bench = case(spark)
    by_item = {i if i is None else str(i): words(t) for i, t in items} | {"7b": words(dict(items[:25])[7])}
    for block_bytes in (600, decontaminate.BLOCK_BYTES):
        found = decontaminate.find_contamination(documents(spark, texts), bench, block_bytes=block_bytes).collect()
        seen = 0
        for r in found:
            w = words(texts[r["doc_id"]])
            for m in r["matches"]:
                item = by_item[m["item_id"]] if m["item_id"] != "7" or m["length"] == 1 else by_item["7b"]
                a, b, n = m["start"], m["item_start"], m["length"]
                assert w[a : a + n] == item[b : b + n] and n >= min(13, len(item))
                assert n == max(extended(w, p, item, 0) for p in range(len(w))) if len(w) < 500 else n >= 13 or n == len(item)
                seen += 1
        assert seen > 20


def test_longest_matches_of_the_corpus(spark):
    item = [f"w{k}" for k in range(40)]
    texts = [" ".join(item[5:20]) + " x", "y y " + " ".join(item[3:25]) + " z " + " ".join(item[10:30]), " ".join(item[:12]), None, " ".join(item[3:25])]
    bench = spark.createDataFrame([("a", " ".join(item)), ("b", "never seen"), (None, "y Y"), (None, None)], "item_id string, text string")
    found = {r["item_id"]: tuple(r)[1:] for r in decontaminate.longest_matches(documents(spark, texts), bench).collect()}
    assert found == {"a": (22, 1, 2, 3), None: (2, 1, 0, 0)}
    digest = by_id(decontaminate.digest(documents(spark, texts), bench))
    assert [tuple(digest[1])[k] for k in (1, 2, 3, 6)] == [45, 44, 2, 22]


def test_repetitive_texts(spark):
    texts, items = ["a " * 3000, "a b " * 500, "a " * 20 + "b"], [(1, "a " * 60), (2, "b a " * 9), (3, "a " * 5 + "b")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = by_id(decontaminate.digest(documents(spark, texts), bench))
    assert [tuple(found[k])[1:] for k in range(3)] == brute(texts, items)
