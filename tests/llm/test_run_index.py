import hashlib
import random

import numpy as np

from tagloom.llm import run_index
from tests.llm.rows import by_id, documents


def brute(texts):
    raw = [(t or "").encode() for t in texts]
    seen = {}
    for b in raw:
        for p in range(len(b) - 199):
            seen[b[p : p + 200]] = seen.get(b[p : p + 200], 0) + 1
    out = []
    for b in raw:
        gone = np.zeros(len(b) + 1, bool)
        for p in range(len(b) - 199):
            if seen[b[p : p + 200]] > 1:
                gone[p : p + 200] = True
        kept = bytes(x for x, g in zip(b, gone, strict=False) if not g)
        out.append((len(b), int(gone.sum()), int((np.diff(np.append(False, gone).astype(int)) == 1).sum()), hashlib.sha256(kept).hexdigest()))
    return out


def corpus():
    r = random.Random(5)
    word = lambda: "".join(r.choice("abcdeé") for _ in range(r.randint(2, 9)))
    text = lambda n: " ".join(word() for _ in range(n))
    passage, exact = text(60), "q" * 199
    texts = [text(r.randint(5, 200)) for _ in range(12)]
    texts += [text(30) + passage + text(20), passage + text(5), text(9) + passage[3:], text(40) + passage[:180]]
    texts += [texts[0], texts[0], None, "", "short", "ab" * 400, " " * 900, exact, exact + "r", exact + "r" + exact]
    texts += [text(80) + "\n" + "line " * 60 + text(30), "x" * 199 + text(50), "x" * 199 + text(51), text(3000) + passage]
    near = text(100)
    return texts + [near[:k] + "é" + near[k:] for k in range(0, 500, 37)]


def test_equals_brute_force(spark):
    texts = corpus()
    found = by_id(run_index.digest(documents(spark, texts)))
    assert [tuple(found[k])[1:] for k in range(len(texts))] == brute(texts)


def test_hot_keys_are_split_without_loss(spark):
    texts = corpus()
    found = by_id(run_index.remove_repeats(documents(spark, texts), hot=1))
    for k, (size, gone, n, sha) in enumerate(brute(texts)):
        r = found[k]
        assert (r["n_bytes"], sum(s["b"] - s["a"] for s in r["spans"]), len(r["spans"])) == (size, gone, n)
        assert hashlib.sha256(bytes(r["kept"])).hexdigest() == sha


def test_repeated_and_null_ids(spark):
    long = "abcdefghij" * 3 + "klmnopqrstuvw" * 20
    rows = [(1, long), (1, long), (1, "other"), (None, long + "!"), (None, None)]
    found = run_index.digest(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r["doc_id"] or 0, r["n_bytes"], r["n_removed"]) for r in found) == sorted(
        [(1, len(long), len(long)), (1, len(long), len(long)), (1, 5, 0), (0, len(long) + 1, len(long)), (0, 0, 0)]
    )


def test_empty_table(spark):
    assert run_index.digest(documents(spark, ["a"]).limit(0)).count() == 0


def test_matching_statistics_of_all_positions():
    r = random.Random(1)
    for _ in range(30):
        text = np.array([r.randint(0, 3) for _ in range(r.randint(1, 120))], np.uint16)
        index = run_index.RunIndex(text)
        raw = text.tolist()
        want = []
        for i in range(len(raw)):
            best = 0
            for j in range(len(raw)):
                k = 0
                while i != j and i + k < len(raw) and j + k < len(raw) and raw[i + k] == raw[j + k]:
                    k += 1
                best = max(best, k)
            want.append(best)
        assert index.matching_statistics().tolist() == want
        assert index.lengths.sum() == len(raw)
