import hashlib
import random
import re
import zlib
from fractions import Fraction

import pytest

from tagloom.llm import periodic
from tests.llm.rows import by_id, documents


def runs_by_hand(words):
    """Every run by plain comparison of the words q apart, for every q."""
    n, runs = len(words), []
    for q in range(1, n // 4 + 1):
        k = 0
        while k < n - q:
            if words[k] != words[k + q]:
                k += 1
                continue
            start = k
            while k < n - q and words[k] == words[k + q]:
                k += 1
            length = k - start + q
            own = words[start : start + length]
            if length >= max(6, 4 * q) and not any(own[p:] == own[:-p] for p in range(1, q)):
                runs.append((start, length, q))
    return sorted(runs, key=lambda r: (r[0], r[2]))


def planted(doc_id, words):
    h = zlib.crc32(("" if doc_id is None else str(doc_id)).encode())
    g, n = h // 10, len(words)
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def answer(words):
    runs = runs_by_hand(words)
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    drop = {i for s, n, q in runs for i in range(s + q, s + n)}
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    head = (best[0], best[1], best[2], 1000 * best[1] // best[2]) if best else (None,) * 4
    listed = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    return (len(runs), *head, sha(listed), sha(" ".join(w for i, w in enumerate(words) if i not in drop)))


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def mixed(rng, most):
    words = []
    while len(words) < most:
        if rng.random() < 0.5:
            words += rng.choices("abcdÄ", k=rng.randint(1, 20))
        else:
            root = rng.choices("ab", k=rng.randint(1, 15))
            words += (root * rng.randint(2, 9))[: rng.randint(4, 120)]
    return words


def odd_texts():
    rng = random.Random(3)
    texts = [None, "", " \n\t", "a", "a a a a a", "a a a a a a", "A a A a A a A a", "a b a b a b a b", "a b a b a b a", "x\ny z\n" * 4, "ä\x0bÄ\x1c " * 9]
    texts += [" ".join(mixed(rng, rng.randint(0, 150))) for _ in range(150)]
    texts += ["same " * 700, " ".join([str(k) for k in range(300)] * 5), " ".join(mixed(rng, 2500))]
    return texts


def test_runs_equal_plain_search(spark):
    texts = odd_texts()
    found = by_id(periodic.digest(documents(spark, texts)))
    assert [tuple(found[k])[1:] for k in range(len(texts))] == [answer(planted(k, words_of(t))) for k, t in enumerate(texts)]


@pytest.mark.parametrize("tile", [8, 64])
def test_stitched_tiles_equal_plain_search(spark, tile):
    texts = odd_texts()
    found = by_id(periodic.summary(documents(spark, texts), tile=tile, spread=200))
    assert [tuple(found[k])[1:] for k in range(len(texts))] == [answer(words_of(t)) for t in texts]


def test_a_very_long_text(spark):
    rng = random.Random(5)
    own = [f"w{rng.randint(0, 10**9)}" for _ in range(40_000)]
    root = [f"r{k}" for k in range(9_000)]
    words = own[:20_000] + root * 4 + root[:7] + own[20_000:] + ["z"] * 30_000
    found = periodic.find_runs(spark.createDataFrame([(1, " ".join(words))], "doc_id long, text string"), spread=1000)
    assert sorted((r["start"], r["end"], r["period"]) for r in found.collect()) == [(20_000, 56_007, 9_000), (76_007, 106_007, 1)]


def test_null_and_repeated_ids(spark):
    rows = [(None, "a " * 8), (None, "b c " * 9), (None, "a " * 8), (4, "d " * 7), (4, "e"), (4, "d " * 7)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = sorted(((i, *answer(planted(i, words_of(t)))) for i, t in rows), key=str)
    assert sorted((tuple(r) for r in periodic.digest(df).collect()), key=str) == want
    assert periodic.digest(df.limit(0)).count() == 0
    named = spark.createDataFrame([("x", "a " * 8)], "doc_id string, text string")
    assert periodic.summary(named).first()["length"] == 8
