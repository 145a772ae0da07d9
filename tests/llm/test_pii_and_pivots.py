import hashlib
import random
import re

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tagloom.llm import pii, pivot_search
from tests.llm.rows import by_id, documents


def base_spans(text):
    text, out = text or "", []
    digits = lambda s: re.sub("[^0-9]", "", s)
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append((m.start(), 0, m.end(), "email"))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            out.append((m.start(), 1, m.end(), "ip"))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = digits(m[0])
        total = sum(int(c) if k % 2 == 0 else sum(divmod(2 * int(c), 10)) for k, c in enumerate(reversed(d)))
        if 12 <= len(d) <= 19 and total % 10 == 0:
            out.append((m.start(), 2, m.end(), "card"))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= len(digits(m[0])) <= 15:
            out.append((m.start(), 3, m.end(), "phone"))
    return [(a, b, k) for a, _, b, k in sorted(out)]


CASES = [
    "mail a.b@c.de, x@y, @z.org a@b.c@d.e ü@ä.de 1@2.3.4.5", "1.2.3.4.5.6.7.8 256.1.1.1 1.1.1.1. 0001.2.3.4",
    "4111 1111 1111 1111 4111-1111-1111-1111 41111111111111112 4111  1111 5500005555555559", "+49 (30) 123-456 78 ++1 +1 22 +123456789012345678 +1.2.3.4.5.6.7.8.9",
    "see https://a.b/c?d=e). www.x.org, ftp://", "IBAN DE89 3704 0044 0532 0130 00 account no: 12345678 x", "", None, "é" * 10 + "a@b.cc" + "1" * 300, "٣٤ 12٣.1.1.1",
]


def test_spans_equal_patterns(spark):
    found = by_id(pii.digest(documents(spark, CASES)))
    for k, text in enumerate(CASES):
        want = base_spans(text)
        r = found[k]
        joined = ",".join(f"{kind}:{a}:{b}" for a, b, kind in want)
        assert r["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest(), text
        assert [r["n_email"], r["n_ip"], r["n_card"], r["n_phone"]] == [sum(x[2] == kind for x in want) for kind in pii.BASE]
        assert set(joined.split(",")) - {""} <= set(r["spans"].split(","))
    assert "url:4:21" in found[4]["spans"] and "url:24:33" in found[4]["spans"] and "account:5:32" in found[5]["spans"]
    assert pii.digest(documents(spark, CASES).limit(0)).count() == 0


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="01259.@+-() aZ_%é\n", max_size=60))
def test_base_spans_of_any_text(text):
    assert [s for s in pii.find(text) if s[2] in pii.BASE] == base_spans(text)


def brute_top(rows, k, every):
    good = [(i, [int(np.floor(64 * float(x))) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    asked = {}
    for i, v in good:
        if i % every == 0:
            asked[i] = min(asked.get(i, v), v)
    out = []
    for i, q in asked.items():
        scored = sorted((-sum(a * b for a, b in zip(q, v, strict=False)), j) for j, v in good if j != i)[:k]
        out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(scored)]
    return sorted(out)


def vectors(spark):
    r = random.Random(4)
    rows = [(k, [r.gauss(0, 1) for _ in range(8)], 0, "x") for k in range(300)]
    rows += [(300 + k, [0.5] * 8, 0, "x") for k in range(60)] + [(400, None, 0, "x"), (401, [1.0, None], 0, "x"), (402, [float("nan")] * 8, 0, "x")]
    rows += [(403, [float("inf")] * 8, 0, "x"), (404, [], 0, "x"), (None, [9.0] * 8, 0, "x"), (7, [0.1] * 8, 0, "x"), (20, [0.3] * 8, 0, "x"), (405, [1.0] * 3, 0, "x")]
    return rows, spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, score string").repartition(3)


def test_top_k_equals_brute_force(spark, monkeypatch):
    rows, df = vectors(spark)
    want = brute_top([(i, None if v is None else [None if x is None else np.float32(x) for x in v]) for i, v, *_ in rows], 20, 20)
    assert sorted(map(tuple, pivot_search.digest(df).collect())) == want
    monkeypatch.setattr(pivot_search, "QUERY_BLOCK", 5)
    monkeypatch.setattr(pivot_search, "CANDIDATE_BLOCK", 17)
    assert sorted(map(tuple, pivot_search.digest(df).collect())) == want


def test_top_k_small_tables(spark):
    _, df = vectors(spark)
    assert pivot_search.digest(df.limit(0)).count() == 0
    few = df.filter("vec_id IN (20, 21, 22)").dropDuplicates(["vec_id"])
    assert len(pivot_search.top_k(few, F.col("vec_id") == 20).collect()) == 2


def test_bounds_eliminate_and_keep_the_best():
    r = np.random.default_rng(0)
    x = np.floor(64 * r.normal(size=(4000, 4)))
    pivots = pivot_search.spread_pivots(x[:500], 16)
    far = pivot_search._distances(x, pivots).astype(np.float32)
    ids = np.arange(4000)
    q, c, s = pivot_search._cut(*pivot_search.best_of(x[:50], far[:50], ids[:50], x, far, ids, 20), 20)
    for k in range(50):
        scores = np.where(ids == k, -np.inf, x @ x[k])
        order = np.lexsort((ids, -scores))[:20]
        assert c[q == k].tolist() == order.tolist() and s[q == k].tolist() == scores[order].astype(int).tolist()
