import hashlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tagloom.llm import line_dedup, mixing
from tests.llm.rows import by_id, documents


def lines_by_hand(texts):
    blank = " \t\n\x0b\x0c\r"
    key = lambda line: "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(blank))
    split = [(t or "").split("\n") for t in texts]
    seen = Counter(k for lines in split for k in {key(x) for x in lines} if k)
    out = []
    for lines in split:
        kept = [x for x in lines if seen[key(x)] < 10]
        out.append((len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return out


def test_lines(spark):
    texts = [f"own {k}\n  COMMON line\t\nÀ\n\nend {k}" for k in range(10)] + [f"Äb{k}\nnine" for k in range(9)]
    texts += [None, "", "\n", "common LINE", "common line\ncommon line", "à", "À\x0b", "x ", "long " * 50_000]
    texts += ["\n".join(f"common line\n{k}" for k in range(3000))]
    found = by_id(line_dedup.digest(documents(spark, texts)))
    assert [tuple(found[k])[1:] for k in range(len(texts))] == lines_by_hand(texts)


def test_lines_keep_other_columns_and_odd_ids(spark):
    df = documents(spark, ["a\nb"] * 10 + ["b\nc"])
    kept = line_dedup.deduplicate(df)
    assert set(df.columns) <= set(kept.columns)
    assert by_id(kept)[10]["text"] == "c" and by_id(kept)[10]["label"] == "w"
    rows = [(None, "same\nother")] * 10 + [(5, "same"), (5, "same\nx")]
    found = line_dedup.digest(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert Counter((r["doc_id"], r["n_lines"], r["n_dropped"]) for r in found) == {(None, 2, 2): 10, (5, 1, 1): 1, (5, 2, 1): 1}
    assert line_dedup.digest(df.limit(0)).count() == 0


def test_lines_run_no_python(spark):
    plan = line_dedup.digest(documents(spark, ["a"]))._jdf.queryExecution().executedPlan().toString()
    assert not any(w in plan for w in ("Python", "Pandas", "Arrow"))


def test_mixture_meets_budget_and_limits(spark):
    texts = ["w " * 50] * 300 + ["v " * 30] * 40 + ["u"] * 10 + [None, "", "  "]
    sources = ["big"] * 300 + ["mid"] * 40 + [None] * 10 + ["big", "none", "none"]
    df = documents(spark, texts, sources=sources)
    total = 300 * 50 + 40 * 30 + 10
    rows = mixing.mix_sources(df, entropy=None, repeats=3.0).collect()
    drawn = Counter()
    for r in rows:
        drawn[r["source"]] += r["n_tokens"]
    assert set(drawn) == {"big", "mid", ""}
    assert drawn[""] <= 3.01 * 10 + 1 and drawn["mid"] > 1200 and abs(sum(drawn.values()) - total) < 120
    for source in drawn:
        for epoch in {r["epoch"] for r in rows if r["source"] == source}:
            mine = sorted((r["start"], r["n_tokens"], r["doc_id"]) for r in rows if (r["source"], r["epoch"]) == (source, epoch))
            at = 0
            for start, n, _ in mine:
                assert start == at
                at += n
            assert len({d for *_, d in mine}) == len(mine)
    assert {(r["doc_id"], r["epoch"]) for r in rows if r["epoch"] == 0 and r["source"] == "mid"} == {(k, 0) for k in range(300, 340)}


def test_exponent(spark):
    totals = spark.createDataFrame([("a", 900), ("b", 90), ("c", 10)], "source string, n long")
    assert mixing.solve_exponent(totals, 1000, None, None) == 0.0
    import math

    p = [0.9, 0.09, 0.01]

    def level(a):
        x = [q**a for q in p]
        return -sum(v / sum(x) * math.log(v / sum(x)) for v in x) / math.log(3)

    a = mixing.solve_exponent(totals, 1000, 0.8, None)
    assert level(a) == pytest.approx(0.8, abs=1e-6)
    a = mixing.solve_exponent(totals, 1000, None, 5.0)
    assert 1000 * (0.01**a / sum(q**a for q in p)) / 10 == pytest.approx(5.0, abs=1e-5)
    assert mixing.solve_exponent(totals, 9000, None, 5.0) == 1.0
    assert mixing.solve_exponent(totals.limit(0), 1000, 0.9, 4.0) == 1.0
    assert mixing.mix_sources(documents(spark, ["a"]).limit(0)).count() == 0


def test_blocks_do_not_change_the_order(spark, monkeypatch):
    df = documents(spark, [f"{'w ' * (k % 7 + 1)}" for k in range(200)], sources=["s"] * 200)
    whole = {tuple(r) for r in mixing.mix_sources(df, budget=1500).collect()}
    monkeypatch.setattr(mixing, "BLOCK_ROWS", 9)
    assert {tuple(r) for r in mixing.mix_sources(df, budget=1500).collect()} == whole
    assert len(whole) > 200 and df.filter(F.col("source") == "s").count() == 200
