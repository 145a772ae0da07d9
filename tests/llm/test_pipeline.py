import hashlib

import corpus_pipeline
from tests.llm.rows import documents
from tests.llm.test_decontaminate import brute as contaminated
from tests.llm.test_lines_and_mixing import lines_by_hand
from tests.llm.test_prefix_tree import brute as components
from tests.llm.test_scores import sentences


def test_stages(spark, tmp_path):
    texts = sentences("p", 40, "abcdefgh") + sentences("q", 40, "uvwxyz")
    langs = ["aa"] * 40 + ["bb"] * 40
    bench = sentences("r", 3, "abcdefgh")
    texts += [None, "", "1 2 3", *[f"{t}\ncommon" for t in texts[:12]], f"{bench[0]} {bench[1]}", texts[5], texts[50]]
    langs += [None] * 3 + ["aa"] * 12 + ["aa", "aa", "bb"]
    docs = documents(spark, texts, langs=langs).select("doc_id", "text", "lang", "source", "n_chars")
    docs.coalesce(2).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(k, t) for k, t in enumerate(bench)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    at = docs
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = {r["doc_id"]: r["text"] for r in at.collect()}
        ids = sorted(before)
        made = stage(spark, at, str(tmp_path))
        if k < 4:
            assert made.columns == docs.columns
        made.write.parquet(f"{tmp_path}/{k}")
        at = spark.read.parquet(f"{tmp_path}/{k}")
        rows = at.collect()
        if name == "language_id":
            assert set(before) - {r["doc_id"] for r in rows} == {80, 81, 82}
        elif name == "line_dedup":
            want = dict(zip(ids, lines_by_hand([before[i] for i in ids]), strict=True))
            got = {r["doc_id"]: hashlib.sha256(r["text"].encode()).hexdigest() for r in rows}
            assert len(rows) == len(ids) and got == {i: w[2] for i, w in want.items()}
            assert any(want[i][1] for i in ids) and all(r["n_chars"] == len(r["text"]) for r in rows)
        elif name == "ngram_jaccard_join":
            root = [ids[c] for _, c in components([before[i] for i in ids])]
            assert {r["doc_id"] for r in rows} == {i for i, c in zip(ids, root, strict=True) if i == c}
        elif name == "benchmark_decontamination":
            bad = {i for i, b in zip(ids, contaminated([before[i] for i in ids], list(enumerate(bench))), strict=True) if b[4]}
            assert bad and {r["doc_id"] for r in rows} == set(ids) - bad
        else:
            assert {r["doc_id"] for r in rows} <= set(ids) and rows
    assert sorted(map(tuple, corpus_pipeline.run(spark, str(tmp_path)).collect())) == sorted(map(tuple, rows))


def test_near_documents_share_five_word_shingles(spark, tmp_path):
    words = [f"w{k}" for k in range(200)]
    near = [f"x{k}" if k in (20, 70, 120, 170) else w for k, w in enumerate(words)]
    far = [f"y{k}" if k in (15, 55, 95, 135, 175) else w for k, w in enumerate(words)]
    docs = documents(spark, [" ".join(t) for t in (words, near, far)])
    kept = {r["doc_id"] for r in corpus_pipeline.distinct_documents(spark, docs, str(tmp_path)).collect()}
    assert kept == {0, 2}  # 176 of 216 shingles, and 171 of 221


def test_stages_judge_every_row_by_itself(spark, tmp_path):
    """Null and repeated ids, and columns that are called like the operators' own."""
    own = sentences("p", 30, "abcdefgh")
    bench = sentences("r", 2, "abcdefgh")
    texts = [*own, own[0], own[1], own[2], f"{bench[0]} {bench[1]}", f"{bench[0]} {bench[1]} {own[7]}", f"{own[3]}\ncommon", *[f"{t}\nCommon" for t in own[10:20]], "1 2", None]
    ids = [*range(30), 0, None, None, None, 5, None, *range(60, 70), None, 5]
    odd = ["score", "lang_pred", "dropped", "_id", "_hash", "id", "doc", "n_lines", "n_dropped", "set", "marks", "gone", "best", "spans", "items", "held_out"]
    rows = [(i, t, "aa", "s", len(t or ""), *[f"{c}{k}" for c in odd]) for k, (i, t) in enumerate(zip(ids, texts, strict=True))]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in odd)).repartition(3)
    spark.createDataFrame([("1", bench[0]), ("2", bench[1])], "item_id string, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    want = list(range(len(texts) - 2))
    lines = lines_by_hand([texts[k] for k in want])
    kept = [sum(n for n, *_ in lines), {lines[k][2] for k in want}]
    at = docs
    for name, stage in corpus_pipeline.STAGES[:4]:
        stage(spark, at, str(tmp_path)).write.parquet(f"{tmp_path}/{name}")
        at = spark.read.parquet(f"{tmp_path}/{name}")
        assert at.columns == docs.columns
        found = at.collect()
        number = [int(r["score"].removeprefix("score")) for r in found]
        assert all(r[c] == f"{c}{k}" for r, k in zip(found, number, strict=True) for c in odd) and all(r["doc_id"] == ids[k] for r, k in zip(found, number, strict=True))
        if name == "language_id":
            assert sorted(number) == want
        elif name == "line_dedup":
            assert sorted(number) == want and {hashlib.sha256(r["text"].encode()).hexdigest() for r in found} == kept[1]
            before = {k: r["text"] for k, r in zip(number, found, strict=True)}
        elif name == "ngram_jaccard_join":
            order = sorted(before, key=lambda k: (ids[k] is None, ids[k] or 0))
            group = components([before[k] for k in order])
            roots = {c for _, c in group}
            assert len(number) == len(roots) and {order.index(k) for k in number if ids[k] is not None and ids.count(ids[k]) == 1} <= roots
            left = {k: before[k] for k in number}
        else:
            bad = {k for k, b in zip(left, contaminated(list(left.values()), list(enumerate(bench))), strict=True) if b[4]}
            assert bad and any(ids[k] is None for k in bad) and set(number) == set(left) - bad
