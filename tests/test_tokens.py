import random

import regex
from pyspark.sql import functions as F

from tagloom.functions import scale
from tagloom.functions import text as tx
from tagloom.functions.arrays import running_total
from tagloom.operators import tokens as tk
from tagloom.plans import views


# what a whole word looks like under each answer, as classes of its characters
U, SMALL, T = r"\p{Uppercase}", r"\p{Lowercase}", r"\p{Lt}"
UNCASED = rf"[^{U}{SMALL}{T}]"
CASINGS = {
    "ALLCAPS": rf"[^{SMALL}{T}]*[{U}][^{SMALL}{T}]*",
    "TITLE": rf"{UNCASED}*[{U}{T}][{SMALL}]*(?:{UNCASED}+[{U}{T}][{SMALL}]*)*{UNCASED}*",
    "LOWER": rf"[^{U}{T}]*[{SMALL}][^{U}{T}]*",
    "MIXED": rf".*[{U}].*",
    "NOCASE": r".*",
}
SHAPES = {"d": regex.compile(r"[\p{Nd}\p{Numeric_Type=Digit}]"), "X": regex.compile(r"(?V1)[\p{L}&&\p{Uppercase}]"), "x": regex.compile(r"(?V1)[\p{L}--\p{Uppercase}]")}


def random_words(n):
    rnd = random.Random(7)
    pools = ["abcXYZ019-()", "éÉßǅªμΣςاあ²½٣Ⅷ①", "aB́ÖöЖж 'x"]
    return ["".join(rnd.choice(rnd.choice(pools)) for _ in range(rnd.randint(1, 9))) for _ in range(n)]


def test_casing_and_shape_by_character_classes(spark):
    words = random_words(3000) + ["A", "Aspirin", "a1", "iPhone", "12", "Ab-12", "ǅǅ", "HELLO", "McDonald", "O'Neil"]
    df = spark.createDataFrame([(w,) for w in words], "w string")
    for r in df.select("w", tx.casing(F.col("w")).alias("c"), tx.word_shape(F.col("w")).alias("s"), tx.has_digit(F.col("w")).alias("d")).collect():
        assert r["c"] == next(name for name, form in CASINGS.items() if regex.fullmatch(form, r["w"], regex.S)), r["w"]
        assert len(r["s"]) == len(r["w"])
        for before, after in zip(r["w"], r["s"], strict=True):
            kinds = [k for k, chars in SHAPES.items() if chars.fullmatch(before)]
            assert after == (kinds[0] if kinds else before), r["w"]
        assert r["d"] == any(c.isdigit() for c in r["w"]), r["w"]


def test_affixes_and_bigrams(spark):
    df = spark.createDataFrame([("x",), ("Aspirin",), ("abc",)], "w string")
    w = F.col("w")
    rows = df.select(
        F.array_compact(F.array(*[tx.char_ngram(w, 2, k) for k in range(5)])).alias("g"),
        F.array(*[tx.suffix(w, n) for n in (3, 4, 5)]).alias("s"), tx.prefix(w, 4).alias("p"),
    ).collect()
    assert rows[0]["g"] == ["x"] and rows[1]["g"] == ["as", "sp", "pi", "ir", "ri"]
    assert rows[1]["s"] == ["rin", "irin", "pirin"] and rows[1]["p"] == "aspi"
    assert rows[2]["s"] == ["abc", None, None]


def test_running_total_crosses_blocks(spark):
    values = list(range(1, 201))
    df = spark.createDataFrame([(values,), ([],), ([5],)], "v array<int>")
    got = [r[0] for r in df.select(running_total(F.col("v"), block=7)).collect()]
    want, total = [], 0
    for v in values:
        total += v
        want.append(total)
    assert got == [want, [], [5]]


def test_simple_offsets_point_into_the_text(spark):
    text = "  Ab-12, é 𝒳x\t(foo) end " + "word " * 300
    df = spark.createDataFrame([("s", text)], "sid string, text string")
    toks = tk.align_offsets(df).first()["tokens"]
    assert [t["form"] for t in toks[:4]] == ["Ab", "-", "12", ","]
    assert all(text[t["start"] : t["end"] + 1] == t["form"] for t in toks)
    assert len(toks) == 310


def test_search_restarts_after_a_rewritten_form(spark):
    df = spark.createDataFrame([('a "b" é a', ["a", "``", "b", '"', "a"])], "text string, forms array<string>")
    got = df.select(tk.search_offsets(F.col("text"), F.col("forms"), block=2)).first()[0]
    assert [(t["start"], t["end"]) for t in got] == [(0, 0), (-1, 0), (3, 3), (4, 4), (8, 8)]


def test_treebank_conventions(spark):
    cases = {
        "Don't take 5mg, it's bad.": ["Do", "n't", "take", "5mg", ",", "it", "'s", "bad", "."],
        'He said "no" (twice).': ["He", "said", "``", "no", "''", "(", "twice", ")", "."],
        "I cannot; won't -- e.g. 1,000 units...": ["I", "can", "not", ";", "wo", "n't", "--", "e.g.", "1,000", "units", "..."],
    }
    df = spark.createDataFrame([(t,) for t in cases], "text string")
    for r in df.select("text", tk.token_forms(F.col("text"), "treebank").alias("f"), tk.located_tokens(F.col("text"), "treebank").alias("t")).collect():
        assert r["f"] == cases[r["text"]]
        assert [t["form"] for t in r["t"]] == r["f"]
        found = [t for t in r["t"] if t["start"] >= 0]
        assert all(r["text"][t["start"] : t["end"] + 1] == t["form"] for t in found)
        assert all(t["form"] in ("``", "''") for t in r["t"] if t["start"] < 0)


def test_bio_first_containing_span_wins(spark):
    tokens = [("H1", 0, 1), ("and", 3, 5), ("H2", 7, 8), ("Blockers", 10, 17), ("long", 20, 30)]
    spans = [(0, 1, "g"), (10, 17, "g"), (7, 17, "g"), (20, 25, "d")]
    df = spark.createDataFrame(
        [("s", tokens, spans), ("t", tokens, [])],
        f"sid string, tokens {tk.TOKENS}, spans array<struct<start:int,end:int,type:string>>",
    )
    got = {r["sid"]: r["tags"] for r in tk.bio_tag(df).collect()}
    assert got["s"] == ["B-g", "O", "B-g", "B-g", "O"]
    assert got["t"] == ["O"] * 5


def test_sanitize(spark):
    df = spark.createDataFrame([("a\tb", "O", ["x=\n"]), ("", "O", []), ("c", "", [])], "form string, tag string, features array<string>")
    rows = tk.sanitize(df).collect()
    assert [(r["form"], r["features"]) for r in rows] == [("a\\tb", ["x=\\n"])]


def test_clustered_sentences_regroup_without_another_shuffle(spark, tmp_path):
    docs = [(1, "Aspirin (ASA) 5mg\n\t\n x \U0001d400b\n"), (2, "é¼ - a_b"), (2, "twice"), (None, "no id"), (3, None)]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    plain, dealt = (views.located(spark, str(tmp_path), c).select("sid", "tokens") for c in (False, True))
    assert sorted(map(str, plain.collect())) == sorted(map(str, dealt.collect())) and plain.filter("size(tokens) = 0").count() == 1
    grouped = dealt.select("sid", F.posexplode("tokens")).groupBy("sid").agg(F.collect_list("col"))
    assert "ENSURE_REQUIREMENTS" not in grouped._jdf.queryExecution().executedPlan().toString()


def test_tasks_grow_with_the_text(spark, monkeypatch):
    rows = spark.createDataFrame([(i, "x" * 1000) for i in range(100)], "doc_id long, text string").coalesce(1)
    assert scale.spread(rows).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    monkeypatch.setattr(scale, "TASK_BYTES", 5000)
    assert scale.spread(rows).rdd.getNumPartitions() >= 20 and scale.by_sentence(rows.withColumnRenamed("doc_id", "sid")).rdd.getNumPartitions() >= 20
