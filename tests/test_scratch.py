"""What queries leave in scratch space, and how often a computed array is computed."""

import gzip
import itertools
import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tagloom.functions.arrays import exploded
from tagloom.operators import features as ft
from tagloom.operators import spans as sp
from tagloom.operators import token_arrays
from tagloom.operators import tokens as tk
from tagloom.plans import catalog, views
from tagloom.sources import rows as rw


@pytest.fixture
def tables(spark, tmp_path):
    docs = [(1, "Paracetamolum hilft.\nNicht Paracetamolum allein"), (2, None), (3, ""), (4, "one\n\n two"), (5, "Paracetamolum")]
    spark.createDataFrame([(i, t, "de") for i, t in docs], "doc_id long, text string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([("b", "paracetamolum und mehr")], "item_id string, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    return str(tmp_path)


def test_packed_feature_files_read_back(spark, tables, tmp_path):
    rows = catalog._basic(spark, tables, True)
    for name, packed in (("plain", None), ("packed", "gzip")):
        rw.write_features(rows, str(tmp_path / name), compression=packed)
    a, b = (sorted(map(str, rw.read_features(spark, str(tmp_path / x)).collect())) for x in ("plain", "packed"))
    assert a == b and len(a) == rows.count() == 9
    files = list((tmp_path / "packed").glob("part-*"))
    assert files and all(f.suffix == ".gz" for f in files)
    assert any("formLower=paracetamolum" in gzip.open(f, "rt").read() for f in files)


@pytest.mark.parametrize("name", ["a7_write_features", "a8_read_features"])
def test_feature_queries_pack_their_files(spark, tables, monkeypatch, name):
    asked, write = [], rw.write_features
    monkeypatch.setattr(rw, "write_features", lambda *a, **k: (asked.append(k.get("compression")), write(*a, **k)))
    assert catalog.QUERIES[name](spark, tables).count() and asked == ["gzip"]


@pytest.mark.parametrize("name", ["a11_crf_round_trip", "j2_train_and_score", "g5_decode_crf"])
def test_features_of_all_tokens_are_not_written(spark, tables, monkeypatch, name):
    written, settle = [], catalog.settle
    monkeypatch.setattr(catalog, "settle", lambda df, *a: (written.append(df.columns), settle(df, *a))[1])
    catalog.QUERIES[name](spark, tables).collect()
    assert not any("features" in columns for columns in written)


def test_exploded_keeps_what_explode_keeps_and_computes_once(spark):
    rows = spark.createDataFrame([(1, "a b"), (2, None), (3, ""), (4, "c")], "k int, text string")
    pieces = F.filter(F.split("text", " "), lambda x: x != "")
    assert exploded(rows, ["k"], pieces, "x", "i").collect() == rows.select("k", F.posexplode(pieces).alias("i", "x")).collect()
    with_null = spark.createDataFrame([([None, "a"],)], "v array<string>")
    assert [r.x for r in exploded(with_null, [], F.col("v"), "x").collect()] == [None, "a"]
    plan = exploded(rows.select("k", pieces.alias("p")), ["k"], F.col("p"), "x")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("split(") == 1


def test_tokens_are_found_once(spark, tables):
    plan = views.tokens(spark, tables)._jdf.queryExecution().optimizedPlan().toString()
    assert "size(zip_with(" not in plan


def test_tokens_of_a_batch_are_those_of_the_pattern(spark):
    pools = ["abcXYZ019-()", "éÉßǅªμΣςاあ²½٣Ⅷ①", "aB́ÖöЖж 'x", " \t\x0b\x0c\x85\x1c\xa0  \U0001f600\U00010400\U0001d7ce​﻿"]
    rnd = random.Random(3)
    texts = ["".join(rnd.choice(rnd.choice(pools)) for _ in range(rnd.randint(0, 60))) for _ in range(2000)] + [None, "", " ", None, "a" * 70_000]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string").repartition(3)
    for r in df.select("text", tk.token_forms(F.col("text")).alias("forms"), tk.located_tokens(F.col("text")).alias("tokens")).collect():
        if r.text is None:
            assert r.tokens is None
            continue
        assert [t.form for t in r.tokens] == r.forms == [r.text[t.start : t.end + 1] for t in r.tokens]
        assert all(a.end < b.start for a, b in itertools.pairwise(r.tokens))


def test_pieces_of_a_batch_do_not_change_its_tokens(spark, monkeypatch):
    texts, classes = pa.array(["ab é", None, "", "x-y", " ", "é1 2"]), token_arrays._classes(*token_arrays._class_runs())
    whole = token_arrays.locate(texts, classes)
    monkeypatch.setattr(token_arrays, "PIECE_BYTES", 1)
    assert token_arrays.locate(texts, classes).equals(whole)
    assert token_arrays.locate(texts.slice(2, 3), classes).equals(whole.slice(2, 3))


def test_token_rows_with_lists_of_unlike_length(spark):
    tokens = [("A", 0, 0), ("b", 2, 2), ("C", 4, 4)]
    df = spark.createDataFrame(
        [("s", tokens, ["O"]), ("t", tokens[:1], ["O", "B-x"]), ("u", tokens[:2], None), ("v", None, ["O"]), ("w", [], [])],
        "sid string, tokens array<struct<form:string,start:int,end:int>>, tags array<string>",
    )
    rows = {(r.sid, r.tok_ix): r for r in ft.token_rows(df).collect()}
    assert sorted(rows) == [("s", 0), ("s", 1), ("s", 2), ("t", 0), ("u", 0), ("u", 1)]
    assert [rows["s", i].tag for i in range(3)] == ["O", None, None] and rows["t", 0].tag == "O" and rows["u", 1].tag is None
    mid = rows["s", 1]
    assert (mid.form, mid.lower, mid.casing, mid.start, mid.prev.form, mid.next.lower, mid.prev2, mid.next2) == ("b", "b", "LOWER", 2, "A", "c", None, None)
    assert rows["s", 2].prev2.form == "A" and rows["s", 0].next2.form == "C" and rows["s", 0].prev is None and rows["s", 2].next is None


def test_spans_start_from_forms_that_may_be_terms(spark, tables):
    plan = views.gold_spans(spark, tables)._jdf.queryExecution().optimizedPlan().toString()
    assert ">= 8" in plan
    assert sorted((r.sid, r.ent_ix, r.text) for r in views.gold_spans(spark, tables).collect()) == [
        ("1.s0", 0, "Paracetamolum hilft"), ("1.s1", 1, "Paracetamolum allein"), ("5.s0", 0, "Paracetamolum"),
    ]


def _decoded_one_by_one(rows, drop_adjacent):
    """Entities of ``sid, tok_ix, form, start, end, label``, token by token."""
    out = []
    for sid, group in itertools.groupby(sorted(rows), key=lambda r: r[0]):
        runs = []
        for r in group:
            if r[5] in ("O",) or r[5].startswith("B"):
                runs.append([r])
            elif runs:
                runs[-1].append(r)
        for run, after in zip(runs, [*runs[1:], None], strict=False):
            lost = drop_adjacent and after and after[0][5].startswith("B")
            if run[0][5].startswith("B") and not lost:
                out.append((sid, run[0][3], run[-1][4], " ".join(r[2] for r in run), run[0][5][2:]))
    return sorted(out)


def test_thinned_labels_decode_alike(spark):
    rnd, rows = random.Random(5), []
    for s in range(40):
        often = rnd.choice([1, 4, 60])
        for i in range(rnd.choice([3, 200, 700])):
            if rnd.random() < 0.9:  # numbers with gaps
                rows.append((f"s{s}", i, f"w{i}", 3 * i, 3 * i + 1, rnd.choice(["B-a", "I-a", "I-b", "I-a"] + ["O"] * often)))
    # an I after an O, after a gap and after nothing; labels over the border of a stretch
    rows += [("t", i, "x", i, i, lab) for i, lab in ((0, "I-a"), (1, "B-a"), (5, "I-a"), (6, "O"), (62, "B-a"), (64, "I-a"), (128, "O"), (300, "I-a"), (301, "B-b"))]
    # after O some tokens close what is open
    df = spark.createDataFrame(rows, "sid string, tok_ix int, form string, start int, end int, label string").repartition(4)
    for drop in (True, False):
        got = sorted(map(tuple, sp.bio_decode(df, drop).collect()))
        want = _decoded_one_by_one(rows, drop)
        assert got == want and len(want) > 100
    quiet = spark.range(6400).select(F.lit("s").alias("sid"), F.col("id").cast("int").alias("tok_ix"), F.lit("x").alias("form"), F.lit(0).alias("start"), F.lit(0).alias("end"), F.lit("O").alias("label"))
    assert sp.thinned(quiet).count() == 100
