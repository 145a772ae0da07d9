import pytest
from pyspark.sql import functions as F

from tagloom.operators import naive_bayes as nb
from tagloom.plans import runs
from tagloom.sources import lexicons, models, rows, vectors, xml

DOCUMENT = """<?xml version="1.0" encoding="UTF-8"?>
<document id="d">
  <sentence id="d.s0" text=" Aspirin and H1 blockers &amp; more ">
    <entity id="d.s0.e0" charOffset="1-7" type="drug" text="Aspirin"/>
    <entity id="d.s0.e1" charOffset="13-14;16-23" type="group" text="H1 blockers"/>
    <pair id="d.s0.p0" e1="d.s0.e0" e2="d.s0.e1" ddi="true" type="effect"/>
    <pair id="d.s0.p1" e1="d.s0.e1" e2="d.s0.e0" ddi="false"/>
  </sentence>
  <sentence id="d.s1" text=""/>
  <sentence id="" text="dropped"/>
</document>
"""


@pytest.fixture
def corpus(spark, tmp_path):
    (tmp_path / "a.xml").write_text(DOCUMENT)
    (tmp_path / "b.txt").write_text(DOCUMENT)
    return xml.read_annotated_xml(spark, str(tmp_path))


def test_annotated_xml(spark, corpus, tmp_path):
    got = {r["sid"]: r for r in corpus.collect()}
    assert set(got) == {"d.s0", "d.s1"}
    assert got["d.s0"]["text"] == " Aspirin and H1 blockers & more " and got["d.s1"]["entities"] == []
    segs = sorted(tuple(r) for r in xml.entity_segments(corpus).collect())
    assert segs == [("d.s0", 0, 0, 1, 7, "drug"), ("d.s0", 1, 0, 13, 14, "group"), ("d.s0", 1, 1, 16, 23, "group")]
    assert [tuple(r) for r in xml.gold_relations(corpus).collect()] == [("d.s0", "d.s0.e0", "d.s0.e1", "effect")]
    assert ("d.s0", "13-14;16-23", "H1 blockers", "group") in [tuple(r) for r in xml.gold_entities(corpus).collect()]
    xml.write_annotated_xml(corpus, str(tmp_path / "copy"))
    again = xml.read_annotated_xml(spark, str(tmp_path / "copy"))
    assert sorted(map(str, again.collect())) == sorted(map(str, corpus.collect()))


def test_feature_rows_round_trip(spark, corpus, tmp_path):
    features = runs.extract_features(corpus)
    rows.write_features(features, str(tmp_path / "tsv"), corpus)
    back = rows.read_features(spark, str(tmp_path / "tsv"))
    assert sorted(map(str, back.collect())) == sorted(map(str, features.select(back.columns).collect()))
    text = "".join(p.read_text() for p in (tmp_path / "tsv").glob("part-*"))
    assert text.startswith("\n") or "\n\n" in text
    first = features.orderBy("tok_ix").first()
    assert first["tag"] == "B-drug" and first["features"][:3] == ["form=Aspirin", "formLower=aspirin", "pref3=asp"]
    assert "BoS" in first["features"] and first["features"][-2:] == ["pos=UNK", "emb_unavailable=true"]


def test_predictions_with_pipes(spark, tmp_path):
    ents = spark.createDataFrame([("s", 0, 4, "a|b c", "drug"), ("s", 0, 4, "a|b c", "drug")], "sid string, start int, end int, text string, type string")
    rows.write_predictions(ents, str(tmp_path / "out"))
    assert [tuple(r) for r in rows.read_predictions(spark, str(tmp_path / "out")).collect()] == [("s", "0-4", "a|b c", "drug")]


def test_lexicons(spark, tmp_path):
    (tmp_path / "l.txt").write_text(" Aspirin \naspirin\n\n Ibu Profen\n")
    assert sorted(r[0] for r in lexicons.read_lexicon(spark, str(tmp_path / "l.txt")).collect()) == ["aspirin", "ibu profen"]
    (tmp_path / "d.xml").write_text(
        "<drugbank><drug><name>Beta</name><groups><group>approved</group></groups><synonyms><synonym>alpha</synonym>"
        "<synonym>Beta</synonym></synonyms><products><product><name>Gamma</name></product></products></drug>"
        "<drug><name>Delta</name><groups><group>illicit</group></groups></drug></drugbank>"
    )
    drugs = xml.read_drug_xml(spark, str(tmp_path / "d.xml"))
    assert [r[0] for r in lexicons.lexicon_from_drugbank(drugs).collect()] == ["alpha", "Beta", "Gamma"]


def test_chembl_repeats_synonyms_per_indication(spark):
    md = spark.createDataFrame([(1, "b", 4), (2, "a", 4), (3, "c", 3), (4, "d", 4), (5, "e", 4)], "molregno long, pref_name string, max_phase int")
    ms = spark.createDataFrame([(1, "y"), (1, "x")], "molregno long, synonyms string")
    di = spark.createDataFrame([(1, 4), (1, None), (1, 2), (4, 3)], "molregno long, max_phase_for_ind int")
    mh = spark.createDataFrame([(5, 9), (2, 2)], "molregno long, parent_molregno long")
    got = [tuple(r) for r in lexicons.lexicon_from_chembl(md, ms, di, mh).collect()]
    assert got == [(2, "a", "", 4), (1, "b", "x; x; y; y", 4)]


def test_embeddings(spark, tmp_path):
    (tmp_path / "v.txt").write_text("a 1 2 3\nshort 1\nb 4 5 6 7\nbad 1 x 3\na 7 8 9\nlate 1 1 1\n")
    got = {r["word"]: r["vec"] for r in vectors.read_embeddings(spark, str(tmp_path / "v.txt"), dim=3, max_vocab=5).collect()}
    assert got == {"a": [7.0, 8.0, 9.0], "b": [4.0, 5.0, 6.0]}
    assert vectors.read_embeddings(spark, str(tmp_path / "none.txt")).count() == 0


def test_model_round_trip_and_unknown_kind(spark, tmp_path):
    train = spark.createDataFrame([("O", ["form=a", "x=1"]), ("B-d", ["form=b", "x=2"])], "tag string, features array<string>")
    model = nb.fit_naive_bayes(train)
    models.save_model(model, str(tmp_path / "m"))
    loaded = models.load_model(spark, str(tmp_path / "m"))
    assert loaded.labels == model.labels and loaded.kind == "naive_bayes"
    assert sorted(map(str, loaded.tables["log_prob"].collect())) == sorted(map(str, model.tables["log_prob"].collect()))
    with pytest.raises(ValueError):
        models.save_model(models.Model("svm", []), str(tmp_path / "n"))
    with pytest.raises(ValueError):
        runs.label_tokens(models.Model("svm", []), train.select(F.lit("s").alias("sid"), F.lit(0).alias("tok_ix"), F.lit("a").alias("form"), F.lit(0).alias("start"), F.lit(0).alias("end"), "features"))
