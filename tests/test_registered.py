import os

import pytest

import __spark_entry__ as entry
from tests.check_oracle import compare

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")
CHECKED = [
    "a2_entity_segments", "a6_first_vectors", "a6_read_embeddings", "a13_lexicon_from_chembl", "b1_tokenize_treebank", "b2_align_offsets_treebank",
    "b3_bio_tag", "c4_word_shape", "c5_casing", "d2_previous2", "d4_next2", "e1_fuzzy_lexicon", "e2_exact_lexicon", "e3_fit_tagger", "e3_guess_tags", "e4_embedding_bins",
    "f4_fit_naive_bayes", "g3_sequence_weights", "h1_bio_decode", "i2_statistics", "i5_evaluate_relations", "i7_error_analysis",
    "j2_train_and_score", "j3_score_stream",
]


def test_entry(spark):
    assert entry.entry(spark).count() == 6


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", CHECKED)
def test_query_equals_sql(spark, name):
    ok, note = compare(spark, SF, name)
    assert ok, note
