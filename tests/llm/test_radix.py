import hashlib
from collections import Counter, defaultdict

from hypothesis import given, settings
from hypothesis import strategies as st

from tagloom.llm import radix
from tests.llm.rows import documents


def by_hand(rows):
    """Every row's group by plain comparison of whole texts; a null id is smaller than any other."""
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[text or ""].append(doc_id)
    out = Counter()
    for text, ids in groups.items():
        best = max((i for i in ids if i is not None), default=None)
        digest = hashlib.sha256(text.encode()).hexdigest()
        for k, i in enumerate(sorted(ids, key=lambda i: (i is not None, i or 0))):
            out[i, best, len(ids), k == len(ids) - 1, digest] += 1
    return out


def test_groups_of_odd_rows(spark):
    long = "long words " * 20_000
    rows = [(k, t) for k, t in enumerate([None, "", "a", "a", "b", "ä" * 32, "ä" * 32, "ä" * 32 + "x", "x" * 64, "x" * 64, "x" * 65, long, long, long + "!", long[:-1], "a\0", "a\0", "a "])]
    rows += [(None, "a"), (None, "only null"), (None, "only null"), (7, "twice"), (7, "twice"), (8, "twice"), (9, "A")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert Counter(tuple(r) for r in radix.digest(df).collect()) == by_hand(rows)
    assert radix.digest(df.limit(0)).count() == 0


@settings(max_examples=8, deadline=None)
@given(st.lists(st.text("ab\n", max_size=9) | st.none(), max_size=40))
def test_short_digits(spark, texts):
    rows = list(enumerate(texts))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = radix.exact_groups(df, first=1, growth=1, longest=2).select("doc.doc_id", "keep_id", "group_size", "kept", "body_sha256")
    assert Counter(tuple(r) for r in found.collect()) == by_hand(rows)


def test_a_hot_group_and_ids_of_another_kind(spark):
    rows = [(f"d{k:04}", "same " * 100 if k % 3 else f"own {k}") for k in range(3000)]
    found = radix.digest(spark.createDataFrame(rows, "doc_id string, text string")).collect()
    assert sum(r["kept"] for r in found) == 1001 and max(r["group_size"] for r in found) == 2000
    assert {r["keep_id"] for r in found if r["group_size"] == 2000} == {"d2999"}


def test_copies_go_and_columns_stay(spark):
    df = documents(spark, ["x", "x", None, "", "y"]).withColumnsRenamed({"score": "digit", "label": "row", "spans": "rest", "source": "kept"})
    kept = radix.drop_copies(df)
    assert kept.columns == df.columns and sorted(r["doc_id"] for r in kept.collect()) == [1, 3, 4]


def test_no_python_and_no_digest_in_the_comparison(spark):
    plan = radix.digest(documents(spark, ["a", "a"]))._jdf.queryExecution().executedPlan().toString()
    assert not any(w in plan for w in ("Python", "Pandas", "Arrow"))
