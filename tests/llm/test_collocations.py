import random
import re
from collections import Counter

import pytest

from tagloom.llm import collocations
from tests.llm.rows import documents

LOWER = {k: k + 32 for k in range(65, 91)}


def by_hand(rows, longest=5, least=100, covered=100, top=2000):
    counts, total = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(words)
            counts.update((lang, tuple(words[i : i + k])) for k in range(1, longest + 1) for i in range(len(words) - k + 1))
    often = {key: a for key, a in counts.items() if a >= least and len(key[1]) > 1}
    gone = {
        (lang, p[i : i + k]) for (lang, p), f in often.items() for k in range(2, len(p)) for i in range(len(p) - k + 1)
        if 100 * f >= covered * counts[lang, p[i : i + k]]
    }
    out = {}
    for (lang, p), a in often.items():
        if (lang, p) in gone:
            continue
        cuts = [(counts[lang, p[:k]], counts[lang, p[k:]]) for k in range(1, len(p))]
        score, _, l, r = min((1000 * a * total[lang] // (l * r), k, l, r) for k, (l, r) in enumerate(cuts))
        out.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), l, r))
    return {
        (lang, k + 1, phrase.decode(), -a, l, r, total[lang], -score)
        for lang, found in out.items() for k, (score, a, phrase, l, r) in enumerate(sorted(found)[:top])
    }


def odd_rows(rng, n=300):
    words = ["the", "The", "of", "é", "É", "new", "york", "state", "a\x0bb", "x\x1c", "-"]
    rows = [(rng.choice(["", " "]).join([" ".join(rng.choices(words, k=rng.randint(0, 40))) + rng.choice(".,;:!?\n\r\x0c\t ") for _ in range(rng.randint(0, 6))]), rng.choice(["en", "de", None, "und", ""])) for _ in range(n)]
    return rows + [(None, "en"), ("", "en"), ("...", "xx"), ("new york city hall now " * 2000, "en"), ("again " * 500, None)]


def frame(spark, rows):
    return documents(spark, [t for t, _ in rows], [lang for _, lang in rows])


def test_phrases_equal_plain_counting(spark):
    rows = odd_rows(random.Random(2), 2500)
    found = [tuple(r) for r in collocations.digest(frame(spark, rows)).collect()]
    assert len(found) > 60 and len(found) == len(set(found)) and set(found) == by_hand(rows)


@pytest.mark.parametrize("sent", [0, 1 << 20])
def test_blocks_that_cut_texts(spark, sent):
    rows = odd_rows(random.Random(4))
    found = collocations.collocations(frame(spark, rows), longest=4, least=30, covered=60, top=50, block_words=997, sent_bytes=sent)
    assert {tuple(r) for r in found.collect()} == by_hand(rows, 4, 30, 60, 50)


def test_empty_and_wordless(spark):
    for rows in ([("", "en")], [(None, None), (" . ", "en")], [("one two", "en")]):
        assert collocations.digest(frame(spark, rows)).count() == 0
    assert collocations.digest(frame(spark, [("a", "en")]).limit(0)).count() == 0


def test_products_beyond_64_bits(spark):
    big = 10**12
    table = spark.createDataFrame([("en", "a b", big, 3 * big, big, big)], "lang string, phrase string, a long, words long, l long, r long")
    product = (collocations._whole("a") * collocations._whole("words") * 1000).alias("product")
    assert table.select(product, "l", "r").selectExpr("product div (cast(l AS decimal(18,0)) * cast(r AS decimal(18,0))) AS s").first()["s"] == 3000
