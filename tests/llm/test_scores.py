import random

import numpy as np
import pyarrow as pa

from tagloom.llm import language, lm_score, toxicity
from tests.llm.rows import by_id, documents

ALPHABETS = {"aa": "abcdefgh", "bb": "fghijklm", "cc": "äöüßklmn"}


def sentences(seed, n, alphabet):
    r = random.Random(seed)
    return [" ".join("".join(r.choice(alphabet) for _ in range(r.randint(2, 7))) for _ in range(r.randint(5, 60))) for _ in range(n)]


def test_language_held_out(spark):
    texts, langs = [], []
    for lang, alphabet in ALPHABETS.items():
        texts += sentences(lang, 120, alphabet)
        langs += [lang] * 120
    odd = [None, "", "123 ... 4", "abc " * 100_000, "abcdefgh", "x"]
    found = by_id(language.digest(documents(spark, texts + odd, langs=langs + [None] * len(odd))))
    assert len(found) == len(texts) + len(odd)
    held = [k for k in range(len(texts)) if found[k]["held_out"]]
    assert len(held) > 50 and sum(found[k]["lang_pred"] == langs[k] for k in held) >= 0.98 * len(held)
    base = len(texts)
    assert [found[base + k]["lang_pred"] for k in (0, 1, 2, 3)] == ["und", "und", "und", "aa"]
    assert all(0 <= r["score"] <= 1 for r in found.values()) and found[base]["score"] == 0


def test_language_scores_equal_plain_bayes(spark):
    docs = documents(spark, ["abc abd", "xyz", "abc", "xyw xyz"], langs=["aa", "bb", "aa", "bb"])
    langs, table, prior = language.fit(docs)
    assert langs == ["aa", "bb"] and np.allclose(np.exp(table).sum(axis=0), 1, atol=1e-3) and np.allclose(np.exp(prior), 0.5)
    buckets, of, lettered = language.grams(["ab"])
    assert [len(b) for b in buckets] == [2, 1] and lettered.all() and all((o == 0).all() for o in of)
    got = by_id(language.predict(docs, (langs, table, prior)))
    for k, text in enumerate(["abc abd", "xyz", "abc", "xyw xyz"]):
        b = np.concatenate(language.grams([text])[0])
        odds = np.exp(table[b].astype(float).sum(axis=0) + prior)
        assert got[k]["lang_pred"] == langs[odds.argmax()] and abs(got[k]["score"] - odds.max() / odds.sum()) < 1e-5


def test_language_without_training(spark):
    docs = documents(spark, ["abc", None], langs=[None, None])
    assert {r["lang_pred"] for r in language.digest(docs).collect()} == {"und"}
    assert language.digest(docs.limit(0)).count() == 0


def brute_losses(texts, good, kind, coder):
    pairs, words, before, total = {}, {}, {}, 0
    numbered = [coder.pairs(pa.array([t], pa.string())) for t in texts]
    for k, (word, prev, slot, _) in enumerate(numbered):
        if (k in good) == bool(kind):
            for w, p, s in zip(word.tolist(), prev.tolist(), slot.tolist(), strict=True):
                pairs[s], words[w], before[p], total = pairs.get(s, 0) + 1, words.get(w, 0) + 1, before.get(p, 0) + 1, total + 1
    out = []
    for word, prev, slot, _ in numbered:
        loss = []
        for w, p, s in zip(word.tolist(), prev.tolist(), slot.tolist(), strict=True):
            seen = before.get(p, 0)
            two = min(pairs.get(s, 0), seen) / max(seen, 1)
            loss.append(-np.log(0.6 * two + 0.35 * words.get(w, 0) / max(total, 1) + 0.05 / (coder.unknown + 1)))
        out.append(float(np.mean(loss)) if loss else 0.0)
    return out


def test_cross_entropy_difference(spark):
    texts = sentences(1, 30, "abc") + sentences(2, 30, "bcd") + [None, "", "...", "abc " * 50_000, "abc abc", "abc abc"]
    good = set(range(0, 25)) | {61}
    labels = spark.createDataFrame([(k, 1, None) for k in good] + [(40, 0, 1), (41, None, 0), (None, 1, 0), (9999, 1, 1)], "doc_id long, quality int, toxic int")
    docs = documents(spark, texts)
    models = lm_score.fit(docs, labels, vocabulary_size=50, slots=1 << 12)
    found = by_id(lm_score.score(docs, models))
    for kind, name in ((1, "target_loss"), (0, "background_loss")):
        assert np.allclose([found[k][name] for k in range(len(texts))], brute_losses(texts, good, kind, models.coder), atol=1e-5)
    assert np.mean([found[k]["score"] for k in range(25)]) < np.mean([found[k]["score"] for k in range(30, 60)])
    assert found[60]["n_words"] == 0 and found[60]["score"] == 0
    assert lm_score.digest(docs.limit(0), labels).count() == 0
    assert lm_score.digest(docs, labels.limit(0)).count() == len(texts)


def test_every_good_document_is_target(spark):
    texts = sentences(4, 40, "abcd")
    labels = spark.range(450_000).selectExpr("id AS doc_id", "1 AS quality")
    docs = documents(spark, texts)
    models = lm_score.fit(docs, labels)
    found = by_id(lm_score.score(docs, models))
    for kind, name in ((1, "target_loss"), (0, "background_loss")):
        assert np.allclose([found[k][name] for k in range(40)], brute_losses(texts, set(range(40)), kind, models.coder), atol=1e-5)


def test_bigrams_and_words_are_counted_exactly(spark, monkeypatch):
    """More distinct words than 65,536 and more distinct bigrams than cells; several blocks and hash ranges; other documents."""
    monkeypatch.setattr(lm_score, "BLOCK_BYTES", 100_000)
    monkeypatch.setattr(lm_score, "BUCKET_CELLS", 50_000)
    r = random.Random(5)
    texts = [" ".join(f"w{r.randint(0, 300_000)}" for _ in range(2000)) for _ in range(60)] + sentences(6, 40, "ab")
    good = set(range(0, 60, 2)) | set(range(60, 80))
    labels = spark.createDataFrame([(k, 1) for k in good], "doc_id long, quality int")
    models = lm_score.fit(documents(spark, texts), labels)

    def plain(asked):
        coded = [t.split() for t in texts]
        words, before, pairs = ([{}, {}] for _ in range(3))
        for k, w in enumerate(coded):
            side = int(k in good)
            for a, b in zip(["", *w], w, strict=False):
                for held, key in ((words, b), (before, a), (pairs, (a, b))):
                    held[side][key] = held[side].get(key, 0) + 1
        known = len(words[0].keys() | words[1].keys())
        assert known > 70_000
        for side in (0, 1):
            total = sum(words[side].values())
            yield [
                float(np.mean([-np.log(0.6 * pairs[side].get((a, b), 0) / max(before[side].get(a, 0), 1) + 0.35 * words[side].get(b, 0) / total + 0.05 / (known + 1)) for a, b in zip(["", *w], w, strict=False)]))
                for w in map(str.split, asked)
            ]

    for asked in (texts, [*texts[50:70], "w1 w2 neverseen w3"]):
        docs = models.documents if asked is texts else documents(spark, asked)
        found = by_id(lm_score.score(docs, models))
        for name, want in zip(("background_loss", "target_loss"), plain(asked), strict=True):
            assert np.allclose([found[k][name] for k in range(len(asked))], want, atol=1e-9)


def toxic_case(spark):
    r = random.Random(8)
    clean, texts, toxic = sentences(3, 700, "abcdefgh"), [], []
    for k, t in enumerate(clean):
        words = t.split()
        if k % 4 == 0:
            for _ in range(r.randint(2, 5)):
                words.insert(r.randrange(len(words)), "zorgl" + r.choice(["an", "ib", "ost", "um"]))
        texts.append(" ".join(words))
        toxic.append(int(k % 4 == 0))
    texts += [None, "", "...", "zorglan " * 30_000, texts[0], texts[0]]
    toxic += [0, 0, 0, 1, 1, 1]
    labels = [(k, 1, t) for k, t in enumerate(toxic) if k % 5] + [(1, 0, None), (None, 1, 1), (12345, 0, 1)]
    return texts, toxic, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_toxicity_held_out(spark):
    texts, toxic, labels = toxic_case(spark)
    found = by_id(toxicity.digest(documents(spark, texts), labels))
    held = [k for k in range(700) if found[k]["held_out"]]
    right = sum(found[k]["predicted"] == toxic[k] for k in held)
    assert len(held) > 150 and right >= 0.97 * len(held)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7) for r in found.values())
    assert found[700]["predicted"] == 0 and found[701]["score"] == found[702]["score"] and found[703]["predicted"] == 1


def test_grammar_states():
    g = toxicity.Grammar({"zorg": 2.0, "moron$": 3.0})
    kinds = lambda t: [k for k, _, _ in g.clause(t.split())]
    assert kinds("a zorglan b") == ["plain"] and kinds("you are a zorgum") == ["aimed"] and kinds("zorgum you are") == ["aimed"]
    assert kinds("not a zorgum") == ["negated"] and kinds("not one two three zorgum") == ["plain"]
    assert kinds("she said moron") == ["reported"] and kinds("kill moronic moron") == ["threat", "plain"]
    assert g.features(None) == g.features("") == g.features("nothing here") == [0.0] * len(toxicity.FEATURES)


def test_toxicity_without_labels(spark):
    docs = documents(spark, ["a b", None])
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert [r["predicted"] for r in toxicity.digest(docs, labels).collect()] == [0, 0]
    assert toxicity.digest(docs.limit(0), labels).count() == 0
