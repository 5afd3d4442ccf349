import zlib

import numpy as np
import pytest

from versus.llm import langid


@pytest.fixture(scope="module")
def model(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    return docs, langid.fit(langid.training_rows(docs))


def test_held_out_accuracy(spark, model):
    docs, m = model
    lang = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    got = langid.identify(docs, m).collect()
    assert len(got) == docs.count()
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1
    held = [r for r in got if r.held_out]
    assert np.mean([r.lang_pred == lang[r.doc_id] for r in held]) > 0.93


def test_single_language_fit_equals_brute_force(model):
    """With one language chosen the prediction is the largest plain log-likelihood."""
    docs, m = model
    texts = [r.text for r in docs.select("text").limit(80).collect()]
    shares, ok = m.infer(texts)
    for t, p, good in zip(texts, shares, ok):
        if good and (p > 0).sum() == 1:
            like = m.logp[langid.trigrams(t)].sum(axis=0)
            assert int(np.argmax(p)) == int(np.argmax(like))


def test_em_is_at_the_likelihood_maximum(model):
    _, m = model
    en, fr = "the and of that with this " * 30, "dans pour elle est une qui les " * 40
    (p,), _ = m.infer([en + fr])
    chosen = {m.langs[i] for i in np.flatnonzero(p)}
    assert chosen == {"en", "fr"}
    g = langid.trigrams(en + fr)
    prob = np.exp(m.logp[g])

    def like(q):
        return np.log(prob @ q).sum()

    for step in (0.05, -0.05):
        q = p.copy()
        i, j = np.flatnonzero(p)
        q[i] += step
        q[j] -= step
        assert like(q) < like(p)


def test_results_do_not_depend_on_the_batch(model):
    docs, m = model
    texts = [r.text for r in docs.select("text").limit(400).collect()]
    texts += ["the and of that with " * 20 + "dans pour elle est une " * 20, "x", "", "é", texts[0] + texts[1]]
    together, _ = m.infer(texts)
    alone = np.concatenate([m.infer([t])[0] for t in texts])
    assert (together == alone).all()
    backwards, _ = m.infer(texts[::-1])
    assert (together == backwards[::-1]).all()


def test_bounded_search_equals_every_set(model):
    """The chosen set has the largest penalised likelihood of all nested sets."""
    docs, m = model
    texts = [r.text for r in docs.select("text").limit(40).collect()]
    texts += [a + " " + b for a, b in zip(texts[::2], texts[1::2])]

    def value(t, keep):
        p = np.exp(m.logp[langid.trigrams(t)][:, keep])
        pi = np.full(len(keep), 1 / len(keep))
        for _ in range(300):
            pi = (pi * p / (p @ pi)[:, None]).mean(axis=0)
        return np.log(p @ pi).sum() - len(keep) * m.penalty * np.log(len(p) + 1), pi

    shares, ok = m.infer(texts)
    for t, s, good in zip(texts, shares, ok):
        if good:
            _, pi = value(t, list(range(len(m.langs))))
            order = np.argsort(-pi, kind="stable")
            best = max(value(t, list(order[:k]))[0] for k in range(1, len(m.langs) + 1))
            assert value(t, list(np.flatnonzero(s)))[0] > best - 0.5


def test_equal_languages_tie_to_the_first():
    m = langid.LanguageModel(["aa", "bb"], np.full((langid.BUCKETS, 2), -np.log(langid.BUCKETS)))
    (p,), _ = m.infer(["some words of either"])
    assert p.tolist() == [1.0, 0.0]


def test_sample_is_bounded_whatever_the_ids(spark, monkeypatch):
    rows = [(i, f"the words of number {n} and that", "en") for n, i in enumerate([None] * 300 + [7] * 300)]
    rows += [(None, f"les mots dans une page {n}", "fr") for n in range(300)] + [(9, "das ist ein Satz", "de")] * 500 + [(1, "nada", None), (2, None, "es")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    m = langid.fit(df, per_lang=50)
    assert m.langs == ["de", "en", "fr"]
    weight = 1 / np.exp(m.logp).min(axis=0)  # trigrams seen, in units of the smoothing
    one = len(langid.trigrams("das ist ein Satz")) + langid.BUCKETS * 0.5
    assert weight[0] * 0.5 == pytest.approx(one)  # the repeated text counts once
    for i, text in ((1, "the words of number 100 and that"), (2, "les mots dans une page 100")):
        read = (weight[i] * 0.5 - langid.BUCKETS * 0.5) / len(langid.trigrams(text))
        assert 20 < read < 90


SCHEMA = "doc_id long, text string, lang string, lang_pred int, score string"


def test_edge_cases(spark, model):
    _, m = model
    long_text = "the and of that with this " * 100_000
    rows = [(1, None, "en"), (2, "", "en"), (3, "12 !! 34", "en"), (None, "the and of that", None), (5, long_text, "x"), (5, long_text, "x"), (6, "é", None)]
    df = spark.createDataFrame([(*r, 1, "a") for r in rows], SCHEMA)
    got = langid.identify(df, m).collect()
    assert len(got) == len(rows)
    assert all(r.lang_pred == "und" and r.score == 0 for r in got if r.doc_id in (1, 2, 3))
    assert [r.lang_pred for r in got if r.doc_id == 5] == ["en", "en"]
    assert [r.lang_pred for r in got if r.doc_id is None] == ["en"]
    empty = spark.createDataFrame([], SCHEMA)
    assert langid.identify(empty, m).count() == 0
    none = langid.fit(empty)
    assert none.langs == []
    assert {r.lang_pred for r in langid.identify(df, none).collect()} == {"und"}
