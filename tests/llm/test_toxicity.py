import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from versus.llm import toxicity


def brute_segments(scores):
    """Ruzzo and Tompa's definition by recursion: the best segment, then both sides of it."""
    def split(a, b):
        best = max(((sum(scores[i:j]), -(j - i), -i) for i in range(a, b) for j in range(i + 1, b + 1)), default=(0, 0, 0))
        if best[0] <= 1e-12:
            return []
        i, j = -best[2], -best[2] - best[1]
        return split(a, i) + [(best[0], i, j - 1)] + split(j, b)

    return split(0, len(scores))


@pytest.mark.parametrize("seed", range(20))
def test_segments_equal_the_definition(seed):
    rng = random.Random(seed)
    n = rng.randint(1, 28)
    hits = sorted((i, rng.choice([1.03, 2.51, -1.7, 0.35, 4.2])) for i in rng.sample(range(n), rng.randint(0, n)))
    scores = [-0.3] * n
    for i, s in hits:
        scores[i] = s
    got = sorted(toxicity.segments(hits, 0.3), key=lambda x: x[1])
    want = brute_segments(scores)
    assert [(a, b) for _, a, b in got] == [(a, b) for _, a, b in want]
    assert [s for s, _, _ in got] == pytest.approx([s for s, _, _ in want])


def test_segments_are_linear():
    hits = [(i, 1.0 if i % 3 else -2.5) for i in range(300_000)]
    assert len(toxicity.segments(hits)) == 100_000


def test_extreme_value_root():
    p, s = np.array([0.99, 0.01]), np.array([-0.1, 2.0])
    lam = toxicity._extreme_value(p, s)
    assert (p * np.exp(lam * s)).sum() == pytest.approx(1.0, abs=1e-6) and lam > 0


WORDS = "river house stone garden winter morning people water letter window market road bread light story".split()
BAD = [stem + end for stem in ("vilek", "grumb") for end in ("a", "um", "or", "at", "is", "ox", "ent", "iff", "ul", "ard")]


def planted(rng, i, bad):
    words = [rng.choice(WORDS) + rng.choice(["", "s", "er", "ly"]) for _ in range(rng.randint(20, 300))]
    if bad:
        at = rng.randrange(len(words) - 12)
        for _ in range(5):
            words[at + rng.randrange(12)] = rng.choice(BAD)
    return (i, " ".join(words), 0.5, "s", 1)


SCHEMA = "doc_id long, text string, score double, predicted string, toxic int"


@pytest.fixture(scope="module")
def trained(spark):
    rng = random.Random(4)
    rows = [planted(rng, i, i % 5 == 0) for i in range(1500)]
    docs = spark.createDataFrame(rows, SCHEMA)
    labels = spark.createDataFrame([(i, int(i % 5 == 0), 1) for i in range(1200)] + [(None, 1, 1), (1201, None, 1), (3, 0, 0), (7, 1, 1)], "doc_id long, toxic int, text int")
    return docs, toxicity.fit(toxicity.training_rows(docs), labels)


def test_held_out_planted_passages(trained):
    docs, model = trained
    got = toxicity.score(docs, model).collect()
    assert len(got) == 1500
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert r.predicted == int(r.score >= 0.5) and 0 <= r.score <= 1
    wrong = [r.doc_id for r in got if r.predicted != int(r.doc_id % 5 == 0)]
    assert len(wrong) <= 15
    text = {r.doc_id: r.text for r in docs.collect()}
    for r in got:
        if r.predicted:  # the passage holds the planted words
            words = toxicity.words_of(text[r.doc_id])
            covered = {w for p in r.passages for w in words[p["first"]: p["last"] + 1]}
            assert covered & set(BAD)


def test_unseen_endings_are_caught_by_their_stem(trained):
    _, model = trained
    clean = " ".join(WORDS * 3)
    x, found = model.passages(f"{clean} vilekast vilekenz vilekiv {clean}")
    assert model.score(x) > 0.5 and found[0][1:] == (45, 47)
    assert model.score(model.passages(clean)[0]) < 0.5


def test_every_occurrence_scores():
    model = toxicity.ToxicityModel({"vileka": 3.0, "grumbat": 3.0, "grumbox": 3.0})
    clean, bad = ["river"] * 100, ["vileka", "grumbat", "grumbox"]
    _, found = model.passages(" ".join(clean + bad + clean + bad + clean))
    assert sorted(x[1:] for x in found) == [(100, 102), (203, 205)]
    apart = [w for b in bad for w in [b] + clean[:40]]  # first uses alone, too weak each
    _, found = model.passages(" ".join(apart + clean + bad + clean))
    assert [x[1:] for x in found] == [(223, 225)]
    assert model.passages(" ".join(apart + clean))[1] == []


def test_repeated_ids_do_not_crowd_the_sample(spark):
    rng = random.Random(9)
    rows = [planted(rng, i, i % 2 == 0) for i in range(400)]
    rows += [(1000, f"{rng.choice(WORDS)} {i}", 0.5, "s", 1) for i in range(3000)]  # two toxic ids of many texts
    rows += [(1002, f"{rng.choice(WORDS)} " + "abcdefghij"[i % 10] * (i // 10 + 1), 0.5, "s", 1) for i in range(3000)]
    docs = spark.createDataFrame(rows, SCHEMA)
    labels = spark.createDataFrame([(i, int(i % 2 == 0)) for i in range(400)] + [(1000, 1), (1002, 1)], "doc_id long, toxic int")
    got, sizes = toxicity.sample(docs, toxicity.label_rows(labels), "doc_id", "text", 300)
    n = {r.toxic: r["count"] for r in got.groupBy("toxic").count().collect()}
    assert sizes == {0: 200, 1: 202} and n[0] == 200 and 220 <= n[1] <= 380
    assert got.filter("toxic = 1").filter(F.size(F.split("text", " ")) > 15).count() == 200
    # one text on 500 rows of an id: once, not 500 * 500 times
    same = docs.filter("doc_id < 400").unionByName(docs.filter("doc_id = 0").crossJoin(spark.range(500).select()))
    got, _ = toxicity.sample(same, toxicity.label_rows(labels), "doc_id", "text", 6000)
    assert got.count() == 400
    assert any(u in BAD for u in toxicity.fit(docs, labels, per_class=300).units)


def test_real_tables(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    got = toxicity.score(docs, toxicity.fit(toxicity.training_rows(docs), labels))
    held = got.filter("held_out").join(labels.select("doc_id", "toxic"), "doc_id").collect()
    hit = np.mean([r.predicted for r in held if r.toxic == 1])
    false = np.mean([r.predicted for r in held if r.toxic == 0])
    assert hit > 0.75 and false < 0.02


def test_edge_cases(spark, trained):
    _, model = trained
    long_text = " ".join(WORDS * 40_000)
    rows = [(1, None), (2, ""), (2, ""), (None, "vileka vilekum grumbat vilekor grumbox"), (3, long_text)]
    df = spark.createDataFrame([(*r, 0.1, "p", 7) for r in rows], SCHEMA)
    got = toxicity.score(df, model).collect()
    assert len(got) == len(rows)
    assert all(r.predicted == 0 and r.passages == [] for r in got if r.doc_id in (1, 2, 3))
    assert [r.predicted for r in got if r.doc_id is None] == [1]
    empty = spark.createDataFrame([], SCHEMA)
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    assert toxicity.score(empty, model).count() == 0
    none = toxicity.fit(empty, labels)
    assert {r.predicted for r in toxicity.score(df, none).collect()} == {0}
