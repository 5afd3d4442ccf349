"""Each stage against a plain version over its own input."""

import zlib

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as P
from versus.llm import langid, mixing, pieces, simhash, toxicity

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("stages")
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for name, f in P.STAGES:
        f(spark, out[-1], SF).write.parquet(f"{root}/{name}")
        out.append(spark.read.parquet(f"{root}/{name}"))
    return out


def rows(df):
    return sorted(map(tuple, df.collect()))


def test_stages_keep_the_columns(stages):
    for df in stages[1:-1]:
        assert df.dtypes == stages[0].dtypes


def test_filters_keep_rows_unchanged(stages):
    for before, after in zip(stages[:3], stages[1:4]):
        assert set(rows(after)) <= set(rows(before))


def test_language_stage(spark, stages):
    model = langid.fit(langid.training_rows(stages[0]))
    want = [r.doc_id for r in langid.identify(stages[0], model).collect() if r.lang_pred != "und"]
    assert sorted(r.doc_id for r in stages[1].collect()) == sorted(want)


def test_toxicity_stage(spark, stages):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    model = toxicity.fit(toxicity.training_rows(stages[1]), labels)
    want = [r.doc_id for r in stages[1].collect() if model.score(model.passages(r.text)[0]) < 0.5]
    assert sorted(r.doc_id for r in stages[2].collect()) == sorted(want)


def test_dedup_stage(stages):
    docs = stages[2].select("doc_id", "text").collect()
    fps = {r.doc_id: simhash.simhash(r.text) & (2 ** 64 - 1) for r in docs}
    ids, group = sorted(fps), {i: i for i in fps}
    changed = True
    while changed:
        changed = False
        for i in ids:
            low = min(group[j] for j in ids if (fps[i] ^ fps[j]).bit_count() <= 4)
            if low < group[i]:
                group[i], changed = low, True
    assert sorted(r.doc_id for r in stages[3].collect()) == [i for i in ids if group[i] == i]


def test_mixing_stage(spark, stages):
    labels = mixing.quality_weights(spark.read.parquet(f"{SF}/labels.parquet"))
    want = [r.doc_id for r in mixing.mix(stages[3], labels).collect() for _ in range(r.copies)]
    assert sorted(r.doc_id for r in stages[4].collect()) == sorted(want)
    assert set(rows(stages[4])) <= set(rows(stages[3]))


def test_tokens_decode_to_the_mix(stages):
    v = pieces.vocabulary()
    texts = {r.doc_id: r.text for r in stages[4].collect()}
    got = {}
    for r in stages[5].collect():
        got.setdefault((r.doc_id, r.part), r.ids)
        assert len(r.ids) == r.n_tokens
    for doc, t in texts.items():
        parts = [ids for (d, _), ids in sorted((k, x) for k, x in got.items() if k[0] == doc)]
        raw = b"".join(v.decode(x) for x in parts)
        assert raw[1:].decode() == t
    assert stages[5].filter("part = 0").count() == stages[4].count()


def test_stages_on_odd_rows(spark):
    base = "doc_id long, text string, lang string, source string, n_chars long, score double, fingerprint string"
    long_text = "the and of that with this " * 40_000
    data = [(1, None), (2, ""), (None, "the man of the house and that"), (3, "the man"), (3, "the man"), (4, long_text), (5, "12 34"), (6, "and of the"), (6, "and of that")]
    docs = spark.createDataFrame([(i, t, None, None if i == 3 else "s", 1, 0.5, "x") for i, t in data], base)
    train = spark.read.parquet(f"{SF}/documents.parquet")
    for df in (docs, docs.limit(0)):
        for name, f in P.STAGES[:4]:
            got = f(spark, df, SF)
            assert got.columns == df.columns, name
            got.collect()
    assert P.STAGES[4][1](spark, docs.limit(0), SF).count() == 0
    kept = P.near_dedup(spark, docs, SF).collect()
    assert sorted((r.doc_id or 0) for r in kept) == [0, 1, 3, 4, 5, 6, 6]
    unlabelled = P.language_id(spark, docs, SF).collect()
    assert sorted((r.doc_id or 0) for r in unlabelled) == [0, 3, 3, 4, 6, 6]
    both = train.select(*train.columns).unionByName(docs.select(*train.columns))
    left = {r.doc_id for r in P.language_id(spark, both.withColumn("doc_id", F.coalesce("doc_id", F.lit(-9))), SF).filter("n_chars = 1").collect()}
    assert {-9, 3, 4, 6} <= left


def test_dedup_goes_by_text_not_by_id(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long, score double, fingerprint string"
    copy = "a copy without any id that stands here many times over"
    data = [(1, None), (2, ""), (None, "the man of the house and that"), (3, "the man"), (3, "the man"), (5, "12 34"), (6, "and of the"), (6, "and of that")]
    data += [(None, copy)] * 50 + [(7, "and of the"), (8, "quite another text"), (None, "quite another text")]
    docs = spark.createDataFrame([(i, t, None, "s", 1, 0.5, "x") for i, t in data], schema)
    kept = sorted((r.doc_id or 0, r.text or "") for r in P.near_dedup(spark, docs, SF).collect())
    assert kept == [(0, copy), (0, "the man of the house and that"), (1, ""), (3, "the man"), (5, "12 34"),
                    (6, "and of that"), (6, "and of the"), (8, "quite another text")]


def test_run_equals_the_stages(spark, stages):
    got = P.run(spark, SF)
    key = lambda r: (r.doc_id, r.part, r.decoded_crc32, zlib.crc32(bytes(str(r.ids), "ascii")))
    assert sorted(map(key, got.collect())) == sorted(map(key, stages[5].collect()))
