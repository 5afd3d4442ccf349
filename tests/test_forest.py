"""The forest against a plain count of its rows, and Spark's model of it against its own votes."""

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.classification import RandomForestClassifier

from versus.operators import forest as FO
from versus.operators import models as M
from versus.operators import training as TR

FEATS = ["a", "b", "c"]


@pytest.fixture(scope="module")
def frame(spark):
    rng = np.random.default_rng(6)
    n = 1200
    x = np.column_stack([rng.normal(size=n).round(1), rng.integers(0, 3, n), rng.normal(size=n)])
    y = (x[:, 0] * x[:, 1] + x[:, 2] + 0.7 * rng.normal(size=n) > 0.5).astype(int)
    x[rng.random((n, 3)) < 0.05] = np.nan
    pdf = pd.DataFrame(x, columns=FEATS).assign(win=y, matchid=np.arange(n), teamid=100)
    pdf["split"] = np.where(np.arange(n) % 10 < 7, "train", "test")
    df = spark.createDataFrame(pdf.astype(object).where(pdf.notna(), None), "a double, b double, c double, win int, matchid long, teamid long, split string")
    return pdf, df.repartition(4)


def test_a_forest_takes_a_pass_a_level_and_no_fit_of_spark(frame, monkeypatch):
    _, df = frame
    passes, level = [], FO._level
    monkeypatch.setattr(FO, "_level", lambda *a: passes.append(a[2]) or level(*a))
    monkeypatch.setattr(RandomForestClassifier, "fit", None)
    model = M.fit_random_forest(df, FEATS, "win", n_estimators=9, max_depth=4)
    assert passes == [0, 1, 2, 3] and model.ml_model.getNumTrees == 9
    assert abs(sum(v for _, v in model.importances()) - 1) < 1e-9


def test_rows_are_found_where_a_plain_count_finds_them(frame):
    """Every node's class counts are those of the bagged rows that its splits lead to, and no split gains more."""
    pdf, df = frame
    model = M.fit_random_forest(df, FEATS, "win", n_estimators=3, max_depth=3, min_samples_leaf=5, class_weight=None)
    edges = model.votes.edges
    keys = np.array([r.k for r in df.select(FO.F.xxhash64(*df.columns).alias("k"), "matchid").orderBy("matchid").collect()], dtype=np.int64)
    v, y = pdf[FEATS].to_numpy(float), pdf.win.to_numpy()
    for t, (feature, cut, left, _, one, _) in enumerate(model.votes.trees):
        bag = FO.bags(keys, t // 4, 42)[t % 4]
        node = np.zeros(len(v), int)
        for _ in range(3):
            go = np.array([v[i, feature[q]] <= edges[feature[q]][cut[q]] if left[q] != q else True for i, q in enumerate(node)])
            node = np.where(left[node] == node, node, left[node] + ~go)
        for leaf in np.unique(node):
            own = (node == leaf) & (bag > 0)
            if own.any():
                assert bag[own].sum() >= 5
                assert one[leaf] == pytest.approx((bag[own] * y[own]).sum() / bag[own].sum())
        # the root's split is the best of its drawn features
        drawn, gini = FO.drawn_features(np.array([1]), t, 3, 2, 42)[0], lambda w: 1 - sum((bag[w] * (y[w] == c)).sum() ** 2 for c in (0, 1)) / bag[w].sum() ** 2
        gains = {}
        for f in drawn:
            for i, e in enumerate(edges[f]):
                go = v[:, f] <= e
                if min(bag[go].sum(), bag[~go].sum()) >= 5:
                    share = bag[go].sum() / bag.sum()
                    gains[f, i] = gini(bag >= 0) - share * gini(go) - (1 - share) * gini(~go)
        assert feature[0] in drawn and gains[feature[0], cut[0]] == pytest.approx(max(gains.values()))


def test_spark_scores_as_the_votes_do(spark, frame, tmp_path):
    _, df = frame
    model = M.fit_random_forest(df.where("split = 'train'"), FEATS, "win", n_estimators=11, max_depth=6)
    own = {r.matchid: r for r in model.score(df, ["matchid"]).collect()}
    TR.save_model(spark, model, str(tmp_path / "m"), "win", "test")
    back = TR.load_model(spark, str(tmp_path / "m"))
    assert back.votes is None
    for r in back.score(df, ["matchid"]).collect():
        assert (r.margin, r.score) == (pytest.approx(own[r.matchid].margin, abs=1e-12), pytest.approx(own[r.matchid].score, abs=1e-12))
        assert r.pred == own[r.matchid].pred
    assert back.importances() == model.importances()


def test_as_good_as_spark_and_equal_on_any_partitioning(frame):
    df = frame[1].na.fill(0.0, FEATS)
    got = TR.train_run(df, "random_forest", "win", features=FEATS, n_estimators=40, max_depth=6).metrics.where("split = 'test'").first()
    train = M.balanced_weight(df.where("split = 'train'"), "win")
    rf = RandomForestClassifier(labelCol="win", weightCol="weight", numTrees=40, maxDepth=6, seed=42, featureSubsetStrategy="sqrt").fit(M._assembled(train, FEATS))
    other = M.FittedModel("random_forest", FEATS, ml_model=rf).score(df.where("split = 'test'"), ["win"])
    assert got["roc_auc"] == pytest.approx(TR.classification_metrics(other, "win", "pred", "score").first()["roc_auc"], abs=0.02)
    a, b = (M.fit_random_forest(f, FEATS, "win", n_estimators=6, max_depth=5).votes.trees for f in (df, df.repartition(7)))
    assert all(np.array_equal(p, q) for s, t in zip(a, b) for p, q in zip(s[:5], t[:5]))


def test_many_open_nodes_take_more_passes(frame, monkeypatch):
    _, df = frame
    whole = M.fit_random_forest(df, FEATS, "win", n_estimators=4, max_depth=5).votes.trees
    passes, level = [], FO._level
    monkeypatch.setattr(FO, "_level", lambda *a: passes.append(a[2]) or level(*a))
    monkeypatch.setattr(FO, "CELLS", 3 * 2 * FO.MAX_BINS * 2)
    parts = M.fit_random_forest(df, FEATS, "win", n_estimators=4, max_depth=5).votes.trees
    assert passes[:4] == [0, 1, 2, 2]
    assert all(np.array_equal(p, q) for s, t in zip(whole, parts) for p, q in zip(s[:5], t[:5]))


def test_draws_and_one_class(frame):
    keys = np.arange(40_000, dtype=np.int64) * 7919
    draws = np.concatenate([FO.bags(keys, g, 42) for g in range(3)])
    assert abs(draws.mean() - 1) < 0.01 and abs(draws.var() - 1) < 0.02 and abs(np.corrcoef(draws) - np.eye(12)).max() < 0.03
    places = np.arange(1, 4000)
    drawn = FO.drawn_features(places, 5, 10, 4, 42)
    assert all(len(set(r)) == 4 for r in drawn) and np.allclose(np.bincount(drawn.ravel(), minlength=10) / len(places), 0.4, atol=0.03)
    _, df = frame
    model = M.fit_random_forest(df.where("win = 1"), FEATS, "win", n_estimators=3, max_depth=3)
    assert all(r.score == 1.0 and r.pred == 1 for r in model.score(df.limit(20)).collect())
