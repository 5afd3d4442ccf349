"""Selection math against NumPy, models on a planted signal, persistence,
scoring and streaming round trips."""

import numpy as np
import pandas as pd
import pytest

from versus.operators import models as M
from versus.operators import selection as SEL
from versus.operators import training as TR
from versus.operators.scoring import score_batch


@pytest.fixture(scope="module")
def planted(spark):
    rng = np.random.default_rng(7)
    n = 4000
    x1 = rng.normal(size=n)
    x2 = rng.normal(size=n)
    x3 = 0.5 * x1 + rng.normal(scale=0.1, size=n)
    y = (1.5 * x1 - x2 + rng.normal(scale=0.5, size=n) > 0).astype(int)
    split = np.where(np.arange(n) % 10 < 7, "train", np.where(np.arange(n) % 10 < 9, "val", "test"))
    pdf = pd.DataFrame({"matchid": np.arange(n), "teamid": 100, "x1": x1, "x2": x2, "x3": x3,
                        "split": split, "win": y})
    return spark.createDataFrame(pdf), pdf


def test_gram_correlation_matches_numpy(spark, planted):
    df, pdf = planted
    g = SEL.gram(df, ["x1", "x2", "x3"])
    np.testing.assert_allclose(g.correlation(), np.corrcoef(pdf[["x1", "x2", "x3"]].to_numpy().T), atol=1e-10)
    np.testing.assert_allclose(g.raw, pdf[["x1", "x2", "x3"]].to_numpy().T @ pdf[["x1", "x2", "x3"]].to_numpy(),
                               rtol=1e-9)


def test_vif_uncentred_and_centred(spark, planted):
    df, pdf = planted
    X = pdf[["x1", "x2", "x3"]].to_numpy()
    g = SEL.gram(df, ["x1", "x2", "x3"])
    v = SEL.vif_scores(g)
    for i, c in enumerate(["x1", "x2", "x3"]):
        others = np.delete(X, i, axis=1)
        beta, *_ = np.linalg.lstsq(others, X[:, i], rcond=None)
        ssr = ((X[:, i] - others @ beta) ** 2).sum()
        assert v[c] == pytest.approx((X[:, i] ** 2).sum() / ssr, rel=1e-6)
    vc = SEL.vif_scores(g, centred=True)
    inv = np.linalg.inv(np.corrcoef(X.T))
    assert [vc[c] for c in ["x1", "x2", "x3"]] == pytest.approx(list(np.diag(inv)), rel=1e-6)


def test_constant_and_collinear_columns(spark):
    pdf = pd.DataFrame({"a": np.arange(50.0), "b": np.arange(50.0) * 2, "k": np.ones(50)})
    g = SEL.gram(spark.createDataFrame(pdf), ["a", "b", "k"])
    assert np.isnan(g.correlation()[2, 0])
    keep, drop = SEL.drop_high_correlation(g, 0.98)
    assert drop == ["b"] and keep == ["a", "k"]
    v = SEL.vif_scores(g)
    assert v["k"] == 1.0 and v["a"] == float("inf")


def test_pca_components(spark, planted):
    df, pdf = planted
    g = SEL.gram(df, ["x1", "x2", "x3"])
    ev = np.sort(np.linalg.eigvalsh(np.corrcoef(pdf[["x1", "x2", "x3"]].to_numpy().T)))[::-1]
    assert SEL.pca_components_95(g) == int(np.searchsorted(np.cumsum(ev / ev.sum()), 0.95) + 1)


def test_scaling_artifact_kinds(spark):
    rng = np.random.default_rng(3)
    heavy = np.concatenate([rng.normal(size=900), rng.normal(50, 1, size=100)])
    pdf = pd.DataFrame({"b": rng.integers(0, 2, 1000).astype(float), "h": heavy, "n": rng.normal(size=1000)})
    art = {r["feature"]: r for r in SEL.scaling_artifact(spark.createDataFrame(pdf), ["b", "h", "n"]).collect()}
    assert art["b"]["kind"] == "binary" and art["h"]["kind"] == "robust" and art["n"]["kind"] == "standard"
    assert art["n"]["scale"] == pytest.approx(pdf["n"].std(ddof=0))
    q1, q3 = np.quantile(heavy, [0.25, 0.75])
    assert art["h"]["scale"] == pytest.approx(q3 - q1) and art["h"]["center"] == pytest.approx(np.median(heavy))


@pytest.mark.parametrize("name", ["logistic_regression", "perceptron", "svm_linear", "xgboost"])
def test_models_learn_planted_signal(spark, planted, name):
    df, _ = planted
    res = TR.train_run(df, name, "win", features=["x1", "x2", "x3"])
    test = res.metrics.where("split = 'test'").first()
    assert test["roc_auc"] > 0.85 and test["accuracy"] > 0.75


def test_least_squares_link_quirk(spark, planted):
    df, _ = planted
    quirk = TR.train_run(df, "linear_regression_classifier", "win", features=["x1", "x2", "x3"])
    scored = quirk.model.score(df)
    assert scored.where("(margin >= 0) != (pred = 1)").count() == 0  # label 1 whenever the score >= 0
    assert quirk.metrics.where("split = 'test'").first()["roc_auc"] > 0.85
    ident = TR.train_run(df, "linear_regression_classifier", "win", features=["x1", "x2", "x3"], link="identity")
    assert ident.metrics.where("split = 'test'").first()["accuracy"] > 0.75


def test_least_squares_matches_numpy(spark, planted):
    df, pdf = planted
    m = M.fit_linear_regression_classifier(df, ["x1", "x2"], "win")
    X = np.column_stack([np.ones(len(pdf)), pdf[["x1", "x2"]].to_numpy()])
    beta = np.linalg.pinv(X) @ pdf["win"].to_numpy()
    assert m.intercept == pytest.approx(beta[0]) and list(m.coef) == pytest.approx(list(beta[1:]))


def test_save_load_and_score(spark, planted, tmp_path):
    df, _ = planted
    res = TR.train_run(df, "logistic_regression", "win", features=["x1", "x2"])
    path = str(tmp_path / "model")
    TR.save_model(spark, res.model, path, "win", "test")
    loaded = TR.load_model(spark, path)
    a = res.model.score(df, ["matchid"]).orderBy("matchid").select("score").collect()
    b = loaded.score(df, ["matchid"]).orderBy("matchid").select("score").collect()
    assert [r[0] for r in a] == pytest.approx([r[0] for r in b])
    out = score_batch(df.drop("x2"), loaded, None, ["x1", "x2"], keep=["matchid"])
    row = out.first()
    assert set(out.columns) == {"matchid", "probability", "label", "confidence", "model_version"}
    assert row["confidence"] == pytest.approx(max(row["probability"], 1 - row["probability"]))


def test_trials_are_seeded_and_in_range(spark):
    a = TR.sample_trials(spark, "random_forest", 20).collect()
    b = TR.sample_trials(spark, "random_forest", 20).collect()
    assert a == b
    assert all(100 <= r["n_estimators"] <= 800 and r["n_estimators"] % 50 == 0 for r in a)
    lr = [r["learning_rate"] for r in TR.sample_trials(spark, "xgboost", 50).collect()]
    assert all(0.001 <= v <= 0.3 for v in lr)


def test_scaling_is_fitted_on_median_filled_values(spark):
    rng = np.random.default_rng(4)
    pdf = pd.DataFrame({"s": rng.normal(3, 2, 1500), "r": rng.normal(0, 1, 1500), "b": rng.integers(0, 2, 1500).astype(float), "n": np.nan})
    pdf.loc[rng.random(1500) < 0.1, "r"] = 40.0
    for c in "srb":
        pdf.loc[rng.random(1500) < 0.25, c] = np.nan
    got = {r.feature: r for r in SEL.scaling_artifact(spark.createDataFrame(pdf), list("srbn")).collect()}
    s = pdf["s"].fillna(pdf["s"].median())
    r = pdf["r"].fillna(pdf["r"].median())
    assert (got["s"].kind, got["r"].kind, got["b"].kind, got["n"].kind) == ("standard", "robust", "binary", "standard")
    np.testing.assert_allclose([got["s"].impute, got["s"].center, got["s"].scale], [pdf["s"].median(), s.mean(), s.std(ddof=0)])
    np.testing.assert_allclose([got["r"].center, got["r"].scale], [pdf["r"].median(), r.quantile(0.75) - r.quantile(0.25)])
    assert (got["n"].impute, got["n"].scale) == (0.0, 1.0)


def test_gram_is_pairwise_with_gaps_and_tiny_scales(spark):
    rng = np.random.default_rng(8)
    pdf = pd.DataFrame(rng.normal(size=(800, 4)), columns=list("abcd"))
    pdf["b"] = pdf["a"] * 0.5 + pdf["b"]
    pdf["d"] = pdf["d"] * 1e-9 + 3e-9
    pdf.loc[rng.random(800) < 0.3, "a"] = np.nan
    pdf.loc[rng.random(800) < 0.2, "c"] = np.nan
    pdf["e"] = np.nan  # all gaps
    g = SEL.gram(spark.createDataFrame(pdf), list("abcde"))
    want = pdf.corr().to_numpy()
    got = g.correlation()
    np.testing.assert_allclose(got[:4, :4], want[:4, :4], atol=1e-9)
    assert np.isnan(got[4]).all()
    assert SEL.drop_high_correlation(g, 0.3)[1] == ["b"]


def test_vif_of_tiny_collinear_columns_and_median_fill(spark):
    rng = np.random.default_rng(9)
    x = rng.normal(size=500) * 1e-7
    pdf = pd.DataFrame({"x": x, "y": 2 * x, "k": 5.0, "z": rng.normal(size=500)})
    df = spark.createDataFrame(pdf)
    v = SEL.vif_scores(SEL.gram(df, ["x", "y", "k"]))
    assert v["x"] == v["y"] == float("inf") and v["k"] == 1.0
    pdf.loc[rng.random(500) < 0.4, "z"] = np.nan
    df = spark.createDataFrame(pdf)
    assert SEL.medians(df, ["z"])["z"] == pytest.approx(pdf["z"].median())
    filled = pdf.fillna({"z": pdf["z"].median()})[["x", "z"]].to_numpy()
    inv = np.linalg.inv(filled.T @ filled)
    want = np.diag(filled.T @ filled) * np.diag(inv)
    got = SEL.vif_scores(SEL.gram(df, ["x", "z"], fill=SEL.medians(df, ["x", "z"])))
    np.testing.assert_allclose([got["x"], got["z"]], want, rtol=1e-9)
