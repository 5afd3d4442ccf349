"""Models fitted side by side against models fitted alone."""

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.classification import LinearSVC

from versus.operators import manyfit as MF
from versus.operators import models as M
from versus.operators import training as TR

FEATS = ["a", "b", "c"]


@pytest.fixture(scope="module")
def frame(spark):
    rng = np.random.default_rng(4)
    n = 2000
    x = rng.normal(size=(n, 3))
    y = (x[:, 0] - 0.7 * x[:, 1] + 0.5 * x[:, 0] * x[:, 2] + rng.normal(size=n) > 0.4).astype(int)
    pdf = pd.DataFrame(x, columns=FEATS).assign(win=y, matchid=np.arange(n) // 2, teamid=np.where(np.arange(n) % 2, 200, 100))
    pdf["split"] = np.where(np.arange(n) % 10 < 7, "train", np.where(np.arange(n) % 10 == 7, "val", "test"))
    return pdf, spark.createDataFrame(pdf).repartition(4)


def test_logistic_models_equal_single_fits(frame):
    _, df = frame
    cs = [0.01, 10.0]
    models, passes = MF.fit_many(MF.store(df, FEATS, "win"), [MF.Spec(C=c, balanced=True) for c in cs], tol=1e-10)
    for c, m in zip(cs, models):
        single = M.fit_logistic_regression(df, FEATS, "win", C=c).ml_model
        assert np.allclose(m.coef, single.coefficients.toArray(), atol=2e-4)
        assert m.intercept == pytest.approx(single.intercept, abs=2e-4)


def hinge(pdf, coef, intercept, C):
    s = np.where(pdf.win == 1, 1, -1)
    return np.maximum(0, 1 - s * (pdf[FEATS].to_numpy() @ coef + intercept)).mean() + coef @ coef / (2 * C * len(pdf))


def test_hinge_models_reach_the_single_fit(frame):
    pdf, df = frame
    cs = [1.0]
    models, _ = MF.fit_many(MF.store(df, FEATS, "win"), [MF.Spec(C=c, loss="hinge") for c in cs])
    for c, m in zip(cs, models):
        svc = LinearSVC(labelCol="win", regParam=1 / (c * len(pdf)), maxIter=60, standardization=False).fit(M._assembled(df, FEATS))
        assert hinge(pdf, m.coef, m.intercept, c) <= hinge(pdf, svc.coefficients.toArray(), svc.intercept, c) * 1.005


def test_thirty_trials_cost_as_many_scans_as_the_slowest(spark, frame):
    _, df = frame
    trials = TR.sample_trials(spark, "svm_linear", 30).orderBy("trial").collect()
    rows = MF.store(df, FEATS, "win")
    specs = [MF.Spec(C=t["C"], loss="hinge") for t in trials]
    _, many = MF.fit_many(rows, specs)
    alone = [MF.fit_many(rows, [s])[1] for s in specs[:3]]
    assert many <= 3 * max(alone)


def test_samples_and_fourier_features(frame, monkeypatch):
    pdf, df = frame
    order = np.random.default_rng(1).permutation(len(pdf))
    ranked = df.sparkSession.createDataFrame(pdf.assign(rank=order)).repartition(3)
    specs = [MF.Spec(limit=400), MF.Spec(), MF.Spec(loss="hinge", gamma=0.3, n_components=20)]
    rows = MF.store(ranked, FEATS, "win", rank=MF.F.col("rank"))
    models, _ = MF.fit_many(rows, specs, tol=1e-10)
    small = M.fit_logistic_regression(ranked.where("rank < 400"), FEATS, "win", class_weight=None).ml_model
    assert np.allclose(models[0].coef, small.coefficients.toArray(), atol=1e-3)
    scored = models[2].score(ranked, ["matchid", "teamid", "win"]).toPandas()
    ours = MF.scores(ranked, rows, specs, models, "win").where("model = 2").toPandas()
    assert np.allclose(np.sort(scored.score), np.sort(ours.score))
    wrong = MF.errors(rows, specs, models)[2]
    assert wrong == (len(pdf), float((scored.pred != scored.win).sum()), 0.0, 0.0)
    # partial sums added by Spark
    monkeypatch.setattr(MF, "DRIVER_PARTS", 0)
    again, _ = MF.fit_many(rows, specs[:1], tol=1e-10)
    assert np.allclose(again[0].coef, models[0].coef)


def test_trial_objectives_equal_single_trials(spark, frame):
    _, df = frame
    trials = [{"trial": 4, "C": 0.01}]
    got = {r.trial: r.value for r in TR.trial_objectives(df, "svm_linear", trials).collect()}
    for t in trials:
        assert got[t["trial"]] == pytest.approx(TR.holdout_objective(df, "svm_linear", {"C": t["C"]}), abs=0.01)


def test_search_resumes_from_its_log(spark, frame, tmp_path, monkeypatch):
    _, df = frame
    monkeypatch.setitem(TR.SEARCH_SPACES, "logistic_regression", {"C": ("float", 0.01, 100.0, None, True)})
    first = TR.tuning_run(df, "logistic_regression", 2, log_path=str(tmp_path / "log"))
    more = TR.tuning_run(df, "logistic_regression", 4, log_path=str(tmp_path / "log"))
    assert (first["trials"], more["trials"]) == (2, 4) and more["best_value"] >= first["best_value"]
    assert sorted(r.trial for r in spark.read.parquet(str(tmp_path / "log")).collect()) == [0, 1, 2, 3]


def test_learning_curve_equals_single_fits(frame):
    _, df = frame
    got = TR.learning_curve(df, "logistic_regression", fractions=(0.05, 0.5, 1.0)).orderBy("fraction").collect()
    assert [r.rows for r in got] == [70, 700, 1400]
    model = TR.train_run(df, "logistic_regression").model
    val = model.score(df.where("split = 'val'"), ["win"])
    assert got[-1].val_error == pytest.approx(val.where("pred <> win").count() / val.count(), abs=0.01)
