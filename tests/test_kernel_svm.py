"""The kernel SVM's Newton passes against the hinge loss that other solvers reach."""

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.classification import LinearSVC

from versus.operators import manyfit as MF
from versus.operators import models as M

FEATS = ["a", "b", "c"]


@pytest.fixture(scope="module")
def frame(spark):
    rng = np.random.default_rng(11)
    x = rng.normal(size=(1500, 3))
    y = (np.sin(2 * x[:, 0]) + x[:, 1] * x[:, 2] + rng.normal(size=1500) > 0).astype(int)
    pdf = pd.DataFrame(x, columns=FEATS).assign(win=y, matchid=np.arange(1500))
    return pdf, spark.createDataFrame(pdf).repartition(3)


def hinge(pdf, model, C):
    coef, intercept = model.ml_model.coefficients.toArray(), model.ml_model.intercept
    margins = {r.matchid: r.margin for r in model.score(pdf[1], ["matchid"]).collect()}
    m = np.array([margins[i] for i in pdf[0].matchid]) * np.where(pdf[0].win == 1, 1, -1)
    return np.maximum(0, 1 - m).mean() + coef @ coef / (2 * C * len(m)), intercept


@pytest.mark.parametrize("C", [1.0, 50.0])
def test_the_least_hinge_loss_in_few_passes(frame, C):
    pdf, df = frame
    model = M.fit_rbf_svm(df, FEATS, "win", C=C, gamma=0.3, n_components=40)
    svc = LinearSVC(labelCol="win", regParam=1 / (C * len(pdf)), maxIter=200, standardization=False).fit(M.fourier_vectors(df, FEATS, "win", 0.3, 40))
    other = M.FittedModel("svm_rbf", FEATS, ml_model=svc, transform=model.transform, params=model.params)
    assert hinge(frame, model, C)[0] <= hinge(frame, other, C)[0] * (1 + 2e-5)
    assert model.params["passes"] < 100


def test_a_start_from_a_sample_ends_on_all_rows(frame, monkeypatch):
    _, df = frame
    spec = MF.Spec(C=1.0, loss="hinge", gamma=0.3, n_components=40)
    rows = MF.store(df, FEATS, "win", specs=[spec])
    (whole,), _ = MF.fit_many(rows, [spec])
    asked, bends = [], MF._bends
    monkeypatch.setattr(MF, "_bends", lambda *a: asked.append([v[2] for v in a[3].values()]) or bends(*a))
    monkeypatch.setattr(MF, "SAMPLED_FROM", 100)
    (sampled,), _ = MF.fit_many(rows, [spec])
    assert asked[0] == [MF.SAMPLE] and asked[-1] == [1]
    assert np.allclose(sampled.coef, whole.coef, atol=0.02 * np.abs(whole.coef).max())


def test_no_rows_keep_the_zero_vector_and_one_class_is_fitted(spark, frame):
    pdf, df = frame
    spec = MF.Spec(C=1.0, loss="hinge", gamma=0.3, n_components=10)
    (empty,), _ = MF.fit_many(MF.store(df.where("win > 5"), FEATS, "win", specs=[spec]), [spec])
    assert not np.any(empty.coef)
    (ones,), _ = MF.fit_many(MF.store(df.where("win = 1"), FEATS, "win", specs=[spec]), [spec])
    assert ones.intercept > 0.95 and np.abs(ones.coef).max() < 0.05
