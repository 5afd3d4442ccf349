"""Histogram boosting against a plain NumPy version that splits one leaf at a time."""

import numpy as np
import pandas as pd
import pytest

from versus.operators import boosting as B
from versus.operators import training as TR

FEATS = ["a", "b", "c", "d"]


def data(n, seed):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 4)).round(2)
    x[:, 3] = rng.integers(0, 3, n)
    y = (x[:, 0] + x[:, 1] * x[:, 3] + rng.normal(size=n) > 0.3).astype(int)
    x[rng.random((n, 4)) < 0.05] = np.nan
    return pd.DataFrame(x, columns=FEATS).assign(win=y, matchid=np.arange(n))


@pytest.fixture(scope="module")
def frames(spark):
    made = [data(900, 1), data(400, 2)]
    return [(pdf, spark.createDataFrame(pdf.astype(object).where(pdf.notna(), None), "a double, b double, c double, d double, win int, matchid long").repartition(3)) for pdf in made]


def plain(pdf, edges, n_trees, rate, alpha, lam, gamma, least, leaves=None, depth=None):
    """Margins of the training rows after each tree."""
    x, y = B.bin_values(pdf[FEATS].to_numpy(float), edges).astype(int), pdf.win.to_numpy(float)
    m = np.full(len(y), np.log(y.mean() / (1 - y.mean())))
    pull = lambda g, h: max(abs(g) - alpha, 0) ** 2 / (h + lam) if h + lam > 0 else 0.0
    out = []

    def best(rows, level, g, h):
        if depth and level >= depth:
            return None
        found = None
        for missing_left in (True, False):
            for j in range(x.shape[1]):
                for cut in range(1, x[:, j].max() + 1):
                    b = x[rows, j]
                    left = rows[np.where(b == 0, missing_left, b <= cut)]
                    right = np.setdiff1d(rows, left)
                    if min(len(left), len(right)) < least:
                        continue
                    gain = 0.5 * (pull(g[left].sum(), h[left].sum()) + pull(g[right].sum(), h[right].sum()) - pull(g[rows].sum(), h[rows].sum())) - gamma
                    if gain > 1e-10 and (found is None or gain > found[0] + 1e-9):
                        found = (gain, left, right)
        return found

    for _ in range(n_trees):
        p = 1 / (1 + np.exp(-m))
        g, h = p - y, p * (1 - p)
        tree = [(np.arange(len(y)), 0)]
        splits = [best(*tree[0], g, h)]
        while (not leaves or len(tree) < leaves) and any(splits):
            i = max((i for i, s in enumerate(splits) if s), key=lambda i: splits[i][0])
            (_, left, right), level = splits[i], tree[i][1] + 1
            tree[i:i + 1] = [(left, level), (right, level)]
            splits[i:i + 1] = [best(left, level, g, h), best(right, level, g, h)]
        m = m.copy()
        for rows, _ in tree:
            gs = g[rows].sum()
            m[rows] += -rate * np.sign(gs) * max(abs(gs) - alpha, 0) / (h[rows].sum() + lam)
        out.append(m)
    return out


@pytest.mark.parametrize("shape", [dict(num_leaves=6), dict(max_depth=3), dict(num_leaves=5, max_depth=2)])
def test_equals_plain_version(frames, shape):
    pdf, df = frames[0]
    model = B.fit_boosted(df, FEATS, "win", n_estimators=3, learning_rate=0.3, reg_alpha=0.4, reg_lambda=1.5, gamma=0.05, min_child_samples=10, max_bins=12, **shape)
    want = plain(pdf, model.edges, 3, 0.3, 0.4, 1.5, 0.05, 10, shape.get("num_leaves"), shape.get("max_depth"))[-1]
    got = {r.matchid: r.margin for r in model.score(df, ["matchid"]).collect()}
    assert np.allclose([got[i] for i in pdf.matchid], want, atol=1e-9)
    if "num_leaves" in shape:
        assert max(sum(f < 0 for f in t.feature) for t in model.trees) == min(shape["num_leaves"], 4 if shape.get("max_depth") == 2 else 99)


def test_partial_histograms_added_by_spark(frames, monkeypatch):
    pdf, df = frames[0]
    one = B.fit_boosted(df, FEATS, "win", n_estimators=2, num_leaves=6, max_bins=12, reg_lambda=1.0)
    monkeypatch.setattr(B, "ROWS_PER_PART", 300)
    monkeypatch.setattr(B, "DRIVER_PARTS", 0)
    monkeypatch.setattr(B, "FEATURE_BLOCK", 3)
    monkeypatch.setattr(B, "REFRESH", 1)
    many = B.fit_boosted(df, FEATS, "win", n_estimators=2, num_leaves=6, max_bins=12, reg_lambda=1.0)
    assert [t.feature for t in one.trees] == [t.feature for t in many.trees]
    assert np.allclose(one.margins(pdf[FEATS].to_numpy(float)), many.margins(pdf[FEATS].to_numpy(float)))


def test_patience_and_penalties_act(frames):
    (pdf, df), (vpdf, val) = frames
    shape = dict(learning_rate=0.5, num_leaves=8, max_bins=16)
    model = B.fit_boosted(df, FEATS, "win", val, n_estimators=40, early_stopping_rounds=4, **shape)
    losses = model.params["val_losses"]
    assert model.params["trees"] == int(np.argmin(losses)) < model.params["grown"] < 40
    assert model.params["grown"] == model.params["trees"] + 4
    p = 1 / (1 + np.exp(-model.margins(vpdf[FEATS].to_numpy(float))))
    assert np.isclose(min(losses), -np.mean(np.log(np.where(vpdf.win == 1, p, 1 - p))))
    size = [np.mean([abs(v) for t in B.fit_boosted(df, FEATS, "win", n_estimators=2, **shape, **kw).trees for v in t.value])
            for kw in ({}, {"reg_lambda": 20.0}, {"reg_alpha": 20.0})]
    assert size[0] > size[1] and size[0] > size[2]


def test_rows_are_drawn_by_tree_and_reruns_agree(frames):
    pdf, df = frames[0]
    kw = dict(n_estimators=3, num_leaves=5, max_bins=12, subsample=0.5, colsample_bytree=0.5)
    a, b = (B.fit_boosted(f, FEATS, "win", **kw) for f in (df, df.repartition(7)))
    assert [vars(t)["feature"] for t in a.trees] == [vars(t)["feature"] for t in b.trees]
    assert np.allclose(a.margins(pdf[FEATS].to_numpy(float)), b.margins(pdf[FEATS].to_numpy(float)))
    keys = np.arange(20_000, dtype=np.int64) * 7919
    u = np.column_stack([B._unit(keys, t, 42) for t in range(3)])
    assert abs(u.mean() - 0.5) < 0.01 and abs(np.corrcoef(u.T) - np.eye(3)).max() < 0.03


def test_saved_and_loaded(spark, frames, tmp_path):
    pdf, df = frames[0]
    model = B.fit_boosted(df, FEATS, "win", n_estimators=2, num_leaves=4, name="lightgbm")
    TR.save_model(spark, model, str(tmp_path / "m"), "win", "postgame")
    back = TR.load_model(spark, str(tmp_path / "m"))
    assert np.array_equal(back.margins(pdf[FEATS].to_numpy(float)), model.margins(pdf[FEATS].to_numpy(float)))
    assert back.importances() == model.importances() and abs(sum(v for _, v in model.importances()) - 1) < 1e-9
