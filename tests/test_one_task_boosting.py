"""Boosting inside one task against boosting by passes."""

import numpy as np
import pandas as pd
import pytest

from versus.operators import boosting as B

FEATS = ["a", "b", "c", "d"]


@pytest.fixture(scope="module")
def frames(spark):
    out = []
    for n, seed in ((1500, 1), (500, 2)):
        rng = np.random.default_rng(seed)
        x = rng.normal(size=(n, 4)).round(2)
        y = (x[:, 0] + x[:, 1] * x[:, 2] + rng.normal(size=n) > 0.3).astype(int)
        x[rng.random((n, 4)) < 0.05] = np.nan
        pdf = pd.DataFrame(x, columns=FEATS).assign(win=y, matchid=np.arange(n))
        out.append(spark.createDataFrame(pdf.astype(object).where(pdf.notna(), None), "a double, b double, c double, d double, win int, matchid long").repartition(3))
    return out


@pytest.mark.parametrize("shape", [dict(num_leaves=7, min_child_samples=5), dict(max_depth=4, reg_lambda=1.0)])
def test_the_trees_of_one_task_are_those_of_passes(frames, monkeypatch, shape):
    df, val = frames
    kw = dict(n_estimators=6, early_stopping_rounds=6, subsample=0.8, colsample_bytree=0.8, max_bins=16, **shape)
    passes, scan = [], B._histograms
    monkeypatch.setattr(B, "_histograms", lambda *a: passes.append(1) or scan(*a))
    alone = B.fit_boosted(df, FEATS, "win", val, **kw)
    assert not passes
    monkeypatch.setattr(B, "ROWS_PER_CORE", 100)
    many = B.fit_boosted(df, FEATS, "win", val, **kw)
    assert not passes
    monkeypatch.setattr(B, "ONE_TASK_BYTES", 0)
    by_passes = B.fit_boosted(df, FEATS, "win", val, **kw)
    assert len(passes) > 6
    for other in (many, by_passes):
        assert [(t.feature, t.bin, t.missing_left, t.left, t.right) for t in alone.trees] == [(t.feature, t.bin, t.missing_left, t.left, t.right) for t in other.trees]
        assert np.allclose(alone.params["val_losses"], other.params["val_losses"], atol=1e-12) and np.allclose(alone.gains, other.gains)
        for s, t in zip(alone.trees, other.trees):
            assert np.allclose(s.value, t.value, atol=1e-12)


def test_a_task_that_fails_leaves_no_process(spark, frames, monkeypatch):
    import multiprocessing
    df, _ = frames
    x, y = np.zeros((200, 2), np.uint8), np.arange(200) % 2.0
    crew = B._Crew(2, [(x, y, np.ones(200), np.arange(200), np.zeros(200, bool), np.zeros(200))], 3)
    assert len(multiprocessing.active_children()) >= 3
    (h, loss), *rest = crew.ask("root", np.arange(2), 4, 0, 1.0, 42)
    assert h.shape == (2, 4, 3) and len(rest) == 2 and sum(g[0][0, 0, 2] for g in [(h, loss), *rest]) == 200
    staff = crew.staff
    crew.close()
    assert not any(p.is_alive() for p in staff)
