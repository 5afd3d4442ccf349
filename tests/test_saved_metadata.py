"""What a saved model's metadata tells."""

import json

import numpy as np
import pandas as pd
import pytest

from versus.operators import training as TR
from versus.plans import catalog_pipeline


def test_a_saved_model_keeps_its_features_and_metrics(spark, monkeypatch):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(400, 2))
    pdf = pd.DataFrame({"matchid": np.arange(400), "teamid": 100, "split": np.where(np.arange(400) % 4 == 0, "test", "train"), "a": x[:, 0], "b": x[:, 1],
                        "win": (x[:, 0] + 0.3 * rng.normal(size=400) > 0).astype(int)})
    frame = spark.createDataFrame(pdf)
    monkeypatch.setattr(catalog_pipeline, "processed", lambda spark, sf: (frame,))
    (row,) = catalog_pipeline.q_save_model(spark, "unused").collect()
    assert (row.model, row.features, row.feature_columns, row.target, row.scope) == ("perceptron", 2, ["a", "b"], "win", "postgame")
    want = {r.split: r.asDict() for r in TR.train_run(frame, "perceptron", "win").metrics.collect()}
    kept = json.loads(row.metrics)
    assert kept.keys() == want.keys() == {"train", "test"}
    for split, values in kept.items():
        assert set(values) == set(TR.METRICS)
        for m, v in values.items():
            assert v == pytest.approx(want[split][m], rel=1e-9)
