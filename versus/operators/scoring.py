"""Batch scoring with the fitted preprocessing and model (#171).

Missing raw columns become 0.0, the preprocessing artifact is applied as one
``select``, missing model columns become 0.0, then the model scores; label =
score >= threshold, confidence = max(score, 1 - score). Stateless, so the same
function serves the streaming path (``versus.streaming.scoring``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .clean import align_schema
from .models import FittedModel


def preprocess(df: DataFrame, artifact_rows: Sequence, keep: Sequence[str] = ()) -> DataFrame:
    exprs = [((F.coalesce(F.col(r["feature"]).cast("double"), F.lit(r["impute"])) - F.lit(r["center"]))
              / F.lit(r["scale"])).alias(r["feature"]) for r in artifact_rows]
    return df.select(*keep, *exprs)


def score_batch(requests: DataFrame, model: FittedModel, artifact_rows: Sequence | None = None,
                raw_columns: Sequence[str] | None = None, keep: Sequence[str] = (), version: str = "v1",
                threshold: float | None = None) -> DataFrame:
    keep = [c for c in keep if c in requests.columns]
    df = requests
    if raw_columns is not None:
        df = align_schema(df, [*keep, *[c for c in raw_columns if c not in keep]])
    if artifact_rows:
        df = preprocess(df, artifact_rows, keep)
    have = set(df.columns)
    for c in model.features:
        if c not in have:
            df = df.withColumn(c, F.lit(0.0))
    scored = model.score(df, keep=keep)
    t = model.threshold if threshold is None else threshold
    return scored.select(*keep, F.col("score").alias("probability"),
                         (F.col("score") >= t).cast("int").alias("label"),
                         F.greatest(F.col("score"), 1 - F.col("score")).alias("confidence"),
                         F.lit(version).alias("model_version"))
