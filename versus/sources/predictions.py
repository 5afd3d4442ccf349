"""Prediction frames derived from the driver's ``events`` table.

Label: the event is a purchase. Three deterministic scorers give a long
``(model, event_id, label, score, pred)`` frame; every score is plain IEEE
arithmetic on stored values, so Spark and the SQL oracle agree bit for bit.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .fixture import read_table

# fixed values: scorer definitions (also written as SQL in PREDICTIONS_SQL)
MODELS = ("value_ratio", "user_blend", "user_parity")


def predictions(spark: SparkSession, sf_dir: str, threshold: float = 0.5) -> DataFrame:
    ev = read_table(spark, sf_dir, "events").select(
        "event_id", "user_id", "value", (F.col("event_type") == "purchase").cast("int").alias("label"))
    ratio = F.col("value") / (F.col("value") + 50.0)
    scores = F.array(
        F.struct(F.lit("value_ratio").alias("model"), ratio.alias("score")),
        F.struct(F.lit("user_blend").alias("model"),
                 ((F.col("user_id") % 7).cast("double") / 7.0 + ratio / 7.0).alias("score")),
        F.struct(F.lit("user_parity").alias("model"),
                 F.when(F.col("user_id") % 2 == 0, F.lit(0.3)).otherwise(F.lit(0.7)).alias("score")))
    long = ev.select("event_id", "label", F.explode(scores).alias("m")).select(
        "m.model", "event_id", "label", "m.score")
    return long.withColumn("pred", (F.col("score") >= threshold).cast("int"))


PREDICTIONS_SQL = """, ev AS (
  SELECT event_id, user_id, value, CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END AS label FROM events),
predictions0 AS (
  SELECT 'value_ratio' AS model, event_id, label, value / (value + 50.0) AS score FROM ev
  UNION ALL
  SELECT 'user_blend', event_id, label, CAST(user_id % 7 AS DOUBLE) / 7.0 + (value / (value + 50.0)) / 7.0 FROM ev
  UNION ALL
  SELECT 'user_parity', event_id, label, CASE WHEN user_id % 2 = 0 THEN 0.3 ELSE 0.7 END FROM ev),
predictions AS (
  SELECT model, event_id, label, CAST(score AS DOUBLE) AS score,
         CASE WHEN score >= 0.5 THEN 1 ELSE 0 END AS pred FROM predictions0)"""
