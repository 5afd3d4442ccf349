"""Queries: evaluation metrics, curves, tests and model/run comparison."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import evaluate as EV
from ..operators import reshape as RS
from ..operators import windows as W
from ..sources.predictions import PREDICTIONS_SQL, predictions
from .common import rnd, round_doubles
from .registry import query

G = ["model"]

CLIP = "GREATEST(LEAST(score, CAST(1 AS DOUBLE) - CAST(1e-15 AS DOUBLE)), CAST(1e-15 AS DOUBLE))"

CUM_SQL = PREDICTIONS_SQL + f"""
, sc AS (SELECT model, {CLIP} AS s, CAST(SUM(label) AS DOUBLE) AS pos, CAST(SUM(1 - label) AS DOUBLE) AS neg
         FROM predictions GROUP BY model, {CLIP}),
cum AS (SELECT sc.*,
          SUM(pos) OVER (PARTITION BY model ORDER BY s DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum_pos,
          SUM(neg) OVER (PARTITION BY model ORDER BY s DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum_neg,
          SUM(pos) OVER (PARTITION BY model) AS tot_pos, SUM(neg) OVER (PARTITION BY model) AS tot_neg
        FROM sc),
ranks AS (SELECT model,
          SUM(pos * (tot_neg - cum_neg + 0.5 * neg)) / (MAX(tot_pos) * MAX(tot_neg)) AS roc_auc,
          SUM(pos * cum_pos / (cum_pos + cum_neg)) / MAX(tot_pos) AS pr_auc
        FROM cum GROUP BY model)"""

COUNT_SQL = f"""
, counting AS (SELECT model,
    SUM(CASE WHEN label = pred THEN 1.0 ELSE 0.0 END) / COUNT(*) AS accuracy,
    CASE WHEN SUM(pred) = 0 THEN 0.0 ELSE CAST(SUM(label * pred) AS DOUBLE) / SUM(pred) END AS precision,
    CASE WHEN SUM(label) = 0 THEN 0.0 ELSE CAST(SUM(label * pred) AS DOUBLE) / SUM(label) END AS recall,
    CASE WHEN SUM(label) + SUM(pred) = 0 THEN 0.0 ELSE CAST(2 * SUM(label * pred) AS DOUBLE) / (SUM(label) + SUM(pred)) END AS f1,
    AVG(({CLIP} - label) * ({CLIP} - label)) AS brier_score,
    -AVG(label * LN({CLIP}) + (1 - label) * LN(1 - {CLIP})) AS log_loss
  FROM predictions GROUP BY model)"""

_METRICS = ["accuracy", "precision", "recall", "f1", "brier_score", "log_loss", "roc_auc", "pr_auc"]


def _preds(spark, sf):
    return predictions(spark, sf)


@query("classification_metrics", "WITH " + (CUM_SQL + COUNT_SQL).lstrip(", ") + f"""
SELECT c.model, {", ".join(rnd(m) + " AS " + m for m in _METRICS)}
FROM counting c JOIN ranks r ON c.model = r.model""")
def q_classification_metrics(spark, sf):
    return round_doubles(EV.classification_metrics(_preds(spark, sf), group=G))


@query("roc_auc", "WITH " + CUM_SQL.lstrip(", ") + f"\nSELECT model, {rnd('roc_auc')} AS roc_auc FROM ranks")
def q_roc_auc(spark, sf):
    return round_doubles(EV.rank_metrics(_preds(spark, sf), group=G).select("model", "roc_auc"))


@query("average_precision", "WITH " + CUM_SQL.lstrip(", ") + f"\nSELECT model, {rnd('pr_auc')} AS pr_auc FROM ranks")
def q_average_precision(spark, sf):
    return round_doubles(EV.rank_metrics(_preds(spark, sf), group=G).select("model", "pr_auc"))


@query("brier_score", "WITH " + (PREDICTIONS_SQL + COUNT_SQL).lstrip(", ") +
       f"\nSELECT model, {rnd('brier_score')} AS brier_score FROM counting")
def q_brier_score(spark, sf):
    return round_doubles(EV.counting_metrics(_preds(spark, sf), group=G).select("model", "brier_score"))


@query("log_loss", "WITH " + (PREDICTIONS_SQL + COUNT_SQL).lstrip(", ") +
       f"\nSELECT model, {rnd('log_loss')} AS log_loss FROM counting")
def q_log_loss(spark, sf):
    return round_doubles(EV.counting_metrics(_preds(spark, sf), group=G).select("model", "log_loss"))


@query("confusion_matrix", "WITH " + PREDICTIONS_SQL.lstrip(", ") + """
SELECT model, CAST(SUM(CASE WHEN label = 0 AND pred = 0 THEN 1 ELSE 0 END) AS BIGINT) AS tn,
       CAST(SUM(CASE WHEN label = 0 AND pred = 1 THEN 1 ELSE 0 END) AS BIGINT) AS fp,
       CAST(SUM(CASE WHEN label = 1 AND pred = 0 THEN 1 ELSE 0 END) AS BIGINT) AS fn,
       CAST(SUM(CASE WHEN label = 1 AND pred = 1 THEN 1 ELSE 0 END) AS BIGINT) AS tp
FROM predictions GROUP BY model""")
def q_confusion_matrix(spark, sf):
    return EV.confusion_counts(_preds(spark, sf), group=G)


@query("roc_curve", "WITH " + CUM_SQL.lstrip(", ") + f"""
SELECT model, {rnd('s')} AS threshold, {rnd('cum_neg / tot_neg')} AS fpr, {rnd('cum_pos / tot_pos')} AS tpr,
       {rnd('(cum_neg / tot_neg - (cum_neg - neg) / tot_neg) * (cum_pos / tot_pos + (cum_pos - pos) / tot_pos) / 2')} AS area_piece
FROM cum""")
def q_roc_curve(spark, sf):
    return round_doubles(EV.roc_curve(_preds(spark, sf), group=G))


_PREC0 = "CASE WHEN (cum_pos - pos) + (cum_neg - neg) > 0 THEN (cum_pos - pos) / ((cum_pos - pos) + (cum_neg - neg)) ELSE 1.0 END"


@query("pr_curve", "WITH " + CUM_SQL.lstrip(", ") + f"""
SELECT model, {rnd('s')} AS threshold, {rnd('cum_pos / (cum_pos + cum_neg)')} AS precision,
       {rnd('cum_pos / tot_pos')} AS recall,
       {rnd(f'(cum_pos / tot_pos - (cum_pos - pos) / tot_pos) * (cum_pos / (cum_pos + cum_neg) + {_PREC0}) / 2')} AS area_piece,
       {rnd('tot_pos / (tot_pos + tot_neg)')} AS base_rate
FROM cum""")
def q_pr_curve(spark, sf):
    return round_doubles(EV.pr_curve(_preds(spark, sf), group=G))


@query("curve_area", "WITH " + CUM_SQL.lstrip(", ") + f"""
SELECT model, {rnd('SUM((cum_neg / tot_neg - (cum_neg - neg) / tot_neg) * (cum_pos / tot_pos + (cum_pos - pos) / tot_pos) / 2)')} AS area
FROM cum GROUP BY model""")
def q_curve_area(spark, sf):
    """Trapezoid area under the ROC curve (#142)."""
    return round_doubles(EV.curve_area(EV.roc_curve(_preds(spark, sf), group=G), G))


_EDGES = " + ".join(f"CASE WHEN score > {e!r} THEN 1 ELSE 0 END" for e in EV.CALIBRATION_EDGES)


@query("calibration_curve", "WITH " + PREDICTIONS_SQL.lstrip(", ") + f"""
SELECT model, CAST({_EDGES} AS INTEGER) AS bin, {rnd('AVG(score)')} AS prob_pred,
       {rnd('AVG(CAST(label AS DOUBLE))')} AS prob_true, CAST(COUNT(*) AS BIGINT) AS n
FROM predictions GROUP BY model, {_EDGES}""")
def q_calibration_curve(spark, sf):
    return round_doubles(EV.calibration_curve(_preds(spark, sf), group=G))


MCNEMAR_SQL = "WITH " + PREDICTIONS_SQL.lstrip(", ") + """
, pair AS (SELECT a.event_id, a.label, a.pred AS pred1, b.pred AS pred2
           FROM predictions a JOIN predictions b ON a.event_id = b.event_id
           WHERE a.model = 'value_ratio' AND b.model = 'user_parity'),
t AS (SELECT CAST(SUM(CASE WHEN pred1 = label AND pred2 = label THEN 1 ELSE 0 END) AS BIGINT) AS both_correct,
             CAST(SUM(CASE WHEN pred1 = label AND pred2 <> label THEN 1 ELSE 0 END) AS BIGINT) AS first_only,
             CAST(SUM(CASE WHEN pred1 <> label AND pred2 = label THEN 1 ELSE 0 END) AS BIGINT) AS second_only,
             CAST(SUM(CASE WHEN pred1 <> label AND pred2 <> label THEN 1 ELSE 0 END) AS BIGINT) AS both_wrong FROM pair)
SELECT *, ROUND(CASE WHEN first_only + second_only > 0 THEN
   POWER(ABS(CAST(first_only AS DOUBLE) - second_only) - 1, 2) / (first_only + second_only) END, 6) AS statistic FROM t"""


def _paired(spark, sf):
    p = _preds(spark, sf)
    a = p.where(F.col("model") == "value_ratio").select("event_id", "label", F.col("pred").alias("pred1"))
    b = p.where(F.col("model") == "user_parity").select("event_id", F.col("pred").alias("pred2"))
    return a.join(b, "event_id")


@query("mcnemar", MCNEMAR_SQL)
def q_mcnemar(spark, sf):
    return round_doubles(EV.mcnemar(_paired(spark, sf), "label", "pred1", "pred2"))


@query("mcnemar_pvalue")
def q_mcnemar_pvalue(spark, sf):
    """Adds the chi-square p-value (rows-only check: no erfc in SQL)."""
    return EV.with_mcnemar_pvalue(EV.mcnemar(_paired(spark, sf), "label", "pred1", "pred2"))


ERR_SQL = """
SELECT model, CAST(SUM(CASE WHEN label = 0 AND pred = 1 THEN 1 ELSE 0 END) AS BIGINT) AS false_positives,
       CAST(SUM(CASE WHEN label = 1 AND pred = 0 THEN 1 ELSE 0 END) AS BIGINT) AS false_negatives,
       CAST(SUM(CASE WHEN label <> pred THEN 1 ELSE 0 END) AS BIGINT) AS total_errors,
       ROUND(CAST(SUM(CASE WHEN label <> pred THEN 1 ELSE 0 END) AS DOUBLE) / COUNT(*), 6) AS error_rate"""


@query("error_ranking", "WITH " + PREDICTIONS_SQL.lstrip(", ") + ERR_SQL +
       " FROM predictions GROUP BY model ORDER BY total_errors DESC")
def q_error_ranking(spark, sf):
    return round_doubles(EV.error_counts(_preds(spark, sf))).orderBy(F.col("total_errors").desc())


SPLIT_OF_EVENT = "CASE WHEN ('0x' || SUBSTR(MD5(CAST(event_id AS VARCHAR) || ':42'), 1, 8))::BIGINT / 4294967296.0 < 0.5 THEN 'in_sample' ELSE 'out_of_sample' END"


def _event_split():
    h = F.conv(F.substring(F.md5(F.concat(F.col("event_id").cast("string"), F.lit(":42"))), 1, 8), 16, 10)
    return F.when(h.cast("bigint") / 4294967296.0 < 0.5, "in_sample").otherwise("out_of_sample")


@query("error_analysis", "WITH " + PREDICTIONS_SQL.lstrip(", ") + f"""
SELECT model, {SPLIT_OF_EVENT} AS sample, ROUND(1 - SUM(CASE WHEN label = pred THEN 1.0 ELSE 0.0 END) / COUNT(*), 6) AS error
FROM predictions GROUP BY model, {SPLIT_OF_EVENT}""")
def q_error_analysis(spark, sf):
    """1 - accuracy in and out of sample per model (#146)."""
    p = _preds(spark, sf).withColumn("sample", _event_split())
    m = EV.counting_metrics(p, score=None, group=["model", "sample"])
    return round_doubles(m.select("model", "sample", (1 - F.col("accuracy")).alias("error")))


@query("model_comparison", "WITH " + (CUM_SQL + COUNT_SQL).lstrip(", ") + f"""
SELECT c.model, {", ".join(rnd(m) + " AS " + m for m in _METRICS)}
FROM counting c JOIN ranks r ON c.model = r.model ORDER BY roc_auc DESC""")
def q_model_comparison(spark, sf):
    """One metric row per model sorted by roc_auc (#147)."""
    return round_doubles(EV.classification_metrics(_preds(spark, sf), group=G)).orderBy(F.col("roc_auc").desc())


@query("champion_selection", "WITH " + (CUM_SQL + COUNT_SQL).lstrip(", ") + f"""
SELECT c.model, {rnd('r.roc_auc')} AS roc_auc, {rnd('c.accuracy')} AS accuracy, {rnd('c.f1')} AS f1
FROM counting c JOIN ranks r ON c.model = r.model
ORDER BY r.roc_auc DESC, c.accuracy DESC, c.f1 DESC LIMIT 1""")
def q_champion_selection(spark, sf):
    """Best model by (roc_auc, accuracy, f1) (#149)."""
    m = EV.classification_metrics(_preds(spark, sf), group=G)
    best = m.orderBy(F.col("roc_auc").desc_nulls_last(), F.col("accuracy").desc(), F.col("f1").desc()).limit(1)
    return round_doubles(best.select("model", "roc_auc", "accuracy", "f1"))


# ---------------------------------------------------------------- run tables
FOLD_SQL = "CAST((('0x' || SUBSTR(MD5(CAST(event_id AS VARCHAR) || ':fold'), 1, 8))::BIGINT % 5) AS INTEGER)"


def _fold():
    h = F.conv(F.substring(F.md5(F.concat(F.col("event_id").cast("string"), F.lit(":fold"))), 1, 8), 16, 10)
    return (h.cast("bigint") % 5).cast("int")


def runs_frame(spark, sf):
    """One evaluation run per (model, fold): fold = md5 bucket of the event id."""
    p = _preds(spark, sf).withColumn("fold", _fold())
    m = EV.classification_metrics(p, group=["model", "fold"])
    return round_doubles(m.select(
        F.concat_ws("-", "model", F.col("fold").cast("string")).alias("run_id"), "model", "fold",
        (F.col("fold") >= 3).cast("int").alias("is_tuned"), F.col("fold").cast("bigint").alias("updated_at"),
        *_METRICS))


RUNS_SQL = "WITH " + PREDICTIONS_SQL.lstrip(", ") + f"""
, pf AS (SELECT predictions.*, {FOLD_SQL} AS fold FROM predictions),
sc AS (SELECT model, fold, {CLIP} AS s, CAST(SUM(label) AS DOUBLE) AS pos, CAST(SUM(1 - label) AS DOUBLE) AS neg
       FROM pf GROUP BY model, fold, {CLIP}),
cum AS (SELECT sc.*,
          SUM(pos) OVER (PARTITION BY model, fold ORDER BY s DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum_pos,
          SUM(neg) OVER (PARTITION BY model, fold ORDER BY s DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum_neg,
          SUM(pos) OVER (PARTITION BY model, fold) AS tot_pos, SUM(neg) OVER (PARTITION BY model, fold) AS tot_neg
        FROM sc),
ranks AS (SELECT model, fold,
          SUM(pos * (tot_neg - cum_neg + 0.5 * neg)) / (MAX(tot_pos) * MAX(tot_neg)) AS roc_auc,
          SUM(pos * cum_pos / (cum_pos + cum_neg)) / MAX(tot_pos) AS pr_auc
        FROM cum GROUP BY model, fold),
counting AS (SELECT model, fold,
    SUM(CASE WHEN label = pred THEN 1.0 ELSE 0.0 END) / COUNT(*) AS accuracy,
    CASE WHEN SUM(pred) = 0 THEN 0.0 ELSE CAST(SUM(label * pred) AS DOUBLE) / SUM(pred) END AS precision,
    CASE WHEN SUM(label) = 0 THEN 0.0 ELSE CAST(SUM(label * pred) AS DOUBLE) / SUM(label) END AS recall,
    CASE WHEN SUM(label) + SUM(pred) = 0 THEN 0.0 ELSE CAST(2 * SUM(label * pred) AS DOUBLE) / (SUM(label) + SUM(pred)) END AS f1,
    AVG(({CLIP} - label) * ({CLIP} - label)) AS brier_score,
    -AVG(label * LN({CLIP}) + (1 - label) * LN(1 - {CLIP})) AS log_loss
  FROM pf GROUP BY model, fold),
runs AS (SELECT c.model || '-' || CAST(c.fold AS VARCHAR) AS run_id, c.model, c.fold,
                CASE WHEN c.fold >= 3 THEN 1 ELSE 0 END AS is_tuned, CAST(c.fold AS BIGINT) AS updated_at,
                {", ".join(rnd(m) + " AS " + m for m in _METRICS)}
         FROM counting c JOIN ranks r ON c.model = r.model AND c.fold = r.fold)"""

_RUN_COLS = "run_id, model, fold, is_tuned, updated_at, " + ", ".join(_METRICS)


@query("best_run_per_model", RUNS_SQL + f"""
SELECT {_RUN_COLS} FROM (SELECT runs.*, ROW_NUMBER() OVER (PARTITION BY model
   ORDER BY roc_auc DESC NULLS LAST, accuracy DESC NULLS LAST, f1 DESC NULLS LAST, run_id) AS r FROM runs) x WHERE r = 1""")
def q_best_run_per_model(spark, sf):
    return W.best_run_per_model(runs_frame(spark, sf))


@query("latest_run", RUNS_SQL + f"""
SELECT {_RUN_COLS} FROM (SELECT runs.*, ROW_NUMBER() OVER (PARTITION BY model
   ORDER BY updated_at DESC, run_id DESC) AS r FROM runs) x WHERE r = 1""")
def q_latest_run(spark, sf):
    out = W.latest_run(runs_frame(spark, sf), group_col="model")
    return out.select(*_RUN_COLS.split(", "))


@query("preferred_run", RUNS_SQL + f"""
SELECT {_RUN_COLS} FROM (SELECT runs.*, ROW_NUMBER() OVER (PARTITION BY model
   ORDER BY is_tuned DESC NULLS LAST, roc_auc DESC NULLS LAST, updated_at DESC NULLS LAST, run_id) AS r FROM runs) x WHERE r = 1""")
def q_preferred_run(spark, sf):
    return W.preferred_run(runs_frame(spark, sf))


@query("melt_metrics", RUNS_SQL + """
SELECT run_id, metric, value FROM runs UNPIVOT (value FOR metric IN (""" + ", ".join(_METRICS) + "))")
def q_melt_metrics(spark, sf):
    """Wide run metrics -> (run_id, metric, value) (#70)."""
    return RS.melt(runs_frame(spark, sf), ["run_id"], _METRICS, "metric", "value")


@query("pivot_metrics", RUNS_SQL + """
, long AS (SELECT run_id, metric, value FROM runs UNPIVOT (value FOR metric IN (""" + ", ".join(_METRICS) + """)))
SELECT run_id, """ + ", ".join(f"MAX(CASE WHEN metric = '{m}' THEN value END) AS {m}" for m in _METRICS) +
       " FROM long GROUP BY run_id")
def q_pivot_metrics(spark, sf):
    """(run_id, key, value) -> one column per metric key (#55)."""
    long = RS.melt(runs_frame(spark, sf), ["run_id"], _METRICS, "metric", "value")
    return RS.pivot_metrics(long, "run_id", "metric", "value", _METRICS)


@query("left_join_on_condition", RUNS_SQL + """
, params AS (SELECT run_id, 'model_name' AS key, model AS value FROM runs
             UNION ALL SELECT run_id, 'fold', CAST(fold AS VARCHAR) FROM runs),
metrics AS (SELECT run_id, metric AS key, CAST(value AS VARCHAR) AS value FROM runs
             UNPIVOT (value FOR metric IN (roc_auc, accuracy)))
SELECT r.run_id, r.updated_at, p.value AS model_name, m.value AS roc_auc
FROM runs r LEFT JOIN params p ON r.run_id = p.run_id AND p.key = 'model_name'
LEFT JOIN metrics m ON r.run_id = m.run_id AND m.key = 'roc_auc'""")
def q_left_join_on_condition(spark, sf):
    """runs LEFT JOIN params ON id AND key = 'model_name' LEFT JOIN metrics ON id AND key = 'roc_auc' (#40)."""
    from ..operators.relational import left_join_on_condition
    runs = runs_frame(spark, sf)
    params = runs.select("run_id", F.lit("model_name").alias("key"), F.col("model").alias("value")).unionByName(
        runs.select("run_id", F.lit("fold").alias("key"), F.col("fold").cast("string").alias("value")))
    metrics = RS.melt(runs, ["run_id"], ["roc_auc", "accuracy"], "key", "value").withColumn(
        "value", F.col("value").cast("string"))
    out = left_join_on_condition(runs.select("run_id", "updated_at"), params, metrics, "model_name", "roc_auc")
    return out
