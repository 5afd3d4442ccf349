"""Queries: models, training runs, scoring, tuning and the leakage audit.

Fitted models cannot be checked against SQL (rows-only), except where the
fit has a closed SQL form (1-feature least squares) and for the trial table.
The processed feature frame is fitted once per session and sf directory and
stored as Parquet in ``spark.checkpoint.dir``, as every fit and score reads it by columns.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import functions as F

from ..operators import models as M
from ..operators import selection as SEL
from ..operators import split as SP
from ..operators import training as TR
from ..operators.evaluate import classification_metrics
from ..operators.scoring import score_batch
from ..functions.columns import select_candidates
from ..session import cut_lineage, store_columns
from ..streaming.scoring import read_scored, score_stream
from .catalog_merge import stage_cleaned
from .catalog_stats import TRAIN, post_feature_frame
from .common import rnd, round_doubles
from .registry import fitted_once, query, with_fixture
from .sqlparts import CLEANED, MERGED, PM, SIDES

POST = PM + SIDES + MERGED + CLEANED
_FITTED: dict = {}
_RAW: dict = {}


def raw_features(spark, sf):
    """[ids, split, candidate features..., win] stored once, and the candidates."""
    def make():
        frame = post_feature_frame(spark, sf)
        feats = select_candidates(frame.drop("split"))
        return store_columns(frame.select("matchid", "teamid", "split", *feats, "win")), feats

    return fitted_once(spark, sf, _RAW, make)


def processed(spark, sf):
    """[ids, split, selected scaled features..., win], fitted on train once."""
    def make():
        frame, feats = raw_features(spark, sf)
        out, artifact, summary = SEL.fit_transform_splits(frame, feats, "win", stored=True)
        return store_columns(out), artifact.collect(), summary, feats

    return fitted_once(spark, sf, _FITTED, make)


def _metrics(spark, sf, name, **params):
    frame = processed(spark, sf)[0]
    res = TR.train_run(frame, name, "win", **params)
    return res.metrics.select(F.lit(name).alias("model"), "*")


for _key, _name in [("logistic_regression", "logistic_regression"), ("perceptron", "perceptron"),
                    ("linear_regression_classifier", "linear_regression_classifier"),
                    ("random_forest", "random_forest"), ("gbt_depthwise", "xgboost"), ("gbt_leafwise", "lightgbm"),
                    ("svm_linear", "svm_linear"), ("svm_rbf", "svm_rbf")]:
    def _make(name):
        def q(spark, sf):
            return _metrics(spark, sf, name)
        q.__doc__ = f"Fit {name} on the train split; metrics per split (rows-only check)."
        return q
    query(_key)(_make(_name))


@query("extract_xy")
def q_extract_xy(spark, sf):
    """Model input columns: numeric, non-id, non-target, non-leaky (#133)."""
    frame = processed(spark, sf)[0]
    return spark.createDataFrame([(c,) for c in M.extract_xy(frame, "win")], "feature string")


@query("train_run")
def q_train_run(spark, sf):
    """Fit, score all splits, persist the model and log run/params/metrics (#134, #7, #9)."""
    frame = processed(spark, sf)[0]
    res = TR.train_run(frame, "logistic_regression", "win")
    root = TR.artifact_root(spark)
    path = f"{root}/models/{res.run_id}"
    TR.save_model(spark, res.model, path, "win", "postgame")
    TR.log_run(spark, root, res.run_id, "01-baselines", "logistic_regression", "postgame",
               {"C": 1.0, "max_iter": 1000}, res.metrics, res.fit_seconds)
    return res.metrics.select(F.lit(res.run_id).alias("run_id"), "*")


@query("feature_importance")
def q_feature_importance(spark, sf):
    frame = processed(spark, sf)[0]
    res = TR.train_run(frame, "random_forest", "win")
    return TR.feature_importance(spark, res.model)


@query("top_importance")
def q_top_importance(spark, sf):
    """Top 10 features by normalized random-forest importance (#76)."""
    frame = processed(spark, sf)[0]
    res = TR.train_run(frame, "random_forest", "win")
    return TR.feature_importance(spark, res.model, top=10)


@query("save_load_model")
def q_save_load_model(spark, sf):
    """Persist a model with its metadata, load it back, score test (#7, #150)."""
    frame = processed(spark, sf)[0]
    res = TR.train_run(frame, "linear_regression_classifier", "win")
    path = f"{TR.artifact_root(spark)}/models/{uuid.uuid4().hex[:12]}"
    TR.save_model(spark, res.model, path, "win", "postgame")
    loaded = TR.load_model(spark, path)
    scored = loaded.score(frame.where(F.col("split") == "test"), ["matchid", "teamid", "win"])
    return classification_metrics(scored, "win", "pred", "score")


@query("evaluate_scope")
def q_evaluate_scope(spark, sf):
    """Persist a model and its preprocessor, load both, align raw test rows (missing columns
    0), transform once, score, metrics (#150)."""
    out, rows, _, _ = processed(spark, sf)
    root = f"{TR.artifact_root(spark)}/scopes/{uuid.uuid4().hex[:12]}"
    TR.save_model(spark, TR.train_run(out, "logistic_regression", "win").model, f"{root}/model", "win", "postgame")
    TR.save_preprocessor(spark, rows, f"{root}/preprocessor")
    model, fitted = TR.load_model(spark, f"{root}/model"), TR.load_preprocessor(spark, f"{root}/preprocessor")
    raw = raw_features(spark, sf)[0].where(F.col("split") == "test")
    scored = score_batch(raw, model, fitted, [r["feature"] for r in fitted], keep=["matchid", "teamid", "win"])
    return classification_metrics(scored.withColumnRenamed("label", "pred").withColumnRenamed("probability", "score"),
                                  "win", "pred", "score")


@query("shap_linear")
def q_shap_linear(spark, sf):
    """Mean |coef * (x - mean)| per feature of the linear champion (#151)."""
    frame = processed(spark, sf)[0]
    res = TR.train_run(frame, "linear_regression_classifier", "win")
    train = frame.where(F.col("split") == "train")
    return TR.shap_linear(frame.where(F.col("split") == "test"), res.model, train)


@query("save_preprocessor")
def q_save_preprocessor(spark, sf):
    """The scaling artifact written as Parquet and read back (#8)."""
    _, rows, _, _ = processed(spark, sf)
    path = f"{TR.artifact_root(spark)}/preprocessor/{uuid.uuid4().hex[:12]}"
    TR.save_preprocessor(spark, rows, path)
    return spark.read.parquet(path)


@query("write_summary")
def q_write_summary(spark, sf):
    """Feature-pipeline summary as one sorted JSON document, read back (#6)."""
    _, _, summary, _ = processed(spark, sf)
    path = f"{TR.artifact_root(spark)}/summary/{uuid.uuid4().hex[:12]}"
    TR.write_summary(spark, summary, path)
    return spark.read.text(path)


@query("evaluation_summary")
def q_evaluation_summary(spark, sf):
    """Champion (best validation roc_auc of two baselines) and its metrics on every split,
    written as one JSON document and read back (#10)."""
    frame = processed(spark, sf)[0]
    names = ("logistic_regression", "linear_regression_classifier")
    metrics = {n: cut_lineage(TR.train_run(frame, n, "win").metrics) for n in names}  # a row a split, read several times
    best = max(metrics, key=lambda n: metrics[n].where("split = 'val'").first()["roc_auc"] or 0)
    splits = {s: TR.evaluation_summary(metrics[best], best, s) for s in ("train", "val", "test")}
    path = f"{TR.artifact_root(spark)}/evaluation/{uuid.uuid4().hex[:12]}"
    TR.write_summary(spark, {"champion": best, "splits": splits}, path)
    return spark.read.text(path).withColumnRenamed("value", "summary")


@query("learning_curve")
def q_learning_curve(spark, sf):
    frame = processed(spark, sf)[0]
    return TR.learning_curve(frame, "logistic_regression")


# ---------------------------------------------------------------- closed-form checks
@query("linear_regression_1d", with_fixture(POST + f"""
SELECT {rnd(f'REGR_INTERCEPT(CAST(win AS DOUBLE), kills_sum)')} AS intercept, {rnd('REGR_SLOPE(CAST(win AS DOUBLE), kills_sum)')} AS slope
FROM cleaned WHERE {TRAIN}"""))
def q_linear_regression_1d(spark, sf):
    """Least-squares classifier with one feature: intercept and slope from the Gram pass (#126)."""
    train = SP.split_grouped(stage_cleaned(spark, sf)).where(F.col("split") == "train")
    train = cut_lineage(train.select("kills_sum", "win"))  # the Gram pass reads it twice
    m = M.fit_linear_regression_classifier(train, ["kills_sum"], "win")
    return round_doubles(spark.createDataFrame([(float(m.intercept), float(m.coef[0]))], "intercept double, slope double"))


@query("score_batch", with_fixture(POST + f"""
, fit AS (SELECT REGR_INTERCEPT(CAST(win AS DOUBLE), kills_sum) AS b0, REGR_SLOPE(CAST(win AS DOUBLE), kills_sum) AS b1
          FROM cleaned WHERE {TRAIN}),
sc AS (SELECT matchid, teamid, 1.0 / (1.0 + EXP(-(b0 + kills_sum * b1))) AS p FROM cleaned, fit)
SELECT matchid, teamid, ROUND(p, 4) AS probability, CASE WHEN p >= 0.5 THEN 1 ELSE 0 END AS label,
       ROUND(GREATEST(p, 1 - p), 4) AS confidence, 'v1' AS model_version FROM sc"""))
def q_score_batch(spark, sf):
    """Score every cleaned row with the 1-feature linear model; missing model
    columns would be 0.0; label at p >= 0.5; confidence = max(p, 1 - p) (#171)."""
    cleaned = cut_lineage(stage_cleaned(spark, sf).select("matchid", "teamid", "kills_sum", "win"))  # fitted on and scored
    train = SP.split_grouped(cleaned).where(F.col("split") == "train")
    m = M.fit_linear_regression_classifier(train, ["kills_sum"], "win")
    out = score_batch(cleaned, m, None, ["kills_sum"], keep=["matchid", "teamid"])
    return round_doubles(out, 4)


@query("score_stream")
def q_score_stream(spark, sf):
    """The batch scorer on a Structured Streaming file source (availableNow), read back (#172)."""
    stored = cut_lineage(stage_cleaned(spark, sf).select("matchid", "teamid", "kills_sum", "deaths_sum", "win"))  # fitted on and scored
    cleaned = stored.drop("win")
    train = SP.split_grouped(stored).where(F.col("split") == "train")
    m = M.fit_linear_regression_classifier(train, ["kills_sum", "deaths_sum"], "win")
    root = f"{TR.artifact_root(spark)}/stream/{uuid.uuid4().hex[:12]}"
    cleaned.repartition(4).write.mode("overwrite").parquet(f"{root}/in")
    score_stream(spark, f"{root}/in", cleaned.schema, m, f"{root}/out", f"{root}/ckpt",
                 raw_columns=["kills_sum", "deaths_sum"], keep=["matchid", "teamid"], max_files_per_trigger=2)
    return read_scored(spark, f"{root}/out")


# ---------------------------------------------------------------- tuning and audit
def _trial_sql(model: str, n: int) -> str:
    import math as _m
    cols = []
    for name, (kind, lo, hi, step, log) in TR.SEARCH_SPACES[model].items():
        u = f"(CAST(('0x' || SUBSTR(MD5(CAST(trial AS VARCHAR) || ':' || '{name}' || ':42'), 1, 8)) AS BIGINT) / 4294967296.0)"
        v = (f"EXP({_m.log(lo)!r} + {u} * {(_m.log(hi) - _m.log(lo))!r})" if log
             else f"({float(lo)!r} + {u} * {float(hi - lo)!r})")
        if kind == "int":
            st = step or 1
            v = f"LEAST(GREATEST(CAST({lo} + FLOOR(({v} - {lo}) / {st} + 0.5) * {st} AS BIGINT), {lo}), {hi})"
            cols.append(f"CAST({v} AS BIGINT) AS {name}")
        else:
            cols.append(f"ROUND({v}, 6) AS {name}")
    space = TR.SEARCH_SPACES[model]
    drawn = f"CAST(FLOOR(n * {'subsample_' if 'subsample' in space else '1.0'} + 0.5) AS BIGINT)"
    bounds = ["n", "CAST(POWER(2, max_depth) AS BIGINT)"] + ([f"CAST(FLOOR({drawn} / min_samples_leaf) AS BIGINT)"] if "min_samples_leaf" in space else [])
    raw = [c if " AS subsample" not in c else c + ", " + c.replace("ROUND(", "", 1).replace(", 6) AS subsample", " AS subsample_") for c in cols]
    out = ", ".join(space)
    return with_fixture(POST + f""", tr AS (SELECT COUNT(*) AS n FROM cleaned WHERE {TRAIN}),
t AS (SELECT trial, n, {', '.join(raw)} FROM range(0, {n}) t(trial), tr)
SELECT trial, {out}, {drawn} AS tree_rows, LEAST({', '.join(bounds)}) AS most_leaves FROM t""")


def _trials(spark, sf, model):
    frame = SP.split_grouped(stage_cleaned(spark, sf))
    return round_doubles(TR.trial_bounds(frame, TR.sample_trials(spark, model, 30), model))


@query("sample_trials", _trial_sql("random_forest", 30))
def q_sample_trials(spark, sf):
    """Seeded random-search trials for the forest search space, with what each can use of the
    training rows (#153)."""
    return _trials(spark, sf, "random_forest")


@query("sample_trials_log", _trial_sql("xgboost", 30))
def q_sample_trials_log(spark, sf):
    """Trials with a log-uniform float and stepped ints (#153)."""
    return _trials(spark, sf, "xgboost")


@query("linear_trials")
def q_linear_trials(spark, sf):
    """Thirty trials of the linear SVM with their validation metric, fitted in shared scans (#153, #154)."""
    trials = [r.asDict() for r in TR.sample_trials(spark, "svm_linear", TR.TRIALS).orderBy("trial").collect()]
    return TR.trial_objectives(processed(spark, sf)[0], "svm_linear", trials)


@query("holdout_objective")
def q_holdout_objective(spark, sf):
    frame = processed(spark, sf)[0]
    v = TR.holdout_objective(frame, "svm_rbf", {"C": 1.0, "gamma": 0.05})
    return spark.createDataFrame([("svm_rbf", float(v))], "model string, val_metric double")


@query("tuning_run")
def q_tuning_run(spark, sf):
    """The full number of trials on the kernel SVM, one of the tuned models, with a resumable
    trial log; best refit scored on test (#156). ``TR.tune_models`` runs them on all models."""
    frame = processed(spark, sf)[0]
    log = f"{TR.artifact_root(spark)}/trials/{uuid.uuid4().hex[:12]}"
    out = TR.tuning_run(frame, "svm_rbf", log_path=log)
    return spark.createDataFrame([(out["model"], int(out["trials"]), json.dumps(out["best_params"]),
                                   float(out["best_value"]))], "model string, trials bigint, best_params string, best_value double")


@query("ablation_single")
def q_ablation_single(spark, sf):
    """Retrain without outcome-proximal objective columns; metric deltas per split (#157)."""
    frame = processed(spark, sf)[0]
    return TR.ablation_single(frame, "logistic_regression", TR.DEFAULT_ABLATION_PATTERNS + ("tower", "dragon"))


@query("ablation_progressive")
def q_ablation_progressive(spark, sf):
    frame = processed(spark, sf)[0]
    return TR.ablation_progressive(frame, "logistic_regression", run_all=True)


_SAMPLE_SQL = ("CASE WHEN CAST(('0x' || SUBSTR(MD5(CAST(event_id AS VARCHAR) || ':42'), 1, 8)) AS BIGINT) "
               "/ 4294967296.0 < 0.5 THEN 'in_sample' ELSE 'out_of_sample' END")


@query("meaningful_drop", f"""
WITH ev AS (SELECT event_id, CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END AS label, value, user_id FROM events),
p AS (SELECT 'full' AS run, {_SAMPLE_SQL} AS sample, label,
             CASE WHEN value / (value + 50.0) >= 0.5 THEN 1 ELSE 0 END AS pred FROM ev
      UNION ALL SELECT 'ablated', {_SAMPLE_SQL}, label, CASE WHEN user_id % 2 = 0 THEN 0 ELSE 1 END FROM ev),
m AS (SELECT run, sample, SUM(CASE WHEN label = pred THEN 1.0 ELSE 0.0 END) / COUNT(*) AS accuracy FROM p GROUP BY run, sample)
SELECT f.sample, ROUND(CAST(a.accuracy - f.accuracy AS DOUBLE), 6) AS delta_accuracy, CAST(0.0 AS DOUBLE) AS delta_roc_auc,
       CASE WHEN f.accuracy - a.accuracy >= 0.03 THEN 1 ELSE 0 END AS meaningful_drop
FROM m f JOIN m a ON f.run = 'full' AND a.run = 'ablated' AND f.sample = a.sample""")
def q_meaningful_drop(spark, sf):
    """Accuracy drop >= 0.03 or AUC drop >= 0.005 per sample; missing metrics
    count as 0 (#159)."""
    from ..sources.predictions import predictions
    from ..operators.evaluate import counting_metrics, meaningful_drop
    from .catalog_eval import _event_split
    p = predictions(spark, sf).withColumn("sample", _event_split())
    full = counting_metrics(p.where("model = 'value_ratio'"), score=None, group=["sample"])
    abl = counting_metrics(p.where("model = 'user_parity'"), score=None, group=["sample"])
    full = full.withColumn("roc_auc", F.lit(None).cast("double"))
    abl = abl.withColumn("roc_auc", F.lit(None).cast("double"))
    return round_doubles(meaningful_drop(full, abl, ["sample"]))
