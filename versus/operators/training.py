"""Training runs, persistence, run logging, holdout tuning and the leakage
audit (#7-#10, #123, #134, #150-#157).

Runs, parameters and metrics are appended to Parquet tables under an
artifact root on shared storage (``versus.artifact.dir`` or, when unset, a
folder inside ``spark.checkpoint.dir``). Sequential decisions (epochs, trials,
ablation profiles) are short driver loops over small result tables; every fit
and every metric inside them is a distributed job.
"""

from __future__ import annotations

import json
import math
import time
import uuid
from collections.abc import Sequence
from dataclasses import dataclass, replace

import numpy as np
from pyspark.ml import PipelineModel
from pyspark.ml.classification import LinearSVCModel, LogisticRegressionModel, RandomForestClassificationModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..constants import MIN_ACCURACY_DROP, MIN_ROC_AUC_DROP, SEED
from ..session import cut_lineage, ensure_checkpoint_dir
from . import manyfit as MF
from . import models as M
from ..sources.io import read_existing
from .boosting import Boosted
from .clean import drop_by_pattern
from .evaluate import classification_metrics
from .ordered import ordered_rank

METRICS = ("accuracy", "precision", "recall", "f1", "roc_auc", "pr_auc", "brier_score", "log_loss")

# fixed values: ablation patterns and progressive profiles of the leakage audit
DEFAULT_ABLATION_PATTERNS = ("firsttower", "firstbaron", "firstinhib", "turretkills_sum",
                             "turretkills_diff_vs_opp", "inhibkills_sum", "inhibkills_diff_vs_opp")
ABLATION_PROFILES = (
    ("objective_baseline", DEFAULT_ABLATION_PATTERNS),
    ("objective_plus_firstdragon_and_objective_diffs",
     (*DEFAULT_ABLATION_PATTERNS, "firstdragon", "dragonkills_diff_vs_opp", "baronkills_diff_vs_opp",
      "objective_control_score", "objective_control_rate")),
    ("all_objective_signals",
     (*DEFAULT_ABLATION_PATTERNS, "firstdragon", "first", "objective", "turret", "tower", "dragon", "baron",
      "inhib", "_diff_vs_opp")),
    ("objective_plus_macro_fight_pressure",
     (*DEFAULT_ABLATION_PATTERNS, "first", "objective", "turret", "tower", "dragon", "baron", "inhib",
      "_diff_vs_opp", "kills", "assists", "kda", "gold", "jungle", "vision", "timecc", "cc_per_min",
      "killingspree", "doublekills", "triplekills", "quadrakills", "pentakills")),
)

# fixed values: random-search ranges per model (low, high, step or log)
SEARCH_SPACES = {
    "random_forest": {"n_estimators": ("int", 100, 800, 50, False), "max_depth": ("int", 4, 20, 1, False),
                      "min_samples_split": ("int", 2, 10, 1, False), "min_samples_leaf": ("int", 1, 5, 1, False)},
    "xgboost": {"n_estimators": ("int", 200, 1200, 50, False), "learning_rate": ("float", 0.001, 0.3, None, True),
                "max_depth": ("int", 3, 12, 1, False), "subsample": ("float", 0.6, 1.0, None, False),
                "colsample_bytree": ("float", 0.6, 1.0, None, False),
                "min_child_weight": ("float", 0.5, 10.0, None, True), "gamma": ("float", 0.0, 5.0, None, False)},
    "lightgbm": {"n_estimators": ("int", 200, 1200, 50, False), "learning_rate": ("float", 0.001, 0.3, None, True),
                 "num_leaves": ("int", 15, 127, 1, False), "subsample": ("float", 0.6, 1.0, None, False),
                 "colsample_bytree": ("float", 0.6, 1.0, None, False), "min_child_samples": ("int", 5, 100, 1, False)},
    "svm_linear": {"C": ("float", 0.001, 100.0, None, True)},
    "svm_rbf": {"C": ("float", 0.001, 100.0, None, True), "gamma": ("float", 0.0001, 10.0, None, True)},
}
#: Models that ``manyfit`` fits side by side.
LINEAR = ("logistic_regression", "svm_linear", "svm_rbf")
# fixed values: models and trials of a full search, and the learning curve's shares of the training rows
TUNED_MODELS = ("random_forest", "svm_rbf", "xgboost", "lightgbm")
TRIALS = 30
CURVE_FRACTIONS = (0.1, 0.2, 0.4, 0.6, 0.8, 1.0)


def artifact_root(spark: SparkSession) -> str:
    root = spark.conf.get("versus.artifact.dir", None)
    if not root:
        root = ensure_checkpoint_dir(spark).rstrip("/") + "/versus-artifacts"
    return root


def _path_join(root: str, *parts: str) -> str:
    return "/".join([root.rstrip("/")] + list(parts))


# ---------------------------------------------------------------- train / evaluate
@dataclass
class RunResult:
    run_id: str
    model: M.FittedModel
    metrics: DataFrame          # one row per split
    fit_seconds: float


def train_run(frame: DataFrame, model_name: str, target: str = "win", split_col: str = "split",
              id_cols: Sequence[str] = ("matchid", "teamid"), features: Sequence[str] | None = None,
              **params) -> RunResult:
    """Fit on train (validation rows feed early stopping where supported),
    score every split in one pass, metrics per split (#134)."""
    feats = list(features) if features is not None else M.extract_xy(frame, target, id_cols, (split_col,))
    train = frame.where(F.col(split_col) == "train")
    val = frame.where(F.col(split_col) == "val")
    t0 = time.perf_counter()
    model = M.fit(model_name, train, feats, target, val=val if model_name in ("xgboost", "lightgbm") else None,
                  **params)
    fit_seconds = time.perf_counter() - t0
    scored = model.score(frame, keep=[*id_cols, split_col, target])
    metrics = classification_metrics(scored, label=target, pred="pred", score="score", group=[split_col])
    return RunResult(uuid.uuid4().hex[:12], model, metrics, fit_seconds)


def feature_importance(spark: SparkSession, model: M.FittedModel, top: int | None = None) -> DataFrame:
    """Normalized importances sorted descending (#135); ``top`` keeps the first n (#76)."""
    rows = model.importances()
    if top is not None:
        rows = rows[:top]
    return spark.createDataFrame(rows, "feature string, importance double")


def split_metrics(metrics: DataFrame) -> dict:
    """The metric rows of a run by split, as its metadata keeps them (a row a split)."""
    return {r["split"]: {m: r[m] for m in METRICS if m in metrics.columns} for r in metrics.collect()}


def shap_linear(frame: DataFrame, model: M.FittedModel, baseline: DataFrame | None = None) -> DataFrame:
    """Exact additive attributions of a linear margin: coef * (x - mean); returns
    the mean |attribution| per feature (#151). Means come from ``baseline``
    (default: the frame itself); two aggregates, no per-row Python."""
    base = baseline if baseline is not None else frame
    feats = model.features
    means = base.agg(*[F.avg(F.col(c).cast("double")).alias(f"m{i}") for i, c in enumerate(feats)]).first()
    coef = model.coef if model.coef is not None else \
        model.ml_model.coefficients.toArray()
    attrs = [F.abs(F.lit(float(w)) * (F.coalesce(F.col(c).cast("double"), F.lit(0.0)) - F.lit(means[f"m{i}"] or 0.0)))
             for i, (c, w) in enumerate(zip(feats, coef))]
    one = frame.agg(*[F.avg(a).alias(f"a{i}") for i, a in enumerate(attrs)])
    stack = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"a{i}").alias("mean_abs_attribution"))
                      for i, c in enumerate(feats)])
    return one.select(F.explode(stack).alias("s")).select("s.*")


# ---------------------------------------------------------------- persistence and logging
def save_model(spark: SparkSession, model: M.FittedModel | Boosted, path: str, target: str, scope: str,
               metrics: dict | None = None) -> str:
    """Model (ml writer or a coefficient table) plus one metadata row (#7)."""
    if isinstance(model, Boosted):
        kind, intercept = "boosted", model.base
    else:
        kind, intercept = ("linear" if model.ml_model is None else type(model.ml_model).__name__), model.intercept
    meta = {"name": model.name, "features": model.features, "target": target, "scope": scope, "seed": SEED,
            "link": model.link, "threshold": model.threshold, "intercept": intercept,
            "params": {k: v for k, v in model.params.items() if isinstance(v, (int, float, str))},
            "metrics": metrics or {}, "kind": kind}
    if kind == "boosted":
        spark.createDataFrame([(model.to_json(),)], "model string").write.mode("overwrite").parquet(_path_join(path, "boosted"))
    elif kind != "linear":
        model.ml_model.write().overwrite().save(_path_join(path, "ml"))
    else:
        spark.createDataFrame([(c, float(w)) for c, w in zip(model.features, model.coef)],
                              "feature string, coef double").write.mode("overwrite").parquet(_path_join(path, "coef"))
    spark.createDataFrame([(json.dumps(meta, sort_keys=True),)], "meta string").write.mode("overwrite").json(
        _path_join(path, "meta"))
    return path


_ML_LOADERS = {"LogisticRegressionModel": LogisticRegressionModel, "RandomForestClassificationModel":
               RandomForestClassificationModel,
               "LinearSVCModel": LinearSVCModel, "PipelineModel": PipelineModel}


def load_metadata(spark: SparkSession, path: str) -> dict:
    """The metadata that ``save_model`` wrote: name, features, target, scope, seed, metrics."""
    return json.loads(spark.read.json(_path_join(path, "meta")).first()["meta"])


def load_model(spark: SparkSession, path: str) -> M.FittedModel | Boosted:
    meta = load_metadata(spark, path)
    if meta["kind"] == "boosted":
        return Boosted.from_json(spark.read.parquet(_path_join(path, "boosted")).first()["model"])
    fm = M.FittedModel(meta["name"], meta["features"], link=meta["link"], threshold=meta["threshold"],
                       intercept=meta["intercept"], params=dict(meta["params"]))
    if meta["kind"] == "linear":
        coef = {r["feature"]: r["coef"] for r in spark.read.parquet(_path_join(path, "coef")).collect()}
        fm.coef = np.array([coef[c] for c in meta["features"]])
    else:
        fm.ml_model = _ML_LOADERS[meta["kind"]].load(_path_join(path, "ml"))
        if meta["name"] == "svm_rbf":
            n = int(meta["params"].get("n_components", 200))
            fm.transform, names = M.fourier_map(meta["features"], float(meta["params"]["gamma"]),
                                                n, int(meta["params"].get("seed", SEED)))
            fm.params["model_features"] = names
    return fm


def save_preprocessor(spark: SparkSession, rows: Sequence, path: str) -> str:
    """The fitted scaling artifact (one row per feature) as Parquet (#8)."""
    spark.createDataFrame(list(rows), "feature string, kind string, impute double, center double, scale double") \
        .write.mode("overwrite").parquet(path)
    return path


def load_preprocessor(spark: SparkSession, path: str) -> list:
    return spark.read.parquet(path).orderBy("feature").collect()  # one row per feature


def log_run(spark: SparkSession, root: str, run_id: str, experiment: str, model_name: str, scope: str,
            params: dict, metrics: DataFrame, fit_seconds: float) -> None:
    """Append the run, its parameters and its metrics (long) to the run log (#9).

    Each call writes a version of its own: a folder in each of the three tables, then one row of the
    manifest, whose single file appears by one rename.  Writers share no folder, so they do not disturb
    each other; a version without its manifest row, as a killed writer leaves it, is never read.
    """
    version, now = f"v{uuid.uuid4().hex}", time.time()

    def write(rows: DataFrame, table: str) -> None:
        rows.write.parquet(_path_join(root, table, f"version={version}"))

    write(spark.createDataFrame([(run_id, experiment, model_name, scope, float(now), float(fit_seconds))],
                                "run_id string, experiment string, model string, scope string, created_at double, "
                                "fit_seconds double"), "runs")
    write(spark.createDataFrame([(run_id, k, str(v)) for k, v in params.items()] or [(run_id, "none", "")],
                                "run_id string, key string, value string"), "params")
    write(metrics.select("split", F.explode(F.array(*[
        F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")) for m in METRICS
        if m in metrics.columns])).alias("m")).select(
        F.lit(run_id).alias("run_id"), F.concat_ws("_", "split", "m.metric").alias("key"), F.col("m.value").alias("value")),
        "metrics")
    write(spark.createDataFrame([(run_id, float(now))], "run_id string, written_at double").coalesce(1), "manifest")


def read_log(spark: SparkSession, root: str, table: str) -> DataFrame:
    """``runs``, ``params`` or ``metrics`` of the run log: the rows of finished versions; of a run
    logged more than once, those of the latest (#9)."""
    latest = (spark.read.parquet(_path_join(root, "manifest")).groupBy("run_id")
              .agg(F.max_by("version", F.struct("written_at", "version")).alias("version")))
    return spark.read.parquet(_path_join(root, table)).join(latest, ["run_id", "version"], "left_semi").drop("version")


def write_summary(spark: SparkSession, payload: dict, path: str) -> None:
    """A summary dict as one sorted-key JSON document (#6, #10)."""
    spark.createDataFrame([(json.dumps(payload, sort_keys=True, default=str),)], "summary string").coalesce(1) \
        .write.mode("overwrite").text(path)


def evaluation_summary(metrics: DataFrame, model_name: str, split: str = "test") -> dict:
    """Champion name plus its metrics on one split (#10)."""
    row = metrics.where(F.col("split") == split).first()
    return {"champion": model_name, "split": split,
            "metrics": {m: (None if row is None or row[m] is None else float(row[m])) for m in METRICS
                        if row is not None and m in row.asDict()}}


# ---------------------------------------------------------------- tuning
def trial_bounds(frame: DataFrame, trials: DataFrame, model_name: str, split_col: str = "split") -> DataFrame:
    """Trials with what they can use of the training rows of ``frame``: the rows a tree draws and the
    leaves it can have at most, by its leaf size, depth and leaf budget (#153)."""
    rows = frame.where(F.col(split_col) == "train").agg(F.count(F.lit(1)).alias("train_rows"))
    out = with_one_row(trials, rows)
    space = SEARCH_SPACES[model_name]
    drawn = F.floor(F.col("train_rows") * (F.col("subsample") if "subsample" in space else F.lit(1.0)) + 0.5).cast("bigint")
    bounds = [F.col("train_rows"), F.pow(F.lit(2.0), F.col("max_depth")) if "max_depth" in space else F.col("num_leaves").cast("double")]
    least = next((c for c in ("min_samples_leaf", "min_child_samples") if c in space), None)
    if least:
        bounds.append(F.floor(F.col("tree_rows") / F.col(least)))
    return out.withColumn("tree_rows", drawn).withColumn("most_leaves", F.least(*[b.cast("bigint") for b in bounds])).drop("train_rows")


def with_one_row(df: DataFrame, one: DataFrame) -> DataFrame:
    """The columns of a one-row frame beside every row, as literals (one job, no join)."""
    row = one.first()
    return df.select("*", *[F.lit(row[c]).alias(c) for c in one.columns])


def sample_trials(spark: SparkSession, model_name: str, n_trials: int, seed: int = SEED) -> DataFrame:
    """Seeded random-search trial table: one row per trial, one column per
    parameter, values from md5 uniforms (#153)."""
    from .split import hash_unit
    space = SEARCH_SPACES[model_name]
    df = spark.range(n_trials).withColumnRenamed("id", "trial")
    for name, (kind, lo, hi, step, log) in space.items():
        u = hash_unit(F.col("trial"), F.lit(name), seed=seed)
        if log:
            v = F.exp(F.lit(math.log(lo)) + u * F.lit(math.log(hi) - math.log(lo)))
        else:
            v = F.lit(float(lo)) + u * F.lit(float(hi - lo))
        if kind == "int":
            st = step or 1
            v = (F.lit(lo) + F.floor((v - F.lit(lo)) / st + 0.5) * st).cast("bigint")
            v = F.least(F.greatest(v, F.lit(lo)), F.lit(hi))
        df = df.withColumn(name, v)
    return df


def holdout_objective(frame: DataFrame, model_name: str, params: dict, target: str = "win",
                      features: Sequence[str] | None = None) -> float:
    """Fit on train, score validation: val roc_auc, falling back to val f1 (#154)."""
    res = train_run(frame, model_name, target, features=features, **params)
    row = res.metrics.where(F.col("split") == "val").first()
    if row is None:
        return float("nan")
    return float(row["roc_auc"]) if row["roc_auc"] is not None else float(row["f1"])


def tune_models(frame: DataFrame, models: Sequence[str] = TUNED_MODELS, n_trials: int = TRIALS, **kw) -> dict:
    """The full search: ``n_trials`` trials of every model, the best one by validation (#156)."""
    runs = [tuning_run(frame, m, n_trials, **kw) for m in models]
    return max(runs, key=lambda r: r["best_value"])


def _spec(model_name: str, params: dict) -> MF.Spec:
    """The linear model behind a trial."""
    if model_name == "logistic_regression":
        return MF.Spec(C=params.get("C", 1.0), balanced=True)
    return MF.Spec(C=params.get("C", 1.0), loss="hinge", gamma=params.get("gamma"))


def trial_objectives(frame: DataFrame, model_name: str, trials: Sequence[dict], target: str = "win",
                     features: Sequence[str] | None = None) -> DataFrame:
    """Validation metric of every trial of a linear model (#154): all are fitted in one scan an iteration
    and scored in one pass.  Returns (trial, params, value), ``value`` as in ``holdout_objective``."""
    spark = frame.sparkSession
    feats = list(features) if features is not None else M.extract_xy(frame, target, exclude=("split",))
    params = [{k: v for k, v in t.items() if k != "trial"} for t in trials]
    specs = [_spec(model_name, p) for p in params]
    rows = MF.store(frame.where(F.col("split") == "train"), feats, target, specs=specs)
    models, _ = MF.fit_many(rows, specs)
    scored = MF.scores(frame.where(F.col("split") == "val"), rows, specs, models, target)
    by_model = classification_metrics(scored, target, "pred", "score", group=["model"])
    # a row a trial: the budget, not the data
    names = spark.createDataFrame([(j, int(t["trial"]), json.dumps(p, sort_keys=True)) for j, (t, p) in enumerate(zip(trials, params))], "model int, trial bigint, params string")
    return names.join(by_model, "model", "left").select("trial", "params", F.coalesce("roc_auc", "f1").alias("value"))


def tuning_run(frame: DataFrame, model_name: str, n_trials: int = TRIALS, target: str = "win",
               log_path: str | None = None, features: Sequence[str] | None = None) -> dict:
    """Budgeted random search with resume: trials already in the log are
    skipped (left-anti on trial number); best = max_by over the log; refit with
    the best parameters and score test once (#156).  The trials of a linear model share their
    scans (``trial_objectives``)."""
    spark = frame.sparkSession
    trials = sample_trials(spark, model_name, n_trials)
    done = None
    if log_path:
        done = read_existing(spark, log_path)
    todo = trials.join(done.select("trial"), "trial", "left_anti") if done is not None else trials
    rows = [r.asDict() for r in todo.orderBy("trial").collect()]  # n_trials rows: the budget, not the data
    if model_name in LINEAR:
        batches = [trial_objectives(frame, model_name, rows, target, features)] if rows else []
    else:
        batches = (spark.createDataFrame([(int(r["trial"]), json.dumps({k: v for k, v in r.items() if k != "trial"}, sort_keys=True),
                                           holdout_objective(frame, model_name, {k: v for k, v in r.items() if k != "trial"}, target, features))],
                                         "trial bigint, params string, value double") for r in rows)
    for found in batches:
        found = cut_lineage(found)
        if log_path:
            found.write.mode("append").parquet(log_path)
        done = found if done is None else done.unionByName(found)
    best = done.agg(F.max_by("params", "value").alias("params"), F.max("value").alias("value")).first()
    best_params = json.loads(best["params"])
    final = train_run(frame, model_name, target, features=features, **best_params)
    test = final.metrics.where(F.col("split") == "test").first()
    return {"model": model_name, "trials": done.count(), "best_params": best_params, "best_value": best["value"],
            "test": {m: test[m] for m in METRICS} if test else {}}


# ---------------------------------------------------------------- leakage audit
def ablation_single(frame: DataFrame, model_name: str, patterns: Sequence[str], target: str = "win",
                    protect: Sequence[str] = ("matchid", "teamid", "split", "win"), **params) -> DataFrame:
    """Retrain without pattern-matched columns; delta = ablated - full per split (#157)."""
    full = train_run(frame, model_name, target, **params).metrics
    ablated = train_run(drop_by_pattern(frame, patterns, protect), model_name, target, **params).metrics
    return meaningful_drop(full, ablated, ["split"])


def meaningful_drop(full: DataFrame, ablated: DataFrame, on: Sequence[str],
                    min_accuracy_drop: float = MIN_ACCURACY_DROP, min_roc_auc_drop: float = MIN_ROC_AUC_DROP) -> DataFrame:
    from .evaluate import meaningful_drop as md
    return md(full, ablated, on, min_accuracy_drop, min_roc_auc_drop)


def ablation_progressive(frame: DataFrame, model_name: str, target: str = "win", run_all: bool = False,
                         profiles=ABLATION_PROFILES, split: str = "test", **params) -> DataFrame:
    """Successively broader profiles; stop at the first meaningful drop on
    ``split`` unless ``run_all`` (#158)."""
    spark = frame.sparkSession
    full = train_run(frame, model_name, target, **params).metrics
    rows = []
    for name, pats in profiles:
        abl = train_run(drop_by_pattern(frame, pats, ("matchid", "teamid", "split", target)),
                        model_name, target, **params).metrics
        r = meaningful_drop(full, abl, ["split"]).where(F.col("split") == split).first()
        rows.append((name, float(r["delta_accuracy"]), float(r["delta_roc_auc"]), int(r["meaningful_drop"])))
        if r["meaningful_drop"] and not run_all:
            break
    return spark.createDataFrame(rows, "profile string, delta_accuracy double, delta_roc_auc double, "
                                       "meaningful_drop int")


def learning_curve(frame: DataFrame, model_name: str, fractions: Sequence[float] = CURVE_FRACTIONS,
                   target: str = "win", id_cols: Sequence[str] = ("matchid", "teamid"), minimum: int = 64, **params) -> DataFrame:
    """For each fraction: fit on max(64, n*f) lowest-hash training rows (nested
    samples), report train and validation error (#123).  Rows are ranked once; the models of a
    linear family are fitted and judged in shared scans, others one after the other."""
    from .split import hash_unit
    spark = frame.sparkSession
    feats = M.extract_xy(frame, target, id_cols, ("split",))
    train = frame.where(F.col("split") == "train").withColumn("_h", hash_unit(*id_cols, seed=SEED))
    ranked = cut_lineage(ordered_rank(train, ["_h", *id_cols], name="_rank").drop("_h"))
    n = ranked.count()
    limits = [min(n, max(minimum, int(n * f))) for f in fractions]
    val = frame.where(F.col("split") == "val")
    if model_name in LINEAR and params.get("gamma") != "scale":
        both = ranked.withColumn("_use", F.lit(1)).unionByName(val.withColumn("_rank", F.lit(0)).withColumn("_use", F.lit(0)))
        specs = [replace(_spec(model_name, params), limit=limit) for limit in limits]
        stored = MF.store(both, feats, target, F.col("_use"), F.col("_rank"), specs)
        models, _ = MF.fit_many(stored, specs)
        rows = [(float(f), int(a), wrong / max(a, 1.0), other / max(b, 1.0)) for f, (a, wrong, b, other) in zip(fractions, MF.errors(stored, specs, models))]
    else:
        rows = []
        for f, limit in zip(fractions, limits):
            sub = ranked.where(F.col("_rank") < limit).drop("_rank")
            model = M.fit(model_name, sub, feats, target, **params)
            m_tr = classification_metrics(model.score(sub, [target]), target, "pred", None).first()
            m_va = classification_metrics(model.score(val, [target]), target, "pred", None).first()
            rows.append((float(f), limit, 1 - m_tr["accuracy"], 1 - m_va["accuracy"]))
    return spark.createDataFrame(rows, "fraction double, rows bigint, train_error double, val_error double")
