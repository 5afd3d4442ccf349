"""Binary classifiers on Spark (#124-#135).

* ``pyspark.ml`` estimators where Spark has one that takes the same parameters (logistic
  regression, linear SVM);
* the random forest is grown by ``forest.fit_forest`` into Spark's own model;
* gradient-boosted trees are ``boosting.fit_boosted``;
* the batch perceptron and the least-squares classifier are distributed
  aggregates (one aggregate per epoch / one Gram pass) with only k numbers on
  the driver;
* the RBF SVM is re-aimed as random Fourier features (Rahimi & Recht, 2007)
  computed with NumPy on Arrow batches and a linear SVM on top, fitted by ``manyfit``.

Every fitted model scores with ``score(df)`` -> ``score`` (probability of
class 1, or the sigmoid of the margin), ``margin`` and ``pred``.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.classification import LinearSVC, LinearSVCModel, LogisticRegression, RandomForestClassifier
from pyspark.ml.common import _py2java
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.util import Identifiable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..constants import SEED
from ..functions.columns import split_leaky
from .boosting import Boosted, fit_boosted
from .forest import Votes, fit_forest, voted
from .relational import numeric_columns
from .selection import gram

# fixed values: default hyper-parameters of the modelled configuration
DEFAULTS = {
    "logistic_regression": {"C": 1.0, "max_iter": 1000, "class_weight": "balanced"},
    "perceptron": {"max_iter": 1000, "eta0": 1.0, "tol": 1e-3, "n_iter_no_change": 5},
    "linear_regression_classifier": {"ridge_alpha": 0.0, "threshold": 0.5, "link": "sigmoid"},
    "random_forest": {"n_estimators": 200, "max_depth": 12, "min_samples_split": 2, "min_samples_leaf": 1,
                      "class_weight": "balanced_subsample"},
    "xgboost": {"n_estimators": 300, "learning_rate": 0.05, "max_depth": 6, "subsample": 0.8,
                "colsample_bytree": 0.8, "reg_alpha": 0.0, "reg_lambda": 1.0, "min_child_weight": 1.0, "gamma": 0.0,
                "early_stopping_rounds": 30},
    "lightgbm": {"n_estimators": 300, "learning_rate": 0.05, "num_leaves": 31, "min_child_samples": 20,
                 "subsample": 0.8, "colsample_bytree": 0.8, "reg_alpha": 0.0, "reg_lambda": 0.0,
                 "early_stopping_rounds": 30},
    "svm_linear": {"C": 1.0, "max_iter": 3000},
    "svm_rbf": {"C": 1.0, "gamma": "scale", "n_components": 200},
}


def extract_xy(df: DataFrame, target: str, id_cols: Sequence[str] = ("matchid", "teamid"),
               exclude: Sequence[str] = ("split",)) -> list[str]:
    """Feature columns = numeric minus ids, target and leaky names; the label
    must be numeric and never NULL (checked with one count) (#133)."""
    if target not in df.columns:
        raise ValueError(f"target {target} not found")
    if target not in numeric_columns(df):
        raise ValueError(f"target {target} must be numeric")
    drop = set(id_cols) | {target} | set(exclude)
    feats = split_leaky([c for c in numeric_columns(df) if c not in drop], target)[0]
    if df.where(F.col(target).isNull()).limit(1).count():
        raise ValueError(f"target {target} contains NULL values")
    return feats


def _assembled(df: DataFrame, features: Sequence[str], out: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=list(features), outputCol=out, handleInvalid="keep").transform(df)


def class_weights(df: DataFrame, target: str) -> dict:
    """n / (classes * n_class) by class, from one small aggregate."""
    counts = {r[0]: r[1] for r in df.groupBy(target).count().collect()}
    n = sum(counts.values())
    k = max(len(counts), 1)
    return {c: n / (k * m) for c, m in counts.items()}


def balanced_weight(df: DataFrame, target: str, name: str = "weight") -> DataFrame:
    """The weight of each row's class."""
    expr = F.lit(1.0)
    for c, v in class_weights(df, target).items():
        expr = F.when(F.col(target) == c, F.lit(v)).otherwise(expr)
    return df.withColumn(name, expr)


@dataclass
class FittedModel:
    name: str
    features: list
    ml_model: Any = None
    coef: np.ndarray | None = None
    intercept: float = 0.0
    link: str = "sigmoid"
    threshold: float = 0.5
    params: dict = field(default_factory=dict)
    transform: Any = None  # optional feature map applied before the linear part / ml model
    votes: Votes | None = None  # a forest's trees as arrays, which score as ml_model does

    def margin_expr(self):
        expr = F.lit(float(self.intercept))
        for c, w in zip(self.features, self.coef):
            expr = expr + F.coalesce(F.col(c).cast("double"), F.lit(0.0)) * F.lit(float(w))
        return expr

    def score(self, df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
        keep = list(keep)
        if isinstance(self.ml_model, LinearSVCModel) and self.transform is not None and "n_components" in self.params:
            out = fourier_margin(df, keep, self, self.ml_model.coefficients.toArray(), float(self.ml_model.intercept))
            score = F.lit(1.0) / (F.lit(1.0) + F.exp(-F.col("margin")))
            return out.select(*keep, "margin", score.alias("score"), (F.col("margin") > self.ml_model.getThreshold()).cast("int").alias("pred"))
        if self.votes is not None:
            return voted(df, keep, self.features, self.votes)
        src = self.transform(df) if self.transform else df
        feats = self.params.get("model_features", self.features)
        if self.ml_model is None:
            m = self.margin_expr() if self.transform is None else _linear(feats, self.coef, self.intercept)
            score = (F.lit(1.0) / (F.lit(1.0) + F.exp(-m))) if self.link == "sigmoid" else m
            out = src.select(*keep, m.alias("margin"), score.alias("score"))
            return out.withColumn("pred", (F.col("score") >= self.threshold).cast("int"))
        scored = self.ml_model.transform(_assembled(src, feats))
        raw = vector_to_array("rawPrediction")
        if "probability" in scored.columns:
            score = vector_to_array("probability")[1]
        else:
            score = F.lit(1.0) / (F.lit(1.0) + F.exp(-raw[1]))
        return scored.select(*keep, raw[1].alias("margin"), score.alias("score"),
                             F.col("prediction").cast("int").alias("pred"))

    def importances(self) -> list[tuple[str, float]]:
        """Normalized importances: tree importances, or |coefficients| (#135)."""
        feats = self.params.get("model_features", self.features)
        if self.ml_model is not None:
            stage = self.ml_model.stages[-1] if hasattr(self.ml_model, "stages") else self.ml_model
            if hasattr(stage, "featureImportances"):
                v = stage.featureImportances.toArray()
            else:
                v = np.abs(stage.coefficients.toArray())
        else:
            v = np.abs(np.asarray(self.coef, dtype=float))
        tot = v.sum()
        v = v / tot if tot > 0 else v
        return sorted(zip(feats, map(float, v)), key=lambda t: -t[1])


def _linear(features, coef, intercept):
    expr = F.lit(float(intercept))
    for c, w in zip(features, coef):
        expr = expr + F.coalesce(F.col(c).cast("double"), F.lit(0.0)) * F.lit(float(w))
    return expr


def fit_logistic_regression(train: DataFrame, features: Sequence[str], target: str, C: float = 1.0,
                            max_iter: int = 1000, class_weight: str | None = "balanced", **_) -> FittedModel:
    """L2 logistic regression, sklearn scaling of the penalty: regParam = 1 / (C * sum w) (#124)."""
    data = balanced_weight(train, target) if class_weight == "balanced" else train.withColumn("weight", F.lit(1.0))
    n = data.count()
    lr = LogisticRegression(featuresCol="features", labelCol=target, weightCol="weight", maxIter=max_iter,
                            regParam=1.0 / (C * n), elasticNetParam=0.0, standardization=False, tol=1e-6)
    model = lr.fit(_assembled(data, features))
    return FittedModel("logistic_regression", list(features), ml_model=model,
                       params={"C": C, "max_iter": max_iter})


def fit_perceptron(train: DataFrame, features: Sequence[str], target: str, max_iter: int = 1000,
                   eta0: float = 1.0, tol: float = 1e-3, n_iter_no_change: int = 5, **_) -> FittedModel:
    """Batch perceptron: each epoch one aggregate of y*x over misclassified rows;
    the epoch with the fewest mistakes is kept (#125). The training frame is
    persisted so epochs re-read it instead of recomputing its lineage."""
    feats = list(features)
    k = len(feats)
    y = (2 * F.col(target).cast("double") - 1)
    data = train.select(*[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in feats],
                        y.alias("_y")).persist()
    n = data.count()
    w, b = np.zeros(k), 0.0
    best = (n + 1, w.copy(), b)
    stall = 0
    for _epoch in range(max_iter):
        margin = _linear(feats, w, b)
        wrong = (F.col("_y") * margin) <= 0
        row = data.agg(F.count_if(wrong).alias("err"),
                       F.sum(F.when(wrong, F.col("_y"))).alias("sy"),
                       *[F.sum(F.when(wrong, F.col("_y") * F.col(c))).alias(f"s{i}") for i, c in enumerate(feats)]
                       ).first()
        err = row["err"]
        if err < best[0] - tol * n:
            best, stall = (err, w.copy(), b), 0
        else:
            stall += 1
        if err == 0 or stall >= n_iter_no_change:
            break
        w = w + eta0 * np.array([row[f"s{i}"] or 0.0 for i in range(k)])
        b = b + eta0 * (row["sy"] or 0.0)
    data.unpersist()
    return FittedModel("perceptron", feats, coef=best[1], intercept=best[2], link="sigmoid", threshold=0.5,
                       params={"epochs": _epoch + 1, "best_errors": int(best[0])})


def fit_linear_regression_classifier(train: DataFrame, features: Sequence[str], target: str,
                                     ridge_alpha: float = 0.0, threshold: float = 0.5,
                                     link: str = "sigmoid", **_) -> FittedModel:
    """Least squares on {0,1} targets from one Gram pass; intercept unpenalized;
    pseudo-inverse without ridge (#126). ``link='sigmoid'`` reproduces the
    modelled behaviour (label 1 whenever the linear score >= 0)."""
    feats = list(features)
    g = gram(train, feats + [target])
    k = len(feats)
    cxx, cxy = g.centred[:k, :k], g.centred[:k, k]
    if ridge_alpha > 0:
        beta = np.linalg.solve(cxx + ridge_alpha * np.eye(k), cxy)
    else:
        beta = np.linalg.pinv(cxx) @ cxy
    intercept = float(g.mean[k] - g.mean[:k] @ beta)
    return FittedModel("linear_regression_classifier", feats, coef=beta, intercept=intercept, link=link,
                       threshold=threshold, params={"ridge_alpha": ridge_alpha})


def fit_random_forest(train: DataFrame, features: Sequence[str], target: str, n_estimators: int = 200,
                      max_depth: int = 12, min_samples_split: int = 2, min_samples_leaf: int = 1,
                      class_weight: str | None = "balanced_subsample", seed: int = SEED) -> FittedModel:
    """Spark bounds a node by its children, so ``min_samples_split`` rows in a node are
    asked for as half of them in each child (#127).  The trees are grown by ``forest.fit_forest``, a pass a
    level for all of them; the model is Spark's own."""
    least = max(min_samples_leaf, -(-min_samples_split // 2))
    rf = RandomForestClassifier(featuresCol="features", labelCol=target, weightCol="weight", numTrees=n_estimators,
                                maxDepth=max_depth, minInstancesPerNode=least, seed=seed,
                                featureSubsetStrategy="sqrt", cacheNodeIds=True, checkpointInterval=-1)
    weights = class_weights(train, target) if class_weight else {}
    model, votes = fit_forest(train, features, target, rf, weights)
    return FittedModel("random_forest", list(features), ml_model=model, votes=votes)


def fit_gbt(train: DataFrame, features: Sequence[str], target: str, val: DataFrame | None = None,
            n_estimators: int = 300, learning_rate: float = 0.05, max_depth: int | None = 6, subsample: float = 0.8,
            colsample_bytree: float = 0.8, reg_alpha: float = 0.0, reg_lambda: float = 0.0, min_child_samples: int = 1,
            min_child_weight: float = 0.0, gamma: float = 0.0, num_leaves: int | None = None, early_stopping_rounds: int = 0,
            class_weight: str | None = None, seed: int = SEED, name: str = "xgboost") -> Boosted:
    """Histogram boosting, by depth (#128) or, with a leaf budget, best leaf first (#129); ``val`` stops it
    after ``early_stopping_rounds`` trees without a better log loss."""
    weight = None
    if class_weight == "balanced":
        train, weight = balanced_weight(train, target, "_weight"), "_weight"
        val = None if val is None else val.withColumn("_weight", F.lit(1.0))
    return fit_boosted(train, features, target, val, n_estimators=n_estimators, learning_rate=learning_rate, num_leaves=num_leaves,
                       max_depth=None if num_leaves else max_depth, subsample=subsample, colsample_bytree=colsample_bytree, reg_alpha=reg_alpha,
                       reg_lambda=reg_lambda, gamma=gamma, min_child_samples=min_child_samples, min_child_weight=min_child_weight,
                       early_stopping_rounds=early_stopping_rounds, seed=seed, weight=weight, name=name)


def fit_linear_svm(train: DataFrame, features: Sequence[str], target: str, C: float = 1.0,
                   max_iter: int = 3000, **_) -> FittedModel:
    """Hinge loss + L2 with regParam = 1 / (C * n); score = sigmoid(margin) (#130)."""
    n = train.count()
    svc = LinearSVC(featuresCol="features", labelCol=target, regParam=1.0 / (C * n), maxIter=max_iter,
                    standardization=False)
    return FittedModel("svm_linear", list(features), ml_model=svc.fit(_assembled(train, features)))


def fourier_draws(k: int, n_components: int, seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    """Directions (standard normal) and phases of the random Fourier features."""
    rng = np.random.default_rng(seed)
    return rng.normal(size=(k, n_components)), rng.uniform(0.0, 2 * np.pi, size=n_components)


def fourier_map(features: Sequence[str], gamma: float, n_components: int, seed: int = SEED):
    """z(x) = sqrt(2/D) cos(W x + b), W ~ N(0, 2 gamma), b ~ U(0, 2 pi), as a
    ``mapInPandas`` transform (NumPy on Arrow batches)."""
    W, b = fourier_draws(len(features), n_components, seed)
    W = np.sqrt(2.0 * gamma) * W
    names = [f"rff_{i}" for i in range(n_components)]
    feats = list(features)

    def apply(df: DataFrame) -> DataFrame:
        keep = [f for f in df.schema.fields if f.name not in names]
        schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in keep] + [f"{n} double" for n in names])

        def fn(batches):
            for pdf in batches:
                x = pdf[feats].astype("float64").fillna(0.0).to_numpy()
                z = np.sqrt(2.0 / n_components) * np.cos(x @ W + b)
                yield pd.concat([pdf.reset_index(drop=True), pd.DataFrame(z, columns=names)], axis=1)

        return df.mapInPandas(fn, schema)

    return apply, names


def _fourier_values(batch: pa.RecordBatch, features: Sequence[str], W: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The Fourier features of an Arrow batch, NULL and NaN as 0, a few hundred rows at a time so that they stay in cache."""
    cols = [batch.column(batch.schema.get_field_index(f)).cast(pa.float64()).to_numpy(zero_copy_only=False) for f in features]
    x = np.nan_to_num(np.column_stack(cols), copy=False, nan=0.0, posinf=np.inf, neginf=-np.inf) if cols else np.empty((batch.num_rows, 0))
    z = x @ W
    for at in range(0, len(z), 256):
        part = z[at:at + 256]
        part += b
        np.cos(part, out=part)
        part *= np.sqrt(2.0 / len(b))
    return z


def fourier_vectors(df: DataFrame, features: Sequence[str], target: str, gamma: float, n_components: int, seed: int = SEED) -> DataFrame:
    """(features vector, target) of every row: ``fourier_map`` without a column for each component."""
    W, b = fourier_draws(len(features), n_components, seed)
    W, feats = np.sqrt(2.0 * gamma) * W, list(features)

    def apply(batches):
        for batch in batches:
            z = _fourier_values(batch, feats, W, b)
            ends = np.arange(0, z.size + 1, n_components, dtype=np.int32)
            yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(pa.array(ends), pa.array(z.ravel())), batch.column(batch.schema.get_field_index(target))],
                                             names=["z", target])

    out = df.select(*feats, target).mapInArrow(apply, f"z array<double>, `{target}` {df.schema[target].dataType.simpleString()}")
    return out.select(array_to_vector("z").alias("features"), target)


def fourier_margin(df: DataFrame, keep: Sequence[str], model: FittedModel, coef: np.ndarray, intercept: float) -> DataFrame:
    """``keep`` and the margin of a linear model over Fourier features, which leave no task."""
    W, b = fourier_draws(len(model.features), int(model.params["n_components"]), int(model.params.get("seed", SEED)))
    W, feats, w = np.sqrt(2.0 * float(model.params["gamma"])) * W, [f"_x{i}" for i in range(len(model.features))], np.asarray(coef, dtype=float)
    keep = list(keep)

    def apply(batches):
        for batch in batches:
            m = _fourier_values(batch, feats, W, b) @ w + intercept
            yield pa.RecordBatch.from_arrays([*batch.columns[:len(keep)], pa.array(m)], names=[*keep, "margin"])

    schema = "".join(f"`{c}` {df.schema[c].dataType.simpleString()}, " for c in keep) + "margin double"
    src = df.select(*keep, *[F.col(c).cast("double").alias(f) for c, f in zip(model.features, feats)])
    return src.mapInArrow(apply, schema)


def fit_rbf_svm(train: DataFrame, features: Sequence[str], target: str, C: float = 1.0,
                gamma: str | float = "scale", n_components: int = 200, seed: int = SEED, **_) -> FittedModel:
    """RBF-kernel SVM re-aimed as random Fourier features + linear SVM, fitted by ``manyfit``'s Newton
    passes (#131).  gamma='scale' = 1 / (k * Var(X)) over all entries, from the Gram pass."""
    feats = list(features)
    if gamma == "scale":
        g = gram(train, feats)
        k = len(feats)
        total_mean = float(g.mean.mean())
        second = float((np.diag(g.raw) / max(g.n, 1)).mean())
        var = second - total_mean ** 2
        gamma = 1.0 / (k * var) if var > 0 else 1.0
    from . import manyfit as MF  # which imports this module
    transform, names = fourier_map(feats, float(gamma), n_components, seed)
    spec = MF.Spec(C=C, loss="hinge", gamma=float(gamma), n_components=n_components)
    (fitted,), passes = MF.fit_many(MF.store(train, feats, target, specs=[spec], seed=seed), [spec])
    return FittedModel("svm_rbf", feats, ml_model=_svc_model(train, fitted.coef, fitted.intercept), transform=transform,
                       params={"gamma": gamma, "n_components": n_components, "seed": seed, "model_features": names, "passes": passes})


def _svc_model(df: DataFrame, coef: np.ndarray, intercept: float) -> LinearSVCModel:
    """A ``LinearSVCModel`` of given coefficients."""
    jvm, sc = df.sparkSession._jvm, df.sparkSession.sparkContext
    return LinearSVCModel(jvm.org.apache.spark.ml.classification.LinearSVCModel(Identifiable()._randomUID().replace("Identifiable", "LinearSVC"),
                                                                                _py2java(sc, Vectors.dense(list(map(float, coef)))), float(intercept)))


FITTERS = {
    "logistic_regression": fit_logistic_regression,
    "perceptron": fit_perceptron,
    "linear_regression_classifier": fit_linear_regression_classifier,
    "random_forest": fit_random_forest,
    "xgboost": lambda tr, f, t, val=None, **kw: fit_gbt(tr, f, t, val=val, name="xgboost", **kw),
    "lightgbm": lambda tr, f, t, val=None, **kw: fit_gbt(tr, f, t, val=val, name="lightgbm", **kw),
    "svm_linear": fit_linear_svm,
    "svm_rbf": fit_rbf_svm,
}


def fit(name: str, train: DataFrame, features: Sequence[str], target: str, val: DataFrame | None = None,
        **params) -> FittedModel | Boosted:
    """Fit a named model with its default hyper-parameters overridden by ``params``."""
    kw = dict(DEFAULTS.get(name, {}))
    kw.update(params)
    if name in ("xgboost", "lightgbm"):
        return FITTERS[name](train, features, target, val=val, **kw)
    return FITTERS[name](train, features, target, **kw)
