"""Binary-classification evaluation as aggregates (#136-#149).

Inputs are long prediction frames ``(group..., label, score, pred)``. Counting
metrics are one aggregate per group. Rank metrics first collapse rows to one
row per (group, score) (map-side partial aggregate, so ties and hot groups are
pre-aggregated), then use ``ordered_prefix`` for the running counts.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import clip_probability
from .ordered import ordered_prefix


def _safe_div(a, b):
    return F.when(b != 0, a / b).otherwise(F.lit(0.0))


def confusion_counts(df: DataFrame, label: str = "label", pred: str = "pred",
                     group: Sequence[str] = ()) -> DataFrame:
    """tn, fp, fn, tp per group (#141)."""
    y, p = F.col(label).cast("int"), F.col(pred).cast("int")
    return df.groupBy(*group).agg(
        F.count_if((y == 0) & (p == 0)).cast("bigint").alias("tn"),
        F.count_if((y == 0) & (p == 1)).cast("bigint").alias("fp"),
        F.count_if((y == 1) & (p == 0)).cast("bigint").alias("fn"),
        F.count_if((y == 1) & (p == 1)).cast("bigint").alias("tp"))


def counting_metrics(df: DataFrame, label: str = "label", pred: str = "pred",
                     score: str | None = "score", group: Sequence[str] = ()) -> DataFrame:
    """accuracy, precision, recall, f1 (0 when undefined); brier and log loss on
    clipped scores when ``score`` is given (#136, #139, #140)."""
    y, p = F.col(label).cast("double"), F.col(pred).cast("double")
    tp = F.sum(y * p)
    fp = F.sum((1 - y) * p)
    fn = F.sum(y * (1 - p))
    n = F.count(F.lit(1))
    prec = _safe_div(tp, tp + fp)
    rec = _safe_div(tp, tp + fn)
    exprs = [
        (F.sum(F.when(y == p, 1.0).otherwise(0.0)) / n).alias("accuracy"),
        prec.alias("precision"), rec.alias("recall"),
        _safe_div(2 * tp, 2 * tp + fp + fn).alias("f1"),
    ]
    if score:
        s = clip_probability(score)
        exprs += [F.avg((s - y) * (s - y)).alias("brier_score"),
                  (-F.avg(y * F.log(s) + (1 - y) * F.log(1 - s))).alias("log_loss")]
    return df.groupBy(*group).agg(*exprs)


def score_counts(df: DataFrame, label: str = "label", score: str = "score",
                 group: Sequence[str] = (), clip: bool = True) -> DataFrame:
    """One row per (group, distinct score): positives and negatives."""
    s = clip_probability(score) if clip else F.col(score).cast("double")
    y = F.col(label).cast("bigint")
    return df.groupBy(*group, s.alias("s")).agg(F.sum(y).alias("pos"), F.sum(1 - y).alias("neg"))


def _descending_counts(df, label, score, group, clip=True):
    counted = score_counts(df, label, score, group, clip)
    return ordered_prefix(counted, ["s"], ["pos", "neg"], group, descending=True)


def rank_metrics(df: DataFrame, label: str = "label", score: str = "score",
                 group: Sequence[str] = (), clip: bool = True) -> DataFrame:
    """roc_auc (rank AUC, ties count half) and pr_auc (step average precision)
    per group; NULL when a group has a single class (#137, #138)."""
    c = _descending_counts(df, label, score, group, clip)
    # descending running counts: cum_neg counts negatives with score >= s
    neg_below = F.col("tot_neg") - F.col("cum_neg")
    precision = F.col("cum_pos") / (F.col("cum_pos") + F.col("cum_neg"))
    agg = c.groupBy(*group).agg(
        F.sum(F.col("pos") * (neg_below + 0.5 * F.col("neg"))).alias("_u"),
        F.sum(F.col("pos") * precision).alias("_ap"),
        F.max("tot_pos").alias("_p"), F.max("tot_neg").alias("_n"))
    both = (F.col("_p") > 0) & (F.col("_n") > 0)
    return agg.select(*group,
                      F.when(both, F.col("_u") / (F.col("_p") * F.col("_n"))).alias("roc_auc"),
                      F.when(both, F.col("_ap") / F.col("_p")).alias("pr_auc"))


def classification_metrics(df: DataFrame, label: str = "label", pred: str = "pred",
                           score: str | None = "score", group: Sequence[str] = ()) -> DataFrame:
    """Full metric row per group (#136) from ONE aggregation chain.

    Rows collapse to one bucket per (group, clipped score) carrying positives,
    negatives and the additive pieces of every counting metric (tp, fp, fn,
    correct, squared labels); running counts over the buckets give AUC and average
    precision; a final per-group aggregate sums everything.  Brier and log loss
    follow from a bucket's score and counts there, so a bucket moves no real number but its
    score.  No join between metric families.
    """
    if not score:
        return counting_metrics(df, label, pred, None, group)
    y, p = F.col(label).cast("double"), F.col(pred).cast("double")
    s = clip_probability(score)
    buckets = df.groupBy(*group, s.alias("s")).agg(
        F.sum(y).alias("pos"), F.sum(1 - y).alias("neg"),
        F.sum(y * p).alias("tp"), F.sum((1 - y) * p).alias("fp"), F.sum(y * (1 - p)).alias("fn"),
        F.sum(F.when(y == p, 1.0).otherwise(0.0)).alias("correct"), F.sum(y * y).alias("yy"))
    c = ordered_prefix(buckets, ["s"], ["pos", "neg"], group, descending=True)
    at, pos, neg = F.col("s"), F.col("pos"), F.col("neg")
    sq = pos * (1 - at) * (1 - at) + neg * at * at + (F.col("yy") - pos)  # the sum of (s - y)^2
    ll = pos * F.log(at) + neg * F.log(1 - at)
    neg_below = F.col("tot_neg") - F.col("cum_neg")
    precision_at = F.col("cum_pos") / (F.col("cum_pos") + F.col("cum_neg"))
    agg = c.groupBy(*group).agg(
        F.sum("tp").alias("_tp"), F.sum("fp").alias("_fp"), F.sum("fn").alias("_fn"),
        F.sum("correct").alias("_ok"), F.sum(F.col("pos") + F.col("neg")).alias("_n"),
        F.sum(sq).alias("_sq"), F.sum(ll).alias("_ll"),
        F.sum(F.col("pos") * (neg_below + 0.5 * F.col("neg"))).alias("_u"),
        F.sum(F.col("pos") * precision_at).alias("_ap"),
        F.max("tot_pos").alias("_p"), F.max("tot_neg").alias("_q"))
    tp, fp, fn = F.col("_tp"), F.col("_fp"), F.col("_fn")
    both = (F.col("_p") > 0) & (F.col("_q") > 0)
    return agg.select(
        *group, (F.col("_ok") / F.col("_n")).alias("accuracy"),
        _safe_div(tp, tp + fp).alias("precision"), _safe_div(tp, tp + fn).alias("recall"),
        _safe_div(2 * tp, 2 * tp + fp + fn).alias("f1"),
        (F.col("_sq") / F.col("_n")).alias("brier_score"), (-F.col("_ll") / F.col("_n")).alias("log_loss"),
        F.when(both, F.col("_u") / (F.col("_p") * F.col("_q"))).alias("roc_auc"),
        F.when(both, F.col("_ap") / F.col("_p")).alias("pr_auc"))


def roc_curve(df: DataFrame, label: str = "label", score: str = "score",
              group: Sequence[str] = ()) -> DataFrame:
    """(threshold, fpr, tpr) at every distinct score, descending, plus each point's
    trapezoid piece (its sum over a group is the area) (#142)."""
    c = _descending_counts(df, label, score, group)
    fpr = F.col("cum_neg") / F.col("tot_neg")
    tpr = F.col("cum_pos") / F.col("tot_pos")
    fpr0 = (F.col("cum_neg") - F.col("neg")) / F.col("tot_neg")
    tpr0 = (F.col("cum_pos") - F.col("pos")) / F.col("tot_pos")
    return c.select(*group, F.col("s").alias("threshold"), fpr.alias("fpr"), tpr.alias("tpr"),
                    ((fpr - fpr0) * (tpr + tpr0) / 2).alias("area_piece"))


def pr_curve(df: DataFrame, label: str = "label", score: str = "score",
             group: Sequence[str] = ()) -> DataFrame:
    """(threshold, precision, recall) per distinct score with trapezoid pieces;
    the curve starts at (recall 0, precision 1) (#143)."""
    c = _descending_counts(df, label, score, group)
    tp, fp = F.col("cum_pos"), F.col("cum_neg")
    tp0, fp0 = tp - F.col("pos"), fp - F.col("neg")
    precision = tp / (tp + fp)
    precision0 = F.when(tp0 + fp0 > 0, tp0 / (tp0 + fp0)).otherwise(F.lit(1.0))
    recall, recall0 = tp / F.col("tot_pos"), tp0 / F.col("tot_pos")
    return c.select(*group, F.col("s").alias("threshold"), precision.alias("precision"),
                    recall.alias("recall"),
                    ((recall - recall0) * (precision + precision0) / 2).alias("area_piece"),
                    (F.col("tot_pos") / (F.col("tot_pos") + F.col("tot_neg"))).alias("base_rate"))


def curve_area(curve: DataFrame, group: Sequence[str] = ()) -> DataFrame:
    return curve.groupBy(*group).agg(F.sum("area_piece").alias("area"))


# fixed values: ten uniform bins, inner edges as numpy.linspace(0, 1, 11)[1:-1]
CALIBRATION_EDGES = [0.1, 0.2, 0.30000000000000004, 0.4, 0.5, 0.6000000000000001,
                     0.7000000000000001, 0.8, 0.9]


def calibration_curve(df: DataFrame, label: str = "label", score: str = "score",
                      group: Sequence[str] = (), edges: Sequence[float] = CALIBRATION_EDGES) -> DataFrame:
    """Per non-empty bin: mean score and observed positive rate (#144).
    A score equal to an edge belongs to the lower bin."""
    s = F.col(score).cast("double")
    b = sum(((s > e).cast("int") for e in edges), F.lit(0))
    return df.groupBy(*group, b.alias("bin")).agg(
        F.avg(s).alias("prob_pred"), F.avg(F.col(label).cast("double")).alias("prob_true"),
        F.count(F.lit(1)).cast("bigint").alias("n"))


def mcnemar(df: DataFrame, label: str, pred1: str, pred2: str, group: Sequence[str] = ()) -> DataFrame:
    """2x2 agreement counts and the continuity-corrected statistic (#145)."""
    y = F.col(label).cast("int")
    c1, c2 = F.col(pred1).cast("int") == y, F.col(pred2).cast("int") == y
    out = df.groupBy(*group).agg(
        F.count_if(c1 & c2).cast("bigint").alias("both_correct"),
        F.count_if(c1 & ~c2).cast("bigint").alias("first_only"),
        F.count_if(~c1 & c2).cast("bigint").alias("second_only"),
        F.count_if(~c1 & ~c2).cast("bigint").alias("both_wrong"))
    b, c = F.col("first_only").cast("double"), F.col("second_only").cast("double")
    return out.withColumn("statistic", F.when(b + c > 0, F.pow(F.abs(b - c) - 1, 2) / (b + c)))


def chi2_1_pvalue(statistic: float | None) -> float | None:
    """Upper tail of chi-square with one degree of freedom."""
    if statistic is None:
        return None
    return math.erfc(math.sqrt(statistic / 2.0))


def with_mcnemar_pvalue(df: DataFrame) -> DataFrame:
    """Adds ``pvalue`` to the (small, one row per group) McNemar table with an
    Arrow-batched pandas UDF (Spark SQL has no erfc)."""

    @F.pandas_udf("double")
    def _p(stat: pd.Series) -> pd.Series:
        return stat.map(lambda v: None if pd.isna(v) else chi2_1_pvalue(float(v))).astype("float64")

    return df.withColumn("pvalue", _p("statistic"))


def error_counts(df: DataFrame, label: str = "label", pred: str = "pred",
                 group: Sequence[str] = ("model",)) -> DataFrame:
    """False positives, false negatives and total errors per model (#78, #146)."""
    y, p = F.col(label).cast("int"), F.col(pred).cast("int")
    return df.groupBy(*group).agg(
        F.count_if((y == 0) & (p == 1)).cast("bigint").alias("false_positives"),
        F.count_if((y == 1) & (p == 0)).cast("bigint").alias("false_negatives"),
        F.count_if(y != p).cast("bigint").alias("total_errors"),
        (F.count_if(y != p) / F.count(F.lit(1))).alias("error_rate"))


def meaningful_drop(full: DataFrame, ablated: DataFrame, on: Sequence[str],
                    min_accuracy_drop: float = 0.03, min_roc_auc_drop: float = 0.005) -> DataFrame:
    """Per key: deltas (ablated - full) and whether the drop is meaningful (#159).
    Missing metrics count as 0."""
    f = full.select(*on, F.col("accuracy").alias("full_accuracy"), F.col("roc_auc").alias("full_roc_auc"))
    a = ablated.select(*on, F.col("accuracy").alias("ablated_accuracy"),
                       F.col("roc_auc").alias("ablated_roc_auc"))
    j = f.join(a, list(on), "inner")
    fa, aa = F.coalesce(F.col("full_accuracy"), F.lit(0.0)), F.coalesce(F.col("ablated_accuracy"), F.lit(0.0))
    fr, ar = F.coalesce(F.col("full_roc_auc"), F.lit(0.0)), F.coalesce(F.col("ablated_roc_auc"), F.lit(0.0))
    acc_drop, auc_drop = fa - aa, fr - ar
    return j.select(*on, (aa - fa).alias("delta_accuracy"), (ar - fr).alias("delta_roc_auc"),
                    ((acc_drop >= min_accuracy_drop) | (auc_drop >= min_roc_auc_drop)).cast("int")
                    .alias("meaningful_drop"))
