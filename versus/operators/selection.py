"""Feature selection and split-safe preprocessing (#106-#116).

One Gram pass serves correlation, VIF and the PCA diagnostic: every task
folds its rows into k x k blocks of pairwise sums (NumPy inside
``mapInArrow``, Arrow batches), the blocks are summed with one
``groupBy(i, j)``, and only the k x k result (bounded by the feature count,
never by the rows) reaches the driver for the small linear algebra.
Correlation is pairwise complete; VIF and PCA take median-filled columns.

Scaling artifacts are one long table (feature, kind, impute, center, scale)
fitted on the training rows with exact distributed quantiles, then applied to
every split by the same single ``select``.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..constants import (CORRELATION_THRESHOLD, MIN_FEATURES_AFTER_VIF, OUTLIER_IQR_FACTOR,
                         ROBUST_OUTLIER_SHARE, VIF_THRESHOLD)
from .ordered import exact_quantiles
from ..session import cut_lineage


@dataclass
class Gram:
    """Pairwise sufficient statistics of k columns, each shifted by ``shift``.

    ``count[i, j]`` rows have both i and j; over them ``total[i, j]`` sums i,
    ``square[i, j]`` its square and ``cross[i, j]`` the product. Without gaps
    every row counts for every pair. ``constant`` marks columns whose smallest
    value is their largest.
    """
    columns: list
    shift: np.ndarray
    count: np.ndarray
    total: np.ndarray
    square: np.ndarray
    cross: np.ndarray
    constant: np.ndarray

    @property
    def n(self) -> int:
        return int(self.count.max()) if self.count.size else 0

    @property
    def mean(self) -> np.ndarray:
        own = np.diag(self.count)
        return self.shift + np.diag(self.total) / np.maximum(own, 1)

    @property
    def centred(self) -> np.ndarray:
        """Cross-products about the pair's own means."""
        return self.cross - self.total * self.total.T / np.maximum(self.count, 1)

    @property
    def raw(self) -> np.ndarray:
        """X^T X over the rows that have both columns."""
        m = self.shift
        return self.cross + self.total * m[None, :] + self.total.T * m[:, None] + self.count * np.outer(m, m)

    def subset(self, columns: Sequence[str]) -> "Gram":
        """The statistics of some of the columns (exact sub-blocks)."""
        at = [self.columns.index(c) for c in columns]
        grid = np.ix_(at, at)
        return Gram(list(columns), self.shift[at], self.count[grid], self.total[grid], self.square[grid],
                    self.cross[grid], self.constant[at])

    def correlation(self) -> np.ndarray:
        """Pairwise-complete Pearson r; NaN where a side does not vary."""
        n = np.maximum(self.count, 1)
        var = self.square - self.total * self.total / n
        flat = var <= 1e-13 * self.square
        flat |= self.constant[:, None]
        with np.errstate(invalid="ignore", divide="ignore"):
            r = self.centred / np.sqrt(np.where(flat, np.nan, var) * np.where(flat, np.nan, var).T)
        return np.clip(r, -1.0, 1.0)


def _finite_filled(df: DataFrame, columns: Sequence[str], fill: dict | None) -> DataFrame:
    out = []
    for c in columns:
        v = F.col(c).cast("double")
        v = F.when(F.isnan(v) | (F.abs(v) == float("inf")), F.lit(None).cast("double")).otherwise(v)
        if fill is not None:
            v = F.coalesce(v, F.lit(float(fill.get(c, 0.0))))
        out.append(v.alias(f"c{len(out)}"))
    return df.select(*out)


def _batch(batch: pa.RecordBatch) -> np.ndarray:
    """The batch as rows x columns; NULL is NaN."""
    return np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns])


def _heads(x: DataFrame, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Mean of each column (0 without values), and whether its smallest value is its largest.

    One pass of NumPy over Arrow batches: an aggregate with three functions a column is too long to be compiled.
    """
    def scan(batches):
        n, total, lo, hi = np.zeros(k), np.zeros(k), np.full(k, np.inf), np.full(k, -np.inf)
        for batch in batches:
            a = _batch(batch)
            here = np.isfinite(a)
            n += here.sum(axis=0)
            total += np.where(here, a, 0.0).sum(axis=0)
            lo = np.minimum(lo, np.where(here, a, np.inf).min(axis=0, initial=np.inf))
            hi = np.maximum(hi, np.where(here, a, -np.inf).max(axis=0, initial=-np.inf))
        yield pa.RecordBatch.from_arrays([pa.array(range(k), pa.int32()), *map(pa.array, (n, total, lo, hi))], names=["i", "n", "t", "lo", "hi"])

    mean, constant = np.zeros(k), np.ones(k, bool)
    parts = x.mapInArrow(scan, "i int, n double, t double, lo double, hi double").where("n > 0")
    for r in parts.groupBy("i").agg(F.sum("n").alias("n"), F.sum("t").alias("t"), F.min("lo").alias("lo"), F.max("hi").alias("hi")).collect():  # k rows
        mean[r["i"]], constant[r["i"]] = r["t"] / r["n"], r["lo"] == r["hi"]
    return mean, constant


def gram(df: DataFrame, columns: Sequence[str], fill: dict | None = None) -> Gram:
    """Two jobs whatever the number of columns: means and ranges, then per-partition
    blocks of pairwise sums (NumPy on Arrow batches), added up by (i, j).

    NULL, NaN and +/-inf are gaps: a row counts for the pairs of columns it has.
    ``fill`` (a value per column, 0 by default) closes the gaps first.
    """
    cols = list(columns)
    k = len(cols)
    x = _finite_filled(df, cols, fill)
    shift, constant = _heads(x, k) if k else (np.zeros(0), np.zeros(0, bool))

    def block(batches):
        acc = np.zeros((4, k, k))
        for batch in batches:
            a = _batch(batch) - shift
            here = np.isfinite(a)
            if here.all():  # without gaps every row counts for every pair
                acc[0] += len(a)
                acc[1] += a.sum(axis=0)[:, None]
                acc[2] += (a * a).sum(axis=0)[:, None]
                acc[3] += a.T @ a
            else:
                a = np.where(here, a, 0.0)
                w = here.astype("float64")
                acc += np.stack([w.T @ w, a.T @ w, (a * a).T @ w, a.T @ a])
        i, j = np.indices((k, k), dtype="int32")
        yield pa.RecordBatch.from_arrays([pa.array(v.ravel()) for v in (i, j, *acc)], names=["i", "j", *"wtqp"])

    out = np.zeros((4, k, k))
    if k:
        sums = x.mapInArrow(block, "i int, j int, w double, t double, q double, p double").groupBy("i", "j")
        for r in sums.agg(*[F.sum(c).alias(c) for c in "wtqp"]).collect():  # k * k rows
            out[:, r["i"], r["j"]] = r["w"], r["t"], r["q"], r["p"]
    return Gram(cols, shift, *out, constant)


def medians(df: DataFrame, columns: Sequence[str]) -> dict:
    """Exact median of each column (0 where a column is all gaps)."""
    got = {r["feature"]: r["value"] for r in exact_quantiles(df, columns, [0.5]).collect()}  # one row per column
    return {c: 0.0 if got.get(c) is None else got[c] for c in columns}


def correlation_matrix(spark, g: Gram) -> DataFrame:
    """Long Pearson matrix (a, b, r); NaN for constant columns (#106)."""
    r = g.correlation()
    rows = [(a, b, None if np.isnan(r[i, j]) else float(r[i, j]))
            for i, a in enumerate(g.columns) for j, b in enumerate(g.columns)]
    return spark.createDataFrame(rows, "a string, b string, r double")


def drop_high_correlation(g: Gram, threshold: float = CORRELATION_THRESHOLD) -> tuple[list, list]:
    """Drop column j when any i < j has |r| > threshold, even if i is dropped
    too; NaN never triggers a drop (#107)."""
    r = np.abs(g.correlation())
    drop = [g.columns[j] for j in range(len(g.columns))
            if any((not np.isnan(r[i, j])) and r[i, j] > threshold for i in range(j))]
    return [c for c in g.columns if c not in drop], drop


def vif_scores(g: Gram, centred: bool = False) -> dict:
    """VIF_i = G_ii * (G^-1)_ii on the raw Gram (uncentred), or the diagonal of
    the inverse correlation matrix (``centred``) (#108, #109).

    Constant columns score 1.0; fewer than two usable columns -> all 1.0;
    exactly collinear columns -> +inf (pseudo-inverse with a rank test). Take the
    Gram of filled columns: pairwise sums of gappy ones need not be a Gram matrix.
    """
    cols = g.columns
    usable = [i for i in range(len(cols)) if not g.constant[i] and g.count[i, i] > 0]
    out = {c: 1.0 for c in cols}
    if len(usable) < 2:
        return out
    if centred:
        m = g.correlation()[np.ix_(usable, usable)]
    else:
        # unit diagonal: VIF does not depend on the columns' scales, rank tests do
        m = g.raw[np.ix_(usable, usable)]
        size = np.sqrt(np.diag(m))
        m = m / np.outer(size, size)
    # per column: regress on the others with the k x k block; VIF = G_ii / SSR_i
    # (equals G_ii * (G^-1)_ii at full rank; SSR ~ 0 means exactly collinear -> inf)
    k = len(usable)
    for pos, i in enumerate(usable):
        rest = [j for j in range(k) if j != pos]
        b = m[rest, pos]
        ssr = float(m[pos, pos] - b @ np.linalg.pinv(m[np.ix_(rest, rest)]) @ b)
        out[cols[i]] = float("inf") if ssr <= 1e-10 * abs(m[pos, pos]) else float(m[pos, pos] / ssr)
    return out


def drop_high_vif(g: Gram, threshold: float = VIF_THRESHOLD,
                  min_features: int = MIN_FEATURES_AFTER_VIF) -> tuple[list, list, dict]:
    """Drop every column with VIF > threshold at once; keep all when fewer than
    ``min_features`` would remain (#110)."""
    scores = vif_scores(g)
    drop = [c for c in g.columns if scores[c] > threshold]
    keep = [c for c in g.columns if c not in drop]
    if len(keep) < min_features:
        return list(g.columns), [], scores
    return keep, drop, scores


def pca_components_95(g: Gram, share: float = 0.95) -> int:
    """Components needed for >= 95 % variance of the standardized data (#111)."""
    k = len(g.columns)
    if k == 0:
        return 0
    if k == 1:
        return 1
    r = g.correlation()
    # constant columns standardize to zeros: no variance, no correlation
    r = np.where(np.isnan(r), 0.0, r)
    ev = np.sort(np.clip(np.linalg.eigvalsh(r), 0, None))[::-1]
    if ev.sum() <= 0:
        return 1
    cum = np.cumsum(ev / ev.sum())
    return int(np.searchsorted(cum, share) + 1)


# ---------------------------------------------------------------- scaling
def binary_columns(df: DataFrame, columns: Sequence[str]) -> list:
    from .relational import detect_binary
    return detect_binary(df, columns)


def scaling_artifact(train: DataFrame, columns: Sequence[str], iqr_factor: float = OUTLIER_IQR_FACTOR,
                     robust_share: float = ROBUST_OUTLIER_SHARE, stored: bool = False) -> DataFrame:
    """Fit the preprocessing on the training rows (#112-#115).

    Returns (feature, kind, impute, center, scale): binary columns impute the
    most frequent value (smallest on ties) and pass through; columns with more
    than ``robust_share`` of all rows outside the 1.5 IQR fences of the observed
    values get robust scaling (median, IQR); the rest standard scaling (mean,
    population std). Both scalings are fitted on median-filled values. NaN
    counts as NULL; zero scales become 1; an all-NULL column is filled with 0.
    ``stored`` tells that ``train`` is a projection of stored rows, which need no second copy.
    """
    spark = train.sparkSession
    cols = list(columns)
    clean = train.select(*[F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double")).alias(f"c{i}") for i, c in enumerate(cols)])
    clean = clean if stored else cut_lineage(clean)  # read by several aggregates
    at = {c: f"c{i}" for i, c in enumerate(cols)}
    # one aggregate: rows, binary detection, mean and sum of squares about it
    exprs = [F.count(F.lit(1)).alias("rows")]
    for v in at.values():
        exprs += [F.count(v).alias(f"n{v}"), F.count_if(~F.col(v).isin(0.0, 1.0)).alias(f"x{v}"),
                  F.avg(v).alias(f"m{v}"), F.var_pop(v).alias(f"v{v}")]
    one = clean.agg(*exprs).first()
    binary = [c for c in cols if one[f"n{at[c]}"] and not one[f"x{at[c]}"]]
    numeric = [c for c in cols if c not in binary]

    def quartiles(df, names, probs=(0.25, 0.5, 0.75)):
        if not names:
            return {}
        got = exact_quantiles(df, [at[c] for c in names], list(probs), materialize=False).collect()  # three rows per column
        return {(r["feature"], r["p"]): r["value"] for r in got}

    q = quartiles(clean, numeric)
    fences = {}
    for c in numeric:
        q1, q3 = q.get((at[c], 0.25)), q.get((at[c], 0.75))
        if q1 is not None and q3 is not None and q3 > q1:
            fences[c] = (q1 - iqr_factor * (q3 - q1), q3 + iqr_factor * (q3 - q1))
    out = [F.count_if((F.col(at[c]) < lo) | (F.col(at[c]) > hi)).alias(at[c]) for c, (lo, hi) in fences.items()]
    outside = clean.agg(*out).first() if out else {}
    robust = [c for c in fences if outside[at[c]] > robust_share * one["rows"]]
    fill = {c: q.get((at[c], 0.5)) or 0.0 for c in numeric}
    gappy = [c for c in robust if one[f"n{at[c]}"] < one["rows"]]
    filled = clean.select(*[F.coalesce(at[c], F.lit(fill[c])).alias(at[c]) for c in gappy])
    q.update(quartiles(filled, gappy, (0.25, 0.75)))
    modes = clean.agg(*[F.mode(at[c], True).alias(at[c]) for c in binary]).first() if binary else {}

    rows = []
    for c in cols:
        v = at[c]
        if c in binary:
            rows.append((c, "binary", modes[v], 0.0, 1.0))
        elif c in robust:
            rows.append((c, "robust", fill[c], fill[c], (q[v, 0.75] - q[v, 0.25]) or 1.0))
        else:
            # mean and variance after gaps of the median join n observed values
            n, total = one[f"n{v}"], max(one["rows"], 1)
            mean0, var0, gaps = one[f"m{v}"] or 0.0, one[f"v{v}"] or 0.0, one["rows"] - n
            mean = (n * mean0 + gaps * fill[c]) / total
            var = (n * (var0 + (mean0 - mean) ** 2) + gaps * (fill[c] - mean) ** 2) / total
            rows.append((c, "standard", fill[c], mean, float(np.sqrt(var)) or 1.0))
    return spark.createDataFrame(rows, "feature string, kind string, impute double, center double, scale double")


def apply_scaling(df: DataFrame, artifact_rows: Sequence, keep: Sequence[str] = ()) -> DataFrame:
    """(coalesce(x, impute) - center) / scale for every artifact row, one select;
    output order ``[keep..., binary, robust, standard]`` like a column transformer."""
    kinds = {"binary": 0, "robust": 1, "standard": 2}
    ordered = sorted(artifact_rows, key=lambda r: kinds[r["kind"]])
    exprs = []
    for r in ordered:
        v = F.coalesce(F.col(r["feature"]).cast("double"), F.lit(r["impute"]))
        exprs.append(((v - F.lit(r["center"])) / F.lit(r["scale"])).alias(r["feature"]))
    return df.select(*[F.col(c) for c in keep], *exprs)


def fit_transform_splits(frame: DataFrame, feature_cols: Sequence[str], target: str,
                         id_cols: Sequence[str] = ("matchid", "teamid"), split_col: str = "split",
                         correlation_threshold: float = CORRELATION_THRESHOLD,
                         vif_threshold: float = VIF_THRESHOLD,
                         min_features_after_vif: int = MIN_FEATURES_AFTER_VIF, stored: bool = False):
    """Correlation filter -> VIF filter -> PCA diagnostic -> scaling groups ->
    fit on train, transform all splits with one select (#116).

    Returns (transformed frame with ``[ids, split, features..., target]``,
    artifact DataFrame, summary dict). ``stored`` tells that ``frame`` is a projection of stored rows.
    """
    from .relational import numeric_columns
    numeric = set(numeric_columns(frame))
    candidate = [c for c in feature_cols if c in numeric]
    # the fit statistics read the training rows, the transform reads all rows:
    # cut the lineage of the narrow projection once (reliable checkpoint in
    # spark.checkpoint.dir) and derive both from it
    frame = frame.select(*id_cols, split_col, *candidate, target)
    frame = frame if stored else cut_lineage(frame)
    train = frame.where(F.col(split_col) == "train").select(*candidate, target)
    # without gaps every Gram below is a sub-block of the first one (same rows),
    # so one pass serves correlation, VIF and PCA
    g = gram(train, candidate)
    corr_keep, corr_drop = drop_high_correlation(g, correlation_threshold)
    gappy = {c for c, n in zip(g.columns, np.diag(g.count)) if n < g.n or not n}
    if any(c in gappy for c in corr_keep):
        # VIF on NULL -> median filled data
        g2 = gram(train, corr_keep, fill=medians(train, corr_keep))
    else:
        g2 = g.subset(corr_keep)
    vif_keep, vif_drop, scores = drop_high_vif(g2, vif_threshold, min_features_after_vif)
    g3 = g2.subset(vif_keep)
    pca = pca_components_95(g3)
    artifact = scaling_artifact(train, vif_keep, stored=True)
    rows = artifact.collect()  # one row per selected feature
    out = _transform(frame, rows, id_cols, split_col, target)
    summary = {
        "candidate_feature_count": len(candidate), "after_correlation": len(corr_keep),
        "after_vif": len(vif_keep), "dropped_high_correlation": corr_drop, "dropped_high_vif": vif_drop,
        "pca_components_95pct": pca,
        "binary_passthrough_cols": [r["feature"] for r in rows if r["kind"] == "binary"],
        "robust_scaled_cols": [r["feature"] for r in rows if r["kind"] == "robust"],
        "standard_scaled_cols": [r["feature"] for r in rows if r["kind"] == "standard"],
        "vif_top": [k for k, _ in sorted(scores.items(), key=lambda kv: -kv[1])[:20]],
    }
    return out, artifact, summary


def _transform(frame: DataFrame, rows, id_cols, split_col, target) -> DataFrame:
    kinds = {"binary": 0, "robust": 1, "standard": 2}
    ordered = sorted(rows, key=lambda r: kinds[r["kind"]])
    exprs = [((F.coalesce(F.col(r["feature"]).cast("double"), F.lit(r["impute"])) - F.lit(r["center"]))
              / F.lit(r["scale"])).alias(r["feature"]) for r in ordered]
    return frame.select(*id_cols, split_col, *exprs, target)
