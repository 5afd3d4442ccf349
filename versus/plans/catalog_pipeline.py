"""Queries: end-to-end builds, scope comparison, logging and the remaining
data-quality expectations under their inventory names."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import functions as F

from ..operators import quality as Q
from ..operators import training as TR
from ..sources.fixture import DEFAULT_SLOTS
from .catalog_merge import binary_stats, stage_merged
from .catalog_models import processed
from .catalog_stats import MATCH_COLS, _count_row, _static, _unique_row
from .pipeline import build_postgame_features, build_pregame_features
from .registry import fitted_once, query, tables, with_fixture
from .sqlparts import CLEANED, MERGED, PM, SIDES

POST = PM + SIDES + MERGED + CLEANED
_BUILDS: dict = {}


def _build(spark, sf, scope):
    def make():
        out_dir = f"{TR.artifact_root(spark)}/build/{uuid.uuid4().hex[:12]}"
        if scope == "pregame":
            return build_pregame_features(spark, tables(spark, sf, wide=True), out_dir, DEFAULT_SLOTS)
        t = tables(spark, sf, wide=True, picks=False)
        return build_postgame_features(spark, t, out_dir, DEFAULT_SLOTS, binary=binary_stats(t))

    return fitted_once(spark, sf, _BUILDS, make, scope)


@query("build_postgame_features")
def q_build_postgame_features(spark, sf):
    """merge -> clean -> split -> features -> encoders -> selection -> scaling,
    written partitioned by (scope, split) with gzip CSV and a JSON summary (#117)."""
    return _build(spark, sf, "postgame")[0]


@query("build_pregame_features")
def q_build_pregame_features(spark, sf):
    """The draft-only build with its fixed candidate list and VIF floor of 5 (#118)."""
    return _build(spark, sf, "pregame")[0]


@query("scope_comparison")
def q_scope_comparison(spark, sf):
    """Same model on both scopes; test accuracy / roc_auc / f1 side by side (#148)."""
    out = None
    for scope in ("postgame", "pregame"):
        frame = _build(spark, sf, scope)[0].drop("scope")
        m = TR.train_run(frame, "logistic_regression", "win").metrics.where(F.col("split") == "test")
        m = m.select(F.lit(scope).alias("scope"), "accuracy", "roc_auc", "f1")
        out = m if out is None else out.unionByName(m)
    return out


@query("save_model")
def q_save_model(spark, sf):
    """Persist model + metadata (features, target, scope, seed, metrics of every split); read model and
    metadata back (#7)."""
    frame = processed(spark, sf)[0]
    res = TR.train_run(frame, "perceptron", "win")
    path = f"{TR.artifact_root(spark)}/models/{res.run_id}"
    TR.save_model(spark, res.model, path, "win", "postgame", TR.split_metrics(res.metrics))
    loaded, meta = TR.load_model(spark, path), TR.load_metadata(spark, path)
    return spark.createDataFrame([(loaded.name, len(loaded.features), float(loaded.intercept), meta["target"], meta["scope"], meta["seed"],
                                   meta["features"], json.dumps(meta["metrics"], sort_keys=True))],
                                 "model string, features int, intercept double, target string, scope string, seed int, "
                                 "feature_columns array<string>, metrics string")


@query("log_run")
def q_log_run(spark, sf):
    """Log run, params and long metrics under one version; read this run back (#9)."""
    frame = processed(spark, sf)[0]
    res = TR.train_run(frame, "linear_regression_classifier", "win")
    root = f"{TR.artifact_root(spark)}/runs-{uuid.uuid4().hex[:8]}"
    TR.log_run(spark, root, res.run_id, "01-baselines", "linear_regression_classifier", "postgame",
               {"ridge_alpha": 0.0}, res.metrics, res.fit_seconds)
    return TR.read_log(spark, root, "metrics").where(F.col("run_id") == res.run_id)


@query("expect_columns_match_set", with_fixture("\n" + _static("raw_matches", "columns_match_set", None, True, "matches")))
def q_expect_columns_match_set(spark, sf):
    return Q.run_suite(tables(spark, sf)["matches"], [Q.expect_columns_match_set(MATCH_COLS)], "raw_matches")


@query("expect_column_exists", with_fixture("\n" + " UNION ALL ".join(
    [_static("raw_matches", "exists", "duration", True, "matches"), _static("raw_matches", "exists", "gameid", False, "matches")])))
def q_expect_column_exists(spark, sf):
    m = tables(spark, sf)["matches"]
    return Q.run_suite(m, [Q.expect_column_exists("duration"), Q.expect_column_exists("gameid")], "raw_matches")


@query("expect_column_count_between", with_fixture(POST + f"""
SELECT 'merged' AS suite, 'column_count_between' AS expectation, NULL AS column_name, 1 AS success,
       CAST(0 AS BIGINT) AS unexpected_count, COUNT(*) AS element_count FROM merged"""))
def q_expect_column_count_between(spark, sf):
    """At least 10 columns in the merged frame (#162)."""
    return Q.run_suite(stage_merged(spark, sf), [Q.expect_column_count_between(10)], "merged")


FORBIDDEN = ["winner", "result", "bluewins", "match_result", "final_result"]


@query("forbid_columns", with_fixture(POST + "\n" + " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, 0 AS present, COUNT(*) AS rows FROM merged" for c in FORBIDDEN)))
def q_forbid_columns(spark, sf):
    """Outcome-like columns must be absent from the merged frame; raises when present (#168)."""
    merged = stage_merged(spark, sf)
    Q.forbid_columns(merged, FORBIDDEN)
    cells = F.array(*[F.struct(F.lit(c).alias("column_name"), F.lit(int(c in merged.columns)).alias("present")) for c in FORBIDDEN])
    return merged.agg(F.count(F.lit(1)).alias("rows")).select(F.explode(cells).alias("c"), "rows").select("c.*", "rows")


@query("run_suite", with_fixture(POST + "\n" + " UNION ALL ".join(
    [_count_row("merged", "not_null", c, f"{c} IS NULL", "*", "merged") for c in ("matchid", "teamid")]
    + [_count_row("merged", "in_set", "teamid", "teamid IS NOT NULL AND teamid NOT IN (100, 200)", "teamid", "merged"),
       _count_row("merged", "in_set", "win", "win IS NOT NULL AND win NOT IN (0, 1)", "win", "merged"),
       _count_row("merged", "in_set", "is_blue_side", "is_blue_side IS NOT NULL AND is_blue_side NOT IN (0, 1)",
                  "is_blue_side", "merged"),
       _count_row("merged", "between", "duration", "duration IS NOT NULL AND (duration < 0 OR duration > 7200)",
                  "duration", "merged"),
       _unique_row("merged", "compound_unique", "matchid,teamid", ["matchid", "teamid"], "merged")])))
def q_run_suite(spark, sf):
    """The merged-frame suite: row-level checks in one aggregate, uniqueness in one more (#169)."""
    suite = [Q.expect_not_null("matchid"), Q.expect_not_null("teamid"), Q.expect_in_set("teamid", [100, 200]),
             Q.expect_in_set("win", [0, 1]), Q.expect_in_set("is_blue_side", [0, 1]),
             Q.expect_between("duration", 0, 7200), Q.expect_compound_unique(["matchid", "teamid"])]
    return Q.run_suite(stage_merged(spark, sf), suite, "merged")
