"""Queries: data quality, descriptive statistics, selection and scaling."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.columns import column_profile, leakage_table, select_candidates
from ..operators import quality as Q
from ..operators import selection as SEL
from ..operators import split as SP
from ..operators import stats as ST
from ..operators.clean import align_schema, drop_by_pattern
from ..session import cut_lineage
from .catalog_merge import stage_cleaned, stage_members, stage_merged
from .common import rnd, round_doubles
from .registry import query, tables, with_fixture
from .sqlparts import CLEANED, MERGED, PM, SIDES

POST = PM + SIDES + MERGED + CLEANED
SPLIT_U = "(CAST(('0x' || SUBSTR(MD5(CAST(matchid AS VARCHAR) || ':42'), 1, 8)) AS BIGINT) / 4294967296.0)"
TRAIN = f"{SPLIT_U} >= 0.3"


# ---------------------------------------------------------------- data quality
STATS_SUITE = [Q.expect_column_exists(c) for c in ("id", "win", "kills", "deaths", "assists", "goldearned")] + [
    Q.expect_not_null("id"), Q.expect_unique("id"), Q.expect_in_set("win", [0, 1])] + [
    Q.expect_between(c, min_value=0) for c in ("kills", "deaths", "assists", "goldearned")]


def _static(suite, exp, col, ok, src):
    return (f"SELECT '{suite}' AS suite, '{exp}' AS expectation, {('NULL' if col is None else repr(col))} AS column_name, "
            f"{int(ok)} AS success, CAST({0 if ok else 1} AS BIGINT) AS unexpected_count, COUNT(*) AS element_count FROM {src}")


def _count_row(suite, exp, col, bad, n, src):
    return (f"SELECT '{suite}' AS suite, '{exp}' AS expectation, '{col}' AS column_name, "
            f"CASE WHEN COUNT({n}) = 0 OR COUNT(CASE WHEN {bad} THEN 1 END) = 0 THEN 1 ELSE 0 END AS success, "
            f"CAST(COUNT(CASE WHEN {bad} THEN 1 END) AS BIGINT) AS unexpected_count, CAST(COUNT({n}) AS BIGINT) AS element_count FROM {src}")


def _unique_row(suite, exp, name, keys, src):
    k = ", ".join(keys)
    nn = " OR ".join(f"{c} IS NOT NULL" for c in keys)
    return (f"SELECT '{suite}' AS suite, '{exp}' AS expectation, '{name}' AS column_name, "
            f"CASE WHEN COALESCE(SUM(CASE WHEN n > 1 THEN n END), 0) = 0 THEN 1 ELSE 0 END AS success, "
            f"CAST(COALESCE(SUM(CASE WHEN n > 1 THEN n END), 0) AS BIGINT) AS unexpected_count, "
            f"CAST(COALESCE(SUM(n), 0) AS BIGINT) AS element_count FROM (SELECT {k}, COUNT(*) AS n FROM {src} WHERE {nn} GROUP BY {k}) u")


STATS_SUITE_SQL = with_fixture("\n" + " UNION ALL ".join(
    [_static("raw_stats", "exists", c, True, "stats") for c in ("id", "win", "kills", "deaths", "assists", "goldearned")]
    + [_count_row("raw_stats", "not_null", "id", "id IS NULL", "*", "stats"),
       _unique_row("raw_stats", "unique", "id", ["id"], "stats"),
       _count_row("raw_stats", "in_set", "win", "win IS NOT NULL AND win NOT IN (0, 1)", "win", "stats")]
    + [_count_row("raw_stats", "between", c, f"{c} IS NOT NULL AND {c} < 0", c, "stats")
       for c in ("kills", "deaths", "assists", "goldearned")]))


@query("quality_suite", STATS_SUITE_SQL)
def q_quality_suite(spark, sf):
    """The member-statistics suite: every row-level expectation in one aggregate (#169)."""
    return Q.run_suite(tables(spark, sf)["stats"], STATS_SUITE, "raw_stats")


@query("expect_not_null", with_fixture(POST + "\n" + " UNION ALL ".join(
    _count_row("merged", "not_null", c, f"{c} IS NULL", "*", "merged") for c in ("matchid", "teamid", "duration"))))
def q_expect_not_null(spark, sf):
    return Q.run_suite(stage_merged(spark, sf), [Q.expect_not_null(c) for c in ("matchid", "teamid", "duration")], "merged")


@query("expect_unique", with_fixture("\n" + _unique_row("raw_matches", "unique", "id", ["id"], "matches")))
def q_expect_unique(spark, sf):
    return Q.run_suite(tables(spark, sf)["matches"], [Q.expect_unique("id")], "raw_matches")


@query("expect_compound_unique", with_fixture(POST + "\n" + _unique_row(
    "merged", "compound_unique", "matchid,teamid", ["matchid", "teamid"], "merged")))
def q_expect_compound_unique(spark, sf):
    return Q.run_suite(stage_merged(spark, sf), [Q.expect_compound_unique(["matchid", "teamid"])], "merged")


@query("expect_between", with_fixture("\n" + _count_row(
    "raw_matches", "between", "duration", "duration IS NOT NULL AND (duration < 0 OR duration > 7200)", "duration", "matches")))
def q_expect_between(spark, sf):
    return Q.run_suite(tables(spark, sf)["matches"], [Q.expect_between("duration", 0, 7200)], "raw_matches")


@query("expect_in_set", with_fixture("\nSELECT * FROM (" + " UNION ALL ".join([
    _count_row("raw_matches", "in_set", "seasonid",
               "seasonid IS NOT NULL AND seasonid NOT IN (SELECT DISTINCT seasonid FROM matches WHERE seasonid IS NOT NULL)",
               "seasonid", "matches"),
    _count_row("raw_matches", "in_set", "platformid",
               "platformid IS NOT NULL AND platformid NOT IN ('1-URGENT', '2-HIGH')", "platformid", "matches")]) + ") x"))
def q_expect_in_set(spark, sf):
    """A fixed set and a set learnt from the data (#167)."""
    m = tables(spark, sf)["matches"]
    suite = [Q.expect_in_set("seasonid", Q.learned_set(m, "seasonid")),
             Q.expect_in_set("platformid", ["1-URGENT", "2-HIGH"])]
    return Q.run_suite(m, suite, "raw_matches")


MATCH_COLS = ["id", "platformid", "seasonid", "duration"]


@query("expect_schema", with_fixture("\n" + " UNION ALL ".join([
    _static("raw_matches", "columns_match_set", None, True, "matches"),
    _static("raw_matches", "exists", "duration", True, "matches"),
    _static("raw_matches", "exists", "gameid", False, "matches"),
    _static("raw_matches", "column_count_between", None, False, "matches")])))
def q_expect_schema(spark, sf):
    """Column set, column existence and column count checks (#160-#162)."""
    m = tables(spark, sf)["matches"]
    suite = [Q.expect_columns_match_set(MATCH_COLS), Q.expect_column_exists("duration"),
             Q.expect_column_exists("gameid"), Q.expect_column_count_between(10)]
    return Q.run_suite(m, suite, "raw_matches")


NO_OUTCOME = ("winner", "result", "bluewins", "match_result", "final_result")
SIDE_CHECKS = [Q.expect_in_set("win", [0, 1]), Q.expect_in_set("teamid", [100, 200]), Q.expect_in_set("is_blue_side", [0, 1]),
               Q.expect_compound_unique(["matchid", "teamid"])]
PROCESSED_COLS = ("matchid", "teamid", "win", "kills_sum", "deaths_sum", "goldearned_sum", "towerkills", "duration",
                  "is_blue_side", "platformid")


def _side_rows(suite, src):
    sets = [_count_row(suite, "in_set", c, f"{c} IS NOT NULL AND {c} NOT IN ({v})", c, src)
            for c, v in (("win", "0, 1"), ("teamid", "100, 200"), ("is_blue_side", "0, 1"))]
    return sets + [_unique_row(suite, "compound_unique", "matchid,teamid", ["matchid", "teamid"], src)]


def _grain_row(suite, src):
    return f"""SELECT '{suite}' AS suite, 'grain' AS expectation, NULL AS column_name,
  CASE WHEN bad = 0 AND dup = 0 THEN 1 ELSE 0 END AS success, CAST(broken AS BIGINT) AS unexpected_count, CAST(n AS BIGINT) AS element_count
  FROM (SELECT SUM(r) AS n, SUM(r - s) AS dup, SUM(b) AS bad, SUM(CASE WHEN s <> 2 THEN 1 ELSE 0 END) + SUM(CASE WHEN w <> 1 THEN 1 ELSE 0 END) AS broken
        FROM (SELECT matchid, COUNT(*) AS r, COUNT(DISTINCT teamid) AS s, SUM(win) AS w,
                     COUNT(CASE WHEN teamid IS NULL OR teamid NOT IN (100, 200) THEN 1 END) AS b FROM {src} GROUP BY matchid) g) z"""


_REPORT = " UNION ALL ".join(
    [_static("raw_stats", "exists", c, True, "stats") for c in ("id", "win", "kills", "deaths", "assists", "goldearned")]
    + [_count_row("raw_stats", "not_null", "id", "id IS NULL", "*", "stats"), _unique_row("raw_stats", "unique", "id", ["id"], "stats"),
       _count_row("raw_stats", "in_set", "win", "win IS NOT NULL AND win NOT IN (0, 1)", "win", "stats")]
    + [_count_row("raw_stats", "between", c, f"{c} IS NOT NULL AND {c} < 0", c, "stats") for c in ("kills", "deaths", "assists", "goldearned")]
    + [_count_row("raw_matches", "not_null", "id", "id IS NULL", "*", "matches"), _unique_row("raw_matches", "unique", "id", ["id"], "matches"),
       _count_row("raw_matches", "between", "duration", "duration IS NOT NULL AND (duration < 0 OR duration > 7200)", "duration", "matches"),
       _count_row("merged", "not_null", "matchid", "matchid IS NULL", "*", "merged"), _count_row("merged", "not_null", "teamid", "teamid IS NULL", "*", "merged"),
       _count_row("merged", "between", "duration", "duration IS NOT NULL AND (duration < 300 OR duration > 7200)", "duration", "merged"),
       *_side_rows("merged", "merged"), _grain_row("merged", "merged"),
       *[_static("processed", "exists", c, True, "cleaned") for c in ("matchid", "teamid", "win")],
       _static("processed", "column_count_between", None, True, "cleaned"), *_side_rows("processed", "cleaned"),
       *[_count_row("processed", "not_null", c, f"{c} IS NULL", "*", "cleaned") for c in PROCESSED_COLS], _grain_row("processed", "cleaned"),
       """SELECT 'raw_matches' AS suite, 'short_duration_monitor' AS expectation, 'duration' AS column_name, 1 AS success,
  CAST(COUNT(CASE WHEN duration < 300 THEN 1 END) AS BIGINT) AS unexpected_count, COUNT(*) AS element_count FROM matches"""])


@query("quality_report", with_fixture(POST + f""", report AS ({_REPORT})
SELECT * FROM report UNION ALL
SELECT 'all' AS suite, 'all_checkpoints_passed' AS expectation, NULL AS column_name, MIN(success) AS success,
       CAST(SUM(1 - success) AS BIGINT) AS unexpected_count, COUNT(*) AS element_count FROM report"""))
def q_quality_report(spark, sf):
    """The four checkpoints (raw statistics, raw groups, merged, processed features) with row
    counts, grain reports, the short-duration monitor and the overall pass (#170)."""
    from ..operators.clean import violation_counts
    t = tables(spark, sf)
    merged, done = stage_merged(spark, sf), stage_cleaned(spark, sf).select(*PROCESSED_COLS)
    for frame in (merged, done):
        Q.forbid_columns(frame, NO_OUTCOME)

    def grain(frame, suite):
        return violation_counts(frame).select(
            F.lit(suite).alias("suite"), F.lit("grain").alias("expectation"), F.lit(None).cast("string").alias("column_name"),
            ((F.col("duplicate_match_team_rows") + F.col("invalid_teamid_rows")) == 0).cast("int").alias("success"),
            (F.col("invalid_match_team_count") + F.col("invalid_winner_matches")).alias("unexpected_count"), F.col("rows").alias("element_count"))

    monitor = Q.short_rows_monitor(t["matches"]).select(
        F.lit("raw_matches").alias("suite"), F.lit("short_duration_monitor").alias("expectation"), F.lit("duration").alias("column_name"),
        F.lit(1).alias("success"), F.col("short_rows").alias("unexpected_count"), F.col("rows").alias("element_count"))
    parts = [Q.run_suite(t["stats"], STATS_SUITE, "raw_stats"),
             Q.run_suite(t["matches"], [Q.expect_not_null("id"), Q.expect_unique("id"), Q.expect_between("duration", 0, 7200)], "raw_matches"),
             Q.run_suite(merged, [Q.expect_not_null("matchid"), Q.expect_not_null("teamid"), Q.expect_between("duration", 300, 7200),
                                  *SIDE_CHECKS], "merged"), grain(merged, "merged"),
             Q.run_suite(done, [*[Q.expect_column_exists(c) for c in ("matchid", "teamid", "win")], Q.expect_column_count_between(10),
                                *SIDE_CHECKS, *[Q.expect_not_null(c) for c in done.columns]], "processed"), grain(done, "processed"), monitor]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    out = cut_lineage(out)  # a row per expectation
    passed = out.agg(F.min("success").alias("success"), F.sum(1 - F.col("success")).cast("bigint").alias("unexpected_count"),
                     F.count(F.lit(1)).alias("element_count"))
    return out.unionByName(passed.select(F.lit("all").alias("suite"), F.lit("all_checkpoints_passed").alias("expectation"),
                                         F.lit(None).cast("string").alias("column_name"), "success", "unexpected_count", "element_count"))


@query("short_rows_monitor", with_fixture("""
SELECT CAST(SUM(CASE WHEN duration < 300 THEN 1 ELSE 0 END) AS BIGINT) AS short_rows, CAST(COUNT(*) AS BIGINT) AS rows FROM matches"""))
def q_short_rows_monitor(spark, sf):
    return Q.short_rows_monitor(tables(spark, sf)["matches"])


# ---------------------------------------------------------------- descriptive statistics
DESC_COLS = ["kills_sum", "goldearned_sum", "duration"]


@query("describe_percentiles", with_fixture(POST + "\n" + " UNION ALL ".join(
    f"""SELECT '{c}' AS feature, CAST(COUNT({c}) AS BIGINT) AS count, {rnd(f'AVG({c})')} AS mean, {rnd(f'STDDEV_SAMP({c})')} AS std,
       {rnd(f'MIN({c})')} AS min, {rnd(f'MAX({c})')} AS max, """ + ", ".join(
        f"{rnd(f'QUANTILE_CONT({c}, {p})')} AS p{int(round(p * 100)):02d}" for p in (0.05, 0.25, 0.5, 0.75, 0.95))
    + " FROM merged" for c in DESC_COLS)))
def q_describe_percentiles(spark, sf):
    return round_doubles(ST.describe_percentiles(stage_merged(spark, sf), DESC_COLS))


@query("value_counts", with_fixture("""
SELECT platformid AS value, CAST(COUNT(*) AS BIGINT) AS count, ROUND(CAST(COUNT(*) AS DOUBLE) / (SELECT COUNT(*) FROM matches), 6) AS share
FROM matches GROUP BY platformid"""))
def q_value_counts(spark, sf):
    return round_doubles(ST.value_counts(tables(spark, sf)["matches"], "platformid"))


CAT_RATE_SQL = PM + """
, cr AS (SELECT championid AS category, CAST(COUNT(*) AS BIGINT) AS games, CAST(SUM(win) AS BIGINT) AS wins,
                CAST(SUM(win) AS DOUBLE) / COUNT(*) AS rate
         FROM pm WHERE matchid IS NOT NULL AND teamid IN (100, 200) GROUP BY championid HAVING COUNT(*) >= 20),
crn AS (SELECT cr.*, COALESCE(c.name, 'ID:' || CAST(cr.category AS VARCHAR)) AS name
        FROM cr LEFT JOIN champs c ON cr.category = c.id)"""


def _cat_rate(spark, sf):
    return ST.category_outcome_rate(stage_members(spark, sf), "championid", "win", tables(spark, sf)["champs"], 20)


@query("category_outcome_rate", with_fixture(CAT_RATE_SQL + f"\nSELECT category, games, wins, {rnd('rate')} AS rate, name FROM crn"))
def q_category_outcome_rate(spark, sf):
    return round_doubles(_cat_rate(spark, sf))


@query("top_bottom_k", with_fixture(CAT_RATE_SQL + f"""
SELECT * FROM (SELECT category, games, wins, {rnd('rate')} AS rate, name, 'top' AS side FROM crn ORDER BY rate DESC, category LIMIT 5)
UNION ALL
SELECT * FROM (SELECT category, games, wins, {rnd('rate')} AS rate, name, 'bottom' AS side FROM crn ORDER BY rate ASC, category LIMIT 5)"""))
def q_top_bottom_k(spark, sf):
    return round_doubles(ST.top_bottom_k(_cat_rate(spark, sf), "rate", 5))


@query("rate_by_level", with_fixture(POST + f"""
SELECT firstblood, {rnd('AVG(CAST(win AS DOUBLE))')} AS rate, CAST(COUNT(*) AS BIGINT) AS rows FROM merged GROUP BY firstblood"""))
def q_rate_by_level(spark, sf):
    return round_doubles(ST.rate_by_level(stage_merged(spark, sf), "firstblood", "win"))


@query("trimmed_histogram", with_fixture(POST + f"""
, b AS (SELECT QUANTILE_CONT(goldearned_sum, 0.01) AS lo, QUANTILE_CONT(goldearned_sum, 0.99) AS hi FROM merged)
SELECT CAST(LEAST(FLOOR((goldearned_sum - lo) * (15.0 / (hi - lo))), 14) AS INTEGER) AS bin, CAST(COUNT(*) AS BIGINT) AS count,
       {rnd('MAX(lo)')} AS lo, {rnd('MAX(hi)')} AS hi
FROM merged, b WHERE goldearned_sum >= lo AND goldearned_sum <= hi GROUP BY 1"""))
def q_trimmed_histogram(spark, sf):
    return round_doubles(ST.trimmed_histogram(stage_merged(spark, sf), "goldearned_sum"))


@query("box_stats", with_fixture(POST + f"""
, q AS (SELECT CAST(win AS VARCHAR) AS win, QUANTILE_CONT(goldearned_sum, 0.25) AS q1, QUANTILE_CONT(goldearned_sum, 0.5) AS median,
               QUANTILE_CONT(goldearned_sum, 0.75) AS q3 FROM merged GROUP BY win)
SELECT q.win, {rnd('q1')} AS q1, {rnd('median')} AS median, {rnd('q3')} AS q3, {rnd('q3 - q1')} AS iqr,
       {rnd('MIN(CASE WHEN m.goldearned_sum >= q1 - 1.5 * (q3 - q1) THEN m.goldearned_sum END)')} AS whisker_low,
       {rnd('MAX(CASE WHEN m.goldearned_sum <= q3 + 1.5 * (q3 - q1) THEN m.goldearned_sum END)')} AS whisker_high,
       CAST(SUM(CASE WHEN m.goldearned_sum < q1 - 1.5 * (q3 - q1) OR m.goldearned_sum > q3 + 1.5 * (q3 - q1) THEN 1 ELSE 0 END) AS BIGINT) AS outliers
FROM merged m JOIN q ON CAST(m.win AS VARCHAR) = q.win GROUP BY q.win, q1, median, q3"""))
def q_box_stats(spark, sf):
    return round_doubles(ST.box_stats(stage_merged(spark, sf), "goldearned_sum", "win"))


@query("kde_grid", with_fixture(POST + f"""
, s AS (SELECT win AS g, COUNT(*) AS n, STDDEV_SAMP(goldearned_sum) * POWER(CAST(COUNT(*) AS DOUBLE), -0.2) AS bw,
               MIN(goldearned_sum) AS mn, MAX(goldearned_sum) AS mx FROM merged GROUP BY win),
s2 AS (SELECT g, n, bw, mn - 3.0 * bw AS lo, (mx + 3.0 * bw - (mn - 3.0 * bw)) / 199 AS step FROM s),
c AS (SELECT win AS g, goldearned_sum AS x, COUNT(*) AS cnt FROM merged GROUP BY win, goldearned_sum),
grid AS (SELECT s2.*, i FROM s2, range(0, 200) r(i))
SELECT grid.g AS win, CAST(grid.i AS INTEGER) AS i, {rnd('MAX(grid.lo + grid.i * grid.step)')} AS grid,
       {rnd('SUM(c.cnt * EXP(-0.5 * ((grid.lo + grid.i * grid.step - c.x) / grid.bw) * ((grid.lo + grid.i * grid.step - c.x) / grid.bw)) / (grid.bw * SQRT(2 * PI()))) / MAX(grid.n)')} AS density
FROM grid JOIN c ON grid.g = c.g GROUP BY grid.g, grid.i"""))
def q_kde_grid(spark, sf):
    return round_doubles(ST.kde_grid(stage_merged(spark, sf), "goldearned_sum", "win"))


@query("schema_profile", with_fixture("\n" + " UNION ALL ".join(
    f"""SELECT '{c}' AS column_name, '{t}' AS dtype, CAST(COUNT({c}) AS BIGINT) AS non_null,
       ROUND((1 - CAST(COUNT({c}) AS DOUBLE) / COUNT(*)) * 100, 2) AS null_pct, CAST(COUNT(DISTINCT {c}) AS BIGINT) AS distinct,
       (SELECT string_agg(v, ', ' ORDER BY v) FROM (SELECT DISTINCT CAST({c} AS VARCHAR) AS v FROM matches WHERE {c} IS NOT NULL ORDER BY v LIMIT 3) z) AS samples
       FROM matches""" for c, t in (("id", "bigint"), ("platformid", "string"), ("seasonid", "bigint"), ("duration", "bigint")))))
def q_schema_profile(spark, sf):
    return ST.schema_profile(tables(spark, sf)["matches"])


SEL_COLS = ["kills_sum", "deaths_sum", "assists_sum", "goldearned_sum", "goldspent_sum", "kills_mean",
            "goldearned_mean", "towerkills", "dragonkills", "baronkills"]


@query("corr_with_target", with_fixture(POST + "\nSELECT * FROM (" + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, {rnd(f'ABS(COVAR_SAMP({c}, CAST(win AS DOUBLE)) / NULLIF(STDDEV_SAMP({c}) * STDDEV_SAMP(CAST(win AS DOUBLE)), 0))')} AS abs_corr FROM cleaned"
    for c in SEL_COLS) + ") x ORDER BY abs_corr DESC NULLS LAST, feature LIMIT 20"))
def q_corr_with_target(spark, sf):
    return round_doubles(ST.corr_with_target(stage_cleaned(spark, sf), SEL_COLS, "win"))


def _train(spark, sf):
    return SP.split_grouped(stage_cleaned(spark, sf)).where(F.col("split") == "train")


@query("correlation_matrix", with_fixture(POST + "\nSELECT * FROM (" + " UNION ALL ".join(
    f"SELECT '{a}' AS a, '{b}' AS b, {rnd(f'CORR({a}, {b})')} AS r FROM cleaned WHERE {TRAIN}"
    for a in SEL_COLS for b in SEL_COLS) + ") x"))
def q_correlation_matrix(spark, sf):
    """Pearson matrix from one Gram pass over the training rows (#106)."""
    g = SEL.gram(_train(spark, sf), SEL_COLS)
    return round_doubles(SEL.correlation_matrix(spark, g))


def _drop_sql():
    parts = []
    for j, b in enumerate(SEL_COLS):
        if j == 0:
            parts.append(f"SELECT '{b}' AS feature, 0 AS dropped")
            continue
        conds = " OR ".join(f"ABS(CORR({a}, {b})) > 0.98" for a in SEL_COLS[:j])
        parts.append(f"SELECT '{b}' AS feature, CASE WHEN {conds} THEN 1 ELSE 0 END AS dropped FROM cleaned WHERE {TRAIN}")
    return " UNION ALL ".join(parts)


@query("drop_high_correlation", with_fixture(POST + "\n" + _drop_sql()))
def q_drop_high_correlation(spark, sf):
    g = SEL.gram(_train(spark, sf), SEL_COLS)
    _, drop = SEL.drop_high_correlation(g)
    return spark.createDataFrame([(c, int(c in drop)) for c in SEL_COLS], "feature string, dropped int")


VIF2 = ("kills_sum", "deaths_sum")


@query("vif", with_fixture(POST + f"""
, g AS (SELECT SUM(kills_sum * kills_sum) AS a, SUM(kills_sum * deaths_sum) AS b, SUM(deaths_sum * deaths_sum) AS c
        FROM cleaned WHERE {TRAIN})
SELECT 'kills_sum' AS feature, {rnd('a * c / (a * c - b * b)')} AS vif FROM g
UNION ALL SELECT 'deaths_sum', {rnd('a * c / (a * c - b * b)')} FROM g"""))
def q_vif(spark, sf):
    """Uncentred VIF (no intercept) from the Gram matrix; k = 2 here (#108)."""
    g = SEL.gram(_train(spark, sf), list(VIF2))
    s = SEL.vif_scores(g)
    return round_doubles(spark.createDataFrame([(c, s[c]) for c in VIF2], "feature string, vif double"))


@query("vif_centred", with_fixture(POST + f"""
, g AS (SELECT CORR(kills_sum, deaths_sum) AS r FROM cleaned WHERE {TRAIN})
SELECT 'kills_sum' AS feature, {rnd('1 / (1 - r * r)')} AS vif FROM g
UNION ALL SELECT 'deaths_sum', {rnd('1 / (1 - r * r)')} FROM g"""))
def q_vif_centred(spark, sf):
    """VIF with an intercept: diagonal of the inverse correlation matrix (#109)."""
    g = SEL.gram(_train(spark, sf), list(VIF2))
    s = SEL.vif_scores(g, centred=True)
    return round_doubles(spark.createDataFrame([(c, s[c]) for c in VIF2], "feature string, vif double"))


@query("drop_high_vif")
def q_drop_high_vif(spark, sf):
    """VIF filter over the candidate features with the keep-all fallback (#110)."""
    g = SEL.gram(_train(spark, sf), SEL_COLS)
    keep, drop, scores = SEL.drop_high_vif(g, min_features=5)
    return spark.createDataFrame([(c, float(scores[c]), int(c in drop)) for c in SEL_COLS],
                                 "feature string, vif double, dropped int")


@query("pca_components_95")
def q_pca_components_95(spark, sf):
    g = SEL.gram(_train(spark, sf), SEL_COLS)
    return spark.createDataFrame([(len(SEL_COLS), SEL.pca_components_95(g))], "features int, components_95 int")


SCALE_COLS = ["kills_sum", "goldearned_sum", "towerkills", "firstblood", "kills_mean", "is_blue_side"]


def _scale_sql(c):
    src = f"(SELECT * FROM cleaned WHERE {TRAIN})"
    return f"""SELECT '{c}' AS feature, kind,
  ROUND(CASE WHEN kind = 'binary' THEN md ELSE q2 END, 6) AS impute,
  ROUND(CASE kind WHEN 'binary' THEN 0.0 WHEN 'robust' THEN q2 ELSE mean END, 6) AS center,
  ROUND(CASE kind WHEN 'binary' THEN 1.0 WHEN 'robust' THEN CASE WHEN q3 - q1 = 0 THEN 1.0 ELSE q3 - q1 END
             ELSE CASE WHEN sd = 0 OR sd IS NULL THEN 1.0 ELSE sd END END, 6) AS scale
FROM (SELECT *, CASE WHEN isbin THEN 'binary' WHEN q3 - q1 <> 0 AND share > 0.05 THEN 'robust' ELSE 'standard' END AS kind
  FROM (SELECT COUNT({c}) > 0 AND COUNT(CASE WHEN {c} NOT IN (0, 1) THEN 1 END) = 0 AS isbin,
               QUANTILE_CONT(CAST({c} AS DOUBLE), 0.25) AS q1, QUANTILE_CONT(CAST({c} AS DOUBLE), 0.5) AS q2,
               QUANTILE_CONT(CAST({c} AS DOUBLE), 0.75) AS q3, AVG(CAST({c} AS DOUBLE)) AS mean,
               STDDEV_POP(CAST({c} AS DOUBLE)) AS sd,
               (SELECT CAST(v AS DOUBLE) FROM (SELECT {c} AS v, COUNT(*) AS n FROM {src} s WHERE {c} IS NOT NULL GROUP BY {c}
                ORDER BY n DESC, v ASC LIMIT 1)) AS md
        FROM {src} t) a,
       (SELECT AVG(CASE WHEN CAST({c} AS DOUBLE) < q1 - 1.5 * (q3 - q1) OR CAST({c} AS DOUBLE) > q3 + 1.5 * (q3 - q1) THEN 1.0 ELSE 0.0 END) AS share
        FROM {src} t2, (SELECT QUANTILE_CONT(CAST({c} AS DOUBLE), 0.25) AS q1, QUANTILE_CONT(CAST({c} AS DOUBLE), 0.75) AS q3 FROM {src} t3) qq) o) z"""


@query("scaling_groups", with_fixture(POST + "\n" + " UNION ALL ".join(_scale_sql(c) for c in SCALE_COLS)))
def q_scaling_groups(spark, sf):
    """Binary / robust / standard grouping with its fitted impute, center and
    scale: the preprocessing artifact (#112-#115)."""
    return round_doubles(SEL.scaling_artifact(_train(spark, sf), SCALE_COLS))


@query("standard_scale", with_fixture(POST + f"""
, st AS (SELECT AVG(kills_mean) AS m, STDDEV_POP(kills_mean) AS s FROM cleaned WHERE {TRAIN})
SELECT matchid, teamid, {rnd('(kills_mean - m) / CASE WHEN s = 0 THEN 1.0 ELSE s END')} AS kills_mean FROM cleaned, st"""))
def q_standard_scale(spark, sf):
    """(x - mean) / population std fitted on train, applied to every row (#115)."""
    from ..operators.selection import apply_scaling
    one = _train(spark, sf).agg(F.avg("kills_mean").alias("m"), F.stddev_pop("kills_mean").alias("s"),
                                F.median("kills_mean").alias("med")).first()
    art = {"feature": "kills_mean", "kind": "standard", "impute": one["med"], "center": one["m"],
           "scale": one["s"] or 1.0}
    return round_doubles(apply_scaling(stage_cleaned(spark, sf), [art], keep=["matchid", "teamid"]))


@query("robust_scale", with_fixture(POST + f"""
, st AS (SELECT QUANTILE_CONT(goldearned_sum, 0.5) AS med, QUANTILE_CONT(goldearned_sum, 0.75) - QUANTILE_CONT(goldearned_sum, 0.25) AS iqr
         FROM cleaned WHERE {TRAIN})
SELECT matchid, teamid, {rnd('(goldearned_sum - med) / CASE WHEN iqr = 0 THEN 1.0 ELSE iqr END')} AS goldearned_sum FROM cleaned, st"""))
def q_robust_scale(spark, sf):
    """(x - median) / IQR fitted on train with exact quantiles (#114)."""
    from ..operators.ordered import exact_quantiles
    from ..operators.selection import apply_scaling
    cleaned = cut_lineage(stage_cleaned(spark, sf).select("matchid", "teamid", "goldearned_sum"))  # fitted on and scaled
    train = SP.split_grouped(cleaned).where(F.col("split") == "train")
    q = {r["p"]: r["value"] for r in exact_quantiles(train, ["goldearned_sum"], [0.25, 0.5, 0.75], materialize=False).collect()}
    iqr = q[0.75] - q[0.25]
    art = {"feature": "goldearned_sum", "kind": "robust", "impute": q[0.5], "center": q[0.5], "scale": iqr or 1.0}
    return round_doubles(apply_scaling(cleaned, [art], keep=["matchid", "teamid"]))


@query("impute", with_fixture(POST + f"""
, st AS (SELECT QUANTILE_CONT(CASE WHEN teamid = 100 THEN NULL ELSE kills_sum END, 0.5) AS med FROM cleaned WHERE {TRAIN})
SELECT matchid, teamid, {rnd('COALESCE(CASE WHEN teamid = 100 THEN NULL ELSE kills_sum END, med)')} AS kills_sum FROM cleaned, st"""))
def q_impute(spark, sf):
    """Median imputation fitted on train; blue-side values are masked to create the gaps (#113)."""
    from ..operators.ordered import exact_quantiles
    masked = stage_cleaned(spark, sf).withColumn(
        "kills_sum", F.when(F.col("teamid") == 100, F.lit(None).cast("double")).otherwise(F.col("kills_sum")))
    train = SP.split_grouped(masked).where(F.col("split") == "train")
    med = exact_quantiles(train, ["kills_sum"], [0.5]).first()["value"]
    return round_doubles(masked.select("matchid", "teamid", F.coalesce("kills_sum", F.lit(med)).alias("kills_sum")))


def post_feature_frame(spark, sf):
    from ..operators import features as FE
    return SP.split_grouped(FE.team_features(FE.player_features(stage_cleaned(spark, sf))))


@query("fit_transform_splits")
def q_fit_transform_splits(spark, sf):
    """Correlation -> VIF -> PCA diagnostic -> scaling fitted on train, one
    select for every split; output [ids, split, features..., target] (#116)."""
    frame = post_feature_frame(spark, sf)
    feats = select_candidates(frame.drop("split"))
    out, _, _ = SEL.fit_transform_splits(frame, feats, "win")
    return out


LEAKY_HERE = ("win", "participant_win_consistency", "participant_win_inconsistent", "firstblood")
_NULLS = "(UNPIVOT (SELECT COUNT(*) - COUNT(COLUMNS('(.*)')) AS '\\1' FROM cleaned) ON COLUMNS(*) INTO NAME column_name VALUE nulls)"


@query("split_leaky_columns", with_fixture(POST + f"""
SELECT column_name, (SELECT COUNT(*) FROM cleaned) AS rows, nulls,
       CASE WHEN column_name IN {LEAKY_HERE} THEN 1 ELSE 0 END AS leaky FROM {_NULLS} u"""))
def q_split_leaky_columns(spark, sf):
    """Every column of the cleaned frame with its rows, NULLs and leak classification (#26)."""
    return leakage_table(stage_cleaned(spark, sf))


@query("select_candidates", with_fixture(POST + f"""
SELECT column_name AS feature, (SELECT COUNT(*) FROM cleaned) - nulls AS non_null FROM {_NULLS} u
WHERE column_name NOT IN {LEAKY_HERE} AND column_name NOT IN ('matchid', 'teamid', 'platformid', 'seasonid', 'duration')"""))
def q_select_candidates(spark, sf):
    """Numeric, non-reserved, non-leaky columns of the cleaned frame with their non-NULL rows (#27)."""
    frame = stage_cleaned(spark, sf)
    profile = column_profile(frame).where(F.col("column_name").isin(*select_candidates(frame)))
    return profile.select(F.col("column_name").alias("feature"), (F.col("rows") - F.col("nulls")).alias("non_null"))


@query("drop_by_pattern", with_fixture(POST + "\nSELECT matchid, teamid, win, " + ", ".join(rnd(c) + " AS " + c for c in ("deaths_sum", "goldearned_sum", "goldspent_sum")) + " FROM cleaned"))
def q_drop_by_pattern(spark, sf):
    """Drop every column whose name contains 'kill', 'assist', 'mean', 'rate',
    'first', 'consist', 'side', 'platform', 'season', 'duration', 'tower',
    'dragon' or 'baron' (case-insensitive) (#28)."""
    pats = ["KILL", "assist", "mean", "rate", "first", "consist", "side", "platform", "season", "duration",
            "tower", "dragon", "baron"]
    return round_doubles(drop_by_pattern(stage_cleaned(spark, sf), pats))


@query("align_schema", with_fixture(POST + "\nSELECT ROUND(kills_sum, 6) AS kills_sum, CAST(0.0 AS DOUBLE) AS visionscore_sum, win FROM cleaned"))
def q_align_schema(spark, sf):
    """Reorder to a model's column list; missing columns become 0.0 (#30)."""
    return round_doubles(align_schema(stage_cleaned(spark, sf), ["kills_sum", "visionscore_sum", "win"]))
