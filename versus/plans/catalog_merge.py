"""Queries: member join, side aggregates, merge, cleaning and integrity."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..constants import KEYS, MIN_DURATION_SECONDS
from ..operators import clean as C
from ..operators import features as FE
from ..operators import relational as R
from ..sources.fixture import DEFAULT_SLOTS
from .common import rnd, round_doubles
from .postgame import postgame_sides
from .registry import query, tables, with_fixture
from .sqlparts import (CLEANED, MERGED, MERGED_COLUMNS, PM, SIDE_COLUMNS, SIDES, STAT_FEATURES)


def stage_members(spark, sf):
    return R.assign_sides(tables(spark, sf, wide=True)["members"], DEFAULT_SLOTS)


def binary_stats(t) -> list[str]:
    """Binary statistics, found without ranking the lines: the slots do not matter for them."""
    members = t["members"].drop("id", "player")
    return R.detect_binary(members, R.feature_columns_for_aggregation(members))


def stage_sides(spark, sf):
    t = tables(spark, sf, wide=True, picks=False)
    return R.aggregate_sides(R.assign_sides(t["members"], DEFAULT_SLOTS), binary=binary_stats(t))


def stage_merged(spark, sf):
    t = tables(spark, sf, wide=True, picks=False)
    return postgame_sides(R.assign_sides(t["members"], DEFAULT_SLOTS), t["matches"], t["teamstats"], binary_stats(t))


def stage_cleaned(spark, sf):
    return C.clean_dataset(stage_merged(spark, sf), MIN_DURATION_SECONDS, never_null=KEYS)  # assign_sides drops NULL keys


# ---------------------------------------------------------------- flagship
FLAGSHIP_SQL = with_fixture(PM + SIDES + f"""
SELECT matchid, teamid,
       {", ".join(rnd(c) + " AS " + c for c in SIDE_COLUMNS if c not in ("win", "participant_win_inconsistent"))},
       win, participant_win_inconsistent,
       {rnd("2 * goldearned_sum - SUM(goldearned_sum) OVER (PARTITION BY matchid)")} AS goldearned_sum_diff_vs_opp,
       {rnd("(kills_sum + assists_sum) / GREATEST(GREATEST(deaths_sum, 1), 1e-6)")} AS kda_ratio
FROM sides""")


@query("flagship_side_totals", FLAGSHIP_SQL)
def flagship_side_totals(spark, sf):
    """Side totals with the win label, opponent gold difference and KDA
    (#33 -> #22 -> #42 + #45 -> #61 -> #87)."""
    sides = stage_sides(spark, sf)
    out = FE.diff_vs_opponent(sides, ["goldearned_sum"]).transform(FE.kda_ratio)
    return round_doubles(out)


# ---------------------------------------------------------------- joins / aggregates
@query("join_inner_stats", with_fixture(f"""
SELECT p.id, p.matchid, p.player, p.championid, p.position, p.role, s.win,
       {", ".join(rnd("s." + c) + " AS " + c for c in STAT_FEATURES)}
FROM participants p JOIN stats s ON p.id = s.id"""))
def q_join_inner_stats(spark, sf):
    t = tables(spark, sf, wide=True)
    return round_doubles(R.join_inner_stats(t["participants"], t["stats"]))


@query("infer_side", with_fixture(PM + """
SELECT id, matchid, player, teamid FROM pm"""))
def q_infer_side(spark, sf):
    t = tables(spark, sf)
    p = t["participants"]
    from ..functions.scalars import fill_side
    return p.select("id", "matchid", "player", fill_side(F.lit(None), "player", DEFAULT_SLOTS).alias("teamid"))


@query("agg_sum_mean_all", with_fixture(PM + SIDES + f"""
SELECT matchid, teamid, {", ".join(rnd(c) + " AS " + c for c in SIDE_COLUMNS if c.endswith(("_sum", "_mean")))}
FROM sides"""))
def q_agg_sum_mean_all(spark, sf):
    return round_doubles(R.aggregate_sides(stage_members(spark, sf), binary=[], with_label=False))


@query("detect_binary", with_fixture(PM + " " + " UNION ALL ".join(
    f"""SELECT '{c}' AS column_name,
       CASE WHEN COUNT({c}) > 0 AND COUNT(CASE WHEN {c} NOT IN (0, 1) THEN 1 END) = 0 THEN 1 ELSE 0 END AS is_binary
       FROM pm WHERE matchid IS NOT NULL AND teamid IN (100, 200)""" for c in STAT_FEATURES)))
def q_detect_binary(spark, sf):
    members = stage_members(spark, sf)
    feats = R.feature_columns_for_aggregation(members)
    found = set(R.detect_binary(members, feats))
    rows = [(c, int(c in found)) for c in feats]
    # the detection is the job above; its small answer is returned as a frame
    return spark.createDataFrame(rows, "column_name string, is_binary int")


@query("agg_binary_rate", with_fixture(PM + SIDES + """
SELECT matchid, teamid, ROUND(firstbloodkill_rate, 6) AS firstbloodkill_rate FROM sides"""))
def q_agg_binary_rate(spark, sf):
    sides = R.aggregate_sides(stage_members(spark, sf))
    return round_doubles(sides.select("matchid", "teamid", *[c for c in sides.columns if c.endswith("_rate")]))


@query("derive_group_label", with_fixture(PM + f"""
SELECT matchid, teamid, CASE WHEN AVG(win) >= 0.5 THEN 1 ELSE 0 END AS win,
       ROUND(CAST(GREATEST(SUM(win), COUNT(win) - SUM(win)) AS DOUBLE) / GREATEST(COUNT(win), 1), 6) AS participant_win_consistency,
       CASE WHEN COUNT(DISTINCT win) > 1 THEN 1 ELSE 0 END AS participant_win_inconsistent
FROM pm WHERE matchid IS NOT NULL AND teamid IN (100, 200) GROUP BY matchid, teamid"""))
def q_derive_group_label(spark, sf):
    return round_doubles(R.derive_group_label(stage_members(spark, sf)))


@query("join_left_dedup", with_fixture(PM + SIDES + """
, ts AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY matchid, teamid
                    ORDER BY firstblood, towerkills, dragonkills, baronkills) AS rn FROM teamstats)
SELECT s.matchid, s.teamid, s.win, t.firstblood, t.towerkills, t.dragonkills, t.baronkills
FROM sides s LEFT JOIN ts t ON s.matchid = t.matchid AND s.teamid = t.teamid AND t.rn = 1"""))
def q_join_left_dedup(spark, sf):
    t = tables(spark, sf, wide=True)
    sides = R.derive_group_label(stage_members(spark, sf)).select("matchid", "teamid", "win")
    return R.join_left_dedup(sides, t["teamstats"])


@query("join_left_dimension", with_fixture(PM + SIDES + """
SELECT s.matchid, s.teamid, s.win, m.platformid, m.seasonid, m.duration
FROM sides s LEFT JOIN matches m ON s.matchid = m.id"""))
def q_join_left_dimension(spark, sf):
    t = tables(spark, sf)
    sides = R.derive_group_label(stage_members(spark, sf)).select("matchid", "teamid", "win")
    return R.join_left_dimension(sides, t["matches"])


@query("side_flag", with_fixture(PM + SIDES + """
SELECT matchid, teamid, CASE WHEN teamid = 100 THEN 1 ELSE 0 END AS is_blue_side FROM sides"""))
def q_side_flag(spark, sf):
    sides = R.derive_group_label(stage_members(spark, sf)).select("matchid", "teamid")
    return R.with_side_flag(sides)


def merged_select(src: str) -> str:
    dbl = set(c for c in SIDE_COLUMNS if c not in ("win", "participant_win_inconsistent"))
    return ", ".join(rnd(c) + " AS " + c if c in dbl else c for c in MERGED_COLUMNS) + f" FROM {src}"


@query("postgame_dataset", with_fixture(PM + SIDES + MERGED + "\nSELECT " + merged_select("merged")))
def q_postgame_dataset(spark, sf):
    return round_doubles(stage_merged(spark, sf))


@query("clean_dataset", with_fixture(PM + SIDES + MERGED + CLEANED + "\nSELECT " + merged_select("cleaned")))
def q_clean_dataset(spark, sf):
    return round_doubles(stage_cleaned(spark, sf))


@query("group_integrity_filter", with_fixture(PM + SIDES + MERGED + """
, valid AS (SELECT matchid FROM merged GROUP BY matchid HAVING COUNT(DISTINCT teamid) = 2 AND SUM(win) = 1)
SELECT matchid, teamid, win FROM merged WHERE matchid IN (SELECT matchid FROM valid)"""))
def q_group_integrity_filter(spark, sf):
    return C.group_integrity_filter(stage_merged(spark, sf)).select("matchid", "teamid", "win")


@query("min_duration_filter", with_fixture(PM + SIDES + MERGED + """
SELECT matchid, teamid, duration FROM merged WHERE duration >= 300"""))
def q_min_duration_filter(spark, sf):
    return C.min_duration_filter(stage_merged(spark, sf), MIN_DURATION_SECONDS).select(
        "matchid", "teamid", "duration")


INTEGRITY_SQL = """
, per_key AS (SELECT matchid, teamid, COUNT(*) AS n, SUM(COALESCE(CAST(win AS DOUBLE), 0)) AS w
              FROM {src} GROUP BY matchid, teamid),
per_group AS (SELECT matchid, COUNT(*) AS n_sides, SUM(w) AS wins FROM per_key
              WHERE matchid IS NOT NULL GROUP BY matchid)
SELECT CAST((SELECT SUM(n) FROM per_key) AS BIGINT) AS rows,
       CAST((SELECT COALESCE(SUM(n - 1), 0) FROM per_key) AS BIGINT) AS duplicate_match_team_rows,
       CAST((SELECT COALESCE(SUM(CASE WHEN teamid IS NULL OR teamid NOT IN (100, 200) THEN n END), 0) FROM per_key) AS BIGINT) AS invalid_teamid_rows,
       CAST((SELECT COUNT(*) FROM per_group) AS BIGINT) AS unique_matches,
       CAST((SELECT COUNT(*) FROM per_group WHERE n_sides <> 2) AS BIGINT) AS invalid_match_team_count,
       CAST((SELECT COUNT(*) FROM per_group WHERE wins <> 1) AS BIGINT) AS invalid_winner_matches"""


@query("integrity_report", with_fixture(PM + SIDES + MERGED + INTEGRITY_SQL.format(src="merged")))
def q_integrity_report(spark, sf):
    return C.violation_counts(stage_merged(spark, sf))


@query("assert_group_frame", with_fixture(PM + SIDES + MERGED + CLEANED + INTEGRITY_SQL.format(src="cleaned")))
def q_assert_group_frame(spark, sf):
    cleaned = stage_cleaned(spark, sf)
    return C.violation_counts(cleaned)


@query("frame_summary", with_fixture(PM + SIDES + MERGED + CLEANED + f"""
SELECT CAST(SUM(COUNT(*)) OVER () AS BIGINT) AS rows, CAST({len(MERGED_COLUMNS)} AS BIGINT) AS columns,
       CAST(0 AS BIGINT) AS missing_values, CAST(win AS VARCHAR) AS target_value,
       CAST(COUNT(*) AS BIGINT) AS target_count,
       ROUND(CAST(COUNT(*) AS DOUBLE) / SUM(COUNT(*)) OVER (), 6) AS target_rate
FROM cleaned GROUP BY win"""))
def q_frame_summary(spark, sf):
    return C.frame_summary(stage_cleaned(spark, sf))
