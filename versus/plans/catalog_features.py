"""Queries: splits, feature operators, encoders and the pre-game feature set."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..constants import ROLE_ORDER
from ..operators import encoders as EN
from ..operators import features as FE
from ..operators import reshape as RS
from ..operators import split as SP
from ..operators.clean import violation_counts
from ..operators.relational import assign_sides, detect_binary
from ..sources.fixture import DEFAULT_SLOTS
from .catalog_merge import merged_select, stage_cleaned, stage_merged
from .catalog_pregame import PREGAME_SQL, stage_pregame, stored_tables
from .common import rnd, round_doubles
from .postgame import postgame_sides
from .pregame import CODES, add_pregame_features
from .registry import ORACLE, query, with_fixture
from .sqlparts import CLEANED, MERGED, PM, SIDES, STAT_FEATURES
from ..session import cut_lineage

U_MATCH = "(CAST(('0x' || SUBSTR(MD5(CAST(matchid AS VARCHAR) || ':42'), 1, 8)) AS BIGINT) / 4294967296.0)"
U_ROW = ("(CAST(('0x' || SUBSTR(MD5(CAST(matchid AS VARCHAR) || ':' || CAST(teamid AS VARCHAR) || ':42'), 1, 8))"
         " AS BIGINT) / 4294967296.0)")
SPLIT = f"CASE WHEN matchid IS NULL THEN NULL WHEN {U_MATCH} < 0.2 THEN 'test' WHEN {U_MATCH} < 0.3 THEN 'val' ELSE 'train' END"

POST = PM + SIDES + MERGED + CLEANED


# ---------------------------------------------------------------- flows over stored tables
def _stored_postgame(spark, sf):
    return stored_tables(spark, sf).run(lambda t, one_pass: postgame_sides(
        assign_sides(t["members"], DEFAULT_SLOTS), t["matches"], t["teamstats"], detect_binary(t["members"], STAT_FEATURES)))


@query("postgame_dataset_bucketed", with_fixture(PM + SIDES + MERGED + "\nSELECT " + merged_select("merged")))
def q_postgame_dataset_bucketed(spark, sf):
    """#103 over tables stored by group."""
    return round_doubles(_stored_postgame(spark, sf))


@query("integrity_report_bucketed", ORACLE["integrity_report"])
def q_integrity_report_bucketed(spark, sf):
    """#48 over tables stored by group: sides, checks and report without a shuffle by group."""
    return violation_counts(_stored_postgame(spark, sf))


# ---------------------------------------------------------------- splits
@query("split_grouped", with_fixture(POST + f"\nSELECT matchid, teamid, {SPLIT} AS split FROM cleaned"))
def q_split_grouped(spark, sf):
    return SP.split_grouped(stage_cleaned(spark, sf)).select("matchid", "teamid", "split")


@query("anti_disjoint_check", with_fixture(POST + f"""
, s AS (SELECT DISTINCT matchid, {SPLIT} AS split FROM cleaned)
SELECT CAST((SELECT COUNT(*) FROM (SELECT matchid FROM s WHERE split = 'train' INTERSECT SELECT matchid FROM s WHERE split = 'val')) AS BIGINT) AS train_val,
       CAST((SELECT COUNT(*) FROM (SELECT matchid FROM s WHERE split = 'train' INTERSECT SELECT matchid FROM s WHERE split = 'test')) AS BIGINT) AS train_test,
       CAST((SELECT COUNT(*) FROM (SELECT matchid FROM s WHERE split = 'val' INTERSECT SELECT matchid FROM s WHERE split = 'test')) AS BIGINT) AS val_test"""))
def q_anti_disjoint_check(spark, sf):
    """Group keys shared by each pair of splits; all zero when disjoint (#41).
    One aggregate per key with split-membership flags, then one row."""
    from ..operators.relational import split_overlap_counts
    s = SP.split_grouped(stage_cleaned(spark, sf)).select("matchid", "split")
    return split_overlap_counts(s, "matchid", "split", ("train", "val", "test"))


@query("split_stratified", with_fixture(POST + f"""
SELECT matchid, teamid, win, CASE WHEN r < FLOOR(n * 0.2 + 0.5) THEN 'test'
       WHEN r < FLOOR(n * 0.2 + 0.5) + FLOOR((n - FLOOR(n * 0.2 + 0.5)) * (0.1 / (1 - 0.2)) + 0.5) THEN 'val'
       ELSE 'train' END AS split
FROM (SELECT matchid, teamid, win, ROW_NUMBER() OVER (PARTITION BY win ORDER BY {U_ROW}, matchid, teamid) - 1 AS r,
             COUNT(*) OVER (PARTITION BY win) AS n FROM cleaned) x"""))
def q_split_stratified(spark, sf):
    c = stage_cleaned(spark, sf).select("matchid", "teamid", "win")
    return SP.split_stratified(c, "win", ["matchid", "teamid"])


@query("stratified_cap", with_fixture(POST + f"""
, counts AS (SELECT win, COUNT(*) AS n FROM cleaned GROUP BY win),
quota0 AS (SELECT win, n, GREATEST(1, CAST(FLOOR(CAST(n AS DOUBLE) / (SELECT SUM(n) FROM counts) * 5000) AS BIGINT)) AS q FROM counts),
quota AS (SELECT win, q + CASE WHEN win = (SELECT win FROM quota0 ORDER BY n - q DESC, win LIMIT 1)
                          THEN 5000 - (SELECT SUM(q) FROM quota0) ELSE 0 END AS q FROM quota0)
SELECT matchid, teamid, win FROM (
  SELECT matchid, teamid, win, ROW_NUMBER() OVER (PARTITION BY win ORDER BY {U_ROW}, matchid, teamid) - 1 AS r FROM cleaned) x
WHERE r < (SELECT q FROM quota WHERE quota.win = x.win)"""))
def q_stratified_cap(spark, sf):
    """Class-preserving cap at 5,000 rows (#121). The oracle's top-up step is
    exact for two classes (the remainder after flooring is at most one row)."""
    c = cut_lineage(stage_cleaned(spark, sf).select("matchid", "teamid", "win"))  # counted, then ranked
    return SP.stratified_cap(c, "win", ["matchid", "teamid"], 5000)


@query("sample_rows", with_fixture(POST + f"""
SELECT matchid, teamid, win FROM cleaned ORDER BY {U_ROW}, matchid, teamid LIMIT 1000"""))
def q_sample_rows(spark, sf):
    c = stage_cleaned(spark, sf).select("matchid", "teamid", "win")
    return SP.sample_rows(c, 1000, ["matchid", "teamid"])


# ---------------------------------------------------------------- post-game features
def _post_features_frame(spark, sf):
    return FE.player_features(stage_merged(spark, sf))


MIN = "(GREATEST(CAST(COALESCE(duration, 0) AS DOUBLE), 60.0) / 60.0)"


@query("match_minutes", with_fixture(PM + SIDES + MERGED + f"\nSELECT matchid, teamid, {rnd(MIN)} AS match_minutes FROM merged"))
def q_match_minutes(spark, sf):
    return round_doubles(FE.match_minutes(stage_merged(spark, sf)).select("matchid", "teamid", "match_minutes"))


@query("phase_flags", with_fixture(PM + SIDES + MERGED + f"""
SELECT matchid, teamid, CASE WHEN {MIN} < 20 THEN 1 ELSE 0 END AS phase_early,
       CASE WHEN {MIN} >= 20 AND {MIN} < 30 THEN 1 ELSE 0 END AS phase_mid,
       CASE WHEN {MIN} >= 30 THEN 1 ELSE 0 END AS phase_late FROM merged"""))
def q_phase_flags(spark, sf):
    out = FE.phase_flags(FE.match_minutes(stage_merged(spark, sf)))
    return out.select("matchid", "teamid", "phase_early", "phase_mid", "phase_late")


KDA = "(kills_sum + assists_sum) / GREATEST(GREATEST(deaths_sum, 1.0), 1e-6)"
SPENT = "goldspent_sum / GREATEST(goldearned_sum, 1e-6)"


@query("kda_ratio", with_fixture(PM + SIDES + f"\nSELECT matchid, teamid, {rnd(KDA)} AS kda_ratio FROM sides"))
def q_kda_ratio(spark, sf):
    from ..operators.relational import aggregate_sides
    from .catalog_merge import stage_members
    return round_doubles(FE.kda_ratio(aggregate_sides(stage_members(spark, sf), binary=[])).select(
        "matchid", "teamid", "kda_ratio"))


@query("economy_ratios", with_fixture(PM + SIDES + f"\nSELECT matchid, teamid, {rnd(SPENT)} AS gold_spent_ratio FROM sides"))
def q_economy_ratios(spark, sf):
    from ..operators.relational import aggregate_sides
    from .catalog_merge import stage_members
    return round_doubles(FE.economy_ratios(aggregate_sides(stage_members(spark, sf), binary=[])).select(
        "matchid", "teamid", "gold_spent_ratio"))


@query("per_minute_rates", with_fixture(PM + SIDES + MERGED + f"""
SELECT matchid, teamid, {rnd(f"(kills_sum + assists_sum) / GREATEST({MIN}, 1e-6)")} AS cs_per_min,
       {rnd(f"deaths_sum / GREATEST({MIN}, 1e-6)")} AS vision_per_min FROM merged"""))
def q_per_minute_rates(spark, sf):
    """Per-minute rates with creep score = kills + assists and vision = deaths (#89)."""
    m = stage_merged(spark, sf).select("matchid", "teamid", "duration",
                                       F.col("kills_sum").alias("totminionskilled_sum"),
                                       F.col("assists_sum").alias("neutralminionskilled_sum"),
                                       F.col("deaths_sum").alias("visionscore_sum"))
    out = FE.per_minute_rates(FE.match_minutes(m))
    return round_doubles(out.select("matchid", "teamid", "cs_per_min", "vision_per_min"))


@query("jungle_share", with_fixture(PM + SIDES + f"""
SELECT matchid, teamid, {rnd("kills_sum / GREATEST(kills_sum + deaths_sum, 1e-6)")} AS jungle_control_share FROM sides"""))
def q_jungle_share(spark, sf):
    """own / (own + enemy) with own = kills, enemy = deaths (#90)."""
    from ..operators.relational import aggregate_sides
    from .catalog_merge import stage_members
    s = aggregate_sides(stage_members(spark, sf), binary=[]).select(
        "matchid", "teamid", F.col("kills_sum").alias("ownjunglekills_sum"),
        F.col("deaths_sum").alias("enemyjunglekills_sum"))
    return round_doubles(FE.jungle_share(s).select("matchid", "teamid", "jungle_control_share"))


_PF = [rnd(MIN) + " AS match_minutes", f"CASE WHEN {MIN} < 20 THEN 1 ELSE 0 END AS phase_early",
       f"CASE WHEN {MIN} >= 20 AND {MIN} < 30 THEN 1 ELSE 0 END AS phase_mid",
       f"CASE WHEN {MIN} >= 30 THEN 1 ELSE 0 END AS phase_late", rnd(KDA) + " AS kda_ratio",
       rnd(SPENT) + " AS gold_spent_ratio"]


@query("player_features", with_fixture(PM + SIDES + MERGED + "\nSELECT matchid, teamid, " + ", ".join(_PF) + " FROM merged"))
def q_player_features(spark, sf):
    out = _post_features_frame(spark, sf)
    return round_doubles(out.select("matchid", "teamid", "match_minutes", "phase_early", "phase_mid", "phase_late",
                                    "kda_ratio", "gold_spent_ratio"))


OBJ = "(CAST(COALESCE(towerkills, 0) AS DOUBLE) + COALESCE(dragonkills, 0) + COALESCE(baronkills, 0))"


@query("objective_control", with_fixture(PM + SIDES + MERGED + f"""
SELECT matchid, teamid, {rnd(OBJ)} AS objective_control_score,
       {rnd(f"{OBJ} / GREATEST(GREATEST({MIN}, 1.0), 1e-6)")} AS objective_control_rate FROM merged"""))
def q_objective_control(spark, sf):
    out = FE.objective_control(_post_features_frame(spark, sf))
    return round_doubles(out.select("matchid", "teamid", "objective_control_score", "objective_control_rate"))


_DIFF_COLS = ["kills_sum", "assists_sum", "deaths_sum", "goldearned_sum", "towerkills", "dragonkills", "baronkills"]


def _diff(c):
    return rnd(f"2 * CAST(COALESCE({c}, 0) AS DOUBLE) - SUM(CAST(COALESCE({c}, 0) AS DOUBLE)) OVER (PARTITION BY matchid)")


@query("diff_vs_opponent", with_fixture(PM + SIDES + MERGED + "\nSELECT matchid, teamid, " +
                                        ", ".join(f"{_diff(c)} AS {c}_diff_vs_opp" for c in _DIFF_COLS) + " FROM merged"))
def q_diff_vs_opponent(spark, sf):
    out = FE.diff_vs_opponent(stage_merged(spark, sf), _DIFF_COLS)
    return round_doubles(out.select("matchid", "teamid", *[c + "_diff_vs_opp" for c in _DIFF_COLS]))


GDIFF = "(2 * goldearned_sum - SUM(goldearned_sum) OVER (PARTITION BY matchid))"


@query("gold_pressure", with_fixture(PM + SIDES + MERGED + f"""
SELECT matchid, teamid, {rnd(f"{GDIFF} / GREATEST({MIN}, 1e-6)")} AS gold_diff_per_min,
       {rnd(f"{GDIFF} / GREATEST({MIN}, 1e-6) * 15.0")} AS gold_adv_15_proxy,
       {rnd(f"{GDIFF} / GREATEST({MIN}, 1e-6) * 25.0")} AS gold_adv_25_proxy FROM merged"""))
def q_gold_pressure(spark, sf):
    out = FE.gold_pressure(FE.diff_vs_opponent(_post_features_frame(spark, sf), ["goldearned_sum"]))
    return round_doubles(out.select("matchid", "teamid", "gold_diff_per_min", "gold_adv_15_proxy", "gold_adv_25_proxy"))


@query("kill_activity", with_fixture(PM + SIDES + f"\nSELECT matchid, teamid, {rnd('kills_sum + assists_sum')} AS kill_activity FROM sides"))
def q_kill_activity(spark, sf):
    from ..operators.relational import aggregate_sides
    from .catalog_merge import stage_members
    return round_doubles(FE.kill_activity(aggregate_sides(stage_members(spark, sf), binary=[])).select(
        "matchid", "teamid", "kill_activity"))


_TF_OUT = (["is_blue_side", "objective_control_score", "objective_control_rate"]
           + [c + "_diff_vs_opp" for c in _DIFF_COLS]
           + ["gold_diff_per_min", "gold_adv_15_proxy", "gold_adv_25_proxy", "kill_activity"])


@query("team_features", with_fixture(PM + SIDES + MERGED + "\nSELECT matchid, teamid, is_blue_side, " + ", ".join(
    [f"{rnd(OBJ)} AS objective_control_score",
     f"{rnd(f'{OBJ} / GREATEST(GREATEST({MIN}, 1.0), 1e-6)')} AS objective_control_rate"]
    + [f"{_diff(c)} AS {c}_diff_vs_opp" for c in _DIFF_COLS]
    + [f"{rnd(f'{GDIFF} / GREATEST({MIN}, 1e-6)')} AS gold_diff_per_min",
       f"{rnd(f'{GDIFF} / GREATEST({MIN}, 1e-6) * 15.0')} AS gold_adv_15_proxy",
       f"{rnd(f'{GDIFF} / GREATEST({MIN}, 1e-6) * 25.0')} AS gold_adv_25_proxy",
       f"{rnd('kills_sum + assists_sum')} AS kill_activity"]) + " FROM merged"))
def q_team_features(spark, sf):
    out = FE.team_features(_post_features_frame(spark, sf))
    return round_doubles(out.select("matchid", "teamid", *_TF_OUT))


# ---------------------------------------------------------------- pre-game encoders and features
TE_COLS = ([f"champion_{i}" for i in range(1, 6)] + [f"{r}_championid" for r in ROLE_ORDER]
           + [f"banned_champion_{i}" for i in range(1, 6)])
CHAMP = [f"champion_{i}" for i in range(1, 6)]
BANS = [f"banned_champion_{i}" for i in range(1, 6)]
ROLES = [f"role_{i}" for i in range(1, 6)]

ENC_SQL = PREGAME_SQL + f"""
, pg AS (SELECT pregame.*, {SPLIT} AS split FROM pregame),
tr AS (SELECT * FROM pg WHERE split = 'train'),
prior AS (SELECT AVG(CAST(win AS DOUBLE)) AS p FROM tr),
te_long AS ({" UNION ALL ".join(f"SELECT '{c}' AS feature, CAST({c} AS VARCHAR) AS category, win FROM tr" for c in TE_COLS)}),
te AS (SELECT feature, category,
              (AVG(CAST(win AS DOUBLE)) * COUNT(*) + (SELECT p FROM prior) * 25.0) / (COUNT(*) + 25.0) AS value
       FROM te_long WHERE category IS NOT NULL GROUP BY feature, category),
pk_long AS ({" UNION ALL ".join(f"SELECT CAST(CAST({c} AS DOUBLE) AS VARCHAR) AS category FROM tr WHERE {c} IS NOT NULL" for c in CHAMP)}),
pk AS (SELECT category, CAST(COUNT(*) AS DOUBLE) / (SELECT COUNT(*) FROM pk_long) AS value FROM pk_long GROUP BY category),
pkprior AS (SELECT 1.0 / COUNT(*) AS p FROM pk),
plat AS (SELECT category, CAST(ROW_NUMBER() OVER (ORDER BY category) - 1 AS INTEGER) AS value
         FROM (SELECT DISTINCT COALESCE(CAST(platformid AS VARCHAR), 'unknown') AS category FROM tr) d),
enc AS (
  SELECT pg.*,
    {", ".join(f"COALESCE(t{i}.value, (SELECT p FROM prior)) AS {c}_winrate_te" for i, c in enumerate(TE_COLS))},
    {", ".join(f"COALESCE(k{i}.value, (SELECT p FROM pkprior)) AS {c}_pick_rate" for i, c in enumerate(CHAMP))},
    COALESCE(pl.value, -1) AS platform_code, COALESCE(CAST(seasonid AS DOUBLE), -1.0) AS season_code
  FROM pg
  {" ".join(f"LEFT JOIN te t{i} ON t{i}.feature = '{c}' AND t{i}.category = CAST(pg.{c} AS VARCHAR)" for i, c in enumerate(TE_COLS))}
  {" ".join(f"LEFT JOIN pk k{i} ON k{i}.category = CAST(CAST(pg.{c} AS DOUBLE) AS VARCHAR)" for i, c in enumerate(CHAMP))}
  LEFT JOIN plat pl ON pl.category = COALESCE(CAST(pg.platformid AS VARCHAR), 'unknown'))"""


def _stage_pregame_split(spark, sf):
    """The curated pre-game frame with its split, materialized once (it feeds
    every encoder fit and the apply step)."""
    pg = stage_pregame(spark, sf)
    return cut_lineage(SP.split_grouped(pg))


def _fit_te(spark, sf):
    pg = _stage_pregame_split(spark, sf)
    return pg, EN.fit_target_encoding(pg.where(F.col("split") == "train"), TE_COLS)


def _fit_all(spark, sf):
    pg = _stage_pregame_split(spark, sf)
    train = pg.where(F.col("split") == "train")
    te = EN.fit_target_encoding(train, TE_COLS)
    pick = EN.fit_pick_rate(train, CHAMP)
    return pg, te, pick, EN.fit_codes(train, CODES)


@query("target_encode", with_fixture(ENC_SQL + f"\nSELECT category, {rnd('value')} AS value FROM te WHERE feature = 'champion_1'"))
def q_target_encode(spark, sf):
    """Smoothed win rate per category of one column, fitted on the train split (#96)."""
    pg = _stage_pregame_split(spark, sf)
    enc = EN.fit_target_encoding(pg.where(F.col("split") == "train"), ["champion_1"])
    return round_doubles(enc.table.select("category", "value"))


@query("target_encode_multi", with_fixture(ENC_SQL + f"\nSELECT feature, category, {rnd('value')} AS value FROM te"))
def q_target_encode_multi(spark, sf):
    pg = _stage_pregame_split(spark, sf)
    return round_doubles(EN.fit_target_encoding(pg.where(F.col("split") == "train"), TE_COLS).table)


@query("apply_encoding", with_fixture(ENC_SQL + "\nSELECT matchid, teamid, split, " +
                                      ", ".join(f"{rnd(c + '_winrate_te')} AS {c}_winrate_te" for c in TE_COLS) + " FROM enc"))
def q_apply_encoding(spark, sf):
    pg, te = _fit_te(spark, sf)
    out = EN.apply_encoding(pg, te)
    return round_doubles(out.select("matchid", "teamid", "split", *[c + "_winrate_te" for c in TE_COLS]))


@query("pick_rate", with_fixture(ENC_SQL + f"\nSELECT category, {rnd('value')} AS value FROM pk"))
def q_pick_rate(spark, sf):
    pg = _stage_pregame_split(spark, sf)
    return round_doubles(EN.fit_pick_rate(pg.where(F.col("split") == "train"), CHAMP).table)


@query("category_codes", with_fixture(ENC_SQL + "\nSELECT matchid, teamid, platform_code, season_code FROM enc"))
def q_category_codes(spark, sf):
    pg = _stage_pregame_split(spark, sf)
    out = EN.encode_all(pg, codes=EN.fit_codes(pg.where(F.col("split") == "train"), CODES))
    return out.select("matchid", "teamid", "platform_code", "season_code")


@query("ban_flags", with_fixture(PREGAME_SQL + """
SELECT matchid, teamid, CAST(COALESCE(n_bans, 0) AS DOUBLE) AS n_bans,
       CASE WHEN COALESCE(n_bans, 0) > 0 THEN 1 ELSE 0 END AS has_ban_data FROM pregame"""))
def q_ban_flags(spark, sf):
    pg = stage_pregame(spark, sf)
    n = F.coalesce(F.col("n_bans").cast("double"), F.lit(0.0))
    return pg.select("matchid", "teamid", n.alias("n_bans"), (n > 0).cast("int").alias("has_ban_data"))


def _list(cols, cast="DOUBLE"):
    return "[" + ", ".join(f"CAST({c} AS {cast})" for c in cols) + "]"


def _row_stats_sql(cols, names):
    n = len(cols)
    mean = f"(({' + '.join(cols)}) / {float(n)})"
    sq = " + ".join(f"({c} - {mean}) * ({c} - {mean})" for c in cols)
    out = {
        "avg": f"{rnd(mean)} AS {names['avg']}",
        "min": f"{rnd('LEAST(' + ', '.join(cols) + ')')} AS {names['min']}",
        "max": f"{rnd('GREATEST(' + ', '.join(cols) + ')')} AS {names['max']}",
        "std": f"{rnd(f'SQRT(({sq}) / {n - 1})')} AS {names['std']}",
        "span": f"{rnd('GREATEST(' + ', '.join(cols) + ') - LEAST(' + ', '.join(cols) + ')')} AS {names['span']}",
    }
    return [out[k] for k in names]


@query("row_stats", with_fixture(ENC_SQL + "\nSELECT matchid, teamid, " + ", ".join(_row_stats_sql(
    [c + "_winrate_te" for c in CHAMP], {"avg": "wr_avg", "min": "wr_min", "max": "wr_max", "std": "wr_std",
                                         "span": "wr_span"})) + " FROM enc"))
def q_row_stats(spark, sf):
    pg, te = _fit_te(spark, sf)
    out = RS.row_stats(EN.apply_encoding(pg, te), [c + "_winrate_te" for c in CHAMP], "wr")
    return round_doubles(out.select("matchid", "teamid", "wr_avg", "wr_min", "wr_max", "wr_std", "wr_span"))


_CH_LIST = "[" + ", ".join(CHAMP) + "]"


@query("row_counts", with_fixture(PREGAME_SQL + f"""
SELECT matchid, teamid, CAST(len(list_filter({_CH_LIST}, lambda x: x IS NOT NULL)) AS BIGINT) AS draft_size,
       CASE WHEN len(list_filter({_CH_LIST}, lambda x: x IS NOT NULL)) = 5 THEN 1 ELSE 0 END AS has_full_draft,
       CAST(len(list_distinct(list_filter({_CH_LIST}, lambda x: x IS NOT NULL))) AS BIGINT) AS unique_champion_count
FROM pregame"""))
def q_row_counts(spark, sf):
    pg = stage_pregame(spark, sf)
    return RS.row_counts(pg, CHAMP).select("matchid", "teamid", "draft_size", "has_full_draft", "unique_champion_count")


_ROLE_FILLED = [f"COALESCE(CAST({r} AS VARCHAR), 'unknown')" for r in ROLES]
ROLE_DIV_SQL = (f"CAST({' + '.join(f'CASE WHEN {x} <> {chr(39)}unknown{chr(39)} THEN 1 ELSE 0 END' for x in _ROLE_FILLED)} AS BIGINT) AS role_known_count, "
                f"CAST(len(list_distinct(list_filter([{', '.join(f'lower({x})' for x in _ROLE_FILLED)}], lambda x: x <> 'unknown'))) AS BIGINT) AS role_diversity")


@query("role_diversity", with_fixture(PREGAME_SQL + f"\nSELECT matchid, teamid, {ROLE_DIV_SQL} FROM pregame"))
def q_role_diversity(spark, sf):
    pg = stage_pregame(spark, sf)
    return RS.role_diversity(pg, ROLES).select("matchid", "teamid", "role_known_count", "role_diversity")


@query("stack_columns", with_fixture(PREGAME_SQL + "\nSELECT champion FROM (" + " UNION ALL ".join(
    f"SELECT {c} AS champion FROM pregame" for c in CHAMP) + ") s"))
def q_stack_columns(spark, sf):
    """champion_1..5 stacked into one column, NULLs kept (#71)."""
    pg = stage_pregame(spark, sf)
    return RS.stack_columns(pg, CHAMP, "champion")


PREGAME_FEATURES = ["team_avg_champ_wr", "team_min_champ_wr", "team_max_champ_wr", "team_std_champ_wr",
                    "team_champ_wr_span", "team_avg_pick_rate", "team_max_pick_rate", "team_min_pick_rate",
                    "avg_banned_champ_wr", "max_banned_champ_wr", "draft_size", "has_full_draft",
                    "unique_champion_count", "role_known_count", "role_diversity", "n_bans", "has_ban_data",
                    "platform_code", "season_code", "team_avg_champ_wr_diff_vs_opp",
                    "team_max_champ_wr_diff_vs_opp", "team_avg_pick_rate_diff_vs_opp"]

_WR = [c + "_winrate_te" for c in CHAMP]
_PR = [c + "_pick_rate" for c in CHAMP]
_BW = [c + "_winrate_te" for c in BANS]
_PGF_SQL = ENC_SQL + f"""
, feat AS (
  SELECT enc.*,
    ({" + ".join(_WR)}) / 5.0 AS team_avg_champ_wr, LEAST({", ".join(_WR)}) AS team_min_champ_wr,
    GREATEST({", ".join(_WR)}) AS team_max_champ_wr,
    SQRT(({" + ".join(f"({c} - ({' + '.join(_WR)}) / 5.0) * ({c} - ({' + '.join(_WR)}) / 5.0)" for c in _WR)}) / 4) AS team_std_champ_wr,
    GREATEST({", ".join(_WR)}) - LEAST({", ".join(_WR)}) AS team_champ_wr_span,
    ({" + ".join(_PR)}) / 5.0 AS team_avg_pick_rate, GREATEST({", ".join(_PR)}) AS team_max_pick_rate,
    LEAST({", ".join(_PR)}) AS team_min_pick_rate,
    ({" + ".join(_BW)}) / 5.0 AS avg_banned_champ_wr, GREATEST({", ".join(_BW)}) AS max_banned_champ_wr,
    CAST(len(list_filter({_CH_LIST}, lambda x: x IS NOT NULL)) AS BIGINT) AS draft_size,
    CASE WHEN len(list_filter({_CH_LIST}, lambda x: x IS NOT NULL)) = 5 THEN 1 ELSE 0 END AS has_full_draft,
    CAST(len(list_distinct(list_filter({_CH_LIST}, lambda x: x IS NOT NULL))) AS BIGINT) AS unique_champion_count,
    {ROLE_DIV_SQL},
    CAST(COALESCE(n_bans, 0) AS DOUBLE) AS n_bans_d, CASE WHEN COALESCE(n_bans, 0) > 0 THEN 1 ELSE 0 END AS has_ban_data
  FROM enc)"""

_PGF_SELECT = []
for _c in PREGAME_FEATURES:
    if _c.endswith("_diff_vs_opp"):
        _b = _c[: -len("_diff_vs_opp")]
        _PGF_SELECT.append(f"{rnd(f'2 * {_b} - SUM({_b}) OVER (PARTITION BY matchid)')} AS {_c}")
    elif _c == "n_bans":
        _PGF_SELECT.append("n_bans_d AS n_bans")
    elif _c in ("draft_size", "has_full_draft", "unique_champion_count", "role_known_count", "role_diversity",
                "has_ban_data", "platform_code"):
        _PGF_SELECT.append(_c)
    else:
        _PGF_SELECT.append(f"{rnd(_c)} AS {_c}")


@query("pregame_features", with_fixture(_PGF_SQL + "\nSELECT matchid, teamid, split, win, " + ", ".join(_PGF_SELECT) + " FROM feat"))
def q_pregame_features(spark, sf):
    """Encoders fitted on train, then the full draft feature set on every split (#102)."""
    out = add_pregame_features(*_fit_all(spark, sf))
    return round_doubles(out.select("matchid", "teamid", "split", "win", *PREGAME_FEATURES))
