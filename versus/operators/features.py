"""Side-level feature operators (#61, #85-#95).

All projections; the only shuffle is the opponent difference, a window over
``matchid`` whose groups hold at most two rows (one per side) once the frame
is keyed by (matchid, teamid).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..constants import OBJECTIVE_COLUMNS, RELATIVE_FEATURES
from ..functions.scalars import safe_ratio, side_flag


POSITIVE = "versus.positive"  # column metadata: every value is known to be > 0


def first_present(df: DataFrame, options: Sequence[str]) -> str | None:
    """First of ``options`` that is a column (plan-time)."""
    cols = set(df.columns)
    return next((c for c in options if c in cols), None)


def _num0(c: str):
    return F.coalesce(F.col(c).try_cast("double"), F.lit(0.0))


def match_minutes(df: DataFrame) -> DataFrame:
    """max(duration, 60) / 60, missing duration counts as 0 (#85)."""
    dur = _num0("duration") if "duration" in df.columns else F.lit(0.0)
    minutes = (F.greatest(dur, F.lit(60.0)) / 60.0).alias("match_minutes", metadata={POSITIVE: True})
    return df.select(*[c for c in df.columns if c != "match_minutes"], minutes)


def phase_flags(df: DataFrame) -> DataFrame:
    """Early (< 20 min), mid ([20, 30)), late (>= 30) flags (#86)."""
    m = F.col("match_minutes")
    return df.select("*", (m < 20).cast("int").alias("phase_early"),
                     ((m >= 20) & (m < 30)).cast("int").alias("phase_mid"),
                     (m >= 30).cast("int").alias("phase_late"))


def kda_ratio(df: DataFrame) -> DataFrame:
    """(kills + assists) / max(deaths, 1) (#87)."""
    k = first_present(df, ["kills_sum", "kills"])
    d = first_present(df, ["deaths_sum", "deaths"])
    a = first_present(df, ["assists_sum", "assists"])
    if not (k and d and a):
        return df
    return df.withColumn("kda_ratio", safe_ratio(_num0(k) + _num0(a), F.greatest(_num0(d), F.lit(1.0))))


def economy_ratios(df: DataFrame) -> DataFrame:
    """Gold spent / earned and damage / earned (#88)."""
    earned = first_present(df, ["goldearned_sum", "goldearned"])
    spent = first_present(df, ["goldspent_sum", "goldspent"])
    damage = first_present(df, ["totdmgtochamp_sum", "totdmgtochamp"])
    out = df
    if earned and spent:
        out = out.withColumn("gold_spent_ratio", safe_ratio(spent, earned))
    if damage and earned:
        out = out.withColumn("damage_per_gold", safe_ratio(damage, earned))
    return out


def per_minute_rates(df: DataFrame) -> DataFrame:
    """Objective damage, creep score, vision and crowd control per minute (#89)."""
    obj = first_present(df, ["dmgtoobj_sum", "dmgtoobj"])
    tur = first_present(df, ["dmgtoturrets_sum", "dmgtoturrets"])
    mins = first_present(df, ["totminionskilled_sum", "totminionskilled"])
    neut = first_present(df, ["neutralminionskilled_sum", "neutralminionskilled"])
    vis = first_present(df, ["visionscore_sum", "visionscore"])
    cc = first_present(df, ["timecc_sum", "timecc"])
    m = F.col("match_minutes")
    out = df
    if obj:
        num = _num0(obj) + _num0(tur) if tur else F.col(obj)
        out = out.withColumn("objective_damage_per_min", safe_ratio(num, m))
    if mins:
        num = _num0(mins) + _num0(neut) if neut else F.col(mins)
        out = out.withColumn("cs_per_min", safe_ratio(num, m))
    if vis:
        out = out.withColumn("vision_per_min", safe_ratio(vis, m))
    if cc:
        out = out.withColumn("cc_per_min", safe_ratio(cc, m))
    return out


def jungle_share(df: DataFrame) -> DataFrame:
    """own / (own + enemy) jungle kills (#90)."""
    own = first_present(df, ["ownjunglekills_sum", "ownjunglekills"])
    enemy = first_present(df, ["enemyjunglekills_sum", "enemyjunglekills"])
    if not (own and enemy):
        return df
    return df.withColumn("jungle_control_share", safe_ratio(own, _num0(own) + _num0(enemy)))


def player_features(df: DataFrame) -> DataFrame:
    """Composition of #85-#90 (#94)."""
    return (df.transform(match_minutes).transform(phase_flags).transform(kda_ratio)
            .transform(economy_ratios).transform(per_minute_rates).transform(jungle_share))


def diff_vs_opponent(df: DataFrame, columns: Sequence[str], group: str = "matchid",
                     suffix: str = "_diff_vs_opp") -> DataFrame:
    """v - (group total - v) = 2v - total for each listed column present (#61)."""
    cols = [c for c in columns if c in df.columns]
    if not cols or group not in df.columns:
        return df
    w = Window.partitionBy(group)
    return df.select("*", *[(2 * _num0(c) - F.sum(_num0(c)).over(w)).alias(c + suffix) for c in cols])


def objective_control(df: DataFrame, check_minutes: bool = True) -> DataFrame:
    """Sum of objective counts and its rate per minute (#91).

    Minutes fall back to duration / 60 only when no row has positive
    ``match_minutes``; that global test is one ``limit(1)`` probe job.
    """
    objs = [c for c in OBJECTIVE_COLUMNS if c in df.columns]
    if not objs:
        return df
    score = sum((F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in objs), F.lit(0.0))
    out = df.withColumn("objective_control_score", score)
    if "match_minutes" in df.columns:
        minutes = _num0("match_minutes")
        known_positive = df.schema["match_minutes"].metadata.get(POSITIVE, False)
        if "duration" in df.columns and check_minutes and not known_positive and \
                len(df.where(F.col("match_minutes") > 0).limit(1).take(1)) == 0:
            minutes = _num0("duration") / 60.0
    elif "duration" in df.columns:
        minutes = _num0("duration") / 60.0
    else:
        minutes = F.lit(0.0)
    return out.withColumn("objective_control_rate",
                          safe_ratio("objective_control_score", F.greatest(minutes, F.lit(1.0))))


def gold_pressure(df: DataFrame) -> DataFrame:
    """Gold difference per minute and its 15 / 25 minute projections (#92)."""
    g = first_present(df, ["goldearned_sum_diff_vs_opp", "goldearned_diff_vs_opp"])
    if not g or "match_minutes" not in df.columns:
        return df
    per_min = safe_ratio(g, "match_minutes")
    return df.select("*", per_min.alias("gold_diff_per_min"),
                     (per_min * 15.0).alias("gold_adv_15_proxy"),
                     (per_min * 25.0).alias("gold_adv_25_proxy"))


def kill_activity(df: DataFrame) -> DataFrame:
    """kills + assists (#93)."""
    k = first_present(df, ["kills_sum", "kills"])
    a = first_present(df, ["assists_sum", "assists"])
    if not (k and a):
        return df
    return df.withColumn("kill_activity", _num0(k) + _num0(a))


def team_features(df: DataFrame, relative: Sequence[str] = RELATIVE_FEATURES,
                  check_minutes: bool = True) -> DataFrame:
    """Composition of #23, #61, #91-#93 (#95)."""
    out = df
    if "is_blue_side" not in out.columns and "teamid" in out.columns:
        out = out.withColumn("is_blue_side", side_flag("teamid"))
    out = objective_control(out, check_minutes)
    if {"matchid", "teamid"} <= set(out.columns):
        out = diff_vs_opponent(out, relative)
    return out.transform(gold_pressure).transform(kill_activity)
