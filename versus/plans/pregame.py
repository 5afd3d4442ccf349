"""End-to-end pre-game (draft-only) flow (#104).

members -> label per side (one aggregate over all members) ; draft slots
(window with group limit) -> champion/role slot pivots and role pivot (one
aggregate) ; bans (window with group limit) -> ban slots and count (one
aggregate) ; then key joins and the group dimension.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..constants import KEYS, MAX_DRAFT_SLOTS, ROLE_ORDER, UNKNOWN_ROLE
from ..operators.relational import (assign_sides, derive_group_label, join_inner_stats, join_left_dimension,
                                    label_columns, with_side_flag)
from ..operators.reshape import code_slot_columns, role_columns, slot_columns
from ..operators.windows import ban_slot, draft_order, draft_slot


def _draft_columns(max_slots: int) -> list:
    # role_rank is a code for canonical_role (known roles 0..4, anything else
    # 99 = 'unknown'), so the role slots aggregate integers and map back
    return [*slot_columns("draft_slot", "championid", "champion", max_slots),
            *code_slot_columns("draft_slot", "role_rank", {v: k for k, v in ROLE_ORDER.items()}, "role",
                               max_slots, UNKNOWN_ROLE),
            *role_columns()]


def draft_frame(members: DataFrame, slots_per_side: int = 5, max_slots: int = MAX_DRAFT_SLOTS) -> DataFrame:
    """Per side: champion_1..n, role_1..n and <role>_championid (#62, #64, #68, #69)."""
    return draft_slot(members, slots_per_side, max_slots).groupBy(*KEYS).agg(*_draft_columns(max_slots))


def label_and_draft(members: DataFrame, slots_per_side: int = 5, max_slots: int = MAX_DRAFT_SLOTS) -> DataFrame:
    """The side label over all members and the draft over the first ``max_slots`` (#45, #62, #64,
    #68, #69) in one aggregate: members are read once.  A side must fit one task's sort."""
    order = draft_order(members, slots_per_side)
    w = Window.partitionBy(*KEYS).orderBy(*order.sort)
    ranked = order.rows.withColumn("draft_slot", F.row_number().over(w))
    drafted = F.col("draft_slot") <= max_slots
    ranked = ranked.withColumns({"championid": F.when(drafted, F.col("championid")), "role_rank": F.when(drafted, F.col("role_rank")),
                                 "canonical_role": F.when(drafted, F.col("canonical_role")), "draft_slot": F.when(drafted, F.col("draft_slot"))})
    return ranked.groupBy(*KEYS).agg(*label_columns(), *_draft_columns(max_slots))


def ban_frame(teambans: DataFrame, max_slots: int = MAX_DRAFT_SLOTS) -> DataFrame:
    """Per side: n_bans (non-NULL categories kept) and banned_champion_1..n (#60, #63, #68)."""
    bans = ban_slot(teambans, max_slots)
    return bans.groupBy(*KEYS).agg(
        F.count("championid").cast("bigint").alias("n_bans"),
        *slot_columns("ban_slot", "championid", "banned_champion", max_slots))


def pregame_sides(members: DataFrame, matches: DataFrame, teambans: DataFrame, slots_per_side: int = 5,
                  max_slots: int = MAX_DRAFT_SLOTS, one_pass: bool = False) -> DataFrame:
    """One row per (group, side) from member rows with their outcome (#104).

    ``one_pass`` reads the members once (``label_and_draft``); without it the label is a
    map-side aggregate and the draft keeps ``max_slots`` rows a side before the shuffle, which
    is the plan for sides too large for one task.
    """
    members = assign_sides(members, slots_per_side)
    if one_pass:
        merged = label_and_draft(members, slots_per_side, max_slots)
    else:
        merged = derive_group_label(members).join(draft_frame(members, slots_per_side, max_slots), list(KEYS), "left")
    merged = join_left_dimension(merged.join(ban_frame(teambans, max_slots), list(KEYS), "left"), matches)
    merged = merged.withColumn("n_bans", F.coalesce(F.col("n_bans"), F.lit(0)).cast("bigint"))
    return with_side_flag(merged)


def pregame_dataset(matches: DataFrame, participants: DataFrame, stats: DataFrame,
                    teambans: DataFrame, slots_per_side: int = 5,
                    max_slots: int = MAX_DRAFT_SLOTS) -> DataFrame:
    """#33, then ``pregame_sides`` (#104)."""
    members = join_inner_stats(participants, stats, stats_columns=["id", "win"])
    return pregame_sides(members, matches, teambans, slots_per_side, max_slots)


def _present(df: DataFrame, prefix: str, n: int = MAX_DRAFT_SLOTS) -> list[str]:
    return [f"{prefix}_{i}" for i in range(1, n + 1) if f"{prefix}_{i}" in df.columns]


#: Columns that become codes, and the codes' names.
CODES = {"platformid": "platform_code", "seasonid": "season_code"}


def add_pregame_features(df: DataFrame, te, pick, codes: dict) -> DataFrame:
    """Draft features (#72-#74, #98-#101) and three opponent differences (#102).

    ``te`` and ``pick`` are the fitted target and pick-rate encodings, ``codes`` the fitted
    category codes; one dictionary of all of them meets the rows once.
    """
    from ..operators.encoders import encode_all
    from ..operators.features import diff_vs_opponent
    from ..operators.reshape import role_diversity, row_counts, row_stats

    champ = _present(df, "champion")
    bans = _present(df, "banned_champion")
    roles = _present(df, "role")
    out, prior = encode_all(df, te, pick, codes), te.prior
    if not te.columns:
        out = out.withColumn("champion_signal_prior", F.lit(prior))
    te = [f"{c}_winrate_te" for c in champ if f"{c}_winrate_te" in out.columns]
    picks = [f"{c}_pick_rate" for c in champ if f"{c}_pick_rate" in out.columns]
    ban_te = [f"{c}_winrate_te" for c in bans if f"{c}_winrate_te" in out.columns]
    if te:
        out = row_stats(out, te, "_wr").select(
            *out.columns, F.col("_wr_avg").alias("team_avg_champ_wr"), F.col("_wr_min").alias("team_min_champ_wr"),
            F.col("_wr_max").alias("team_max_champ_wr"), F.col("_wr_std").alias("team_std_champ_wr"),
            F.col("_wr_span").alias("team_champ_wr_span"))
    else:
        out = out.select("*", *[F.lit(prior).alias(c) for c in ("team_avg_champ_wr", "team_min_champ_wr",
                                                                 "team_max_champ_wr")],
                         F.lit(0.0).alias("team_std_champ_wr"), F.lit(0.0).alias("team_champ_wr_span"))
    if picks:
        out = row_stats(out, picks, "_pr").select(
            *out.columns, F.col("_pr_avg").alias("team_avg_pick_rate"), F.col("_pr_max").alias("team_max_pick_rate"),
            F.col("_pr_min").alias("team_min_pick_rate"))
    else:
        out = out.select("*", *[F.lit(pick.prior).alias(c) for c in ("team_avg_pick_rate", "team_max_pick_rate",
                                                                      "team_min_pick_rate")])
    if ban_te:
        out = row_stats(out, ban_te, "_bw").select(
            *out.columns, F.col("_bw_avg").alias("avg_banned_champ_wr"), F.col("_bw_max").alias("max_banned_champ_wr"))
    if champ:
        out = row_counts(out, champ)
    else:
        out = out.select("*", F.lit(0).alias("draft_size"), F.lit(0).alias("has_full_draft"),
                         F.lit(0).alias("unique_champion_count"))
    if roles:
        out = role_diversity(out, roles)
    if "n_bans" in out.columns:
        out = out.withColumn("n_bans", F.coalesce(F.col("n_bans").cast("double"), F.lit(0.0)))
        out = out.withColumn("has_ban_data", (F.col("n_bans") > 0).cast("int"))
    return diff_vs_opponent(out, ["team_avg_champ_wr", "team_max_champ_wr", "team_avg_pick_rate"])
