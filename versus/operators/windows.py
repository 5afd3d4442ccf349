"""Window operators: ranked slots, first-per-key, best/latest run (#62-#67).

``row_number() <= k`` directly on the window output lets Spark insert a
WindowGroupLimit before the shuffle (partial top-k per map task), so a hot
side or model never ships more than k rows per map partition.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..constants import KEYS, MAX_DRAFT_SLOTS, SIDES
from ..functions.scalars import normalize_role, role_rank, team_player_slot
from .ordered import group_rank
from .relational import coerce_int_columns


def ranked_slot(df: DataFrame, keys: Sequence[str], order: Sequence, name: str,
                max_slots: int | None) -> DataFrame:
    """Position inside each key by ``order`` (1-based); keep the first ``max_slots``.

    With a limit, ``row_number() <= k`` becomes a partial WindowGroupLimit
    before the shuffle. Without one, an order given as column names (ascending)
    goes through ``group_rank`` so hot keys are spread over many tasks.
    """
    if not max_slots and all(isinstance(o, str) for o in order):
        return group_rank(df, list(keys), list(order), name).withColumn(name, F.col(name).cast("int"))
    w = Window.partitionBy(*keys).orderBy(*order)
    out = df.withColumn(name, F.row_number().over(w))
    return out.where(F.col(name) <= max_slots) if max_slots else out


class DraftOrder(NamedTuple):
    rows: DataFrame  # members with canonical_role, team_player_slot and role_rank
    sort: list       # the draft order inside a side


def draft_order(members: DataFrame, slots_per_side: int = 5) -> DraftOrder:
    """Canonical role, role rank and side-relative slot of each member, and the order they draft in (#80-#82)."""
    raw = [c for c in ("position", "role") if c in members.columns]
    out = members.select(
        "*",
        normalize_role(*raw, slot="player", slots_per_side=slots_per_side).alias("canonical_role"),
        team_player_slot("player", slots_per_side).alias("team_player_slot"))
    out = out.withColumn("role_rank", role_rank("canonical_role"))
    return DraftOrder(out, [F.col(c).asc_nulls_last() for c in ("role_rank", "team_player_slot", "player", "id")])


def draft_slot(members: DataFrame, slots_per_side: int = 5, max_slots: int = MAX_DRAFT_SLOTS,
               keys: Sequence[str] = KEYS) -> DataFrame:
    """Canonical role, role rank, side-relative slot and draft position (#62, #80-#82)."""
    order = draft_order(members, slots_per_side)
    return ranked_slot(order.rows, keys, order.sort, "draft_slot", max_slots)


def ban_slot(teambans: DataFrame, max_slots: int = MAX_DRAFT_SLOTS, keys: Sequence[str] = KEYS,
             sides: Sequence[int] = SIDES) -> DataFrame:
    """Ban position by (banturn, category), or by category when banturn is absent (#63).

    NULL keys and foreign sides are removed first.
    """
    bans = coerce_int_columns(teambans, [*keys, "championid", "banturn"])
    bans = bans.dropna(subset=list(keys)).where(F.col("teamid").isin(*sides))
    order = ([F.col("banturn").asc_nulls_last()] if "banturn" in bans.columns else []) + \
        [F.col("championid").asc_nulls_last()]
    return ranked_slot(bans, keys, order, "ban_slot", max_slots)


def first_per_role(drafted: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """First member per (side, canonical role) in draft order (#64)."""
    return ranked_slot(drafted, [*keys, "canonical_role"], [F.col("draft_slot")], "_r", 1).drop("_r")


def best_per_group(df: DataFrame, group: Sequence[str], order: Sequence, k: int = 1,
                   name: str = "_rank") -> DataFrame:
    """Top ``k`` rows per group by ``order`` (#65, #67)."""
    return ranked_slot(df, group, order, name, k).drop(name)


def best_run_per_model(runs: DataFrame, model_col: str = "model",
                       metrics: Sequence[str] = ("roc_auc", "accuracy", "f1")) -> DataFrame:
    """Best run per model by the metrics, descending, NULLs last (#65)."""
    order = [F.col(m).desc_nulls_last() for m in metrics] + [F.col("run_id").asc()]
    return best_per_group(runs, [model_col], order)


def latest_run(runs: DataFrame, group_col: str = "experiment", time_col: str = "updated_at") -> DataFrame:
    """Newest run per group: ``max_by`` in one aggregate, no window (#66)."""
    others = [c for c in runs.columns if c != group_col]
    packed = F.max_by(F.struct(*others), F.struct(F.col(time_col), F.col("run_id")))
    return runs.groupBy(group_col).agg(packed.alias("_r")).select(group_col, "_r.*")


def preferred_run(runs: DataFrame, group_col: str = "model", tuned_col: str = "is_tuned",
                  score_col: str = "roc_auc", time_col: str = "updated_at") -> DataFrame:
    """Pick per group by (tuned first, best score, newest) (#67)."""
    order = [F.col(tuned_col).desc_nulls_last(), F.col(score_col).desc_nulls_last(),
             F.col(time_col).desc_nulls_last(), F.col("run_id").asc()]
    return best_per_group(runs, [group_col], order)
