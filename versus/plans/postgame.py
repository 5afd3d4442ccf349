"""End-to-end post-game flow: member tables -> one clean row per (group, side).

``postgame_dataset`` is #103; ``clean_dataset`` (#105) lives in operators.clean.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame

from ..operators.relational import (aggregate_sides, assign_sides, join_inner_stats,
                                    join_left_dedup, join_left_dimension, with_side_flag)


def member_rows(participants: DataFrame, stats: DataFrame, slots_per_side: int = 5) -> DataFrame:
    """participants JOIN stats, side filled from the slot, binary target, valid keys (#33, #20-#22)."""
    return assign_sides(join_inner_stats(participants, stats), slots_per_side)


def members_of(t: Mapping[str, DataFrame], stats_columns: Sequence[str] | None = None) -> DataFrame:
    """Member rows with their statistics: the table ``members`` if there is one, else the join (#33)."""
    if "members" in t:
        return t["members"]
    return join_inner_stats(t["participants"], t["stats"], stats_columns=stats_columns)


def postgame_sides(members: DataFrame, matches: DataFrame, teamstats: DataFrame, binary: Sequence[str] | None = None) -> DataFrame:
    """One row per (group, side) from member rows: #42/#44/#45 -> #34 -> #35 -> #23.

    Everything is keyed by the group or by (group, side): members that come partitioned by
    group (a rank over the group, a bucketed table) are not shuffled again.
    """
    sides = aggregate_sides(members, binary=binary)
    merged = join_left_dimension(join_left_dedup(sides, teamstats), matches)
    return with_side_flag(merged)


def postgame_dataset(matches: DataFrame, participants: DataFrame, stats: DataFrame,
                     teamstats: DataFrame, slots_per_side: int = 5,
                     binary: Sequence[str] | None = None) -> DataFrame:
    """#33, then ``postgame_sides`` (#103)."""
    return postgame_sides(member_rows(participants, stats, slots_per_side), matches, teamstats, binary)
