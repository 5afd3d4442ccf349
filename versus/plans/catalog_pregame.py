"""Queries: roles, draft and ban slots, pivots and the pre-game dataset."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..constants import KEYS, MAX_DRAFT_SLOTS, ROLE_ALIASES, ROLE_ORDER, SLOT_ROLE_FALLBACK
from ..functions.scalars import normalize_role, role_rank, team_player_slot
from ..operators import windows as W
from ..operators.relational import assign_sides
from ..operators.reshape import pivot_role, pivot_slots
from ..sources.fixture import DEFAULT_SLOTS, has_hot_order
from .pregame import ban_frame, pregame_sides
from ..sources.layout import store
from .registry import fitted_once, query, tables, with_fixture
from .sqlparts import PM


def _alias_case(expr: str) -> str:
    whens = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in ROLE_ALIASES.items())
    return f"(CASE lower(trim({expr})) {whens} ELSE NULL END)"


_SLOT = f"(((player - 1) % {DEFAULT_SLOTS}) + 1)"
_FALLBACK = "CASE " + _SLOT + " " + " ".join(
    f"WHEN {k} THEN '{v}'" for k, v in SLOT_ROLE_FALLBACK.items()) + " ELSE NULL END"
_RANK = "CASE canonical_role " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in ROLE_ORDER.items()) + " ELSE 99 END"

ROLES_SQL = PM + f"""
, pmr0 AS (
  SELECT pm.*, COALESCE({_alias_case("position")}, {_alias_case("role")}, {_FALLBACK}, 'unknown') AS canonical_role,
         {_SLOT} AS team_player_slot
  FROM pm WHERE matchid IS NOT NULL AND teamid IN (100, 200)),
pmr AS (SELECT pmr0.*, {_RANK} AS role_rank FROM pmr0),
drafted AS (
  SELECT * FROM (
    SELECT pmr.*, ROW_NUMBER() OVER (PARTITION BY matchid, teamid
                  ORDER BY role_rank, team_player_slot, player, id) AS draft_slot FROM pmr) x
  WHERE draft_slot <= {MAX_DRAFT_SLOTS})"""

_CHAMP_SLOTS = ", ".join(f"MAX(CASE WHEN draft_slot = {i} THEN championid END) AS champion_{i}"
                         for i in range(1, MAX_DRAFT_SLOTS + 1))
_ROLE_SLOTS = ", ".join(f"MAX(CASE WHEN draft_slot = {i} THEN canonical_role END) AS role_{i}"
                        for i in range(1, MAX_DRAFT_SLOTS + 1))
_ROLE_PIVOT = ", ".join(
    f"arg_min(CASE WHEN canonical_role = '{r}' THEN championid END, CASE WHEN canonical_role = '{r}' THEN draft_slot END) AS {r}_championid"
    for r in ROLE_ORDER)
_BAN_SLOTS = ", ".join(f"MAX(CASE WHEN ban_slot = {i} THEN championid END) AS banned_champion_{i}"
                       for i in range(1, MAX_DRAFT_SLOTS + 1))

BANS_SQL = f"""
, bans AS (
  SELECT * FROM (
    SELECT b.*, ROW_NUMBER() OVER (PARTITION BY matchid, teamid ORDER BY banturn, championid) AS ban_slot
    FROM teambans b WHERE matchid IS NOT NULL AND teamid IS NOT NULL AND teamid IN (100, 200)) x
  WHERE ban_slot <= {MAX_DRAFT_SLOTS}),
banpiv AS (
  SELECT matchid, teamid, CAST(COUNT(championid) AS BIGINT) AS n_bans, {_BAN_SLOTS}
  FROM bans GROUP BY matchid, teamid)"""


def stage_pregame(spark, sf):
    t = tables(spark, sf, wide=True)
    return pregame_sides(t["members"], t["matches"], t["teambans"], DEFAULT_SLOTS, one_pass=not has_hot_order(spark, sf))


def _members(spark, sf):
    return assign_sides(tables(spark, sf, wide=True)["members"], DEFAULT_SLOTS)


@query("normalize_role", with_fixture(PM + f"""
SELECT id, COALESCE({_alias_case("position")}, {_alias_case("role")}, {_FALLBACK}, 'unknown') AS canonical_role
FROM pm"""))
def q_normalize_role(spark, sf):
    p = tables(spark, sf)["participants"]
    return p.select("id", normalize_role("position", "role", slot="player",
                                         slots_per_side=DEFAULT_SLOTS).alias("canonical_role"))


@query("team_player_slot", with_fixture(f"SELECT id, player, CAST({_SLOT} AS BIGINT) AS team_player_slot FROM participants"))
def q_team_player_slot(spark, sf):
    p = tables(spark, sf)["participants"]
    return p.select("id", "player", team_player_slot("player", DEFAULT_SLOTS).cast("bigint").alias("team_player_slot"))


@query("role_rank", with_fixture(ROLES_SQL + "\nSELECT id, canonical_role, role_rank FROM pmr"))
def q_role_rank(spark, sf):
    m = _members(spark, sf)
    role = normalize_role("position", "role", slot="player", slots_per_side=DEFAULT_SLOTS)
    return m.select("id", role.alias("canonical_role"), role_rank(role).alias("role_rank"))


@query("draft_slot", with_fixture(ROLES_SQL + """
SELECT matchid, teamid, id, championid, canonical_role, CAST(draft_slot AS INTEGER) AS draft_slot FROM drafted"""))
def q_draft_slot(spark, sf):
    d = W.draft_slot(_members(spark, sf), DEFAULT_SLOTS)
    return d.select("matchid", "teamid", "id", "championid", "canonical_role", "draft_slot")


@query("first_per_role", with_fixture(ROLES_SQL + """
SELECT matchid, teamid, canonical_role, championid FROM (
  SELECT drafted.*, ROW_NUMBER() OVER (PARTITION BY matchid, teamid, canonical_role ORDER BY draft_slot) AS r
  FROM drafted) x WHERE r = 1"""))
def q_first_per_role(spark, sf):
    d = W.first_per_role(W.draft_slot(_members(spark, sf), DEFAULT_SLOTS))
    return d.select("matchid", "teamid", "canonical_role", "championid")


@query("pivot_slots", with_fixture(ROLES_SQL + f"""
SELECT matchid, teamid, {_CHAMP_SLOTS} FROM drafted GROUP BY matchid, teamid"""))
def q_pivot_slots(spark, sf):
    d = W.draft_slot(_members(spark, sf), DEFAULT_SLOTS)
    return pivot_slots(d, "draft_slot", "championid", "champion", MAX_DRAFT_SLOTS)


@query("pivot_role", with_fixture(ROLES_SQL + f"""
SELECT matchid, teamid, {_ROLE_PIVOT} FROM drafted GROUP BY matchid, teamid"""))
def q_pivot_role(spark, sf):
    d = W.draft_slot(_members(spark, sf), DEFAULT_SLOTS)
    return pivot_role(d)


@query("ban_slot", with_fixture(BANS_SQL + """
SELECT matchid, teamid, championid, banturn, CAST(ban_slot AS INTEGER) AS ban_slot FROM bans"""))
def q_ban_slot(spark, sf):
    b = W.ban_slot(tables(spark, sf)["teambans"])
    return b.select("matchid", "teamid", "championid", "banturn", "ban_slot")


@query("group_count_after_cap", with_fixture(BANS_SQL + "\nSELECT matchid, teamid, n_bans FROM banpiv"))
def q_group_count_after_cap(spark, sf):
    return ban_frame(tables(spark, sf)["teambans"]).select("matchid", "teamid", "n_bans")


@query("join_outer_pivots", with_fixture(ROLES_SQL + BANS_SQL + f"""
, champ AS (SELECT matchid, teamid, {_CHAMP_SLOTS} FROM drafted GROUP BY matchid, teamid)
SELECT COALESCE(c.matchid, b.matchid) AS matchid, COALESCE(c.teamid, b.teamid) AS teamid,
       {", ".join(f"c.champion_{i}" for i in range(1, MAX_DRAFT_SLOTS + 1))},
       {", ".join(f"b.banned_champion_{i}" for i in range(1, MAX_DRAFT_SLOTS + 1))}
FROM champ c FULL OUTER JOIN banpiv b ON c.matchid = b.matchid AND c.teamid = b.teamid"""))
def q_join_outer_pivots(spark, sf):
    """Draft slots FULL OUTER JOIN ban slots on the side key (#36)."""
    champ = pivot_slots(W.draft_slot(_members(spark, sf), DEFAULT_SLOTS), "draft_slot", "championid",
                        "champion", MAX_DRAFT_SLOTS)
    bans = ban_frame(tables(spark, sf, wide=True)["teambans"]).drop("n_bans")
    return champ.join(bans, list(KEYS), "full")


_PREGAME_COLS = (["matchid", "teamid", "win", "participant_win_consistency", "participant_win_inconsistent"]
                 + [f"champion_{i}" for i in range(1, 6)] + [f"role_{i}" for i in range(1, 6)]
                 + [f"{r}_championid" for r in ROLE_ORDER] + ["n_bans"]
                 + [f"banned_champion_{i}" for i in range(1, 6)]
                 + ["platformid", "seasonid", "duration", "is_blue_side"])

PREGAME_SQL = ROLES_SQL + BANS_SQL + f"""
, label AS (
  SELECT matchid, teamid, CASE WHEN AVG(win) >= 0.5 THEN 1 ELSE 0 END AS win,
         ROUND(CAST(GREATEST(SUM(win), COUNT(win) - SUM(win)) AS DOUBLE) / GREATEST(COUNT(win), 1), 6) AS participant_win_consistency,
         CASE WHEN COUNT(DISTINCT win) > 1 THEN 1 ELSE 0 END AS participant_win_inconsistent
  FROM pm WHERE matchid IS NOT NULL AND teamid IN (100, 200) GROUP BY matchid, teamid),
draftpiv AS (SELECT matchid, teamid, {_CHAMP_SLOTS}, {_ROLE_SLOTS}, {_ROLE_PIVOT} FROM drafted GROUP BY matchid, teamid),
pregame AS (
  SELECT l.*, {", ".join(f"d.champion_{i}" for i in range(1, 6))}, {", ".join(f"d.role_{i}" for i in range(1, 6))},
         {", ".join(f"d.{r}_championid" for r in ROLE_ORDER)}, COALESCE(b.n_bans, 0) AS n_bans,
         {", ".join(f"b.banned_champion_{i}" for i in range(1, 6))},
         m.platformid, m.seasonid, m.duration, CASE WHEN l.teamid = 100 THEN 1 ELSE 0 END AS is_blue_side
  FROM label l
  LEFT JOIN draftpiv d ON l.matchid = d.matchid AND l.teamid = d.teamid
  LEFT JOIN banpiv b ON l.matchid = b.matchid AND l.teamid = b.teamid
  LEFT JOIN matches m ON l.matchid = m.id)"""


@query("pregame_dataset", with_fixture(PREGAME_SQL + f"\nSELECT {', '.join(_PREGAME_COLS)} FROM pregame"))
def q_pregame_dataset(spark, sf):
    out = stage_pregame(spark, sf)
    return out.withColumn("participant_win_consistency", F.round("participant_win_consistency", 6))


_STORED: dict = {}

#: Group column of each stored table.
GROUP_KEYS = {"members": "matchid", "matches": "id", "teamstats": "matchid", "teambans": "matchid"}


def stored_tables(spark, sf):
    """The domain tables bucketed by group, stored once for these files."""
    def make():
        t = tables(spark, sf, wide=True).stored()
        return store({name: t[name] for name in GROUP_KEYS}, GROUP_KEYS)
    return fitted_once(spark, sf, _STORED, make)


@query("pregame_dataset_bucketed", with_fixture(PREGAME_SQL + f"\nSELECT {', '.join(_PREGAME_COLS)} FROM pregame"))
def q_pregame_dataset_bucketed(spark, sf):
    """#104 over tables stored by group: one scan of each and no shuffle."""
    out = stored_tables(spark, sf).run(lambda t, one_pass: pregame_sides(t["members"], t["matches"], t["teambans"], DEFAULT_SLOTS, one_pass=one_pass))
    return out.withColumn("participant_win_consistency", F.round("participant_win_consistency", 6))
