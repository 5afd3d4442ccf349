"""Reusable SQL fragments for the DuckDB oracle (one per Spark stage).

They are written independently of the Spark code, as plain SQL over the
fixture views, so the oracle checks the Spark operators rather than echoing them.
"""

from __future__ import annotations

from ..sources.fixture import DEFAULT_SLOTS

STAT_FEATURES = ("kills", "deaths", "assists", "goldearned", "goldspent", "firstbloodkill")
BINARY_STATS = ("firstbloodkill",)

# member rows: participants JOIN stats, side inferred from the slot, binary win
PM = f""", pm AS (
  SELECT p.id, p.matchid, p.player, p.championid, p.position, p.role,
         CAST(CASE WHEN p.player IS NULL THEN NULL WHEN p.player <= {DEFAULT_SLOTS} THEN 100 ELSE 200 END AS BIGINT) AS teamid,
         CASE WHEN COALESCE(CAST(s.win AS DOUBLE), 0) > 0 THEN 1 ELSE 0 END AS win,
         {", ".join("s." + c for c in STAT_FEATURES)}
  FROM participants p JOIN stats s ON p.id = s.id)"""

_sums = ",\n         ".join(f"CAST(COALESCE(SUM({c}), 0) AS DOUBLE) AS {c}_sum" for c in STAT_FEATURES)
_means = ",\n         ".join(f"AVG({c}) AS {c}_mean" for c in STAT_FEATURES)
_rates = ",\n         ".join(f"AVG({c}) AS {c}_rate" for c in BINARY_STATS)

LABEL = """CASE WHEN AVG(win) >= 0.5 THEN 1 ELSE 0 END AS win,
         CAST(GREATEST(SUM(win), COUNT(win) - SUM(win)) AS DOUBLE) / GREATEST(COUNT(win), 1) AS participant_win_consistency,
         CASE WHEN COUNT(DISTINCT win) > 1 THEN 1 ELSE 0 END AS participant_win_inconsistent"""

# one row per (matchid, teamid): sums, means, rates and the label
SIDES = f""", sides AS (
  SELECT matchid, teamid,
         {_sums},
         {_means},
         {_rates},
         {LABEL}
  FROM pm WHERE matchid IS NOT NULL AND teamid IN (100, 200)
  GROUP BY matchid, teamid)"""

SIDE_COLUMNS = ([f"{c}_sum" for c in STAT_FEATURES] + [f"{c}_mean" for c in STAT_FEATURES]
                + [f"{c}_rate" for c in BINARY_STATS]
                + ["win", "participant_win_consistency", "participant_win_inconsistent"])

# post-game dataset: sides LEFT JOIN teamstats LEFT JOIN matches, side flag
MERGED = """, merged AS (
  SELECT s.*, t.firstblood, t.towerkills, t.dragonkills, t.baronkills,
         m.platformid, m.seasonid, m.duration,
         CASE WHEN s.teamid = 100 THEN 1 ELSE 0 END AS is_blue_side
  FROM sides s
  LEFT JOIN teamstats t ON s.matchid = t.matchid AND s.teamid = t.teamid
  LEFT JOIN matches m ON s.matchid = m.id)"""

MERGED_COLUMNS = (["matchid", "teamid"] + SIDE_COLUMNS
                  + ["firstblood", "towerkills", "dragonkills", "baronkills",
                     "platformid", "seasonid", "duration", "is_blue_side"])

# cleaned (min duration 300): fills are no-ops on this data except the
# integer/double clip; integrity = 2 sides and 1 winner per match
CLEANED = """, cleaned0 AS (
  SELECT * FROM merged WHERE duration >= 300),
valid AS (
  SELECT matchid FROM cleaned0 GROUP BY matchid
  HAVING COUNT(DISTINCT teamid) = 2 AND SUM(win) = 1),
cleaned AS (
  SELECT c.* FROM cleaned0 c WHERE c.matchid IN (SELECT matchid FROM valid))"""
