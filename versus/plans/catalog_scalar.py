"""Queries: scalar functions, cleaning steps and small relational operators
applied to the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..constants import SIDES as SIDE_IDS
from ..functions import scalars as S
from ..operators import clean as C
from ..operators import relational as R
from ..sources.fixture import read_table
from .catalog_merge import stage_members, stage_merged
from .common import rnd, round_doubles
from .registry import query, tables, with_fixture
from .sqlparts import MERGED, PM, SIDES


@query("coerce_int", """
SELECT p_partkey, TRY_CAST(TRY_CAST(SUBSTR(p_brand, 7) AS DOUBLE) AS BIGINT) AS brand_number,
       CAST(NULL AS BIGINT) AS type_number FROM part""")
def q_coerce_int(spark, sf):
    """Text to nullable integer: 'Brand#13' digits parse, the type text does not (#12)."""
    p = read_table(spark, sf, "part")
    return p.select("p_partkey", S.coerce_int(F.substring("p_brand", 7, 10)).alias("brand_number"),
                    S.coerce_int("p_type").alias("type_number"))


@query("coerce_numeric", """
SELECT event_id, TRY_CAST(SUBSTR(props, 7, LENGTH(props) - 7) AS DOUBLE) AS k, TRY_CAST(event_type AS DOUBLE) AS bad FROM events""")
def q_coerce_numeric(spark, sf):
    """The number inside the JSON text and a non-numeric column, to double (#13)."""
    e = read_table(spark, sf, "events")
    inner = F.expr("substring(props, 7, length(props) - 7)")
    return e.select("event_id", S.coerce_numeric(inner).alias("k"), S.coerce_numeric("event_type").alias("bad"))


@query("normalize_columns", """
SELECT o_orderkey AS o_orderkey, o_custkey AS o_custkey, o_orderstatus AS o_orderstatus FROM orders""")
def q_normalize_columns(spark, sf):
    """' O_OrderKey ' style names are stripped and lower-cased (#11)."""
    o = read_table(spark, sf, "orders").select(
        F.col("o_orderkey").alias(" O_OrderKey "), F.col("o_custkey").alias("O_CUSTKEY"),
        F.col("o_orderstatus").alias("o_OrderStatus "))
    return C.normalize_columns(o)


@query("drop_exact_duplicates", """
SELECT DISTINCT l_orderkey, l_linenumber, l_returnflag, l_linestatus FROM lineitem""")
def q_drop_exact_duplicates(spark, sf):
    li = read_table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus")
    return C.drop_exact_duplicates(li)


@query("fill_numeric", with_fixture(PM + """
SELECT id, CAST(COALESCE(CASE WHEN role IS NULL THEN NULL ELSE kills END, 0) AS DOUBLE) AS kills FROM pm"""))
def q_fill_numeric(spark, sf):
    """NULL numeric -> 0; kills is blanked where the raw role is missing (#15)."""
    m = stage_members(spark, sf)
    src = tables(spark, sf)["participants"].select("id", "role")
    x = m.select("id", "kills").join(src, "id").select(
        "id", F.when(F.col("role").isNull(), F.lit(None).cast("double")).otherwise(F.col("kills")).alias("kills"))
    return C.fill_numeric(x)


@query("fill_string", with_fixture("SELECT id, COALESCE(role, 'unknown') AS role FROM participants"))
def q_fill_string(spark, sf):
    return C.fill_string(tables(spark, sf)["participants"].select("id", "role"))


@query("clip_non_negative", """
SELECT c_custkey, GREATEST(c_acctbal, 0.0) AS c_acctbal FROM customer""")
def q_clip_non_negative(spark, sf):
    """Negative balances clipped at 0 (dynamic numeric clip, keys kept) (#17)."""
    c = read_table(spark, sf, "customer").select("c_custkey", "c_acctbal")
    return C.clip_non_negative(c, listed=(), keep=("c_custkey",))


@query("binarize", """
SELECT c_custkey, CASE WHEN COALESCE(c_acctbal, 0) > 0 THEN 1 ELSE 0 END AS positive FROM customer""")
def q_binarize(spark, sf):
    c = read_table(spark, sf, "customer")
    return c.select("c_custkey", S.binarize("c_acctbal").alias("positive"))


@query("drop_null_keys", with_fixture("SELECT id, player, role FROM participants WHERE role IS NOT NULL"))
def q_drop_null_keys(spark, sf):
    """Rows with a NULL in any key part removed (keys: id, role) (#20)."""
    return C.drop_null_keys(tables(spark, sf)["participants"].select("id", "player", "role"), ["id", "role"])


@query("valid_side_filter", with_fixture(PM + " SELECT id, teamid FROM pm WHERE teamid IN (100, 200)"))
def q_valid_side_filter(spark, sf):
    m = stage_members(spark, sf).select("id", "teamid")
    return C.valid_side_filter(m, SIDE_IDS)


@query("safe_ratio", """
SELECT o_orderkey, ROUND(COALESCE(o_totalprice, 0) / GREATEST(COALESCE(CAST(o_custkey % 3 AS DOUBLE), 0), 1e-6), 6) AS ratio FROM orders""")
def q_safe_ratio(spark, sf):
    """Price over (custkey mod 3): zero denominators fall back to 1e-6 (#24)."""
    o = read_table(spark, sf, "orders")
    return round_doubles(o.select("o_orderkey", S.safe_ratio("o_totalprice", (F.col("o_custkey") % 3).cast("double")).alias("ratio")))


@query("inf_to_null", """
SELECT c_custkey, CASE WHEN c_acctbal = 0 THEN NULL ELSE ROUND(1.0 / c_acctbal, 6) END AS inv FROM customer""")
def q_inf_to_null(spark, sf):
    """1 / balance made finite: the infinities become NULL (#31)."""
    c = read_table(spark, sf, "customer").select(
        "c_custkey", F.when(F.col("c_acctbal") == 0, F.lit(float("inf"))).otherwise(1.0 / F.col("c_acctbal")).alias("inv"))
    return round_doubles(C.inf_to_null(c))


@query("map_values", with_fixture(PM + SIDES + """
SELECT matchid, teamid, CASE win WHEN 1 THEN 'Win' WHEN 0 THEN 'Loss' ELSE 'ID:' || CAST(win AS VARCHAR) END AS outcome FROM sides"""))
def q_map_values(spark, sf):
    """1 -> Win, 0 -> Loss, else ID:<value> (#32)."""
    s = R.derive_group_label(stage_members(spark, sf))
    return s.select("matchid", "teamid", S.value_or_label("win", {1: "Win", 0: "Loss"}).alias("outcome"))


@query("sigmoid", """
SELECT event_id, ROUND(1.0 / (1.0 + EXP(-((value - 50.0) / 25.0))), 6) AS score FROM events""")
def q_sigmoid(spark, sf):
    e = read_table(spark, sf, "events")
    return round_doubles(e.select("event_id", S.sigmoid((F.col("value") - 50.0) / 25.0).alias("score")))


@query("clip_probability", """
SELECT event_id, ROUND(GREATEST(LEAST(value / 100.0, CAST(1 AS DOUBLE) - CAST(1e-15 AS DOUBLE)), CAST(1e-15 AS DOUBLE)), 6) AS p FROM events""")
def q_clip_probability(spark, sf):
    e = read_table(spark, sf, "events")
    return round_doubles(e.select("event_id", S.clip_probability(F.col("value") / 100.0).alias("p")))


@query("union_all", """
SELECT s_suppkey AS key, s_name AS name, s_nationkey AS nationkey FROM supplier
UNION ALL SELECT c_custkey, c_name, c_nationkey FROM customer""")
def q_union_all(spark, sf):
    """Row-wise concat by column name (#79)."""
    s = read_table(spark, sf, "supplier").select(F.col("s_suppkey").alias("key"), F.col("s_name").alias("name"),
                                                 F.col("s_nationkey").alias("nationkey"))
    c = read_table(spark, sf, "customer").select(F.col("c_custkey").alias("key"), F.col("c_name").alias("name"),
                                                 F.col("c_nationkey").alias("nationkey"))
    return s.unionByName(c)


@query("join_aggregates", with_fixture(PM + SIDES + f"""
SELECT matchid, teamid, {rnd('kills_sum')} AS kills_sum, {rnd('kills_mean')} AS kills_mean,
       {rnd('firstbloodkill_rate')} AS firstbloodkill_rate, win FROM sides"""))
def q_join_aggregates(spark, sf):
    """Sum, mean, rate and label in one aggregate instead of four merged ones (#37)."""
    s = R.aggregate_sides(stage_members(spark, sf), binary=["firstbloodkill"])
    return round_doubles(s.select("matchid", "teamid", "kills_sum", "kills_mean", "firstbloodkill_rate", "win"))


@query("semi_valid_groups", with_fixture(PM + SIDES + MERGED + """
SELECT m.id, m.matchid FROM pm m WHERE m.matchid IN (SELECT matchid FROM merged GROUP BY matchid
  HAVING COUNT(DISTINCT teamid) = 2 AND SUM(win) = 1)"""))
def q_semi_valid_groups(spark, sf):
    """Member rows of groups that pass the integrity rule, by left-semi join (#39)."""
    valid = C.group_integrity_filter(stage_merged(spark, sf)).select("matchid").distinct()
    return R.semi_valid_groups(stage_members(spark, sf).select("id", "matchid"), valid)


@query("lookup_with_default", with_fixture(PM + """
SELECT p.id, COALESCE(c.name, 'none') AS champion_name
FROM pm p LEFT JOIN champs c ON CAST(p.championid AS VARCHAR) = CAST(c.id AS VARCHAR)"""))
def q_lookup_with_default(spark, sf):
    t = tables(spark, sf)
    table = t["champs"].select(F.col("id").cast("string").alias("category"), F.col("name").alias("value"))
    out = R.lookup_with_default(stage_members(spark, sf).select("id", "championid"), "championid", table,
                                "champion_name", "none")
    return out.select("id", "champion_name")


@query("reattach_columns", with_fixture(PM + SIDES + f"""
SELECT matchid, teamid, {rnd('kills_sum')} AS kills_sum, {rnd('deaths_sum')} AS deaths_sum, win FROM sides"""))
def q_reattach_columns(spark, sf):
    """Ids, features and label travel in one row; the order [ids, features, target] is one select (#174)."""
    s = R.aggregate_sides(stage_members(spark, sf), binary=[])
    return round_doubles(s.select("matchid", "teamid", "kills_sum", "deaths_sum", "win"))
