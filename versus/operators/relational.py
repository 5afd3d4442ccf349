"""Joins and side-level aggregates (#33-#45).

Design notes for scale:
* one ``groupBy(matchid, teamid)`` computes every sum, mean, rate and the
  label statistics (partial + final hash aggregate, no joins between them);
* dimension joins are plain joins: AQE turns them into broadcast joins from
  measured runtime sizes, so nothing is broadcast without a size check;
* "first row per key" uses ``row_number`` over an explicit order, because
  Spark has no file order.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..constants import AGG_EXCLUDED, KEYS, SIDES, TARGET
from ..functions.scalars import binarize, coerce_int, fill_side, side_flag
from ..session import cut_lineage

NUMERIC_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType,
                 T.DoubleType, T.DecimalType)


def numeric_columns(df: DataFrame) -> list[str]:
    """Numeric columns by schema (plan-time, no job)."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NUMERIC_TYPES)
            and not isinstance(f.dataType, T.BooleanType)]


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def coerce_int_columns(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Nullable-integer coercion of the listed columns that exist (#12).

    Integer columns are left untouched so no needless cast enters the plan.
    """
    out = df
    for c in columns:
        if c in df.columns and not isinstance(df.schema[c].dataType, (T.LongType, T.IntegerType,
                                                                      T.ShortType, T.ByteType)):
            out = out.withColumn(c, coerce_int(c))
    return out


def join_with_suffixes(left: DataFrame, right: DataFrame, on: Sequence[str], how: str,
                       suffixes: tuple[str, str] = ("_x", "_y")) -> DataFrame:
    """Equi-join on same-named keys; other shared names get the given suffixes (#33)."""
    on = list(on)
    shared = (set(left.columns) & set(right.columns)) - set(on)
    ls, rs = suffixes
    lsel = [F.col(c).alias(c + ls) if c in shared else F.col(c) for c in left.columns]
    rsel = [F.col(c).alias(c + rs) if c in shared else F.col(c) for c in right.columns]
    return left.select(*lsel).join(right.select(*rsel), on, how)


def join_inner_stats(participants: DataFrame, stats: DataFrame, key: str = "id",
                     stats_columns: Sequence[str] | None = None) -> DataFrame:
    """Member rows joined to their statistics by id (#33).

    ``stats_columns`` prunes the statistics side (the pre-game flow needs only
    ``id`` and ``win``); Catalyst also prunes unused columns by itself.
    """
    participants = coerce_int_columns(participants, ["id", "matchid", "player", "teamid", "championid"])
    stats = coerce_int_columns(stats, [key])
    if stats_columns is not None:
        stats = stats.select(*[c for c in stats_columns if c in stats.columns])
    return join_with_suffixes(participants, stats, [key], "inner", ("_participant", "_stat"))


def assign_sides(df: DataFrame, slots_per_side: int = 5, target: str = TARGET,
                 sides: Sequence[int] = SIDES) -> DataFrame:
    """Side id (present or inferred), binary target, valid keys only (#20-#22)."""
    side = fill_side("teamid", "player", slots_per_side) if "teamid" in df.columns else \
        fill_side(F.lit(None), "player", slots_per_side)
    out = df.withColumn("teamid", side)
    if target in out.columns:
        out = out.withColumn(target, binarize(target))
    return out.where(F.col("matchid").isNotNull() & F.col("teamid").isNotNull()
                     & F.col("teamid").isin(*sides))


def detect_binary(df: DataFrame, columns: Sequence[str]) -> list[str]:
    """Columns whose non-null values are all 0 or 1 (all-NULL columns excluded) (#43).

    One single-row aggregate job over a pruned scan.
    """
    if not columns:
        return []
    exprs = []
    for i, c in enumerate(columns):
        v = F.col(c).cast("double")
        exprs.append(F.count(v).alias(f"n{i}"))
        exprs.append(F.count(F.when(v.isNotNull() & ~v.isin(0.0, 1.0), 1)).alias(f"bad{i}"))
    row = df.agg(*exprs).first()
    return [c for i, c in enumerate(columns) if row[f"n{i}"] > 0 and row[f"bad{i}"] == 0]


def label_columns(target: str = TARGET) -> list:
    """Side label from member outcomes (#45): majority vote, tie -> 1.

    ``inconsistent`` uses min/max instead of a distinct count so the whole
    aggregate stays one hash aggregate (no Expand for DISTINCT).
    """
    t = F.col(target)
    wins = F.coalesce(F.sum(t), F.lit(0)).cast("double")
    n = F.count(t).cast("double")
    return [
        F.coalesce((F.avg(t) >= 0.5).cast("int"), F.lit(0)).alias(target),
        (F.greatest(wins, n - wins) / F.greatest(n, F.lit(1.0))).alias("participant_win_consistency"),
        F.coalesce((F.max(t) > F.min(t)).cast("int"), F.lit(0)).alias("participant_win_inconsistent"),
    ]


def feature_columns_for_aggregation(df: DataFrame, excluded: Iterable[str] = AGG_EXCLUDED) -> list[str]:
    excluded = set(excluded)
    cols = [c for c in numeric_columns(df) if c not in excluded]
    if not cols:
        raise ValueError("nothing to aggregate: no numeric member column is left")
    return cols


def aggregate_sides(df: DataFrame, keys: Sequence[str] = KEYS, target: str = TARGET,
                    excluded: Iterable[str] = AGG_EXCLUDED, binary: Sequence[str] | None = None,
                    with_label: bool = True) -> DataFrame:
    """``x_sum`` / ``x_mean`` of every numeric feature, ``b_rate`` of binary ones,
    and the side label, in ONE aggregate (#37, #42, #44, #45).

    ``binary=None`` detects binary columns (#43) with one pruned probe over the
    member rows (two counts per column); the result itself stays lazy.
    """
    feats = feature_columns_for_aggregation(df, excluded)
    rates = set(detect_binary(df, feats) if binary is None else binary)
    exprs = [F.coalesce(F.sum(c), F.lit(0)).alias(f"{c}_sum") for c in feats]
    exprs += [F.avg(c).alias(f"{c}_mean") for c in feats]
    if with_label:
        exprs += label_columns(target)
    exprs += [F.avg(c).alias(f"{c}_rate") for c in feats if c in rates]
    return df.groupBy(*keys).agg(*exprs)


def derive_group_label(df: DataFrame, keys: Sequence[str] = KEYS, target: str = TARGET) -> DataFrame:
    """Only the label statistics per side (#45)."""
    return df.groupBy(*keys).agg(*label_columns(target))


def first_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence | None = None) -> DataFrame:
    """Keep one row per key: the first by an explicit order (all other columns by default) (#34)."""
    keys = list(keys)
    if order_by is None:
        order_by = [F.col(c).asc_nulls_last() for c in df.columns if c not in keys]
    if not order_by:
        return df.dropDuplicates(keys)
    w = Window.partitionBy(*keys).orderBy(*order_by)
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def join_left_dedup(left: DataFrame, right: DataFrame, keys: Sequence[str] = KEYS,
                    order_by: Sequence | None = None, suffix: str = "_team") -> DataFrame:
    """Left join to the first right row per key; clashing right columns get ``suffix`` (#34)."""
    right = coerce_int_columns(right, keys)
    return join_with_suffixes(left, first_per_key(right, keys, order_by), keys, "left", ("", suffix))


def join_left_dimension(left: DataFrame, dim: DataFrame, dim_key: str = "id",
                        key: str = "matchid", suffix: str = "_match") -> DataFrame:
    """Left join to a dimension whose key is renamed to ``key`` (#35)."""
    dim = coerce_int_columns(dim, [dim_key]).withColumnRenamed(dim_key, key)
    return join_with_suffixes(left, dim, [key], "left", ("", suffix))


def with_side_flag(df: DataFrame) -> DataFrame:
    return df.withColumn("is_blue_side", side_flag("teamid"))


def semi_valid_groups(df: DataFrame, valid: DataFrame, key: str = "matchid") -> DataFrame:
    """Rows whose group is in ``valid`` (#39); a left-semi join (AQE splits skewed keys)."""
    return df.join(valid.select(key), key, "left_semi")


def anti_disjoint_check(a: DataFrame, b: DataFrame, key: str = "matchid") -> DataFrame:
    """Keys present in both inputs; an empty result means the sets are disjoint (#41)."""
    return a.select(key).where(F.col(key).isNotNull()).intersect(b.select(key))


def split_overlap_counts(df: DataFrame, key: str, split_col: str, splits: Sequence[str]) -> DataFrame:
    """Keys present in each pair of splits, one row (#41 at scale): per key one
    flag per split (a partial + final aggregate), then pair counts."""
    flags = df.where(F.col(key).isNotNull()).groupBy(key).agg(
        *[F.max((F.col(split_col) == s_).cast("int")).alias(f"_in_{s_}") for s_ in splits])
    pairs = [(a, b) for i, a in enumerate(splits) for b in splits[i + 1:]]
    return flags.agg(*[F.count_if((F.col(f"_in_{a}") == 1) & (F.col(f"_in_{b}") == 1)).cast("bigint")
                       .alias(f"{a}_{b}") for a, b in pairs])


def left_join_on_condition(runs: DataFrame, params: DataFrame, metrics: DataFrame,
                           param_key: str, metric_key: str) -> DataFrame:
    """runs LEFT JOIN params ON id AND key = param_key LEFT JOIN metrics ON id AND key = metric_key (#40)."""
    p = params.where(F.col("key") == param_key).select(
        F.col("run_id").alias("_p_run"), F.col("value").alias(param_key))
    m = metrics.where(F.col("key") == metric_key).select(
        F.col("run_id").alias("_m_run"), F.col("value").alias(metric_key))
    return (runs.join(p, runs.run_id == p._p_run, "left")
            .join(m, runs.run_id == m._m_run, "left").drop("_p_run", "_m_run"))


BROADCAST_LOOKUP_BYTES = 64 << 20  # of the keys' text in a dictionary that is sent to every task
BROADCAST_LOOKUP_ROWS = 200_000  # (key, value) rows that are sent to every task; more meet in a shuffle


def with_small(df: DataFrame, small: DataFrame, on: str | Column) -> DataFrame:
    """Inner join to a small table (one row per key; by a name or a condition), counted first and broadcast only up to
    ``BROADCAST_LOOKUP_ROWS``; beyond that the same join is left to the planner."""
    small = cut_lineage(small)
    few = small.limit(BROADCAST_LOOKUP_ROWS + 1).count() <= BROADCAST_LOOKUP_ROWS
    return df.join(F.broadcast(small) if few else small, on)


def lookup_with_default(df: DataFrame, column: str, table: DataFrame, output: str, default,
                        key_col: str = "category", value_col: str = "value", n_entries: int | None = None) -> DataFrame:
    """Map ``column`` through a fitted (key, value) table; unseen or NULL -> default (#38).

    One left join. NULL keys of the table are dropped and a repeated key counts
    once (smallest value), so every input row appears exactly once. The table is
    counted first (``n_entries`` if known) and broadcast only up to
    ``BROADCAST_LOOKUP_ROWS``; the result does not depend on it.
    """
    t = table.where(F.col(key_col).isNotNull()).groupBy(F.col(key_col).alias("_lk")).agg(F.min(value_col).alias("_lv"))
    n = table.count() if n_entries is None else n_entries
    right = F.broadcast(t) if n <= BROADCAST_LOOKUP_ROWS else t
    joined = df.join(right, df[column].cast(t.schema["_lk"].dataType) == right["_lk"], "left")
    return joined.withColumn(output, F.coalesce(F.col("_lv"), F.lit(default))).drop("_lk", "_lv")


class Lookup(NamedTuple):
    """``output`` of a row is the dictionary's value for (``feature``, ``key``), else ``default``."""
    feature: str
    key: Column  # string
    output: str
    default: float


def lookup_many(df: DataFrame, lookups: Sequence[Lookup], dictionary: DataFrame) -> DataFrame:
    """Many lookups in one dictionary (feature, category, value), unique by its first two columns (#102).

    Up to ``BROADCAST_LOOKUP_ROWS`` entries of ``BROADCAST_LOOKUP_BYTES`` in all (counted first), the
    dictionary is built and sent once, and every lookup probes this one table without a shuffle. Beyond it the rows are stacked as (row, lookup, key), meet the
    dictionary in one shuffle join and come back as one row by one aggregate, whatever the number
    of lookups; NULL keys do not move. Both ways give the same values, row for row.
    """
    if not lookups:
        return df
    entries = cut_lineage(dictionary.where(F.col("category").isNotNull()).select(
        F.struct(F.col("feature"), F.col("category")).alias("_lk"), F.col("value").cast("double").alias("_lv")))
    size = entries.agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("_lk.category")).alias("bytes")).first()
    kept = df.columns
    if size["n"] <= BROADCAST_LOOKUP_ROWS and (size["bytes"] or 0) <= BROADCAST_LOOKUP_BYTES:
        out, small = df, F.broadcast(entries)
        for i, x in enumerate(lookups):
            out = out.withColumn(f"_k{i}", F.struct(F.lit(x.feature).alias("feature"), x.key.alias("category")))
        for i in range(len(lookups)):
            out = out.join(small.withColumnsRenamed({"_lk": f"_e{i}", "_lv": f"_v{i}"}), F.col(f"_k{i}") == F.col(f"_e{i}"), "left")
    else:
        rows = cut_lineage(df.withColumn("_row", F.monotonically_increasing_id()))
        asked = F.array(*[F.struct(F.lit(i).alias("at"), F.lit(x.feature).alias("feature"), x.key.alias("category"))
                          for i, x in enumerate(lookups)])
        asked = rows.select("_row", F.inline(F.filter(asked, lambda a: a["category"].isNotNull())))
        met = asked.select("_row", "at", F.struct("feature", "category").alias("_lk")).join(entries, "_lk")
        back = met.groupBy("_row").agg(*[F.max(F.when(F.col("at") == i, F.col("_lv"))).alias(f"_v{i}") for i in range(len(lookups))])
        out = rows.join(back, "_row", "left")
    new = {x.output: F.coalesce(F.col(f"_v{i}"), F.lit(float(x.default))).alias(x.output) for i, x in enumerate(lookups)}
    return out.select(*[c for c in kept if c not in new], *new.values())
