"""Cleaning, predicates and group-integrity rules (#11-#32, #46-#49, #105).

The integrity rule (exactly two sides and one winner per group) is an
aggregate over ``matchid`` followed by a left-semi join, so a hot group is
pre-aggregated map-side and AQE can split it in the join; nothing gathers one
group's rows into a single buffer.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..constants import (BINARY_COLUMNS, KEYS, NON_NEGATIVE_COLUMNS, SIDES, SIDES_PER_GROUP,
                         TARGET)
from ..functions.scalars import binarize, finite_or_null
from .relational import coerce_int_columns, numeric_columns, string_columns

_FLOATING = (T.DoubleType, T.FloatType)


def normalize_columns(df: DataFrame) -> DataFrame:
    """Strip and lowercase every column name (#11)."""
    return df.toDF(*[c.strip().lower() for c in df.columns])


def coerce_numeric_columns(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Listed columns to double; unparseable -> NULL (#13)."""
    out = df
    for c in columns:
        if c in df.columns:
            out = out.withColumn(c, F.col(c).try_cast("double"))
    return out


def drop_exact_duplicates(df: DataFrame) -> DataFrame:
    """Whole-row dedup (#14): a partial + final aggregate on all columns."""
    return df.dropDuplicates()


def _null_or_nan(c: str, dtype) -> F.Column:
    col = F.col(c)
    return (col.isNull() | F.isnan(col)) if isinstance(dtype, _FLOATING) else col.isNull()


def fill_numeric(df: DataFrame, value=0, columns: Sequence[str] | None = None) -> DataFrame:
    """NULL (and NaN) in numeric columns -> ``value`` (#15)."""
    cols = set(numeric_columns(df) if columns is None else columns)
    out = []
    for f in df.schema.fields:
        if f.name in cols:
            out.append(F.when(_null_or_nan(f.name, f.dataType), F.lit(value).cast(f.dataType))
                       .otherwise(F.col(f.name)).alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)


def fill_string(df: DataFrame, value: str = "unknown") -> DataFrame:
    """NULL strings -> ``value`` (#16)."""
    cols = string_columns(df)
    return df.na.fill(value, subset=cols) if cols else df


def clip_non_negative(df: DataFrame, listed: Sequence[str] = NON_NEGATIVE_COLUMNS,
                      keep: Sequence[str] = ("matchid", "teamid", "win", "is_blue_side"),
                      numeric_before: Sequence[str] | None = None) -> DataFrame:
    """Listed columns: coerce, NULL -> 0, clip at 0; every other numeric non-key
    column: clip at 0 with NULL kept NULL (#17)."""
    numeric = list(numeric_columns(df) if numeric_before is None else numeric_before)
    keep = set(keep)
    out = df
    for c in listed:
        if c in out.columns:
            dtype = out.schema[c].dataType
            v = F.col(c) if c in numeric else F.col(c).try_cast("double")
            zero = F.lit(0).cast(dtype if c in numeric else T.DoubleType())
            out = out.withColumn(c, F.greatest(F.coalesce(v, zero), zero))
    for c in numeric:
        if c in keep or c in listed or c not in out.columns:
            continue
        col = F.col(c)
        out = out.withColumn(c, F.when(col < 0, F.lit(0).cast(out.schema[c].dataType)).otherwise(col))
    return out


def binarize_columns(df: DataFrame, columns: Sequence[str] = BINARY_COLUMNS) -> DataFrame:
    """Listed columns to 0/1 ints: > 0 -> 1, else (and NULL) 0 (#18)."""
    out = df
    for c in columns:
        if c in out.columns:
            out = out.withColumn(c, binarize(c))
    return out


def min_duration_filter(df: DataFrame, min_seconds: int | None, column: str = "duration") -> DataFrame:
    """Keep rows with duration >= threshold; NULL never kept (#19).

    A numeric column is compared as is, so the predicate can reach the Parquet
    scan (PushedFilters); text columns are parsed first.
    """
    if min_seconds is None or column not in df.columns:
        return df
    c = F.col(column) if column in numeric_columns(df) else F.col(column).try_cast("double")
    return df.where(c >= min_seconds)


def drop_null_keys(df: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Remove rows with a NULL key part (#20)."""
    return df.dropna(subset=list(keys))


def valid_side_filter(df: DataFrame, sides: Sequence[int] = SIDES, column: str = "teamid") -> DataFrame:
    """Side id in the allowed set (#21)."""
    return df.where(F.col(column).isin(*sides))


def inf_to_null(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """NaN and +/-inf -> NULL in floating columns (#31)."""
    cols = set(columns) if columns is not None else {
        f.name for f in df.schema.fields if isinstance(f.dataType, _FLOATING)}
    return df.select(*[finite_or_null(c).alias(c) if c in cols else F.col(c) for c in df.columns])


def align_schema(df: DataFrame, columns: Sequence[str], fill: float = 0.0) -> DataFrame:
    """Exactly ``columns`` in that order; missing ones become ``fill`` (#30)."""
    have = set(df.columns)
    return df.select(*[F.col(c) if c in have else F.lit(fill).cast("double").alias(c) for c in columns])


def drop_by_pattern(df: DataFrame, patterns: Sequence[str], protect: Sequence[str] = ()) -> DataFrame:
    """Drop every column whose name contains any pattern, case-insensitive (#28)."""
    pats = [p.lower() for p in patterns if p]
    drop = [c for c in df.columns if c not in protect and any(p in c.lower() for p in pats)]
    return df.drop(*drop)


def group_integrity_filter(df: DataFrame, group: str = "matchid", side: str = "teamid",
                           target: str = TARGET, sides: Sequence[int] = SIDES,
                           expected_sides: int = SIDES_PER_GROUP,
                           fail_on_duplicates: bool = True) -> DataFrame:
    """Keep groups with exactly ``expected_sides`` sides and exactly one winner (#46).

    Keys are coerced, the target and side flag binarized, NULL / foreign side
    ids dropped. A side-level frame has a few rows per group, so rows, distinct
    sides and winners are window aggregates over the group (no self join); they
    sit on the partitioning of a preceding join by group. A duplicate (group,
    side) key raises at execution time via ``raise_error``.
    """
    out = coerce_int_columns(df, [group, side]).withColumn(target, binarize(target))
    if "is_blue_side" in out.columns:
        out = out.withColumn("is_blue_side", binarize("is_blue_side"))
    out = out.dropna(subset=[group, side]).where(F.col(side).isin(*sides))
    names = out.columns
    w = Window.partitionBy(group)
    present = [F.max((F.col(side) == s).cast("int")).over(w) for s in sides]
    out = out.withColumns({"_rows": F.count(F.lit(1)).over(w), "_sides": sum(present[1:], present[0]),
                           "_wins": F.sum(target).over(w)})
    ok = (F.col("_sides") == expected_sides) & (F.col("_wins") == 1)
    if fail_on_duplicates:
        twice = F.raise_error(F.lit("a side occurs more than once in its group")).cast("boolean")
        ok = F.when(F.col("_rows") > F.col("_sides"), twice).otherwise(ok)
    return out.where(ok).select(*names)


def violation_counts(df: DataFrame, group: str = "matchid", side: str = "teamid",
                     target: str = TARGET, sides: Sequence[int] = SIDES,
                     expected_sides: int = SIDES_PER_GROUP) -> DataFrame:
    """One row of grain-violation counts for a side-level frame (#47, #48).

    One chain of aggregates, no join: per (group, side) key, then per group
    (the NULL group is kept as its own row so its rows still count), then one
    row. NULL sides count as a distinct side, NULL targets as 0.
    """
    keyed = df.select(F.col(group), F.col(side).try_cast("double").alias(side),
                      F.coalesce(F.col(target).try_cast("double"), F.lit(0.0)).alias("_t"))
    bad_side = F.col(side).isNull() | ~F.col(side).isin(*[float(x) for x in sides])
    per_key = keyed.groupBy(group, side).agg(F.count(F.lit(1)).alias("_n"), F.sum("_t").alias("_t"))
    per_group = per_key.groupBy(group).agg(
        F.count(F.lit(1)).alias("_sides"), F.sum("_t").alias("_wins"), F.sum("_n").alias("_rows"),
        F.sum(F.col("_n") - 1).alias("_dups"), F.sum(F.when(bad_side, F.col("_n")).otherwise(0)).alias("_bad"))
    real = F.col(group).isNotNull()
    return per_group.agg(
        F.coalesce(F.sum("_rows"), F.lit(0)).cast("bigint").alias("rows"),
        F.coalesce(F.sum("_dups"), F.lit(0)).cast("bigint").alias("duplicate_match_team_rows"),
        F.coalesce(F.sum("_bad"), F.lit(0)).cast("bigint").alias("invalid_teamid_rows"),
        F.count_if(real).cast("bigint").alias("unique_matches"),
        F.count_if(real & (F.col("_sides") != expected_sides)).cast("bigint").alias("invalid_match_team_count"),
        F.count_if(real & (F.col("_wins") != 1)).cast("bigint").alias("invalid_winner_matches"))


def assert_group_frame(df: DataFrame, name: str = "frame", **kw) -> dict:
    """Raise on any grain violation (#47); returns the counts otherwise."""
    row = violation_counts(df, **kw).first().asDict()
    bad = {k: v for k, v in row.items() if k not in ("rows", "unique_matches") and v}
    if bad:
        raise ValueError(f"{name} violates the side-level grain: {bad}")
    return row


def frame_summary(df: DataFrame, target: str = TARGET, dp: int = 6) -> DataFrame:
    """rows, columns, missing cells, and per target value its count and rate (#49).

    One aggregate grouped by the target (low cardinality by definition), then a
    window over those few rows for the totals.
    """
    nulls = [F.count_if(_null_or_nan(f.name, f.dataType)) for f in df.schema.fields]
    per_value = df.groupBy(F.col(target).cast("string").alias("target_value")).agg(
        F.count(F.lit(1)).alias("target_count"), sum(nulls[1:], nulls[0]).alias("_nulls"))
    w = Window.partitionBy(F.lit(0))
    total = F.sum("target_count").over(w)
    return per_value.select(
        total.cast("bigint").alias("rows"),
        F.lit(len(df.columns)).cast("bigint").alias("columns"),
        F.sum("_nulls").over(w).cast("bigint").alias("missing_values"),
        "target_value", F.col("target_count").cast("bigint").alias("target_count"),
        F.round(F.col("target_count") / total, dp).alias("target_rate"))


def clean_dataset(df: DataFrame, min_duration_seconds: int | None = None,
                  never_null: Sequence[str] = (), **integrity_kw) -> DataFrame:
    """#11 -> #14 -> #15 -> #16 -> #17 -> #18 -> #19 -> #46 (#105).

    ``never_null`` names columns (of the normalized frame) that hold no NULL and no NaN, which need no fill.
    A filled key is another column to the planner: rows that lie by group would be shuffled
    by group once more for the integrity rule.
    """
    out = normalize_columns(df)
    early = (min_duration_seconds is not None and min_duration_seconds > 0
             and "duration" in numeric_columns(out))
    if early:
        # equivalent to filtering after the fill and clip (both only touch NULL
        # and negative values, which fail a positive threshold either way), and
        # a plain comparison on the raw column is pushed into the scan
        out = min_duration_filter(out, min_duration_seconds)
    out = out.transform(drop_exact_duplicates)
    numeric_before = numeric_columns(out)
    out = fill_numeric(out, columns=[c for c in numeric_before if c not in never_null]).transform(fill_string)
    out = clip_non_negative(out, numeric_before=numeric_before)
    out = binarize_columns(out)
    if not early:
        out = min_duration_filter(out, min_duration_seconds)
    return group_integrity_filter(out, **integrity_kw)
