"""Reshape and row-wise operators (#55, #68-#74).

Pivots use fixed output columns (``max(when(slot = i, v))``), so there is no
pivot-value discovery job and the side-level aggregate stays one pass.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import KEYS, ROLE_ORDER, UNKNOWN_ROLE


def slot_columns(slot_col: str, value_col: str, prefix: str, n: int) -> list[Column]:
    """``prefix_1..n`` = the value at slot i (aggregate expressions) (#68)."""
    return [F.max(F.when(F.col(slot_col) == i, F.col(value_col))).alias(f"{prefix}_{i}")
            for i in range(1, n + 1)]


def pivot_slots(df: DataFrame, slot_col: str, value_col: str, prefix: str, n: int,
                keys: Sequence[str] = KEYS) -> DataFrame:
    """Long (key, slot, value) -> wide ``prefix_1..n`` (#68)."""
    return df.groupBy(*keys).agg(*slot_columns(slot_col, value_col, prefix, n))


def role_columns(role_col: str = "canonical_role", value_col: str = "championid",
                 order_col: str = "draft_slot", roles: Sequence[str] = tuple(ROLE_ORDER)) -> list[Column]:
    """``<role>_championid`` = value of the first member (by ``order_col``) with that role (#64, #69)."""
    # min_by keeps fixed-width buffers, so the aggregate stays a codegen'd HashAggregate
    return [F.min_by(F.col(value_col), F.when(F.col(role_col) == r, F.col(order_col))).alias(f"{r}_{value_col}")
            for r in roles]


def code_slot_columns(slot_col: str, code_col: str, labels: dict, prefix: str, n: int,
                      default: str) -> list[Column]:
    """Like ``slot_columns`` for a string that is a function of an integer code:
    the aggregate keeps the integer (hash aggregate) and the label is mapped
    back afterwards with a literal map."""
    lut = F.create_map(*[x for k, v in labels.items() for x in (F.lit(k), F.lit(v))])
    return [F.coalesce(F.element_at(lut, F.max(F.when(F.col(slot_col) == i, F.col(code_col)))),
                       F.when(F.max(F.when(F.col(slot_col) == i, F.col(code_col))).isNotNull(), F.lit(default))
                       ).alias(f"{prefix}_{i}") for i in range(1, n + 1)]


def pivot_role(df: DataFrame, keys: Sequence[str] = KEYS, **kw) -> DataFrame:
    """Role pivot as its own operator (#69)."""
    return df.groupBy(*keys).agg(*role_columns(**kw))


def pivot_metrics(df: DataFrame, id_col: str, key_col: str, value_col: str,
                  keys: Sequence[str]) -> DataFrame:
    """max(case when key = k then value end) per id for the listed keys (#55)."""
    return df.groupBy(id_col).agg(*[F.max(F.when(F.col(key_col) == k, F.col(value_col))).alias(k)
                                    for k in keys])


def melt(df: DataFrame, ids: Sequence[str], values: Sequence[str], var: str = "metric",
         value: str = "value") -> DataFrame:
    """Wide -> long (#70)."""
    return df.unpivot(list(ids), list(values), var, value)


def stack_columns(df: DataFrame, columns: Sequence[str], name: str = "value") -> DataFrame:
    """All listed columns stacked into one column (#71)."""
    return df.select(F.explode(F.array(*[F.col(c) for c in columns])).alias(name))


def row_stats(df: DataFrame, columns: Sequence[str], prefix: str, std_fill: float = 0.0) -> DataFrame:
    """Row-wise mean, min, max, sample std (NULL -> ``std_fill``) and span, NULLs skipped (#72);
    plain arithmetic over the fixed columns, so it stays in generated code."""
    x = [F.col(c).cast("double") for c in columns]
    names = df.columns
    n = sum((v.isNotNull().cast("int") for v in x), F.lit(0))
    total = sum((F.coalesce(v, F.lit(0.0)) for v in x), F.lit(0.0))
    out = df.withColumns({"_n": n, "_total": total}).withColumn("_mean", F.when(F.col("_n") > 0, F.col("_total") / F.col("_n")))
    out = out.withColumn("_sq", sum((F.coalesce((v - F.col("_mean")) * (v - F.col("_mean")), F.lit(0.0)) for v in x), F.lit(0.0)))
    std = F.when(F.col("_n") > 1, F.sqrt(F.col("_sq") / (F.col("_n") - 1))).otherwise(F.lit(std_fill))
    high, low = (F.greatest(*x), F.least(*x)) if len(x) > 1 else (x[0], x[0])
    return out.select(*names, F.col("_mean").alias(f"{prefix}_avg"), low.alias(f"{prefix}_min"),
                      high.alias(f"{prefix}_max"), std.alias(f"{prefix}_std"), (high - low).alias(f"{prefix}_span"))


def row_counts(df: DataFrame, columns: Sequence[str], size_name: str = "draft_size",
               full_name: str = "has_full_draft", distinct_name: str = "unique_champion_count") -> DataFrame:
    """Non-NULL count, all-present flag and distinct non-NULL count per row (#73)."""
    arr = F.array(*[F.col(c) for c in columns])
    present = F.size(F.array_compact(arr))
    return df.select("*", present.cast("bigint").alias(size_name),
                     (present == len(columns)).cast("int").alias(full_name),
                     F.size(F.array_distinct(F.array_compact(arr))).cast("bigint").alias(distinct_name))


def role_diversity(df: DataFrame, columns: Sequence[str], unknown: str = UNKNOWN_ROLE) -> DataFrame:
    """Known-role count and distinct lower-cased known roles per row (#74)."""
    filled = [F.coalesce(F.col(c).cast("string"), F.lit(unknown)) for c in columns]
    known = sum(((x != unknown).cast("int") for x in filled), F.lit(0))
    lowered = F.array(*[F.lower(x) for x in filled])
    distinct_known = F.size(F.array_distinct(F.filter(lowered, lambda x: x != unknown)))
    return df.select("*", known.cast("bigint").alias("role_known_count"),
                     distinct_known.cast("bigint").alias("role_diversity"))
