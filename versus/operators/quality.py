"""Data-quality expectations compiled to Spark aggregates (#160-#170).

A suite is a list of ``Expectation`` specs. ``run_suite`` answers every
row-level expectation (not-null, between, in-set) of a suite with ONE
aggregate over the frame, every uniqueness check with one
``groupBy(key).count`` aggregate (partial + final, so a hot key is
pre-aggregated), a learnt set with a join of value counts, and all schema
checks with one row count. The result is a long table: one row per expectation.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

@dataclass
class Expectation:
    kind: str                      # not_null | between | in_set | unique | compound_unique |
    #                                exists | column_count_between | columns_match_set
    column: str | None = None
    columns: Sequence[str] = ()
    min_value: float | None = None
    max_value: float | None = None
    values: Sequence = ()
    learned: DataFrame | None = None
    mostly: float = 1.0
    extra: dict = field(default_factory=dict)


def expect_not_null(c, mostly=1.0):
    return Expectation("not_null", c, mostly=mostly)


def expect_between(c, min_value=None, max_value=None, mostly=1.0):
    return Expectation("between", c, min_value=min_value, max_value=max_value, mostly=mostly)


def expect_in_set(c, values, mostly=1.0):
    """``values``: a sequence, or a learnt set (one-column frame), which is joined."""
    if isinstance(values, DataFrame):
        return Expectation("in_set", c, learned=values, mostly=mostly)
    return Expectation("in_set", c, values=list(values), mostly=mostly)


def expect_unique(c):
    return Expectation("unique", c)


def expect_compound_unique(cols):
    return Expectation("compound_unique", ",".join(cols), columns=list(cols))


def expect_column_exists(c):
    return Expectation("exists", c)


def expect_column_count_between(min_value=None, max_value=None):
    return Expectation("column_count_between", None, min_value=min_value, max_value=max_value)


def expect_columns_match_set(cols):
    return Expectation("columns_match_set", None, columns=list(cols))


def learned_set(df: DataFrame, column: str) -> DataFrame:
    """Allowed values learnt from the data (#167): the distinct non-NULL values, as a
    one-column frame of any size."""
    return df.select(F.col(column).alias("value")).where(F.col("value").isNotNull()).distinct()


def forbid_columns(df: DataFrame, forbidden: Sequence[str]) -> None:
    """Raise when any outcome-like column is present (#168)."""
    present = [c for c in forbidden if c in df.columns]
    if present:
        raise ValueError("columns that give the outcome away: " + ", ".join(present))


def _row_level(e: Expectation):
    """(unexpected, considered) aggregate expressions for a row-level expectation."""
    c = F.col(e.column)
    if e.kind == "not_null":
        return F.count_if(c.isNull()), F.count(F.lit(1))
    if e.kind == "between":
        bad = F.lit(False)
        if e.min_value is not None:
            bad = bad | (c < F.lit(e.min_value))
        if e.max_value is not None:
            bad = bad | (c > F.lit(e.max_value))
        return F.count_if(c.isNotNull() & bad), F.count(c)
    if e.kind == "in_set":
        return F.count_if(c.isNotNull() & ~c.isin(*e.values)), F.count(c)
    raise ValueError(e.kind)


def run_suite(df: DataFrame, suite: Sequence[Expectation], name: str = "suite") -> DataFrame:
    """One row per expectation: success, unexpected and element counts (#169)."""
    cols = set(df.columns)
    static, row_level, unique, learned = [], [], [], []
    for i, e in enumerate(suite):
        if e.kind == "exists":
            static.append((e.kind, e.column, 0 if e.column in cols else 1))
        elif e.kind == "column_count_between":
            n = len(df.columns)
            ok = (e.min_value is None or n >= e.min_value) and (e.max_value is None or n <= e.max_value)
            static.append((e.kind, None, 0 if ok else 1))
        elif e.kind == "columns_match_set":
            static.append((e.kind, None, len(set(e.columns) ^ cols)))
        elif e.kind in ("unique", "compound_unique"):
            unique.append((i, e))
        elif e.column not in cols:
            static.append((e.kind, e.column, 1))
        elif e.learned is not None:
            learned.append(e)
        else:
            row_level.append((i, e))
    parts = []
    if static:
        # what the schema decides, for the rows it was decided for
        cells = F.array(*[F.struct(F.lit(kind).alias("expectation"), F.lit(col).cast("string").alias("column_name"),
                                   F.lit(int(bad == 0)).alias("success"), F.lit(bad).cast("bigint").alias("unexpected_count"))
                          for kind, col, bad in static])
        rows = df.agg(F.count(F.lit(1)).alias("element_count")).select(F.explode(cells).alias("r"), "element_count")
        parts.append(rows.select(F.lit(name).alias("suite"), "r.expectation", "r.column_name", "r.success", "r.unexpected_count",
                                 "element_count"))
    for e in learned:
        counts = df.where(F.col(e.column).isNotNull()).groupBy(F.col(e.column).alias("_v")).agg(F.count(F.lit(1)).alias("_n"))
        known = e.learned.select(F.col(e.learned.columns[0]).alias("_k")).distinct()
        res = counts.join(known, F.col("_v") == F.col("_k"), "left").agg(
            F.coalesce(F.sum(F.when(F.col("_k").isNull(), F.col("_n"))), F.lit(0)).cast("bigint").alias("unexpected_count"),
            F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint").alias("element_count"))
        share = 1 - F.col("unexpected_count") / F.greatest(F.col("element_count"), F.lit(1))
        parts.append(res.select(F.lit(name).alias("suite"), F.lit(e.kind).alias("expectation"), F.lit(e.column).alias("column_name"),
                                (share >= e.mostly).cast("int").alias("success"), "unexpected_count", "element_count"))
    if row_level:
        exprs = []
        for i, e in row_level:
            bad, n = _row_level(e)
            exprs += [bad.alias(f"b{i}"), n.alias(f"n{i}")]
        one = df.agg(*exprs)
        stack = F.array(*[F.struct(F.lit(e.kind).alias("expectation"), F.lit(e.column).alias("column_name"),
                                   F.col(f"b{i}").cast("bigint").alias("unexpected_count"),
                                   F.col(f"n{i}").cast("bigint").alias("element_count"),
                                   F.lit(float(e.mostly)).alias("mostly"))
                          for i, e in row_level])
        long = one.select(F.explode(stack).alias("r")).select("r.*")
        ok = F.when(F.col("element_count") == 0, F.lit(1)).otherwise(
            ((1 - F.col("unexpected_count") / F.col("element_count")) >= F.col("mostly")).cast("int"))
        parts.append(long.select(F.lit(name).alias("suite"), "expectation", "column_name", ok.alias("success"),
                                 "unexpected_count", "element_count"))
    for i, e in unique:
        keys = list(e.columns) if e.kind == "compound_unique" else [e.column]
        present = df.select(*keys).where(F.greatest(*[F.col(k).isNotNull().cast("int") for k in keys]) == 1) \
            if len(keys) > 1 else df.select(*keys).where(F.col(keys[0]).isNotNull())
        counts = present.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
        res = counts.agg(F.coalesce(F.sum(F.when(F.col("_n") > 1, F.col("_n"))), F.lit(0)).cast("bigint").alias("unexpected_count"),
                         F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint").alias("element_count"))
        parts.append(res.select(F.lit(name).alias("suite"), F.lit(e.kind).alias("expectation"),
                                F.lit(e.column).alias("column_name"),
                                (F.col("unexpected_count") == 0).cast("int").alias("success"),
                                "unexpected_count", "element_count"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def short_rows_monitor(df: DataFrame, column: str = "duration", threshold: float = 300) -> DataFrame:
    """Rows below a threshold (#59)."""
    return df.agg(F.count_if(F.col(column) < threshold).cast("bigint").alias("short_rows"),
                  F.count(F.lit(1)).cast("bigint").alias("rows"))
