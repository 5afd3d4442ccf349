"""Fitted encoders as artifact tables (#96-#100).

Fitting is one aggregate over the training rows (columns unpivoted into
(feature, category) so all encoders fit in one ``groupBy``). Applying
(``encode_all``) puts all fitted tables into one dictionary, unique by
construction, and meets it with ``lookup_many``.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..constants import ENCODER_CANDIDATES, TARGET, TE_SMOOTHING
from .ordered import ordered_rank
from .relational import Lookup, lookup_many
from ..session import cut_lineage


@dataclass
class Encoding:
    """A fitted lookup: long table (feature, category, value) with unique keys, plus defaults."""
    table: DataFrame
    prior: float
    columns: list


def _long(df: DataFrame, columns: Sequence[str], extra: Sequence[str] = ()) -> DataFrame:
    packed = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("category"))
                       for c in columns])
    return df.select(*extra, F.explode(packed).alias("_e")).select(*extra, "_e.*")


def fit_target_encoding(train: DataFrame, columns: Sequence[str] = ENCODER_CANDIDATES,
                        target: str = TARGET, smoothing: float = TE_SMOOTHING) -> Encoding:
    """Smoothed mean target per category: (mean*n + prior*m) / (n + m) (#96, #97).

    The prior is the training mean (0.5 for an empty frame). Columns absent or
    all-NULL are skipped; NULL categories are ignored.
    """
    present = [c for c in columns if c in train.columns]
    head = train.agg(F.avg(F.col(target).cast("double")).alias("_prior"),
                     *[F.count(c).alias(f"_n{i}") for i, c in enumerate(present)]).first()
    prior = 0.5 if head["_prior"] is None else float(head["_prior"])
    used = [c for i, c in enumerate(present) if head[f"_n{i}"] > 0]
    if not used:
        empty = train.sparkSession.createDataFrame([], "feature string, category string, value double")
        return Encoding(empty, prior, [])
    long = _long(train, used, [target]).where(F.col("category").isNotNull())
    table = long.groupBy("feature", "category").agg(
        F.avg(F.col(target).cast("double")).alias("_mean"), F.count(F.lit(1)).alias("_n"))
    value = (F.col("_mean") * F.col("_n") + F.lit(prior * smoothing)) / (F.col("_n") + F.lit(smoothing))
    # fitted state: materialized once, so every apply-join reads the small table
    fitted = cut_lineage(table.select("feature", "category", value.alias("value")))
    return Encoding(fitted, prior, used)


def apply_encoding(df: DataFrame, enc: Encoding, suffix: str = "_winrate_te",
                   fallback: str = "champion_signal_prior") -> DataFrame:
    """``<col><suffix>`` per encoded column, unseen/NULL -> prior; when nothing
    was encoded a constant ``fallback`` column holds the prior (#98)."""
    out = encode_all(df, te=enc, suffix=suffix)
    if not enc.columns:
        out = out.withColumn(fallback, F.lit(enc.prior))
    return out


def fit_pick_rate(train: DataFrame, columns: Sequence[str]) -> Encoding:
    """Share of each category over all listed slots; prior = mean share (#99)."""
    cols = [c for c in columns if c in train.columns]
    if not cols:
        return Encoding(train.sparkSession.createDataFrame([], "category string, value double"), 0.0, [])
    stacked = train.select(F.explode(F.array(*[F.col(c).cast("double") for c in cols])).alias("v")).where(
        F.col("v").isNotNull() & ~F.isnan("v"))
    counts = stacked.groupBy(F.col("v").cast("string").alias("category")).agg(F.count(F.lit(1)).alias("_n"))
    stats = counts.agg(F.count(F.lit(1)).alias("k"), F.sum("_n").alias("total")).first()
    if not stats["k"]:
        return Encoding(train.sparkSession.createDataFrame([], "category string, value double"), 0.0, cols)
    table = cut_lineage(counts.select("category", (F.col("_n") / F.lit(float(stats["total"]))).alias("value")))
    prior = 1.0 / stats["k"]
    return Encoding(table, prior, cols)


def apply_pick_rate(df: DataFrame, enc: Encoding, suffix: str = "_pick_rate") -> DataFrame:
    return encode_all(df, pick=enc, pick_suffix=suffix)


def fit_category_codes(train: DataFrame, column: str, unknown: str = "unknown") -> DataFrame:
    """Sorted distinct strings (NULL -> 'unknown') -> codes 0..n-1 (#100); the rank of
    the levels is a binned one, so their number is not limited."""
    levels = train.select(F.coalesce(F.col(column).cast("string"), F.lit(unknown)).alias("category")).distinct()
    return ordered_rank(levels, ["category"], name="value").select("category", F.col("value").cast("int").alias("value"))


def apply_category_codes(df: DataFrame, column: str, output: str, codes: DataFrame,
                         unknown: str = "unknown") -> DataFrame:
    """String column -> code, unseen -> -1; numeric columns pass through, NULL -> -1 (#100)."""
    return encode_all(df, codes={column: (output, codes)}, unknown=unknown)


def is_number(df: DataFrame, column: str) -> bool:
    return isinstance(df.schema[column].dataType, T.NumericType)


def fit_codes(train: DataFrame, outputs: dict[str, str]) -> dict[str, tuple[str, DataFrame | None]]:
    """Codes of every present column of ``outputs`` (column -> output); numeric ones need none (#100)."""
    return {c: (o, None if is_number(train, c) else fit_category_codes(train, c))
            for c, o in outputs.items() if c in train.columns}


def encode_all(df: DataFrame, te: Encoding | None = None, pick: Encoding | None = None,
               codes: dict[str, tuple[str, DataFrame | None]] | None = None, suffix: str = "_winrate_te",
               pick_suffix: str = "_pick_rate", unknown: str = "unknown") -> DataFrame:
    """All fitted encoders at once (#98-#100): one dictionary of (encoder and column, category) -> value.

    Unseen or NULL categories take the encoder's prior, unseen code levels -1; numeric code
    columns pass through (NULL: -1).
    """
    tables, asked, numbers = [], [], []
    if te is not None and te.columns:
        tables.append(te.table.select(F.concat(F.lit("te "), "feature").alias("feature"), "category", "value"))
        asked += [Lookup(f"te {c}", F.col(c).cast("string"), c + suffix, te.prior) for c in te.columns]
    if pick is not None and pick.columns:
        tables.append(pick.table.select(F.lit("pick").alias("feature"), "category", "value"))
        asked += [Lookup("pick", F.col(c).cast("double").cast("string"), c + pick_suffix, pick.prior) for c in pick.columns]
    whole = []
    for c, (output, table) in (codes or {}).items():
        if c not in df.columns:
            continue
        if is_number(df, c):
            numbers.append(F.coalesce(F.col(c).cast("double"), F.lit(-1.0)).alias(output))
            continue
        tables.append(table.select(F.lit(f"code {c}").alias("feature"), "category", F.col("value").cast("double").alias("value")))
        asked.append(Lookup(f"code {c}", F.coalesce(F.col(c).cast("string"), F.lit(unknown)), output, -1.0))
        whole.append(output)
    out = df
    if asked:
        out = lookup_many(df, asked, reduce(DataFrame.unionByName, tables))
    for o in whole:
        out = out.withColumn(o, F.col(o).cast("int"))
    return out.select("*", *numbers) if numbers else out
