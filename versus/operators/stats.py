"""Descriptive statistics and plot data as aggregates (#50-#58, #75-#77).

Quantiles are exact and distributed (``ordered.exact_quantiles``); the
approximate sketch (``percentile_approx``) is available through ``approx=True``
on the quantile-based operators where an exact answer is not needed.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage
from .ordered import exact_quantiles, quantile_table
from .relational import with_small


def describe_percentiles(df: DataFrame, columns: Sequence[str],
                         probs: Sequence[float] = (0.05, 0.25, 0.5, 0.75, 0.95), approx: bool = False) -> DataFrame:
    """count / mean / sample std / min / max and the given percentiles per column (#51)."""
    moments = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("v")) for c in columns])).alias("_s")
    ).select("_s.*").groupBy("feature").agg(
        F.count("v").cast("bigint").alias("count"), F.avg("v").alias("mean"), F.stddev_samp("v").alias("std"),
        F.min("v").alias("min"), F.max("v").alias("max"))
    q = exact_quantiles(df, columns, probs, approx=approx)
    wide = q.groupBy("feature").agg(*[F.max(F.when(F.col("p") == p, F.col("value"))).alias(f"p{int(round(p * 100)):02d}")
                                      for p in probs])
    return moments.join(wide, "feature", "left")


def value_counts(df: DataFrame, column: str, name: str = "value") -> DataFrame:
    """Count and share per distinct value (#52); the total is one count job and
    enters the plan as a literal (no join, no global window)."""
    total = df.count()
    counts = df.groupBy(F.col(column).alias(name)).agg(F.count(F.lit(1)).cast("bigint").alias("count"))
    return counts.select(name, "count", (F.col("count") / F.lit(float(max(total, 1)))).alias("share"))


def category_outcome_rate(members: DataFrame, category: str, target: str, names: DataFrame | None = None,
                          min_games: int = 1, name_key: str = "id", name_col: str = "name") -> DataFrame:
    """games, wins and win rate per category, HAVING games >= min_games, with a
    display name (``ID:<id>`` when unknown) (#53)."""
    agg = members.groupBy(F.col(category).alias("category")).agg(
        F.count(F.lit(1)).cast("bigint").alias("games"),
        F.sum(F.col(target).cast("bigint")).cast("bigint").alias("wins"))
    agg = agg.where(F.col("games") >= min_games).withColumn("rate", F.col("wins") / F.col("games"))
    if names is None:
        return agg.withColumn("name", F.concat(F.lit("ID:"), F.col("category").cast("string")))
    n = names.select(F.col(name_key).alias("_nk"), F.col(name_col).alias("_nm")).dropDuplicates(["_nk"])
    out = agg.join(n, agg.category == n._nk, "left")
    return out.select("category", "games", "wins", "rate",
                      F.coalesce("_nm", F.concat(F.lit("ID:"), F.col("category").cast("string"))).alias("name"))


def top_bottom_k(df: DataFrame, by: str, k: int = 20, tie: str = "category") -> DataFrame:
    """The k highest and k lowest rows by ``by`` (ties broken by ``tie``) (#75).

    Each side is a TakeOrdered (per-partition top-k, then one merge of k rows) over the
    stored rows, so that what makes them runs once.
    """
    df = cut_lineage(df)
    top = df.orderBy(F.col(by).desc(), F.col(tie).asc()).limit(k).withColumn("side", F.lit("top"))
    bottom = df.orderBy(F.col(by).asc(), F.col(tie).asc()).limit(k).withColumn("side", F.lit("bottom"))
    return top.unionByName(bottom)


def rate_by_level(df: DataFrame, level: str, target: str) -> DataFrame:
    """Mean outcome and rows per level of a low-cardinality column (#54)."""
    return df.groupBy(level).agg(F.avg(F.col(target).cast("double")).alias("rate"),
                                 F.count(F.lit(1)).cast("bigint").alias("rows"))


def trimmed_histogram(df: DataFrame, column: str, bins: int = 15, lower: float = 0.01,
                      upper: float = 0.99, approx: bool = False) -> DataFrame:
    """Equal-width histogram inside the [lower, upper] quantile range (#56).

    The two bounds are exact quantiles (one small table); the binning is one
    aggregate. The top edge belongs to the last bin.
    """
    q = {r["p"]: r["value"] for r in exact_quantiles(df, [column], [lower, upper], approx=approx).collect()}
    lo, hi = q.get(lower), q.get(upper)  # two numbers
    x = F.col(column).cast("double")
    if lo is None or hi is None:
        return df.sparkSession.createDataFrame([], "bin int, count bigint, lo double, hi double")
    inside = df.select(x.alias("x")).where((F.col("x") >= lo) & (F.col("x") <= hi))
    width = hi - lo
    idx = F.lit(0) if width == 0 else F.least(F.floor((F.col("x") - F.lit(lo)) * F.lit(float(bins) / width)),
                                              F.lit(bins - 1))
    return inside.groupBy(idx.cast("int").alias("bin")).agg(
        F.count(F.lit(1)).cast("bigint").alias("count"), F.lit(lo).alias("lo"), F.lit(hi).alias("hi"))


def box_stats(df: DataFrame, column: str, group: str) -> DataFrame:
    """Quartiles and 1.5 IQR whiskers per group (#57)."""
    long = df.select(F.col(group).cast("string").alias("feature"), F.col(column).cast("double").alias("v"))
    q = quantile_table(long, "feature", "v", [0.25, 0.5, 0.75])
    wide = q.groupBy("feature").agg(F.max(F.when(F.col("p") == 0.25, F.col("value"))).alias("q1"),
                                    F.max(F.when(F.col("p") == 0.5, F.col("value"))).alias("median"),
                                    F.max(F.when(F.col("p") == 0.75, F.col("value"))).alias("q3"))
    wide = wide.withColumn("iqr", F.col("q3") - F.col("q1"))
    j = with_small(long, wide, "feature")
    lo_fence = F.col("q1") - 1.5 * F.col("iqr")
    hi_fence = F.col("q3") + 1.5 * F.col("iqr")
    whisk = j.groupBy("feature").agg(
        F.min(F.when(F.col("v") >= lo_fence, F.col("v"))).alias("whisker_low"),
        F.max(F.when(F.col("v") <= hi_fence, F.col("v"))).alias("whisker_high"),
        F.count_if((F.col("v") < lo_fence) | (F.col("v") > hi_fence)).cast("bigint").alias("outliers"))
    return wide.join(whisk, "feature").withColumnRenamed("feature", group)


def kde_grid(df: DataFrame, column: str, group: str, gridsize: int = 200, cut: float = 3.0, cells_per_bandwidth: int = 200,
             reach: float = 8.5) -> DataFrame:
    """Gaussian KDE per group on an even grid, Scott bandwidth n^(-1/5) * std (#58).

    Linear binning: a value gives its weight to the two ends of its cell, in proportion, and
    only cells meet the grid, each the points within ``reach`` bandwidths (beyond, a kernel is
    below 1e-15 of its peak). With cells of a 200th of the bandwidth the density is off by at
    most 1 / (8 * 200^2), 3e-6, of a kernel's peak. The cells number range / bandwidth * 200,
    which grows with n^(1/5); rows and distinct values do not matter beyond the one aggregate.
    A group without spread has NULL densities.
    """
    base = df.select(F.col(group).alias("g"), F.col(column).cast("double").alias("x")).where(F.col("x").isNotNull())
    stats = base.groupBy("g").agg(F.count(F.lit(1)).alias("n"), F.stddev_samp("x").alias("sd"),
                                  F.min("x").alias("mn"), F.max("x").alias("mx"))
    stats = stats.withColumn("bw", F.col("sd") * F.pow(F.col("n").cast("double"), F.lit(-0.2)))
    stats = stats.withColumn("lo", F.col("mn") - cut * F.col("bw")).withColumn("hi", F.col("mx") + cut * F.col("bw"))
    stats = cut_lineage(stats.withColumn("step", (F.col("hi") - F.col("lo")) / (gridsize - 1)).select("g", "n", "bw", "lo", "mn", "step"))  # a row a group
    width = F.col("bw") / cells_per_bandwidth
    placed = with_small(base.where(F.col("g").isNotNull()), stats.where(F.col("bw") > 0).drop("n"), "g")
    placed = placed.withColumn("_p", (F.col("x") - F.col("mn")) / width).withColumn("_c", F.floor("_p").cast("bigint"))
    share = F.col("_p") - F.col("_c")
    # the weights of a cell's two ends by cell first, so that rows are not doubled
    cells = placed.groupBy("g", "_c").agg(F.count(F.lit(1)).cast("double").alias("_n"), F.sum(share).alias("_s"))
    ends = F.array(F.struct(F.col("_c").alias("c"), (F.col("_n") - F.col("_s")).alias("w")), F.struct((F.col("_c") + 1).alias("c"), F.col("_s").alias("w")))
    cells = cells.select("g", F.explode(ends).alias("e")).groupBy("g", "e.c").agg(F.sum("e.w").alias("w"))
    near = with_small(cells, stats, "g").withColumn("x", F.col("mn") + F.col("c") * width)
    first = F.greatest(F.lit(0), F.ceil((F.col("x") - reach * F.col("bw") - F.col("lo")) / F.col("step")))
    last = F.least(F.lit(gridsize - 1), F.floor((F.col("x") + reach * F.col("bw") - F.col("lo")) / F.col("step")))
    near = near.where(first <= last).select("g", "x", "w", "bw", "lo", "step", F.explode(F.sequence(first.cast("int"), last.cast("int"))).alias("i"))
    z = (F.col("lo") + F.col("i") * F.col("step") - F.col("x")) / F.col("bw")
    sums = near.groupBy(F.col("g").alias("_g"), F.col("i").alias("_i")).agg(F.sum(F.col("w") * F.exp(-0.5 * z * z) / (F.col("bw") * math.sqrt(2 * math.pi))).alias("_d"))
    points = stats.select("*", F.explode(F.sequence(F.lit(0), F.lit(gridsize - 1))).alias("i"))
    out = points.join(sums, F.col("g").eqNullSafe(F.col("_g")) & (F.col("i") == F.col("_i")), "left")
    density = F.when(F.col("bw") > 0, F.coalesce("_d", F.lit(0.0)) / F.col("n"))
    return out.select(F.col("g").alias(group), "i", (F.col("lo") + F.col("i") * F.col("step")).alias("grid"), density.alias("density"))


def schema_profile(df: DataFrame, samples: int = 3) -> DataFrame:
    """Per column: type, non-NULL count, NULL %, distinct count and the
    ``samples`` smallest distinct values as text (#50).

    Counts are one aggregate; the samples come from the distinct (column,
    value) pairs ranked with ``row_number() <= samples`` per column, which
    Spark pre-limits per map partition, so no task gathers a column's values.
    """
    n = F.count(F.lit(1))
    exprs = [n.alias("_rows")]
    for i, f in enumerate(df.schema.fields):
        c = F.col(f.name)
        exprs += [F.count(c).alias(f"nn{i}"), F.count_distinct(c).alias(f"d{i}")]
    one = df.agg(*exprs)
    stack = F.array(*[F.struct(F.lit(f.name).alias("column_name"), F.lit(f.dataType.simpleString()).alias("dtype"),
                               F.col(f"nn{i}").cast("bigint").alias("non_null"),
                               F.col(f"d{i}").cast("bigint").alias("distinct"))
                      for i, f in enumerate(df.schema.fields)])
    counts = one.select("_rows", F.explode(stack).alias("r")).select(
        "r.column_name", "r.dtype", "r.non_null",
        F.round((1 - F.col("r.non_null") / F.col("_rows")) * 100, 2).alias("null_pct"), "r.distinct")
    long = df.select(F.explode(F.array(*[F.struct(F.lit(f.name).alias("column_name"),
                                                  F.col(f.name).cast("string").alias("v"))
                                         for f in df.schema.fields])).alias("s")).select("s.*") \
        .where(F.col("v").isNotNull()).distinct()
    w = Window.partitionBy("column_name").orderBy("v")
    first = long.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= samples)
    picked = first.groupBy("column_name").agg(
        F.concat_ws(", ", F.transform(F.array_sort(F.collect_list(F.struct("_r", "v"))), lambda x: x["v"]))
        .alias("samples"))  # at most ``samples`` rows per column reach this aggregate
    return counts.join(picked, "column_name", "left")


def corr_with_target(df: DataFrame, columns: Sequence[str], target: str, top: int = 20) -> DataFrame:
    """|Pearson r| of each column with the target, largest first, top n (#77).
    Constant columns give NULL (no divide-by-zero error)."""
    t = F.col(target).cast("double")
    one = df.agg(*[F.try_divide(F.covar_samp(F.col(c).cast("double"), t),
                                F.stddev_samp(F.col(c).cast("double")) * F.stddev_samp(t)).alias(f"r{i}")
                   for i, c in enumerate(columns)])
    stack = F.array(*[F.struct(F.lit(c).alias("feature"), F.abs(F.col(f"r{i}")).alias("abs_corr"))
                      for i, c in enumerate(columns)])
    long = one.select(F.explode(stack).alias("s")).select("s.*")
    return long.orderBy(F.col("abs_corr").desc_nulls_last(), F.col("feature")).limit(top)
