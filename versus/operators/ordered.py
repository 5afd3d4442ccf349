"""Running sums and ranks over a global order, without a single-partition window.

``ordered_prefix`` is the building block for rank-based metrics (AUC, average
precision, ROC / PR curves), exact quantiles, stratified splits and exact
samples. Plan:

1. rows are dealt into range partitions of (partition keys, whole order) and
   stored once with a reliable checkpoint, each with its partition number as
   its bin. Range sampling balances the bins whatever the keys: a hot key, a
   tied leading column or a NULL key is cut like any other;
2. per (keys, bin) totals - at most bins + distinct keys rows - become
   exclusive offsets by a window over that small table;
3. running sum inside each (keys, bin) window plus the offset, matched
   null-safely.

The cost per row does not depend on the number of bins. Only rows equal in
every order column stay together; callers pre-aggregate those (metrics group
by score first).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage


def range_bins(df: DataFrame, keys: Sequence[str], order: Sequence[str], bins: int | None = None,
               name: str = "_bin") -> DataFrame:
    """``df`` stored in range partitions of ``keys`` then ``order``, numbered by ``name``.

    ``bins`` asks for that many partitions; by default the session's shuffle
    partitions, which adaptive execution merges where they are small.
    """
    by = [F.col(c) for c in (*keys, *order)]
    dealt = df.repartitionByRange(bins, *by) if bins else df.repartitionByRange(*by)
    return cut_lineage(dealt.withColumn(name, F.spark_partition_id()))


def ordered_prefix(df: DataFrame, order: Sequence[str], sums: Sequence[str],
                   partition: Sequence[str] = (), descending: bool = False,
                   bins: int | None = None, prefix: str = "cum_", totals: bool = True) -> DataFrame:
    """Inclusive running sums of ``sums`` in ``order`` within ``partition``.

    Order columns may be of any sortable type; with ``descending`` the whole
    order is reversed (NULLs first ascending, last descending). NULL partition
    keys are keys like any other. Adds ``cum_<c>`` and, with ``totals``,
    ``tot_<c>`` (the partition total) for every summed column.
    """
    partition = list(partition)
    work = range_bins(df, partition, order, bins)
    per_bin = work.groupBy(*partition, "_bin").agg(*[F.sum(c).alias(f"_b_{c}") for c in sums])
    whole = Window.partitionBy(*partition)
    step = F.col("_bin").desc() if descending else F.col("_bin").asc()
    before = whole.orderBy(step).rowsBetween(Window.unboundedPreceding, -1)
    small = [F.coalesce(F.sum(f"_b_{c}").over(before), F.lit(0)).alias(f"_o_{c}") for c in sums]
    if totals:
        small += [F.sum(f"_b_{c}").over(whole).alias(f"tot_{c}") for c in sums]
    offsets = per_bin.select(*[F.col(c).alias(f"_k_{c}") for c in partition], F.col("_bin").alias("_k__bin"), *small)
    sort = [F.col(c).desc() if descending else F.col(c).asc() for c in order]
    inside = Window.partitionBy(*partition, "_bin").orderBy(*sort).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    running = work.select("*", *[F.sum(c).over(inside).alias(f"_w_{c}") for c in sums])
    match = [F.col("_bin") == F.col("_k__bin"), *[F.col(c).eqNullSafe(F.col(f"_k_{c}")) for c in partition]]
    out = running.join(offsets, match)
    names = [*df.columns, *([f"tot_{c}" for c in sums] if totals else [])]
    return out.select(*names, *[(F.col(f"_o_{c}") + F.col(f"_w_{c}")).alias(f"{prefix}{c}") for c in sums])


def ordered_rank(df: DataFrame, order: Sequence[str], partition: Sequence[str] = (),
                 name: str = "rank0", bins: int | None = None, with_count: str | None = None) -> DataFrame:
    """0-based position in ``order`` within ``partition`` (ties broken by later
    order columns); optional partition row count as ``with_count``."""
    out = ordered_prefix(df.withColumn("_one", F.lit(1)), order, ["_one"], partition, bins=bins)
    out = out.withColumn(name, F.col("cum__one") - 1)
    if with_count:
        out = out.withColumn(with_count, F.col("tot__one"))
    return out.drop("_one", "cum__one", "tot__one")


def exact_quantiles(df: DataFrame, columns: Sequence[str], probs: Sequence[float],
                    bins: int | None = None, name_col: str = "feature", approx: bool = False,
                    accuracy: int = 10000, materialize: bool = True) -> DataFrame:
    """Linearly interpolated quantiles of each column -> (feature, p, value).

    Exact by default, without exploding the rows: a sketch of all columns (one
    aggregate) brackets every wanted rank in a narrow band of values, a second
    aggregate counts the values below each band, and only the values inside
    bands (about 6 / ``accuracy`` of the rows for each p) become rows and are
    ranked. NULL and NaN are ignored. ``approx=True`` returns the sketch itself
    (relative rank error 1 / ``accuracy``, no interpolation). ``materialize``
    stores the columns first, as they are read three times.
    """
    spark, cols, ps = df.sparkSession, list(columns), [float(p) for p in probs]
    v = [F.col(c).cast("double") for c in cols]
    clean = df.select(*[F.when(~F.isnan(x), x).alias(f"c{i}") for i, x in enumerate(v)])
    if materialize and not approx:
        clean = cut_lineage(clean)
    names = [f"c{i}" for i in range(len(cols))]
    sizes = clean.agg(*[F.count(c).alias(c) for c in names]).first() if names else {}
    # the sketch is off by up to 1 / accuracy of the rows, and its ranks by up to two from (n - 1) p
    slack = {i: 3.0 / accuracy + 2.0 / sizes[c] for i, c in enumerate(names) if sizes[c]}
    if not slack:
        return spark.createDataFrame([], f"{name_col} string, p double, value double")
    ends = {i: ps if approx else [min(max(q, 0.0), 1.0) for p in ps for q in (p - s, p + s)] for i, s in slack.items()}
    head = clean.agg(*[F.percentile_approx(f"c{i}", e, accuracy).alias(f"qc{i}") for i, e in ends.items()]).first()  # a few numbers per column
    found = [(i, j) for i in slack for j in range(len(ps))]
    if approx:
        rows = [(cols[i], ps[j], head[f"qc{i}"][j]) for i, j in found]
        return spark.createDataFrame(rows, f"{name_col} string, p double, value double")
    # the outermost ranks have no value beyond them: their bands are open
    band = {}
    for i, j in found:
        low, high = head[f"qc{i}"][2 * j: 2 * j + 2]
        band[i, j] = (float("-inf") if ps[j] <= slack[i] else low, float("inf") if ps[j] >= 1 - slack[i] else high)
    below = clean.agg(F.lit(0).alias("z"), *[F.count_if(F.col(f"c{i}") < lo).alias(f"b{i}_{j}") for (i, j), (lo, _) in band.items()]).first()
    cells = F.array(*[F.when((F.col(f"c{i}") >= lo) & (F.col(f"c{i}") <= hi),
                             F.struct(F.lit(i).alias("i"), F.lit(j).alias("j"), F.col(f"c{i}").alias("v"))) for (i, j), (lo, hi) in band.items()])
    inside = clean.select(F.explode(F.array_compact(cells)).alias("s")).groupBy("s.i", "s.j", "s.v").agg(F.count(F.lit(1)).alias("n"))
    ranked = ordered_prefix(inside, ["v"], ["n"], ["i", "j"], bins=bins)
    aims = []
    for i, j in band:
        h = (sizes[f"c{i}"] - 1) * ps[j]
        aims.append((i, j, cols[i], ps[j], h - int(h), int(h) - below[f"b{i}_{j}"], -int(-h // 1) - below[f"b{i}_{j}"]))
    aim = F.broadcast(spark.createDataFrame(aims, f"ai int, aj int, {name_col} string, p double, part double, lo long, hi long"))  # columns x probs rows
    hit = ranked.join(aim, (F.col("i") == F.col("ai")) & (F.col("j") == F.col("aj")))

    def at(rank):
        return F.max(F.when((F.col(rank) < F.col("cum_n")) & (F.col(rank) >= F.col("cum_n") - F.col("n")), F.col("v")))

    picked = hit.groupBy(name_col, "p").agg(at("lo").alias("lo_v"), at("hi").alias("hi_v"), F.max("part").alias("part"))
    return picked.select(name_col, "p", (F.col("lo_v") + F.col("part") * (F.col("hi_v") - F.col("lo_v"))).alias("value"))


def quantile_table(long: DataFrame, key: str, value: str, probs: Sequence[float],
                   bins: int | None = None) -> DataFrame:
    """Exact quantiles of ``value`` per ``key`` in a long frame, distributed.

    Values are counted per distinct (key, value) first, then ranked by
    ``ordered_prefix`` per key; the interpolation endpoints are the values
    holding 0-based ranks floor(h) and ceil(h), h = (n - 1) p. NULL / NaN
    values are ignored. Returns (key, p, value).
    """
    v = F.col(value).cast("double")
    clean = long.select(F.col(key), v.alias("v")).where(F.col("v").isNotNull() & ~F.isnan("v"))
    counted = clean.groupBy(key, "v").agg(F.count(F.lit(1)).alias("n"))
    pref = ordered_prefix(counted, ["v"], ["n"], [key], bins=bins)
    # a row holds ranks [cum - n, cum - 1]
    ps = F.array(*[F.lit(float(p)) for p in probs])
    with_p = pref.select(key, "v", "n", "cum_n", "tot_n", F.explode(ps).alias("p"))
    h = (F.col("tot_n") - 1) * F.col("p")
    lo, hi = F.floor(h), F.ceil(h)
    start = F.col("cum_n") - F.col("n")
    end = F.col("cum_n") - 1
    picks = with_p.select(
        key, "p", h.alias("h"),
        F.when((lo >= start) & (lo <= end), F.col("v")).alias("lo_v"),
        F.when((hi >= start) & (hi <= end), F.col("v")).alias("hi_v")
    ).where(F.col("lo_v").isNotNull() | F.col("hi_v").isNotNull())
    agg = picks.groupBy(key, "p").agg(F.max("lo_v").alias("lo_v"), F.max("hi_v").alias("hi_v"),
                                     F.max("h").alias("h"))
    out = F.col("lo_v") + (F.col("h") - F.floor("h")) * (F.col("hi_v") - F.col("lo_v"))
    return agg.select(key, "p", out.alias("value"))


GROUP_CELLS = 4096  # parts of the groups, by hash, that are counted before any group is


def has_hot_group(df: DataFrame, keys: Sequence[str], threshold: int) -> bool:
    """Whether any group has more than ``threshold`` rows.

    Groups are counted together in cells of their hash first, which moves a few numbers a task;
    only groups of cells beyond the threshold are counted by themselves.
    """
    many = F.count(F.lit(1)).alias("_n")
    cell = F.pmod(F.xxhash64(*keys), F.lit(GROUP_CELLS)).cast("int")
    full = [r["_c"] for r in df.groupBy(cell.alias("_c")).agg(many).where(F.col("_n") > threshold).collect()]  # GROUP_CELLS at most
    return bool(full) and not df.where(cell.isin(full)).groupBy(*keys).agg(many).where(F.col("_n") > threshold).isEmpty()


def group_rank(df: DataFrame, group: str | Sequence[str], order: Sequence[str], name: str = "rank1",
               hot_threshold: int = 5_000_000, bins: int | None = None) -> DataFrame:
    """1-based ``row_number`` within ``group`` by ``order`` that survives hot groups.

    Groups up to ``hot_threshold`` rows are ranked by an ordinary window. Larger
    ones (at most rows / threshold of them, counted first) take the binned
    ranks of ``ordered_rank``; both give the same numbers for every column type,
    NULL groups included, so the threshold only chooses the plan.
    """
    keys = [group] if isinstance(group, str) else list(group)
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    hot = cut_lineage(sizes.where(F.col("_n") > hot_threshold).select(*[F.col(k).alias(f"_h_{k}") for k in keys]))
    w = Window.partitionBy(*keys).orderBy(*order)
    if hot.isEmpty():
        return df.withColumn(name, F.row_number().over(w).cast("bigint"))
    match = [F.col(k).eqNullSafe(F.col(f"_h_{k}")) for k in keys]
    cold = df.join(hot, match, "left_anti").withColumn(name, F.row_number().over(w).cast("bigint"))
    ranked = ordered_rank(df.join(hot, match, "left_semi"), list(order), keys, name="_r0", bins=bins)
    return cold.unionByName(ranked.withColumn(name, (F.col("_r0") + 1).cast("bigint")).drop("_r0"))
