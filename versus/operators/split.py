"""Group-safe and stratified splits, capped and exact samples (#119-#123).

Random permutations are replaced by an md5 hash of (key, seed): seed-stable,
computable row by row on any executor, identical in the SQL oracle. Group
splits threshold the hash of the group key, so every row of a group lands in
the same split without any shuffle. Exact per-class quotas rank rows by hash
with ``ordered_rank`` (no single-partition window).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..constants import SEED, TEST_SIZE, VAL_SIZE
from ..session import cut_lineage
from .ordered import ordered_rank
from .relational import with_small

HASH_CELLS = 4096  # equal parts of [0, 1) in which the rows of a class are counted before any of them is ranked


def hash_unit(*cols: str | Column, seed: int = SEED) -> Column:
    """Uniform-looking value in [0, 1) from md5 of the key parts and the seed."""
    parts = [F.col(c).cast("string") if isinstance(c, str) else c.cast("string") for c in cols]
    digest = F.md5(F.concat_ws(":", *parts, F.lit(str(seed))))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") / 4294967296.0


def split_grouped(df: DataFrame, group_col: str = "matchid", test_size: float = TEST_SIZE,
                  val_size: float = VAL_SIZE, seed: int = SEED, name: str = "split") -> DataFrame:
    """test = hash < test_size; val = next val_size (= val/(1-test) of the rest); train otherwise.
    Rows with a NULL group get no split (NULL) (#119)."""
    u = hash_unit(group_col, seed=seed)
    s = (F.when(F.col(group_col).isNull(), F.lit(None).cast("string"))
         .when(u < test_size, "test").when(u < test_size + val_size, "val").otherwise("train"))
    return df.withColumn(name, s)


def split_stratified(df: DataFrame, target: str, id_cols: Sequence[str], test_size: float = TEST_SIZE,
                     val_size: float = VAL_SIZE, seed: int = SEED, name: str = "split") -> DataFrame:
    """Per class: the first round(n*test) rows by hash are test, the next
    round((n - n_test) * val/(1-test)) val, the rest train; a NULL class is split
    like any other (#120)."""
    h = df.withColumn("_h", hash_unit(*id_cols, seed=seed))
    ranked = ordered_rank(h, ["_h", *id_cols], [target], name="_r", with_count="_n")
    n_test = F.floor(F.col("_n") * test_size + 0.5)
    n_val = F.floor((F.col("_n") - n_test) * (val_size / (1 - test_size)) + 0.5)
    s = F.when(F.col("_r") < n_test, "test").when(F.col("_r") < n_test + n_val, "val").otherwise("train")
    return ranked.withColumn(name, s).drop("_h", "_r", "_n")


def class_quotas(counts: DataFrame, target: str, cap: int, count: str = "count") -> DataFrame:
    """(target, quota) for a sample of exactly min(``cap``, rows) rows from one row per class.

    Every class starts with the floor of its share, one row at least. What that leaves of the cap
    goes in whole rounds of one row to every class with room, least room first to run out; what
    it takes beyond the cap comes off the largest quotas, down to a common level of at least
    one row. With more classes than the cap the classes with the most rows keep one row each. A
    single class, or a NULL class, is a class like any other. The table has a row a class; it is
    ordered in one task.
    """
    whole, n = Window.partitionBy(), F.col(count)
    base = counts.select(target, n.alias("_n"), F.greatest(F.lit(1), F.floor(n * cap / F.sum(n).over(whole))).alias("_base"))
    base = base.select("*", (F.lit(cap) - F.sum("_base").over(whole)).alias("_free"), F.count(F.lit(1)).over(whole).alias("_k"))

    # taking back: the level L with sum(min(quota, L)) = cap, the rest one row each above it
    rising = Window.orderBy("_base", F.col(target).asc_nulls_last())
    up_to = rising.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    place = F.row_number().over(rising)
    kept = base.select("*", F.sum("_base").over(up_to).alias("_sum"), place.alias("_i"))
    # quotas of place 1..i stay whole while cutting all later ones to this one's level still exceeds no cap
    kept = kept.withColumn("_stays", F.col("_sum") + (F.col("_k") - F.col("_i")) * F.col("_base") <= cap)
    kept = kept.select("*", F.sum(F.when(F.col("_stays"), F.col("_base"))).over(whole).alias("_whole"), F.count_if("_stays").over(whole).alias("_m"))
    spread = F.col("_k") - F.col("_m")
    rest = F.lit(cap) - F.coalesce("_whole", F.lit(0))
    level = F.floor(rest / spread)
    by_size = F.row_number().over(Window.partitionBy("_stays").orderBy(F.col("_n").desc(), F.col(target).asc_nulls_last()))
    cut = F.when(F.col("_stays"), F.col("_base")).otherwise(level + (by_size <= rest - level * spread).cast("bigint"))

    # giving: the same by room
    room = F.col("_n") - F.col("_base")
    kept = kept.withColumn("_room", room).withColumn("_cut", cut)
    by_room = Window.orderBy("_room", F.col(target).asc_nulls_last())
    given = kept.select("*", F.sum("_room").over(by_room.rowsBetween(Window.unboundedPreceding, Window.currentRow)).alias("_rsum"),
                        F.row_number().over(by_room).alias("_ri"))
    given = given.withColumn("_full", F.col("_rsum") + (F.col("_k") - F.col("_ri")) * F.col("_room") <= F.col("_free"))
    given = given.select("*", F.sum(F.when(F.col("_full"), F.col("_room"))).over(whole).alias("_filled"), F.count_if("_full").over(whole).alias("_rm"))
    rspread, rrest = F.col("_k") - F.col("_rm"), F.col("_free") - F.coalesce("_filled", F.lit(0))
    rounds = F.floor(rrest / rspread)
    extra = F.row_number().over(Window.partitionBy("_full").orderBy(F.col("_room").desc(), F.col(target).asc_nulls_last())) <= rrest - rounds * rspread
    more = F.when(F.col("_full"), F.col("_room")).otherwise(rounds + extra.cast("bigint"))
    return given.select(target, F.when(F.col("_free") < 0, F.col("_cut")).otherwise(F.least(F.col("_n"), F.col("_base") + more)).cast("bigint").alias("quota"))


def stratified_cap(df: DataFrame, target: str, id_cols: Sequence[str], cap: int | None,
                   seed: int = SEED) -> DataFrame:
    """Keep at most ``cap`` rows with class shares preserved (#121); no-op when
    ``cap`` is None / <= 0 or the frame is already small."""
    if cap is None or cap <= 0 or df.limit(cap + 1).count() <= cap:
        return df
    h = df.withColumn("_h", hash_unit(*id_cols, seed=seed))
    ranked = ordered_rank(_first_cells(h, target, cap), ["_h", *id_cols], [target], name="_r")
    return ranked.where(F.col("_r") < F.col("_quota")).select(*df.columns)


def _first_cells(h: DataFrame, target: str, cap: int) -> DataFrame:
    """The rows in the first cells of the hash of every class, up to the cell that fills the class's quota (``_quota``).

    A row of a later cell has the whole quota before it, and the rows that stay keep their
    ranks: what is ranked grows with the cap and with a cell, not with the rows.
    """
    cell = F.floor(F.col("_h") * HASH_CELLS).cast("int")
    cells = cut_lineage(h.groupBy(F.col(target).alias("_class"), cell.alias("_cell")).agg(F.count(F.lit(1)).alias("_n")))
    quotas = class_quotas(cells.groupBy("_class").agg(F.sum("_n").alias("count")), "_class", cap).toDF("_q_class", "_quota")
    before = Window.partitionBy("_class").orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    started = cells.select("_class", "_cell", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    wanted = started.join(quotas, F.col("_class").eqNullSafe(F.col("_q_class")) & (F.col("_before") < F.col("_quota")))
    last = wanted.groupBy("_class", "_quota").agg(F.max("_cell").alias("_last"))
    return with_small(h, last, F.col(target).eqNullSafe(F.col("_class")) & (cell <= F.col("_last"))).drop("_class", "_last")


def sample_rows(df: DataFrame, n: int, id_cols: Sequence[str], seed: int = SEED) -> DataFrame:
    """Exactly min(n, rows) rows without replacement, seed-stable (#122): the first
    ``n`` of the binned hash order, so no task ever holds the sample."""
    h = df.withColumn("_h", hash_unit(*id_cols, seed=seed))
    return ordered_rank(h, ["_h", *id_cols], name="_r").where(F.col("_r") < n).drop("_h", "_r")


def nested_fraction(df: DataFrame, fraction: float, id_cols: Sequence[str], minimum: int = 64,
                    seed: int = SEED) -> DataFrame:
    """Learning-curve sample: the max(minimum, int(n * fraction)) lowest-hash rows,
    so smaller fractions are subsets of larger ones (#123)."""
    n = df.count()
    return sample_rows(df, min(n, max(minimum, int(n * fraction))), id_cols, seed)
