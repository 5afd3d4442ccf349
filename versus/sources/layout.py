"""Stored tables that share one layout: bucketed and sorted by group.

Ranks, side aggregates, integrity checks, opponent differences and the joins between member,
side and group tables are all keyed by the group.  Tables stored in buckets of the group's
hash are read as they lie, so flows over them shuffle nothing; the shuffle is paid once, when
the data are stored.

A bucket is read by one task, so a group with more than ``hot_rows`` member rows must not be
in one.  Such groups (at most rows / hot_rows of them) are counted out first and stored in
plain tables beside; ``run`` applies a flow to both parts, as groups do not meet each other.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import cut_lineage, ensure_checkpoint_dir

BUCKETS = 64
HOT_ROWS = 5_000_000


@dataclass(frozen=True)
class StoredTables:
    """Names of the stored tables; ``hot`` is empty if no group is too large for a bucket."""

    spark: SparkSession
    cold: dict[str, str]
    hot: dict[str, str]
    buckets: int

    def tables(self, hot: bool = False) -> dict[str, DataFrame]:
        return {name: self.spark.table(stored) for name, stored in (self.hot if hot else self.cold).items()}

    def run(self, flow: Callable[[Mapping[str, DataFrame], bool], DataFrame]) -> DataFrame:
        """``flow(tables, one_pass)`` over the bucketed groups, and over the large ones if there are any;
        ``one_pass`` tells that a group fits one task."""
        out = flow(self.tables(), True)
        return out.unionByName(flow(self.tables(hot=True), False)) if self.hot else out

    def drop(self) -> None:
        """Remove the tables and their files."""
        for stored in (*self.cold.values(), *self.hot.values()):
            self.spark.sql(f"DROP TABLE IF EXISTS {stored} PURGE")


def bucket_count(rows: int, rows_per_bucket: int = 2_000_000, least: int = BUCKETS) -> int:
    """A power of two, so that tables of different sizes stay joinable bucket by bucket."""
    n = least
    while n * rows_per_bucket < rows:
        n *= 2
    return n


def store(tables: Mapping[str, DataFrame], keys: Mapping[str, str], members: str = "members", buckets: int | None = None,
          hot_rows: int = HOT_ROWS, root: str | None = None) -> StoredTables:
    """Store ``tables`` in buckets of their group column ``keys[name]``, sorted by it.

    ``members`` names the largest table, whose groups are counted: groups of more than
    ``hot_rows`` rows go to plain tables.  Rows without a group belong to no group and stay in
    the bucketed part.  ``root`` is a shared folder; by default one under the checkpoint folder.
    """
    spark = tables[members].sparkSession
    root = root or f"{ensure_checkpoint_dir(spark).rstrip('/')}/layout/{uuid.uuid4().hex}"
    tag = f"grouped_{uuid.uuid4().hex[:12]}"
    sizes = tables[members].groupBy(F.col(keys[members]).alias("_group")).agg(F.count(F.lit(1)).alias("_n"))
    large = (F.col("_n") > hot_rows) & F.col("_group").isNotNull()
    # one small answer; the sizes themselves are not stored
    total, any_hot = sizes.agg(F.coalesce(F.sum("_n"), F.lit(0)), F.coalesce(F.max(large), F.lit(False))).first()
    n = buckets or bucket_count(total)
    hot = cut_lineage(sizes.where(large).select("_group")) if any_hot else None
    cold_names, hot_names = {}, {}
    for name, df in tables.items():
        key = keys[name]
        rest = df.join(hot, df[key] == hot["_group"], "left_anti") if any_hot else df
        cold_names[name] = f"{tag}_{name}"
        # one task writes one bucket: one sorted file each
        (rest.repartition(n, key).write.bucketBy(n, key).sortBy(key)
         .option("path", f"{root}/{name}").saveAsTable(cold_names[name]))
        if any_hot:
            hot_names[name] = f"{tag}_{name}_hot"
            df.join(hot, df[key] == hot["_group"], "left_semi").write.option("path", f"{root}/{name}_hot").saveAsTable(hot_names[name])
    return StoredTables(spark, cold_names, hot_names, n)
