"""Queries: sources and sinks round trips on data derived from the driver tables."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..operators import split as SP
from ..operators.training import artifact_root
from ..sources import io as IO
from .catalog_merge import stage_cleaned
from .registry import query, tables, with_fixture
from .sqlparts import CLEANED, MERGED, PM, SIDES


def _scratch(spark, name):
    return f"{artifact_root(spark)}/io/{name}-{uuid.uuid4().hex[:12]}"


@query("read_csv_nulltoken", with_fixture("SELECT id, matchid, player, championid, position, role FROM participants"))
def q_read_csv_nulltoken(spark, sf):
    """Members written as CSV with the \\N NULL token, read back with an explicit schema (#1)."""
    p = tables(spark, sf)["participants"]
    path = _scratch(spark, "participants-csv")
    IO.write_csv(p, path, compression=None)
    return IO.read_csv_nulltoken(spark, path, p.schema)


@query("write_compressed", with_fixture("SELECT matchid, teamid, championid, banturn FROM teambans"))
def q_write_compressed(spark, sf):
    """gzip CSV sink, read back (#4)."""
    b = tables(spark, sf)["teambans"]
    path = _scratch(spark, "bans-csv-gz")
    IO.write_csv(b, path, compression="gzip")
    return IO.read_csv_nulltoken(spark, path, b.schema)


@query("union_align", with_fixture("""
SELECT id, win, kills, deaths, assists, goldearned, goldspent, firstbloodkill FROM stats WHERE win = 1
UNION ALL SELECT id, win, kills, deaths, CAST(NULL AS DOUBLE), goldearned, goldspent, firstbloodkill FROM stats WHERE win <> 1"""))
def q_union_align(spark, sf):
    """The statistics table as two parts (winning and other rows, together the
    whole table); the second lacks a column and has an extra one and is
    aligned to the first part's columns (#2)."""
    s = tables(spark, sf)["stats"]
    part1 = s.where(F.col("win") == 1)
    part2 = s.where(F.col("win") != 1).drop("assists").withColumn("extra", F.lit(1))
    return IO.union_align(part1, part2)


@query("load_tables", """
SELECT 'orders' AS table_name, CAST(COUNT(*) AS BIGINT) AS rows FROM orders
UNION ALL SELECT 'part', CAST(COUNT(*) AS BIGINT) FROM part
UNION ALL SELECT 'lineitem', CAST(COUNT(*) AS BIGINT) FROM lineitem""")
def q_load_tables(spark, sf):
    """Read named tables (an optional missing one is skipped); rows per table (#3)."""
    paths = {n: f"{sf}/{n}.parquet" for n in ("orders", "part", "lineitem")}
    paths["champs_dimension"] = f"{sf}/does_not_exist.parquet"
    t = IO.load_tables(spark, paths, optional=["champs_dimension"])
    out = None
    for name, df in t.items():
        c = df.agg(F.count(F.lit(1)).cast("bigint").alias("rows")).select(F.lit(name).alias("table_name"), "rows")
        out = c if out is None else out.unionByName(c)
    return out


_U = "(CAST(('0x' || SUBSTR(MD5(CAST(matchid AS VARCHAR) || ':42'), 1, 8)) AS BIGINT) / 4294967296.0)"


@query("read_splits", with_fixture(PM + SIDES + MERGED + CLEANED + f"""
SELECT matchid, teamid, win FROM cleaned WHERE {_U} < 0.2"""))
def q_read_splits(spark, sf):
    """Splits written partitioned by (scope, split); the test split is read
    with partition pruning (#5)."""
    df = SP.split_grouped(stage_cleaned(spark, sf)).select("matchid", "teamid", "win", "split")
    path = _scratch(spark, "splits")
    IO.write_splits(df, path, "postgame")
    return IO.read_splits(spark, path, "postgame")["test"].select("matchid", "teamid", "win")
