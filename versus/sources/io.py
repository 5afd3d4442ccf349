"""Sources and sinks (#1-#5).

CSV with a ``\\N`` NULL token and an explicit schema (no inference pass), part
files aligned to the first part's columns, gzip CSV and Parquet sinks, and
processed splits stored partitioned by (scope, split) so a read of one split
prunes the others at the file listing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.errors import AnalysisException

NULL_TOKEN = "\\N"


def read_existing(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame | None:
    """The table at ``path``, or None if nothing is there; any other error is raised."""
    try:
        return spark.read.format(fmt).load(path)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def read_csv_nulltoken(spark: SparkSession, path: str, schema, nrows: int | None = None,
                       null_token: str = NULL_TOKEN, mode: str = "FAILFAST") -> DataFrame:
    """Header CSV, ``\\N`` -> NULL, explicit schema, optional row limit (#1).
    A missing path raises (Spark fails the read at analysis time), and so does a
    malformed record unless ``mode`` says otherwise."""
    df = (spark.read.schema(schema).option("header", True).option("nullValue", null_token)
          .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
          .option("mode", mode).csv(path))
    return df.limit(nrows) if nrows is not None else df


def write_csv(df: DataFrame, path: str, compression: str | None = "gzip", null_token: str = NULL_TOKEN) -> str:
    """Header CSV sink, gzip by default, NULL written as the token (#4)."""
    w = (df.write.mode("overwrite").option("header", True).option("nullValue", null_token)
         .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False))
    if compression:
        w = w.option("compression", compression)
    w.csv(path)
    return path


def union_align(first: DataFrame, *others: DataFrame) -> DataFrame:
    """Append later parts projected onto the first part's columns: extra
    columns dropped, missing ones NULL (#2)."""
    cols = first.columns
    out = first
    for o in others:
        have = set(o.columns)
        out = out.unionByName(o.select(*[F.col(c) if c in have else F.lit(None).cast(first.schema[c].dataType).alias(c)
                                         for c in cols]))
    return out


def load_tables(spark: SparkSession, paths: dict, fmt: str = "parquet", optional: Sequence[str] = ()) -> dict:
    """Read every named table; optional ones are skipped when absent (#3)."""
    out = {}
    for name, path in paths.items():
        found = read_existing(spark, path, fmt) if name in optional else spark.read.format(fmt).load(path)
        if found is not None:
            out[name] = found
    return out


def write_splits(df: DataFrame, path: str, scope: str, split_col: str = "split") -> str:
    """Processed splits as one Parquet table partitioned by (scope, split) (#5)."""
    df.withColumn("scope", F.lit(scope)).write.mode("overwrite").partitionBy("scope", split_col).parquet(path)
    return path


def read_splits(spark: SparkSession, path: str, scope: str, splits: Sequence[str] = ("train", "val", "test"),
                split_col: str = "split") -> dict:
    """One DataFrame per split; the filters prune partitions at listing time (#5)."""
    base = spark.read.parquet(path)
    return {s: base.where((F.col("scope") == scope) & (F.col(split_col) == s)) for s in splits}
