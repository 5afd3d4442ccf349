"""Query catalog: each entry is a Spark callable ``(spark, sf_dir) -> DataFrame``
plus, where the operator is SQL-expressible, the equivalent DuckDB SQL text.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession

from ..session import join_as_they_lie
from ..sources.fixture import DEFAULT_SLOTS, DomainTables, data_stamp, fixture_sql

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def query(key: str, sql: str | None = None):
    """Register ``fn`` under ``key``; ``sql`` is its oracle (omitted for rows-only checks)."""
    def deco(fn: QueryFn) -> QueryFn:
        if key in QUERIES:
            raise ValueError(f"duplicate query key {key}")
        QUERIES[key] = fn
        if sql is not None:
            ORACLE[key] = sql
        return fn
    return deco


def tables(spark: SparkSession, sf_dir: str, wide: bool = False, picks: bool = True) -> Mapping[str, DataFrame]:
    """The domain tables as lazy projections of the driver tables: a query plans and reads
    only those it names, straight from the given Parquet; ``wide`` if it combines several,
    without ``picks`` if it needs the members' statistics only."""
    join_as_they_lie(spark)
    return DomainTables(spark, sf_dir, DEFAULT_SLOTS, wide, picks)


def fitted_once(spark: SparkSession, sf_dir: str, kept: dict, make, *more):
    """``make()``, kept in ``kept`` for this application and these very files."""
    key = (spark.sparkContext.applicationId, sf_dir, data_stamp(spark, sf_dir), *more)
    if key not in kept:
        kept[key] = make()
    return kept[key]


def with_fixture(body: str) -> str:
    """Oracle SQL over the fixture mapping: ``body`` is ``extra CTEs`` + final SELECT,
    starting with either ``, name AS (...)`` or a bare ``SELECT``."""
    body = body.strip()
    prefix = fixture_sql(DEFAULT_SLOTS)
    if body.startswith(","):
        return prefix + body
    return prefix + "\n" + body
