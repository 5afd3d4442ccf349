"""Map the driver's star-schema tables onto the member/side/group domain.

A group (match) is an order, a member row (participant) is a line item, a
category (champion) is the part brand and a ban is a returned line.
``DomainTables`` plans the six domain tables lazily with the DataFrame API;
``fixture_sql`` is the same mapping as a SQL ``WITH`` prefix for the DuckDB
oracle. Both must stay in step.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir, table_path

DEFAULT_SLOTS = 2  # members per side in the fixture (the modelled data has 5)

_MEMBER_ORDER = ("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
                 "l_discount", "l_tax", "l_shipdate", "l_returnflag", "l_linestatus")

# fixed values: part type -> raw position text, return flag -> raw role text
POSITION_BY_TYPE = {"STANDARD": "Top", "PROMO": " jungler ", "ECONOMY": "MIDDLE",
                    "MEDIUM": "duo_carry", "SMALL": "utility"}
ROLE_BY_FLAG = {"A": "bot", "R": "support"}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def _case(col, mapping: dict, default=None):
    expr = None
    for key, value in mapping.items():
        expr = (F.when(col == key, F.lit(value)) if expr is None
                else expr.when(col == key, F.lit(value)))
    return expr.otherwise(F.lit(default))


def data_stamp(spark: SparkSession, path: str) -> tuple:
    """(file, bytes, modification time) under ``path``, by the file system that Spark reads it with."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    return tuple(sorted((f.getPath().getName(), f.getLen(), f.getModificationTime()) for f in fs.listStatus(p)))


#: Whether a table has an order beyond the threshold; decides between equal plans only.
_HOT: dict[tuple, bool] = {}


def has_hot_order(spark: SparkSession, sf_dir: str, hot_threshold: int = 5_000_000) -> bool:
    """Whether an order has more lines than one task should rank (one aggregate, once for these files)."""
    from ..operators.ordered import has_hot_group
    key = (sf_dir, data_stamp(spark, table_path(sf_dir, "lineitem")), hot_threshold)
    if key not in _HOT:
        _HOT[key] = has_hot_group(read_table(spark, sf_dir, "lineitem").select("l_orderkey"), ["l_orderkey"], hot_threshold)
    return _HOT[key]


def ranked_lines(spark: SparkSession, sf_dir: str, wide: bool = False, hot_threshold: int = 5_000_000, picks: bool = True) -> DataFrame:
    """One row per line item of an order, with its member slot inside the order.

    The slot is a per-order rank; ``group_rank`` keeps an order holding a large share of all
    lines from landing in one task.  ``wide`` meets the parts before the lines are ranked and
    names their columns last in the rank's order, where they cannot matter (a part key has
    one part): every table made of these rows then shuffles the very same columns, so all
    tables of a query share one scan and one exchange.  The part's key itself only tells
    ``has_part``; without ``picks`` nothing else of the part travels with the lines.
    """
    from ..operators.ordered import group_rank
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
        "l_linenumber", "l_returnflag", "l_linestatus", "l_shipdate").where(F.col("l_orderkey").isNotNull())
    order = list(_MEMBER_ORDER)
    if wide:
        named = [_brand_number().alias("championid"), "p_type"] if picks else []
        part = read_table(spark, sf_dir, "part").select("p_partkey", *named)
        li = li.join(part, li.l_partkey == part.p_partkey, "left")
        li = li.withColumn("has_part", F.col("p_partkey").isNotNull()).drop("p_partkey")
        order += ["has_part", *(["championid", "p_type"] if picks else [])]
    if has_hot_order(spark, sf_dir, hot_threshold):
        ranked = group_rank(li, "l_orderkey", order, "player", hot_threshold)
    else:
        w = Window.partitionBy("l_orderkey").orderBy(*order)
        ranked = li.withColumn("player", F.row_number().over(w).cast("bigint"))
    return ranked.withColumnRenamed("l_orderkey", "matchid").drop("l_suppkey", "l_shipdate")


def _brand_number(col="p_brand"):
    return F.substring(F.col(col), 7, 1 << 20).cast("bigint")


def _side_of(player, slots):
    return F.when(player <= slots, F.lit(100)).otherwise(F.lit(200)).cast("bigint")


class DomainTables(Mapping):
    """The domain tables by name, each planned when it is first asked for.

    ``wide`` tables are for queries that combine several of them (see ``ranked_lines``); they
    also offer ``members``, participants and their statistics in one projection, as both
    are the same line item.  Wide tables without ``picks`` (what a member chose: category, position,
    role) serve the post-game flow, which aggregates statistics only.
    """

    NAMES = ("matches", "participants", "stats", "teamstats", "teambans", "champs")

    def __init__(self, spark: SparkSession, sf_dir: str, slots: int = DEFAULT_SLOTS, wide: bool = False, picks: bool = True):
        self.spark, self.sf_dir, self.slots, self.wide, self.picks = spark, sf_dir, slots, wide, picks
        self._made: dict[str, DataFrame] = {}
        self._lines: DataFrame | None = None

    def __iter__(self):
        if not self.picks:
            return iter(("matches", "teamstats", "members"))
        return iter((*self.NAMES, "members") if self.wide else self.NAMES)

    def __len__(self):
        return len(list(iter(self)))

    def __getitem__(self, name: str) -> DataFrame:
        if name not in list(iter(self)):
            raise KeyError(name)
        if name not in self._made:
            self._made[name] = getattr(self, f"_{name}")()
        return self._made[name]

    def stored(self) -> DomainTables:
        """The same tables over ranked lines that are stored once, for flows that write several of them;
        as Parquet, which is smaller than a checkpoint and lets each table read its own columns."""
        out = DomainTables(self.spark, self.sf_dir, self.slots, self.wide, self.picks)
        path = f"{ensure_checkpoint_dir(self.spark).rstrip('/')}/layout/{uuid.uuid4().hex}/lines"
        self._base().write.parquet(path)
        out._lines = self.spark.read.parquet(path)
        return out

    def _base(self) -> DataFrame:
        if self._lines is not None:
            return self._lines
        return ranked_lines(self.spark, self.sf_dir, self.wide, picks=self.picks)

    def _with_part(self) -> DataFrame:
        base = self._base()
        if self.wide:
            return base.where("has_part")
        part = read_table(self.spark, self.sf_dir, "part").select("p_partkey", _brand_number().alias("championid"), "p_type")
        return base.join(part, base.l_partkey == part.p_partkey, "inner")

    def _member_columns(self) -> list:
        keys = [(F.col("matchid") * 100 + F.col("player")).alias("id"), "matchid", "player"]
        if not self.picks:
            return keys
        return [*keys, "championid",
                _case(F.col("p_type"), POSITION_BY_TYPE, "none").alias("position"),
                _case(F.col("l_returnflag"), ROLE_BY_FLAG, None).cast("string").alias("role")]

    def _stat_columns(self) -> list:
        return [(F.col("l_linestatus") == "O").cast("int").alias("win"),
                F.col("l_quantity").alias("kills"),
                F.col("l_linenumber").cast("double").alias("deaths"),
                F.round(F.col("l_tax") * 100).cast("double").alias("assists"),
                F.col("l_extendedprice").alias("goldearned"),
                (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("goldspent"),
                (F.col("l_returnflag") == "A").cast("double").alias("firstbloodkill")]

    def _participants(self) -> DataFrame:
        return self._with_part().select(*self._member_columns())

    def _stats(self) -> DataFrame:
        return self._base().select((F.col("matchid") * 100 + F.col("player")).alias("id"), *self._stat_columns())

    def _members(self) -> DataFrame:
        return self._with_part().select(*self._member_columns(), *self._stat_columns())

    def _matches(self) -> DataFrame:
        return read_table(self.spark, self.sf_dir, "orders").select(
            F.col("o_orderkey").alias("id"),
            F.col("o_orderpriority").alias("platformid"),
            F.year("o_orderdate").cast("bigint").alias("seasonid"),
            (F.floor("o_totalprice").cast("bigint") % 3600).alias("duration"))

    def _teamstats(self) -> DataFrame:
        side = _side_of(F.col("player"), self.slots)
        return self._base().groupBy("matchid", side.alias("teamid")).agg(
            F.max((F.col("player") == 1).cast("int")).alias("firstblood"),
            F.sum((F.col("l_returnflag") == "A").cast("bigint")).alias("towerkills"),
            F.sum((F.col("l_returnflag") == "R").cast("bigint")).alias("dragonkills"),
            F.sum((F.col("l_returnflag") == "N").cast("bigint")).alias("baronkills"))

    def _teambans(self) -> DataFrame:
        return self._with_part().where(F.col("l_returnflag") == "A").select(
            "matchid", _side_of(F.col("player"), self.slots).alias("teamid"), "championid", F.col("player").alias("banturn"))

    def _champs(self) -> DataFrame:
        return read_table(self.spark, self.sf_dir, "part").select(
            _brand_number().alias("id"), F.col("p_brand").alias("name")).distinct()


def fixture_sql(slots: int = DEFAULT_SLOTS) -> str:
    """The same mapping as a SQL WITH-prefix (DuckDB and Spark SQL both run it)."""
    position = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in POSITION_BY_TYPE.items())
    role = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in ROLE_BY_FLAG.items())
    order = ", ".join(_MEMBER_ORDER)
    side = f"CASE WHEN player <= {slots} THEN 100 ELSE 200 END"
    return f"""WITH base AS (
  SELECT l_orderkey AS matchid,
         CAST(ROW_NUMBER() OVER (PARTITION BY l_orderkey ORDER BY {order}) AS BIGINT) AS player,
         l_partkey, l_quantity, l_extendedprice, l_discount, l_tax, l_linenumber, l_returnflag, l_linestatus
  FROM lineitem WHERE l_orderkey IS NOT NULL),
participants AS (
  SELECT b.matchid * 100 + b.player AS id, b.matchid, b.player,
         CAST(SUBSTR(p_brand, 7) AS BIGINT) AS championid,
         CASE p_type {position} ELSE 'none' END AS position,
         CASE b.l_returnflag {role} ELSE NULL END AS role
  FROM base b JOIN part ON b.l_partkey = p_partkey),
stats AS (
  SELECT matchid * 100 + player AS id, CASE WHEN l_linestatus = 'O' THEN 1 ELSE 0 END AS win,
         l_quantity AS kills, CAST(l_linenumber AS DOUBLE) AS deaths, CAST(ROUND(l_tax * 100) AS DOUBLE) AS assists,
         l_extendedprice AS goldearned, l_extendedprice * (1 - l_discount) AS goldspent,
         CAST(CASE WHEN l_returnflag = 'A' THEN 1 ELSE 0 END AS DOUBLE) AS firstbloodkill
  FROM base),
matches AS (
  SELECT o_orderkey AS id, o_orderpriority AS platformid, CAST(YEAR(o_orderdate) AS BIGINT) AS seasonid,
         CAST(FLOOR(o_totalprice) AS BIGINT) % 3600 AS duration
  FROM orders),
teamstats AS (
  SELECT matchid, CAST({side} AS BIGINT) AS teamid,
         MAX(CASE WHEN player = 1 THEN 1 ELSE 0 END) AS firstblood,
         CAST(SUM(CASE WHEN l_returnflag = 'A' THEN 1 ELSE 0 END) AS BIGINT) AS towerkills,
         CAST(SUM(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS BIGINT) AS dragonkills,
         CAST(SUM(CASE WHEN l_returnflag = 'N' THEN 1 ELSE 0 END) AS BIGINT) AS baronkills
  FROM base GROUP BY matchid, {side}),
teambans AS (
  SELECT b.matchid, CAST({side} AS BIGINT) AS teamid,
         CAST(SUBSTR(p_brand, 7) AS BIGINT) AS championid, b.player AS banturn
  FROM base b JOIN part ON b.l_partkey = p_partkey WHERE b.l_returnflag = 'A'),
champs AS (
  SELECT DISTINCT CAST(SUBSTR(p_brand, 7) AS BIGINT) AS id, p_brand AS name FROM part)"""
