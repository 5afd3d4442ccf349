"""Sharding by fixed virtual slots (DataFrame functions only).

Records hash into ``n_slots`` virtual slots for good.  The bytes of each slot are
aggregated and a slot-to-shard map is drawn up from them: slots by falling size, each
to the shard with the fewest bytes so far.  The map is a small versioned table in the
shared folder; growing or rebalancing edits it (``grow``) and stores the next version,
and only the records of the moved slots change their shard.  The law kept is
``bytes``: shards are of nearly equal size.

At scale: texts are read once, for their length and checksum.  What is broadcast is
the map, ``n_slots`` rows by construction.  A record that occurs many times over is
salted by its number, so that no slot grows with it; a row's place in its shard is its slot's offset
plus its place in the slot, never a window over a shard.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import cut_lineage, numbered, shared_folder

SLOTS = 4096
HEADER = 16
_MAP = ["slot", "shard", "bytes", "rows"]


def records(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", n_slots: int = SLOTS) -> DataFrame:
    """``(doc_id, size, text_crc32, virtual_slot)``, one row per row of ``df``.

    ``size`` is the UTF-8 bytes of the text (null: none) plus ``HEADER``; a null text has
    the checksum of the empty one.  Rows equal in all three are salted with their number among
    each other, so a record's slots do not depend on partitions or order; equal texts of
    different ids lie in different slots.  They are counted before they move and numbered
    from the count, in blocks (``common.numbered``), so no task holds a record that repeats without end.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = df.select(F.col(id_col).alias("doc_id"), (F.octet_length(text) + HEADER).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"))
    key = ["doc_id", "size", "text_crc32"]
    rows = numbered(rows.groupBy(*key).agg(F.count("*").alias("n")), "n", "salt")
    slot = F.pmod(F.xxhash64("doc_id", "text_crc32", "salt"), F.lit(n_slots)).cast("int")
    return cut_lineage(rows.select(*key, slot.alias("virtual_slot")))


def slot_sizes(rows: DataFrame) -> DataFrame:
    """``(slot, bytes, rows)``: at most ``n_slots`` rows."""
    return rows.groupBy(F.col("virtual_slot").alias("slot")).agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"))


def draw_map(slots: DataFrame, n_shards: int) -> DataFrame:
    """``(slot, shard, bytes, rows)``: the largest slot first, each to the shard with the
    fewest bytes so far (ties: smallest slot, smallest shard).  One fold over the slots' array."""
    entry = F.struct((-F.col("bytes")).alias("neg"), "slot", "rows")
    start = F.struct(F.array_repeat(F.lit(0).cast("long"), n_shards).alias("load"), F.array().cast("array<int>").alias("shards"))

    def put(acc, x):
        at = F.array_position(acc["load"], F.array_min(acc["load"])) - 1
        load = F.transform(acc["load"], lambda v, i: F.when(i == at, v - x["neg"]).otherwise(v))
        return F.struct(load.alias("load"), F.concat(acc["shards"], F.array(at.cast("int"))).alias("shards"))

    one = slots.agg(F.array_sort(F.collect_list(entry)).alias("slots"))
    one = one.select("slots", F.aggregate("slots", start, put)["shards"].alias("shards"))
    drawn = one.select(F.explode(F.arrays_zip("slots", "shards")).alias("x"))
    return drawn.select("x.slots.slot", F.col("x.shards").alias("shard"), (-F.col("x.slots.neg")).alias("bytes"), "x.slots.rows")


def grow(current: DataFrame, n_shards: int) -> DataFrame:
    """The map edited for one more shard (number ``n_shards``): each shard hands over whole
    slots, smallest first, as long as it stays nearer to the new mean; slots that stay keep
    their shard, and none moves between old shards."""
    mean = F.sum("bytes").over(Window.partitionBy()) / (n_shards + 1)
    shard = Window.partitionBy("shard")
    load = F.sum("bytes").over(shard)
    given = F.sum("bytes").over(shard.orderBy("bytes", "slot"))
    moved = (given - F.col("bytes") / 2) <= load - mean
    return (current.withColumn("moved", moved)
            .select("slot", F.when(F.col("moved"), F.lit(n_shards)).otherwise(F.col("shard")).alias("shard"), "bytes", "rows"))


def save_map(current: DataFrame, path: str, version: int) -> None:
    """Store a version of the map; an existing version is never overwritten."""
    current.select(*_MAP).coalesce(1).write.mode("error").parquet(f"{path}/version={version}")


def load_map(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """A stored version, the newest by default, with its number."""
    maps = spark.read.parquet(path)
    if version is None:
        version = maps.agg(F.max("version")).first()[0]
    return maps.filter(F.col("version") == version)


def place(rows: DataFrame, current: DataFrame) -> DataFrame:
    """``(doc_id, size, text_crc32, shard, slot, virtual_slot, map_version)``; ``slot`` numbers
    the rows of a shard from 0 without gaps."""
    offset = F.sum("rows").over(Window.partitionBy("shard").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1))
    small = current.select(F.col("slot").alias("virtual_slot"), "shard", "version", F.coalesce(offset, F.lit(0)).alias("offset"))
    within = F.row_number().over(Window.partitionBy("virtual_slot").orderBy("doc_id", "text_crc32", "size")) - 1
    out = rows.withColumn("within", within).join(F.broadcast(small), "virtual_slot")  # n_slots rows at most
    return out.select("doc_id", "size", "text_crc32", F.col("shard").cast("int").alias("shard"), (F.col("offset") + F.col("within")).cast("long").alias("slot"),
                      "virtual_slot", F.col("version").cast("int").alias("map_version"))


def shard(df: DataFrame, n_shards: int = 40, id_col: str = "doc_id", text_col: str = "text", n_slots: int = SLOTS,
          map_path: str | None = None) -> DataFrame:
    """Place every row of ``df``: see ``records`` and ``place``.  The first version of the map is
    stored at ``map_path`` (default: a new folder in the shared one) and read from there.
    An empty table gives an empty result."""
    spark = df.sparkSession
    path = map_path or f"{shared_folder(spark)}/slot_maps/{uuid.uuid4().hex}"
    rows = records(df, id_col, text_col, n_slots)
    save_map(draw_map(slot_sizes(rows), n_shards), path, 1)
    return place(rows, load_map(spark, path))
