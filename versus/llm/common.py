"""Small helpers shared by the operators."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import cut_lineage, ensure_checkpoint_dir, table_path

__all__ = ["cut_lineage", "with_small", "numbered", "read", "shared_folder", "long_array", "release", "small_batches", "id_text", "crc_mod", "unit_hash", "sized_batches"]

#: Documents are handed to NumPy in pieces of about this many characters, so that
#: a task's working set does not follow the Arrow batch (10,000 rows of any length).
CHUNK_CHARS = 1 << 20


#: Rows of an Arrow batch between Spark and Python; whole texts make Spark's 10,000 too large.
ARROW_ROWS = 1000


def small_batches(spark: SparkSession) -> None:
    """Bound the Arrow batches of this session: JVM and Python each hold a batch of whole
    texts per task, outside the heap."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))


def release() -> None:
    """At the end of a task: its process lives on, its buffers need not."""
    pa.default_memory_pool().release_unused()


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table, for queries that hand whole texts to Python."""
    small_batches(spark)
    return spark.read.parquet(table_path(sf_dir, name))


def id_text(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(doc_id, text)`` only: further columns, whatever their names, stay out of
    the way and are not read.  A null text becomes the empty text."""
    return df.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def crc_mod(id_col: Column, n: int) -> Column:
    """``crc32(id as text) mod n``; a null id counts as the empty text (crc 0)."""
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit(""))) % F.lit(n)


def unit_hash(*cols: Column, seed: int = 0) -> Column:
    """A value in [0, 1) that only the given columns and the seed decide."""
    h = F.shiftrightunsigned(F.xxhash64(*cols, F.lit(seed)), 12)
    return h.cast("double") / F.lit(float(1 << 52))


def sized_batches(texts: Iterable[str | None], limit: int = CHUNK_CHARS) -> Iterator[list[str]]:
    """Consecutive texts (null: empty) in lists of about ``limit`` characters."""
    out, chars = [], 0
    for t in texts:
        t = t or ""
        if out and chars + len(t) > limit:
            yield out
            out, chars = [], 0
        out.append(t)
        chars += len(t)
    if out:
        yield out


def long_array(values: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(values, dtype=np.int64))


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share (``spark.checkpoint.dir``)."""
    return ensure_checkpoint_dir(spark).rstrip("/")


#: A side of a join is broadcast up to this many rows (its rows are a few numbers wide).
BROADCAST_ROWS = 200_000


def with_small(df: DataFrame, small: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """Join an aggregated table whose rows are counted first: within ``BROADCAST_ROWS`` it is
    broadcast, beyond it the same join is left to the planner.  Keys match null-safely."""
    small = cut_lineage(small)
    side = small.select(*[F.col(k).alias(f"__{k}") for k in on], *[c for c in small.columns if c not in on])
    if side.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        side = F.broadcast(side)
    cond = [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in on]
    return df.join(side, cond, how).drop(*[f"__{k}" for k in on])


#: Equal rows that one row of counts stands for at a time.
BLOCK = 10_000


def numbered(counted: DataFrame, n: str, number: str, block: int = BLOCK) -> DataFrame:
    """Each row of ``counted`` as many times as its column ``n`` says, numbered from 0 in the long
    column ``number``.  Large counts are cut into blocks that are spread over all tasks first."""
    counted = cut_lineage(counted)
    at, size = "__block", F.lit(block).cast("long")
    few = counted.filter(F.col(n) <= block).withColumn(at, F.lit(0).cast("long"))
    many = counted.filter(F.col(n) > block).withColumn(at, F.explode(F.expr(f"sequence(0L, (`{n}` - 1) div {block}L)")))
    both = few.unionByName(many.repartition(*counted.columns, at))
    last = F.least(F.col(n), (F.col(at) + 1) * size) - 1
    return both.withColumn(number, F.explode(F.sequence(F.col(at) * size, last))).drop(n, at)


#: DuckDB SQL: the table of the CRC-32 as a CTE of one row, to be cross joined where ``crc_sql``
#: gives the unsigned CRC-32 of an ASCII text.
CRC_TABLE_SQL = """crc_table AS (SELECT list(c ORDER BY i) AS crc_t FROM (SELECT i,
  list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c FROM range(256) t(i)))"""


def crc_sql(text: str) -> str:
    step = "xor(c >> 8, crc_t[1 + (xor(c, b) & 255)])"
    codes = f"list_transform(string_split({text}, ''), lambda ch: CAST(ascii(ch) AS BIGINT))"
    return f"xor(list_reduce({codes}, lambda c, b: {step}, 4294967295), 4294967295)"
