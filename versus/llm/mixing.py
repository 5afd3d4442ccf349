"""Mixing sources to target weights by Efraimidis-Spirakis sampling (DataFrame functions only).

Every document gets the exponential key ``-ln(u) / quality weight`` with ``u`` hashed
from its id and a seed.  A source's target is its weighted share of all words, capped
at ``max_repeat`` times its size, the excess reshared by weight.  A source gives
``floor(target / size)`` complete epochs; the rest of the target is the fractional
epoch: documents in key order while the middle of the document in the running sum of
words is within the rest, so a source misses its target by at most half a document.

At scale: texts are read once, for their number of words.  Running sums over a hot
source are not one window: keys fall into ``bins`` ranges, totals per (source, bin)
are summed over at most ``bins`` rows of a source, and only inside a bin are
documents ordered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut_lineage, numbered, with_small

WORD = r"[^\x20\x09-\x0D]+"
CYCLE = (5, 2, 1)


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def unit_md5(id_col: Column, seed: int) -> Column:
    """Uniform in (0, 1), from 48 bits of md5(id, seed)."""
    text = F.concat(F.coalesce(id_col.cast("string"), F.lit("")), F.lit(f":{seed}"))
    return (F.conv(F.substring(F.md5(text), 1, 12), 16, 10).cast("double") + 0.5) / float(1 << 48)


def quality_weights(labels: DataFrame, id_col: str = "doc_id", quality_col: str = "quality") -> DataFrame:
    """``(doc_id, weight)``, one row per id: 2 for good documents, a half for bad ones."""
    return (labels.filter(F.col(id_col).isNotNull() & F.col(quality_col).isNotNull()).groupBy(F.col(id_col).alias("doc_id"))
            .agg((0.5 + 1.5 * F.avg(quality_col)).alias("weight")))


def targets(sources: DataFrame, cycle: tuple[int, ...] = CYCLE, max_repeat: int = 3) -> DataFrame:
    """Adds ``target`` to ``(source, source_size)``, one row per source.

    Weights repeat ``cycle`` over the sources by code point, null last.  Sources fill up
    in the order of size / weight; ``level`` is the words per weight left for those
    that are not yet full, and the first that stays below its cap fixes it for the rest.
    The windows run over one row per source.
    """
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*map(F.lit, cycle)), (place % len(cycle)) + 1)
    s = sources.withColumn("w", weight).withColumn("cap", F.col("source_size") * max_repeat)
    order = Window.orderBy(F.col("cap") / F.col("w"), F.col("source").asc_nulls_last())
    before, whole = order.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    left = F.sum("source_size").over(whole) - F.coalesce(F.sum("cap").over(before), F.lit(0))
    weights = F.sum("w").over(whole) - F.coalesce(F.sum("w").over(before), F.lit(0))
    s = s.withColumn("level", left / weights)
    s = s.withColumn("full", F.col("cap") / F.col("w") <= F.col("level"))
    level = F.max(F.when(~F.col("full"), F.col("level"))).over(whole)
    target = F.when(F.col("full"), F.col("cap").cast("double")).otherwise(level * F.col("w"))
    return s.select("source", "source_size", target.alias("target"))


def mix(df: DataFrame, weights: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text",
        source_col: str = "source", cycle: tuple[int, ...] = CYCLE, max_repeat: int = 3, seed: int = 8,
        bins: int = 4096) -> DataFrame:
    """``(doc_id, source, size, source_size, target, copies, taken)``, one row per row of ``df``.

    ``size`` counts words (null and empty texts: 0, taken 0); ``copies`` is how often the
    mix has the document, ``taken`` its words.  ``weights`` (``doc_id, weight``; missing
    or null: 1) scale the keys.  A null source is a source.  Rows without an id, and rows of
    one id, share one key; of these, the shorter come first.  Rows equal in id, source and
    size are interchangeable: they move as one row with their number, and are counted off
    after their place in the running sum is known, so no repeated row makes a bin grow.
    """
    rows = df.select(F.col(id_col).alias("doc_id"), F.col(source_col).cast("string").alias("source"), word_count(F.col(text_col)).alias("size"))
    rows = rows.groupBy("doc_id", "source", "size").agg(F.count("*").alias("n"))
    if weights is not None:
        rows = rows.join(weights.select("doc_id", "weight"), "doc_id", "left")
    else:
        rows = rows.withColumn("weight", F.lit(1.0))
    key = -F.log(unit_md5(F.col("doc_id"), seed)) / F.coalesce("weight", F.lit(1.0))
    rows = rows.withColumn("key", key).withColumn("bin", F.floor((1 - F.exp(-F.col("key"))) * bins).cast("int"))
    rows = cut_lineage(rows.select("doc_id", "source", "size", "n", "key", "bin"))

    words = F.col("size") * F.col("n")
    sums = cut_lineage(rows.groupBy("source", "bin").agg(F.sum(words).alias("words")))
    aims = targets(sums.groupBy("source").agg(F.sum("words").alias("source_size")), cycle, max_repeat)
    earlier = Window.partitionBy("source").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select("source", "bin", F.coalesce(F.sum("words").over(earlier), F.lit(0)).alias("offset"))

    inside = Window.partitionBy("source", "bin").orderBy("key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("before", F.coalesce(F.sum(words).over(inside), F.lit(0)))
    rows = with_small(rows, offsets, ["source", "bin"])
    rows = with_small(rows, aims, ["source"])
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    rows = rows.select("doc_id", "source", "size", "n", "source_size", "target", epochs.alias("epochs"), (F.col("offset") + F.col("before")).alias("before"))
    rows = numbered(rows, "n", "number")
    rest = F.col("target") - F.col("epochs") * F.col("source_size")
    middle = F.col("before") + F.col("number") * F.col("size") + F.col("size") / 2
    rows = rows.withColumn("copies", F.col("epochs") + F.when((F.col("size") > 0) & (middle <= rest), 1).otherwise(0))
    return rows.select("doc_id", "source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))


#: DuckDB SQL of ``op8``: plain windows over the whole sources.
ORACLE = r"""
WITH d AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size FROM documents),
q AS (SELECT doc_id, 0.5 + 1.5 * avg(quality) AS weight FROM labels WHERE doc_id IS NOT NULL AND quality IS NOT NULL GROUP BY doc_id),
k AS (SELECT d.*, -ln((CAST(CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':8'), 1, 12) AS BIGINT) AS DOUBLE) + 0.5) / 281474976710656.0)
             / coalesce(weight, 1.0) AS key FROM d LEFT JOIN q USING (doc_id)),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT *, [5, 2, 1][CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS INT)] AS w, 3 * source_size AS cap FROM s),
f AS (SELECT *, (CAST(sum(source_size) OVER () AS DOUBLE) - coalesce(sum(cap) OVER o, 0)) / (sum(w) OVER () - coalesce(sum(w) OVER o, 0)) AS level FROM w
      WINDOW o AS (ORDER BY CAST(cap AS DOUBLE) / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
g AS (SELECT source, source_size, CASE WHEN CAST(cap AS DOUBLE) / w <= level THEN CAST(cap AS DOUBLE)
             ELSE max(CASE WHEN CAST(cap AS DOUBLE) / w > level THEN level END) OVER () * w END AS target FROM f),
e AS (SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS epochs FROM g),
r AS (SELECT k.doc_id, k.source, k.size, e.source_size, e.target, e.epochs,
             coalesce(sum(k.size) OVER (PARTITION BY k.source ORDER BY k.key, k.doc_id, k.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
      FROM k JOIN e ON k.source IS NOT DISTINCT FROM e.source)
SELECT doc_id, source, size, source_size, target,
       epochs + CASE WHEN size > 0 AND before + size / 2.0 <= target - epochs * source_size THEN 1 ELSE 0 END AS copies,
       size * (epochs + CASE WHEN size > 0 AND before + size / 2.0 <= target - epochs * source_size THEN 1 ELSE 0 END) AS taken
FROM r
"""
