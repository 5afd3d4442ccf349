"""Merkle manifest of a dataset, its proofs by pointer jumping.

Every row is a leaf: the hash of its fields.  Each group's leaves, in the order of their
ids, form a tree whose every ``FAN`` neighbours become one node; the roots of the groups,
in the order of the group values, form a further tree over them.

*Building.*  Leaves are numbered inside their group by range partitions and offsets, so a
group of any share of the rows is spread.  Blocks of ``FAN ** BLOCK_LEVELS`` neighbours are
hashed through ``BLOCK_LEVELS`` levels in one aggregate of bounded size; the blocks'
tops are the leaves of the next round.

*Proofs.*  An inner node holds the siblings on its way to its parent.  A round joins the
nodes with themselves: a node takes over the segment and the pointer of the node it points
at, which doubles the distance.  Nodes that have reached the root stop.  A node high up is
pointed at by up to ``FAN ** distance`` others; it is copied to their ancestors
``SALT_LEVELS`` above them, so that a join key meets at most ``FAN ** SALT_LEVELS`` rows; the
copies are fewer than the nodes that read them.  Leaves, the bulk of the rows, join their
finished parent once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import CRC_TABLE_SQL, crc_sql, cut_lineage

FAN = 3
BLOCK_LEVELS = 6
SALT_LEVELS = 4

LEAF_FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def field(c: Column) -> Column:
    """``-`` for null, else the UTF-8 byte count, a colon and the value."""
    s = c.cast("string")
    return F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-"))


def leaf_hash(*fields: Column) -> Column:
    return F.sha2(F.concat(*[field(c) for c in fields]), 256)


def group_key(c: Column) -> Column:
    """Not null, and in the order of the groups: null first, then by UTF-8 bytes."""
    return F.coalesce(F.concat(F.lit("="), c.cast("string")), F.lit(""))


def _with_height(df: DataFrame) -> DataFrame:
    """``height``: levels above the leaves of a tree of ``n`` leaves."""
    height, top = F.lit(0), 1
    while top < 1 << 62:
        height, top = height + (F.col("n") > top).cast("int"), top * FAN
    return df.withColumn("height", height)


def _numbered(leaves: DataFrame, order: Sequence[str]) -> DataFrame:
    """``idx`` (from 0) by ``order`` inside ``g``, and ``n``, the rows of ``g``."""
    # a seeded number last, so that many equal rows spread as well; they are interchangeable
    dealt = leaves.repartitionByRange(F.col("g"), *[F.col(c).asc_nulls_first() for c in order], F.rand(11)).withColumn("bin", F.spark_partition_id())
    dealt = cut_lineage(dealt)
    per_bin = dealt.groupBy("g", "bin").agg(F.count("*").alias("m"))
    whole = Window.partitionBy("g")
    earlier = whole.orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    # a row for each group and bin
    offsets = per_bin.select(F.col("g").alias("og"), F.col("bin").alias("obin"), F.coalesce(F.sum("m").over(earlier), F.lit(0)).alias("offset"), F.sum("m").over(whole).alias("n"))
    inside = Window.partitionBy("g", "bin").orderBy(*[F.col(c).asc_nulls_first() for c in order])
    out = dealt.withColumn("at", F.row_number().over(inside) - 1).join(offsets, (F.col("g") == F.col("og")) & (F.col("bin") == F.col("obin")))
    return out.withColumn("idx", F.col("offset") + F.col("at")).drop("bin", "at", "og", "obin", "offset")


def _parents(hashes: Column) -> Column:
    """The next level above consecutive nodes."""
    runs = F.sequence(F.lit(0), F.floor((F.size(hashes) - 1) / FAN).cast("int"))
    return F.transform(runs, lambda i: F.sha2(F.array_join(F.slice(hashes, i * FAN + 1, F.lit(FAN)), ""), 256))


def _siblings(hashes: Column, at: Column) -> tuple[Column, Column]:
    """What stands left and right of node ``at`` (from 0) in its run, as bytes."""
    inside = F.pmod(at, F.lit(FAN)).cast("int")
    left = F.array_join(F.slice(hashes, at - inside + 1, inside), "")
    right = F.array_join(F.slice(hashes, at + 2, F.lit(FAN - 1) - inside), "")
    return F.unhex(left), F.unhex(right)


def _blocks(nodes: DataFrame, carry: Sequence[str]) -> DataFrame:
    """Neighbouring nodes of one level in blocks, with the levels above them: ``(g, n, height,
    base, block, items, l0 .. l6)``; a tree's levels end at its root."""
    size = FAN ** BLOCK_LEVELS
    item = F.struct("idx", *carry, "hash")
    out = nodes.groupBy("g", "n", "height", "base", F.floor(F.col("idx") / size).alias("block")).agg(F.sort_array(F.collect_list(item)).alias("items"))
    out = out.withColumn("l0", F.col("items.hash"))
    for k in range(1, BLOCK_LEVELS + 1):
        below = F.col(f"l{k - 1}")
        out = out.withColumn(f"l{k}", F.when(F.col("height") >= F.col("base") + k, _parents(below)).otherwise(F.expr("cast(array() as array<string>)")))
    return cut_lineage(out)


_NODE = "struct<level:int,idx:bigint,hash:string,left:binary,right:binary>"


def _node(hashes: Column, level: Column, start: Column):
    def node(h: Column, i: Column) -> Column:
        left, right = _siblings(hashes, i)
        return F.struct(level.alias("level"), (start + i).alias("idx"), h.alias("hash"), left.alias("left"), right.alias("right"))
    return node


def _inner(blocks: DataFrame, first: int) -> DataFrame:
    """Nodes of the levels from ``base + first`` on whose siblings the block knows, roots included:
    ``(g, height, level, idx, hash, left, right)``."""
    levels = []
    for k in range(first, BLOCK_LEVELS + 1):
        hashes, level = F.col(f"l{k}"), F.col("base") + k
        # the top of a block has its siblings in other blocks, unless it is the root
        known = (level == F.col("height")) if k == BLOCK_LEVELS else F.lit(True)
        start = F.col("block") * FAN ** (BLOCK_LEVELS - k)

        levels.append(F.when(known, F.transform(hashes, _node(hashes, level, start))).otherwise(F.expr(f"cast(array() as array<{_NODE}>)")))
    return blocks.select("g", "n", "height", F.inline(F.concat(*levels)))


def build(leaves: DataFrame, order: Sequence[str], carry: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """Trees over ``leaves`` (``g, hash`` and the columns of ``order`` and ``carry``), one for each ``g``.

    Returns the leaves ``(g, n, height, idx, hash, left, right, *carry)`` and the inner nodes
    ``(g, n, height, level, idx, hash, left, right)``.  Equal rows are interchangeable.
    """
    nodes = _with_height(_numbered(leaves, [*order, "hash"])).withColumn("base", F.lit(0))
    blocks = _blocks(nodes, carry)
    items = blocks.select("g", "n", "height", "l0", F.posexplode("items").alias("at", "item"))
    left, right = _siblings(F.col("l0"), F.col("at"))
    leaf_rows = items.select("g", "n", "height", "item.idx", "item.hash", left.alias("left"), right.alias("right"), *[f"item.{c}" for c in carry])
    inner = _inner(blocks, 1)
    base = 0
    while True:
        base += BLOCK_LEVELS
        tops = blocks.filter(F.col("height") > base).select("g", "n", "height", F.lit(base).alias("base"), F.col("block").alias("idx"), F.element_at(f"l{BLOCK_LEVELS}", 1).alias("hash"))
        if tops.isEmpty():
            return leaf_rows, inner
        blocks = _blocks(tops, [])
        inner = inner.unionByName(_inner(blocks, 0))


def proofs(leaves: DataFrame, inner: DataFrame, above: DataFrame | None = None) -> DataFrame:
    """Every leaf with its whole way up: the columns of ``leaves`` but left and right, ``top`` (its tree's
    root) and ``way``, the siblings (left, right) of every level up to it, followed by the
    way of its ``g`` in ``above`` (``g, way``) if given.
    """
    none = F.expr("cast(array() as array<struct<left:binary,right:binary>>)")
    # trees of one leaf have no inner node: their leaf is their root
    roots = inner.filter("level = height").unionByName(leaves.filter("height = 0").select("g", "n", "height", F.lit(0).alias("level"), "idx", "hash", "left", "right"))
    if above is not None:
        roots = roots.join(above.select(F.col("g").alias("ag"), F.col("way").alias("further")), F.col("g") == F.col("ag")).drop("ag")
    else:
        roots = roots.withColumn("further", none)
    done = cut_lineage(roots.select("g", "n", "height", "level", "idx", F.unhex("hash").alias("top"), F.col("further").alias("way")))
    rest = inner.filter("level < height").select("g", "n", "height", "level", "idx", F.array(F.struct("left", "right")).alias("way"))
    rest = cut_lineage(rest)
    distance = 1
    while not rest.isEmpty():
        # the nodes ``distance`` above: of the finished ones or, with a segment as long, of the others
        down = max(distance - SALT_LEVELS, 0)
        ends = done.select("g", "n", "level", "idx", "way", "top")
        targets = ends.unionByName(rest.select("g", "n", "level", "idx", "way", F.lit(None).cast("binary").alias("top"))).filter(F.col("level") > distance)
        spread = FAN ** down
        # copies to the ancestors SALT_LEVELS above the nodes that point here, as far as the level goes
        width = F.ceil(F.col("n") / F.pow(F.lit(float(FAN)), F.col("level") - down))
        copies = F.sequence(F.col("idx") * spread, F.least((F.col("idx") + 1) * spread, width.cast("long")) - 1)
        targets = targets.select(F.col("g").alias("tg"), F.col("level").alias("tlevel"), F.explode(copies).alias("tidx"), F.col("way").alias("tway"), F.col("top").alias("ttop"))
        near = F.floor(F.col("idx") / FAN ** (distance - down)).cast("long")
        met = rest.join(targets, (F.col("g") == F.col("tg")) & (F.col("level") + distance == F.col("tlevel")) & (near == F.col("tidx")))
        met = cut_lineage(met.select("g", "n", "height", "level", "idx", F.concat("way", "tway").alias("way"), F.col("ttop").alias("top")))
        done = done.unionByName(met.filter("top IS NOT NULL"))
        rest, distance = met.filter("top IS NULL").drop("top"), distance * 2
    ways = done.select(F.col("g").alias("wg"), F.col("level").alias("wlevel"), F.col("idx").alias("widx"), "top", "way")
    parent = F.when(F.col("height") > 0, F.floor(F.col("idx") / FAN)).otherwise(F.lit(0)).cast("long")
    first = F.when(F.col("height") > 0, F.array(F.struct("left", "right"))).otherwise(none)
    out = leaves.join(ways, (F.col("g") == F.col("wg")) & (F.least(F.col("height"), F.lit(1)) == F.col("wlevel")) & (parent == F.col("widx")))
    kept = [c for c in leaves.columns if c not in ("left", "right")]
    return out.select(*kept, F.lower(F.hex("top")).alias("top"), F.concat(first, "way").alias("way"))


def fold(leaf: Column, way: Column) -> Column:
    """The root that a leaf and the siblings on its way give."""
    return F.aggregate(way, leaf, lambda acc, s: F.sha2(F.concat(F.lower(F.hex(s.left)), acc, F.lower(F.hex(s.right))), 256))


def proof_hash(way: Column) -> Column:
    """One hash for all siblings on a way, left to right and level by level."""
    return F.sha2(F.array_join(F.transform(way, lambda s: F.concat(F.lower(F.hex(s.left)), F.lower(F.hex(s.right)))), ""), 256)


def manifest(df: DataFrame, fields: Sequence[str] = LEAF_FIELDS, id_col: str = "doc_id", group_col: str = "source",
             more: dict[str, Column] | None = None) -> DataFrame:
    """``(id_col, leaf, subroot, root, way)`` and the expressions ``more`` over ``df``, one row per row.

    ``leaf`` hashes ``fields``; ``subroot`` is the root of the row's group, ``root`` that of
    all groups, ``way`` the siblings from leaf to root.  Rows without an id come first in their
    group, rows of one id in the order of their leaves; equal rows are interchangeable.
    A null group is a group of its own, before the others.  Null fields, empty and very long
    texts are hashed like any other, further columns do not matter; no rows, no result.
    """
    more = more or {}
    leaves = df.select(group_key(F.col(group_col)).alias("g"), F.col(id_col).alias("id"), leaf_hash(*[F.col(c) for c in fields]).alias("hash"),
                       *[c.alias(f"more_{k}") for k, c in more.items()])
    leaves, inner = build(cut_lineage(leaves), ["id"], ["id", *[f"more_{k}" for k in more]])
    subroots = inner.filter("level = height").select("g", "hash").unionByName(leaves.filter("height = 0").select("g", "hash"))
    subroots = cut_lineage(subroots.select(F.lit("").alias("g"), F.col("g").alias("group"), "hash"))
    over = proofs(*build(subroots, ["group"], ["group"]))
    over = cut_lineage(over.select(F.col("group").alias("g"), "way", "top"))
    root = over.select("top").first()
    out = proofs(leaves, inner, over.select("g", "way"))
    return out.select(F.col("id").alias(id_col), F.col("hash").alias("leaf"), F.col("top").alias("subroot"),
                      F.lit(root and root.top).cast("string").alias("root"), "way", *[F.col(f"more_{k}").alias(k) for k in more])


def tampered_leaf(df: DataFrame, fields: Sequence[str] = LEAF_FIELDS, id_col: str = "doc_id", text_col: str = "text") -> Column:
    """The leaf after the line feeds are deleted from the texts of even ``crc32(id)``; null where the leaf stays."""
    text = F.col(text_col)
    changed = [F.translate(text, "\n", "") if c == text_col else F.col(c) for c in fields]
    hit = (F.crc32(F.col(id_col).cast("string")) % 2 == 0) & text.contains("\n")
    return F.when(hit, leaf_hash(*changed))


def verified(df: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The contract of ``op11``: proofs of untampered rows held against tampered ones."""
    out = manifest(df, id_col=id_col, more={"tampered": tampered_leaf(df, id_col=id_col)})
    out = out.withColumn("folded_root", fold(F.coalesce("tampered", "leaf"), F.col("way"))).withColumn("proof_sha256", proof_hash(F.col("way")))
    return out.select(id_col, "leaf", "subroot", "root", "proof_sha256", "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


#: DuckDB SQL of ``op11``: levels by recursion, every leaf joined to its ancestors by division.
ORACLE = f"""
WITH RECURSIVE {CRC_TABLE_SQL},
f AS (SELECT doc_id, coalesce('=' || source, '') AS g, text,
  coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || CAST(doc_id AS VARCHAR), '-') || coalesce(strlen(source) || ':' || source, '-')
  || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || CAST(n_chars AS VARCHAR), '-') AS head FROM documents),
h AS (SELECT doc_id, g, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
  CASE WHEN {crc_sql("CAST(doc_id AS VARCHAR)")} % 2 = 0 THEN sha256(head || coalesce(strlen(replace(text, chr(10), '')) || ':' || replace(text, chr(10), ''), '-')) END AS tampered FROM f, crc_table),
leaves AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx, count(*) OVER (PARTITION BY g) AS n FROM h),
nodes AS (SELECT g, 0 AS level, idx, leaf AS hash, n FROM leaves
  UNION ALL SELECT g, level + 1, idx // 3, sha256(string_agg(hash, '' ORDER BY idx)), (n + 2) // 3 FROM nodes WHERE n > 1 GROUP BY g, level, idx // 3, n),
subroots AS (SELECT g, hash AS subroot, row_number() OVER (ORDER BY g) - 1 AS idx, count(*) OVER () AS n FROM nodes WHERE n = 1),
tops AS (SELECT 0 AS level, idx, subroot AS hash, n FROM subroots
  UNION ALL SELECT level + 1, idx // 3, sha256(string_agg(hash, '' ORDER BY idx)), (n + 2) // 3 FROM tops WHERE n > 1 GROUP BY level, idx // 3, n),
inside AS (SELECT g, level, idx, coalesce(string_agg(hash, '') OVER (run ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS a,
  coalesce(string_agg(hash, '') OVER (run ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS b FROM nodes WHERE n > 1 WINDOW run AS (PARTITION BY g, level, idx // 3 ORDER BY idx)),
over_ AS (SELECT level, idx, coalesce(string_agg(hash, '') OVER (run ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS a,
  coalesce(string_agg(hash, '') OVER (run ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS b FROM tops WHERE n > 1 WINDOW run AS (PARTITION BY level, idx // 3 ORDER BY idx)),
low AS (SELECT l.g, l.idx, list(s.a || '|' || s.b ORDER BY s.level) AS way FROM leaves l JOIN inside s ON s.g = l.g AND s.idx = l.idx // CAST(power(3, s.level) AS BIGINT) GROUP BY l.g, l.idx),
high AS (SELECT r.g, list(s.a || '|' || s.b ORDER BY s.level) AS way FROM subroots r JOIN over_ s ON s.idx = r.idx // CAST(power(3, s.level) AS BIGINT) GROUP BY r.g),
w AS (SELECT l.*, r.subroot, list_concat(coalesce(low.way, []), coalesce(high.way, [])) AS way
  FROM leaves l JOIN subroots r USING (g) LEFT JOIN low ON low.g = l.g AND low.idx = l.idx LEFT JOIN high ON high.g = l.g),
e AS (SELECT doc_id, leaf, subroot, (SELECT hash FROM tops WHERE n = 1) AS root, sha256(replace(array_to_string(way, ''), '|', '')) AS proof_sha256,
  list_reduce(way, lambda acc, s: sha256(split_part(s, '|', 1) || acc || split_part(s, '|', 2)), coalesce(tampered, leaf)) AS folded_root FROM w)
SELECT *, folded_root = root AS verified FROM e
"""
