"""SimHash near-duplicates by anchor-point covering.

A document's 64-bit fingerprint is cut into blocks.  Two fingerprints that differ
in at most ``max_bits`` bits differ little in at least one block (pigeonhole), and
each block has a covering code as its anchors: a perfect Hamming code on the first
``2^r - 1`` bits times all values of the rest, covering radius 1 (blocks that must
agree exactly take every value as an anchor, radius 0).  A fingerprint's *home* is
its nearest anchor; it is replicated to every anchor within covering radius plus
the block's threshold, so the home of one end of a link always holds the other.
Homes and replicas are compared anchor by anchor on all 64 bits.

At scale: copies collapse to one row per fingerprint before anything is
replicated.  An anchor with more than ``cell`` rows is dealt out as a grid of
(homes part, replicas part) cells, so a task holds at most about ``2 * cell`` rows
of one anchor, and a dense cell returns a spanning star per component instead of
its pairs.  Links become components in ``components.connected_components``.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut_lineage, id_text, long_array
from .components import connected_components

SEED = 42
CELL = 2048
_DENSE = 1024  # a cell with more comparisons than this returns stars instead of pairs


# ---- fingerprints -----------------------------------------------------------

def simhash(text: str, shingle: int = 4) -> int:
    """Majority vote of the shingles' XXH64 bits, as a signed 64-bit integer."""
    words = text.encode().lower().split()  # bytes: A-Z only, and the six ASCII white-space bytes
    n = len(words)
    if not n:
        return 0
    joined = b" ".join(words)
    if n <= shingle:
        digests = xxhash.xxh64_digest(joined, SEED)
    else:
        lens = np.fromiter(map(len, words), np.int64, n)
        ends = (lens + 1).cumsum() - 1
        first, last = (ends - lens)[: n - shingle + 1].tolist(), ends[shingle - 1:].tolist()
        h = xxhash.xxh64_digest
        digests = b"".join([h(joined[a:b], SEED) for a, b in zip(first, last)])
    rows = np.frombuffer(digests, np.uint8).reshape(-1, 8)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(rows), 1 << 15):
        ones += np.unpackbits(rows[at: at + (1 << 15)], axis=1).sum(axis=0, dtype=np.int32)
    return int(np.packbits(2 * ones > len(rows)).view(">i8")[0])


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4) -> DataFrame:
    """``(doc_id, fp)``, one row per row of ``df``: the whole text is read, lower-cased
    A-Z, cut at ASCII white space and shingled (fewer words: the whole sequence).
    A null, empty or blank text has fingerprint zero."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = [simhash(t.as_py(), shingle) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps, pa.int64())], ["doc_id", "fp"])

    rows = id_text(df, id_col, text_col).withColumn("doc_id", F.col("doc_id").cast("long"))
    return rows.mapInArrow(run, "doc_id long, fp long")


# ---- anchors ----------------------------------------------------------------

@lru_cache
def block_plan(max_bits: int) -> tuple[tuple[int, int, int], ...]:
    """``(shift, width, threshold)`` of each block.  The blocks' thresholds plus one add
    up to ``max_bits + 1``: a pair beyond every threshold differs in more bits."""
    near, exact = divmod(max_bits + 1, 2)
    weights = [3] * near + [2] * exact
    cuts = np.round(np.cumsum([0, *weights]) * 64 / sum(weights)).astype(int)
    return tuple((int(a), int(b - a), int(w == 3)) for a, b, w in zip(cuts, cuts[1:], weights))


@lru_cache
def covering(width: int, threshold: int) -> tuple[list[np.ndarray], list[int], list[int]]:
    """Parity masks of the block's code, the step to the nearest anchor by syndrome, and
    the steps to all anchors within covering radius plus threshold by syndrome."""
    if not threshold:
        return [], [0], [np.zeros(1, np.uint64)]
    r = int(np.log2(width + 1))
    bits = (1 << r) - 1  # bit i (from 0) has parity column i + 1; bits beyond them none
    columns = [i + 1 if i < bits else 0 for i in range(width)]
    masks = [sum(1 << i for i, c in enumerate(columns) if c >> k & 1) for k in range(r)]
    steps: list[list[int]] = [[] for _ in range(bits + 1)]
    steps[0].append(0)
    for i in range(width):
        steps[columns[i]].append(1 << i)
        for j in range(i):  # radius 1 plus threshold 1
            steps[columns[i] ^ columns[j]].append(1 << i | 1 << j)
    home = [0] + [1 << (s - 1) for s in range(1, bits + 1)]
    return masks, home, [np.array(x, np.uint64) for x in steps]


def replicate(reps: DataFrame, max_bits: int) -> DataFrame:
    """``(block, anchor, role, fp, rep)``: role 0 at the home anchor, role 1 at every
    anchor within covering radius plus threshold (the home included)."""
    plan = block_plan(max_bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in (batch.slice(i, 4096) for i in range(0, batch.num_rows, 4096)):
                fp = part.column("fp").to_numpy(zero_copy_only=False)
                rep = part.column("rep").to_numpy(zero_copy_only=False)
                out: list[tuple] = []
                for k, (shift, width, threshold) in enumerate(plan):
                    masks, home, steps = covering(width, threshold)
                    mask = np.uint64((1 << width) - 1)
                    value = (fp.view(np.uint64) >> np.uint64(shift)) & mask
                    syndrome = np.zeros(len(fp), np.int64)
                    for i, m in enumerate(masks):
                        syndrome |= (np.bitwise_count(value & np.uint64(m)).astype(np.int64) & 1) << i
                    out.append((k, value ^ np.array(home, np.uint64)[syndrome], 0, fp, rep))
                    for s, step in enumerate(steps):
                        at = np.flatnonzero(syndrome == s)
                        if len(at):
                            near = (value[at, None] ^ step[None, :]).ravel()
                            out.append((k, near, 1, np.repeat(fp[at], len(step)), np.repeat(rep[at], len(step))))
                sizes = [len(x[1]) for x in out]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat([x[0] for x in out], sizes).astype(np.int32)),
                     long_array(np.concatenate([x[1] for x in out]).view(np.int64)),
                     pa.array(np.repeat([x[2] for x in out], sizes).astype(np.int32)),
                     long_array(np.concatenate([x[3] for x in out])),
                     long_array(np.concatenate([x[4] for x in out]))],
                    ["block", "anchor", "role", "fp", "rep"])

    return reps.select("fp", "rep").mapInArrow(run, "block int, anchor long, role int, fp long, rep long")


# ---- comparison -------------------------------------------------------------

def _dense(fh, rh, fm, rm, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Star edges with the components of one cell's homes and replicas."""
    a = np.bitwise_count(fh[:, None] ^ fm[None, :]) <= max_bits
    big = np.int64(np.iinfo(np.int64).max)
    lh, lm = rh.copy(), rm.copy()
    while True:
        nm = np.minimum(lm, np.where(a, lh[:, None], big).min(axis=0))
        nh = np.minimum(lh, np.where(a, nm[None, :], big).min(axis=1))
        if np.array_equal(nm, lm) and np.array_equal(nh, lh):
            break
        lh, lm = nh, nm
    x, y = np.concatenate([rh, rm]), np.concatenate([lh, lm])
    keep = x != y
    return x[keep], y[keep]


def _compare(cols: list[np.ndarray], max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links of whole cells; ``cols``: four key columns, role, fp, rep, sorted."""
    role, fp, rep = cols[4], cols[5].view(np.uint64), cols[6]
    n = len(role)
    new = np.zeros(n, bool)
    new[0] = True
    for c in cols[:4]:
        new[1:] |= c[1:] != c[:-1]
    start = np.flatnonzero(new)
    size = np.diff(np.append(start, n))
    homes = np.add.reduceat((role == 0).astype(np.int64), start)
    others = size - homes
    xs, ys = [], []
    work = homes * others
    small = np.flatnonzero((work > 0) & (work <= _DENSE) & (size > 2))
    group = np.cumsum(work[small]) // (1 << 20)
    for g in np.unique(group):
        cell = small[group == g]
        h = homes[cell]
        i = np.repeat(start[cell], h) + np.arange(h.sum()) - np.repeat(np.cumsum(h) - h, h)
        m = np.repeat(others[cell], h)
        j = np.repeat(np.repeat(start[cell] + h, h), m) + np.arange(m.sum()) - np.repeat(np.cumsum(m) - m, m)
        i = np.repeat(i, m)
        keep = (fp[i] < fp[j]) & (np.bitwise_count(fp[i] ^ fp[j]) <= max_bits)
        xs.append(rep[i[keep]])
        ys.append(rep[j[keep]])
    for c in np.flatnonzero(work > _DENSE):
        a, b, z = start[c], start[c] + homes[c], start[c] + size[c]
        for lo in range(a, b, CELL):
            for at in range(b, z, CELL):
                hi, to = min(lo + CELL, b), min(at + CELL, z)
                x, y = _dense(fp[lo:hi], rep[lo:hi], fp[at:to], rep[at:to], max_bits)
                xs.append(x)
                ys.append(y)
    empty = np.zeros(0, np.int64)
    return np.concatenate([empty, *xs]), np.concatenate([empty, *ys])


def links(reps: DataFrame, max_bits: int = 4, cell: int = CELL) -> DataFrame:
    """``(a, b)``: enough links between representatives (``fp, rep``; one row per
    fingerprint) for the components of all pairs at ``max_bits`` or fewer bits."""
    spread = replicate(reps, max_bits)
    hot = cut_lineage(spread.groupBy("block", "anchor").count().filter(F.col("count") > cell)
                      .select("block", "anchor", F.ceil(F.col("count") / cell).cast("int").alias("parts")))
    if hot.isEmpty():
        cells = spread.withColumns({"hc": F.lit(0), "rc": F.lit(0)})
    else:
        # at most (replicas / cell) rows; left to the planner, which knows their number at run time
        dealt = spread.join(hot, ["block", "anchor"], "left")
        parts = F.coalesce("parts", F.lit(1))
        own = F.pmod(F.xxhash64("fp"), parts).cast("int")
        every = F.explode(F.sequence(F.lit(0), parts - 1))
        cells = (dealt.withColumn("own", own).withColumn("k", every)
                 .withColumns({"hc": F.when(F.col("role") == 0, F.col("own")).otherwise(F.col("k")),
                               "rc": F.when(F.col("role") == 0, F.col("k")).otherwise(F.col("own"))}))
    keys = ["block", "anchor", "hc", "rc"]
    cells = cells.select(*keys, "role", "fp", "rep").repartition(*keys).sortWithinPartitions(*keys, "role")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(cols):
            x, y = _compare(cols, max_bits)
            return pa.RecordBatch.from_arrays([long_array(x), long_array(y)], ["a", "b"])

        carry: list[np.ndarray] | None = None
        for batch in batches:
            cols = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            if not len(cols[0]):
                continue
            if carry is not None:
                cols = [np.concatenate(x) for x in zip(carry, cols)]
            same = np.ones(len(cols[0]), bool)
            for c in cols[:4]:
                same &= c == c[-1]
            cut = len(same) - int(np.argmin(same[::-1])) if not same.all() else 0
            if cut:
                yield out([c[:cut] for c in cols])
            carry = [c[cut:] for c in cols]
        if carry is not None:
            yield out(carry)

    return cells.mapInArrow(run, "a long, b long")


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4,
                    max_bits: int = 4, cell: int = CELL) -> DataFrame:
    """``(doc_id, fp, fingerprint, component_id)``, one row per row of ``df``.

    Rows link when their fingerprints differ in ``max_bits`` or fewer bits; the
    component is the smallest id reachable.  Null and empty texts have fingerprint
    zero and link like any other; a row without an id takes no part (component
    null).  Repeated rows repeat in the result; an empty table gives an empty one.
    """
    prints = cut_lineage(fingerprints(df, id_col, text_col, shingle))
    reps = prints.filter(F.col("doc_id").isNotNull()).groupBy("fp").agg(F.min("doc_id").alias("rep"))
    classes = connected_components(links(reps, max_bits, cell)).withColumnRenamed("node", "rep")
    named = reps.join(classes, "rep", "left").select("fp", F.coalesce("component", "rep").alias("component_id"))
    own = F.when(F.col("doc_id").isNotNull(), F.col("component_id"))
    return (prints.join(named, "fp", "left")
            .select("doc_id", "fp", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), own.alias("component_id")))


def text_keys(text: Column) -> list[Column]:
    """Two hashes that stand for a text (null: empty) beside its id."""
    whole = F.coalesce(text, F.lit(""))
    return [F.xxhash64(whole), F.crc32(whole)]


def representatives(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4,
                    max_bits: int = 4, cell: int = CELL) -> DataFrame:
    """``(doc_id, h, c, rows)``, one row per group of linked fingerprints: its row of smallest id
    (null ids last, then by ``text_keys``) and how many rows have that id and text.

    Groups come from the texts alone: a shared id joins nothing, a missing one excludes nothing.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = [simhash(t.as_py(), shingle) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), batch.column(3), pa.array(fps, pa.int64())], ["doc_id", "h", "c", "fp"])

    h, c = text_keys(F.col("text"))
    rows = id_text(df, id_col, text_col).select(F.col("doc_id").cast("long").alias("doc_id"), "text", h.alias("h"), c.alias("c"))
    prints = cut_lineage(rows.mapInArrow(run, "doc_id long, h long, c long, fp long").groupBy("fp", "doc_id", "h", "c").agg(F.count("*").alias("rows")))
    reps = prints.select("fp", F.col("fp").alias("rep")).distinct()
    classes = connected_components(links(reps, max_bits, cell))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "h", "c", "rows")).alias("first")
    # one row a fingerprint before the groups meet, so a group's size is its fingerprints
    best = prints.groupBy("fp").agg(first).join(classes, F.col("fp") == F.col("node"), "left")
    best = best.groupBy(F.coalesce("component", "fp").alias("component")).agg(F.min("first").alias("first"))
    return best.select("first.doc_id", "first.h", "first.c", "first.rows")
