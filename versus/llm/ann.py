"""Nearest neighbours by inner product: stable projections, kd-tree, chi-square stop.

Inner products become distances (``|q|^2 + M^2 - 2 q.x`` with ``M`` the largest norm, by
one more coordinate), and points are projected to ``DIMS`` Gaussian (2-stable)
coordinates.  The squared projected distance of a pair over its squared distance is
chi-square distributed with ``DIMS`` degrees of freedom.  A kd-tree over the projected
points yields them leaf by leaf in order of projected distance; they are verified by
their exact inner products until the next leaf is so far off that a point as near as
the k-th best found would have shown up with probability ``CONFIDENCE`` (SRS, Sun et
al., "SRS: Solving c-Approximate Nearest Neighbor Queries", 2014).

At scale: the kd-tree has two storeys.  The upper one, fitted on a bounded sample, deals
all rows into cells of about ``CELL`` rows (a crowded cell is split by a hash); each cell
has its own tree.  A query first searches its home cell, which bounds its k-th
distance; the same test then decides which other cells it must visit.  A task holds one
cell and at most ``QUERIES`` queries.  What is broadcast is the directory of cells: at
most ``MAX_CELLS`` boxes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut_lineage, unit_hash

DIMS = 8
LEAF = 64
CELL = 8192
QUERIES = 2048
MAX_CELLS = 1 << 14
SAMPLE = 50_000
CONFIDENCE = 0.97
_RESULT = "query_id long, vec_id long, score double"


def chi_square_cdf(x: float, m: int) -> float:
    """For an even number of degrees of freedom."""
    term, total = 1.0, 0.0
    for i in range(m // 2):
        total += term
        term *= (x / 2) / (i + 1)
    return 1.0 - math.exp(-x / 2) * total


def chi_square_quantile(p: float, m: int) -> float:
    low, high = 0.0, 1.0
    while chi_square_cdf(high, m) < p:
        high *= 2
    for _ in range(80):
        mid = (low + high) / 2
        low, high = (mid, high) if chi_square_cdf(mid, m) < p else (low, mid)
    return high


def kd_leaves(points: np.ndarray, size: int) -> list[np.ndarray]:
    """Indices of the leaves of a kd-tree: halves at the median of the widest side."""
    out, todo = [], [np.arange(len(points))]
    while todo:
        at = todo.pop()
        if len(at) <= size:
            out.append(at)
            continue
        p = points[at]
        dim = int(np.argmax(p.max(axis=0) - p.min(axis=0)))
        half = len(at) // 2
        order = np.argpartition(p[:, dim], half)
        todo += [at[order[half:]], at[order[:half]]]
    return out


def box_distance(q: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Squared distances from points (rows) to boxes (rows)."""
    out = np.zeros((len(q), len(low)))
    for d in range(q.shape[1]):
        gap = np.maximum(np.maximum(low[None, :, d] - q[:, None, d], q[:, None, d] - high[None, :, d]), 0.0)
        out += gap * gap
    return out


@dataclass
class Projection:
    """Fixed Gaussian projection of vectors (and of the coordinate that makes norms equal)."""

    dim: int
    top: float  # the largest squared norm
    dims: int = DIMS
    seed: int = 7

    def __post_init__(self):
        self.matrix = np.random.default_rng(self.seed).standard_normal((self.dim + 1, self.dims))

    def rows(self, x: np.ndarray) -> np.ndarray:
        extra = np.sqrt(np.maximum(self.top - (x * x).sum(axis=1), 0.0))
        return x @ self.matrix[:-1] + extra[:, None] * self.matrix[-1]

    def queries(self, q: np.ndarray) -> np.ndarray:
        return q @ self.matrix[:-1]


@dataclass
class TopTree:
    """Upper storey: a complete binary tree of splits."""

    dims: list[int]
    cuts: list[float]
    depth: int

    @classmethod
    def fit(cls, points: np.ndarray, depth: int) -> TopTree:
        dims, cuts, level = [], [], [np.arange(len(points))]
        for _ in range(depth):
            below = []
            for at in level:
                p = points[at]
                dim = int(np.argmax(p.std(axis=0))) if len(at) else 0
                cut = float(np.median(p[:, dim])) if len(at) else 0.0
                dims.append(dim)
                cuts.append(cut)
                right = p[:, dim] > cut if len(at) else np.zeros(0, bool)
                below += [at[~right], at[right]]
            level = below
        return cls(dims, cuts, depth)

    def cell(self, points: np.ndarray) -> np.ndarray:
        node = np.zeros(len(points), np.int64)
        dims, cuts = np.array(self.dims, np.int64), np.array(self.cuts)
        rows = np.arange(len(points))
        for _ in range(self.depth):
            node = 2 * node + 1 + (points[rows, dims[node]] > cuts[node])
        return node - ((1 << self.depth) - 1)


def _matrix(column, dim: int) -> np.ndarray:
    """Rows of a list column as float64."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def search_cell(x: np.ndarray, ids: np.ndarray, proj: np.ndarray, q: np.ndarray, q_ids: np.ndarray, q_proj: np.ndarray,
                bound: np.ndarray, top: float, k: int, stop: float) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """For each query ``(position, rows, scores)``: its best rows of the cell, ``k`` at most.

    ``bound`` is the score of the k-th best so far (-inf: none).  Each round verifies the
    next leaves of every query that has not passed the test; rounds double.
    """
    leaves = kd_leaves(proj, LEAF)
    low = np.stack([proj[a].min(axis=0) for a in leaves])
    high = np.stack([proj[a].max(axis=0) for a in leaves])
    gaps = box_distance(q_proj, low, high)
    order = np.argsort(gaps, axis=1)
    sorted_gaps = np.take_along_axis(gaps, order, axis=1)
    place = np.argsort(order, axis=1)  # when a query comes to a leaf
    scores = np.full((len(q), len(x)), -np.inf)
    norm = (q * q).sum(axis=1) + top
    best = bound.copy()
    active = np.arange(len(q))
    done, step = 0, 8
    while len(active) and done < len(leaves):
        near = np.maximum(norm[active] - 2 * best[active], 0.0) * stop  # the gap at which the test holds
        active = active[sorted_gaps[active, done] < np.where(np.isfinite(best[active]), near, np.inf)]
        if not len(active):
            break
        until = min(done + step, len(leaves))
        due = (place[active] >= done) & (place[active] < until)
        for j, rows in enumerate(leaves):
            who = active[due[:, j]]
            if len(who):
                scores[who[:, None], rows[None, :]] = q[who] @ x[rows].T
        scores[active[:, None], np.arange(len(x))[None, :]] = np.where(ids[None, :] == q_ids[active, None], -np.inf, scores[active])
        if len(x) > k:
            best[active] = np.maximum(best[active], np.partition(scores[active], len(x) - k, axis=1)[:, len(x) - k])
        done, step = until, 2 * step
    out = []
    for i in range(len(q)):
        # the same sum whatever the block, so that equal vectors tie exactly
        at = np.flatnonzero((scores[i] >= best[i] - 1e-9 * max(norm[i], 1.0)) & np.isfinite(scores[i]))
        if len(at):
            exact = (x[at] * q[i]).sum(axis=1)
            keep = np.lexsort((ids[at], -exact))[:k]
            out.append((i, at[keep], exact[keep]))
    return out


def _valid(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """Rows that take part: an id, and a vector that is not zero and has finite components only."""
    v = F.col("vec")
    good = F.forall(v, lambda c: c.isNotNull() & (F.abs(c) < float("inf")) & ~F.isnan(c)) & F.exists(v, lambda c: c != 0)
    rows = df.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).alias("vec"))
    return rows.filter(F.col("vec_id").isNotNull() & v.isNotNull() & (F.size("vec") > 0)).filter(good)


def nearest(df: DataFrame, every: int = 20, k: int = 20, id_col: str = "vec_id", vec_col: str = "embedding",
            cell_rows: int = CELL, confidence: float = CONFIDENCE) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the ``k`` rows of largest inner product for every
    row whose id is divisible by ``every``, ties to the smaller id.

    Null, zero or non-finite vectors, rows without an id, and vectors of another length
    than most take no part.  A query never finds rows of its own id; a row repeated is a
    candidate each time, a query repeated is asked once.  No vectors, no result.
    """
    spark = df.sparkSession
    rows = _valid(df, id_col, vec_col)
    lengths = rows.groupBy(F.size("vec").alias("dim")).agg(F.count("*").alias("n"), F.max(F.aggregate("vec", F.lit(0.0), lambda a, c: a + c.cast("double") * c.cast("double"))).alias("top"))
    head = lengths.orderBy(F.desc("n"), "dim").first()
    if head is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    dim, n = head.dim, head.n
    project = Projection(dim, float(head.top))
    rows = rows.filter(F.size("vec") == dim)
    sample = rows.filter(unit_hash(F.col("vec_id"), seed=3) * n < SAMPLE).select("vec").toArrow()  # SAMPLE rows, about
    depth = max(0, min(math.ceil(math.log2(max(n / cell_rows, 1))), int(math.log2(MAX_CELLS))))
    points = project.rows(_matrix(sample.column(0), dim)) if sample.num_rows else np.zeros((0, DIMS))
    tree = TopTree.fit(points, depth)
    kind = dict(rows.dtypes)["vec"]

    def locate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = _matrix(b.column(1), dim)
            p = project.rows(x)
            pq = project.queries(x)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(tree.cell(p), pa.int32()), pa.array(tree.cell(pq), pa.int32()),
                                              pa.array(list(p), pa.list_(pa.float64()))], ["vec_id", "vec", "cell", "home", "proj"])

    located = rows.mapInArrow(locate, f"vec_id long, vec {kind}, cell int, home int, proj array<double>")
    box = [f(F.col("proj")[d]).alias(f"{name}{d}") for name, f in (("low", F.min), ("high", F.max)) for d in range(DIMS)]
    located = cut_lineage(located)
    cells = located.groupBy("cell").agg(F.count("*").alias("n"), *box).orderBy("cell").toPandas()  # MAX_CELLS rows at most
    parts = np.ceil(cells["n"].to_numpy() / cell_rows).astype(int)
    low = cells[[f"low{d}" for d in range(DIMS)]].to_numpy()
    high = cells[[f"high{d}" for d in range(DIMS)]].to_numpy()
    numbers = cells["cell"].to_numpy()
    directory = spark.sparkContext.broadcast((numbers, parts, low, high))
    crowded = {int(c): int(p) for c, p in zip(numbers, parts) if p > 1}
    split = F.coalesce(F.create_map(*[F.lit(z) for kv in crowded.items() for z in kv])[F.col("cell")], F.lit(1)) if crowded else F.lit(1)
    base = located.select("vec_id", "vec", "cell", F.pmod(F.xxhash64("vec_id", "proj"), split).cast("int").alias("part"), "proj")

    asked = located.filter(F.col("vec_id") % every == 0).select("vec_id", "vec", "home").dropDuplicates(["vec_id", "vec"])
    asked = cut_lineage(asked.withColumnRenamed("vec_id", "query_id"))
    blocks = max(1, math.ceil(asked.count() / QUERIES))
    stop = chi_square_quantile(confidence, DIMS)
    top = project.top

    def routed(first: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            """The home cell's nearest part of a query, or all other parts that the test does not rule out."""
            numbers, parts, low, high = directory.value
            for b in batches:
                ids, vec, home, bound = b.column(0), b.column(1), b.column(2).to_numpy(), b.column(3).to_numpy(zero_copy_only=False)
                q = _matrix(vec, dim)
                gaps = box_distance(project.queries(q), low, high)
                # the home cell may be empty of rows: then the nearest box is home
                at = np.searchsorted(numbers, home)
                own = np.where((at < len(numbers)) & (numbers[np.minimum(at, len(numbers) - 1)] == home), np.minimum(at, len(numbers) - 1), gaps.argmin(axis=1))
                mine = ids.to_numpy() % parts[own]
                rows, cell, part = [], [], []
                if first:
                    rows, cell, part = np.arange(len(q)), numbers[own], mine
                else:
                    known = np.isfinite(bound)
                    limit = np.where(known, np.maximum((q * q).sum(axis=1) + top - 2 * np.where(known, bound, 0.0), 0.0) * stop, np.inf)
                    i, c = np.nonzero(gaps < limit[:, None])
                    i, c, p = np.repeat(i, parts[c]), np.repeat(c, parts[c]), np.concatenate([np.arange(x) for x in parts[c]] or [np.zeros(0, int)])
                    other = (c != own[i]) | (p != mine[i])
                    rows, cell, part = i[other], numbers[c[other]], p[other]
                take = pa.array(rows, pa.int64())
                yield pa.RecordBatch.from_arrays([ids.take(take), vec.take(take), b.column(3).take(take), pa.array(cell, pa.int32()), pa.array(part, pa.int32())],
                                                 ["query_id", "vec", "bound", "cell", "part"])
        return run

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        """One cell part (CELL rows, about) and a block of queries (QUERIES, about)."""
        found: list[tuple] = []
        if left.num_rows and right.num_rows:
            x, p, ids = _matrix(right.column("vec"), dim), _matrix(right.column("proj"), DIMS), right.column("vec_id").to_numpy()
            for at in range(0, left.num_rows, 256):
                some = left.slice(at, 256)
                q, q_ids = _matrix(some.column("vec"), dim), some.column("query_id").to_numpy()
                got = search_cell(x, ids, p, q, q_ids, project.queries(q), some.column("bound").to_numpy(), top, k, stop)
                found += [(np.full(len(r), q_ids[i]), ids[r], s) for i, r, s in got]
        cols = [np.concatenate([np.zeros(0, t), *(f[i] for f in found)]) for i, t in enumerate((np.int64, np.int64, np.float64))]
        return pa.table({"query_id": pa.array(cols[0]), "vec_id": pa.array(cols[1]), "score": pa.array(cols[2])})

    def search(queries: DataFrame, first: bool) -> DataFrame:
        route = queries.mapInArrow(routed(first), f"query_id long, vec {kind}, bound double, cell int, part int")
        route = route.withColumn("block", F.pmod(F.xxhash64("query_id"), F.lit(blocks)).cast("int"))
        copies = base.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
        keys = ["cell", "part", "block"]
        return route.groupBy(*keys).cogroup(copies.groupBy(*keys)).applyInArrow(meet, _RESULT)

    none = F.lit(float("-inf"))
    home = cut_lineage(search(asked.withColumn("bound", none), True))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    bounds = home.withColumn("r", F.row_number().over(order)).filter(F.col("r") == k).select("query_id", F.col("score").alias("bound"))
    rest = asked.join(bounds, "query_id", "left").select("query_id", "vec", "home", F.coalesce("bound", none).alias("bound"))
    both = home.unionByName(search(rest, False))
    return (both.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))
