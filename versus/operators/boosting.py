"""Histogram gradient boosting on Spark (#128, #129).

Features are cut once into at most ``max_bins`` quantile bins.  The binned rows are stored in
blocks (bytes, labels, margins) that NumPy reads without a copy.  A pass sends the tree so
far to every block and adds up, for each open leaf, gradients, Hessians and counts by
feature and bin; the histograms, bounded by leaves x features x bins and independent of the
rows, meet by leaf and feature block and come to the driver, which chooses the splits.

* The tree grows best first: the leaf of the largest gain is split until ``num_leaves`` or
  ``max_depth`` is reached; without a leaf budget every leaf that gains is split, which is
  growth by depth.  Children whose gain the queue will ask for are measured
  together, so a tree takes about as many passes as it is deep, and the result is that of one
  split at a time.
* Only the smaller child is measured; its sibling is the parent less the child.
* ``reg_alpha`` and ``reg_lambda`` penalise leaf values inside the gain, ``gamma`` is the least gain,
  ``min_child_samples`` and ``min_child_weight`` bound a leaf.
* A missing value goes to the side that gains more.
* The pass of a tree's root also takes the validation log loss of the trees before: after
  ``early_stopping_rounds`` trees without a better one the best number of trees is kept.
* Rows and columns are drawn anew for every tree, rows by a hash of (row, tree).
* Rows that fit one task are boosted in one: it holds the blocks and deals their rows to a process for each core
  of its executor, so a tree costs no job.  More rows (``ONE_TASK_BYTES``) take the passes above.
* A finished tree is added to the margins once: the moved blocks are kept by the executors for the
  passes of the next tree, and stored every ``REFRESH`` trees, which bounds what a lost one repeats.
"""

from __future__ import annotations

import heapq
import json
import multiprocessing
import pickle
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..constants import SEED
from ..session import cut_lineage

MISSING = 0          # bin of NULL and NaN
FEATURE_BLOCK = 32   # features of one histogram row
DRIVER_PARTS = 32    # up to so many partial histograms a leaf are added by the driver, more by Spark
ROWS_PER_PART = 200_000
ROWS_PER_CORE = 20_000   # rows that are worth a task of their own while cores are free
REFRESH = 25         # trees between two stored margins
ONE_TASK_BYTES = 400_000_000  # binned rows, labels, weights, keys and margins that one task may hold


@dataclass
class Tree:
    """Nodes by number, the root first: feature, last bin on the left, side of missing values, children, value."""

    feature: list = field(default_factory=list)
    bin: list = field(default_factory=list)
    missing_left: list = field(default_factory=list)
    left: list = field(default_factory=list)
    right: list = field(default_factory=list)
    value: list = field(default_factory=list)

    def add(self, value: float) -> int:
        for part, v in ((self.feature, -1), (self.bin, -1), (self.missing_left, True), (self.left, -1), (self.right, -1), (self.value, value)):
            part.append(v)
        return len(self.feature) - 1

    def leaves(self, x: np.ndarray) -> np.ndarray:
        """Leaf of each binned row."""
        at = np.zeros(len(x), dtype=np.int32)
        feature, cut = np.asarray(self.feature), np.asarray(self.bin)
        missing, left, right = np.asarray(self.missing_left), np.asarray(self.left), np.asarray(self.right)
        open_rows = np.flatnonzero(feature[at] >= 0)
        while len(open_rows):
            node = at[open_rows]
            b = x[open_rows, feature[node]]
            goes_left = np.where(b == MISSING, missing[node], b <= cut[node])
            at[open_rows] = np.where(goes_left, left[node], right[node])
            open_rows = open_rows[feature[at[open_rows]] >= 0]
        return at


    def add_to(self, out: np.ndarray, x: np.ndarray) -> None:
        """Add the value of each row's leaf to ``out``; ``x`` has the binned rows as columns."""
        leaf, value = np.asarray(self.feature) < 0, np.asarray(self.value, dtype=np.float64)
        feature = np.where(leaf, 0, self.feature)
        shift = (~leaf & ~np.asarray(self.missing_left, dtype=bool)).astype(np.uint8)  # a missing value, 0, becomes the largest
        cut = np.where(leaf, 255, np.asarray(self.bin) - shift).astype(np.uint8)
        own = np.arange(len(leaf))
        child = np.stack([np.where(leaf, own, self.left), np.where(leaf, own, self.right)], axis=1).ravel()
        deep, level = 0, [0]
        while level := [c for n in level if not leaf[n] for c in (self.left[n], self.right[n])]:
            deep += 1
        for at in range(0, x.shape[1], 16_384):
            values = np.ascontiguousarray(x[:, at:at + 16_384])
            width, values = values.shape[1], values.ravel()
            base, node = np.arange(width), np.zeros(width, np.int64)
            for _ in range(deep):
                b = values.take(feature.take(node) * width + base) - shift.take(node)
                node = child.take(2 * node + (b > cut.take(node)))
            out[at:at + width] += value.take(node)


@dataclass
class Boosted:
    """A fitted model with the interface of ``models.FittedModel``."""

    name: str
    features: list
    edges: list          # per feature: upper ends of its bins
    base: float
    trees: list
    gains: np.ndarray    # total gain by feature
    params: dict = field(default_factory=dict)
    threshold: float = 0.5
    link: str = "sigmoid"

    def margins(self, values: np.ndarray) -> np.ndarray:
        x = np.ascontiguousarray(bin_values(values, self.edges).T)
        out = np.full(x.shape[1], self.base)
        for t in self.trees:
            t.add_to(out, x)
        return out

    def score(self, df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
        @F.pandas_udf("double")
        def margin(batches: Iterator[pd.DataFrame]) -> Iterator[pd.Series]:
            for pdf in batches:
                yield pd.Series(self.margins(pdf.to_numpy(dtype=np.float64, na_value=np.nan)))

        cols = F.struct(*[F.col(c).cast("double").alias(f"f{i}") for i, c in enumerate(self.features)])
        out = df.select(*keep, margin(cols).alias("margin"))
        out = out.withColumn("score", F.lit(1.0) / (F.lit(1.0) + F.exp(-F.col("margin"))))
        return out.withColumn("pred", (F.col("score") >= self.threshold).cast("int"))

    def importances(self) -> list[tuple[str, float]]:
        total = self.gains.sum()
        v = self.gains / total if total > 0 else self.gains
        return sorted(zip(self.features, map(float, v)), key=lambda t: -t[1])

    def to_json(self) -> str:
        return json.dumps({"name": self.name, "features": self.features, "edges": [list(map(float, e)) for e in self.edges], "base": self.base,
                           "trees": [vars(t) for t in self.trees], "gains": list(map(float, self.gains)), "params": self.params})

    @staticmethod
    def from_json(text: str) -> Boosted:
        d = json.loads(text)
        return Boosted(d["name"], d["features"], [np.array(e) for e in d["edges"]], d["base"], [Tree(**t) for t in d["trees"]], np.array(d["gains"]), d["params"])


def bin_values(values: np.ndarray, edges: Sequence[np.ndarray]) -> np.ndarray:
    """Bins of raw values: 0 for missing ones, else 1 + the first bin whose end is not below the value."""
    out = np.empty(values.shape, dtype=np.uint8)
    for j, e in enumerate(edges):
        out[:, j] = np.where(np.isnan(values[:, j]), MISSING, 1 + np.searchsorted(e, values[:, j]))
    return out


def quantile_edges(train: DataFrame, features: Sequence[str], max_bins: int, accuracy: int = 10_000) -> list[np.ndarray]:
    """Ends of all bins but the last, from one sketch of all features; they are values of the data."""
    probs = [i / (max_bins - 1) for i in range(1, max_bins - 1)]
    cols = [F.col(c).cast("double") for c in features]
    row = train.agg(*[F.percentile_approx(F.when(~F.isnan(c), c), probs, accuracy).alias(f"q{i}") for i, c in enumerate(cols)]).first()
    return [np.unique(np.array(row[f"q{i}"] or [], dtype=np.float64)) for i in range(len(cols))]


def _unit(keys: np.ndarray, tree: int, seed: int) -> np.ndarray:
    """A number in [0, 1) for each (row key, tree): splitmix64."""
    with np.errstate(over="ignore"):
        z = keys.view(np.uint64) + np.uint64((seed * 1_000_003 + tree + 1) * 0x9E3779B97F4A7C15 & (2**64 - 1))
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        z = z ^ (z >> np.uint64(31))
    return (z >> np.uint64(11)).astype(np.float64) / float(1 << 53)


_BLOCK = "rows int, x binary, y binary, w binary, key binary, val binary, m binary"
_HIST = "slot int, block int, h binary"


def _blocks(frame: DataFrame, features: Sequence[str], target: str, edges: list, weight: str | None, base: float) -> DataFrame:
    """Binned rows, an Arrow batch a record."""
    key = F.xxhash64(*[F.col(c) for c in frame.columns if c != "_is_val"])
    w = F.col(weight).cast("double") if weight else F.lit(1.0)
    cols = [F.col(c).cast("double").alias(f"f{i}") for i, c in enumerate(features)]
    src = frame.select(*cols, F.col(target).cast("double").alias("y"), w.alias("w"), key.alias("key"), F.col("_is_val").alias("val"))
    k = len(features)

    def pack(batches):
        for b in batches:
            if not b.num_rows:
                continue
            raw = np.column_stack([b.column(i).to_numpy(zero_copy_only=False) for i in range(k)]).astype(np.float64) if k else np.empty((b.num_rows, 0))
            y, w, key, val = (b.column(c).to_numpy(zero_copy_only=False) for c in ("y", "w", "key", "val"))
            parts = [bin_values(raw, edges), y.astype(np.float64), w.astype(np.float64), key.astype(np.int64), val.astype(np.uint8), np.full(b.num_rows, base)]
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows], pa.int32()), *[pa.array([p.tobytes()], pa.binary()) for p in parts]],
                                             names=["rows", "x", "y", "w", "key", "val", "m"])

    return src.mapInArrow(pack, _BLOCK)


def _read(batch: pa.RecordBatch, k: int) -> Iterator[tuple]:
    kinds = {"x": np.uint8, "y": np.float64, "w": np.float64, "key": np.int64, "val": np.uint8, "m": np.float64}
    for i in range(batch.num_rows):
        got = {c: np.frombuffer(batch.column(c)[i].as_buffer(), dtype=t) for c, t in kinds.items()}
        yield got["x"].reshape(-1, k), got["y"], got["w"], got["key"], got["val"].astype(bool), got["m"]


def _histograms(blocks: DataFrame, k: int, tree: Tree, slots: dict, columns: np.ndarray, n_bins: int,
                number: int, subsample: float, seed: int, parts: int, with_loss: bool) -> tuple[dict, tuple[float, float]]:
    """(gradient, Hessian, count) by slot, column and bin, of the leaves ``slots`` (leaf -> slot) of ``tree``; and
    ``with_loss`` loss and weight of the validation rows before this tree."""
    n_blocks = -(-len(columns) // FEATURE_BLOCK)

    def scan(batches):
        total = np.zeros((len(slots), len(columns), n_bins, 3))
        loss = np.zeros(2)
        lookup = np.full(max(len(tree.feature), 1), -1)
        for leaf, slot in slots.items():
            lookup[leaf] = slot
        for batch in batches:
            for x, y, w, key, val, m in _read(batch, k):
                if with_loss and val.any():
                    loss += [float((w[val] * np.logaddexp(0.0, np.where(y[val] > 0.5, -m[val], m[val]))).sum()), float(w[val].sum())]
                use = ~val
                if subsample < 1.0:
                    use &= _unit(key, number, seed) < subsample
                rows = np.flatnonzero(use)
                slot = lookup[tree.leaves(x[rows])]
                rows, slot = rows[slot >= 0], slot[slot >= 0]
                bins = np.ascontiguousarray(x[rows].T)
                p = 1.0 / (1.0 + np.exp(-m[rows]))
                g, h, at = w[rows] * (p - y[rows]), w[rows] * p * (1 - p), slot.astype(np.int64) * n_bins
                size = len(slots) * n_bins
                for j, c in enumerate(columns):
                    idx = at + bins[c]
                    for i, v in enumerate((g, h, None)):
                        total[:, j, :, i] += np.bincount(idx, weights=v, minlength=size).reshape(len(slots), n_bins)
        out = [(-1, 0, loss.tobytes())]
        for s in range(len(slots)):
            out += [(s, b, total[s, b * FEATURE_BLOCK:(b + 1) * FEATURE_BLOCK].tobytes()) for b in range(n_blocks)]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.int32(), pa.int32(), pa.binary()))], names=["slot", "block", "h"])

    found = blocks.mapInArrow(scan, _HIST)
    if parts > DRIVER_PARTS:
        def added(table: pa.Table) -> pa.Table:
            total = sum(np.frombuffer(v.as_buffer()) for v in table.column("h"))
            return pa.table({"slot": table.column("slot")[:1], "block": table.column("block")[:1], "h": pa.array([total.tobytes()], pa.binary())})
        found = found.groupBy("slot", "block").applyInArrow(added, _HIST)
    hist: dict = {}
    for r in found.collect():  # leaves x feature blocks, times DRIVER_PARTS at most
        v = np.frombuffer(r.h)
        hist[r.slot, r.block] = hist[r.slot, r.block] + v if (r.slot, r.block) in hist else v
    loss = hist.pop((-1, 0), np.zeros(2))
    whole = {leaf: np.concatenate([hist[s, b].reshape(-1, n_bins, 3) for b in range(n_blocks)]) for leaf, s in slots.items()} if len(hist) else \
        {leaf: np.zeros((len(columns), n_bins, 3)) for leaf in slots}
    return whole, (float(loss[0]), float(loss[1]))


class _Share:
    """Some of the rows, held by a process: what ``_histograms`` finds in a pass, without one."""

    def __init__(self, k: int, parts: Sequence[tuple]):
        x, self.y, self.w, self.key, self.val, self.m = (np.concatenate(c) for c in zip(*parts)) if parts else \
            (np.empty((0, k), np.uint8), np.empty(0), np.empty(0), np.empty(0, np.int64), np.empty(0, bool), np.empty(0))
        self.x = np.ascontiguousarray(x.T)

    def root(self, columns: np.ndarray, n_bins: int, number: int, subsample: float, seed: int) -> tuple[np.ndarray, np.ndarray]:
        """Histogram of all drawn rows; loss and weight of the validation rows."""
        val = np.flatnonzero(self.val)
        loss = np.array([(self.w[val] * np.logaddexp(0.0, np.where(self.y[val] > 0.5, -self.m[val], self.m[val]))).sum(), self.w[val].sum()])
        use = ~self.val
        if subsample < 1.0:
            use &= _unit(self.key, number, seed) < subsample
        rows = np.flatnonzero(use)
        p, w = 1.0 / (1.0 + np.exp(-self.m[rows])), self.w[rows]
        self.pull, self.bins, self.n_bins = w * (p - self.y[rows]) + 1j * (w * p * (1 - p)), {int(c): self.x[c].take(rows) for c in columns}, n_bins
        self.rows = {0: np.arange(len(rows))}
        return self._histogram(0), loss

    def _histogram(self, node: int) -> np.ndarray:
        rows = self.rows[node]
        pull, out = self.pull.take(rows), np.empty((len(self.bins), self.n_bins, 3))
        for j, b in enumerate(self.bins.values()):
            b = b.take(rows).astype(np.int64)
            both = np.zeros(self.n_bins, complex)
            np.add.at(both, b, pull)  # gradient and Hessian at once
            out[j, :, 0], out[j, :, 1], out[j, :, 2] = both.real, both.imag, np.bincount(b, minlength=self.n_bins)
        return out

    def leaves(self, tree: Tree, leaves: Sequence[int]) -> np.ndarray:
        """Histograms of leaves of a tentative tree."""
        parents = {c: n for n in range(len(tree.left)) if tree.left[n] >= 0 for c in (tree.left[n], tree.right[n])}
        for leaf in leaves:
            todo = [leaf]
            while todo[-1] not in self.rows:
                todo.append(parents[todo[-1]])
            for node in reversed(todo[1:]):
                rows, b = self.rows[node], self.bins[tree.feature[node]].take(self.rows[node])
                goes_left = b <= tree.bin[node]
                if not tree.missing_left[node]:
                    goes_left &= b != MISSING
                self.rows[tree.left[node]], self.rows[tree.right[node]] = rows[goes_left], rows[~goes_left]
        return np.stack([self._histogram(leaf) for leaf in leaves])

    def move(self, tree: Tree) -> None:
        """Add a finished tree to the margins."""
        tree.add_to(self.m, self.x)


def _serve(share: _Share, ours, others) -> None:
    for c in others:
        c.close()  # so that the end of the task's process is seen here
    while True:
        try:
            name, args = ours.recv()
        except EOFError:
            return
        ours.send(getattr(share, name)(*args))


class _Crew:
    """All rows, in shares of a process each; answers are added."""

    def __init__(self, k: int, parts: list, processes: int):
        if processes <= 1:
            self.alone, self.pipes, self.staff = _Share(k, parts), [], []
            return
        rows = np.cumsum([0, *[len(p[1]) for p in parts]])
        ends = [int(rows[-1]) * i // processes for i in range(processes + 1)]
        fork, self.alone, self.pipes, self.staff = multiprocessing.get_context("fork"), None, [], []
        for a, b in zip(ends, ends[1:]):
            own = [tuple(v[max(a - s, 0):b - s] for v in p) for p, s, e in zip(parts, rows, rows[1:]) if s < b and e > a]
            mine, theirs = fork.Pipe()
            self.staff.append(fork.Process(target=lambda own=own, theirs=theirs, others=[*self.pipes, mine]: _serve(_Share(k, own), theirs, others), daemon=True))
            self.staff[-1].start()
            theirs.close()
            self.pipes.append(mine)

    def ask(self, name: str, *args) -> list:
        if self.alone is not None:
            return [getattr(self.alone, name)(*args)]
        for p in self.pipes:
            p.send((name, args))
        return [p.recv() for p in self.pipes]

    def close(self) -> None:
        for p in self.pipes:
            p.close()
        for p in self.staff:
            p.join()


class _OneTask:
    """The passes of ``_boost`` inside a task."""

    def __init__(self, crew: _Crew, n_bins: int, subsample: float, seed: int):
        self.crew, self.n_bins, self.subsample, self.seed = crew, n_bins, subsample, seed

    def root(self, columns, number):
        found = self.crew.ask("root", columns, self.n_bins, number, self.subsample, self.seed)
        return sum(h for h, _ in found), sum(v for _, v in found)

    def leaves(self, tree, leaves, columns, number):
        return dict(zip(leaves, sum(self.crew.ask("leaves", tree, leaves))))

    def move(self, tree, number):
        self.crew.ask("move", tree)


class _Passes:
    """The passes of ``_boost`` as jobs over blocks."""

    def __init__(self, blocks: DataFrame, k: int, n_bins: int, subsample: float, seed: int, with_loss: bool):
        self.blocks, self.k, self.shape, self.with_loss = blocks, k, (n_bins, subsample, seed, blocks.rdd.getNumPartitions()), with_loss
        self.older = None  # kept blocks that the next pass still reads

    def _histograms(self, tree, slots, columns, number, with_loss):
        n_bins, subsample, seed, parts = self.shape
        return _histograms(self.blocks, self.k, tree, slots, columns, n_bins, number, subsample, seed, parts, with_loss)

    def root(self, columns, number):
        root = Tree()
        root.add(0.0)
        found, loss = self._histograms(root, {0: 0}, columns, number, self.with_loss)
        self.older = _release(self.older)
        return found[0], loss

    def leaves(self, tree, leaves, columns, number):
        return self._histograms(tree, {leaf: i for i, leaf in enumerate(leaves)}, columns, number, False)[0]

    def move(self, tree, number):
        moved = self.blocks.mapInArrow(_moved(self.k, tree), _BLOCK)
        if number % REFRESH == 0:
            moved = cut_lineage(moved)
            _release(self.blocks)
        else:
            moved, self.older = moved.persist(), self.blocks
        self.blocks = moved

    def close(self):
        _release(self.older)
        _release(self.blocks)


@dataclass(frozen=True)
class Growth:
    """What shapes a tree."""

    num_leaves: int | None
    max_depth: int | None
    learning_rate: float
    reg_alpha: float
    reg_lambda: float
    gamma: float
    min_child_samples: int
    min_child_weight: float

    def pull(self, g, h):
        """Gradient pulled in by ``reg_alpha``, squared over the Hessian: what a leaf gains."""
        t = np.sign(g) * np.maximum(np.abs(g) - self.reg_alpha, 0.0)
        with np.errstate(divide="ignore", invalid="ignore"):
            return np.where(h + self.reg_lambda > 0, t * t / (h + self.reg_lambda), 0.0)

    def value(self, g: float, h: float) -> float:
        t = np.sign(g) * max(abs(g) - self.reg_alpha, 0.0)
        return float(-self.learning_rate * t / (h + self.reg_lambda)) if h + self.reg_lambda > 0 else 0.0

    def best(self, hist: np.ndarray) -> tuple | None:
        """(gain, column, last bin on the left, missing left, left sums, right sums) of the best split; ties go to the
        first column, the first bin and missing on the left."""
        total = hist[0].sum(axis=0) if len(hist) else np.zeros(3)
        found = None
        for missing_left in (True, False):
            start = hist[:, 1:, :].cumsum(axis=1)
            left = start + hist[:, :1, :] if missing_left else start
            right = total[None, None, :] - left
            gain = 0.5 * (self.pull(left[..., 0], left[..., 1]) + self.pull(right[..., 0], right[..., 1]) - self.pull(total[0], total[1])) - self.gamma
            fits = np.ones(gain.shape, dtype=bool)
            for side in (left, right):
                fits &= (side[..., 2] >= max(self.min_child_samples, 1)) & (side[..., 1] >= self.min_child_weight)
            gain = np.where(fits, gain, -np.inf)
            if gain.size:
                j, b = np.unravel_index(int(gain.argmax()), gain.shape)
                if gain[j, b] > 1e-10 and (found is None or gain[j, b] > found[0] + 1e-12):
                    found = (float(gain[j, b]), int(j), int(b) + 1, missing_left, left[j, b].copy(), right[j, b].copy())
        return found


def grow(root: np.ndarray, measure, columns: np.ndarray, growth: Growth, gains: np.ndarray) -> Tree:
    """A tree grown best first from its root's histogram; ``measure(tree, leaves)`` gives the histograms of
    leaves of a tentative tree."""
    # tentative tree: every split that the queue has asked for, measured or not
    draft = Tree()
    draft.add(0.0)
    hists, splits, depth, sums = {0: root}, {}, {0: 0}, {0: root[0].sum(axis=0) if len(root) else np.zeros(3)}
    budget = growth.num_leaves or (1 << 62)

    def split_of(node):
        if node not in splits:
            deep = growth.max_depth is not None and growth.max_depth > 0 and depth[node] >= growth.max_depth
            splits[node] = None if deep else growth.best(hists[node])
        return splits[node]

    while True:
        chosen, unmeasured, queue, leaves = [], [], [], 1
        if split_of(0):
            heapq.heappush(queue, (-splits[0][0], 0))
        while queue and leaves < budget:
            node = heapq.heappop(queue)[1]
            chosen.append(node)
            leaves += 1
            if draft.left[node] < 0:
                _, j, b, missing_left, left, right = splits[node]
                draft.feature[node], draft.bin[node], draft.missing_left[node] = int(columns[j]), b, missing_left
                for side, part in (("left", left), ("right", right)):
                    child = draft.add(0.0)
                    getattr(draft, side)[node] = child
                    depth[child], sums[child] = depth[node] + 1, part
            for child in (draft.left[node], draft.right[node]):
                if child in hists:
                    if split_of(child):
                        heapq.heappush(queue, (-splits[child][0], child))
            if draft.left[node] not in hists and not (growth.max_depth and depth[node] + 1 >= growth.max_depth):
                unmeasured.append(node)
        # children of the last splits matter only while there is budget for a split of theirs
        if not unmeasured or leaves >= budget and unmeasured == chosen[-1:]:
            break
        small = {n: min(draft.left[n], draft.right[n], key=lambda c: (sums[c][2], c)) for n in unmeasured}
        found = measure(draft, sorted(small.values()))
        for n, s in small.items():
            other = draft.right[n] if s == draft.left[n] else draft.left[n]
            hists[s], hists[other] = found[s], hists[n] - found[s]
    # the chosen splits alone, renumbered
    kept, out = set(chosen), Tree()
    numbers, todo = {0: out.add(0.0)}, [0]
    while todo:
        node = todo.pop(0)
        at = numbers[node]
        if node in kept:
            out.feature[at], out.bin[at], out.missing_left[at] = draft.feature[node], draft.bin[node], draft.missing_left[node]
            gains[draft.feature[node]] += splits[node][0]
            for side in ("left", "right"):
                child = getattr(draft, side)[node]
                numbers[child] = out.add(0.0)
                getattr(out, side)[at] = numbers[child]
                todo.append(child)
        else:
            out.value[at] = growth.value(float(sums[node][0]), float(sums[node][1]))
    return out


def fit_boosted(train: DataFrame, features: Sequence[str], target: str, val: DataFrame | None = None, n_estimators: int = 300,
                learning_rate: float = 0.05, num_leaves: int | None = None, max_depth: int | None = None, subsample: float = 1.0,
                colsample_bytree: float = 1.0, reg_alpha: float = 0.0, reg_lambda: float = 0.0, gamma: float = 0.0,
                min_child_samples: int = 1, min_child_weight: float = 0.0, early_stopping_rounds: int = 0,
                max_bins: int = 64, seed: int = SEED, weight: str | None = None, name: str = "boosted") -> Boosted:
    """Boosted trees on the log loss; see the module's text.  Without ``val`` or with
    ``early_stopping_rounds`` 0 all ``n_estimators`` trees are kept.  A tree that cannot split ends the fit."""
    if not 3 <= max_bins <= 255:
        raise ValueError("max_bins must be between 3 and 255")
    feats, k = list(features), len(features)
    edges = quantile_edges(train, feats, max_bins)
    w = F.col(weight).cast("double") if weight else F.lit(1.0)
    mean = train.agg((F.sum(w * F.col(target).cast("double")) / F.sum(w)).alias("p"), F.count(F.lit(1)).alias("n")).first()
    p = min(max(float(mean.p or 0.5), 1e-6), 1 - 1e-6)
    base = float(np.log(p / (1 - p)))
    need = [*feats, target, *([weight] if weight else [])]
    ids = [c for c in train.columns if c not in need and (val is None or c in val.columns)]
    frame = train.select(*need, *ids, F.lit(False).alias("_is_val"))
    if val is not None:
        frame = frame.unionByName(val.select(*need, *ids, F.lit(True).alias("_is_val")))
    cores = train.sparkSession.sparkContext.defaultParallelism
    parts = max(1, -(-mean.n // ROWS_PER_PART), min(-(-mean.n // ROWS_PER_CORE), cores))
    blocks = cut_lineage(_blocks(frame.coalesce(parts), feats, target, edges, weight, base))
    growth = Growth(num_leaves, max_depth, learning_rate, reg_alpha, reg_lambda, gamma, min_child_samples, min_child_weight)
    n_bins = 2 + max((len(e) for e in edges), default=0)
    patience = early_stopping_rounds if val is not None else 0
    rounds = (k, n_estimators, max(1, int(round(colsample_bytree * k))), seed, growth, patience)
    rows = blocks.agg(F.sum("rows")).first()[0] or 0
    if rows * (k + 60) <= ONE_TASK_BYTES:
        trees, kept_gains, losses, best = _in_one_task(blocks, k, n_bins, subsample, seed, rounds, rows)
    else:
        passes = _Passes(blocks, k, n_bins, subsample, seed, bool(patience))
        trees, kept_gains, losses, best = _boost(passes, *rounds)
        passes.close()
    n = best[1] if patience and losses else len(trees)
    return Boosted(name, feats, edges, base, trees[:n], kept_gains[n - 1] if n else np.zeros(k),
                   {"trees": n, "grown": len(trees), "learning_rate": learning_rate, "num_leaves": num_leaves, "max_depth": max_depth, "reg_alpha": reg_alpha,
                    "reg_lambda": reg_lambda, "early_stopping_rounds": early_stopping_rounds, "val_losses": losses})


def _boost(passes, k: int, n_estimators: int, n_columns: int, seed: int, growth: Growth, patience: int) -> tuple[list[Tree], list, list, tuple]:
    """(trees, gains by feature after each, validation losses, the least of them and its number of trees)."""
    rng = np.random.default_rng(seed)
    trees, gains, losses, kept_gains = [], np.zeros(k), [], []
    best = (float("inf"), 0)
    for number in range(n_estimators + 1):
        columns = np.sort(rng.choice(k, n_columns, replace=False)) if n_columns < k else np.arange(k)
        last = number == n_estimators
        if last and not patience:
            break
        root, loss = passes.root(columns[:1] if last else columns, number)
        if patience and loss[1] > 0:
            losses.append(float(loss[0] / loss[1]))
            if losses[-1] < best[0]:
                best = (losses[-1], number)
            elif number - best[1] >= patience:
                break
        if last:
            break
        tree = grow(root, lambda draft, leaves, columns=columns, number=number: passes.leaves(draft, leaves, columns, number), columns, growth, gains)
        if len(tree.feature) == 1:
            break
        trees.append(tree)
        kept_gains.append(gains.copy())
        passes.move(tree, len(trees))
    return trees, kept_gains, losses, best


def _in_one_task(blocks: DataFrame, k: int, n_bins: int, subsample: float, seed: int, rounds: tuple, rows: int) -> tuple:
    """``_boost`` in one task, by as many processes as its executor has cores."""
    sc = blocks.sparkSession.sparkContext
    executors = sc._jsc.sc().getExecutorMemoryStatus().size()
    cores = sc.defaultParallelism // max(executors - (0 if (sc.master or "").startswith("local[") or sc.master == "local" else 1), 1)
    processes = max(1, min(cores, rows // ROWS_PER_CORE))

    def run(batches):
        crew = _Crew(k, [part for batch in batches for part in _read(batch, k)], processes)
        try:
            done = _boost(_OneTask(crew, n_bins, subsample, seed), *rounds)
        finally:
            crew.close()
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(done)], pa.binary())], names=["done"])

    return pickle.loads(blocks.coalesce(1).mapInArrow(run, "done binary").first().done)


def _release(blocks: DataFrame | None) -> None:
    """Let the executors forget blocks that they keep."""
    if blocks is not None and blocks.is_cached:
        blocks.unpersist()


def _moved(k: int, tree: Tree):
    """The same blocks with the tree added to their margins."""
    def move(batches):
        value = np.asarray(tree.value)
        for batch in batches:
            m = [(m + value[tree.leaves(x)]).tobytes() for x, _, _, _, _, m in _read(batch, k)]
            yield batch.set_column(batch.schema.get_field_index("m"), "m", pa.array(m, pa.binary()))
    return move
