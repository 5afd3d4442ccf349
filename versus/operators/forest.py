"""Random forests on Spark, all trees a level a pass (#127).

Features are cut once into at most ``MAX_BINS`` bins and the binned rows stored in blocks that NumPy reads
without a copy.  A pass walks the rows of a part down one tree after the other and counts, for every node
of the tree's lowest level, bagged rows by drawn feature, bin and class.  The counts of a tree are
small (nodes x drawn features x bins) whatever the rows; those of all parts meet by tree in one
shuffle, where the best split of every node is chosen; only the splits come to the driver.  So a
forest takes as many passes as it is deep.

* Rows are drawn with replacement by a hash of (row, tree), Poisson(1) times each; the features of a
  node by a hash of (tree, node): nothing of either is stored, and reruns agree on any partitioning.
* Gini impurity of class weights, ``least`` bagged rows a child, and leaves of one parent and one
  prediction made one, as in ``pyspark.ml``; missing values go to the right, as they do there.
* The result is a native ``RandomForestClassificationModel``: the trees are written in its format and loaded.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import DecisionTreeClassifier, RandomForestClassificationModel, RandomForestClassifier
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage, ensure_checkpoint_dir
from .boosting import quantile_edges

MAX_BINS = 32
ROWS_PER_PART = 500_000
ROWS_PER_CORE = 20_000   # rows that are worth a task of their own while cores are free
CELLS = 1 << 22          # counts of a tree that a pass may hold
CHUNK = 16_384           # rows that walk together: their nodes stay in cache
_FOUND = np.dtype([("feature", "<i2"), ("bin", "<i2"), ("gain", "<f8"), ("n", "<i8", 2), ("left", "<i8", 2)])


@dataclass
class Grown:
    """A tree so far, a value a node, the root first.  A node without split leads to itself."""

    feature: np.ndarray = field(default_factory=lambda: np.zeros(1, np.int16))
    bin: np.ndarray = field(default_factory=lambda: np.full(1, 255, np.uint8))
    left: np.ndarray = field(default_factory=lambda: np.zeros(1, np.int32))     # the right child is the next one
    place: np.ndarray = field(default_factory=lambda: np.ones(1, np.int64))     # 1 for the root, 2 p and 2 p + 1 below p
    gain: np.ndarray = field(default_factory=lambda: np.full(1, -1.0))
    counts: np.ndarray = field(default_factory=lambda: np.zeros((1, 2), np.int64))
    open: np.ndarray = field(default_factory=lambda: np.zeros(1, np.int64))     # nodes to be split next

    def split(self, found: np.ndarray, least: int, deep: bool) -> None:
        """Split the open nodes as found; their children are open unless they are ``deep`` or pure."""
        self.counts[self.open] = found["n"]
        takes = found["feature"] >= 0
        nodes, found = self.open[takes], found[takes]
        first = len(self.left) + 2 * np.arange(len(nodes))
        self.feature[nodes], self.bin[nodes], self.left[nodes], self.gain[nodes] = found["feature"], found["bin"], first, found["gain"]
        new = np.arange(len(self.left), len(self.left) + 2 * len(nodes))
        counts = np.stack([found["left"], found["n"] - found["left"]], axis=1).reshape(-1, 2)
        self.place = np.append(self.place, np.stack([2 * self.place[nodes], 2 * self.place[nodes] + 1], axis=1).ravel())
        self.feature, self.bin = np.append(self.feature, np.zeros(len(new), np.int16)), np.append(self.bin, np.full(len(new), 255, np.uint8))
        self.left, self.gain = np.append(self.left, new.astype(np.int32)), np.append(self.gain, np.full(len(new), -1.0))
        self.counts = np.concatenate([self.counts, counts])
        self.open = new[:0] if deep else new[(counts.min(axis=1) > 0) & (counts.sum(axis=1) >= 2 * least)]


def _mixed(z: np.ndarray) -> np.ndarray:
    """splitmix64."""
    with np.errstate(over="ignore"):
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return z ^ (z >> np.uint64(31))


def _salt(seed: int, *parts: int) -> np.uint64:
    v = seed
    for p in parts:
        v = (v * 1_000_003 + p + 1) & (2**64 - 1)
    return np.uint64(v * 0x9E3779B97F4A7C15 & (2**64 - 1))


def _times() -> np.ndarray:
    """How often a row is drawn (Poisson, mean 1) by 16 random bits."""
    share, left, out = np.exp(-1.0), np.exp(-1.0), np.zeros(1 << 16, np.uint8)
    for n in range(1, 9):
        out[int(round(left * (1 << 16))):] = n
        share /= n
        left += share
    return out


def bags(keys: np.ndarray, group: int, seed: int) -> np.ndarray:
    """How often each row is drawn for the four trees of a group: four rows of counts."""
    with np.errstate(over="ignore"):
        bits = _mixed(keys.view(np.uint64) + _salt(seed, 0, group)).view(np.uint16).reshape(-1, 4)
    return _times()[bits.T]


def drawn_features(places: np.ndarray, tree: int, k: int, m: int, seed: int) -> np.ndarray:
    """``m`` of ``k`` features for each node of a tree."""
    with np.errstate(over="ignore"):
        z = _mixed(places.astype(np.uint64)[:, None] * np.uint64(k) + np.arange(k, dtype=np.uint64)[None, :] + _salt(seed, 1, tree))
    return np.sort(np.argsort(z, axis=1, kind="stable")[:, :m], axis=1)


def thresholds(train: DataFrame, features: Sequence[str]) -> list[np.ndarray]:
    """Upper ends of all bins but the last: between all values of a feature that has few, else quantiles."""
    k = len(features)

    def few(batches):
        seen = [np.empty(0)] * k
        for b in batches:
            for j in range(k):
                if len(seen[j]) <= MAX_BINS:
                    v = b.column(j).to_numpy(zero_copy_only=False).astype(np.float64)
                    seen[j] = np.union1d(seen[j], v[~np.isnan(v)])[:MAX_BINS + 1]
        yield pa.RecordBatch.from_arrays([pa.array(range(k), pa.int32()), pa.array([list(s) for s in seen], pa.list_(pa.float64()))], names=["i", "v"])

    values: list = [set() for _ in features]
    cols = [F.col(c).cast("double").alias(f"f{i}") for i, c in enumerate(features)]
    for r in train.select(*cols).mapInArrow(few, "i int, v array<double>").collect():  # 33 values a feature and part
        values[r.i].update(r.v)
    out = quantile_edges(train, features, MAX_BINS + 1)
    for j, v in enumerate(values):
        if len(v) <= MAX_BINS:
            v = np.sort(np.array(list(v), dtype=np.float64))
            out[j] = (v[:-1] + v[1:]) / 2
    return out


def _blocks(train: DataFrame, features: Sequence[str], target: str, edges: list, parts: int) -> DataFrame:
    """Bins, classes and keys of the rows, an Arrow batch a record, dealt evenly."""
    k = len(features)
    cols = [F.col(c).cast("double").alias(f"f{i}") for i, c in enumerate(features)]
    src = train.select(*cols, F.col(target).cast("double").alias("y"), F.xxhash64(*[F.col(c) for c in train.columns]).alias("key"))

    def pack(batches):
        for b in batches:
            if b.num_rows:
                x = np.empty((b.num_rows, k), np.uint8)
                for j in range(k):  # NaN is beyond every end
                    x[:, j] = np.searchsorted(edges[j], b.column(j).to_numpy(zero_copy_only=False).astype(np.float64))
                y, key = (b.column(c).to_numpy(zero_copy_only=False) for c in ("y", "key"))
                yield pa.RecordBatch.from_arrays([pa.array([v.tobytes()], pa.binary()) for v in (x, (y > 0.5).astype(np.uint8), key.astype(np.int64))], names=["x", "y", "key"])

    return cut_lineage(src.mapInArrow(pack, "x binary, y binary, key binary").repartition(parts))


def _count(x: np.ndarray, y: np.ndarray, bag: np.ndarray, tree: Grown, drawn: np.ndarray, level: int) -> np.ndarray:
    """Bagged rows by open node, drawn feature, bin and class."""
    k, m = x.shape[1], drawn.shape[1]
    feature, cut, left = tree.feature.astype(np.int64), tree.bin, tree.left.astype(np.int64)
    slots = np.full(len(left), -1)
    slots[tree.open] = np.arange(len(tree.open))
    drawn = [np.ascontiguousarray(drawn[:, j]) for j in range(m)]
    out, cells = np.zeros(len(tree.open) * m * MAX_BINS * 2, np.int32), MAX_BINS * 2
    for at in range(0, len(x), CHUNK):
        times = bag[at:at + CHUNK]
        rows = np.flatnonzero(times)
        values, base, node = x[at:at + CHUNK].ravel(), rows * k, np.zeros(len(rows), np.int64)
        for _ in range(level):
            node = left.take(node) + (values.take(base + feature.take(node)) > cut.take(node))
        slot = slots.take(node)
        if len(tree.open) < 1 << level:  # some rows have come to a leaf
            live = np.flatnonzero(slot >= 0)
            rows, base, slot = rows[live], base[live], slot[live]
        times, start = times[rows].astype(np.int32), slot * (m * cells) + y[at:at + CHUNK][rows]
        for j in range(m):
            b = values.take(base + drawn[j].take(slot))
            np.add.at(out, start + (b.astype(np.int64) * 2 + j * cells), times)
    return out


def _best(hist: np.ndarray, drawn: np.ndarray, weights: np.ndarray, least: int) -> np.ndarray:
    """The best split of every node; ties go to the first feature and bin."""
    n = hist[:, 0].sum(axis=1)
    left = hist.cumsum(axis=2)[:, :, :-1]
    right = n[:, None, None, :] - left

    def impure(c):  # weight x Gini impurity
        w = c * weights
        total = w.sum(axis=-1)
        with np.errstate(divide="ignore", invalid="ignore"):
            return np.where(total > 0, total - (w * w).sum(axis=-1) / total, 0.0)

    whole = (n * weights).sum(axis=1)
    gain = (impure(n)[:, None, None] - impure(left) - impure(right)) / np.maximum(whole, 1e-300)[:, None, None]
    fits = (left.sum(axis=-1) >= max(least, 1)) & (right.sum(axis=-1) >= max(least, 1))
    gain = np.where(fits, gain, -1.0).reshape(len(hist), -1)
    top = gain.argmax(axis=1)
    j, b = np.divmod(top, hist.shape[2] - 1)
    out, at = np.zeros(len(hist), _FOUND), np.arange(len(hist))
    out["gain"], out["bin"], out["n"], out["left"] = gain[at, top], b, n, left[at, j, b]
    out["feature"] = np.where(out["gain"] > 1e-14, drawn[at, j], -1)
    return out


def _level(blocks: DataFrame, trees: list[Grown], level: int, k: int, m: int, weights: np.ndarray, least: int, seed: int) -> dict[int, np.ndarray]:
    """The best splits of the open nodes of all trees, one pass."""
    numbers = [t for t, tree in enumerate(trees) if len(tree.open)]
    live = {t: Grown(trees[t].feature, trees[t].bin, trees[t].left, trees[t].place[trees[t].open], np.empty(0), np.empty(0), trees[t].open) for t in numbers}
    places = {t: tree.place for t, tree in live.items()}

    def scan(batches):
        rows = [[np.frombuffer(b.column(i)[r].as_buffer(), dtype=d) for i, d in enumerate((np.uint8, np.uint8, np.int64))] for b in batches for r in range(b.num_rows)]
        if not rows:
            return
        x, y, key = (np.concatenate(c) for c in zip(*rows))
        x, group, bag = x.reshape(-1, k), -1, None
        del rows
        for t, tree in live.items():
            if t // 4 != group:
                group, bag = t // 4, bags(key, t // 4, seed)
            found = _count(x, y, bag[t % 4], tree, drawn_features(places[t], t, k, m, seed), level)
            wide = found.max(initial=0) >= 1 << 16
            yield pa.RecordBatch.from_arrays([pa.array([t], pa.int32()), pa.array([wide]), pa.array([(found if wide else found.astype(np.uint16)).tobytes()], pa.binary())],
                                             names=["tree", "wide", "h"])

    def meet(table: pa.Table) -> pa.Table:
        t = table.column("tree")[0].as_py()
        hist = sum(np.frombuffer(h.as_buffer(), dtype=np.int32 if wide.as_py() else np.uint16).astype(np.int64) for h, wide in zip(table.column("h"), table.column("wide")))
        found = _best(hist.reshape(-1, m, MAX_BINS, 2), drawn_features(places[t], t, k, m, seed), weights, least)
        return pa.table({"tree": pa.array([t], pa.int32()), "found": pa.array([found.tobytes()], pa.binary())})

    counted = blocks.mapInArrow(scan, "tree int, wide boolean, h binary")
    got = counted.groupBy("tree").applyInArrow(meet, "tree int, found binary").collect()  # a split a node
    return {r.tree: np.frombuffer(r.found, dtype=_FOUND) for r in got}


def fit_forest(train: DataFrame, features: Sequence[str], target: str, rf: RandomForestClassifier,
               weights: dict) -> tuple[RandomForestClassificationModel, Votes]:
    """Grow the forest that ``rf`` describes; ``weights`` by class, 1 where none is given."""
    feats, k, seed = list(features), len(features), rf.getSeed()
    edges = thresholds(train, feats)
    n, cores = train.count(), train.sparkSession.sparkContext.defaultParallelism
    blocks = _blocks(train, feats, target, edges, max(1, -(-n // ROWS_PER_PART), min(-(-n // ROWS_PER_CORE), cores)))
    m, least, depth = int(np.ceil(np.sqrt(k))), rf.getMinInstancesPerNode(), rf.getMaxDepth()
    w = np.array([float(weights.get(0, 1.0)), float(weights.get(1, 1.0))])
    trees = [Grown() for _ in range(rf.getNumTrees())]
    most = max(1, CELLS // (m * MAX_BINS * 2))
    for level in range(depth):
        opened, found = [t.open for t in trees], [[] for _ in trees]
        for at in range(0, max(map(len, opened)), most):  # one pass unless trees are very deep
            for tree, nodes in zip(trees, opened):
                tree.open = nodes[at:at + most]
            got = _level(blocks, trees, level, k, m, w, least, seed)
            for t, tree in enumerate(trees):
                if len(tree.open):  # without any rows there is nothing to split
                    found[t].append(got.get(t, np.array([(-1, 0, -1.0, 0, 0)] * len(tree.open), _FOUND)))
        for tree, nodes, own in zip(trees, opened, found):
            tree.open = nodes
            if own:
                tree.split(np.concatenate(own), least, level + 1 == depth)
        if not any(len(t.open) for t in trees):
            break
    return _native(train, rf, trees, edges, w, k)


def _pruned(tree: Grown, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(nodes that stay, whether a node is a leaf, predictions): leaves of one parent that predict the same are one."""
    stats = tree.counts * weights
    says, leaf = (stats[:, 1] > stats[:, 0]).astype(np.float64), tree.left == np.arange(len(tree.left))
    depth = np.floor(np.log2(tree.place)).astype(int)
    for d in range(depth.max(initial=0) - 1, -1, -1):
        at = np.flatnonzero((depth == d) & ~leaf)
        a, b = tree.left[at], tree.left[at] + 1
        leaf[at[leaf[a] & leaf[b] & (says[a] == says[b])]] = True
    stays = np.zeros(len(leaf), bool)
    stays[0] = True
    for d in range(depth.max(initial=0)):
        at = np.flatnonzero((depth == d) & ~leaf & stays)
        stays[tree.left[at]] = stays[tree.left[at] + 1] = True
    return np.flatnonzero(stays), leaf, says


@dataclass
class Votes:
    """The nodes of all trees as arrays, to score rows in blocks; votes add up tree by tree as they do in Spark's model."""

    edges: list
    trees: list = field(default_factory=list)   # (feature, last bin on the left, left child, votes for 0, votes for 1, levels)

    def add(self, feature: np.ndarray, cut: np.ndarray, left: np.ndarray, stats: np.ndarray, levels: int) -> None:
        total = stats.sum(axis=1)
        share = np.divide(stats, total[:, None], out=np.zeros_like(stats), where=total[:, None] > 0)
        leaf = left < 0
        self.trees.append((np.where(leaf, 0, feature).astype(np.int16), np.where(leaf, 255, cut).astype(np.uint8), np.where(leaf, np.arange(len(left)), left).astype(np.int32),
                           share[:, 0].copy(), share[:, 1].copy(), levels))

    def of(self, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Votes for 0 and for 1 of raw rows; missing values go to the right."""
        k, no, yes = values.shape[1], np.zeros(len(values)), np.zeros(len(values))
        for at in range(0, len(values), CHUNK):
            part = values[at:at + CHUNK]
            x = np.column_stack([np.searchsorted(e, part[:, j]) for j, e in enumerate(self.edges)]).astype(np.uint8).ravel()
            base, own = np.arange(len(part)) * k, slice(at, at + len(part))
            for feature, cut, left, zero, one, levels in self.trees:
                feature, left, node = feature.astype(np.int64), left.astype(np.int64), np.zeros(len(part), np.int64)
                for _ in range(levels):
                    node = left.take(node) + (x.take(base + feature.take(node)) > cut.take(node))
                no[own] += zero.take(node)
                yes[own] += one.take(node)
        return no, yes


def voted(df: DataFrame, keep: Sequence[str], features: Sequence[str], votes: Votes) -> DataFrame:
    """``keep``, margin, score and prediction as Spark's model gives them."""
    keep, names = list(keep), [f"_x{i}" for i in range(len(features))]

    def apply(batches):
        for batch in batches:
            x = np.column_stack([batch.column(len(keep) + j).to_numpy(zero_copy_only=False).astype(np.float64) for j in range(len(names))])
            no, yes = votes.of(x)
            total = no + yes
            score = np.divide(yes, total, out=np.zeros(len(yes)), where=total > 0)
            yield pa.RecordBatch.from_arrays([*batch.columns[:len(keep)], pa.array(yes), pa.array(score), pa.array((yes > no).astype(np.int32))], names=[*keep, "margin", "score", "pred"])

    schema = "".join(f"`{c}` {df.schema[c].dataType.simpleString()}, " for c in keep) + "margin double, score double, pred int"
    return df.select(*keep, *[F.col(c).cast("double").alias(n) for c, n in zip(features, names)]).mapInArrow(apply, schema)


def _native(train: DataFrame, rf: RandomForestClassifier, trees: list[Grown], edges: list, weights: np.ndarray, k: int) -> tuple[RandomForestClassificationModel, Votes]:
    """The trees in the format in which Spark stores a forest, loaded from it; and as arrays."""
    votes = Votes(edges)
    spark = train.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/forests/{uuid.uuid4().hex}"
    table = np.zeros((k, MAX_BINS))
    for j, e in enumerate(edges):
        table[j, :len(e)] = e
    cols: dict = {c: [] for c in ("tree", "id", "prediction", "impurity", "a", "b", "count", "gain", "left", "right", "feature", "threshold")}
    for t, tree in enumerate(trees):
        nodes, leaf, says = _pruned(tree, weights)
        number = np.full(len(leaf), -1)
        number[nodes] = np.arange(len(nodes))
        leaf, stats = leaf[nodes], tree.counts[nodes] * weights
        total = np.maximum(stats.sum(axis=1), 1e-300)
        left, feature = tree.left[nodes], tree.feature[nodes]
        ends = np.where(leaf, 0.0, table[feature, np.minimum(tree.bin[nodes], MAX_BINS - 1)])
        votes.add(feature, tree.bin[nodes], np.where(leaf, -1, number[left]), stats, int(np.log2(tree.place[nodes].max())))
        for c, v in (("tree", np.full(len(nodes), t)), ("id", np.arange(len(nodes))), ("prediction", says[nodes]), ("impurity", 1.0 - (stats * stats).sum(axis=1) / (total * total)),
                     ("a", stats[:, 0]), ("b", stats[:, 1]), ("count", tree.counts[nodes].sum(axis=1)), ("gain", np.where(leaf, -1.0, tree.gain[nodes])),
                     ("left", np.where(leaf, -1, number[left])), ("right", np.where(leaf, -1, number[np.where(leaf, 0, left + 1)])), ("feature", np.where(leaf, -1, feature)), ("threshold", ends)):
            cols[c].append(v)
    v = {c: np.concatenate(p) for c, p in cols.items()}
    n, leaf = len(v["id"]), v["left"] < 0
    two = np.stack([v["a"], v["b"]], axis=1).ravel()
    ends = np.concatenate([[0], np.cumsum(~leaf)]).astype(np.int32)
    split = pa.StructArray.from_arrays([pa.array(v["feature"], pa.int32()), pa.ListArray.from_arrays(pa.array(ends), pa.array(v["threshold"][~leaf])), pa.array(np.full(n, -1), pa.int32())],
                                       names=["featureIndex", "leftCategoriesOrThreshold", "numCategories"])
    node = pa.StructArray.from_arrays([pa.array(v["id"], pa.int32()), pa.array(v["prediction"]), pa.array(v["impurity"]), pa.ListArray.from_arrays(pa.array(np.arange(0, 2 * n + 1, 2, dtype=np.int32)), pa.array(two)),
                                       pa.array(v["count"], pa.int64()), pa.array(v["gain"]), pa.array(v["left"], pa.int32()), pa.array(v["right"], pa.int32()), split],
                                      names=["id", "prediction", "impurity", "impurityStats", "rawCount", "gain", "leftChild", "rightChild", "split"])
    nodes = spark.createDataFrame(pa.table({"treeID": pa.array(v["tree"], pa.int32()), "nodeData": node}))
    nodes.repartition(spark.sparkContext.defaultParallelism, "treeID").write.parquet(f"{path}/data")  # trees are put together a file a task

    def told(kind: str, params, names: Sequence[str] | None = None, **more) -> str:
        given = {p.name: params.getOrDefault(p) for p in params.params if params.isSet(p) and (names is None or p.name in names)}
        return json.dumps({"class": f"org.apache.spark.ml.classification.{kind}", "timestamp": int(time.time() * 1000), "sparkVersion": spark.version, "uid": f"{kind}_{uuid.uuid4().hex[:12]}",
                           "paramMap": given, "defaultParamMap": {p.name: params.getOrDefault(p) for p in params.params if params.hasDefault(p) and not params.isSet(p)}, **more})

    one = DecisionTreeClassifier(**{p.name: rf.getOrDefault(p) for p in rf.params if rf.isSet(p) and DecisionTreeClassifier().hasParam(p.name)})
    rows = [(t, told("DecisionTreeClassificationModel", one, numFeatures=k, numClasses=2), 1.0) for t in range(len(trees))]
    spark.createDataFrame(rows, "_1 int, _2 string, _3 double").coalesce(1).write.parquet(f"{path}/treesMetadata")
    whole = told("RandomForestClassificationModel", rf, numFeatures=k, numClasses=2, numTrees=len(trees))
    spark.createDataFrame([(whole,)], "value string").coalesce(1).write.text(f"{path}/metadata")
    return RandomForestClassificationModel.load(path), votes
