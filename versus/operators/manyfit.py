"""Many linear models in one scan (#123, #153, #154, #156).

Trials of a search and samples of a learning curve read the same rows; fitted one by one they
scan them once a trial and iteration.  Here the rows are stored once in blocks that NumPy
reads without a copy, and a pass evaluates loss and gradient of all models at once:
``rows x features`` times ``features x models``.  Every model runs its own L-BFGS on the driver,
written as a generator that yields the point it wants evaluated; the points of all models that
are not done go into the next pass, line searches included.  So a search takes as many passes
as its slowest model, whatever their number.

A hinge model over Fourier features has a kink a row, at which L-BFGS crawls.  It is minimised by Newton's
method instead: the kinks are rounded (softplus), less from stage to stage, until the rounding itself adds next to
nothing to the loss, which bounds the distance to the least loss; a pass adds up the rounded loss, its
gradient and its Hessian (components x components, whatever the rows).  A large fit starts from the
solution over one row in ``SAMPLE``; it ends on all rows.

A model may take only the rows below a rank (nested samples of a learning curve), weigh the
classes of its rows equally, and see the rows through random Fourier features (one shared
projection, scaled by each model's gamma), computed in the pass and stored nowhere.
"""

from __future__ import annotations

from collections.abc import Generator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import SEED
from ..session import cut_lineage
from .models import FittedModel, fourier_draws, fourier_map

DRIVER_PARTS = 32        # up to so many partial sums a model are added by the driver, more by Spark
DRIVER_BYTES = 1 << 26   # and up to so many bytes of them
SAMPLE = 16              # one row in so many finds where a large Newton fit starts
SAMPLED_FROM = 50_000    # rows of a large fit
ROWS_PER_CORE = 20_000   # rows under Fourier features that are worth a task of their own while cores are free
CHUNK = 2048             # rows whose Fourier features are in memory at a time
CELLS_PER_PART = 25_000_000  # rows of a part times the columns that all models see of a row
_PACKED = "x binary, y binary, rank binary, use binary"
_SUMS = "model int, v binary"


@dataclass(frozen=True)
class Spec:
    """One model: ``loss`` logistic or hinge, penalty 1 / (C n), the rows of rank below ``limit`` (all: None)."""

    C: float = 1.0
    loss: str = "logistic"
    limit: int | None = None
    balanced: bool = False
    gamma: float | None = None
    n_components: int = 200


@dataclass
class Rows:
    """Rows stored in blocks; ``use`` tells training rows (1) from others (0)."""

    blocks: DataFrame
    features: list
    parts: int
    seed: int = SEED


def store(frame: DataFrame, features: Sequence[str], target: str, use: Column | None = None, rank: Column | None = None,
          specs: Sequence[Spec] = (), seed: int = SEED) -> Rows:
    """Pack the rows, an Arrow batch a block; NULL features count as 0 (as in every linear model here).
    ``specs``, if known, bound the work of a part."""
    k = len(features)
    width = sum(k if s.gamma is None else s.n_components for s in specs) or k
    rows_per_part = max(1000, CELLS_PER_PART // max(width, 1))
    src = frame.select(*[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(f"f{i}") for i, c in enumerate(features)],
                       F.col(target).cast("double").alias("y"), (F.lit(0) if rank is None else rank).cast("long").alias("rank"),
                       (F.lit(1) if use is None else use.cast("int")).alias("use"))

    def pack(batches):
        for b in batches:
            if b.num_rows:
                cols = [b.column(i).to_numpy(zero_copy_only=False) for i in range(b.num_columns)]
                parts = [np.column_stack(cols[:k]).astype(np.float64), cols[k].astype(np.float64), cols[k + 1].astype(np.int64), cols[k + 2].astype(np.uint8)]
                yield pa.RecordBatch.from_arrays([pa.array([p.tobytes()], pa.binary()) for p in parts], names=["x", "y", "rank", "use"])

    n = frame.count()
    if any(_curved(s) for s in specs):  # a pass over Fourier features is work for all cores, dealt evenly
        src = src.repartition(max(1, min(-(-n // ROWS_PER_CORE), frame.sparkSession.sparkContext.defaultParallelism)))
    else:
        src = src.coalesce(max(1, -(-n // rows_per_part)))
    blocks = cut_lineage(src.mapInArrow(pack, _PACKED))
    return Rows(blocks, list(features), blocks.rdd.getNumPartitions(), seed)


def _each(batches, k: int):
    for batch in batches:
        for i in range(batch.num_rows):
            x, y, rank, use = (np.frombuffer(batch.column(c)[i].as_buffer(), dtype=t) for c, t in zip(range(4), (np.float64, np.float64, np.int64, np.uint8)))
            yield x.reshape(-1, k), y, rank, use == 1


def _curved(spec: Spec) -> bool:
    """Whether Newton's method fits the model."""
    return spec.loss == "hinge" and spec.gamma is not None


def _added(found: DataFrame, parts: int, size: int = 0) -> dict[int, np.ndarray]:
    """The vectors of each model, added; ``size`` bytes a part, if they are many."""
    if parts > DRIVER_PARTS or parts * size > DRIVER_BYTES:
        def add(table: pa.Table) -> pa.Table:
            total = sum(np.frombuffer(v.as_buffer()) for v in table.column("v"))
            return pa.table({"model": table.column("model")[:1], "v": pa.array([total.tobytes()], pa.binary())})
        found = found.groupBy("model").applyInArrow(add, _SUMS)
    out: dict[int, np.ndarray] = {}
    for r in found.collect():  # models x DRIVER_PARTS rows of one gradient each
        v = np.frombuffer(r.v)
        out[r.model] = out[r.model] + v if r.model in out else v
    return out


def _views(specs: dict[int, Spec], k: int, seed: int):
    """Each model's view of the rows: the rows themselves or its Fourier features."""
    draws = {d: fourier_draws(k, d, seed) for d in {s.n_components for s in specs.values() if s.gamma is not None}}

    def views(x: np.ndarray):
        shared = {d: x @ w for d, (w, _) in draws.items()}
        for j, s in specs.items():
            if s.gamma is None:
                yield j, x
            else:
                d = s.n_components
                yield j, np.sqrt(2.0 / d) * np.cos(np.sqrt(2.0 * s.gamma) * shared[d] + draws[d][1])
    return views


def _weights(spec: Spec, y: np.ndarray, rank: np.ndarray, use: np.ndarray, classes: tuple[float, float]) -> np.ndarray:
    w = use.astype(np.float64)
    if spec.limit is not None:
        w = w * (rank < spec.limit)
    return w * np.where(y > 0.5, classes[1], classes[0]) if spec.balanced else w


def _sums(rows: Rows, specs: dict[int, Spec], classes: dict, points: dict[int, np.ndarray]) -> dict[int, np.ndarray]:
    """(loss, gradient) of every wanted point, over all rows, one pass."""
    wanted = {j: specs[j] for j in points}
    views, k = _views(wanted, len(rows.features), rows.seed), len(rows.features)

    def scan(batches):
        total = {j: np.zeros(len(p) + 1) for j, p in points.items()}
        for x, y, rank, use in _each(batches, k):
            sign = np.where(y > 0.5, 1.0, -1.0)
            for j, z in views(x):
                w = _weights(wanted[j], y, rank, use, classes[j])
                m = sign * (z @ points[j][:-1] + points[j][-1])
                if wanted[j].loss == "logistic":
                    loss, slope = np.logaddexp(0.0, -m), -1.0 / (1.0 + np.exp(np.minimum(m, 700.0)))
                else:
                    loss, slope = np.maximum(0.0, 1.0 - m), -(m < 1.0).astype(np.float64)
                s = w * slope * sign
                total[j] += np.concatenate([[w @ loss], s @ z, [s.sum()]])
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array([v.tobytes() for v in total.values()], pa.binary())], names=["model", "v"])

    return _added(rows.blocks.mapInArrow(scan, _SUMS), rows.parts)


def class_counts(rows: Rows, specs: Sequence[Spec]) -> list[tuple[float, float]]:
    """Rows of each class that each model takes, one pass."""
    k = len(rows.features)

    def scan(batches):
        total = np.zeros((len(specs), 2))
        for _, y, rank, use in _each(batches, k):
            for j, s in enumerate(specs):
                w = use if s.limit is None else use & (rank < s.limit)
                total[j] += [(w & (y <= 0.5)).sum(), (w & (y > 0.5)).sum()]
        yield pa.RecordBatch.from_arrays([pa.array(range(len(specs)), pa.int32()), pa.array([v.tobytes() for v in total], pa.binary())], names=["model", "v"])

    got = _added(rows.blocks.mapInArrow(scan, _SUMS), rows.parts)
    return [tuple(got.get(j, np.zeros(2))) for j in range(len(specs))]


def lbfgs(start: np.ndarray, max_iter: int, tol: float, memory: int = 10) -> Generator[np.ndarray, tuple[float, np.ndarray], np.ndarray]:
    """Minimise by L-BFGS with backtracking; yields points, is sent (value, gradient), returns the best point."""
    x = start
    f, g = yield x
    steps: list = []
    for it in range(max_iter):
        if np.abs(g).max(initial=0.0) < 1e-10:
            break
        d, kept = g.copy(), []
        for s, y, r in reversed(steps):
            a = r * (s @ d)
            kept.append(a)
            d = d - a * y
        if steps:
            s, y, _ = steps[-1]
            d = d * ((s @ y) / (y @ y))
        for (s, y, r), a in zip(steps, reversed(kept)):
            d = d + (a - r * (y @ d)) * s
        d = -d
        if d @ g >= 0:
            d, steps = -g, []
        step = 1.0 if steps else min(1.0, 1.0 / max(np.abs(g).sum(), 1e-12))
        while True:
            new = x + step * d
            f2, g2 = yield new
            if f2 <= f + 1e-4 * step * (g @ d) or step < 1e-9:
                break
            step *= 0.5
        if f2 >= f:
            if not steps:
                break
            steps = []  # a kink: once more along the gradient
            continue
        s, y = new - x, g2 - g
        if s @ y > 1e-12:
            steps = [*steps, (s, y, 1.0 / (s @ y))][-memory:]
        done = abs(f - f2) <= tol * max(abs(f), abs(f2), 1e-12)
        x, f, g = new, f2, g2
        if done:
            break
    return x


def _bends(rows: Rows, specs: dict[int, Spec], classes: dict, asked: dict[int, tuple]) -> dict[int, tuple]:
    """(weight, rounded loss, loss, gradient, Hessian) of every point asked for, summed in one pass; ``asked`` has
    (point, width of the rounding, take one row in so many) by model."""
    wanted, k = {j: specs[j] for j in asked}, len(rows.features)
    steps = {step: {j: wanted[j] for j in asked if asked[j][2] == step} for step in {a[2] for a in asked.values()}}
    views = {step: _views(own, k, rows.seed) for step, own in steps.items()}

    def scan(batches):
        total = {j: [np.zeros(3), np.zeros(len(p)), np.zeros((len(p), len(p)))] for j, (p, _, _) in asked.items()}
        for x, y, rank, use in _each(batches, k):
            for step, view in views.items():
                for at in range(0, len(x), CHUNK * step):
                    part = slice(at, at + CHUNK * step, step)
                    sign = np.where(y[part] > 0.5, 1.0, -1.0)
                    for j, z in view(x[part]):
                        point, width, _ = asked[j]
                        w = _weights(wanted[j], y[part], rank[part], use[part], classes[j])
                        u = 1.0 - sign * (z @ point[:-1] + point[-1])
                        slope = 1.0 / (1.0 + np.exp(np.clip(-u / width, -700.0, 700.0)))
                        rounded = width * np.logaddexp(0.0, u / width)
                        s, (sums, gradient, hessian) = -w * slope * sign, total[j]
                        sums += [w.sum(), w @ rounded, w @ np.maximum(u, 0.0)]
                        gradient += np.append(s @ z, s.sum())
                        bend = w * slope * (1.0 - slope)
                        bent = np.flatnonzero(bend > 1e-7)  # the others' share of the Hessian is nothing to a step
                        v = np.column_stack([z[bent], np.ones(len(bent))]) * np.sqrt(bend[bent] / width)[:, None]
                        hessian += v.T @ v
        out = [np.concatenate([sums, gradient, hessian[np.triu_indices(len(gradient))]]) for sums, gradient, hessian in total.values()]
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array([v.tobytes() for v in out], pa.binary())], names=["model", "v"])

    size = sum(4 * len(p) * (len(p) + 3) for p, _, _ in asked.values())
    got, out = _added(rows.blocks.mapInArrow(scan, _SUMS), rows.parts, size), {}
    for j, (p, _, _) in asked.items():
        d = len(p)
        v = got.get(j, np.zeros(3 + d + d * (d + 1) // 2))
        hessian = np.zeros((d, d))
        hessian[np.triu_indices(d)] = v[3 + d:]
        out[j] = (float(v[0]), float(v[1]), float(v[2]), v[3:3 + d], hessian + np.triu(hessian, 1).T)
    return out


def newton(start: np.ndarray, penalty: float, sampled: bool, tol: float = 5e-6, most: int = 300) -> Generator[tuple, tuple, np.ndarray]:
    """Minimise mean hinge loss + penalty / 2 |w|^2, the intercept free; yields (point, width of the rounding, take
    one row in so many), is sent the sums of ``_bends``, returns the best point.

    The rounded loss is nowhere below the loss, so what rounding adds at its minimum is also about the most that the
    loss there can be above the least; the last stage is that where it adds less than ``tol`` of the loss.
    """
    x, passes = start, 0
    ridge = np.append(np.full(len(x) - 1, penalty), 0.0)

    def seen(sent, x):
        n, rounded, loss, g, h = sent
        flat = np.append(x[:-1], 0.0)
        n, extra = max(n, 1.0), penalty / 2 * float(flat @ flat)
        return rounded / n + extra, loss / n + extra, g / n + penalty * flat, h / n + np.diag(ridge)

    stages = [(4.0 ** -i, SAMPLE) for i in range(3)] if sampled else []
    for width, step in stages + [(4.0 ** -i, 1) for i in range(2 if sampled else 0, 11)]:
        f, plain, g, h = seen((yield x, width, step), x)
        passes += 1
        while passes < most:
            d = -np.linalg.solve(h + 1e-9 * np.eye(len(x)), g)
            gain = -float(g @ d)
            last = step == 1 and f - plain <= tol * f
            if not gain > (2 * tol if last else 1e-4) * f:
                break
            t = 1.0
            while True:
                new = x + t * d
                f2, plain2, g2, h2 = seen((yield new, width, step), new)
                passes += 1
                if f2 <= f - 1e-4 * t * gain or t < 1e-6 or passes >= most:
                    break
                slope = float(g2 @ d)
                t *= min(max(gain / (gain + slope), 0.1), 0.7) if slope > 0 else 0.5
            if f2 >= f:
                break
            x, f, plain, g, h = new, f2, plain2, g2, h2
        if step == 1 and f - plain <= tol * f:
            break
    return x


def fit_many(rows: Rows, specs: Sequence[Spec], max_iter: int = 200, tol: float = 1e-7) -> tuple[list[FittedModel], int]:
    """All models fitted side by side, and the passes over the rows that took.

    Objective: mean weighted loss + |w|^2 / (2 C n), the intercept free.  A model without rows
    keeps the zero vector.
    """
    counts = class_counts(rows, specs)
    classes = {j: tuple(((a + b) / (2 * c)) if c else 0.0 for c in (a, b)) for j, (a, b) in enumerate(counts)}
    sizes = {j: max(a + b, 1.0) for j, (a, b) in enumerate(counts)}
    table = dict(enumerate(specs))
    k, found, passes = len(rows.features), {}, 1

    def run(runs: dict, measure) -> int:
        points, done = {j: next(r) for j, r in runs.items()}, 0
        while points:
            sums, done = measure(points), done + 1
            for j in list(points):
                try:
                    points[j] = runs[j].send(sums(j, points[j]))
                except StopIteration as end:
                    found[j] = end.value
                    del points[j]
        return done

    def slopes(points):
        sums = _sums(rows, table, classes, points)

        def told(j, x):
            n, reg = sizes[j], 1.0 / (table[j].C * sizes[j])
            got = sums.get(j, np.zeros(len(x) + 1))
            flat = np.append(x[:-1], 0.0)
            return got[0] / n + reg / 2 * float(flat @ flat), got[1:] / n + reg * flat
        return told

    def bends(points):
        sums = _bends(rows, table, classes, points)
        return lambda j, _: sums[j]

    passes += run({j: lbfgs(np.zeros((k if s.gamma is None else s.n_components) + 1), max_iter, tol) for j, s in table.items() if not _curved(s)}, slopes)
    passes += run({j: newton(np.zeros(s.n_components + 1), 1.0 / (s.C * sizes[j]), sizes[j] >= SAMPLED_FROM) for j, s in table.items() if _curved(s)}, bends)
    return [_model(rows, s, found[j]) for j, s in table.items()], passes


def _model(rows: Rows, spec: Spec, x: np.ndarray) -> FittedModel:
    name = "logistic_regression" if spec.loss == "logistic" else "svm_linear"
    out = FittedModel(name, list(rows.features), coef=x[:-1], intercept=float(x[-1]), params={"C": spec.C})
    if spec.gamma is not None:
        out.name = "svm_rbf"
        out.transform, names = fourier_map(rows.features, spec.gamma, spec.n_components, rows.seed)
        out.params.update({"gamma": spec.gamma, "n_components": spec.n_components, "seed": rows.seed, "model_features": names})
    return out


def errors(rows: Rows, specs: Sequence[Spec], models: Sequence[FittedModel]) -> list[tuple[float, float, float, float]]:
    """(training rows, wrong ones, other rows, wrong ones) of each model, one pass."""
    table = dict(enumerate(specs))
    views, k = _views(table, len(rows.features), rows.seed), len(rows.features)
    coefs = [(m.coef, m.intercept) for m in models]

    def scan(batches):
        total = np.zeros((len(specs), 4))
        for x, y, rank, use in _each(batches, k):
            for j, z in views(x):
                wrong = ((z @ coefs[j][0] + coefs[j][1]) >= 0) != (y > 0.5)
                own = use if table[j].limit is None else use & (rank < table[j].limit)
                total[j] += [own.sum(), (own & wrong).sum(), (~use).sum(), (~use & wrong).sum()]
        yield pa.RecordBatch.from_arrays([pa.array(range(len(specs)), pa.int32()), pa.array([v.tobytes() for v in total], pa.binary())], names=["model", "v"])

    got = _added(rows.blocks.mapInArrow(scan, _SUMS), rows.parts)
    return [tuple(map(float, got.get(j, np.zeros(4)))) for j in range(len(specs))]


def scores(frame: DataFrame, rows: Rows, specs: Sequence[Spec], models: Sequence[FittedModel], target: str) -> DataFrame:
    """(model, label, score, pred) of every row of ``frame`` and model, for metrics by model."""
    table = dict(enumerate(specs))
    k = len(rows.features)
    views, coefs = _views(table, k, rows.seed), [(m.coef, m.intercept) for m in models]
    src = frame.select(*[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(f"f{i}") for i, c in enumerate(rows.features)], F.col(target).cast("double").alias("y"))

    def scan(batches):
        for b in batches:
            cols = [b.column(i).to_numpy(zero_copy_only=False) for i in range(k + 1)]
            x, y = np.column_stack(cols[:k]) if b.num_rows else np.empty((0, k)), cols[k]
            for j, z in views(x):
                m = z @ coefs[j][0] + coefs[j][1]
                p = 1.0 / (1.0 + np.exp(-np.clip(m, -700, 700)))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(m), j), pa.int32()), pa.array(y), pa.array(p), pa.array((p >= 0.5).astype(np.int32))],
                                                 names=["model", target, "score", "pred"])

    return src.mapInArrow(scan, f"model int, {target} double, score double, pred int")
