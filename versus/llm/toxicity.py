"""Toxicity by maximum-scoring segment search.

*Token scores.*  Words and their leading 3 to 6 letters are units.  A unit's score is
its log-odds ratio between toxic and clean training documents under informative
Dirichlet priors (Monroe, Colaresi and Quinn, "Fightin' Words", 2008), shrunk to the
near end of its confidence interval; units that then stay under ``LEAST`` score nothing,
nor do leading letters that one word accounts for.
A word takes its unit of largest shrunk score, at every place where a text has it; words
without one have the drift ``-DRIFT``.  Only the log-odds count documents: how often clean
texts repeat a word is in the token distribution and the fit of the calibration.

*Passages.*  One linear scan (Ruzzo and Tompa, 1999) finds all disjoint maximal
scoring segments of a text.

*Calibration.*  Under the clean documents' token distribution a text of n words has
about ``K n exp(-lambda S)`` segments of score S or more (Karlin and Altschul, 1990).
The sum statistic of its best segments gives the text an extreme-value p-value, and a
one-variable logistic fit on training documents kept out of the counting turns
``log(1 - log p)`` into the score (the outer logarithm keeps a few mislabelled texts of
extreme evidence from flattening the curve).

At scale: fitting reads a bounded sample of the labelled rows (``per_class``); the
units that matter are a few thousand.  Scoring is one pass without a shuffle.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import crc_mod, cut_lineage, release, sized_batches, unit_hash

#: Labelled documents of each class that are fitted, about (chosen by a hash of the id).
PER_CLASS = 6000
DRIFT = 0.1
LEAST = 0.5
_PREFIXES = (3, 4, 5, 6)
_WORD = re.compile(r"[^\W\d_]+")


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def units_of(word: str) -> list[str]:
    """The word, and its leading letters (marked by ``*``) where they are shorter."""
    return [word, *(word[:k] + "*" for k in _PREFIXES if len(word) > k)]


def segments(hits: list[tuple[int, float]], drift: float = DRIFT) -> list[tuple[float, int, int]]:
    """All maximal scoring segments ``(score, first, last)`` of a sequence in which the
    positions of ``hits`` have their scores and all others ``-drift``; linear time."""
    open_: list[list] = []  # cumulative before, after; first, last; nearest earlier one that starts lower
    total, last = 0.0, -1
    for i, s in hits:
        total -= drift * (i - last - 1)
        last = i
        low, total = total, total + s
        if s <= 0:
            continue
        first, high = i, total
        while True:
            j = len(open_) - 1
            while j >= 0 and open_[j][0] >= low:
                j = open_[j][4]
            if j < 0 or open_[j][1] >= high:
                open_.append([low, high, first, i, j])
                break
            low, first = open_[j][0], open_[j][2]
            del open_[j:]
    return [(r - l, a, b) for l, r, a, b, _ in open_]


class _WordScores(dict):
    """Score of a word, worked out once."""

    def __init__(self, units: dict[str, float]):
        self.units = units

    def __missing__(self, word: str) -> float:
        s = max((self.units[u] for u in units_of(word) if u in self.units), key=abs, default=0.0)
        self[word] = s
        return s


@dataclass
class ToxicityModel:
    """``units``: unit -> score; ``lam``, ``k``: extreme-value parameters of the
    clean distribution; ``a``, ``b``: logistic calibration of log(1 - log p)."""

    units: dict[str, float]
    lam: float = 1.0
    k: float = 0.1
    a: float = -2.0
    b: float = 1.2
    drift: float = DRIFT
    _scores: _WordScores | None = field(default=None, repr=False)

    def __getstate__(self):
        return {**self.__dict__, "_scores": None}

    def hits(self, words: list[str]) -> list[tuple[int, float]]:
        if self._scores is None or len(self._scores) > 100_000:
            self._scores = _WordScores(self.units)
        score = self._scores
        return [(i, s) for i, s in enumerate([score[w] for w in words]) if s]

    def passages(self, text: str | None) -> tuple[float, list[tuple[float, int, int]]]:
        """-log p of the text, and its segments that are significant on their own (expected
        number under 0.05), best first; word positions, both ends included."""
        words = words_of(text or "")
        found = sorted(segments(self.hits(words), self.drift), key=lambda s: (-s[0], s[1]))
        if not found:
            return 0.0, []
        space = math.log(self.k * len(words)) if self.k * len(words) > 1 else 0.0
        best, total = 0.0, 0.0
        for r, (s, _, _) in enumerate(found, 1):
            total += self.lam * s - space
            if self.lam * s <= space:
                break
            # P(sum of r normalised scores >= total) ~ e^-t t^(r-1) / (r! (r-1)!), and e^-r for choosing r
            best = max(best, total - (r - 1) * math.log(max(total, 1e-9)) + math.lgamma(r + 1) + math.lgamma(r) - (r - 1) if total > r else 0.0)
        limit = space - math.log(0.05)
        return best, [x for x in found if self.lam * x[0] >= limit]

    def score(self, evidence: float) -> float:
        return 1.0 / (1.0 + math.exp(-max(-60.0, min(60.0, self.a + self.b * math.log1p(evidence)))))


def _log_odds(t: Column, c: Column, nt: int, nc: int, prior: float, z: float) -> Column:
    """Shrunk score of a unit in ``t`` of ``nt`` toxic and ``c`` of ``nc`` clean documents."""
    share = (t + c) / F.lit(float(nt + nc)) * prior
    t1, c1 = t + share, c + share
    rest = prior + 0.5  # half a document more, as a unit may be in every document
    t0, c0 = F.lit(nt + rest) - t1, F.lit(nc + rest) - c1
    delta = F.log(t1 / t0) - F.log(c1 / c0)
    sd = F.sqrt(1 / t1 + 1 / c1 + 1 / t0 + 1 / c0)  # common words: the documents without them are the few
    return F.signum(delta) * F.greatest(F.abs(delta) - z * sd, F.lit(0.0))


def _families(scores: dict[str, float], toxic: dict[str, int]) -> dict[str, float]:
    """Without the leading letters that one word accounts for: half of their toxic
    documents or more have that word, so they say nothing of others that begin alike."""
    alone = {u for w in scores if not w.endswith("*") for u in units_of(w)[1:] if u in scores and 2 * toxic[w] >= toxic[u]}
    return {u: s for u, s in scores.items() if u not in alone}


def _extreme_value(probs: np.ndarray, scores: np.ndarray) -> float:
    """The positive root lambda of sum p exp(lambda s) = 1 (negative mean, a positive score)."""
    low, high = 0.0, 1.0
    value = lambda x: float((probs * np.exp(np.minimum(x * scores, 500.0))).sum()) - 1.0
    while value(high) < 0 and high < 1e3:
        low, high = high, 2 * high
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (mid, high) if value(mid) < 0 else (low, mid)
    return max(high, 1e-3)


def _logistic(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[float, float]:
    """Ridge-regularised logistic regression on one variable, by Newton steps."""
    beta = np.array([-2.0, 0.3])
    design = np.stack([np.ones_like(x), x], axis=1)
    ridge = np.diag([1e-3, 1e-2])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        grad = design.T @ (w * (y - p)) - ridge @ beta
        hess = (design * (w * p * (1 - p))[:, None]).T @ design + ridge
        step = np.linalg.solve(hess, grad)
        beta = beta + np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-6:
            break
    return float(beta[0]), float(max(beta[1], 1e-3))


def _class_key(text: str) -> int:
    """Smallest hash of three words in a row: copies and near copies mostly share it, so
    that a text copied a thousand times counts about once."""
    words = words_of(text)
    if len(words) < 3:
        return xxhash.xxh64_intdigest(" ".join(words)) >> 1
    return min(xxhash.xxh64_intdigest(" ".join(words[i:i + 3])) for i in range(len(words) - 2)) >> 1


def training_rows(df: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Rows that may be learnt from: crc32(id as text) mod 5 is not 0."""
    return df.filter(crc_mod(F.col(id_col), 5) != 0)


def label_rows(labels: DataFrame, id_col: str = "doc_id", label_col: str = "toxic") -> DataFrame:
    """``(doc_id, toxic)``, one row per id; contradictory labels of an id are left out."""
    return (labels.filter(F.col(id_col).isNotNull() & F.col(label_col).isin(0, 1)).groupBy(F.col(id_col).alias("doc_id"))
            .agg(F.min(label_col).alias("toxic"), F.max(label_col).alias("most")).filter("toxic = most").drop("most"))


def sample(df: DataFrame, marks: DataFrame, id_col: str, text_col: str, per_class: int) -> tuple[DataFrame | None, dict[int, int]]:
    """``(toxic, text)``, about ``per_class`` rows of each class, and the ids of each class; no
    rows without both classes.

    A row is a text of an id, once however often it repeats.  An id of ``m`` texts is taken
    ``min(m, level)`` times (expected), with one level for the class, so no id crowds out others.
    """
    texts = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).filter(F.col("text").isNotNull())
    texts = texts.withColumn("key", F.xxhash64("text"))
    pairs = cut_lineage(texts.select("doc_id", "key").join(marks, "doc_id").distinct())
    owned = pairs.groupBy("doc_id", "toxic").agg(F.count("*").alias("m"))
    sizes, levels = {}, {}
    hist = owned.groupBy("toxic", "m").agg(F.count("*").alias("n")).collect()  # a few numbers: distinct m
    for y in {r.toxic for r in hist}:
        own = sorted((r.m, r.n) for r in hist if r.toxic == y)
        sizes[y] = left = sum(n for _, n in own)
        budget, levels[y] = float(per_class), float(own[-1][0])
        for m, n in own:  # fewest texts first: whole while the even share of what is left allows it
            if m * left > budget:
                levels[y] = budget / left
                break
            budget, left = budget - m * n, left - n
    if len(sizes) < 2:
        return None, sizes
    level = F.when(F.col("toxic") == 1, F.lit(levels[1])).otherwise(F.lit(levels[0]))
    taken = pairs.join(owned.select("doc_id", "m"), "doc_id").filter(unit_hash(F.col("doc_id"), F.col("key"), seed=1) * F.col("m") < level)
    # about 2 * per_class keys, so the texts meet them in a broadcast; equal rows become one before they move
    found = texts.join(F.broadcast(taken.select("doc_id", "key", "toxic")), ["doc_id", "key"])
    return found.select("doc_id", "toxic", "text").distinct().select("toxic", "text"), sizes


def fit(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
        per_class: int = PER_CLASS, prior: float = 20.0, z: float = 3.0) -> ToxicityModel:
    """Learn from the rows of ``df`` that ``labels`` marks 0 or 1.

    ``per_class`` bounds the documents read of each class, by a hash of id and text; repeated
    rows count once, and ids of many texts share evenly (``sample``).  Null texts are skipped.
    Without both classes the model has no units and every text gets the same low score.
    """
    spark = df.sparkSession
    rows, sizes = sample(df, label_rows(labels, id_col, label_col), id_col, text_col, per_class)
    if rows is None:
        return ToxicityModel({})

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = [_class_key(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int32()), batch.column(1), pa.array(keys, pa.int64())], ["toxic", "text", "key"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Copy classes (rows sorted by label and key) in which each unit occurs; the empty unit counts the classes."""
        counts: tuple[dict, dict] = ({}, {})
        now, seen = None, set()

        def close():
            if now is not None:
                own = counts[now[0]]
                for u in {u for w in seen for u in units_of(w)} | {""}:
                    own[u] = own.get(u, 0) + 1

        for batch in batches:
            for toxic, text, key in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if (toxic, key) != now:
                    close()
                    now, seen = (toxic, key), set()
                seen.update(words_of(text))
        close()
        for y, own in enumerate(counts):
            names = list(own)
            for at in range(0, len(names), 50_000):
                part = names[at: at + 50_000]
                yield pa.RecordBatch.from_arrays([pa.array(part, pa.string()), pa.array([own[u] * y for u in part], pa.int64()),
                                                  pa.array([own[u] * (1 - y) for u in part], pa.int64())], ["unit", "t", "c"])

    kept = cut_lineage(rows.mapInArrow(keyed, "toxic int, text string, key long"))  # bounded by per_class; read three times
    counting = F.pmod("key", F.lit(4)) != 0
    counted = (kept.filter(counting).repartition("toxic", "key").sortWithinPartitions("toxic", "key")
               .mapInArrow(count, "unit string, t long, c long").groupBy("unit").agg(F.sum("t").alias("t"), F.sum("c").alias("c")))
    counted = counted.filter((F.col("unit") == "") | (F.col("t") + F.col("c") >= 3)).cache()
    try:
        whole = counted.filter("unit = ''").first()
        if whole is None or not whole.t or not whole.c:
            return ToxicityModel({})
        score = _log_odds(F.col("t"), F.col("c"), whole.t, whole.c, prior, z)
        units = counted.filter("unit != ''").select("unit", "t", score.alias("s")).filter(F.abs("s") >= LEAST).toPandas()
    finally:
        counted.unpersist()
    model = ToxicityModel(_families(dict(zip(units["unit"], units["s"].astype(float))), dict(zip(units["unit"], units["t"]))))

    shared = spark.sparkContext.broadcast(model)

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Word scores of clean documents: a hundredth and how often."""
        seen: dict[int, int] = {}
        for batch in batches:
            for text in batch.column(0):
                words = words_of(text.as_py())
                hits = shared.value.hits(words)
                seen[0] = seen.get(0, 0) + len(words) - len(hits)
                for _, s in hits:
                    seen[round(s * 100)] = seen.get(round(s * 100), 0) + 1
        yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.int64()), pa.array(list(seen.values()), pa.int64())], ["s", "n"])

    clean = kept.filter(counting & (F.col("toxic") == 0)).select("text").mapInArrow(tally, "s long, n long")
    dist = clean.groupBy("s").agg(F.sum("n").alias("n")).toPandas()
    n = dist["n"].to_numpy(float)
    s = np.where(dist["s"] == 0, -DRIFT, dist["s"] / 100.0)
    positive = max(model.units.values(), default=0.0)
    if positive > 0 and n.sum():
        # a top unit may be unseen in clean text: it counts once there
        model.lam = _extreme_value(np.append(n, 1.0) / (n.sum() + 1.0), np.append(s, positive))
    shared = spark.sparkContext.broadcast(model)

    def evidence(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = [shared.value.passages(t.as_py())[0] for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(x, pa.float64())], ["toxic", "x"])

    rest = kept.filter(~counting).select("toxic", "text").mapInArrow(evidence, "toxic int, x double").toPandas()  # bounded by per_class
    if len(rest) and rest["toxic"].nunique() == 2:
        y = rest["toxic"].to_numpy(float)
        weight = np.where(y == 1, max(1.0, sizes[1] / per_class), max(1.0, sizes[0] / per_class))
        model.a, model.b = _logistic(np.log1p(rest["x"].to_numpy(float)), y, weight)
    return model


def score_column(spark, model: ToxicityModel, text: Column) -> Column:
    """``struct(score, passages)`` of a text column, one pass, no shuffle; a passage has its
    score and first and last word (from 0)."""
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("score double, passages array<struct<score:double,first:int,last:int>>")
    def run(series: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        m = shared.value
        for s in series:
            rows = []
            for texts in sized_batches(s):
                for t in texts:
                    x, found = m.passages(t)
                    rows.append((m.score(x), [{"score": a, "first": b, "last": c} for a, b, c in found]))
            yield pd.DataFrame(rows, columns=["score", "passages"])
        m._scores = None  # the process lives on
        release()

    return run(text)


def score(df: DataFrame, model: ToxicityModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, held_out, score, predicted, passages)``, one row per row of ``df``.

    A null or empty text has no passage and the score of no evidence.  A null id counts
    as the empty text for ``held_out``.
    """
    rows = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    rows = rows.withColumn("p", score_column(df.sparkSession, model, F.col("text")))
    return rows.select("doc_id", (crc_mod(F.col("doc_id"), 5) == 0).alias("held_out"), "p.score",
                       (F.col("p.score") >= 0.5).cast("int").alias("predicted"), "p.passages")
