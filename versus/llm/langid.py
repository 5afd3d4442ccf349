"""Language identification by multilingual mixture inference.

Each language is a distribution over hashed byte trigrams, learnt from labelled
documents.  A document's language proportions are the maximum-likelihood weights
of the mixture of these distributions, found by expectation-maximisation over the
document's trigram counts; its language set is the nested set (by proportion) of
largest log-likelihood less ``penalty * log(trigrams)`` for each language.  After
Lui, Lau and Baldwin, "Automatic Detection and Language Identification of
Multilingual Documents" (2014).

At scale: fitting reads a bounded sample (``per_lang`` texts of a language);
the model is languages x ``BUCKETS`` numbers.  Prediction is one pass over the
whole texts without a shuffle, vectorised over many documents at a time.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import crc_mod, release, sized_batches, unit_hash, with_small

BUCKETS = 1 << 14
#: Documents of each language that are fitted, about (chosen by a hash of the text).
PER_LANG = 4000
UND = "und"

#: Bytes that are no ASCII letter count as a space; bytes of other letters stay.
_FOLD = bytes(c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def trigrams(text: str) -> np.ndarray:
    """Hashed byte trigrams whose middle byte belongs to a word."""
    b = np.frombuffer(b" " + text.encode().lower().translate(_FOLD) + b" ", np.uint8)
    w = b.astype(np.uint32)
    g = ((w[:-2] << np.uint32(16) | w[1:-1] << np.uint32(8) | w[2:]) * np.uint32(0x9E3779B1)) >> np.uint32(18)
    return g[b[1:-1] != 32]


def has_letter(text: str | None) -> bool:
    return any(map(str.isalpha, text or ""))


def _mixture(pi: np.ndarray, p: np.ndarray, c: np.ndarray, doc: np.ndarray, start: np.ndarray, total: np.ndarray,
             rounds: int) -> np.ndarray:
    """Weights (text x language) after expectation-maximisation; each text stops by its own change,
    so that its result does not depend on the texts beside it."""
    moving = np.ones(len(total), bool)
    for _ in range(rounds):
        joint = pi[doc] * p
        joint *= (c / joint.sum(axis=1))[:, None]
        new = np.add.reduceat(joint, start, axis=0) / total[:, None]
        change = np.abs(new - pi).max(axis=1)
        pi = np.where(moving[:, None], new, pi)
        moving &= change >= 1e-3
        if not moving.any():
            break
    return pi


@dataclass
class LanguageModel:
    """``logp``: trigram bucket x language, natural logarithms."""

    langs: list[str]
    logp: np.ndarray
    penalty: float = 2.0

    def infer(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Proportions (text x language, zero outside the chosen set) and whether the
        text has any letter; without letters the proportions are all zero.

        Sets of every size are searched, for each text until the bound on its likelihood rules
        larger ones out; of sets (or languages) that tie, the smaller (or first) is taken.
        Equal texts get equal results whatever texts stand beside them."""
        n, m = len(texts), len(self.langs)
        out, ok = np.zeros((n, m)), np.array([has_letter(t) for t in texts], bool)
        if not m or not ok.any():
            return out, ok & bool(m)
        grams, counts = [], []
        for t in (t for t, k in zip(texts, ok) if k):
            c = np.bincount(trigrams(t), minlength=BUCKETS)
            g = np.flatnonzero(c)
            if not len(g):  # letters, but none in a trigram: cannot be, kept for safety
                g = np.zeros(1, np.int64)
            grams.append(g)
            counts.append(c[g])
        sizes = np.array([len(g) for g in grams])
        start = np.cumsum(sizes) - sizes
        doc = np.repeat(np.arange(len(sizes)), sizes)
        logp = self.logp[np.concatenate(grams)]
        c = np.concatenate(counts).astype(np.float64)
        total = np.add.reduceat(c, start)
        top = logp.max(axis=1, keepdims=True)
        p = np.exp(logp - top)
        base = np.add.reduceat(c * top[:, 0], start)

        full = _mixture(np.full((len(sizes), m), 1.0 / m), p, c, doc, start, total, 12)
        # no set of languages can have a likelihood above this one: weights q instead of full gain
        # at most total * log(sum q * gain), by Jensen's inequality
        mixed = np.maximum((full[doc] * p).sum(axis=1), 1e-300)
        gain = np.add.reduceat(p * (c / mixed)[:, None], start, axis=0) / total[:, None]
        bound = base + np.add.reduceat(c * np.log(mixed), start) + total * np.log(np.maximum(gain.max(axis=1), 1.0))
        order = np.argsort(-full, axis=1, kind="stable")
        cost = self.penalty * np.log(total + 1)
        best = np.full(len(sizes), -np.inf)
        pick = np.zeros((len(sizes), m))
        live = np.arange(len(sizes))  # texts for which a larger set may still be the best
        for k in range(1, m + 1):
            if not len(live):
                break
            rows = np.flatnonzero(np.isin(doc, live)) if len(live) < len(sizes) else np.arange(len(doc))
            n_k = sizes[live]
            start_k = np.cumsum(n_k) - n_k
            doc_k = np.repeat(np.arange(len(live)), n_k)
            langs = order[live, :k]
            pk, ck = np.take_along_axis(p[rows], langs[doc_k], axis=1), c[rows]
            pi = np.take_along_axis(full[live], langs, axis=1) + 1e-9
            pi = pi / pi.sum(axis=1, keepdims=True)
            if k > 1:
                pi = _mixture(pi, pk, ck, doc_k, start_k, total[live], 8)
            like = base[live] + np.add.reduceat(ck * np.log((pi[doc_k] * pk).sum(axis=1) + 1e-300), start_k)
            value = like - k * cost[live]
            better = value > best[live]
            at = live[better]
            best[at] = value[better]
            pick[at] = 0
            pick[at[:, None], langs[better]] = pi[better]
            live = live[bound[live] - (k + 1) * cost[live] > best[live]]
        out[ok] = pick
        return out, ok


def fit(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
        per_lang: int = PER_LANG, smooth: float = 0.5) -> LanguageModel:
    """Learn from the labelled rows of ``df`` (null labels and texts are skipped).

    ``per_lang`` bounds the texts read of each language: a text is taken, once however often
    it repeats, when a hash of it is under ``per_lang / distinct texts of its language``; ids
    play no part.  No labelled row gives a model without languages, which predicts ``und``.
    The model on the driver has languages x ``BUCKETS`` numbers.
    """
    rows = df.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text")).filter(F.col("lang").isNotNull() & F.col("text").isNotNull())
    rows = rows.withColumn("key", F.xxhash64("text"))
    share = rows.groupBy("lang", "key").agg(F.lit(1).alias("one")).groupBy("lang").agg(F.count("*").alias("n"))
    taken = (with_small(rows, share, ["lang"]).filter(unit_hash(F.col("key"), seed=9) * F.col("n") < per_lang)
             .select("lang", "text").distinct())

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                sums.setdefault(lang, np.zeros(BUCKETS, np.int64))
                sums[lang] += np.bincount(trigrams(text.as_py()), minlength=BUCKETS)
        for lang, s in sums.items():
            at = np.flatnonzero(s)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at, pa.int32()), pa.array(s[at], pa.int64())],
                                             ["lang", "gram", "n"])

    sums = taken.mapInArrow(count, "lang string, gram int, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    got = sums.toPandas()  # at most languages x BUCKETS rows
    langs = sorted(got["lang"].unique())
    counts = np.zeros((BUCKETS, len(langs)))
    place = {x: i for i, x in enumerate(langs)}
    counts[got["gram"].to_numpy(), got["lang"].map(place).to_numpy(dtype=np.int64)] = got["n"].to_numpy()
    counts += smooth
    return LanguageModel(langs, np.log(counts / counts.sum(axis=0, keepdims=True)) if langs else counts)


def predict_column(spark, model: LanguageModel, text: Column) -> Column:
    """``struct(lang_pred, score, langs, shares)`` of a text column; one pass, no shuffle."""
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double, langs array<string>, shares array<double>")
    def run(series: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        m = shared.value
        for s in series:
            rows = []
            for texts in sized_batches(s):
                shares, ok = m.infer(texts)
                for p, good in zip(shares, ok):
                    at = [i for i in np.argsort(-p, kind="stable") if p[i] > 0] if good else []
                    if at:
                        rows.append((m.langs[at[0]], float(min(p[at[0]], 1.0)), [m.langs[i] for i in at], [float(p[i]) for i in at]))
                    else:
                        rows.append((UND, 0.0, [], []))
            yield pd.DataFrame(rows, columns=["lang_pred", "score", "langs", "shares"])
        release()

    return run(text)


def training_rows(df: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Rows that may be learnt from: crc32(id as text) mod 4 is not 2."""
    return df.filter(crc_mod(F.col(id_col), 4) != 2)


def identify(df: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, held_out, lang_pred, score, langs, shares)``, one row per row of ``df``.

    ``lang_pred`` is the language of the largest share and ``score`` that share; ``langs``
    and ``shares`` list the chosen set.  A null text or one without a letter is ``und``
    with score 0 and empty lists.  A null id counts as the empty text for ``held_out``.
    """
    rows = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    rows = rows.withColumn("p", predict_column(df.sparkSession, model, F.col("text")))
    return rows.select("doc_id", (crc_mod(F.col("doc_id"), 4) == 2).alias("held_out"), "p.lang_pred", "p.score", "p.langs", "p.shares")
