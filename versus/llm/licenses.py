"""Licence scans: sparse TF-IDF cosine to templates, then inheritance along paths.

Every line of a text is a vector of TF-IDF weights, and so is every template (a licence
notice).  A line whose cosine to its best template reaches ``threshold`` is a licence
header of its document.  A document that is little else than a notice (the cosine of its
whole text reaches it too) is a licence file and speaks for its directory.  Documents
without a header inherit from the nearest ancestor directory that has a licence file.

At scale: the corpus is asked only for the document frequencies of the templates' few
words (an aggregate), so a task holds the templates and one batch of texts.  Ancestors
are joined as rows (document, directory), a few narrow ones a document, and the nearest
is an aggregate; no directory is gathered.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut_lineage, release

# fixed values: short notices of common licences
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("MPL-2.0", "This file is subject to the terms of the Mozilla Public License, version 2.0."),
    ("proprietary", "All rights reserved."),
    ("public-domain", "This work is dedicated to the public domain."),
)
THRESHOLD = 0.7
_TOKEN = re.compile(r"[^\W_]+(?:[.-][^\W_]+)*")


def tokens(text: str) -> list[str]:
    return _TOKEN.findall(text.lower())


class Matcher:
    """Cosine of token lists to the templates; words no template has weigh like unseen ones."""

    def __init__(self, frequency: dict[str, int], documents: int, templates=TEMPLATES, threshold: float = THRESHOLD):
        self.threshold, self.n = threshold, documents
        self.counts = [(name, Counter(tokens(text))) for name, text in templates]
        words = {w for _, c in self.counts for w in c}
        self.idf = {w: math.log((1 + documents) / (1 + frequency.get(w, 0))) + 1.0 for w in words}
        self.unseen = math.log(1 + documents) + 1.0
        self.vectors = []
        for name, c in self.counts:
            v = {w: k * self.idf[w] for w, k in c.items()}
            norm = math.sqrt(sum(x * x for x in v.values()))
            self.vectors.append((name, {w: x / norm for w, x in v.items()}))
        # a line without any of these shares so little weight with each template that it cannot reach the threshold
        need: set[str] = set()
        for _, v in self.vectors:
            weak, total = sorted(v.items(), key=lambda x: x[1]), 0.0
            for w, x in weak:
                total += x * x
                if math.sqrt(total) >= threshold:
                    need.add(w)
        self.anchors = re.compile(r"(?<![^\W_])(?:" + "|".join(map(re.escape, sorted(need, key=lambda w: (-len(w), w)))) + r")(?![^\W_])")

    def best(self, words: list[str]) -> tuple[float, str | None]:
        """Largest cosine and its template (ties: first by name)."""
        if not words:
            return 0.0, None
        v = {w: k * self.idf.get(w, self.unseen) for w, k in Counter(words).items()}
        norm = math.sqrt(sum(x * x for x in v.values()))
        found = [(sum(x * t.get(w, 0.0) for w, x in v.items()) / norm, name) for name, t in self.vectors]
        score = max(s for s, _ in found)
        return (score, min(name for s, name in found if s == score)) if score > 0 else (0.0, None)

    def scan(self, text: str | None) -> tuple[str | None, float, bool]:
        """``(license, score, file)`` of a text: its best header line, and whether the text is a
        licence file."""
        low = (text or "").lower()
        best: tuple[float, str | None] = (0.0, None)
        seen = -1
        for m in self.anchors.finditer(low):
            if m.start() <= seen:
                continue
            begin, end = low.rfind("\n", 0, m.start()) + 1, low.find("\n", m.end())
            seen = end if end >= 0 else len(low)
            found = self.best(tokens(low[begin:seen]))
            if found[1] and (found[0] > best[0] or found[0] == best[0] and found[1] < (best[1] or "~")):
                best = found
        if best[1] is None or best[0] < self.threshold:
            return None, 0.0, False
        return best[1], min(best[0], 1.0), self.best(tokens(low))[0] >= self.threshold


def fit(df: DataFrame, text_col: str = "text", threshold: float = THRESHOLD) -> Matcher:
    """Document frequencies of the templates' words over the whole corpus."""
    words = frozenset(w for _, t in TEMPLATES for w in tokens(t))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for batch in batches:
            for t in batch.column(0):
                seen.update(words.intersection(_TOKEN.findall((t.as_py() or "").lower())))
                seen[""] += 1
        yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())], ["word", "n"])
        release()

    rows = df.select(F.col(text_col)).mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).collect()  # the templates' words
    got = {r.word: r.n for r in rows}
    return Matcher(got, got.pop("", 0), threshold=threshold)


def scan_column(spark, matcher: Matcher, text: Column) -> Column:
    shared = spark.sparkContext.broadcast(matcher)

    @F.pandas_udf("license string, score double, file boolean")
    def run(series: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for s in series:
            yield pd.DataFrame([shared.value.scan(t) for t in s], columns=["license", "score", "file"])
        release()

    return run(text)


def scan(df: DataFrame, path: Column, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``(doc_id, path, license, score, found, from_dir)``, one row per row of ``df``.

    ``found`` is ``header``, ``file`` or ``inherited`` (null: no licence); an inherited one has
    the score of its licence file and the directory it comes from.  A directory's licence is
    that of its best file (ties: smaller name).  Null texts count as empty; a row without a
    path has only its own headers; the root directory is the empty path.
    """
    matcher = fit(df, text_col, threshold)
    rows = df.select(F.col(id_col).alias("doc_id"), path.cast("string").alias("path"), F.col(text_col).alias("text"))
    rows = rows.withColumn("m", scan_column(df.sparkSession, matcher, F.col("text")))
    own = cut_lineage(rows.select("doc_id", "path", "m.license", "m.score", "m.file").withColumn("parent", F.regexp_replace("path", "/?[^/]*$", "")))
    files = own.filter(F.col("file") & F.col("parent").isNotNull()).groupBy(F.col("parent").alias("dir")).agg(
        F.min(F.struct((-F.col("score")).alias("worse"), F.col("license").alias("name"))).alias("best"))
    files = files.select("dir", F.col("best.name").alias("dir_license"), (-F.col("best.worse")).alias("dir_score"), F.length("dir").alias("depth"))
    # directories are few beside documents: each inherits once, then documents meet their own directory
    parts = F.split("parent", "/")
    above = F.transform(F.sequence(F.lit(0), F.size(parts)), lambda i: F.array_join(F.slice(parts, F.lit(1), i), "/"))
    dirs = own.filter(F.col("parent").isNotNull()).select("parent").distinct().select("parent", F.explode(F.array_distinct(above)).alias("dir"))
    nearest = dirs.join(files, "dir").groupBy("parent").agg(F.max_by(F.struct("dir", "dir_license", "dir_score"), "depth").alias("from"))
    joined = own.join(nearest, "parent", "left")
    has = F.col("license").isNotNull()
    return joined.select(
        "doc_id", "path", F.coalesce("license", "from.dir_license").alias("license"), F.when(has, F.col("score")).otherwise(F.coalesce("from.dir_score", F.lit(0.0))).alias("score"),
        F.when(F.col("file"), "file").when(has, "header").when(F.col("from").isNotNull(), "inherited").alias("found"),
        F.when(~has, F.col("from.dir")).alias("from_dir"))
