import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from versus.llm import licenses

SCHEMA = "doc_id long, text string, path string, score string, license int"


def run(spark, rows):
    df = spark.createDataFrame([(i, t, p, "x", 1) for i, t, p in rows], SCHEMA)
    return licenses.scan(df, F.col("path")).collect()


def brute(texts, line):
    """Cosines of a line with every template, without the anchor words' short cut."""
    n = len(texts)
    df = Counter(w for t in texts for w in set(licenses.tokens(t or "")))
    names = {w for _, t in licenses.TEMPLATES for w in licenses.tokens(t)}

    def vec(text):
        return {w: k * (math.log((1 + n) / (1 + (df[w] if w in names else 0))) + 1) for w, k in Counter(licenses.tokens(text)).items()}

    def cos(a, b):
        size = math.sqrt(sum(x * x for x in a.values()) * sum(x * x for x in b.values()))
        return sum(x * b.get(w, 0) for w, x in a.items()) / size if size else 0.0

    return max((cos(vec(line), vec(t)), name) for name, t in licenses.TEMPLATES)


def test_documents_equal_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()
    texts = [r.text for r in docs]
    m = licenses.fit(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))
    for r in docs:
        best = max((brute(texts, line) for line in r.text.split("\n") if "icens" in line or "eserved" in line or "domain" in line), default=(0.0, None))
        name, score, _ = m.scan(r.text)
        if best[0] >= licenses.THRESHOLD:
            assert name == best[1] and score == pytest.approx(min(best[0], 1.0))
        else:
            assert name is None


def test_inheritance_from_the_nearest_directory(spark):
    mit, gpl = "Released under the MIT License.", "This work is licensed under the GNU General Public License, version 3."
    rows = [(1, mit, "a/LICENSE"), (2, gpl, "a/b/c/LICENSE"), (3, "plain words", "a/x"), (4, "plain words", "a/b/x"), (5, "plain", "a/b/c/d/x"),
            (6, f"words before\n{mit}\nand " + "many words after " * 40, "a/b/c/x"), (7, "plain", "other/x"), (8, "plain", "ab/x"), (9, None, "a/y"), (9, None, "a/y"),
            (10, gpl, None), (None, "", "a/b/z"), (11, "plain", "rootless"), (12, "word " * 300_000, "a/long")]
    got = {}
    for r in run(spark, rows):
        got.setdefault(r.doc_id, []).append((r.license, r.found, r.from_dir))
    assert got[1] == [("MIT", "file", None)] and got[2] == [("GPL-3.0", "file", None)]
    assert got[3] == got[4] == got[None] == got[12] == [("MIT", "inherited", "a")]
    assert got[5] == [("GPL-3.0", "inherited", "a/b/c")]
    assert got[6] == [("MIT", "header", None)]
    assert got[7] == got[8] == got[11] == [(None, None, None)]
    assert got[9] == [("MIT", "inherited", "a")] * 2 and got[10] == [("GPL-3.0", "file", None)]
    assert run(spark, []) == []
