import hashlib
import math
import random
import re

import duckdb
import pytest

from tools.oracle_check import digest
from versus.llm import common, mixing
from versus.llm.catalog import ORACLE, QUERIES


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_matches_duckdb(spark, sf):
    con = duckdb.connect()
    for t in ("documents", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('/root/testdata/{sf}/{t}.parquet')")
    df = QUERIES["op8_mixing"](spark, f"/root/testdata/{sf}")
    rows = [tuple(r) for r in df.collect()]
    res = con.execute(ORACLE["op8_mixing"])
    names = [d[0] for d in res.description]
    assert digest(df.columns, rows)[0] == digest(names, res.fetchall())[0]


def reshare(sizes, weights, most):
    """Targets by the contract's words: cut at the cap, reshare the excess, again."""
    total, target = sum(sizes), {}
    open_ = set(range(len(sizes)))
    left = total
    while open_:
        w = sum(weights[i] for i in open_)
        above = [i for i in open_ if left * weights[i] / w > most * sizes[i]]
        if not above:
            target.update({i: left * weights[i] / w for i in open_})
            break
        for i in above:
            target[i] = most * sizes[i]
            left -= target[i]
            open_.remove(i)
    return [target[i] for i in range(len(sizes))]


@pytest.mark.parametrize("seed", range(5))
def test_targets_equal_resharing(spark, seed):
    rng = random.Random(seed)
    sizes = [int(rng.lognormvariate(6, 2)) for _ in range(rng.randint(1, 40))] + [0]
    names = sorted(f"s{i}" for i in range(len(sizes) - 1)) + [None]
    df = spark.createDataFrame(list(zip(names, sizes)), "source string, source_size long")
    got = {r.source: r.target for r in mixing.targets(df).collect()}
    want = reshare(sizes, [(5, 2, 1)[i % 3] for i in range(len(sizes))], 3)
    assert [got[n] for n in names] == pytest.approx(want)
    assert sum(got.values()) == pytest.approx(sum(sizes))


SCHEMA = "doc_id long, text string, source string, size string, target int, copies int, bin int"


def test_equals_sequential_sampling(spark):
    rng = random.Random(3)
    rows = [(i, " ".join(["w"] * rng.randint(0, 60)), "hot" if i % 3 else rng.choice(["a", "b", None])) for i in range(900)]
    quality = {i: i % 2 for i in range(0, 900, 3)}
    labels = spark.createDataFrame(list(quality.items()), "doc_id long, quality int")
    df = spark.createDataFrame([(*r, "x", 1, 2, 3) for r in rows], SCHEMA)
    got = {r.doc_id: r for r in mixing.mix(df, mixing.quality_weights(labels), bins=16).collect()}
    size = {i: len(re.findall(r"[^\x20\x09-\x0D]+", t)) for i, t, _ in rows}
    sources = ["a", "b", "hot", None]
    total = [sum(size[i] for i, _, s in rows if s == name) for name in sources]
    aim = reshare(total, [5, 2, 1, 5], 3)
    for name, words, target in zip(sources, total, aim):
        epochs = int(target // words)
        rest, before, order = target - epochs * words, 0, []
        for i, _, s in rows:
            if s == name:
                u = (int(hashlib.md5(f"{i}:8".encode()).hexdigest()[:12], 16) + 0.5) / 2 ** 48
                order.append((-math.log(u) / (0.5 + 1.5 * quality[i] if i in quality else 1.0), i))
        for _, i in sorted(order):
            copies = epochs + int(size[i] > 0 and before + size[i] / 2 <= rest)
            before += size[i]
            assert (got[i].size, got[i].copies, got[i].taken) == (size[i], copies, copies * size[i])
            assert got[i].target == pytest.approx(target) and got[i].copies <= 3
        taken = sum(got[i].taken for i, _, s in rows if s == name)
        assert abs(taken - target) <= 30


def test_heavier_documents_come_first(spark):
    df = spark.createDataFrame([(i, "one two", "a" if i < 4000 else "b") for i in range(8000)], "doc_id long, text string, source string")
    weights = spark.createDataFrame([(i, 4.0) for i in range(0, 8000, 2)], "doc_id long, weight double")
    rows = [r for r in mixing.mix(df, weights).collect() if r.source == "b"]  # target 2/7 of all: 4/7 of the source
    share = {h: sum(r.copies for r in rows if r.doc_id % 2 == h) / 2000 for h in (0, 1)}
    assert share[0] > 0.75 and share[1] < 0.4


def test_edge_cases(spark):
    rows = [(1, None, "a"), (2, "", "a"), (None, "x y z", None), (3, "p q", "a"), (3, "p q", "a"), (4, "t " * 200_000, "b")]
    df = spark.createDataFrame([(*r, "x", 1, 2, 3) for r in rows], SCHEMA)
    got = mixing.mix(df).collect()
    assert len(got) == len(rows)
    assert all(r.size == 0 and r.taken == 0 for r in got if r.doc_id in (1, 2))
    assert [r.size for r in got if r.doc_id == 4] == [200_000]
    assert sum({(r.source): r.target for r in got}.values()) == pytest.approx(200_007)
    assert mixing.mix(df.limit(0)).count() == 0
    blank = mixing.mix(df.filter("doc_id < 3")).collect()
    assert {(r.target, r.taken) for r in blank} == {(0.0, 0)}


def test_repeated_rows_and_rows_without_ids_equal_sequential_sampling(spark, monkeypatch):
    """Rows of one id share a key, the shorter first; equal rows are counted off in blocks."""
    monkeypatch.setattr(common.numbered, "__defaults__", (64,))
    rng = random.Random(5)
    rows = [(7, "r " * 9, "a")] * 700 + [(None, "n " * rng.randint(0, 12), "a") for _ in range(400)]
    rows += [(i, "w " * rng.randint(0, 30), rng.choice("ab")) for i in range(10, 300)] + [(i, "v " * 20, "b") for i in range(300, 900)]
    rng.shuffle(rows)
    out = [sorted((r.doc_id or -1, r.source, r.size, r.copies) for r in mixing.mix(
        spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(n), bins=8).collect()) for n in (2, 5)]
    assert out[0] == out[1]
    want, words = [], {s: sum(len(t.split()) for _, t, x in rows if x == s) for s in "ab"}
    for name, target in zip("ab", reshare([words["a"], words["b"]], [5, 2], 3)):
        epochs, before, order = int(target // words[name]), 0, []
        for i, t, s in rows:
            if s == name:
                u = (int(hashlib.md5(f"{'' if i is None else i}:8".encode()).hexdigest()[:12], 16) + 0.5) / 2 ** 48
                order.append((-math.log(u), -1 if i is None else i, len(t.split())))
        for _, i, size in sorted(order):
            want.append((i, name, size, epochs + int(size > 0 and before + size / 2 <= target - epochs * words[name])))
            before += size
    assert out[0] == sorted(want)
