import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from versus.llm import simhash
from versus.llm.components import connected_components


def brute_fp(text, k=4):
    words, word = [], b""
    for c in (text or "").encode() + b" ":
        if c == 32 or 9 <= c <= 13:
            words += [word] if word else []
            word = b""
        else:
            word += bytes([c + 32 if 65 <= c <= 90 else c])
    if not words:
        return 0
    sh = [b" ".join(words[i:i + k]) for i in range(len(words) - k + 1)] or [b" ".join(words)]
    hs = [xxhash.xxh64_intdigest(s, 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_components(ids, fps, bits):
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(ids)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= bits:
                a, b = sorted((find(ids[i]), find(ids[j])))
                parent[b] = a
    return {i: find(i) for i in ids}


SCHEMA = "doc_id long, text string, fp string, component_id int, block int"


def run(spark, rows, **kw):
    df = spark.createDataFrame([(i, t, "x", 1, 2) for i, t in rows], SCHEMA)
    return simhash.near_duplicates(df, **kw).collect()


def test_documents_equal_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = {r.doc_id: r for r in simhash.near_duplicates(docs).collect()}
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    fps = [brute_fp(t) for _, t in rows]
    want = brute_components([i for i, _ in rows], fps, 4)
    for (i, _), fp in zip(rows, fps):
        assert got[i].fingerprint == f"{fp:016x}"
        assert got[i].component_id == want[i]


@pytest.mark.parametrize("bits", [0, 1, 2, 3, 4, 5])
@pytest.mark.parametrize("cell", [64, 2048])
def test_links_lose_nothing(spark, bits, cell):
    """Clusters whose members differ by a few bits, some of them chains."""
    rng = random.Random(bits)
    fps = set()
    for _ in range(40):
        x = rng.getrandbits(64)
        for _ in range(12):
            fps.add(x)
            for b in rng.sample(range(64), rng.randint(0, 6)):
                x ^= 1 << b
    centre = rng.getrandbits(64)  # one crowded neighbourhood
    for _ in range(300):
        fps.add(centre ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 3))))
    fps = sorted(fps)
    signed = np.array(fps, np.uint64).view(np.int64).tolist()
    reps = spark.createDataFrame(list(zip(signed, range(len(fps)))), "fp long, rep long")
    comp = {r.node: r.component for r in connected_components(simhash.links(reps, bits, cell)).collect()}
    want = brute_components(list(range(len(fps))), fps, bits)
    assert {i: comp.get(i, i) for i in want} == want


def test_block_plan_covers_every_threshold():
    for bits in range(9):
        plan = simhash.block_plan(bits)
        assert sum(w for _, w, _ in plan) == 64
        assert sum(t + 1 for _, _, t in plan) == bits + 1


def test_edge_cases(spark):
    rows = [(5, None), (7, ""), (3, " \n "), (9, "a b c d e"), (4, "A B C D E"), (None, "a b c d e"), (4, "A B C D E"), (11, "word")]
    got = run(spark, rows)
    by = sorted((r.doc_id is None, r.doc_id, r.fingerprint, r.component_id) for r in got)
    assert len(got) == len(rows)
    assert {r.component_id for r in got if r.doc_id in (5, 7, 3)} == {3}
    assert all(r.fingerprint == "0" * 16 for r in got if r.doc_id in (5, 7, 3))
    assert {r.component_id for r in got if r.doc_id in (9, 4)} == {4}
    assert by[-1][0] and by[-1][3] is None
    assert run(spark, []) == []


def test_very_long_text_and_hot_fingerprint(spark):
    text = " ".join(random.Random(1).choice(["alpha", "beta", "gamma", "delta"]) + str(i % 97) for i in range(60_000))
    got = run(spark, [(1, text), (2, text + " end")] + [(10 + i, "same words in every copy here") for i in range(500)])
    by = {r.doc_id: r.component_id for r in got}
    assert by[1] == by[2] == 1
    assert {by[10 + i] for i in range(500)} == {10}


def test_components_of_a_long_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(1, i) for i in range(2, 90)] + [(7, 7), (None, 3)]
    df = spark.createDataFrame(edges, "a long, b long")
    comp = {r.node: r.component for r in connected_components(df).collect()}
    assert comp == {**{i: 100 for i in range(100, 161)}, **{i: 1 for i in range(1, 90)}}
    assert connected_components(df.filter(F.lit(False))).count() == 0
