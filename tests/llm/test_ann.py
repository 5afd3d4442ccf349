import numpy as np
import pytest

from versus.llm import ann


def brute(ids, x, every, k):
    out = {}
    for i, q in zip(ids, x):
        if i % every == 0:
            s = (x * q).sum(axis=1)
            at = [j for j in np.lexsort((ids, -s)) if ids[j] != i][:k]
            out[i] = [(int(ids[j]), float(s[j])) for j in at]
    return out


def collected(df):
    got = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r.rank)):
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(got[r.query_id])
    return got


def test_chi_square():
    assert ann.chi_square_cdf(15.507, 8) == pytest.approx(0.95, abs=1e-4)
    assert ann.chi_square_quantile(0.95, 8) == pytest.approx(15.507, abs=1e-3)


def test_projected_distances_are_chi_square():
    rng = np.random.default_rng(0)
    x = rng.standard_normal((4000, 64)) * rng.random((4000, 1))
    q = rng.standard_normal((1, 64))
    p = ann.Projection(64, float((x * x).sum(1).max()))
    d = (q * q).sum() + p.top - 2 * (x @ q[0])
    many = [float(((ann.Projection(64, p.top, seed=s).rows(x[:1]) - ann.Projection(64, p.top, seed=s).queries(q)) ** 2).sum() / d[0]) for s in range(400)]
    assert np.mean(np.array(many) < 15.507) == pytest.approx(0.95, abs=0.04)


@pytest.mark.parametrize("cell", [100, 8192])
def test_recall_on_embeddings(spark, cell):
    df = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    rows = df.collect()
    ids, x = np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], np.float64)
    want, got = brute(ids, x, 20, 20), collected(ann.nearest(df, cell_rows=cell))
    assert set(got) == set(want)
    score = {(i, j): s for i, own in want.items() for j, s in own}
    hits = [len({j for j, _ in got[i]} & {j for j, _ in want[i]}) / 20 for i in want]
    assert np.mean(hits) >= 0.95
    for i, own in got.items():
        assert len(own) == 20 and i not in [j for j, _ in own]
        assert all(s == score[i, j] for j, s in own if (i, j) in score)
        assert own == sorted(own, key=lambda t: (-t[1], t[0]))


SCHEMA = "vec_id long, embedding array<float>, score int, cell string"


def test_edge_cases(spark):
    same = [1.0, 0.0, 0.0]
    rows = [(0, same), (None, same), (40, None), (60, [0.0, 0.0, 0.0]), (80, [1.0, None, 0.0]), (100, [float("nan"), 1.0, 0.0]), (120, [float("inf"), 1.0, 0.0]),
            (140, [1.0]), (160, []), (20, [0.5, 2.0, 0.0]), (20, [0.5, 2.0, 0.0])] + [(1000 + i, same) for i in range(1, 400)] + [(5, [3.0, 0.0, 1.0])]
    df = spark.createDataFrame([(*r, 1, "c") for r in rows], SCHEMA)
    got = collected(ann.nearest(df, cell_rows=64))
    assert set(got) == {0, 20} | {1000 + i for i in range(20, 400, 20)}
    assert got[0] == [(5, 3.0)] + [(1000 + i, 1.0) for i in range(1, 20)]
    assert got[1200][1:] == [(0, 1.0)] + [(1000 + i, 1.0) for i in range(1, 19)]
    assert got[20][0] == (5, 1.5) and len(got[20]) == 20
    few = collected(ann.nearest(df.filter("vec_id in (0, 5, 20)"), cell_rows=64))
    assert few[0] == [(5, 3.0), (20, 0.5), (20, 0.5)] and few[20] == [(5, 1.5), (0, 0.5)]
    assert ann.nearest(df.limit(0)).count() == 0


def test_unequal_norms(spark):
    rng = np.random.default_rng(1)
    x = rng.standard_normal((3000, 16)).astype(np.float32) * rng.lognormal(size=(3000, 1)).astype(np.float32)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    want, got = brute(np.arange(3000), x.astype(np.float64), 50, 10), collected(ann.nearest(df, every=50, k=10, cell_rows=500))
    assert np.mean([len({j for j, _ in got[i]} & {j for j, _ in want[i]}) / 10 for i in want]) >= 0.95
