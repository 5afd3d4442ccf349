"""Edge cases the driver tables do not contain: NULL keys, foreign sides,
duplicates, NaN / inf, constant and all-NULL columns, ties, unseen levels."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from versus.functions import scalars as S
from versus.operators import clean as C
from versus.operators import encoders as EN
from versus.operators import evaluate as EV
from versus.operators import relational as R
from versus.operators import split as SP
from versus.operators import stats as ST
from versus.operators.ordered import exact_quantiles, ordered_prefix, ordered_rank


def test_safe_ratio_and_binarize(spark):
    df = spark.createDataFrame([(1.0, 0.0), (None, 2.0), (3.0, None), (-1.0, 4.0)], "n double, d double")
    out = df.select(S.safe_ratio("n", "d").alias("r"), S.binarize("n").alias("b")).collect()
    assert out[0].r == pytest.approx(1e6) and out[1].r == 0.0 and out[2].r == pytest.approx(3e6)
    assert [r.b for r in out] == [1, 0, 1, 0]


def test_coerce_and_inf(spark):
    df = spark.createDataFrame([("12",), ("x",), (None,), ("3.5",)], "s string")
    got = [r[0] for r in df.select(S.coerce_int("s")).collect()]
    assert got == [12, None, None, None]
    f = spark.createDataFrame([(float("inf"),), (float("nan"),), (2.0,)], "x double")
    assert [r.x for r in C.inf_to_null(f).collect()] == [None, None, 2.0]


def test_normalize_role_order_and_fallback(spark):
    rows = [(" Jungler ", None, 1), ("weird", "SUPPORT", 2), ("none", "nan", 3), (None, None, 7), (None, None, None)]
    df = spark.createDataFrame(rows, "position string, role string, player long")
    got = [r[0] for r in df.select(S.normalize_role("position", "role", slot="player")).collect()]
    assert got == ["jungle", "support", "mid", "jungle", "unknown"]


def test_infer_side_keeps_present_values(spark):
    df = spark.createDataFrame([(None, 3), (200, 1), (None, 6), (None, None)], "teamid long, player long")
    got = [r[0] for r in df.select(S.fill_side("teamid", "player")).collect()]
    assert got == [100, 200, 200, None]


def test_detect_binary_ignores_all_null(spark):
    df = spark.createDataFrame([(0.0, None, 1.0), (1.0, None, 2.0), (None, None, 0.0)], "a double, b double, c double")
    assert R.detect_binary(df, ["a", "b", "c"]) == ["a"]


def test_group_label_tie_and_consistency(spark):
    df = spark.createDataFrame([(1, 100, 1), (1, 100, 0), (1, 200, 0), (1, 200, 0)], "matchid long, teamid long, win int")
    got = {r.teamid: r for r in R.derive_group_label(df).collect()}
    assert got[100].win == 1 and got[100].participant_win_inconsistent == 1
    assert got[100].participant_win_consistency == 0.5
    assert got[200].win == 0 and got[200].participant_win_consistency == 1.0


def test_integrity_filter_rules(spark):
    rows = [(1, 100, 1), (1, 200, 0),          # valid
            (2, 100, 1),                       # one side
            (3, 100, 1), (3, 200, 1),          # two winners
            (4, 100, 0), (4, 300, 1),          # foreign side dropped -> one side
            (None, 100, 1)]                    # null key
    df = spark.createDataFrame(rows, "matchid long, teamid long, win int")
    assert sorted(r.matchid for r in C.group_integrity_filter(df).collect()) == [1, 1]


def test_integrity_filter_raises_on_duplicate_keys(spark):
    df = spark.createDataFrame([(1, 100, 1), (1, 100, 0), (1, 200, 0)], "matchid long, teamid long, win int")
    with pytest.raises(Exception, match="more than once"):
        C.group_integrity_filter(df).collect()


def test_violation_counts(spark):
    rows = [(1, 100, 1), (1, 100, 0), (2, 300, 1), (3, 100, 1), (3, 200, 0), (4, 100, 1), (4, 200, 1)]
    df = spark.createDataFrame(rows, "matchid long, teamid long, win int")
    r = C.violation_counts(df).first()
    assert r.rows == 7 and r.duplicate_match_team_rows == 1 and r.invalid_teamid_rows == 1
    assert r.unique_matches == 4 and r.invalid_match_team_count == 2 and r.invalid_winner_matches == 1


def test_clip_keeps_null_for_dynamic_columns(spark):
    df = spark.createDataFrame([(1, 100, -2.0, None), (1, 200, 3.0, -1.0)], "matchid long, teamid long, kills double, other double")
    out = C.clip_non_negative(df).orderBy("teamid").collect()
    assert out[0].kills == 0.0 and out[0].other is None and out[1].other == 0.0


def test_ordered_prefix_matches_pandas(spark):
    rng = np.random.default_rng(0)
    pdf = pd.DataFrame({"g": rng.integers(0, 3, 500), "s": rng.normal(size=500), "v": rng.integers(0, 5, 500)})
    pdf = pdf.drop_duplicates(["g", "s"])
    out = ordered_prefix(spark.createDataFrame(pdf), ["s"], ["v"], ["g"], bins=7).toPandas()
    exp = pdf.sort_values(["g", "s"]).assign(c=lambda d: d.groupby("g")["v"].cumsum())
    merged = out.merge(exp, on=["g", "s"])
    assert (merged["cum_v"] == merged["c"]).all() and len(merged) == len(pdf)


def test_ordered_rank_descending_and_counts(spark):
    df = spark.createDataFrame([(float(i),) for i in range(100)], "s double")
    out = ordered_rank(df, ["s"], name="r", bins=5, with_count="n").collect()
    assert all(r.r == int(r.s) and r.n == 100 for r in out)


def test_exact_quantiles_match_numpy(spark):
    rng = np.random.default_rng(1)
    x = np.round(rng.normal(size=999), 2)
    df = spark.createDataFrame(pd.DataFrame({"x": x, "y": x * 2}))
    got = {(r.feature, r.p): r.value for r in exact_quantiles(df, ["x", "y"], [0.05, 0.25, 0.5, 0.75, 0.95], bins=9).collect()}
    for p in [0.05, 0.25, 0.5, 0.75, 0.95]:
        assert got[("x", p)] == pytest.approx(np.quantile(x, p))
        assert got[("y", p)] == pytest.approx(np.quantile(x * 2, p))


def _auc_bruteforce(y, s):
    pos = [a for a, b in zip(s, y) if b == 1]
    neg = [a for a, b in zip(s, y) if b == 0]
    tot = sum(1.0 if p > n else 0.5 if p == n else 0.0 for p in pos for n in neg)
    return tot / (len(pos) * len(neg))


def _ap_bruteforce(y, s):
    order = sorted(set(s), reverse=True)
    P = sum(y)
    ap, prev_r = 0.0, 0.0
    for t in order:
        tp = sum(1 for a, b in zip(s, y) if a >= t and b == 1)
        fp = sum(1 for a, b in zip(s, y) if a >= t and b == 0)
        r = tp / P
        ap += (r - prev_r) * (tp / (tp + fp))
        prev_r = r
    return ap


def test_rank_metrics_bruteforce_with_ties(spark):
    rng = np.random.default_rng(2)
    y = rng.integers(0, 2, 300).tolist()
    s = (np.round(rng.random(300), 1)).tolist()  # heavy ties
    df = spark.createDataFrame(list(zip(y, s)), "label int, score double")
    r = EV.rank_metrics(df).first()
    assert r.roc_auc == pytest.approx(_auc_bruteforce(y, s))
    assert r.pr_auc == pytest.approx(_ap_bruteforce(y, s))
    area = EV.curve_area(EV.roc_curve(df)).first().area
    assert area == pytest.approx(r.roc_auc)


def test_rank_metrics_single_class_is_null(spark):
    df = spark.createDataFrame([(1, 0.2), (1, 0.9)], "label int, score double")
    r = EV.rank_metrics(df).first()
    assert r.roc_auc is None and r.pr_auc is None


def test_counting_metrics_zero_division(spark):
    df = spark.createDataFrame([(0, 0, 0.1), (0, 0, 0.2)], "label int, pred int, score double")
    r = EV.counting_metrics(df).first()
    assert r.precision == 0.0 and r.recall == 0.0 and r.f1 == 0.0 and r.accuracy == 1.0


def test_mcnemar_pvalue(spark):
    df = spark.createDataFrame([(1, 1, 0)] * 10 + [(1, 0, 1)] * 2 + [(0, 0, 0)] * 5, "y int, p1 int, p2 int")
    r = EV.with_mcnemar_pvalue(EV.mcnemar(df, "y", "p1", "p2")).first()
    assert r.statistic == pytest.approx((abs(10 - 2) - 1) ** 2 / 12)
    assert r.pvalue == pytest.approx(math.erfc(math.sqrt(r.statistic / 2)))


def test_target_encoding_unseen_and_null(spark):
    train = spark.createDataFrame([(1, 1), (1, 0), (2, 1), (None, 1)], "c long, win int")
    enc = EN.fit_target_encoding(train, ["c", "missing"], smoothing=2.0)
    prior = 0.75
    assert enc.prior == prior and enc.columns == ["c"]
    vals = {r.category: r.value for r in enc.table.collect()}
    assert vals["1"] == pytest.approx((0.5 * 2 + prior * 2) / 4)
    test = spark.createDataFrame([(1,), (3,), (None,)], "c long")
    got = [r.c_winrate_te for r in EN.apply_encoding(test, enc).orderBy(F.col("c").asc_nulls_last()).collect()]
    assert got[1] == prior and got[2] == prior


def test_encoding_fallback_constant(spark):
    train = spark.createDataFrame([(None, 1), (None, 0)], "c long, win int")
    enc = EN.fit_target_encoding(train, ["c"])
    out = EN.apply_encoding(train, enc)
    assert "champion_signal_prior" in out.columns and out.first().champion_signal_prior == 0.5


def test_category_codes_unseen_minus_one(spark):
    train = spark.createDataFrame([("b",), ("a",), (None,)], "p string")
    codes = EN.fit_category_codes(train, "p")
    assert {r.category: r.value for r in codes.collect()} == {"a": 0, "b": 1, "unknown": 2}
    test = spark.createDataFrame([("a",), ("z",), (None,)], "p string")
    got = [r.code for r in EN.apply_category_codes(test, "p", "code", codes).orderBy("code").collect()]
    assert sorted(got) == [-1, 0, 2]


@pytest.mark.parametrize("counts, cap, want", [
    ({0: 900, 1: 100}, 100, {0: 90, 1: 10}),
    ({0: 1, 1: 1000}, 10, {0: 1, 1: 9}),           # a class keeps one row, the largest gives it
    ({0: 500}, 7, {0: 7}),                         # a single class
    ({0: 3, 1: 3, 2: 3}, 8, {0: 3, 1: 3, 2: 2}),   # what the floors leave goes by room
    ({0: 50, None: 50}, 10, {0: 5, None: 5}),      # a NULL class is a class
    ({0: 1000, 1: 3000, **{i: 1 for i in range(2, 52)}}, 100, {0: 24, 1: 26, **{i: 1 for i in range(2, 52)}}),  # the cap holds
    ({0: 3, 1: 2, 2: 2, 3: 1}, 3, {0: 1, 1: 1, 2: 1, 3: 0}),  # more classes than the cap
])
def test_class_quotas(spark, counts, cap, want):
    df = spark.createDataFrame(list(counts.items()), "y int, count long")
    assert {r.y: r.quota for r in SP.class_quotas(df, "y", cap).collect()} == want


def test_stratified_cap_and_split_with_null_class(spark):
    rows = [(i, None if i % 10 == 0 else i % 2) for i in range(1000)]
    df = spark.createDataFrame(rows, "id long, y int")
    kept = SP.stratified_cap(df, "y", ["id"], 100)
    got = {r.y: r["count"] for r in kept.groupBy("y").count().collect()}
    assert got == {None: 10, 0: 40, 1: 50}
    split = SP.split_stratified(df, "y", ["id"]).groupBy("y", "split").count().collect()
    n = {(r.y, r.split): r["count"] for r in split}
    assert n[None, "test"] == 20 and n[None, "val"] == 10 and n[None, "train"] == 70


def test_ordered_prefix_tied_hot_group_and_null_keys(spark):
    from versus.operators.ordered import ordered_rank, range_bins
    rng = np.random.default_rng(3)
    rows = [(None if i % 3 == 0 else 1 if i % 3 == 1 else int(rng.integers(5)), int(rng.integers(2)), f"t{int(rng.integers(10**9)):010d}", i) for i in range(6000)]
    df = spark.createDataFrame(rows, "g int, a int, b string, id long")
    got = {r.id: r.r for r in ordered_rank(df, ["a", "b", "id"], ["g"], name="r", bins=16).collect()}
    by: dict = {}
    for g, a, b, i in rows:
        by.setdefault(g, []).append((a, b, i))
    for own in by.values():
        for k, (_, _, i) in enumerate(sorted(own)):
            assert got[i] == k
    sizes = [r["count"] for r in range_bins(df, ["g"], ["a", "b", "id"], 16).groupBy("_bin").count().collect()]
    assert len(sizes) >= 14 and max(sizes) < 3 * 6000 / 16  # ties of (g, a) are cut


def test_lookup_sizes_duplicates_and_nulls(spark):
    from versus.operators.relational import lookup_with_default
    df = spark.createDataFrame([("k1",), ("k1",), ("zz",), (None,), ("k9999",)], "k string")
    for n in (10, 20_000):
        table = spark.createDataFrame([(f"k{i}", float(i)) for i in range(n)] + [("k1", 7.0), (None, 5.0)], "category string, value double")
        got = sorted((r.k or "", r.v) for r in lookup_with_default(df, "k", table, "v", -1.0).collect())
        assert got == [("", -1.0), ("k1", 1.0), ("k1", 1.0), ("k9999", 9999.0 if n > 9999 else -1.0), ("zz", -1.0)]


def test_integrity_filter_more_than_two_sides(spark):
    from versus.operators.clean import group_integrity_filter
    rows = [(1, s, int(s == 2)) for s in (1, 2, 3)] + [(2, 1, 1), (2, 3, 0)] + [(3, s, 1) for s in (1, 2, 3)]
    df = spark.createDataFrame(rows, "matchid long, teamid long, win int")
    out = group_integrity_filter(df, sides=(1, 2, 3), expected_sides=3)
    assert sorted((r.matchid, r.teamid) for r in out.collect()) == [(1, 1), (1, 2), (1, 3)]
    twice = spark.createDataFrame([(1, 1, 1), (1, 1, 0), (1, 2, 0)], "matchid long, teamid long, win int")
    with pytest.raises(Exception, match="more than once"):
        group_integrity_filter(twice, sides=(1, 2)).collect()


def test_group_split_keeps_groups_whole(spark):
    df = spark.range(2000).select((F.col("id") % 500).alias("matchid"), F.col("id"))
    out = SP.split_grouped(df).groupBy("matchid").agg(F.countDistinct("split").alias("k"))
    assert out.where("k > 1").count() == 0


@pytest.mark.parametrize("n", [1, 2, 3, 50, 1125, 30_000])
def test_exact_quantiles_of_any_size(spark, n):
    rng = np.random.default_rng(n)
    pdf = pd.DataFrame({"a": rng.normal(size=n), "b": rng.integers(0, 3, n).astype(float), "c": rng.lognormal(size=n), "e": 7.0, "z": np.nan})
    pdf.loc[rng.random(n) < 0.3, "c"] = np.nan
    probs = [0.0, 0.01, 0.25, 0.5, 0.75, 0.999, 1.0]
    got = {(r.feature, r.p): r.value for r in exact_quantiles(spark.createDataFrame(pdf), list("abcez"), probs).collect()}
    for c in "abce":
        for p in probs:
            want = pdf[c].quantile(p)
            assert np.isnan(want) and (c, p) not in got or got[c, p] == pytest.approx(want, abs=1e-12)
    assert not any(c == "z" for c, _ in got)


def test_approx_quantiles_close_to_exact(spark):
    from versus.operators.stats import describe_percentiles
    rng = np.random.default_rng(5)
    df = spark.createDataFrame(pd.DataFrame({"x": rng.normal(size=5000)}))
    ex = describe_percentiles(df, ["x"]).first()
    ap = describe_percentiles(df, ["x"], approx=True).first()
    for k in ("p05", "p25", "p50", "p75", "p95"):
        assert abs(ex[k] - ap[k]) < 0.05


def test_group_rank_hot_group_matches_window(spark):
    from pyspark.sql import Window
    from versus.operators.ordered import group_rank
    rng = np.random.default_rng(11)
    g = np.where(rng.random(3000) < 0.5, 0, rng.integers(1, 50, 3000))  # group 0 holds half of all rows
    pdf = pd.DataFrame({"g": g, "a": rng.integers(0, 20, 3000), "b": rng.random(3000)})
    df = spark.createDataFrame(pdf)
    got = group_rank(df, "g", ["a", "b"], "r", hot_threshold=500, bins=6)
    exp = df.withColumn("e", F.row_number().over(Window.partitionBy("g").orderBy("a", "b")))
    j = got.join(exp, ["g", "a", "b"])
    assert j.count() == 3000 and j.where("r != e").count() == 0


def test_kde_by_cells_equals_the_sum_over_all_values(spark):
    rng = np.random.default_rng(8)
    x = {"a": rng.normal(5, 2, 3000), "b": np.r_[rng.exponential(1.0, 500), 40.0], "one": np.array([3.0, 3.0])}
    df = spark.createDataFrame([(g, float(v)) for g, vs in x.items() for v in vs] + [("a", None)], "g string, x double")
    got = ST.kde_grid(df, "x", "g").toPandas()
    for g in ("a", "b"):
        v, part = x[g], got[got.g == g].sort_values("i")
        bw = v.std(ddof=1) * len(v) ** -0.2
        grid = np.linspace(v.min() - 3 * bw, v.max() + 3 * bw, 200)
        want = np.exp(-0.5 * ((grid[:, None] - v) / bw) ** 2).sum(axis=1) / (bw * np.sqrt(2 * np.pi) * len(v))
        assert np.allclose(part.grid, grid) and np.abs(part.density - want).max() < 1e-5 * want.max()
    assert got[got.g == "one"].density.isna().all() and len(got) == 600


def test_lookup_many_sent_or_shuffled(spark, monkeypatch):
    """The dictionary's way to the rows does not change them; NULL, unseen and repeated rows included."""
    from versus.operators import relational as R
    rows = [("a", "x", 1), ("b", None, 2), (None, "y", 3), ("a", "x", 1), ("unseen", "a", 4)]
    df = spark.createDataFrame(rows, "p string, q string, n int")
    words = spark.createDataFrame([("p", "a", 1.0), ("p", "b", 2.0), ("q", "x", 3.0), ("q", "a", 4.0), ("q", None, 9.0)],
                                  "feature string, category string, value double")
    asked = [R.Lookup("p", F.col("p"), "vp", -1.0), R.Lookup("q", F.col("q"), "vq", -2.0), R.Lookup("q", F.col("p"), "n", 0.5)]
    want = sorted([("a", "x", 1.0, 3.0, 4.0), ("b", None, 2.0, -2.0, 0.5), (None, "y", -1.0, -2.0, 0.5),
                   ("a", "x", 1.0, 3.0, 4.0), ("unseen", "a", -1.0, 4.0, 0.5)], key=str)
    for limits in ((200_000, 64 << 20), (0, 64 << 20), (200_000, 0)):
        monkeypatch.setattr(R, "BROADCAST_LOOKUP_ROWS", limits[0])
        monkeypatch.setattr(R, "BROADCAST_LOOKUP_BYTES", limits[1])
        out = R.lookup_many(df, asked, words)
        assert out.columns == ["p", "q", "vp", "vq", "n"]
        assert sorted(map(tuple, out.collect()), key=str) == want
        assert R.lookup_many(df.limit(0), asked, words).count() == 0
        assert {tuple(r) for r in R.lookup_many(df, asked, words.limit(0)).select("vp", "vq", "n").collect()} == {(-1.0, -2.0, 0.5)}
