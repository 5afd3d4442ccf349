"""What queries move and repeat on large tables: columns that travel, frames stored once, passes that do not grow."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from versus.operators import boosting as B
from versus.operators import evaluate as E
from versus.operators import models as M
from versus.operators import ordered as O
from versus.operators import selection as SEL
from versus.operators import split as SP
from versus.operators import training as TR
from versus.operators.clean import clean_dataset
from versus.plans import catalog_features, catalog_merge, catalog_models, catalog_pipeline, catalog_stats
from versus.plans.registry import tables


@pytest.fixture(scope="module")
def sf(spark, tmp_path_factory):
    """Orders of four lines, all parts known."""
    d = str(tmp_path_factory.mktemp("tables"))
    n = F.col("id")
    li = spark.range(1600).select(
        (n / 4).cast("bigint").alias("l_orderkey"), (n % 7).alias("l_partkey"), (n % 5).alias("l_suppkey"), (n % 50 + 1).cast("double").alias("l_quantity"),
        (n * 37 % 1000 + 1).cast("double").alias("l_extendedprice"), F.lit(0.05).alias("l_discount"), ((n % 9) / 100).alias("l_tax"), (n % 4 + 1).alias("l_linenumber"),
        F.when(n % 3 == 0, "A").when(n % 3 == 1, "R").otherwise("N").alias("l_returnflag"),
        F.when((n % 4 < 2) == (n % 8 < 4), "O").otherwise("F").alias("l_linestatus"), F.lit("1995-01-01").cast("date").alias("l_shipdate"))
    li.coalesce(1).write.parquet(f"{d}/lineitem.parquet")
    spark.range(400).select(n.alias("o_orderkey"), F.lit("1-URGENT").alias("o_orderpriority"), F.lit("1995-01-01").cast("date").alias("o_orderdate"),
                            (n + 1000.5).alias("o_totalprice")).coalesce(1).write.parquet(f"{d}/orders.parquet")
    spark.range(7).select(n.alias("p_partkey"), F.concat(F.lit("Brand#"), n + 11).alias("p_brand"), F.lit("PROMO").alias("p_type")).coalesce(1).write.parquet(f"{d}/part.parquet")
    return d


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_sides_meet_as_they_lie_in_any_session(spark, sf):
    key = "spark.sql.requireAllClusterKeysForCoPartition"
    spark.conf.set(key, "true")
    try:
        tables(spark, sf)
        assert spark.conf.get(key) == "false" or spark.sparkContext.getConf().contains(key)
    finally:
        spark.conf.set(key, "false")


def test_post_game_lines_carry_no_part_columns(spark, sf):
    exchanges = [line for line in _plan(catalog_merge.stage_merged(spark, sf)).splitlines() if "p_type" in line or "p_brand" in line]
    assert not exchanges
    wide = tables(spark, sf, wide=True)
    lean = tables(spark, sf, wide=True, picks=False)
    cols = lean["members"].columns
    assert sorted(wide["members"].select(cols).collect()) == sorted(lean["members"].collect())


@pytest.mark.parametrize("module, query", [(catalog_models, "q_linear_regression_1d"), (catalog_models, "q_score_batch"), (catalog_models, "q_score_stream"),
                                           (catalog_stats, "q_robust_scale"), (catalog_features, "q_stratified_cap")])
def test_cleaned_rows_are_built_once_and_stored(spark, sf, monkeypatch, module, query):
    built, stored = [], []
    make, cut = module.stage_cleaned, module.cut_lineage
    monkeypatch.setattr(module, "stage_cleaned", lambda *a: built.append(1) or make(*a))
    monkeypatch.setattr(module, "cut_lineage", lambda df: stored.append(1) or cut(df))
    assert getattr(module, query)(spark, sf).count() > 0
    assert len(built) == len(stored) == 1


def test_cleaned_rows_stay_where_their_sides_lie(spark, sf):
    """Lines are shuffled by order once; no other exchange carries sides, also where nothing is broadcast."""
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        cleaned = catalog_merge.stage_cleaned(spark, sf)
        rows = cleaned.collect()
    finally:
        spark.conf.set(key, before)
    text = _plan(cleaned).split("== Initial Plan ==")[0]
    above = text.split("HashAggregate")[0]
    assert rows and "Window" in above and "Exchange" not in above


def test_rows_without_nulls_in_their_keys_need_no_fill(spark):
    df = spark.createDataFrame([(1, 100, 1, None), (1, 200, 0, 2.0), (1, 200, 0, 2.0), (2, 100, 1, 1.0), (3, 100, 1, 4.0), (3, 200, 1, 4.0)],
                               "matchid long, teamid long, win int, kills_sum double")
    want = sorted(clean_dataset(df).collect())
    assert [tuple(r) for r in want] == [(1, 100, 1, 0.0), (1, 200, 0, 2.0)]
    assert sorted(clean_dataset(df, never_null=("matchid", "teamid")).collect()) == want
    # a NULL key is filled unless it is named
    gap = spark.createDataFrame([(None, 100, 1, 1.0), (None, 200, 0, 1.0)], df.schema)
    assert sorted(r.matchid for r in clean_dataset(gap).collect()) == [0, 0]


def test_stored_lines_are_read_by_the_columns_of_each_table(spark, sf):
    stored, lines = tables(spark, sf, wide=True).stored(), tables(spark, sf, wide=True)
    assert "ReadSchema" in _plan(stored["teamstats"]) and "l_extendedprice" not in _plan(stored["teamstats"])
    for name in ("members", "teamstats", "teambans"):
        assert stored[name].columns == lines[name].columns
        assert sorted(map(repr, stored[name].collect())) == sorted(map(repr, lines[name].collect()))


def test_the_post_game_build_ranks_lean_lines_and_no_probe_does(spark, sf, monkeypatch):
    asked, built = [], []
    monkeypatch.setattr(catalog_pipeline, "_BUILDS", {})
    make = catalog_pipeline.tables
    monkeypatch.setattr(catalog_pipeline, "tables", lambda *a, **kw: asked.append(kw) or make(*a, **kw))
    monkeypatch.setattr(catalog_pipeline, "build_postgame_features", lambda *a, **kw: built.append(kw) or (None, {}))
    catalog_pipeline._build(spark, sf, "postgame")
    assert asked == [{"wide": True, "picks": False}]
    assert built == [{"binary": ["firstbloodkill"]}]


def test_scaling_of_stored_rows_makes_no_copy(spark, monkeypatch):
    df = spark.range(200).select((F.col("id") * 7 % 31).cast("double").alias("a"), F.when(F.col("id") % 5 > 0, F.col("id") % 2).cast("double").alias("b"))
    copies, cut = [], SEL.cut_lineage
    monkeypatch.setattr(SEL, "cut_lineage", lambda d: copies.append(1) or cut(d))
    want = SEL.scaling_artifact(df, ["a", "b"]).collect()
    assert len(copies) == 1
    assert SEL.scaling_artifact(df, ["a", "b"], stored=True).collect() == want and len(copies) == 1


def test_a_boosting_pass_does_not_walk_the_trees_before_it(spark, monkeypatch):
    rng = np.random.default_rng(3)
    rows = [(int(i), float(a), float(b), int(a + b > 0.2 * c)) for i, (a, b, c) in enumerate(rng.normal(size=(400, 3)))]
    df = spark.createDataFrame(rows, "id long, a double, b double, win int")
    walked = []
    scan = B._histograms
    monkeypatch.setattr(B, "_histograms", lambda *a, **kw: walked.append(a) or scan(*a, **kw))
    monkeypatch.setattr(B, "REFRESH", 4)
    model = B.fit_boosted(df.where("id < 300"), ["a", "b"], "win", df.where("id >= 300"), n_estimators=7, max_depth=3, early_stopping_rounds=7)
    assert not any(isinstance(x, list) and x and isinstance(x[0], B.Tree) for a in walked for x in a)
    # the losses told by the passes are those of the finished model's margins
    val = [r for r in rows if r[0] >= 300]
    x, y = np.array([r[1:3] for r in val]), np.array([r[3] for r in val])
    for n, loss in enumerate(model.params["val_losses"][:len(model.trees) + 1]):
        m = B.Boosted("b", ["a", "b"], model.edges, model.base, model.trees[:n], model.gains).margins(x)
        assert loss == pytest.approx(float(np.logaddexp(0, np.where(y == 1, -m, m)).mean()), rel=1e-9)


def test_a_forest_keeps_the_nodes_of_its_rows(spark):
    df = spark.range(60).select((F.col("id") % 7).cast("double").alias("a"), (F.col("id") % 2).cast("int").alias("win"))
    fit = M.fit_random_forest(df, ["a"], "win", n_estimators=3, max_depth=3).ml_model
    assert fit.getCacheNodeIds()


def test_fourier_features_need_no_column_each(spark):
    rows = [(i, None if i % 11 == 0 else float(i % 13 - 6), float("nan") if i % 17 == 0 else i / 50, i % 2) for i in range(300)]
    df = spark.createDataFrame(rows, "id long, a double, b double, win int").repartition(3)
    transform, names = M.fourier_map(["a", "b"], 0.3, 20)
    want = {r["id"]: [r[n] for n in names] for r in transform(df).collect()}
    got = M.fourier_vectors(df.withColumn("win", F.col("id").cast("int")), ["a", "b"], "win", 0.3, 20)
    assert got.columns == ["features", "win"]
    for r in got.collect():
        assert list(r["features"]) == pytest.approx(want[r["win"]], abs=1e-12)
    model = M.fit_rbf_svm(df, ["a", "b"], "win", gamma=0.3, n_components=20)
    w, b = model.ml_model.coefficients.toArray(), model.ml_model.intercept
    scored = model.score(df, ["id", "win"])
    assert "rff_0" not in scored._jdf.queryExecution().analyzed().toString()
    for r in scored.collect():
        margin = float(np.dot(want[r["id"]], w) + b)
        assert r["margin"] == pytest.approx(margin, abs=1e-9) and r["score"] == pytest.approx(1 / (1 + np.exp(-margin)), abs=1e-9)
        assert r["pred"] == int(margin > 0)


def test_the_processed_frame_is_read_by_columns(spark, sf, monkeypatch):
    """Raw and processed features are stored in columns, and a fit that names one column reads that one."""
    monkeypatch.setattr(catalog_models, "_RAW", {})
    monkeypatch.setattr(catalog_models, "_FITTED", {})
    out, rows, _, feats = catalog_models.processed(spark, sf)
    raw = catalog_models.raw_features(spark, sf)[0]
    for frame, names in ((raw, feats), (out, [r["feature"] for r in rows])):
        assert set(frame.columns) == {"matchid", "teamid", "split", *names, "win"} and frame.count() > 0
        read = _plan(frame.select("win"))
        assert "ReadSchema: struct<win" in read and names[0] not in read.split("ReadSchema")[1]


def test_buckets_of_the_metrics_move_no_real_number_but_the_score(spark, monkeypatch):
    rng = np.random.default_rng(5)
    score, label = rng.random(500).round(2), rng.integers(0, 2, 500)
    rows = [("a" if i % 3 else "b", float(s), int(y), int(s >= 0.5)) for i, (s, y) in enumerate(zip(score, label))]
    # gaps: a label that is not there counts nowhere, a prediction that is not there is wrong
    df = spark.createDataFrame([*rows, ("a", 0.25, None, 0), ("a", 0.25, 1, None), ("b", 0.0, 1, 0), ("b", 1.0, 0, 1)], "g string, score double, label int, pred int")
    moved, prefix = [], E.ordered_prefix
    monkeypatch.setattr(E, "ordered_prefix", lambda d, *a, **kw: moved.append(d) or prefix(d, *a, **kw))
    got = {r["g"]: r for r in E.classification_metrics(df, group=["g"]).collect()}
    real = [c for c in moved[0].columns if c not in ("g", "s") and moved[0].where(F.col(c) != F.round(c)).count()]
    assert len(moved) == 1 and real == []
    for r in E.counting_metrics(df, group=["g"]).collect():
        assert got[r["g"]]["f1"] == pytest.approx(r["f1"], rel=1e-12)
        assert got[r["g"]]["brier_score"] == pytest.approx(r["brier_score"], rel=1e-12)
        assert got[r["g"]]["log_loss"] == pytest.approx(r["log_loss"], rel=1e-12)


def test_the_summary_ranks_the_scores_of_a_run_once(spark, sf, monkeypatch):
    seen, make = [], TR.evaluation_summary
    monkeypatch.setattr(TR, "evaluation_summary", lambda m, *a: seen.append(_plan(m)) or make(m, *a))
    assert catalog_models.q_evaluation_summary(spark, sf).count() == 1
    assert len(seen) == 3 and not any("Exchange" in p or "Window" in p for p in seen)


def test_gram_needs_no_aggregate_by_column(spark):
    """Means and ranges come from one pass whose plan does not grow with the columns; gaps and whole batches agree."""
    rng = np.random.default_rng(2)
    a = rng.normal(3.0, 2.0, (240, 3))
    a[:, 2] = 7.5
    rows = [[None if (i + j) % 5 == 0 and i > 120 else float(v) for j, v in enumerate(r)] for i, r in enumerate(a)]
    rows += [[float("nan"), float("inf"), 7.5], [float("-inf"), None, None]]
    df = spark.createDataFrame(rows, "a double, b double, c double").withColumn("d", F.lit(None).cast("double")).repartition(3)
    x = SEL._finite_filled(df, ["a", "b", "c", "d"], None)
    mean, constant = SEL._heads(x, 4)
    m = np.array([[np.nan if v is None else v for v in r] for r in rows])
    m = np.where(np.isfinite(m), m, np.nan)
    assert mean == pytest.approx([*np.nanmean(m, axis=0), 0.0]) and list(constant) == [False, False, True, True]
    g, here = SEL.gram(df, ["a", "b", "c", "d"]), np.isfinite(np.column_stack([m, np.full(len(m), np.nan)]))
    assert g.count == pytest.approx((here.T.astype(float) @ here))
    both = here[:, 0] & here[:, 1]
    assert g.correlation()[0, 1] == pytest.approx(np.corrcoef(m[both, 0], m[both, 1])[0, 1])
    whole = spark.createDataFrame([[float(v) for v in r] for r in a[:, :2]], "a double, b double").repartition(3)
    assert SEL.gram(whole, ["a", "b"]).centred == pytest.approx(np.cov(a[:, :2].T) * 239)


def test_a_capped_sample_ranks_the_first_cells_of_its_classes_only(spark, monkeypatch):
    """The rows kept are the first of the whole rank, NULL class, ties of the hash and classes beyond the cap included."""
    rows = [(i, i % 3, None if i % 50 == 0 else int(i % 10 == 1)) for i in range(20000)] + [(5, 2, 1)] * 3
    df = spark.createDataFrame(rows, "id long, part long, y int").repartition(5)
    h = df.withColumn("_h", SP.hash_unit("id"))
    for cap in (40, 700, 2):
        quotas = {r.y: r.quota for r in SP.class_quotas(df.groupBy("y").count(), "y", cap).collect()}
        by = {}
        for r in sorted(h.collect(), key=lambda r: (r._h, r.id)):
            by.setdefault(r.y, []).append((r.id, r.part, r.y))
        ranked, rank = [], SP.ordered_rank
        monkeypatch.setattr(SP, "ordered_rank", lambda d, *a, **kw: ranked.append(d.count()) or rank(d, *a, **kw))
        got = sorted(map(tuple, SP.stratified_cap(df, "y", ["id"], cap).collect()), key=repr)
        monkeypatch.setattr(SP, "ordered_rank", rank)
        assert got == sorted([r for y, own in by.items() for r in own[:quotas[y]]], key=repr) and len(got) == cap
        assert ranked[0] <= cap + 3 * 25  # a cell holds 5 of 20,000 rows


@pytest.mark.parametrize("cells", [1, 8, 4096])
def test_groups_are_counted_by_themselves_only_where_a_cell_is_full(spark, monkeypatch, cells):
    """Forty groups of nine rows, one with a NULL key."""
    df = spark.range(9 * 40).select(F.when(F.col("id") % 40 > 0, F.col("id") % 40).alias("k"), F.lit(None).cast("string").alias("t"))
    grouped, group = [], type(df).groupBy
    monkeypatch.setattr(type(df), "groupBy", lambda self, *by: grouped.append([str(c) for c in by]) or group(self, *by))
    monkeypatch.setattr(O, "GROUP_CELLS", cells, raising=False)
    for threshold in (360, 9, 8, 0):
        assert O.has_hot_group(df, ["k", "t"], threshold) is (threshold < 9)
        assert ["k", "t"] not in grouped or threshold < 360
    assert not O.has_hot_group(df.where("false"), ["k"], 0)
    assert O.has_hot_group(df.where("k is null"), ["k"], 8) and not O.has_hot_group(df.where("k is null"), ["k"], 9)
