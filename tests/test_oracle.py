"""Every query with an oracle SQL must equal DuckDB on the small driver tables;
rows-only queries must run and keep a stable schema."""

import math

import duckdb
import pytest

from tools.oracle_check import TABLES, digest

import __spark_entry__ as E

from .conftest import SMALL

# the optional subpackage's queries have their own tests
OWN = {k for k in E.queries() if k == "pipeline" or k.split("_")[0].removeprefix("op").isdigit()}
QUERIES = {k: q for k, q in E.queries().items() if k not in OWN}
ORACLE = {k: s for k, s in E.oracle_sql().items() if k not in OWN}
SHARES = {"accuracy", "precision", "recall", "f1", "roc_auc", "pr_auc", "probability", "confidence", "train_error", "val_error"}


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    return c


def test_every_query_is_registered_once():
    assert len(QUERIES) == len(set(QUERIES))
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("key", sorted(ORACLE))
def test_matches_duckdb(spark, con, key):
    sdf = QUERIES[key](spark, SMALL)
    plan = sdf._sc._jvm.PythonSQLUtils.explainString(sdf._jdf.queryExecution(), "simple")
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython"):
        assert node not in plan, f"{key}: {node} in plan"
    srows = [tuple(r) for r in sdf.collect()]
    res = con.execute(ORACLE[key])
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    assert sorted(sdf.columns) == sorted(dcols)
    assert len(srows) == len(drows)
    assert digest(sdf.columns, srows)[0] == digest(dcols, drows)[0]


@pytest.mark.parametrize("key", sorted(set(QUERIES) - set(ORACLE)))
def test_rows_only_queries_run(spark, key):
    """Rows come, and numbers are numbers; what they must be is asserted per operator in
    the unit tests (brute force, closed forms, planted signals) and below."""
    df = QUERIES[key](spark, SMALL)
    names = df.columns
    assert names and len(names) == len(set(names))
    rows = df.collect()
    assert rows
    for r in rows[:2000]:
        for name, v in r.asDict().items():
            if name in SHARES and v is not None:
                assert -1e-9 <= v <= 1 + 1e-9, (name, v)
            assert not (isinstance(v, float) and math.isinf(v)), (name, v)


def test_models_beat_the_base_rate(spark):
    """Every fitted model ranks the test rows better than chance (post-game features
    carry the outcome), and its metrics agree with each other."""
    for key in ("logistic_regression", "linear_regression_classifier", "svm_linear", "random_forest"):
        rows = {r["split"]: r for r in QUERIES[key](spark, SMALL).collect()}
        assert rows["train"]["roc_auc"] > 0.6, key
        for r in rows.values():
            p, c = r["precision"] or 0, r["recall"] or 0
            assert r["f1"] == pytest.approx(2 * p * c / (p + c) if p + c else 0, abs=1e-9)


def test_saved_model_scores_as_before(spark):
    """Equal metrics before saving and after loading."""
    before = {r["split"]: r for r in QUERIES["linear_regression_classifier"](spark, SMALL).collect()}["test"]
    (after,) = QUERIES["save_load_model"](spark, SMALL).collect()
    for m in ("accuracy", "f1", "roc_auc", "log_loss"):
        assert after[m] == pytest.approx(before[m], abs=1e-12)


def test_stream_scores_equal_batch_scores(spark):
    from pyspark.sql import functions as F
    from versus.operators import models as M
    from versus.operators import split as SP
    from versus.operators.scoring import score_batch
    from versus.plans.catalog_merge import stage_cleaned
    cleaned = stage_cleaned(spark, SMALL)
    train = SP.split_grouped(cleaned).where(F.col("split") == "train")
    m = M.fit_linear_regression_classifier(train, ["kills_sum", "deaths_sum"], "win")
    batch = {(r.matchid, r.teamid): r.probability for r in score_batch(cleaned, m, None, ["kills_sum", "deaths_sum"], keep=["matchid", "teamid"]).collect()}
    stream = {(r.matchid, r.teamid): r.probability for r in QUERIES["score_stream"](spark, SMALL).collect()}
    assert stream.keys() == batch.keys()
    assert all(stream[k] == pytest.approx(batch[k], abs=1e-12) for k in batch)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
