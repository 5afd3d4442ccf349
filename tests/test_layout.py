"""Stored tables bucketed by group, with groups that are too large for a bucket."""

import pytest

from versus.plans.pregame import pregame_sides
from versus.sources.fixture import DEFAULT_SLOTS, DomainTables
from versus.sources.layout import bucket_count, store

from .conftest import SMALL

KEYS = {"members": "matchid", "matches": "id", "teambans": "matchid"}


def flow(t, one_pass):
    return pregame_sides(t["members"], t["matches"], t["teambans"], DEFAULT_SLOTS, one_pass=one_pass)


def rows(df):
    return sorted(map(repr, df.select(*sorted(df.columns)).collect()))


@pytest.mark.parametrize("hot_rows,any_hot", [(6, True), (1000, False)])
def test_large_groups_take_the_other_plan(spark, tmp_path, hot_rows, any_hot):
    t = DomainTables(spark, SMALL, DEFAULT_SLOTS, wide=True)
    stored = store({k: t[k] for k in KEYS}, KEYS, buckets=4, hot_rows=hot_rows, root=str(tmp_path))
    assert bool(stored.hot) == any_hot
    assert rows(stored.run(flow)) == rows(flow(t, True)) == rows(flow(t, False))
    for name in KEYS:
        parts = [stored.tables()[name].count()] + ([stored.tables(hot=True)[name].count()] if any_hot else [])
        assert sum(parts) == t[name].count()
    stored.drop()
    assert not spark.catalog.tableExists(stored.cold["members"])


def test_groups_without_a_key_stay(spark, tmp_path):
    df = spark.createDataFrame([(None, 1), (1, 2), (1, 3), (1, 4), (2, 5)], "matchid long, v int")
    stored = store({"members": df}, {"members": "matchid"}, buckets=2, hot_rows=2, root=str(tmp_path))
    assert sorted(r.v for r in stored.tables()["members"].collect()) == [1, 5]
    assert sorted(r.v for r in stored.tables(hot=True)["members"].collect()) == [2, 3, 4]


def test_bucket_count():
    assert [bucket_count(n) for n in (0, 128_000_000, 128_000_001, 10**9)] == [64, 64, 128, 512]
