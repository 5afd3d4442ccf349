"""The run log: concurrent writers, a killed writer, a run logged twice."""

from concurrent.futures import ThreadPoolExecutor

import pytest

from versus.operators import training as TR


def metrics(spark, value):
    return spark.createDataFrame([("val", value, 0.5), ("test", value, None)], "split string, accuracy double, f1 double")


def log(spark, root, run, value):
    TR.log_run(spark, root, run, "exp", "model", "scope", {"C": value, "n": 3}, metrics(spark, value), 1.5)


def test_two_writers_leave_two_whole_runs(spark, tmp_path):
    root = str(tmp_path)
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(lambda i: log(spark, root, f"run{i}", i / 10), range(4)))
    assert sorted(r.run_id for r in TR.read_log(spark, root, "runs").collect()) == [f"run{i}" for i in range(4)]
    assert TR.read_log(spark, root, "params").count() == 8
    got = {(r.run_id, r.key): r.value for r in TR.read_log(spark, root, "metrics").collect()}
    assert len(got) == 16
    assert got["run3", "val_accuracy"] == 0.3 and got["run3", "test_f1"] is None


@pytest.mark.parametrize("dies_at", ["runs", "params", "metrics", "manifest"])
def test_killed_writer_leaves_nothing_visible(spark, tmp_path, monkeypatch, dies_at):
    root = str(tmp_path)
    log(spark, root, "whole", 0.5)
    join = TR._path_join

    def dying(base, *parts):
        if parts[0] == dies_at:
            raise RuntimeError("killed")
        return join(base, *parts)

    with monkeypatch.context() as m:
        m.setattr(TR, "_path_join", dying)
        with pytest.raises(RuntimeError):
            log(spark, root, "partial", 0.6)
    for table in ("runs", "params", "metrics"):
        assert {r.run_id for r in TR.read_log(spark, root, table).collect()} == {"whole"}
    log(spark, root, "partial", 0.7)  # and may be tried again
    assert {r.run_id for r in TR.read_log(spark, root, "metrics").collect()} == {"whole", "partial"}
    assert TR.read_log(spark, root, "params").count() == 4


def test_run_logged_twice_is_read_once(spark, tmp_path):
    root = str(tmp_path)
    log(spark, root, "run", 0.1)
    log(spark, root, "run", 0.9)
    got = TR.read_log(spark, root, "metrics").where("key = 'val_accuracy'").collect()
    assert [r.value for r in got] == [0.9]
    assert TR.read_log(spark, root, "runs").columns == ["run_id", "experiment", "model", "scope", "created_at", "fit_seconds"]
