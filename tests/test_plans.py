"""Plan assertions: the physical plans stay JVM-side, push filters and column
pruning into the Parquet scan, limit groups before shuffles and keep a bounded
number of exchanges."""

import re

import pytest

import __spark_entry__ as E

from .conftest import SMALL

Q = E.queries()


def plan(df) -> str:
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def exchanges(text: str) -> int:
    return len(re.findall(r"Exchange \(\d+\)\nInput", text)) or text.count("+- Exchange")


@pytest.mark.parametrize("key", ["flagship_side_totals", "postgame_dataset", "clean_dataset", "pregame_dataset",
                                 "team_features", "classification_metrics", "roc_curve", "quality_suite",
                                 "describe_percentiles", "pregame_features"])
def test_no_python_in_relational_plans(spark, key):
    text = plan(Q[key](spark, SMALL))
    for node in ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "FlatMapGroupsInPandas", "MapInPandas"):
        assert node not in text, f"{key} plan contains {node}"


def test_filter_reaches_parquet_scan(spark):
    """On the given files: the duration, a derived column, is filtered right above the
    orders scan, before any exchange."""
    text = plan(Q["clean_dataset"](spark, SMALL))
    scan = re.search(r"\((\d+)\) Scan parquet[^\n]*\nOutput[^\n]*o_totalprice[^\n]*\n.*?\n\n", text, re.S)
    above = re.search(rf"\((\d+)\) Filter[^\n]*\nInput[^\n]*o_totalprice[^\n]*\nCondition[^\n]*% 3600\) >= 300", text)
    assert scan and above, "duration filter does not sit on the orders scan"


def test_column_pruning(spark):
    """A query reads the tables and columns it names, straight from the given files."""
    text = plan(Q["value_counts"](spark, SMALL))
    assert "ReadSchema: struct<o_orderpriority:string>" in text
    assert "lineitem.parquet" not in text


def test_group_limit_before_shuffle(spark):
    text = plan(Q["draft_slot"](spark, SMALL))
    assert "WindowGroupLimit" in text


def test_draft_aggregate_is_hash_based(spark):
    text = plan(Q["pregame_dataset"](spark, SMALL))
    assert "SortAggregate" not in text and "ObjectHashAggregate" not in text


@pytest.mark.parametrize("key,limit", [("flagship_side_totals", 2), ("postgame_dataset", 2),
                                       ("pregame_features", 2), ("roc_curve", 4)])
def test_exchange_budget(spark, key, limit):
    text = plan(Q[key](spark, SMALL))
    n = text.count("Exchange hashpartitioning") + text.count("Exchange rangepartitioning") + \
        text.count("Exchange SinglePartition")
    assert n <= limit, f"{key}: {n} shuffles"


def final_plan(df) -> str:
    """The plan as it ran, with the exchanges that were reused."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


@pytest.mark.parametrize("key", ["postgame_dataset", "clean_dataset", "pregame_dataset", "team_features", "join_inner_stats"])
def test_lines_are_scanned_and_shuffled_once(spark, key):
    """All domain tables of a query rank the same exchange of the line items."""
    text = final_plan(Q[key](spark, SMALL))
    assert len(re.findall(r"FileScan parquet[^\n]*lineitem", text)) == 1
    made = [line for line in text.splitlines() if "Exchange hashpartitioning(l_orderkey" in line]
    assert sum("ReusedExchange" not in line for line in made) == 1 and len(made) == 2


def test_top_and_bottom_share_their_input(spark):
    assert "lineitem" not in plan(Q["top_bottom_k"](spark, SMALL))


@pytest.mark.parametrize("key,tables", [("pregame_dataset_bucketed", 3), ("postgame_dataset_bucketed", 3)])
def test_stored_groups_are_not_shuffled(spark, key, tables):
    """Over tables bucketed by group: one scan of each, no exchange by a hash, also where no
    side is small enough to be broadcast."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = final_plan(Q[key](spark, SMALL))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert text.count("FileScan") == tables and text.count("SelectedBucketsCount") == tables
    assert "Exchange" not in text


def test_all_encoders_meet_the_rows_in_one_dictionary(spark):
    """One broadcast of one dictionary serves every column read (a second, of its keys alone, those that
    the query does not read); only the opponent difference shuffles."""
    text = final_plan(Q["pregame_features"](spark, SMALL))
    made = [line for line in text.splitlines() if "Exchange" in line and "ReusedExchange" not in line]
    assert sum("BroadcastExchange" in line for line in made) <= 2
    assert sum("BroadcastExchange" not in line for line in made) == 1
    assert "SortMergeJoin" not in text and "NestedLoop" not in text
