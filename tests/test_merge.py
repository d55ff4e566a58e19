"""Latest rows and merge rules."""

import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tidemark.operators.merge import (
    FLAG_IN_SOFT_DELETE,
    INSERT_TS_ONLY,
    KEEP_DELETE_TS,
    RESURRECT,
    STAY_DELETED,
    empty_target,
    latest_per_key,
    load_to_target,
    merge_delta,
    new_target,
)

OLD, GONE, NOW = datetime(2023, 1, 1), datetime(2023, 6, 1), datetime(2024, 1, 1)
TARGET = "k int, v string, is_deleted int, insert_ts timestamp_ntz, update_ts timestamp_ntz, delete_ts timestamp_ntz"
DELTA = "k int, v string, soft_delete int, load_ts timestamp_ntz"


@pytest.fixture
def target(spark):
    return spark.createDataFrame(
        [
            (1, "updated", 0, OLD, OLD, None),
            (2, "deleted", 0, OLD, OLD, None),
            (3, "revived", 1, OLD, OLD, GONE),
            (4, "untouched", 0, OLD, OLD, None),
            (7, "no flag", 0, OLD, OLD, None),
        ],
        TARGET,
    )


@pytest.fixture
def delta(spark):
    return spark.createDataFrame(
        [(1, "u", 0, NOW), (2, "d", 1, NOW), (3, "r", 0, NOW), (5, "i", 0, NOW), (6, "x", 1, NOW), (7, "n", None, NOW)],
        DELTA,
    )


COMMON = {
    2: ("deleted", 1, OLD, NOW, NOW),
    4: ("untouched", 0, OLD, OLD, None),
    7: ("no flag", 0, OLD, OLD, None),
}
EXPECTED = {
    "resurrect": (RESURRECT, {1: ("u", 0, OLD, NOW, None), 3: ("r", 0, OLD, NOW, None), 5: ("i", 0, NOW, NOW, None)}),
    "keep": (KEEP_DELETE_TS, {1: ("u", 0, OLD, NOW, None), 3: ("r", 0, OLD, NOW, GONE), 5: ("i", 0, NOW, NOW, None)}),
    "stay": (STAY_DELETED, {1: ("u", 0, OLD, NOW, None), 3: ("r", 1, OLD, NOW, GONE), 5: ("i", None, NOW, NOW, None)}),
    "insert only": (
        INSERT_TS_ONLY,
        {1: ("u", 0, OLD, NOW, None), 3: ("r", 0, OLD, NOW, GONE), 5: ("i", None, NOW, None, None)},
    ),
}


@pytest.mark.parametrize("name", EXPECTED)
@pytest.mark.parametrize("broadcast", [True, False])
def test_policies(request, target, delta, name, broadcast):
    if not broadcast:
        request.getfixturevalue("shuffled")
    policy, changed = EXPECTED[name]
    merged = merge_delta(target, delta, ["k"], policy, NOW)
    assert merged.columns == target.columns
    assert {r[0]: tuple(r)[1:] for r in merged.collect()} == {**COMMON, **changed}


def test_flag_kept_in_soft_delete(spark):
    target = spark.createDataFrame([(1, "a", 1, OLD, OLD, GONE), (2, "b", 0, OLD, OLD, None)],
        "k int, v string, soft_delete int, __insert_timestamp timestamp_ntz, __update_timestamp timestamp_ntz, __delete_timestamp timestamp_ntz")
    delta = spark.createDataFrame([(1, "A", 0, NOW), (2, "B", 1, NOW), (3, "C", 0, NOW)], DELTA)
    got = {r[0]: tuple(r)[1:] for r in merge_delta(target, delta, ["k"], FLAG_IN_SOFT_DELETE, NOW).collect()}
    assert got == {1: ("A", 0, OLD, NOW, GONE), 2: ("b", 1, OLD, NOW, NOW), 3: ("C", 0, NOW, NOW, None)}


def test_merging_twice_changes_nothing(target, delta, rows):
    once = merge_delta(target, delta, ["k"], run_ts=NOW)
    assert rows(merge_delta(once, delta, ["k"], run_ts=NOW)) == rows(once)


def test_null_keys_match_each_other(spark, rows):
    target = spark.createDataFrame([(None, "old", 0, OLD, OLD, None)], TARGET)
    delta = spark.createDataFrame([(None, "new", 0, NOW)], DELTA)
    assert rows(merge_delta(target, delta, ["k"], run_ts=NOW), "k", "v") == [(None, "new")]


def test_key_only_table(spark, rows):
    target = empty_target(spark.createDataFrame([], "k int, soft_delete int, load_ts timestamp_ntz"))
    first = merge_delta(target, spark.createDataFrame([(1, 0, OLD)], "k int, soft_delete int, load_ts timestamp_ntz"), ["k"], run_ts=OLD)
    second = merge_delta(first, spark.createDataFrame([(1, 0, NOW)], "k int, soft_delete int, load_ts timestamp_ntz"), ["k"], run_ts=NOW)
    assert rows(second) == [(1, 0, OLD, NOW, None)]


def test_names_match_in_any_case_and_unknown_columns_are_ignored(spark, target, rows):
    delta = spark.createDataFrame([(1, "u", "?", 0, NOW)], "K int, V string, extra string, Soft_Delete int, LOAD_TS timestamp_ntz")
    merged = merge_delta(target.where("k = 1"), delta, ["k"], run_ts=NOW)
    assert rows(merged, "k", "v") == [(1, "u")]


def test_unknown_policy_name(target, delta):
    with pytest.raises(ValueError, match="unknown merge policy"):
        load_to_target(delta, target, ["k"], "whatever")


def test_latest_per_key_ties_go_to_the_tombstone_then_to_greater_values(spark, rows):
    data = [(1, "a", 0, NOW), (1, "b", 1, NOW), (1, "c", 0, OLD), (2, "x", 0, NOW), (2, "y", 0, NOW), (3, "z", 0, None), (3, "w", 0, OLD)]
    for seed in range(3):
        random.Random(seed).shuffle(data)
        df = spark.createDataFrame(data, DELTA).repartition(1 + seed * 3)
        assert rows(latest_per_key(df, ["k"]), "k", "v") == [(1, "b"), (2, "y"), (3, "w")]


def test_latest_per_key_with_unorderable_columns(spark):
    df = spark.createDataFrame([(1, {"a": 1}, OLD), (1, {"a": 2}, NOW)], "k int, m map<string,int>, load_ts timestamp_ntz")
    assert latest_per_key(df, ["k"]).collect()[0].m == {"a": 2}


@pytest.mark.parametrize("seed", range(3))
def test_merge_equals_row_by_row_replay(spark, shuffled, seed):
    source = random.Random(seed)
    loads = [
        [(k, f"{k}-{day}", source.choice([0, 0, 1]), datetime(2024, 1, day)) for k in source.sample(range(20), 8)]
        for day in range(1, 5)
    ]
    expected = {}
    for load in loads:
        for k, v, gone, _ in load:
            if gone and k in expected:
                expected[k] = (expected[k][0], 1)
            elif not gone:
                expected[k] = (v, 0)
    target = None
    for load in loads:
        delta = spark.createDataFrame(load, DELTA)
        now = load[0][3]
        target = new_target(delta, ["k"], run_ts=now) if target is None else merge_delta(target, delta, ["k"], run_ts=now)
    assert {r.k: (r.v, r.is_deleted) for r in target.collect()} == expected


def test_plans_keep_the_target_in_place(spark, sf):
    """With a small delta the target is neither shuffled nor built into a hash table."""
    orders = spark.read.parquet(f"{sf}/orders.parquet")
    delta = orders.where("o_custkey = 7").withColumns({"soft_delete": F.lit(0), "load_ts": F.lit(NOW)})
    plan = merge_delta(orders, delta, ["o_orderkey"], run_ts=NOW, deduplicated=True)._jdf.queryExecution().toString()
    assert "SortMergeJoin" not in plan and "BuildLeft" not in plan
    assert "Cartesian" not in plan and "NestedLoop" not in plan


def test_window_reduces_before_the_shuffle(spark, sf):
    plan = latest_per_key(spark.read.parquet(f"{sf}/lineitem.parquet"), ["l_orderkey"], ["l_shipdate"])
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.rindex("WindowGroupLimit") > text.index("Exchange hashpartitioning")


def test_parquet_catalog_table_refuses_merge(spark, delta):
    """The statement is complete; only the table format lacks row-level changes."""
    from pyspark.errors import PySparkException

    from tidemark.operators.merge import merge_table

    spark.createDataFrame([], TARGET).write.mode("overwrite").saveAsTable("merge_target")
    with pytest.raises(PySparkException) as error:
        merge_table("merge_target", delta, ["k"], run_ts=NOW)
    assert "MERGE INTO" in str(error.value)
