"""Comparison of states against brute force."""

import random

import pytest
from pyspark.sql import functions as F

from tidemark.functions.hashing import bucket_fingerprint, changed_buckets
from tidemark.operators.delta import apply_scd2, as_of, next_snapshot, scd2_step, snapshot_delta, start_history
from tidemark.operators.diff import (
    DuplicateKeyError,
    assert_unique_keys,
    change_counts,
    classified_keys,
    deleted_keys,
    deletes,
    inserted_keys,
    snapshot_diff,
    superseded,
    updated_keys,
    upserts,
)

SCHEMA = "a int, b string, x string, y decimal(10,2)"
KEYS = ["a", "b"]


def random_state(seed, size=60, unique=True):
    """Random rows with NULLs in keys and values, from small value sets so that states overlap."""
    source = random.Random(seed)
    made = {}
    out = []
    for _ in range(size):
        key = (source.choice([None, *range(12)]), source.choice([None, "", "p", "p||q"]))
        value = (source.choice([None, "", "u", "u||v", "v"]), source.choice([None, "1.00", "2.50"]))
        made[key] = value
        out.append((*key, *value))
    if unique:
        out = [(*k, *v) for k, v in made.items()]
    return out


def frame(spark, data):
    from decimal import Decimal

    return spark.createDataFrame([(a, b, x, None if y is None else Decimal(y)) for a, b, x, y in data], SCHEMA)


def brute_kinds(prev, curr):
    kinds = {}
    for key in {r[:2] for r in prev} | {r[:2] for r in curr}:
        before = {r[2:] for r in prev if r[:2] == key}
        after = {r[2:] for r in curr if r[:2] == key}
        kinds[key] = "I" if not before else "D" if not after else "U" if after - before else "S"
    return kinds


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("unique", [True, False])
def test_diff_equals_brute_force(spark, seed, unique):
    prev, curr = random_state(seed, unique=unique), random_state(seed + 100, unique=unique)
    got = {(r.a, r.b): r.change_kind for r in snapshot_diff(frame(spark, prev), frame(spark, curr), KEYS).collect()}
    assert got == brute_kinds(prev, curr)


@pytest.mark.parametrize("seed", range(4))
def test_unique_key_diff_equals_brute_force(spark, seed):
    prev, curr = random_state(seed), random_state(seed + 100)
    diff = classified_keys(frame(spark, prev), frame(spark, [*curr, curr[0]]), KEYS, unique_keys=True)
    plan = diff._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "SortAggregate" not in plan
    got = {(r.a, r.b): (r.change_kind, r.curr_rows) for r in diff.collect()}
    rows = {k: 0 for k in brute_kinds(prev, curr)}
    for r in [*curr, curr[0]]:
        rows[r[:2]] += 1
    assert got == {k: (v, rows[k]) for k, v in brute_kinds(prev, curr).items()}


@pytest.mark.parametrize("seed", range(3))
def test_key_sets_and_rows_equal_brute_force(spark, shuffled, seed):
    prev, curr = random_state(seed), random_state(seed + 50)
    p, c = frame(spark, prev), frame(spark, curr)
    kinds = brute_kinds(prev, curr)

    def of(*wanted):
        return {k for k, v in kinds.items() if v in wanted}

    def key_set(df):
        found = [(r.a, r.b) for r in df.collect()]
        assert len(found) == len(set(found))
        return set(found)

    assert key_set(inserted_keys(p, c, KEYS)) == of("I")
    assert key_set(updated_keys(p, c, KEYS)) == of("U")
    assert key_set(deleted_keys(p, c, KEYS)) == of("D")
    assert key_set(upserts(p, c, KEYS)) == of("I", "U")
    assert key_set(deletes(p, c, KEYS)) == of("D")
    assert key_set(superseded(p, c, KEYS)) == of("U")


@pytest.mark.parametrize("seed", range(3))
def test_delta_turns_previous_into_current(spark, seed):
    prev, curr = frame(spark, random_state(seed)), frame(spark, random_state(seed + 9))
    delta = snapshot_delta(prev, curr, KEYS, "2024-01-01")
    state = {(r.a, r.b): (r.x, r.y) for r in prev.collect()}
    for r in delta.collect():
        if r.soft_delete:
            del state[(r.a, r.b)]
        else:
            state[(r.a, r.b)] = (r.x, r.y)
        stamps = (r.insert_ts, r.update_ts, r.delete_ts)
        assert (stamps[2] is None, stamps[0] is None, stamps[1] is None) == ((False, True, True) if r.soft_delete else (True, False, False))
    assert state == {(r.a, r.b): (r.x, r.y) for r in curr.collect()}


def test_same_state_has_no_changes(spark):
    state = frame(spark, random_state(1))
    counts = change_counts(snapshot_diff(state, state, KEYS)).first()
    assert (counts.inserted, counts.updated, counts.deleted) == (0, 0, 0)
    assert counts.unchanged == state.count()


def test_null_positions_and_separators_are_told_apart(spark):
    before = frame(spark, [(1, "k", None, None), (2, "k", "p||q", None), (3, "p||q", "r", None)])
    after = frame(spark, [(1, "k", "", None), (2, "k", "p", None), (3, "p", "r", None)])
    got = {(r.a, r.b): r.change_kind for r in snapshot_diff(before, after, KEYS).collect()}
    assert got == {(1, "k"): "U", (2, "k"): "U", (3, "p||q"): "D", (3, "p"): "I"}


def test_column_order_does_not_matter(spark):
    state = frame(spark, random_state(2))
    counts = change_counts(snapshot_diff(state, state.select("y", "x", "b", "a"), KEYS)).first()
    assert counts.unchanged == state.count()


def test_new_column_counts_as_a_change_only_where_filled(spark):
    before = spark.createDataFrame([(1, "x"), (2, "y")], "k int, v string")
    after = spark.createDataFrame([(1, "x", None), (2, "y", "new")], "k int, v string, w string")
    got = {r.k: r.change_kind for r in snapshot_diff(before, after, ["k"]).collect()}
    assert got == {1: "S", 2: "U"}


def test_duplicate_keys_do_not_multiply(spark):
    before = spark.createDataFrame([(1, "x"), (1, "x"), (2, "y")], "k int, v string")
    after = spark.createDataFrame([(1, "z"), (1, "z"), (2, "y")], "k int, v string")
    assert upserts(before, after, ["k"]).count() == 2
    assert superseded(before, after, ["k"]).count() == 2
    with pytest.raises(DuplicateKeyError):
        assert_unique_keys(after, ["k"])


def test_hot_key_on_both_sides(spark):
    """A third of the rows share one key: compared without pairing them."""
    hot = spark.range(30_000).select(
        F.when(F.col("id") < 10_000, F.lit(None)).otherwise(F.col("id")).alias("k"), (F.col("id") * 7).alias("v")
    )
    after = hot.where("v <> 7")
    got = snapshot_diff(hot, after, ["k"]).groupBy("change_kind").count().collect()
    assert {r.change_kind: r["count"] for r in got} == {"S": 20_001}
    assert deleted_keys(hot, hot.where("k is not null"), ["k"]).collect() == [(None,)]


def test_map_and_nested_columns_are_compared(spark):
    schema = "k int, m map<string,int>, s struct<a:int,b:array<string>>, z binary"
    before = spark.createDataFrame(
        [(1, {"a": 1, "b": 2}, (1, ["x"]), b"1"), (2, {"a": 1}, (1, ["x"]), b"1"), (3, {}, (1, []), b"1")], schema
    )
    after = spark.createDataFrame(
        [(1, {"b": 2, "a": 1}, (1, ["x"]), b"1"), (2, {"a": 2}, (1, ["x"]), b"1"), (3, {}, (1, []), b"2")], schema
    )
    got = {r.k: r.change_kind for r in snapshot_diff(before, after, ["k"]).collect()}
    assert got == {1: "S", 2: "U", 3: "U"}


def test_fingerprint_ignores_order_and_sees_keys(spark):
    def prints(data):
        return bucket_fingerprint(spark.createDataFrame(data, "k int, v string").repartition(3), ["k"], 1)

    base = [(1, "A"), (2, "B")]
    assert changed_buckets(prints(base), prints(base[::-1])).count() == 0
    for other in ([(1, "B"), (2, "A")], [(7, "A"), (9, "B")], [(1, "A")], base + [(2, "B")]):
        assert changed_buckets(prints(base), prints(other)).count() == 1


def test_next_snapshot_keeps_earlier_tombstones(spark, rows):
    first = next_snapshot(None, spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "k int, v string"), ["k"])
    second = next_snapshot(first, spark.createDataFrame([(1, "a"), (2, "B")], "k int, v string"), ["k"])
    third = next_snapshot(second, spark.createDataFrame([(1, "a"), (3, "c")], "k int, v string"), ["k"])
    assert rows(third, "k", "v", "soft_delete") == sorted(
        [(1, "a", 0), (3, "c", 0), (2, "b", 1), (3, "c", 1), (2, "B", 1)], key=repr
    )


def test_history_can_be_read_as_of_any_run(spark, rows):
    states = [
        [(1, "a"), (2, "b")],
        [(1, "a2"), (3, "c")],
        [(1, "a2"), (2, "b again"), (3, "c")],
        [],
    ]
    history = None
    opened, closed = None, []
    for day, data in enumerate(states, start=1):
        now = spark.createDataFrame(data, "k int, v string")
        run = f"2024-01-{day:02d} 00:00:00"
        if opened is None:
            opened = start_history(now, ["k"], run)
        else:
            ended, opened = scd2_step(opened, now, ["k"], run)
            closed += ended.collect()
        history = start_history(now, ["k"], run) if history is None else apply_scd2(history, now, ["k"], run)
    for day, data in enumerate(states, start=1):
        assert rows(as_of(history, f"2024-01-{day:02d} 12:00:00"), "k", "v") == sorted(data, key=repr)
    assert rows(as_of(history, "2023-12-31")) == []
    ends = {(r.k, r.v, r.valid_to): r.closed_by for r in history.where("valid_to is not null").collect()}
    assert ends == {(r.k, r.v, r.valid_to): r.closed_by for r in closed} and opened.count() == 0
    closed = {(r.k, r.v): r.closed_by for r in history.collect()}
    assert closed[(1, "a")] == "U" and closed[(2, "b")] == "D" and closed[(3, "c")] == "D"


def test_names_in_other_case(spark):
    before = spark.createDataFrame([(1, "x"), (2, "y"), (3, "z")], "K int, Val string")
    after = spark.createDataFrame([("x", 1), ("Y", 2), ("n", 4)], "VAL string, k int")
    got = {r[0]: r.change_kind for r in snapshot_diff(before, after, ["k"]).collect()}
    assert got == {1: "S", 2: "U", 3: "D", 4: "I"}
    delta = snapshot_delta(before, after, ["k"], "2024-01-01")
    assert {(r["k"], r["val"], r["soft_delete"]) for r in delta.selectExpr("k", "val", "soft_delete").collect()} == {
        (2, "Y", 0), (4, "n", 0), (3, "z", 1)}


def test_names_with_dots_and_spaces(spark):
    before = spark.createDataFrame([(1, "x"), (2, "y")], "`order.id` int, `the value` string")
    after = spark.createDataFrame([(1, "x"), (2, "z")], "`order.id` int, `the value` string")
    delta = snapshot_delta(before, after, ["order.id"], "2024-01-01")
    assert [tuple(r)[:2] for r in delta.collect()] == [(2, "z")]
