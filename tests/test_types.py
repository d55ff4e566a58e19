"""Columns that change their type: the lattice, snapshots, targets, history; and order-safe merges."""

import threading
from dataclasses import replace
from datetime import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.control.watermarks import WatermarkStore
from tidemark.operators.drift import TypeChangeError, cast_up, common_schema, union_drift, wider_type
from tidemark.operators.merge import POLICIES, RESURRECT, MergePolicy, merge_delta, merge_parts, without_state
from tidemark.plans.load import merge_into, read_target
from tidemark.plans.snapshot_cdc import run_snapshot_cdc
from tidemark.plans.timestamp_cdc import run_timestamp_cdc
from tidemark.sinks.generations import CommitConflict, GenerationStore
from tidemark.sources.paths import TablePaths

DAY = [f"2024-01-0{k} 00:00:00" for k in range(1, 8)]


def kind(text):
    return T._parse_datatype_string(text)


@pytest.mark.parametrize(
    "a, b, want",
    [
        ("int", "bigint", "bigint"), ("tinyint", "smallint", "smallint"), ("int", "double", "double"), ("smallint", "float", "float"),
        ("int", "float", "double"), ("bigint", "double", None), ("int", "decimal(12,2)", "decimal(12,2)"), ("bigint", "decimal(5,2)", "decimal(21,2)"),
        ("decimal(12,2)", "decimal(14,4)", "decimal(14,4)"), ("decimal(38,0)", "decimal(38,10)", None), ("decimal(10,2)", "double", None),
        ("int", "string", "string"), ("date", "timestamp_ntz", "timestamp_ntz"), ("date", "string", "string"), ("timestamp", "string", None),
        ("timestamp", "timestamp_ntz", None), ("binary", "string", None), ("boolean", "int", None), ("void", "date", "date"),
        ("array<int>", "array<bigint>", "array<bigint>"), ("map<string,int>", "map<string,string>", "map<string,string>"),
        ("map<int,int>", "map<string,int>", None), ("struct<a:int,b:string>", "struct<A:bigint,c:date>", "struct<a:bigint,b:string,c:date>"),
        ("struct<a:int>", "struct<a:binary>", None),
    ],
)
def test_wider_types(spark, a, b, want):
    for x, y in ((a, b), (b, a)):
        found = wider_type(kind(x), kind(y))
        if want is None or "struct" not in a or x == a:
            assert (found and found.simpleString()) == (want and kind(want).simpleString())


def test_widening_keeps_every_value(spark):
    rows = spark.sql(
        "select cast(-2147483648 as int) i, cast(1.25 as decimal(5,2)) d, named_struct('a', 1) s, array(1, null) l, map('k', 1) m"
        " union all select null, null, null, null, null"
    )
    wide = kind("struct<i:string,d:decimal(10,4),s:struct<a:bigint,b:string>,l:array<string>,m:map<string,double>>")
    got = cast_up(rows, wide).collect()
    assert tuple(got[1]) == (None,) * 5
    assert got[0]["i"] == "-2147483648" and str(got[0]["d"]) == "1.2500" and got[0]["s"].asDict() == {"a": 1, "b": None}
    assert got[0]["l"] == ["1", None] and got[0]["m"] == {"k": 1.0}
    with pytest.raises(TypeChangeError, match="'d'.*decimal.*double"):
        common_schema(rows.schema, kind("struct<d:double>"))
    both = union_drift(rows.select("i"), spark.sql("select 'x' i, 1 more")).collect()
    assert {(r["i"], r["more"]) for r in both} == {("-2147483648", None), (None, None), ("x", 1)}


def states(spark, *texts):
    return [spark.sql(f"select * from values {t}") for t in texts]


@pytest.mark.parametrize("stable", [False, True])
def test_a_retyped_snapshot_stays_readable(spark, tmp_path, rows, stable):
    paths = TablePaths(str(tmp_path), "d", "s", "t")
    one = spark.range(200).select(F.col("id").alias("k"), F.lit(5).alias("v"))
    two = one.select("k", F.when(F.col("k") == 7, "100").otherwise("5").alias("v"))
    three = one.select("k", F.when(F.col("k") == 8, "text").otherwise("5").alias("v"))
    results = [run_snapshot_cdc(spark, s, ["k"], paths, t, buckets=16, stable_source=stable) for s, t in zip((one, two, three), DAY)]
    assert [(r.inserted, r.updated, r.deleted, r.changed_buckets) for r in results[1:]] == [(0, 1, 0, 1), (0, 2, 0, 2)]
    store = GenerationStore(spark, paths.snapshot)
    assert rows(store.read(), "k", "v") == rows(three)
    assert rows(store.read(1), "k", "v") == rows(one)
    assert rows(GenerationStore(spark, paths.target).read(), "k", "v") == rows(three)
    history = sorted((r["k"], r["v"]) for r in store.read_snapshot().where("soft_delete = 1").collect())
    assert history == [(7, "100"), (7, "5"), (8, "5")]
    assert run_snapshot_cdc(spark, three, ["k"], paths, DAY[3], buckets=16, stable_source=stable).written == 0


def test_a_number_that_becomes_a_double_delivers_real_changes_alone(spark, tmp_path, rows):
    paths = TablePaths(str(tmp_path), "d", "s", "t")
    one = spark.range(50).select(F.col("id").cast("int").alias("k"), F.col("id").cast("int").alias("v"))
    two = one.select("k", F.when(F.col("k") == 3, 3.5).otherwise(F.col("v").cast("double")).alias("v"))
    run_snapshot_cdc(spark, one, ["k"], paths, DAY[0], buckets=4)
    result = run_snapshot_cdc(spark, two, ["k"], paths, DAY[1], buckets=4)
    assert (result.inserted, result.updated, result.deleted) == (0, 1, 0)
    assert rows(GenerationStore(spark, paths.target).read(), "k", "v") == rows(two)


def test_a_key_that_becomes_text_finds_its_rows(spark, tmp_path, rows):
    paths = TablePaths(str(tmp_path), "d", "s", "t")
    one = spark.range(60).select(F.col("id").alias("k"), F.lit("a").alias("v"))
    two = one.where("k <> 5").select(F.col("k").cast("string").alias("k"), F.when(F.col("k") == 6, "b").otherwise("a").alias("v"))
    run_snapshot_cdc(spark, one, ["k"], paths, DAY[0], buckets=8)
    result = run_snapshot_cdc(spark, two, ["k"], paths, DAY[1], buckets=8)
    assert (result.inserted, result.updated, result.deleted) == (0, 1, 1)
    target = GenerationStore(spark, paths.target).read()
    assert target.where("is_deleted = 0").count() == 59 and target.count() == 60
    assert [r["k"] for r in target.where("is_deleted = 1").collect()] == ["5"]


def test_a_type_without_a_lossless_target_is_refused_before_anything_is_written(spark, tmp_path):
    paths = TablePaths(str(tmp_path), "d", "s", "t")
    one, two = states(spark, "(1, 10L) as t(k, v)", "(1, 1.5D) as t(k, v)")
    run_snapshot_cdc(spark, one, ["k"], paths, DAY[0], buckets=2)
    before = sorted(str(p) for p in tmp_path.rglob("*"))
    for run in (
        lambda: run_snapshot_cdc(spark, two, ["k"], paths, DAY[1], buckets=2),
        lambda: merge_into(GenerationStore(spark, paths.target), two.selectExpr("*", "0 soft_delete", "timestamp_ntz'2024-01-02' load_ts"), ["k"]),
    ):
        with pytest.raises(TypeChangeError, match="'v'"):
            run()
    assert sorted(str(p) for p in tmp_path.rglob("*")) == before
    with pytest.raises(TypeChangeError):
        merge_delta(one.selectExpr("*", "0 is_deleted"), two.selectExpr("*", "0 soft_delete", "timestamp_ntz'2024-01-02' load_ts"), ["k"])


def test_a_timestamp_run_widens(spark, tmp_path, rows):
    paths = TablePaths(str(tmp_path), "d", "s", "t")
    one, two = states(
        spark,
        "(1, 10, timestamp_ntz'2024-01-01'), (2, 20, timestamp_ntz'2024-01-01') as t(k, v, at)",
        "(1, 'ten', timestamp_ntz'2024-01-02') as t(k, v, at)",
    )
    for trust in (False, True):
        place = replace(paths, table=f"t{trust}")
        run_timestamp_cdc(spark, one, ["k"], ["at"], datetime(2023, 1, 1), place, DAY[0], buckets=2, trust_timestamps=trust)
        result = run_timestamp_cdc(spark, two, ["k"], ["at"], datetime(2024, 1, 1), place, DAY[1], buckets=2, trust_timestamps=trust)
        assert (result.inserted, result.deleted) == (1, 1)
        assert rows(GenerationStore(spark, place.target).read(), "k", "v", "is_deleted") == [(1, "ten", 0), (2, "20", 1)]
        assert rows(GenerationStore(spark, place.snapshot).read(), "k", "v") == [(1, "ten")]


# -- order of arrival -----------------------------------------------------

ORDERED = replace(RESURRECT, order="load_ts")


def load(spark, day, rows):
    return spark.createDataFrame([(k, v, d, DAY[day]) for k, v, d in rows], "k int, v string, soft_delete int, load_ts string").withColumn(
        "load_ts", F.col("load_ts").cast("timestamp_ntz")
    )


@pytest.mark.parametrize("order", [(0, 1, 2, 3), (3, 2, 1, 0), (1, 3, 0, 2), (2, 0, 3, 1)])
@pytest.mark.parametrize("parts", [False, True])
def test_loads_in_any_order_give_one_target(spark, rows, order, parts):
    loads = [
        load(spark, 0, [(1, "a", 0), (2, "a", 0), (3, "a", 0), (5, "a", 0)]),
        load(spark, 1, [(1, "b", 0), (2, "b", 1), (4, "b", 1), (5, "x", 1)]),
        load(spark, 2, [(2, "c", 0), (6, "c", 1), (5, "c", 1)]),
        load(spark, 3, [(3, "d", 1), (6, "d", 0), (1, None, 0)]),
    ]
    target = spark.createDataFrame([], "k int, v string")
    for k in order:
        if parts:
            kept, added = merge_parts(target, loads[k], ["k"], ORDERED, DAY[6])
            target = kept.unionByName(added)
        else:
            target = merge_delta(target, loads[k], ["k"], ORDERED, DAY[6])
        target = spark.createDataFrame(target.collect(), target.schema)
    told = without_state(target)
    assert told.columns == ["k", "v", "is_deleted", "insert_ts", "update_ts", "delete_ts"]
    assert rows(told, "k", "v", "is_deleted") == [(1, None, 0), (2, "c", 0), (3, "a", 1), (5, "a", 1), (6, "d", 0)]
    gone = {r["k"] for r in told.where("delete_ts is not null").collect()}
    assert gone == {3, 5} and told.where("insert_ts is null or update_ts is null").count() == 0


def test_rows_of_one_time_are_ordered_by_value_and_tombstone(spark, rows):
    for first, second in ((0, 1), (1, 0)):
        loads = [load(spark, 0, [(1, "a", 0), (2, "a", 1), (3, "z", 0)]), load(spark, 0, [(1, "b", 0), (2, "b", 0), (3, "y", 0)])]
        target = merge_delta(spark.createDataFrame([], "k int, v string"), loads[first], ["k"], ORDERED, DAY[6])
        target = merge_delta(target, loads[second], ["k"], ORDERED, DAY[6])
        assert rows(without_state(target), "k", "v", "is_deleted") == [(1, "b", 0), (2, "b", 1), (3, "z", 0)]


def test_a_stored_target_keeps_its_order(spark, tmp_path, rows):
    store = GenerationStore(spark, str(tmp_path))
    for day in (1, 0):
        merge_into(store, load(spark, day, [(1, f"day {day}", 0), (2, "gone", day)]), ["k"], ORDERED, None, buckets=2)
    assert rows(read_target(store), "k", "v", "is_deleted") == [(1, "day 1", 0), (2, "gone", 1)]
    assert "__data_ts" in store.read().columns


def test_order_needs_a_policy_that_revives():
    with pytest.raises(ValueError):
        replace(POLICIES["stay_deleted"], order="load_ts")
    assert MergePolicy(order="load_ts").order == "load_ts"


def test_a_merge_ranks_once_and_scans_the_target_once(spark, tmp_path, shuffled):
    spark.range(100).selectExpr("id as k", "'a' as v").write.parquet(f"{tmp_path}/target")
    spark.range(50).selectExpr("id * 3 as k", "'b' as v", "0 as soft_delete", "timestamp_ntz'2024-01-01' as load_ts").write.parquet(f"{tmp_path}/delta")
    merged = merge_delta(spark.read.parquet(f"{tmp_path}/target"), spark.read.parquet(f"{tmp_path}/delta"), ["k"], run_ts=DAY[1])
    assert merged.count() == 100 + 16
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Window [") == 1 and plan.count("FullOuter") == 1
    assert plan.count("FileScan parquet") == 2  # one of each


# -- two writers ----------------------------------------------------------


def test_of_two_commits_on_one_generation_the_second_is_refused(spark, tmp_path, rows):
    store, other = (GenerationStore(spark, str(tmp_path)) for _ in range(2))
    df = spark.range(5).select(F.col("id").alias("k"))
    one, two = store.next_generation(), other.next_generation()
    assert one != two
    for s, n in ((store, one), (other, two)):
        s.write_live(df, n, ["k"], 1)
    entry = [{"bucket": 0, "rows": 5, "fingerprint": None}]
    other.commit(two, df.schema, 1, entry)
    with pytest.raises(CommitConflict):
        store.commit(one, df.schema, 1, entry)
    store.discard(one)
    assert store.generations() == [two] and rows(store.read()) == rows(df)


def test_a_successor_whose_writer_died_is_completed(spark, tmp_path):
    store = GenerationStore(spark, str(tmp_path))
    df = spark.range(5).select(F.col("id").alias("k"))
    entry = [{"bucket": 0, "rows": 5, "fingerprint": None}]
    n = store.next_generation()
    store.write_live(df, n, ["k"], 1)
    store.commit(n, df.schema, 1, entry)
    (tmp_path / "commits" / f"generation={n}").unlink()  # as if its writer had died in front of the last step
    again = store.next_generation()
    store.write_live(df, again, ["k"], 1)
    with pytest.raises(CommitConflict):
        store.commit(again, df.schema, 1, entry)
    assert store.generations() == [n]


def test_two_puts_at_once_are_both_kept(spark, tmp_path):
    WatermarkStore(spark, str(tmp_path)).put("t0", datetime(2024, 1, 1), "SUCCESS")
    failed = []

    def put(name):
        try:
            for day in (2, 3):
                WatermarkStore(spark, str(tmp_path)).put(name, datetime(2024, 1, day), "SUCCESS")
        except Exception as error:  # shown by the assertion
            failed.append(error)

    threads = [threading.Thread(target=put, args=(f"t{k}",)) for k in (1, 2)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    store = WatermarkStore(spark, str(tmp_path))
    assert not failed and {n: store.get(n).day for n in ("t0", "t1", "t2")} == {"t0": 1, "t1": 3, "t2": 3}
