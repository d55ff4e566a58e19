"""Whole runs: repeated, failing, changing bucket counts, many tables."""

import os
import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tidemark.control.runlog import RunLog
from tidemark.operators.diff import DuplicateKeyError
from tidemark.operators.merge import STAY_DELETED
from tidemark.plans import snapshot_cdc, timestamp_cdc
from tidemark.plans.load import load_delta, merge_into
from tidemark.plans.snapshot_cdc import run_snapshot_cdc
from tidemark.plans.sync import sync_tables, total_rows
from tidemark.plans.timestamp_cdc import run_timestamp_cdc
from tidemark.sinks.generations import GenerationStore
from tidemark.sources.files import EmptyLoad, LoadError, validate_load
from tidemark.sources.paths import TablePaths
from tidemark.specs import TableSpec

DAY = [datetime(2024, 1, d) for d in range(1, 29)]


@pytest.fixture
def paths(tmp_path):
    return TablePaths(str(tmp_path), "db", "s", "t")


def frame(spark, data):
    return spark.createDataFrame(sorted(data.items()), "k int, v string")


def target_state(spark, paths):
    rows = GenerationStore(spark, paths.target).read()
    return {r.k: (r.v, r.is_deleted) for r in rows.collect()}


def test_snapshot_runs_follow_the_source(spark, paths):
    source = random.Random(5)
    state, expected = {}, {}
    for day in DAY[:4]:
        for k in source.sample(range(30), 8):
            if source.random() < 0.3:
                state.pop(k, None)
            else:
                state[k] = f"{k}-{day:%d}"
        before = {k: v for k, (v, gone) in expected.items() if not gone}
        result = run_snapshot_cdc(spark, frame(spark, state), ["k"], paths, day, buckets=3)
        assert result.extracted == len(state)
        assert result.inserted == len(set(state) - set(before))
        assert result.deleted == len(set(before) - set(state))
        assert result.updated == sum(1 for k in set(before) & set(state) if before[k] != state[k])
        for k in set(before) - set(state):
            expected[k] = (before[k], 1)
        expected.update({k: (v, 0) for k, v in state.items()})
        assert target_state(spark, paths) == expected
        snapshot = GenerationStore(spark, paths.snapshot).read()
        assert {r.k: r.v for r in snapshot.collect()} == state


def test_unchanged_source_commits_and_writes_nothing(spark, paths):
    data = {k: str(k) for k in range(20)}
    run_snapshot_cdc(spark, frame(spark, data), ["k"], paths, DAY[0], buckets=4)
    result = run_snapshot_cdc(spark, frame(spark, data), ["k"], paths, DAY[1], buckets=4)
    assert (result.written, result.changed_buckets, result.delta_path) == (0, 0, None)
    store = GenerationStore(spark, paths.snapshot)
    assert store.generations() == [1]
    assert os.listdir(f"{paths.snapshot}/live") == ["generation=1"]


def test_only_changed_buckets_are_replaced(spark, paths):
    data = {k: str(k) for k in range(200)}
    run_snapshot_cdc(spark, frame(spark, data), ["k"], paths, DAY[0], buckets=16)
    data[7] = "new"
    result = run_snapshot_cdc(spark, frame(spark, data), ["k"], paths, DAY[1], buckets=16)
    assert (result.updated, result.changed_buckets) == (1, 1)
    for place in (paths.snapshot, paths.target):
        index = GenerationStore(spark, place).index()
        assert sum(r.data_generation == 2 for r in index) == 1


def test_bucket_that_becomes_empty_yields_deletes(spark, paths):
    data = {k: str(k) for k in range(8)}
    run_snapshot_cdc(spark, frame(spark, data), ["k"], paths, DAY[0], buckets=8)
    result = run_snapshot_cdc(spark, frame(spark, {0: "0"}), ["k"], paths, DAY[1], buckets=8)
    assert result.deleted == 7
    result = run_snapshot_cdc(spark, frame(spark, {}), ["k"], paths, DAY[2], buckets=8)
    assert result.deleted == 1
    assert set(target_state(spark, paths).values()) == {(str(k), 1) for k in range(8)}
    result = run_snapshot_cdc(spark, frame(spark, {3: "back"}), ["k"], paths, DAY[3], buckets=8)
    assert result.inserted == 1 and target_state(spark, paths)[3] == ("back", 0)


def test_other_bucket_count_finds_the_same_changes(spark, paths):
    data = {k: str(k) for k in range(50)}
    run_snapshot_cdc(spark, frame(spark, data), ["k"], paths, DAY[0], buckets=2)
    data[3] = "new"
    del data[4]
    result = run_snapshot_cdc(spark, frame(spark, data), ["k"], paths, DAY[1], buckets=5)
    assert (result.inserted, result.updated, result.deleted) == (0, 1, 1)
    assert {r.k: r.v for r in GenerationStore(spark, paths.snapshot).read().collect()} == data


def test_bucket_count_stays_with_the_snapshot(spark, paths, monkeypatch):
    counts = iter((4, 9))
    monkeypatch.setattr(snapshot_cdc, "bucket_count_of", lambda stored: next(counts))
    run_snapshot_cdc(spark, frame(spark, {k: "a" for k in range(40)}), ["k"], paths, DAY[0])
    result = run_snapshot_cdc(spark, frame(spark, {k: "a" for k in range(90)}), ["k"], paths, DAY[1])
    assert result.inserted == 50 and result.updated == result.deleted == 0
    assert GenerationStore(spark, paths.snapshot).index()[0].buckets == 4


@pytest.mark.parametrize("first", [True, False])
def test_duplicate_keys_are_refused(spark, paths, first):
    twice = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b")], "k int, v string")
    if not first:
        run_snapshot_cdc(spark, frame(spark, {1: "a", 2: "x"}), ["k"], paths, DAY[0], buckets=1)
    with pytest.raises(DuplicateKeyError):
        run_snapshot_cdc(spark, twice, ["k"], paths, DAY[1], buckets=1)


def test_failed_merge_is_made_up_for_by_the_next_run(spark, paths, monkeypatch):
    run_snapshot_cdc(spark, frame(spark, {1: "a", 2: "b"}), ["k"], paths, DAY[0], buckets=2)

    def fail(*args, **kwargs):
        raise RuntimeError("target is away")

    monkeypatch.setattr(snapshot_cdc, "merge_into", fail)
    with pytest.raises(RuntimeError):
        run_snapshot_cdc(spark, frame(spark, {1: "A", 3: "c"}), ["k"], paths, DAY[1], buckets=2)
    assert GenerationStore(spark, paths.snapshot).generations() == [1]
    monkeypatch.undo()
    result = run_snapshot_cdc(spark, frame(spark, {1: "A", 3: "c"}), ["k"], paths, DAY[2], buckets=2)
    assert (result.inserted, result.updated, result.deleted) == (1, 1, 1)
    assert target_state(spark, paths) == {1: ("A", 0), 2: ("b", 1), 3: ("c", 0)}


def test_failed_commit_after_the_merge_repeats_harmlessly(spark, paths, monkeypatch):
    run_snapshot_cdc(spark, frame(spark, {1: "a", 2: "b"}), ["k"], paths, DAY[0], buckets=2)
    whole = GenerationStore.commit

    def fail_for_snapshot(self, *args, **kwargs):
        if self.base.endswith("/snapshot"):
            raise RuntimeError("executor lost")
        return whole(self, *args, **kwargs)

    monkeypatch.setattr(GenerationStore, "commit", fail_for_snapshot)
    with pytest.raises(RuntimeError):
        run_snapshot_cdc(spark, frame(spark, {1: "A", 3: "c"}), ["k"], paths, DAY[1], buckets=2)
    monkeypatch.undo()
    run_snapshot_cdc(spark, frame(spark, {1: "A", 3: "c"}), ["k"], paths, DAY[2], buckets=2)
    assert target_state(spark, paths) == {1: ("A", 0), 2: ("b", 1), 3: ("c", 0)}


def test_source_gains_and_loses_a_column(spark, paths):
    run_snapshot_cdc(spark, spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string"), ["k"], paths, DAY[0], buckets=2)
    wider = spark.createDataFrame([(1, "a", 5), (3, "c", 6)], "k int, v string, w int")
    run_snapshot_cdc(spark, wider, ["k"], paths, DAY[1], buckets=2)
    target = GenerationStore(spark, paths.target).read()
    assert {r.k: (r.v, r.w, r.is_deleted) for r in target.collect()} == {1: ("a", 5, 0), 2: ("b", None, 1), 3: ("c", 6, 0)}
    narrower = spark.createDataFrame([(1, 5), (3, 7)], "k int, w int")
    run_snapshot_cdc(spark, narrower, ["k"], paths, DAY[2], buckets=2)
    target = GenerationStore(spark, paths.target).read()
    assert {r.k: (r.v, r.w) for r in target.where("is_deleted = 0").collect()} == {1: ("a", 5), 3: ("c", 7)}


TS = "k int, v string, ins timestamp_ntz, upd timestamp_ntz"


def test_timestamp_runs(spark, paths):
    start = datetime(1900, 1, 1)
    first = [(1, "a", DAY[0], None), (2, "b", DAY[1], None), (3, "null", None, None)]
    run = run_timestamp_cdc(spark, spark.createDataFrame(first, TS), ["k"], ["ins", "upd"], start, paths, DAY[9], buckets=2)
    assert (run.extracted, run.deleted, run.watermark) == (2, 0, DAY[1])
    second = [(1, "A", DAY[0], DAY[4]), (3, "null", None, None), (4, "d", DAY[3], None)]
    run = run_timestamp_cdc(spark, spark.createDataFrame(second, TS), ["k"], ["ins", "upd"], run.watermark, paths, DAY[10], buckets=2)
    assert (run.extracted, run.deleted, run.watermark) == (2, 1, DAY[4])
    assert target_state(spark, paths) == {1: ("A", 0), 2: ("b", 1), 4: ("d", 0)}
    store = GenerationStore(spark, paths.snapshot)
    snapshot = store.read_snapshot(only_last_deletes=True)
    assert {(r.k, r.soft_delete) for r in snapshot.collect()} == {(1, 0), (3, 0), (4, 0), (2, 1)}
    run = run_timestamp_cdc(spark, spark.createDataFrame(second, TS), ["k"], ["ins", "upd"], run.watermark, paths, DAY[11], buckets=2)
    assert (run.written, run.watermark) == (0, DAY[4]) and store.generations() == [1, 2]


@pytest.mark.parametrize("trust", [True, False])
def test_trusted_timestamps_give_the_same_snapshot_and_target(spark, paths, trust):
    source = random.Random(3)
    state, mark = {}, datetime(1900, 1, 1)
    expected = {}
    for day in DAY[:5]:
        gone = source.sample(sorted(state), min(len(state), 4)) if state else []
        for k in gone:
            expected[k] = (state.pop(k)[0], 1)
        for k in source.sample(range(40), 10):
            state[k] = (f"{k}-{day:%d}", day)
            expected[k] = (state[k][0], 0)
        rows = spark.createDataFrame([(k, v, at, None) for k, (v, at) in sorted(state.items())], TS)
        run = run_timestamp_cdc(
            spark, rows, ["k"], ["ins", "upd"], mark, paths, day, buckets=3, trust_timestamps=trust
        )
        mark = run.watermark
        assert target_state(spark, paths) == expected
        snapshot = GenerationStore(spark, paths.snapshot).read()
        assert {r.k: (r.v, r.ins) for r in snapshot.collect()} == state


def test_trusted_increment_with_a_new_column_or_nothing(spark, paths):
    start = datetime(1900, 1, 1)
    rows = spark.createDataFrame([(k, "a", DAY[0]) for k in range(20)], "k int, v string, ins timestamp_ntz")
    args = (["k"], ["ins"])
    run = run_timestamp_cdc(spark, rows, *args, start, paths, DAY[10], buckets=3, trust_timestamps=True)
    run = run_timestamp_cdc(spark, rows, *args, run.watermark, paths, DAY[11], trust_timestamps=True)
    store = GenerationStore(spark, paths.snapshot)
    assert run.written == 0 and store.generations() == [1]
    wider = rows.withColumn("w", F.lit(None).cast("int")).where("k <> 5").union(
        spark.createDataFrame([(99, "n", DAY[1], 7)], "k int, v string, ins timestamp_ntz, w int")
    )
    run = run_timestamp_cdc(spark, wider, *args, run.watermark, paths, DAY[12], trust_timestamps=True)
    assert (run.extracted, run.deleted) == (1, 1)
    assert store.read().count() == 20 and store.read().where("w = 7").count() == 1
    assert {r.data_generation for r in store.index()} >= {store.current()}


def test_rows_without_timestamps_can_be_included(spark, paths):
    data = spark.createDataFrame([(1, "a", DAY[0], None), (2, "null", None, None)], TS)
    run = run_timestamp_cdc(spark, data, ["k"], ["ins", "upd"], datetime(1900, 1, 1), paths, DAY[9], buckets=1, nulls="include")
    assert run.extracted == 2


def test_failed_timestamp_load_keeps_the_deletes(spark, paths, monkeypatch):
    first = spark.createDataFrame([(1, "a", DAY[0], None), (2, "b", DAY[1], None)], TS)
    run = run_timestamp_cdc(spark, first, ["k"], ["ins", "upd"], datetime(1900, 1, 1), paths, DAY[9], buckets=1)
    monkeypatch.setattr(timestamp_cdc, "merge_into", lambda *a, **k: 1 / 0)
    second = spark.createDataFrame([(1, "a", DAY[0], None)], TS)
    with pytest.raises(ZeroDivisionError):
        run_timestamp_cdc(spark, second, ["k"], ["ins", "upd"], run.watermark, paths, DAY[10], buckets=1)
    monkeypatch.undo()
    run = run_timestamp_cdc(spark, second, ["k"], ["ins", "upd"], run.watermark, paths, DAY[11], buckets=1)
    assert run.deleted == 1 and target_state(spark, paths)[2] == ("b", 1)


def test_sync_tables_isolates_failures_and_logs(spark, tmp_path):
    specs = [
        TableSpec("db", "s", "good", ("k",)),
        TableSpec("db", "s", "no_keys", ()),
        TableSpec("db", "s", "broken", ("k",)),
        TableSpec("db", "s", "timed", ("k",), ("ins",)),
        TableSpec("db", "s", "falls_back", ("k",), ("missing",)),
    ]
    timed = spark.createDataFrame([(1, "a", DAY[2], None)], TS)

    def read(spec):
        if spec.table == "broken":
            raise OSError("no such table")
        return timed

    base = str(tmp_path)
    results = sync_tables(spark, specs, read, base, DAY[20], "nightly", buckets=1)
    by_table = {r.table: r for r in results}
    assert by_table["db.s.no_keys"].error and "no such table" in by_table["db.s.broken"].error
    assert by_table["db.s.timed"].watermark == DAY[2]
    assert by_table["db.s.falls_back"].load_type == "SNAPSHOT"
    assert total_rows(results) == 3

    later = spark.createDataFrame([(1, "a", DAY[2], None), (2, "b", DAY[3], None)], TS)
    results = sync_tables(spark, specs[3:4], lambda spec: later, base, DAY[21], "nightly", buckets=1, at_once=2)
    assert (results[0].extracted, results[0].watermark) == (1, DAY[3])
    state = {(r.SourceTable, r.RunId): r for r in RunLog(spark, f"{base}/control/runs").state().collect()}
    assert state[("good", 1)].Status == "SUCCESS" and state[("good", 1)].LoadType == "SNAPSHOT"
    assert state[("timed", 4)].LastRunTimestamp == DAY[2]


def test_failed_table_is_logged_failed(spark, tmp_path):
    specs = [TableSpec("db", "s", "t", ("nokey",)), TableSpec("db", "s", "u", ("k",))]
    sync_tables(spark, specs, lambda spec: frame(spark, {1: "a"}), str(tmp_path), DAY[0], buckets=1)
    rows = {r.SourceTable: r for r in RunLog(spark, f"{tmp_path}/control/runs").state().collect()}
    assert rows["t"].Status == "FAILED" and "nokey" in rows["t"].ErrorMessage
    assert rows["u"].Status == "SUCCESS" and rows["u"].RowsMerged == 1
    assert rows["u"].PipelineRunStatus == rows["t"].PipelineRunStatus == "FAILED"


DELTA = "k int, v string, soft_delete int, load_ts timestamp_ntz"


def test_load_delta_lands_checks_and_empties(spark, tmp_path):
    base = str(tmp_path)
    store = GenerationStore(spark, f"{base}/target")
    spark.createDataFrame([(1, "a", 0, DAY[0]), (2, "b", 0, DAY[0])], DELTA).write.parquet(f"{base}/in/run-1")
    spark.createDataFrame([(1, "A", 0, DAY[1], "x")], DELTA + ", hash_val string").write.parquet(f"{base}/in/run-2")
    assert load_delta(spark, f"{base}/in", store, f"{base}/raw", ["k"], run_ts=DAY[2], buckets=2) == 3
    assert {r.k: r.v for r in store.read().collect()} == {1: "A", 2: "b"}
    assert "hash_val" not in store.read().columns
    assert spark.read.parquet(f"{base}/raw").count() == 0
    # Loading all run directories again leaves the same rows.
    load_delta(spark, f"{base}/in", store, f"{base}/raw", ["k"], run_ts=DAY[3], buckets=2, policy=STAY_DELETED)
    assert {r.k: r.v for r in store.read().collect()} == {1: "A", 2: "b"}


@pytest.mark.parametrize("exists", [True, False])
def test_load_delta_without_rows(spark, tmp_path, exists):
    base = str(tmp_path)
    store = GenerationStore(spark, f"{base}/target")
    if exists:
        spark.createDataFrame([], DELTA).write.parquet(f"{base}/in/run-1")
    with pytest.raises(EmptyLoad):
        load_delta(spark, f"{base}/in", store, f"{base}/raw", ["k"], run_ts=DAY[0])
    assert load_delta(spark, f"{base}/in", store, f"{base}/raw", ["k"], run_ts=DAY[0], on_empty="skip") == 0
    assert store.current() is None


def test_partly_loaded_files_are_named(spark, tmp_path):
    spark.range(10).write.parquet(str(tmp_path / "in"))
    landed = spark.read.parquet(str(tmp_path / "in")).withColumn("file_name", F.col("_metadata.file_path"))
    expected = landed.groupBy(F.col("file_name").alias("file")).agg(F.count("*").alias("rows"))
    assert validate_load(landed, expected, file_column="file_name") == 10
    with pytest.raises(LoadError, match="of"):
        validate_load(landed.where("id <> 3"), expected, file_column="file_name")


def test_batches_are_merged_once_per_stream(spark, tmp_path):
    store = GenerationStore(spark, str(tmp_path))
    delta = spark.createDataFrame([(1, "a", 0, DAY[0])], DELTA)
    assert merge_into(store, delta, ["k"], run_ts=DAY[0], buckets=1, batch=("s1", 0)) == 1
    assert merge_into(store, delta, ["k"], run_ts=DAY[1], buckets=1, batch=("s1", 0)) is None
    assert merge_into(store, delta, ["k"], run_ts=DAY[2], buckets=1, batch=("s2", 0)) == 2
    assert merge_into(store, delta, ["k"], run_ts=DAY[3], buckets=1) == 3
    assert merge_into(store, delta, ["k"], run_ts=DAY[4], buckets=1, batch=("s1", 0)) is None
    assert merge_into(store, delta, ["k"], run_ts=DAY[4], buckets=1, batch=("s1", 1)) == 4


def test_stable_source_writes_changed_buckets_only(spark, paths):
    data = {k: str(k) for k in range(200)}
    run_snapshot_cdc(spark, frame(spark, data), ["k"], paths, DAY[0], buckets=16, stable_source=True)
    data[7] = "new"
    del data[8]
    result = run_snapshot_cdc(spark, frame(spark, data), ["k"], paths, DAY[1], buckets=16, stable_source=True)
    assert (result.inserted, result.updated, result.deleted, result.extracted) == (0, 1, 1, 199)
    store = GenerationStore(spark, paths.snapshot)
    written = [d for d in os.listdir(f"{paths.snapshot}/live/generation=2") if d.startswith("bucket=")]
    assert len(written) == result.changed_buckets <= 2
    assert {r.k: r.v for r in store.read().collect()} == data
    result = run_snapshot_cdc(spark, frame(spark, data), ["k"], paths, DAY[2], buckets=16, stable_source=True)
    assert result.written == 0 and store.generations() == [1, 2]


def test_columns_of_a_stored_target_can_change(spark, tmp_path):
    from pyspark.sql import types as T

    from tidemark.plans.load import alter_target

    store = GenerationStore(spark, str(tmp_path))
    merge_into(store, spark.createDataFrame([(1, "a", 0, DAY[0])], DELTA), ["k"], run_ts=DAY[0], buckets=2, batch=("s", 4))
    alter_target(store, ["k"], add={"w": T.LongType()})
    assert "w" in store.read().columns and store.read().first().w is None
    assert store.index()[0].data_generation == 1
    alter_target(store, ["k"], drop=["V"])
    assert "v" not in store.read().columns and store.read().count() == 1
    alter_target(store, ["k"], add={"v": T.StringType()})
    assert store.read().first().v is None
    assert merge_into(store, spark.createDataFrame([(1, "a", 0, DAY[1])], DELTA), ["k"], run_ts=DAY[1], batch=("s", 4)) is None
    with pytest.raises(ValueError):
        alter_target(store, ["k"], drop=["nothing"])


@pytest.mark.parametrize("mode", ["snapshot", "timestamp"])
def test_source_is_read_once_per_run(spark, paths, mode):
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            read.add(len(batch))
            yield batch

    # Changes the rows, with the run, of a source that counts what is read from it.
    for day, size in enumerate((300, 250, 280)):
        rows = spark.range(size).select(
            F.col("id").alias("k"), (F.col("id") * (day + 1)).alias("v"), F.lit(DAY[day]).alias("at")
        )
        source = rows.mapInPandas(counted, rows.schema)
        read.value = 0
        if mode == "snapshot":
            run_snapshot_cdc(spark, source, ["k"], paths, DAY[day], buckets=4)
        else:
            run_timestamp_cdc(spark, source, ["k"], ["at"], datetime(1900, 1, 1), paths, DAY[day], buckets=4)
        assert read.value == size


@pytest.mark.parametrize("broadcast_bytes", [0, 10**9])
def test_small_and_large_deltas_merge_alike(spark, tmp_path, broadcast_bytes):
    source = random.Random(11)
    store = GenerationStore(spark, str(tmp_path))
    expected = {}
    for day in DAY[:6]:
        load = [(k, f"{k}-{day:%d}", source.choice([0, 0, 1]), day) for k in source.sample(range(60), 20)]
        merge_into(
            store, spark.createDataFrame(load, DELTA), ["k"], run_ts=day, buckets=5, broadcast_bytes=broadcast_bytes
        )
        for k, v, gone, _ in load:
            if gone and k in expected:
                expected[k] = (expected[k][0], 1)
            elif not gone:
                expected[k] = (v, 0)
        got = store.read(keep_bucket=True)
        assert {r.k: (r.v, r.is_deleted) for r in got.collect()} == expected
        # Every row lies in the bucket its key belongs to.
        from tidemark.functions.hashing import hash_bucket

        assert hash_bucket(got.withColumnRenamed("bucket", "at"), ["k"], 5).where("at <> bucket").count() == 0


def test_rows_of_a_target_stay_in_their_tasks(spark, tmp_path, monkeypatch):
    plans = []
    whole = GenerationStore.write_in_place

    def spy(self, kept, added, *args):
        plans.append(kept._jdf.queryExecution().executedPlan().toString())
        return whole(self, kept, added, *args)

    monkeypatch.setattr(GenerationStore, "write_in_place", spy)
    store = GenerationStore(spark, str(tmp_path))
    for day in DAY[:2]:
        merge_into(store, spark.createDataFrame([(1, "a", 0, day), (2, "b", 0, day)], DELTA), ["k"], run_ts=day, buckets=2)
    assert len(plans) == 1 and "BroadcastHashJoin" in plans[0] and "Exchange hashpartitioning" not in plans[0]


def test_small_files_are_gathered_again(spark, tmp_path):
    store = GenerationStore(spark, str(tmp_path))
    most = 0
    for n in range(12):
        day = DAY[n]
        merge_into(store, spark.createDataFrame([(n, "a", 0, day)], DELTA), ["k"], run_ts=day, buckets=1)
        most = max(most, len(store.read().inputFiles()))
    assert store.read().count() == 12
    assert most <= 6


def test_large_source_is_landed_by_bucket_without_a_shuffle(spark, paths, monkeypatch):
    """Rows of a large source are written once a run, and the outcome is that of the shuffled write."""
    states = [{k: str(k) for k in range(60)}, {**{k: str(k) for k in range(5, 60)}, 7: "new", 99: "n"}, {k: str(k) for k in range(60)}]
    seen = []
    for place, large in ((paths, True), (TablePaths(f"{paths.root}-plain", "d", "s", "t"), False)):
        landed, kinds = [], []
        real = snapshot_cdc.write_and_read
        monkeypatch.setattr(snapshot_cdc, "scatters", lambda *a, large=large: large)
        monkeypatch.setattr(snapshot_cdc, "write_and_read", lambda df, path: landed.append(path.rsplit("/", 1)[1]) or real(df, path))
        for day, data in enumerate(states):
            run = run_snapshot_cdc(spark, frame(spark, data), ["k"], place, DAY[day], buckets=3)
            kinds.append((run.extracted, run.inserted, run.updated, run.deleted, run.changed_buckets))
        monkeypatch.undo()
        store = GenerationStore(spark, place.snapshot)
        rows = sorted(map(tuple, store.read_snapshot().select("k", "v", "hash_val", "soft_delete").collect()))
        seen.append((kinds, rows, target_state(spark, place), [sorted(map(tuple, store.read(g).collect())) for g in store.generations()]))
        assert ("landed" in landed) is not large
    assert seen[0] == seen[1]


def test_large_source_leaves_unchanged_buckets_where_they_are(spark, paths, monkeypatch):
    monkeypatch.setattr(snapshot_cdc, "scatters", lambda *a: True)
    data = {k: str(k) for k in range(200)}
    run_snapshot_cdc(spark, frame(spark, data), ["k"], paths, DAY[0], buckets=16)
    data[7] = "new"
    assert run_snapshot_cdc(spark, frame(spark, data), ["k"], paths, DAY[1], buckets=16).changed_buckets == 1
    store = GenerationStore(spark, paths.snapshot)
    assert sum(r.data_generation == 2 for r in store.index()) == 1
    assert len([n for n in os.listdir(f"{paths.snapshot}/live/generation=2") if n.startswith("bucket=")]) == 1
    assert {r.k: r.v for r in store.read().collect()} == data
    run_snapshot_cdc(spark, frame(spark, data), ["k"], paths, DAY[2], buckets=16)
    assert store.generations() == [1, 2] and sorted(os.listdir(f"{paths.snapshot}/live")) == ["generation=1", "generation=2"]


def test_replaced_rows_are_joined_with_short_hashes(spark, paths, monkeypatch):
    """Where the changed keys are too many to be broadcast, the hash crosses the shuffle as bytes and comes out as it was."""
    monkeypatch.setattr(snapshot_cdc, "fits_broadcast", lambda *a: False)
    run_snapshot_cdc(spark, frame(spark, {1: "a", 2: "b", 3: "c"}), ["k"], paths, DAY[0], buckets=2)
    store = GenerationStore(spark, paths.snapshot)
    before = {r.k: r.hash_val for r in store.read().collect()}
    run_snapshot_cdc(spark, frame(spark, {1: "A", 3: "c"}), ["k"], paths, DAY[1], buckets=2)
    assert {r.k: r.hash_val for r in store.read_history().collect()} == {1: before[1], 2: before[2]}


def test_which_tables_are_large_for_their_buckets(spark):
    from tidemark.sinks.datasets import scatters

    assert scatters(spark.range(10**9), 8) and not scatters(spark.range(10**9), 2000)
    assert not scatters(spark.range(10**5), 8)
    unknown = spark.createDataFrame(spark.sparkContext.parallelize([(1,)]), "k int")
    assert not scatters(unknown, 1)


def test_large_timestamp_source_is_landed_by_bucket_without_a_shuffle(spark, paths, monkeypatch):
    second = [(1, "A", DAY[0], DAY[4]), (3, "null", None, None), (4, "d", DAY[3], None)]
    seen = []
    for place, large in ((paths, True), (TablePaths(f"{paths.root}-plain", "d", "s", "t"), False)):
        landed = []
        real = timestamp_cdc.write_and_read
        monkeypatch.setattr(timestamp_cdc, "scatters", lambda *a, large=large: large, raising=False)
        monkeypatch.setattr(timestamp_cdc, "write_and_read", lambda df, path: landed.append(path.rsplit("/", 1)[1]) or real(df, path))
        first = [(1, "a", DAY[0], None), (2, "b", DAY[1], None), (3, "null", None, None)]
        run = run_timestamp_cdc(spark, spark.createDataFrame(first, TS), ["k"], ["ins", "upd"], datetime(1900, 1, 1), place, DAY[9], buckets=7)
        run = run_timestamp_cdc(spark, spark.createDataFrame(second, TS), ["k"], ["ins", "upd"], run.watermark, place, DAY[10], buckets=7)
        monkeypatch.undo()
        store = GenerationStore(spark, place.snapshot)
        rows = sorted(map(str, store.read_snapshot(only_last_deletes=True).select("k", "v", "ins", "upd", "soft_delete").collect()))
        seen.append((run.extracted, run.deleted, run.watermark, rows, target_state(spark, place), sorted((r.bucket, r.data_generation, r["rows"]) for r in store.index())))
        assert ("landed" in landed) is not large
    assert seen[0] == seen[1]
