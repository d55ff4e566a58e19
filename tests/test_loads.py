"""Batch loads: files taken once, damaged files, counts from the write, options of the list, and the run log's places."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tidemark.control.runlog import RunLog
from tidemark.functions.hashing import bucket_count_of
from tidemark.operators.merge import POLICIES
from tidemark.plans import load as load_plan
from tidemark.plans.load import load_delta
from tidemark.plans.snapshot_cdc import run_snapshot_cdc
from tidemark.sinks.datasets import append_raw
from tidemark.sinks.generations import GenerationStore
from tidemark.sources.files import EmptyLoad, LoadError
from tidemark.sources.ledger import FileLedger, list_files, skipped_files
from tidemark.sources.paths import TablePaths
from tidemark.sources.storage import children, create_new
from tidemark.specs import SpecError, read_specs

DAY = [f"2024-01-0{k} 00:00:00" for k in range(1, 8)]


def rows_of(spark, low, high, tag="a"):
    return spark.range(low, high).select(F.col("id").alias("k"), F.lit(tag).alias("v"), F.lit(0).alias("soft_delete"))


def put(spark, path, low, high, tag="a"):
    rows_of(spark, low, high, tag).coalesce(1).write.mode("overwrite").parquet(path)


def test_a_file_is_taken_once_and_again_when_replaced(spark, tmp_path, rows):
    base = str(tmp_path)
    store, ledger = GenerationStore(spark, f"{base}/target"), FileLedger(spark, f"{base}/ledger")
    take = lambda day: load_delta(
        spark, f"{base}/in", store, f"{base}/raw", ["k"], run_ts=DAY[day], on_empty="skip", buckets=2, ledger=ledger
    )
    put(spark, f"{base}/in/a", 0, 10)
    assert take(0) == 10 and take(1) == 0
    put(spark, f"{base}/in/b", 5, 8, "b")
    assert take(2) == 3
    assert rows(store.read(), "k", "v") == [(k, "b" if 5 <= k < 8 else "a") for k in range(10)]
    put(spark, f"{base}/in/a", 0, 2, "c")
    assert take(3) == 2 and take(4) == 0
    assert ledger.read().count() == 3 and ledger.new_files(list_files(spark, f"{base}/in")).isEmpty()
    with pytest.raises(EmptyLoad):
        load_delta(spark, f"{base}/in", store, f"{base}/raw", ["k"], run_ts=DAY[5], ledger=ledger)


def test_a_load_that_dies_takes_its_files_again(spark, tmp_path, monkeypatch):
    base = str(tmp_path)
    store, ledger = GenerationStore(spark, f"{base}/target"), FileLedger(spark, f"{base}/ledger")
    put(spark, f"{base}/in/a", 0, 10)

    def die(*args, **kwargs):
        raise OSError("lost")

    with monkeypatch.context() as m:
        m.setattr(load_plan, "merge_into", die)
        with pytest.raises(OSError):
            load_delta(spark, f"{base}/in", store, f"{base}/raw", ["k"], run_ts=DAY[0], ledger=ledger)
    assert load_delta(spark, f"{base}/in", store, f"{base}/raw", ["k"], run_ts=DAY[0], buckets=2, ledger=ledger) == 10


def test_damaged_files_are_named_and_the_others_loaded(spark, tmp_path):
    base = str(tmp_path)
    for name in ("good", "cut", "torn", "none"):
        put(spark, f"{base}/in/{name}", 0, 0 if name == "none" else 1000)
    cut, torn = (next((tmp_path / "in" / name).glob("*.parquet")) for name in ("cut", "torn"))
    for file in (cut, torn):
        file.write_bytes(file.read_bytes()[:-20])
    cut.with_name(f".{cut.name}.crc").unlink()  # the other one fails its check sum as well
    (tmp_path / "in" / "hollow.parquet").write_bytes(b"")
    (tmp_path / "in" / "words.parquet").write_bytes(b"not what its name says")
    store, ledger = GenerationStore(spark, f"{base}/target"), FileLedger(spark, f"{base}/ledger")
    schema = rows_of(spark, 0, 1).schema
    again = lambda day: load_delta(
        spark, f"{base}/in", store, f"{base}/raw", ["k"], run_ts=DAY[day], buckets=2, schema=schema, ledger=ledger, skipped=f"{base}/skipped", on_empty="skip"
    )
    assert again(0) == 1000 and store.read().count() == 1000
    told = {r["file"].rsplit("/", 1)[1]: r["reason"] for r in spark.read.parquet(f"{base}/skipped").collect()}
    assert told == {cut.name: "no whole Parquet file", torn.name: "could not be read", "words.parquet": "no whole Parquet file", "hollow.parquet": "no bytes"}
    # what was damaged is new once it is mended
    put(spark, f"{base}/in/cut", 1000, 1500)
    assert again(1) == 500
    with pytest.raises(Exception, match="(?i)parquet"):
        load_delta(spark, f"{base}/in", store, f"{base}/raw", ["k"], run_ts=DAY[2], schema=schema)


def test_a_file_read_in_part_is_named(spark, tmp_path):
    put(spark, f"{tmp_path}/in", 0, 100)
    name = next(tmp_path.glob("in/*.parquet"))
    loaded = spark.range(60).select(F.lit(f"file://{name}").alias("file_name"))
    found = skipped_files(spark, f"{tmp_path}/in", loaded).collect()
    assert [(r["rows"], r["want"], r["reason"]) for r in found] == [(60, 100, "read in part")]


def test_rows_are_counted_as_they_are_written(spark, tmp_path, monkeypatch):
    base = str(tmp_path)
    assert append_raw(rows_of(spark, 0, 7), f"{base}/x") == 7 and append_raw(rows_of(spark, 0, 0), f"{base}/x", "r") == 0
    put(spark, f"{base}/in/a", 0, 10)
    store = GenerationStore(spark, f"{base}/target")
    monkeypatch.setattr(load_plan, "validate_load", lambda *a, **k: pytest.fail("the landing table is read for its counts"))
    assert load_delta(spark, f"{base}/in", store, f"{base}/raw", ["k"], run_ts=DAY[0], buckets=2) == 10
    monkeypatch.undo()
    monkeypatch.setattr(load_plan, "append_raw", lambda df, path, run: append_raw(df.limit(4), path, run))
    with pytest.raises(LoadError, match="4 of 10"):
        load_delta(spark, f"{base}/in", store, f"{base}/raw", ["k"], run_ts=DAY[1], buckets=2)


HEAD = "DATABASE_NAME,SCHEMA_NAME,SRC_TBL_NAME,PRIMARY_KEY_COL,INCR_LOGIC_COL_NAME,TRUST_TIMESTAMPS,NULL_TIMESTAMPS,STABLE_SOURCE,CHECK_KEYS,BUCKETS,MERGE_POLICY"


def test_options_of_the_list(spark, tmp_path):
    path = tmp_path / "list.csv"
    path.write_text(f"{HEAD}\nd,s,a,k,ts,Y,include,,no,16,keep_delete_ts\nd,s,b,k,null,,,TRUE,,,\n")
    a, b = read_specs(spark, str(path))
    assert (a.trust_timestamps, a.nulls, a.stable_source, a.check_keys, a.buckets, a.policy) == (True, "include", False, False, 16, POLICIES["keep_delete_ts"])
    assert (b.trust_timestamps, b.nulls, b.stable_source, b.check_keys, b.buckets, b.policy) == (False, "exclude", True, True, None, None)


@pytest.mark.parametrize("entry, named", [("maybe,,,,,", "TRUST_TIMESTAMPS"), (",,,,0,", "BUCKETS"), (",,,,many,", "BUCKETS"), (",,,,,upsert", "MERGE_POLICY"), (",all,,,,", "NULL_TIMESTAMPS")])
def test_an_option_that_cannot_be_read_is_named(spark, tmp_path, entry, named):
    path = tmp_path / "list.csv"
    path.write_text(f"{HEAD}\nd,s,orders,k,ts,{entry}\n")
    with pytest.raises(SpecError, match=f"orders: {named}"):
        read_specs(spark, str(path))


def test_watermarks_are_looked_up_in_the_newest_days(spark, tmp_path):
    log = RunLog(spark, str(tmp_path))
    key = ("jdbc", "db", "s", "t")
    names = dict(zip(("SourceType", "SourceDatabase", "SourceSchema", "SourceTable"), key))
    for day in range(6):
        run = f"p_{day}"
        log.start(DAY[day], RunId=day + 1, PipelineRunId=run, PipelineId="p/1", LoadType="TIMESTAMP", **names)
        log.end(day + 1, DAY[day], "FAILED" if day == 5 else "SUCCESS", PipelineRunId=run, LastRunTimestamp=datetime(2024, 2, day + 1))
    days = children(spark, f"{tmp_path}/ended/pipeline=p%2F1")
    assert len(days) == 6
    for day in days[:3]:  # what is not needed is not read
        for file in (tmp_path / "ended" / "pipeline=p%2F1" / day).glob("*.parquet"):
            file.write_bytes(b"damaged")
    other = ("jdbc", "db", "s", "u")
    assert log.watermarks("p/1", [key]) == {key: datetime(2024, 2, 5)}
    assert log.watermarks("p/2", [key, other]) == {}
    with pytest.raises(Exception):
        log.watermarks("p/1", [other])


def test_run_ids_are_given_out_once(spark, tmp_path):
    log, other = RunLog(spark, str(tmp_path)), RunLog(spark, str(tmp_path))
    assert [log.claim_ids(3), other.claim_ids(1), other.next_id(), log.claim_ids(2), other.claim_ids(1)] == [1, 4, 5, 5, 7]
    assert create_new(spark, f"{tmp_path}/ids/upto=8") and log.next_id() == 9


def test_buckets_go_by_stored_size(spark, tmp_path, monkeypatch):
    assert [bucket_count_of(n, 10) for n in (0, 1, 10, 11, 95)] == [1, 1, 1, 2, 10]
    from tidemark.plans import snapshot_cdc

    monkeypatch.setattr(snapshot_cdc, "bucket_count_of", lambda stored: bucket_count_of(stored, 20_000))
    counts = {}
    for name, value in (("narrow", F.lit("a")), ("wide", F.concat_ws(" ", *[F.md5(F.concat("id", F.lit(k))) for k in range(12)]))):
        paths = TablePaths(str(tmp_path), "d", "s", name)
        frame = spark.range(2000).select(F.col("id").cast("string").alias("id")).select(F.col("id").alias("k"), value.alias("v"))
        run_snapshot_cdc(spark, frame, ["k"], paths, DAY[0], policy=None)
        counts[name] = GenerationStore(spark, paths.snapshot).index()[0].buckets
    assert counts["wide"] > 3 * counts["narrow"] >= 3
