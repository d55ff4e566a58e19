"""Run log and watermark store."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tidemark.control.runlog import (
    RUN_LOG_SCHEMA,
    RunLog,
    control_view,
    last_watermark,
    last_watermarks,
    latest_run,
    lookback_watermarks,
    next_run_id,
    rollup_status,
)
from tidemark.control.watermarks import WatermarkStore
from tidemark.functions.scalars import FIRST_WATERMARK, OPEN_END

T0, T1 = datetime(2024, 1, 1, 8), datetime(2024, 1, 1, 8, 1, 35)
TABLE = dict(PipelineId="p", SourceType="jdbc", SourceDatabase="db", SourceSchema="s", LoadType="TIMESTAMP")


@pytest.fixture
def log(spark, tmp_path):
    return RunLog(spark, str(tmp_path / "runs"))


def run(log, run_id, table="t", status="SUCCESS", pipeline_run="r1", ended=T1, **end):
    log.start(T0, RunId=run_id, PipelineRunId=pipeline_run, SourceTable=table, **TABLE)
    if status is not None:
        log.end(run_id, ended, status, **end)


def test_empty_log(spark, log):
    assert log.next_id() == 1
    assert last_watermark(log.read(), "p", "jdbc", "db", "s", "t") == FIRST_WATERMARK
    log.ensure()
    log.ensure()
    assert log.read().count() == 0 and log.next_id() == 1
    assert log.state().schema == RUN_LOG_SCHEMA


def test_start_and_end(log):
    run(log, 1, status=None)
    started = log.state().first()
    assert (started.Status, started.MergeStatus, started.TableRunStatus) == ("STARTED",) * 3
    assert (started.RowsMerged, started.RowsProcessed, started.EndTime) == (0, None, None)
    log.end(1, T1, "SUCCESS", RowsProcessed=7, RowsDeleted=2, LastRunTimestamp=T0, MergeStatus="SUCCESS")
    ended = log.state().first()
    assert (ended.Status, ended.TableRunStatus, ended.PipelineRunStatus) == ("SUCCESS",) * 3
    assert (ended.DurationSeconds, ended.RowsProcessed, ended.RowsExtracted, ended.RowsMerged) == (95, 7, 7, 7)
    assert (ended.RowsDeleted, ended.StartTime, ended.ExtractStatus, ended.MergeStatus) == (2, T0, None, "SUCCESS")
    assert log.next_id() == 2


def test_end_without_rows_or_start(log):
    run(log, 1, status="FAILED", ErrorMessage="it's broken")
    row = log.state().first()
    assert (row.RowsProcessed, row.RowsExtracted, row.RowsDeleted, row.ErrorMessage) == (0, 0, 0, "it's broken")
    with pytest.raises(ValueError, match="never started"):
        log.end(99, T1, "SUCCESS")
    with pytest.raises(ValueError, match="not run log columns"):
        log.start(T0, RunId=2, PipelineRunId="r", Wrong=1)


def test_rollup_ignores_null_and_counts_unfinished_runs(spark):
    data = [(1, "a", "SUCCESS"), (2, "a", None), (3, "b", "SUCCESS"), (4, "b", "FAILED"), (5, "c", "STARTED"), (6, "d", None)]
    log = spark.createDataFrame(data, "RunId long, PipelineRunId string, TableRunStatus string")
    got = {r.PipelineRunId: r.PipelineRunStatus for r in rollup_status(log).collect()}
    assert got == {"a": "SUCCESS", "b": "FAILED", "c": "FAILED", "d": "SUCCESS"}


def test_last_watermark_takes_the_latest_success(spark, log):
    run(log, 1, LastRunTimestamp=datetime(2023, 1, 1), ended=datetime(2024, 1, 1))
    run(log, 2, LastRunTimestamp=datetime(2023, 3, 1), ended=datetime(2024, 1, 3))
    run(log, 3, LastRunTimestamp=datetime(2023, 2, 1), ended=datetime(2024, 1, 4), status="FAILED")
    run(log, 4, LastRunTimestamp=None, ended=datetime(2024, 1, 5))
    run(log, 5, table="other", LastRunTimestamp=datetime(2023, 9, 1), ended=datetime(2024, 1, 6))
    run(log, 6, table="new", status=None)
    events = log.read()
    assert last_watermark(events, "p", "jdbc", "db", "s", "t") == datetime(2023, 3, 1)
    assert last_watermark(events, "q", "jdbc", "db", "s", "t") == FIRST_WATERMARK
    every = {r.SourceTable: r.watermark for r in last_watermarks(events).collect()}
    assert every == {"t": datetime(2023, 3, 1), "other": datetime(2023, 9, 1), "new": FIRST_WATERMARK}
    assert latest_run(events).first().RunId == 6
    assert next_run_id(events).first().next_id == 7


def test_lookback_skips_empty_runs_and_the_open_end(spark):
    schema = "RunId long, SourceTable string, Status string, RowsProcessed long, LastRunTimestamp timestamp_ntz"
    at = datetime(2024, 1, 1, 0, 5)
    log = spark.createDataFrame(
        [
            (1, "t", "SUCCESS", 5, at),
            (2, "t", "SUCCESS", 0, datetime(2024, 2, 1)),
            (3, "t", "SUCCESS", 5, OPEN_END),
            (4, "t", "FAILED", 5, datetime(2024, 3, 1)),
            (5, "t", "SUCCESS", 5, None),
            (6, "u", "SUCCESS", 0, at),
        ],
        schema,
    )
    for name in RUN_LOG_SCHEMA.fieldNames():
        if name not in log.columns:
            log = log.withColumn(name, F.lit(None))
    got = lookback_watermarks(control_view(log)).collect()
    assert [tuple(r) for r in got] == [("t", datetime(2023, 12, 31, 23, 55))]
    assert len(control_view(log).columns) == 18


def test_watermark_store(spark, tmp_path):
    store = WatermarkStore(spark, str(tmp_path))
    assert store.get("t") == FIRST_WATERMARK
    store.put("t", T0, "SUCCESS")
    store.put("u", T1, "FAILED", full_load_done=0, last_run_lsn="0x1")
    store.put("t", T1, "SUCCESS")
    assert store.get("t") == T1 and store.get("u") == T1 and store.get("v") == FIRST_WATERMARK
    assert [tuple(r) for r in store.read().orderBy("TableName").collect()] == [
        ("t", T1, "SUCCESS", None, 1), ("u", T1, "FAILED", "0x1", 0)]
