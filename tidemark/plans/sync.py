"""Keeping many tables in step."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from tidemark.control.runlog import FAILED, SUCCESS, RunLog
from tidemark.functions.columns import project
from tidemark.functions.scalars import FIRST_WATERMARK
from tidemark.operators.merge import RESURRECT, MergePolicy
from tidemark.plans.result import RunResult
from tidemark.plans.snapshot_cdc import run_snapshot_cdc
from tidemark.plans.timestamp_cdc import run_timestamp_cdc
from tidemark.sources.paths import TablePaths
from tidemark.specs import TIMESTAMP, TableSpec, choose_load_type


def sync_tables(
    spark: SparkSession,
    specs: Iterable[TableSpec],
    read_source: Callable[[TableSpec], DataFrame],
    base: str,
    run_ts: datetime,
    pipeline_id: str = "tables",
    policy: MergePolicy | None = RESURRECT,
    buckets: int | None = None,
    at_once: int = 1,
    clock: Callable[[], datetime] | None = None,
) -> list[RunResult]:
    """Run change capture for every table of the list and log each run.

    A table with increment columns that all exist goes by timestamp, any
    other by snapshot comparison. A table without keys is skipped; a failing
    one is logged FAILED and does not stop the others. A table's own options
    (see ``TableSpec``) go before those given here. ``at_once`` tables are
    driven side by side, sharing the cluster's slots.
    """
    log = RunLog(spark, f"{base.rstrip('/')}/control/runs")
    clock = clock or (lambda: run_ts)
    pipeline_run = f"{pipeline_id}_{run_ts:%Y%m%d%H%M%S}" + (f"{run_ts:%f}" if run_ts.microsecond else "")
    specs = list(specs)
    first_id = log.claim_ids(max(1, len(specs)))
    timed = [(s.source_type, s.database, s.schema, s.table) for s in specs if s.ts_cols]
    watermarks = log.watermarks(pipeline_id, timed) if timed else {}

    def run(position: int, spec: TableSpec) -> RunResult:
        if not spec.keys:
            return RunResult(run_ts, load_type="", table=spec.name, error="no key columns given")
        paths = TablePaths(base, spec.database, spec.schema, spec.table, spec.target)
        run_id = first_id + position
        started = False
        load_type = ""
        try:
            source = project(read_source(spec), spec.columns)
            load_type = choose_load_type(spec.ts_cols, source.columns)
            log.start(
                clock(),
                RunId=run_id,
                PipelineRunId=pipeline_run,
                PipelineId=pipeline_id,
                PipelineName=pipeline_id,
                SourceType=spec.source_type,
                SourceDatabase=spec.database,
                SourceSchema=spec.schema,
                SourceTable=spec.table,
                LoadType=load_type,
                CloudLocation=paths.root,
            )
            started = True
            if load_type == TIMESTAMP:
                since = watermarks.get((spec.source_type, spec.database, spec.schema, spec.table), FIRST_WATERMARK)
                result = run_timestamp_cdc(
                    spark,
                    source,
                    spec.keys,
                    spec.ts_cols,
                    since,
                    paths,
                    run_ts,
                    spec.buckets or buckets,
                    spec.policy or policy,
                    spec.nulls,
                    spec.trust_timestamps,
                )
            else:
                result = run_snapshot_cdc(
                    spark,
                    source,
                    spec.keys,
                    paths,
                    run_ts,
                    spec.buckets or buckets,
                    spec.policy or policy,
                    spec.check_keys,
                    spec.stable_source,
                )
            result.table = spec.name
            log.end(
                run_id,
                clock(),
                SUCCESS,
                PipelineRunId=pipeline_run,
                RowsProcessed=result.written,
                LastRunTimestamp=result.watermark,
                ExtractStatus=SUCCESS,
                RawLoadStatus=SUCCESS,
                MergeStatus=SUCCESS,
                RowsExtracted=result.extracted,
                RowsWrittenToCloud=result.written,
                RowsMerged=result.merged,
                RowsDeleted=result.deleted,
            )
            return result
        except Exception as error:  # one table must not stop the others
            message = f"{type(error).__name__}: {error}".splitlines()[0]
            if started:
                log.end(run_id, clock(), FAILED, PipelineRunId=pipeline_run, ErrorMessage=message)
            return RunResult(run_ts, load_type=load_type, table=spec.name, error=message)

    with ThreadPoolExecutor(max_workers=max(1, at_once)) as pool:
        jobs = [pool.submit(run, i, s) for i, s in enumerate(specs)]
        return [job.result() for job in jobs]


def total_rows(results: Iterable[RunResult]) -> int:
    """Rows delivered over all tables."""
    return sum(r.written for r in results)
