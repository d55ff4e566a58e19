"""Run log: one start and one end event per table run, kept as a Parquet table.

The log is append-only. The state of a run is its newest event, a pipeline
run's status is aggregated from its table runs, and the watermark of a table
is looked up from its last successful run.
"""

from __future__ import annotations

import threading
from collections.abc import Sequence
from datetime import datetime
from urllib.parse import quote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.scalars import (
    FIRST_WATERMARK,
    LOOKBACK_MINUTES,
    OPEN_END,
    duration_seconds,
    look_back,
    timestamp_literal,
)
from tidemark.operators.merge import latest_per_key
from tidemark.sources.storage import children, create_new, delete
from tidemark.sources.tables import read_if_exists

# The columns of the run log and the status words.
RUN_LOG_SCHEMA = T.StructType(
    [
        T.StructField(name, dtype)
        for name, dtype in (
            ("RunId", T.LongType()),
            ("PipelineRunId", T.StringType()),
            ("PipelineId", T.StringType()),
            ("PipelineName", T.StringType()),
            ("SourceType", T.StringType()),
            ("SourceDatabase", T.StringType()),
            ("SourceSchema", T.StringType()),
            ("SourceTable", T.StringType()),
            ("LoadType", T.StringType()),
            ("Status", T.StringType()),
            ("StartTime", T.TimestampNTZType()),
            ("EndTime", T.TimestampNTZType()),
            ("DurationSeconds", T.LongType()),
            ("RowsProcessed", T.LongType()),
            ("LastRunTimestamp", T.TimestampNTZType()),
            ("Cloud", T.StringType()),
            ("CloudLocation", T.StringType()),
            ("ErrorMessage", T.StringType()),
            ("ExtractStatus", T.StringType()),
            ("RawLoadStatus", T.StringType()),
            ("MergeStatus", T.StringType()),
            ("TableRunStatus", T.StringType()),
            ("PipelineRunStatus", T.StringType()),
            ("RowsExtracted", T.LongType()),
            ("RowsWrittenToCloud", T.LongType()),
            ("RowsMerged", T.LongType()),
            ("RowsDeleted", T.LongType()),
        )
    ]
)
STARTED, RUNNING, SUCCESS, FAILED = "STARTED", "RUNNING", "SUCCESS", "FAILED"
TABLE_COLUMNS = ("PipelineId", "SourceType", "SourceDatabase", "SourceSchema", "SourceTable")

_append_lock = threading.Lock()


def start_values(started: Column) -> dict[str, Column]:
    """Log columns of a run that has just started."""
    zero = F.lit(0).cast("bigint")
    return {
        "Status": F.lit(STARTED),
        "StartTime": started,
        "ExtractStatus": F.lit(STARTED),
        "RawLoadStatus": F.lit(STARTED),
        "MergeStatus": F.lit(STARTED),
        "TableRunStatus": F.lit(STARTED),
        "PipelineRunStatus": F.lit(RUNNING),
        "RowsExtracted": zero,
        "RowsWrittenToCloud": zero,
        "RowsMerged": zero,
        "RowsDeleted": zero,
    }


def log_start(runs: DataFrame, started: Column) -> DataFrame:
    """Start events for ``runs`` (id, names, load type, location); other columns are NULL."""
    return _conform(runs.withColumns(start_values(started)))


def log_end(started: DataFrame, ends: DataFrame) -> DataFrame:
    """End events: start events joined with ``ends`` by ``RunId``, and by ``PipelineRunId`` if ``ends`` has it.

    ``ends`` gives ``Status`` and ``EndTime`` and optionally the other result
    columns. Counters left NULL default to ``RowsProcessed`` (0 if NULL too),
    ``RowsDeleted`` to 0.
    """
    given = {c.lower(): c for c in ends.columns}

    def end(name: str) -> Column:
        return F.col(f"e.{given[name.lower()]}") if name.lower() in given else F.lit(None)

    processed = F.coalesce(end("RowsProcessed"), F.lit(0)).cast("bigint")
    results = {
        "Status": end("Status"),
        "EndTime": end("EndTime"),
        "DurationSeconds": duration_seconds(F.col("s.StartTime"), end("EndTime")),
        "RowsProcessed": processed,
        "LastRunTimestamp": end("LastRunTimestamp"),
        "ErrorMessage": end("ErrorMessage"),
        "ExtractStatus": end("ExtractStatus"),
        "RawLoadStatus": end("RawLoadStatus"),
        "MergeStatus": end("MergeStatus"),
        "TableRunStatus": end("Status"),
        "RowsExtracted": F.coalesce(end("RowsExtracted"), processed),
        "RowsWrittenToCloud": F.coalesce(end("RowsWrittenToCloud"), processed),
        "RowsMerged": F.coalesce(end("RowsMerged"), processed),
        "RowsDeleted": F.coalesce(end("RowsDeleted"), F.lit(0)),
    }
    same = F.col("s.RunId") == F.col("e.RunId")
    if "pipelinerunid" in given:
        same = same & F.col("s.PipelineRunId").eqNullSafe(end("PipelineRunId"))
    joined = started.alias("s").join(ends.alias("e"), same)
    return joined.select(
        *[results.get(f.name, F.col(f"s.{f.name}")).cast(f.dataType).alias(f.name) for f in RUN_LOG_SCHEMA]
    )


def _conform(df: DataFrame) -> DataFrame:
    have = set(df.columns)
    return df.select(
        *[
            (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in RUN_LOG_SCHEMA
        ]
    )


def run_state(log: DataFrame) -> DataFrame:
    """The newest event of every run: the finished one if there is one.

    A run is named by its pipeline run and its id, so pipelines that number their runs alike keep all of them.
    """
    return latest_per_key(log, ["PipelineRunId", "RunId"], ["EndTime", "StartTime"])


def rollup_status(state: DataFrame) -> DataFrame:
    """Per pipeline run FAILED if any table run ended otherwise than in SUCCESS (NULL does not count)."""
    failed = F.max(F.when(F.col("TableRunStatus") != SUCCESS, 1).otherwise(0))
    status = F.when(failed == 1, FAILED).otherwise(SUCCESS)
    return state.groupBy("PipelineRunId").agg(status.alias("PipelineRunStatus"))


def with_rollup(state: DataFrame) -> DataFrame:
    """Run states with the status of their pipeline run filled in."""
    status = rollup_status(state).withColumnRenamed("PipelineRunStatus", "__status")
    keep = [c for c in state.columns if c != "PipelineRunStatus"]
    return state.join(status, "PipelineRunId", "left").select(
        *keep, F.col("__status").alias("PipelineRunStatus")
    ).select(*state.columns)


def run_summary(state: DataFrame) -> DataFrame:
    """Per pipeline run: tables, failed tables and total rows processed."""
    return state.groupBy("PipelineRunId").agg(
        F.count(F.lit(1)).alias("tables"),
        F.count(F.when(F.col("TableRunStatus") != SUCCESS, 1)).alias("failed"),
        F.coalesce(F.sum("RowsProcessed"), F.lit(0)).alias("total_rows"),
    )


def next_run_id(log: DataFrame) -> DataFrame:
    """One row ``next_id``: highest run id plus one, 1 for an empty log."""
    return log.agg((F.coalesce(F.max("RunId"), F.lit(0)) + 1).alias("next_id"))


def latest_run(log: DataFrame) -> DataFrame:
    """The run started last (one row; ties go to the higher id)."""
    return log.orderBy(F.desc("StartTime"), F.desc("RunId")).limit(1)


def _usable() -> Column:
    return (
        (F.col("LoadType") == "TIMESTAMP")
        & (F.col("Status") == SUCCESS)
        & F.col("LastRunTimestamp").isNotNull()
    )


def last_watermarks(log: DataFrame, default: datetime | str = FIRST_WATERMARK) -> DataFrame:
    """Per table the watermark of its last successful timestamp run, else ``default``."""
    order = F.struct("EndTime", "RunId")
    latest = F.max_by(F.when(_usable(), F.col("LastRunTimestamp")), F.when(_usable(), order))
    return log.groupBy(*TABLE_COLUMNS).agg(
        F.coalesce(latest, timestamp_literal(default)).alias("watermark")
    )


def last_watermark(
    log: DataFrame | None,
    pipeline_id: str,
    source_type: str,
    database: str,
    schema: str,
    table: str,
    default: datetime = FIRST_WATERMARK,
) -> datetime:
    """The watermark of one table."""
    if log is None:
        return default
    names = dict(zip(TABLE_COLUMNS, (pipeline_id, source_type, database, schema, table)))
    runs = log.where(_usable())
    for column, value in names.items():
        runs = runs.where(F.col(column) == value)
    row = runs.orderBy(F.desc_nulls_last("EndTime"), F.desc("RunId")).select("LastRunTimestamp").limit(1).first()
    return default if row is None else row["LastRunTimestamp"]


def control_view(state: DataFrame) -> DataFrame:
    """The run log under the 18 column names of the older control table."""
    # The names of that table's columns.
    text = F.lit(None).cast("string")
    return state.select(
        F.col("RunId").alias("RUN_ID"),
        F.col("StartTime").alias("RUN_START"),
        F.col("EndTime").alias("RUN_END"),
        F.col("DurationSeconds").cast("double").alias("DURATION_IN_SEC"),
        F.col("SourceDatabase").alias("SOURCE_DATABASE_NAME"),
        F.col("SourceSchema").alias("SOURCE_SCHEMA_NAME"),
        F.col("SourceTable").alias("SOURCE_OBJECT_NAME"),
        text.alias("TARGET_DATABASE_NAME"),
        text.alias("TARGET_SCHEMA_NAME"),
        F.col("SourceTable").alias("TARGET_TABLE_NAME"),
        F.col("PipelineName").alias("TRIGGERED_BY"),
        F.col("Status").alias("STATUS"),
        F.col("ErrorMessage").alias("ERROR_MESSAGE"),
        F.col("RowsProcessed").alias("ROWS_INSERTED"),
        F.lit(None).cast("bigint").alias("ROWS_UPDATED"),
        F.col("LastRunTimestamp").alias("MAX_TIMESTAMP"),
        F.col("StartTime").alias("CREATED_TIMESTAMP"),
        F.col("PipelineId").alias("CREATED_BY"),
    )


def lookback_watermarks(control: DataFrame, minutes: int = LOOKBACK_MINUTES) -> DataFrame:
    """Per source table the latest successful run's timestamp, moved back ``minutes``.

    Runs without rows and those with the open-ended time marker do not count;
    tables without any such run are absent.
    """
    usable = control.where(
        (F.col("STATUS") == SUCCESS)
        & (F.col("MAX_TIMESTAMP") != timestamp_literal(OPEN_END))
        & (F.col("ROWS_INSERTED") != 0)
    )
    latest = usable.groupBy("SOURCE_OBJECT_NAME").agg(F.max_by("MAX_TIMESTAMP", "RUN_ID").alias("MAX_TIMESTAMP"))
    return latest.select("SOURCE_OBJECT_NAME", look_back(F.col("MAX_TIMESTAMP"), minutes).alias("watermark"))


class RunLog:
    """The run log at a path.

    ``started/run=R`` holds the start events of a pipeline run, ``ended/pipeline=P/day=D`` the end events of a pipeline by
    the day they ended on, so looking up a run or a pipeline's last watermarks reads the files concerned and not
    the whole log. ``ids/upto=N`` tells the highest id given out.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")

    def read(self) -> DataFrame | None:
        """All events, or None before the first."""
        if not set(children(self.spark, self.path)) - {"ids"}:
            return None
        return (
            self.spark.read.schema(RUN_LOG_SCHEMA)
            .option("recursiveFileLookup", True)
            .option("pathGlobFilter", "*.parquet")
            .parquet(self.path)
        )

    def ensure(self) -> None:
        """Create the empty log if there is none."""
        if self.read() is None:
            self._append(self.spark.createDataFrame([], RUN_LOG_SCHEMA), "empty")

    def state(self) -> DataFrame:
        """State of every run with its pipeline run's status."""
        self.ensure()
        return with_rollup(run_state(self.read()))

    def next_id(self) -> int:
        """The id after the last one given out. One listing; a log without a mark is read."""
        return self._last_id()[0] + 1

    def claim_ids(self, many: int) -> int:
        """The first of ``many`` ids that no other run gets."""
        last, marks = self._last_id()
        while not create_new(self.spark, f"{self.path}/ids/upto={last + many}"):
            last += many  # another writer has taken these
        for n in marks:
            if n < last:  # the newest but one stays, for writers that have listed it
                delete(self.spark, f"{self.path}/ids/upto={n}")
        return last + 1

    def _last_id(self) -> tuple[int, list[int]]:
        marks = [int(n.split("=", 1)[1]) for n in children(self.spark, f"{self.path}/ids") if n.startswith("upto=")]
        if marks:
            return max(marks), marks
        log = self.read()
        return (0 if log is None else next_run_id(log).first()["next_id"] - 1), marks

    def watermarks(self, pipeline_id: str, tables: Sequence[tuple[str, str, str, str]]) -> dict[tuple[str, str, str, str], datetime]:
        """The watermark of the last successful timestamp run of each of a pipeline's ``tables`` (type, database, schema,
        name); those without one are missing.

        Days are read from the newest backwards, twice as many each time, until all tables are found.
        """
        place = f"{self.path}/ended/pipeline={_name(pipeline_id)}"
        days = [n for n in reversed(children(self.spark, place)) if n.startswith("day=")]
        wanted, found = set(tables), {}
        start, many = 0, 1
        while wanted and start < len(days):
            paths = [f"{place}/{d}" for d in days[start : start + many]]
            runs = self.spark.read.schema(RUN_LOG_SCHEMA).parquet(*paths).where(_usable())
            rows = runs.groupBy(*TABLE_COLUMNS[1:]).agg(F.max_by("LastRunTimestamp", F.struct("EndTime", "RunId")).alias("at")).collect()
            for r in rows:
                name = tuple(r)[:4]
                if name in wanted:
                    found[name] = r["at"]
                    wanted.remove(name)
            start, many = start + many, 2 * many
        return found

    def start(self, started: datetime | str, **columns: object) -> None:
        """Log the start of one table run."""
        events = log_start(self._row(columns), timestamp_literal(started))
        self._append(events, f"started/run={_name(columns['PipelineRunId'])}")

    def end(self, run_id: int, ended: datetime | str, status: str, **columns: object) -> None:
        """Log the end of a table run started before.

        With its ``PipelineRunId`` only the events of that pipeline run are read, else the whole log.
        """
        pipeline_run = columns.get("PipelineRunId")
        log = self.read() if pipeline_run is None else self._events(str(pipeline_run))
        started = log.where((F.col("RunId") == run_id) & F.col("EndTime").isNull())
        ends = self._row({"RunId": run_id, "Status": status, **columns}).withColumn(
            "EndTime", timestamp_literal(ended)
        )
        events = self.spark.createDataFrame(log_end(started, ends).collect(), RUN_LOG_SCHEMA)
        row = events.first()
        if row is None:
            raise ValueError(f"run {run_id} was never started")
        self._append(events, f"ended/pipeline={_name(row['PipelineId'])}/day={row['EndTime']:%Y-%m-%d}")

    def _events(self, pipeline_run: str) -> DataFrame:
        path = f"{self.path}/started/run={_name(pipeline_run)}"
        found = read_if_exists(self.spark, path)
        return self.spark.createDataFrame([], RUN_LOG_SCHEMA) if found is None else self.spark.read.schema(RUN_LOG_SCHEMA).parquet(path)

    def _row(self, columns: dict[str, object]) -> DataFrame:
        fields = [f for f in RUN_LOG_SCHEMA if f.name in columns]
        unknown = set(columns) - {f.name for f in fields}
        if unknown:
            raise ValueError(f"not run log columns: {sorted(unknown)}")
        return self.spark.createDataFrame([tuple(columns[f.name] for f in fields)], T.StructType(fields))

    def _append(self, events: DataFrame, place: str) -> None:
        # Two appends into one directory at a time would disturb each other's commit.
        with _append_lock:
            events.coalesce(1).write.mode("append").parquet(f"{self.path}/{place}")


def _name(text: object) -> str:
    """A value as a part of a path."""
    return quote(str(text), safe="")
