"""Load-once pick-up of arriving Parquet files, and merging them continuously."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.merge import RESURRECT, MergePolicy
from tidemark.plans.load import merge_into
from tidemark.sinks.generations import GenerationStore


def ingest_stream(
    spark: SparkSession,
    directory: str,
    schema: T.StructType,
    pattern: str = "*.parquet",
    files_per_batch: int | None = None,
    skip_corrupt: bool = False,
) -> DataFrame:
    """A stream of the rows of new files below ``directory``; each file is read once per checkpoint."""
    reader = (
        spark.readStream.schema(schema)
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", True)
    )
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    if skip_corrupt:
        reader = reader.option("ignoreCorruptFiles", True)
    return reader.parquet(directory)


def land_stream(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append all files not yet taken to a landing table, then stop."""
    return (
        stream.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )


def stream_merge(
    stream: DataFrame,
    store: GenerationStore,
    keys: Sequence[str],
    checkpoint: str,
    policy: MergePolicy = RESURRECT,
    run_ts: datetime | str | None = None,
    buckets: int | None = None,
    interval: str | None = None,
) -> StreamingQuery:
    """Merge every micro-batch of arriving delta rows into the target.

    The number of the batch is committed with the target's generation, under
    the query's id, so a batch redelivered after a failure is not merged
    twice, while a query with a new checkpoint starts afresh. Without ``interval`` the
    query takes what is there and stops. Without ``run_ts`` rows are stamped
    with the latest load time of their batch. A batch is read once, to write the
    latest row of each key. With a policy that has an ``order``, files may arrive in
    any order; ``read_target`` gives the target.
    """

    def merge(batch: DataFrame, batch_id: int) -> None:
        stream_id = store.spark.sparkContext.getLocalProperty("sql.streaming.queryId")
        merge_into(store, batch, keys, policy, run_ts, buckets, (stream_id or checkpoint, batch_id))

    writer = stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
    if interval is None:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=interval).start()
