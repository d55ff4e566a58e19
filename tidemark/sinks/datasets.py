"""Delta and landing-table writes."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.columns import BUCKET, quoted

# A written table up to this size in memory is broadcast; beyond it, joins shuffle.
BROADCAST_BYTES = 32 * 1024 * 1024
# What a task scans at most, and at least where there are cores to spare (Spark's defaults), and what has to be in each
# file of a table whose rows are not shuffled for the write.
SCAN_BYTES = 128 * 1024 * 1024
LEAST_SCAN_BYTES = 4 * 1024 * 1024
SCATTERED_BYTES = 1024 * 1024


def rebalanced(df: DataFrame, *columns: str) -> DataFrame:
    """Even out write tasks: rows of one column value go together, but a hot
    value is split over several tasks and small ones are packed (adaptive
    execution does both by measured size)."""
    return df.hint("rebalance", *columns)


def scatters(df: DataFrame, buckets: int, least: int = SCATTERED_BYTES) -> bool:
    """Whether a table is so large for its buckets that each task can write files of its own for all of them.

    That spares the shuffle of the full rows. By Spark's estimate of the rows' bytes and of the tasks that read them a
    file has to get ``least`` bytes; where the estimate is unknown, as with a database, the rows are shuffled.
    """
    spark = df.sparkSession
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    if size >= int(spark._jsparkSession.sessionState().conf().defaultSizeInBytes()):
        return False
    tasks = max(size // SCAN_BYTES, min(spark.sparkContext.defaultParallelism, size // LEAST_SCAN_BYTES), 1)
    return size >= least * tasks * buckets


def write_partitioned(df: DataFrame, path: str, column: str, mode: str = "overwrite") -> None:
    """Parquet partitioned by ``column``, without a file per task and value."""
    rebalanced(df, column).write.mode(mode).partitionBy(column).parquet(path)


def stored_bytes(spark: SparkSession, path: str) -> int:
    """Size of all files below a path."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = place.getFileSystem(spark._jsc.hadoopConfiguration())
    return files.getContentSummary(place).getLength()


def row_bytes(df: DataFrame) -> int:
    """What the rows take in memory, however well their files are compressed: 16 bytes and 16 for each column of
    each row, and the bytes of all values of varying length."""
    varying = [
        F.coalesce(F.octet_length(quoted(f.name) if isinstance(f.dataType, (T.StringType, T.BinaryType)) else F.to_json(F.struct(quoted(f.name)))), F.lit(0))
        for f in df.schema.fields
        if isinstance(f.dataType, (T.StringType, T.BinaryType, T.ArrayType, T.MapType, T.StructType, T.VariantType))
    ]
    lengths = F.sum(reduce(add, varying)) if varying else F.lit(0)
    row = df.agg(F.count(F.lit(1)).alias("rows"), lengths.cast("long").alias("bytes")).first()
    return row["rows"] * 16 * (1 + len(df.columns)) + (row["bytes"] or 0)


def fits_broadcast(df: DataFrame, paths: Sequence[str], most: int = BROADCAST_BYTES) -> bool:
    """Whether the rows of a written table are few and short enough to be broadcast.

    Files over the limit settle it; else the rows are measured, which reads no more than the limit.
    """
    spark = df.sparkSession
    return sum(stored_bytes(spark, p) for p in paths) <= most and row_bytes(df) <= most


def write_delta(df: DataFrame, run_dir: str, scattered: bool = False) -> None:
    """The delta of one run; a repeated run replaces its own directory. ``scattered`` writes it where its rows are."""
    if scattered:
        df.write.mode("overwrite").partitionBy(BUCKET).parquet(run_dir)
    elif BUCKET in df.columns:
        write_partitioned(df, run_dir, BUCKET)
    else:
        df.write.mode("overwrite").parquet(run_dir)


def write_and_read(df: DataFrame, path: str) -> DataFrame:
    """Cut lineage: write ``df`` and read it back, now with known size."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def append_raw(df: DataFrame, path: str, run: str | None = None) -> int:
    """Append rows to a landing table; ``run`` gives them a directory of their own.

    Returns the rows written, which the write itself counts.
    """
    written = Observation()
    counted = df.observe(written, F.count(F.lit(1)).alias("rows"))
    if run is None:
        counted.write.mode("append").parquet(path)
    else:
        counted.write.mode("overwrite").parquet(f"{path}/run={run}")
    return written.get["rows"]


def read_raw(spark: SparkSession, path: str, runs: Sequence[str] | None = None) -> DataFrame:
    """A landing table, or only the given runs of it."""
    if runs is None:
        return spark.read.parquet(path)
    return spark.read.option("basePath", path).parquet(*[f"{path}/run={r}" for r in runs])


def consume_raw(spark: SparkSession, path: str) -> None:
    """Empty a landing table, keeping its schema."""
    schema = spark.read.parquet(path).schema
    spark.createDataFrame([], schema).write.mode("overwrite").parquet(path)
