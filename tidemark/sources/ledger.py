"""Which files have been loaded: a ledger for batch loads, and a report of files that gave no or too few rows."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.scalars import timestamp_literal
from tidemark.sources.files import file_counts
from tidemark.sources.tables import read_if_exists

# The mark at both ends of a Parquet file, and the bytes of a file that holds nothing but its footer
# besides the footer itself (both marks and the footer's length).
MARK = "PAR1"
FRAME_BYTES = 12
#: A file without a row is no larger; a larger one that gave no row is damaged, and its content is not looked at.
MOST_EMPTY_BYTES = 64 * 1024 * 1024

LEDGER_SCHEMA = T.StructType(
    [
        T.StructField("file", T.StringType()),
        T.StructField("size", T.LongType()),
        T.StructField("modified", T.LongType()),
        T.StructField("loaded_at", T.TimestampNTZType()),
    ]
)


def list_files(
    spark: SparkSession, directory: str | Sequence[str], pattern: str = "*.parquet", recursive: bool = True
) -> DataFrame:
    """``file, size, modified`` (microseconds since 1970) of all matching files below ``directory``; their content is not read."""
    paths = [directory] if isinstance(directory, str) else list(directory)
    listed = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", recursive)
        .load(paths)
    )
    return listed.select(
        F.col("path").alias("file"),
        F.col("length").alias("size"),
        F.unix_micros("modificationTime").alias("modified"),
    )


class FileLedger:
    """The files that earlier loads have taken, kept as a table at a path: each load adds its own.

    A file is known by path, size and time of change, so one that was replaced under its name is new.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")

    def read(self) -> DataFrame:
        """All entries; none before the first load."""
        if read_if_exists(self.spark, self.path) is None:
            return self.spark.createDataFrame([], LEDGER_SCHEMA)
        return self.spark.read.schema(LEDGER_SCHEMA).parquet(self.path)

    def new_files(self, listed: DataFrame) -> DataFrame:
        """Those of ``listed`` (see ``list_files``) that no load has taken."""
        known = self.read().select(*[F.col(c).alias(f"__{c}") for c in ("file", "size", "modified")])
        same = (F.col("file") == F.col("__file")) & (F.col("size") == F.col("__size")) & (F.col("modified") == F.col("__modified"))
        return listed.join(known, same, "left_anti")

    def add(self, files: DataFrame, loaded_at: datetime | str) -> None:
        """Note files as taken. Written after the load, so a load that dies takes its files again."""
        files.select("file", "size", "modified", timestamp_literal(loaded_at).alias("loaded_at")).coalesce(1).write.mode("append").parquet(self.path)


def skipped_files(
    spark: SparkSession,
    directory: str | Sequence[str],
    loaded: DataFrame,
    pattern: str = "*.parquet",
    file_column: str = "file_name",
    listed: DataFrame | None = None,
) -> DataFrame:
    """Files that a load with ``skip_corrupt`` left out or read in part: ``file, size, rows, want, reason``.

    Listed files are held against the rows of ``loaded`` by an anti-join. What gave no row is damaged, unless it is a
    whole Parquet file that holds nothing but its footer. A file with fewer rows than its footer tells of is read in
    part. Only files without rows are opened, and none of them beyond the size of an empty one. ``listed`` narrows the
    report to files that the load was to take; files without a byte, which no listing of rows shows, are always in it.
    """
    every = list_files(spark, directory, pattern)
    rows = _with_rows(every if listed is None else listed, loaded, file_column)
    unknown = F.lit(None).cast("long").alias("want")
    columns = ["file", "size", F.coalesce("rows", F.lit(0)).alias("rows")]
    silent = rows.where("rows is null")
    found = silent.where(F.col("size") > MOST_EMPTY_BYTES).select(*columns, unknown, F.lit("no rows").alias("reason"))
    small = silent.where(F.col("size") <= MOST_EMPTY_BYTES)
    paths = [r["file"] for r in small.select("file").collect()]  # names alone, as for any read
    if paths:
        content = spark.read.format("binaryFile").option("ignoreCorruptFiles", True).load(paths).select(F.col("path").alias("__path"), "content")
        mark = F.lit(bytearray(MARK.encode()))
        whole = (F.substring("content", 1, 4) == mark) & (F.substring("content", -4, 4) == mark)
        # the footer's length is the last number in front of the end mark
        empty = whole & (_little_endian(F.substring("content", -8, 4)) == F.length("content") - FRAME_BYTES)
        reason = F.when(~whole, "no whole Parquet file").otherwise("no rows could be read")
        looked = content.select("__path", F.coalesce(empty, F.lit(False)).alias("__empty"), reason.alias("__reason"))
        damaged = small.join(looked, _plain("file") == _plain("__path"), "left").where("not coalesce(__empty, false)")
        damaged = damaged.withColumn("reason", F.coalesce("__reason", F.lit("could not be read")))
        found = found.unionByName(damaged.select(*columns, unknown, "reason"))
    # a file without a byte is in the listing, but no task gets it
    reader = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", True)
    names = reader.load([directory] if isinstance(directory, str) else list(directory)).inputFiles()
    named = spark.createDataFrame([(n,) for n in names], "file string")
    there = every.select(F.col("file").alias("__path"))
    hollow = named.join(there, _plain("file") == _plain("__path"), "left_anti")
    zero = F.lit(0).cast("long")
    found = found.unionByName(hollow.select("file", zero.alias("size"), zero.alias("rows"), unknown, F.lit("no bytes").alias("reason")))
    return found.unionByName(_in_part(spark, directory, rows, pattern))


def _with_rows(listed: DataFrame, loaded: DataFrame, file_column: str) -> DataFrame:
    got = file_counts(loaded, file_column).withColumnRenamed("file", "__got")
    return listed.join(got, _plain("file") == _plain("__got"), "left").drop("__got", "modified")


def _little_endian(four: Column) -> Column:
    """The number in four bytes, the lowest first."""
    digits = F.hex(four)
    return F.conv(F.concat(*[F.substring(digits, k, 2) for k in (7, 5, 3, 1)]), 16, 10).cast("long")


def _plain(column: str) -> Column:
    """A path without the slashes by which writings of one place differ, decoded."""
    return F.regexp_replace(F.url_decode(F.replace(F.col(column), F.lit("+"), F.lit("%2B"))), "^([a-z0-9]+):/+", "$1:/")


def _in_part(spark: SparkSession, directory: str | Sequence[str], rows: DataFrame, pattern: str) -> DataFrame:
    """Files of which fewer rows came than their footers count; footers alone are read."""
    reader = spark.read.option("pathGlobFilter", pattern).option("recursiveFileLookup", True).option("ignoreCorruptFiles", True)
    footers = reader.schema("__none int").parquet(*([directory] if isinstance(directory, str) else directory))
    want = footers.groupBy(F.col("_metadata.file_path").alias("__path")).agg(F.count(F.lit(1)).alias("want"))
    short = rows.join(want, _plain("file") == _plain("__path")).where(F.col("rows") < F.col("want"))
    return short.select("file", "size", "rows", "want", F.lit("read in part").alias("reason"))
