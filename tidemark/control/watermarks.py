"""Keyed watermark store: one row per table."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.scalars import FIRST_WATERMARK, timestamp_literal
from tidemark.operators.merge import upsert
from tidemark.sinks.generations import CommitConflict, GenerationStore

# The columns of the watermark table.
WATERMARK_SCHEMA = T.StructType(
    [
        T.StructField("TableName", T.StringType()),
        T.StructField("LastRunTimestamp", T.TimestampNTZType()),
        T.StructField("Status", T.StringType()),
        T.StructField("LastRunLSN", T.StringType()),
        T.StructField("FullLoadDone", T.IntegerType()),
    ]
)


def upsert_watermarks(store: DataFrame, updates: DataFrame) -> DataFrame:
    """All five fields of the updated tables replaced, new tables added."""
    return upsert(store, updates.select(*store.columns), ["TableName"])


def watermark_or_default(store: DataFrame, tables: DataFrame, default: datetime | str = FIRST_WATERMARK) -> DataFrame:
    """``TableName, watermark`` for every asked table, ``default`` where none is stored."""
    wanted = tables.select("TableName").distinct()
    return wanted.join(store.select("TableName", "LastRunTimestamp"), "TableName", "left").select(
        "TableName",
        F.coalesce("LastRunTimestamp", timestamp_literal(default)).alias("watermark"),
    )


#: Generations that are kept, for readers that have just begun.
KEPT = 3


class WatermarkStore:
    """The watermark table at a path, replaced as a whole on every update (one row per table).

    Of two updates at once the later one begins again from the first, so neither is lost.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.store = GenerationStore(spark, path)

    def read(self) -> DataFrame:
        rows = self.store.read()
        return self.spark.createDataFrame([], WATERMARK_SCHEMA) if rows is None else rows

    def get(self, table: str, default: datetime = FIRST_WATERMARK) -> datetime:
        row = self.read().where(F.col("TableName") == table).select("LastRunTimestamp").first()
        return default if row is None or row[0] is None else row[0]

    def put(
        self,
        table: str,
        watermark: datetime,
        status: str,
        full_load_done: int = 1,
        last_run_lsn: str | None = None,
    ) -> None:
        update = self.spark.createDataFrame(
            [(table, watermark, status, last_run_lsn, full_load_done)], WATERMARK_SCHEMA
        )
        while True:
            base = self.store.current()
            rows = self.store.read(base)
            rows = self.spark.createDataFrame([], WATERMARK_SCHEMA) if rows is None else rows
            generation = self.store.next_generation(base or 0)
            self.store.write_live(upsert_watermarks(rows, update), generation, ["TableName"], 1)
            try:
                self.store.commit(generation, WATERMARK_SCHEMA, 1, [{"bucket": 0, "rows": None, "fingerprint": None}])
            except CommitConflict:  # another update came first: begin again from it, so that both are kept
                self.store.discard(generation)
                continue
            self.store.expire(KEPT)
            return
