"""Generations: visibility, retention, pruning."""

import os

import pytest
from pyspark.sql import functions as F

from tidemark.plans.load import bucket_rows
from tidemark.sinks.datasets import write_partitioned
from tidemark.sinks.generations import GenerationStore


def put(store, df, buckets=4, only=None):
    """Write and commit ``df``; ``only`` limits what is replaced to some buckets."""
    generation = store.next_generation()
    kept = [r for r in store.index() if only is not None and r.bucket not in only]
    store.write_live(df, generation, ["k"], buckets)
    written = bucket_rows(store.read_staged(generation, df.schema)).collect()
    store.commit(generation, df.schema, buckets, written, kept)
    return generation


def frame(spark, low, high, tag="a"):
    return spark.range(low, high).select(F.col("id").alias("k"), F.lit(tag).alias("v"))


@pytest.fixture
def store(spark, tmp_path):
    return GenerationStore(spark, str(tmp_path))


def test_nothing_to_read_before_the_first_commit(spark, store):
    assert store.current() is None and store.read() is None and store.index() == []
    store.write_live(frame(spark, 0, 10), 1, ["k"], 4)
    assert store.read() is None
    assert store.next_generation() == 2


def test_every_generation_stays_readable(spark, store, rows):
    put(store, frame(spark, 0, 10))
    put(store, frame(spark, 5, 20, "b"))
    assert store.generations() == [1, 2]
    assert rows(store.read(1)) == rows(frame(spark, 0, 10))
    assert rows(store.read()) == rows(frame(spark, 5, 20, "b"))


def test_unfinished_index_is_ignored(spark, store, rows, tmp_path):
    put(store, frame(spark, 0, 10))
    store.write_live(frame(spark, 0, 99), 2, ["k"], 4)
    (tmp_path / "index" / "generation=2").mkdir()
    (tmp_path / "index" / "generation=2" / "part-0.parquet").write_bytes(b"half")
    assert store.current() == 1
    assert rows(store.read()) == rows(frame(spark, 0, 10))
    assert store.next_generation() == 3


def test_committing_twice_is_refused(spark, store):
    generation = put(store, frame(spark, 0, 10))
    with pytest.raises(ValueError):
        store.commit(generation, frame(spark, 0, 1).schema, 4, [])
    with pytest.raises(ValueError):
        store.discard(generation)


def test_kept_buckets_are_shared(spark, store, rows):
    put(store, frame(spark, 0, 100))
    bucket = store.read(keep_bucket=True).where("k = 7").first().bucket
    part = store.read(keep_bucket=True).where(F.col("bucket") == bucket).drop("bucket").withColumn("v", F.lit("new"))
    put(store, part, only={bucket})
    assert {r.data_generation for r in store.index()} == {1, 2}
    got = store.read()
    assert got.count() == 100
    assert got.where("v = 'new'").count() == part.count()


def test_reading_buckets_opens_only_their_directories(spark, store):
    put(store, frame(spark, 0, 100))
    files = store.read(buckets=[1, 3]).inputFiles()
    assert files and all("bucket=1/" in f or "bucket=3/" in f for f in files)


def test_empty_table(spark, store):
    put(store, frame(spark, 0, 10))
    put(store, frame(spark, 0, 0))
    assert store.read().count() == 0
    assert store.read().columns == ["k", "v"]


def test_added_column_is_null_in_kept_buckets(spark, store):
    put(store, frame(spark, 0, 100))
    only = {0}
    part = store.read(buckets=only).withColumn("w", F.lit(1))
    put(store, part, only=only)
    got = store.read()
    assert got.columns == ["k", "v", "w"]
    assert got.where("w is null").count() == 100 - part.count()


def test_expire_drops_unused_directories_only(spark, store, rows, tmp_path):
    put(store, frame(spark, 0, 100))
    part = store.read(buckets=[2]).withColumn("v", F.lit("new"))
    put(store, part, only={2})
    store.write_live(frame(spark, 0, 5), 3, ["k"], 4)
    put(store, store.read(buckets=[3]), only={3})
    before = rows(store.read())
    assert store.expire(1) == [1, 2]
    assert store.generations() == [4]
    assert rows(store.read()) == before
    assert sorted(os.listdir(tmp_path / "live")) == ["generation=1", "generation=2", "generation=4"]
    left = [d for d in os.listdir(tmp_path / "live" / "generation=1") if d.startswith("bucket=")]
    assert sorted(left) == ["bucket=0", "bucket=1"]
    with pytest.raises(ValueError):
        store.expire(0)


def test_history_belongs_to_its_generation(spark, store, rows):
    put(store, frame(spark, 0, 10))
    generation = store.next_generation()
    store.write_history(frame(spark, 0, 3).withColumn("change_kind", F.lit("D")), generation)
    assert store.read_history() is None
    store.write_live(frame(spark, 3, 10), generation, ["k"], 4)
    written = bucket_rows(store.read_staged(generation, frame(spark, 0, 1).schema)).collect()
    store.commit(generation, frame(spark, 0, 1).schema, 4, written)
    assert store.read_snapshot(1).where("soft_delete = 1").count() == 0
    assert rows(store.read_snapshot(2).where("soft_delete = 1"), "k") == [(0,), (1,), (2,)]


def test_hot_bucket_is_split_over_files(spark, tmp_path):
    """One value with most rows is written by several tasks, not one."""
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64KB")
    try:
        df = spark.range(0, 200_000, numPartitions=8).select(
            F.when(F.rand(3) < 0.9, 0).otherwise((F.col("id") % 5).cast("int")).alias("b"),
            F.sha2(F.col("id").cast("string"), 256).alias("v"),
        )
        write_partitioned(df, str(tmp_path / "out"), "b")
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert len([f for f in os.listdir(tmp_path / "out" / "b=0") if f.endswith(".parquet")]) > 1
    assert spark.read.parquet(str(tmp_path / "out")).count() == 200_000
