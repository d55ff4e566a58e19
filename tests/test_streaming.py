"""Load-once pick-up and continuous merging."""

from datetime import datetime

from tidemark.plans.load import merge_into
from tidemark.sinks.generations import GenerationStore
from tidemark.streaming.files import ingest_stream, land_stream, stream_merge

DELTA = "k int, v string, soft_delete int, load_ts timestamp_ntz"


def loads(spark):
    day = [datetime(2024, 1, d) for d in (1, 2, 3)]
    return [
        spark.createDataFrame([(1, "a", 0, day[0]), (2, "b", 0, day[0])], DELTA),
        spark.createDataFrame([(1, "A", 0, day[1]), (2, "b", 1, day[1])], DELTA),
        spark.createDataFrame([(3, "c", 0, day[2]), (2, "B", 0, day[2])], DELTA),
    ]


def test_each_file_is_taken_once(spark, tmp_path, rows):
    base = str(tmp_path)
    counts = []
    for number, load in enumerate(loads(spark)):
        load.coalesce(1).write.parquet(f"{base}/in/{number}")
        for _ in range(2):
            stream = ingest_stream(spark, f"{base}/in", load.schema)
            land_stream(stream, f"{base}/landed", f"{base}/check").awaitTermination()
            counts.append(spark.read.parquet(f"{base}/landed").count())
    assert counts == [2, 2, 4, 4, 6, 6]


def test_stream_equals_batch(spark, tmp_path, rows):
    base = str(tmp_path)
    streamed, batched = GenerationStore(spark, f"{base}/s"), GenerationStore(spark, f"{base}/b")
    for number, load in enumerate(loads(spark)):
        load.coalesce(1).write.parquet(f"{base}/in/{number}")
        stream = ingest_stream(spark, f"{base}/in", load.schema)
        stream_merge(stream, streamed, ["k"], f"{base}/check", buckets=2).awaitTermination()
        merge_into(batched, load, ["k"], run_ts=load.first().load_ts, buckets=2)
    assert rows(streamed.read()) == rows(batched.read())
    assert streamed.generations() == [1, 2, 3]


def test_redelivered_batch_is_ignored_but_a_new_checkpoint_is_not(spark, tmp_path, monkeypatch):
    base = str(tmp_path)
    store = GenerationStore(spark, f"{base}/target")
    load = loads(spark)[0]
    load.coalesce(1).write.parquet(f"{base}/in/0")

    def run(checkpoint):
        stream_merge(ingest_stream(spark, f"{base}/in", load.schema), store, ["k"], checkpoint, buckets=2).awaitTermination()

    run(f"{base}/one")
    # Forget that batch 0 was finished, as if the driver had died right after the merge.
    import os

    for name in os.listdir(f"{base}/one/commits"):
        os.remove(f"{base}/one/commits/{name}")
    run(f"{base}/one")
    assert store.generations() == [1]
    run(f"{base}/two")
    assert store.generations() == [1, 2]
