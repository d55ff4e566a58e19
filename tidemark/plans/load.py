"""Loading deltas into a target table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.columns import BUCKET, FRAMEWORK_COLUMNS, HASH, drop_columns
from tidemark.functions.hashing import bucket_count_of, hash_bucket, same_bucket
from tidemark.functions.scalars import timestamp_literal
from tidemark.operators.drift import add_columns, cast_up, common_schema, drop_column, schema_drift, widening
from tidemark.operators.merge import LOAD_TS, RESURRECT, MergePolicy, empty_target, latest_per_key, merge_delta, merge_parts, without_state
from tidemark.sinks.datasets import (
    BROADCAST_BYTES,
    append_raw,
    consume_raw,
    fits_broadcast,
    read_raw,
    stored_bytes,
    write_and_read,
)
from tidemark.sinks.generations import GenerationStore, last_batches
from tidemark.sources.files import EmptyLoad, file_counts, ingest_files, validate_load
from tidemark.sources.ledger import FileLedger, list_files, skipped_files
from tidemark.sources.paths import run_name


def bucket_rows(df: DataFrame) -> DataFrame:
    """Rows per bucket, in the form an index keeps them, without fingerprints."""
    return df.groupBy(BUCKET).agg(
        F.count(F.lit(1)).alias("rows"), F.lit(None).cast("decimal(38,0)").alias("fingerprint")
    )


def assert_target_takes(store: GenerationStore, rows: DataFrame) -> None:
    """Raise if a stored target has a column that cannot hold both its own values and those of ``rows`` without loss."""
    stored = store.schema()
    if stored is not None:
        common_schema(stored, drop_columns(rows, *FRAMEWORK_COLUMNS).schema)


def merge_into(
    store: GenerationStore,
    delta: DataFrame,
    keys: Sequence[str],
    policy: MergePolicy = RESURRECT,
    run_ts: datetime | str | None = "1970-01-01",
    buckets: int | None = None,
    batch: tuple[str, int] | None = None,
    landed: str | None = None,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> int | None:
    """Merge a delta into a stored target; returns the new generation, or None if nothing was done.

    Only the buckets that hold keys of the delta are read and rewritten; the
    others are carried over by reference. ``batch`` names a stream and its
    batch number: a batch not above the last one merged from that stream is
    ignored, which makes redelivery harmless. New source columns are added to
    the target, and a column of another type is widened to one that holds old and
    new values, or the merge is refused before anything is written. Buckets that
    the delta does not touch are widened as they are read.

    The latest row per key is written beside the target first, unless the
    delta already lies at the path ``landed`` with one row per key. Its size
    decides how to merge: up to ``broadcast_bytes`` it is broadcast, and the
    target's rows are rewritten by the tasks that scan them, without a
    shuffle. Beyond that, or once a target has gathered too many small files,
    rows are joined by shuffle or at least written anew by bucket. ``run_ts`` None
    stamps rows with the latest load time of the delta.
    """
    base = store.current()
    index = store.index(base)
    batches = last_batches(index)
    if batch is not None:
        stream, number = batch
        if batches.get(stream, -1) >= number:
            return None
        batches = {**batches, stream: number}

    delta = delta.drop(HASH, BUCKET)
    rebucketed = False
    if index:
        wider = widening(store.schema(base), drop_columns(delta, *FRAMEWORK_COLUMNS).schema, keys, same_bucket)
        delta, rebucketed = cast_up(delta, wider.schema), wider.rebucketed
    generation = store.next_generation(base or 0)
    if landed is not None:
        newest = delta
    else:
        landed = store.work(generation, "latest")
        newest = write_and_read(latest_per_key(delta, keys, [policy.order or LOAD_TS]), landed)
    if index:
        buckets = index[0].buckets
    elif buckets is None:
        buckets = bucket_count_of(stored_bytes(store.spark, landed))
    newest = hash_bucket(newest, keys, buckets)
    # At most one row per bucket comes back.
    touched = [r[BUCKET] for r in newest.select(BUCKET).distinct().collect()]
    if not touched:
        store.discard(generation)
        return None
    newest = newest.drop(BUCKET)
    if run_ts is None:  # the latest row of each key has the latest load time of all
        run_ts = newest.agg(F.max(LOAD_TS).alias("t")).first()["t"]
    if rebucketed:  # keys of another type lie in other buckets: all rows are dealt anew
        touched = [r.bucket for r in index]

    target = store.read(base, touched, keep_bucket=True) if index else None
    small = fits_broadcast(newest, [landed], broadcast_bytes)
    in_place = target is not None and small and not rebucketed and not store.is_fragmented(target)
    if target is None:
        target = empty_target(newest, policy)
    else:
        target = add_columns(target, schema_drift(newest, target).added)
    if small:
        kept, added = merge_parts(target, newest, keys, policy, run_ts, deduplicated=True, small=True)
        merged = kept.drop(BUCKET).unionByName(added.drop(BUCKET))
    else:
        merged = merge_delta(target.drop(BUCKET), newest, keys, policy, run_ts, deduplicated=True)
    if in_place:
        store.write_in_place(kept, added, generation, keys, buckets)
    else:
        store.write_live(merged, generation, keys, buckets, gather=True)
    schema = merged.schema
    written = bucket_rows(store.read_staged(generation, schema)).collect()
    others = [r for r in index if r.bucket not in set(touched)]
    store.commit(generation, schema, buckets, written, others, batches)
    return generation


def read_target(store: GenerationStore, generation: int | None = None) -> DataFrame | None:
    """A stored target without the state that an order-safe policy keeps in it."""
    rows = store.read(generation)
    return None if rows is None else without_state(rows)


def alter_target(
    store: GenerationStore,
    keys: Sequence[str],
    add: Mapping[str, T.DataType] | None = None,
    drop: Sequence[str] = (),
) -> int:
    """Commit a generation with columns added or dropped.

    Adding touches no data. Dropping rewrites the table, so that a column of
    the same name can come back later without its old values.
    """
    base = store.current()
    index = store.index(base)
    rows = store.read(base, keep_bucket=True)
    if rows is None:
        raise ValueError("there is no table yet")
    generation = store.next_generation(base or 0)
    buckets = index[0].buckets
    changed = add_columns(rows, add or {})
    for name in drop:
        changed = drop_column(changed, name)
    written: list = []
    if drop:
        store.write_live(changed, generation, keys, buckets)
        written = bucket_rows(store.read_staged(generation, changed.schema)).collect()
    store.commit(generation, changed.schema, buckets, written, [] if drop else index, last_batches(index))
    return generation


def load_delta(
    spark: SparkSession,
    directory: str | Sequence[str],
    store: GenerationStore,
    raw_path: str,
    keys: Sequence[str],
    policy: MergePolicy = RESURRECT,
    run_ts: datetime | str = "1970-01-01",
    on_empty: str = "fail",
    empty_raw: bool = True,
    buckets: int | None = None,
    schema: T.StructType | None = None,
    ledger: FileLedger | None = None,
    skipped: str | None = None,
) -> int:
    """Pick up delta files, land them, check the load, merge, empty the landing table.

    Returns the rows landed. ``on_empty="skip"`` leaves the target alone when
    no row arrived. Files are matched by name pattern in the whole tree.
    Giving the ``schema`` spares reading every file's footer to merge them.

    With a ``ledger`` only files that no earlier load has taken are read; they are noted once they are merged, so a load
    that dies takes them again. ``skipped`` is where damaged files are named (see ``skipped_files``) while all others
    are loaded; without it a damaged file stops the load.

    The rows landed are counted as they are written. Only if that is not what the files' footers tell is the landing
    table read for the files at fault.
    """
    listed, place = None, directory
    if ledger is not None:
        listed = write_and_read(ledger.new_files(list_files(spark, directory)), f"{ledger.path}.listed/run={run_name(run_ts)}")
        directory = [r["file"] for r in listed.select("file").collect()]  # names alone, as for any read
        if not directory:
            if on_empty == "skip":
                return 0
            raise EmptyLoad("no new files to load")
    damaged = {"skip_corrupt": skipped is not None}
    try:
        arrived = ingest_files(
            spark, directory, schema, merge_schema=schema is None, drop=[HASH], file_name="file_name", **damaged
        )
        files = ingest_files(spark, directory, arrived.schema if schema is None else schema, **damaged)
    except AnalysisException as error:
        if error.getCondition() not in ("UNABLE_TO_INFER_SCHEMA", "PATH_NOT_FOUND"):
            raise
        if on_empty == "skip":
            return 0
        raise EmptyLoad(f"no files to load in {directory}") from error
    run = run_name(run_ts)
    if LOAD_TS not in arrived.columns:
        arrived = arrived.withColumn(LOAD_TS, timestamp_literal(run_ts))
    rows = append_raw(arrived, raw_path, run)
    landed = read_raw(spark, raw_path, [run])
    if skipped is not None:
        write_and_read(skipped_files(spark, place, landed, listed=listed), f"{skipped}/run={run}")
    elif rows != files.count():
        validate_load(landed, file_counts(files), on_empty, file_column="file_name")
    if rows == 0:
        if on_empty == "skip":
            return 0
        raise EmptyLoad("no rows were loaded; check the path and the file pattern")
    merge_into(store, landed.drop("file_name", "run"), keys, policy, run_ts, buckets)
    if ledger is not None:
        taken = listed if skipped is None else listed.join(spark.read.parquet(f"{skipped}/run={run}").select("file"), "file", "left_anti")
        ledger.add(taken, run_ts)
    if empty_raw:
        consume_raw(spark, f"{raw_path}/run={run}")
    return rows
