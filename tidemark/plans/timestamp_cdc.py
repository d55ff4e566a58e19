"""Change capture for one table by timestamp high-watermark."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.columns import BUCKET, SOFT_DELETE, clear_of_framework, join_on_keys, key_columns
from tidemark.functions.hashing import bucket_count_of, bucket_fingerprint, differing_buckets, hash_bucket, same_bucket
from tidemark.operators.audit import flag, stamp_audit
from tidemark.operators.diff import deleted_keys
from tidemark.operators.drift import add_columns, append_like, cast_up, schema_drift, widening
from tidemark.operators.incremental import changed_since, extract_summary
from tidemark.operators.merge import RESURRECT, MergePolicy
from tidemark.plans.load import assert_target_takes, bucket_rows, merge_into
from tidemark.plans.result import RunResult
from tidemark.sinks.datasets import BROADCAST_BYTES, fits_broadcast, scatters, stored_bytes, write_and_read, write_delta
from tidemark.sinks.generations import GenerationStore
from tidemark.sources.paths import TablePaths


def run_timestamp_cdc(
    spark: SparkSession,
    source: DataFrame,
    keys: Sequence[str],
    ts_cols: Sequence[str],
    watermark: datetime,
    paths: TablePaths,
    run_ts: datetime | str,
    buckets: int | None = None,
    policy: MergePolicy | None = RESURRECT,
    nulls: str = "exclude",
    trust_timestamps: bool = False,
) -> RunResult:
    """Deliver rows over ``watermark`` and keys gone since the last snapshot, then commit the snapshot.

    The source is read once; the increment, the deletions, the snapshot and
    the next watermark all come from that one reading. If nothing changed,
    no generation is committed and the watermark stays.

    ``trust_timestamps`` says that every change of a row moves one of its
    timestamps over the watermark. Then only the increment and the keys are
    read from the source (both reach the scan as filter and column list), and
    the snapshot is brought up to date from them in the buckets concerned,
    instead of being written anew.

    A column whose type has changed is widened as in ``run_snapshot_cdc``, or
    the run is refused before anything is written.

    A source column named like one of the framework's own (its timestamps
    among them) is kept under a name with ``source_`` before it, so the next
    watermark never comes from the times that this run stamps.
    """
    source, renamed = clear_of_framework(source)
    keys = [renamed.get(k.lower(), k) for k in keys]
    ts_cols = [renamed.get(c.lower(), c) for c in ts_cols]
    store = GenerationStore(spark, paths.snapshot)
    base = store.current()
    index = store.index(base)
    anew = False
    if index:
        # refused here, before anything is written, if values could be cut
        wider = widening(store.schema(base), source.schema, keys, same_bucket)
        source, anew = cast_up(source, wider.schema), wider.rebucketed
    if policy is not None:
        assert_target_takes(GenerationStore(spark, paths.target), source)
    if buckets is None and index:
        buckets = index[0].buckets
    generation = store.next_generation(base or 0)
    over = changed_since(source, ts_cols, watermark, nulls)

    if index and trust_timestamps and not anew:
        buckets = index[0].buckets
        delta, commit = _from_increment(store, base, generation, source, over, keys, buckets)
    else:
        schema = source.schema
        # a snapshot that increments are going to update in place is kept in whole files
        scattered = buckets is not None and not trust_timestamps and scatters(source, buckets)
        if scattered:
            # Landed by bucket, as the next generation if the bucket differs. Statistics are one row per bucket.
            store.write_live(source, generation, keys, buckets, scattered=True)
            current = store.read_staged(generation, schema)
        else:
            # Landed as it comes; only the buckets that differ are shuffled.
            landed = write_and_read(source, store.work(generation, "landed"))
            if buckets is None:  # a first run is sized by what it has landed
                buckets = bucket_count_of(stored_bytes(spark, store.work(generation, "landed")))
            current = hash_bucket(landed, keys, buckets)
        stats = bucket_fingerprint(current, keys).collect()
        changed = differing_buckets(index, stats, buckets, anew) if index else {r["bucket"] for r in stats}
        regrouped = anew or bool(index) and index[0].buckets != buckets
        delta = flag(changed_since(current, ts_cols, watermark, nulls), deleted=False)
        here = current.where(F.col(BUCKET).isin(sorted(changed)))
        prev = store.read(base, None if regrouped else changed) if index else None
        if prev is not None and changed:
            prev = cast_up(prev, schema)
            gone_keys = write_and_read(deleted_keys(prev, here.drop(BUCKET), keys), store.work(generation, "gone"))
            gone = store.write_history(join_on_keys(prev, gone_keys, keys, "left_semi"), generation)
            delta = append_like(delta, flag(hash_bucket(gone, keys, buckets), deleted=True))

        def commit() -> None:
            fresh = [r for r in stats if r["bucket"] in changed]
            if scattered:
                store.drop_staged(generation, {r["bucket"] for r in stats} - changed)
            elif fresh:
                store.write_live(here, generation, keys, buckets)
            store.commit(generation, schema, buckets, fresh, [r for r in index if r.bucket is not None and r.bucket not in changed])

    delta = stamp_audit(delta, run_ts)
    delta_path = paths.run_dir(run_ts)
    write_delta(delta, delta_path)
    arrived = spark.read.schema(delta.schema).parquet(delta_path)
    summary = extract_summary(arrived.where(F.col(SOFT_DELETE) == 0), ts_cols).first()
    result = RunResult(
        run_ts=run_ts,
        load_type="TIMESTAMP",
        generation=generation,
        extracted=summary["rows"],
        inserted=summary["rows"],
        deleted=arrived.where(F.col(SOFT_DELETE) == 1).count(),
        watermark=max(watermark, summary["max_ts"] or watermark),
        delta_path=delta_path,
    )
    if result.written == 0:
        store.discard(generation)
        return result
    if policy is not None:
        target = GenerationStore(spark, paths.target)
        merge_into(target, arrived.drop(BUCKET), keys, policy, run_ts, buckets)
        result.merged = result.written
    commit()
    return result


def _from_increment(
    store: GenerationStore,
    base: int,
    generation: int,
    source: DataFrame,
    over: DataFrame,
    keys: Sequence[str],
    buckets: int,
) -> tuple[DataFrame, Callable[[], None]]:
    """Delta (with ``bucket``) from increment and keys, and the step that commits the snapshot.

    The increment is landed before the keys are read: a row deleted in
    between is delivered as live and as deleted, of which deleted wins.
    """
    increment_path, gone_path = store.work(generation, "increment"), store.work(generation, "gone")
    increment = write_and_read(hash_bucket(over, keys, buckets), increment_path)
    here = source.select(*key_columns(keys))
    gone_keys = write_and_read(
        hash_bucket(deleted_keys(cast_up(store.read(base), source.schema), here, keys), keys, buckets), gone_path
    )
    # At most one row per bucket comes back.
    moved = increment.select(BUCKET).union(gone_keys.select(BUCKET)).distinct()
    touched = {r[BUCKET] for r in moved.collect()}
    before = cast_up(store.read(base, touched, keep_bucket=True), source.schema)
    narrow = increment.select(*key_columns(keys)).unionByName(gone_keys.select(*key_columns(keys)))
    small = fits_broadcast(narrow, [increment_path, gone_path], BROADCAST_BYTES)
    gone = store.write_history(
        join_on_keys(before.drop(BUCKET), gone_keys.drop(BUCKET), keys, "left_semi", small), generation
    )
    delta = append_like(
        flag(increment, deleted=False), flag(hash_bucket(gone, keys, buckets), deleted=True)
    )

    def commit() -> None:
        widened = add_columns(before, schema_drift(increment, before, ignore=[BUCKET]).added)
        replaced = increment.select(*key_columns(keys)).union(gone_keys.select(*key_columns(keys)))
        kept = join_on_keys(widened, replaced, keys, "left_anti", small)
        added = join_on_keys(increment, gone_keys.drop(BUCKET), keys, "left_anti", small)
        if small and not store.is_fragmented(before):
            store.write_in_place(kept, added, generation, keys, buckets)
        else:
            merged = kept.unionByName(added, allowMissingColumns=True).drop(BUCKET)
            store.write_live(merged, generation, keys, buckets, gather=True)
        schema = widened.drop(BUCKET).schema
        written = bucket_rows(store.read_staged(generation, schema)).collect()
        others = [r for r in store.index(base) if r.bucket not in touched]
        store.commit(generation, schema, buckets, written, others)

    return delta, commit
