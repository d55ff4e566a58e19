"""Change capture for one table by comparing it with its last snapshot."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.columns import BUCKET, CHANGE_KIND, HASH, clear_of_framework, content_columns
from tidemark.functions.hashing import bucket_count_of, bucket_fingerprint, differing_buckets, hash_bucket, packed_hash, row_hash, same_bucket, unpacked_hash
from tidemark.operators.audit import flag, stamp_audit
from tidemark.operators.delta import replaced_rows
from tidemark.operators.diff import (
    DELETED,
    INSERTED,
    SAME,
    UPDATED,
    assert_unique_keys,
    classified_keys,
    raise_if_any,
    rows_of_kind,
)
from tidemark.operators.drift import append_like, cast_up, widening
from tidemark.operators.merge import RESURRECT, MergePolicy
from tidemark.plans.load import assert_target_takes, merge_into
from tidemark.plans.result import RunResult
from tidemark.sinks.datasets import fits_broadcast, scatters, stored_bytes, write_and_read, write_delta
from tidemark.sinks.generations import GenerationStore, without_hash
from tidemark.sources.paths import TablePaths


def run_snapshot_cdc(
    spark: SparkSession,
    source: DataFrame,
    keys: Sequence[str],
    paths: TablePaths,
    run_ts: datetime | str,
    buckets: int | None = None,
    policy: MergePolicy | None = RESURRECT,
    check_keys: bool = True,
    stable_source: bool = False,
) -> RunResult:
    """Compare ``source`` with the last snapshot, write the delta, merge it, commit the new snapshot.

    1. The source is read once and landed as it comes, hashed, without a shuffle.
    2. Bucket fingerprints against those kept with the last generation tell
       which buckets differ; only these are shuffled into the next generation,
       and everything below touches only these. A source that is large for
       its buckets (see ``scatters``) is landed by bucket instead, and its
       buckets that differ become the next generation as they lie.
    3. Keys and hashes of both sides are compared; the changed keys are
       written, so that later joins know their size. The same pass finds
       duplicate keys.
    4. Replaced rows go to the snapshot's history, upserts and tombstones to the delta.
    5. The delta is merged into the target, and last of all the generation
       is committed: a run that dies before is repeated with the same outcome.

    A source column named like one of the framework's own is kept under a
    name with ``source_`` before it. ``policy`` None leaves the target alone. Without ``check_keys`` duplicate
    keys are let through, and the target gets the greatest row of each.
    A column whose type has changed is kept in a type that holds old and new values without loss (see
    ``wider_type``); if there is none, the run is refused before anything is written. Buckets that did not change stay as
    they were written. Only if the same value has another text in the new type (an integer that becomes a double), or
    a key another bucket, is the snapshot compared and written as a whole, once.
    ``stable_source`` says that reading the source again gives the same rows
    (files that do not change, not a live database): fingerprints are then
    taken from the source, and only the buckets that differ are shuffled and
    written.
    """
    source, renamed = clear_of_framework(source)
    keys = [renamed.get(k.lower(), k) for k in keys]
    store = GenerationStore(spark, paths.snapshot)
    base = store.current()
    index = store.index(base)
    anew = False
    if index:
        # refused here, before anything is written, if values could be cut
        wider = widening(without_hash(store.schema(base)), source.schema, keys, same_bucket)
        source = cast_up(source, wider.schema)
        anew = wider.rehashed or wider.rebucketed
    if policy is not None:
        assert_target_takes(GenerationStore(spark, paths.target), source)
    generation = store.next_generation(base or 0)
    hashed = row_hash(source, keys)
    if buckets is None and index:
        buckets = index[0].buckets
    elif buckets is None:  # a first run is sized by what it has landed
        hashed = write_and_read(hashed, store.work(generation, "landed"))
        buckets = bucket_count_of(stored_bytes(spark, store.work(generation, "landed")))

    staged = hash_bucket(hashed, keys, buckets)
    schema = staged.drop(BUCKET).schema
    scattered = scatters(source, buckets)
    # Statistics are one row per bucket.
    if index and scattered and not stable_source:
        store.write_live(staged, generation, keys, buckets, scattered=True)
        stats = bucket_fingerprint(store.read_staged(generation, schema), keys).collect()
        differing = differing_buckets(index, stats, buckets, anew)
        store.drop_staged(generation, {r["bucket"] for r in stats} - differing)
    elif index:
        if not stable_source:
            staged = write_and_read(staged, store.work(generation, "landed"))
        stats = bucket_fingerprint(staged, keys).collect()
        differing = sorted(differing_buckets(index, stats, buckets, anew))
        if differing:
            store.write_live(staged.where(F.col(BUCKET).isin(differing)), generation, keys, buckets, scattered=scattered)
    else:
        store.write_live(staged, generation, keys, buckets, scattered=scattered)
        stats = bucket_fingerprint(store.read_staged(generation, schema), keys).collect()
    result = RunResult(
        generation=generation, extracted=sum(r["rows"] for r in stats), run_ts=run_ts, load_type="SNAPSHOT"
    )

    if not index:
        current = store.read_staged(generation, schema)
        if check_keys:
            assert_unique_keys(current, keys)
        result.inserted = result.extracted
        delta = flag(current, deleted=False)
    else:
        changed = differing_buckets(index, stats, buckets, anew)
        result.changed_buckets = len(changed)
        if not changed:
            store.discard(generation)
            return result
        now = [r["bucket"] for r in stats if r["bucket"] in changed]
        curr = store.read_staged(generation, schema, now)
        regrouped = anew or index[0].buckets != buckets
        prev = cast_up(store.read(base, None if regrouped else changed), schema)
        if anew:
            # rows are compared by the hash that they have in the new types, so that only real changes are delivered
            prev = row_hash(prev.drop(HASH), keys, columns=content_columns(curr, keys))
        compared = classified_keys(prev, curr, keys, unique_keys=check_keys)
        notable = (F.col(CHANGE_KIND) != SAME) | (F.col("curr_rows") > 1)
        changes = write_and_read(compared.where(notable), store.work(generation, "changes"))
        if check_keys:
            raise_if_any(changes.where("curr_rows > 1"), keys)
        changes = changes.drop("curr_rows")
        counts = {r[CHANGE_KIND]: r["count"] for r in changes.groupBy(CHANGE_KIND).count().collect()}
        result.inserted = counts.get(INSERTED, 0)
        result.updated = counts.get(UPDATED, 0)
        result.deleted = counts.get(DELETED, 0)

        small = fits_broadcast(changes, [store.work(generation, "changes")])
        if small:
            replaced = replaced_rows(prev, changes, keys, small)
        else:
            replaced = unpacked_hash(replaced_rows(packed_hash(prev), changes, keys))
        replaced = store.write_history(replaced, generation)
        gone = replaced.where(F.col(CHANGE_KIND) == DELETED).drop(CHANGE_KIND)
        new = rows_of_kind(curr, changes, keys, INSERTED, UPDATED, small=small)
        delta = append_like(flag(new, deleted=False), flag(hash_bucket(gone, keys, buckets), deleted=True))

    if result.written:
        result.delta_path = paths.run_dir(run_ts)
        write_delta(stamp_audit(delta, run_ts), result.delta_path, scattered=scattered and not index)
        if policy is not None:
            arrived = spark.read.parquet(result.delta_path).drop(HASH, BUCKET)
            target = GenerationStore(spark, paths.target)
            merge_into(
                target, arrived, keys, policy, run_ts, buckets, landed=result.delta_path if check_keys else None
            )
            result.merged = result.written
    kept = [] if not index else [r for r in index if r.bucket is not None and r.bucket not in changed]
    fresh = stats if not index else [r for r in stats if r["bucket"] in changed]
    store.commit(generation, schema, buckets, fresh, kept)
    return result
