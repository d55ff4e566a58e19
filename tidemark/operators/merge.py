"""Latest row per key, and soft-delete merges into a target."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.columns import (
    FRAMEWORK_COLUMNS,
    SOFT_DELETE,
    join_on_keys,
    key_columns,
    quoted,
)
from tidemark.functions.scalars import timestamp_literal
from tidemark.operators.drift import add_columns, cast_up, common_schema


LOAD_TS = "load_ts"
#: Order values that a target keeps: of the newest row merged, and of the one that gave the data.
APPLIED, DATA = "__applied_ts", "__data_ts"
#: Order of a row without one: before all others.
NEVER = "0001-01-01 00:00:00"


@dataclass(frozen=True)
class MergePolicy:
    """How a merge marks rows in the target.

    ``deleted_column`` flags deleted rows with 1. The remaining fields settle
    the points on which warehouses differ.
    """

    deleted_column: str = "is_deleted"
    insert_ts: str | None = "insert_ts"
    update_ts: str | None = "update_ts"
    delete_ts: str | None = "delete_ts"
    revive: bool = True
    """A live row clears the deleted flag of a matching target row."""
    clear_delete_ts: bool = True
    """... and its deletion time."""
    flag_inserts: bool = True
    """New rows get flag 0; otherwise the flag stays NULL."""
    update_ts_on_insert: bool = True
    """New rows get an update time, too."""
    order: str | None = None
    """Column of the delta by which its rows follow each other (``load_ts``). The target then keeps it as state, and rows
    older than what has been merged lose, whenever they arrive. Only for policies that revive."""

    def __post_init__(self) -> None:
        if self.order and not self.revive:
            raise ValueError("a policy that never revives depends on the order of arrival")


RESURRECT = MergePolicy()
KEEP_DELETE_TS = MergePolicy(clear_delete_ts=False)
STAY_DELETED = MergePolicy(revive=False, clear_delete_ts=False, flag_inserts=False)
INSERT_TS_ONLY = MergePolicy(clear_delete_ts=False, flag_inserts=False, update_ts_on_insert=False)
FLAG_IN_SOFT_DELETE = MergePolicy(
    deleted_column="soft_delete",
    insert_ts="__insert_timestamp",
    update_ts="__update_timestamp",
    delete_ts="__delete_timestamp",
    clear_delete_ts=False,
)
POLICIES = {
    "resurrect": RESURRECT,
    "keep_delete_ts": KEEP_DELETE_TS,
    "stay_deleted": STAY_DELETED,
    "insert_ts_only": INSERT_TS_ONLY,
    "flag_in_soft_delete": FLAG_IN_SOFT_DELETE,
}


def latest_per_key(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str] = ("load_ts",),
    tiebreak: Sequence[str] | None = None,
) -> DataFrame:
    """The newest row of each key.

    Ties on ``order`` go to the tombstone, then to the greater values of the
    remaining columns, so that recomputing a lost task picks the same row.
    Spark keeps only each task's best row per key ahead of the shuffle
    (window group limit), which also defuses hot keys.
    """
    if tiebreak is None:
        used = {c.lower() for c in [*keys, *order, SOFT_DELETE]}
        rest = [f.name for f in df.schema.fields if f.name.lower() not in used and _orderable(f.dataType)]
        tiebreak = ([SOFT_DELETE] if SOFT_DELETE in df.columns else []) + rest
    ranking = [quoted(c).desc_nulls_last() for c in [*order, *tiebreak]]
    window = Window.partitionBy(*key_columns(keys)).orderBy(*ranking)
    return df.withColumn("__rank", F.row_number().over(window)).where("__rank = 1").drop("__rank")


def _orderable(dtype: T.DataType) -> bool:
    if isinstance(dtype, T.ArrayType):
        return _orderable(dtype.elementType)
    if isinstance(dtype, T.StructType):
        return all(_orderable(f.dataType) for f in dtype.fields)
    return not isinstance(dtype, (T.MapType, T.VariantType))


def _target_with_marks(target: DataFrame, policy: MergePolicy) -> DataFrame:
    marks: dict[str, str] = {policy.deleted_column: "int"}
    marks.update({c: "timestamp_ntz" for c in (policy.insert_ts, policy.update_ts, policy.delete_ts) if c})
    if policy.order:
        marks.update({APPLIED: "timestamp_ntz", DATA: "timestamp_ntz"})
    return add_columns(target, marks)


def _widened(target: DataFrame, newest: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both with the columns they share in types that hold the values of both without loss, or an error."""
    have = {c.lower() for c in target.columns} - {c.lower() for c in FRAMEWORK_COLUMNS}
    shared = T.StructType([f for f in newest.schema.fields if f.name.lower() in have])
    types = common_schema(target.schema, shared)
    return cast_up(target, types), cast_up(newest, T.StructType([f for f in types.fields if f.name.lower() in have]))


def merge_delta(
    target: DataFrame,
    delta: DataFrame,
    keys: Sequence[str],
    policy: MergePolicy = RESURRECT,
    run_ts: datetime | str = "1970-01-01",
    deduplicated: bool = False,
) -> DataFrame:
    """The target after merging the latest delta row of each key.

    Matched tombstones flag the target row and keep its data; matched live
    rows replace the data; unmatched live rows are inserted; unmatched
    tombstones and rows without a flag are ignored; other target rows stay.
    Columns follow the target; delta columns it lacks are ignored (see
    ``schema_drift`` and ``add_columns``). A column with another type in the
    delta gets one that holds both without loss; without one it is an error.

    One full join on unique keys: the delta is ranked once, the target read once. Only if Spark's own estimate lets
    the delta be broadcast, the target's rows stay where they are (see ``merge_parts``) and its keys are read once more.
    """
    if _broadcastable(delta):
        kept, added = merge_parts(target, delta, keys, policy, run_ts, deduplicated)
        return kept.unionByName(added)
    merge = _Merge(target, delta, keys, policy, run_ts, deduplicated)
    side = {k: f"__key_{i}" for i, k in enumerate(keys)}
    incoming = merge.incoming.withColumn("__arrived", F.lit(True)).withColumnsRenamed(side)
    same = reduce(and_, [quoted(k).eqNullSafe(F.col(n)) for k, n in side.items()])
    joined = merge.target.withColumn("__known", F.lit(True)).join(incoming, same, "full_outer")
    known = F.col("__known").isNotNull()
    rows = joined.where(known | merge.enters)
    return rows.select(
        *[F.when(known, merge.matched(c)).otherwise(merge.inserted(c, side)).cast(merge.types[c]).alias(c) for c in merge.target.columns]
    )


def _broadcastable(df: DataFrame) -> bool:
    """Whether Spark estimates the rows to be under its limit for broadcasts."""
    limit = df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) <= int(limit)


def merge_parts(
    target: DataFrame,
    delta: DataFrame,
    keys: Sequence[str],
    policy: MergePolicy = RESURRECT,
    run_ts: datetime | str = "1970-01-01",
    deduplicated: bool = False,
    small: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """The same in two parts: the target's rows after the merge, and the inserted rows.

    With ``small`` (a delta whose stored size has been checked) the target's
    rows stay in the tasks that scan them, and its keys are read once more to find the rows to insert.
    """
    merge = _Merge(target, delta, keys, policy, run_ts, deduplicated)
    kept = join_on_keys(merge.target, merge.incoming, keys, "left", small).select(
        *[merge.matched(c).cast(merge.types[c]).alias(c) for c in merge.target.columns]
    )
    entering = merge.incoming.where(merge.enters)
    known = join_on_keys(
        merge.target.select(*key_columns(keys)), entering.select(*key_columns(keys)), keys, "left_semi", small
    )
    fresh = join_on_keys(entering, known, keys, "left_anti")
    added = fresh.select(*[merge.inserted(c).cast(merge.types[c]).alias(c) for c in merge.target.columns])
    return kept, added


class _Merge:
    """What a merge makes of each column, over target columns and the delta's under names of their own.

    With ``policy.order`` a row of the target knows the order value of the newest row merged into it (``APPLIED``) and of
    the row that gave its data (``DATA``). What is older than either changes nothing there, so loads can arrive in
    any order. A tombstone whose key is unknown is kept as a row without data, for a live row that may come later.
    """

    def __init__(self, target: DataFrame, delta: DataFrame, keys: Sequence[str], policy: MergePolicy, run_ts, deduplicated: bool):
        self.policy, self.now = policy, timestamp_literal(run_ts)
        target = _target_with_marks(target, policy)
        newest = delta if deduplicated else latest_per_key(delta, keys, [policy.order or LOAD_TS])
        newest = newest.where(F.col(SOFT_DELETE).isin(0, 1))
        self.target, newest = _widened(target, newest)
        marks = {c.lower() for c in (policy.deleted_column, policy.insert_ts, policy.update_ts, policy.delete_ts) if c}
        framework = {c.lower() for c in (*FRAMEWORK_COLUMNS, APPLIED, DATA)} | marks
        self.is_key = {k.lower() for k in keys}
        in_delta = {c.lower() for c in newest.columns}
        data = [c for c in self.target.columns if c.lower() in in_delta and c.lower() not in self.is_key | framework]
        self.new_name = {c: f"__new_{i}" for i, c in enumerate(data)}
        self.types = {f.name: f.dataType for f in self.target.schema.fields}
        order = [F.coalesce(quoted(policy.order), timestamp_literal(NEVER)).alias("__order")] if policy.order else []
        self.incoming = newest.select(
            *key_columns(keys), F.col(SOFT_DELETE).alias("__deleted"), *[quoted(c).alias(n) for c, n in self.new_name.items()], *order
        )
        self.is_live, self.is_gone = F.col("__deleted") == 0, F.col("__deleted") == 1
        #: Rows that are added if the target does not have their key.
        self.enters = (self.is_live | self.is_gone) if policy.order else self.is_live
        self.gives = self.revives = self.is_live
        self.deletes, self.is_ghost = self.is_gone, F.lit(False)
        if policy.order:
            self._in_order(data)

    def _in_order(self, data: Sequence[str]) -> None:
        order, applied, given = F.col("__order"), F.col(APPLIED), F.col(DATA)
        comparable = [c for c in data if _orderable(self.types[c])]
        # rows of one order value: the greater values, as among the rows of one load; a tombstone stays over a live row
        greater = F.lit(False)
        if comparable:
            greater = F.struct(*[F.col(self.new_name[c]) for c in comparable]) > F.struct(*[quoted(c) for c in comparable])
        deleted = quoted(self.policy.deleted_column) == 1
        self.is_ghost = applied.isNotNull() & given.isNull()
        self.gives = self.is_live & (given.isNull() | (order > given) | ((order == given) & greater))
        self.revives = self.is_live & (applied.isNull() | (order > applied) | ((order == applied) & ~F.coalesce(deleted, F.lit(False))))
        self.deletes = self.is_gone & (applied.isNull() | (order >= applied))

    def matched(self, name: str) -> Column:
        """The value of a row that the target has."""
        policy, now, old, low = self.policy, self.now, quoted(name), name.lower()
        changes = self.gives | self.revives | self.deletes
        # a row without data that a newer live row meets is as good as new
        begins = self.is_ghost & self.revives
        if name in self.new_name:
            return F.when(self.gives, F.col(self.new_name[name])).otherwise(old)
        if low == policy.deleted_column.lower():
            value = F.when(self.deletes, F.lit(1))
            value = value.when(begins, F.lit(0) if policy.flag_inserts else F.lit(None))
            if policy.revive:
                value = value.when(self.revives, F.lit(0))
            return value.otherwise(old)
        if policy.insert_ts and low == policy.insert_ts.lower():
            return F.when(self.is_ghost & self.is_live, now).otherwise(old)
        if policy.update_ts and low == policy.update_ts.lower():
            value = F.when(begins, now if policy.update_ts_on_insert else F.lit(None))
            value = value.when(self.is_ghost & self.is_gone, old)
            return value.when(changes, now).otherwise(old)
        if policy.delete_ts and low == policy.delete_ts.lower():
            value = F.when(self.deletes, now).when(begins, F.lit(None).cast("timestamp_ntz"))
            if policy.clear_delete_ts:
                value = value.when(self.revives, F.lit(None).cast("timestamp_ntz"))
            return value.otherwise(old)
        if policy.order and name == APPLIED:
            return F.when(self.revives | self.deletes, F.greatest(old, F.col("__order"))).otherwise(old)
        if policy.order and name == DATA:
            return F.when(self.gives, F.col("__order")).otherwise(old)
        return old

    def inserted(self, name: str, key_names: dict[str, str] | None = None) -> Column:
        """The value of a row that the target does not have."""
        policy, low = self.policy, name.lower()
        live = lambda value: F.when(self.is_live, value) if policy.order else value
        if low in self.is_key:
            renamed = {k.lower(): n for k, n in (key_names or {}).items()}
            return F.col(renamed[low]) if low in renamed else quoted(name)
        if name in self.new_name:
            return live(F.col(self.new_name[name]))
        if low == policy.deleted_column.lower():
            value = F.lit(0) if policy.flag_inserts else F.lit(None).cast("int")
            return F.when(self.is_gone, F.lit(1)).otherwise(value) if policy.order else value
        if policy.insert_ts and low == policy.insert_ts.lower():
            return live(self.now)
        if policy.update_ts and low == policy.update_ts.lower() and policy.update_ts_on_insert:
            return live(self.now)
        if policy.order and policy.delete_ts and low == policy.delete_ts.lower():
            return F.when(self.is_gone, self.now)
        if policy.order and name == APPLIED:
            return F.col("__order")
        if policy.order and name == DATA:
            return live(F.col("__order"))
        return F.lit(None)


def without_state(target: DataFrame) -> DataFrame:
    """A target merged with ``MergePolicy.order`` as its readers want it: without rows that have no data, and without
    the order values."""
    have = set(target.columns)
    if not {APPLIED, DATA} <= have:
        return target
    return target.where(F.col(APPLIED).isNull() | F.col(DATA).isNotNull()).drop(APPLIED, DATA)


def merge_table(
    table: str,
    delta: DataFrame,
    keys: Sequence[str],
    policy: MergePolicy = RESURRECT,
    run_ts: datetime | str = "1970-01-01",
    deduplicated: bool = False,
) -> None:
    """Merge into a catalog table whose format supports row-level changes.

    Same rules as :func:`merge_delta`, left to the table's own ``MERGE``,
    which need not rewrite rows that stay. Plain Parquet tables refuse it,
    so the merge itself, and names of several parts, have not been tried here.
    """
    now = timestamp_literal(run_ts)
    target_columns = delta.sparkSession.table(table).columns
    newest = (delta if deduplicated else latest_per_key(delta, keys)).alias("r")
    in_delta = {c.lower() for c in newest.columns}
    framework = {c.lower() for c in FRAMEWORK_COLUMNS}
    data = [c for c in target_columns if c.lower() in in_delta - framework]
    is_key = {k.lower() for k in keys}

    def new(name: str) -> Column:
        return F.col(f"r.`{name}`")

    same_key = reduce(and_, [new(k).eqNullSafe(F.col(f"{table}.`{k}`")) for k in keys])
    deleted = {policy.deleted_column: F.lit(1)}
    updated = {c: new(c) for c in data if c.lower() not in is_key}
    inserted = {c: new(c) for c in data}
    if policy.revive:
        updated[policy.deleted_column] = F.lit(0)
    if policy.flag_inserts:
        inserted[policy.deleted_column] = F.lit(0)
    if policy.update_ts:
        deleted[policy.update_ts] = updated[policy.update_ts] = now
        if policy.update_ts_on_insert:
            inserted[policy.update_ts] = now
    if policy.delete_ts:
        deleted[policy.delete_ts] = now
        if policy.clear_delete_ts:
            updated[policy.delete_ts] = F.lit(None).cast("timestamp_ntz")
    if policy.insert_ts:
        inserted[policy.insert_ts] = now
    (
        newest.mergeInto(table, same_key)
        .whenMatched(new(SOFT_DELETE) == 1)
        .update(deleted)
        .whenMatched(new(SOFT_DELETE) == 0)
        .update(updated)
        .whenNotMatched(new(SOFT_DELETE) == 0)
        .insert(inserted)
        .merge()
    )


def new_target(
    delta: DataFrame, keys: Sequence[str], policy: MergePolicy = RESURRECT, run_ts: datetime | str = "1970-01-01"
) -> DataFrame:
    """The target after its first delta."""
    return merge_delta(empty_target(delta, policy), delta, keys, policy, run_ts)


def empty_target(delta: DataFrame, policy: MergePolicy = RESURRECT) -> DataFrame:
    """A target without rows that has the delta's business columns and the policy's marks."""
    business = [c for c in delta.columns if c.lower() not in {x.lower() for x in FRAMEWORK_COLUMNS}]
    frame = delta.select(*[quoted(c) for c in business]).where(F.lit(False))
    return _target_with_marks(frame, policy)


def load_to_target(
    delta: DataFrame,
    target: DataFrame,
    keys: Sequence[str],
    policy: str | MergePolicy = "resurrect",
    run_ts: datetime | str = "1970-01-01",
) -> DataFrame:
    """Merge by the name of a policy preset or by a policy of one's own."""
    if isinstance(policy, str):
        try:
            policy = POLICIES[policy.lower()]
        except KeyError:
            raise ValueError(f"unknown merge policy {policy!r}; one of {sorted(POLICIES)}") from None
    return merge_delta(target, delta, keys, policy, run_ts)


def upsert(target: DataFrame, updates: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Replace rows by key and add new ones, without flags or audit columns."""
    return join_on_keys(target, updates.select(*key_columns(keys)), keys, "left_anti").unionByName(updates)

