"""Comparison of states, deltas, snapshots and history."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.base import query, row_hash_sql, state, table
from checks.scans import fingerprint_sql
from checks.states import (
    CONV_CURR,
    CONV_PREV,
    DOC_CURR,
    DOC_PREV,
    FIRST_TS,
    ORD_COLUMNS,
    ORD_CURR,
    ORD_PREV,
    ORD_TIMES_CURR,
    ORD_TIMES_PREV,
    RUN_TS,
    WATERMARK,
)
from tidemark.functions.columns import live, tombstones
from tidemark.functions.hashing import bucket_fingerprint, changed_buckets
from tidemark.operators.audit import flag, stamp_audit
from tidemark.operators.delta import apply_scd2, as_of, next_snapshot, scd2_step, snapshot_delta, start_history
from tidemark.operators.diff import (
    change_counts,
    changed_keys,
    deleted_keys,
    deletes,
    duplicate_keys,
    inserted_keys,
    snapshot_diff,
    superseded,
    updated_keys,
    upsert_keys,
    upserts,
)
from tidemark.operators.drift import add_columns, align_to, drop_column, schema_drift, union_drift
from tidemark.operators.incremental import timestamp_delta, timestamp_snapshot

ORD_KEYS = ("o_orderkey",)
CONV_KEYS = ("conv_id", "turn")
DOC_KEYS = ("doc_id",)
PAIRS = {
    "orders": (ORD_PREV, ORD_CURR, ORD_KEYS, ORD_COLUMNS[1:]),
    "conversations": (CONV_PREV, CONV_CURR, CONV_KEYS, ("role", "text")),
    "documents": (DOC_PREV, DOC_CURR, DOC_KEYS, ("lang", "source", "n_chars", "text")),
}


def diff_sql(pair: str) -> str:
    """The comparison as a full join on the key, column by column."""
    prev, curr, keys, columns = PAIRS[pair]
    on = " and ".join(f"p.{k} is not distinct from c.{k}" for k in keys)
    differs = " or ".join(f"p.{c} is distinct from c.{c}" for c in columns)
    picked = ", ".join(f"coalesce(c.{k}, p.{k}) as {k}" for k in keys)
    return f"""
select {picked}, case when p.there is null then 'I' when c.there is null then 'D'
                      when {differs} then 'U' else 'S' end as change_kind
from (select *, 1 as there from ({prev}) x) p full join (select *, 1 as there from ({curr}) y) c on {on}"""


def _pair(spark, sf, pair):
    prev, curr, keys, _ = PAIRS[pair]
    return state(spark, sf, prev), state(spark, sf, curr), list(keys)


def _rows_sql(pair: str, side: int, kinds: str) -> str:
    keys = PAIRS[pair][2]
    on = " and ".join(f"r.{k} = d.{k}" for k in keys)
    return f"select r.* from ({PAIRS[pair][side]}) r join ({diff_sql(pair)}) d on {on} where d.change_kind in ({kinds})"


for _name in PAIRS:

    @query(f"snapshot_diff_{_name}", diff_sql(_name))
    def _(spark, sf, pair=_name):
        return snapshot_diff(*_pair(spark, sf, pair))

    @query(
        f"change_counts_{_name}",
        f"""select count(case when change_kind = 'I' then 1 end) as inserted,
                   count(case when change_kind = 'U' then 1 end) as updated,
                   count(case when change_kind = 'D' then 1 end) as deleted,
                   count(case when change_kind = 'S' then 1 end) as unchanged from ({diff_sql(_name)}) d""",
    )
    def _(spark, sf, pair=_name):
        return change_counts(snapshot_diff(*_pair(spark, sf, pair)))

    @query(f"upserts_{_name}", _rows_sql(_name, 1, "'I', 'U'"))
    def _(spark, sf, pair=_name):
        prev, curr, keys = _pair(spark, sf, pair)
        return upserts(prev, curr, keys)

    @query(f"deletes_{_name}", _rows_sql(_name, 0, "'D'"))
    def _(spark, sf, pair=_name):
        prev, curr, keys = _pair(spark, sf, pair)
        return deletes(prev, curr, keys)

    @query(f"superseded_{_name}", _rows_sql(_name, 0, "'U'"))
    def _(spark, sf, pair=_name):
        prev, curr, keys = _pair(spark, sf, pair)
        return superseded(prev, curr, keys)

    _keys = ", ".join(PAIRS[_name][2])

    @query(f"inserted_keys_{_name}", f"select {_keys} from ({diff_sql(_name)}) d where change_kind = 'I'")
    def _(spark, sf, pair=_name):
        return inserted_keys(*_pair(spark, sf, pair))

    @query(f"updated_keys_{_name}", f"select {_keys} from ({diff_sql(_name)}) d where change_kind = 'U'")
    def _(spark, sf, pair=_name):
        return updated_keys(*_pair(spark, sf, pair))

    @query(f"deleted_keys_{_name}", f"select {_keys} from ({diff_sql(_name)}) d where change_kind = 'D'")
    def _(spark, sf, pair=_name):
        return deleted_keys(*_pair(spark, sf, pair))


@query("snapshot_diff_orders_unique_keys", diff_sql("orders"))
def _(spark, sf):
    prev, curr, keys = _pair(spark, sf, "orders")
    return snapshot_diff(prev, curr, keys, unique_keys=True)


@query("snapshot_diff_conversations_unique_keys", diff_sql("conversations"))
def _(spark, sf):
    prev, curr, keys = _pair(spark, sf, "conversations")
    return snapshot_diff(prev, curr, keys, unique_keys=True)


@query("changed_keys_orders", f"select * from ({diff_sql('orders')}) d where change_kind <> 'S'")
def _(spark, sf):
    return changed_keys(*_pair(spark, sf, "orders"))


@query("upsert_keys_conversations", f"select conv_id, turn from ({diff_sql('conversations')}) d where change_kind in ('I', 'U')")
def _(spark, sf):
    return upsert_keys(*_pair(spark, sf, "conversations"))


# Line items have no unique key, so both states hold several versions per key;
# a key counts as updated if any current
# version of it is new.
_LINE_COLUMNS = ("l_partkey", "l_suppkey", "l_quantity", "l_price", "l_returnflag", "l_linestatus", "l_shipdate")
_LINE = """
select l_orderkey, l_linenumber, l_partkey, l_suppkey, cast(l_quantity as decimal(18,2)) as l_quantity,
       cast(l_extendedprice as decimal(18,2)) as l_price, l_returnflag, l_linestatus, l_shipdate
from {lineitem}"""
_LINE_PREV = f"select * from ({_LINE}) t where l_returnflag <> 'A' or l_linestatus = 'F'"
_LINE_CURR = f"select * from ({_LINE}) t where l_returnflag <> 'N' or l_linestatus = 'O'"


@query(
    "snapshot_diff_lineitem_versions",
    f"""
with p as (select distinct l_orderkey, l_linenumber, {row_hash_sql(*_LINE_COLUMNS)} as h from ({_LINE_PREV}) x),
     c as (select distinct l_orderkey, l_linenumber, {row_hash_sql(*_LINE_COLUMNS)} as h from ({_LINE_CURR}) y),
     pk as (select distinct l_orderkey, l_linenumber from p),
     ck as (select distinct l_orderkey, l_linenumber from c),
     fresh as (select distinct l_orderkey, l_linenumber from (select * from c except select * from p) z)
select coalesce(pk.l_orderkey, ck.l_orderkey) as l_orderkey,
       coalesce(pk.l_linenumber, ck.l_linenumber) as l_linenumber,
       case when pk.l_orderkey is null then 'I' when ck.l_orderkey is null then 'D'
            when fresh.l_orderkey is not null then 'U' else 'S' end as change_kind
from pk full join ck on pk.l_orderkey = ck.l_orderkey and pk.l_linenumber = ck.l_linenumber
left join fresh on ck.l_orderkey = fresh.l_orderkey and ck.l_linenumber = fresh.l_linenumber""",
)
def _(spark, sf):
    prev, curr = state(spark, sf, _LINE_PREV), state(spark, sf, _LINE_CURR)
    return snapshot_diff(prev, curr, ["l_orderkey", "l_linenumber"])


@query(
    "duplicate_keys_lineitem",
    "select l_orderkey, l_linenumber, count(*) as rows from {lineitem} group by 1, 2 having count(*) > 1",
)
def _(spark, sf):
    return duplicate_keys(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


# A third of the keys NULL on both sides: compared as one key, never joined row by row.
_HOT_PREV = "select case when o_orderstatus = 'P' then null else o_orderkey end as k, o_custkey from {orders}"
_HOT_CURR = "select case when o_orderstatus in ('P', 'F') then null else o_orderkey end as k, o_custkey from {orders}"


@query(
    "deleted_keys_hot_null",
    f"""select k from ({_HOT_PREV}) p except select k from ({_HOT_CURR}) c""",
)
def _(spark, sf):
    return deleted_keys(state(spark, sf, _HOT_PREV), state(spark, sf, _HOT_CURR), ["k"])


def audit_sql(run_ts: str) -> str:
    now = f"cast('{run_ts}' as #ts)"
    return (
        f"{now} as load_ts, case when soft_delete = 0 then {now} end as insert_ts, "
        f"case when soft_delete = 0 then {now} end as update_ts, case when soft_delete = 1 then {now} end as delete_ts"
    )


def delta_sql(pair: str, run_ts: str = RUN_TS) -> str:
    upsert = _rows_sql(pair, 1, "'I', 'U'")
    gone = _rows_sql(pair, 0, "'D'")
    columns = ", ".join([*PAIRS[pair][2], *PAIRS[pair][3]])
    return f"""
select {columns}, soft_delete, {audit_sql(run_ts)} from (
  select {columns}, 0 as soft_delete from ({upsert}) a union all select {columns}, 1 from ({gone}) b) t"""


for _name in PAIRS:

    @query(f"snapshot_delta_{_name}", delta_sql(_name))
    def _(spark, sf, pair=_name):
        prev, curr, keys = _pair(spark, sf, pair)
        return snapshot_delta(prev, curr, keys, RUN_TS).drop("hash_val")


@query("snapshot_delta_first_run", f"select *, 0 as soft_delete, {audit_sql(RUN_TS).replace('soft_delete = 0', 'true').replace('soft_delete = 1', 'false')} from ({ORD_CURR}) t")
def _(spark, sf):
    return snapshot_delta(None, state(spark, sf, ORD_CURR), ["o_orderkey"], RUN_TS)


@query("stamp_audit_orders", f"select t.*, {audit_sql(RUN_TS)} from (select *, case when o_orderstatus = 'F' then 1 else 0 end as soft_delete from ({ORD_CURR}) u) t")
def _(spark, sf):
    flagged = state(spark, sf, ORD_CURR).withColumn(
        "soft_delete", F.when(F.col("o_orderstatus") == "F", 1).otherwise(0)
    )
    return stamp_audit(flagged, RUN_TS)


_O = ", ".join(ORD_COLUMNS)
# A snapshot that already holds tombstones: the previous state plus deletions of an earlier run.
_SNAPSHOT = f"""
select {_O}, 0 as soft_delete from ({ORD_PREV}) a
union all select -o_orderkey - 1, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority, 1
from ({ORD_PREV}) b where o_orderpriority = '3-MEDIUM'"""
NEXT_SNAPSHOT_SQL = f"""
select {_O}, 0 as soft_delete from ({ORD_CURR}) a
union all select {_O}, 1 from ({_rows_sql('orders', 0, "'U', 'D'")}) b
union all select {_O}, 1 from ({_SNAPSHOT}) c where soft_delete = 1"""


@query("next_snapshot_orders", NEXT_SNAPSHOT_SQL)
def _(spark, sf):
    snapshot = state(spark, sf, _SNAPSHOT)
    return next_snapshot(snapshot, state(spark, sf, ORD_CURR), ["o_orderkey"]).drop("hash_val")


@query("live_orders", f"select * from ({_SNAPSHOT}) t where soft_delete = 0")
def _(spark, sf):
    return live(state(spark, sf, _SNAPSHOT))


@query("tombstones_orders", f"select * from ({_SNAPSHOT}) t where soft_delete = 1")
def _(spark, sf):
    return tombstones(state(spark, sf, _SNAPSHOT))


def _history_sql(pair: str) -> str:
    columns = ", ".join(f"r.{c}" for c in [*PAIRS[pair][2], *PAIRS[pair][3]])
    on = " and ".join(f"r.{k} = d.{k}" for k in PAIRS[pair][2])
    first, now = f"cast('{FIRST_TS}' as #ts)", f"cast('{RUN_TS}' as #ts)"
    return f"""
select {columns}, 'I' as change_kind, {first} as valid_from,
       case when d.change_kind in ('U', 'D') then {now} end as valid_to,
       case when d.change_kind in ('U', 'D') then d.change_kind end as closed_by
from ({PAIRS[pair][0]}) r join ({diff_sql(pair)}) d on {on}
union all
select {columns}, d.change_kind, {now}, cast(null as #ts), cast(null as string)
from ({PAIRS[pair][1]}) r join ({diff_sql(pair)}) d on {on} where d.change_kind in ('I', 'U')"""


for _name in ("orders", "conversations"):

    @query(f"scd2_history_{_name}", _history_sql(_name))
    def _(spark, sf, pair=_name):
        prev, curr, keys = _pair(spark, sf, pair)
        return apply_scd2(start_history(prev, keys, FIRST_TS), curr, keys, RUN_TS).drop("hash_val")


@query("scd2_step_orders", _history_sql("orders"))
def _(spark, sf):
    prev, curr, keys = _pair(spark, sf, "orders")
    closed, opened = scd2_step(start_history(prev, keys, FIRST_TS), curr, keys, RUN_TS)
    return closed.unionByName(opened).drop("hash_val")


@query("scd2_as_of_first", ORD_PREV)
def _(spark, sf):
    prev, curr, keys = _pair(spark, sf, "orders")
    history = apply_scd2(start_history(prev, keys, FIRST_TS), curr, keys, RUN_TS)
    return as_of(history, "2024-01-01 12:00:00").select(*ORD_COLUMNS)


@query("scd2_as_of_second", ORD_CURR)
def _(spark, sf):
    prev, curr, keys = _pair(spark, sf, "orders")
    history = apply_scd2(start_history(prev, keys, FIRST_TS), curr, keys, RUN_TS)
    return as_of(history, RUN_TS).select(*ORD_COLUMNS)


# Only one customer's orders differ here, so most of many buckets stay the same.
_FEW_CHANGED = """
select o_orderkey, o_custkey, o_orderstatus,
       cast(o_totalprice + case when o_custkey = 7 then 1 else 0 end as decimal(18,2)) as o_totalprice,
       o_orderdate, o_orderpriority from {orders}"""
_ALL_ORDERS = """
select o_orderkey, o_custkey, o_orderstatus, cast(o_totalprice as decimal(18,2)) as o_totalprice,
       o_orderdate, o_orderpriority from {orders}"""


@query(
    "changed_buckets_orders",
    f"""select coalesce(p.bucket, c.bucket) as bucket
        from ({fingerprint_sql(_ALL_ORDERS, ORD_KEYS, ORD_COLUMNS[1:], 64)}) p
        full join ({fingerprint_sql(_FEW_CHANGED, ORD_KEYS, ORD_COLUMNS[1:], 64)}) c on p.bucket = c.bucket
        where p.rows is distinct from c.rows or p.fingerprint is distinct from c.fingerprint""",
)
def _(spark, sf):
    before = bucket_fingerprint(state(spark, sf, _ALL_ORDERS), ["o_orderkey"], 64, portable=True)
    after = bucket_fingerprint(state(spark, sf, _FEW_CHANGED), ["o_orderkey"], 64, portable=True)
    return changed_buckets(before, after)


# Values swapped between two shares of the table: same contents, other keys.
_SWAP_A = "select o_orderkey as k, o_custkey as v from {orders}"
_SWAP_B = "select o_orderkey as k, o_custkey + 0 as v from {orders} where o_orderstatus = 'P' union all select -o_orderkey - 1, o_custkey from {orders} where o_orderstatus <> 'P'"


@query(
    "changed_buckets_renamed_keys",
    f"""select coalesce(p.bucket, c.bucket) as bucket
        from ({fingerprint_sql(_SWAP_A, ('k',), ('v',), 16)}) p
        full join ({fingerprint_sql(_SWAP_B, ('k',), ('v',), 16)}) c on p.bucket = c.bucket
        where p.rows is distinct from c.rows or p.fingerprint is distinct from c.fingerprint""",
)
def _(spark, sf):
    before = bucket_fingerprint(state(spark, sf, _SWAP_A), ["k"], 16, portable=True)
    after = bucket_fingerprint(state(spark, sf, _SWAP_B), ["k"], 16, portable=True)
    return changed_buckets(before, after)


_T = "o_orderkey, o_orderstatus, o_orderpriority, o_totalprice, ins_ts, upd_ts"
_GONE = f"select * from ({ORD_TIMES_PREV}) p where not exists (select 1 from ({ORD_TIMES_CURR}) c where c.o_orderkey = p.o_orderkey)"
_SINCE = f"cast('{WATERMARK}' as #ts)"
TIMESTAMP_DELTA_SQL = f"""
select {_T}, soft_delete, {audit_sql(RUN_TS)} from (
  select {_T}, 0 as soft_delete from ({ORD_TIMES_CURR}) a where ins_ts > {_SINCE} or upd_ts > {_SINCE}
  union all select {_T}, 1 from ({_GONE}) b) t"""


@query("timestamp_delta_orders", TIMESTAMP_DELTA_SQL)
def _(spark, sf):
    snapshot = flag(state(spark, sf, ORD_TIMES_PREV), deleted=False)
    return timestamp_delta(
        snapshot, state(spark, sf, ORD_TIMES_CURR), ["o_orderkey"], ["ins_ts", "upd_ts"], WATERMARK, RUN_TS
    )


@query(
    "timestamp_snapshot_orders",
    f"select {_T}, 0 as soft_delete from ({ORD_TIMES_CURR}) a union all select {_T}, 1 from ({_GONE}) b",
)
def _(spark, sf):
    # An earlier tombstone must not be carried over.
    prev = state(spark, sf, ORD_TIMES_PREV)
    old = prev.withColumn("o_orderkey", -F.col("o_orderkey") - 1)
    snapshot = flag(prev, deleted=False).unionByName(flag(old, deleted=True))
    return timestamp_snapshot(snapshot, state(spark, sf, ORD_TIMES_CURR), ["o_orderkey"])


@query(
    "union_drift_orders",
    """select o_orderkey, o_totalprice, o_orderpriority, cast(null as string) as channel from {orders}
       where o_orderstatus = 'F'
       union all select o_orderkey, o_totalprice, cast(null as string), o_orderpriority from {orders}
       where o_orderstatus <> 'F'""",
)
def _(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_orderpriority", "o_orderstatus")
    old = orders.where("o_orderstatus = 'F'").drop("o_orderstatus")
    new = orders.where("o_orderstatus <> 'F'").select(
        "o_totalprice", F.col("o_orderkey").alias("O_ORDERKEY"), F.col("o_orderpriority").alias("channel")
    )
    return union_drift(old, new)


@query("add_columns_customer", "select *, cast(null as string) as c_phone, cast(null as bigint) as c_points from {customer}")
def _(spark, sf):
    return add_columns(table(spark, sf, "customer"), {"c_phone": "string", "C_NAME": "string", "c_points": "bigint"})


@query("drift_added_to_target", "select p_partkey, p_name, p_brand, cast(null as string) as p_type, cast(null as int) as p_size, cast(null as double) as p_retailprice from {part}")
def _(spark, sf):
    source = table(spark, sf, "part")
    target = source.select("p_partkey", "p_name", "p_brand")
    return add_columns(target, schema_drift(source, target).added)


@query("drop_column_part", "select p_partkey, p_name, p_brand, p_type, p_retailprice from {part}")
def _(spark, sf):
    return drop_column(table(spark, sf, "part"), "P_SIZE")


@query("align_to_schema_supplier", "select s_suppkey, s_name, cast(s_acctbal as decimal(18,2)) as s_acctbal, cast(null as string) as s_phone from {supplier}")
def _(spark, sf):
    from pyspark.sql import types as T

    schema = T.StructType.fromDDL("s_suppkey BIGINT, s_name STRING, s_acctbal DECIMAL(18,2), s_phone STRING")
    return align_to(table(spark, sf, "supplier"), schema)

