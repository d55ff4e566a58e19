"""Latest rows, merges, files, whole runs, streams and control tables."""

from __future__ import annotations

from dataclasses import replace
from datetime import datetime

from pyspark.sql import functions as F

from checks.base import bucket_sql, query, scratch, state, table
from checks.changes import NEXT_SNAPSHOT_SQL, TIMESTAMP_DELTA_SQL, delta_sql
from checks.states import (
    CONV_CURR,
    CONV_PREV,
    FIRST_TS,
    ORD_COLUMNS,
    ORD_CURR,
    ORD_PREV,
    ORD_RAW,
    ORD_TARGET,
    ORD_TIMES_CURR,
    ORD_TIMES_PREV,
    RUN_TS,
    RUNS,
    WATERMARK,
)
from tidemark.control.runlog import (
    RunLog,
    control_view,
    last_watermarks,
    latest_run,
    log_end,
    log_start,
    lookback_watermarks,
    next_run_id,
    rollup_status,
    run_state,
    run_summary,
    with_rollup,
)
from tidemark.control.watermarks import WatermarkStore, upsert_watermarks, watermark_or_default
from tidemark.functions.hashing import hash_bucket
from tidemark.operators.delta import next_snapshot, snapshot_delta
from tidemark.operators.merge import (
    FLAG_IN_SOFT_DELETE,
    POLICIES,
    MergePolicy,
    latest_per_key,
    load_to_target,
    merge_delta,
    new_target,
    upsert,
)
from tidemark.plans.load import load_delta, merge_into, read_target
from tidemark.plans.snapshot_cdc import run_snapshot_cdc
from tidemark.plans.sync import sync_tables
from tidemark.plans.timestamp_cdc import run_timestamp_cdc
from tidemark.sinks.datasets import append_raw, consume_raw, read_raw, write_delta
from tidemark.sinks.generations import GenerationStore
from tidemark.sources.files import file_counts, ingest_files, load_differences, validate_load
from tidemark.sources.ledger import FileLedger
from tidemark.sources.paths import TablePaths, run_name
from tidemark.sources.tables import read_snapshot
from tidemark.specs import TableSpec, read_specs
from tidemark.streaming.files import ingest_stream, land_stream, stream_merge

MERGE_TS = "2024-01-05 00:00:00"
DATA = ORD_COLUMNS[1:]
MARKS = ("is_deleted", "insert_ts", "update_ts", "delete_ts")

# -- latest row per key ---------------------------------------------------

_RANKED = ", ".join(
    ["load_ts desc nulls last", "soft_delete desc nulls last", *[f"{c} desc nulls last" for c in DATA]]
)
LATEST_SQL = f"""
select {', '.join(ORD_COLUMNS)}, soft_delete, load_ts from (
  select *, row_number() over (partition by o_orderkey order by {_RANKED}) as rn from ({ORD_RAW}) r) t
where rn = 1"""


@query("latest_per_key_orders", LATEST_SQL)
def _(spark, sf):
    return latest_per_key(state(spark, sf, ORD_RAW), ["o_orderkey"])


_LINE_REST = "l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus"


@query(
    "latest_per_key_lineitem",
    f"""select l_orderkey, l_linenumber, l_shipdate, {_LINE_REST} from (
        select *, row_number() over (partition by l_orderkey, l_linenumber order by l_shipdate desc nulls last,
          {', '.join(f'{c} desc nulls last' for c in _LINE_REST.split(', '))}) as rn from {{lineitem}}) t where rn = 1""",
)
def _(spark, sf):
    return latest_per_key(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"], ["l_shipdate"])


# Three keys only, each with a third of the rows.
@query(
    "latest_per_hot_key_lineitem",
    """select l_returnflag, l_orderkey, l_linenumber, l_shipdate from (
        select *, row_number() over (partition by l_returnflag order by l_shipdate desc, l_orderkey desc,
          l_linenumber desc) as rn from {lineitem}) t where rn = 1""",
)
def _(spark, sf):
    narrow = table(spark, sf, "lineitem").select("l_returnflag", "l_orderkey", "l_linenumber", "l_shipdate")
    return latest_per_key(narrow, ["l_returnflag"], ["l_shipdate"])


@query(
    "latest_turn_per_conversation",
    """select conv_id, turn, role, text from (select *, row_number() over
        (partition by conv_id order by turn desc) as rn from {conversations}) t where rn = 1""",
)
def _(spark, sf):
    return latest_per_key(table(spark, sf, "conversations"), ["conv_id"], ["turn"])


# -- merges ---------------------------------------------------------------


def merge_sql(policy: MergePolicy, target: str = ORD_TARGET, latest: str = LATEST_SQL, now: str = MERGE_TS) -> str:
    """A merge with soft deletes as a full join and CASE expressions."""
    flag, ins, upd, dele = policy.deleted_column, policy.insert_ts, policy.update_ts, policy.delete_ts
    ts = f"cast('{now}' as #ts)"
    null_ts = "cast(null as #ts)"
    is_new, live, gone = "t.o_orderkey is null", "s.soft_delete = 0", "s.soft_delete = 1"
    data = ", ".join(f"case when {live} then s.{c} else t.{c} end as {c}" for c in DATA)
    return f"""
select coalesce(t.o_orderkey, s.o_orderkey) as o_orderkey, {data},
  case when {is_new} then {0 if policy.flag_inserts else 'null'}
       when {gone} then 1 {f'when {live} then 0' if policy.revive else ''} else t.{flag} end as {flag},
  case when {is_new} then {ts} else t.{ins} end as {ins},
  case when {is_new} then {ts if policy.update_ts_on_insert else null_ts}
       when {live} or {gone} then {ts} else t.{upd} end as {upd},
  case when {is_new} then {null_ts} when {gone} then {ts}
       {f'when {live} then {null_ts}' if policy.clear_delete_ts else ''} else t.{dele} end as {dele}
from ({target}) t full join ({latest}) s on t.o_orderkey = s.o_orderkey
where t.o_orderkey is not null or {live}"""


_FLAG_TARGET = f"""
select {', '.join(ORD_COLUMNS)}, is_deleted as soft_delete, insert_ts as __insert_timestamp,
       update_ts as __update_timestamp, delete_ts as __delete_timestamp from ({ORD_TARGET}) t"""

for _name, _policy in POLICIES.items():
    _target = _FLAG_TARGET if _policy is FLAG_IN_SOFT_DELETE else ORD_TARGET

    @query(f"merge_{_name}_orders", merge_sql(_policy, _target))
    def _(spark, sf, policy=_policy, target=_target):
        return merge_delta(state(spark, sf, target), state(spark, sf, ORD_RAW), ["o_orderkey"], policy, MERGE_TS)


@query("load_to_target_orders", merge_sql(POLICIES["resurrect"]))
def _(spark, sf):
    delta = state(spark, sf, ORD_RAW)
    return load_to_target(delta, state(spark, sf, ORD_TARGET), ["o_orderkey"], "Resurrect", MERGE_TS)


_EMPTY = f"select * from ({ORD_TARGET}) e where false"


@query("merge_into_empty_target_orders", merge_sql(POLICIES["resurrect"], _EMPTY))
def _(spark, sf):
    return new_target(state(spark, sf, ORD_RAW), ["o_orderkey"], run_ts=MERGE_TS)


@query(
    "merge_key_only_nations",
    f"""select n_nationkey, 0 as is_deleted, case when n_regionkey < 2 then cast('{FIRST_TS}' as #ts)
        else cast('{MERGE_TS}' as #ts) end as insert_ts,
        case when n_regionkey = 0 then cast('{FIRST_TS}' as #ts) else cast('{MERGE_TS}' as #ts) end as update_ts,
        cast(null as #ts) as delete_ts from {{nation}}""",
)
def _(spark, sf):
    nations = table(spark, sf, "nation")
    first = F.lit(FIRST_TS).cast("timestamp_ntz")
    target = nations.where("n_regionkey < 2").select(
        "n_nationkey",
        F.lit(0).alias("is_deleted"),
        first.alias("insert_ts"),
        first.alias("update_ts"),
        F.lit(None).cast("timestamp_ntz").alias("delete_ts"),
    )
    delta = nations.where("n_regionkey > 0").select(
        "n_nationkey", F.lit(0).alias("soft_delete"), F.lit(RUN_TS).cast("timestamp_ntz").alias("load_ts")
    )
    return merge_delta(target, delta, ["n_nationkey"], run_ts=MERGE_TS)


@query(
    "upsert_customers",
    """select c_custkey, c_name, case when c_mktsegment = 'BUILDING' then 0.0 else c_acctbal end as c_acctbal
       from {customer}""",
)
def _(spark, sf):
    customers = table(spark, sf, "customer")
    old = customers.where("c_mktsegment <> 'MACHINERY'").select("c_custkey", "c_name", "c_acctbal")
    new = customers.where("c_mktsegment in ('BUILDING', 'MACHINERY')").select(
        "c_custkey", "c_name", F.when(F.col("c_mktsegment") == "BUILDING", 0.0).otherwise(F.col("c_acctbal")).alias("c_acctbal")
    )
    return upsert(old, new, ["c_custkey"])


# -- sinks ----------------------------------------------------------------


@query(
    "write_delta_by_bucket",
    f"select t.*, {bucket_sql(8, 'o_orderkey')} as bucket from ({delta_sql('orders')}) t",
)
def _(spark, sf):
    path = scratch(spark)
    delta = snapshot_delta(state(spark, sf, ORD_PREV), state(spark, sf, ORD_CURR), ["o_orderkey"], RUN_TS)
    write_delta(hash_bucket(delta.drop("hash_val"), ["o_orderkey"], 8, portable=True), path)
    return spark.read.parquet(path)


@query("snapshot_written_and_read", NEXT_SNAPSHOT_SQL)
def _(spark, sf):
    base = scratch(spark)
    assert read_snapshot(spark, f"{base}/snapshot") is None
    from checks.changes import _SNAPSHOT

    state(spark, sf, _SNAPSHOT).write.parquet(f"{base}/snapshot")
    snapshot = read_snapshot(spark, f"{base}/snapshot")
    after = next_snapshot(snapshot, state(spark, sf, ORD_CURR), ["o_orderkey"]).drop("hash_val")
    after.write.parquet(f"{base}/snapshot-next")
    return read_snapshot(spark, f"{base}/snapshot-next")


@query(
    "append_raw_orders",
    f"""select 'first' as run, o_orderkey, o_totalprice from ({ORD_PREV}) a
        union all select 'second', o_orderkey, o_totalprice from ({ORD_CURR}) b""",
)
def _(spark, sf):
    path = scratch(spark)
    append_raw(state(spark, sf, ORD_PREV), path, "first")
    append_raw(state(spark, sf, ORD_CURR), path, "second")
    return read_raw(spark, path, ["first", "second"]).select("run", "o_orderkey", "o_totalprice")


@query("consume_raw_orders", f"select o_orderkey, o_totalprice from ({ORD_CURR}) b")
def _(spark, sf):
    path = scratch(spark)
    append_raw(state(spark, sf, ORD_PREV), path)
    consume_raw(spark, path)
    append_raw(state(spark, sf, ORD_CURR), path)
    return read_raw(spark, path).select("o_orderkey", "o_totalprice")


# -- files ----------------------------------------------------------------


#: Every order is in one of these, whatever its status.
_PARTS = {
    "O": "o_orderstatus <=> 'O'",
    "P": "o_orderstatus <=> 'P'",
    "other": "o_orderstatus is null or o_orderstatus not in ('O', 'P')",
}
_PART_SQL = "case when o_orderstatus in ('O', 'P') then o_orderstatus else 'other' end"


def _landed(spark, sf):
    """Current orders as files in a tree: one directory per status, one of them with a column more."""
    base = scratch(spark)
    orders = state(spark, sf, ORD_CURR)
    for value, is_here in _PARTS.items():
        part = orders.where(is_here)
        if value == "P":
            part = part.withColumn("hash_val", F.md5(F.col("o_orderpriority")))
        part.write.parquet(f"{base}/run-1/{value}")
    orders.select("o_orderkey").write.csv(f"{base}/run-1/notes")
    return base


@query("ingest_files_by_name", ORD_CURR)
def _(spark, sf):
    base = _landed(spark, sf)
    return ingest_files(spark, base, state(spark, sf, ORD_PREV).schema)


@query("ingest_files_merged_schema", f"select t.*, cast('{RUN_TS}' as #ts) as load_ts from ({ORD_CURR}) t")
def _(spark, sf):
    return ingest_files(spark, _landed(spark, sf), merge_schema=True, drop=["hash_val"], load_ts=RUN_TS)


@query(
    "ingest_files_enforced_schema",
    f"select o_orderkey, cast(o_totalprice as double) as o_totalprice, cast(null as string) as o_comment from ({ORD_CURR}) t",
)
def _(spark, sf):
    from pyspark.sql import types as T

    schema = T.StructType.fromDDL("o_orderkey BIGINT, O_TOTALPRICE DECIMAL(18,2), o_comment STRING")
    rows = ingest_files(spark, _landed(spark, sf), schema)
    return rows.select("o_orderkey", F.col("O_TOTALPRICE").cast("double").alias("o_totalprice"), "o_comment")


@query("ingest_files_case_sensitive", f"select o_orderkey, cast(null as string) as O_ORDERSTATUS from ({ORD_CURR}) t")
def _(spark, sf):
    from pyspark.sql import types as T

    schema = T.StructType.fromDDL("o_orderkey BIGINT, O_ORDERSTATUS STRING")
    return ingest_files(spark, _landed(spark, sf), schema, match="sensitive")


@query(
    "validate_load_by_directory",
    f"select {_PART_SQL} as directory, count(*) as rows from ({ORD_CURR}) t group by 1",
)
def _(spark, sf):
    raw, files = _landed_raw(spark, sf, "true")
    validate_load(raw, files, file_column="file_name")
    directory = F.regexp_extract("file", "/run-1/([^/]+)/", 1)
    return file_counts(raw, "file_name").groupBy(directory.alias("directory")).agg(F.sum("rows").alias("rows"))


def _landed_raw(spark, sf, where):
    """A landing table of the files' rows that satisfy ``where``, and the row counts of the files themselves."""
    base, schema = _landed(spark, sf), state(spark, sf, ORD_PREV).schema
    append_raw(ingest_files(spark, base, schema, file_name="file_name").where(where), f"{base}/raw", "load")
    return read_raw(spark, f"{base}/raw", ["load"]), file_counts(ingest_files(spark, f"{base}/run-1", schema))


@query(
    "load_differences_file_short",
    f"""select {_PART_SQL} as directory, count(case when o_orderpriority <> '1-URGENT' then 1 end) as rows, count(*) as want
        from ({ORD_CURR}) t group by 1""",
)
def _(spark, sf):
    raw, files = _landed_raw(spark, sf, "o_orderpriority <> '1-URGENT'")
    short = load_differences(raw, files, "file_name")
    directory = F.regexp_extract("file", "/run-1/([^/]+)/", 1)
    return short.groupBy(directory.alias("directory")).agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"), F.sum("want").alias("want")
    )


@query(
    "load_delta_orders",
    merge_sql(POLICIES["resurrect"], _EMPTY, now=MERGE_TS),
)
def _(spark, sf):
    base = scratch(spark)
    # One directory per load, as deltas arrive.
    raw = state(spark, sf, ORD_RAW)
    for number, day in enumerate(sorted(r["load_ts"] for r in raw.select("load_ts").distinct().collect())):
        raw.where(F.col("load_ts") == F.lit(day)).write.parquet(f"{base}/in/load-{number}")
    store = GenerationStore(spark, f"{base}/target")
    load_delta(spark, f"{base}/in", store, f"{base}/raw", ["o_orderkey"], run_ts=MERGE_TS, buckets=8)
    return store.read()


# -- streams --------------------------------------------------------------


@query(
    "ingest_ledger_second_load",
    f"select o_orderkey, 1 as load from ({ORD_PREV}) a union all select o_orderkey, 2 from ({ORD_CURR}) b",
)
def _(spark, sf):
    # the first file is still there at the second load, which takes the other one alone
    base = scratch(spark)
    store, ledger = GenerationStore(spark, f"{base}/target"), FileLedger(spark, f"{base}/ledger")
    landed = []
    for load, (rows, run_ts) in enumerate(((ORD_PREV, FIRST_TS), (ORD_CURR, RUN_TS)), 1):
        part = state(spark, sf, rows).withColumn("soft_delete", F.lit(0))
        part.write.parquet(f"{base}/in/load-{load}")
        load_delta(spark, f"{base}/in", store, f"{base}/raw", ["o_orderkey"], run_ts=run_ts, empty_raw=False, buckets=4, ledger=ledger)
        landed.append(read_raw(spark, f"{base}/raw", [run_name(run_ts)]).select("o_orderkey", F.lit(load).alias("load")))
    return landed[0].unionByName(landed[1])


@query(
    "load_names_damaged_files",
    f"""select o_orderkey, cast(null as string) as file, cast(null as string) as reason from ({ORD_CURR}) c
        union all select null, 'broken.parquet', 'no whole Parquet file' union all select null, 'nothing.parquet', 'no bytes'""",
)
def _(spark, sf):
    # one file holds words of the table instead of Parquet, one nothing; a third one is whole and has no rows
    base = scratch(spark)
    store = GenerationStore(spark, f"{base}/target")
    part = state(spark, sf, ORD_CURR).withColumn("soft_delete", F.lit(0))
    part.write.parquet(f"{base}/in/a")
    part.limit(0).coalesce(1).write.parquet(f"{base}/in/b")
    words = " ".join(r[0] for r in part.select("o_orderpriority").distinct().orderBy("o_orderpriority").collect())
    for name, content in (("broken", words), ("nothing", "")):
        place = spark._jvm.org.apache.hadoop.fs.Path(f"{base}/in/{name}.parquet")
        out = place.getFileSystem(spark._jsc.hadoopConfiguration()).create(place)
        out.write(bytearray(content.encode()))
        out.close()
    load_delta(
        spark, f"{base}/in", store, f"{base}/raw", ["o_orderkey"], run_ts=RUN_TS, buckets=4, schema=part.schema, skipped=f"{base}/skipped"
    )
    skipped = spark.read.parquet(f"{base}/skipped")
    none = F.lit(None).cast("string")
    names = skipped.select(F.lit(None).cast("long").alias("o_orderkey"), F.substring_index("file", "/", -1).alias("file"), "reason")
    return store.read().select("o_orderkey", none.alias("file"), none.alias("reason")).unionByName(names)


@query("ingest_stream_load_once", f"select o_orderkey, o_totalprice, 1 as times from ({ORD_CURR}) t")
def _(spark, sf):
    base = scratch(spark)
    orders = state(spark, sf, ORD_CURR).select("o_orderkey", "o_totalprice", "o_orderstatus")
    for value, is_here in _PARTS.items():
        part = orders.where(is_here).drop("o_orderstatus")
        part.write.parquet(f"{base}/in/{value}")
        stream = ingest_stream(spark, f"{base}/in", part.schema)
        land_stream(stream, f"{base}/landed", f"{base}/checkpoint").awaitTermination()
    landed = spark.read.parquet(f"{base}/landed")
    return landed.groupBy("o_orderkey", "o_totalprice").agg(F.count(F.lit(1)).cast("int").alias("times"))


@query(
    "stream_merge_orders",
    merge_sql(POLICIES["resurrect"], f"{merge_sql(POLICIES['resurrect'], _EMPTY, latest=f'select * from ({ORD_RAW}) a where load_ts = cast({chr(39)}{FIRST_TS}{chr(39)} as #ts)', now=MERGE_TS)}",
              latest=LATEST_SQL.replace(f"({ORD_RAW}) r", f"({ORD_RAW}) r where load_ts > cast('{FIRST_TS}' as #ts)")),
)
def _(spark, sf):
    base = scratch(spark)
    raw = state(spark, sf, ORD_RAW)
    store = GenerationStore(spark, f"{base}/target")
    is_first = F.col("load_ts") == F.lit(FIRST_TS).cast("timestamp_ntz")
    for number, part in enumerate((raw.where(is_first), raw.where(~is_first))):
        part.write.parquet(f"{base}/in/load-{number}")
        stream = ingest_stream(spark, f"{base}/in", part.schema)
        stream_merge(
            stream, store, ["o_orderkey"], f"{base}/checkpoint", run_ts=MERGE_TS, buckets=8
        ).awaitTermination()
    return store.read()


def _merged_in_order(loads):
    """The target after merging the loads of ``ORD_RAW`` one after another, each reduced to its latest rows."""
    target = _EMPTY
    for load in loads:
        own = LATEST_SQL.replace(f"({ORD_RAW}) r", f"({ORD_RAW}) r where load_ts = cast('{load}' as #ts)")
        target = merge_sql(POLICIES["resurrect"], target, own)
    return target


_LOADS = [f"2024-01-0{day} 00:00:00" for day in (1, 2, 3, 4)]


@query("stream_merge_out_of_order_orders", _merged_in_order(_LOADS))
def _(spark, sf):
    # the last load arrives first: revivals before the deletions, these before what they delete
    base = scratch(spark)
    raw = state(spark, sf, ORD_RAW)
    store = GenerationStore(spark, f"{base}/target")
    ordered = replace(POLICIES["resurrect"], order="load_ts")
    for load in reversed(_LOADS):
        part = raw.where(F.col("load_ts") == F.lit(load).cast("timestamp_ntz"))
        part.write.parquet(f"{base}/in/load-{load[:10]}")
        stream = ingest_stream(spark, f"{base}/in", part.schema)
        stream_merge(
            stream, store, ["o_orderkey"], f"{base}/checkpoint", ordered, run_ts=MERGE_TS, buckets=8
        ).awaitTermination()
    return read_target(store)


# -- whole runs -----------------------------------------------------------


_CDC_TARGET = f"""
select o_orderkey, {', '.join(DATA)}, 0 as is_deleted, cast('{FIRST_TS}' as #ts) as insert_ts,
       cast('{FIRST_TS}' as #ts) as update_ts, cast(null as #ts) as delete_ts from ({ORD_PREV}) t"""
SNAPSHOT_CDC_SQL = merge_sql(
    POLICIES["resurrect"],
    _CDC_TARGET,
    f"select {', '.join(ORD_COLUMNS)}, soft_delete from ({delta_sql('orders')}) d",
    RUN_TS,
)


def snapshot_cdc_target(spark, sf):
    """Two runs over the two states of orders; the merged target."""
    paths = TablePaths(scratch(spark), "shop", "main", "orders")
    for states, run_ts in ((ORD_PREV, FIRST_TS), (ORD_CURR, RUN_TS)):
        run_snapshot_cdc(spark, state(spark, sf, states), ["o_orderkey"], paths, run_ts, buckets=8)
    return GenerationStore(spark, paths.target).read()


@query("snapshot_cdc_orders", SNAPSHOT_CDC_SQL)
def _(spark, sf):
    return snapshot_cdc_target(spark, sf)


@query("snapshot_cdc_delta_conversations", delta_sql("conversations"))
def _(spark, sf):
    paths = TablePaths(scratch(spark), "shop", "main", "conversations")
    for states, run_ts in ((CONV_PREV, FIRST_TS), (CONV_CURR, RUN_TS)):
        result = run_snapshot_cdc(
            spark, state(spark, sf, states), ["conv_id", "turn"], paths, run_ts, buckets=4, policy=None
        )
    return spark.read.parquet(result.delta_path).drop("hash_val", "bucket")


@query(
    "snapshot_generations_orders",
    f"""select 1 as generation, {', '.join(ORD_COLUMNS)}, 0 as soft_delete from ({ORD_PREV}) a
        union all select 2, {', '.join(ORD_COLUMNS)}, 0 from ({ORD_CURR}) b
        union all select 2, {', '.join(ORD_COLUMNS)}, 1 from (
          select p.* from ({ORD_PREV}) p left join ({ORD_CURR}) c on p.o_orderkey = c.o_orderkey
          where c.o_orderkey is null or p.o_totalprice <> c.o_totalprice
             or p.o_orderstatus is distinct from c.o_orderstatus) g""",
)
def _(spark, sf):
    paths = TablePaths(scratch(spark), "shop", "main", "orders")
    for states, run_ts in ((ORD_PREV, FIRST_TS), (ORD_CURR, RUN_TS)):
        run_snapshot_cdc(spark, state(spark, sf, states), ["o_orderkey"], paths, run_ts, buckets=8, policy=None)
    store = GenerationStore(spark, paths.snapshot)
    parts = [store.read_snapshot(g).withColumn("generation", F.lit(g)) for g in store.generations()]
    return parts[0].unionByName(parts[1]).drop("hash_val")


@query(
    "snapshot_after_expire_orders",
    f"""select {', '.join(ORD_COLUMNS)}, 0 as soft_delete from ({ORD_CURR}) b
        union all select {', '.join(ORD_COLUMNS)}, 1 from (
          select p.* from ({ORD_PREV}) p left join ({ORD_CURR}) c on p.o_orderkey = c.o_orderkey
          where c.o_orderkey is null or p.o_totalprice <> c.o_totalprice
             or p.o_orderstatus is distinct from c.o_orderstatus) g
        union all select {', '.join(ORD_COLUMNS)}, 1 from ({ORD_CURR}) c
          where not exists (select 1 from ({ORD_PREV}) p where p.o_orderkey = c.o_orderkey)
        union all select {', '.join(ORD_COLUMNS)}, 1 from (
          select c.* from ({ORD_CURR}) c join ({ORD_PREV}) p on p.o_orderkey = c.o_orderkey
          where p.o_totalprice <> c.o_totalprice or p.o_orderstatus is distinct from c.o_orderstatus) g""",
)
def _(spark, sf):
    # there and back and there again, with all but the last generation expired twice
    paths = TablePaths(scratch(spark), "shop", "main", "orders")
    store = GenerationStore(spark, paths.snapshot)
    for day, states in enumerate((ORD_PREV, ORD_CURR, ORD_PREV, ORD_CURR), 1):
        run_snapshot_cdc(spark, state(spark, sf, states), ["o_orderkey"], paths, f"2024-01-0{day}", buckets=8, policy=None)
        store.expire(1)
        store.expire(1)
    # what the third run replaced the second one's rows with is in history once, that of the first and the last alike
    return store.read_snapshot().drop("hash_val").distinct()


@query(
    "snapshot_cdc_bucket_column_orders",
    f"""select c.o_orderkey, c.o_orderstatus as source_bucket, 0 as soft_delete from ({ORD_CURR}) c
        left join ({ORD_PREV}) p on p.o_orderkey = c.o_orderkey
        where p.o_orderkey is null or p.o_orderstatus is distinct from c.o_orderstatus
        union all select p.o_orderkey, p.o_orderstatus, 1 from ({ORD_PREV}) p
        where not exists (select 1 from ({ORD_CURR}) c where c.o_orderkey = p.o_orderkey)""",
)
def _(spark, sf):
    paths = TablePaths(scratch(spark), "shop", "main", "orders")
    for states, run_ts in ((ORD_PREV, FIRST_TS), (ORD_CURR, RUN_TS)):
        rows = state(spark, sf, states).select("o_orderkey", F.col("o_orderstatus").alias("bucket"))
        result = run_snapshot_cdc(spark, rows, ["o_orderkey"], paths, run_ts, buckets=8, policy=None)
    return spark.read.parquet(result.delta_path).select("o_orderkey", "source_bucket", "soft_delete")


@query("snapshot_cdc_null_column_orders", f"select o_orderkey, soft_delete from ({delta_sql('orders')}) d")
def _(spark, sf):
    # the second state brings a column that is NULL everywhere, which is no change
    paths = TablePaths(scratch(spark), "shop", "main", "orders")
    run_snapshot_cdc(spark, state(spark, sf, ORD_PREV), ["o_orderkey"], paths, FIRST_TS, buckets=8, policy=None)
    rows = state(spark, sf, ORD_CURR).withColumn("o_comment", F.lit(None).cast("string"))
    result = run_snapshot_cdc(spark, rows, ["o_orderkey"], paths, RUN_TS, buckets=8, policy=None)
    return spark.read.parquet(result.delta_path).select("o_orderkey", "soft_delete")


@query(
    "timestamp_cdc_named_like_audit_orders",
    f"""select o_orderkey, ins_ts as source_insert_ts, upd_ts as source_update_ts, soft_delete,
        (select greatest(max(ins_ts), max(upd_ts)) from ({TIMESTAMP_DELTA_SQL}) w where soft_delete = 0) as watermark
        from ({TIMESTAMP_DELTA_SQL}) d""",
)
def _(spark, sf):
    paths = TablePaths(scratch(spark), "shop", "main", "orders")
    since = datetime.fromisoformat(WATERMARK)
    names = {"ins_ts": "insert_ts", "upd_ts": "update_ts"}
    for states, run_ts in ((ORD_TIMES_PREV, FIRST_TS), (ORD_TIMES_CURR, RUN_TS)):
        result = run_timestamp_cdc(
            spark, state(spark, sf, states).withColumnsRenamed(names), ["o_orderkey"], list(names.values()), since, paths,
            run_ts, buckets=8,
        )
    delta = spark.read.parquet(result.delta_path).select("o_orderkey", "source_insert_ts", "source_update_ts", "soft_delete")
    return delta.withColumn("watermark", F.lit(result.watermark).cast("timestamp_ntz"))


# -- columns that change their type ----------------------------------------

_RANK = "substr(o_orderpriority, 1, 1)"
# A rank that was a number becomes a text, first for one status and then for some finished orders as well.
RETYPED = (
    f"select o_orderkey, cast({_RANK} as int) as o_rank from {{orders}}",
    f"select o_orderkey, case when o_orderstatus = 'P' then 'unknown' else {_RANK} end as o_rank from {{orders}}",
    f"""select o_orderkey, case when o_orderstatus = 'P' then 'unknown'
        when o_orderstatus = 'F' and o_orderpriority = '5-LOW' then 'low' else {_RANK} end as o_rank from {{orders}}""",
)


@query(
    "snapshot_cdc_retyped_orders",
    f"""select 'snapshot' as place, o_orderkey, o_rank, 0 as deleted from ({RETYPED[2]}) c
        union all select 'snapshot', o_orderkey, {_RANK}, 1 from {{orders}}
          where o_orderstatus = 'P' or (o_orderstatus = 'F' and o_orderpriority = '5-LOW')
        union all select 'target', o_orderkey, o_rank, 0 from ({RETYPED[2]}) c""",
)
def _(spark, sf):
    paths = TablePaths(scratch(spark), "shop", "main", "orders")
    for day, text in enumerate(RETYPED, 1):
        run_snapshot_cdc(spark, state(spark, sf, text), ["o_orderkey"], paths, f"2024-01-0{day}", buckets=8)
    snapshot = GenerationStore(spark, paths.snapshot).read_snapshot()
    target = GenerationStore(spark, paths.target).read()
    named = lambda rows, place, flag: rows.select(F.lit(place).alias("place"), "o_orderkey", "o_rank", F.col(flag).alias("deleted"))
    return named(snapshot, "snapshot", "soft_delete").unionByName(named(target, "target", "is_deleted"))


# An integer becomes a double whose values are mostly the same: only the real changes are delivered.
WIDENED = (
    "select o_orderkey, cast(floor(o_totalprice / 1000) as int) as o_units from {orders}",
    """select o_orderkey, case when o_orderstatus = 'P' then floor(o_totalprice / 1000) + 0.25e0
       else cast(floor(o_totalprice / 1000) as double) end as o_units from {orders}""",
)


@query(
    "snapshot_cdc_widened_number_orders",
    f"select o_orderkey, o_units, soft_delete from (select *, 0 as soft_delete from ({WIDENED[1]}) c) d where o_units <> floor(o_units)",
)
def _(spark, sf):
    paths = TablePaths(scratch(spark), "shop", "main", "orders")
    for day, text in enumerate(WIDENED, 1):
        result = run_snapshot_cdc(spark, state(spark, sf, text), ["o_orderkey"], paths, f"2024-01-0{day}", buckets=8, policy=None)
    return spark.read.parquet(result.delta_path).select("o_orderkey", "o_units", "soft_delete")


@query(
    "timestamp_cdc_retyped_orders",
    f"""select o_orderkey, case when o_orderstatus = 'P' then 'unknown' else {_RANK} end as o_rank, 0 as is_deleted
        from {{orders}} where not (o_orderstatus = 'F' and o_orderpriority = '5-LOW')
        union all select o_orderkey, {_RANK}, 1 from {{orders}} where o_orderstatus = 'F' and o_orderpriority = '5-LOW'""",
)
def _(spark, sf):
    # every order is delivered first; then one status with a new type and time, while others are gone
    paths = TablePaths(scratch(spark), "shop", "main", "orders")
    first = state(spark, sf, f"select o_orderkey, cast({_RANK} as int) as o_rank, o_orderdate as at from {{orders}}")
    second = state(
        spark, sf,
        f"""select o_orderkey, case when o_orderstatus = 'P' then 'unknown' else {_RANK} end as o_rank,
            case when o_orderstatus = 'P' then cast('2030-01-01' as #ts) else o_orderdate end as at
            from {{orders}} where not (o_orderstatus = 'F' and o_orderpriority = '5-LOW')""",
    )
    for rows, since, run_ts in ((first, "1900-01-01", FIRST_TS), (second, "2029-01-01", RUN_TS)):
        run_timestamp_cdc(spark, rows, ["o_orderkey"], ["at"], datetime.fromisoformat(since), paths, run_ts, buckets=8, trust_timestamps=True)
    return GenerationStore(spark, paths.target).read().select("o_orderkey", "o_rank", "is_deleted")


_UNITS = "cast(floor(o_totalprice / 1000) as int)"
_PRICE = "cast(o_totalprice as decimal(12,2))"


@query(
    "merge_widened_value_orders",
    f"""select o_orderkey,
        case when o_orderpriority = '1-URGENT' then 0 when o_orderstatus = 'P' then {_UNITS} + 0.75e0 else {_UNITS} end as o_units,
        case when o_orderpriority = '1-URGENT' then {_PRICE} when o_orderstatus = 'P' then {_PRICE} + 0.0125 else {_PRICE} end as o_price,
        0 as is_deleted from {{orders}}""",
)
def _(spark, sf):
    # an integer and a decimal meet a double and more decimals, and are delivered once more as they were
    store = GenerationStore(spark, scratch(spark))
    loads = (
        f"select o_orderkey, {_UNITS} as o_units, {_PRICE} as o_price from {{orders}}",
        f"select o_orderkey, {_UNITS} + 0.75e0 as o_units, cast({_PRICE} + 0.0125 as decimal(14,4)) as o_price from {{orders}} where o_orderstatus = 'P'",
        f"select o_orderkey, 0 as o_units, {_PRICE} as o_price from {{orders}} where o_orderpriority = '1-URGENT'",
    )
    for day, text in enumerate(loads, 1):
        stamp = F.lit(f"2024-01-0{day}").cast("timestamp_ntz")
        delta = state(spark, sf, text).withColumns({"soft_delete": F.lit(0), "load_ts": stamp})
        merge_into(store, delta, ["o_orderkey"], run_ts=f"2024-01-0{day}", buckets=8)
    return store.read().select("o_orderkey", "o_units", "o_price", "is_deleted")


@query("merge_widened_key_orders", f"""
select cast(c_custkey as int) as c_custkey, c_name, case when c_nationkey = 7 then 0.0 else c_acctbal end as c_acctbal, 0 as is_deleted
from {{customer}}""")
def _(spark, sf):
    # the target's key is an int, that of the second delta a bigint
    store = GenerationStore(spark, scratch(spark))
    customers = table(spark, sf, "customer").select(F.col("c_custkey").cast("int").alias("c_custkey"), "c_name", "c_acctbal", "c_nationkey")
    wide = customers.where("c_nationkey = 7").withColumns({"c_custkey": F.col("c_custkey").cast("bigint"), "c_acctbal": F.lit(0.0)})
    for rows, run_ts in ((customers, FIRST_TS), (wide, RUN_TS)):
        delta = rows.drop("c_nationkey").withColumns({"soft_delete": F.lit(0), "load_ts": F.lit(run_ts).cast("timestamp_ntz")})
        merge_into(store, delta, ["c_custkey"], run_ts=run_ts, buckets=32)
    return store.read().select("c_custkey", "c_name", "c_acctbal", "is_deleted")


@query(
    "sync_two_pipelines_runs",
    """select concat('job-', o_orderstatus) as pipeline, 'orders' as source_table, count(*) as rows, 'SUCCESS' as status
       from {orders} group by o_orderstatus
       union all select concat('job-', o_orderstatus), 'events', (select count(*) from {events}), 'SUCCESS'
       from (select distinct o_orderstatus from {orders}) t""",
)
def _(spark, sf):
    # a pipeline for each status, all of which number their runs alike, in one log
    log = RunLog(spark, f"{scratch(spark)}/control/runs")
    counts = {r["o_orderstatus"]: r["count"] for r in table(spark, sf, "orders").groupBy("o_orderstatus").count().collect()}
    events = table(spark, sf, "events").count()
    for status in counts:
        for number, name in enumerate(("orders", "events"), 1):
            log.start(FIRST_TS, RunId=number, PipelineRunId=f"run-{status}", PipelineId=f"job-{status}", SourceTable=name, LoadType="SNAPSHOT")
    for status, rows in counts.items():
        for number, processed in enumerate((rows, events), 1):
            log.end(number, RUN_TS, "SUCCESS", PipelineRunId=f"run-{status}", RowsProcessed=processed)
    state = log.state()
    return state.select(
        F.col("PipelineId").alias("pipeline"), F.col("SourceTable").alias("source_table"), F.col("RowsProcessed").alias("rows"), F.col("Status").alias("status")
    )


_TIMES = "o_orderkey, o_orderstatus, o_orderpriority, o_totalprice, ins_ts, upd_ts"


@query("timestamp_cdc_delta_orders", TIMESTAMP_DELTA_SQL)
def _(spark, sf):
    paths = TablePaths(scratch(spark), "shop", "main", "orders")
    since = datetime.fromisoformat(WATERMARK)
    for states, run_ts in ((ORD_TIMES_PREV, FIRST_TS), (ORD_TIMES_CURR, RUN_TS)):
        result = run_timestamp_cdc(
            spark, state(spark, sf, states), ["o_orderkey"], ["ins_ts", "upd_ts"], since, paths, run_ts,
            buckets=8, policy=None,
        )
    return spark.read.parquet(result.delta_path).drop("bucket")


@query(
    "timestamp_cdc_snapshot_orders",
    f"""select {_TIMES}, 0 as soft_delete from ({ORD_TIMES_CURR}) a union all select {_TIMES}, 1 from (
        select * from ({ORD_TIMES_PREV}) p
        where not exists (select 1 from ({ORD_TIMES_CURR}) c where c.o_orderkey = p.o_orderkey)) b""",
)
def _(spark, sf):
    paths = TablePaths(scratch(spark), "shop", "main", "orders")
    since = datetime.fromisoformat(WATERMARK)
    for states, run_ts in ((ORD_TIMES_PREV, FIRST_TS), (ORD_TIMES_CURR, RUN_TS)):
        run_timestamp_cdc(
            spark, state(spark, sf, states), ["o_orderkey"], ["ins_ts", "upd_ts"], since, paths, run_ts,
            buckets=8, policy=None,
        )
    return GenerationStore(spark, paths.snapshot).read_snapshot(only_last_deletes=True)


@query("timestamp_cdc_trusted_delta_orders", TIMESTAMP_DELTA_SQL)
def _(spark, sf):
    paths = TablePaths(scratch(spark), "shop", "main", "orders")
    since = datetime.fromisoformat(WATERMARK)
    for states, run_ts in ((ORD_TIMES_PREV, FIRST_TS), (ORD_TIMES_CURR, RUN_TS)):
        result = run_timestamp_cdc(
            spark, state(spark, sf, states), ["o_orderkey"], ["ins_ts", "upd_ts"], since, paths, run_ts,
            buckets=8, policy=None, trust_timestamps=True,
        )
    return spark.read.parquet(result.delta_path).drop("bucket")


# Three tables in one go, two runs: orders by comparison, conversations by
# comparison on a composite key, events by timestamp.
_SYNC_STATES = {
    "orders": (ORD_PREV, ORD_CURR),
    "conversations": (CONV_PREV, CONV_CURR),
    "events": (
        "select * from {events} where ts <= cast('2024-01-20 00:00:00' as #ts)",
        "select * from {events} where event_type <> 'error' or ts > cast('2024-01-10 00:00:00' as #ts)",
    ),
}


@query(
    "sync_tables_two_runs",
    f"""
select 'orders' as source_table, 1 as run, 'SNAPSHOT' as load_type, (select count(*) from ({ORD_PREV}) a) as rows, 0 as deleted
union all select 'orders', 2, 'SNAPSHOT', (select count(*) from ({delta_sql('orders')}) a),
  (select count(*) from ({delta_sql('orders')}) a where soft_delete = 1)
union all select 'conversations', 1, 'SNAPSHOT', (select count(*) from ({CONV_PREV}) a), 0
union all select 'conversations', 2, 'SNAPSHOT', (select count(*) from ({delta_sql('conversations')}) a),
  (select count(*) from ({delta_sql('conversations')}) a where soft_delete = 1)
union all select 'events', 1, 'TIMESTAMP', (select count(*) from ({_SYNC_STATES['events'][0]}) a), 0
union all select 'events', 2, 'TIMESTAMP',
  (select count(*) from ({_SYNC_STATES['events'][1]}) a where ts > (select max(ts) from ({_SYNC_STATES['events'][0]}) b))
  + (select count(*) from {{events}} where event_type = 'error' and ts <= cast('2024-01-10 00:00:00' as #ts)),
  (select count(*) from {{events}} where event_type = 'error' and ts <= cast('2024-01-10 00:00:00' as #ts))""",
)
def _(spark, sf):
    base = scratch(spark)
    specs = [
        TableSpec("shop", "main", "orders", ("o_orderkey",)),
        TableSpec("shop", "main", "conversations", ("conv_id", "turn"), ("updated_at",)),
        TableSpec("shop", "main", "events", ("event_id",), ("ts",)),
    ]
    for number, run_ts in enumerate((FIRST_TS, RUN_TS)):
        sync_tables(
            spark,
            specs,
            lambda spec: state(spark, sf, _SYNC_STATES[spec.table][number]),
            base,
            datetime.fromisoformat(run_ts),
            buckets=4,
            at_once=3,
        )
    log = RunLog(spark, f"{base}/control/runs").state()
    run = F.when(F.col("StartTime") == F.lit(FIRST_TS).cast("timestamp_ntz"), 1).otherwise(2)
    return log.select(
        F.col("SourceTable").alias("source_table"),
        run.alias("run"),
        F.col("LoadType").alias("load_type"),
        F.col("RowsProcessed").alias("rows"),
        F.col("RowsDeleted").alias("deleted"),
    )


@query("sync_with_table_options", f"""
select 'orders' as source_table, count(*) as rows, sum(is_deleted) as deleted from ({SNAPSHOT_CDC_SQL}) t
union all select 'events', count(*), count(case when event_type = 'error' and ts <= cast('2024-01-10 00:00:00' as #ts) then 1 end)
  from {{events}}""")
def _(spark, sf):
    # orders from files that stay, into a target of another name; events with times to be trusted
    base = scratch(spark)
    specs = [
        TableSpec("shop", "main", "orders", ("o_orderkey",), target="orders_clean", stable_source=True, buckets=8),
        TableSpec("shop", "main", "events", ("event_id",), ("ts",), trust_timestamps=True, buckets=4),
    ]
    for number, run_ts in enumerate((FIRST_TS, RUN_TS)):
        read = lambda spec, at=number: state(spark, sf, _SYNC_STATES[spec.table][at])
        for result in sync_tables(spark, specs, read, base, datetime.fromisoformat(run_ts)):
            if result.error:
                raise RuntimeError(result.error)
    parts = []
    for spec in specs:
        target = GenerationStore(spark, TablePaths(base, "shop", "main", spec.table, spec.target).target).read()
        counts = target.agg(F.count(F.lit(1)).alias("rows"), F.sum("is_deleted").alias("deleted"))
        parts.append(counts.select(F.lit(spec.table).alias("source_table"), "rows", "deleted"))
    return parts[0].unionByName(parts[1])


_LISTED = (
    "ID,DATABASE_NAME,SCHEMA_NAME,SRC_TBL_NAME,PRIMARY_KEY_COL,INCR_LOGIC_COL_NAME,TRG_TBL_NAME,TRUST_TIMESTAMPS,STABLE_SOURCE,BUCKETS,MERGE_POLICY",
    "1,shop,main,orders,o_orderkey,none,orders_clean,,yes,8,insert_ts_only",
    "2,shop,main,events,event_id,ts,,Y,,4,",
)


@query("sync_from_list_orders_events", f"""
select 'orders' as source_table, count(*) as rows, sum(is_deleted) as deleted, count(delete_ts) as delete_times
  from ({merge_sql(POLICIES["insert_ts_only"], _CDC_TARGET, f"select {', '.join(ORD_COLUMNS)}, soft_delete from ({delta_sql('orders')}) d", RUN_TS)}) t
union all select 'events', count(*), count(case when event_type = 'error' and ts <= cast('2024-01-10 00:00:00' as #ts) then 1 end),
  count(case when event_type = 'error' and ts <= cast('2024-01-10 00:00:00' as #ts) then 1 end) from {{events}}""")
def _(spark, sf):
    # the list is a file with options: one table from files that stay, under a policy of its own, one with times to be trusted
    base = scratch(spark)
    spark.createDataFrame([(line,) for line in _LISTED], "line string").coalesce(1).write.text(f"{base}/list")
    specs = read_specs(spark, f"{base}/list")
    for number, run_ts in enumerate((FIRST_TS, RUN_TS)):
        read = lambda spec, at=number: state(spark, sf, _SYNC_STATES[spec.table][at])
        for result in sync_tables(spark, specs, read, base, datetime.fromisoformat(run_ts)):
            if result.error:
                raise RuntimeError(result.error)
    parts = []
    for spec in specs:
        target = GenerationStore(spark, TablePaths(base, "shop", "main", spec.table, spec.target).target).read()
        counts = target.agg(
            F.count(F.lit(1)).alias("rows"), F.sum(F.coalesce("is_deleted", F.lit(0))).alias("deleted"), F.count("delete_ts").alias("delete_times")
        )
        parts.append(counts.select(F.lit(spec.table).alias("source_table"), "rows", "deleted", "delete_times"))
    return parts[0].unionByName(parts[1])


@query(
    "watermark_store_runs",
    f"""select o_orderpriority as "TableName", max(o_orderdate) as watermark from {{orders}}
        where o_orderstatus <> 'P' group by o_orderpriority""".replace('"', ""),
)
def _(spark, sf):
    # put for each table in turn, twice for some, and read back one by one
    store = WatermarkStore(spark, scratch(spark))
    orders = table(spark, sf, "orders").where("o_orderstatus <> 'P'")
    ends = orders.groupBy("o_orderpriority", "o_orderstatus").agg(F.max("o_orderdate").alias("at")).collect()
    for r in sorted(ends, key=lambda r: (r["at"], r["o_orderpriority"], r["o_orderstatus"])):
        store.put(r["o_orderpriority"], r["at"], "SUCCESS")
    rows = [(t, store.get(t)) for t in sorted({r["o_orderpriority"] for r in ends})]
    return spark.createDataFrame(rows, "TableName string, watermark timestamp_ntz")


@query("merge_touched_buckets_customers", f"""
select c_custkey, c_name, case when c_nationkey = 7 then 0.0 else c_acctbal end as c_acctbal, c_mktsegment, 0 as is_deleted,
  cast('{FIRST_TS}' as #ts) as insert_ts,
  cast(case when c_nationkey = 7 then '{RUN_TS}' else '{FIRST_TS}' end as #ts) as update_ts,
  cast(null as #ts) as delete_ts from {{customer}}""")
def _(spark, sf):
    store = GenerationStore(spark, scratch(spark))
    customers = table(spark, sf, "customer")
    loads = (
        (customers, FIRST_TS),
        (customers.where("c_nationkey = 7").withColumn("c_acctbal", F.lit(0.0)), RUN_TS),
    )
    for rows, run_ts in loads:
        delta = rows.drop("c_nationkey").withColumns(
            {"soft_delete": F.lit(0), "load_ts": F.lit(run_ts).cast("timestamp_ntz")}
        )
        merge_into(store, delta, ["c_custkey"], run_ts=run_ts, buckets=32)
    return store.read()


# -- control tables -------------------------------------------------------

_STARTED = ("RunId", "PipelineRunId", "PipelineId", "PipelineName", "SourceType", "SourceDatabase",
            "SourceSchema", "SourceTable", "LoadType")


def _log(spark, sf):
    """Start and end events of every run."""
    runs = state(spark, sf, RUNS)
    started = log_start(runs.select(*_STARTED, "StartTime"), F.col("StartTime"))
    ends = runs.where("EndTime is not null").select("RunId", "Status", "EndTime", "RowsProcessed", "LastRunTimestamp")
    return started, started.unionByName(log_end(started, ends))


_STATE = f"""
select {', '.join(_STARTED)}, StartTime, EndTime,
  case when EndTime is null then 'STARTED' else Status end as Status,
  case when EndTime is null then 'STARTED' else Status end as TableRunStatus,
  case when EndTime is null then null else datediff('second', StartTime, EndTime) end as DurationSeconds,
  case when EndTime is null then null else RowsProcessed end as RowsProcessed,
  case when EndTime is null then null else LastRunTimestamp end as LastRunTimestamp,
  case when EndTime is null then 0 else RowsProcessed end as RowsMerged
from ({RUNS}) t"""
_STATE_COLUMNS = (*_STARTED, "StartTime", "EndTime", "Status", "TableRunStatus", "DurationSeconds",
                  "RowsProcessed", "LastRunTimestamp", "RowsMerged")


@query(
    "log_start_runs",
    f"""select RunId, 'STARTED' as Status, 'STARTED' as TableRunStatus, 'RUNNING' as PipelineRunStatus,
        cast(0 as bigint) as RowsMerged, StartTime from ({RUNS}) t""",
)
def _(spark, sf):
    started, _ = _log(spark, sf)
    return started.select("RunId", "Status", "TableRunStatus", "PipelineRunStatus", "RowsMerged", "StartTime")


@query("run_state_runs", _STATE)
def _(spark, sf):
    _, log = _log(spark, sf)
    return run_state(log).select(*_STATE_COLUMNS)


_ROLLUP = f"""select PipelineRunId, case when max(case when TableRunStatus <> 'SUCCESS' then 1 else 0 end) = 1
  then 'FAILED' else 'SUCCESS' end as PipelineRunStatus from ({_STATE}) s group by 1"""


@query("rollup_status_runs", _ROLLUP)
def _(spark, sf):
    _, log = _log(spark, sf)
    return rollup_status(run_state(log))


@query(
    "run_state_with_rollup",
    f"select s.RunId, s.PipelineRunId, r.PipelineRunStatus from ({_STATE}) s join ({_ROLLUP}) r on s.PipelineRunId = r.PipelineRunId",
)
def _(spark, sf):
    _, log = _log(spark, sf)
    return with_rollup(run_state(log)).select("RunId", "PipelineRunId", "PipelineRunStatus")


@query(
    "run_summary_runs",
    f"""select PipelineRunId, count(*) as tables, count(case when TableRunStatus <> 'SUCCESS' then 1 end) as failed,
        cast(coalesce(sum(RowsProcessed), 0) as bigint) as total_rows from ({_STATE}) s group by 1""",
)
def _(spark, sf):
    _, log = _log(spark, sf)
    return run_summary(run_state(log))


@query("next_run_id_runs", f"select coalesce(max(RunId), 0) + 1 as next_id from ({RUNS}) t")
def _(spark, sf):
    return next_run_id(state(spark, sf, RUNS))


@query(
    "latest_run_runs",
    f"select RunId, StartTime from ({RUNS}) t order by StartTime desc, RunId desc limit 1",
)
def _(spark, sf):
    return latest_run(state(spark, sf, RUNS)).select("RunId", "StartTime")


_TABLE = "PipelineId, SourceType, SourceDatabase, SourceSchema, SourceTable"
_LAST = f"""
select {_TABLE}, LastRunTimestamp from (
  select *, row_number() over (partition by {_TABLE} order by EndTime desc nulls last, RunId desc) as rn
  from ({RUNS}) t where LoadType = 'TIMESTAMP' and Status = 'SUCCESS' and LastRunTimestamp is not null) u
where rn = 1"""


@query(
    "last_watermarks_runs",
    f"""select t.PipelineId, t.SourceType, t.SourceDatabase, t.SourceSchema, t.SourceTable,
        coalesce(l.LastRunTimestamp, cast('1900-01-01 00:00:00' as #ts)) as watermark
        from (select distinct {_TABLE} from ({RUNS}) r) t left join ({_LAST}) l
        on t.PipelineId = l.PipelineId and t.SourceTable = l.SourceTable""",
)
def _(spark, sf):
    return last_watermarks(state(spark, sf, RUNS))


@query(
    "lookback_watermarks_runs",
    f"""select SourceTable as SOURCE_OBJECT_NAME, LastRunTimestamp - interval 10 minutes as watermark from (
        select *, row_number() over (partition by SourceTable order by RunId desc) as rn from ({RUNS}) t
        where Status = 'SUCCESS' and LastRunTimestamp <> cast('9999-12-31 23:59:59.999' as #ts)
          and RowsProcessed <> 0) u where rn = 1""",
)
def _(spark, sf):
    runs = state(spark, sf, RUNS).withColumns(
        {"DurationSeconds": F.lit(0), "ErrorMessage": F.lit(None).cast("string")}
    )
    return lookback_watermarks(control_view(runs))


@query(
    "control_view_runs",
    f"""select RunId as RUN_ID, StartTime as RUN_START, SourceTable as SOURCE_OBJECT_NAME, Status as STATUS,
        RowsProcessed as ROWS_INSERTED, LastRunTimestamp as MAX_TIMESTAMP from ({_STATE}) s""",
)
def _(spark, sf):
    _, log = _log(spark, sf)
    return control_view(run_state(log)).select(
        "RUN_ID", "RUN_START", "SOURCE_OBJECT_NAME", "STATUS", "ROWS_INSERTED", "MAX_TIMESTAMP"
    )


# Watermarks per customer's table: the first state's latest order, then the second's.
def _marks(text: str) -> str:
    return f"""select concat('table-', cast(o_custkey as string)) as TableName, max(o_orderdate) as LastRunTimestamp,
      'SUCCESS' as Status, cast(null as string) as LastRunLSN, cast(count(*) as int) as FullLoadDone
      from ({text}) t group by o_custkey"""


@query(
    "upsert_watermarks_customers",
    f"""select coalesce(n.TableName, o.TableName) as TableName,
        case when n.TableName is not null then n.LastRunTimestamp else o.LastRunTimestamp end as LastRunTimestamp,
        'SUCCESS' as Status, cast(null as string) as LastRunLSN,
        case when n.TableName is not null then n.FullLoadDone else o.FullLoadDone end as FullLoadDone
        from ({_marks(ORD_PREV)}) o full join ({_marks(f"select * from ({ORD_CURR}) x where o_orderstatus = 'F'")}) n
        on o.TableName = n.TableName""",
)
def _(spark, sf):
    updates = state(spark, sf, _marks(f"select * from ({ORD_CURR}) x where o_orderstatus = 'F'"))
    return upsert_watermarks(state(spark, sf, _marks(ORD_PREV)), updates)


@query(
    "watermark_or_default_customers",
    f"""select a.TableName, coalesce(m.LastRunTimestamp, cast('1900-01-01 00:00:00' as #ts)) as watermark
        from (select concat('table-', cast(c_custkey as string)) as TableName from {{customer}}) a
        left join ({_marks(f"select * from ({ORD_CURR}) x where o_orderstatus = 'F' and o_totalprice > 300000")}) m on a.TableName = m.TableName""",
)
def _(spark, sf):
    store = state(spark, sf, _marks(f"select * from ({ORD_CURR}) x where o_orderstatus = 'F' and o_totalprice > 300000"))
    asked = table(spark, sf, "customer").select(
        F.concat(F.lit("table-"), F.col("c_custkey").cast("string")).alias("TableName")
    )
    return watermark_or_default(store, asked)
