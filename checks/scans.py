"""Scans, extracts, projections and scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.base import bucket_sql, encoded_sql, hex_number_sql, query, row_hash_sql, state, table
from checks.states import CONV_CURR, ORD_COLUMNS, ORD_CURR, ORD_PREV, ORD_TIMES, RUNS, WATERMARK
from tidemark.functions.columns import (
    business_columns,
    drop_columns,
    non_key_columns,
    preview,
    project,
    row_count,
    table_columns,
)
from tidemark.functions.hashing import bucket_count, bucket_fingerprint, hash_bucket, row_hash
from tidemark.functions.scalars import duration_seconds, format_millis, none_if_empty, parse_list
from tidemark.operators.delta import current_keys
from tidemark.operators.drift import map_types, mapping_table
from tidemark.operators.incremental import (
    changed_since,
    extract_summary,
    full_extract,
    incremental_extract,
    max_timestamp,
)
from tidemark.sources.tables import range_predicates

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


@query("full_extract_lineitem", "select l_orderkey, l_linenumber, l_quantity, l_shipdate from {lineitem}")
def _(spark, sf):
    return full_extract(table(spark, sf, "lineitem"), "l_orderkey, l_linenumber, l_quantity", ["l_shipdate"])


@query(
    "full_extract_summary",
    f"select count(*) as rows, greatest(max(ins_ts), max(upd_ts)) as max_ts from ({ORD_TIMES}) t",
)
def _(spark, sf):
    return extract_summary(state(spark, sf, ORD_TIMES), ["ins_ts", "upd_ts"])


_OVER = f"(ins_ts > cast('{WATERMARK}' as #ts) or upd_ts > cast('{WATERMARK}' as #ts))"


@query("incremental_extract_orders", f"select o_orderkey, ins_ts, upd_ts from ({ORD_TIMES}) t where {_OVER}")
def _(spark, sf):
    return incremental_extract(
        state(spark, sf, ORD_TIMES), ["ins_ts", "upd_ts"], WATERMARK, "o_orderkey, ins_ts, upd_ts"
    )


@query("changed_since_events", "select * from {events} where ts > cast('2024-01-15 00:00:00' as #ts)")
def _(spark, sf):
    return changed_since(table(spark, sf, "events"), ["ts"], "2024-01-15 00:00:00")


@query(
    "changed_since_with_nulls",
    f"select * from ({ORD_TIMES}) t where {_OVER} or (ins_ts is null and upd_ts is null)",
)
def _(spark, sf):
    return changed_since(state(spark, sf, ORD_TIMES), ["ins_ts", "upd_ts"], WATERMARK, nulls="include")


@query("max_timestamp_orders", f"select greatest(max(ins_ts), max(upd_ts)) as max_ts from ({ORD_TIMES}) t")
def _(spark, sf):
    return max_timestamp(state(spark, sf, ORD_TIMES), ["ins_ts", "upd_ts"])


@query(
    "next_watermark_events",
    "select max(ts) as max_ts from {events} where ts > cast('2024-01-15 00:00:00' as #ts)",
)
def _(spark, sf):
    return max_timestamp(changed_since(table(spark, sf, "events"), ["ts"], "2024-01-15 00:00:00"), ["ts"])


@query(
    "hash_bucket_orders",
    f"select o_orderkey, {bucket_sql(8, 'o_orderkey')} as bucket from {{orders}}",
)
def _(spark, sf):
    return hash_bucket(table(spark, sf, "orders").select("o_orderkey"), ["o_orderkey"], 8, portable=True)


@query(
    "hash_bucket_sizes_lineitem",
    f"select {bucket_sql(16, 'l_orderkey', 'l_linenumber')} as bucket, count(*) as rows from {{lineitem}} group by 1",
)
def _(spark, sf):
    keyed = hash_bucket(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"], 16, portable=True)
    return keyed.groupBy("bucket").agg(F.count(F.lit(1)).alias("rows"))


@query(
    "bucket_sizing",
    " union all ".join(
        f"select '{t}' as table_name, count(*) as rows, "
        f"cast(greatest(1, least(64, ceil(count(*) / 1000.0))) as int) as buckets from {{{t}}}"
        for t in TABLES
    ),
)
def _(spark, sf):
    counts = None
    for name in TABLES:
        one = row_count(table(spark, sf, name)).select(F.lit(name).alias("table_name"), "rows")
        counts = one if counts is None else counts.unionByName(one)
    return counts.withColumn("buckets", bucket_count(F.col("rows"), rows_per_bucket=1000))


@query("current_keys_conversations", f"select conv_id, turn from ({CONV_CURR}) t")
def _(spark, sf):
    return current_keys(state(spark, sf, CONV_CURR), ["conv_id", "turn"])


@query(
    "preview_sizes",
    " union all ".join(f"select '{t}' as table_name, least(10, count(*)) as rows from {{{t}}}" for t in TABLES),
)
def _(spark, sf):
    sizes = None
    for name in TABLES:
        one = row_count(preview(table(spark, sf, name))).select(F.lit(name).alias("table_name"), "rows")
        sizes = one if sizes is None else sizes.unionByName(one)
    return sizes


_BOUNDS = ("1996-01-01", "1998-01-01", "2000-01-01")


@query(
    "parallel_range_scan",
    """select case when o_orderdate < date '1996-01-01' or o_orderdate is null then 0
                   when o_orderdate < date '1998-01-01' then 1
                   when o_orderdate < date '2000-01-01' then 2 else 3 end as part,
              o_orderkey, o_orderdate from {orders}""",
)
def _(spark, sf):
    orders = table(spark, sf, "orders")
    parts = None
    for i, predicate in enumerate(range_predicates("o_orderdate", _BOUNDS)):
        one = orders.where(predicate).select(F.lit(i).alias("part"), "o_orderkey", "o_orderdate")
        parts = one if parts is None else parts.unionByName(one)
    return parts


@query("project_customer", "select c_custkey, c_name, c_acctbal from {customer}")
def _(spark, sf):
    return project(table(spark, sf, "customer"), "c_custkey, c_name, c_acctbal")


@query("business_columns_orders", f"select {', '.join(ORD_COLUMNS)} from ({ORD_CURR}) t")
def _(spark, sf):
    from tidemark.operators.audit import flag, stamp_audit

    stamped = stamp_audit(flag(row_hash(state(spark, sf, ORD_CURR), ["o_orderkey"]), False), "2024-01-01")
    return stamped.select(*business_columns(stamped))


@query("non_key_columns_conversations", f"select role, text from ({CONV_CURR}) t")
def _(spark, sf):
    conversations = state(spark, sf, CONV_CURR)
    return conversations.select(*non_key_columns(conversations, ["CONV_ID", "Turn"]))


@query("table_columns_supplier", "select s_suppkey, s_name, s_nationkey, s_acctbal from {supplier}")
def _(spark, sf):
    suppliers = table(spark, sf, "supplier").withColumns(
        {"EDW_INSERTED_TIMESTAMP": F.lit(1), "edw_updated_timestamp": F.lit(2)}
    )
    return suppliers.select(*table_columns(suppliers))


@query("drop_columns_pages", "select page_id, html from {pages}")
def _(spark, sf):
    return drop_columns(table(spark, sf, "pages"), "url", "hash_val")


@query(
    "row_hash_orders",
    f"select o_orderkey, {row_hash_sql(*ORD_COLUMNS[1:])} as hash_val from ({ORD_PREV}) t",
)
def _(spark, sf):
    return row_hash(state(spark, sf, ORD_PREV), ["o_orderkey"]).select("o_orderkey", "hash_val")


@query(
    "row_hash_compat_orders",
    f"select o_orderkey, md5(concat_ws('||', {', '.join(f'cast({c} as string)' for c in ORD_COLUMNS[1:])})) "
    f"as hash_val from ({ORD_PREV}) t",
)
def _(spark, sf):
    return row_hash(state(spark, sf, ORD_PREV), ["o_orderkey"], mode="compat").select("o_orderkey", "hash_val")


@query("row_hash_documents", f"select doc_id, {row_hash_sql('text', 'lang', 'source', 'n_chars')} as hash_val from {{documents}}")
def _(spark, sf):
    return row_hash(table(spark, sf, "documents"), ["doc_id"]).select("doc_id", "hash_val")


@query("row_hash_pages", f"select page_id, {row_hash_sql('url', 'html')} as hash_val from {{pages}}")
def _(spark, sf):
    return row_hash(table(spark, sf, "pages"), ["page_id"]).select("page_id", "hash_val")


def fingerprint_sql(text: str, keys: tuple[str, ...], columns: tuple[str, ...], buckets: int) -> str:
    """Per bucket row count and fingerprint of a state, for the other engine."""
    number = hex_number_sql(f"md5({encoded_sql(*keys, 'hash_val')})", 15)
    return (
        f"select {bucket_sql(buckets, *keys)} as bucket, count(*) as rows, "
        f"cast(sum(cast({number} as hugeint)) as string) as fingerprint "
        f"from (select *, {row_hash_sql(*columns)} as hash_val from ({text}) t) u group by 1"
    )


@query("bucket_fingerprint_orders", fingerprint_sql(ORD_CURR, ("o_orderkey",), ORD_COLUMNS[1:], 8))
def _(spark, sf):
    out = bucket_fingerprint(state(spark, sf, ORD_CURR), ["o_orderkey"], 8, portable=True)
    return out.withColumn("fingerprint", F.col("fingerprint").cast("string"))


@query("bucket_fingerprint_conversations", fingerprint_sql(CONV_CURR, ("conv_id", "turn"), ("role", "text"), 4))
def _(spark, sf):
    out = bucket_fingerprint(state(spark, sf, CONV_CURR), ["conv_id", "turn"], 4, portable=True)
    return out.withColumn("fingerprint", F.col("fingerprint").cast("string"))


@query(
    "duration_seconds_runs",
    f"select RunId, datediff('second', StartTime, EndTime) as seconds from ({RUNS}) t",
)
def _(spark, sf):
    runs = state(spark, sf, RUNS)
    return runs.select("RunId", duration_seconds(F.col("StartTime"), F.col("EndTime")).alias("seconds"))


@query(
    "format_millis_events",
    "select event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%g') as text from {events}",
)
def _(spark, sf):
    return table(spark, sf, "events").select("event_id", format_millis(F.col("ts")).alias("text"))


# Increment column lists as they occur in table lists: none, empty words, one name, two quoted names.
_LISTS = """
select event_id, case event_type when 'click' then '' when 'view' then ' None ' when 'error' then 'NULL'
       when 'signup' then concat(' ', cast(user_id as string), ' ')
       else concat('"', event_type, ', ', cast(user_id as string), '"') end as names
from {events}"""


@query(
    "parse_list_events",
    f"""select event_id, case when lower(trim(names)) in ('', 'none', 'null') then '-'
        else array_to_string(list_filter(list_transform(string_split(replace(names, '"', ''), ','),
             lambda x: trim(x)), lambda x: x <> ''), '|') end as names from ({_LISTS}) t""",
)
def _(spark, sf):
    parsed = parse_list(none_if_empty(F.col("names")))
    return state(spark, sf, _LISTS).select(
        "event_id", F.coalesce(F.array_join(parsed, "|"), F.lit("-")).alias("names")
    )


# Type names as a source catalogue would report them, in mixed case, one of them unknown.
_TYPES = """
select event_id, case event_type when 'click' then 'INT' when 'view' then 'Varchar' when 'error' then 'decimal'
       when 'signup' then 'DateTime' else 'geography' end as data_type
from {events}"""


@query(
    "map_types_events",
    f"""select event_id, data_type, coalesce(case lower(data_type) when 'int' then 'number'
        when 'varchar' then 'varchar' when 'decimal' then 'float' when 'datetime' then 'timestampntz' end, '?')
        as mapped_type from ({_TYPES}) t""",
)
def _(spark, sf):
    out = map_types(state(spark, sf, _TYPES), mapping_table(spark), target="SNOWFLAKE")
    return out.withColumn("mapped_type", F.coalesce("mapped_type", F.lit("?")))
