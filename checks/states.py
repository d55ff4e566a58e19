"""Two states of several test tables, and feeds and logs derived from them.

Every row of a table takes part: it is in the previous state, the current
one, or both. What was inserted, changed or removed follows from the rows'
own content.
"""

RUN_TS = "2024-01-02 00:00:00"
FIRST_TS = "2024-01-01 00:00:00"

# Orders from 2001 are new, finished low-priority ones were purged, urgent
# ones were repriced, and one group's status was unknown (NULL) before.
ORD_COLUMNS = ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")
ORD_PREV = """
select o_orderkey, o_custkey,
       case when o_orderpriority = '2-HIGH' and o_orderstatus = 'P' then null else o_orderstatus end as o_orderstatus,
       cast(o_totalprice + case when o_orderpriority = '1-URGENT' then 1 else 0 end as decimal(18,2)) as o_totalprice,
       o_orderdate, o_orderpriority
from {orders} where o_orderdate < date '2001-01-01'"""
ORD_CURR = """
select o_orderkey, o_custkey, o_orderstatus, cast(o_totalprice as decimal(18,2)) as o_totalprice,
       o_orderdate, o_orderpriority
from {orders}
where not (o_orderstatus = 'F' and o_orderpriority = '5-LOW' and o_orderdate < date '2001-01-01')"""

# System turns were added, late turns removed, assistant texts edited.
CONV_PREV = """
select conv_id, turn, role, case when role = 'assistant' then concat(text, '!') else text end as text
from {conversations} where role <> 'system'"""
CONV_CURR = """
select conv_id, turn, role, text from {conversations} where role = 'system' or turn < 6"""

# One source of documents was added, one withdrawn, one re-delivered with edits.
DOC_PREV = """
select doc_id, lang, source, n_chars, case when source = 'src3' then concat(text, ' ') else text end as text
from {documents} where source <> 'src7'"""
DOC_CURR = """
select doc_id, lang, source, n_chars, text from {documents} where source <> 'src11'"""

# Insert and update times with NULLs in either or both.
ORD_TIMES = """
select o_orderkey, o_orderstatus, o_orderpriority, cast(o_totalprice as decimal(18,2)) as o_totalprice,
       case when o_orderpriority = '4-NOT SPECIFIED' then null else o_orderdate end as ins_ts,
       case when o_orderstatus = 'P' then o_orderdate + interval 400 days end as upd_ts
from {orders}"""
WATERMARK = "1998-01-01 00:00:00"
ORD_TIMES_PREV = f"select * from ({ORD_TIMES}) t where ins_ts is null or ins_ts <= cast('{WATERMARK}' as #ts)"
ORD_TIMES_CURR = f"""
select * from ({ORD_TIMES}) t
where not (o_orderstatus = 'F' and o_orderpriority = '5-LOW' and ins_ts <= cast('{WATERMARK}' as #ts))"""

# Landed loads with several rows per key: the first state, the second state,
# its deletions, a revival, tombstones of keys the target never had, and rows
# without a flag.
_COLS = ", ".join(ORD_COLUMNS)
ORD_RAW = f"""
select {_COLS}, 0 as soft_delete, cast('2024-01-01 00:00:00' as #ts) as load_ts from ({ORD_PREV}) a
union all
select {_COLS}, 0, cast('2024-01-02 00:00:00' as #ts) from ({ORD_CURR}) b
union all
select {_COLS}, 1, cast('2024-01-02 00:00:00' as #ts) from ({ORD_PREV}) c
where o_orderstatus = 'F' and o_orderpriority = '5-LOW'
union all
select {_COLS}, 0, cast('2024-01-03 00:00:00' as #ts) from ({ORD_PREV}) d
where o_orderstatus = 'F' and o_orderpriority = '5-LOW' and o_totalprice > 250000
union all
select -o_orderkey - 1, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority, 1,
       cast('2024-01-03 00:00:00' as #ts) from ({ORD_PREV}) e where o_orderpriority = '3-MEDIUM'
union all
select {_COLS}, cast(null as int), cast('2024-01-04 00:00:00' as #ts) from ({ORD_CURR}) f
where o_orderpriority = '2-HIGH' and o_orderstatus = 'F'"""

# The target before that merge: the first state, some of it already deleted.
ORD_TARGET = f"""
select {_COLS},
       case when o_orderstatus = 'F' then 1 else 0 end as is_deleted,
       cast('2023-12-01 00:00:00' as #ts) as insert_ts,
       cast('2023-12-02 00:00:00' as #ts) as update_ts,
       case when o_orderstatus = 'F' then cast('2023-12-03 00:00:00' as #ts) end as delete_ts
from ({ORD_PREV}) t"""

# Orders read as a log of job runs: few tables and sources, each with a large
# share of the rows, failed and unfinished runs, unknown and open-ended watermarks.
RUNS = """
select o_orderkey as RunId,
       concat('run-', cast(o_custkey as string)) as PipelineRunId,
       concat('job-', o_orderstatus) as PipelineId,
       concat('job ', o_orderstatus) as PipelineName,
       'jdbc' as SourceType, 'shop' as SourceDatabase, 'main' as SourceSchema,
       o_orderpriority as SourceTable,
       case when o_totalprice > 100000 then 'TIMESTAMP' else 'SNAPSHOT' end as LoadType,
       case when o_totalprice > 480000 then 'FAILED' when o_totalprice < 20000 then null else 'SUCCESS' end as Status,
       o_orderdate as StartTime,
       case when o_totalprice > 15000 then o_orderdate + interval 95 seconds end as EndTime,
       case when o_totalprice < 150000 then 0 else cast(floor(o_totalprice) as bigint) end as RowsProcessed,
       case when o_orderstatus = 'P' then null
            when o_totalprice > 300000 then cast('9999-12-31 23:59:59.999' as #ts)
            else o_orderdate - interval 1 day end as LastRunTimestamp
from {orders}"""
