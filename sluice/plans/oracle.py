"""DuckDB oracle SQL for every registered query (same column names).

Control tables are derived inline exactly as ``sluice.plans.fixtures`` derives
them with Spark.
"""

from __future__ import annotations

_CFG = """with cfg as (
  select c_custkey as id,
    ['IO','IO-SNAP','IO-CDC','IO-SNAP-DLY','IO-SNAP-MAX-CDC','IO-CUSTOM-CDC','TL-SRC-TGT','TL-CDC','TL-AGG'][(c_custkey % 9 + 1)::int] as load_strategy,
    timestamp '2024-01-01 06:30:00' + to_days((c_custkey % 28)::int) as cdc_ts,
    timestamp '2024-01-01 06:30:00' + to_days((c_custkey % 28 + 1)::int) as to_ts,
    c_nationkey, c_mktsegment
  from customer)
"""

_HDR = """with hdr as (
  select o_custkey as audit_id, o_orderkey as run_id,
    case o_orderstatus when 'O' then 'RUNNING' when 'F' then 'COMPLETED' else 'STOPPED' end as status,
    o_orderdate as insert_ts, 1 as latest_record_ind
  from orders)
"""

_LOG = _CFG + """, r as (select *, cast(to_ts as date) as max_value, id % 2 = 0 as gate from cfg where id % 7 <> 0),
a as (select id,
  case load_strategy when 'IO-SNAP' then cdc_ts + interval 1 day
    when 'IO-SNAP-DLY' then date_trunc('day', to_ts + interval 1 day)
    when 'IO-CDC' then timestamp '2024-01-20 09:30:00' when 'TL-CDC' then timestamp '2024-01-20 09:30:00'
    when 'IO-SNAP-MAX-CDC' then case when gate then cast(max_value + interval 1 day as timestamp) end
    when 'IO-CUSTOM-CDC' then case when gate then timestamp '2024-01-20 00:00:00' end end as lo,
  case load_strategy when 'IO-SNAP-DLY' then to_ts + interval 1 day
    when 'IO-SNAP-MAX-CDC' then case when gate then cast(max_value + interval 1 day as timestamp) + interval 86399 second end
    when 'IO-CUSTOM-CDC' then case when gate then timestamp '2024-01-20 23:59:59' end end as hi from r),
log as (
  select id as audit_id, timestamp '2024-01-01 00:00:00' as insert_timestamp, cdc_ts as cdc_timestamp,
    'YYYY-MM-DD HH24:MI:SS' as cdc_timestamp_fmt, to_ts as to_cdc_timestamp from cfg
  union all select id, timestamp '2024-01-20 09:30:00', lo, 'YYYY-MM-DD HH24:MI:SS', hi from a where lo is not null)
"""


def _chain_sql(table, strategy, key, where, lower="null::timestamp", upper="null::timestamp", completed=None, distinct=None):
    """What a whole run leaves: counts, gate, next bounds, completion date, and the target's rows and keys."""
    written = f"(select distinct {distinct} from {table} where {where})" if distinct else f"(select * from {table} where {where})"
    return (
        f"with src as (select * from {table} where {where}), tgt as {written}, "
        f"s as (select count(*) as n, {lower} as lo, {upper} as hi, {completed or 'null::date'} as done from src), "
        f"t as (select count(*) as n, sum({key})::bigint as key_sum, count(distinct {key}) as n_keys from tgt) "
        f"select '{table}' as id, '{strategy}' as load_strategy, s.n as src_record_count, t.n as target_record_count, "
        "s.n <> 0 and s.n = t.n as counts_match, case when s.n > 0 then s.lo::timestamp end as cdc_timestamp, "
        "case when s.n > 0 then s.hi::timestamp end as to_cdc_timestamp, "
        "coalesce(s.done, date '2023-01-01') as delta_completion_date, t.n as n_rows, t.key_sum, t.n_keys from s, t"
    )


ORACLE: dict[str, str] = {
    "delta_full": "select event_id, ts, user_id, event_type, value from events",
    "delta_snapshot_eq": (
        "select o_orderkey, o_orderdate, o_totalprice from orders "
        "where o_orderdate = timestamp '1998-03-15 00:00:00'"
    ),
    "delta_open_lower": "select event_id, ts, event_type from events where ts >= timestamp '2024-01-20 00:00:00'",
    "delta_closed_window": (
        "select event_id, ts, event_type from events "
        "where ts >= timestamp '2024-01-10 00:00:00' and ts <= timestamp '2024-01-10 23:59:59'"
    ),
    "delta_until_yesterday": (
        "select event_id, ts from events "
        "where ts >= timestamp '2024-01-18 00:00:00' and ts <= timestamp '2024-01-19 23:59:59'"
    ),
    "delta_multi_column": (
        "select event_id, ts from events where cast(strftime(ts,'%Y-%m-%d ') || strftime(ts,'%H:%M:%S') "
        "as timestamp) >= timestamp '2024-01-25 12:00:00'"
    ),
    "delta_plus_composite": (
        "select event_id, ts from events where cast(strftime(ts,'%Y-%m-%d') || ' ' || strftime(ts,'%H:%M:%S') "
        "as timestamp) >= timestamp '2024-01-25 12:00:00'"
    ),
    "overlap_shift": (
        "select event_id, ts from events where ts >= timestamp '2024-01-20 00:00:00' - interval 90 minute"
    ),
    "static_predicate": (
        "select l_orderkey, l_linenumber, l_quantity from lineitem "
        "where l_returnflag in ('A','R') and l_quantity > 45"
    ),
    "partition_discovery": (
        "select cast(l_returnflag as varchar) l_returnflag, cast(l_linestatus as varchar) l_linestatus "
        "from lineitem where l_quantity > 49 group by 1,2"
    ),
    "partition_discovery_date": (
        "select cast(cast(ts as date) as varchar) as event_date from events "
        "where ts >= timestamp '2024-01-18 00:00:00' and ts <= timestamp '2024-01-19 23:59:59' group by 1"
    ),
    "partitioned_extract_nullsafe": (
        "select p_partkey, nullif(p_brand,'Brand#11') as brand from part where p_size > 10 and (p_brand = 'Brand#11' "
        "or p_brand in (select p_brand from part where p_partkey < 12 and p_size > 10))"
    ),
    "tl_agg": (
        "select l_orderkey, l_linenumber, l_shipdate from lineitem where l_returnflag='N' "
        "and l_shipdate = (select max(l_shipdate) from lineitem where l_returnflag='N')"
    ),
    "tl_agg_ge_avg": (
        "select o_orderkey, o_totalprice from orders where o_orderstatus='F' "
        "and o_totalprice >= (select avg(o_totalprice) from orders where o_orderstatus='F')"
    ),
    "tl_agg_partitions": (
        "select cast(l_linestatus as varchar) l_linestatus, cast(cast(l_shipdate as date) as varchar) l_shipdate "
        "from lineitem where l_shipdate=(select max(l_shipdate) from lineitem) group by 1,2"
    ),
    "dedup_primary_keys": (
        "select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity from ("
        "select *, row_number() over (partition by l_orderkey,l_linenumber order by l_shipdate, l_partkey, "
        "l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus) rn "
        "from lineitem) where rn=1"
    ),
    "reconcile_counts": (
        "with n as (select l_orderkey as run_id, count(*) as src, count(distinct l_linenumber) as tgt from lineitem group by 1 "
        "union all select -1, count(*), count(distinct (l_orderkey, l_linenumber)) from lineitem), "
        "r as (select o_orderkey as run_id from orders union all select -1) "
        "select run_id, coalesce(src, 0) as src_record_count, coalesce(tgt, 0) as target_record_count, "
        "coalesce(src <> 0 and src = tgt, false) as counts_match from r left join n using (run_id)"
    ),
    "max_partition_date": (
        "select max(cast(ts as date)) as max_value from events "
        "where ts >= timestamp '2024-01-01 00:00:00' and ts <= timestamp '2024-01-19 23:59:59'"
    ),
    "config_lookup": _CFG
    + "select id, load_strategy from cfg where c_mktsegment in ('BUILDING','MACHINERY') "
    "and case when c_mktsegment='BUILDING' then c_nationkey=3 else c_nationkey=7 end",
    "config_cardinality": _CFG
    + "select c_nationkey, c_mktsegment, count(*) as n_configs, "
    "case when count(*)=1 then 'OK' else 'AMBIGUOUS' end as verdict from cfg group by 1,2",
    "advance_watermark": _CFG
    + """, r as (select *, date '2024-01-19' as max_value, id % 2 = 0 as gate from cfg)
select id, load_strategy,
  case load_strategy when 'IO-SNAP' then cdc_ts + interval 1 day
    when 'IO-SNAP-DLY' then date_trunc('day', to_ts + interval 1 day)
    when 'IO-CDC' then timestamp '2024-01-20 09:30:00' when 'TL-CDC' then timestamp '2024-01-20 09:30:00'
    when 'IO-SNAP-MAX-CDC' then case when gate then cast(max_value + interval 1 day as timestamp) end
    when 'IO-CUSTOM-CDC' then case when gate then timestamp '2024-01-20 00:00:00' end end as next_cdc_ts,
  case load_strategy when 'IO-SNAP-DLY' then to_ts + interval 1 day
    when 'IO-SNAP-MAX-CDC' then case when gate then cast(max_value + interval 1 day as timestamp) + interval 86399 second end
    when 'IO-CUSTOM-CDC' then case when gate then timestamp '2024-01-20 23:59:59' end end as next_to_ts
from r where load_strategy in ('IO-SNAP','IO-CDC','TL-CDC','IO-SNAP-DLY','IO-SNAP-MAX-CDC','IO-CUSTOM-CDC')
  and (load_strategy not in ('IO-SNAP-MAX-CDC','IO-CUSTOM-CDC') or gate)""",
    "audit_spec_upsert": (
        "select c_custkey as audit_id, md5(concat(upper('job'),upper(c_mktsegment),upper(c_name))) "
        "as audit_line_job_id, case when c_custkey % 2 = 0 then timestamp '2024-01-01 00:00:00' "
        "else timestamp '2024-01-20 09:30:00' end as insert_timestamp from customer"
    ),
    "audit_retire_latest": _HDR
    + """, cur as (select audit_id, max(run_id) as run_id from hdr group by 1)
select audit_id, h.run_id, h.status,
  case when h.run_id <> c.run_id and h.status <> 'RUNNING' then 0 else h.latest_record_ind end as latest_record_ind
from hdr h join cur c using (audit_id)""",
    "audit_set_counts": (
        "with n as (select l_orderkey, count(*) as src, count(distinct l_linenumber) as tgt "
        "from lineitem group by 1) select o_orderkey as run_id, coalesce(src,0) as src_record_count, "
        "coalesce(tgt,0) as target_record_count from orders left join n on l_orderkey=o_orderkey and o_orderkey % 5 <> 0"
    ),
    "extract_log_upsert": (
        "select coalesce(s.user_id, l.c_custkey) as k, coalesce(s.m, date '2024-01-01') as delta_completion_date, "
        "case when l.c_custkey is null then 'INSERT' when s.user_id is null then 'KEEP' else 'UPDATE' end as action "
        "from (select user_id, max(cast(ts as date)) m from events group by 1) s "
        "full join (select c_custkey from customer where c_custkey % 2 = 0) l on s.user_id=l.c_custkey"
    ),
    "restart_gate": _CFG
    + """, rs as (select user_id as audit_id,
    arg_max(case when event_type in ('error', 'view') then 'Extract' else event_type end, (date_trunc('day', ts), event_id)) as step_name
  from events group by 1)
select id, case when step_name is not null and step_name <> 'Extract' then 'Y' else 'N' end as exit_flag
from cfg left join rs on id=audit_id""",
    "restart_clear": (
        "select event_id, user_id from events e where not exists (select 1 from (select distinct user_id "
        "from events where event_type='error' and ts >= timestamp '2024-01-30') d where d.user_id=e.user_id)"
    ),
    "sink_append_extract_date": (
        "select event_id, ts, timestamp '2024-01-10 00:00:00' as EXTRACT_DATE from events "
        "where ts >= timestamp '2024-01-10 00:00:00' and ts < timestamp '2024-01-11 00:00:00' "
        "union all select event_id, ts, timestamp '2024-01-11 00:00:00' from events "
        "where ts >= timestamp '2024-01-11 00:00:00' and ts < timestamp '2024-01-12 00:00:00'"
    ),
    "sink_truncate_extract_date": (
        "select event_id, ts, timestamp '2024-01-20 00:00:00' as EXTRACT_DATE from events "
        "where ts >= timestamp '2024-01-20 00:00:00'"
    ),
    "sink_append_target_cols": (
        "select l_orderkey, l_linenumber, l_shipdate, l_returnflag, l_linestatus from lineitem "
        "where l_shipdate >= timestamp '1998-01-01' and l_shipdate <= timestamp '1998-01-31 23:59:59' "
        "union all select l_orderkey, l_linenumber, l_shipdate, l_returnflag, l_linestatus from lineitem "
        "where l_shipdate >= timestamp '1998-02-01' and l_shipdate <= timestamp '1998-02-28 23:59:59'"
    ),
    "sink_truncate_load": "select event_id, user_id, event_type from events where event_type in ('view','error')",
    "partitioned_equals_whole": (
        "select o_orderstatus, count(*) as n, count(distinct o_orderkey) as n_keys from orders "
        "where o_orderdate >= timestamp '1998-01-01' and o_orderstatus <> 'O' group by 1"
    ),
    "extracted_flag": _CFG
    + "select id, count(o_orderkey) as n_rows, count(o_orderkey) <> 0 as is_extracted from cfg "
    "left join orders on o_custkey = id group by 1",
    "audit_line_retire": _HDR
    + "select audit_id, run_id, status, case when status <> 'RUNNING' and audit_id in (select c_custkey from customer "
    "where c_custkey % 3 <> 0) then 0 else latest_record_ind end "
    "as latest_record_ind from hdr union all select c_custkey, -1, 'RUNNING', 1 from customer where c_custkey % 3 <> 0",
    "watermark_log_append": _LOG + "select * from log",
    "latest_watermarks": _LOG
    + "select audit_id, arg_max(cdc_timestamp, insert_timestamp) as cdc_timestamp, "
    "arg_max_null(to_cdc_timestamp, insert_timestamp) as to_cdc_timestamp, "
    "arg_max(cdc_timestamp_fmt, insert_timestamp) as cdc_timestamp_fmt from log group by 1",
    "slices_subset": (
        "select l_orderkey, l_linenumber, nullif(l_returnflag,'N') as flag, l_linestatus from lineitem where l_quantity > 30 "
        "and ((l_returnflag = 'N' and l_linestatus = 'O') or (l_returnflag = 'A' and l_linestatus = 'F'))"
    ),
    "quoted_names": (
        "select event_id, event_type as kind, 'a \"b\" c' as note, ts from events "
        "where event_type in ('click','\"view\"') and ts >= timestamp '2024-01-10 00:00:00'"
    ),
    "text_watermark_any_case": (
        "select event_id, strftime(ts,'%Y%m%d %H:%M:%S') as wm from events "
        "where date_trunc('second', ts) >= timestamp '2024-01-20 06:00:00'"
    ),
    "request_verdicts": _CFG
    + """, c as (select id, case when id % 10 <> 0 then c_mktsegment end as s, 'NATION_' || c_nationkey as t, 'EVT_NATION_' || c_nationkey as e,
    c_mktsegment = 'BUILDING' as manual, c_mktsegment = 'MACHINERY' as scheduled from cfg),
q as (select 'by table ' || id as request_id, s, t, null::bigint as i, null as e, 'Y' as m from c
  union all select 'by id ' || id, s, t, id, null, 'Y' from c
  union all select 'shifted ' || id, t, null, null, null, 'Y' from c
  union all select 'event ' || id, null, null, null, e, 'N' from c
  union all select 'no event ' || id, null, null, null, null, 'N' from c),
n as (select request_id, case when m = 'Y' then (select count(*) from c where manual and c.s = q.s and c.t = q.t and (q.i is null or c.id = q.i))
    when q.e is null then (select count(*) from c where scheduled)
    else (select count(*) from c where scheduled and c.e = q.e) end as n_configs from q)
select request_id, n_configs, case when n_configs = 0 then 'MISSING' when n_configs = 1 then 'OK' else 'AMBIGUOUS' end as verdict from n""",
    "sink_file_sizes": (
        "select event_type, count(*) as n_rows, ceil(count(*) / 300.0)::bigint as n_files, "
        "least(count(*), 300) as largest from events group by 1"
    ),
    "chain_io": _chain_sql("orders", "IO", "o_orderkey", "o_orderstatus <> 'P'"),
    "chain_io_snap": _chain_sql(
        "orders", "IO-SNAP", "o_orderkey", "o_orderdate = timestamp '1998-03-15'", lower="timestamp '1998-03-16'"
    ),
    "chain_io_cdc": _chain_sql(
        "events", "IO-CDC", "event_id", "ts >= timestamp '2024-01-11 23:15:00'", lower="timestamp '2024-01-20 09:30:00'"
    ),
    "chain_io_snap_dly": _chain_sql(
        "lineitem", "IO-SNAP-DLY", "l_orderkey", "l_shipdate between timestamp '1997-01-01' and timestamp '1998-12-31 23:59:59'",
        lower="timestamp '1999-01-01'", upper="timestamp '1999-01-01 23:59:59'", distinct="l_orderkey, l_linenumber",
    ),
    "chain_io_snap_max_cdc": _chain_sql(
        "events", "IO-SNAP-MAX-CDC", "event_id", "ts between timestamp '2024-01-03' and timestamp '2024-01-19 23:59:59'",
        lower="max(ts::date) + interval 1 day", upper="max(ts::date) + interval 2 day - interval 1 second", completed="max(ts::date)",
    ),
    "chain_io_custom_cdc": _chain_sql(
        "events", "IO-CUSTOM-CDC", "event_id", "ts between timestamp '2024-01-03' and timestamp '2024-01-19 23:59:59'",
        lower="timestamp '2024-01-20'", upper="timestamp '2024-01-20 23:59:59'", completed="date '2024-01-19'",
    ),
    "chain_tl_agg": _chain_sql(
        "lineitem", "TL-AGG", "l_orderkey",
        "l_returnflag = 'N' and l_shipdate = (select max(l_shipdate) from lineitem where l_returnflag = 'N')",
    ),
    "chain_restarted": _chain_sql(
        "events", "IO-SNAP-DLY", "event_id", "ts between timestamp '2024-01-04' and timestamp '2024-01-09 23:59:59'",
        lower="timestamp '2024-01-10'", upper="timestamp '2024-01-10 23:59:59'",
    ),
    "log_compaction": _HDR
    + """ select audit_id, run_id, case when run_id % 2 = 0 then status else 'RUNNING' end as status from hdr""",
    "shared_scan": (
        "select id, count(*) as src_record_count, count(*) as n_rows, sum(event_id)::bigint as key_sum from ("
        "select 'full' as id, event_id from events union all "
        "select 'late', event_id from events where ts >= timestamp '2024-01-20' union all "
        "select 'day', event_id from events where ts between timestamp '2024-01-10' and timestamp '2024-01-10 23:59:59' union all "
        "select 'errors', event_id from events where event_type = 'error') group by id"
    ),
    "hot_slices": (
        "select case when l_partkey % 3 = 0 then 'HOT' when l_quantity > 48 then null else l_returnflag end as flag, "
        "case when l_partkey % 3 = 0 then 0 else l_suppkey end as supplier, count(*) as n_rows, count(*) as n_met, "
        "true as within_two_shares from lineitem group by 1, 2"
    ),
    "full_pull_ranges": (
        "select o_orderstatus, count(*) as n_rows, count(*) as n_met, true as within_two_shares from orders group by 1"
    ),
    "delta_empty_column": "select o_orderkey, o_orderstatus from orders where o_orderstatus = 'F'",
    "delta_missing_format": "select event_id, event_type from events where event_type <> 'view'",
    "sink_rebalanced_files": (
        "select case when event_id % 3 = 0 then 'hot' else event_type end as kind, count(*) as n_rows, true as capped, "
        "(select count(*) from events) as target_record_count from events group by 1"
    ),
    "restart_record": _CFG
    + "select id as audit_id, '1' as step_id, 'Extract' as step_name, 'Failed at extraction' as description "
    "from cfg where c_nationkey = 3 union all select user_id, '1', 'Extract', 'Failed at extraction' "
    "from (select user_id from events where event_type='error' group by 1)",
    "config_normalise": _CFG
    + "select id, coalesce(nullif(c_mktsegment,'BUILDING'),' 1=1 ') as query_parameter, "
    "replace('DT+TM','+','||'' ''||') as cdc_column, string_split('a,b',',')[1] as pk1, "
    "cdc_ts - to_minutes((id % 60)::bigint) as cdc_timestamp from cfg",
}
