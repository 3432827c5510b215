"""Registered queries: one per operator group of the survey, with oracle SQL.

Every query reads the given tables (or frames Spark derives from them) and
reaches its result through the library's operators: predicates, discovery,
slicing, dedup, sinks that write and read back, and set-based control-table
operators.  Sink queries write under ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import datetime as _dt
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.functions.keys import split_names
from sluice.functions.timefmt import ts_lit
from sluice.operators import audit, config as cfgops, counts, partitions, restart, sinks, watermark
from sluice.plans.extract import (
    ExtractionConfig,
    discover_slices,
    plan_extraction,
    result_row,
    run_extraction,
)
from sluice.plans.fixtures import (
    FMT,
    NOW,
    audit_header_from_orders,
    audit_lines_from_orders,
    derived_configs,
)
from sluice.functions.dialect import spark_sql
from sluice.plans.scratch import scratch_dir, scratch_path
from sluice.plans.shared import run_shared
from sluice.sources.control_log import ROW, LogTable, append_changes, compact_log, read_log
from sluice.sources.parquet import read_table
from sluice.sources.slices import slice_ranges, table_ranges

dt = _dt.datetime
Query = Callable[[SparkSession, str], DataFrame]


def _events_text_parts(events: DataFrame, first_fmt: str) -> DataFrame:
    """A source with the watermark split over two text columns."""
    return events.select(
        "event_id",
        "ts",
        F.date_format("ts", first_fmt).alias("DT"),
        F.date_format("ts", "HH:mm:ss").alias("TM"),
    )


# --- predicates (P1-P11) ---------------------------------------------------


def delta_full(spark, sf):
    """L1 IO: always a full pull, even with a watermark configured."""
    cfg = ExtractionConfig.from_mapping(
        dict(load_strategy="IO", select_columns="event_id, ts, user_id, event_type, value",
             cdc_column="ts", cdc_timestamp=dt(2024, 1, 20), cdc_ts_format=FMT)
    )
    return plan_extraction(read_table(spark, sf, "events"), cfg, NOW).selected


def delta_snapshot_eq(spark, sf):
    """P3 (IO-SNAP): watermark column equals the snapshot timestamp."""
    cfg = ExtractionConfig.from_mapping(
        dict(load_strategy="IO-SNAP", select_columns="o_orderkey, o_orderdate, o_totalprice",
             cdc_column="o_orderdate", cdc_timestamp=dt(1998, 3, 15), cdc_ts_format=FMT)
    )
    return plan_extraction(read_table(spark, sf, "orders"), cfg, NOW).selected


def delta_open_lower(spark, sf):
    """P4 (IO-CDC): open lower bound."""
    cfg = ExtractionConfig.from_mapping(
        dict(load_strategy="IO-CDC", select_columns="event_id, ts, event_type",
             cdc_column="ts", cdc_timestamp=dt(2024, 1, 20), cdc_ts_format=FMT)
    )
    return plan_extraction(read_table(spark, sf, "events"), cfg, NOW).selected


def delta_closed_window(spark, sf):
    """P5 (IO-SNAP-DLY): window inclusive at both ends."""
    cfg = ExtractionConfig.from_mapping(
        dict(load_strategy="IO-SNAP-DLY", select_columns="event_id, ts, event_type",
             cdc_column="ts", cdc_timestamp=dt(2024, 1, 10), to_cdc_timestamp=dt(2024, 1, 10, 23, 59, 59),
             cdc_ts_format=FMT, target_partition_column="event_type")
    )
    return plan_extraction(read_table(spark, sf, "events"), cfg, NOW).selected


def delta_until_yesterday(spark, sf):
    """P6 (IO-CUSTOM-CDC): from the watermark to yesterday 23:59:59."""
    cfg = ExtractionConfig.from_mapping(
        dict(load_strategy="IO-CUSTOM-CDC", select_columns="event_id, ts",
             cdc_column="ts", cdc_timestamp=dt(2024, 1, 18), cdc_ts_format=FMT)
    )
    return plan_extraction(read_table(spark, sf, "events"), cfg, NOW).selected


def delta_multi_column(spark, sf):
    """``DT,TM`` concatenated without separator, lower bound only even
    for a windowed strategy (kept from the reference)."""
    source = _events_text_parts(read_table(spark, sf, "events"), "yyyy-MM-dd ")
    cfg = ExtractionConfig.from_mapping(
        dict(load_strategy="IO-SNAP-DLY", select_columns="event_id, ts", cdc_column="DT,TM",
             cdc_timestamp=dt(2024, 1, 25, 12), to_cdc_timestamp=dt(2024, 1, 25, 23, 59, 59), cdc_ts_format=FMT)
    )
    return plan_extraction(source, cfg, NOW).selected


def delta_plus_composite(spark, sf):
    """P8 + P11: ``DT+TM`` joined with a space and parsed with the config format."""
    source = _events_text_parts(read_table(spark, sf, "events"), "yyyy-MM-dd")
    cfg = ExtractionConfig.from_mapping(
        dict(load_strategy="IO-CDC", select_columns="event_id, ts", cdc_column="DT+TM",
             cdc_timestamp=dt(2024, 1, 25, 12), cdc_ts_format=FMT)
    )
    return plan_extraction(source, cfg, NOW).selected


def overlap_shift(spark, sf):
    """P10: the lower bound moves back by ``overlap_in_min``."""
    cfg = ExtractionConfig.from_mapping(
        dict(load_strategy="IO-CDC", select_columns="event_id, ts", cdc_column="ts",
             cdc_timestamp=dt(2024, 1, 20), cdc_ts_format=FMT, overlap_in_min="90")
    )
    return plan_extraction(read_table(spark, sf, "events"), cfg, NOW).selected


def static_predicate(spark, sf):
    """P1 + P2: configured projection and row filter."""
    cfg = ExtractionConfig.from_mapping(
        dict(load_strategy="TL-SRC-TGT", select_columns="l_orderkey, l_linenumber, l_quantity",
             query_parameter="l_returnflag in ('A','R') and l_quantity > 45")
    )
    return plan_extraction(read_table(spark, sf, "lineitem"), cfg, NOW).selected


# --- discovery, slicing, aggregate filter (A1-A4, A7) -----------------------


def partition_discovery(spark, sf):
    """A1: distinct string partition keys under the static predicate."""
    cfg = ExtractionConfig.from_mapping(
        dict(load_strategy="TL-SRC-TGT", query_parameter="l_quantity > 49",
             source_partition_column="l_returnflag, l_linestatus")
    )
    return discover_slices(read_table(spark, sf, "lineitem"), cfg, NOW)


def _events_with_date(spark, sf):
    events = read_table(spark, sf, "events")
    return events.withColumn("event_date", F.to_date("ts"))


def partition_discovery_date(spark, sf):
    """A1 with the P6 delta: the date slices an IO-SNAP-MAX-CDC run reads."""
    cfg = ExtractionConfig.from_mapping(
        dict(load_strategy="IO-SNAP-MAX-CDC", cdc_column="ts", cdc_timestamp=dt(2024, 1, 18),
             cdc_ts_format=FMT, source_partition_column="event_date")
    )
    return discover_slices(_events_with_date(spark, sf), cfg, NOW)


def partitioned_extract_nullsafe(spark, sf):
    """A2: rows of chosen slices: brands of a few parts, the null brand, and
    one that no row has."""
    part = read_table(spark, sf, "part").withColumn("brand", F.nullif(F.col("p_brand"), F.lit("Brand#11")))
    cfg = ExtractionConfig.from_mapping(
        dict(load_strategy="TL-SRC-TGT", select_columns="p_partkey, brand", query_parameter="p_size > 10",
             source_partition_column="brand")
    )
    some = discover_slices(part.where("p_partkey < 12 and brand is not null"), cfg, NOW)
    keys = some.unionByName(spark.createDataFrame([(None,), ("Brand#none",)], "brand string"))
    rows = plan_extraction(part, cfg, NOW).selected
    return partitions.restrict_to_partitions(rows, keys, ["brand"])


def slices_subset(spark, sf):
    """S4 + A2: a chosen part of the (flag, status) slices, a null key among
    them, extracted through the plan's own ``slices``."""
    lineitem = read_table(spark, sf, "lineitem").withColumn("flag", F.nullif(F.col("l_returnflag"), F.lit("N")))
    cfg = ExtractionConfig.from_mapping(
        dict(load_strategy="TL-SRC-TGT", select_columns="l_orderkey, l_linenumber, flag, l_linestatus",
             query_parameter="l_quantity > 30", source_partition_column="flag, l_linestatus")
    )
    chosen = spark.createDataFrame([(None, "O"), ("A", "F")], "flag string, l_linestatus string")
    return plan_extraction(lineitem, cfg, NOW, slices=chosen).selected


def quoted_names(spark, sf):
    """P1 + P2 + P4: double-quoted source names in every SQL text of a config,
    and quotes inside a literal."""
    events = read_table(spark, sf, "events").withColumnRenamed("event_type", "Event Type")
    cfg = ExtractionConfig.from_mapping(
        dict(load_strategy="IO-CDC", select_columns='"event_id", "Event Type" as kind, \'a "b" c\' as note, ts',
             query_parameter='"Event Type" in (\'click\', \'"view"\')', cdc_column='"ts"',
             cdc_timestamp=dt(2024, 1, 10), cdc_ts_format=FMT)
    )
    return plan_extraction(events, cfg, NOW).selected


def text_watermark_any_case(spark, sf):
    """A lower-case source format over a text watermark."""
    events = read_table(spark, sf, "events").withColumn("wm", F.date_format("ts", "yyyyMMdd HH:mm:ss"))
    cfg = ExtractionConfig.from_mapping(
        dict(load_strategy="IO-CDC", select_columns="event_id, wm", cdc_column="wm",
             cdc_timestamp=dt(2024, 1, 20, 6), cdc_ts_format="yyyymmdd hh24:mi:ss")
    )
    return plan_extraction(events, cfg, NOW).selected


def tl_agg(spark, sf):
    """A3 (TL-AGG): rows at the maximum ship date of the filtered table."""
    cfg = ExtractionConfig.from_mapping(
        dict(load_strategy="TL-AGG", select_columns="l_orderkey, l_linenumber, l_shipdate",
             query_parameter="l_returnflag='N'", agg_column="l_shipdate", agg_column_function="max",
             agg_operation="=")
    )
    return plan_extraction(read_table(spark, sf, "lineitem"), cfg, NOW).selected


def tl_agg_ge_avg(spark, sf):
    """A3 with another function and operator: ``>= avg``."""
    cfg = ExtractionConfig.from_mapping(
        dict(load_strategy="TL-AGG", select_columns="o_orderkey, o_totalprice",
             query_parameter="o_orderstatus='F'", agg_column="o_totalprice", agg_column_function="avg",
             agg_operation=">=")
    )
    return plan_extraction(read_table(spark, sf, "orders"), cfg, NOW).selected


def tl_agg_partitions(spark, sf):
    """A4: slices that carry the extreme value; the aggregate column joins the
    keys.  The source exposes the ship date as a DATE column, as date
    partition keys are in the reference's sources."""
    source = read_table(spark, sf, "lineitem").withColumn("l_shipdate", F.to_date("l_shipdate"))
    cfg = ExtractionConfig.from_mapping(
        dict(load_strategy="TL-AGG", source_partition_column="l_linestatus", agg_column="l_shipdate",
             agg_column_function="max", agg_operation="=")
    )
    return discover_slices(source, cfg, NOW)


def max_partition_date(spark, sf):
    """Newest date among the discovered date slices."""
    cfg = ExtractionConfig.from_mapping(
        dict(load_strategy="IO-SNAP-MAX-CDC", cdc_column="ts", cdc_timestamp=dt(2024, 1, 1),
             cdc_ts_format=FMT, source_partition_column="event_date")
    )
    keys = discover_slices(_events_with_date(spark, sf), cfg, NOW)
    return partitions.max_partition_date(keys, "event_date")


def partitioned_equals_whole(spark, sf):
    """A sliced extraction (discovery + null-safe semi-join, one scan) of
    some of the statuses, summarised per slice."""
    orders = read_table(spark, sf, "orders")
    cfg = ExtractionConfig.from_mapping(
        dict(load_strategy="IO-CDC", select_columns="o_orderkey, o_orderstatus", cdc_column="o_orderdate",
             cdc_timestamp=dt(1998, 1, 1), cdc_ts_format=FMT, source_partition_column="o_orderstatus")
    )
    keys = discover_slices(orders.where("o_orderstatus <> 'O'"), cfg, NOW)
    rows = partitions.restrict_to_partitions(plan_extraction(orders, cfg, NOW).selected, keys, ["o_orderstatus"])
    return rows.groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("o_orderkey").alias("n_keys")
    )


# --- dedup, counts (A5, A6, A8, R1) -----------------------------------------

_LINEITEM_ORDER = (
    "l_shipdate, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus"
)


def dedup_primary_keys(spark, sf):
    """One row per (l_orderkey, l_linenumber), smallest under a full order."""
    cfg = ExtractionConfig.from_mapping(
        dict(load_strategy="TL-SRC-TGT", primary_keys="l_orderkey, l_linenumber", dedup_order=_LINEITEM_ORDER)
    )
    out = plan_extraction(read_table(spark, sf, "lineitem"), cfg, NOW).output
    return out.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")


def reconcile_counts(spark, sf):
    """A5 + C7 + C10 + R1: read and write counts stored on each run's audit
    header row, read back and reconciled: one real extraction (dedup, write)
    with counts observed in the writing pass, and one run per order, whose
    lines are its source rows and whose line numbers are what it wrote."""
    cfg = ExtractionConfig.from_mapping(
        dict(id="lineitem", load_strategy="IO-CUSTOM-CDC", primary_keys="l_orderkey,l_linenumber",
             target_path=scratch_path(spark, "reconcile"))
    )
    result = run_extraction(read_table(spark, sf, "lineitem"), cfg, NOW)
    one = spark.createDataFrame(
        [(-1, NOW, 1, -1, "RUNNING", NOW, 0, 0)],
        "audit_id long, insert_timestamp timestamp_ntz, latest_record_ind int, workflow_run_id long, "
        "workflow_header_status string, workflow_start_ts timestamp_ntz, src_record_count long, "
        "target_record_count long",
    )
    header = audit_header_from_orders(read_table(spark, sf, "orders")).unionByName(one)
    per_run = _order_counts(spark, sf).select("workflow_run_id", "src_record_count", "target_record_count")
    done = spark.createDataFrame(
        [(-1, result.src_record_count, result.target_record_count)],
        "workflow_run_id long, src_record_count long, target_record_count long",
    )
    header = audit.set_header_counts(header, per_run.unionByName(done), keys=("workflow_run_id",))
    # an older latest row of the same runs: the newest one counts
    older = header.where("workflow_run_id % 3 = 0").withColumns(
        {"insert_timestamp": ts_lit("1990-01-01 00:00:00"), "src_record_count": F.lit(7).cast("long"),
         "target_record_count": F.lit(7).cast("long")}
    )
    stored = audit.header_counts(header.unionByName(older), header)
    return counts.reconcile_counts(stored).select(
        F.col("workflow_run_id").alias("run_id"), "src_record_count", "target_record_count", "counts_match"
    )


def _order_counts(spark, sf):
    """Per order: its lines, and its distinct line numbers."""
    per_line = read_table(spark, sf, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.count(F.lit(1)).alias("c"))
    return per_line.groupBy(F.col("l_orderkey").alias("workflow_run_id")).agg(
        F.sum("c").cast("long").alias("src_record_count"), F.count(F.lit(1)).alias("target_record_count")
    )


def extracted_flag(spark, sf):
    """A6 set-based: rows each config's extraction selects, and the flag."""
    cfg = derived_configs(read_table(spark, sf, "customer")).select("id")
    return counts.extracted_flags(cfg, read_table(spark, sf, "orders"), "id", "o_custkey")


# --- sinks (K1-K6) ----------------------------------------------------------


def sink_append_extract_date(spark, sf):
    """K1 + K2: two IO-SNAP days appended under their EXTRACT_DATE."""
    events = read_table(spark, sf, "events").withColumn("snap_day", F.to_date("ts").cast("timestamp_ntz"))
    path = scratch_path(spark, "append_extract_date")
    for day in (dt(2024, 1, 10), dt(2024, 1, 11)):
        cfg = ExtractionConfig.from_mapping(
            dict(load_strategy="IO-SNAP", select_columns="event_id, ts", cdc_column="snap_day",
                 cdc_timestamp=day, cdc_ts_format=FMT, target_path=path)
        )
        run_extraction(events, cfg, NOW)
    schema = T.StructType(
        [T.StructField("event_id", T.LongType()), T.StructField("ts", T.TimestampNTZType()),
         T.StructField(sinks.EXTRACT_DATE, T.TimestampNTZType())]
    )
    return sinks.read_target(spark, path, schema)


def sink_truncate_extract_date(spark, sf):
    """K3: a TL-CDC run replaces an earlier load completely."""
    events = read_table(spark, sf, "events")
    path = scratch_path(spark, "truncate_extract_date")
    for lower in (dt(2024, 1, 10), dt(2024, 1, 20)):
        cfg = ExtractionConfig.from_mapping(
            dict(load_strategy="TL-CDC", select_columns="event_id, ts", cdc_column="ts",
                 cdc_timestamp=lower, cdc_ts_format=FMT, target_path=path)
        )
        run_extraction(events, cfg, NOW)
    schema = T.StructType(
        [T.StructField("event_id", T.LongType()), T.StructField("ts", T.TimestampNTZType()),
         T.StructField(sinks.EXTRACT_DATE, T.TimestampNTZType())]
    )
    return sinks.read_target(spark, path, schema)


def sink_append_target_cols(spark, sf):
    """K4: two IO-SNAP-DLY windows appended, partitioned by configured columns."""
    lineitem = read_table(spark, sf, "lineitem")
    path = scratch_path(spark, "append_target_cols")
    for lo, hi in ((dt(1998, 1, 1), dt(1998, 1, 31, 23, 59, 59)), (dt(1998, 2, 1), dt(1998, 2, 28, 23, 59, 59))):
        cfg = ExtractionConfig.from_mapping(
            dict(load_strategy="IO-SNAP-DLY",
                 select_columns="l_orderkey, l_linenumber, l_shipdate, l_returnflag, l_linestatus",
                 cdc_column="l_shipdate", cdc_timestamp=lo, to_cdc_timestamp=hi, cdc_ts_format=FMT,
                 target_partition_column="l_returnflag, l_linestatus", target_path=path)
        )
        run_extraction(lineitem, cfg, NOW)
    schema = T.StructType(
        [T.StructField("l_orderkey", T.LongType()), T.StructField("l_linenumber", T.IntegerType()),
         T.StructField("l_shipdate", T.TimestampNTZType()), T.StructField("l_returnflag", T.StringType()),
         T.StructField("l_linestatus", T.StringType())]
    )
    return sinks.read_target(spark, path, schema)


def sink_truncate_load(spark, sf):
    """K5: load ``click``, then truncate and load the ``view`` and ``error``
    slices in one overwrite write."""
    events = read_table(spark, sf, "events")
    path = scratch_path(spark, "truncate_load")
    first = ExtractionConfig.from_mapping(
        dict(load_strategy="TL-SRC-TGT", select_columns="event_id, user_id, event_type",
             query_parameter="event_type = 'click'", target_partition_column="event_type", target_path=path)
    )
    run_extraction(events, first, NOW)
    second = ExtractionConfig.from_mapping(
        dict(load_strategy="TL-SRC-TGT", select_columns="event_id, user_id, event_type",
             query_parameter="event_type in ('view','error')", source_partition_column="event_type",
             target_partition_column="event_type", target_path=path)
    )
    run_extraction(events, second, NOW)
    schema = T.StructType(
        [T.StructField("event_id", T.LongType()), T.StructField("user_id", T.LongType()),
         T.StructField("event_type", T.StringType())]
    )
    return sinks.read_target(spark, path, schema)


# --- config (C1-C3) ---------------------------------------------------------


def config_lookup(spark, sf):
    """A manual and a scheduled run request matched against all configs."""
    cfg = derived_configs(read_table(spark, sf, "customer"))
    requests = spark.createDataFrame(
        [("manual", "Y", "BUILDING", "NATION_3", None, None), ("scheduled", "N", None, None, None, "EVT_NATION_7")],
        "request_id string, manual_flag string, schema_name string, table_name string, config_id long, "
        "cloudwatch_event_name string",
    )
    return cfgops.lookup_configs(cfg, requests).select("id", "load_strategy")


def config_cardinality(spark, sf):
    """Matches per lookup shape, with a verdict."""
    cfg = derived_configs(read_table(spark, sf, "customer"))
    return cfgops.config_cardinality(cfg, ["c_nationkey", "c_mktsegment"])


def request_verdicts(spark, sf):
    """C1 + C2: run requests of every shape against all configs - manual by
    table, manual by id, scheduled by event, scheduled without one, and names
    that nothing or only a half matches - with their match count and verdict."""
    customer = read_table(spark, sf, "customer")
    # a tenth of the configs have no schema, so names must match column by column
    cfg = derived_configs(customer).withColumn("schema_name", F.when(F.col("id") % 10 != 0, F.col("schema_name")))
    text = F.lit(None).cast("string")
    number = F.lit(None).cast("long")
    shapes = [
        ("by table", F.lit("Y"), "schema_name", "table_name", number, text),
        ("by id", F.lit("Y"), "schema_name", "table_name", F.col("id"), text),
        ("shifted", F.lit("Y"), "table_name", text, number, text),
        ("event", F.lit("N"), text, text, number, "cloudwatch_event_name"),
        ("no event", F.lit("N"), text, text, number, text),
    ]
    requests = None
    for name, manual, schema, table, config_id, event in shapes:
        part = cfg.select(
            F.concat(F.lit(f"{name} "), F.col("id").cast("string")).alias("request_id"), manual.alias("manual_flag"),
            (F.col(schema) if isinstance(schema, str) else schema).alias("schema_name"),
            (F.col(table) if isinstance(table, str) else table).alias("table_name"), config_id.alias("config_id"),
            (F.col(event) if isinstance(event, str) else event).alias("cloudwatch_event_name"),
        )
        requests = part if requests is None else requests.unionByName(part)
    checked = cfgops.check_requests(requests, cfgops.lookup_configs(cfg, requests, counted=True), cfg)
    return checked.select("request_id", "n_configs", "verdict")


def config_normalise(spark, sf):
    """C3 + P10 on every config row."""
    cfg = cfgops.normalise_configs(derived_configs(read_table(spark, sf, "customer")))
    return cfg.select(
        "id", "query_parameter", "cdc_column", F.element_at("primary_keys", 1).alias("pk1"), "cdc_timestamp"
    )


# --- watermark (W1-W6) ------------------------------------------------------


def advance_watermark(spark, sf):
    """W1-W5 over all configs; the newest partition date and the gate are
    given per config."""
    cfg = derived_configs(read_table(spark, sf, "customer"))
    runs = cfg.withColumn("max_value", F.lit(_dt.date(2024, 1, 19))).withColumn("gate", F.col("id") % 2 == 0)
    return watermark.advanced_runs(runs, NOW).select("id", "load_strategy", "next_cdc_ts", "next_to_ts")


def watermark_log_append(spark, sf):
    """An existing log plus the advances of all strategies."""
    cfg = derived_configs(read_table(spark, sf, "customer")).withColumns(
        {"max_value": F.to_date("to_cdc_timestamp"), "gate": F.col("id") % 2 == 0, "is_extracted": F.col("id") % 7 != 0}
    )
    log = cfg.select(
        F.col("id").alias("audit_id"),
        ts_lit("2024-01-01 00:00:00").alias("insert_timestamp"),
        "cdc_timestamp",
        F.col("cdc_ts_format").alias("cdc_timestamp_fmt"),
        "to_cdc_timestamp",
    )
    new = watermark.watermark_log_rows(watermark.advance_watermark(cfg, NOW), NOW)
    kept = _control_log(spark, "watermark_log", log, ("audit_id",), ("audit_id", "insert_timestamp"))
    append_changes(spark, kept, None, watermark.append_watermark_log(log.where(F.lit(False)), new))
    return read_log(spark, kept).drop(ROW)


def latest_watermarks(spark, sf):
    """W6 read back: the bounds each config's next run starts from."""
    return watermark.latest_watermarks(watermark_log_append(spark, sf))


def _control_log(spark, name: str, rows: DataFrame, key: tuple, identity: tuple) -> LogTable:
    """``rows`` as the history of a control log of their own."""
    log = LogTable(scratch_path(spark, name), rows.schema, key, identity, buckets=16)
    append_changes(spark, log, None, rows)
    return log


# --- audit (C4-C10, R2) -----------------------------------------------------


def audit_spec_upsert(spark, sf):
    """C4: even customers already have a spec; the run adds the odd ones."""
    customer = read_table(spark, sf, "customer")
    runs = customer.select(
        F.col("c_custkey").alias("audit_id"),
        F.col("c_mktsegment").alias("schema_name"),
        F.col("c_name").alias("table_name"),
    )
    spec0 = spark.createDataFrame(
        [],
        "audit_id long, audit_line_job_id string, job_name string, description string, schema_name string, "
        "table_name string, insert_timestamp timestamp_ntz",
    )
    spec1 = audit.upsert_audit_spec(spec0, runs.where(F.col("audit_id") % 2 == 0), "job", dt(2024, 1, 1))
    spec2 = audit.upsert_audit_spec(spec1, runs, "job", NOW)
    return spec2.select("audit_id", "audit_line_job_id", "insert_timestamp")


def audit_retire_latest(spark, sf):
    """C5 + C6: the newest run per audit id is the current run; the older
    rows are retired first, then the current runs are appended."""
    header = audit_header_from_orders(read_table(spark, sf, "orders"))
    current = header.groupBy("audit_id").agg(F.max("workflow_run_id").alias("workflow_run_id"))
    history = header.join(current, ["audit_id", "workflow_run_id"], "left_anti")
    runs = header.join(current, ["audit_id", "workflow_run_id"], "left_semi")
    log = _control_log(spark, "audit_header", history, ("audit_id",), ("audit_id", "workflow_run_id"))
    before = read_log(spark, log, current)
    append_changes(spark, log, before, audit.append_header(audit.retire_header(before, current), runs, NOW))
    return read_log(spark, log).select(
        "audit_id",
        F.col("workflow_run_id").alias("run_id"),
        F.col("workflow_header_status").alias("status"),
        "latest_record_ind",
    )


def audit_set_counts(spark, sf):
    """Per-run counts (all lines read, distinct line numbers written)."""
    header = audit_header_from_orders(read_table(spark, sf, "orders"))
    # every fifth run's row is retired and keeps its counts
    header = header.withColumn("latest_record_ind", (F.col("workflow_run_id") % 5 != 0).cast("int"))
    log = _control_log(spark, "audit_header", header, ("audit_id",), ("workflow_run_id",))
    before = read_log(spark, log)
    append_changes(spark, log, before, audit.set_header_counts(before, _order_counts(spark, sf), keys=("workflow_run_id",)))
    return read_log(spark, log).select(F.col("workflow_run_id").alias("run_id"), "src_record_count", "target_record_count")


def audit_line_retire(spark, sf):
    """C8 + C9: retire the non-running lines of the configs run now (two in
    three), then add one running line for each of them."""
    lines = audit_lines_from_orders(read_table(spark, sf, "orders"))
    customer = read_table(spark, sf, "customer").where("c_custkey % 3 <> 0")
    runs = customer.select(
        F.col("c_custkey").alias("audit_id"),
        F.col("c_custkey").cast("string").alias("audit_line_job_id"),
        ts_lit(NOW).alias("job_start_ts"),
        F.lit(-1).cast("long").alias("job_run_id"),
        F.lit("RUNNING").alias("job_status"),
    )
    log = _control_log(spark, "audit_line", lines, ("audit_id",), ("audit_id", "job_run_id"))
    before = read_log(spark, log)
    append_changes(spark, log, before, audit.append_lines(audit.retire_lines(before, runs), runs, NOW))
    return read_log(spark, log).select(
        "audit_id",
        F.col("job_run_id").alias("run_id"),
        F.col("job_status").alias("status"),
        "latest_record_ind",
    )


def extract_log_upsert(spark, sf):
    """S3 + R2: newest loaded date per key merged into the log (INSERT/UPDATE/KEEP);
    the log is read by the runs' keys, all other rows stay where they are."""
    customer = read_table(spark, sf, "customer")
    log = customer.where(F.col("c_custkey") % 2 == 0).select(
        F.col("c_custkey").alias("k"),
        F.lit(_dt.date(2024, 1, 1)).alias("delta_completion_date"),
        F.lit("COMPLETED").alias("status"),
        ts_lit("2024-01-01 00:00:00").alias("last_update_timestamp"),
    )
    updates = (
        read_table(spark, sf, "events")
        .groupBy(F.col("user_id").alias("k"))
        .agg(F.max(F.to_date("ts")).alias("delta_completion_date"))
    )
    kept = _control_log(spark, "extract_log", log, ("k",), ("k",))
    before = read_log(spark, kept, updates)
    merged = audit.upsert_extract_log(before, updates, ["k"], NOW)
    append_changes(spark, kept, before, merged.drop("action"))
    action = F.coalesce("action", F.lit("KEEP")).alias("action")
    return read_log(spark, kept).join(merged.select("k", "action"), "k", "left").select("k", "delta_completion_date", action)


def log_compaction(spark, sf):
    """C6 + C7: header rows logged year by year as runs open and close, the full
    buckets rewritten, then one more run; read back, newest state per run."""
    orders = read_table(spark, sf, "orders")
    header = audit_header_from_orders(orders)
    year = F.year("insert_timestamp")
    log = LogTable(scratch_path(spark, "log_compaction"), header.schema, ("audit_id",), ("workflow_run_id",), 8)
    for y in range(1995, 2002):
        started = header.where(year == y).withColumn("workflow_header_status", F.lit("RUNNING"))
        append_changes(spark, log, None, started)
        compact_log(spark, log, at_least=3)
    closed = header.where("workflow_header_status <> 'RUNNING' and workflow_run_id % 2 = 0")
    before = read_log(spark, log, closed.select("audit_id"))
    status = closed.select("workflow_run_id", F.col("workflow_header_status").alias("__now"))
    after = before.join(status, "workflow_run_id", "left").withColumn(
        "workflow_header_status", F.coalesce("__now", "workflow_header_status")
    )
    append_changes(spark, log, before, after)
    return read_log(spark, log).select("audit_id", F.col("workflow_run_id").alias("run_id"), F.col("workflow_header_status").alias("status"))


# --- restart (R3-R5) --------------------------------------------------------


def restart_gate(spark, sf):
    """Every event is a restart row of its user, stamped by the day, so
    rows tie; the newest one decides, of equal ones that with the largest id."""
    cfg = derived_configs(read_table(spark, sf, "customer")).select("id")
    rows = read_table(spark, sf, "events").select(
        F.col("user_id").alias("audit_id"),
        F.format_string("%012d", "event_id").alias("step_id"),
        F.when(F.col("event_type").isin("error", "view"), "Extract").otherwise(F.col("event_type")).alias("step_name"),
        F.date_trunc("day", "ts").cast("timestamp_ntz").alias("insert_timestamp"),
    )
    return restart.restart_gate(cfg, rows, ["id"], ["audit_id"]).select("id", "exit_flag")


def restart_clear(spark, sf):
    """Drop the restart rows of the configs being run now."""
    events = read_table(spark, sf, "events")
    rows = events.select("event_id", "user_id")
    running = events.where((F.col("event_type") == "error") & (F.col("ts") >= ts_lit("2024-01-30 00:00:00")))
    return restart.clear_restart(rows, running.select("user_id"), ["user_id"])


def restart_record(spark, sf):
    """Failed configs of nation 3 appended to existing restart rows."""
    cfg = derived_configs(read_table(spark, sf, "customer"))
    events = read_table(spark, sf, "events")
    empty = spark.createDataFrame(
        [],
        "audit_id long, step_id string, step_name string, table_name string, job_name string, "
        "step_job_name string, insert_timestamp timestamp_ntz, schema_name string, description string, "
        "manual_flag string",
    )
    earlier = events.where(F.col("event_type") == "error").select(F.col("user_id").alias("audit_id")).distinct()
    existing = restart.record_restart(empty, earlier, "job", dt(2024, 1, 1))
    failed = cfg.where(F.col("c_nationkey") == 3).select(F.col("id").alias("audit_id"))
    log = _control_log(spark, "restart", existing, ("audit_id",), ("audit_id", "insert_timestamp"))
    append_changes(spark, log, None, restart.record_restart(empty, failed, "job", NOW))
    return read_log(spark, log).select("audit_id", "step_id", "step_name", "description")


# --- whole chains (L1-L6, L9) --------------------------------------------------


def _chain(spark, sf, table: str, source: DataFrame, columns: str, tries: int = 1, **config) -> DataFrame:
    """One run of a strategy end to end, and what it left behind.

    Extract and write with counts observed, reconcile (R1), advance the
    watermark (W1-W5) from what the run itself observed, log it (W6), merge the
    extraction log (R2), and read the target back.  With several ``tries`` the
    run dies after each write but the last and starts again under its run id.
    """
    path = scratch_path(spark, f"chain_{config['load_strategy'].lower()}")
    cfg = ExtractionConfig.from_mapping(
        dict(config, id=table, select_columns=columns, cdc_ts_format=FMT, target_path=path, table_name=table)
    )
    again = {"run_id": f"{table}/wf-1"} if tries > 1 else {}
    for _ in range(tries):
        result = run_extraction(source, cfg, NOW, **again)
    run = watermark.advance_watermark(result_row(spark, result, NOW), NOW)
    log = watermark.append_watermark_log(
        spark.createDataFrame([], "audit_id string, insert_timestamp timestamp_ntz, cdc_timestamp timestamp_ntz, "
                                  "cdc_timestamp_fmt string, to_cdc_timestamp timestamp_ntz"),
        watermark.watermark_log_rows(run, NOW),
    )
    old = spark.createDataFrame(
        [(table, _dt.date(2023, 1, 1), "COMPLETED", NOW)],
        "table_name string, delta_completion_date date, status string, last_update_timestamp timestamp_ntz",
    )
    loaded = run.where(F.col("load_strategy").isin("IO-SNAP-MAX-CDC", "IO-CUSTOM-CDC") & F.col("gate") & F.col("max_value").isNotNull())
    completed = audit.upsert_extract_log(
        old, loaded.select(F.col("id").alias("table_name"), F.col("max_value").alias("delta_completion_date")), ["table_name"], NOW
    )
    key = split_names(columns)[0]
    back = spark.read.parquet(path).agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum(F.col(key)).cast("long").alias("key_sum"), F.countDistinct(key).alias("n_keys")
    )
    return (
        run.select("id", "load_strategy", "src_record_count", "target_record_count", F.col("gate").alias("counts_match"))
        .join(log.select(F.col("audit_id").alias("id"), "cdc_timestamp", "to_cdc_timestamp"), "id", "left")
        .join(completed.select(F.col("table_name").alias("id"), "delta_completion_date"), "id", "left")
        .withColumn("__back", back.select(F.struct("*")).scalar())
        .select("*", "__back.*")
        .drop("__back")
    )


def chain_io(spark, sf):
    """L1: a full pull; no watermark moves."""
    return _chain(spark, sf, "orders", read_table(spark, sf, "orders"), "o_orderkey, o_orderstatus", load_strategy="IO",
                  query_parameter="o_orderstatus <> 'P'")


def chain_io_snap(spark, sf):
    """L2: one snapshot day."""
    return _chain(spark, sf, "orders", read_table(spark, sf, "orders"), "o_orderkey, o_orderdate", load_strategy="IO-SNAP",
                  cdc_column="o_orderdate", cdc_timestamp=dt(1998, 3, 15))


def chain_io_cdc(spark, sf):
    """L3: from the watermark on, overlap applied."""
    return _chain(spark, sf, "events", read_table(spark, sf, "events"), "event_id, ts", load_strategy="IO-CDC",
                  cdc_column="ts", cdc_timestamp=dt(2024, 1, 12), overlap_in_min="45")


def chain_io_snap_dly(spark, sf):
    """L4: one day's window, duplicates removed by key."""
    return _chain(spark, sf, "lineitem", read_table(spark, sf, "lineitem"), "l_orderkey, l_linenumber, l_returnflag",
                  load_strategy="IO-SNAP-DLY", cdc_column="l_shipdate", cdc_timestamp=dt(1997, 1, 1),
                  to_cdc_timestamp=dt(1998, 12, 31, 23, 59, 59), primary_keys="l_orderkey, l_linenumber",
                  target_partition_column="l_returnflag")


def chain_io_snap_max_cdc(spark, sf):
    """Date slices until yesterday; the newest date read moves the watermark."""
    return _chain(spark, sf, "events", _events_with_date(spark, sf), "event_id, ts, event_date", load_strategy="IO-SNAP-MAX-CDC",
                  cdc_column="ts", cdc_timestamp=dt(2024, 1, 3), source_partition_column="event_date",
                  target_partition_column="event_date")


def chain_io_custom_cdc(spark, sf):
    """Until yesterday by key; the gate passes as keys are unique."""
    return _chain(spark, sf, "events", read_table(spark, sf, "events"), "event_id, ts", load_strategy="IO-CUSTOM-CDC",
                  cdc_column="ts", cdc_timestamp=dt(2024, 1, 3), primary_keys="event_id")


def chain_tl_agg(spark, sf):
    """The rows at the newest ship date, loaded in place of the target."""
    return _chain(spark, sf, "lineitem", read_table(spark, sf, "lineitem"), "l_orderkey, l_linenumber, l_shipdate",
                  load_strategy="TL-AGG", query_parameter="l_returnflag='N'", agg_column="l_shipdate",
                  agg_column_function="max", agg_operation="=")


def chain_restarted(spark, sf):
    """L4 with R3 and R4: a run that wrote its rows and died before they were
    noted runs again under its run id; nothing is there twice."""
    columns, source = "event_id, ts, event_type", read_table(spark, sf, "events")
    config = dict(load_strategy="IO-SNAP-DLY", cdc_column="ts", cdc_timestamp=dt(2024, 1, 4),
                  to_cdc_timestamp=dt(2024, 1, 9, 23, 59, 59), target_partition_column="event_type")
    return _chain(spark, sf, "events", source, columns, tries=2, **config)


def shared_scan(spark, sf):
    """L1-L6 on one table: four configs of ``events`` over one scan, a target each."""
    base = scratch_path(spark, "shared_targets")
    own = {
        "full": dict(load_strategy="IO", select_columns="event_id, value"),
        "late": dict(load_strategy="IO-CDC", select_columns="event_id, ts", cdc_column="ts", cdc_timestamp=dt(2024, 1, 20)),
        "day": dict(load_strategy="IO-SNAP-DLY", select_columns="event_id, event_type", cdc_column="ts",
                    cdc_timestamp=dt(2024, 1, 10), to_cdc_timestamp=dt(2024, 1, 10, 23, 59, 59), target_partition_column="event_type"),
        "errors": dict(load_strategy="TL-SRC-TGT", select_columns="event_id", query_parameter="event_type = 'error'"),
    }
    configs = [ExtractionConfig.from_mapping(dict(c, id=k, cdc_ts_format=FMT, target_path=f"{base}/{k}")) for k, c in own.items()]
    results = run_shared(read_table(spark, sf, "events"), configs, NOW)
    out = None
    for cfg, res in zip(configs, results):
        back = spark.read.parquet(cfg.target_path).agg(
            F.lit(cfg.id).alias("id"), F.lit(res.src_record_count).cast("long").alias("src_record_count"),
            F.count(F.lit(1)).alias("n_rows"), F.sum("event_id").cast("long").alias("key_sum"),
        )
        out = back if out is None else out.unionByName(back)
    return out


def _met(rows: DataFrame, predicates: list[str], key: list[str]) -> DataFrame:
    """Per key its rows, and how many predicates they meet in all; and whether no
    predicate holds more than two shares of the rows."""
    # no lambda: the predicates stay compiled
    hits = F.array_remove(F.array(*[F.when(F.expr(spark_sql(p)), i).otherwise(-1) for i, p in enumerate(predicates)]), -1)
    # asked once per row, read twice; a key lies in few ranges
    alike = _checkpointed_by_expression(rows.select(*key, hits.alias("hits")).groupBy(*key, "hits").agg(F.count(F.lit(1)).alias("n")))
    per_range = alike.select("n", F.explode("hits").alias("i")).groupBy("i").agg(F.sum("n").alias("n"))
    return alike.groupBy(*key).agg(
        F.sum("n").alias("n_rows"), F.sum(F.col("n") * F.size("hits")).cast("long").alias("n_met"), F.max(F.size("hits")).alias("most")
    ).withColumn("largest", per_range.agg(F.max("n")).scalar())


def _checkpointed_by_expression(df: DataFrame) -> DataFrame:
    """``df`` checkpointed, compiled expression by expression: as one method, dozens
    of predicates pass what the JVM compiles and run tens of times slower."""
    spark, whole = df.sparkSession, "spark.sql.codegen.wholeStage"
    scratch_dir(spark)
    before = spark.conf.get(whole)
    spark.conf.set(whole, "false")
    try:
        return df.checkpoint(eager=True)
    finally:
        spark.conf.set(whole, before)


def hot_slices(spark, sf):
    """Slices dealt by rows over two key columns; a third of the rows have one
    key, which is cut by primary key, and some keys are null."""
    lines = read_table(spark, sf, "lineitem")
    hot = F.col("l_partkey") % 3 == 0
    rows = lines.select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_suppkey",
        F.when(hot, "HOT").when(F.col("l_quantity") > 48, None).otherwise(F.col("l_returnflag")).alias("flag"),
        F.when(hot, 0).otherwise(F.col("l_suppkey")).alias("supplier"),
    )
    key = ["flag", "supplier"]
    parts = 24
    counted = partitions.discover_partitions(rows, key, counted=True)
    dealt = slice_ranges(counted, key, rows, parts, ["l_orderkey", "l_linenumber", "l_suppkey", "l_quantity"])
    met = _met(rows, dealt.predicates, key)
    total = rows.agg(F.count(F.lit(1))).scalar()
    return met.select(*key, "n_rows", "n_met", (F.col("largest") <= 2 * F.ceil(total / parts)).alias("within_two_shares"))


def full_pull_ranges(spark, sf):
    """A full pull in ranges of a skewed text key and a number, met once each."""
    rows = read_table(spark, sf, "orders").select(
        F.when(F.col("o_custkey") % 3 == 0, "same").otherwise(F.md5(F.col("o_custkey").cast("string"))).alias("name"),
        F.nullif(F.col("o_orderkey"), F.lit(3)).alias("o_orderkey"),
        "o_orderstatus",
    )
    predicates = table_ranges(rows, ["name", "o_orderkey"], 16)
    met = _met(rows, predicates, ["o_orderstatus"])
    total = rows.agg(F.count(F.lit(1))).scalar()
    return met.select("o_orderstatus", "n_rows", "n_met", (F.col("largest") <= 2 * F.ceil(total / 16)).alias("within_two_shares"))


def delta_empty_column(spark, sf):
    """A windowed strategy without a watermark column pulls everything."""
    cfg = ExtractionConfig.from_mapping(
        dict(load_strategy="IO-CDC", select_columns="o_orderkey, o_orderstatus", cdc_column="",
             cdc_timestamp=dt(1998, 1, 1), cdc_ts_format=FMT, query_parameter="o_orderstatus = 'F'")
    )
    return plan_extraction(read_table(spark, sf, "orders"), cfg, NOW).selected


def delta_missing_format(spark, sf):
    """A watermark column without a format gives no delta term."""
    cfg = ExtractionConfig.from_mapping(
        dict(load_strategy="IO-CUSTOM-CDC", select_columns="event_id, event_type", cdc_column="ts",
             cdc_timestamp=dt(2024, 1, 15), query_parameter="event_type <> 'view'")
    )
    return plan_extraction(read_table(spark, sf, "events"), cfg, NOW).selected


def sink_rebalanced_files(spark, sf):
    """K4 + K6: files sized by bytes ahead of the write, with a value that holds
    a third of the rows; rows per value, and counts observed in the writing stage."""
    path = scratch_path(spark, "rebalanced")
    events = read_table(spark, sf, "events")
    kind = F.when(F.col("event_id") % 3 == 0, "hot").otherwise(F.col("event_type"))
    cfg = ExtractionConfig.from_mapping(
        dict(load_strategy="IO-SNAP-DLY", select_columns="event_id, ts, kind", target_partition_column="kind", target_path=path,
             cdc_column="ts", cdc_timestamp=dt(2024, 1, 1), to_cdc_timestamp=dt(2024, 2, 28), cdc_ts_format=FMT,
             max_records_per_file="1000", rebalance_files="Y")
    )
    result = run_extraction(events.withColumn("kind", kind), cfg, NOW)
    per_file = spark.read.parquet(path).groupBy("kind", F.input_file_name().alias("f")).agg(F.count(F.lit(1)).alias("n"))
    return per_file.groupBy("kind").agg(
        F.sum("n").cast("long").alias("n_rows"), (F.max("n") <= 1000).alias("capped"),
        F.lit(result.target_record_count).cast("long").alias("target_record_count"),
    )


def sink_file_sizes(spark, sf):
    """K6: rows per target file, as the config row caps them."""
    path = scratch_path(spark, "file_sizes")
    cfg = ExtractionConfig.from_mapping(
        dict(load_strategy="TL-SRC-TGT", select_columns="event_id, event_type", target_partition_column="event_type",
             target_path=path, max_records_per_file="300", files_per_partition="1")
    )
    run_extraction(read_table(spark, sf, "events"), cfg, NOW)
    per_file = spark.read.parquet(path).groupBy("event_type", F.input_file_name().alias("f")).agg(F.count(F.lit(1)).alias("n"))
    return per_file.groupBy("event_type").agg(
        F.sum("n").cast("long").alias("n_rows"), F.count(F.lit(1)).alias("n_files"), F.max("n").alias("largest")
    )


QUERIES: dict[str, Query] = {
    "delta_full": delta_full,
    "delta_snapshot_eq": delta_snapshot_eq,
    "delta_open_lower": delta_open_lower,
    "delta_closed_window": delta_closed_window,
    "delta_until_yesterday": delta_until_yesterday,
    "delta_multi_column": delta_multi_column,
    "delta_plus_composite": delta_plus_composite,
    "overlap_shift": overlap_shift,
    "static_predicate": static_predicate,
    "partition_discovery": partition_discovery,
    "partition_discovery_date": partition_discovery_date,
    "partitioned_extract_nullsafe": partitioned_extract_nullsafe,
    "tl_agg": tl_agg,
    "tl_agg_ge_avg": tl_agg_ge_avg,
    "tl_agg_partitions": tl_agg_partitions,
    "dedup_primary_keys": dedup_primary_keys,
    "reconcile_counts": reconcile_counts,
    "max_partition_date": max_partition_date,
    "config_lookup": config_lookup,
    "config_cardinality": config_cardinality,
    "advance_watermark": advance_watermark,
    "audit_spec_upsert": audit_spec_upsert,
    "audit_retire_latest": audit_retire_latest,
    "audit_set_counts": audit_set_counts,
    "extract_log_upsert": extract_log_upsert,
    "restart_gate": restart_gate,
    "restart_clear": restart_clear,
    "sink_append_extract_date": sink_append_extract_date,
    "sink_truncate_extract_date": sink_truncate_extract_date,
    "sink_append_target_cols": sink_append_target_cols,
    "sink_truncate_load": sink_truncate_load,
    "partitioned_equals_whole": partitioned_equals_whole,
    "extracted_flag": extracted_flag,
    "audit_line_retire": audit_line_retire,
    "watermark_log_append": watermark_log_append,
    "restart_record": restart_record,
    "config_normalise": config_normalise,
    "slices_subset": slices_subset,
    "quoted_names": quoted_names,
    "text_watermark_any_case": text_watermark_any_case,
    "request_verdicts": request_verdicts,
    "latest_watermarks": latest_watermarks,
    "sink_file_sizes": sink_file_sizes,
    "chain_io": chain_io,
    "chain_io_snap": chain_io_snap,
    "chain_io_cdc": chain_io_cdc,
    "chain_io_snap_dly": chain_io_snap_dly,
    "chain_io_snap_max_cdc": chain_io_snap_max_cdc,
    "chain_io_custom_cdc": chain_io_custom_cdc,
    "chain_tl_agg": chain_tl_agg,
    "sink_rebalanced_files": sink_rebalanced_files,
    "delta_missing_format": delta_missing_format,
    "delta_empty_column": delta_empty_column,
    "full_pull_ranges": full_pull_ranges,
    "hot_slices": hot_slices,
    "shared_scan": shared_scan,
    "chain_restarted": chain_restarted,
    "log_compaction": log_compaction,
}
