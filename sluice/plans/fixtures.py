"""Control tables derived from the test tables.

The reference ships no inputs, so the control tables of the registered queries
are derived from the given tables with Spark; they grow with the scale
factor.  The same derivations appear in the oracle SQL.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.functions.timefmt import ts_lit
from sluice.plans.strategy import STRATEGY_ORDER

# Fixed values of the fixtures (the run clock and the source-dialect format).
NOW = _dt.datetime(2024, 1, 20, 9, 30, 0)
FMT = "YYYY-MM-DD HH24:MI:SS"
CONFIG_BASE_TS = "2024-01-01 06:30:00"


def derived_configs(customer: DataFrame) -> DataFrame:
    """One config per customer.

    ``load_strategy`` cycles through the nine by ``c_custkey % 9``; bounds
    start at 2024-01-01 06:30 plus ``c_custkey % 28`` days, upper one day
    later.  Segment and nation stand in for the lookup fields: ``BUILDING``
    configs are manual (looked up by schema and table), ``MACHINERY`` ones
    scheduled (looked up by event name), other segments are inactive.
    """
    k = F.col("c_custkey")
    seg = F.col("c_mktsegment")
    nation = F.col("c_nationkey").cast("string")
    base = ts_lit(CONFIG_BASE_TS)
    strategies = F.array(*[F.lit(s) for s in STRATEGY_ORDER])
    return customer.select(
        k.alias("id"),
        F.element_at(strategies, (k % 9 + 1).cast("int")).alias("load_strategy"),
        (base + F.make_dt_interval((k % 28).cast("int"))).alias("cdc_timestamp"),
        (base + F.make_dt_interval((k % 28 + 1).cast("int"))).alias("to_cdc_timestamp"),
        F.col("c_nationkey"),
        seg.alias("c_mktsegment"),
        F.when(seg.isin("BUILDING", "MACHINERY"), "Y").otherwise("N").alias("active_flag"),
        F.when(seg == "BUILDING", "Y").otherwise("N").alias("manual_flag"),
        seg.alias("schema_name"),
        F.concat(F.lit("NATION_"), nation).alias("table_name"),
        F.concat(F.lit("EVT_NATION_"), nation).alias("cloudwatch_event_name"),
        F.nullif(seg, F.lit("BUILDING")).alias("query_parameter"),
        F.lit("DT+TM").alias("cdc_column"),
        F.lit("a,b").alias("primary_keys"),
        (k % 60).cast("string").alias("overlap_in_min"),
        F.lit(FMT).alias("cdc_ts_format"),
    )


def audit_header_from_orders(orders: DataFrame) -> DataFrame:
    """Audit header rows: one run per order, all flagged latest."""
    status = (
        F.when(F.col("o_orderstatus") == "O", "RUNNING")
        .when(F.col("o_orderstatus") == "F", "COMPLETED")
        .otherwise("STOPPED")
    )
    return orders.select(
        F.col("o_custkey").alias("audit_id"),
        F.col("o_orderdate").alias("insert_timestamp"),
        F.lit(1).alias("latest_record_ind"),
        F.col("o_orderkey").alias("workflow_run_id"),
        status.alias("workflow_header_status"),
        F.col("o_orderdate").alias("workflow_start_ts"),
        F.lit(0).cast("long").alias("src_record_count"),
        F.lit(0).cast("long").alias("target_record_count"),
    )


def audit_lines_from_orders(orders: DataFrame) -> DataFrame:
    """Audit line rows: one job run per order; the line key is the customer."""
    header = audit_header_from_orders(orders)
    return header.select(
        F.col("audit_id"),
        F.col("audit_id").cast("string").alias("audit_line_job_id"),
        F.col("workflow_start_ts").alias("job_start_ts"),
        F.col("workflow_run_id").alias("job_run_id"),
        F.col("workflow_header_status").alias("job_status"),
        F.col("latest_record_ind"),
        F.col("insert_timestamp"),
    )
