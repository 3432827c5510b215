"""Watermark advance and log (W1-W6), set-based over runs.

One ``when`` chain computes the next bounds of every finished run at once; a
single config run is the one-row case of the same operator.  Upper bounds
that do not apply are real nulls (the reference stored the text ``'NULL'``).

Input columns of ``runs``:

* ``load_strategy``, ``cdc_timestamp``, ``to_cdc_timestamp`` - the bounds used
* ``read_ts``       - time the read was defined (W3); defaults to ``now``
* ``max_value``     - newest loaded partition date (A7, W4)
* ``gate``          - count reconciliation passed (R1, W4/W5)
* ``is_extracted``  - anything was extracted (A6); no advance otherwise
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.functions.timefmt import day_end, day_start, ts_lit


def _col_or(runs: DataFrame, name: str, default: Column) -> Column:
    return F.col(name) if name in runs.columns else default


def advance_watermark(runs: DataFrame, now: _dt.datetime) -> DataFrame:
    """Add ``next_cdc_ts`` and ``next_to_ts`` (both ``timestamp_ntz``)."""
    strategy = F.col("load_strategy")
    lower = F.col("cdc_timestamp")
    upper = F.col("to_cdc_timestamp")
    run_time = ts_lit(now)
    read_ts = _col_or(runs, "read_ts", run_time)
    gate = F.coalesce(_col_or(runs, "gate", F.lit(False)), F.lit(False))
    extracted = F.coalesce(_col_or(runs, "is_extracted", F.lit(True)), F.lit(True))
    max_day = day_start(_col_or(runs, "max_value", F.lit(None).cast("date")).cast("timestamp_ntz"))
    one_day = F.make_dt_interval(F.lit(1))
    null_ts = F.lit(None).cast("timestamp_ntz")

    next_lower = (
        F.when(strategy == "IO-SNAP", lower + one_day)  # W1
        .when(strategy == "IO-SNAP-DLY", day_start(upper + one_day))  # W2
        .when(strategy.isin("IO-CDC", "TL-CDC"), read_ts)  # W3
        .when((strategy == "IO-SNAP-MAX-CDC") & gate, max_day + one_day)  # W4
        .when((strategy == "IO-CUSTOM-CDC") & gate, day_start(run_time))  # W5
        .otherwise(null_ts)
    )
    next_upper = (
        F.when(strategy == "IO-SNAP-DLY", upper + one_day)
        .when((strategy == "IO-SNAP-MAX-CDC") & gate, day_end(max_day + one_day))
        .when((strategy == "IO-CUSTOM-CDC") & gate, day_end(run_time))
        .otherwise(null_ts)
    )
    return runs.withColumn("next_cdc_ts", F.when(extracted, next_lower).otherwise(null_ts)).withColumn(
        "next_to_ts", F.when(extracted, next_upper).otherwise(null_ts)
    )


def advanced_runs(runs: DataFrame, now: _dt.datetime) -> DataFrame:
    """Only the runs whose lower bound moves."""
    return advance_watermark(runs, now).where(F.col("next_cdc_ts").isNotNull())


def watermark_log_rows(advanced: DataFrame, now: _dt.datetime, id_column: str = "id") -> DataFrame:
    """W6 rows: ``audit_id, insert_timestamp, cdc_timestamp,
    cdc_timestamp_fmt, to_cdc_timestamp`` for every run with a new lower bound."""
    fmt = F.col("cdc_ts_format") if "cdc_ts_format" in advanced.columns else F.lit(None).cast("string")
    return advanced.where(F.col("next_cdc_ts").isNotNull()).select(
        F.col(id_column).alias("audit_id"),
        ts_lit(now).alias("insert_timestamp"),
        F.col("next_cdc_ts").alias("cdc_timestamp"),
        fmt.alias("cdc_timestamp_fmt"),
        F.col("next_to_ts").alias("to_cdc_timestamp"),
    )


def append_watermark_log(log: DataFrame, new_rows: DataFrame) -> DataFrame:
    """The log with the new rows appended (by name; missing columns null)."""
    return log.unionByName(new_rows, allowMissingColumns=True)


def latest_watermarks(log: DataFrame) -> DataFrame:
    """The newest log row per ``audit_id`` (what a next run would start from).

    Of rows with one time stamp the one with the later bounds counts.  The
    maximum is a partial aggregate, so a config with a long history is folded
    map-side rather than sorted in one task.
    """
    bounds = ["cdc_timestamp", "to_cdc_timestamp", "cdc_timestamp_fmt"]
    latest = F.max(F.struct("insert_timestamp", *bounds))
    return log.groupBy("audit_id").agg(latest.alias("w")).select("audit_id", *[f"w.{c}" for c in bounds])
