"""Runs whose control tables are logs (C5-C9, W6, R2, R5 in proportion to the run).

The config table is read as it is.  Of the six tables a run writes it reads
only the rows of the configs its requests match, by the buckets these fall
into, and appends only the rows it adds or changes (``sources.control_log``):
once when the audit rows are opened, once with the outcome.  What it costs
follows the requests, not the history.
"""

from __future__ import annotations

import datetime as _dt

from concurrent.futures import ThreadPoolExecutor
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.operators import config as cfgops
from sluice.plans.job import SCHEMAS, ControlTables, JobOutcome, run_requests
from sluice.sources import control_log
from sluice.sources.control_log import LogTable

#: Key a table is read by, and the columns that tell its rows apart.
KEYS = {
    "audit_spec": (("audit_id",), ("audit_id", "audit_line_job_id", "job_name", "schema_name", "table_name")),
    "audit_header": (("audit_id",), ("audit_id", "workflow_run_id", "insert_timestamp")),
    "audit_line": (("audit_id",), ("audit_id", "audit_line_job_id", "job_run_id", "insert_timestamp")),
    "restart": (("audit_id",), ("audit_id", "manual_flag", "step_id", "step_name", "insert_timestamp")),
    "watermark_log": (("audit_id",), ("audit_id", "insert_timestamp")),
    "extract_log": (("schema_name", "table_name"), ("schema_name", "table_name", "cdc_column")),
}


def log_tables(root: str, buckets: int = 64) -> dict[str, LogTable]:
    return {
        name: LogTable(f"{root.rstrip('/')}/{name}", SCHEMAS[name], key, identity, buckets)
        for name, (key, identity) in KEYS.items()
    }


def read_for(spark: SparkSession, logs: dict[str, LogTable], config: DataFrame, requests: DataFrame) -> ControlTables:
    """The control tables with the rows of the configs that ``requests`` match."""
    matches = cfgops.lookup_configs(config, requests.drop("workflow_run_id", "job_run_id"))
    ids = matches.select(F.col("id").alias("audit_id"), "schema_name", "table_name").distinct()
    return ControlTables(config, **{name: control_log.read_log(spark, t, ids) for name, t in logs.items()})


def _each(logs: dict[str, LogTable], commit: Callable[[str, LogTable], object]) -> None:
    """``commit`` for every table, side by side: each is a few small Spark jobs."""
    with ThreadPoolExecutor(max_workers=len(logs)) as pool:
        list(pool.map(lambda item: commit(*item), logs.items()))


def import_tables(spark: SparkSession, logs: dict[str, LogTable], tables: ControlTables) -> None:
    """Start the logs from existing control tables."""
    _each(logs, lambda name, t: control_log.append_changes(spark, t, None, getattr(tables, name)))


def run_logged(
    spark: SparkSession,
    root: str,
    config: DataFrame,
    requests: DataFrame,
    source_for,
    job_name: str,
    now: _dt.datetime,
    compact_at: int = 32,
    **options,
) -> JobOutcome:
    """``run_requests`` over the logs below ``root``; the outcome's tables hold the rows of this run's configs.

    The journal lies below ``root``, so the same requests can be run again
    after a crash (``resume``).  Buckets with ``compact_at`` segments or more
    are rewritten at the end.
    """
    logs = log_tables(root)
    before = read_for(spark, logs, config, requests)
    opened: list[ControlTables] = []

    def note_opened(tables: ControlTables) -> None:
        _each(logs, lambda name, t: control_log.append_changes(spark, t, getattr(before, name), getattr(tables, name)))
        opened.append(tables)

    outcome = run_requests(
        spark, before, requests, source_for, job_name, now,
        persist=note_opened, journal=f"{root.rstrip('/')}/journal", resume=True, **options,
    )

    def close(name: str, t: LogTable) -> None:
        control_log.append_changes(spark, t, getattr(opened[0], name), getattr(outcome.tables, name))
        control_log.compact_log(spark, t, compact_at)

    _each(logs, close)
    return outcome
