"""Command line: run extraction requests against versioned control tables.

    python -m sluice (--log ROOT | --control ROOT --out NEW_ROOT) --source-root DIR \\
        (--schema S --table T [--id ID] | --event NAME) \\
        --workflow-run-id W --job-run-id J [--job-name N] [--now ISO] [--target-root DIR]

The run request takes the place of the reference's job arguments.  Control
tables are logs below ``ROOT`` that the run appends to, or are read from
``ROOT`` and written whole to ``NEW_ROOT``.  The same command run again after a
crash takes up where the first one died.
Sources are Parquet at ``{source-root}/{table}.parquet`` or
``{source-root}/{schema}/{table}``, or, with ``--jdbc-url``, the table
``schema.table`` of a JDBC database (password from the environment variable
named by ``--jdbc-password-env``; it is never printed).  A config with source
partition columns is then read as one parallel JDBC partition per slice.
The session comes from the environment (``spark-submit`` settings).
"""

from __future__ import annotations

import argparse
import datetime as _dt
import json
import os
import sys


JDBC_CATALOG = "sluice_src"
REQUEST_SCHEMA = (
    "request_id string, manual_flag string, schema_name string, table_name string, config_id string, "
    "cloudwatch_event_name string, workflow_run_id string, job_run_id string"
)


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="sluice", description=__doc__.splitlines()[0])
    p.add_argument("--control", help="root of the control tables to read")
    p.add_argument("--out", help="new root for the control tables this run leaves")
    p.add_argument("--log", help="root of a control log, read and appended to in place: the config table in "
                                 "<root>/config, the other tables as logs")
    p.add_argument("--share-scans", action="store_true", help="read a table once for all its configs")
    p.add_argument("--source-root")
    p.add_argument("--jdbc-url")
    p.add_argument("--jdbc-user")
    p.add_argument("--jdbc-password-env")
    p.add_argument("--jdbc-driver")
    p.add_argument("--jdbc-partitions", type=int, default=8,
                   help="parallel range reads of an unpartitioned config's delta window")
    p.add_argument("--schema")
    p.add_argument("--table")
    p.add_argument("--id")
    p.add_argument("--event")
    p.add_argument("--workflow-run-id")
    p.add_argument("--job-run-id")
    p.add_argument("--requests", help="JSON-lines file of run requests (one object per line, same fields "
                                      "as the single-request options) run in one application")
    p.add_argument("--parallel", type=int, default=None, help="concurrent extractions (default: the session's task slots)")
    p.add_argument("--input-bytes", type=int, help="size the session for this much input (with --executors, --cores)")
    p.add_argument("--executors", type=int, default=1)
    p.add_argument("--cores", type=int, default=1, help="cores per executor")
    p.add_argument("--job-name", default="sluice-extract")
    p.add_argument("--now")
    p.add_argument("--target-root")
    return p


def jdbc_options_from_args(args) -> dict[str, str] | None:
    if not args.jdbc_url:
        return None
    from sluice.sources.jdbc import jdbc_options

    password = os.environ.get(args.jdbc_password_env) if args.jdbc_password_env else None
    return jdbc_options(args.jdbc_url, user=args.jdbc_user, password=password, driver=args.jdbc_driver)


def main(argv: list[str] | None = None, spark=None) -> dict:
    args = _parser().parse_args(argv)
    if not args.log and not (args.control and args.out):
        raise SystemExit("either --log or both --control and --out are required")
    if not args.source_root and not args.jdbc_url:
        raise SystemExit("one of --source-root or --jdbc-url is required")
    from pyspark.errors import AnalysisException
    from pyspark.sql import SparkSession

    from sluice.plans.job import read_control_tables, run_requests, write_control_tables

    spark = spark or (
        SparkSession.builder.appName("sluice").config("spark.ui.enabled", "false").getOrCreate()
    )
    if args.input_bytes:
        from sluice.plans.sizing import scale_settings

        for key, value in scale_settings(args.input_bytes, args.executors, args.cores).items():
            spark.conf.set(key, value)
    now = _dt.datetime.fromisoformat(args.now) if args.now else _dt.datetime.now().replace(microsecond=0)
    if args.requests:
        request = spark.read.schema(REQUEST_SCHEMA).json(args.requests)
    else:
        if not (args.workflow_run_id and args.job_run_id):
            raise SystemExit("--workflow-run-id and --job-run-id are required for a single request")
        manual = "N" if args.event else "Y"
        request = spark.createDataFrame(
            [("cli", manual, args.schema, args.table, args.id, args.event, args.workflow_run_id, args.job_run_id)],
            REQUEST_SCHEMA,
        )

    jdbc = jdbc_options_from_args(args)

    if jdbc is not None:
        from sluice.sources.jdbc import register_jdbc_catalog

        register_jdbc_catalog(spark, JDBC_CATALOG, jdbc)

    def source_for(cfg):
        if jdbc is not None:
            from sluice.plans.extract import Source, discover_slices
            from sluice.sources.jdbc import (
                read_jdbc_slices,
                read_jdbc_table,
                read_jdbc_window,
                sliced_jdbc_source,
                window_partitioning,
            )
            from sluice.sources.slices import table_ranges

            table = f"{cfg.schema_name}.{cfg.table_name}"
            # The catalog table pushes GROUP BY and MAX into the database:
            # discovery and TL-AGG's aggregate never stream the table.
            catalog_table = spark.table(f"{JDBC_CATALOG}.{table}")
            if not cfg.source_partition_column:
                if args.jdbc_partitions <= 1:
                    return Source(read_jdbc_table(spark, jdbc, table), catalog_table)
                window = window_partitioning(cfg, now)
                if window is not None:
                    return Source(read_jdbc_window(spark, jdbc, table, *window, args.jdbc_partitions), catalog_table)
                keys = [c for c in cfg.primary_keys if c in catalog_table.columns]
                if not keys:
                    return Source(read_jdbc_table(spark, jdbc, table), catalog_table)
                # a full pull: quantiles of the key, of any type and number of columns
                predicates = table_ranges(catalog_table, keys, args.jdbc_partitions)
                return Source(read_jdbc_slices(spark, jdbc, table, predicates), catalog_table)
            keys = discover_slices(catalog_table, cfg, now, counted=True)
            rows = sliced_jdbc_source(
                spark, jdbc, table, catalog_table, keys, list(cfg.source_partition_column),
                primary_keys=tuple(c for c in cfg.primary_keys if c in catalog_table.columns),
            )
            return Source(rows, catalog_table)
        flat = f"{args.source_root.rstrip('/')}/{cfg.table_name}.parquet"
        try:
            return spark.read.parquet(flat)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
        return spark.read.parquet(f"{args.source_root.rstrip('/')}/{cfg.schema_name}/{cfg.table_name}")

    target_for = (lambda c: f"{args.target_root.rstrip('/')}/{c.id}") if args.target_root else None
    options = dict(target_path_for=target_for, max_parallel=args.parallel, share_scans=args.share_scans)
    if args.log:
        from sluice.plans.logged import run_logged
        from sluice.sources.control import CONFIG

        config = spark.read.schema(CONFIG).parquet(f"{args.log.rstrip('/')}/config")
        outcome = run_logged(spark, args.log, config, request, source_for, args.job_name, now, **options)
    else:
        outcome = run_requests(
            spark,
            read_control_tables(spark, args.control),
            request,
            source_for,
            args.job_name,
            now,
            persist=lambda tables: write_control_tables(tables, f"{args.out.rstrip('/')}/opened"),
            journal=f"{args.out.rstrip('/')}/outcomes",
            **options,
        )
        write_control_tables(outcome.tables, args.out)
    summaries = []
    for row in outcome.runs.collect():  # one row per request
        d = row.asDict()
        summaries.append({k: (v.isoformat(sep=" ") if isinstance(v, (_dt.datetime, _dt.date)) else v)
                          for k, v in d.items()})
    for summary in summaries:
        print(json.dumps(summary))
    return summaries[0] if len(summaries) == 1 else {"runs": summaries}


def _ok(summary: dict) -> bool:
    return summary.get("verdict") == "OK" and not summary.get("error")


if __name__ == "__main__":
    result = main()
    runs = result.get("runs", [result])
    sys.exit(0 if all(_ok(r) for r in runs) else 1)
