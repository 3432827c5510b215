"""A whole extraction run for a table of run requests.

The reference does one config per job: look it up, open the audit rows,
check the restart table, extract, store counts, move the watermark, log.
``run_requests`` does the same for many requests at once.  Every control-table
step is one set-based operator over all runs; only the extractions themselves
are separate Spark jobs, one per config, because each reads its own source
table.  The per-config loop iterates over matched config rows (bounded by the
request table), never over data.

Control tables are read as DataFrames and the new versions are returned; the
caller writes them to new paths (``write_control_tables``), as a path cannot
be overwritten while it is being read.
"""

from __future__ import annotations

import datetime as _dt
import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field, fields
from typing import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.functions.predicates import upper_bound_used
from sluice.functions.timefmt import ts_lit
from sluice.operators import audit, config as cfgops, counts, restart, watermark
from sluice.plans.extract import ExtractionConfig, ExtractionResult, Source, run_extraction
from sluice.plans.scratch import scratch_dir
from sluice.plans.shared import shareable, shared_scan
from sluice.operators.audit import RUNNING
from sluice.sources import control


@dataclass
class ControlTables:
    config: DataFrame
    audit_spec: DataFrame
    audit_header: DataFrame
    audit_line: DataFrame
    restart: DataFrame
    watermark_log: DataFrame
    extract_log: DataFrame


SCHEMAS = {
    "config": control.CONFIG,
    "audit_spec": control.AUDIT_SPEC,
    "audit_header": control.AUDIT_HEADER,
    "audit_line": control.AUDIT_LINE,
    "restart": control.RESTART,
    "watermark_log": control.WATERMARK_LOG,
    "extract_log": control.EXTRACT_LOG,
}


@dataclass
class JobOutcome:
    tables: ControlTables
    runs: DataFrame  # one row per request with verdict, exit flag, counts, gate, next bounds
    results: dict = field(default_factory=dict)  # config id -> ExtractionResult, shared by its requests
    errors: dict = field(default_factory=dict)  # config id -> error text


def empty_control_tables(spark: SparkSession, config: DataFrame) -> ControlTables:
    return ControlTables(
        config,
        *[control.empty(spark, SCHEMAS[f.name]) for f in fields(ControlTables)[1:]],
    )


def read_control_tables(spark: SparkSession, root: str) -> ControlTables:
    return ControlTables(
        *[spark.read.schema(SCHEMAS[f.name]).parquet(f"{root}/{f.name}") for f in fields(ControlTables)]
    )


def write_control_tables(tables: ControlTables, root: str) -> None:
    """Write every control table under a new ``root`` (one version per run)."""
    for f in fields(ControlTables):
        df: DataFrame = getattr(tables, f.name)
        df.select([c.name for c in SCHEMAS[f.name].fields]).write.mode("overwrite").parquet(f"{root}/{f.name}")


def run_requests(
    spark: SparkSession,
    tables: ControlTables,
    requests: DataFrame,
    source_for: Callable[[ExtractionConfig], DataFrame],
    job_name: str,
    now: _dt.datetime,
    target_path_for: Callable[[ExtractionConfig], str] | None = None,
    max_parallel: int | None = None,
    persist: Callable[[ControlTables], None] | None = None,
    journal: str | None = None,
    resume: bool = False,
    share_scans: bool = False,
) -> JobOutcome:
    """Run every request that matches exactly one active config.

    Several requests for one config extract it once and share the outcome.

    The extractions are submitted from ``max_parallel`` threads, so independent
    tables load side by side on the cluster (Spark accepts jobs from several
    threads of one session); by default as many as the session has task slots.

    ``persist`` receives the control tables with the audit rows opened and the
    restart rows cleared, before anything is extracted; each extraction's
    outcome is then appended under ``journal``.  A run that dies midway so
    leaves RUNNING rows and the outcomes it had.  The same requests run again
    (same config and ``workflow_run_id``) take these outcomes from the journal
    instead of extracting once more, and an extraction that had written but
    not been noted replaces what it wrote.  With ``resume`` the audit rows the
    earlier try opened are used again rather than opened twice.

    ``share_scans`` reads a table once for all its configs (``plans.shared``).

    ``requests`` columns: ``request_id, manual_flag, schema_name, table_name,
    config_id, cloudwatch_event_name, workflow_run_id, job_run_id``.
    ``source_for`` returns the source DataFrame of a config (Parquet, or a
    JDBC table whose filters Spark pushes down), or a ``Source`` pairing the
    rows with a frame for TL-AGG's aggregate.
    """
    matches = cfgops.lookup_configs(tables.config, requests.drop("workflow_run_id", "job_run_id"), counted=True)
    verdicts = cfgops.check_requests(requests, matches, tables.config)  # C2
    ok = verdicts.where(F.col("verdict") == "OK").select("request_id", "workflow_run_id", "job_run_id")
    # the one config of each
    runs = matches.drop(cfgops.CONFIGS).join(ok, "request_id", "inner")

    # C4: audit spec; each run learns its line id.
    spec = audit.upsert_audit_spec(
        tables.audit_spec,
        runs.select(F.col("id").alias("audit_id"), "schema_name", "table_name"),
        job_name,
        now,
    )
    line_ids = spec.where(F.col("job_name") == job_name).select(
        "audit_id", "schema_name", "table_name", "audit_line_job_id"
    )
    runs = runs.join(
        line_ids.withColumnRenamed("audit_id", "id"), ["id", "schema_name", "table_name"], "left"
    )
    # Every later step reads the runs; a reliable checkpoint (in the shared
    # spark.checkpoint.dir) computes the lookup once and keeps it fixed.
    scratch_dir(spark)
    runs = runs.checkpoint(eager=True)

    # Header.
    current = runs.select(F.col("id").alias("audit_id"), "workflow_run_id")
    header = audit.retire_header(tables.audit_header, current)
    opened = current
    if resume:
        still_open = tables.audit_header.where(
            (F.col("latest_record_ind") == 1) & (F.col("workflow_header_status") == RUNNING)
        )
        opened = current.join(still_open.select("audit_id", "workflow_run_id").distinct(), ["audit_id", "workflow_run_id"], "left_anti")
    header = audit.append_header(
        header,
        opened.withColumn("workflow_header_status", F.lit(RUNNING)).withColumn(
            "workflow_start_ts", ts_lit(now)
        ),
        now,
    )

    # Lines.
    line_runs = runs.select(
        F.col("id").alias("audit_id"),
        "audit_line_job_id",
        ts_lit(now).alias("job_start_ts"),
        "job_run_id",
        F.lit(RUNNING).alias("job_status"),
    )
    new_lines = line_runs
    if resume:
        still_open = tables.audit_line.where((F.col("latest_record_ind") == 1) & (F.col("job_status") == RUNNING))
        same_run = ["audit_id", "audit_line_job_id", "job_run_id"]
        new_lines = line_runs.join(still_open.select(*same_run).distinct(), same_run, "left_anti")
    lines = audit.append_lines(audit.retire_lines(tables.audit_line, line_runs), new_lines, now)

    # Restart gate; R4: clear the rows of the configs that will extract.
    gated = restart.restart_gate(
        runs, tables.restart, ["id", "manual_flag"], ["audit_id", "manual_flag"]
    )
    plan_rows = gated.collect()  # one row per matched config (bounded by the requests)
    to_extract = list({r["id"]: r for r in plan_rows if r["exit_flag"] == "N"}.values())  # once per config
    restart_tbl = restart.clear_restart(
        tables.restart,
        spark.createDataFrame(
            [(str(r["id"]), r["manual_flag"]) for r in to_extract], "audit_id string, manual_flag string"
        ),
        ["audit_id", "manual_flag"],
    )

    if persist is not None:
        persist(ControlTables(tables.config, spec, header, lines, restart_tbl, tables.watermark_log, tables.extract_log))

    # One extraction per config.
    results: dict = {}
    errors: dict = {}
    run_ids = _run_ids(plan_rows)
    done = _noted(spark, journal, run_ids, to_extract, now) if journal is not None else {}
    results.update(done)
    to_run = [r for r in to_extract if r["id"] not in done]

    def config_of(r) -> ExtractionConfig:
        cfg = ExtractionConfig.from_mapping(r.asDict())
        return cfg.with_path(target_path_for(cfg)) if target_path_for is not None else cfg

    staged = _shared_sources(to_run, config_of, source_for, now) if share_scans else {}

    def extract_one(r):
        try:
            cfg = config_of(r)
            src = staged.get(r["id"])
            prefiltered = src is not None
            src = source_for(cfg) if src is None else src
            pair = src if isinstance(src, Source) else Source(src)
            res = run_extraction(
                pair.rows, cfg, now, agg_source=pair.aggregates, run_id=run_ids.get(r["id"]), prefiltered=prefiltered
            )
            return r["id"], res, None
        except Exception as exc:  # every failure leaves a restart row (fixes #17)
            return r["id"], None, f"{type(exc).__name__}: {exc}"

    def extract_and_note(r):
        cid, res, err = extract_one(r)
        if journal is not None:
            # a folder each: writers of one folder would share its temporary files
            row = _outcome_row(spark, cid, run_ids.get(cid), res, err)
            row.write.parquet(f"{journal.rstrip('/')}/outcome={uuid.uuid4().hex}")
        return cid, res, err

    with ThreadPoolExecutor(max_workers=max_parallel or spark.sparkContext.defaultParallelism) as pool:
        outcomes = list(pool.map(extract_and_note, to_run))
    for cid, res, err in outcomes:
        if err is None:
            results[cid] = res
        else:
            errors[cid] = err

    # Restart rows for failures.
    failed = [r for r in to_extract if r["id"] in errors]
    restart_tbl = restart.record_restart(
        restart_tbl,
        spark.createDataFrame(
            [(str(r["id"]), r["schema_name"], r["table_name"], r["manual_flag"]) for r in failed],
            "audit_id string, schema_name string, table_name string, manual_flag string",
        ),
        job_name,
        now,
    )

    res = _results_frame(spark, plan_rows, results, errors)

    # C7 then C10 + R1: counts stored on the run's latest header row, read back for the gate.
    header = audit.set_header_counts(
        header,
        res.select(F.col("id").alias("audit_id"), "workflow_run_id", "src_record_count", "target_record_count")
        .where(F.col("src_record_count").isNotNull())
        .distinct(),
    )
    stored = audit.header_counts(header, res.select(F.col("id").alias("audit_id"), "workflow_run_id"))
    res = res.join(
        stored.select(
            F.col("audit_id").alias("id"),
            "workflow_run_id",
            counts.reconcile_gate(F.col("src_record_count"), F.col("target_record_count")).alias("gate"),
            counts.gate_reason(F.col("src_record_count"), F.col("target_record_count")).alias("gate_reason"),
        ),
        ["id", "workflow_run_id"],
        "left",
    )

    # W1-W5, W6.
    advanced = watermark.advance_watermark(res, now)
    wm_log = watermark.append_watermark_log(
        tables.watermark_log, watermark.watermark_log_rows(advanced.dropDuplicates(["id"]), now, id_column="id")
    )

    # R2: extraction log for the gated strategies that passed and loaded a date.
    log_updates = advanced.where(
        F.col("load_strategy").isin("IO-SNAP-MAX-CDC", "IO-CUSTOM-CDC")
        & F.col("gate")
        & F.col("max_value").isNotNull()
    ).select(
        "schema_name",
        "table_name",
        F.col("cdc_column"),
        F.col("max_value").alias("delta_completion_date"),
    )
    ext_log = audit.upsert_extract_log(
        tables.extract_log, log_updates, ["schema_name", "table_name"], now
    ).drop("action")

    new_tables = ControlTables(tables.config, spec, header, lines, restart_tbl, wm_log, ext_log)
    runs_out = verdicts.join(
        advanced.select(
            "request_id", "id", "load_strategy", "exit_flag", "src_record_count", "target_record_count",
            "is_extracted", "gate", "gate_reason", "next_cdc_ts", "next_to_ts", "error",
        ),
        "request_id",
        "left",
    )
    return JobOutcome(new_tables, runs_out, results, errors)


OUTCOME = (
    "id string, run_id string, src_record_count long, target_record_count long, is_extracted boolean, "
    "read_ts timestamp_ntz, max_value date, wrote boolean, error string"
)


def _run_ids(plan_rows) -> dict:
    """What tells one run of a config from the next: its id with the first of its workflow runs."""
    first: dict = {}
    for r in plan_rows:
        if r["workflow_run_id"] is not None:
            wf = str(r["workflow_run_id"])
            first[r["id"]] = min(wf, first.get(r["id"], wf))
    return {cid: f"{cid}/{wf}" for cid, wf in first.items()}


def _outcome_row(spark: SparkSession, config_id, run_id: str | None, result: ExtractionResult | None, error: str | None) -> DataFrame:
    """One extraction's outcome as the journal keeps it."""
    r = result
    row = (r.src_record_count, r.target_record_count, r.is_extracted, r.read_ts, r.max_partition_date, r.wrote) if r else (None,) * 6
    return spark.createDataFrame([(str(config_id), run_id, *row, error)], OUTCOME).coalesce(1)


def _noted(spark: SparkSession, journal: str, run_ids: dict, rows, now: _dt.datetime) -> dict:
    """Results of these runs that an earlier try noted in the journal, by config id."""
    wanted = {run_ids[r["id"]]: r for r in rows if r["id"] in run_ids}
    if not wanted:
        return {}
    try:
        noted = spark.read.schema(OUTCOME).parquet(journal)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return {}
    keys = spark.createDataFrame([(k,) for k in wanted], "run_id string")
    found = noted.where("error is null").join(keys, "run_id", "left_semi").dropDuplicates(["run_id"]).collect()
    out = {}
    for n in found:  # at most one row per run asked for
        row = wanted[n["run_id"]]
        cfg = ExtractionConfig.from_mapping(row.asDict())
        upper = upper_bound_used(cfg.load_strategy, cfg.to_cdc_timestamp, now)
        out[row["id"]] = ExtractionResult(
            cfg, n["src_record_count"], n["target_record_count"], n["is_extracted"], n["read_ts"], upper, n["max_value"], n["wrote"], resumed=True
        )
    return out


def _shared_sources(rows, config_of, source_for, now: _dt.datetime) -> dict:
    """Staged rows by config id, for tables that several of the configs read."""
    groups: dict = {}
    for r in rows:
        try:
            cfg = config_of(r)
        except ValueError:
            continue  # reported by the config's own run
        if shareable(cfg):
            groups.setdefault((cfg.schema_name, cfg.table_name), []).append((r["id"], cfg))
    staged = {}
    for own in groups.values():
        if len(own) < 2:
            continue
        try:
            src = source_for(own[0][1])
            src = src.rows if isinstance(src, Source) else src
            staged.update(zip([cid for cid, _ in own], shared_scan(src, [c for _, c in own], now)))
        except Exception:
            continue  # one config's fault must not stop the others: each runs, and reports, on its own
    return staged


def _results_frame(spark: SparkSession, plan_rows, results: dict, errors: dict) -> DataFrame:
    """One row per matched run with its bounds and extraction outcome."""
    out = []
    for r in plan_rows:
        res: ExtractionResult | None = results.get(r["id"])
        try:
            cfg = ExtractionConfig.from_mapping(r.asDict()) if res is None else res.config
            strategy = cfg.load_strategy.value
            lower, upper = cfg.cdc_timestamp, cfg.to_cdc_timestamp
        except ValueError:
            strategy, lower, upper = r["load_strategy"], r["cdc_timestamp"], r["to_cdc_timestamp"]
        out.append(
            (
                r["request_id"],
                str(r["id"]),
                str(r["workflow_run_id"]) if r["workflow_run_id"] is not None else None,
                r["exit_flag"],
                strategy,
                r["schema_name"],
                r["table_name"],
                r["cdc_column"],
                lower,
                upper,
                r["cdc_ts_format"],
                res.read_ts if res else None,
                res.max_partition_date if res else None,
                res.src_record_count if res else None,
                res.target_record_count if res else None,
                res.is_extracted if res else False,
                errors.get(r["id"]),
            )
        )
    schema = (
        "request_id string, id string, workflow_run_id string, exit_flag string, load_strategy string, "
        "schema_name string, table_name string, cdc_column string, cdc_timestamp timestamp_ntz, "
        "to_cdc_timestamp timestamp_ntz, cdc_ts_format string, read_ts timestamp_ntz, max_value date, "
        "src_record_count long, target_record_count long, is_extracted boolean, error string"
    )
    return spark.createDataFrame(out, schema)
