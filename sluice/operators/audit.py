"""Audit spec, header and line tables, and the extraction log.

The reference runs one ``UPDATE``/``INSERT`` statement per run through a
remote SQL API.  Plain Parquet has no ``UPDATE``, so each operator returns the
whole new table as a DataFrame; the caller writes it to a new path (reading
and overwriting one path in the same job fails).  All operators take the
runs of many configs at once.  The run side is one row per config; the
history side grows without bound, so every join keeps the history as the
streamed side and lets AQE broadcast the run side only after measuring it.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.functions.keys import job_line_id
from sluice.functions.timefmt import ts_lit

# The description stored with every audit spec row, the status
# that keeps a header or line row latest, and the status of a new
# extraction-log row.
SPEC_DESCRIPTION = "Ingesting into S3 raw"
RUNNING = "RUNNING"
COMPLETED = "COMPLETED"


def upsert_audit_spec(spec: DataFrame, runs: DataFrame, job_name: str, now: _dt.datetime) -> DataFrame:
    """C4: insert a spec row for every ``(audit_id, job, schema, table)`` not
    present yet; existing rows are kept unchanged.

    ``runs`` columns: ``audit_id, schema_name, table_name``.
    ``audit_line_job_id = md5(concat(upper(job), upper(schema), upper(table)))``.
    """
    keys = ["audit_id", "job_name", "schema_name", "table_name"]
    wanted = (
        runs.select("audit_id", "schema_name", "table_name")
        .withColumn("job_name", F.lit(job_name))
        .dropDuplicates(keys)  # one spec row even when a config is run twice at once
    )
    new = wanted.join(spec.select(*keys), keys, "left_anti").select(
        F.col("audit_id"),
        job_line_id(F.col("job_name"), F.col("schema_name"), F.col("table_name")).alias("audit_line_job_id"),
        F.col("job_name"),
        F.lit(SPEC_DESCRIPTION).alias("description"),
        F.col("schema_name"),
        F.col("table_name"),
        ts_lit(now).alias("insert_timestamp"),
    )
    return spec.unionByName(new.select(*[c for c in spec.columns if c in new.columns]), allowMissingColumns=True)


def retire_header(header: DataFrame, current_runs: DataFrame) -> DataFrame:
    """``latest_record_ind = 0`` for an audit id's rows of other runs that
    are not ``RUNNING``.  The current run, running rows, rows with a null
    status and audit ids not being run now are untouched.

    ``current_runs`` columns: ``audit_id, workflow_run_id``.  Several current
    runs of one audit id behave like their updates applied one after another:
    a row is retired when some current run of its audit id is another run.
    The runs are folded to one row per audit id first, so the join never
    multiplies history rows.
    """
    cur = current_runs.groupBy("audit_id").agg(
        F.countDistinct("workflow_run_id").alias("__n_cur"),
        F.max("workflow_run_id").alias("__cur_run"),
    )
    joined = header.join(cur, "audit_id", "left")
    other_run = (F.col("__n_cur") > 1) | (F.col("workflow_run_id") != F.col("__cur_run"))
    retire = F.col("__cur_run").isNotNull() & other_run & (F.col("workflow_header_status") != RUNNING)
    ind = F.when(retire, F.lit(0)).otherwise(F.col("latest_record_ind"))
    return joined.withColumn("latest_record_ind", ind.cast(header.schema["latest_record_ind"].dataType)).select(
        *header.columns
    )


def append_header(header: DataFrame, runs: DataFrame, now: _dt.datetime) -> DataFrame:
    """One new latest row per run.

    ``runs`` columns: ``audit_id, workflow_run_id, workflow_header_status,
    workflow_start_ts``.
    """
    new = runs.select(
        F.col("audit_id"),
        ts_lit(now).alias("insert_timestamp"),
        F.lit(1).alias("latest_record_ind"),
        F.col("workflow_run_id"),
        F.col("workflow_header_status"),
        F.col("workflow_start_ts"),
    )
    return header.unionByName(new, allowMissingColumns=True)


def set_header_counts(
    header: DataFrame,
    counts: DataFrame,
    keys: tuple[str, ...] = ("audit_id", "workflow_run_id"),
) -> DataFrame:
    """Store the read/write counts on the latest row of each run.

    ``counts`` columns: ``keys + [src_record_count, target_record_count]``.
    Rows of other runs keep their counts.
    """
    # one counts row per run, so the join never multiplies header rows
    pair = F.max(F.struct("src_record_count", "target_record_count"))
    c = counts.groupBy(*keys).agg(pair.alias("__c")).select(
        *keys, F.col("__c.src_record_count").alias("__src"), F.col("__c.target_record_count").alias("__tgt")
    )
    joined = header.join(c, list(keys), "left")
    hit = F.col("__src").isNotNull() & (F.col("latest_record_ind") == 1)
    src_t = header.schema["src_record_count"].dataType
    tgt_t = header.schema["target_record_count"].dataType
    return (
        joined.withColumn("src_record_count", F.when(hit, F.col("__src")).otherwise(F.col("src_record_count")).cast(src_t))
        .withColumn(
            "target_record_count", F.when(hit, F.col("__tgt")).otherwise(F.col("target_record_count")).cast(tgt_t)
        )
        .select(*header.columns)
    )


def header_counts(header: DataFrame, runs: DataFrame) -> DataFrame:
    """The counts on the latest header row of each run (feeds R1).

    Several latest rows for one run (a rerun under the same run id) are
    folded to one, keeping the newest counts, so each run gets one row.
    """
    # both counts come from one row: the newest, then the one with the larger counts
    pair = ["src_record_count", "target_record_count"]
    order = F.struct(*(c for c in ("insert_timestamp",) if c in header.columns), *pair)
    latest = (
        header.where(F.col("latest_record_ind") == 1)
        .groupBy("audit_id", "workflow_run_id")
        .agg(F.max_by(F.struct(*pair), order).alias("c"))
        .select("audit_id", "workflow_run_id", "c.src_record_count", "c.target_record_count")
    )
    return runs.select("audit_id", "workflow_run_id").join(latest, ["audit_id", "workflow_run_id"], "left")


def retire_lines(lines: DataFrame, current_runs: DataFrame) -> DataFrame:
    """``latest_record_ind = 0`` for the non-running rows of each
    ``(audit_id, audit_line_job_id)`` being run now.  Unlike the header there
    is no current-run exemption: this runs before the new line is added."""
    cur = current_runs.select("audit_id", "audit_line_job_id").distinct().withColumn("__hit", F.lit(True))
    joined = lines.join(cur, ["audit_id", "audit_line_job_id"], "left")
    retire = F.col("__hit").isNotNull() & (F.col("job_status") != RUNNING)
    ind = F.when(retire, F.lit(0)).otherwise(F.col("latest_record_ind"))
    return joined.withColumn("latest_record_ind", ind.cast(lines.schema["latest_record_ind"].dataType)).select(
        *lines.columns
    )


def append_lines(lines: DataFrame, runs: DataFrame, now: _dt.datetime) -> DataFrame:
    """One new latest line per run.

    ``runs`` columns: ``audit_id, audit_line_job_id, job_start_ts,
    job_run_id, job_status``.
    """
    new = runs.select(
        F.col("audit_id"),
        F.col("audit_line_job_id"),
        F.col("job_start_ts"),
        F.col("job_run_id"),
        F.col("job_status"),
        F.lit(1).alias("latest_record_ind"),
        ts_lit(now).alias("insert_timestamp"),
    )
    return lines.unionByName(new, allowMissingColumns=True)


def upsert_extract_log(
    log: DataFrame,
    updates: DataFrame,
    keys: list[str],
    now: _dt.datetime,
    status: str = COMPLETED,
) -> DataFrame:
    """R2: merge the newest completion dates into the extraction log.

    Keys present on both sides are updated (``UPDATE``), keys only in
    ``updates`` are inserted with ``status`` (``INSERT``), the rest stay
    (``KEEP``).  ``updates`` columns: ``keys + [delta_completion_date]``
    (plus optional ``cdc_column``).  The result has an ``action`` column.
    """
    has_cdc = "cdc_column" in updates.columns
    # Several updates of one key: the newest completion date wins, as the
    # last of the reference's sequential upserts would.
    newest = updates.groupBy(*keys).agg(
        F.max("delta_completion_date").alias("__u_date"),
        *([F.max(F.struct("delta_completion_date", "cdc_column")).alias("__u_both")] if has_cdc else []),
    )
    u = newest.select(
        *[F.col(k).alias(f"__u_{k}") for k in keys],
        F.col("__u_date"),
        # dates that tie: the last column name
        *([F.col("__u_both.cdc_column").alias("__u_cdc")] if has_cdc else []),
        F.lit(True).alias("__u_hit"),
    )
    l = log.withColumn("__l_hit", F.lit(True))
    cond = None
    for k in keys:
        term = l[k] == u[f"__u_{k}"]
        cond = term if cond is None else cond & term
    joined = l.join(u, cond, "full_outer")
    in_log = F.col("__l_hit").isNotNull()
    in_upd = F.col("__u_hit").isNotNull()
    action = F.when(in_log & in_upd, "UPDATE").when(in_upd, "INSERT").otherwise("KEEP")
    out = []
    for name in log.columns:
        if name in keys:
            value = F.coalesce(F.col(name), F.col(f"__u_{name}"))
        elif name == "delta_completion_date":
            value = F.when(in_upd, F.col("__u_date")).otherwise(F.col(name))
        elif name == "last_update_timestamp":
            value = F.when(in_upd, ts_lit(now)).otherwise(F.col(name))
        elif name == "status":
            value = F.when(in_log, F.col(name)).otherwise(F.lit(status))
        elif name == "cdc_column" and has_cdc:
            value = F.when(in_log, F.col(name)).otherwise(F.col("__u_cdc"))
        else:
            value = F.col(name)
        out.append(value.cast(log.schema[name].dataType).alias(name))
    return joined.select(*out, action.alias("action"))
