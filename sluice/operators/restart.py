"""Restart table operators (R3-R5), set-based.

A failed extraction leaves an ``Extract`` row; the next run of that config
re-extracts.  Any other step means the extraction already finished and only
the later steps remain, so extraction is skipped (``exit_flag = 'Y'``).
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.functions.timefmt import ts_lit

# The row the reference writes when extraction fails.
STEP_ID = "1"
STEP_NAME = "Extract"
DESCRIPTION = "Failed at extraction"


def restart_gate(
    configs: DataFrame,
    restart: DataFrame,
    config_keys: list[str],
    restart_keys: list[str],
) -> DataFrame:
    """``exit_flag`` per config.

    No restart row, or newest row with step ``Extract`` -> ``N`` (run the
    extraction); any other step -> ``Y``.  With several rows for one config
    the newest ``insert_timestamp`` decides, then the largest ``step_id`` and
    step name (the reference took an arbitrary one).  ``max_by`` folds each config's rows map-side.
    """
    # rows of one time stamp are told apart by step, so reruns agree
    order = ["insert_timestamp", *(c for c in ("step_id", "step_name") if c in restart.columns)]
    newest = restart.groupBy(*[F.col(k) for k in restart_keys]).agg(
        F.max_by("step_name", F.struct(*order)).alias("__step")
    )
    cond = None
    for ck, rk in zip(config_keys, restart_keys):
        term = configs[ck] == newest[rk]
        cond = term if cond is None else cond & term
    joined = configs.join(newest, cond, "left")
    step = F.col("__step")
    flag = F.when(step.isNotNull() & (step != STEP_NAME), "Y").otherwise("N")
    return joined.select(*[configs[c] for c in configs.columns], flag.alias("exit_flag"))


def clear_restart(restart: DataFrame, runs: DataFrame, keys: list[str]) -> DataFrame:
    """The restart table without the rows of the configs being run."""
    return restart.join(runs.select(*keys).distinct(), keys, "left_anti")


def record_restart(
    restart: DataFrame,
    failed: DataFrame,
    job_name: str,
    now: _dt.datetime,
) -> DataFrame:
    """Append a ``1 / Extract / Failed at extraction`` row per failed run.

    ``failed`` columns: ``audit_id`` and optionally ``schema_name,
    table_name, manual_flag``.
    """
    def opt(name: str):
        return F.col(name) if name in failed.columns else F.lit(None).cast("string")

    new = failed.select(
        F.col("audit_id"),
        F.lit(STEP_ID).alias("step_id"),
        F.lit(STEP_NAME).alias("step_name"),
        opt("table_name").alias("table_name"),
        F.lit(job_name).alias("job_name"),
        F.lit(job_name).alias("step_job_name"),
        ts_lit(now).alias("insert_timestamp"),
        opt("schema_name").alias("schema_name"),
        F.lit(DESCRIPTION).alias("description"),
        opt("manual_flag").alias("manual_flag"),
    )
    return restart.unionByName(new, allowMissingColumns=True)
