"""Read and write counts, extracted flag, reconciliation.

The reference counts with separate actions, each re-running the source query.
Here both counts ride on the write itself through one ``Observation``.  The
observation sits in the final (writing) stage: accumulators of result tasks
are applied once per partition even when an executor is lost and tasks are
retried, whereas metrics taken in a map stage can be counted twice when that
stage is recomputed.  The source count therefore travels as a per-row
``__source_rows`` column through the dedup shuffle and is summed after it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from sluice.operators.dedup import SOURCE_ROWS


def observe_counts(rows: DataFrame, name: str):
    """Attach an observation to ``rows`` and drop the helper column.

    Returns ``(frame, observation)``; after the action the observation holds
    ``src_record_count`` and ``target_record_count``.
    """
    obs = Observation(name)
    src = F.sum(F.col(SOURCE_ROWS)) if SOURCE_ROWS in rows.columns else F.count(F.lit(1))
    metrics = [
        F.coalesce(src, F.lit(0)).cast("long").alias("src_record_count"),
        F.count(F.lit(1)).alias("target_record_count"),
    ]
    observed = rows.observe(obs, *metrics)
    if SOURCE_ROWS in rows.columns:
        observed = observed.drop(SOURCE_ROWS)
    return observed, obs


def reconcile_gate(src: Column, tgt: Column) -> Column:
    """Counts pass when both are non-zero and equal; null counts fail."""
    return F.coalesce((src != 0) & (tgt != 0) & (src == tgt), F.lit(False))


def gate_reason(src: Column, tgt: Column) -> Column:
    """Why R1 blocks a run, or null where it passes."""
    return (
        F.when(src.isNull() | tgt.isNull(), "not counted")
        .when(src == 0, "no source rows")
        .when(tgt == 0, "no target rows")
        .when(src != tgt, F.concat(F.lit("counts differ by "), F.abs(src - tgt).cast("string")))
    )


def reconcile_counts(counts: DataFrame) -> DataFrame:
    """R1 over a frame of ``src_record_count`` / ``target_record_count``."""
    return counts.withColumn(
        "counts_match", reconcile_gate(F.col("src_record_count"), F.col("target_record_count"))
    )


def extracted_flags(
    configs: DataFrame,
    rows: DataFrame,
    config_key: str,
    row_key: str,
) -> DataFrame:
    """A6, set-based: per config, the rows its extraction selected and whether
    it extracted anything.

    ``rows`` is pre-aggregated per key before the join, so the shuffle moves
    one row per config, not one per source row; configs with no rows get 0.
    """
    per_key = rows.groupBy(F.col(row_key).alias("__key")).agg(F.count(F.lit(1)).alias("n_rows"))
    joined = configs.join(per_key, configs[config_key] == per_key["__key"], "left")
    n = F.coalesce(F.col("n_rows"), F.lit(0)).cast("long")
    return joined.select(configs[config_key], n.alias("n_rows"), (n != 0).alias("is_extracted"))
