"""The minimum end-to-end slice: one IO-SNAP-DLY config on ``events``."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.operators.watermark import advance_watermark
from sluice.plans.extract import ExtractionConfig, result_row, run_extraction
from sluice.plans.fixtures import FMT, NOW
from sluice.plans.scratch import scratch_path
from sluice.sources.parquet import read_table


def flagship(spark: SparkSession, sf_dir: str, now: _dt.datetime = NOW) -> DataFrame:
    cfg = ExtractionConfig.from_mapping(
        dict(
            id="events-daily",
            load_strategy="IO-SNAP-DLY",
            select_columns="event_id, ts, user_id, event_type, value",
            cdc_column="ts",
            cdc_timestamp=_dt.datetime(2024, 1, 10),
            to_cdc_timestamp=_dt.datetime(2024, 1, 10, 23, 59, 59),
            cdc_ts_format=FMT,
            target_partition_column="event_type",
            target_path=scratch_path(spark, "flagship"),
        )
    )
    result = run_extraction(read_table(spark, sf_dir, "events"), cfg, now)
    runs = advance_watermark(result_row(spark, result, now), now)
    return runs.select(
        "id",
        "load_strategy",
        "src_record_count",
        "target_record_count",
        F.col("gate").alias("counts_match"),
        "next_cdc_ts",
        "next_to_ts",
    )
