"""Fixed schemas of the control tables.

The reference's control tables live in a relational database; their column
names are those it reads and writes.  Types are inferred from use.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

S, L, I, TS, D = T.StringType(), T.LongType(), T.IntegerType(), T.TimestampNTZType(), T.DateType()


def _schema(*fields) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


CONFIG = _schema(
    ("id", S),
    ("active_flag", S),
    ("manual_flag", S),
    ("cloudwatch_event_name", S),
    ("schema_name", S),
    ("table_name", S),
    ("select_columns", S),
    ("query_parameter", S),
    ("source_partition_column", S),
    ("target_partition_column", S),
    ("primary_keys", S),
    ("cdc_column", S),
    ("cdc_timestamp", TS),
    ("to_cdc_timestamp", TS),
    ("cdc_ts_format", S),
    ("overlap_in_min", S),
    ("load_strategy", S),
    ("agg_column", S),
    ("agg_column_function", S),
    ("agg_operation", S),
    ("curate_bucket", S),
    ("curate_prefix", S),
)

AUDIT_SPEC = _schema(
    ("audit_id", S),
    ("audit_line_job_id", S),
    ("job_name", S),
    ("description", S),
    ("schema_name", S),
    ("table_name", S),
    ("insert_timestamp", TS),
)

AUDIT_HEADER = _schema(
    ("audit_id", S),
    ("insert_timestamp", TS),
    ("latest_record_ind", I),
    ("workflow_run_id", S),
    ("workflow_header_status", S),
    ("workflow_start_ts", TS),
    ("src_record_count", L),
    ("target_record_count", L),
)

AUDIT_LINE = _schema(
    ("audit_id", S),
    ("audit_line_job_id", S),
    ("job_start_ts", TS),
    ("job_run_id", S),
    ("job_status", S),
    ("latest_record_ind", I),
    ("insert_timestamp", TS),
)

RESTART = _schema(
    ("audit_id", S),
    ("step_id", S),
    ("step_name", S),
    ("table_name", S),
    ("job_name", S),
    ("step_job_name", S),
    ("insert_timestamp", TS),
    ("schema_name", S),
    ("description", S),
    ("manual_flag", S),
)

WATERMARK_LOG = _schema(
    ("audit_id", S),
    ("insert_timestamp", TS),
    ("cdc_timestamp", TS),
    ("cdc_timestamp_fmt", S),
    ("to_cdc_timestamp", TS),
)

EXTRACT_LOG = _schema(
    ("schema_name", S),
    ("table_name", S),
    ("cdc_column", S),
    ("delta_completion_date", D),
    ("status", S),
    ("last_update_timestamp", TS),
)


def empty(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)
