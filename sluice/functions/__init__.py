"""Column builders shared by operators and plans."""

from sluice.functions.timefmt import ts_lit, to_spark_format, day_start, day_end
from sluice.functions.predicates import (
    delta_predicate,
    static_predicate,
    watermark_expression,
    and_all,
)
from sluice.functions.keys import split_names, split_sql_list, job_line_id

__all__ = [
    "ts_lit",
    "to_spark_format",
    "day_start",
    "day_end",
    "delta_predicate",
    "static_predicate",
    "watermark_expression",
    "and_all",
    "split_names",
    "split_sql_list",
    "job_line_id",
]
