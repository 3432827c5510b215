"""Source readers: Parquet, JDBC and control-table schemas."""

from sluice.sources.parquet import read_parquet, read_table
from sluice.sources.jdbc import (
    jdbc_options,
    read_jdbc_table,
    read_jdbc_slices,
    range_predicates,
)

__all__ = [
    "read_parquet",
    "read_table",
    "jdbc_options",
    "read_jdbc_table",
    "read_jdbc_slices",
    "range_predicates",
]
