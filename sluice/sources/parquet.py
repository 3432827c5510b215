"""Parquet sources.

A Parquet source is read lazily; the extraction plan's filters and projection
reach the scan (``PushedFilters``, pruned ``ReadSchema``), and partition
columns of a Hive-style layout are pruned by Catalyst.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def read_parquet(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    return reader.parquet(path)


def read_table(spark: SparkSession, base_dir: str, name: str) -> DataFrame:
    """``{base_dir}/{name}.parquet`` (the layout of the test data)."""
    return spark.read.parquet(f"{base_dir.rstrip('/')}/{name}.parquet")
