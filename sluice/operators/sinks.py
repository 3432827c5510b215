"""Target writes (K1-K6) and pinned-schema read-back.

Every load is one ``DataFrameWriter`` call.  Truncate-and-load (``TL-*``)
writes its files beside those of the load before; a marker makes them count
once all are there (``operators.loads``).  No file is renamed, and a load that
dies at any point leaves one whole load to be read.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.functions.timefmt import stamp_text
from sluice.operators import loads

# The stamp column's name and the reference's cap of 10000 rows
# per output file.
EXTRACT_DATE = "EXTRACT_DATE"
MAX_RECORDS_PER_FILE = 10000


@dataclass(frozen=True)
class SinkSpec:
    path: str
    mode: str  # "append" | "overwrite"
    partition_by: list[str] = field(default_factory=list)
    max_records_per_file: int = MAX_RECORDS_PER_FILE
    # Optional: shuffle so that each target partition value is written by at
    # most this many tasks (fewer, larger files).  Off by default: without it
    # the write needs no shuffle and is skew-free, at the price of up to one
    # file per task and partition value.
    files_per_partition: int | None = None
    # Optional, instead: shuffle so that files hold about as many bytes each.
    # AQE splits a large target partition value over tasks and joins small
    # ones, by the sizes it measures (``advisoryPartitionSizeInBytes``).
    rebalance: bool = False
    # Run that appends; a rerun under the same id replaces what the run wrote.
    run_id: str | None = None


def arrange_for_write(rows: DataFrame, spec: SinkSpec) -> DataFrame:
    """The shuffle ahead of the write that the spec asks for, if any."""
    if spec.rebalance:
        return rows.hint("rebalance", *[F.col(f"`{c}`") for c in spec.partition_by])
    if spec.files_per_partition and spec.partition_by:
        return cluster_for_write(rows, spec.partition_by, spec.files_per_partition)
    return rows


def cluster_for_write(rows: DataFrame, partition_by: list[str], files_per_partition: int) -> DataFrame:
    """Hash-partition by the target partition columns plus a salt in
    ``[0, files_per_partition)``.

    A plain ``repartition(*partition_by)`` would send a value holding a third
    of all rows to one task; the salt splits every value over up to
    ``files_per_partition`` tasks.  The salt is a hash of the row's own
    hashable columns, so a retried task reproduces the same placement.  A
    given number of parts keeps AQE from joining parts that are small in bytes
    but many files.
    """
    hashable = [
        F.col(f.name)
        for f in rows.schema.fields
        if not isinstance(f.dataType, (T.MapType, T.VariantType))
    ]
    salt = F.pmod(F.xxhash64(*hashable), F.lit(files_per_partition))
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(parts, *[F.col(c) for c in partition_by], salt)


def stamp_extract_date(rows: DataFrame, when: _dt.datetime) -> DataFrame:
    """K1: ``EXTRACT_DATE`` as ``%Y-%m-%d %H:%M:%S`` text (a constant)."""
    return rows.withColumn(EXTRACT_DATE, F.lit(stamp_text(when)))


def write_target(rows: DataFrame, spec: SinkSpec) -> None:
    """K2-K6: one write, in place; ``overwrite`` counts from its commit on (``operators.loads``).

    An append with a ``run_id`` first removes what an earlier try of the same
    run left, so a rerun adds nothing twice.
    """
    spark = rows.sparkSession
    rows = arrange_for_write(rows, spec)
    replaces = spec.mode == "overwrite"
    first = replaces and loads.is_new(spark, spec.path)
    if replaces:
        load = loads.new_load()
    else:
        load = loads.current_load(spark, spec.path)
        if spec.run_id:
            loads.remove_run(spark, spec.path, spec.run_id)
    writer = loads.named(rows.write.mode("append"), load, None if replaces else spec.run_id)
    writer = writer.option("maxRecordsPerFile", spec.max_records_per_file)
    if spec.partition_by:
        writer = writer.partitionBy(*spec.partition_by)
    writer.parquet(spec.path)
    if replaces:
        loads.commit_load(spark, spec.path, load)
        if not first:  # lists every file
            loads.remove_superseded(spark, spec.path)


def read_target(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    timestamp_partitions: tuple[str, ...] = (EXTRACT_DATE,),
) -> DataFrame:
    """Read a target's current load back with its schema pinned.

    Partition columns come back from directory names as written text;
    ``EXTRACT_DATE`` (and any column named in ``timestamp_partitions``) is
    read as string and converted to ``timestamp_ntz`` explicitly instead of
    letting partition inference guess a type.
    """
    as_text = T.StructType(
        [
            T.StructField(f.name, T.StringType(), True) if f.name in timestamp_partitions else f
            for f in schema.fields
        ]
    )
    df = spark.read.schema(as_text).option("pathGlobFilter", loads.current_files(spark, path)).parquet(path)
    for name in timestamp_partitions:
        if name in df.columns:
            df = df.withColumn(name, F.col(name).cast("timestamp_ntz"))
    return df.select([f.name for f in schema.fields])
