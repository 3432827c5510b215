"""Helpers shared by the operators of this package."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.plans.scratch import scratch_dir

#: A word: a run of anything but space and the ASCII controls tab to return.
WORD = "[^\\x20\\x09-\\x0D]+"
#: Bytes of an Arrow batch between the JVM and Python.
BATCH_SETTING, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 8 << 20
#: A side of a join is broadcast only up to this many (narrow) rows.
BROADCAST_ROWS = 100_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut(df: DataFrame) -> DataFrame:
    """``df`` with its lineage cut by a reliable checkpoint in the shared folder."""
    scratch_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def small_side(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` (already cut) marked for broadcast if it has few rows, else as it is.

    Beyond ``max_rows`` the join is a shuffle join that AQE may split.
    """
    return F.broadcast(df) if df.count() <= max_rows else df


def held_out(doc_id: Column) -> Column:
    """One fifth of the documents, by the CRC-32 of the id as text; a null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def unit_hash(*cols: Column) -> Column:
    """A uniform number in [0, 1) that depends on the values alone."""
    return F.shiftrightunsigned(F.xxhash64(*cols), 11).cast("double") / float(1 << 53)


def bound_batches(spark: SparkSession) -> None:
    """Keep Arrow batches small for the rest of the session, unless they are smaller already.

    The JVM and the Python worker each hold a batch of texts several times
    over, so the batch, not the operator, would set an executor's memory.
    """
    now = (spark.conf.get(BATCH_SETTING, None) or "").lower().rstrip("b")
    if not now.isdigit() or int(now) > BATCH_BYTES:
        spark.conf.set(BATCH_SETTING, str(BATCH_BYTES))


def plain_names(df: DataFrame, **cols: str) -> DataFrame:
    """The named input columns only, under fixed names, so extra columns cannot clash."""
    return df.select(*[F.col(f"`{src}`").alias(name) for name, src in cols.items()])
