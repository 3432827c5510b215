"""Control tables kept as append-only logs of row versions.

A run reads only the rows of its own keys and writes only the rows it adds or
changes, as one segment; what a table holds is, per row, its newest version.

Layout below a table's folder::

    seq=<number>-<id>/bucket=<b>/part-*.parquet    row versions of one segment
    _segments/<number>-<id>                        segment committed (empty file)
    _segments/<number>-<id>.base.<b>               segment replaces all earlier ones of bucket b

``bucket`` is a hash of the table's key, so a read for known keys prunes to
their buckets, and the files of all others stay untouched.  Segments without a
marker are not read.  ``compact_log`` rewrites the buckets that have gathered
many segments, each committed on its own.

Every row has an id (``__row``), made from the columns that tell a table's rows
apart, and versions carry a flag for removed rows.  The newest version is an
ordinary ``max_by`` per row id, combined map-side.  Two runs that change one
row at the same time resolve to the one whose segment is named later.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

ROW, GONE, SEQ, BUCKET = "__row", "__gone", "seq", "bucket"
MARKERS = "_segments"


@dataclass(frozen=True)
class LogTable:
    """Where a control table lies, its columns, the key it is read by and the columns that tell its rows apart."""

    path: str
    schema: T.StructType
    key: tuple[str, ...]
    identity: tuple[str, ...]
    buckets: int = 64

    @property
    def columns(self) -> list[str]:
        return [f.name for f in self.schema.fields]

    @property
    def versions(self) -> T.StructType:
        extra = [(ROW, T.StringType()), (GONE, T.BooleanType()), (SEQ, T.StringType()), (BUCKET, T.IntegerType())]
        return T.StructType([*self.schema.fields, *(T.StructField(n, t) for n, t in extra)])

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*[F.col(c).cast("string") for c in self.key]), F.lit(self.buckets)).cast("int")


def _folder(spark: SparkSession, path: str):
    cls = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    here = cls(path)
    return here.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), here, cls


def segments(spark: SparkSession, table: LogTable) -> tuple[list[str], dict[int, str]]:
    """The committed segments in order, and per compacted bucket the segment that replaces all before it."""
    fs, here, cls = _folder(spark, f"{table.path}/{MARKERS}")
    names = sorted(str(s.getPath().getName()) for s in fs.listStatus(here)) if fs.exists(here) else []
    bases: dict[int, str] = {}
    for name in names:
        if ".base." in name:
            seq, bucket = name.split(".base.")
            bases[int(bucket)] = max(seq, bases.get(int(bucket), ""))
    return [n for n in names if ".base." not in n], bases


def _next(spark: SparkSession, table: LogTable) -> str:
    deltas, bases = segments(spark, table)
    last = max([*deltas, *bases.values()], default="0-")
    return f"{int(last.split('-')[0]) + 1:012d}-{uuid.uuid4().hex[:12]}"


def _mark(spark: SparkSession, table: LogTable, name: str) -> None:
    fs, here, cls = _folder(spark, f"{table.path}/{MARKERS}")
    fs.create(cls(here, name), False).close()


def _versions(spark: SparkSession, table: LogTable, buckets: list[int] | None) -> DataFrame:
    """Committed row versions of the given buckets (all if ``None``)."""
    deltas, bases = segments(spark, table)
    wanted = range(table.buckets) if buckets is None else buckets
    groups: dict[str, list[int]] = {}
    for b in wanted:
        groups.setdefault(bases.get(b, ""), []).append(b)
    oldest = min(groups, default="")
    needed = [s for s in sorted({*deltas, *(g for g in groups if g)}) if s >= oldest]
    if not needed or not groups:
        return spark.createDataFrame([], table.versions)
    rows = (
        spark.read.schema(table.versions)
        .option("basePath", table.path)
        .parquet(*[f"{table.path}/{SEQ}={s}" for s in needed])
    )
    only_bases = sorted({g for g in groups if g} - set(deltas))
    after = F.lit(False)
    for base, own in groups.items():
        # the bucket's base, and the segments after it
        newer = (F.col(SEQ) > base) & (~F.col(SEQ).isin(only_bases) if only_bases else F.lit(True))
        after = after | (F.col(BUCKET).isin(own) & ((F.col(SEQ) == base) | newer))
    return rows.where(after)


def _newest(versions: DataFrame, table: LogTable) -> DataFrame:
    state = F.struct(*table.columns, GONE)
    newest = versions.groupBy(ROW).agg(F.max_by(state, SEQ).alias("v"))
    return newest.where(~F.col(f"v.{GONE}")).select(*[F.col(f"v.`{c}`") for c in table.columns], ROW)


def read_log(spark: SparkSession, table: LogTable, keys: DataFrame | None = None) -> DataFrame:
    """The table's rows and their ids; with ``keys`` those of these keys only.

    ``keys`` has the key columns.  The buckets they fall into are collected (at
    most ``table.buckets`` numbers) so the scan reads no others.
    """
    if keys is None:
        return _newest(_versions(spark, table, None), table)
    wanted = keys.select(*[F.col(c).cast(table.schema[c].dataType).alias(c) for c in table.key]).distinct()
    buckets = sorted(r[0] for r in wanted.select(table.bucket()).distinct().collect())
    versions = _versions(spark, table, buckets)
    return _newest(versions.join(wanted, list(table.key), "left_semi"), table)


def with_ids(table: LogTable, rows: DataFrame) -> DataFrame:
    """``rows`` with the id of every row; new rows, without one yet, get it from what tells them apart."""
    if ROW not in rows.columns:
        rows = rows.withColumn(ROW, F.lit(None).cast("string"))
    rows = rows.select(*table.columns, ROW)
    same = W.partitionBy(*table.identity).orderBy(F.xxhash64(*table.columns))
    text = [F.coalesce(F.col(c).cast("string"), F.lit("\u0000")) for c in table.identity]
    name = F.concat_ws("\u0001", *text, F.row_number().over(same).cast("string"))
    fresh = rows.where(F.col(ROW).isNull()).withColumn(ROW, F.md5(name.cast("binary")))
    return rows.where(F.col(ROW).isNotNull()).unionByName(fresh)


def changes(table: LogTable, before: DataFrame | None, after: DataFrame) -> DataFrame:
    """The versions that lead from ``before`` to ``after``: rows added, changed or gone."""
    cols = F.struct(*table.columns)
    new = with_ids(table, after).select(ROW, cols.alias("a"))
    if before is None:
        return new.select("a.*", ROW, F.lit(False).alias(GONE))
    old = with_ids(table, before).select(ROW, cols.alias("b"))
    both = new.join(old, ROW, "full_outer").where(~F.col("a").eqNullSafe(F.col("b")))
    return both.withColumn("v", F.coalesce("a", "b")).select("v.*", ROW, F.col("a").isNull().alias(GONE))


def append_changes(spark: SparkSession, table: LogTable, before: DataFrame | None, after: DataFrame) -> str:
    """Write what ``after`` changes over ``before`` as one segment; its name.

    Both are rows as ``read_log`` gives them, for the same keys; rows without
    an id are new.  ``before=None`` starts from nothing.
    """
    seq = _next(spark, table)
    _write(changes(table, before, after), table, seq)
    _mark(spark, table, seq)
    return seq


def _write(versions: DataFrame, table: LogTable, seq: str) -> None:
    # files sized by bytes: AQE splits a large bucket and joins small ones
    spread = versions.withColumn(BUCKET, table.bucket()).hint("rebalance", F.col(BUCKET))
    spread.write.partitionBy(BUCKET).parquet(f"{table.path}/{SEQ}={seq}")


def compact_log(spark: SparkSession, table: LogTable, at_least: int = 8) -> list[int]:
    """Rewrite the buckets that have ``at_least`` segments since their last rewriting; which they are."""
    deltas, bases = segments(spark, table)
    if not deltas:
        return []
    fs, here, cls = _folder(spark, table.path)
    held: dict[int, int] = {}
    for s in deltas:
        for status in fs.listStatus(cls(here, f"{SEQ}={s}")):
            name = str(status.getPath().getName())
            if name.startswith(f"{BUCKET}="):
                b = int(name.split("=")[1])
                held[b] = held.get(b, 0) + (s > bases.get(b, ""))
    full = sorted(b for b, n in held.items() if n >= at_least)
    if full:
        seq = _next(spark, table)
        rows = _newest(_versions(spark, table, full), table).withColumn(GONE, F.lit(False))
        _write(rows, table, seq)
        for b in full:
            _mark(spark, table, f"{seq}.base.{b}")
    return full


def remove_replaced(spark: SparkSession, table: LogTable) -> int:
    """Remove bucket folders that a rewriting has replaced; how many there were."""
    deltas, bases = segments(spark, table)
    fs, here, cls = _folder(spark, table.path)
    n = 0
    for seq in sorted({*deltas, *bases.values()}):
        for b, base in bases.items():
            folder = cls(here, f"{SEQ}={seq}/{BUCKET}={b}")
            if seq < base and fs.exists(folder):
                fs.delete(folder, True)
                n += 1
    return n
