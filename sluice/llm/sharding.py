"""Sharding by histogram sort.

Documents are ordered by a key: the digest of the text, then a digest of the
id, so that equal texts stand side by side.  The shards are consecutive key
ranges of nearly equal bytes.  Their splitters are found by probing: bytes are
counted below candidate boundaries (key prefixes) in one aggregation over all
partitions, each splitter's range is narrowed to the bucket it falls into, and
only those buckets get finer probes in the next round, until a bucket holds no
more than ``tolerance`` bytes or a single key.  Then the rows are exchanged
once, straight to their place.

Rows equal in id and text share a key.  A splitter that falls inside such a run
is a number of copies: the run's rows are stored and counted off, so many for
each side.

Only DataFrame functions are used.  The driver sees, per round, at most
``pieces * 256`` bucket sums (4096 in the first round).  A shard of more than
``rows_per_piece`` rows or ``bytes_per_piece`` bytes is cut into pieces by
further splitters of the same kind, so neither a shard nor a hot text has to fit
into one task; the number of pieces follows the bytes.

Defined results: a null text counts 0 bytes plus the overhead and has the key
and the checksum of an empty one; a null id has the digest of an empty one;
sizes come before groups: a boundary may fall inside a group of equal texts, and
between rows equal in id and text, whose places among themselves are arbitrary;
texts of any length are one row and never cut; an empty table gives an empty
result; the added columns replace input columns of the same name.
"""

from __future__ import annotations

import json
import os
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sluice.llm.common import cut, small_side

FIRST_DIGITS = 3  # hexadecimal digits of the first round's probes: 4096 buckets
NEXT_DIGITS = 2
#: Bits of a row's place within its part in ``monotonically_increasing_id``.
PLACE_BITS = 33


class Splitter(NamedTuple):
    """The key in which a boundary falls, the bytes before that key, its rows and its bytes (all 0 if not a single key)."""

    key: str
    below: int
    rows: int
    bytes: int


def sort_key(doc_id: Column, text: Column) -> Column:
    by_text = F.md5(F.coalesce(text.cast("string"), F.lit("")).cast("binary"))
    by_id = F.md5(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary"))
    return F.concat(by_text, F.substring(by_id, 1, 16))


def byte_size(text: Column, overhead: int = 16) -> Column:
    return (F.coalesce(F.octet_length(text), F.lit(0)) + overhead).cast("long")


def find_splitters(keyed: DataFrame, pieces: int, total: int, tolerance: int = 0) -> list[str]:
    """The last key below each of the ``pieces - 1`` boundaries, ascending.

    ``keyed`` has (key, size).  Boundary j ends the range in which the running
    bytes first reach ``j / pieces`` of the total, to within ``tolerance``.
    """
    return [s.key for s in probe_splitters(keyed, pieces, total, tolerance)]


def boundary(j: int, pieces: int, total: int) -> int:
    return -(-j * total // pieces)


def probe_splitters(keyed: DataFrame, pieces: int, total: int, tolerance: int = 0) -> list[Splitter]:
    """``find_splitters`` with what is known of each splitter's key."""
    wanted = {j: boundary(j, pieces, total) for j in range(1, pieces)}
    found: dict[int, Splitter] = {}
    #: open buckets: key prefix -> (bytes before it, the splitters inside)
    probes: dict[str, tuple[int, list[int]]] = {"": (0, list(wanted))}
    while probes:
        by_length: dict[int, list[str]] = {}
        for prefix in probes:
            by_length.setdefault(len(prefix), []).append(prefix)
        counted: dict[str, list] = {}
        for n, prefixes in by_length.items():
            finer = n + (NEXT_DIGITS if n else FIRST_DIGITS)
            rows = keyed.where(F.substring("key", 1, n).isin(prefixes)) if n else keyed
            got = (
                rows.groupBy(F.substring("key", 1, finer).alias("bucket"))
                .agg(F.sum("size").alias("bytes"), F.min("key").alias("lo"), F.max("key").alias("hi"), F.count(F.lit(1)).alias("rows"))
                .collect()
            )
            for r in got:
                counted.setdefault(r.bucket[:n], []).append(r)
        narrower: dict[str, tuple[int, list[int]]] = {}
        for prefix, (below, inside) in probes.items():
            for r in sorted(counted[prefix], key=lambda r: r.bucket):
                here = [j for j in inside if below < wanted[j] <= below + r.bytes]
                if here and (r.bytes <= tolerance or r.lo == r.hi):
                    one = r.lo == r.hi
                    found.update(dict.fromkeys(here, Splitter(r.hi, below, r.rows, r.bytes) if one else Splitter(r.hi, 0, 0, 0)))
                elif here:
                    # the keys of the bucket agree at least this far
                    narrower[os.path.commonprefix([r.lo, r.hi])] = (below, here)
                below += r.bytes
        probes = narrower
    return [found[j] for j in sorted(found)]


def splitters_below(splitters: list[str], key: Column) -> Column:
    """Number of splitters below the key, looked up by the key's first digits."""
    buckets = 16**FIRST_DIGITS
    inner: list[list[str]] = [[] for _ in range(buckets)]
    for s in splitters:
        inner[int(s[:FIRST_DIGITS], 16)].append(s)
    starts, run = [], 0
    for own in inner:
        starts.append(run)
        run += len(own)
    # one literal, parsed when the plan is made
    table = F.from_json(F.lit(json.dumps({"starts": starts, "inner": inner})), "starts array<int>, inner array<array<string>>")
    at = (F.conv(F.substring(key, 1, FIRST_DIGITS), 16, 10).cast("int") + 1).cast("int")
    return F.element_at(table["starts"], at) + F.size(F.filter(F.element_at(table["inner"], at), lambda s: s < key))


class Run(NamedTuple):
    """Rows of one key that boundaries cut: its piece, its rows, and the copies at which a next piece begins."""

    key: str
    piece: int
    rows: int
    cuts: list[int]

    def rows_in(self) -> list[tuple[int, int]]:
        """(piece, rows) of the run."""
        ends = [0, *[min(c, self.rows) for c in self.cuts], self.rows]
        return [(self.piece + i, hi - lo) for i, (lo, hi) in enumerate(zip(ends, ends[1:]))]


def cut_runs(splitters: list[Splitter], pieces: int, total: int) -> list[Run]:
    """The keys of several rows inside which a boundary falls."""
    runs: dict[str, Run] = {}
    for j, s in enumerate(splitters, 1):
        if s.rows > 1:
            size = s.bytes // s.rows
            run = runs.setdefault(s.key, Run(s.key, j - 1, s.rows, []))
            run.cuts.append(-(-(boundary(j, pieces, total) - s.below) // size))
    return list(runs.values())


def counted_off(rows: DataFrame) -> DataFrame:
    """``rows`` (with ``__key``) with ``__copy``, a number from 0 for the rows of each key, in any order.

    The rows are stored first, in sorted parts: a row's number is its place
    within its part's run of the key, plus the key's rows in the parts before.
    """
    place = F.monotonically_increasing_id()
    stored = cut(rows.sortWithinPartitions("__key")).withColumns({"__place": place, "__part": F.shiftright(place, PLACE_BITS)})
    parts = stored.groupBy("__key", "__part").agg(F.min("__place").alias("__first"), F.count(F.lit(1)).alias("n"))
    earlier = W.partitionBy("__key").orderBy("__part").rowsBetween(W.unboundedPreceding, -1)
    starts = cut(parts.select("__key", "__part", "__first", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("__start")))
    numbered = stored.join(small_side(starts), ["__key", "__part"])
    return numbered.withColumn("__copy", F.col("__start") + F.col("__place") - F.col("__first")).drop("__part", "__first", "__start", "__place")


def shard_documents(
    docs: DataFrame,
    shards: int = 40,
    tolerance: int = 0,
    rows_per_piece: int = 1_000_000,
    bytes_per_piece: int = 256 << 20,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """``docs`` with size, text_crc32, shard and slot (the place in the shard's key order)."""
    spark = docs.sparkSession
    key, size = sort_key(F.col(doc_id), F.col(text)), byte_size(F.col(text))
    keyed = cut(docs.select(key.alias("key"), size.alias("size")))
    head = keyed.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("size"), F.lit(0)).alias("total")).first()
    per_shard = max(1, -(-head.n // (shards * rows_per_piece)), -(-head.total // (shards * bytes_per_piece)))
    pieces = shards * per_shard
    splitters = probe_splitters(keyed, pieces, head.total, tolerance) if head.n else []
    names = [s.key for s in splitters]
    runs = cut_runs(splitters, pieces, head.total)
    # at most one run per boundary
    rows = json.dumps([{"__key": r.key, "__from": r.piece, "__cuts": r.cuts} for r in runs])
    kind = "array<struct<__key: string, __from: int, __cuts: array<bigint>>>"
    table = F.broadcast(spark.range(1).select(F.inline(F.from_json(F.lit(rows), kind))))

    before = F.lit(0)
    if per_shard > 1:
        alone = keyed.withColumnRenamed("key", "__key")
        alone = alone.join(table, "__key", "left_anti") if runs else alone
        rows = dict(alone.groupBy(splitters_below(names, F.col("__key"))).count().collect())
        for p, n in (x for r in runs for x in r.rows_in()):
            rows[p] = rows.get(p, 0) + n
        starts, run = [], 0
        for p in range(pieces):
            run = 0 if p % per_shard == 0 else run
            starts.append(run)
            run += rows.get(p, 0)
        before = F.element_at(F.from_json(F.lit(json.dumps(starts)), "array<long>"), (F.col("__piece") + 1).cast("int"))

    full = docs.withColumns({"size": size, "text_crc32": F.crc32(F.coalesce(F.col(text), F.lit("")).cast("binary")), "__key": key})
    placed = full.join(table, "__key", "left_anti") if runs else full
    placed = placed.withColumn("__piece", splitters_below(names, F.col("__key")))
    if runs:
        off = counted_off(full.join(table, "__key"))
        piece = F.col("__from") + F.size(F.filter("__cuts", lambda c: c <= F.col("__copy")))
        placed = placed.unionByName(off.withColumn("__piece", piece).drop("__from", "__cuts", "__copy"))
    in_piece = W.partitionBy("__piece").orderBy("__key")
    return (
        placed.withColumn("slot", (before + F.row_number().over(in_piece) - 1).cast("long"))
        .withColumn("shard", F.floor(F.col("__piece") / per_shard).cast("int"))
        .drop("__key", "__piece")
    )


def op9_histogram_shards(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return shard_documents(docs).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


#: CRC-32 in SQL: the table of the 256 byte remainders from the polynomial, then a fold over the bytes.
ORACLE = """
with recursive steps(i, k, c) as (
  select i, 0, i::bigint from range(256) t(i)
  union all
  select i, k + 1, case when c % 2 = 1 then xor(c >> 1, 3988292384::bigint) else c >> 1 end from steps where k < 8),
crc as (select list(c order by i) as t from steps where k = 8),
d as (select doc_id, coalesce(octet_length(encode(text)), 0)::bigint + 16 as size,
             md5(coalesce(text, '')) || substr(md5(coalesce(doc_id::varchar, '')), 1, 16) as key,
             list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda x: ('0x' || x)::bigint) as b
      from documents),
c as (select doc_id, size, key,
             xor(list_reduce(list_prepend(4294967295::bigint, b), lambda a, x: xor(a >> 8, crc.t[xor(a & 255, x) + 1])), 4294967295::bigint) as text_crc32
      from d, crc),
o as (select *, coalesce(sum(size) over (order by key rows between unbounded preceding and 1 preceding), 0) as before,
             sum(size) over () as total from c),
p as (select *, least(39, (before::hugeint * 40 // total::hugeint))::int as shard from o)
select doc_id, size, text_crc32, 'bytes' as law, shard,
       (row_number() over (partition by shard order by key) - 1)::bigint as slot, null::int as grown_shard
from p
"""
