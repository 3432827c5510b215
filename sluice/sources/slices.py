"""Parallel reads dealt by rows: which predicate text reads which share of a table.

A database table is read in parallel by one predicate per task.  The ranges
here hold about as many *rows* each, whatever the keys look like:

* ``slice_ranges`` deals the discovered partition keys, each with its number of
  rows, into ranges over all key columns; a key that alone holds more than a
  share is read on its own, cut further by ranges of the primary key.
* ``table_ranges`` cuts a whole table at quantiles of its key, of any
  orderable types and number of columns.

Ranges of several columns are compared lexicographically, a null below all
values, as Spark sorts.  Every row meets exactly one predicate: a range takes
what lies below its end and not below an earlier end, which is exact under any
order the database may have for text.

What comes to the driver is one row per range.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.operators.partitions import KEY_ROWS as ROWS
from sluice.plans.scratch import scratch_dir
from sluice.sources.jdbc import quote_identifier, quote_literal

#: Bits of a row's place within its part in ``monotonically_increasing_id``.
PLACE_BITS = 33


def below(columns: list[str], bound: tuple) -> str:
    """``columns < bound``, column by column, nulls first; true or false for every row, never unknown."""
    terms = []
    for i, value in enumerate(bound):
        if value is None:
            continue  # nothing lies below a null
        name = quote_identifier(columns[i])
        less = f"({name} IS NULL OR {name} < {quote_literal(value)})"
        terms.append(" AND ".join([equal(columns[:i], bound[:i]), less] if i else [less]))
    return "(" + " OR ".join(f"({t})" for t in terms) + ")" if terms else "1 = 0"


def equal(columns: list[str], key: tuple) -> str:
    """``columns`` hold this key, nulls included; true or false for every row, never unknown."""
    terms = []
    for c, v in zip(columns, key):
        name = quote_identifier(c)
        terms += [f"{name} IS NULL"] if v is None else [f"{name} IS NOT NULL", f"{name} = {quote_literal(v)}"]
    return " AND ".join(terms)


def implies(a: tuple, b: tuple) -> bool:
    """Whether what lies below ``a`` lies below ``b`` whatever order the database has for text."""
    for x, y in zip(a, b):
        if x is None and y is None or x is not None and y is not None and x == y:
            continue
        if x is None or y is None:
            return x is None
        return not isinstance(x, str) and not isinstance(y, str) and bool(x < y)
    return True


def ranges(columns: list[str], bounds: list[tuple], ordered: bool) -> list[str]:
    """Predicates of which each row meets exactly one.

    ``ordered`` says that the database orders the key as Spark does, which
    spares each range all but the nearest of the ends before it.  Otherwise
    the ends before it that a later one implies are spared: of ends of one
    text, the last is asked.  The nearest ends stand first, where nearly all
    rows of other ranges fail.  A range of one column with a lower end leaves
    the column bare, for the database's indexes.
    """
    out: list[str] = []
    before: list[tuple] = []  # ends to be asked, the nearest last
    for k in range(len(bounds) + 1):
        upper = bounds[k] if k < len(bounds) else None
        if len(columns) == 1 and before:
            name = quote_identifier(columns[0])
            terms = [f"{name} >= {quote_literal(b)}" for (b,) in reversed(before)]
            own = [f"{name} < {quote_literal(upper[0])}"] if upper is not None else []
        else:
            terms = [f"NOT {below(columns, b)}" for b in reversed(before)]
            own = [below(columns, upper)] if upper is not None else []
        out.append(" AND ".join([*terms[:1], *own, *terms[1:]]) or "1 = 1")
        if upper is not None:
            before = [upper] if ordered else [*(b for b in before if not implies(b, upper)), upper]
    return out


def _ascending(bounds) -> list[tuple]:
    """Distinct bounds in Spark's order, without the least: no range begins before it."""
    return sorted(set(bounds), key=lambda b: [(v is not None, v) if v is not None else (False,) for v in b])[1:]


def sorts_alike(rows: DataFrame, columns: list[str]) -> bool:
    """Whether any database orders these columns as Spark does: not so for text."""
    return not any(isinstance(rows.schema[c].dataType, T.StringType) for c in columns)


def quantile_bounds(rows: DataFrame, columns: list[str], parts: int) -> list[tuple]:
    """At most ``parts - 1`` ascending keys that cut ``rows`` into parts of about as many rows.

    Range partitioning draws the quantiles from a sample of every input
    partition; each part names its least key.  Only the key columns are read.
    """
    if parts < 2:
        return []
    least = (
        rows.select(*[f"`{c}`" for c in columns])
        .repartitionByRange(parts, *[F.col(f"`{c}`") for c in columns])
        .groupBy(F.spark_partition_id().alias("p"))
        .agg(F.min(F.struct(*[f"`{c}`" for c in columns])).alias("v"))
        .collect()
    )
    return _ascending(tuple(r.v) for r in least)


def table_ranges(rows: DataFrame, columns: list[str], parts: int) -> list[str]:
    """Predicates for a full pull in about ``parts`` ranges of its key."""
    bounds = quantile_bounds(rows, columns, parts)
    return ranges(columns, bounds, sorts_alike(rows, columns))


@dataclass(frozen=True)
class Dealt:
    """Predicates, and what they were dealt from: ends of ranges and the hot keys."""

    predicates: list[str]
    bounds: list[tuple]
    hot: list[tuple]


def row_bounds(keys: DataFrame, columns: list[str], share: int) -> list[tuple]:
    """Keys that start a new range when, in order, ``share`` rows are passed.

    A running sum over range-sorted keys: the sums of the sorted parts come to
    the driver, the keys stay; of every range its least key is returned.
    """
    names = [F.col(f"`{c}`") for c in columns]
    scratch_dir(keys.sparkSession)
    # fixed parts: their numbers are read twice
    sorted_keys = keys.repartitionByRange(*names).sortWithinPartitions(*names).checkpoint(eager=True)
    place = F.monotonically_increasing_id()
    parted = sorted_keys.withColumn("__part", F.shiftright(place, PLACE_BITS))
    sums = {r["__part"]: r["n"] for r in parted.groupBy("__part").agg(F.sum(ROWS).alias("n")).collect()}
    before, starts = 0, []
    for part in sorted(sums):
        starts.append((part, before))
        before += sums[part]
    if not starts:
        return []
    running = W.partitionBy("__part").orderBy(*names).rowsBetween(W.unboundedPreceding, -1)
    offsets = keys.sparkSession.createDataFrame(starts, "__part long, __start long")
    upto = F.col("__start") + F.coalesce(F.sum(ROWS).over(running), F.lit(0))
    least = (
        parted.join(F.broadcast(offsets), "__part")
        .withColumn("__range", F.floor(upto / share))
        .groupBy("__range")
        .agg(F.min(F.struct(*names)).alias("v"))
        .collect()
    )
    return _ascending(tuple(r.v) for r in least)


def _cuts(rows: DataFrame, columns: list[str], hot: list[tuple], sizes: list[int], primary_keys: list[str], share: int) -> list[list[tuple]]:
    """Per hot key the primary keys that cut its rows, in one pass over the rows of all hot keys."""
    tagged = rows.sparkSession.createDataFrame([(i, *k) for i, k in enumerate(hot)], "__hot int, " + ", ".join(f"__k{i} string" for i in range(len(columns))))
    match: Column = F.lit(True)
    for i, c in enumerate(columns):
        match = match & F.col(f"`{c}`").cast("string").eqNullSafe(F.col(f"__k{i}"))
    # at most one row per range: small by construction
    own = rows.join(F.broadcast(tagged), match).select("__hot", *[f"`{c}`" for c in primary_keys])
    pieces = sum(2 * math.ceil(n / share) for n in sizes)
    least = (
        own.repartitionByRange(pieces, "__hot", *[F.col(f"`{c}`") for c in primary_keys])
        .groupBy(F.spark_partition_id().alias("p"), "__hot")
        .agg(F.min(F.struct(*[f"`{c}`" for c in primary_keys])).alias("v"))
        .collect()
    )
    found: list[set] = [set() for _ in hot]
    for r in least:
        found[r["__hot"]].add(tuple(r.v))
    return [_ascending(x) for x in found]


def slice_ranges(keys: DataFrame, columns: list[str], rows: DataFrame, parts: int, primary_keys: list[str] | None = None) -> Dealt:
    """Predicates that deal the rows of the discovered ``keys`` into about ``parts`` shares.

    ``keys`` has the key columns as text and their row counts in ``__rows``;
    ``rows`` is the source, for the types of the key columns and, where a key
    is hot, for its primary keys.  No range holds more than two shares, unless
    one primary key does.
    """
    keys = keys.groupBy(*[f"`{c}`" for c in columns]).agg(F.sum(ROWS).alias(ROWS))
    total = keys.agg(F.sum(ROWS)).first()[0] or 0
    share = max(1, math.ceil(total / parts))
    typed = keys.select(*[F.col(f"`{c}`").cast(rows.schema[c].dataType).alias(c) for c in columns], F.col(ROWS))
    # fewer than ``parts`` keys can hold more than a share
    hot_rows = keys.where(F.col(ROWS) > share).select(*[f"`{c}`" for c in columns], ROWS).collect()
    hot = [tuple(r[c] for c in columns) for r in hot_rows]
    bounds = row_bounds(typed.where(F.col(ROWS) <= share), columns, share)
    apart = [f"NOT ({equal(columns, k)})" for k in hot]
    out = [" AND ".join([p, *apart]) for p in ranges(columns, bounds, sorts_alike(rows, columns))]
    cuts = _cuts(rows, columns, hot, [r[ROWS] for r in hot_rows], primary_keys, share) if hot and primary_keys else [[] for _ in hot]
    for key, ends in zip(hot, cuts):
        own = equal(columns, key)
        if not ends:
            out.append(own)
            continue
        alike = sorts_alike(rows, primary_keys)
        out += [f"{own} AND {p}" for p in ranges(primary_keys, ends, alike)]
    return Dealt(out, bounds, hot)
