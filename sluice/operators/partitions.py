"""Partition discovery and slicing (A1-A4).

The reference collects the distinct partition keys to the driver, turns each
into SQL text (``"K"='v' and ..``) and then reads the slices one after another.
Here the key set stays a DataFrame:

* ``discover_partitions`` is a ``select(cast).distinct()``: a partial
  aggregate, so even a key holding a third of the rows is reduced map-side
  before the shuffle.
* ``restrict_to_partitions`` is a null-safe ``left_semi`` join, so a null key
  keeps its rows (the reference's ``"K"=None`` slice matched nothing).  No
  broadcast hint: the key side is an aggregate whose size AQE measures at
  run time before it picks a broadcast or a shuffled hash join.
* ``aggregate_filter`` is an uncorrelated scalar subquery; Spark runs the
  one-row aggregate first and pushes ``col <op> value`` into the scan as a
  runtime filter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.functions.keys import null_safe_match, split_names
from sluice.plans.strategy import ConfigError

#: Rows of a discovered key.
KEY_ROWS = "__rows"

# Aggregate functions and comparison operators a TL-AGG config
# may name (``agg_column_function``, ``agg_operation``).
AGG_FUNCTIONS = {
    "max": F.max,
    "min": F.min,
    "avg": F.avg,
    "sum": F.sum,
    "count": F.count,
}
COMPARISONS = {
    "=": lambda a, b: a == b,
    "==": lambda a, b: a == b,
    "<>": lambda a, b: a != b,
    "!=": lambda a, b: a != b,
    ">": lambda a, b: a > b,
    ">=": lambda a, b: a >= b,
    "<": lambda a, b: a < b,
    "<=": lambda a, b: a <= b,
}


def partition_key_columns(columns: str | list[str] | None, agg_column: str | None = None) -> list[str]:
    """Source partition columns, with the TL-AGG column appended (A4)."""
    cols = split_names(columns)
    if agg_column and agg_column.strip() and agg_column.strip() not in cols:
        cols = cols + [agg_column.strip()]
    return cols


def discover_partitions(
    source: DataFrame, columns: list[str], predicate: Column | None = None, counted: bool = False
) -> DataFrame:
    """A1: distinct partition keys, each cast to string, of the rows that
    satisfy ``predicate``.  Null keys are kept as null.  ``counted`` adds the
    rows of each key as ``__rows``."""
    if not columns:
        raise ConfigError("partition discovery needs at least one column")
    rows = source if predicate is None else source.where(predicate)
    keys = rows.select([F.col(c).cast("string").alias(c) for c in columns])
    return keys.groupBy(*columns).agg(F.count(F.lit(1)).alias(KEY_ROWS)) if counted else keys.distinct()


def restrict_to_partitions(rows: DataFrame, keys: DataFrame, columns: list[str]) -> DataFrame:
    """A2: the rows whose partition key is in ``keys`` (null-safe).

    ``keys`` holds string keys as produced by :func:`discover_partitions`;
    the row side is cast the same way so values compare as the reference's
    quoted text did.
    """
    tagged = keys.select([F.col(c).alias(f"__slice_{i}") for i, c in enumerate(columns)])
    cond = null_safe_match(
        [F.col(c).cast("string") for c in columns],
        [tagged[f"__slice_{i}"] for i in range(len(columns))],
    )
    return rows.join(tagged, cond, "left_semi")


def aggregate_filter(
    source: DataFrame,
    agg_column: str,
    agg_function: str,
    agg_operation: str,
    static: Column | None = None,
    materialize: bool = False,
) -> Column:
    """A3: ``agg_column <op> (select fn(agg_column) from source where static)``.

    With ``materialize`` the one-row aggregate is computed once into a
    reliable checkpoint (``spark.checkpoint.dir``), for runs that evaluate the
    filter in more than one action; the subquery then reads that row instead
    of scanning the source again.
    """
    fn = AGG_FUNCTIONS.get(str(agg_function or "").strip().lower())
    op = COMPARISONS.get(str(agg_operation or "").strip())
    if fn is None:
        raise ConfigError(f"unsupported agg_column_function {agg_function!r}")
    if op is None:
        raise ConfigError(f"unsupported agg_operation {agg_operation!r}")
    if not agg_column or not agg_column.strip():
        raise ConfigError("TL-AGG needs agg_column")
    col = agg_column.strip()
    scope = source if static is None else source.where(static)
    one_row = scope.select(fn(F.col(col)).alias("v"))
    if materialize:
        from sluice.plans.scratch import scratch_dir

        scratch_dir(source.sparkSession)
        one_row = one_row.checkpoint(eager=True)
    return op(F.col(col), one_row.scalar())


def max_partition_date(keys: DataFrame, column: str) -> DataFrame:
    """The newest loaded date among ``%Y-%m-%d`` partition keys (one row).

    A key that is not a date raises under ANSI mode, as the reference's
    ``strptime`` did; use a date-typed partition column.
    """
    return keys.agg(F.max(F.to_date(F.col(column))).alias("max_value"))
