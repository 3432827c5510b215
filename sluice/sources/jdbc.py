"""JDBC sources.

The source is read as a table (``dbtable``), not as a hand-written query:
filters and projections of the extraction plan then reach the database
through Spark's JDBC pushdown (``PushedFilters`` / pruned ``ReadSchema``),
with typed bounds instead of spliced text.  Slices become parallel JDBC
partitions through ``predicates=[...]`` instead of a sequential loop: the
discovered keys are dealt into ranges, and only the ranges' bounds come to the
driver, however many keys there are.

This is the one place that must write predicate text, so quoting lives in a
single helper and a null key becomes ``IS NULL``.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: the reference reads sources with this JDBC fetch size.
FETCH_SIZE = 100000
# Ranges a sliced read is dealt into unless the caller says otherwise.
RANGES = 200


def jdbc_options(url: str, user: str | None = None, password: str | None = None, driver: str | None = None,
                 fetchsize: int = FETCH_SIZE, **extra) -> dict[str, str]:
    opts = {"url": url, "fetchsize": str(fetchsize)}
    if user is not None:
        opts["user"] = user
    if password is not None:
        opts["password"] = password
    if driver is not None:
        opts["driver"] = driver
    opts.update({k: str(v) for k, v in extra.items()})
    return opts


def read_jdbc_table(spark: SparkSession, options: dict[str, str], table: str) -> DataFrame:
    """A JDBC table as a lazy DataFrame (pushdown-capable)."""
    return spark.read.format("jdbc").options(**options).option("dbtable", table).load()


def quote_identifier(name: str) -> str:
    """Double-quoted identifier; keeps case as the reference's slices did."""
    return '"' + name.replace('"', '""') + '"'


def quote_literal(value) -> str:
    return "'" + str(value).replace("'", "''") + "'"


def range_bounds(keys: DataFrame, column: str, ranges: int) -> list:
    """At most ``ranges - 1`` ascending values that deal the distinct values of
    ``column`` into ranges of about equal count.

    Range partitioning orders the values; each partition names its least one.
    """
    values = keys.select(column).where(F.col(column).isNotNull()).distinct()
    least = (
        values.repartitionByRange(ranges, column)
        .groupBy(F.spark_partition_id().alias("p"))
        .agg(F.min(column).alias("v"))
        .collect()
    )
    return sorted({r.v for r in least})[1:]


def range_predicates(column: str, bounds: list, ordered: bool = True) -> list[str]:
    """Predicates of which every value of ``column``, null included, meets exactly one.

    The column stays bare (no cast around it) so the database can use its
    indexes; literals are converted by the database.  Text may sort otherwise
    there: with ``ordered=False`` each range also excludes the ranges before
    it, which is exact under any order.
    """
    name = quote_identifier(column)
    if not bounds:
        return [f"{name} IS NOT NULL", f"{name} IS NULL"]
    out = []
    for k in range(len(bounds) + 1):
        before = bounds[max(0, k - 1) : k] if ordered else bounds[:k]
        terms = [f"{name} >= {quote_literal(b)}" for b in before]
        terms += [f"{name} < {quote_literal(bounds[k])}"] if k < len(bounds) else []
        out.append(" AND ".join(terms))
    return [*out, f"{name} IS NULL"]


def read_jdbc_slices(
    spark: SparkSession,
    options: dict[str, str],
    table: str,
    predicates: list[str],
) -> DataFrame:
    """All slices in one DataFrame, one JDBC partition per slice."""
    props = {k: v for k, v in options.items() if k != "url"}
    return spark.read.jdbc(options["url"], table, predicates=predicates, properties=props)


def register_jdbc_catalog(spark: SparkSession, name: str, options: dict[str, str],
                          push_down_aggregate: bool = True) -> None:
    """Register a DataSource V2 JDBC catalog ``name``.

    Tables read as ``spark.table(f"{name}.{schema}.{table}")`` push filters,
    projections and - with ``push_down_aggregate`` - ``GROUP BY`` / ``MAX``
    to the database, so partition discovery (A1) and the TL-AGG aggregate
    (A3) run at the source as the reference's SQL did
    (``.explain`` shows ``PushedAggregates`` / ``PushedGroupByExpressions``).
    """
    prefix = f"spark.sql.catalog.{name}"
    spark.conf.set(prefix, "org.apache.spark.sql.execution.datasources.v2.jdbc.JDBCTableCatalog")
    for k, v in options.items():
        spark.conf.set(f"{prefix}.{k}", v)
    spark.conf.set(f"{prefix}.pushDownAggregate", str(push_down_aggregate).lower())


def sliced_jdbc_source(
    spark: SparkSession,
    options: dict[str, str],
    table: str,
    source: DataFrame,
    keys: DataFrame,
    columns: list[str],
    ranges: int = RANGES,
    subset: bool = False,
    primary_keys: tuple[str, ...] = (),
) -> DataFrame:
    """The source table read as parallel JDBC partitions, one per key range.

    ``keys`` are the discovered slices as strings (``discover_slices`` over
    ``source``, ideally a catalog table, so the ``GROUP BY`` runs in the
    database).  The ranges are over the first key column, in the type it has
    in ``source``.  The extraction's own filters are applied on top by Spark
    and pushed into every range's query.  With ``subset`` the keys are a
    chosen part of the table's, and only their rows are returned (null-safe).
    Without any key nothing is read.

    Keys that come with their row counts (``discover_slices(...,
    counted=True)``) are dealt by rows over all key columns, and a hot key is
    cut further by ``primary_keys`` (``sources.slices``).
    """
    if keys.isEmpty():
        return read_jdbc_table(spark, options, table).where(F.lit(False))
    from sluice.operators.partitions import KEY_ROWS, restrict_to_partitions

    if KEY_ROWS in keys.columns:
        from sluice.sources.slices import slice_ranges

        dealt = slice_ranges(keys, columns, source, ranges, list(primary_keys))
        rows = read_jdbc_slices(spark, options, table, dealt.predicates)
        return restrict_to_partitions(rows, keys, columns) if subset else rows
    first = columns[0]
    kind = source.schema[first].dataType
    bounds = range_bounds(keys.select(F.col(first).cast(kind).alias(first)), first, ranges)
    rows = read_jdbc_slices(spark, options, table, range_predicates(first, bounds, not isinstance(kind, T.StringType)))
    return restrict_to_partitions(rows, keys, columns) if subset else rows


def key_range_partitioning(source: DataFrame, columns: tuple[str, ...]) -> tuple[str, object, object] | None:
    """``(column, lower, upper)`` for a parallel range read of a whole table.

    The first of ``columns`` that is a whole number, date or timestamp serves;
    its ``MIN`` and ``MAX`` are pushed into the database by the catalog table.
    """
    types = {f.name: f.dataType for f in source.schema.fields}
    for c in columns:
        if isinstance(types.get(c), (T.IntegralType, T.DateType, T.TimestampType, T.TimestampNTZType)):
            low, high = source.agg(F.min(c), F.max(c)).first()
            if low is not None and low < high:
                return c, low, high
    return None


def window_partitioning(cfg, now) -> tuple[str, object, object] | None:
    """``(column, lower, upper)`` for a parallel range read of a config's
    delta window, or ``None``.

    Only a plain single watermark column of a strategy with a lower bound
    qualifies; the upper end is the window's end, or ``now`` for an open
    window.  Spark's first and last range partitions are open-ended, so the
    ranges only spread the read; the extraction's own filter keeps the
    result exact.
    """
    from sluice.functions.predicates import delta_applies, upper_bound_used
    from sluice.plans.strategy import DeltaKind

    col = (cfg.cdc_column or "").strip()
    if not col or any(ch in col for ch in ",+|( "):
        return None
    if not delta_applies(cfg.load_strategy, col, cfg.cdc_timestamp, cfg.cdc_ts_format):
        return None
    kind = cfg.load_strategy.delta
    if kind is DeltaKind.EQUAL:
        return None
    upper = upper_bound_used(cfg.load_strategy, cfg.to_cdc_timestamp, now) if kind is not DeltaKind.LOWER else now
    if upper is None or upper <= cfg.cdc_timestamp:
        return None
    return col, cfg.cdc_timestamp, upper


def window_read_options(options: dict[str, str], table: str, column: str, lower, upper,
                        num_partitions: int) -> dict[str, str]:
    """JDBC options for ``num_partitions`` parallel range reads of ``table``."""
    return dict(
        options,
        dbtable=table,
        partitionColumn=column,
        lowerBound=_bound(lower),
        upperBound=_bound(upper),
        numPartitions=str(num_partitions),
    )


def _bound(value) -> str:
    return value.strftime("%Y-%m-%d %H:%M:%S") if isinstance(value, _dt.datetime) else str(value)


def read_jdbc_window(spark: SparkSession, options: dict[str, str], table: str, column: str, lower, upper,
                     num_partitions: int) -> DataFrame:
    """S1 in parallel: the table read as ``num_partitions`` ranges of ``column``."""
    return spark.read.format("jdbc").options(
        **window_read_options(options, table, column, lower, upper, num_partitions)
    ).load()
