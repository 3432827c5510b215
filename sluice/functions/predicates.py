"""Delta predicates (P2-P11) as Columns.

The reference splices bounds into SQL text (``cdc >= TO_TIMESTAMP('..','fmt')``).
Here a bound is a typed literal compared with the watermark expression, so
Catalyst folds it, pushes it to the scan and no quoting can break it.  The
configured static predicate (``query_parameter``) is SQL text by definition and
is parsed once with ``F.expr``; it is ANDed as a whole Column, so a top-level
``or`` inside it cannot escape the delta term.
"""

from __future__ import annotations

import datetime as _dt
import re
from functools import reduce
from typing import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.functions.dialect import back_ticked, plain_name, spark_sql
from sluice.functions.timefmt import leading_date_format, to_spark_format, ts_text, yesterday_end
from sluice.plans.strategy import ConfigError, DeltaKind, LoadStrategy


def and_all(terms) -> Column | None:
    """AND of the non-``None`` terms; ``None`` when there is none."""
    live = [t for t in terms if t is not None]
    if not live:
        return None
    return reduce(lambda a, b: a & b, live)


def static_predicate(query_parameter: str | None) -> Column | None:
    """The configured row filter; ``None`` or blank means no filter."""
    if query_parameter is None or not str(query_parameter).strip():
        return None
    return F.expr(spark_sql(str(query_parameter)))


def _plus_to_concat(text: str) -> str:
    """P8 on a raw value: ``a+b`` -> ``a||' '||b`` (the C3 rewrite)."""
    return text.replace("+", "||' '||")


def watermark_expression(
    source: DataFrame, cdc_column: str, fmt: str | None
) -> tuple[Column, Callable[[object], Column], bool]:
    """The watermark as a Column, a literal builder for its bounds, and
    whether it is a multi-column watermark (P7).

    ``cdc_column`` is a config value: one column, ``a,b,..`` (P7, concatenated
    without separator as plain ``CONCAT`` does) or ``a+b`` / ``a||' '||b``
    (P8, joined with a space).  Text watermarks are parsed with the
    translated ``cdc_ts_format``; the type is resolved against the source
    schema (analysis only, no job).
    """
    text = spark_sql(_plus_to_concat(cdc_column.strip()))
    parts = [p.strip() for p in text.split(",") if p.strip()]
    multi = len(parts) > 1
    expr = F.concat(*[F.expr(p) for p in parts]) if multi else F.expr(parts[0])
    dtype = source.select(expr.alias("w")).schema["w"].dataType
    spark_fmt = to_spark_format(fmt)

    if isinstance(dtype, T.TimestampNTZType):
        return expr, _ntz_literal, multi
    if isinstance(dtype, T.TimestampType):
        # Compare in the column's own type so JDBC and Parquet pushdown survive.
        return expr, lambda v: F.lit(ts_text(v)).cast("timestamp"), multi
    if isinstance(dtype, T.DateType):
        return expr.cast("timestamp_ntz"), _ntz_literal, multi
    if isinstance(dtype, T.StringType):
        parsed = (
            F.to_timestamp_ntz(expr, F.lit(spark_fmt)) if spark_fmt else expr.cast("timestamp_ntz")
        )
        return parsed, _ntz_literal, multi
    raise ConfigError(f"watermark column {cdc_column!r} has unsupported type {dtype.simpleString()}")


def _ntz_literal(value) -> Column:
    return F.lit(ts_text(value)).cast("timestamp_ntz")


def has_watermark(cdc_column: str | None) -> bool:
    return cdc_column is not None and bool(str(cdc_column).strip())


def delta_applies(
    strategy: LoadStrategy,
    cdc_column: str | None,
    cdc_timestamp,
    cdc_ts_format: str | None,
) -> bool:
    """The delta term is used only when the strategy has one and the
    column, the lower bound and the format are all set; otherwise the source
    is pulled in full, as the reference does."""
    if strategy.delta in (DeltaKind.NONE, DeltaKind.AGGREGATE):
        return False
    return has_watermark(cdc_column) and bool(cdc_timestamp) and bool(cdc_ts_format)


def delta_predicate(
    source: DataFrame,
    strategy: LoadStrategy,
    cdc_column: str | None,
    cdc_timestamp,
    to_cdc_timestamp,
    cdc_ts_format: str | None,
    now: _dt.datetime,
    half_open: bool = False,
) -> Column | None:
    """The delta term of ``strategy`` over ``source``, or ``None``.

    ``cdc_timestamp`` is already shifted by the overlap (P10, done in C3).
    A multi-column watermark is always a lower bound only (kept from the
    reference).  With ``half_open`` a window runs to the end of its upper
    bound's second, so rows within that second are not lost between windows.
    """
    if not delta_applies(strategy, cdc_column, cdc_timestamp, cdc_ts_format):
        return None
    expr, lit, multi = watermark_expression(source, str(cdc_column), cdc_ts_format)
    lower = lit(cdc_timestamp)
    term = _delta_term(strategy, expr, lit, lower, multi, to_cdc_timestamp, now, half_open)
    return and_all([leading_text_bound(source, str(cdc_column), cdc_timestamp, cdc_ts_format), term])


def leading_text_bound(source: DataFrame, cdc_column: str, lower, fmt: str | None) -> Column | None:
    """A bound on the bare first column of a text watermark that the scan can
    push down, or ``None``.

    Only for formats that begin with year, month and day in full: such text
    sorts as its date, so a row at or after ``lower`` has a first column at or
    after the text of ``lower``'s day, or one that holds only the beginning of
    that text.  The exact predicate implies it.
    """
    date_format = leading_date_format(fmt)
    try:
        first = plain_name(re.split(r"\|\||\+|,", cdc_column)[0])
    except ConfigError:
        return None
    types = {f.name: f.dataType for f in source.schema.fields}
    if date_format is None or not isinstance(types.get(first), T.StringType):
        return None
    day = _dt.datetime.fromisoformat(ts_text(lower)).strftime(date_format)
    column = F.col(back_ticked(first))
    return (column >= F.lit(day)) | column.isin([day[:n] for n in range(1, len(day))])


def _delta_term(strategy, expr, lit, lower, multi, to_cdc_timestamp, now, half_open) -> Column:
    def window(upper) -> Column:
        if not half_open:
            return expr.between(lower, lit(upper))
        # the whole of the upper bound's last second belongs to this window
        after = _dt.datetime.fromisoformat(ts_text(upper)) + _dt.timedelta(seconds=1)
        return (expr >= lower) & (expr < lit(after.replace(microsecond=0)))

    if multi:
        return expr >= lower
    kind = strategy.delta
    if kind is DeltaKind.EQUAL:
        return expr == lower
    if kind is DeltaKind.LOWER:
        return expr >= lower
    if kind is DeltaKind.WINDOW:
        if not to_cdc_timestamp:
            raise ConfigError(f"{strategy.value} needs to_cdc_timestamp")
        return window(to_cdc_timestamp)
    if kind is DeltaKind.UNTIL_YESTERDAY:
        return window(yesterday_end(now))
    raise AssertionError(kind)


def upper_bound_used(strategy: LoadStrategy, to_cdc_timestamp, now: _dt.datetime):
    """The upper bound a windowed strategy actually reads to (for W2/W5)."""
    if strategy.delta is DeltaKind.WINDOW:
        return to_cdc_timestamp
    if strategy.delta is DeltaKind.UNTIL_YESTERDAY:
        return yesterday_end(now)
    return None
