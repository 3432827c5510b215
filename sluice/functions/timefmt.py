"""Timestamp literals and source-dialect format translation.

All bounds are ``timestamp_ntz`` literals built from text, so a comparison
never depends on the session time zone and Catalyst can push it into the
Parquet scan (``PushedFilters``) or the JDBC query.
"""

from __future__ import annotations

import datetime as _dt
import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Source-dialect datetime tokens (SQL-database style, as written in
# ``cdc_ts_format``) and the Spark datetime pattern each one maps to.  Longer
# tokens are listed before their prefixes.
DIALECT_TOKENS = [
    ("YYYY", "yyyy"),
    ("YY", "yy"),
    ("MONTH", "MMMM"),
    ("MON", "MMM"),
    ("MM", "MM"),
    ("DDD", "DDD"),
    ("DD", "dd"),
    ("HH24", "HH"),
    ("HH12", "hh"),
    ("HH", "hh"),
    ("MI", "mm"),
    ("SS", "ss"),
    ("FF9", "SSSSSSSSS"),
    ("FF7", "SSSSSSS"),
    ("FF6", "SSSSSS"),
    ("FF3", "SSS"),
    ("FF", "SSSSSS"),
    ("AM", "a"),
    ("PM", "a"),
]

_TOKEN_RE = re.compile("|".join(re.escape(t) for t, _ in DIALECT_TOKENS), re.IGNORECASE)
_QUOTED_RE = re.compile(r'"([^"]*)"')
_TOKEN_MAP = dict(DIALECT_TOKENS)
# Fixed value: what marks a config format as a Spark pattern already.
SPARK_MARKER = "spark:"
# Starts of a format under which text sorts as its date, with
# the pattern of the date part.
LEADING_DATES = [("YYYY-MM-DD", "%Y-%m-%d"), ("YYYY/MM/DD", "%Y/%m/%d"), ("YYYY.MM.DD", "%Y.%m.%d"), ("YYYYMMDD", "%Y%m%d")]


def to_spark_format(fmt: str | None) -> str | None:
    """Translate a source-dialect timestamp format into a Spark pattern.

    ``None`` stays ``None``.  Tokens match in any case, as in the dialect;
    double-quoted and other text between them is literal.  A Spark pattern is
    taken as it is only behind the marker ``spark:``.
    """
    if fmt is None:
        return None
    if fmt.startswith(SPARK_MARKER):
        return fmt[len(SPARK_MARKER) :]
    out, literal, pos = [], "", 0
    while pos < len(fmt):
        quoted, token = _QUOTED_RE.match(fmt, pos), _TOKEN_RE.match(fmt, pos)
        if token:
            out += [_quote_literal(literal), _TOKEN_MAP[token.group(0).upper()]]
            literal, pos = "", token.end()
        elif quoted:
            literal, pos = literal + quoted.group(1), quoted.end()
        else:
            literal, pos = literal + fmt[pos], pos + 1
    return "".join([*out, _quote_literal(literal)])


def leading_date_format(fmt: str | None) -> str | None:
    """The ``strftime`` pattern of the date a format begins with, if text in it sorts as that date."""
    for start, pattern in LEADING_DATES:
        if fmt and fmt.upper().startswith(start):
            return pattern
    return None


def _quote_literal(text: str) -> str:
    if re.fullmatch(r"[\s\-:/.,]*", text):
        return text
    return "'" + text.replace("'", "''") + "'"


def ts_text(value: _dt.datetime | _dt.date | str) -> str:
    """Render a bound as ``YYYY-MM-DD HH:MM:SS[.ffffff]`` text."""
    if isinstance(value, _dt.datetime):
        return value.isoformat(sep=" ")
    if isinstance(value, _dt.date):
        return value.isoformat() + " 00:00:00"
    return str(value)


def ts_lit(value: _dt.datetime | _dt.date | str) -> Column:
    """A ``timestamp_ntz`` literal; folded to a constant by Catalyst."""
    return F.lit(ts_text(value)).cast("timestamp_ntz")


def day_start(col: Column) -> Column:
    """Midnight of the day of ``col`` as ``timestamp_ntz``."""
    return F.to_date(col).cast("timestamp_ntz")


def day_end(col: Column) -> Column:
    """``23:59:59`` of the day of ``col`` (whole seconds, as the reference)."""
    return day_start(col) + F.expr("INTERVAL '23:59:59' HOUR TO SECOND")


def stamp_text(value: _dt.datetime) -> str:
    """``EXTRACT_DATE`` text, ``%Y-%m-%d %H:%M:%S``."""
    return value.strftime("%Y-%m-%d %H:%M:%S")


def yesterday_end(now: _dt.datetime) -> _dt.datetime:
    """Upper bound of P6: the day before ``now`` at 23:59:59."""
    d = (now - _dt.timedelta(days=1)).date()
    return _dt.datetime(d.year, d.month, d.day, 23, 59, 59)
