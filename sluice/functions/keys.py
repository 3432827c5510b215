"""Name lists and key columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def split_names(value: str | list[str] | tuple[str, ...] | None) -> list[str]:
    """``"a, b ,c"`` -> ``["a", "b", "c"]``; empty or ``None`` -> ``[]``.

    Config columns such as ``primary_keys`` and ``target_partition_column``
    hold comma lists; every name is trimmed and empty names are dropped.
    """
    if value is None:
        return []
    if isinstance(value, (list, tuple)):
        items = list(value)
    else:
        items = str(value).split(",")
    return [s.strip() for s in items if s is not None and s.strip()]


def split_sql_list(text: str) -> list[str]:
    """Split a configured select list at its top-level commas.

    Commas inside parentheses, quotes or back-ticks stay with their
    expression, so ``"a, concat(b, ',', c) as d"`` gives two items.  Each item
    is handed to ``selectExpr``; nothing is interpreted here.
    """
    items: list[str] = []
    depth = 0
    quote: str | None = None
    start = 0
    i = 0
    while i < len(text):
        ch = text[i]
        if quote:
            if ch == quote:
                if i + 1 < len(text) and text[i + 1] == quote:
                    i += 1
                else:
                    quote = None
        elif ch in ("'", '"', "`"):
            quote = ch
        elif ch == "(":
            depth += 1
        elif ch == ")":
            depth -= 1
        elif ch == "," and depth == 0:
            items.append(text[start:i].strip())
            start = i + 1
        i += 1
    items.append(text[start:].strip())
    return [s for s in items if s]


def job_line_id(job_name: Column, schema_name: Column, table_name: Column) -> Column:
    """Audit line key: ``md5(concat(upper(job), upper(schema), upper(table)))``."""
    return F.md5(F.concat(F.upper(job_name), F.upper(schema_name), F.upper(table_name)))


def null_safe_match(left: list[Column], right: list[Column]) -> Column:
    """AND of ``l <=> r`` pairs: a null key matches a null key."""
    cond = None
    for lc, rc in zip(left, right):
        term = lc.eqNullSafe(rc)
        cond = term if cond is None else cond & term
    if cond is None:
        raise ValueError("at least one key column is required")
    return cond
