"""Primary-key de-duplication.

``dropDuplicates`` keeps an arbitrary row per key (the reference's behaviour);
reruns can then write different rows.  The default here keeps the smallest row
under a full tie-break order, computed as ``min(struct(order columns, rest))``
per key.  ``min`` is an ordinary aggregate, so Spark combines it map-side before
the shuffle: a key that holds a third of all rows arrives at its reducer as one
partial row per map task, never as one sorted group in one task (which a
``row_number()`` window would need).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SOURCE_ROWS = "__source_rows"


def _orderable(dt: T.DataType) -> bool:
    if isinstance(dt, (T.MapType, T.VariantType)):
        return False
    if isinstance(dt, T.StructType):
        return all(_orderable(f.dataType) for f in dt.fields)
    if isinstance(dt, T.ArrayType):
        return _orderable(dt.elementType)
    return True


def dedup_primary_keys(
    rows: DataFrame,
    keys: list[str],
    order_by: list[str] | None = None,
    deterministic: bool = True,
    count_source: bool = False,
) -> DataFrame:
    """One row per ``keys``.

    ``order_by`` names the tie-break columns, compared first; the remaining
    non-key columns follow in schema order, so the choice is total.  Values
    compare as in Spark's ascending sort (a null sorts first).  With
    ``count_source`` an extra ``__source_rows`` column carries how many input
    rows each output row stands for, so the source count can be observed
    after the shuffle, in the stage that writes (see ``operators.counts``).
    """
    if not keys:
        return rows.withColumn(SOURCE_ROWS, F.lit(1).cast("long")) if count_source else rows
    names = rows.columns
    missing = [k for k in keys if k not in names]
    if missing:
        raise ValueError(f"primary key columns not in the extraction: {missing}")
    rest = [c for c in names if c not in keys]
    order = [c for c in (order_by or []) if c in rest]
    tail = order + [c for c in rest if c not in order]
    schema = {f.name: f.dataType for f in rows.schema.fields}

    arbitrary = not deterministic or not all(_orderable(schema[c]) for c in tail)
    if arbitrary and not count_source:
        return rows.dropDuplicates(keys)

    pick = F.first if arbitrary else F.min
    if not tail:
        aggs = []
    else:
        aggs = [pick(F.struct(*[F.col(c).alias(f"__o{i}") for i, c in enumerate(tail)])).alias("__best")]
    if count_source:
        aggs.append(F.count(F.lit(1)).alias(SOURCE_ROWS))
    if not aggs:
        return rows.distinct()
    picked = rows.groupBy(*keys).agg(*aggs)
    position = {c: i for i, c in enumerate(tail)}
    cols = [F.col(c) if c in keys else F.col(f"__best.__o{position[c]}").alias(c) for c in names]
    if count_source:
        cols.append(F.col(SOURCE_ROWS))
    return picked.select(*cols)
