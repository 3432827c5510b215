"""One scan of a table for all configs that read it.

Each config asks for other rows of one source table.  ``shared_scan`` reads the
table once, tags every row with the configs whose predicate it satisfies and
stages the tagged rows, one partition folder per config; each config's own
write then reads its folder.  The source, a database above all, is read once
for N configs, and the rows staged are those the configs select.

TL-AGG is left out: its filter needs an aggregate of the whole table first.
"""

from __future__ import annotations

import datetime as _dt
import re
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.plans.extract import ExtractionConfig, ExtractionResult, row_predicate, run_extraction, validate, validate_source
from sluice.plans.scratch import scratch_path
from sluice.plans.strategy import ConfigError, LoadStrategy

TAG = "__config"


def shareable(cfg: ExtractionConfig) -> bool:
    return cfg.load_strategy is not LoadStrategy.TL_AGG


def used_columns(source: DataFrame, configs: list[ExtractionConfig]) -> list[str]:
    """Source columns any of the configs may write, dedup or slice by; all if one selects everything."""
    texts = [c.select_columns for c in configs]
    if any("*" in t for t in texts):
        return source.columns
    named = {n.lower() for c in configs for n in (*c.primary_keys, *c.source_partition_column, *c.dedup_order)}
    words = {w.lower() for t in texts for w in re.findall(r"\w+", t)}
    odd = " ".join(texts).lower()
    return [c for c in source.columns if c.lower() in named or c.lower() in words or (not c.isidentifier() and c.lower() in odd)]


def tagged_rows(source: DataFrame, configs: list[ExtractionConfig], now: _dt.datetime) -> DataFrame:
    """The rows any config selects, once per such config, with its number in ``__config``."""
    predicates = [row_predicate(source, c, now) for c in configs]
    wanted = [F.lit(True) if p is None else F.coalesce(p, F.lit(False)) for p in predicates]
    # plain comparisons, which the scan takes on; a null is false here as well
    some = None if any(p is None for p in predicates) else reduce(lambda a, b: a | b, predicates)
    numbers = F.filter(F.array(*[F.when(w, F.lit(i)) for i, w in enumerate(wanted)]), lambda x: x.isNotNull())
    names = [F.col(f"`{c}`") for c in used_columns(source, configs)]
    rows = source if some is None else source.where(some)
    return rows.select(*names, F.explode(numbers).alias(TAG))


def shared_scan(source: DataFrame, configs: list[ExtractionConfig], now: _dt.datetime) -> list[DataFrame]:
    """Per config the source rows it selects, from one scan of ``source``."""
    for c in configs:
        validate(c)
        validate_source(source, c)
        if not shareable(c):
            raise ConfigError("TL-AGG cannot share a scan")
    path = scratch_path(source.sparkSession, "shared")
    rows = tagged_rows(source, configs, now)
    rows.write.partitionBy(TAG).parquet(path)
    staged = source.sparkSession.read.schema(rows.schema).parquet(path)
    return [staged.where(F.col(TAG) == i).drop(TAG) for i in range(len(configs))]


def run_shared(
    source: DataFrame, configs: list[ExtractionConfig], now: _dt.datetime, run_ids: list[str | None] | None = None
) -> list[ExtractionResult]:
    """Run several configs of one table over one scan of it; one target and one result each."""
    rows = shared_scan(source, configs, now)
    ids = run_ids or [None] * len(configs)
    return [run_extraction(r, c, now, run_id=i, prefiltered=True) for r, c, i in zip(rows, configs, ids)]
