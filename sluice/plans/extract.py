"""One config row -> one extraction plan -> one write.

``plan_extraction`` composes the operators for a config's strategy into a lazy
DataFrame and a sink spec; nothing runs until ``run_extraction`` writes.  The
sequence per strategy:

=================  ============================================================
IO                 P2 (full pull) -> K1 now -> K2 append by EXTRACT_DATE
IO-SNAP            P2 P3 -> K1 watermark -> K2
IO-CDC             P2 P4 (overlap applied) -> K1 watermark -> K2
TL-CDC             P2 P4 -> K1 watermark -> K3 overwrite by EXTRACT_DATE
IO-SNAP-DLY        P2 P5 -> K4 append by target columns, counted
IO-SNAP-MAX-CDC    P2 P6 -> K4, counted, max partition date observed (A7)
IO-CUSTOM-CDC      P2 P6 -> K4, counted
TL-SRC-TGT         P2 -> K5 overwrite by target columns
TL-AGG             P2 A3 -> K5
=================  ============================================================

Unpartitioned runs de-duplicate on ``primary_keys`` (A8); partitioned runs do
not (kept from the reference).  A partitioned run reads its slices as one
scan: the slices are the distinct partition keys of the same filtered rows,
so their union is exactly the filter.  (``restrict_to_partitions`` is the
operator for reading a chosen subset of slices.)
"""

from __future__ import annotations

import datetime as _dt
import uuid
from dataclasses import dataclass, field, replace
from typing import Any, Mapping

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.functions.dialect import plain_name, spark_sql
from sluice.functions.keys import split_names, split_sql_list
from sluice.functions.predicates import (
    and_all,
    delta_predicate,
    static_predicate,
    upper_bound_used,
)
from sluice.operators.config import DEFAULT_QUERY_PARAMETER, PLUS_REWRITE, target_path_text
from sluice.operators.counts import observe_counts, reconcile_gate
from sluice.operators.dedup import dedup_primary_keys
from sluice.operators.partitions import aggregate_filter, restrict_to_partitions
from sluice.operators.sinks import (
    EXTRACT_DATE,
    MAX_RECORDS_PER_FILE,
    SinkSpec,
    arrange_for_write,
    stamp_extract_date,
    write_target,
)
from sluice.plans.strategy import ConfigError, DeltaKind, LoadStrategy


@dataclass(frozen=True)
class ExtractionConfig:
    """A normalised config row (C3 applied)."""

    load_strategy: LoadStrategy
    id: Any = None
    select_columns: str = "*"
    query_parameter: str | None = DEFAULT_QUERY_PARAMETER
    cdc_column: str | None = None
    cdc_timestamp: _dt.datetime | None = None
    to_cdc_timestamp: _dt.datetime | None = None
    cdc_ts_format: str | None = None
    source_partition_column: tuple[str, ...] = ()
    target_partition_column: tuple[str, ...] = ()
    primary_keys: tuple[str, ...] = ()
    agg_column: str | None = None
    agg_column_function: str | None = None
    agg_operation: str | None = None
    target_path: str | None = None
    schema_name: str | None = None
    table_name: str | None = None
    # Tie-break for the deterministic dedup; empty = remaining columns in order.
    dedup_order: tuple[str, ...] = ()
    max_records_per_file: int = MAX_RECORDS_PER_FILE
    files_per_partition: int | None = None
    rebalance_files: bool = False
    half_open_windows: bool = False

    @classmethod
    def from_mapping(cls, raw: Mapping[str, Any]) -> "ExtractionConfig":
        """Build from a raw config row, applying C3 and P10 to this one row.

        Same rules as ``operators.config.normalise_configs`` (a test checks
        that both agree).
        """
        strategy = LoadStrategy.parse(raw.get("load_strategy"))
        qp = raw.get("query_parameter")
        cdc = raw.get("cdc_column")
        if cdc is not None:
            cdc = str(cdc).replace("+", PLUS_REWRITE)
        ts = _as_datetime(raw.get("cdc_timestamp"))
        overlap = raw.get("overlap_in_min")
        if ts is not None and overlap is not None and str(overlap).strip():
            try:
                ts = ts - _dt.timedelta(minutes=int(str(overlap).strip()))
            except ValueError:
                raise ConfigError(f"overlap_in_min must be a whole number, not {overlap!r}") from None
        max_records = _whole_number(raw, "max_records_per_file")
        path = raw.get("target_path") or target_path_text(raw.get("curate_bucket"), raw.get("curate_prefix"))
        return cls(
            load_strategy=strategy,
            id=raw.get("id"),
            select_columns=raw.get("select_columns") or "*",
            query_parameter=DEFAULT_QUERY_PARAMETER if qp is None else qp,
            cdc_column=cdc,
            cdc_timestamp=ts,
            to_cdc_timestamp=_as_datetime(raw.get("to_cdc_timestamp")),
            cdc_ts_format=raw.get("cdc_ts_format"),
            source_partition_column=_names(raw.get("source_partition_column")),
            target_partition_column=_names(raw.get("target_partition_column")),
            primary_keys=_names(raw.get("primary_keys")),
            agg_column=None if raw.get("agg_column") is None else plain_name(str(raw["agg_column"])),
            agg_column_function=raw.get("agg_column_function"),
            agg_operation=raw.get("agg_operation"),
            target_path=path,
            schema_name=raw.get("schema_name"),
            table_name=raw.get("table_name"),
            dedup_order=_names(raw.get("dedup_order")),
            max_records_per_file=MAX_RECORDS_PER_FILE if max_records is None else max_records,
            files_per_partition=_whole_number(raw, "files_per_partition"),
            rebalance_files=_yes(raw, "rebalance_files"),
            half_open_windows=_yes(raw, "half_open_windows"),
        )

    def with_path(self, path: str) -> "ExtractionConfig":
        return replace(self, target_path=path)


def _names(value) -> tuple[str, ...]:
    return tuple(plain_name(n) for n in split_names(value))


def _yes(raw: Mapping[str, Any], name: str) -> bool:
    return str(raw.get(name) or "N").strip().upper() in ("Y", "TRUE")


def _whole_number(raw: Mapping[str, Any], name: str) -> int | None:
    """A positive whole number of a config row, or ``None`` where it is not set."""
    value = raw.get(name)
    if value is None or not str(value).strip():
        return None
    try:
        number = int(str(value).strip())
    except ValueError:
        number = 0
    if number < 1:
        raise ConfigError(f"{name} must be a positive whole number, not {value!r}")
    return number


def _as_datetime(value):
    """Config bounds arrive as datetimes (typed control tables) or as text."""
    if value is None or isinstance(value, _dt.datetime):
        return value
    if isinstance(value, _dt.date):
        return _dt.datetime(value.year, value.month, value.day)
    text = str(value).strip()
    if not text or text.upper() in ("NULL", "NONE"):
        return None
    return _dt.datetime.fromisoformat(text)


def validate(cfg: ExtractionConfig) -> None:
    """Reject configs the reference would half-run and then crash on."""
    s = cfg.load_strategy
    if s is LoadStrategy.IO_SNAP and cfg.cdc_timestamp is None:
        raise ConfigError("IO-SNAP needs cdc_timestamp (its watermark advances from it)")
    if s is LoadStrategy.IO_SNAP_DLY and cfg.to_cdc_timestamp is None:
        raise ConfigError("IO-SNAP-DLY needs to_cdc_timestamp")
    if s is LoadStrategy.TL_AGG and not (cfg.agg_column and cfg.agg_column_function and cfg.agg_operation):
        raise ConfigError("TL-AGG needs agg_column, agg_column_function and agg_operation")
    if s is LoadStrategy.IO_SNAP_MAX_CDC and len(cfg.source_partition_column) > 1:
        raise ConfigError("IO-SNAP-MAX-CDC needs a single date partition column")


def validate_source(source: DataFrame, cfg: ExtractionConfig) -> None:
    """Reject configs whose columns the source cannot serve, before anything is read."""
    types = {f.name.lower(): f.dataType for f in source.schema.fields}
    wanted = cfg.source_partition_column
    missing = [c for c in wanted if c.lower() not in types]
    if missing:
        raise ConfigError(f"source partition columns not in the source: {missing}")
    if cfg.load_strategy is LoadStrategy.IO_SNAP_MAX_CDC and wanted:
        kind = types[wanted[0].lower()]
        if not isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            raise ConfigError(f"IO-SNAP-MAX-CDC needs a date partition column, {wanted[0]!r} is {kind.simpleString()}")


@dataclass
class ExtractionPlan:
    config: ExtractionConfig
    predicate: Column | None
    filtered: DataFrame  # source rows that satisfy the predicate (all columns)
    selected: DataFrame  # what the reference's query returns
    output: DataFrame  # what is written (dedup, stamp; may carry __source_rows)
    sink: SinkSpec | None
    stamp: _dt.datetime | None = None
    partition_date_column: str | None = None
    date_observation: Any = None


@dataclass
class ExtractionResult:
    config: ExtractionConfig
    src_record_count: int
    target_record_count: int
    is_extracted: bool
    read_ts: _dt.datetime
    upper_bound: _dt.datetime | None
    max_partition_date: _dt.date | None = None
    wrote: bool = True
    resumed: bool = False  # taken from the journal of an earlier try, not run again
    extra: dict = field(default_factory=dict)

    @property
    def counts_match(self) -> bool:
        s, t = self.src_record_count, self.target_record_count
        return s != 0 and t != 0 and s == t


@dataclass(frozen=True)
class Source:
    """A source for one config: ``rows`` are read for the extraction;
    ``aggregates`` (optional) answers TL-AGG's scalar aggregate, e.g. a JDBC
    catalog table that pushes ``MAX`` into the database."""

    rows: DataFrame
    aggregates: DataFrame | None = None


def row_predicate(
    source: DataFrame,
    cfg: ExtractionConfig,
    now: _dt.datetime,
    agg_source: DataFrame | None = None,
    materialize_aggregate: bool = False,
) -> Column | None:
    """P2 AND the strategy's delta term (P3-P9) AND, for TL-AGG, A3 (computed
    over ``agg_source`` when given, else over ``source``)."""
    static = static_predicate(cfg.query_parameter)
    delta = delta_predicate(
        source,
        cfg.load_strategy,
        cfg.cdc_column,
        cfg.cdc_timestamp,
        cfg.to_cdc_timestamp,
        cfg.cdc_ts_format,
        now,
        cfg.half_open_windows,
    )
    agg = None
    if cfg.load_strategy.delta is DeltaKind.AGGREGATE:
        agg = aggregate_filter(
            source if agg_source is None else agg_source,
            cfg.agg_column,
            cfg.agg_column_function,
            cfg.agg_operation,
            static,
            materialize=materialize_aggregate,
        )
    return and_all([static, delta, agg])


def plan_extraction(
    source: DataFrame,
    cfg: ExtractionConfig,
    now: _dt.datetime,
    observe_partition_date: bool = False,
    slices: DataFrame | None = None,
    agg_source: DataFrame | None = None,
    materialize_aggregate: bool = False,
    prefiltered: bool = False,
) -> ExtractionPlan:
    """Compose the lazy plan.  With ``observe_partition_date`` an
    ``IO-SNAP-MAX-CDC`` partitioned run also observes its newest partition
    date (A7) on the scan; partitioned runs have no shuffle, so scan and
    write share one stage and the metric is exact.

    ``slices`` (string keys over ``source_partition_column``, as
    :func:`discover_slices` returns them) restricts a partitioned run to those
    slices, e.g. to re-extract only some partitions; null-safe semi-join (A2).
    """
    validate(cfg)
    validate_source(source, cfg)
    pred = None if prefiltered else row_predicate(source, cfg, now, agg_source, materialize_aggregate)
    filtered = source if pred is None else source.where(pred)
    if slices is not None:
        if not cfg.source_partition_column:
            raise ConfigError("slices need source_partition_column")
        filtered = restrict_to_partitions(filtered, slices, list(cfg.source_partition_column))
    strategy = cfg.load_strategy
    date_col = None
    date_obs = None
    if strategy is LoadStrategy.IO_SNAP_MAX_CDC and cfg.source_partition_column:
        date_col = cfg.source_partition_column[0]
        if observe_partition_date:
            date_obs = Observation(f"max_partition_date_{uuid.uuid4().hex}")
            filtered = filtered.observe(
                date_obs, F.max(F.to_date(F.col(date_col).cast("string"))).alias("max_partition_date")
            )
    selected = filtered.selectExpr(*split_sql_list(spark_sql(cfg.select_columns)))
    partitioned = bool(cfg.source_partition_column)

    output = selected
    count_source = not partitioned and bool(cfg.primary_keys)
    if count_source:
        output = dedup_primary_keys(selected, list(cfg.primary_keys), list(cfg.dedup_order), count_source=True)

    stamp = None
    if strategy.stamps_extract_date:
        use_mark = strategy.stamp_uses_watermark and cfg.cdc_timestamp is not None
        stamp = cfg.cdc_timestamp if use_mark else now
        output = stamp_extract_date(output, stamp)
        partition_by = [EXTRACT_DATE]
    else:
        partition_by = list(cfg.target_partition_column)

    sink = None
    if cfg.target_path:
        sink = SinkSpec(
            path=cfg.target_path,
            mode="overwrite" if strategy.overwrites else "append",
            partition_by=partition_by,
            max_records_per_file=cfg.max_records_per_file,
            files_per_partition=cfg.files_per_partition,
            rebalance=cfg.rebalance_files,
        )
    return ExtractionPlan(cfg, pred, filtered, selected, output, sink, stamp, date_col, date_obs)


def run_extraction(
    source: DataFrame,
    cfg: ExtractionConfig,
    now: _dt.datetime,
    read_ts: _dt.datetime | None = None,
    slices: DataFrame | None = None,
    agg_source: DataFrame | None = None,
    run_id: str | None = None,
    prefiltered: bool = False,
) -> ExtractionResult:
    """Plan, write once, and report counts observed in the same pass.

    ``read_ts`` (W3's next lower bound) is fixed before the read is defined,
    so rows committed during the read are picked up by the next run.

    With a ``run_id`` the run can be repeated: what an earlier try under the
    same id appended is removed first.  ``prefiltered`` says that ``source``
    holds just the rows the config selects (``plans.shared``).
    """
    read_ts = read_ts or now
    strategy = cfg.load_strategy
    partitioned = bool(cfg.source_partition_column)
    # A partitioned truncate-and-load checks for rows before writing: two
    # actions, so TL-AGG's one-row aggregate is computed once for both.
    two_actions = partitioned and strategy.overwrites
    plan = plan_extraction(
        source,
        cfg,
        now,
        observe_partition_date=True,
        slices=slices,
        agg_source=agg_source,
        materialize_aggregate=two_actions and strategy is LoadStrategy.TL_AGG,
        prefiltered=prefiltered,
    )
    if plan.sink is None:
        raise ConfigError("config has no target path")
    upper = upper_bound_used(strategy, cfg.to_cdc_timestamp, now)

    if two_actions and plan.selected.isEmpty():
        # Kept from the reference: a partitioned truncate-and-load with no
        # slices writes nothing, so the previous target stays.
        return ExtractionResult(cfg, 0, 0, False, read_ts, upper, None, wrote=False)

    output, sink = plan.output, replace(plan.sink, run_id=run_id)
    # Arranged before observing so the counts stay in the writing stage.
    output = arrange_for_write(output, sink)
    sink = replace(sink, files_per_partition=None, rebalance=False)
    output, obs = observe_counts(output, f"counts_{uuid.uuid4().hex}")
    write_target(output, sink)
    metrics = obs.get
    src = int(metrics.get("src_record_count") or 0)
    tgt = int(metrics.get("target_record_count") or 0)
    max_date = plan.date_observation.get.get("max_partition_date") if plan.date_observation else None
    if strategy is LoadStrategy.IO_CUSTOM_CDC:
        # The reference records the read's end day as the completion date.
        max_date = (now - _dt.timedelta(days=1)).date()
    return ExtractionResult(cfg, src, tgt, src > 0, read_ts, upper, max_date)


def result_row(spark: SparkSession, result: ExtractionResult, now: _dt.datetime) -> DataFrame:
    """A one-row ``runs`` frame for ``operators.watermark.advance_watermark``."""
    cfg = result.config
    row = [
        (
            str(cfg.id) if cfg.id is not None else None,
            cfg.load_strategy.value,
            cfg.cdc_timestamp,
            cfg.to_cdc_timestamp,
            cfg.cdc_ts_format,
            result.read_ts,
            result.max_partition_date,
            result.src_record_count,
            result.target_record_count,
            result.is_extracted,
        )
    ]
    schema = (
        "id string, load_strategy string, cdc_timestamp timestamp_ntz, to_cdc_timestamp timestamp_ntz, "
        "cdc_ts_format string, read_ts timestamp_ntz, max_value date, src_record_count long, "
        "target_record_count long, is_extracted boolean"
    )
    df = spark.createDataFrame(row, schema)
    return df.withColumn("gate", reconcile_gate(F.col("src_record_count"), F.col("target_record_count")))


def discover_slices(
    source: DataFrame, cfg: ExtractionConfig, now: _dt.datetime, agg_source: DataFrame | None = None, counted: bool = False
) -> DataFrame:
    """A1/A4: the distinct partition keys (as strings) the extraction covers, with their rows if ``counted``.

    Same predicate as the extraction (``TL-SRC-TGT`` has no delta term;
    ``TL-AGG`` adds its aggregate filter and its column to the keys).
    """
    from sluice.operators.partitions import discover_partitions, partition_key_columns

    agg = cfg.agg_column if cfg.load_strategy is LoadStrategy.TL_AGG else None
    cols = partition_key_columns(list(cfg.source_partition_column), agg)
    return discover_partitions(source, cols, row_predicate(source, cfg, now, agg_source), counted)
