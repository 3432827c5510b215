"""Every strategy x (watermark column present/absent) x (bound present/absent)
x (single / comma / plus column), checked against plain Python filtering."""

import datetime as dt
import itertools

import pytest
from pyspark.sql import functions as F

from sluice.plans.extract import ExtractionConfig, plan_extraction
from sluice.plans.strategy import ConfigError, LoadStrategy

NOW = dt.datetime(2024, 1, 20, 9, 30)
FMT = "YYYY-MM-DD HH24:MI:SS"
LO = dt.datetime(2024, 1, 18, 6, 0, 0)
HI = dt.datetime(2024, 1, 19, 12, 0, 0)


@pytest.fixture(scope="module")
def source(spark):
    # Whole-second timestamps every 7 minutes over ~5 days, plus text parts.
    start = dt.datetime(2024, 1, 16)
    rows = [(i, start + dt.timedelta(minutes=7 * i)) for i in range(1100)]
    df = spark.createDataFrame(rows, "id long, ts timestamp_ntz")
    return df.select(
        "id", "ts",
        F.date_format("ts", "yyyy-MM-dd").alias("D"),
        F.date_format("ts", "HH:mm:ss").alias("T"),
        F.date_format("ts", "yyyy-MM-dd ").alias("DS"),
    ).cache()


def expected_ids(rows, strategy, column, has_ts):
    s = LoadStrategy(strategy)
    if s in (LoadStrategy.IO, LoadStrategy.TL_SRC_TGT) or column is None or not has_ts:
        return {r[0] for r in rows}
    if column != "ts":  # composite text watermarks
        if "," in column:
            return {r[0] for r in rows if r[1] >= LO}
    ts_ok = {
        LoadStrategy.IO_SNAP: lambda t: t == LO,
        LoadStrategy.IO_CDC: lambda t: t >= LO,
        LoadStrategy.TL_CDC: lambda t: t >= LO,
        LoadStrategy.IO_SNAP_DLY: lambda t: LO <= t <= HI,
        LoadStrategy.IO_SNAP_MAX_CDC: lambda t: LO <= t <= dt.datetime(2024, 1, 19, 23, 59, 59),
        LoadStrategy.IO_CUSTOM_CDC: lambda t: LO <= t <= dt.datetime(2024, 1, 19, 23, 59, 59),
    }[s]
    return {r[0] for r in rows if ts_ok(r[1])}


CASES = list(itertools.product(
    [s.value for s in LoadStrategy if s is not LoadStrategy.TL_AGG],
    [None, "ts", "DS,T", "D+T"],
    [True, False],
))


@pytest.mark.parametrize("strategy,column,has_ts", CASES)
def test_delta_matrix(spark, source, strategy, column, has_ts):
    rows = [(r.id, r.ts) for r in source.select("id", "ts").collect()]
    raw = dict(load_strategy=strategy, select_columns="id", cdc_column=column,
               cdc_timestamp=LO if has_ts else None, to_cdc_timestamp=HI, cdc_ts_format=FMT)
    if strategy == "IO-SNAP" and not has_ts:
        with pytest.raises(ConfigError):
            plan_extraction(source, ExtractionConfig.from_mapping(raw), NOW)
        return
    got = {r.id for r in plan_extraction(source, ExtractionConfig.from_mapping(raw), NOW).selected.collect()}
    assert got == expected_ids(rows, strategy, column, has_ts)


def test_missing_format_pulls_everything(spark, source):
    raw = dict(load_strategy="IO-CDC", select_columns="id", cdc_column="ts", cdc_timestamp=LO)
    got = plan_extraction(source, ExtractionConfig.from_mapping(raw), NOW).selected.count()
    assert got == source.count()


def test_window_without_upper_bound_is_rejected(spark, source):
    raw = dict(load_strategy="IO-SNAP-DLY", cdc_column="ts", cdc_timestamp=LO, cdc_ts_format=FMT)
    with pytest.raises(ConfigError):
        plan_extraction(source, ExtractionConfig.from_mapping(raw), NOW)


def test_static_predicate_with_or_cannot_escape_delta(spark, source):
    raw = dict(load_strategy="IO-CDC", select_columns="id, ts", cdc_column="ts", cdc_timestamp=HI,
               cdc_ts_format=FMT, query_parameter="id < 5 or id > 1000")
    rows = plan_extraction(source, ExtractionConfig.from_mapping(raw), NOW).selected.collect()
    assert rows and all(r.ts >= HI for r in rows)


def test_bounds_reach_the_parquet_scan(spark):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    raw = dict(load_strategy="IO-SNAP-DLY", select_columns="event_id", cdc_column="ts",
               cdc_timestamp=LO, to_cdc_timestamp=HI, cdc_ts_format=FMT)
    plan = plan_extraction(events, ExtractionConfig.from_mapping(raw), NOW).selected
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(ts" in text and "LessThanOrEqual(ts" in text
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz>" in text


def test_unknown_strategy_rejected():
    with pytest.raises(ConfigError):
        ExtractionConfig.from_mapping(dict(load_strategy="IO-SNAPSHOT"))


@pytest.mark.parametrize("columns, first", [("DT,TM", "yyyy-MM-dd "), ("DT+TM", "yyyy-MM-dd"), ("WM", None), ("Y,M", "split")])
def test_text_watermark_prunes_without_losing_rows(spark, scratch, columns, first):
    """The pushed bound on the first column is implied by the exact predicate, however the text is split."""
    import datetime as dt

    from pyspark.sql import functions as F

    from sluice.plans.extract import ExtractionConfig, plan_extraction

    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet").select("event_id", "ts")
    text = {"WM": F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), "DT": F.date_format("ts", first if first and first != "split" else "yyyy-MM-dd"),
            "TM": F.date_format("ts", "HH:mm:ss"), "Y": F.date_format("ts", "yyyy-MM"), "M": F.date_format("ts", "-dd HH:mm:ss")}
    path = scratch("text_wm")
    events.withColumns(text).write.parquet(path)
    cfg = ExtractionConfig.from_mapping(dict(load_strategy="IO-CDC", select_columns="event_id", cdc_column=columns,
                                             cdc_timestamp=dt.datetime(2024, 1, 20, 6), cdc_ts_format="YYYY-MM-DD HH24:MI:SS"))
    got = plan_extraction(spark.read.parquet(path), cfg, dt.datetime(2024, 1, 26)).selected
    plan = got._jdf.queryExecution().executedPlan().toString()
    pushed = plan[plan.index("PushedFilters"):].split("\n")[0]
    assert "GreaterThanOrEqual" in pushed
    want = events.where("date_trunc('second', ts) >= timestamp_ntz'2024-01-20 06:00:00'")
    assert sorted(r[0] for r in got.collect()) == sorted(r.event_id for r in want.collect())


@pytest.mark.parametrize("strategy, upper", [("IO-SNAP-DLY", "2024-01-19 23:59:59"), ("IO-CUSTOM-CDC", None)])
def test_half_open_windows_lose_no_fraction(spark, strategy, upper):
    import datetime as dt

    from sluice.plans.extract import ExtractionConfig, plan_extraction

    rows = ["2024-01-18 00:00:00", "2024-01-19 23:59:59", "2024-01-19 23:59:59.5", "2024-01-19 23:59:59.999999", "2024-01-20 00:00:00"]
    source = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "id int, t string").selectExpr("id", "cast(t as timestamp_ntz) as ts")
    base = dict(load_strategy=strategy, select_columns="id", cdc_column="ts", cdc_timestamp=dt.datetime(2024, 1, 18),
                to_cdc_timestamp=upper, cdc_ts_format="YYYY-MM-DD HH24:MI:SS")
    got = {}
    for flag in (None, "Y"):
        cfg = ExtractionConfig.from_mapping(dict(base, half_open_windows=flag))
        got[flag] = sorted(r.id for r in plan_extraction(source, cfg, dt.datetime(2024, 1, 20, 9, 30)).selected.collect())
    assert got == {None: [0, 1], "Y": [0, 1, 2, 3]}
