"""Properties: slices union to the whole; consecutive daily windows tile."""

import datetime as dt

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from sluice.operators import partitions
from sluice.operators.watermark import advance_watermark
from sluice.plans.extract import ExtractionConfig, discover_slices, plan_extraction

NOW = dt.datetime(2024, 1, 20, 9, 30)
FMT = "YYYY-MM-DD HH24:MI:SS"


@settings(max_examples=6, deadline=None, derandomize=True)
@given(st.sampled_from(["o_orderstatus", "o_orderpriority", "o_orderstatus, o_orderpriority"]),
       st.integers(min_value=1995, max_value=2001))
def test_slices_union_equals_whole(spark, cols, year):
    orders = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    cfg = ExtractionConfig.from_mapping(dict(load_strategy="IO-CDC", select_columns="*", cdc_column="o_orderdate",
                                             cdc_timestamp=dt.datetime(year, 6, 1), cdc_ts_format=FMT,
                                             source_partition_column=cols))
    plan = plan_extraction(orders, cfg, NOW)
    keys = discover_slices(orders, cfg, NOW)
    sliced = partitions.restrict_to_partitions(plan.selected, keys, list(cfg.source_partition_column))
    assert sliced.exceptAll(plan.selected).count() == 0
    assert plan.selected.exceptAll(sliced).count() == 0


def test_consecutive_daily_windows_neither_overlap_nor_gap(spark):
    # Whole-second source: windows ending at 23:59:59 tile the timeline.
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet").withColumn(
        "ts", F.date_trunc("second", "ts").cast("timestamp_ntz"))
    lo, hi = dt.datetime(2024, 1, 3), dt.datetime(2024, 1, 3, 23, 59, 59)
    seen = []
    for _ in range(5):
        cfg = ExtractionConfig.from_mapping(dict(load_strategy="IO-SNAP-DLY", select_columns="event_id",
                                                 cdc_column="ts", cdc_timestamp=lo, to_cdc_timestamp=hi,
                                                 cdc_ts_format=FMT))
        seen.extend(r.event_id for r in plan_extraction(events, cfg, NOW).selected.collect())
        run = spark.createDataFrame([("IO-SNAP-DLY", lo, hi)],
                                    "load_strategy string, cdc_timestamp timestamp_ntz, to_cdc_timestamp timestamp_ntz")
        nxt = advance_watermark(run, NOW).first()
        assert nxt.next_cdc_ts == hi.replace(hour=0, minute=0, second=0) + dt.timedelta(days=1)
        lo, hi = nxt.next_cdc_ts, nxt.next_to_ts
    assert len(seen) == len(set(seen))
    expected = events.where((F.col("ts") >= F.lit("2024-01-03").cast("timestamp_ntz")) &
                            (F.col("ts") < F.lit("2024-01-08").cast("timestamp_ntz"))).count()
    assert len(seen) == expected


_DELTA_STRATEGIES = ["IO-SNAP", "IO-CDC", "TL-CDC", "IO-SNAP-DLY", "IO-SNAP-MAX-CDC", "IO-CUSTOM-CDC"]


@settings(max_examples=20, deadline=None, derandomize=True)
@given(
    strategy=st.sampled_from(_DELTA_STRATEGIES),
    lo=st.datetimes(min_value=dt.datetime(2023, 12, 30), max_value=dt.datetime(2024, 2, 1)),
    span=st.integers(min_value=0, max_value=5 * 24 * 3600),
    overlap=st.integers(min_value=0, max_value=600),
)
def test_delta_predicate_matches_brute_force(spark, strategy, lo, span, overlap):
    from sluice.functions.timefmt import yesterday_end

    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    rows = [(r.event_id, r.ts) for r in events.select("event_id", "ts").collect()]
    hi = lo + dt.timedelta(seconds=span)
    cfg = ExtractionConfig.from_mapping(dict(load_strategy=strategy, select_columns="event_id", cdc_column="ts",
                                             cdc_timestamp=lo, to_cdc_timestamp=hi, cdc_ts_format=FMT,
                                             overlap_in_min=str(overlap)))
    low = lo - dt.timedelta(minutes=overlap)
    rule = {
        "IO-SNAP": lambda t: t == low,
        "IO-CDC": lambda t: t >= low,
        "TL-CDC": lambda t: t >= low,
        "IO-SNAP-DLY": lambda t: low <= t <= hi,
        "IO-SNAP-MAX-CDC": lambda t: low <= t <= yesterday_end(NOW),
        "IO-CUSTOM-CDC": lambda t: low <= t <= yesterday_end(NOW),
    }[strategy]
    got = {r.event_id for r in plan_extraction(events, cfg, NOW).selected.collect()}
    assert got == {i for i, t in rows if rule(t)}


def test_watermark_advance_matches_a_model_of_the_rules(spark):
    import random

    from sluice.operators.watermark import advance_watermark

    rng = random.Random(11)
    names = ["IO", "IO-SNAP", "IO-CDC", "TL-CDC", "IO-SNAP-DLY", "IO-SNAP-MAX-CDC", "IO-CUSTOM-CDC", "TL-SRC-TGT",
             "TL-AGG"]
    rows = []
    for i in range(150):
        lo = dt.datetime(2024, 1, 1) + dt.timedelta(seconds=rng.randrange(0, 400 * 86400))
        hi = lo + dt.timedelta(seconds=rng.randrange(0, 3 * 86400))
        mx = dt.date(2024, 2, 27) + dt.timedelta(days=rng.randrange(0, 400)) if rng.random() < 0.8 else None
        rows.append((str(i), rng.choice(names), lo, hi, mx, rng.random() < 0.5, rng.random() < 0.9))
    now = dt.datetime(2024, 3, 1, 9, 30)
    df = spark.createDataFrame(rows, "id string, load_strategy string, cdc_timestamp timestamp_ntz, "
                                     "to_cdc_timestamp timestamp_ntz, max_value date, gate boolean, is_extracted boolean")
    got = {r.id: (r.next_cdc_ts, r.next_to_ts) for r in advance_watermark(df, now).collect()}
    day = dt.timedelta(days=1)

    def midnight(d):
        return dt.datetime(d.year, d.month, d.day)

    def model(s, lo, hi, mx, gate, extracted):
        if not extracted:
            return (None, None)
        if s == "IO-SNAP":
            return (lo + day, None)
        if s == "IO-SNAP-DLY":
            return (midnight(hi + day), hi + day)
        if s in ("IO-CDC", "TL-CDC"):
            return (now, None)
        if s == "IO-SNAP-MAX-CDC" and gate and mx is not None:
            return (midnight(mx + day), midnight(mx + day) + dt.timedelta(seconds=86399))
        if s == "IO-CUSTOM-CDC" and gate:
            return (midnight(now), midnight(now) + dt.timedelta(seconds=86399))
        return (None, None)

    assert all(got[r[0]] == model(*r[1:]) for r in rows)
