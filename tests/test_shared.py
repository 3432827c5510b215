"""One scan for several configs of a table."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from sluice.plans import shared
from sluice.plans.extract import ExtractionConfig, run_extraction
from sluice.plans.strategy import ConfigError

SF = "/root/testdata/sf0.001"
NOW = dt.datetime(2024, 1, 20, 9, 30)
FMT = "YYYY-MM-DD HH24:MI:SS"
OWN = [
    dict(load_strategy="IO", select_columns="*"),
    dict(load_strategy="IO-CDC", select_columns="event_id, upper(event_type) as t", cdc_column="ts", cdc_timestamp=dt.datetime(2024, 1, 12)),
    dict(load_strategy="IO-SNAP-DLY", select_columns="event_id, event_type", cdc_column="ts", cdc_timestamp=dt.datetime(2024, 1, 10),
         to_cdc_timestamp=dt.datetime(2024, 1, 11), target_partition_column="event_type", primary_keys="event_id"),
    dict(load_strategy="TL-SRC-TGT", select_columns="user_id", query_parameter="event_type = 'nothing'"),
    dict(load_strategy="TL-CDC", select_columns="event_id", cdc_column="ts", cdc_timestamp=dt.datetime(2024, 1, 25)),
]


def _configs(scratch, label, own=OWN):
    return [ExtractionConfig.from_mapping(dict(c, id=str(i), cdc_ts_format=FMT, target_path=f"{scratch(label)}/{i}")) for i, c in enumerate(own)]


def test_equal_to_single_runs_over_one_scan(spark, scratch, monkeypatch):
    events = spark.read.parquet(f"{SF}/events.parquet")
    together, alone = _configs(scratch, "together"), _configs(scratch, "alone")
    results = shared.run_shared(events, together, NOW)
    for a, b, one in zip(together, alone, results):
        single = run_extraction(events, b, NOW)
        assert (one.src_record_count, one.target_record_count, one.is_extracted) == (
            single.src_record_count, single.target_record_count, single.is_extracted)
        left, right = spark.read.parquet(a.target_path), spark.read.parquet(b.target_path)
        assert left.columns == right.columns and left.exceptAll(right).count() == right.exceptAll(left).count() == 0


def test_one_scan_in_the_plan(spark, scratch, capsys):
    events = spark.read.parquet(f"{SF}/events.parquet")
    shared.tagged_rows(events, _configs(scratch, "plan")[1:3], NOW).explain()
    plan = capsys.readouterr().out
    assert plan.count("FileScan") == 1 and "Exchange" not in plan
    assert "PushedFilters: [Or(" in plan and "props" not in plan.split("ReadSchema")[1]


def test_used_columns(spark, scratch):
    df = spark.createDataFrame([(1, 2, 3, 4, 5)], "id long, `odd name` int, ts int, Part int, other int")
    cfg = lambda **k: ExtractionConfig.from_mapping(dict(load_strategy="IO", **k))
    one = cfg(select_columns='"odd name", ID', primary_keys="ts")
    assert shared.used_columns(df, [one, cfg(select_columns="concat(part, 'x')")]) == ["id", "odd name", "ts", "Part"]
    assert shared.used_columns(df, [one, cfg(select_columns="*")]) == df.columns


def test_tl_agg_is_not_shared(spark, scratch):
    df = spark.createDataFrame([(1,)], "v int")
    agg = ExtractionConfig.from_mapping(dict(load_strategy="TL-AGG", agg_column="v", agg_column_function="max", agg_operation="="))
    assert not shared.shareable(agg)
    with pytest.raises(ConfigError):
        shared.shared_scan(df, [agg, agg], NOW)
