"""Writes, read-back, reruns, zero rows and file sizing (K1-K6)."""

import datetime as dt
import glob
import os
from dataclasses import replace

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.operators.sinks import EXTRACT_DATE, SinkSpec, read_target, write_target
from sluice.plans.extract import ExtractionConfig, run_extraction
from sluice.plans.strategy import ConfigError

NOW = dt.datetime(2024, 1, 20, 9, 30)
FMT = "YYYY-MM-DD HH24:MI:SS"
SF = "/root/testdata/sf0.001"


def _local(path):
    return path[len("file:"):] if path.startswith("file:") else path


def test_max_records_per_file(spark, scratch):
    path = scratch("files")
    df = spark.range(1000).coalesce(1)
    write_target(df, SinkSpec(path, "overwrite", [], max_records_per_file=100))
    assert len(glob.glob(os.path.join(_local(path), "*.parquet"))) == 10
    assert spark.read.parquet(path).count() == 1000


def test_values_with_many_files_are_written_side_by_side(spark, scratch, monkeypatch):
    from sluice.operators import loads, sinks

    path, spec = scratch("side"), SinkSpec("", "overwrite", ["k"], max_records_per_file=10, files_per_partition=1)
    df = spark.range(400).selectExpr("id", "concat('v', id % 4) as k")
    placed = sinks.arrange_for_write(df, spec).rdd.getNumPartitions()
    assert placed == int(spark.conf.get("spark.sql.shuffle.partitions"))
    listed = []
    monkeypatch.setattr(loads, "remove_superseded", lambda *a: listed.append(a))
    write_target(df, replace(spec, path=path))
    assert not listed and spark.read.parquet(path).groupBy("k").count().where("count = 100").count() == 4
    assert len(glob.glob(os.path.join(_local(path), "k=*", "*.parquet"))) == 40
    write_target(df, replace(spec, path=path))
    assert len(listed) == 1


def test_truncate_load_rerun_is_idempotent(spark, scratch):
    events = spark.read.parquet(f"{SF}/events.parquet")
    path = scratch("tl")
    cfg = ExtractionConfig.from_mapping(dict(load_strategy="TL-SRC-TGT", select_columns="event_id, event_type",
                                             target_partition_column="event_type", target_path=path))
    r1 = run_extraction(events, cfg, NOW)
    r2 = run_extraction(events, cfg, NOW)
    assert r1.target_record_count == r2.target_record_count == events.count()
    assert spark.read.parquet(path).count() == events.count()


def test_tl_cdc_rerun_replaces_extract_date(spark, scratch):
    events = spark.read.parquet(f"{SF}/events.parquet")
    path = scratch("tlcdc")
    for lower in (dt.datetime(2024, 1, 10), dt.datetime(2024, 1, 25)):
        cfg = ExtractionConfig.from_mapping(dict(load_strategy="TL-CDC", select_columns="event_id, ts",
                                                 cdc_column="ts", cdc_timestamp=lower, cdc_ts_format=FMT,
                                                 target_path=path))
        run_extraction(events, cfg, NOW)
    schema = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("ts", T.TimestampNTZType()),
                           T.StructField(EXTRACT_DATE, T.TimestampNTZType())])
    back = read_target(spark, path, schema)
    assert {r[0] for r in back.select(EXTRACT_DATE).distinct().collect()} == {dt.datetime(2024, 1, 25)}
    assert back.count() == events.where(F.col("ts") >= F.lit("2024-01-25").cast("timestamp_ntz")).count()


def test_zero_rows_unpartitioned_truncate_empties_target(spark, scratch):
    events = spark.read.parquet(f"{SF}/events.parquet")
    path = scratch("zero")
    full = ExtractionConfig.from_mapping(dict(load_strategy="TL-SRC-TGT", select_columns="event_id", target_path=path))
    run_extraction(events, full, NOW)
    none = ExtractionConfig.from_mapping(dict(load_strategy="TL-SRC-TGT", select_columns="event_id",
                                              query_parameter="event_id < 0", target_path=path))
    res = run_extraction(events, none, NOW)
    assert (res.src_record_count, res.is_extracted) == (0, False)
    assert spark.read.schema("event_id long").parquet(path).count() == 0


def test_zero_rows_partitioned_truncate_keeps_target(spark, scratch):
    events = spark.read.parquet(f"{SF}/events.parquet")
    path = scratch("zero_part")
    base = dict(load_strategy="TL-SRC-TGT", select_columns="event_id, event_type",
                source_partition_column="event_type", target_partition_column="event_type", target_path=path)
    run_extraction(events, ExtractionConfig.from_mapping(base), NOW)
    res = run_extraction(events, ExtractionConfig.from_mapping(dict(base, query_parameter="event_id < 0")), NOW)
    assert res.wrote is False and res.is_extracted is False
    assert spark.read.parquet(path).count() == events.count()


def test_counts_observed_in_write_with_dedup(spark, scratch):
    lineitem = spark.read.parquet(f"{SF}/lineitem.parquet")
    cfg = ExtractionConfig.from_mapping(dict(load_strategy="IO-SNAP-DLY", cdc_column="l_shipdate",
                                             cdc_timestamp=dt.datetime(1990, 1, 1),
                                             to_cdc_timestamp=dt.datetime(2030, 1, 1), cdc_ts_format=FMT,
                                             primary_keys="l_orderkey, l_linenumber", target_path=scratch("dedup")))
    res = run_extraction(lineitem, cfg, NOW)
    assert res.src_record_count == lineitem.count()
    assert res.target_record_count == lineitem.select("l_orderkey", "l_linenumber").distinct().count()
    assert spark.read.parquet(cfg.target_path).count() == res.target_record_count
    assert res.counts_match is False  # duplicates make the gate fail, as in the reference


def test_max_cdc_observes_newest_partition_date(spark, scratch):
    events = spark.read.parquet(f"{SF}/events.parquet").withColumn("event_date", F.to_date("ts"))
    cfg = ExtractionConfig.from_mapping(dict(load_strategy="IO-SNAP-MAX-CDC", select_columns="event_id, ts",
                                             cdc_column="ts", cdc_timestamp=dt.datetime(2024, 1, 15),
                                             cdc_ts_format=FMT, source_partition_column="event_date",
                                             target_path=scratch("maxcdc")))
    res = run_extraction(events, cfg, NOW)
    assert res.max_partition_date == dt.date(2024, 1, 19)
    assert res.counts_match and res.src_record_count == spark.read.parquet(cfg.target_path).count()


def test_reload_chosen_slices_only(spark, scratch):
    events = spark.read.parquet(f"{SF}/events.parquet")
    path = scratch("slices")
    cfg = ExtractionConfig.from_mapping(dict(load_strategy="IO-CDC", select_columns="event_id, event_type",
                                             cdc_column="ts", cdc_timestamp=dt.datetime(2024, 1, 15),
                                             cdc_ts_format=FMT, source_partition_column="event_type",
                                             target_path=path))
    chosen = spark.createDataFrame([("view",), ("error",)], "event_type string")
    res = run_extraction(events, cfg, NOW, slices=chosen)
    expected = events.where((F.col("ts") >= F.lit("2024-01-15").cast("timestamp_ntz"))
                            & F.col("event_type").isin("view", "error")).count()
    assert res.src_record_count == res.target_record_count == expected
    back = spark.read.parquet(path)
    assert {r.event_type for r in back.select("event_type").distinct().collect()} == {"view", "error"}


def test_tl_agg_aggregate_from_a_separate_source(spark, scratch):
    # The aggregate frame decides the threshold; rows come from the row frame.
    lineitem = spark.read.parquet(f"{SF}/lineitem.parquet")
    cfg = ExtractionConfig.from_mapping(dict(load_strategy="TL-AGG", select_columns="l_orderkey, l_shipdate",
                                             agg_column="l_shipdate", agg_column_function="max", agg_operation="=",
                                             target_path=scratch("agg")))
    older = lineitem.where(F.col("l_shipdate") < F.lit("1998-01-01").cast("timestamp_ntz"))
    res = run_extraction(lineitem, cfg, NOW, agg_source=older)
    newest_old = older.agg(F.max("l_shipdate")).first()[0]
    assert res.src_record_count == lineitem.where(F.col("l_shipdate") == newest_old).count() > 0


def test_partitioned_tl_agg_equals_unpartitioned(spark, scratch):
    lineitem = spark.read.parquet(f"{SF}/lineitem.parquet")
    base = dict(load_strategy="TL-AGG", select_columns="l_orderkey, l_linenumber, l_linestatus, l_shipdate",
                query_parameter="l_returnflag = 'N'", agg_column="l_shipdate", agg_column_function="max",
                agg_operation="=", target_partition_column="l_linestatus")
    whole = run_extraction(lineitem, ExtractionConfig.from_mapping(dict(base, target_path=scratch("tla"))), NOW)
    sliced_cfg = ExtractionConfig.from_mapping(dict(base, source_partition_column="l_linestatus",
                                                    target_path=scratch("tlb")))
    sliced = run_extraction(lineitem, sliced_cfg, NOW)
    assert whole.src_record_count == sliced.src_record_count > 0
    a = spark.read.parquet(whole.config.target_path)
    b = spark.read.parquet(sliced.config.target_path)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    from sluice.plans.extract import discover_slices
    keys = discover_slices(lineitem, sliced_cfg, NOW)
    assert keys.columns == ["l_linestatus", "l_shipdate"]  # A4: the aggregate column joins the keys


def test_counts_of_a_plan_folded_to_empty(spark, scratch):
    # `1=0` lets Catalyst replace the scan with an empty relation; the
    # observation must still report (0, 0) instead of waiting forever.
    events = spark.read.parquet(f"{SF}/events.parquet")
    for extra in ({}, {"primary_keys": "event_id"}):
        cfg = ExtractionConfig.from_mapping(dict(load_strategy="TL-SRC-TGT", select_columns="event_id",
                                                 query_parameter="1=0", target_path=scratch("folded"), **extra))
        res = run_extraction(events, cfg, NOW)
        assert (res.src_record_count, res.target_record_count, res.is_extracted) == (0, 0, False)


def test_a_failed_load_leaves_the_previous_target(spark, scratch):
    path = scratch("safe")
    base = dict(load_strategy="TL-SRC-TGT", target_path=path, target_partition_column="k")
    good = spark.range(100).selectExpr("id", "cast(id % 3 as string) as k")
    run_extraction(good, ExtractionConfig.from_mapping(base), NOW)
    bad = good.selectExpr("case when id = 99 then raise_error('broken row') else id end as id", "k")
    with pytest.raises(Exception, match="broken row"):
        run_extraction(bad, ExtractionConfig.from_mapping(base), NOW)
    assert sorted(r.id for r in spark.read.parquet(path).collect()) == list(range(100))
    run_extraction(good.where("id < 10"), ExtractionConfig.from_mapping(base), NOW)
    assert spark.read.parquet(path).count() == 10
    parent = os.path.dirname(_local(path))
    assert not [n for n in os.listdir(parent) if n.startswith(f"_{os.path.basename(path)}.previous")]


def test_file_sizes_come_from_the_config_row(spark, scratch):
    cfg = ExtractionConfig.from_mapping(dict(load_strategy="TL-SRC-TGT", max_records_per_file="50", files_per_partition=2))
    assert (cfg.max_records_per_file, cfg.files_per_partition) == (50, 2)
    assert ExtractionConfig.from_mapping(dict(load_strategy="IO", max_records_per_file=" ")).max_records_per_file == 10000
    for bad in ("0", "-1", "many", "1.5"):
        with pytest.raises(ConfigError):
            ExtractionConfig.from_mapping(dict(load_strategy="IO", max_records_per_file=bad))


def test_columns_are_checked_before_anything_is_read(spark, scratch):
    events = spark.read.parquet(f"{SF}/events.parquet")
    for column in ("event_type", "nope"):
        cfg = ExtractionConfig.from_mapping(dict(load_strategy="IO-SNAP-MAX-CDC", cdc_column="ts", cdc_timestamp=NOW, cdc_ts_format=FMT,
                                                 source_partition_column=column, target_path=scratch("never")))
        with pytest.raises(ConfigError):
            run_extraction(events, cfg, NOW)
        assert not os.path.exists(_local(cfg.target_path))
