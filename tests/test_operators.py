"""Operators on inline edge fixtures."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from sluice.operators import audit, config as cfgops, counts, partitions, restart, watermark
from sluice.operators.dedup import SOURCE_ROWS, dedup_primary_keys
from sluice.plans.extract import ExtractionConfig
from sluice.plans.fixtures import derived_configs

NOW = dt.datetime(2024, 1, 20, 9, 30)


def test_dedup_is_deterministic_and_counts_source(spark):
    rows = [(1, 1, "b", 2.0), (1, 1, "a", 9.0), (1, 1, "a", 3.0), (2, 1, "z", 1.0), (None, 1, "n", 1.0)]
    df = spark.createDataFrame(rows, "k1 long, k2 long, s string, v double").repartition(3)
    out = dedup_primary_keys(df, ["k1", "k2"], ["s", "v"], count_source=True)
    got = {(r.k1, r.k2): (r.s, r.v, r[SOURCE_ROWS]) for r in out.collect()}
    assert got == {(1, 1): ("a", 3.0, 3), (2, 1): ("z", 1.0, 1), (None, 1): ("n", 1.0, 1)}
    assert out.columns == ["k1", "k2", "s", "v", SOURCE_ROWS]


def test_dedup_falls_back_for_unorderable_columns(spark):
    df = spark.createDataFrame([(1, {"a": 1}), (1, {"b": 2}), (2, {"c": 3})], "k long, m map<string,int>")
    assert dedup_primary_keys(df, ["k"]).count() == 2
    out = dedup_primary_keys(df, ["k"], count_source=True)
    assert sorted((r.k, r[SOURCE_ROWS]) for r in out.collect()) == [(1, 2), (2, 1)]


def test_null_partition_key_keeps_its_rows(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (3, "b"), (4, None)], "id long, p string")
    keys = partitions.discover_partitions(df, ["p"])
    assert keys.count() == 3
    assert partitions.restrict_to_partitions(df, keys, ["p"]).count() == 4
    # an equality join would drop the null slice
    assert df.join(keys.withColumnRenamed("p", "q"), F.col("p") == F.col("q"), "left_semi").count() == 2


def test_quote_and_none_text_in_partition_values(spark):
    df = spark.createDataFrame([(1, "O'Brien"), (2, "None"), (3, "x")], "id long, p string")
    keys = partitions.discover_partitions(df, ["p"]).where(F.col("p") != "x")
    assert sorted(r.id for r in partitions.restrict_to_partitions(df, keys, ["p"]).collect()) == [1, 2]


def test_multi_column_keys_are_cast_to_string(spark):
    df = spark.createDataFrame([(1, 10, dt.date(2024, 1, 1)), (2, 10, dt.date(2024, 1, 2))], "id long, a int, d date")
    keys = partitions.discover_partitions(df, ["a", "d"])
    assert sorted(tuple(r) for r in keys.collect()) == [("10", "2024-01-01"), ("10", "2024-01-02")]
    assert dict(keys.dtypes) == {"a": "string", "d": "string"}


@pytest.mark.parametrize("fn,op,expected", [("max", "=", [3]), ("min", "<=", [1]), ("avg", ">", [3]),
                                            ("count", "<", [1, 2])])
def test_aggregate_filter(spark, fn, op, expected):
    df = spark.createDataFrame([(1, 1.0), (2, 2.0), (3, 3.0), (4, 9.0)], "id long, v double")
    cond = partitions.aggregate_filter(df, "v", fn, op, F.col("id") <= 3)
    assert sorted(r.id for r in df.where((F.col("id") <= 3) & cond).collect()) == expected


def test_aggregate_filter_rejects_unknown(spark):
    df = spark.createDataFrame([(1, 1.0)], "id long, v double")
    with pytest.raises(ValueError):
        partitions.aggregate_filter(df, "v", "median", "=")
    with pytest.raises(ValueError):
        partitions.aggregate_filter(df, "v", "max", "~")


def test_normalise_agrees_with_single_row_rules(spark):
    customer = spark.read.parquet("/root/testdata/sf0.001/customer.parquet")
    cfg = derived_configs(customer).withColumn("source_partition_column", F.lit(" a , b ,")) \
        .withColumn("target_partition_column", F.lit(""))
    norm = {r.id: r for r in cfgops.normalise_configs(cfg).collect()}
    for raw in cfg.limit(40).collect():
        one = ExtractionConfig.from_mapping(raw.asDict())
        n = norm[raw.id]
        assert one.cdc_timestamp == n.cdc_timestamp
        assert one.cdc_column == n.cdc_column == "DT||' '||TM"
        assert (one.query_parameter or None) == n.query_parameter
        assert list(one.primary_keys) == n.primary_keys
        assert list(one.source_partition_column) == n.source_partition_column == ["a", "b"]
        assert n.target_partition_column is None and one.target_partition_column == ()


def test_lookup_manual_with_id_and_scheduled_wildcard(spark):
    customer = spark.read.parquet("/root/testdata/sf0.001/customer.parquet")
    cfg = derived_configs(customer)
    one = cfg.where((F.col("manual_flag") == "Y") & (F.col("active_flag") == "Y")).first()
    reqs = spark.createDataFrame(
        [("m", "Y", one.schema_name, one.table_name, one.id, None), ("w", "N", None, None, None, None),
         ("none", "Y", "NOPE", "NOPE", None, None)],
        "request_id string, manual_flag string, schema_name string, table_name string, config_id long, "
        "cloudwatch_event_name string")
    matches = cfgops.lookup_configs(cfg, reqs)
    by_req = {r.request_id: r.n_configs for r in cfgops.check_requests(reqs, matches, cfg).collect()}
    scheduled = cfg.where((F.col("manual_flag") == "N") & (F.col("active_flag") == "Y")).count()
    assert by_req == {"m": 1, "w": scheduled, "none": 0}
    verdicts = {r.request_id: r.verdict for r in cfgops.check_requests(reqs, matches, cfg).collect()}
    assert verdicts["m"] == "OK" and verdicts["none"] == "MISSING"


def test_counted_lookups_have_a_row_per_request_not_per_match(spark):
    cfg = spark.range(400).select(
        "id", F.lit("Y").alias("active_flag"), F.when(F.col("id") % 2 == 0, "Y").otherwise("N").alias("manual_flag"),
        F.when(F.col("id") % 10 != 0, "s").alias("schema_name"), F.lit("t").alias("table_name"),
        F.concat(F.lit("e"), F.when(F.col("id") == 7, 7).otherwise(0)).alias("cloudwatch_event_name"))
    cfg = cfg.union(cfg.where("id in (2, 4)")).union(cfg.where("id = 4"))  # ids come twice, thrice
    text, number = F.lit(None).cast("string"), F.lit(None).cast("long")
    shape = lambda name, flag, s, t, i, e: cfg.select(
        F.concat(F.lit(name), F.col("id") % 390).alias("request_id"), F.lit(flag).alias("manual_flag"), s.alias("schema_name"),
        t.alias("table_name"), i.alias("config_id"), e.alias("cloudwatch_event_name"))
    s, t, i, e = F.col("schema_name"), F.col("table_name"), F.col("id"), F.col("cloudwatch_event_name")
    reqs = shape("n", "Y", s, t, number, text).union(shape("i", "Y", s, t, i, text)).union(shape("e", "N", text, text, number, e))
    reqs = reqs.union(shape("w", "N", text, text, number, text)).union(shape("x", None, s, t, i, e)).union(
        shape("m", "Y", s, t, number, text).withColumn("request_id", text))
    rows, counted = cfgops.lookup_configs(cfg, reqs), cfgops.lookup_configs(cfg, reqs, counted=True)
    n_reqs, n_rows = reqs.count(), rows.count()
    assert counted.count() <= n_reqs and n_rows > 50 * n_reqs
    assert counted.agg(F.sum("__configs")).first()[0] == n_rows
    want = cfgops.check_requests(reqs, rows, cfg)
    got = cfgops.check_requests(reqs, counted, cfg)
    assert got.schema == want.schema and got.exceptAll(want).count() == want.exceptAll(got).count() == 0
    # a request of one config has it whole
    ok = want.where("verdict = 'OK'").select("request_id")
    lone, all_of = counted.join(ok, "request_id").drop("__configs"), rows.join(ok, "request_id")
    assert lone.count() > 100 and lone.exceptAll(all_of).count() == all_of.exceptAll(lone).count() == 0
    assert counted.where("__configs > 1 and id is not null").count() == 0


def test_retire_header_leaves_null_status_and_running(spark):
    hdr = spark.createDataFrame(
        [("a", 1, "r1", "COMPLETED"), ("a", 1, "r2", None), ("a", 1, "r3", "RUNNING"), ("a", 1, "cur", "RUNNING"),
         ("b", 1, "r9", "COMPLETED")],
        "audit_id string, latest_record_ind int, workflow_run_id string, workflow_header_status string")
    cur = spark.createDataFrame([("a", "cur")], "audit_id string, workflow_run_id string")
    got = {r.workflow_run_id: r.latest_record_ind for r in audit.retire_header(hdr, cur).collect()}
    assert got == {"r1": 0, "r2": 1, "r3": 1, "cur": 1, "r9": 1}


def test_header_counts_only_on_latest_row(spark):
    hdr = spark.createDataFrame(
        [("a", "r1", 1, 0, 0), ("a", "r1", 0, 5, 5), ("a", "r2", 1, 7, 7)],
        "audit_id string, workflow_run_id string, latest_record_ind int, src_record_count long, "
        "target_record_count long")
    c = spark.createDataFrame([("a", "r1", 10, 9)], "audit_id string, workflow_run_id string, "
                              "src_record_count long, target_record_count long")
    out = sorted(tuple(r) for r in audit.set_header_counts(hdr, c).collect())
    assert out == [("a", "r1", 0, 5, 5), ("a", "r1", 1, 10, 9), ("a", "r2", 1, 7, 7)]
    gate = counts.reconcile_counts(audit.header_counts(audit.set_header_counts(hdr, c),
                                                       c.select("audit_id", "workflow_run_id")))
    assert [r.counts_match for r in gate.collect()] == [False]


def test_reconcile_gate_values(spark):
    df = spark.createDataFrame([(5, 5), (0, 0), (5, 4), (None, 5)], "src_record_count long, target_record_count long")
    assert [r.counts_match for r in counts.reconcile_counts(df).collect()] == [True, False, False, False]


def test_audit_spec_upsert_is_idempotent(spark):
    runs = spark.createDataFrame([(1, "S", "t1"), (2, "S", "t2")], "audit_id long, schema_name string, table_name string")
    spec0 = spark.createDataFrame([], "audit_id long, audit_line_job_id string, job_name string, description string, "
                                  "schema_name string, table_name string, insert_timestamp timestamp_ntz")
    spec1 = audit.upsert_audit_spec(spec0, runs, "Job", NOW)
    spec2 = audit.upsert_audit_spec(spec1, runs, "Job", NOW + dt.timedelta(days=1))
    rows = spec2.collect()
    assert len(rows) == 2 and {r.insert_timestamp for r in rows} == {NOW}
    import hashlib
    assert {r.audit_line_job_id for r in rows} == {hashlib.md5(b"JOBST1").hexdigest(), hashlib.md5(b"JOBST2").hexdigest()}


def test_restart_newest_row_decides(spark):
    cfg = spark.createDataFrame([("a",), ("b",), ("c",)], "id string")
    rows = spark.createDataFrame(
        [("a", "Extract", dt.datetime(2024, 1, 1)), ("a", "Update", dt.datetime(2024, 1, 2)),
         ("b", "Update", dt.datetime(2024, 1, 1)), ("b", "Extract", dt.datetime(2024, 1, 3))],
        "audit_id string, step_name string, insert_timestamp timestamp_ntz")
    got = {r.id: r.exit_flag for r in restart.restart_gate(cfg, rows, ["id"], ["audit_id"]).collect()}
    assert got == {"a": "Y", "b": "N", "c": "N"}
    cleared = restart.clear_restart(rows, spark.createDataFrame([("a",)], "audit_id string"), ["audit_id"])
    assert {r.audit_id for r in cleared.collect()} == {"b"}
    rec = restart.record_restart(cleared, spark.createDataFrame([("z",)], "audit_id string"), "job", NOW)
    z = rec.where("audit_id = 'z'").first()
    assert (z.step_id, z.step_name, z.description) == ("1", "Extract", "Failed at extraction")


def test_extract_log_upsert_actions(spark):
    log = spark.createDataFrame([("s", "t1", dt.date(2024, 1, 1), "COMPLETED", NOW), ("s", "t2", dt.date(2024, 1, 1),
                                 "COMPLETED", NOW)],
                                "schema_name string, table_name string, delta_completion_date date, status string, "
                                "last_update_timestamp timestamp_ntz")
    upd = spark.createDataFrame([("s", "t2", dt.date(2024, 1, 5)), ("s", "t3", dt.date(2024, 1, 6))],
                                "schema_name string, table_name string, delta_completion_date date")
    later = NOW + dt.timedelta(hours=1)
    got = {r.table_name: (r.delta_completion_date, r.status, r.last_update_timestamp, r.action)
           for r in audit.upsert_extract_log(log, upd, ["schema_name", "table_name"], later).collect()}
    assert got == {"t1": (dt.date(2024, 1, 1), "COMPLETED", NOW, "KEEP"),
                   "t2": (dt.date(2024, 1, 5), "COMPLETED", later, "UPDATE"),
                   "t3": (dt.date(2024, 1, 6), "COMPLETED", later, "INSERT")}


def test_watermark_rules_and_log(spark):
    T = dt.datetime
    runs = spark.createDataFrame(
        [("1", "IO-SNAP", T(2024, 1, 5, 6), None, None, True), ("2", "IO-SNAP-DLY", T(2024, 1, 5), T(2024, 1, 5, 23, 59, 59), None, True),
         ("3", "IO-CDC", T(2024, 1, 5), None, None, True), ("4", "IO-SNAP-MAX-CDC", T(2024, 1, 5), None, dt.date(2024, 1, 9), True),
         ("5", "IO-SNAP-MAX-CDC", T(2024, 1, 5), None, dt.date(2024, 1, 9), False), ("6", "IO-CUSTOM-CDC", T(2024, 1, 5), None, None, True),
         ("7", "IO", None, None, None, True), ("8", "TL-AGG", None, None, None, True)],
        "id string, load_strategy string, cdc_timestamp timestamp_ntz, to_cdc_timestamp timestamp_ntz, max_value date, gate boolean")
    got = {r.id: (r.next_cdc_ts, r.next_to_ts) for r in watermark.advance_watermark(runs, NOW).collect()}
    assert got["1"] == (T(2024, 1, 6, 6), None)
    assert got["2"] == (T(2024, 1, 6), T(2024, 1, 6, 23, 59, 59))
    assert got["3"] == (NOW, None)
    assert got["4"] == (T(2024, 1, 10), T(2024, 1, 10, 23, 59, 59))
    assert got["5"] == (None, None)
    assert got["6"] == (T(2024, 1, 20), T(2024, 1, 20, 23, 59, 59))
    assert got["7"] == got["8"] == (None, None)
    log = watermark.watermark_log_rows(watermark.advance_watermark(runs, NOW), NOW)
    assert log.count() == 5 and log.where("to_cdc_timestamp is null").count() == 2
    latest = {r.audit_id: r.cdc_timestamp for r in watermark.latest_watermarks(log).collect()}
    assert latest["4"] == T(2024, 1, 10)


def test_extracted_flags_counts_zero(spark):
    cfg = spark.createDataFrame([(1,), (2,)], "id long")
    rows = spark.createDataFrame([(1,), (1,)], "k long")
    got = {r.id: (r.n_rows, r.is_extracted) for r in counts.extracted_flags(cfg, rows, "id", "k").collect()}
    assert got == {1: (2, True), 2: (0, False)}


def test_two_current_runs_of_one_config_do_not_multiply_rows(spark):
    hdr = spark.createDataFrame(
        [("a", 1, "old", "COMPLETED"), ("a", 1, "x", "STOPPED"), ("a", 1, "y", "RUNNING"), ("b", 1, "z", "COMPLETED")],
        "audit_id string, latest_record_ind int, workflow_run_id string, workflow_header_status string")
    cur = spark.createDataFrame([("a", "x"), ("a", "y")], "audit_id string, workflow_run_id string")
    got = {r.workflow_run_id: r.latest_record_ind for r in audit.retire_header(hdr, cur).collect()}
    assert audit.retire_header(hdr, cur).count() == 4
    # x is retired by run y's update; y is running; old by both
    assert got == {"old": 0, "x": 0, "y": 1, "z": 1}

    runs = spark.createDataFrame([(1, "S", "t"), (1, "S", "t")], "audit_id long, schema_name string, table_name string")
    spec0 = spark.createDataFrame([], "audit_id long, audit_line_job_id string, job_name string, description string, "
                                  "schema_name string, table_name string, insert_timestamp timestamp_ntz")
    assert audit.upsert_audit_spec(spec0, runs, "job", NOW).count() == 1

    log = spark.createDataFrame([("s", "t", dt.date(2024, 1, 1), "COMPLETED", NOW)],
                                "schema_name string, table_name string, delta_completion_date date, status string, "
                                "last_update_timestamp timestamp_ntz")
    upd = spark.createDataFrame([("s", "t", dt.date(2024, 1, 3)), ("s", "t", dt.date(2024, 1, 5))],
                                "schema_name string, table_name string, delta_completion_date date")
    out = audit.upsert_extract_log(log, upd, ["schema_name", "table_name"], NOW).collect()
    assert len(out) == 1 and out[0].delta_completion_date == dt.date(2024, 1, 5) and out[0].action == "UPDATE"


def test_target_path_rules_agree(spark):
    from sluice.operators.config import target_path_text

    cases = [("bucket", "raw/t1"), ("s3a://b", "/p/"), ("/data/out", "t"), ("file:/tmp/x/", "y"), (None, "p"), ("b", "")]
    df = spark.createDataFrame(cases, "curate_bucket string, curate_prefix string")
    got = [r.target_path for r in cfgops.normalise_configs(df).collect()]
    assert got == [target_path_text(b, p) for b, p in cases]
    assert got[:4] == ["s3://bucket/raw/t1", "s3a://b/p", "/data/out/t", "file:/tmp/x/y"]
    assert got[4] is None and got[5] is None
    assert ExtractionConfig.from_mapping(dict(load_strategy="IO", curate_bucket="bucket",
                                              curate_prefix="raw/t1")).target_path == "s3://bucket/raw/t1"


def test_tl_agg_column_already_a_partition_column():
    assert partitions.partition_key_columns("a, d", "d") == ["a", "d"]
    assert partitions.partition_key_columns("a", " d ") == ["a", "d"]
    assert partitions.partition_key_columns(None, None) == []


def test_materialized_aggregate_filter_matches_lazy(spark):
    li = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    static = F.col("l_returnflag") == "N"
    lazy = partitions.aggregate_filter(li, "l_shipdate", "max", "=", static)
    eager = partitions.aggregate_filter(li, "l_shipdate", "max", "=", static, materialize=True)
    a = li.where(static & lazy).select("l_orderkey", "l_linenumber")
    b = li.where(static & eager).select("l_orderkey", "l_linenumber")
    assert a.count() == b.count() > 0 and a.exceptAll(b).count() == 0


def test_header_counts_one_row_per_run(spark):
    hdr = spark.createDataFrame(
        [("a", "r1", 1, 5, 5, dt.datetime(2024, 1, 1)), ("a", "r1", 1, 7, 6, dt.datetime(2024, 1, 2))],
        "audit_id string, workflow_run_id string, latest_record_ind int, src_record_count long, "
        "target_record_count long, insert_timestamp timestamp_ntz")
    runs = spark.createDataFrame([("a", "r1")], "audit_id string, workflow_run_id string")
    rows = audit.header_counts(hdr, runs).collect()
    assert [(r.src_record_count, r.target_record_count) for r in rows] == [(7, 6)]


def test_set_header_counts_with_duplicate_count_rows(spark):
    hdr = spark.createDataFrame([("a", "r1", 1, 0, 0)], "audit_id string, workflow_run_id string, "
                                "latest_record_ind int, src_record_count long, target_record_count long")
    c = spark.createDataFrame([("a", "r1", 4, 4), ("a", "r1", 4, 4)], "audit_id string, workflow_run_id string, "
                              "src_record_count long, target_record_count long")
    assert [tuple(r) for r in audit.set_header_counts(hdr, c).collect()] == [("a", "r1", 1, 4, 4)]


def test_gate_reasons(spark):
    from sluice.operators import counts

    rows = [(1, 1, None), (0, 0, "no source rows"), (5, 0, "no target rows"), (5, 3, "counts differ by 2"), (None, 1, "not counted")]
    df = spark.createDataFrame(rows, "s long, t long, want string")
    got = df.select(counts.gate_reason(F.col("s"), F.col("t")).alias("r"), counts.reconcile_gate(F.col("s"), F.col("t")).alias("g"), "want").collect()
    assert all(r.r == r.want and r.g == (r.want is None) for r in got)
