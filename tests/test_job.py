"""End to end: every strategy through lookup, audit, restart, extraction,
counts, watermark and logs (L1-L9)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from sluice.plans.job import ControlTables, empty_control_tables, read_control_tables, run_requests, \
    write_control_tables
from sluice.plans.extract import Source
from sluice.sources import control

SF = "/root/testdata/sf0.001"
NOW = dt.datetime(2024, 1, 20, 9, 30)
FMT = "YYYY-MM-DD HH24:MI:SS"
T = dt.datetime

# id, strategy, table, select, query_parameter, source partition, target partition, pks, cdc, lo, hi, agg col, fn, op
CONFIGS = [
    ("c1", "IO", "events", "event_id, ts", None, None, None, None, "ts", T(2024, 1, 5), None, None, None, None),
    ("c2", "IO-SNAP", "orders", "o_orderkey, o_orderdate", None, None, None, None, "o_orderdate", T(1998, 3, 15), None, None, None, None),
    ("c3", "IO-CDC", "events", "event_id, ts", None, None, None, None, "ts", T(2024, 1, 25), None, None, None, None),
    ("c4", "IO-SNAP-DLY", "events", "event_id, ts, event_type", None, None, "event_type", "event_id", "ts", T(2024, 1, 10), T(2024, 1, 10, 23, 59, 59), None, None, None),
    ("c5", "IO-SNAP-MAX-CDC", "events_d", "event_id, ts, event_date", None, "event_date", "event_date", None, "ts", T(2024, 1, 15), None, None, None, None),
    ("c6", "IO-CUSTOM-CDC", "events", "event_id, ts", None, None, None, "event_id", "ts", T(2024, 1, 18), None, None, None, None),
    ("c7", "TL-SRC-TGT", "lineitem", "l_orderkey, l_linenumber, l_returnflag", "l_quantity > 45", "l_returnflag", "l_returnflag", None, None, None, None, None, None, None),
    ("c8", "TL-CDC", "events", "event_id, ts", None, None, None, None, "ts", T(2024, 1, 28), None, None, None, None),
    ("c9", "TL-AGG", "lineitem", "l_orderkey, l_shipdate", "l_returnflag='N'", None, None, None, None, None, None, "l_shipdate", "max", "="),
    ("c10", "IO-CDC", "events", "no_such_column", None, None, None, None, "ts", T(2024, 1, 25), None, None, None, None),
    ("c11", "IO-CDC", "events", "event_id", None, None, None, None, "ts", T(2024, 1, 25), None, None, None, None),
]


@pytest.fixture(scope="module")
def setup(spark):
    rows = []
    for (cid, strat, table, sel, qp, spc, tpc, pks, cdc, lo, hi, agg, fn, op) in CONFIGS:
        rows.append((cid, "Y", "Y", None, "SRC", table, sel, qp, spc, tpc, pks, cdc, lo, hi,
                     FMT if cdc else None, None, strat, agg, fn, op, "bucket", cid))
    config = spark.createDataFrame(rows, control.CONFIG)
    tables = empty_control_tables(spark, config)
    # c11 already extracted earlier: its newest restart row is a later step.
    tables.restart = spark.createDataFrame(
        [("c11", "1", "Extract", "events", "job", "job", T(2024, 1, 1), "SRC", "x", "Y"),
         ("c11", "2", "Update", "events", "job", "job", T(2024, 1, 2), "SRC", "x", "Y")], control.RESTART)
    reqs = spark.createDataFrame(
        [(f"r-{c[0]}", "Y", "SRC", c[2], c[0], None, f"wf-{c[0]}", f"jr-{c[0]}") for c in CONFIGS]
        + [("r-missing", "Y", "SRC", "nope", None, None, "wf-x", "jr-x")],
        "request_id string, manual_flag string, schema_name string, table_name string, config_id string, "
        "cloudwatch_event_name string, workflow_run_id string, job_run_id string")
    return config, tables, reqs


def test_run_all_strategies(spark, setup, scratch):
    config, tables, reqs = setup
    root = scratch("targets")

    def source_for(cfg):
        if cfg.table_name == "events_d":
            return spark.read.parquet(f"{SF}/events.parquet").withColumn("event_date", F.to_date("ts"))
        df = spark.read.parquet(f"{SF}/{cfg.table_name}.parquet")
        return Source(df, df) if cfg.table_name == "lineitem" else df

    out = run_requests(spark, tables, reqs, source_for, "job", NOW, target_path_for=lambda c: f"{root}/{c.id}",
                       max_parallel=4)
    runs = {r.request_id: r for r in out.runs.collect()}
    assert runs["r-missing"].verdict == "MISSING" and runs["r-missing"].id is None
    assert runs["r-c11"].exit_flag == "Y" and runs["r-c11"].is_extracted is False
    assert "c10" in out.errors and runs["r-c10"].error
    for cid in ["c1", "c2", "c3", "c4", "c5", "c6", "c7", "c8", "c9"]:
        r = runs[f"r-{cid}"]
        assert r.is_extracted, cid
        assert spark.read.parquet(f"{root}/{cid}").count() == r.target_record_count, cid
    # watermarks: IO and TL-* without a watermark do not move.
    assert runs["r-c1"].next_cdc_ts is None and runs["r-c7"].next_cdc_ts is None and runs["r-c9"].next_cdc_ts is None
    assert runs["r-c2"].next_cdc_ts == T(1998, 3, 16)
    assert runs["r-c3"].next_cdc_ts == NOW and runs["r-c8"].next_cdc_ts == NOW
    assert (runs["r-c4"].next_cdc_ts, runs["r-c4"].next_to_ts) == (T(2024, 1, 11), T(2024, 1, 11, 23, 59, 59))
    assert (runs["r-c5"].next_cdc_ts, runs["r-c5"].next_to_ts) == (T(2024, 1, 20), T(2024, 1, 20, 23, 59, 59))
    assert runs["r-c6"].next_cdc_ts == T(2024, 1, 20) and runs["r-c6"].gate

    t: ControlTables = out.tables
    wm = {r.audit_id for r in t.watermark_log.collect()}
    assert wm == {"c2", "c3", "c4", "c5", "c6", "c8"}
    hdr = t.audit_header.collect()
    assert len(hdr) == 11 and all(h.latest_record_ind == 1 for h in hdr)
    counted = {h.audit_id: (h.src_record_count, h.target_record_count) for h in hdr}
    assert counted["c4"] == (runs["r-c4"].src_record_count, runs["r-c4"].target_record_count)
    restart_rows = {(r.audit_id, r.step_name) for r in t.restart.collect()}
    assert ("c10", "Extract") in restart_rows and ("c11", "Update") in restart_rows
    log = {r.table_name: r.delta_completion_date for r in t.extract_log.collect()}
    assert log == {"events_d": dt.date(2024, 1, 19), "events": dt.date(2024, 1, 19)}
    assert t.audit_spec.count() == 11 and t.audit_line.count() == 11

    # persisted control tables read back with their schemas; a second run retires the first.
    v1 = scratch("control")
    write_control_tables(t, v1)
    again = read_control_tables(spark, v1)
    reqs2 = reqs.where("request_id = 'r-c3'").withColumn("workflow_run_id", F.lit("wf-c3-2"))
    out2 = run_requests(spark, again, reqs2, source_for, "job", NOW + dt.timedelta(days=1),
                        target_path_for=lambda c: f"{root}/{c.id}")
    hdr2 = {(h.audit_id, h.workflow_run_id): h.latest_record_ind for h in out2.tables.audit_header.collect()}
    assert hdr2[("c3", "wf-c3")] == 1  # still RUNNING in the header, so it stays latest
    assert hdr2[("c3", "wf-c3-2")] == 1
    assert out2.tables.audit_spec.count() == 11


def test_command_line_run(spark, setup, scratch):
    from sluice.__main__ import main

    config, tables, _ = setup
    root, out = scratch("ctl"), scratch("ctl2")
    from sluice.plans.job import write_control_tables
    write_control_tables(tables, root)
    summary = main(["--control", root, "--out", out, "--source-root", SF, "--schema", "SRC", "--table", "events",
                    "--id", "c4", "--workflow-run-id", "wf9", "--job-run-id", "jr9", "--now", "2024-01-20T09:30:00",
                    "--target-root", scratch("cli-targets")], spark=spark)
    assert summary["verdict"] == "OK" and summary["is_extracted"]
    assert summary["next_cdc_ts"] == "2024-01-11 00:00:00"
    log = spark.read.parquet(f"{out}/watermark_log").collect()
    assert [r.audit_id for r in log] == ["c4"]


def test_command_line_many_requests(spark, setup, scratch):
    import json
    import os

    from sluice.__main__ import main
    from sluice.plans.job import write_control_tables

    config, tables, _ = setup
    root, out = scratch("ctlm"), scratch("ctlm2")
    write_control_tables(tables, root)
    req_dir = scratch("reqs")
    local = req_dir[len("file:"):] if req_dir.startswith("file:") else req_dir
    os.makedirs(local, exist_ok=True)
    with open(os.path.join(local, "requests.json"), "w") as f:
        for cid, table in (("c3", "events"), ("c8", "events"), ("c2", "orders")):
            f.write(json.dumps(dict(request_id=f"r-{cid}", manual_flag="Y", schema_name="SRC", table_name=table,
                                    config_id=cid, workflow_run_id=f"wf-{cid}", job_run_id=f"jr-{cid}")) + "\n")
    result = main(["--control", root, "--out", out, "--source-root", SF, "--requests",
                   os.path.join(local, "requests.json"), "--parallel", "3", "--now", "2024-01-20T09:30:00",
                   "--target-root", scratch("cli-many")], spark=spark)
    runs = {r["request_id"]: r for r in result["runs"]}
    assert set(runs) == {"r-c3", "r-c8", "r-c2"}
    assert all(r["verdict"] == "OK" and r["is_extracted"] for r in runs.values())
    assert sorted(r.audit_id for r in spark.read.parquet(f"{out}/watermark_log").collect()) == ["c2", "c3", "c8"]


def test_two_requests_for_one_config_extract_it_once(spark, setup, scratch):
    config, tables, reqs = setup
    one = reqs.where("request_id = 'r-c3'")
    two = one.unionByName(one.withColumns({"request_id": F.lit("again"), "workflow_run_id": F.lit("wf-again")}))
    root = scratch("twice")
    events = spark.read.parquet(f"{SF}/events.parquet")
    out = run_requests(spark, tables, two, lambda cfg: events, "job", NOW, target_path_for=lambda c: f"{root}/{c.id}")
    runs = {r.request_id: r for r in out.runs.collect()}
    rows = spark.read.parquet(f"{root}/c3").count()
    assert runs["r-c3"].target_record_count == runs["again"].target_record_count == rows > 0
    assert rows == events.where(F.col("ts") >= F.lit("2024-01-25").cast("timestamp_ntz")).count()
    assert out.tables.watermark_log.count() == 1
    stored = {h.workflow_run_id: h.target_record_count for h in out.tables.audit_header.collect()}
    assert stored == {"wf-c3": rows, "wf-again": rows}


def test_a_crash_leaves_running_rows_and_finished_outcomes(spark, setup, scratch):
    config, tables, reqs = setup
    root, control_root, journal = scratch("crash"), scratch("crash-control"), scratch("crash-journal")
    seen = []

    class Killed(BaseException):
        pass

    def source_for(cfg):
        seen.append(cfg.id)
        if len(seen) > 1:
            raise Killed
        return spark.read.parquet(f"{SF}/events.parquet")

    with pytest.raises(Killed):
        run_requests(spark, tables, reqs.where("request_id in ('r-c3', 'r-c8')"), source_for, "job", NOW,
                     target_path_for=lambda c: f"{root}/{c.id}", max_parallel=1,
                     persist=lambda t: write_control_tables(t, control_root), journal=journal)
    stored = read_control_tables(spark, control_root)
    assert {(r.audit_id, r.workflow_header_status) for r in stored.audit_header.collect()} == {("c3", "RUNNING"), ("c8", "RUNNING")}
    assert {r.job_status for r in stored.audit_line.collect()} == {"RUNNING"}
    done = spark.read.parquet(journal).collect()
    assert [(r.id, r.is_extracted) for r in done] == [(seen[0], True)]
    assert spark.read.parquet(f"{root}/{seen[0]}").count() == done[0].target_record_count
