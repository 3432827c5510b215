"""Control tables as logs of row versions: reads, changes, crashes, compaction."""

import datetime as dt
import glob
import os
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.plans.job import empty_control_tables
from sluice.plans.logged import import_tables, log_tables, run_logged
from sluice.sources import control, control_log
from sluice.sources.control_log import BUCKET, ROW, LogTable, append_changes, compact_log, read_log, remove_replaced

SCHEMA = T.StructType([T.StructField("k", T.LongType()), T.StructField("n", T.LongType()), T.StructField("v", T.StringType())])
SF = "/root/testdata/sf0.001"
NOW = dt.datetime(2024, 1, 20, 9, 30)
FMT = "YYYY-MM-DD HH24:MI:SS"


@pytest.fixture
def log(scratch):
    return LogTable(scratch("log"), SCHEMA, ("k",), ("k", "n"), buckets=8)


def _frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def _state(spark, log, keys=None):
    return sorted((tuple(r) for r in read_log(spark, log, keys).drop(ROW).collect()), key=repr)


def _files(log):
    local = log.path[len("file:"):] if log.path.startswith("file:") else log.path
    return {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{local}/**/*.parquet", recursive=True)}


def test_random_runs_equal_a_plain_table(spark, log):
    rnd = random.Random(3)
    model = {}
    for step in range(10):
        keys = rnd.sample(range(30), 6) + ([None] if step % 3 == 0 else [])
        mine = {r: v for r, v in model.items() if r[0] in keys}
        after = {r: (v if rnd.random() < 0.5 else f"{v}+{step}") for r, v in mine.items() if rnd.random() < 0.8}
        after |= {(k, step): f"new{step}" for k in keys if rnd.random() < 0.7}
        before = read_log(spark, log, _frame(spark, [(k, 0, "") for k in keys]))
        if None in keys:  # a null key is read by no key; its rows come with the whole table
            before = before.unionByName(read_log(spark, log).where("k is null"))
        ids = {(r.k, r.n): r[ROW] for r in before.collect()}
        assert set(ids) == set(mine)
        rows = spark.createDataFrame([(k, n, v, ids.get((k, n))) for (k, n), v in after.items()], "k long, n long, v string, __row string")
        append_changes(spark, log, before, rows)
        model = {r: v for r, v in model.items() if r[0] not in keys} | after
        if step % 4 == 3:
            assert compact_log(spark, log, at_least=2)
            if step == 7:
                assert remove_replaced(spark, log) > 0
        assert _state(spark, log) == sorted(((k, n, v) for (k, n), v in model.items()), key=repr)


def test_a_run_writes_its_own_rows_and_leaves_other_buckets_alone(spark, log):
    append_changes(spark, log, None, _frame(spark, [(i, 0, "old") for i in range(5000)]))
    files = _files(log)
    keys = _frame(spark, [(7, 0, ""), (8, 0, "")])
    before = read_log(spark, log, keys)
    append_changes(spark, log, before, before.withColumn("v", F.when(F.col("k") == 7, "new").otherwise(F.col("v"))))
    now = _files(log)
    assert all(now[f] == t for f, t in files.items())
    (added,) = set(now) - set(files)
    assert spark.read.parquet(added).count() == 1
    assert dict((k, v) for k, _, v in _state(spark, log, keys)) == {7: "new", 8: "old"}
    for i in range(3):
        append_changes(spark, log, None, _frame(spark, [(7, i + 1, "more")]))
    files = _files(log)
    (bucket,) = compact_log(spark, log, at_least=4)
    now = _files(log)
    assert all(now[f] == t for f, t in files.items()) and all(f"{BUCKET}={bucket}/" in f for f in set(now) - set(files))
    assert len(_state(spark, log)) == 5003 and compact_log(spark, log, at_least=4) == []


def test_keyed_reads_prune_to_the_buckets_of_the_keys(spark, log, capsys):
    append_changes(spark, log, None, _frame(spark, [(i, 0, "x") for i in range(200)]))
    for i in range(4):
        append_changes(spark, log, None, _frame(spark, [(3, i + 1, "y")]))
    compact_log(spark, log, at_least=4)
    one = read_log(spark, log, _frame(spark, [(3, 0, "")]))
    one.explain("formatted")
    plan = capsys.readouterr().out
    assert "PartitionFilters" in plan and BUCKET in plan.split("PartitionFilters")[1].split("\n")[0]
    read = {f for f in one.inputFiles()}
    assert len(read) <= 1 and one.count() == 5


@pytest.mark.parametrize("step", ["write", "mark", "base"])
def test_an_unmarked_segment_does_not_count(spark, log, monkeypatch, step):
    for i in range(3):
        append_changes(spark, log, None, _frame(spark, [(k, i, "x") for k in range(8)]))
    want = _state(spark, log)

    def dies(*args):
        raise RuntimeError("died")

    with monkeypatch.context() as m:
        real = control_log._mark
        marks = []

        def second_mark(spark, table, name):
            marks.append(name)
            if len(marks) > 1:
                raise RuntimeError("died")
            real(spark, table, name)

        m.setattr(control_log, "_write" if step == "write" else "_mark", second_mark if step == "base" else dies)
        with pytest.raises(RuntimeError):
            if step == "base":
                compact_log(spark, log, at_least=2)
            else:
                append_changes(spark, log, None, _frame(spark, [(1, 99, "lost")]))
    assert _state(spark, log) == want
    append_changes(spark, log, None, _frame(spark, [(1, 100, "kept")]))
    assert _state(spark, log) == sorted([*want, (1, 100, "kept")], key=repr)
    compact_log(spark, log, at_least=2)
    assert _state(spark, log) == sorted([*want, (1, 100, "kept")], key=repr)


def test_rows_told_apart_by_nothing_are_kept_apart(spark, log):
    append_changes(spark, log, None, _frame(spark, [(1, 1, "a"), (1, 1, "b"), (1, 1, "b"), (None, None, None)]))
    assert _state(spark, log) == sorted([(1, 1, "a"), (1, 1, "b"), (1, 1, "b"), (None, None, None)], key=repr)


def test_an_empty_log_and_an_empty_run(spark, log):
    assert _state(spark, log) == [] and compact_log(spark, log) == []
    append_changes(spark, log, read_log(spark, log), _frame(spark, []))
    assert _state(spark, log) == []


def _control(spark):
    def row(cid, strategy, table, **over):
        base = dict.fromkeys(f.name for f in control.CONFIG.fields)
        base |= dict(id=cid, active_flag="Y", manual_flag="Y", schema_name="SRC", table_name=table, select_columns="*",
                     cdc_column="ts", cdc_ts_format=FMT, load_strategy=strategy, curate_bucket="b", curate_prefix=cid)
        return tuple((base | over).values())

    return spark.createDataFrame(
        [
            row("c1", "IO-SNAP-DLY", "events", cdc_timestamp=dt.datetime(2024, 1, 10), to_cdc_timestamp=dt.datetime(2024, 1, 10, 23, 59, 59)),
            row("c2", "IO-CUSTOM-CDC", "events", select_columns="event_id, ts", cdc_timestamp=dt.datetime(2024, 1, 18)),
            row("c3", "IO-CDC", "events", select_columns="nope", cdc_timestamp=dt.datetime(2024, 1, 18)),
            row("c4", "IO-CDC", "events", cdc_timestamp=dt.datetime(2024, 1, 18)),
        ],
        control.CONFIG,
    )


def _requests(spark, *cids, wf="wf"):
    return spark.createDataFrame(
        [(f"r-{c}", "Y", "SRC", "events", c, None, f"{wf}-{c}", f"jr-{wf}-{c}") for c in cids],
        "request_id string, manual_flag string, schema_name string, table_name string, config_id string, "
        "cloudwatch_event_name string, workflow_run_id string, job_run_id string",
    )


@pytest.fixture
def setup(spark, scratch):
    root, targets = scratch("ctl-log"), scratch("targets")
    config = _control(spark)
    history = empty_control_tables(spark, config)
    history.audit_header = spark.createDataFrame(
        [("c1", dt.datetime(2024, 1, 1), 1, "old", "COMPLETED", dt.datetime(2024, 1, 1), 5, 5)]
        + [(f"x{i}", dt.datetime(2024, 1, 1), 1, "old", "COMPLETED", dt.datetime(2024, 1, 1), 5, 5) for i in range(500)],
        control.AUDIT_HEADER,
    )
    import_tables(spark, log_tables(root), history)

    def run(*cids, now=NOW, wf="wf", **options):
        return run_logged(
            spark, root, config, _requests(spark, *cids, wf=wf), lambda cfg: spark.read.parquet(f"{SF}/events.parquet"), "job", now,
            target_path_for=lambda c: f"{targets}/{c.id}", **options,
        )

    read = lambda name: read_log(spark, log_tables(root)[name])
    return run, read, targets, root


def _size(root):
    local = root[len("file:"):] if root.startswith("file:") else root
    import pyarrow.parquet as pq

    return sum(pq.ParquetFile(f).metadata.num_rows for f in glob.glob(f"{local}/**/*.parquet", recursive=True) if "/journal/" not in f)


def test_runs_append_to_the_logs(spark, setup):
    run, read, targets, root = setup
    start = _size(root)
    out = run("c1", "c2", "c3")
    assert set(out.results) == {"c1", "c2"} and "c3" in out.errors
    # 500 rows of other configs: a run's versions follow its requests
    assert _size(root) - start < 40
    header = {(h.audit_id, h.workflow_run_id): h for h in read("audit_header").collect()}
    assert len(header) == 504
    assert header["c1", "old"].latest_record_ind == 0 and header["x7", "old"].latest_record_ind == 1
    assert header["c1", "wf-c1"].src_record_count == out.results["c1"].src_record_count > 0
    assert {r.audit_id for r in read("watermark_log").collect()} == {"c1", "c2"}
    assert {(r.audit_id, r.step_name) for r in read("restart").collect()} == {("c3", "Extract")}
    assert {(r.table_name, r.delta_completion_date) for r in read("extract_log").collect()} == {("events", dt.date(2024, 1, 19))}
    assert read("audit_spec").count() == read("audit_line").count() == 3
    run("c1", "c3", now=NOW + dt.timedelta(days=1), wf="next")
    assert read("audit_line").count() == 5 and read("audit_spec").count() == 3
    assert read("restart").count() == 1 and read("watermark_log").count() == 3


@pytest.mark.parametrize("at", ["after the write", "after the journal"])
def test_a_run_that_dies_is_taken_up_without_a_duplicate(spark, setup, monkeypatch, at):
    from sluice.plans import job

    run, read, targets, root = setup
    calls = []
    real, real_row = job.run_extraction, job._outcome_row

    def dying(source, cfg, now, **k):
        calls.append(cfg.id)
        return real(source, cfg, now, **k)

    def dying_row(spark, cid, *args):
        if at == "after the write" and cid == "c4":
            raise KeyboardInterrupt
        return real_row(spark, cid, *args)

    with monkeypatch.context() as m:
        m.setattr(job, "run_extraction", dying)
        m.setattr(job, "_outcome_row", dying_row)
        if at == "after the journal":
            m.setattr(job, "_results_frame", lambda *a: (_ for _ in ()).throw(KeyboardInterrupt()))
        with pytest.raises(KeyboardInterrupt):
            run("c1", "c4", max_parallel=1)
    assert {h.workflow_header_status for h in read("audit_header").where("audit_id = 'c4'").collect()} == {"RUNNING"}
    later = NOW + dt.timedelta(hours=1)
    with monkeypatch.context() as m:
        calls.clear()
        m.setattr(job, "run_extraction", lambda source, cfg, now, **k: (calls.append(cfg.id), real(source, cfg, now, **k))[1])
        out = run("c1", "c4", now=later)
    assert calls == ([] if at == "after the journal" else ["c4"])
    assert out.results["c1"].resumed and not out.errors
    events = spark.read.parquet(f"{SF}/events.parquet")
    assert spark.read.parquet(f"{targets}/c4").count() == events.where("ts >= timestamp_ntz'2024-01-18 00:00:00'").count()
    assert spark.read.parquet(f"{targets}/c1").count() == out.results["c1"].target_record_count > 0
    # one header and one line row for the run, with its counts
    (h,) = read("audit_header").where("audit_id = 'c4'").collect()
    assert h.src_record_count == out.results["c4"].src_record_count and read("audit_line").count() == 2
    # W3 starts from the time of the read that counted
    marks = {r.audit_id: r.cdc_timestamp for r in read("watermark_log").collect()}
    assert marks["c4"] == (NOW if at == "after the journal" else later)


def test_shared_scans_give_the_same_run(spark, setup, monkeypatch):
    from sluice.plans import job

    run, read, targets, root = setup
    used = []
    real = job.run_extraction
    monkeypatch.setattr(job, "run_extraction", lambda s, c, n, **k: (used.append((c.id, k["prefiltered"])), real(s, c, n, **k))[1])
    # a config that cannot be written does not stop the others
    out = run("c1", "c2", "c3", "c4", share_scans=True)
    assert sorted(used) == [("c1", True), ("c2", True), ("c3", True), ("c4", True)] and set(out.errors) == {"c3"}
    used.clear()
    alone = run("c1", "c2", "c4", wf="alone")
    assert sorted(used) == [("c1", False), ("c2", False), ("c4", False)]
    for cid in ("c1", "c2", "c4"):
        assert out.results[cid].src_record_count == alone.results[cid].src_record_count > 0


def test_command_line_over_a_log(spark, setup, scratch):
    from sluice.__main__ import main

    run, read, targets, root = setup
    _control(spark).write.parquet(f"{root}/config")
    args = ["--log", root, "--source-root", SF, "--schema", "SRC", "--table", "events", "--id", "c2", "--workflow-run-id", "cli",
            "--job-run-id", "j", "--now", "2024-01-20T09:30:00", "--target-root", targets]
    first = main(args, spark=spark)
    again = main(args, spark=spark)
    assert first["verdict"] == again["verdict"] == "OK" and first["target_record_count"] == again["target_record_count"]
    assert spark.read.parquet(f"{targets}/c2").count() == first["target_record_count"]
    with pytest.raises(SystemExit):
        main(["--source-root", SF], spark=spark)
