"""Every registered query against its DuckDB oracle at sf0.01 (the driver's gate)."""

import pytest

import __spark_entry__ as entry_mod
from sluice.operators import audit, config, counts, partitions, restart
from sluice.plans.catalog import QUERIES
from compare import compare, duck

SF = "/root/testdata/sf0.01"
#: The reference's own operators; the training-data ones are tested in tests/llm.
NAMES = sorted(QUERIES)


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_oracle():
    assert set(NAMES) <= set(entry_mod.queries()) and set(NAMES) <= set(entry_mod.oracle_sql())
    assert len(NAMES) == 58


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    df = entry_mod.queries()[name](spark, SF)
    problems, _, _ = compare(df, con, entry_mod.oracle_sql()[name])
    assert not problems, problems


def test_entry_smoke(spark):
    df = entry_mod.entry(spark)
    rows = df.collect()
    assert len(rows) == 1 and rows[0].counts_match


TIME_SENSITIVE = ["delta_closed_window", "delta_multi_column", "delta_plus_composite", "overlap_shift",
                  "partition_discovery_date", "advance_watermark", "config_normalise", "sink_append_extract_date"]


@pytest.mark.parametrize("name", TIME_SENSITIVE)
def test_results_do_not_depend_on_session_zone_or_ansi(spark, con, name):
    old_tz = spark.conf.get("spark.sql.session.timeZone")
    old_ansi = spark.conf.get("spark.sql.ansi.enabled")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
        spark.conf.set("spark.sql.ansi.enabled", "false")
        df = entry_mod.queries()[name](spark, SF)
        problems, _, _ = compare(df, con, entry_mod.oracle_sql()[name])
    finally:
        spark.conf.set("spark.sql.session.timeZone", old_tz)
        spark.conf.set("spark.sql.ansi.enabled", old_ansi)
    assert not problems, problems


def _same(rows, *args, **kwargs):
    return rows


def _first_step(configs, restart_rows, config_keys, restart_keys):
    from pyspark.sql import functions as F

    first = restart_rows.groupBy(*restart_keys).agg(F.min("step_name").alias("s"))
    joined = configs.join(first, configs[config_keys[0]] == first[restart_keys[0]], "left")
    flag = F.when(F.col("s").isNotNull() & (F.col("s") != "Extract"), "Y").otherwise("N")
    return joined.select(*[configs[c] for c in configs.columns], flag.alias("exit_flag"))


def _counts_everywhere(header, per_run, keys=("audit_id", "workflow_run_id")):
    from pyspark.sql import functions as F

    return real_set_counts(header.withColumn("latest_record_ind", F.lit(1)), per_run, keys)


real_set_counts = audit.set_header_counts


def _gate_false(frame):
    from pyspark.sql import functions as F

    return frame.withColumn("counts_match", F.lit(False))


def _retire_all(lines, runs):
    from pyspark.sql import functions as F

    return lines.withColumn("latest_record_ind", F.when(F.col("job_status") != "RUNNING", 0).otherwise(F.col("latest_record_ind")))


def _always_ok(requests, matches, configs):
    from pyspark.sql import functions as F

    return requests.withColumns({"n_configs": F.lit(1).cast("long"), "verdict": F.lit("OK")})


#: A broken operator, and the row that must see it.
BROKEN = [
    ("partitioned_extract_nullsafe", partitions, "restrict_to_partitions", _same),
    ("partitioned_equals_whole", partitions, "restrict_to_partitions", _same),
    ("audit_line_retire", audit, "retire_lines", _retire_all),
    ("audit_set_counts", audit, "set_header_counts", _counts_everywhere),
    ("reconcile_counts", counts, "reconcile_counts", _gate_false),
    ("restart_gate", restart, "restart_gate", _first_step),
    ("request_verdicts", config, "check_requests", _always_ok),
]


@pytest.mark.parametrize("name, module, operator, broken", BROKEN, ids=[b[0] for b in BROKEN])
def test_row_sees_a_broken_operator(spark, con, monkeypatch, name, module, operator, broken):
    monkeypatch.setattr(module, operator, broken)
    problems, _, _ = compare(QUERIES[name](spark, SF), con, entry_mod.oracle_sql()[name])
    assert problems


def test_slices_row_sees_an_unrestricted_plan(spark, con, monkeypatch):
    from sluice.plans import extract

    monkeypatch.setattr(extract, "restrict_to_partitions", _same)
    assert compare(QUERIES["slices_subset"](spark, SF), con, entry_mod.oracle_sql()["slices_subset"])[0]


def test_quoting_and_format_rows_see_untranslated_text(spark, con, monkeypatch):
    from sluice.functions import predicates
    from sluice.plans import extract

    monkeypatch.setattr(predicates, "spark_sql", str)
    monkeypatch.setattr(extract, "spark_sql", str)
    with pytest.raises(Exception):
        assert not compare(QUERIES["quoted_names"](spark, SF), con, entry_mod.oracle_sql()["quoted_names"])[0]
    monkeypatch.undo()
    monkeypatch.setattr(predicates, "to_spark_format", lambda f: f)
    with pytest.raises(Exception):
        assert not compare(QUERIES["text_watermark_any_case"](spark, SF), con, entry_mod.oracle_sql()["text_watermark_any_case"])[0]


@pytest.mark.parametrize("name", [n for n in NAMES if n.startswith("chain_")])
def test_chain_rows_see_a_lost_row(spark, con, monkeypatch, name):
    from sluice.plans import catalog

    real = catalog.run_extraction
    monkeypatch.setattr(catalog, "run_extraction", lambda source, cfg, now, **k: real(source.where("hash(*) % 2 = 0"), cfg, now, **k))
    assert compare(QUERIES[name](spark, SF), con, entry_mod.oracle_sql()[name])[0]


def test_file_size_row_sees_an_ignored_cap(spark, con, monkeypatch):
    from sluice.operators import sinks
    from sluice.plans import extract

    real = extract.write_target
    monkeypatch.setattr(extract, "write_target", lambda rows, spec: real(rows, sinks.SinkSpec(spec.path, spec.mode, spec.partition_by)))
    assert compare(QUERIES["sink_file_sizes"](spark, SF), con, entry_mod.oracle_sql()["sink_file_sizes"])[0]
