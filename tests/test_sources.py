"""Source helpers that need no database: options, slice lists, fallbacks."""

import pytest

from sluice.sources import jdbc


def test_jdbc_options_keep_fetch_size():
    opts = jdbc.jdbc_options("jdbc:x://h/db", user="u", password="p", driver="d")
    assert opts["fetchsize"] == "100000" and opts["driver"] == "d"


def _met(values, predicates, kind):
    """How many of the predicates each value meets, in a database."""
    import duckdb
    import pyarrow as pa

    con = duckdb.connect()
    con.register("t", pa.table({"k": pa.array(values, kind)}))
    return con.execute("select k, " + " + ".join(f"coalesce(({p})::int, 0)" for p in predicates) + " from t").fetchall()


@pytest.mark.parametrize("kind", ["string", "long", "timestamp"])
def test_range_predicates_cover_every_key_exactly_once(spark, kind):
    import datetime as dt

    import pyarrow as pa

    values = {
        "string": [f"k'{i}\"{i % 7}" for i in range(5000)] + ["", "É", "'"],
        "long": [*range(-50, 4950)],
        "timestamp": [dt.datetime(2024, 1, 1) + dt.timedelta(minutes=i) for i in range(5000)],
    }[kind] + [None]
    type_ = {"string": pa.string(), "long": pa.int64(), "timestamp": pa.timestamp("us")}[kind]
    keys = spark.createDataFrame([(v,) for v in values], f"k {kind.replace('timestamp', 'timestamp_ntz')}")
    bounds = jdbc.range_bounds(keys, "k", 40)
    assert 20 <= len(bounds) <= 39 and bounds == sorted(bounds)
    for ordered in (True, False):
        preds = jdbc.range_predicates("k", bounds, ordered)
        assert len(preds) == len(bounds) + 2
        assert {n for _, n in _met(values, preds, type_)} == {1}


def test_text_ranges_are_exact_under_another_order():
    """A database may sort text otherwise than Spark; ranges that exclude the earlier ones do not care."""
    bounds = ["b", "D", "f", "Z"]  # no order at all
    preds = jdbc.range_predicates("k", bounds, ordered=False)
    import pyarrow as pa

    assert {n for _, n in _met(["a", "b", "C", "e", "z", "Z", "0", None], preds, pa.string())} == {1}


def test_ranges_hold_about_as_many_keys(spark):
    keys = spark.range(10_000).selectExpr("id * id as k")
    bounds = jdbc.range_bounds(keys, "k", 10)
    edges = [0, *[round(b**0.5) for b in bounds], 10_000]
    assert max(b - a for a, b in zip(edges, edges[1:])) < 2500


def test_no_key_reads_nothing_and_a_subset_only_its_rows(spark, monkeypatch):
    table = spark.createDataFrame([("a", 1), ("b", 2), (None, 3), ("c", 4)], "k string, v int")
    monkeypatch.setattr(jdbc, "read_jdbc_table", lambda *a: table)
    asked = []

    def slices(spark, options, name, predicates):
        asked.append(predicates)
        return table

    monkeypatch.setattr(jdbc, "read_jdbc_slices", slices)
    none = spark.createDataFrame([], "k string")
    assert jdbc.sliced_jdbc_source(spark, {}, "t", table, none, ["k"]).count() == 0 and not asked
    chosen = spark.createDataFrame([("a",), (None,), ("x",)], "k string")
    got = jdbc.sliced_jdbc_source(spark, {}, "t", table, chosen, ["k"], ranges=4, subset=True)
    assert sorted(r.v for r in got.collect()) == [1, 3] and len(asked) == 1
    assert jdbc.sliced_jdbc_source(spark, {}, "t", table, table.select("k"), ["k"]).count() == 4


def test_key_range_partitioning_picks_an_ordered_key(spark):
    df = spark.createDataFrame([("x", 5), ("y", 9)], "name string, id long")
    assert jdbc.key_range_partitioning(df, ("name", "id")) == ("id", 5, 9)
    assert jdbc.key_range_partitioning(df, ("name",)) is None and jdbc.key_range_partitioning(df.limit(0), ("id",)) is None


def test_catalog_registration_sets_pushdown(spark):
    jdbc.register_jdbc_catalog(spark, "srcdb", {"url": "jdbc:x://h/db", "fetchsize": "100000"})
    assert spark.conf.get("spark.sql.catalog.srcdb.pushDownAggregate") == "true"
    assert spark.conf.get("spark.sql.catalog.srcdb").endswith("JDBCTableCatalog")


def test_cli_jdbc_options_take_password_from_environment(monkeypatch):
    from sluice.__main__ import _parser, jdbc_options_from_args

    monkeypatch.setenv("SRC_PW", "s3cret")
    args = _parser().parse_args(["--control", "c", "--out", "o", "--jdbc-url", "jdbc:x://h/db", "--jdbc-user", "u",
                                 "--jdbc-password-env", "SRC_PW", "--workflow-run-id", "w", "--job-run-id", "j"])
    opts = jdbc_options_from_args(args)
    assert opts == {"url": "jdbc:x://h/db", "fetchsize": "100000", "user": "u", "password": "s3cret"}
    assert jdbc_options_from_args(_parser().parse_args(
        ["--control", "c", "--out", "o", "--source-root", "/d", "--workflow-run-id", "w", "--job-run-id", "j"])) is None


def test_window_partitioning_from_config_bounds():
    import datetime as dt

    from sluice.plans.extract import ExtractionConfig

    now = dt.datetime(2024, 1, 20, 9, 30)
    fmt = "YYYY-MM-DD HH24:MI:SS"
    dly = ExtractionConfig.from_mapping(dict(load_strategy="IO-SNAP-DLY", cdc_column="TS", cdc_ts_format=fmt,
                                             cdc_timestamp=dt.datetime(2024, 1, 10),
                                             to_cdc_timestamp=dt.datetime(2024, 1, 10, 23, 59, 59)))
    assert jdbc.window_partitioning(dly, now) == ("TS", dt.datetime(2024, 1, 10), dt.datetime(2024, 1, 10, 23, 59, 59))
    cdc = ExtractionConfig.from_mapping(dict(load_strategy="IO-CDC", cdc_column="TS", cdc_ts_format=fmt,
                                             cdc_timestamp=dt.datetime(2024, 1, 10)))
    assert jdbc.window_partitioning(cdc, now)[2] == now
    for raw in (dict(load_strategy="IO-SNAP", cdc_column="TS", cdc_ts_format=fmt, cdc_timestamp=now),
                dict(load_strategy="IO-CDC", cdc_column="A,B", cdc_ts_format=fmt, cdc_timestamp=now),
                dict(load_strategy="IO", cdc_column="TS", cdc_ts_format=fmt, cdc_timestamp=now),
                dict(load_strategy="IO-CDC", cdc_column="TS", cdc_timestamp=now)):
        assert jdbc.window_partitioning(ExtractionConfig.from_mapping(raw), now) is None
    opts = jdbc.window_read_options({"url": "jdbc:x"}, "S.T", "TS", dt.datetime(2024, 1, 10),
                                    dt.datetime(2024, 1, 11), 8)
    assert opts["partitionColumn"] == "TS" and opts["lowerBound"] == "2024-01-10 00:00:00"
    assert opts["numPartitions"] == "8" and opts["dbtable"] == "S.T"
