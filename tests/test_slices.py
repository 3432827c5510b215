"""Predicates dealt by rows: exactly one per row, no share too large."""

import random

import duckdb
import pyarrow as pa
import pytest

from sluice.operators.partitions import discover_partitions
from sluice.sources import slices


def _met(table: pa.Table, predicates):
    """Rows per predicate, and the rows that do not meet exactly one, in a database."""
    con = duckdb.connect()
    con.register("t", table)
    hits = ", ".join(f"coalesce(({p}), false)::int as p{i}" for i, p in enumerate(predicates))
    con.execute(f"create table h as select {hits} from t")
    total = " + ".join(f"p{i}" for i in range(len(predicates)))
    wrong = con.execute(f"select count(*) from h where {total} <> 1").fetchone()[0]
    sums = con.execute("select " + ", ".join(f"sum(p{i})" for i in range(len(predicates))) + " from h").fetchone()
    return wrong, [s or 0 for s in sums]


def _table(spark, rows, schema):
    df = spark.createDataFrame(rows, schema).repartition(4)
    return df, df.toArrow()


@pytest.mark.parametrize("with_pk", [True, False])
def test_a_hot_key_is_cut_by_primary_key(spark, with_pk):
    rnd = random.Random(1)
    names = ["HOT", "it's", 'q"uote', "É", "a", "b", "", None]
    rows = [
        ("HOT", 1, i) if i % 3 == 0 else (rnd.choice(names), rnd.choice([None, 1, 2, 3, rnd.randrange(500)]), i if i % 50 else None)
        for i in range(20_000)
    ]
    df, table = _table(spark, rows, "name string, n int, id long")
    keys = discover_partitions(df, ["name", "n"], counted=True)
    dealt = slices.slice_ranges(keys, ["name", "n"], df, 20, ["id"] if with_pk else [])
    wrong, sums = _met(table, dealt.predicates)
    assert wrong == 0 and sum(sums) == 20_000
    assert ("HOT", "1") in dealt.hot
    if with_pk:
        assert max(sums) <= 2 * 1000
    else:
        assert sorted(sums)[-1] > 6000


def test_keys_with_many_rows_share_the_ranges(spark):
    """Few rows for most keys, many for some: ranges hold about as many rows, not keys."""
    rows = [(k, i) for k in range(400) for i in range(1 if k < 300 else 60)]
    df, table = _table(spark, rows, "k int, id long")
    dealt = slices.slice_ranges(discover_partitions(df, ["k"], counted=True), ["k"], df, 10, ["id"])
    wrong, sums = _met(table, dealt.predicates)
    assert wrong == 0 and max(sums) <= 2 * -(-len(rows) // 10) and not dealt.hot
    assert sum(s > 0 for s in sums) >= 8


@pytest.mark.parametrize("kind", ["text", "composite", "dates", "nulls", "one value"])
def test_full_pull_ranges(spark, kind):
    import datetime as dt

    rnd = random.Random(2)
    word = lambda: rnd.choice(["same", f"k'{rnd.randrange(5000)}", f"É{rnd.randrange(99)}", ""])
    rows, schema, cols = {
        "text": ([(f"{word()}-{i}", i) for i in range(6000)], "a string, id long", ["a"]),
        "composite": ([("same" if i % 2 else word(), i) for i in range(6000)], "a string, id long", ["a", "id"]),
        "dates": ([(dt.datetime(2024, 1, 1) + dt.timedelta(minutes=i * i), i) for i in range(3000)], "a timestamp_ntz, id long", ["a"]),
        "nulls": ([(None if i % 4 == 0 else word(), None if i % 5 == 0 else i) for i in range(6000)], "a string, id long", ["a", "id"]),
        "one value": ([("x", 1)] * 500, "a string, id long", ["a", "id"]),
    }[kind]
    df, table = _table(spark, rows, schema)
    predicates = slices.table_ranges(df, cols, 12)
    wrong, sums = _met(table, predicates)
    assert wrong == 0 and sum(sums) == len(rows)
    if kind != "one value":
        assert max(sums) <= 2 * len(rows) / 12 and sum(s > 0 for s in sums) >= 8


def test_ranges_are_exact_under_another_order():
    bounds = [("b", "2"), ("D", "1"), ("f", "9"), ("Z", "")]  # no order at all
    table = pa.table({"a": ["a", "b", "b", "C", "e", "z", "Z", "0"], "b": ["1", "2", "1", "5", "", "9", "x", "3"]})
    assert _met(table, slices.ranges(["a", "b"], bounds, ordered=False))[0] == 0


def test_ends_of_one_text_are_asked_once():
    """Of ends with one text only the last is asked, exact under any order of the texts."""
    texts = [None, "D", "b", "É", ""]  # no order at all
    bounds = [(t, n) for t in texts for n in (None, 1, 2.5, 30)][1:]
    table = pa.table({"a": [t for t in [*texts, "zz", "A"] for _ in range(6)], "n": [None, 0.0, 1.0, 2.0, 2.5, 99.0] * 7})
    predicates = slices.ranges(["a", "n"], bounds, ordered=False)
    assert _met(table, predicates)[0] == 0
    assert max(p.count("NOT (") for p in predicates) == len(texts) - 1
    assert max(p.count("NOT (") for p in slices.ranges(["n", "a"], [(n, t) for t, n in bounds[4:8]], ordered=False)) == 2


def test_predicates_are_asked_once_and_compiled(spark, monkeypatch):
    from sluice.plans import catalog

    df = spark.createDataFrame([("x", i % 7 if i % 9 else None) for i in range(500)] + [(None, 3), ("y", 8)], "k string, n int")
    asked = spark.sparkContext.accumulator(0)
    marked = df.rdd.map(lambda r: asked.add(1) or r)
    rows = spark.createDataFrame(marked, df.schema)
    met = catalog._met(rows, ['"n" < 3', '"n" >= 3 AND "n" < 8', '"n" IS NULL', '"n" = 3', "1 = 0"], ["k"])
    plan = met._jdf.queryExecution().analyzed().toString()
    assert "lambda" not in plan
    got = {r.k: tuple(r)[1:] for r in met.collect()}
    sevens = [i % 7 for i in range(500) if i % 9]
    threes = sevens.count(3)
    largest = sum(n >= 3 for n in sevens) + 1
    assert got == {"x": (500, 500 + threes, 2, largest), None: (1, 2, 2, largest), "y": (1, 0, 0, largest)}
    assert asked.value == 502


def test_empty_sources_read_nothing_wrong(spark):
    df = spark.createDataFrame([], "k string, id long")
    dealt = slices.slice_ranges(discover_partitions(df, ["k"], counted=True), ["k"], df, 5, ["id"])
    assert not dealt.hot and not dealt.bounds
    assert slices.quantile_bounds(df, ["k"], 5) == [] and slices.table_ranges(df, ["k"], 5) == ["1 = 1"]


def test_jdbc_reads_take_the_dealt_predicates(spark, monkeypatch):
    from sluice.sources import jdbc

    table = spark.createDataFrame([("a", 1)] * 50 + [("b", 2), (None, 3)], "k string, v int")
    asked = []
    monkeypatch.setattr(jdbc, "read_jdbc_slices", lambda spark, options, name, predicates: (asked.append(predicates), table)[1])
    keys = discover_partitions(table, ["k"], counted=True)
    got = jdbc.sliced_jdbc_source(spark, {}, "t", table, keys, ["k"], ranges=4, primary_keys=("v",))
    assert got.count() == 52 and any('"k" = \'a\'' in p and '"v" <' not in p for p in asked[0])
