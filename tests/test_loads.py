"""Loads of a target: one whole load is read whatever step a load dies at."""

import glob
import os

import pytest
from pyspark.sql import types as T

from sluice.operators import loads, sinks
from sluice.operators.sinks import SinkSpec, read_target, write_target

SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("k", T.StringType())])


def _rows(spark, lo, hi, bad=None):
    value = "id" if bad is None else f"case when id = {bad} then raise_error('broken row') else id end"
    return spark.range(lo, hi, 1, 6).selectExpr(f"{value} as id", "cast(id % 3 as string) as k")


def _ids(spark, path):
    return sorted(r.id for r in read_target(spark, path, SCHEMA, ()).collect())


def _data_files(path):
    local = path[len("file:"):] if path.startswith("file:") else path
    return {f: os.stat(f).st_ino for f in glob.glob(f"{local}/**/*.parquet", recursive=True)}


class Died(Exception):
    pass


def _dies(*args, **kwargs):
    raise Died


@pytest.mark.parametrize("partitions", [[], ["k"]])
@pytest.mark.parametrize("step", ["data", "commit", "remove", "remove_some", "markers", "none"])
def test_a_load_that_dies_at_any_step_leaves_one_whole_load(spark, scratch, monkeypatch, step, partitions):
    path = scratch("dies")
    write_target(_rows(spark, 0, 60), SinkSpec(path, "overwrite", partitions))
    files = _data_files(path)
    old, new = list(range(60)), list(range(100, 140))
    bad = 139 if step == "data" else None
    with monkeypatch.context() as m:
        if step == "commit":
            m.setattr(loads, "commit_load", _dies)
        if step == "remove":
            m.setattr(loads, "remove_superseded", _dies)
        if step == "remove_some":
            real = loads._files
            m.setattr(loads, "_files", lambda *a: [(_Flaky(fs), p, n) for fs, p, n in real(*a)])
        if step == "markers":
            m.setattr(loads, "_markers", _third_time(loads._markers))
        try:
            write_target(_rows(spark, 100, 140, bad), SinkSpec(path, "overwrite", partitions))
            assert step == "none"
        except Exception as e:
            assert step != "none" and (isinstance(e, Died) or "broken row" in str(e))
    assert _ids(spark, path) == (old if step in ("data", "commit") else new)
    # what is left of the first load lies where it was written
    left = _data_files(path)
    assert all(left[f] == inode for f, inode in files.items() if f in left)
    # the next load works, and clears what the dead one left
    write_target(_rows(spark, 200, 210), SinkSpec(path, "overwrite", partitions))
    assert _ids(spark, path) == sorted(r.id for r in spark.read.parquet(path).collect()) == list(range(200, 210))


class _Flaky:
    """A file system that dies at the second file it removes."""

    removed = 0

    def __init__(self, fs):
        self.fs = fs

    def delete(self, path, recursive):
        _Flaky.removed += 1
        if _Flaky.removed % 2 == 0:
            raise Died
        return self.fs.delete(path, recursive)


def _third_time(real):
    calls = []

    def markers(*args):
        calls.append(1)
        if len(calls) > 2:
            raise Died
        return real(*args)

    return markers


def test_readers_between_write_and_commit_see_the_earlier_load(spark, scratch, monkeypatch):
    path = scratch("between")
    write_target(_rows(spark, 0, 30), SinkSpec(path, "overwrite", ["k"]))
    seen = []
    real = loads.commit_load

    def look_first(s, p, load):
        seen.append(_ids(s, p))
        real(s, p, load)
        seen.append(_ids(s, p))

    monkeypatch.setattr(loads, "commit_load", look_first)
    write_target(_rows(spark, 50, 60), SinkSpec(path, "overwrite", ["k"]))
    assert seen == [list(range(30)), list(range(50, 60))]


def test_first_load_over_a_plain_target(spark, scratch, monkeypatch):
    path = scratch("plain")
    write_target(_rows(spark, 0, 10), SinkSpec(path, "append", ["k"]))
    with monkeypatch.context() as m:
        m.setattr(loads, "commit_load", _dies)
        with pytest.raises(Died):
            write_target(_rows(spark, 20, 25), SinkSpec(path, "overwrite", ["k"]))
    assert _ids(spark, path) == list(range(10))
    write_target(_rows(spark, 20, 25), SinkSpec(path, "overwrite", ["k"]))
    assert _ids(spark, path) == list(range(20, 25))
    # appends belong to the load and go with it
    write_target(_rows(spark, 30, 33), SinkSpec(path, "append", ["k"], run_id="r"))
    assert _ids(spark, path) == [*range(20, 25), *range(30, 33)]
    write_target(_rows(spark, 40, 42), SinkSpec(path, "overwrite", ["k"]))
    assert _ids(spark, path) == [40, 41]


@pytest.mark.parametrize("partitions", [[], ["k"]])
def test_an_append_run_again_replaces_its_own_rows_only(spark, scratch, partitions):
    path = scratch("again")
    write_target(_rows(spark, 0, 5), SinkSpec(path, "append", partitions))
    write_target(_rows(spark, 10, 15), SinkSpec(path, "append", partitions, run_id="c1/wf 1"))
    write_target(_rows(spark, 20, 25), SinkSpec(path, "append", partitions, run_id="c1/wf 2"))
    write_target(_rows(spark, 10, 14), SinkSpec(path, "append", partitions, run_id="c1/wf 1"))
    want = [*range(5), *range(10, 14), *range(20, 25)]
    assert _ids(spark, path) == sorted(r.id for r in spark.read.parquet(path).collect()) == want


def test_an_empty_load_empties_the_target(spark, scratch):
    path = scratch("empty")
    write_target(_rows(spark, 0, 5), SinkSpec(path, "overwrite", ["k"]))
    write_target(_rows(spark, 0, 0), SinkSpec(path, "overwrite", ["k"]))
    assert _ids(spark, path) == []
    assert sinks.loads.current_load(spark, scratch("nowhere")) is None


def test_rebalanced_files_follow_the_bytes(spark, scratch):
    path = scratch("bytes")
    rows = spark.range(0, 300_000, 1, 4).selectExpr("id", "case when id % 2 = 0 then 'hot' else cast(id % 40 as string) end as k", "sha2(cast(id as string), 256) as v")
    old = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "2m")
    try:
        write_target(rows, SinkSpec(path, "append", ["k"], max_records_per_file=10**9, rebalance=True))
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", old)
    local = path[len("file:"):] if path.startswith("file:") else path
    files = {d: [os.path.getsize(f) for f in glob.glob(f"{local}/k={d}/*.parquet")] for d in ("hot", "1", "3")}
    assert len(files["hot"]) >= 3 and len(files["1"]) == len(files["3"]) == 1
    assert max(files["hot"]) < 2 * min(files["hot"]) + (1 << 20)
    assert spark.read.parquet(path).count() == 300_000
