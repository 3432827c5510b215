"""Loads of a target: which files belong to one, and which load counts.

A load that replaces a target writes its files beside the ones already there,
in the same folders, under names of its own (``load-<id>-...``).  It counts
from the moment its marker, an empty file ``_loads/<number>-<id>``, exists;
the marker with the greatest name is the current load.  Creating an empty file
is one step on any store, so nothing is renamed and a run that dies leaves the
target as it was or with the new load, never with parts of both:

* before the marker, readers go on reading the earlier load's files;
* after it, the earlier files are no longer read and are removed.

``current_files`` is the name pattern of the files that count, to be given to
the Parquet reader as ``pathGlobFilter``, so partition columns and pruning work
as for any folder.  Readers that know no markers see exactly the current load
whenever no load is under way.

An append belongs to the current load and can carry a run id in its file
names, so a rerun finds and removes what an earlier try of the same run left.

Removing lists the target's files on the driver; markers and names are all it
keeps of them.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrameWriter, SparkSession

MARKERS = "_loads"
LOAD, RUN, PLAIN = "load-", "run-", "part"
#: Files of no load: the names the writers of a target without markers give.
NO_LOAD = "[!l]*"


def _folder(spark: SparkSession, path: str):
    """File system, path and path class of a folder."""
    cls = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    here = cls(path)
    return here.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), here, cls


def _markers(spark: SparkSession, path: str) -> list[str]:
    fs, here, cls = _folder(spark, path)
    folder = cls(here, MARKERS)
    if not fs.exists(folder):
        return []
    return sorted(str(s.getPath().getName()) for s in fs.listStatus(folder))


def current_load(spark: SparkSession, path: str) -> str | None:
    """The id of the load that counts; ``None`` for a target that was never replaced."""
    markers = _markers(spark, path)
    return markers[-1].split("-", 1)[1] if markers else None


def current_files(spark: SparkSession, path: str) -> str:
    """Name pattern of the files that count."""
    load = current_load(spark, path)
    return NO_LOAD if load is None else f"{LOAD}{load}-*"


def is_new(spark: SparkSession, path: str) -> bool:
    """Whether nothing was ever written to the target, so that no load can be superseded."""
    fs, here, _ = _folder(spark, path)
    return not fs.exists(here)


def new_load() -> str:
    return uuid.uuid4().hex


def run_tag(run_id: str) -> str:
    """A run id as file names can carry it."""
    return RUN + hashlib.md5(run_id.encode()).hexdigest()


def named(writer: DataFrameWriter, load: str | None, run_id: str | None = None) -> DataFrameWriter:
    """``writer`` with the names of its files set to tell load and run."""
    parts = [f"{LOAD}{load}" if load else PLAIN, *([run_tag(run_id)] if run_id else [])]
    return writer.option("mapreduce.output.basename", "-".join(parts))


def commit_load(spark: SparkSession, path: str, load: str) -> None:
    """The load counts from here on."""
    fs, here, cls = _folder(spark, path)
    number = int(m[-1].split("-", 1)[0]) + 1 if (m := _markers(spark, path)) else 1
    fs.create(cls(cls(here, MARKERS), f"{number:012d}-{load}"), False).close()


def _files(spark: SparkSession, path: str) -> Iterator:
    """(file system, path, name) of every data file below ``path``."""
    fs, here, _ = _folder(spark, path)
    if not fs.exists(here):
        return
    found = fs.listFiles(here, True)
    root = str(here.toUri().getPath()).rstrip("/")
    while found.hasNext():
        p = found.next().getPath()
        below = str(p.toUri().getPath())[len(root) + 1 :]
        # as Spark's readers have it: partition folders may begin with an underscore
        if not any(x.startswith(".") or (x.startswith("_") and "=" not in x) for x in below.split("/")):
            yield fs, p, str(p.getName())


def remove_superseded(spark: SparkSession, path: str) -> None:
    """Remove the files and markers of all loads but the current one."""
    load = current_load(spark, path)
    if load is None:
        return
    for fs, p, name in list(_files(spark, path)):
        if not name.startswith(f"{LOAD}{load}-"):
            fs.delete(p, False)
    fs, here, cls = _folder(spark, path)
    for marker in _markers(spark, path)[:-1]:
        fs.delete(cls(cls(here, MARKERS), marker), False)


def remove_run(spark: SparkSession, path: str, run_id: str) -> int:
    """Remove the files an earlier try of this run appended; how many there were."""
    tag = run_tag(run_id)
    left = [(fs, p) for fs, p, name in _files(spark, path) if f"-{tag}-" in name]
    for fs, p in left:
        fs.delete(p, False)
    return len(left)
