"""Print stage task counts and durations from a Spark event log.

    python tools/stage_times.py EVENT_LOG_DIR

Reads the (rolling, possibly zstd-compressed) event logs that
``spark.eventLog.enabled`` writes under a folder, e.g. ``bench.py`` with
``BENCH_EVENT_LOG_DIR`` set.
"""

from __future__ import annotations

import glob
import io
import json
import os
import sys


def _lines(path: str):
    data = open(path, "rb").read()
    if path.endswith(".zstd"):
        import zstandard

        data = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(data), read_across_frames=True).read()
    for line in data.decode("utf-8", "replace").splitlines():
        try:
            yield json.loads(line)
        except ValueError:
            continue


def stage_times(folder: str) -> list[tuple[int, int, int, str]]:
    out = []
    for path in sorted(glob.glob(os.path.join(folder, "**", "*"), recursive=True)):
        if not os.path.isfile(path) or "appstatus" in path or path.endswith(".crc"):
            continue
        for e in _lines(path):
            if e.get("Event") == "SparkListenerStageCompleted":
                si = e["Stage Info"]
                ms = si.get("Completion Time", 0) - si.get("Submission Time", 0)
                out.append((si["Stage ID"], si["Number of Tasks"], ms, si["Stage Name"]))
    return sorted(out)


if __name__ == "__main__":
    for sid, tasks, ms, name in stage_times(sys.argv[1]):
        print(f"stage {sid:4d}  tasks {tasks:5d}  {ms:7d} ms  {name[:70]}")
