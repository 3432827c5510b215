"""Regenerate docs/PLANS.md: AQE's final plans of the headline queries.

    python tools/plans_doc.py [SF_DIR]

Runs each query once (so the plans are the final adaptive ones), keeps the
plan tree and its scan, join and aggregate lines, and rewrites the document;
the last section is the frame ``run_extraction`` writes, with its count
observation.
"""

from __future__ import annotations

import contextlib
import datetime as dt
import io
import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

NOTES = {
    'delta_closed_window': (
        'IO-SNAP-DLY window: one stage, no shuffle. Both bounds are typed `timestamp_ntz` literals '
        'in `PushedFilters`; `ReadSchema` holds the three selected columns only.'
    ),
    'tl_agg': (
        'TL-AGG: the one-row `max` runs first as a subquery and the result is pushed into the '
        'lineitem scan as `EqualTo(l_shipdate, ScalarSubquery)`, a runtime filter; no join and no '
        'broadcast of data.'
    ),
    'partitioned_equals_whole': (
        'Slices: discovery is a partial `HashAggregate` (one row per key per map task). AQE '
        'measured the key side and chose a broadcast for the null-safe `LeftSemi` (keys '
        "`coalesce(k,'')`, `isnull(k)`). The count distinct is two-level partial aggregation."
    ),
    'dedup_primary_keys': (
        'A8: `partial_min(struct(...))` on the map side, so a hot key leaves each map task as one '
        'row; one shuffle on the primary key; AQE coalesced the shuffle partitions. All columns are '
        'read because the tie-break order needs them.'
    ),
    'extracted_flag': (
        'A6 set-based: orders are aggregated per customer before the join (`partial_count`), so the '
        'join moves one row per config.'
    ),
    'audit_retire_latest': (
        'C5 + C6: the current run per audit id is a partial aggregate. The history (anti-join) and '
        'the current rows (semi-join) stream past it; the retire step folds the current runs to one '
        'row per audit id before its left join, so no history row is multiplied. AQE broadcast the '
        'per-id sides after measuring them.'
    ),
    'restart_gate': (
        'R3: `max_by(step_name, struct(insert_timestamp, step_id, step_name))` per config (map-side '
        'partial), then one left join to the configs.'
    ),
}

TEXT_NOTE = (
    'P7 over a stored source whose watermark is text in two columns, `DT` and `TM`. The exact '
    'predicate parses their concatenation; the bound on `DT`, which it implies, is in '
    '`PushedFilters` and prunes row groups.'
)

WRITTEN_NOTE = (
    'An IO-SNAP-DLY window over lineitem at sf0.1 with primary-key dedup. The count observation '
    '(`CollectMetrics`) sits above the final aggregate, after the shuffle, in the stage that '
    'writes. Its source count is the sum of the per-key `__source_rows` carried through the '
    'shuffle; its target count is the rows written. The window bounds are in `PushedFilters` '
    'and only the selected columns are read.'
)

KEEP = ("PushedFilters", "ReadSchema", "Location", "Join type", "Left keys", "Right keys", "Functions", "Condition")


def _clean(line: str) -> str:
    return re.sub(r"#\d+L?", "", line)


def _explain(df) -> list[str]:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue().splitlines()


def _tree(lines: list[str]) -> str:
    tree = []
    for ln in lines:
        if ln.startswith("+- == Initial Plan =="):
            break
        if tree and not ln.strip():
            break
        tree.append(_clean(ln))
    return "\n".join(tree).rstrip()


def _details(lines: list[str], prefixes=KEEP, limit: int = 16) -> str:
    seen, keep = set(), []
    for ln in lines:
        if ln.startswith(prefixes) and _clean(ln) not in seen:
            seen.add(_clean(ln))
            keep.append(_clean(ln))
    return "\n".join(keep[:limit])


def main(sf: str) -> None:
    from pyspark.sql import SparkSession

    from sluice.operators.counts import observe_counts
    from sluice.plans.catalog import QUERIES
    from sluice.plans.extract import ExtractionConfig, plan_extraction
    from sluice.sources.parquet import read_table

    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "16")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    parts = [
        "# Physical plans of the headline queries\n",
        "Captured with `df.explain(\"formatted\")` after running each query at "
        f"{os.path.basename(sf.rstrip('/'))} on local[8] (16 shuffle partitions, AQE on), so the trees are "
        "AQE's final plans. Only the tree and the scan lines are kept; regenerate with "
        "`python tools/plans_doc.py`.\n",
    ]
    for name, note in NOTES.items():
        df = QUERIES[name](spark, sf)
        df.collect()
        lines = _explain(df)
        parts.append(f"## `{name}`\n\n{note}\n\n```\n{_tree(lines)}\n```\n\n```\n{_details(lines)}\n```\n")

    cfg = ExtractionConfig.from_mapping(dict(
        load_strategy="IO-SNAP-DLY", select_columns="l_orderkey, l_linenumber, l_shipdate, l_quantity",
        cdc_column="l_shipdate", cdc_timestamp=dt.datetime(1998, 1, 1),
        to_cdc_timestamp=dt.datetime(1998, 12, 31, 23, 59, 59), cdc_ts_format="YYYY-MM-DD HH24:MI:SS",
        primary_keys="l_orderkey, l_linenumber", target_path="unused"))
    out, _ = observe_counts(plan_extraction(read_table(spark, sf, "lineitem"), cfg, dt.datetime(2024, 1, 20)).output,
                            "doc")
    lines = _explain(out)
    details = _details(lines, ("PushedFilters", "ReadSchema", "Arguments: doc"))
    parts.append(f"## `run_extraction`: the frame that is written\n\n{WRITTEN_NOTE}\n\n```\n{_tree(lines)}\n```"
                 f"\n\n```\n{details}\n```\n")
    from pyspark.sql import functions as F

    from sluice.plans.scratch import scratch_path

    path = scratch_path(spark, "plans_doc")
    read_table(spark, sf, "events").select(
        "event_id", F.date_format("ts", "yyyy-MM-dd ").alias("DT"), F.date_format("ts", "HH:mm:ss").alias("TM")
    ).write.parquet(path)
    cfg = ExtractionConfig.from_mapping(dict(
        load_strategy="IO-CDC", select_columns="event_id", cdc_column="DT,TM", cdc_timestamp=dt.datetime(2024, 1, 25, 12),
        cdc_ts_format="YYYY-MM-DD HH24:MI:SS"))
    lines = _explain(plan_extraction(spark.read.parquet(path), cfg, dt.datetime(2024, 1, 26)).selected)
    details = _details(lines, ("PushedFilters", "ReadSchema"))
    parts.append(f"## Text watermark stored in two columns\n\n{TEXT_NOTE}\n\n```\n{_tree(lines)}\n```\n\n```\n{details}\n```\n")
    with open(os.path.join(ROOT, "docs", "PLANS.md"), "w") as f:
        f.write("\n".join(parts))
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1")
