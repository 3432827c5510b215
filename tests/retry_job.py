"""Run by test_retries.py in its own Spark app with task retries enabled.

One task of the stage before the dedup shuffle and one task of the writing
stage fail on their first attempt; the extraction must still report exact
counts and write exact rows.
"""

import datetime as dt
import json
import os
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from sluice.plans.extract import ExtractionConfig, run_extraction


def flaky(stage_tag: int):
    @F.pandas_udf("long")
    def fail_first_attempt(v: pd.Series) -> pd.Series:
        ctx = TaskContext.get()
        if ctx.partitionId() == 0 and ctx.attemptNumber() == 0:
            marker = os.environ.get("SLUICE_RETRY_MARKERS")
            if marker:
                open(os.path.join(marker, f"failed-{stage_tag}-{ctx.stageId()}"), "w").close()
            raise RuntimeError(f"injected failure {stage_tag}")
        return v

    return fail_first_attempt


def main(out_dir: str) -> None:
    spark = (
        SparkSession.builder.master("local[4,4]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.adaptive.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    li = spark.read.parquet("/root/testdata/sf0.01/lineitem.parquet").repartition(4)
    # failure before the shuffle (map stage)
    li = li.withColumn("l_orderkey", flaky(1)(F.col("l_orderkey")))
    cfg = ExtractionConfig.from_mapping(
        dict(load_strategy="TL-SRC-TGT", primary_keys="l_orderkey,l_linenumber", target_path=out_dir)
    )
    from sluice.plans import extract as ex

    plan = ex.plan_extraction(li, cfg, dt.datetime(2024, 1, 20))
    # failure in the writing stage, after the shuffle
    real_write = ex.write_target

    def write_with_failure(rows, spec):
        real_write(rows.withColumn("l_linenumber", flaky(2)(F.col("l_linenumber").cast("long")).cast("int")), spec)

    ex.write_target = write_with_failure
    try:
        res = run_extraction(li, cfg, dt.datetime(2024, 1, 20))
    finally:
        ex.write_target = real_write
    clean = spark.read.parquet("/root/testdata/sf0.01/lineitem.parquet")
    print(json.dumps({
        "src": res.src_record_count,
        "tgt": res.target_record_count,
        "written": spark.read.parquet(out_dir).count(),
        "expected_src": clean.count(),
        "expected_tgt": clean.select("l_orderkey", "l_linenumber").distinct().count(),
        "planned": plan.output is not None,
    }))
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1] if len(sys.argv) > 1 else tempfile.mkdtemp(prefix="sluice-retry-") + "/out")
