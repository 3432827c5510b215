"""Where sluice writes its own tables (sink queries, checkpoints).

Always under the session's ``spark.checkpoint.dir``, the shared folder a
cluster names for lineage cuts.  Only a local-mode session without one gets a
temporary folder, as in tests.
"""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def scratch_dir(spark: SparkSession) -> str:
    """Base folder for tables the queries write.

    Read from ``spark.checkpoint.dir`` (shared storage on a cluster).  Only
    when the session has none - local tests - is a temporary folder set.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc_dir = spark.sparkContext.getCheckpointDir()
        if base and not sc_dir:
            # set on the session after the context started: register it so
            # DataFrame.checkpoint() writes there too
            spark.sparkContext.setCheckpointDir(base)
    except Exception:  # sessions without a SparkContext (Spark Connect)
        sc_dir = None
    base = base or sc_dir
    if not base:
        # Only a single-machine session may use a local folder; executors on a
        # cluster could not see it.
        master = spark.conf.get("spark.master", "")
        if master != "local" and not master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder for sluice's tables")
        import tempfile

        base = tempfile.mkdtemp(prefix="sluice-ckpt-")
        try:
            spark.sparkContext.setCheckpointDir(base)
        except Exception:
            spark.conf.set("spark.checkpoint.dir", base)
    return base.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{scratch_dir(spark)}/sluice/{label}-{uuid.uuid4().hex}"
