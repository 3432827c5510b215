"""Session settings sized for the data, for running extractions at scale.

The rules are the usual ones for Spark SQL: input splits and shuffle
partitions of roughly ``target_partition_bytes`` so that each task fits
comfortably in executor memory, AQE on so that partitions are coalesced,
skewed ones split and small join sides broadcast after measuring them.
"""

from __future__ import annotations

import math

MIB = 1024 * 1024


def scale_settings(
    input_bytes: int,
    executors: int,
    cores_per_executor: int,
    target_partition_bytes: int = 256 * MIB,
    broadcast_bytes: int = 64 * MIB,
) -> dict[str, str]:
    """Spark SQL settings for reading ``input_bytes`` on the given cluster.

    Shuffle partitions: enough for ``target_partition_bytes`` per partition,
    and at least two waves of tasks; AQE coalesces them when the data after
    filtering is smaller.  ``broadcast_bytes`` bounds what AQE may broadcast
    after it has measured a join side.
    """
    cores = max(1, executors * cores_per_executor)
    by_size = math.ceil(input_bytes / target_partition_bytes)
    partitions = max(2 * cores, by_size)
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(broadcast_bytes),
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.sources.partitionOverwriteMode": "static",
        "spark.sql.parquet.filterPushdown": "true",
    }
