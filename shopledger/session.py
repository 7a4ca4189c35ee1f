"""Session settings the plans are written for. Reports never change a session themselves."""

from __future__ import annotations

from pyspark.sql import SparkSession

MIB = 1024 * 1024


def settings(total_cores: int) -> dict[str, str]:
    """Settings for a cluster with ``total_cores`` executor cores.

    The shuffle starts with many partitions, so that none outgrows a task at any
    data size, and the adaptive planner merges them to the advisory size. Joins of
    two large tables are left to it as well: it splits skewed partitions and turns a
    join whose side proved small into a broadcast. A broadcast planned from file
    sizes alone is trusted less: files count four times their compressed size.
    """
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "3",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(256 * MIB),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 * MIB),
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.shuffle.partitions": str(max(8, min(50_000, 10 * total_cores))),
        "spark.sql.autoBroadcastJoinThreshold": str(10 * MIB),
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(32 * MIB),
        "spark.sql.sources.fileCompressionFactor": "4.0",
        "spark.sql.files.maxPartitionBytes": str(256 * MIB),
        "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    }


def configured(builder: SparkSession.Builder, total_cores: int) -> SparkSession.Builder:
    for key, value in settings(total_cores).items():
        builder = builder.config(key, value)
    return builder
