"""Session settings the library relies on for skewed data."""

from __future__ import annotations

from pyspark.sql import SparkSession

ADAPTIVE = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join even where the rows then have to be shuffled once more. Otherwise
    # a step that reuses the join's partitioning keeps all rows of a hot key in one task.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Do not take rows joined on one key as being grouped by that key and others: combine
    # them per task, shuffle the few that are left by the whole key, and leave the join free
    # to be split.
    "spark.sql.requireAllClusterKeysForDistribution": "true",
    # Writing many small folders costs by the file, not by the byte: leave some tasks to share it.
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k",
    # Merge a task's own lines into session windows before the shuffle.
    "spark.sql.sessionWindow.merge.sessions.in.local.partition": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Turn on adaptive execution and its handling of skewed joins for a session."""
    for name, value in ADAPTIVE.items():
        spark.conf.set(name, value)
    return spark
