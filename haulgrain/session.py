"""Session settings the plans count on."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Adaptive execution measures each shuffle: it broadcasts a side that turned out small, merges
# small partitions, and splits a partition that a hot key made large.  The last setting splits it
# also where that costs one more shuffle, which is the case in chains of joins on one key.
#
# A shuffle is first dealt out finely and then merged to parts of about ``PART``.  Left alone Spark merges
# it to one part per core, however large the input, up to 64 MB as written: compressed narrow rows
# then fill gigabytes of one task's memory when they are sorted, and spill.
PART, FINEST = "8m", "1000"

# HotSpot interprets a method of more than 8,000 bytes for good.  A stage whose generated method is longer, as
# with dozens of text columns or sums, runs faster operator by operator; Spark's own limit is 65,535.
SETTINGS = {
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": FINEST,
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": PART,
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply ``SETTINGS``; memory, the broadcast threshold and the partitions without adaptive execution stay the deployment's."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark
