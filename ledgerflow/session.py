"""Session settings the plans are written for; all can be changed at run time."""

from __future__ import annotations

from pyspark.sql import SparkSession

RUNTIME_SETTINGS = {
    # The JVM does not compile methods over 8000 bytes; wide cleaning projections then split instead.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.adaptive.enabled": "true",
    # A heavy customer or account is split even where that costs one more shuffle downstream.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}

#: Partitions that a shuffle is cut into at least, before adaptive execution joins small ones: whole transactions take about
#: 440 bytes in memory, so 2**28 of them are sorted 300 MB at a time and need not spill.
SHUFFLE_CUTS = 400


def apply_settings(spark: SparkSession) -> SparkSession:
    for name, value in RUNTIME_SETTINGS.items():
        spark.conf.set(name, value)
    cuts = max(SHUFFLE_CUTS, int(spark.conf.get("spark.sql.shuffle.partitions")))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(cuts))
    return spark
