"""Session settings this library is tuned for."""

import os
import pathlib

from pyspark.sql import SparkSession

_ROOT = str(pathlib.Path(__file__).resolve().parents[1])

# Cluster and local runs share these. Sizes of partitions are left to adaptive
# execution, which splits skewed join partitions and merges small ones.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.serializer": "org.apache.spark.serializer.KryoSerializer",
    # MinHash keeps one minimum per hash function; this lets all of them stay in
    # one generated stage.
    "spark.sql.codegen.maxFields": "400",
}


def build_session(app_name="kindred", master=None, shuffle_partitions=None, extra=None, initial_partitions=None):
    """Create (or get) a session with `SETTINGS`; `extra` overrides single entries.

    `initial_partitions` is the number every exchange starts with before adaptive execution
    merges small partitions. Aggregates behind joins that multiply rows cannot be split
    later, so on a cluster it should be high, some ten times the cores.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = dict(SETTINGS)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if initial_partitions:
        settings["spark.sql.adaptive.coalescePartitions.initialPartitionNum"] = str(initial_partitions)
    settings.update(extra or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def reachable(spark):
    """Let the Python workers that Spark starts from now on import this package."""
    environment = spark.sparkContext.environment
    held = environment.get("PYTHONPATH", "")
    if _ROOT not in held.split(os.pathsep):
        environment["PYTHONPATH"] = os.pathsep.join(p for p in (_ROOT, held) if p)
