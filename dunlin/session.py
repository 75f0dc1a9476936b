"""Session settings the plans are written for."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Adaptive execution picks join sides by measured size, merges small and splits skewed
# shuffle partitions; the forced form also splits where it costs one more shuffle.
CLUSTER_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def cluster_builder(app: str, shuffle_partitions: int = 8000) -> SparkSession.Builder:
    """Builder for a cluster session. Start with many shuffle partitions (AQE merges them);
    ``spark.checkpoint.dir`` must name a folder all executors share."""
    builder = SparkSession.builder.appName(app)
    for key, value in CLUSTER_CONF.items():
        builder = builder.config(key, value)
    return builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))


def local_session(cpus: str = "*", app: str = "dunlin", memory: str = "12g") -> SparkSession:
    builder = cluster_builder(app, shuffle_partitions=8 if cpus == "*" else max(int(cpus), 1))
    return (
        builder.master(f"local[{cpus}]")
        .config("spark.driver.memory", memory)
        .config("spark.sql.files.maxPartitionBytes", "16m")
        .config("spark.ui.enabled", "false")
        .config("spark.log.level", "ERROR")
        .getOrCreate()
    )
