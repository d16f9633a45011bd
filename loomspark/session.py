"""Session settings the operators rely on."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

# Runtime settings: safe to apply to a session somebody else created.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def apply_runtime_conf(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def local_session(
    app: str = "loomspark", cores: int | str = 8, shuffle_partitions: int = 8, checkpoints: str | None = None
) -> SparkSession:
    """A local session for tests and the bench; on a cluster the caller brings its own."""
    builder = SparkSession.builder.config("spark.checkpoint.dir", checkpoints) if checkpoints else SparkSession.builder
    spark = (
        builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("LOOMSPARK_DRIVER_MEMORY", "12g"))
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.host", "127.0.0.1")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return apply_runtime_conf(spark)
