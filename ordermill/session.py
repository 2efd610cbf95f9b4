"""A local session for tests, benchmarks and trying things out."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession


def local_session(name: str, cpus: int = 8) -> SparkSession:
    """Session on this machine; on a cluster, use the one the cluster gives you."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.showConsoleProgress", "false")
        # Intermediate tables; on a cluster, a folder that all executors share.
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="ordermill-shared-"))
        # Without it, every column expression notes the line that made it.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark
