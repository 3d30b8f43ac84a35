"""A session with the settings the plans rely on.

On a cluster the session usually comes from spark-submit; the adaptive
settings below are Spark's defaults there and are spelled out because skewed
writes (rebalance) and skewed joins depend on them. With several output writers
a task that meets few partitions writes them without sorting first. Recording the Python line
of every column expression is off: it costs more than building the plan.
"""

from __future__ import annotations

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", memory: str = "8g", app: str = "tierlake") -> SparkSession:
    parallelism = "8" if cores == "*" else str(cores)
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", parallelism)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.maxConcurrentOutputFileWriters", "32")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark
