"""Local session for tests and the benchmark. On a cluster, use the cluster's
session as it is: the library never overrides session settings, save that operators on
texts lower the bytes of a batch for Python (``starmart.llm.common.small_batches``)."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def default_parallelism(spark: SparkSession) -> int:
    """Task slots of the cluster."""
    return int(spark.sparkContext.defaultParallelism)


def application_id(spark: SparkSession) -> str:
    return spark.sparkContext.applicationId


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, app: str = "starmart") -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("STARMART_DRIVER_MEMORY", "8g"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
