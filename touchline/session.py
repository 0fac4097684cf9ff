"""Session construction and shared scratch storage."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(
    app: str = "touchline", cpus: int | str = "*", shuffle: int = 8, scratch: str = "spark-warehouse/scratch"
) -> SparkSession:
    """A local session for tests and the benchmark; a cluster brings its own."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", os.environ.get("TOUCHLINE_DRIVER_MEMORY", "8g"))
        .config("spark.checkpoint.dir", os.path.abspath(scratch))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_base(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``, or a folder of the warehouse.

    Both are storage that every executor sees; a machine's own temporary folder is not.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    return base.rstrip("/") if base else f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path under the shared scratch folder."""
    return f"{scratch_base(spark)}/touchline/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write an intermediate table to shared storage and read it back.

    Besides cutting lineage (a lost executor re-reads files instead of recomputing), the read
    side carries the true file size, so Catalyst broadcasts it only when it is under
    ``spark.sql.autoBroadcastJoinThreshold`` and shuffles it otherwise.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
