"""Session helpers: connector packages and the shared work folder."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

# Fixed value: the Kafka source for the Spark line this library targets.
KAFKA_PACKAGE = "org.apache.spark:spark-sql-kafka-0-10_2.13:4.1.2"


def kafka_session(app_name: str, package: str = KAFKA_PACKAGE) -> SparkSession.Builder:
    """Builder with the Kafka connector on the classpath (needs a package repository)."""
    return SparkSession.builder.appName(app_name).config("spark.jars.packages", package)


def shared_base(spark: SparkSession) -> str:
    """The folder for intermediate tables that every executor can reach: the one the cluster names in ``spark.checkpoint.dir``.

    A session on one machine may leave it unset, and uses its warehouse; on a cluster that is an error, since the default of the
    warehouse is a folder of the driver's own.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base is None:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = spark.conf.get("spark.sql.warehouse.dir")
    return base.rstrip("/")


def work_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder for intermediate tables that every executor can reach, see ``shared_base``."""
    return f"{shared_base(spark)}/msgflow/{purpose}-{uuid.uuid4().hex}"


def delete_folder(spark: SparkSession, path: str) -> None:
    """Deletes a folder, if it is there, through Hadoop's file systems."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
