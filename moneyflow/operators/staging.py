"""Intermediate tables in the cluster's shared folder: what several plans read is computed once."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; a temporary folder only where that is unset and the master is local, as in tests."""
    where = spark.conf.get("spark.checkpoint.dir", None)
    if not where:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        where = "file://" + tempfile.mkdtemp(prefix="moneyflow-")
        spark.conf.set("spark.checkpoint.dir", where)
    return where.rstrip("/")


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back; the files go when the driver's JVM ends."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(place)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def in_ranges(df: DataFrame, order: Sequence[Column], name: str = "ranges") -> DataFrame:
    """The rows dealt to ranges of ``order``, numbered by ``__p``: what needs a total order runs range by range."""
    return staged(df.repartitionByRange(*order).withColumn("__p", F.spark_partition_id().cast("long")), name)
