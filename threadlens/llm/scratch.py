"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session. A local[*] session without one gets a folder of its own."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = tempfile.mkdtemp(prefix="threadlens-shared-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def stored(frame: DataFrame, name: str) -> DataFrame:
    """The frame written as Parquet and read again: its lineage ends there, and a lost executor costs
    no recomputation. The folder's owner removes old tables.

    Shuffle files go when the driver's JVM finds that nothing refers to them any more, so it is
    asked to look now, before the next step writes its own.
    """
    spark = frame.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    frame.write.parquet(path)
    spark.sparkContext._jvm.System.gc()
    return spark.read.schema(frame.schema).parquet(path)
