"""Session settings the jobs are written for, and shipping of this package to executors."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}

#: Session setting, unset by default: the number of partitions that texts are dealt to after they are read. Spark cannot split
#: a Parquet row group, so a table that was written as one (small tables are) is otherwise read and tokenised by one core. Tables of
#: many files need no such shuffle.
INPUT_PARTITIONS = "spark.threadlens.inputPartitions"

_SHIPPED: set[str] = set()


def spread_input(rows: DataFrame) -> DataFrame:
    """The rows dealt to as many partitions as ``INPUT_PARTITIONS`` names; unchanged where it is unset."""
    partitions = rows.sparkSession.conf.get(INPUT_PARTITIONS, None)
    return rows if partitions is None else rows.repartition(int(partitions))


def ship_package(spark: SparkSession) -> SparkSession:
    """Gives the session's Python workers this package, which the Arrow functions import."""
    app = spark.sparkContext.applicationId
    if app not in _SHIPPED:
        root = Path(__file__).resolve().parent
        archive = Path(tempfile.mkdtemp(prefix="threadlens-")) / "threadlens.zip"
        with zipfile.ZipFile(archive, "w") as out:
            for source in sorted(root.rglob("*.py")):
                out.write(source, source.relative_to(root.parent))
        spark.sparkContext.addPyFile(str(archive))
        _SHIPPED.add(app)
    return spark


def local_session(cores: int | str = "*", memory: str = "8g", **extra: str) -> SparkSession:
    """A single-machine session for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("threadlens")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", "8")
        .config(INPUT_PARTITIONS, str(os.cpu_count() if cores == "*" else cores))
    )
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return ship_package(spark)
