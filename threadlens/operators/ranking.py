"""Top-k rows per group without handing a whole group to one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

# Up to this k Spark itself keeps only k rows per group and map task before the shuffle.
ENGINE_LIMIT = "spark.sql.optimizer.windowGroupLimitThreshold"
SPLITS = 256


def top_per_group(
    rows: DataFrame, group: Sequence[str], order: Sequence[Column], k: int, rank: str = "rank"
) -> DataFrame:
    """First k rows of each group, numbered from 1. ``order`` must be a total order.

    For a k beyond Spark's own pre-shuffle limit a hot group is first cut down in
    hash splits: a row that is not among the first k of its split cannot be among the
    first k of the group, so the result is exact.
    """
    if k > int(rows.sparkSession.conf.get(ENGINE_LIMIT, "1000")):
        split = F.pmod(F.xxhash64(*rows.columns), F.lit(SPLITS))
        within = Window.partitionBy(*group, "_split").orderBy(*order)
        rows = (
            rows.withColumn("_split", split)
            .withColumn("_rank", F.row_number().over(within))
            .where(F.col("_rank") <= k)
            .drop("_split", "_rank")
        )
    window = Window.partitionBy(*group).orderBy(*order)
    return rows.withColumn(rank, F.row_number().over(window)).where(F.col(rank) <= k)


def latest_per_key(rows: DataFrame, key: Sequence[str], newest_first: Sequence[Column]) -> DataFrame:
    """One row per key: the first in the given order."""
    return top_per_group(rows, key, newest_first, 1, rank="_latest").drop("_latest")
