"""Tables that grow by numbered parts and can be folded while they grow.

    <path>/parts/part=<n>   what micro-batch n added; a replay overwrites it
    <path>/bases/base=<k>   all parts up to k, folded into one
    <path>/folded           a row (base) for every fold that is complete

A reader takes the newest complete base and the parts after it. A fold covers parts that can no longer change: micro-batch n + 1
starts when n is done, so all but the last part. What arrives during a fold has a higher number and stays a part.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _load(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The table at a path, or an empty one. The schema is declared: a part without rows says nothing about it."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def write_part(rows: DataFrame, path: str, number: int) -> None:
    rows.write.mode("overwrite").parquet(f"{path}/parts/part={number}")


def last_fold(spark: SparkSession, path: str) -> int:
    """The highest part number that a complete base holds; -1 without one."""
    return _load(spark, f"{path}/folded", "base BIGINT").agg(F.coalesce(F.max("base"), F.lit(-1))).first()[0]


def read_parts(spark: SparkSession, path: str, schema: str, up_to: int | None = None) -> DataFrame:
    """The rows of the newest base and of all parts after it (or of those up to ``up_to``)."""
    base = last_fold(spark, path)
    rest = _load(spark, f"{path}/parts", f"{schema}, part BIGINT").where(F.col("part") > base)
    if up_to is not None:
        rest = rest.where(F.col("part") <= up_to)
    rest = rest.drop("part")
    return rest if base < 0 else _load(spark, f"{path}/bases/base={base}", schema).unionByName(rest)


def fold_parts(spark: SparkSession, path: str, schema: str, merge: Callable[[DataFrame], DataFrame]) -> int:
    """Merges the newest base and the parts that can no longer change into a new base; returns the highest part it holds.

    Nothing is removed, so readers that started before go on undisturbed. A fold that fails leaves no row in ``folded`` and is
    invisible; the next one overwrites what it left.
    """
    last = _load(spark, f"{path}/parts", f"{schema}, part BIGINT").agg(F.max("part")).first()[0]
    base = last_fold(spark, path)
    if last is None or last - 1 <= base:
        return base
    merge(read_parts(spark, path, schema, last - 1)).write.mode("overwrite").parquet(f"{path}/bases/base={last - 1}")
    spark.createDataFrame([(last - 1,)], "base BIGINT").write.mode("append").parquet(f"{path}/folded")
    return last - 1
