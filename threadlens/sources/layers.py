"""Tables of the three layers: hash-bucketed folders that can be replaced key by key.

One folder per video or channel would mean millions of tiny files, so rows are placed
in a fixed number of hash buckets of their key. A reader that asks for some keys prunes
to their buckets; a writer that replaces some keys rewrites their buckets only. Spark's
rebalance step splits a bucket that a hot key makes too large into several files.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark import StorageLevel
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BUCKETS = 256
BUCKET = "key_bucket"
COLUMNS = "_columns"  # an empty table inside the folder, which Spark's listing passes over
MODES = ("overwrite", "append", "refuse")


def bucket_of(key: Column) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(BUCKETS)).cast("int")


def folder_of(path: str, key: Column) -> Column:
    """The folder of the table at ``path`` that holds the rows of a key."""
    return F.concat(F.lit(f"{path}/{BUCKET}="), bucket_of(key).cast("string"))


def write_keyed(
    rows: DataFrame, path: str, key: Sequence[str], mode: str = "overwrite", fmt: str = "parquet"
) -> None:
    """Writes rows by key. ``overwrite`` replaces the keys that occur in ``rows`` and keeps all
    others, ``append`` adds, ``refuse`` raises if one of the keys is already stored."""
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, got {mode!r}")
    rows = rows.withColumn(BUCKET, bucket_of(F.col(key[0])))
    stored = _stored(rows.sparkSession, path, fmt, rows.schema)
    if stored is None:
        # A table that starts without rows has no file that tells its columns.
        rows.limit(0).write.mode("overwrite").parquet(f"{path}/{COLUMNS}")
    if stored is None or mode == "append":
        _save(rows, path, key, mode, fmt)
        return
    # The new rows are needed for their keys and for the write: computed once, kept on disk.
    rows = new_rows = rows.persist(StorageLevel.DISK_ONLY)
    try:
        keys = rows.select(BUCKET, *key).distinct()
        if mode == "refuse":
            clash = stored.join(keys, [BUCKET, *key], "left_semi").select(*key).limit(1).collect()
            if clash:
                raise FileExistsError(f"{path} already holds {clash[0].asDict()}")
        else:
            # At most BUCKETS small numbers, whatever the size of the data.
            touched = [row[0] for row in keys.select(BUCKET).distinct().collect()]
            kept = stored.where(F.col(BUCKET).isin(touched)).join(keys, [BUCKET, *key], "left_anti")
            rows = rows.unionByName(kept.select(*rows.columns))
        _save(rows, path, key, mode, fmt)
    finally:
        new_rows.unpersist()


def _save(rows: DataFrame, path: str, key: Sequence[str], mode: str, fmt: str) -> None:
    placed = rows.hint("rebalance", BUCKET).sortWithinPartitions(BUCKET, *key)
    writer = placed.write.partitionBy(BUCKET).format(fmt)
    if mode == "overwrite":
        # New files are staged and swapped in bucket by bucket when the job commits.
        writer = writer.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    else:
        writer = writer.mode("append")
    writer.save(path)


def read_keyed(
    spark: SparkSession,
    path: str,
    key: str,
    values: Iterable[str] | None = None,
    fmt: str = "parquet",
    schema: str | None = None,
) -> DataFrame:
    """The stored rows, or those of some keys. A table that does not exist is an error."""
    table = _stored(spark, path, fmt, schema)
    if table is None:
        raise FileNotFoundError(f"no table at {path}")
    if values is not None:
        wanted = list(values)
        buckets = [bucket_of(F.lit(v)) for v in wanted]
        table = table.where(F.col(BUCKET).isin(*buckets) & F.col(key).isin(*wanted))
    return table.drop(BUCKET)


def _stored(spark: SparkSession, path: str, fmt: str, schema=None) -> DataFrame | None:
    reader = spark.read.format(fmt)
    if schema is not None:
        extra = f", {BUCKET} INT"
        known = isinstance(schema, str) and BUCKET not in schema
        reader = reader.schema(schema + extra if known else schema)
    try:
        return reader.load(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        if error.getCondition() == "UNABLE_TO_INFER_SCHEMA":
            return spark.read.parquet(f"{path}/{COLUMNS}")
        raise
