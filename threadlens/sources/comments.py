"""Raw and clean comment layers."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from threadlens.functions.plan import computed_once
from threadlens.functions.times import iso_utc, parse_utc
from threadlens.schemas import CLEAN_COMMENT, RAW_COMMENT
from threadlens.sources.layers import read_keyed, write_keyed

REQUIRED = ("video_id", "comment_id", "text")


def _known_fields() -> list[str]:
    return [part.split()[0] for part in RAW_COMMENT.split(", ")]


def parse_raw_lines(lines: DataFrame, line: str = "value", origin: str = "origin") -> DataFrame:
    """JSON lines to raw comments plus ``_reason``: why a line is no valid record, or NULL.

    Blank lines are skipped. Unknown fields count as errors, like missing ones.
    """
    record = F.from_json(line, RAW_COMMENT + ", _bad STRING", {"columnNameOfCorruptRecord": "_bad"})
    parsed = computed_once(
        lines.where(~F.col(line).rlike(r"^\s*$")).select(origin, line),
        _keys=F.json_object_keys(line),
        _record=record,
    )
    unknown = F.array_except("_keys", F.array(*[F.lit(f) for f in _known_fields()]))
    absent = F.filter(
        F.array(*[F.when(F.col(f"_record.{f}").isNull(), F.lit(f)) for f in REQUIRED]),
        lambda name: name.isNotNull(),
    )
    published = F.col("_record.published_at")
    reason = (
        F.when(F.col("_keys").isNull() | F.col("_record._bad").isNotNull(), "not a JSON comment record")
        .when(F.size(absent) > 0, F.concat(F.lit("missing: "), F.array_join(absent, ", ")))
        .when(F.size(unknown) > 0, F.concat(F.lit("unknown: "), F.array_join(unknown, ", ")))
        .when(published.isNotNull() & parse_utc(published).isNull(), "unreadable published_at")
    )
    return parsed.select(
        F.col(origin),
        F.col(line),
        *[F.col(f"_record.{f}").alias(f) for f in _known_fields() if f != "published_at"],
        parse_utc(published).alias("published_at"),
        reason.alias("_reason"),
    ).withColumn("is_reply", F.coalesce("is_reply", F.lit(False)))


def _raw_lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Lines with their file, the start of their block of the file, and an id that grows inside a block."""
    try:
        lines = spark.read.option("recursiveFileLookup", "true").text(paths)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], "value STRING, origin STRING, _start BIGINT, _id BIGINT")
    return lines.select(
        "value",
        F.col("_metadata.file_path").alias("origin"),
        F.col("_metadata.file_block_start").alias("_start"),
        F.monotonically_increasing_id().alias("_id"),
    )


def line_numbers(lines: DataFrame) -> DataFrame:
    """Adds ``_order``: the place of a line among all lines of its folder, files in order of their names.

    A prefix sum over blocks: a first pass counts the lines of every block (one small row per block), the sum of all
    blocks before it is added to a line's place in its own. So the number does not depend on how files are
    split and packed into partitions. The first pass reads no columns and parses nothing, but it reads the files.
    """
    folder = F.regexp_replace("origin", "/[^/]*$", "")
    before = Window.partitionBy("_folder").orderBy("origin", "_start").rowsBetween(Window.unboundedPreceding, -1)
    blocks = (
        lines.groupBy("origin", "_start")
        .agg(F.count("*").alias("_lines"), F.min("_id").alias("_first"))
        .withColumn("_folder", folder)
        .select("origin", "_start", (F.coalesce(F.sum("_lines").over(before), F.lit(0)) - F.col("_first")).alias("_shift"))
    )
    return lines.join(blocks, ["origin", "_start"]).withColumn("_order", F.col("_id") + F.col("_shift")).drop("_start", "_shift", "_id")


def read_raw_comments(spark: SparkSession, paths: str | list[str], number_lines: bool = True) -> DataFrame:
    """Raw comments; reading a bad line fails and names its file. A missing path is empty.

    The check is a filter of the same scan, so strictness costs no second pass. ``arrival`` is the record's own, or
    else its line number (see ``line_numbers``); without ``number_lines`` it is left null and the files are read once.
    """
    parsed = parsed_files(spark, paths, number_lines)
    complaint = F.concat_ws(" ", F.lit("invalid comment record:"), "_reason", F.lit("in"), "origin", "value")
    valid = F.when(F.col("_reason").isNull(), F.lit(True)).otherwise(
        F.raise_error(complaint).cast("boolean")
    )
    return parsed.where(valid).drop("origin", "value", "_reason")


def read_raw_comments_leniently(
    spark: SparkSession, paths: str | list[str], number_lines: bool = True, parsed: DataFrame | None = None
) -> tuple[DataFrame, DataFrame]:
    """(valid comments, rejected lines with file and reason).

    ``parsed`` may pass in the ``parsed_files`` of the paths if the caller keeps them, so that both results share one pass.
    """
    parsed = parsed_files(spark, paths, number_lines) if parsed is None else parsed
    good = parsed.where(F.col("_reason").isNull()).drop("origin", "value", "_reason")
    bad = parsed.where(F.col("_reason").isNotNull()).select(
        "origin", F.col("value").alias("line"), F.col("_reason").alias("reason")
    )
    return good, bad


def parsed_files(spark: SparkSession, paths: str | list[str], number_lines: bool = True) -> DataFrame:
    """``parse_raw_lines`` of files with ``arrival``. Only rejected lines keep ``origin`` and ``value``: a valid one is whole in
    its fields, so rows that are stored do not hold it twice."""
    lines = _raw_lines(spark, paths)
    lines = line_numbers(lines) if number_lines else lines.withColumn("_order", F.lit(None).cast("bigint"))
    lines = lines.withColumn("origin", F.struct("origin", "_order")).select("origin", "value")
    rejected = F.col("_reason").isNotNull()
    return parse_raw_lines(lines).withColumns(
        {
            "arrival": F.coalesce("arrival", F.col("origin._order")),
            "origin": F.when(rejected, F.col("origin.origin")),
            "value": F.when(rejected, F.col("value")),
        }
    )


def write_raw_comments(comments: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Raw layer as JSON lines with ISO times."""
    columns = [c for c in _known_fields() if c in comments.columns]
    rows = comments.select(*columns)
    if isinstance(rows.schema["published_at"].dataType, T.TimestampType):
        rows = rows.withColumn("published_at", iso_utc(F.col("published_at")))
    # The key is a field of the JSON record, the bucket only a folder name.
    write_keyed(rows, path, ["video_id"], mode, fmt="json")


def write_clean_comments(comments: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Clean layer as Parquet; ``refuse`` raises instead of replacing a video."""
    columns = [part.split()[0] for part in CLEAN_COMMENT.split(", ")]
    write_keyed(comments.select(*columns), path, ["video_id"], mode)


def read_clean_comments(
    spark: SparkSession, path: str, videos: Iterable[str] | None = None
) -> DataFrame:
    """The clean layer or some of its videos; a missing layer or video is an error."""
    comments = read_keyed(spark, path, "video_id", videos)
    if videos is not None:
        wanted = spark.createDataFrame([(v,) for v in set(videos)], "video_id STRING")
        absent = wanted.join(comments.select("video_id").distinct(), "video_id", "left_anti")
        names = [row[0] for row in absent.limit(10).collect()]
        if names:
            raise FileNotFoundError(f"no clean comments of {names} at {path}")
    return comments
