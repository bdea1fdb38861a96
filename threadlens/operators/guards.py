"""Checks that stop a job before it mixes incomparable data.

Each check is a distributed query whose result is small (offending groups only); a
strict check looks at a few offenders and raises.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SHOWN = 10


def version_report(comments: DataFrame, grain: Sequence[str] = (), version: str = "preprocess_version") -> DataFrame:
    """Per grain: number of distinct versions, the smallest and largest one, and a verdict."""
    report = comments.groupBy(*grain).agg(
        F.count_distinct(version).alias("versions"),
        F.min(version).alias("lowest"),
        F.max(version).alias("highest"),
    )
    verdict = F.when(F.col("versions") == 0, "missing").when(F.col("versions") > 1, "mixed")
    return report.withColumn("verdict", verdict.otherwise("single"))


def assert_single_version(
    comments: DataFrame, grain: Sequence[str] = (), version: str = "preprocess_version"
) -> None:
    """Every grain must hold exactly one non-null version."""
    bad = version_report(comments, grain, version).where(F.col("verdict") != "single").limit(SHOWN)
    offenders = [row.asDict() for row in bad.collect()]
    if offenders:
        raise ValueError(f"{version} is not the same in every comment: {offenders}")


def single_version(comments: DataFrame, version: str = "preprocess_version") -> str:
    """The one version of the whole input; none or several is an error."""
    row = version_report(comments, (), version).first()
    if row["verdict"] != "single":
        raise ValueError(f"{version} is {row['verdict']}: {row['lowest']!r} to {row['highest']!r}")
    return row["lowest"]


def assert_no_missing_videos(missing: DataFrame) -> None:
    offenders = [tuple(row) for row in missing.limit(SHOWN).collect()]
    if offenders:
        raise FileNotFoundError(f"no clean comments for (channel, video): {offenders}")


def assert_unique(table: DataFrame, key: Sequence[str]) -> None:
    """A stored artifact has at most one row per key."""
    doubled = table.groupBy(*key).count().where(F.col("count") > 1).limit(SHOWN)
    offenders = [row.asDict() for row in doubled.collect()]
    if offenders:
        raise ValueError(f"more than one row per {tuple(key)}: {offenders}")


def lift_mismatches(videos: DataFrame, channels: DataFrame, members: DataFrame) -> DataFrame:
    """Pairs of video and channel artifacts that must not be compared, with the reason.

    ``videos`` names the channel each video is to be compared with, ``members`` holds the
    (channel_id, video_id) pairs the channel artifacts were made from.
    """
    fields = ("artifact_version", "preprocess_version", "config_hash")
    theirs = channels.select(
        "channel_id", F.lit(True).alias("_found"), *[F.col(f).alias(f"_{f}") for f in fields]
    )
    listed = members.select("channel_id", "video_id").distinct().withColumn("_listed", F.lit(True))
    reason = F.when(F.col("_found").isNull(), "no channel artifact")
    for field in fields:
        reason = reason.when(~F.col(field).eqNullSafe(F.col(f"_{field}")), f"{field} differs")
    reason = reason.when(F.col("_listed").isNull(), "video not in channel")
    return (
        videos.select("channel_id", "video_id", *fields)
        .join(theirs, "channel_id", "left")
        .join(listed, ["channel_id", "video_id"], "left")
        .select("channel_id", "video_id", reason.alias("reason"))
        .where(F.col("reason").isNotNull())
    )


def assert_comparable(videos: DataFrame, channels: DataFrame, members: DataFrame) -> None:
    bad = lift_mismatches(videos, channels, members).limit(SHOWN)
    offenders = [row.asDict() for row in bad.collect()]
    if offenders:
        raise ValueError(f"video and channel keywords do not belong together: {offenders}")
