"""Keywords that set one video apart from its channel."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadlens.operators.keywords import RANK_DECIMALS
from threadlens.operators.ranking import top_per_group


def lift(video_score: Column, channel_score: Column) -> Column:
    """Video score over channel score; infinite when the channel list has no such token."""
    return F.when(channel_score == 0, F.lit(float("inf"))).otherwise(
        F.try_divide(video_score, channel_score)
    )


def distinctive_keywords(
    video_keywords: DataFrame,
    channel_keywords: DataFrame,
    top_k: int,
    video: str = "video_id",
    channel: str = "channel_id",
) -> DataFrame:
    """Compares the stored top lists of videos with those of their channels.

    ``video_keywords`` carries the channel of each video. A token missing from the
    channel's *list* has channel score 0 and infinite lift, even if the channel uses it.
    """
    mine = video_keywords.select(
        channel, video, "token", F.col("score").alias("video_score"), F.col("df").alias("video_df")
    )
    theirs = channel_keywords.select(
        channel, "token", F.col("score").alias("_score"), F.col("df").alias("_df")
    )
    rows = mine.join(theirs, [channel, "token"], "left").select(
        channel,
        video,
        "token",
        "video_score",
        F.coalesce("_score", F.lit(0.0)).alias("channel_score"),
        "video_df",
        F.coalesce("_df", F.lit(0).cast("bigint")).alias("channel_df"),
    )
    rows = rows.withColumn("lift", lift(F.col("video_score"), F.col("channel_score")))
    order = [
        F.round("lift", RANK_DECIMALS).desc(),
        F.round("video_score", RANK_DECIMALS).desc(),
        F.col("token").asc(),
    ]
    return top_per_group(rows, [channel, video], order, top_k).select(
        channel, video, "rank", "token", "video_score", "channel_score", "lift", "video_df", "channel_df"
    )
