"""Channels: membership, discovery, comment caps, run summaries and reference lookup."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadlens.functions.refs import with_channel_ref, with_video_id
from threadlens.operators.features import roll_up
from threadlens.operators.ranking import latest_per_key, top_per_group


def channel_members(runs: DataFrame) -> DataFrame:
    """Distinct (channel_id, video_id) of run records."""
    return runs.select("channel_id", F.explode("video_ids").alias("video_id")).distinct()


def channel_comments(comments: DataFrame, members: DataFrame) -> DataFrame:
    """Comments of the member videos, with their channel. A video listed twice is read once."""
    return comments.join(members.select("channel_id", "video_id").distinct(), "video_id")


def channel_stats(video_stats: DataFrame, members: DataFrame) -> DataFrame:
    """Feature counts by channel out of feature counts by video. Only counted rows meet the
    membership table; the comment texts are neither joined nor shuffled."""
    listed = members.select("channel_id", "video_id").distinct()
    return roll_up(video_stats.join(listed, "video_id"), ["channel_id"])


def missing_videos(members: DataFrame, comments: DataFrame) -> DataFrame:
    """Member videos without any clean comment."""
    wanted = members.select("channel_id", "video_id").distinct()
    return wanted.join(comments.select("video_id").distinct(), "video_id", "left_anti").select(
        "channel_id", "video_id"
    )


def cap_comments(comments: DataFrame, limit: int | None) -> DataFrame:
    """First comments of each video in arrival order (page, item). A cap of 0 keeps one.

    Only videos above the cap are ranked, and only by their keys: the place of the last
    comment to keep is found per video, and the comments are filtered by it. The texts
    take part in no window; they are shuffled only if the table of places is too large
    for Spark to broadcast.
    """
    if limit is None:
        return comments
    limit = max(limit, 1)
    place = ["page_no", "item_no", "comment_id"]
    keys = comments.select("video_id", *place)
    above = keys.groupBy("video_id").count().where(F.col("count") > limit)
    ranked = top_per_group(
        keys.join(above, "video_id", "left_semi"), ["video_id"], [F.col(c).asc() for c in place], limit
    )
    last = ranked.where(F.col("rank") == limit).select("video_id", F.struct(*place).alias("_last"))
    kept = F.col("_last").isNull() | (F.struct(*place) <= F.col("_last"))
    return comments.join(last, "video_id", "left").where(kept).select(*comments.columns)


def discover_videos(
    videos: DataFrame,
    limit: int | None = None,
    published_after: datetime | None = None,
    published_before: datetime | None = None,
) -> DataFrame:
    """Newest videos of each channel inside an inclusive time window."""
    inside = videos
    if published_after is not None:
        inside = inside.where(F.col("published_at") >= F.lit(published_after))
    if published_before is not None:
        inside = inside.where(F.col("published_at") <= F.lit(published_before))
    if limit is None:
        return inside
    order = [F.col("published_at").desc(), F.col("video_id").asc()]
    return top_per_group(inside, ["channel_id"], order, limit, rank="_nth").drop("_nth")


def summarize_run(video_status: DataFrame, list_videos: bool = True) -> DataFrame:
    """Per channel: videos found, comments saved, errors, and the ids that succeeded.

    ``video_status`` has channel_id, video_id, comment_count and error (NULL if fine).
    The id list holds the videos of one run, which the run's video limit bounds.
    """
    fine = F.col("error").isNull()
    ids = F.sort_array(F.collect_list(F.when(fine, F.col("video_id")))).alias("video_ids")
    return video_status.groupBy("channel_id").agg(
        *([ids] if list_videos else []),
        F.count("*").alias("video_count"),
        F.coalesce(F.sum(F.when(fine, F.col("comment_count"))), F.lit(0)).alias("comment_count"),
        F.count_if(~fine).alias("error_count"),
    )


def preprocess_totals(video_status: DataFrame) -> DataFrame:
    """Per channel: videos, processed videos, errors, and the exit code of the batch."""
    totals = summarize_run(video_status, list_videos=False)
    return totals.select(
        "channel_id",
        "video_count",
        (F.col("video_count") - F.col("error_count")).alias("processed_count"),
        "error_count",
        F.when(F.col("error_count") > 0, 1).otherwise(0).cast("bigint").alias("exit_code"),
    )


def latest_runs(runs: DataFrame) -> DataFrame:
    """Latest run record of each channel; of records with equal times, the greatest by its other columns."""
    rest = F.to_json(F.struct("*"))
    return latest_per_key(
        runs, ["channel_id"], [F.col("finished_at_utc").desc(), F.col("started_at_utc").desc(), rest.desc()]
    )


def normalize_video_refs(refs: DataFrame, ref: str) -> DataFrame:
    """Adds ``video_id``."""
    return with_video_id(refs, ref)


def normalize_channel_refs(refs: DataFrame, ref: str) -> DataFrame:
    """Adds ``kind``, ``value`` and the lookup key ``input_ref``; all NULL for an unknown form."""
    return with_channel_ref(refs, ref)


def upsert_channel_refs(mapping: DataFrame, resolved: DataFrame, ref: str = "raw_ref") -> DataFrame:
    """The mapping with new resolutions merged in by key; the last write wins.

    References are stored as they were typed and normalised here, so every form works.
    """
    new = with_channel_ref(resolved.select(ref, "channel_id", "resolved_at_utc"), ref)
    new = new.where(F.col("input_ref").isNotNull()).select("input_ref", "channel_id", "resolved_at_utc")
    both = mapping.select("input_ref", "channel_id", "resolved_at_utc").withColumn(
        "_new", F.lit(0)
    ).unionByName(new.withColumn("_new", F.lit(1)))
    newest = [
        F.col("resolved_at_utc").desc(),
        F.col("_new").desc(),
        F.col("channel_id").asc(),
    ]
    return latest_per_key(both, ["input_ref"], newest).drop("_new")


def resolve_channel_refs(refs: DataFrame, mapping: DataFrame, ref: str = "raw_ref") -> DataFrame:
    """Adds ``channel_id`` from the mapping, or the reference itself when it is unknown,
    and says which happened in ``resolved``."""
    known = mapping.select("input_ref", F.col("channel_id").alias("_known"))
    return (
        with_channel_ref(refs, ref)
        .join(known, "input_ref", "left")
        .withColumn("channel_id", F.coalesce("_known", F.col(ref)))
        .withColumn("resolved", F.col("_known").isNotNull())
        .drop("_known", "kind", "value", "input_ref")
    )
