"""Landed API pages: nested JSON to flat comment and video rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadlens.functions.times import parse_utc
from threadlens.schemas import COMMENT_PAGE, VIDEO_PAGE

_BAD = ", _bad STRING"
_OPTIONS = {"columnNameOfCorruptRecord": "_bad"}


def _nonempty(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def _items(pages: DataFrame, keys: list[str], schema: str, payload: str) -> DataFrame:
    """One row per item; a page that is no JSON gives one row with ``_bad``."""
    parsed = pages.select(*keys, F.from_json(payload, schema + _BAD, _OPTIONS).alias("_page"))
    exploded = parsed.select(
        *keys, F.col("_page._bad").alias("_bad"), F.posexplode_outer("_page.items").alias("item_no", "_item")
    )
    return exploded.where(F.col("item_no").isNotNull() | F.col("_bad").isNotNull())


def flatten_comment_pages(pages: DataFrame, payload: str = "payload") -> DataFrame:
    """Comments of comment-thread pages (video_id, page_no, payload), with ``_reason`` for
    items that are no valid comment. An empty original text falls through to the shown one.
    """
    snippet = F.col("_item.snippet.topLevelComment.snippet")
    comment_id = _nonempty(F.col("_item.snippet.topLevelComment.id"))
    published = _nonempty(snippet["publishedAt"])
    reason = (
        F.when(F.col("_bad").isNotNull(), "unreadable page")
        .when(comment_id.isNull(), "comment without an id")
        .when(published.isNotNull() & parse_utc(published).isNull(), "unreadable publishedAt")
    )
    return _items(pages, ["video_id", "page_no"], COMMENT_PAGE, payload).select(
        "video_id",
        comment_id.alias("comment_id"),
        F.coalesce(
            _nonempty(snippet["textOriginal"]), _nonempty(snippet["textDisplay"]), F.lit("")
        ).alias("text"),
        snippet["authorDisplayName"].alias("author"),
        snippet["likeCount"].alias("like_count"),
        parse_utc(published).alias("published_at"),
        F.lit(False).alias("is_reply"),
        F.col("page_no").cast("bigint").alias("page_no"),
        F.col("item_no").cast("bigint").alias("item_no"),
        reason.alias("_reason"),
    )


def flatten_video_pages(pages: DataFrame, payload: str = "payload") -> DataFrame:
    """Videos of video-search pages (channel_id, page_no, payload), with ``_reason`` for
    items without an id or a time, or of a channel other than the one asked for."""
    video_id = _nonempty(F.col("_item.id.videoId"))
    snippet = F.col("_item.snippet")
    published = _nonempty(snippet["publishedAt"])
    reason = (
        F.when(F.col("_bad").isNotNull(), "unreadable page")
        .when(video_id.isNull(), "video without an id")
        .when(published.isNull(), "video without publishedAt")
        .when(parse_utc(published).isNull(), "unreadable publishedAt")
        .when(~snippet["channelId"].eqNullSafe(F.col("channel_id")), "video of another channel")
    )
    return _items(pages, ["channel_id", "page_no"], VIDEO_PAGE, payload).select(
        video_id.alias("video_id"),
        "channel_id",
        F.coalesce(snippet["title"], F.lit("")).alias("title"),
        parse_utc(published).alias("published_at"),
        F.lit(None).cast("string").alias("view_count"),
        reason.alias("_reason"),
    )


def strict(rows: DataFrame) -> DataFrame:
    """Fails while reading if any row carries a reason; no second pass over the pages."""
    complaint = F.concat_ws(" ", F.lit("invalid page item:"), "_reason")
    valid = F.when(F.col("_reason").isNull(), F.lit(True)).otherwise(
        F.raise_error(complaint).cast("boolean")
    )
    return rows.where(valid).drop("_reason")


def quarantine(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid rows, rejected rows with their reason)."""
    good = rows.where(F.col("_reason").isNull()).drop("_reason")
    return good, rows.where(F.col("_reason").isNotNull())
