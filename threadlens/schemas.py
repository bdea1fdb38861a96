"""Table schemas, as DDL strings Spark readers take directly."""

from __future__ import annotations

# Raw layer: one JSON object per line. Times are ISO text until they are parsed.
# ``arrival`` is optional: the position in which the source delivered the comment.
RAW_COMMENT = (
    "video_id STRING, comment_id STRING, text STRING, author STRING, like_count BIGINT, "
    "published_at STRING, is_reply BOOLEAN, arrival BIGINT"
)

CLEAN_COMMENT = (
    "video_id STRING, comment_id STRING, author STRING, published_at TIMESTAMP, like_count BIGINT, "
    "is_reply BOOLEAN, text_raw STRING, text_clean STRING, preprocess_version STRING, "
    "processed_at TIMESTAMP, arrival BIGINT"
)

CHANNEL_VIDEO = (
    "video_id STRING, channel_id STRING, title STRING, published_at TIMESTAMP, view_count STRING"
)

COMMENT_PAGE = (
    "items ARRAY<STRUCT<snippet: STRUCT<topLevelComment: STRUCT<id: STRING, snippet: STRUCT<"
    "textOriginal: STRING, textDisplay: STRING, authorDisplayName: STRING, likeCount: BIGINT, "
    "publishedAt: STRING>>>>>, nextPageToken STRING"
)

VIDEO_PAGE = (
    "items ARRAY<STRUCT<id: STRUCT<videoId: STRING>, snippet: STRUCT<title: STRING, "
    "publishedAt: STRING, channelId: STRING>>>, nextPageToken STRING"
)

CHANNEL_RUN = (
    "channel_id STRING, started_at_utc TIMESTAMP, finished_at_utc TIMESTAMP, video_ids ARRAY<STRING>, "
    "video_count BIGINT, comment_count BIGINT, error_count BIGINT, video_limit BIGINT, "
    "comment_limit BIGINT, published_after TIMESTAMP, published_before TIMESTAMP"
)

CHANNEL_REF = "input_ref STRING, channel_id STRING, resolved_at_utc TIMESTAMP"

CORPUS_META = (
    "artifact_version STRING, preprocess_version STRING, config_hash STRING, video_count BIGINT"
)
