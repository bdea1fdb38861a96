"""Raw comments to clean comments: one projection, no shuffle."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadlens.config import PREPROCESS_VERSION
from threadlens.functions.text import URL_MARK, clean_text
from threadlens.functions.times import parse_utc


def clean_comments(
    raw: DataFrame, processed_at: datetime | None = None, url_mark: str = URL_MARK
) -> DataFrame:
    """The clean layer's columns. Missing author, likes and time get neutral values;
    all rows of a run carry the same ``processed_at``. Works on batch and streaming input."""
    processed_at = processed_at or datetime.now(timezone.utc)
    published = F.col("published_at")
    if dict(raw.dtypes)["published_at"] == "string":
        published = parse_utc(published)
    arrival = F.col("arrival") if "arrival" in raw.columns else F.lit(None).cast("bigint")
    return raw.select(
        "video_id",
        "comment_id",
        F.coalesce("author", F.lit("")).alias("author"),
        F.coalesce(published, F.timestamp_micros(F.lit(0))).alias("published_at"),
        F.coalesce("like_count", F.lit(0)).cast("bigint").alias("like_count"),
        F.coalesce("is_reply", F.lit(False)).alias("is_reply"),
        F.col("text").alias("text_raw"),
        clean_text(F.col("text"), url_mark).alias("text_clean"),
        F.lit(PREPROCESS_VERSION).alias("preprocess_version"),
        F.lit(processed_at).cast("timestamp").alias("processed_at"),
        arrival.alias("arrival"),
    )
