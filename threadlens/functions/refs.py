"""Video and channel references (ids, handles, URLs) normalised row by row, without UDFs.

The functions add their intermediate results as columns, so every pattern runs once per
row: Spark keeps a projection apart when its results are used more than once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadlens.functions.plan import computed_once
from threadlens.functions.text import SPACES

# The reference forms and hosts of the contract.
CHANNEL_ID_PATTERN = r"^UC[a-zA-Z0-9_-]{22}$"
HANDLE_PATTERN = r"^@[a-zA-Z0-9._-]{3,30}$"
CHANNEL_HOSTS = (
    "youtube.com",
    "www.youtube.com",
    "m.youtube.com",
    "youtube-nocookie.com",
    "www.youtube-nocookie.com",
)
SHORT_LINK_HOST = "youtu.be"

# The generic URI pattern of RFC 3986, appendix B: scheme, authority, path, query.
URI_PATTERN = r"^(?:([a-zA-Z][a-zA-Z0-9+.-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?"


def _trimmed(ref: Column) -> Column:
    return F.regexp_replace(ref, f"^[{SPACES}]+|[{SPACES}]+$", "")


def _with_uri_parts(refs: DataFrame, ref: str) -> DataFrame:
    """Adds the trimmed reference and, for URLs only, authority, path and query."""
    is_url = F.col("_value").contains("://")

    def part(group: int) -> Column:
        return F.when(is_url, F.regexp_extract("_value", URI_PATTERN, group))

    return refs.withColumn("_value", _trimmed(F.col(ref))).select(
        "*",
        F.lower(part(2)).alias("_authority"),
        F.regexp_replace(part(3), ";[^/]*$", "").alias("_path"),
        part(4).alias("_query"),
    )


def with_video_id(refs: DataFrame, ref: str, out: str = "video_id") -> DataFrame:
    """Adds the video id of a reference; what is no known URL form stays as it is, trimmed."""
    value, authority, path = F.col("_value"), F.col("_authority"), F.col("_path")
    parts = _with_uri_parts(refs, ref).withColumn(
        "_watched", F.when(path == "/watch", F.regexp_extract("_query", "(?:^|&)v=([^&]+)", 1))
    )
    video = (
        F.when(authority.isNull(), value)
        .when(authority.endswith(SHORT_LINK_HOST), F.regexp_extract(path, "^/*([^/]*)", 1))
        .when(F.col("_watched") != "", F.coalesce(F.try_url_decode("_watched"), "_watched"))
        .when(
            path.rlike("^/(?:shorts|embed)/"), F.regexp_extract(path, "^/(?:shorts|embed)/([^/]*)", 1)
        )
        .otherwise(value)
    )
    return parts.withColumn(out, video).select(*refs.columns, out)


def with_channel_ref(refs: DataFrame, ref: str) -> DataFrame:
    """Adds ``kind`` (channel_id, handle, username), ``value`` and the lookup key
    ``input_ref`` (names in lower case); all three are NULL for an unknown form."""
    value, first, second = F.col("_value"), F.col("_first"), F.col("_second")
    on_site = value.rlike("^https?://") & F.col("_authority").isin(*CHANNEL_HOSTS)
    steps = F.filter(F.split(F.when(on_site, F.col("_path")), "/"), lambda step: step != "")
    parts = (
        _with_uri_parts(refs, ref)
        .withColumn("_steps", steps)
        .withColumn("_first", F.get("_steps", F.lit(0)))
        .withColumn("_second", F.get("_steps", F.lit(1)))
    )

    def found(kind: str, text: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), text.alias("value"))

    user = _trimmed(second)
    parsed = (
        F.when(value.rlike(CHANNEL_ID_PATTERN), found("channel_id", value))
        .when(value.rlike(HANDLE_PATTERN), found("handle", value))
        .when((first == "channel") & second.rlike(CHANNEL_ID_PATTERN), found("channel_id", second))
        .when(first.rlike(HANDLE_PATTERN), found("handle", first))
        .when((first == "user") & (user != ""), found("username", user))
    )
    key = F.when(F.col("kind") == "channel_id", F.col("value")).otherwise(F.lower("value"))
    parts = computed_once(
        parts.withColumn("_parsed", parsed), kind=F.col("_parsed.kind"), value=F.col("_parsed.value")
    )
    return parts.withColumn("input_ref", key).select(*refs.columns, "kind", "value", "input_ref")
