"""Artifact rows: results plus versions, hashes and an echo of the configuration."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadlens.config import (
    KeywordConfig,
    TokenStatsConfig,
    config_hash,
    keyword_config_hash,
    require_utc,
    threshold_text,
)
from threadlens.operators.corpus import Corpus
from threadlens.operators.distinctive import distinctive_keywords
from threadlens.operators.keywords import keyword_summary
from threadlens.operators.stats import token_stats_from
from threadlens.sources.artifacts import explode_keywords


def _created(created_at: datetime | None) -> Column:
    moment = require_utc(created_at or datetime.now(timezone.utc))
    return F.lit(moment).cast("timestamp").alias("created_at_utc")


def config_echo(config: KeywordConfig) -> list[Column]:
    """The whole keyword configuration as columns; thresholds also as text, which keeps a
    count apart from a share."""
    values = {
        "top_k": F.lit(config.top_k).cast("int"),
        "min_token_len": F.lit(config.min_token_len).cast("int"),
        "drop_numeric_tokens": F.lit(config.drop_numeric_tokens),
        "drop_stopwords": F.lit(config.drop_stopwords),
        "stopwords_lang": F.lit(config.stopwords_lang),
        "stopwords_hash": F.lit(config.stopwords_hash),
        "normalization": F.lit(config.normalization),
        "lowercase": F.lit(config.lowercase),
        "min_df": F.lit(float(config.min_df)),
        "max_df": F.lit(float(config.max_df)),
        "min_df_raw": F.lit(threshold_text(config.min_df)),
        "max_df_raw": F.lit(threshold_text(config.max_df)),
        "ngram_min": F.lit(config.ngram_range[0]).cast("bigint"),
        "ngram_max": F.lit(config.ngram_range[1]).cast("bigint"),
        "min_ngram_df": F.lit(config.min_ngram_df).cast("bigint"),
        "tf_mode": F.lit(config.tf_mode),
        "idf_mode": F.lit(config.idf_mode),
    }
    return [value.alias(name) for name, value in values.items()]


def token_stats_artifacts(
    stats: DataFrame,
    grain: Sequence[str],
    config: TokenStatsConfig,
    preprocess_version: str,
    by_arrival: bool = False,
    created_at: datetime | None = None,
) -> DataFrame:
    """Artifact rows of token statistics out of feature counts."""
    rows = token_stats_from(stats, grain, config, by_arrival)
    return rows.select(
        *grain,
        _created(created_at),
        F.lit(preprocess_version).alias("preprocess_version"),
        F.lit(config_hash(config)).alias("config_hash"),
        *[c for c in rows.columns if c not in grain],
    )


def keyword_artifacts(
    stats: DataFrame,
    grain: Sequence[str],
    config: KeywordConfig,
    preprocess_version: str,
    corpus: Corpus | None = None,
    drop_sentiment: bool = True,
    created_at: datetime | None = None,
) -> DataFrame:
    """Artifact rows of keywords out of feature counts."""
    if corpus is not None:
        corpus.require_compatible(config, preprocess_version)
    rows = keyword_summary(stats, grain, config, corpus, drop_sentiment)
    return rows.select(
        *grain,
        _created(created_at),
        F.lit(preprocess_version).alias("preprocess_version"),
        F.lit(keyword_config_hash(config)).alias("config_hash"),
        *config_echo(config),
        *[c for c in rows.columns if c not in grain],
    )


def distinctive_artifacts(
    videos: DataFrame, channels: DataFrame, config: KeywordConfig, created_at: datetime | None = None
) -> DataFrame:
    """One row per (channel, video) from stored keyword artifacts; ``videos`` knows its channel."""
    keys = ["channel_id", "video_id"]
    ranked = distinctive_keywords(
        explode_keywords(videos, *keys), explode_keywords(channels, "channel_id"), config.top_k
    )
    fields = ("token", "video_score", "channel_score", "lift", "video_df", "channel_df")
    lists = ranked.groupBy(*keys).agg(
        F.sort_array(F.collect_list(F.struct("rank", *fields))).alias("_ranked")
    )
    keywords = F.transform("_ranked", lambda k: F.struct(*[k[f].alias(f) for f in fields]))
    none = F.array().cast(
        "array<struct<token:string,video_score:double,channel_score:double,lift:double,"
        "video_df:bigint,channel_df:bigint>>"
    )
    return videos.join(lists, keys, "left").select(
        *keys,
        _created(created_at),
        "preprocess_version",
        "artifact_version",
        "config_hash",
        *config_echo(config),
        F.coalesce(F.size("_ranked"), F.lit(0)).cast("bigint").alias("keyword_count"),
        F.coalesce(keywords, none).alias("keywords"),
    )
