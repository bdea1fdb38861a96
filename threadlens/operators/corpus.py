"""Corpus document frequency: in how many videos does a feature occur."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadlens.config import CORPUS_VERSION, KeywordConfig, corpus_config_hash
from threadlens.operators.features import feature_spread, token_rows


@dataclass(frozen=True)
class Corpus:
    """A tall (token, df_videos) table plus the few facts that make it comparable."""

    tokens: DataFrame
    video_count: int
    preprocess_version: str
    config_hash: str
    artifact_version: str = CORPUS_VERSION

    def require_compatible(self, config: KeywordConfig, preprocess_version: str | None = None) -> None:
        """The corpus must stem from the same feature rules and cleaning version.

        Both grains compare the feature-only hash: a corpus serves any df band or top-k.
        """
        expected = corpus_config_hash(config)
        if self.config_hash != expected:
            raise ValueError(f"corpus has config hash {self.config_hash!r}, the run needs {expected!r}")
        if preprocess_version is not None and self.preprocess_version != preprocess_version:
            raise ValueError(
                f"corpus was built from texts of version {self.preprocess_version!r}, "
                f"the comments have {preprocess_version!r}"
            )

    def with_tokens(self, tokens: DataFrame) -> "Corpus":
        return replace(self, tokens=tokens)


def corpus_df(
    comments: DataFrame, config: KeywordConfig, video: str = "video_id", text: str = "text_clean"
) -> DataFrame:
    """(token, df_videos) over all videos; every feature is kept."""
    return feature_spread(comments, [video], config, text).withColumnRenamed("df", "df_videos")


def corpus_order() -> list[Column]:
    """Most widespread features first, equal ones by name."""
    return [F.col("df_videos").desc(), F.col("token").asc()]


def corpus_df_of(stats: DataFrame) -> DataFrame:
    """(token, df_videos) out of feature counts whose grain is the video: a job that scores
    videos anyway gets its corpus from the same scan."""
    return token_rows(stats).groupBy("token").agg(F.count("*").alias("df_videos"))


def build_corpus(
    comments: DataFrame,
    config: KeywordConfig,
    preprocess_version: str,
    video: str = "video_id",
    text: str = "text_clean",
    stats: DataFrame | None = None,
) -> Corpus:
    """Corpus of a clean layer. A video counts even if none of its comments has a feature.

    ``stats`` may pass in the feature counts by video if the caller has them.
    """
    tokens = corpus_df(comments, config, video, text) if stats is None else corpus_df_of(stats)
    return Corpus(
        tokens=tokens,
        video_count=comments.select(video).distinct().count(),
        preprocess_version=preprocess_version,
        config_hash=corpus_config_hash(config),
    )
