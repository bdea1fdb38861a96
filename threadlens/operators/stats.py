"""Token frequencies and token statistics per video, channel or any other grain."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadlens.config import TokenRules, TokenStatsConfig
from threadlens.operators.features import feature_stats, grain_totals, token_rows
from threadlens.operators.ranking import top_per_group


def token_counts(
    comments: DataFrame, grain: Sequence[str], rules: TokenRules, text: str = "text_clean"
) -> DataFrame:
    """Occurrences of each token in each grain: (grain, token, count)."""
    stats = feature_stats(comments, grain, rules, text, weights=False)
    return token_rows(stats).select(*grain, "token", F.col("n").alias("count"))


def token_grouping_sets(
    comments: DataFrame, video: str, channel: str, rules: TokenRules, text: str = "text_clean"
) -> DataFrame:
    """Token counts of every video, every channel and the whole layer from one scan.

    The grouping sets run over the (channel, video, token) counts and not over the
    tokens, so the threefold expansion happens after aggregation.
    """
    counts = token_counts(comments, [channel, video], rules, text)
    sets = [["token", video], ["token", channel], ["token"]]
    keys = [F.col("token"), F.col(video), F.col(channel)]
    rolled = counts.groupingSets([[F.col(c) for c in s] for s in sets], *keys).agg(
        F.sum("count").alias("count"), F.grouping_id().alias("_set")
    )
    level = F.when(F.col("_set") == 1, "video").when(F.col("_set") == 2, "channel").otherwise("all")
    key = F.when(F.col("_set") == 1, F.col(video)).when(F.col("_set") == 2, F.col(channel))
    return rolled.select(level.alias("level"), key.alias("key"), "token", "count")


def _top_token_order(by_arrival: bool) -> list[Column]:
    ties = ["first_arrival", "first_position", "token"] if by_arrival else ["token"]
    return [F.col("count").desc(), *[F.col(c).asc() for c in ties]]


def top_tokens(
    stats: DataFrame, grain: Sequence[str], top_n: int, by_arrival: bool = False
) -> DataFrame:
    """The most frequent tokens per grain: (grain, rank, token, count).

    Ties go to the token seen first (``by_arrival``) or to the smaller token.
    """
    rows = token_rows(stats).withColumnRenamed("n", "count")
    ranked = top_per_group(rows, grain, _top_token_order(by_arrival), top_n)
    return ranked.select(*grain, "rank", "token", "count")


def token_stats_from(
    stats: DataFrame, grain: Sequence[str], config: TokenStatsConfig, by_arrival: bool = False
) -> DataFrame:
    """One row per grain out of ready feature counts."""
    keys = list(grain)
    totals = grain_totals(stats, keys).select(
        *keys, "row_count", F.col("blank_text_count").alias("empty_text_count")
    )
    sizes = token_rows(stats).groupBy(*keys).agg(
        F.sum("n").alias("total_token_count"), F.count("*").alias("unique_token_count")
    )
    top = top_tokens(stats, keys, config.top_n_tokens, by_arrival).groupBy(*keys).agg(
        F.sort_array(F.collect_list(F.struct("rank", "token", "count"))).alias("_ranked")
    )
    tokens = F.transform("_ranked", lambda t: F.struct(t["token"].alias("token"), t["count"].alias("count")))
    none = F.array().cast("array<struct<token:string,count:bigint>>")
    # Left joins from the totals: a grain whose comments hold no token still gets its row.
    return (
        totals.join(sizes, keys, "left")
        .join(top, keys, "left")
        .select(
            *keys,
            "row_count",
            "empty_text_count",
            F.coalesce("total_token_count", F.lit(0)).alias("total_token_count"),
            F.coalesce("unique_token_count", F.lit(0)).alias("unique_token_count"),
            F.coalesce(tokens, none).alias("top_tokens"),
        )
    )


def token_stats(
    comments: DataFrame,
    grain: Sequence[str],
    config: TokenStatsConfig,
    text: str = "text_clean",
    arrival: str | None = None,
) -> DataFrame:
    """Rows, blank rows, tokens, distinct tokens and top tokens of each grain.

    With ``arrival`` equal counts are ordered by first appearance (the rule for a
    video), without it by token (the rule for a channel).
    """
    stats = feature_stats(comments, grain, config, text, arrival, weights=False)
    return token_stats_from(stats, grain, config, by_arrival=arrival is not None)

