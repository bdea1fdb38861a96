"""Incremental upkeep with Structured Streaming.

Cleaning is stateless. Feature counts are sums, so each micro-batch writes its own
partial counts and a reader adds the parts up: no growing state store, no rewriting of
the table, and a replayed batch overwrites its own part. The sums equal those of a
batch job over the same comments exactly, because they are integers.

A comment that a source delivers again would count again: ``first_deliveries`` drops it, by
state that is kept for a stated time. Document frequencies need the first sight of a (video, token) pair
for good, so that state has no time limit; it is spread over the state store's partitions by the hash of the pair.
"""

from __future__ import annotations

import json
import zlib
from collections import defaultdict
from collections.abc import Callable, Iterator, Sequence
from typing import Any

import pandas as pd
from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from threadlens.config import KeywordConfig, TokenRules
from threadlens.functions.counts import SEPARATOR, list_counts
from threadlens.operators.cleaning import clean_comments
from threadlens.operators.corpus import corpus_df_of
from threadlens.operators.features import feature_lists, feature_stats, roll_up
from threadlens.schemas import CHANNEL_RUN, CLEAN_COMMENT, RAW_COMMENT
from threadlens.sources import parts
from threadlens.sources.comments import parse_raw_lines


def stream_raw_comments(spark: SparkSession, path: str) -> DataFrame:
    """Raw comment files as they land, all lines taken for valid; see ``write_checked_stream`` for others."""
    return spark.readStream.schema(RAW_COMMENT).option("recursiveFileLookup", "true").json(path)


def stream_deliveries(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """Raw comment files as they land, with ``delivered_at``: when their file was written."""
    reader = spark.readStream.schema(RAW_COMMENT).option("recursiveFileLookup", "true")
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.json(path).withColumn("delivered_at", F.col("_metadata.file_modification_time"))


def first_deliveries(
    comments: DataFrame, within: str = "30 days", key: Sequence[str] = ("video_id", "comment_id"), time: str = "delivered_at"
) -> DataFrame:
    """The stream without comments that it delivered before, no longer than ``within`` ago.

    The watermark follows the time of delivery and not that of publication: an old comment that is delivered for the first
    time is no late row. State is kept per comment for ``within``; a comment that comes again after that counts again.
    """
    return comments.withWatermark(time, within).dropDuplicatesWithinWatermark(list(key))


def stream_raw_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of raw comment files as they land, with their file."""
    lines = spark.readStream.option("recursiveFileLookup", "true").text(path)
    return lines.select("value", F.col("_metadata.file_path").alias("origin"))


def write_checked_stream(lines: DataFrame, path: str, rejected: str, checkpoint: str) -> DataStreamWriter:
    """Valid lines to clean Parquet files, all others to ``rejected`` with file and reason.

    Each micro-batch is one part of both tables and is parsed once; a replay overwrites its own part.
    """

    def add_part(batch: DataFrame, batch_id: int) -> None:
        parsed = parse_raw_lines(batch).persist(StorageLevel.DISK_ONLY)
        try:
            add(parsed, batch_id)
        finally:
            parsed.unpersist()

    def add(parsed: DataFrame, batch_id: int) -> None:
        good = parsed.where(F.col("_reason").isNull()).drop("origin", "value", "_reason")
        bad = parsed.where(F.col("_reason").isNotNull())
        bad = bad.select("origin", F.col("value").alias("line"), F.col("_reason").alias("reason"))
        clean_comments(good).write.mode("overwrite").parquet(f"{path}/part={batch_id}")
        bad.write.mode("overwrite").parquet(f"{rejected}/part={batch_id}")

    return lines.writeStream.foreachBatch(add_part).option("checkpointLocation", checkpoint)


def stream_clean_comments(spark: SparkSession, path: str) -> DataFrame:
    return spark.readStream.schema(CLEAN_COMMENT).parquet(path)


def write_clean_stream(raw: DataFrame, path: str, checkpoint: str) -> DataStreamWriter:
    """Raw stream to clean Parquet files, exactly once."""
    return (
        clean_comments(raw)
        .writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )


def running_token_counts(
    comments: DataFrame, grain: Sequence[str], rules: TokenRules, text: str = "text_clean"
) -> DataFrame:
    """Token counts of a stream, for output modes update and complete. The state holds one
    row per (grain, token); for large vocabularies prefer ``write_feature_parts``."""
    stats = feature_stats(comments, grain, rules, text, weights=False)
    return stats.select(*grain, "token", F.col("n").alias("count"), "df").where(F.col("token").isNotNull())


def feature_part_schema(grain: Sequence[str]) -> str:
    """Columns of a table of feature counts."""
    counts = "token STRING, docs BIGINT, blank BIGINT, df BIGINT, n BIGINT, w2 BIGINT, w1 BIGINT, w0 BIGINT"
    return ", ".join([f"{c} STRING" for c in grain] + [counts])


def write_feature_parts(
    comments: DataFrame,
    grain: Sequence[str],
    rules: TokenRules,
    path: str,
    checkpoint: str,
    text: str = "text_clean",
) -> DataStreamWriter:
    """Each micro-batch adds its partial feature counts as one part of the table at ``path``."""

    def add_part(batch: DataFrame, batch_id: int) -> None:
        parts.write_part(feature_stats(batch, grain, rules, text), path, batch_id)

    return comments.writeStream.foreachBatch(add_part).option("checkpointLocation", checkpoint)


def read_feature_parts(spark: SparkSession, path: str, grain: Sequence[str]) -> DataFrame:
    """Feature counts over all parts; feeds the same keyword functions as a batch job."""
    return roll_up(parts.read_parts(spark, path, feature_part_schema(grain)), grain)


def compact_feature_parts(spark: SparkSession, path: str, grain: Sequence[str]) -> int:
    """Adds up the parts that can no longer change into a base that readers take instead of them. May run while the stream
    adds parts."""
    return parts.fold_parts(spark, path, feature_part_schema(grain), lambda rows: roll_up(rows, grain))


def corpus_df_of_parts(spark: SparkSession, path: str, video: str = "video_id") -> DataFrame:
    """Corpus document frequency out of per-video parts."""
    return corpus_df_of(read_feature_parts(spark, path, [video]))


DF_DELTA = "token STRING, df_videos BIGINT"


# Values of the state that ``write_df_table`` keeps; each holds some videos. Fixed for a checkpoint.
STATE_BUCKETS = 1 << 11


def _unseen(key: Any, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """Per video of a bucket the features that no earlier micro-batch has brought, as one string. The state is all features of the
    bucket's videos, packed; only videos that come in are taken apart."""
    seen = dict(json.loads(zlib.decompress(state.get[0]))) if state.exists else {}
    brought = defaultdict(set)
    for frame in frames:
        for video, tokens in zip(frame["video_id"], frame["tokens"]):
            brought[video if isinstance(video, str) else None].update(tokens.split(SEPARATOR))
    new = []
    for video, tokens in brought.items():
        before = [seen[video]] if video in seen else []
        fresh = tokens.difference(*[text.split(SEPARATOR) for text in before])
        if fresh:
            new.append(SEPARATOR.join(fresh))
            seen[video] = SEPARATOR.join([*before, new[-1]])
    if new:
        state.update((zlib.compress(json.dumps([*seen.items()]).encode(), 1),))
        yield pd.DataFrame({"tokens": new})


def write_df_table(
    comments: DataFrame,
    config: KeywordConfig,
    path: str,
    checkpoint: str,
    video: str = "video_id",
    text: str = "text_clean",
    after: Callable[[int], None] | None = None,
) -> DataStreamWriter:
    """Keeps the corpus document frequencies at ``path`` up to date: (token, in how many videos it occurs).

    The state store remembers every (video, token) pair, so a micro-batch adds only the pairs that are new, however large the table
    is. It keeps them packed, ``STATE_BUCKETS`` values of some videos each, a few bytes a pair: a micro-batch costs what its own
    comments cost and packing the values of their videos. It writes one part of increments; a replay finds the state of before and
    overwrites its part. Comments that are delivered again change nothing. ``after`` is called with the number of every part once
    it is written.
    """
    lists = feature_lists(comments, [video], config, text).select(F.col(video).cast("string").alias("video_id"), "tokens")
    lists = lists.withColumn("bucket", F.pmod(F.hash("video_id"), F.lit(STATE_BUCKETS)))
    fresh = lists.groupBy("bucket").applyInPandasWithState(_unseen, "tokens STRING", "tokens BINARY", "append", GroupStateTimeout.NoTimeout)

    def add_part(batch: DataFrame, batch_id: int) -> None:
        parts.write_part(_summed_df(batch.mapInArrow(list_counts, DF_DELTA)), path, batch_id)
        if after is not None:
            after(batch_id)

    return fresh.writeStream.foreachBatch(add_part).option("checkpointLocation", checkpoint)


def _summed_df(rows: DataFrame) -> DataFrame:
    return rows.groupBy("token").agg(F.sum("df_videos").alias("df_videos"))


def read_df_table(spark: SparkSession, path: str) -> DataFrame:
    """(token, df_videos) as of the last finished micro-batch."""
    return _summed_df(parts.read_parts(spark, path, DF_DELTA))


def compact_df_table(spark: SparkSession, path: str) -> int:
    """Folds the increments; may run while the stream adds to them."""
    return parts.fold_parts(spark, path, DF_DELTA, _summed_df)


def write_run_stream(runs: DataFrame, path: str, checkpoint: str) -> DataStreamWriter:
    """Append-only run log from a stream of run records."""
    columns = [part.split()[0] for part in CHANNEL_RUN.split(", ")]
    return (
        runs.select(*columns)
        .writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )
