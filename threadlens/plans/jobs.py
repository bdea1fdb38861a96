"""One function per job of the product. Each runs over all videos or channels at once
(or some of them) and reads and writes the layers under one root folder:

    <root>/bronze   raw comments, JSON lines
    <root>/silver   clean comments, Parquet
    <root>/gold     results
    <root>/rejected unreadable raw records of the last channel run
"""

from __future__ import annotations

from collections.abc import Iterable
from datetime import datetime, timezone

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadlens.config import KeywordConfig, TokenStatsConfig
from threadlens.operators.channels import (
    cap_comments,
    channel_members,
    channel_stats,
    discover_videos,
    missing_videos,
    preprocess_totals,
    resolve_channel_refs,
    summarize_run,
)
from threadlens.operators.cleaning import clean_comments
from threadlens.operators.corpus import Corpus, build_corpus
from threadlens.operators.features import feature_stats
from threadlens.operators.guards import (
    assert_comparable,
    assert_no_missing_videos,
    assert_single_version,
    single_version,
)
from threadlens.operators.keywords import keyword_stats
from threadlens.operators.report import channel_report, report_order
from threadlens.plans.artifacts import (
    distinctive_artifacts,
    keyword_artifacts,
    token_stats_artifacts,
)
from threadlens.sources.artifacts import (
    append_runs,
    read_artifact,
    read_channel_refs,
    read_corpus,
    read_latest_runs,
    save_channel_refs,
    write_artifact,
    write_corpus,
)
from threadlens.sources.comments import (
    parsed_files,
    read_clean_comments,
    read_raw_comments,
    read_raw_comments_leniently,
    write_clean_comments,
    write_raw_comments,
)
from threadlens.sources.layers import folder_of
from threadlens.sources.pages import flatten_comment_pages, flatten_video_pages, quarantine, strict


def raw_path(root: str) -> str:
    return f"{root}/bronze"


def clean_path(root: str) -> str:
    return f"{root}/silver"


def rejected_path(root: str) -> str:
    return f"{root}/rejected"


def _with_source(artifacts: DataFrame, root: str) -> DataFrame:
    """Video artifacts with ``silver_path``, the folder of the clean layer that holds the video's comments."""
    return artifacts.withColumn("silver_path", folder_of(clean_path(root), F.col("video_id")))


def _with_arrival(comments: DataFrame) -> DataFrame:
    """Arrival number of a comment: page first, then place on the page. API pages hold at most
    100 items, so six digits are ample."""
    arrival = F.col("page_no") * 1_000_000 + F.col("item_no")
    return comments.withColumn("arrival", arrival).drop("page_no", "item_no")


def ingest_comment_pages(
    pages: DataFrame, root: str, limit: int | None = 5000, overwrite: bool = True
) -> None:
    """Landed comment pages to the raw layer, capped per video."""
    # Parsed once: capping looks at the keys before it filters the comments.
    found = strict(flatten_comment_pages(pages)).persist(StorageLevel.DISK_ONLY)
    try:
        comments = cap_comments(found, limit)
        write_raw_comments(_with_arrival(comments), raw_path(root), "overwrite" if overwrite else "append")
    finally:
        found.unpersist()


def preprocess(
    spark: SparkSession, root: str, videos: Iterable[str] | None = None, overwrite: bool = True
) -> None:
    """Raw layer to clean layer, all videos or some."""
    raw = read_raw_comments(spark, raw_path(root))  # foreign files may carry no arrival
    if videos is not None:
        raw = raw.where(F.col("video_id").isin(sorted(set(videos))))
    write_clean_comments(clean_comments(raw), clean_path(root), "overwrite" if overwrite else "refuse")


def stats_by_video(
    spark: SparkSession,
    root: str,
    config: TokenStatsConfig = TokenStatsConfig(),
    videos: Iterable[str] | None = None,
) -> DataFrame:
    comments = read_clean_comments(spark, clean_path(root), videos)
    version = single_version(comments)
    config = config.with_stopwords_hash()
    stats = feature_stats(comments, ["video_id"], config, arrival="arrival", weights=False)
    rows = token_stats_artifacts(stats, ["video_id"], config, version, by_arrival=True)
    write_artifact(_with_source(rows, root), root, "token_stats")
    return read_artifact(spark, root, "token_stats", videos)


def keywords_by_video(
    spark: SparkSession,
    root: str,
    config: KeywordConfig = KeywordConfig(),
    videos: Iterable[str] | None = None,
    use_corpus: bool = False,
    keep_sentiment: bool = False,
) -> DataFrame:
    comments = read_clean_comments(spark, clean_path(root), videos)
    config = config.with_stopwords_hash()
    counted = feature_stats if use_corpus else keyword_stats
    rows = keyword_artifacts(
        counted(comments, ["video_id"], config),
        ["video_id"],
        config,
        single_version(comments),
        read_corpus(spark, root) if use_corpus else None,
        drop_sentiment=not keep_sentiment,
    )
    write_artifact(_with_source(rows, root), root, "tfidf")
    return read_artifact(spark, root, "tfidf", videos)


def corpus_document_frequency(
    spark: SparkSession, root: str, config: KeywordConfig = KeywordConfig()
) -> Corpus:
    """Document frequencies over all videos of the clean layer."""
    comments = read_clean_comments(spark, clean_path(root))
    assert_single_version(comments, ["video_id"])
    corpus = build_corpus(comments, config.with_stopwords_hash(), single_version(comments))
    write_corpus(corpus, spark, root)
    return read_corpus(spark, root)


def list_channel_videos(
    pages: DataFrame,
    limit: int | None = 100,
    published_after: datetime | None = None,
    published_before: datetime | None = None,
) -> DataFrame:
    """Landed video pages to the newest videos of each channel."""
    return discover_videos(strict(flatten_video_pages(pages)), limit, published_after, published_before)


def ingest_channels(
    spark: SparkSession,
    video_pages: DataFrame,
    comment_pages: DataFrame,
    root: str,
    video_limit: int | None = 100,
    comment_limit: int | None = 5000,
    published_after: datetime | None = None,
    published_before: datetime | None = None,
    refs: DataFrame | None = None,
    overwrite: bool = True,
) -> DataFrame:
    """Discovers videos, stores their comments, appends one run record per channel.

    A video with a bad comment item is left out and counted as an error; the others go on.
    ``refs`` (raw_ref, channel_id, resolved_at_utc) is merged into the reference mapping.
    """
    started = datetime.now(timezone.utc)
    videos = list_channel_videos(video_pages, video_limit, published_after, published_before)
    # Discovered once: the ids choose the comments and are the rows of the run record.
    members = videos.select("channel_id", "video_id").persist(StorageLevel.DISK_ONLY)
    found = flatten_comment_pages(comment_pages).join(
        members.select("video_id").distinct(), "video_id", "left_semi"
    )
    # Parsed once: the rows feed the error list, the raw layer and the counts.
    found = found.persist(StorageLevel.DISK_ONLY)
    try:
        good, bad = quarantine(found)
        failed = bad.groupBy("video_id").agg(F.min("_reason").alias("error"))
        fine = good.join(failed, "video_id", "left_anti")
        saved = cap_comments(fine, comment_limit)
        write_raw_comments(_with_arrival(saved), raw_path(root), "overwrite" if overwrite else "append")
        size = F.count("*")
        if comment_limit is not None:
            size = F.least(size, F.lit(max(comment_limit, 1)))
        # A video has an error if one of its rows has a reason; otherwise all of its rows are fine.
        outcome = found.groupBy("video_id").agg(F.min("_reason").alias("error"), size.alias("comment_count"))
        counted = F.when(F.col("error").isNull(), F.col("comment_count"))
        status = members.join(outcome, "video_id", "left").withColumn("comment_count", F.coalesce(counted, F.lit(0)))
        settings = {
            "started_at_utc": F.lit(started).cast("timestamp"),
            "finished_at_utc": F.lit(datetime.now(timezone.utc)).cast("timestamp"),
            "video_limit": F.lit(video_limit).cast("bigint"),
            "comment_limit": F.lit(comment_limit).cast("bigint"),
            "published_after": F.lit(published_after).cast("timestamp"),
            "published_before": F.lit(published_before).cast("timestamp"),
        }
        append_runs(summarize_run(status).withColumns(settings), root)
    finally:
        found.unpersist()
        members.unpersist()
    if refs is not None:
        save_channel_refs(refs, spark, root)
    return read_latest_runs(spark, root)


def resolve_channels(spark: SparkSession, root: str, refs: Iterable[str] | None) -> list[str] | None:
    """Channel ids of the references a caller typed; an unknown reference stands for itself."""
    if refs is None:
        return None
    typed = spark.createDataFrame([(r,) for r in refs], "raw_ref STRING")
    try:
        mapping = read_channel_refs(spark, root)
    except FileNotFoundError:
        return sorted({row[0] for row in typed.collect()})
    return sorted({row[0] for row in resolve_channel_refs(typed, mapping).select("channel_id").collect()})


def _channel_input(
    spark: SparkSession, root: str, refs: Iterable[str] | None
) -> tuple[DataFrame, DataFrame, DataFrame, str]:
    """Clean comments for the channels' latest runs, membership, runs and text version.

    For some channels the comments are cut down to their videos first (a small list). For
    all channels nothing is joined to the texts; membership meets the counts later.
    """
    runs = read_latest_runs(spark, root, resolve_channels(spark, root, refs))
    members = channel_members(runs)
    layer = read_clean_comments(spark, clean_path(root))
    listed = members.select("video_id").distinct()
    # One pass over the layer serves both checks: they need no more than its videos and the versions of each.
    seen = layer.select("video_id", "preprocess_version").distinct().persist(StorageLevel.DISK_ONLY)
    try:
        assert_no_missing_videos(missing_videos(members, seen))
        version = single_version(seen.join(listed, "video_id", "left_semi"))
    finally:
        seen.unpersist()
    return (layer if refs is None else layer.join(listed, "video_id", "left_semi")), members, runs, version


def preprocess_channels(
    spark: SparkSession, root: str, refs: Iterable[str] | None = None, overwrite: bool = True
) -> DataFrame:
    """Cleans the videos of each channel's latest run. A video with an unreadable record is
    left out and counted; the result has one row per channel with its exit code.

    The id of an unreadable record is taken from its text if the line is no JSON. A record without
    any id may belong to any video: it fails no video, but a row without a channel counts such records and has
    exit code 1. All unreadable records of the run are set aside under ``rejected`` with file and reason."""
    runs = read_latest_runs(spark, root, resolve_channels(spark, root, refs))
    members = channel_members(runs)
    # Parsed once: all lines are judged before the valid ones of unbroken videos are written.
    parsed = parsed_files(spark, raw_path(root)).persist(StorageLevel.DISK_ONLY)
    try:
        good, bad = read_raw_comments_leniently(spark, raw_path(root), parsed=parsed)
        by_text = F.nullif(F.regexp_extract("line", r'"video_id"\s*:\s*"([^"]+)"', 1), F.lit(""))
        bad = bad.withColumn("video_id", F.coalesce(F.get_json_object("line", "$.video_id"), by_text))
        bad.write.mode("overwrite").parquet(rejected_path(root))
        # Rejected records are few; from here on they are read from their own table.
        bad = spark.read.schema("origin STRING, line STRING, reason STRING, video_id STRING").parquet(rejected_path(root))
        broken = bad.where("video_id is not null").select("video_id").distinct()
        failed = broken.join(members.select("video_id").distinct(), "video_id", "left_semi")
        wanted = good.join(members.select("video_id").distinct(), "video_id", "left_semi").join(
            failed, "video_id", "left_anti"
        )
        write_clean_comments(clean_comments(wanted), clean_path(root), "overwrite" if overwrite else "refuse")
    finally:
        parsed.unpersist()
    status = members.join(failed.withColumn("error", F.lit("unreadable record")), "video_id", "left")
    totals = preprocess_totals(status.withColumn("comment_count", F.lit(0)))
    nothing = F.lit(0).cast("bigint")
    nameless = bad.where("video_id is null").groupBy().agg(F.count("*").alias("error_count")).where("error_count > 0")
    return totals.unionByName(
        nameless.select(
            F.lit(None).cast("string").alias("channel_id"), nothing.alias("video_count"), nothing.alias("processed_count"),
            "error_count", F.lit(1).cast("bigint").alias("exit_code"),
        )
    )


def stats_by_channel(
    spark: SparkSession,
    root: str,
    config: TokenStatsConfig = TokenStatsConfig(),
    refs: Iterable[str] | None = None,
) -> DataFrame:
    comments, members, runs, version = _channel_input(spark, root, refs)
    config = config.with_stopwords_hash()
    by_video = feature_stats(comments, ["video_id"], config, weights=False)
    rows = token_stats_artifacts(channel_stats(by_video, members), ["channel_id"], config, version)
    write_artifact(rows.join(runs.select("channel_id", "video_ids"), "channel_id"), root, "channel_token_stats")
    return read_artifact(spark, root, "channel_token_stats", resolve_channels(spark, root, refs))


def keywords_by_channel(
    spark: SparkSession,
    root: str,
    config: KeywordConfig = KeywordConfig(),
    refs: Iterable[str] | None = None,
    use_corpus: bool = False,
    keep_sentiment: bool = False,
) -> DataFrame:
    comments, members, runs, version = _channel_input(spark, root, refs)
    config = config.with_stopwords_hash()
    by_video = feature_stats(comments, ["video_id"], config)
    rows = keyword_artifacts(
        channel_stats(by_video, members),
        ["channel_id"],
        config,
        version,
        read_corpus(spark, root) if use_corpus else None,
        drop_sentiment=not keep_sentiment,
    )
    write_artifact(rows.join(runs.select("channel_id", "video_ids"), "channel_id"), root, "channel_tfidf")
    return read_artifact(spark, root, "channel_tfidf", resolve_channels(spark, root, refs))


def distinctive_by_video(
    spark: SparkSession,
    root: str,
    config: KeywordConfig = KeywordConfig(),
    refs: Iterable[str] | None = None,
    videos: Iterable[str] | None = None,
) -> DataFrame:
    """Stored video keywords against stored channel keywords; nothing is recomputed.

    A video that is asked for must belong to one of the channels, and every member that takes part
    must have stored keywords; the result holds the wanted videos only.
    """
    ids = resolve_channels(spark, root, refs)
    channels = read_artifact(spark, root, "channel_tfidf", ids)
    members = channels.select("channel_id", F.explode(F.array_distinct("video_ids")).alias("video_id"))
    if videos is not None:
        videos = sorted(set(videos))
        known = members.where(F.col("video_id").isin(videos))
        belong = {row[0] for row in known.select("video_id").distinct().collect()}
        if strangers := [v for v in videos if v not in belong]:
            raise ValueError(f"not videos of these channels: {strangers}")
        members = known
    stored = read_artifact(spark, root, "tfidf", videos)
    assert_no_missing_videos(members.join(stored.select("video_id"), "video_id", "left_anti").select("channel_id", "video_id"))
    mine = stored.join(members, "video_id")
    assert_comparable(mine, channels, members)
    write_artifact(
        distinctive_artifacts(mine, channels, config.with_stopwords_hash()), root, "distinctive_keywords"
    )
    return _of_videos(read_artifact(spark, root, "distinctive_keywords", ids), videos)


def _of_videos(rows: DataFrame, videos: Iterable[str] | None) -> DataFrame:
    return rows if videos is None else rows.where(F.col("video_id").isin(sorted(set(videos))))


def report_channels(
    spark: SparkSession,
    root: str,
    refs: Iterable[str] | None = None,
    videos: Iterable[str] | None = None,
    top_k: int = 30,
) -> DataFrame:
    """Report lines in print order, from stored results only."""
    ids = resolve_channels(spark, root, refs)
    distinctive = None
    if videos is not None:
        videos = sorted(set(videos))
        distinctive = _of_videos(read_artifact(spark, root, "distinctive_keywords", ids), videos)
        compared = {row[0] for row in distinctive.select("video_id").distinct().collect()}
        if absent := [v for v in videos if v not in compared]:
            raise FileNotFoundError(f"no stored distinctive keywords for videos {absent}")
    report = channel_report(
        read_latest_runs(spark, root, ids),
        read_artifact(spark, root, "channel_token_stats", ids),
        read_artifact(spark, root, "channel_tfidf", ids),
        distinctive,
        top_k,
    )
    return report.orderBy(*report_order())
