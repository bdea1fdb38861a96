"""The jobs as queries: each lands conversations as API pages, runs its chain of jobs under a fresh root and reads what the
last one stored. A conversation is a video, its turns are the comments; ten channels share the conversations."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadlens.plans import jobs
from threadlens.plans.table_queries import WINDOW, comment_pages, conversations, rounded, video_pages, work_folder
from threadlens.session import ship_package
from threadlens.sources import artifacts
from threadlens.sources.comments import read_clean_comments, read_raw_comments
from threadlens.sources.layers import BUCKET

def channel_pages(spark: SparkSession, folder: str) -> DataFrame:
    """Conversations as videos of ten channels, 50 to a page."""
    item = F.struct(
        F.struct(F.col("video_id").alias("videoId")).alias("id"),
        F.struct(
            F.lit("").alias("title"),
            F.concat(F.lit("2026-01-01T00:00:"), F.lpad((F.col("video_id").cast("bigint") % 60).cast("string"), 2, "0"), F.lit("Z")).alias("publishedAt"),
            F.col("channel_id").alias("channelId"),
        ).alias("snippet"),
    )
    videos = conversations(spark, folder).select("video_id").distinct().withColumn("channel_id", F.concat(F.lit("c"), F.col("video_id").cast("bigint") % 10))
    page = F.floor(F.col("video_id").cast("bigint") / 500).alias("page_no")
    return (
        videos.groupBy("channel_id", page).agg(F.collect_list(item).alias("items"))
        .select("channel_id", "page_no", F.to_json(F.struct("items")).alias("payload"))
    )


def ingested(spark: SparkSession, folder: str) -> str:
    """A root with the raw layer of all videos."""
    root = work_folder(ship_package(spark))
    jobs.ingest_comment_pages(comment_pages(spark, folder), root)
    return root


def cleaned(spark: SparkSession, folder: str) -> str:
    root = ingested(spark, folder)
    jobs.preprocess(spark, root)
    return root


def channels_ingested(spark: SparkSession, folder: str) -> str:
    root = work_folder(ship_package(spark))
    jobs.ingest_channels(spark, channel_pages(spark, folder), comment_pages(spark, folder), root, video_limit=None)
    return root


def channels_cleaned(spark: SparkSession, folder: str) -> str:
    root = channels_ingested(spark, folder)
    jobs.preprocess_channels(spark, root)
    return root


def _shown(rows: DataFrame) -> DataFrame:
    """Token statistics with the list as text."""
    tokens = F.array_join(F.transform("top_tokens", lambda t: F.concat_ws(":", t["token"], t["count"])), " ")
    return rows.withColumn("top_tokens", tokens).drop("created_at_utc", "preprocess_version", "config_hash", "video_ids", "silver_path")


def _listed(stored: DataFrame, *keys: str) -> DataFrame:
    """Keywords with nine decimals: few comments a video make quotients that end on a five at the seventh."""
    return rounded(artifacts.explode_keywords(stored, *keys), 9)


def ingest_pages_job(spark: SparkSession, folder: str) -> DataFrame:
    root = work_folder(ship_package(spark))
    jobs.ingest_comment_pages(comment_pages(spark, folder), root, limit=3)
    return read_raw_comments(spark, jobs.raw_path(root)).select("video_id", "comment_id", "text", "like_count")


def preprocess_job(spark: SparkSession, folder: str) -> DataFrame:
    rows = read_clean_comments(spark, jobs.clean_path(cleaned(spark, folder)))
    return rows.select("video_id", "comment_id", "author", "text_clean", "preprocess_version")


def video_stats_job(spark: SparkSession, folder: str) -> DataFrame:
    return _shown(jobs.stats_by_video(spark, cleaned(spark, folder)))


def video_keywords_job(spark: SparkSession, folder: str) -> DataFrame:
    return _listed(jobs.keywords_by_video(spark, cleaned(spark, folder)), "video_id")


def artifact_sources_job(spark: SparkSession, folder: str) -> DataFrame:
    """Per video artifact, the clean comments of its video that lie in the folder it names."""
    root = cleaned(spark, folder)
    made = {"token_stats": jobs.stats_by_video(spark, root), "tfidf": jobs.keywords_by_video(spark, root)}
    rows = [rows.select(F.lit(kind).alias("kind"), "video_id", "silver_path") for kind, rows in made.items()]
    # A file's address may carry a scheme, so folders are compared from the root's own part on.
    part = rf"([^/]+/silver/{BUCKET}=[0-9]+)"
    named = rows[0].unionByName(rows[1]).withColumn("place", F.regexp_extract("silver_path", part, 1))
    layer = spark.read.parquet(jobs.clean_path(root)).select("video_id", F.regexp_extract(F.col("_metadata.file_path"), part, 1).alias("place"))
    held = layer.groupBy("video_id", "place").agg(F.count("*").alias("comments"))
    return named.join(held, ["video_id", "place"], "left").select("kind", "video_id", F.coalesce("comments", F.lit(0)).alias("comments"))


def corpus_job(spark: SparkSession, folder: str) -> DataFrame:
    corpus = jobs.corpus_document_frequency(spark, cleaned(spark, folder))
    return corpus.tokens.withColumn("video_count", F.lit(corpus.video_count).cast("bigint"))


def list_videos_job(spark: SparkSession, folder: str) -> DataFrame:
    rows = jobs.list_channel_videos(video_pages(spark, folder), 10, *WINDOW)
    return rows.select("channel_id", "video_id", "title", "published_at")


def ingest_channels_job(spark: SparkSession, folder: str) -> DataFrame:
    root = channels_ingested(spark, folder)
    runs = artifacts.read_latest_runs(spark, root)
    return runs.select("channel_id", F.size("video_ids").cast("bigint").alias("listed"), "video_count", "comment_count", "error_count")


def preprocess_channels_job(spark: SparkSession, folder: str) -> DataFrame:
    """A cut record in every seventh video, and a line without any id for every tenth."""
    root = channels_ingested(spark, folder)
    number = F.col("video_id").cast("bigint")
    cut = F.concat(F.lit('{"video_id":"'), "video_id", F.lit('","comment_id":"cut'))
    lines = F.filter(F.array(F.when(number % 7 == 3, cut), F.when(number % 10 == 1, F.lit("no record"))), lambda x: x.isNotNull())
    videos = conversations(spark, folder).select("video_id").distinct()
    videos.select(F.explode(lines).alias("value")).write.text(f"{jobs.raw_path(root)}/late")
    return jobs.preprocess_channels(spark, root)


def channel_stats_job(spark: SparkSession, folder: str) -> DataFrame:
    return _shown(jobs.stats_by_channel(spark, channels_cleaned(spark, folder)))


def channel_keywords_job(spark: SparkSession, folder: str) -> DataFrame:
    return _listed(jobs.keywords_by_channel(spark, channels_cleaned(spark, folder)), "channel_id")


def _compared(spark: SparkSession, folder: str) -> str:
    root = channels_cleaned(spark, folder)
    jobs.keywords_by_video(spark, root)
    jobs.keywords_by_channel(spark, root)
    return root


def distinctive_job(spark: SparkSession, folder: str) -> DataFrame:
    rows = jobs.distinctive_by_video(spark, _compared(spark, folder))
    return rounded(artifacts.explode_keywords(rows, "channel_id", "video_id"))


def report_job(spark: SparkSession, folder: str) -> DataFrame:
    root = channels_cleaned(spark, folder)
    jobs.stats_by_channel(spark, root)
    jobs.keywords_by_channel(spark, root)
    return rounded(jobs.report_channels(spark, root))


JOB_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "job_ingest_pages": ingest_pages_job,
    "job_preprocess": preprocess_job,
    "job_video_stats": video_stats_job,
    "job_video_keywords": video_keywords_job,
    "job_artifact_sources": artifact_sources_job,
    "job_corpus": corpus_job,
    "job_list_videos": list_videos_job,
    "job_ingest_channels": ingest_channels_job,
    "job_preprocess_channels": preprocess_channels_job,
    "job_channel_stats": channel_stats_job,
    "job_channel_keywords": channel_keywords_job,
    "job_distinctive": distinctive_job,
    "job_report": report_job,
}
