"""Every operator as a query over the given tables (documents, conversations, pages, events).

Roles: a document is a comment, its language the channel, language plus source the video.
A turn of a conversation is a comment, the conversation its video. Pages and events supply
references, runs and videos. All queries read their tables whole.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadlens.config import (
    PREPROCESS_VERSION,
    KeywordConfig,
    TokenStatsConfig,
    config_hash,
    keyword_config_hash,
)
from threadlens.functions.text import clean_text
from threadlens.operators import channels, guards, report
from threadlens.operators.cleaning import clean_comments
from threadlens.operators.corpus import Corpus, build_corpus, corpus_df
from threadlens.operators.distinctive import distinctive_keywords
from threadlens.operators.features import (
    document_ngrams,
    feature_stats,
    grain_totals,
    roll_up,
    stem_vocabulary,
)
from threadlens.operators.keywords import (
    df_thresholds,
    keyword_stats,
    keyword_summary,
    scored_features,
    tfidf_keywords,
    top_keywords,
)
from threadlens.operators.stats import (
    token_counts,
    token_grouping_sets,
    token_stats,
    token_stats_from,
)
from threadlens.plans.artifacts import keyword_artifacts
from threadlens.schemas import CHANNEL_RUN
from threadlens.session import ship_package, spread_input
from threadlens.sources import artifacts, comments as comment_sources, pages
from threadlens.streaming import incremental

VIDEO, CHANNEL = ["video_id"], ["channel_id"]
STATS = TokenStatsConfig()
UNIGRAMS = KeywordConfig()
BIGRAMS = KeywordConfig(ngram_range=(1, 2))
STEMS = KeywordConfig(normalization="stem_en")
WINDOW = (datetime(2024, 1, 5, tzinfo=timezone.utc), datetime(2024, 1, 20, tzinfo=timezone.utc))


# --- the tables in the roles of the product -------------------------------------------


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def documents(spark: SparkSession, folder: str) -> DataFrame:
    ship_package(spark)
    rows = spread_input(table(spark, folder, "documents").select("doc_id", "lang", "source", "text"))
    return rows.select(
        F.col("lang").alias("channel_id"),
        F.concat_ws("-", "lang", "source").alias("video_id"),
        F.col("doc_id").alias("arrival"),
        clean_text(F.col("text")).alias("text_clean"),
    )


def conversations(spark: SparkSession, folder: str) -> DataFrame:
    ship_package(spark)
    rows = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    return rows.select(
        F.col("conv_id").cast("string").alias("video_id"),
        F.concat_ws("-", "conv_id", "turn").alias("comment_id"),
        F.col("turn").cast("bigint").alias("turn"),
        "role",
        "text",
    )


def raw_conversations(spark: SparkSession, folder: str) -> DataFrame:
    """Raw comments with the gaps real ones have: no author, no likes, no or naive times."""
    turn = F.col("turn")
    minute = F.lpad((turn % 60).cast("string"), 2, "0")
    published = F.when(turn % 3 == 1, F.concat(F.lit("2026-01-01T10:"), minute, F.lit(":00"))).when(
        turn % 3 == 2, F.concat(F.lit("2026-01-01T12:"), minute, F.lit(":00+02:00"))
    )
    return conversations(spark, folder).select(
        "video_id",
        "comment_id",
        "text",
        F.when(turn % 2 == 0, F.col("role")).alias("author"),
        F.when(turn % 4 != 0, turn).alias("like_count"),
        published.alias("published_at"),
        F.when(turn % 5 != 0, turn % 2 == 1).alias("is_reply"),
        turn.alias("arrival"),
    )


def comment_pages(spark: SparkSession, folder: str) -> DataFrame:
    """Conversations nested the way the API delivers them: two comments to a page."""
    original = F.when(F.col("turn") % 3 == 0, "").otherwise(F.col("text"))
    thread = F.struct(
        F.col("comment_id").alias("id"),
        F.struct(
            original.alias("textOriginal"),
            F.when(F.col("turn") % 3 == 0, F.col("text")).alias("textDisplay"),
            F.col("role").alias("authorDisplayName"),
            F.col("turn").alias("likeCount"),
            F.lit("2026-01-01T12:34:56Z").alias("publishedAt"),
        ).alias("snippet"),
    )
    item = F.struct(F.struct(thread.alias("topLevelComment")).alias("snippet"))
    return (
        conversations(spark, folder)
        .groupBy("video_id", F.floor(F.col("turn") / 2).alias("page_no"))
        .agg(F.sort_array(F.collect_list(F.struct("turn", item.alias("item")))).alias("_sorted"))
        .select(
            "video_id",
            "page_no",
            F.to_json(F.struct(F.transform("_sorted", lambda s: s["item"]).alias("items"))).alias("payload"),
        )
    )


def video_pages(spark: SparkSession, folder: str) -> DataFrame:
    """Events as videos of the users' channels, 50 to a page."""
    item = F.struct(
        F.struct(F.concat(F.lit("v"), "event_id").alias("videoId")).alias("id"),
        F.struct(
            F.col("event_type").alias("title"),
            F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("publishedAt"),
            F.concat(F.lit("c"), "user_id").alias("channelId"),
        ).alias("snippet"),
    )
    events = table(spark, folder, "events")
    return (
        events.groupBy(
            F.concat(F.lit("c"), "user_id").alias("channel_id"),
            F.floor(F.col("event_id") / 50).alias("page_no"),
        )
        .agg(F.collect_list(item).alias("items"))
        .select("channel_id", "page_no", F.to_json(F.struct("items")).alias("payload"))
    )


def event_status(spark: SparkSession, folder: str) -> DataFrame:
    """Events as the outcome of fetching one video each."""
    return table(spark, folder, "events").select(
        F.concat(F.lit("c"), "user_id").alias("channel_id"),
        F.concat(F.lit("v"), "event_id").alias("video_id"),
        F.floor("value").alias("comment_count"),
        F.when(F.col("event_type") == "error", F.lit("failed")).alias("error"),
    )


def event_runs(spark: SparkSession, folder: str) -> DataFrame:
    """Events as run records of the users' channels."""
    none = F.lit(None).cast("timestamp")
    return table(spark, folder, "events").select(
        F.concat(F.lit("c"), "user_id").alias("channel_id"),
        F.col("ts").cast("timestamp").alias("started_at_utc"),
        F.col("ts").cast("timestamp").alias("finished_at_utc"),
        F.array(F.concat(F.lit("v"), "event_id")).alias("video_ids"),
        F.lit(1).cast("bigint").alias("video_count"),
        F.floor("value").alias("comment_count"),
        F.when(F.col("event_type") == "error", 1).otherwise(0).cast("bigint").alias("error_count"),
        F.lit(100).cast("bigint").alias("video_limit"),
        F.lit(5000).cast("bigint").alias("comment_limit"),
        none.alias("published_after"),
        none.alias("published_before"),
    )


def event_resolutions(spark: SparkSession, folder: str) -> DataFrame:
    """Events as resolved handles; letter case varies, as users type it."""
    user = F.col("user_id").cast("string")
    typed = F.when(F.col("event_id") % 2 == 0, F.concat(F.lit("@User_"), user)).otherwise(
        F.concat(F.lit("https://www.youtube.com/@user_"), user)
    )
    return table(spark, folder, "events").select(
        typed.alias("raw_ref"),
        F.concat(F.lit("c"), "event_id").alias("channel_id"),
        F.col("ts").cast("timestamp").alias("resolved_at_utc"),
    )


def page_refs(spark: SparkSession, folder: str) -> DataFrame:
    """Page URLs, and references of every form made from the page ids."""
    url = F.col("url")
    number = F.col("page_id").cast("string")
    vid = F.concat(F.lit("id_"), number)
    padded = F.lpad(number, 22, "0")
    forms = [
        url,
        F.concat(F.lit("   "), vid, F.lit("   ")),
        F.concat(F.lit("https://youtu.be/"), vid, F.lit("?t=5")),
        F.concat(F.lit("https://www.youtube.com/watch?list=a&v="), vid, F.lit("%2B&t=1#x")),
        F.concat(F.lit("https://youtube.com/shorts/"), vid, F.lit("/more")),
        F.concat(F.lit("https://www.youtube.com/embed/"), vid, F.lit(";p=1")),
        F.concat(F.lit("UC"), padded),
        F.concat(F.lit("https://WWW.YouTube.com//channel/UC"), padded),
        F.concat(F.lit("@Name_"), number),
        F.concat(F.lit("http://m.youtube.com/@name."), number, F.lit("/videos")),
        F.concat(F.lit("https://youtube.com/user/User"), number),
        F.concat(F.lit("https://youtube.com/channel/short"), number),
    ]
    return table(spark, folder, "pages").select(
        "page_id", F.posexplode(F.array(*forms)).alias("form", "raw_ref")
    ).withColumn("form", F.col("form").cast("bigint"))


def work_folder(spark: SparkSession) -> str:
    """A fresh folder in the cluster's shared checkpoint directory. Only a session whose executors share
    the driver's disk may go without that setting."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base is None:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = tempfile.mkdtemp(prefix="threadlens-work-")
    return f"{base.rstrip('/')}/threadlens-{uuid.uuid4().hex}"


# --- shapes for comparison -------------------------------------------------------------


def rounded(rows: DataFrame, digits: int = 6) -> DataFrame:
    """Floating results at six decimals or as many as asked for, ranks as BIGINT."""
    shaped = []
    for name, kind in rows.dtypes:
        column = F.col(name)
        if kind == "double":
            column = F.round(column, digits)
        elif kind == "int":
            column = column.cast("bigint")
        shaped.append(column.alias(name))
    return rows.select(*shaped)


def corpus_of(comments: DataFrame, config: KeywordConfig, stats: DataFrame | None = None) -> Corpus:
    return build_corpus(comments, config, PREPROCESS_VERSION, stats=stats)


# --- queries ---------------------------------------------------------------------------


def clean_text_query(spark: SparkSession, folder: str) -> DataFrame:
    return documents(spark, folder).select(F.col("arrival").alias("doc_id"), "text_clean")


def clean_comments_query(spark: SparkSession, folder: str) -> DataFrame:
    return clean_comments(raw_conversations(spark, folder)).drop("processed_at", "arrival")


def stats_query(grain: list[str], arrival: str | None) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        rows = token_stats(documents(spark, folder), grain, STATS, arrival=arrival)
        shown = F.transform("top_tokens", lambda t: F.concat_ws(":", t["token"], t["count"]))
        return rows.withColumn("top_tokens", F.array_join(shown, " "))

    return run


def counts_query(grain: list[str]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, folder: token_counts(documents(spark, folder), grain, STATS)


def grouping_sets_query(spark: SparkSession, folder: str) -> DataFrame:
    return token_grouping_sets(documents(spark, folder), "video_id", "channel_id", STATS)


def ngrams_query(spark: SparkSession, folder: str) -> DataFrame:
    rows = clean_comments(raw_conversations(spark, folder))
    return document_ngrams(rows, "comment_id", KeywordConfig(ngram_range=(1, 3)))


def tfidf_query(
    grain: list[str], config: KeywordConfig, with_corpus: bool = False, drop_sentiment: bool = True
) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        rows = documents(spark, folder)
        if not with_corpus:
            return rounded(tfidf_keywords(rows, grain, config, drop_sentiment=drop_sentiment))
        # One scan serves the corpus and the grain: coarser counts are sums of video counts.
        by_video = feature_stats(rows, sorted({*grain, "video_id"}), config)
        corpus = corpus_of(rows, config, by_video)
        stats = by_video if grain == VIDEO else roll_up(by_video, grain)
        return rounded(top_keywords(scored_features(stats, grain, config, corpus), grain, config, drop_sentiment))

    return run


def tfidf_conversations_query(drop_sentiment: bool) -> Callable[[SparkSession, str], DataFrame]:
    """Keywords per speaker role; the sentiment words planted by turn number show the filter."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        planted = F.when(F.col("turn") % 4 == 0, F.concat("text", F.lit(" great amazing setup"))).otherwise(
            F.col("text")
        )
        rows = conversations(spark, folder).select("role", clean_text(planted).alias("text_clean"))
        config = KeywordConfig(ngram_range=(1, 2))
        return rounded(tfidf_keywords(rows, ["role"], config, drop_sentiment=drop_sentiment))

    return run


def summary_query(grain: list[str], config: KeywordConfig) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        rows = keyword_summary(keyword_stats(documents(spark, folder), grain, config), grain, config)
        shown = F.transform("keywords", lambda k: F.concat_ws(":", k["token"], k["df"]))
        return rows.withColumn("keyword_count", F.size("keywords").cast("bigint")).withColumn(
            "keywords", F.array_join(shown, " | ")
        )

    return run


def corpus_query(spark: SparkSession, folder: str) -> DataFrame:
    return corpus_df(documents(spark, folder), BIGRAMS)


def thresholds_query(spark: SparkSession, folder: str) -> DataFrame:
    totals = grain_totals(feature_stats(documents(spark, folder), VIDEO, UNIGRAMS), VIDEO)
    parts = [
        df_thresholds(totals, KeywordConfig(min_df=low, max_df=high)).select(
            "video_id", F.lit(name).alias("setting"), "idf_documents", "min_df_abs", "max_df_abs"
        )
        for name, low, high in (("count", 2, 50), ("share", 0.05, 0.9), ("one", 1, 1.0), ("below", -1, 0.5))
    ]
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    return rows


def channel_of_video(rows: DataFrame) -> DataFrame:
    return rows.withColumn("channel_id", F.substring_index("video_id", "-", 1))


def distinctive_query(with_corpus: bool) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        rows = documents(spark, folder)
        # One scan serves both grains: channel counts are sums of video counts.
        by_video = feature_stats(rows, ["channel_id", "video_id"], UNIGRAMS)
        corpus = corpus_of(rows, UNIGRAMS, by_video) if with_corpus else None
        by_channel = roll_up(by_video, CHANNEL)
        keys = ["channel_id", "video_id"]
        mine = top_keywords(scored_features(by_video, keys, UNIGRAMS, corpus), keys, UNIGRAMS)
        theirs = top_keywords(scored_features(by_channel, CHANNEL, UNIGRAMS, corpus), CHANNEL, UNIGRAMS)
        return rounded(distinctive_keywords(mine, theirs, UNIGRAMS.top_k))

    return run


def flatten_comments_query(spark: SparkSession, folder: str) -> DataFrame:
    return pages.strict(pages.flatten_comment_pages(comment_pages(spark, folder)))


def flatten_videos_query(spark: SparkSession, folder: str) -> DataFrame:
    return pages.strict(pages.flatten_video_pages(video_pages(spark, folder)))


def quarantine_query(spark: SparkSession, folder: str) -> DataFrame:
    """Items of pages asked for under the wrong channel end up in quarantine."""
    swapped = video_pages(spark, folder).withColumn(
        "channel_id", F.when(F.col("page_no") % 2 == 0, F.col("channel_id")).otherwise(F.lit("c0"))
    )
    _, bad = pages.quarantine(pages.flatten_video_pages(swapped))
    return bad.select("video_id", "channel_id", F.col("_reason").alias("reason"))


def cap_query(spark: SparkSession, folder: str) -> DataFrame:
    rows = flatten_comments_query(spark, folder)
    return channels.cap_comments(rows, 3).select("video_id", "comment_id", "page_no", "item_no")


def discover_query(spark: SparkSession, folder: str) -> DataFrame:
    rows = channels.discover_videos(flatten_videos_query(spark, folder), 10, *WINDOW)
    return rows.select("channel_id", "video_id", "title", "published_at")


def run_summary_query(spark: SparkSession, folder: str) -> DataFrame:
    rows = channels.summarize_run(event_status(spark, folder))
    return rows.withColumn("video_ids", F.array_join("video_ids", " "))


def totals_query(spark: SparkSession, folder: str) -> DataFrame:
    return channels.preprocess_totals(event_status(spark, folder))


def latest_runs_query(spark: SparkSession, folder: str) -> DataFrame:
    rows = channels.latest_runs(event_runs(spark, folder))
    return rows.select(
        "channel_id", "finished_at_utc", F.col("video_ids")[0].alias("video_id"), "comment_count", "error_count"
    )


def _split_resolutions(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    rows = event_resolutions(spark, folder)
    early = F.col("resolved_at_utc") < F.lit(WINDOW[0])
    empty = spark.createDataFrame([], "input_ref STRING, channel_id STRING, resolved_at_utc TIMESTAMP")
    return channels.upsert_channel_refs(empty, rows.where(early)), rows.where(~early)


def upsert_refs_query(spark: SparkSession, folder: str) -> DataFrame:
    stored, new = _split_resolutions(spark, folder)
    return channels.upsert_channel_refs(stored, new)


def resolve_refs_query(spark: SparkSession, folder: str) -> DataFrame:
    """The early mapping only, so some references stay unknown."""
    stored, _ = _split_resolutions(spark, folder)
    typed = event_resolutions(spark, folder).select("raw_ref").distinct()
    return channels.resolve_channel_refs(typed, stored)


def video_refs_query(spark: SparkSession, folder: str) -> DataFrame:
    return channels.normalize_video_refs(page_refs(spark, folder), "raw_ref")


def channel_refs_query(spark: SparkSession, folder: str) -> DataFrame:
    return channels.normalize_channel_refs(page_refs(spark, folder), "raw_ref")


def version_query(spark: SparkSession, folder: str) -> DataFrame:
    """Versions assigned by document number: most videos are uniform, some mixed or bare."""
    number = F.col("arrival")
    version = (
        F.when(F.col("video_id").endswith("0"), F.lit(None))
        .when(number % 40 == 0, "v0")
        .otherwise("v1")
    )
    return guards.version_report(
        documents(spark, folder).withColumn("preprocess_version", version), VIDEO
    )


def missing_videos_query(spark: SparkSession, folder: str) -> DataFrame:
    """Videos none of whose comments carries the toxic label."""
    rows = table(spark, folder, "documents").select(
        "doc_id", F.col("lang").alias("channel_id"), F.concat_ws("-", "lang", "source").alias("video_id")
    )
    toxic = table(spark, folder, "labels").where(F.col("toxic") == 1).select("doc_id")
    return channels.missing_videos(rows, rows.join(toxic, "doc_id", "left_semi"))


def channel_comments_query(spark: SparkSession, folder: str) -> DataFrame:
    """Comments with the channels that list their video; the lists hold doubled entries."""
    rows = table(spark, folder, "documents").select(
        "doc_id", F.concat_ws("-", "lang", "source").alias("video_id"), "source"
    )
    listed = rows.select(F.col("source").alias("channel_id"), "video_id")
    return channels.channel_comments(rows.select("doc_id", "video_id"), listed)


def membership_tfidf_query(spark: SparkSession, folder: str) -> DataFrame:
    """Keywords of channels given as a membership table: here every source is a channel."""
    members = table(spark, folder, "documents").select(
        F.col("source").alias("channel_id"), F.concat_ws("-", "lang", "source").alias("video_id")
    )
    by_video = feature_stats(documents(spark, folder).drop("channel_id"), VIDEO, UNIGRAMS)
    stats = channels.channel_stats(by_video, members)
    return rounded(top_keywords(scored_features(stats, CHANNEL, UNIGRAMS), CHANNEL, UNIGRAMS))


def lift_guard_query(spark: SparkSession, folder: str) -> DataFrame:
    """Artifacts whose versions differ by document number must be refused, with the reason."""
    rows = table(spark, folder, "documents")
    last = F.max("doc_id")
    videos = rows.groupBy(
        F.col("lang").alias("channel_id"), F.concat_ws("-", "lang", "source").alias("video_id")
    ).agg(
        F.lit("tfidf_v2_1").alias("artifact_version"),
        F.when(last % 3 == 0, "v0").otherwise("v1").alias("preprocess_version"),
        F.when(last % 5 == 0, "other").otherwise("same").alias("config_hash"),
    )
    owners = rows.where(F.col("lang") != "fr").select(F.col("lang").alias("channel_id")).distinct().select(
        "channel_id",
        F.lit("tfidf_v2_1").alias("artifact_version"),
        F.lit("v1").alias("preprocess_version"),
        F.lit("same").alias("config_hash"),
    )
    listed = rows.where(F.col("source") != "src7").select(
        F.col("lang").alias("channel_id"), F.concat_ws("-", "lang", "source").alias("video_id")
    )
    return guards.lift_mismatches(videos, owners, listed)


def report_query(spark: SparkSession, folder: str) -> DataFrame:
    """The report out of stored tables, as the job makes it. The sources stand for channels that have runs but no results yet."""
    base, keys = work_folder(spark), ["channel_id", "video_id"]

    def stored(rows: DataFrame, name: str) -> DataFrame:
        rows.write.parquet(f"{base}/{name}")
        return spark.read.schema(rows.schema).parquet(f"{base}/{name}")

    by_video = stored(feature_stats(documents(spark, folder), keys, UNIGRAMS), "counts")
    by_channel = stored(roll_up(by_video, CHANNEL), "channel_counts")
    stats = token_stats_from(by_channel, CHANNEL, STATS).select(
        "channel_id",
        F.lit(PREPROCESS_VERSION).alias("preprocess_version"),
        F.lit(config_hash(STATS)).alias("config_hash"),
        "top_tokens",
    )
    summary = keyword_summary(by_channel, CHANNEL, UNIGRAMS).withColumn(
        "config_hash", F.lit(keyword_config_hash(UNIGRAMS))
    )
    summary = stored(summary, "summary")
    mine = top_keywords(scored_features(by_video, keys, UNIGRAMS), keys, UNIGRAMS)
    theirs = artifacts.explode_keywords(summary, "channel_id")
    ranked = distinctive_keywords(mine, theirs, UNIGRAMS.top_k)
    fields = ("token", "video_score", "channel_score", "lift", "video_df", "channel_df")
    lists = ranked.groupBy(*keys).agg(
        F.sort_array(F.collect_list(F.struct("rank", *fields))).alias("keywords")
    )
    none = F.lit(None).cast("timestamp")
    # Blank documents stand for the errors of a run.
    sizes = grain_totals(by_video, keys)
    sources = sizes.withColumn("channel_id", F.substring_index("video_id", "-", -1))
    runs = sizes.unionByName(sources).groupBy("channel_id").agg(
        F.count("*").alias("video_count"),
        F.sum("row_count").alias("comment_count"),
        F.sum("blank_text_count").alias("error_count"),
    )
    runs = runs.select(
        "*",
        F.lit(WINDOW[0]).cast("timestamp").alias("published_after"),
        none.alias("published_before"),
    )
    return rounded(report.channel_report(stored(runs, "runs"), stats, summary, lists))


def stem_query(spark: SparkSession, folder: str) -> DataFrame:
    return stem_vocabulary(documents(spark, folder), STEMS)


def raw_round_trip_query(spark: SparkSession, folder: str) -> DataFrame:
    path = work_folder(spark)
    comment_sources.write_raw_comments(raw_conversations(spark, folder), path)
    return comment_sources.read_raw_comments(spark, path).select(
        "video_id", "comment_id", "text", "author", "like_count", "published_at", "is_reply", "arrival"
    )


def clean_round_trip_query(spark: SparkSession, folder: str) -> DataFrame:
    path = work_folder(spark)
    comment_sources.write_clean_comments(clean_comments(raw_conversations(spark, folder)), path)
    return comment_sources.read_clean_comments(spark, path).select(
        "video_id", "comment_id", "author", "published_at", "like_count", "is_reply", "text_clean", "preprocess_version"
    )


def corpus_round_trip_query(spark: SparkSession, folder: str) -> DataFrame:
    root = work_folder(spark)
    artifacts.write_corpus(corpus_of(documents(spark, folder), UNIGRAMS), spark, root)
    corpus = artifacts.read_corpus(spark, root)
    return corpus.tokens.select(
        "token",
        "df_videos",
        F.lit(corpus.video_count).cast("bigint").alias("video_count"),
        F.lit(corpus.config_hash).alias("config_hash"),
    )


def artifact_round_trip_query(spark: SparkSession, folder: str) -> DataFrame:
    root = work_folder(spark)
    stats = feature_stats(documents(spark, folder), VIDEO, UNIGRAMS)
    rows = keyword_artifacts(stats, VIDEO, UNIGRAMS, PREPROCESS_VERSION)
    artifacts.write_artifact(rows, root, "tfidf")
    stored = artifacts.read_artifact(spark, root, "tfidf")
    return rounded(
        artifacts.explode_keywords(stored, "video_id", "config_hash", "vocab_size", "min_df_raw", "max_df_raw")
    )


def run_log_query(spark: SparkSession, folder: str) -> DataFrame:
    root = work_folder(spark)
    runs = event_runs(spark, folder)
    early = F.col("finished_at_utc") < F.lit(WINDOW[0])
    artifacts.append_runs(runs.where(early), root)
    artifacts.append_runs(runs.where(~early), root)
    return artifacts.read_latest_runs(spark, root).select("channel_id", "finished_at_utc", "comment_count")


def stream_clean_query(spark: SparkSession, folder: str) -> DataFrame:
    """Raw JSON files through the streaming cleaner, then read back."""
    ship_package(spark)
    base = work_folder(spark)
    comment_sources.write_raw_comments(raw_conversations(spark, folder), f"{base}/raw")
    stream = incremental.stream_raw_comments(spark, f"{base}/raw")
    query = incremental.write_clean_stream(stream, f"{base}/clean", f"{base}/progress")
    query.trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{base}/clean").select(
        "video_id", "comment_id", "author", "published_at", "like_count", "is_reply", "text_clean", "preprocess_version"
    )


def stream_quarantine_query(spark: SparkSession, folder: str) -> DataFrame:
    """Raw lines, every seventh turn's unreadable, through the checked stream: what was kept and what was rejected."""
    ship_package(spark)
    base = work_folder(spark)
    rows = raw_conversations(spark, folder)
    cut = F.concat("comment_id", F.lit(' cut {"video_id'))
    rows.select(F.when(F.col("arrival") % 7 == 3, cut).otherwise(F.to_json(F.struct("*"))).alias("value")).write.text(f"{base}/raw")
    lines = incremental.stream_raw_lines(spark, f"{base}/raw")
    query = incremental.write_checked_stream(lines, f"{base}/clean", f"{base}/rejected", f"{base}/progress")
    query.trigger(availableNow=True).start().awaitTermination()
    kept = spark.read.parquet(f"{base}/clean").select(F.col("comment_id").alias("line"), F.lit(None).cast("string").alias("reason"))
    return kept.unionByName(spark.read.parquet(f"{base}/rejected").select("line", "reason"))


def stream_features(spark: SparkSession, folder: str) -> str:
    ship_package(spark)
    base = work_folder(spark)
    schema = table(spark, folder, "documents").schema
    # The table is one file or a folder of files. A pattern names either: a stream takes a plain path for a folder.
    stream = (
        spark.readStream.schema(schema)
        .parquet(f"{folder}/documents.parque[t]")
        .select(
            F.col("lang").alias("channel_id"),
            F.concat_ws("-", "lang", "source").alias("video_id"),
            clean_text(F.col("text")).alias("text_clean"),
        )
    )
    query = incremental.write_feature_parts(stream, VIDEO, UNIGRAMS, f"{base}/parts", f"{base}/progress")
    query.trigger(availableNow=True).start().awaitTermination()
    return f"{base}/parts"


def stream_tfidf_query(spark: SparkSession, folder: str) -> DataFrame:
    """Keywords out of incrementally kept counts; equal to the batch query."""
    stats = incremental.read_feature_parts(spark, stream_features(spark, folder), VIDEO)
    return rounded(top_keywords(scored_features(stats, VIDEO, UNIGRAMS), VIDEO, UNIGRAMS))


def stream_corpus_query(spark: SparkSession, folder: str) -> DataFrame:
    return incremental.corpus_df_of_parts(spark, stream_features(spark, folder))


def delivered_twice(spark: SparkSession, folder: str, base: str) -> int:
    """Raw comments in files under ``base``, and all of them once more in later files; the number of files of a delivery."""
    rows = raw_conversations(spark, folder).select(F.to_json(F.struct("*")).alias("value"))
    files = 4
    for delivery in ("first", "second"):
        rows.repartition(files).write.text(f"{base}/{delivery}")
    return files


def stream_redelivered_query(spark: SparkSession, folder: str) -> DataFrame:
    """Token counts of a stream that delivers every comment in two micro-batches."""
    ship_package(spark)
    base = work_folder(spark)
    files = delivered_twice(spark, folder, f"{base}/raw")
    stream = incremental.stream_deliveries(spark, f"{base}/raw", files)
    comments = clean_comments(incremental.first_deliveries(stream))
    query = incremental.write_feature_parts(comments, VIDEO, STATS, f"{base}/parts", f"{base}/progress")
    query.trigger(availableNow=True).start().awaitTermination()
    stats = incremental.read_feature_parts(spark, f"{base}/parts", VIDEO)
    return stats.select("video_id", "token", "docs", "df", F.col("n").alias("count"))


def stream_df_query(spark: SparkSession, folder: str) -> DataFrame:
    """Document frequencies kept by a stream whose comments come twice and whose second micro-batch fails once its part is
    written, so that it is replayed; folded in between and at the end."""
    ship_package(spark)
    base = work_folder(spark)
    files = delivered_twice(spark, folder, f"{base}/raw")
    failures = [1]

    def run() -> None:
        comments = clean_comments(incremental.stream_deliveries(spark, f"{base}/raw", max(files // 2, 1)))
        writer = incremental.write_df_table(comments, BIGRAMS, f"{base}/df", f"{base}/progress", after=fail)
        writer.trigger(availableNow=True).start().awaitTermination()

    def fail(batch_id: int) -> None:
        if batch_id in failures:
            failures.remove(batch_id)
            raise RuntimeError("the micro-batch stops after its part is written")

    try:
        run()
    except StreamingQueryException:
        incremental.compact_df_table(spark, f"{base}/df")
        run()
    incremental.compact_df_table(spark, f"{base}/df")
    return incremental.read_df_table(spark, f"{base}/df")


def stream_runs_query(spark: SparkSession, folder: str) -> DataFrame:
    """The newest run of every channel, out of a run log that a stream has written."""
    base = work_folder(spark)
    event_runs(spark, folder).write.parquet(f"{base}/arriving")
    runs = spark.readStream.schema(CHANNEL_RUN).parquet(f"{base}/arriving")
    query = incremental.write_run_stream(runs, f"{base}/runs", f"{base}/progress")
    query.trigger(availableNow=True).start().awaitTermination()
    latest = channels.latest_runs(spark.read.schema(CHANNEL_RUN).parquet(f"{base}/runs"))
    return latest.select("channel_id", "finished_at_utc", "comment_count")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "clean_text": clean_text_query,
    "clean_comments": clean_comments_query,
    "token_counts_video": counts_query(VIDEO),
    "token_counts_channel": counts_query(CHANNEL),
    "token_stats_video": stats_query(VIDEO, "arrival"),
    "token_stats_channel": stats_query(CHANNEL, None),
    "token_grouping_sets": grouping_sets_query,
    "ngrams": ngrams_query,
    "tfidf_video": tfidf_query(VIDEO, UNIGRAMS),
    "tfidf_channel": tfidf_query(CHANNEL, UNIGRAMS),
    "tfidf_bigrams": tfidf_query(VIDEO, BIGRAMS),
    "tfidf_keep_sentiment": tfidf_conversations_query(False),
    "tfidf_no_sentiment": tfidf_conversations_query(True),
    "tfidf_stemmed": tfidf_query(VIDEO, STEMS),
    "keyword_summary_video": summary_query(VIDEO, UNIGRAMS),
    "keyword_summary_channel": summary_query(CHANNEL, BIGRAMS),
    "df_thresholds": thresholds_query,
    "corpus_df": corpus_query,
    "tfidf_video_corpus": tfidf_query(VIDEO, UNIGRAMS, with_corpus=True),
    "tfidf_channel_corpus": tfidf_query(CHANNEL, UNIGRAMS, with_corpus=True),
    "distinctive_keywords": distinctive_query(False),
    "distinctive_keywords_corpus": distinctive_query(True),
    "flatten_comment_pages": flatten_comments_query,
    "flatten_video_pages": flatten_videos_query,
    "page_quarantine": quarantine_query,
    "cap_comments": cap_query,
    "discover_videos": discover_query,
    "run_summary": run_summary_query,
    "preprocess_totals": totals_query,
    "latest_runs": latest_runs_query,
    "upsert_refs": upsert_refs_query,
    "resolve_refs": resolve_refs_query,
    "normalize_video_refs": video_refs_query,
    "normalize_channel_refs": channel_refs_query,
    "version_guard": version_query,
    "missing_videos": missing_videos_query,
    "channel_comments": channel_comments_query,
    "tfidf_channel_members": membership_tfidf_query,
    "lift_guard": lift_guard_query,
    "channel_report": report_query,
    "stem_vocabulary": stem_query,
    "raw_round_trip": raw_round_trip_query,
    "clean_round_trip": clean_round_trip_query,
    "corpus_round_trip": corpus_round_trip_query,
    "artifact_round_trip": artifact_round_trip_query,
    "run_log": run_log_query,
    "stream_clean": stream_clean_query,
    "stream_quarantine": stream_quarantine_query,
    "stream_tfidf": stream_tfidf_query,
    "stream_corpus_df": stream_corpus_query,
    "stream_redelivered": stream_redelivered_query,
    "stream_df_upsert": stream_df_query,
    "stream_run_log": stream_runs_query,
}
