"""Channel reports as rows of text, from stored tables only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadlens.functions.times import report_time

# Sections in print order.
SECTIONS = ("head", "absent", "top_tokens", "top_keywords", "distinctive_keywords")


def three_decimals(number: Column) -> Column:
    return F.when(number == float("inf"), "inf").otherwise(F.format_string("%.3f", number))


def channel_report(
    runs: DataFrame,
    stats: DataFrame,
    keywords: DataFrame,
    distinctive: DataFrame | None = None,
    top_k: int = 30,
) -> DataFrame:
    """(channel_id, video_id, section, rank, token, line) for every channel that has a run.

    ``runs`` holds the latest run per channel, ``stats`` and ``keywords`` one artifact row
    per channel, ``distinctive`` one per (channel, video). Lists are cut at ``top_k``. A channel without stored statistics or
    keywords has one line that names what is absent. All lines of a channel are one array, so each table is read once (the
    runs once more for ``distinctive``).
    """
    joined = runs.join(
        stats.select(
            "channel_id", "preprocess_version", F.col("config_hash").alias("_stats_hash"), "top_tokens"
        ),
        "channel_id",
        "left",
    ).join(
        keywords.select("channel_id", F.col("config_hash").alias("_keywords_hash"), "keywords"),
        "channel_id",
        "left",
    )
    head = F.array(
        F.concat(F.lit("channel_id: "), F.col("channel_id")),
        F.format_string(
            "latest_run: videos=%d | comments=%d | errors=%d", "video_count", "comment_count", "error_count"
        ),
        F.concat(
            F.lit("run_window: after="), report_time(F.col("published_after")),
            F.lit(" | before="), report_time(F.col("published_before")),
        ),
        F.concat(
            F.lit("artifacts: preprocess_version="), F.col("preprocess_version"),
            F.lit(" | stats_config="), F.col("_stats_hash"),
            F.lit(" | tfidf_config="), F.col("_keywords_hash"),
        ),
    )
    missing = F.concat_ws(
        ", ",
        F.when(F.col("_stats_hash").isNull(), "token statistics"),
        F.when(F.col("_keywords_hash").isNull(), "keywords"),
    )
    none = F.lit(None).cast("string")
    lines = F.concat(
        F.transform(head, lambda line, i: _line("head", none, i + 1, none, line)),
        _list_lines("top_tokens", "top_tokens", none, _count, top_k),
        _list_lines("top_keywords", "keywords", none, _score, top_k),
    )
    absent = F.array(_line("absent", none, F.lit(0), none, F.concat(F.lit("no stored "), missing)))
    report = joined.select("channel_id", F.inline(F.when(missing == "", lines).otherwise(absent)))
    if distinctive is not None:
        compared = distinctive.select("channel_id", "video_id", "keywords").join(
            runs.select("channel_id"), "channel_id", "left_semi"
        )
        section = _list_lines("distinctive_keywords", "keywords", F.col("video_id"), _lift, top_k)
        report = report.unionByName(compared.select("channel_id", F.inline(section)))
    return report.select("channel_id", "video_id", "section", "rank", "token", "line")


def _line(section: str, video: Column, rank: Column, token: Column, line: Column) -> Column:
    return F.struct(
        F.lit(section).alias("section"), video.alias("video_id"), rank.cast("int").alias("rank"), token.alias("token"), line.alias("line")
    )


def _count(item: Column) -> Column:
    return F.concat(F.lit(" count="), item["count"].cast("string"))


def _score(item: Column) -> Column:
    return F.concat(F.lit(" score="), three_decimals(item["score"]), F.lit(" df="), item["df"].cast("string"))


def _lift(item: Column) -> Column:
    return F.concat(
        F.lit(" lift="), three_decimals(item["lift"]),
        F.lit(" video_df="), item["video_df"].cast("string"),
        F.lit(" channel_df="), item["channel_df"].cast("string"),
    )


def _list_lines(section: str, items: str, video: Column, tail: Callable[[Column], Column], top_k: int) -> Column:
    """One line per list entry, or one "(none)" line for an empty list."""

    def shown(item: Column, i: Column) -> Column:
        token = item["token"]
        # A token longer than the column is printed whole.
        padded = F.when(F.length(token) < 15, F.rpad(token, 15, " ")).otherwise(token)
        line = F.concat(F.lit(" "), F.format_string("%2d", i + 1), F.lit(". "), padded, tail(item))
        return _line(section, video, i + 1, token, line)

    nothing = F.array(_line(section, video, F.lit(0), F.lit(None).cast("string"), F.lit(" (none)")))
    return F.when(F.size(items) == 0, nothing).otherwise(F.transform(F.slice(items, 1, top_k), shown))


def report_order() -> list[Column]:
    """Print order of report rows."""
    section = F.array_position(F.array(*[F.lit(s) for s in SECTIONS]), F.col("section"))
    return [F.col("channel_id"), section, F.col("video_id"), F.col("rank")]


def preview(stats: DataFrame, items: int = 10) -> DataFrame:
    """Adds a one-line preview of the first top tokens."""
    shown = F.transform(F.slice("top_tokens", 1, items), lambda t: F.concat_ws(":", t["token"], t["count"]))
    text = F.when(F.size("top_tokens") == 0, "(none)").otherwise(F.array_join(shown, ", "))
    return stats.withColumn("preview", text)
