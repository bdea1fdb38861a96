"""Stored results: one row per key and kind, the corpus table, runs and reference maps."""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadlens.operators.channels import latest_runs, upsert_channel_refs
from threadlens.operators.corpus import Corpus, corpus_order
from threadlens.operators.guards import assert_unique
from threadlens.schemas import CHANNEL_REF, CHANNEL_RUN, CORPUS_META
from threadlens.sources.layers import read_keyed, write_keyed

# Kinds of artifacts and the key of each.
ARTIFACT_KEYS = {
    "token_stats": ["video_id"],
    "channel_token_stats": ["channel_id"],
    "tfidf": ["video_id"],
    "channel_tfidf": ["channel_id"],
    "distinctive_keywords": ["channel_id", "video_id"],
}


def artifact_path(root: str, kind: str) -> str:
    return f"{root}/gold/{kind}"


def write_artifact(rows: DataFrame, root: str, kind: str) -> None:
    """Replaces the artifacts of the keys in ``rows``."""
    write_keyed(rows, artifact_path(root, kind), ARTIFACT_KEYS[kind])


def read_artifact(
    spark: SparkSession, root: str, kind: str, values: Iterable[str] | None = None
) -> DataFrame:
    """Stored artifacts, all or those of some keys (the first key column); one row per key.

    A key that is asked for and not stored is an error.
    """
    wanted = None if values is None else sorted(set(values))
    rows = read_keyed(spark, artifact_path(root, kind), ARTIFACT_KEYS[kind][0], wanted)
    assert_unique(rows, ARTIFACT_KEYS[kind])
    if wanted is not None:
        assert_stored(rows, kind, wanted)
    return rows


def assert_stored(rows: DataFrame, kind: str, wanted: list[str]) -> None:
    """Every wanted key (a list that a user typed) has a row."""
    key = ARTIFACT_KEYS[kind][0]
    found = {row[0] for row in rows.select(key).where(F.col(key).isin(wanted)).distinct().collect()}
    if absent := [value for value in wanted if value not in found]:
        raise FileNotFoundError(f"no stored {kind} for {key} {absent}")


def explode_keywords(artifacts: DataFrame, *keys: str) -> DataFrame:
    """Stored keyword lists as rows, with their place in the list."""
    return artifacts.select(*keys, F.posexplode("keywords").alias("_pos", "_k")).select(
        *keys, (F.col("_pos") + 1).alias("rank"), "_k.*"
    )


def write_corpus(corpus: Corpus, spark: SparkSession, root: str) -> None:
    """Tall token table plus one row of facts. The facts name the token folder and are written
    last, so a failed run leaves the previous corpus in place."""
    folder = uuid.uuid4().hex
    # In order of df, so that a reader's df band skips most row groups.
    corpus.tokens.orderBy(*corpus_order()).write.parquet(f"{root}/gold/corpus_df/tokens/{folder}")
    facts = [
        (
            corpus.artifact_version,
            corpus.preprocess_version,
            corpus.config_hash,
            corpus.video_count,
            folder,
        )
    ]
    meta = spark.createDataFrame(facts, CORPUS_META + ", folder STRING")
    meta.coalesce(1).write.mode("overwrite").json(f"{root}/gold/corpus_df/meta")


def read_corpus(spark: SparkSession, root: str) -> Corpus:
    rows = spark.read.schema(CORPUS_META + ", folder STRING").json(f"{root}/gold/corpus_df/meta").head(2)
    if len(rows) != 1:
        raise ValueError(f"expected one corpus at {root}, found {len(rows)} or more")
    facts = rows[0]
    return Corpus(
        tokens=spark.read.parquet(f"{root}/gold/corpus_df/tokens/{facts['folder']}"),
        video_count=facts["video_count"],
        preprocess_version=facts["preprocess_version"],
        config_hash=facts["config_hash"],
        artifact_version=facts["artifact_version"],
    )


def import_corpus_row(row: DataFrame) -> Corpus:
    """A corpus kept as one row with parallel ``tokens`` and ``df_videos`` arrays, made tall."""
    facts = row.select(
        "artifact_version", "preprocess_version", "config_hash", "video_count",
        (F.size("tokens") == F.size("df_videos")).alias("aligned"),
    ).head(2)
    if len(facts) != 1:
        raise ValueError(f"expected one corpus row, found {len(facts)} or more")
    if not facts[0]["aligned"]:
        raise ValueError("tokens and df_videos of the corpus differ in length")
    tokens = row.select(F.inline(F.arrays_zip("tokens", "df_videos"))).withColumnRenamed("tokens", "token")
    return Corpus(
        tokens=tokens,
        video_count=facts[0]["video_count"],
        preprocess_version=facts[0]["preprocess_version"],
        config_hash=facts[0]["config_hash"],
        artifact_version=facts[0]["artifact_version"],
    )


def append_runs(runs: DataFrame, root: str) -> None:
    """Adds run records; nothing is ever replaced."""
    columns = [part.split()[0] for part in CHANNEL_RUN.split(", ")]
    runs.select(*columns).write.mode("append").parquet(f"{root}/gold/channel_runs")


def read_runs(spark: SparkSession, root: str) -> DataFrame:
    try:
        return spark.read.schema(CHANNEL_RUN).parquet(f"{root}/gold/channel_runs")
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(f"no channel runs under {root}") from error
        raise


def read_latest_runs(spark: SparkSession, root: str, channels: Iterable[str] | None = None) -> DataFrame:
    """Latest run of each channel; a wanted channel without any run is an error."""
    runs = read_runs(spark, root)
    if channels is None:
        return latest_runs(runs)
    wanted = sorted(set(channels))
    found = latest_runs(runs.where(F.col("channel_id").isin(wanted)))
    absent = set(wanted) - {row[0] for row in found.select("channel_id").collect()}
    if absent:
        raise FileNotFoundError(f"no channel runs of {sorted(absent)} under {root}")
    return found


def save_channel_refs(resolved: DataFrame, spark: SparkSession, root: str) -> None:
    """Merges resolutions (raw_ref, channel_id, resolved_at_utc) into the stored mapping."""
    try:
        stored = read_channel_refs(spark, root)
    except FileNotFoundError:
        stored = spark.createDataFrame([], CHANNEL_REF)
    merged = upsert_channel_refs(stored, resolved)
    write_keyed(merged, artifact_path(root, "channel_ref_mapping"), ["input_ref"])


def read_channel_refs(spark: SparkSession, root: str) -> DataFrame:
    return read_keyed(spark, artifact_path(root, "channel_ref_mapping"), "input_ref")
