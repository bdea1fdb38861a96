"""TF-IDF keywords per video, channel or any other grain."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadlens.config import CORPUS_KEYWORDS_VERSION, LOCAL_KEYWORDS_VERSION, KeywordConfig
from threadlens.functions.text import ngram_size
from threadlens.operators.corpus import Corpus
from threadlens.operators.features import (
    dealt_once,
    feature_stats,
    frequent_stats,
    grain_totals,
    term_frequency_sum,
    token_rows,
)
from threadlens.operators.ranking import top_per_group
from threadlens.wordlists import SENTIMENT_EN

# Scores are compared at this many decimals, so equal scores tie whatever the last bit says.
RANK_DECIMALS = 12

# Parts that the features of a grain are dealt to where its totals join them; a power of two.
SALTS = 32


def df_band(documents: Column, config: KeywordConfig) -> tuple[Column, Column]:
    """Absolute document-frequency bounds for N documents.

    An int threshold is a count, a float one a share of N (rounded inwards). With no
    documents the band is (1, 0): nothing fits.
    """

    def absolute(value: int | float, rounded) -> Column:
        if isinstance(value, int):
            return F.lit(int(value)).cast("bigint")
        return rounded(F.lit(float(value)) * documents.cast("double")).cast("bigint")

    lowest = F.greatest(absolute(config.min_df, F.ceil), F.lit(0).cast("bigint"))
    highest = F.least(absolute(config.max_df, F.floor), documents.cast("bigint"))
    some = documents > 0
    return (
        F.when(some, lowest).otherwise(F.lit(1).cast("bigint")),
        F.when(some, highest).otherwise(F.lit(0).cast("bigint")),
    )


def df_thresholds(totals: DataFrame, config: KeywordConfig, corpus: Corpus | None = None) -> DataFrame:
    """Adds ``idf_documents``, ``min_df_abs`` and ``max_df_abs`` to the totals of each grain."""
    documents = F.col("doc_count_non_empty") if corpus is None else F.lit(corpus.video_count)
    out = totals.withColumn("idf_documents", documents.cast("bigint"))
    lowest, highest = df_band(F.col("idf_documents"), config)
    return out.withColumn("min_df_abs", lowest).withColumn("max_df_abs", highest)


def smooth_idf(documents: Column, df: Column) -> Column:
    return F.log((1.0 + documents.cast("double")) / (1.0 + df.cast("double"))) + 1.0


def has_sentiment(token: Column) -> Column:
    """True if any word of a keyword is general praise. Checked on final features,
    so a stem such as "amaz" is not caught. Few keywords hold such a word even as a part of one, which is cheap to see."""
    part = reduce(Column.__or__, [F.contains(token, F.lit(w)) for w in SENTIMENT_EN])
    return part & F.arrays_overlap(F.split(token, " "), F.array(*[F.lit(w) for w in SENTIMENT_EN]))


def _fits_ngram_df(df: Column, config: KeywordConfig) -> Column:
    if config.ngram_range[1] < 2:
        return F.lit(True)
    return (ngram_size(F.col("token")) < 2) | (df >= config.min_ngram_df)


def keyword_stats(
    comments: DataFrame, grain: Sequence[str], config: KeywordConfig, text: str = "text_clean"
) -> DataFrame:
    """The feature counts that local keywords of these grains are scored from. Features that the df rules drop whatever the
    totals leave at once, so the counts serve no other grain and no corpus. One pass: leaving out n-grams without support
    before they are counted (``supported_stats``) takes a second one, which costs more than it saves."""
    lowest = config.min_df if isinstance(config.min_df, int) else 1
    lowest_ngram = config.min_ngram_df if config.ngram_range[1] > 1 else lowest
    return dealt_once(frequent_stats(comments, grain, config, lowest, lowest_ngram, text), grain, _salt=_salt())


def _salt() -> Column:
    # Never NULL to the optimiser: a filter for that would be put below the shuffle of one side of the join only.
    return F.xxhash64("token").bitwiseAND(F.lit(SALTS - 1)).cast("int")


def scored_features(
    stats: DataFrame, grain: Sequence[str], config: KeywordConfig, corpus: Corpus | None = None
) -> DataFrame:
    """Every feature inside the df band with its score: the vocabulary of each grain."""
    keys = list(grain)
    totals = df_thresholds(grain_totals(stats, keys), config, corpus).select(
        *keys, "doc_count_non_empty", "idf_documents", "min_df_abs", "max_df_abs"
    )
    rows = token_rows(stats)
    dealt = ["_salt"] if "_salt" in stats.columns else []
    if corpus is None:
        # A fixed lower bound is known before the totals are: the long tail of rare tokens
        # leaves here and never reaches the join.
        if isinstance(config.min_df, int):
            rows = rows.where(F.col("df") >= config.min_df)
        rows = rows.select(*keys, *dealt, "token", "df", _tf_sum())
    else:
        rows = _with_corpus_df(rows.select(*keys, *dealt, "token", _tf_sum()), config, corpus)
    rows = rows.where(_fits_ngram_df(F.col("df"), config))
    # Totals are one row per grain and grow with the data, so the join is not forced to
    # broadcast: Spark decides by measured size. Shuffled, a grain's rows would all meet in one task, and the ranking
    # behind the join keeps Spark from splitting them: so they are dealt by token. A task holds its share of the totals in a
    # table, which saves sorting the features.
    rows = rows if dealt else rows.withColumn("_salt", _salt())
    salts = F.sequence(F.lit(0), F.lit(SALTS - 1))
    return (
        rows.join(totals.withColumn("_salt", F.explode(salts)).hint("shuffle_hash"), [*keys, "_salt"])
        .where(F.col("df").between(F.col("min_df_abs"), F.col("max_df_abs")))
        .withColumn("avg_tf", F.col("_tf_sum") / F.col("doc_count_non_empty"))
        .withColumn("idf", smooth_idf(F.col("idf_documents"), F.col("df")))
        .withColumn("score", F.col("avg_tf") * F.col("idf"))
        .select(*keys, "token", "score", "idf", "avg_tf", "df")
    )


def _tf_sum() -> Column:
    return term_frequency_sum().alias("_tf_sum")


def _with_corpus_df(rows: DataFrame, config: KeywordConfig, corpus: Corpus) -> DataFrame:
    """Takes df from the corpus; a token the corpus does not know has df 0."""
    lowest, highest = corpus_band(corpus.video_count, config)
    known = corpus.tokens.select("token", F.col("df_videos").alias("df"))
    if lowest >= 1:
        # df 0 is out of the band, so an inner join against the part of the corpus inside the
        # band keeps every result, and neither the rare tail nor the hottest tokens are joined.
        return rows.join(known.where(F.col("df").between(lowest, highest)), "token")
    return rows.join(known, "token", "left").withColumn(
        "df", F.coalesce("df", F.lit(0).cast("bigint"))
    )


def corpus_band(video_count: int, config: KeywordConfig) -> tuple[int, int]:
    """``df_band`` for the single N of a corpus, as plain numbers for pushed-down filters."""
    import math

    if video_count <= 0:
        return 1, 0
    low, high = config.min_df, config.max_df
    low = low if isinstance(low, int) else math.ceil(low * video_count)
    high = high if isinstance(high, int) else math.floor(high * video_count)
    return max(low, 0), min(high, video_count)


def rounded_score(score: Column) -> Column:
    """``round(score, RANK_DECIMALS)``, which Spark takes by way of decimal text. Where the digits to drop are not close to a half, the
    quotient of whole numbers is the same number."""
    scale = 10.0**RANK_DECIMALS
    scaled = score * scale
    plain = (scaled >= 0) & (scaled < 2.0**45) & (F.abs(scaled - F.floor(scaled) - 0.5) > 0.05)
    return F.when(plain, F.floor(scaled + 0.5) / scale).otherwise(F.round(score, RANK_DECIMALS))


def keyword_order() -> list[Column]:
    return [rounded_score(F.col("score")).desc(), F.col("df").desc(), F.col("token").asc()]


def top_keywords(
    scored: DataFrame, grain: Sequence[str], config: KeywordConfig, drop_sentiment: bool = True
) -> DataFrame:
    """Best ``top_k`` features per grain; sentiment words leave after scoring, before the cut."""
    kept = scored.where(~has_sentiment(F.col("token"))) if drop_sentiment else scored
    ranked = top_per_group(kept, grain, keyword_order(), config.top_k)
    return ranked.select(*grain, "rank", "token", "score", "idf", "avg_tf", "df")


def tfidf_keywords(
    comments: DataFrame,
    grain: Sequence[str],
    config: KeywordConfig,
    corpus: Corpus | None = None,
    drop_sentiment: bool = True,
    text: str = "text_clean",
) -> DataFrame:
    """Ranked keywords of every grain as rows: (grain, rank, token, score, idf, avg_tf, df).

    With a corpus, df and N come from it while term frequencies stay local.
    """
    if corpus is not None:
        corpus.require_compatible(config)
    counted = keyword_stats if corpus is None else feature_stats
    stats = counted(comments, grain, config, text)
    return top_keywords(scored_features(stats, grain, config, corpus), grain, config, drop_sentiment)


def keyword_summary(
    stats: DataFrame,
    grain: Sequence[str],
    config: KeywordConfig,
    corpus: Corpus | None = None,
    drop_sentiment: bool = True,
) -> DataFrame:
    """One row per grain: counts, thresholds, vocabulary size and the ranked keyword array.

    The vocabulary is counted inside the df band, before sentiment words leave. A grain
    without a single feature keeps its row with an empty list.
    """
    keys = list(grain)
    totals = df_thresholds(grain_totals(stats, keys), config, corpus)
    scored = scored_features(stats, keys, config, corpus)
    sizes = scored.groupBy(*keys).agg(F.count("*").alias("vocab_size"))
    lists = top_keywords(scored, keys, config, drop_sentiment).groupBy(*keys).agg(
        F.sort_array(
            F.collect_list(F.struct("rank", "token", "score", "avg_tf", "idf", "df"))
        ).alias("_ranked")
    )
    fields = ("token", "score", "avg_tf", "idf", "df")
    keywords = F.transform("_ranked", lambda k: F.struct(*[k[f].alias(f) for f in fields]))
    none = F.array().cast(
        "array<struct<token:string,score:double,avg_tf:double,idf:double,df:bigint>>"
    )
    version = LOCAL_KEYWORDS_VERSION if corpus is None else CORPUS_KEYWORDS_VERSION
    return (
        totals.join(sizes, keys, "left")
        .join(lists, keys, "left")
        .select(
            *keys,
            F.lit(version).alias("artifact_version"),
            "row_count",
            (F.col("row_count") - F.col("doc_count_non_empty")).alias("empty_text_count"),
            "doc_count_non_empty",
            F.coalesce("vocab_size", F.lit(0).cast("bigint")).alias("vocab_size"),
            "min_df_abs",
            "max_df_abs",
            F.coalesce(keywords, none).alias("keywords"),
        )
    )
