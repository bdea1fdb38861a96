"""Token statistics, TF-IDF, corpus and lift, against worked examples and brute force."""

from __future__ import annotations

import math
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from threadlens.config import (
    KeywordConfig,
    TokenStatsConfig,
    config_hash,
    corpus_config_hash,
    keyword_config_hash,
    parse_threshold,
    stopwords_hash,
    threshold_text,
)
from threadlens.operators.corpus import Corpus, build_corpus, corpus_df
from threadlens.operators.distinctive import distinctive_keywords
from threadlens.functions import counts
from threadlens.operators.features import feature_stats, frequent_stats, roll_up, supported_stats
from threadlens.operators.keywords import (
    df_band,
    has_sentiment,
    keyword_stats,
    keyword_summary,
    rounded_score,
    scored_features,
    tfidf_keywords,
    top_keywords,
)
from threadlens.operators.ranking import top_per_group
from threadlens.operators.stats import token_grouping_sets, token_stats, token_stats_from
from threadlens.sources.artifacts import import_corpus_row

V1 = ["i love that cat", "this cat is amazing", "amazing winter love it"]
V2 = ["beautiful cat", ""]
V3 = ["love that cat", "amazing"]
OPEN = dict(min_df=1, max_df=1.0)


def comments(spark, channel="c", **videos):
    rows = [
        (channel, video, text, i)
        for video, texts in videos.items()
        for i, text in enumerate(texts)
    ]
    return spark.createDataFrame(
        rows, "channel_id STRING, video_id STRING, text_clean STRING, arrival BIGINT"
    ).repartition(3)


def ranked(frame, *fields):
    return [tuple(r[f] for f in fields) for r in frame.orderBy("rank").collect()]


def corpus(spark, config, size, **df):
    tokens = spark.createDataFrame([(k.replace("_", " "), v) for k, v in df.items()], "token STRING, df_videos BIGINT")
    return Corpus(tokens, size, "v1", corpus_config_hash(config))


def test_video_stats(spark):
    rows = comments(spark, v=["hello world", "amazing cat", "", None, "world world 123"])
    got = token_stats(rows, ["video_id"], TokenStatsConfig(), arrival="arrival").first()
    assert (got.row_count, got.empty_text_count, got.total_token_count, got.unique_token_count) == (5, 2, 5, 3)
    assert [tuple(t) for t in got.top_tokens] == [("world", 3), ("amazing", 1), ("cat", 1)]


def test_ties_go_to_the_first_seen(spark):
    rows = comments(spark, v=["zebra apple", "mango zebra zebra", "apple apple", "banana"])
    got = token_stats(rows, ["video_id"], TokenStatsConfig(), arrival="arrival").first()
    assert [tuple(t) for t in got.top_tokens] == [("zebra", 3), ("apple", 3), ("mango", 1), ("banana", 1)]
    got = token_stats(rows, ["video_id"], TokenStatsConfig(top_n_tokens=3)).first()
    assert [tuple(t) for t in got.top_tokens] == [("apple", 3), ("zebra", 3), ("banana", 1)]


def test_channel_stats(spark):
    rows = comments(spark, v1=["amazing cat", ""], v2=["funny cat", "hi"])
    got = token_stats(rows, ["channel_id"], TokenStatsConfig()).first()
    assert (got.row_count, got.empty_text_count, got.total_token_count, got.unique_token_count) == (4, 1, 4, 3)
    assert [tuple(t) for t in got.top_tokens] == [("cat", 2), ("amazing", 1), ("funny", 1)]


def test_a_grain_without_tokens_keeps_its_row(spark):
    rows = comments(spark, full=["nice cat"], bare=["", None])
    got = {r.video_id: r for r in token_stats(rows, ["video_id"], TokenStatsConfig()).collect()}
    assert (got["bare"].total_token_count, got["bare"].top_tokens) == (0, [])


def test_video_tfidf(spark):
    config = KeywordConfig(**OPEN)
    rows = comments(spark, v=V1)
    got = tfidf_keywords(rows, ["video_id"], config, drop_sentiment=False)
    assert ranked(got, "token", "df") == [("cat", 2), ("amazing", 2), ("love", 2), ("winter", 1)]
    by_token = {r.token: r for r in got.collect()}
    for token, avg_tf in {"cat": 1 / 3, "love": 5 / 18, "amazing": 5 / 18, "winter": 1 / 9}.items():
        row = by_token[token]
        idf = math.log(4 / (1 + row.df)) + 1
        assert row.avg_tf == pytest.approx(avg_tf, abs=1e-12)
        assert row.idf == pytest.approx(idf, abs=1e-12)
        assert row.score == pytest.approx(avg_tf * idf, abs=1e-12)


def test_min_df_and_vocabulary(spark):
    config = KeywordConfig(min_df=2, max_df=1.0)
    stats = feature_stats(comments(spark, v=V1), ["video_id"], config)
    got = keyword_summary(stats, ["video_id"], config).first()
    # The vocabulary is counted before sentiment words leave.
    assert (got.doc_count_non_empty, got.vocab_size, got.min_df_abs, got.max_df_abs) == (3, 3, 2, 3)
    assert [k.token for k in got["keywords"]] == ["cat"]


def test_only_noise(spark):
    stats = feature_stats(comments(spark, v=["", None, "1 22 333"]), ["video_id"], KeywordConfig())
    got = keyword_summary(stats, ["video_id"], KeywordConfig()).first()
    assert (got.row_count, got.empty_text_count, got.doc_count_non_empty, got.vocab_size) == (3, 3, 0, 0)
    assert (got.min_df_abs, got.max_df_abs, got["keywords"]) == (1, 0, [])


def test_ngram_df(spark):
    config = KeywordConfig(**OPEN, ngram_range=(1, 2), min_ngram_df=2)
    rows = comments(spark, v=["amazing cat", "amazing cat", "funny dog", "cool vid"])
    got = {r.token for r in tfidf_keywords(rows, ["video_id"], config, drop_sentiment=False).collect()}
    assert {"amazing cat", "dog", "cat"} <= got and "funny dog" not in got and "vid" not in got


@pytest.mark.parametrize("bits", [64, 1 << 12])
@pytest.mark.parametrize("span, support", [((1, 2), 2), ((2, 2), 2), ((1, 3), 3), ((2, 3), 2), ((1, 1), 2), ((1, 2), 1)])
def test_words_without_support_spare_their_ngrams(spark, bits, span, support):
    draw = random.Random(4)
    vocabulary = [a + b for a in ("red", "blue", "green", "gold") for b in ("cat", "dog", "owl", "bee", "fox", "ant", "yak")]
    texts = {v: [" ".join(draw.choices(vocabulary, k=draw.randint(0, 9))) for _ in range(40)] + ["", None] for v in ("a", "b")}
    rows = comments(spark, **texts, c=["lonecat"], d=[None])
    config = KeywordConfig(ngram_range=span, min_ngram_df=support)
    whole = {(r.video_id, r.token): tuple(r) for r in feature_stats(rows, ["video_id"], config).collect()}
    found = supported_stats(rows, ["video_id"], config, support, support_bits=bits).collect()
    got = {(r.video_id, r.token): tuple(r) for r in found}
    assert len(got) == len(found) and all(whole[k] == r for k, r in got.items())
    must = {k for k, r in whole.items() if k[1] is None or " " not in k[1] or r[4] >= support}
    assert must <= got.keys()
    if bits > 64 and support > 1 and span[1] > 1:
        assert len(got) < len(whole)


def test_sentiment_words_leave_whole_ngrams(spark):
    config = KeywordConfig(**OPEN, ngram_range=(1, 2), min_ngram_df=1)
    rows = comments(spark, v=["amazing cat", "funny dog"])
    got = {r.token for r in tfidf_keywords(rows, ["video_id"], config).collect()}
    assert got == {"cat", "funny", "dog", "funny dog"}
    stems = KeywordConfig(**OPEN, normalization="stem_en")
    assert "amaz" in {r.token for r in tfidf_keywords(rows, ["video_id"], stems).collect()}


def test_channel_tfidf(spark):
    config = KeywordConfig(**OPEN)
    rows = comments(spark, v1=V1, v2=V2, v3=V3)
    stats = feature_stats(rows, ["channel_id"], config)
    summary = keyword_summary(stats, ["channel_id"], config, drop_sentiment=False).first()
    assert (summary.row_count, summary.empty_text_count, summary.doc_count_non_empty, summary.vocab_size) == (7, 1, 6, 5)
    assert [(k.token, k.df) for k in summary["keywords"]] == [
        ("amazing", 3), ("cat", 4), ("love", 3), ("beautiful", 1), ("winter", 1),
    ]
    avg = {k.token: k.avg_tf for k in summary["keywords"]}
    assert avg == pytest.approx(
        {"amazing": 11 / 36, "cat": 2 / 6, "love": 4 / 18, "winter": 1 / 18, "beautiful": 1 / 12}, abs=1e-12
    )


def test_rolled_up_counts_equal_direct_ones(spark):
    config = KeywordConfig(**OPEN)
    rows = comments(spark, v1=V1, v2=V2, v3=V3)
    rolled = roll_up(feature_stats(rows, ["channel_id", "video_id"], config), ["channel_id"])
    direct = feature_stats(rows, ["channel_id"], config)
    assert sorted(map(str, rolled.collect())) == sorted(map(str, direct.collect()))
    stats = token_stats_from(rolled, ["channel_id"], TokenStatsConfig()).first()
    assert (stats.row_count, stats.empty_text_count) == (7, 1)


def test_grouping_sets(spark):
    rows = comments(spark, v1=["red red blue"], v2=["red"])
    got = {(r.level, r.key, r.token): r["count"] for r in token_grouping_sets(rows, "video_id", "channel_id", TokenStatsConfig()).collect()}
    assert got == {
        ("video", "v1", "red"): 2, ("video", "v1", "blue"): 1, ("video", "v2", "red"): 1,
        ("channel", "c", "red"): 3, ("channel", "c", "blue"): 1, ("all", None, "red"): 3, ("all", None, "blue"): 1,
    }


@pytest.mark.parametrize(
    "low, high, n, band",
    [
        (2, 0.9, 10, (2, 9)), (0.05, 0.9, 30, (2, 27)), (1, 1.0, 4, (1, 4)), (1, 1, 4, (1, 1)),
        (1.0, 1.0, 4, (4, 4)), (-3, 99, 4, (0, 4)), (2, 0.9, 0, (1, 0)), (3, 1, 9, (3, 1)),
    ],
)
def test_df_band(spark, low, high, n, band):
    lowest, highest = df_band(F.col("n"), KeywordConfig(min_df=low, max_df=high))
    row = spark.createDataFrame([(n,)], "n BIGINT").select(lowest, highest).first()
    assert tuple(row) == band


def test_corpus(spark):
    config = KeywordConfig(ngram_range=(1, 2))
    rows = comments(spark, vid1=["amazing cat", "amazing cat"], vid2=["funny dog", "amazing dog"], vid3=[""])
    built = build_corpus(rows, config, "v1")
    assert built.video_count == 3
    df = {r.token: r.df_videos for r in built.tokens.collect()}
    assert (df["amazing"], df["cat"], df["dog"], df["amazing cat"]) == (2, 1, 1, 1)
    stats = feature_stats(rows, ["video_id"], config)
    assert {r.token: r.df_videos for r in build_corpus(rows, config, "v1", stats=stats).tokens.collect()} == df


def test_corpus_takes_over_df_and_size(spark):
    config = KeywordConfig(**OPEN, ngram_range=(1, 2), min_ngram_df=1)
    rows = comments(spark, v=["amazing cat", "amazing cat"])
    wide = corpus(spark, config, 10, amazing=7, cat=5, amazing_cat=2)
    got = {r.token: r for r in tfidf_keywords(rows, ["video_id"], config, wide, drop_sentiment=False).collect()}
    assert {t: r.df for t, r in got.items()} == {"amazing": 7, "cat": 5, "amazing cat": 2}
    assert got["cat"].idf == pytest.approx(math.log(11 / 6) + 1)
    assert got["cat"].avg_tf == pytest.approx(1 / 3)


def test_corpus_and_unknown_tokens(spark):
    config = KeywordConfig(min_df=0, max_df=1.0)
    rows = comments(spark, v=["bird cat"])
    got = {r.token: r.df for r in tfidf_keywords(rows, ["video_id"], config, corpus(spark, config, 9, cat=5)).collect()}
    assert got == {"cat": 5, "bird": 0}
    strict = KeywordConfig(**OPEN)
    got = tfidf_keywords(rows, ["video_id"], strict, corpus(spark, strict, 9, cat=5))
    assert [r.token for r in got.collect()] == ["cat"]


def test_channel_with_corpus(spark):
    config = KeywordConfig(**OPEN)
    rows = comments(spark, v1=["cat dog"], v2=["bird cat"])
    got = tfidf_keywords(rows, ["channel_id"], config, corpus(spark, config, 100, cat=50, dog=10, bird=5))
    assert ranked(got, "token", "df")[0] in [("cat", 50), ("bird", 5), ("dog", 10)]
    scores = {r.token: r.score for r in got.collect()}
    assert scores["bird"] > scores["dog"]


def test_corpus_guard(spark):
    config = KeywordConfig(**OPEN)
    other = corpus(spark, KeywordConfig(ngram_range=(1, 2)), 3, cat=1)
    with pytest.raises(ValueError, match="config hash"):
        tfidf_keywords(comments(spark, v=["cat"]), ["video_id"], config, other)
    with pytest.raises(ValueError, match="version"):
        corpus(spark, config, 3, cat=1).require_compatible(config, "v2")
    # The same corpus serves every df band and top-k.
    corpus(spark, config, 3, cat=1).require_compatible(KeywordConfig(min_df=7, top_k=1))


def test_one_row_corpus_import(spark):
    schema = "artifact_version STRING, preprocess_version STRING, config_hash STRING, video_count BIGINT, tokens ARRAY<STRING>, df_videos ARRAY<BIGINT>"
    row = spark.createDataFrame([("corpus_v1", "v1", "h", 4, ["cat", "dog"], [3, 1])], schema)
    got = import_corpus_row(row)
    assert got.video_count == 4 and sorted(map(tuple, got.tokens.collect())) == [("cat", 3), ("dog", 1)]
    with pytest.raises(ValueError, match="length"):
        import_corpus_row(spark.createDataFrame([("corpus_v1", "v1", "h", 4, ["cat"], [3, 1])], schema))


def keyword_rows(spark, *rows):
    return spark.createDataFrame(list(rows), "channel_id STRING, video_id STRING, token STRING, score DOUBLE, df BIGINT")


def test_lift(spark):
    theirs = keyword_rows(spark, ("c", None, "cat", 0.81, 10), ("c", None, "amazing", 0.63, 8), ("c", None, "dog", 0.49, 5))
    mine = keyword_rows(spark, ("c", "v", "amazing", 0.63, 8), ("c", "v", "video", 0.49, 5), ("c", "w", "cat", 1.62, 3))
    got = distinctive_keywords(mine, theirs, 30)
    v = ranked(got.where("video_id = 'v'"), "token", "lift", "channel_score", "channel_df")
    assert v == [("video", math.inf, 0.0, 0), ("amazing", 1.0, 0.63, 8)]
    assert ranked(got.where("video_id = 'w'"), "lift") == [(2.0,)]
    assert distinctive_keywords(mine, theirs, 1).where("video_id = 'v'").count() == 1


def test_hashes_and_thresholds():
    plain, stems = KeywordConfig(), KeywordConfig(normalization="stem_en")
    assert config_hash(plain) != config_hash(stems)
    assert keyword_config_hash(plain) != config_hash(plain)
    assert corpus_config_hash(plain) == corpus_config_hash(KeywordConfig(min_df=5, top_k=1))
    assert corpus_config_hash(plain) != corpus_config_hash(stems)
    # Known digest of compact, key-sorted JSON: sha256('{"a":[1,2],"b":"é"}').
    import hashlib

    assert config_hash({"b": "é", "a": (1, 2)}) == hashlib.sha256('{"a":[1,2],"b":"é"}'.encode()).hexdigest()[:16]
    assert len(stopwords_hash("en")) == 16
    for value in (2, 0.9, 1, 1.0, 1e-05):
        assert parse_threshold(threshold_text(value)) == value
        assert type(parse_threshold(threshold_text(value))) is type(value)
    assert threshold_text(True) == "1"


def test_big_k_is_exact(spark):
    random.seed(3)
    rows = [(g, random.randint(0, 10**6)) for g in ["hot"] * 6000 + ["cold"] * 5]
    frame = spark.createDataFrame(rows, "g STRING, x BIGINT")
    got = top_per_group(frame, ["g"], [F.col("x").desc()], 1500)
    expected = sorted((x for g, x in rows if g == "hot"), reverse=True)[:1500]
    assert [r.x for r in got.where("g = 'hot'").orderBy("rank").collect()] == expected
    assert got.where("g = 'cold'").count() == 5


@pytest.mark.parametrize("ngram_range, min_df, max_df", [((1, 1), 2, 0.9), ((1, 3), 0.02, 0.5)])
def test_against_brute_force(spark, ngram_range, min_df, max_df):
    """Random comments with a hot video that holds a third of them."""
    random.seed(11)
    words = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(60)]
    data = []
    for i in range(900):
        video = "hot" if i % 3 == 0 else f"v{random.randint(0, 9)}"
        text = " ".join(random.choices(words, weights=range(1, 61), k=random.randint(0, 9)))
        data.append(("c", video, text, i))
    rows = spark.createDataFrame(data, "channel_id STRING, video_id STRING, text_clean STRING, arrival BIGINT")
    config = KeywordConfig(ngram_range=ngram_range, min_df=min_df, max_df=max_df, top_k=15)
    got = defaultdict(dict)
    for r in tfidf_keywords(rows.repartition(7), ["video_id"], config).collect():
        got[r.video_id][r["rank"]] = (r.token, r.df, round(r.score, 10))

    documents = defaultdict(list)
    for _, video, text, _ in data:
        tokens = text.split()
        grams = [" ".join(tokens[i:i + n]) for n in range(ngram_range[0], ngram_range[1] + 1) for i in range(len(tokens) - n + 1)]
        if grams:
            documents[video].append(grams)
    for video, docs in documents.items():
        df, tf = Counter(), defaultdict(float)
        for grams in docs:
            for token, count in Counter(grams).items():
                df[token] += 1
                tf[token] += count / len(grams)
        n = len(docs)
        low = min_df if isinstance(min_df, int) else math.ceil(min_df * n)
        high = math.floor(max_df * n)
        scored = [
            (t, d, tf[t] / n * (math.log((1 + n) / (1 + d)) + 1))
            for t, d in df.items()
            if low <= d <= high and (" " not in t or d >= 2)
        ]
        scored.sort(key=lambda s: (-round(s[2], 12), -s[1], s[0]))
        expected = {i: (t, d, round(s, 10)) for i, (t, d, s) in enumerate(scored[:15], 1)}
        assert got.get(video, {}) == expected


def test_the_features_of_one_grain_meet_its_totals_in_many_tasks(spark):
    words = " ".join(f"word{i}" for i in range(100))
    rows = spark.createDataFrame([("c", words)] * 3, "channel_id string, text_clean string")
    config = KeywordConfig(min_df=1, max_df=1.0)
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        scored = scored_features(feature_stats(rows, ["channel_id"], config), ["channel_id"], config)
        assert scored.count() == 100
        assert scored.select(F.spark_partition_id()).distinct().count() > 1
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


ODD = [
    ("v", "red fox red fox"), ("v", "red fox"), ("v", "the red-fox; ümlaut's fox"), ("v", None), ("v", "  "), (None, "red fox"),
    (None, "red fox fox"), ("", "fox"), ("w", "..."), ("x", "don't 12 haha hahahaha fooool fox"), ("x", "don't fox\tfox\nfox"),
]


@pytest.mark.parametrize("lowest, lowest_ngram", [(1, 1), (2, 2), (2, 3), (3, 1)])
def test_packed_counts_are_feature_stats(spark, lowest, lowest_ngram):
    rows = spark.createDataFrame(ODD * 2 + [("v", "once only")], "video_id STRING, text_clean STRING").repartition(5)
    config = KeywordConfig(ngram_range=(1, 3))
    enough = F.col("df") >= F.when(F.col("token").contains(" "), max(lowest, lowest_ngram)).otherwise(lowest)
    expected = feature_stats(rows, ["video_id"], config).where((F.col("docs") > 0) | enough)
    got = frequent_stats(rows, ["video_id"], config, lowest, lowest_ngram)
    assert Counter(map(tuple, got.collect())) == Counter(map(tuple, expected.collect()))


def test_packed_counts_of_small_slices_and_merges(spark):
    """The same sums however often a batch is cut and however few buckets are summed at a time."""
    import pyarrow as pa

    texts = [f"word{i % 3} word{i % 5} word{i % 7}" for i in range(60)]
    columns = {"k": ["a", None, "b"] * 20, "_hash": [1, 2, 3] * 20, "_runs": [[t] for t in texts], "_blank": [False] * 60}
    batch = pa.RecordBatch.from_pydict(columns)
    names, config, found = ["docs", "blank", "df", "n", "w2", "w1", "w0"], KeywordConfig(ngram_range=(1, 2)), []
    for chars, merged in ((1 << 23, 1 << 24), (40, 1 << 24), (40, 1)):
        packed = pa.Table.from_batches(list(counts.packed_batches([batch], 1, config, names, slice_chars=chars))).sort_by(counts.BUCKET)
        sums = counts.merge_batches(packed.to_batches(max_chunksize=7), ["k"], names, merge_bytes=merged)
        found.append(Counter(tuple(row.values()) for part in sums for row in part.to_pylist()))
    assert found[0] == found[1] == found[2] and max(found[0].values()) == 1
    assert sum(row[2] for row in found[0] if row[1] is None) == 60


def test_rare_features_are_never_rows(spark):
    """Most features are in one document only: they are counted and dropped in Arrow, without an aggregation of Spark's rows."""
    rows = spark.createDataFrame(ODD, "video_id STRING, text_clean STRING")
    stats = keyword_stats(rows, ["video_id"], KeywordConfig(ngram_range=(1, 2)))
    assert "Aggregate" not in stats._jdf.queryExecution().optimizedPlan().toString()
    assert {r.token for r in stats.collect()} == {None, "red", "fox", "red fox", "don't"}


def test_rounded_score_is_round(spark):
    chance = random.Random(1)
    values = [chance.random() * 10.0 ** chance.randint(-13, 4) for _ in range(20_000)]
    values += [n * 1e-12 + d for n in (0, 1, 7, 123456789012) for d in (0, 4.9e-13, 5e-13, 5.1e-13)]
    values += [0.0, -0.0, -1.5e-12, -0.3, 1e300, 2.0**45 / 1e12, float("inf"), float("nan"), None]
    rows = spark.createDataFrame([(v,) for v in values], "score DOUBLE")
    same = rounded_score(F.col("score")).eqNullSafe(F.round("score", 12))
    assert rows.where(~same).collect() == []


def test_sentiment_words_are_whole_words(spark):
    words = ["best", "bestow", "a best", "best a", "the bestow", "topic top", "top's", "", None, "x y love", "glove"]
    rows = spark.createDataFrame([(w,) for w in words], "token STRING")
    assert [r[0] for r in rows.coalesce(1).where(has_sentiment(F.col("token"))).collect()] == ["best", "a best", "best a", "topic top", "x y love"]
