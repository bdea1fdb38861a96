"""Cleaning, tokens, n-grams and stems, against worked examples."""

from __future__ import annotations

import random
import re
import unicodedata

import pytest
from pyspark.sql import functions as F

from threadlens.config import KeywordConfig, TokenRules
from threadlens.functions import text
from threadlens.functions.stem import stem_word
from threadlens.functions.text import clean_text, collapse_letters, is_blank, is_letter_pair_run
from threadlens.operators.features import document_features, document_tokens
from threadlens.wordlists import stopwords

PLAIN = dict(drop_stopwords=False)


def column(spark, values, expression):
    rows = spark.createDataFrame(list(enumerate(values)), "i INT, t STRING")
    return [r[0] for r in rows.orderBy("i").select(expression(F.col("t"))).collect()]


def features(spark, texts, config):
    rows = spark.createDataFrame(list(enumerate(texts)), "i INT, text_clean STRING")
    return [r[0] for r in document_features(rows, config).orderBy("i").select("features").collect()]


def test_clean_text(spark):
    texts = [
        "Hello   WORLD! https://example.com",
        "WWW.Site.org/a?b=c next",
        " \t  x y\x1cz ",
        "ＡＢ ﬁne ä",
        "",
        None,
    ]
    expected = ["hello world! <url>", "<url> next", "x y z", "ab fine ä", "", None]
    assert column(spark, texts, clean_text) == expected


def test_url_mark_is_taken_literally(spark):
    assert column(spark, ["see http://a.b c"], lambda c: clean_text(c, "[$1\\x]")) == ["see [$1\\x] c"]


def test_clean_text_agrees_with_plain_python(spark):
    random.seed(7)
    pieces = ["Ab", " ", "\n", " ", " ", "\x1f", "http://x.y/Z", "www.q", "Å", "ﬃ", "é", "İ", "!"]
    texts = ["".join(random.choices(pieces, k=random.randint(0, 12))) for _ in range(300)]

    def plain(text):
        text = unicodedata.normalize("NFKC", text)
        text = re.sub(r"https?://\S+|www\.\S+", "<URL>", text, flags=re.IGNORECASE).lower()
        return re.sub(r"\s+", " ", text).strip()

    assert column(spark, texts, clean_text) == [plain(t) for t in texts]


def test_blank(spark):
    assert column(spark, [None, "", "  \t", " a"], is_blank) == [True, True, True, False]


def test_letter_rules(spark):
    assert column(spark, ["cooooooooool", "hiiiiii", "aab", "AAAa"], collapse_letters) == ["cool", "hii", "aab", "AAa"]
    words = ["lololo", "xdxdxd", "cat", "banana", "lololol", "hahahaha"]
    assert column(spark, words, is_letter_pair_run) == [True, True, False, False, False, True]


def test_token_filters(spark):
    config = TokenRules()
    rows = spark.createDataFrame(
        [("Hiiiiiiii gooooood content it's 123 1a x hahaha don't",)], "text_clean STRING"
    )
    got = document_tokens(rows, config).first()["tokens"]
    assert got == ["good", "content", "1a", "don't"]
    keep = TokenRules(drop_numeric_tokens=False, min_token_len=1, lowercase=False, drop_stopwords=False)
    got = document_tokens(rows, keep).first()["tokens"]
    assert got == ["Hii", "good", "content", "it's", "123", "1a", "x", "don't"]


def test_unknown_language_and_mode():
    with pytest.raises(ValueError):
        stopwords("xx")
    with pytest.raises(ValueError):
        TokenRules(stopwords_lang="xx")
    with pytest.raises(ValueError):
        TokenRules(normalization="lemma")


@pytest.mark.parametrize(
    "ngram_range, expected",
    [
        ((1, 1), ["love", "beautiful", "cat"]),
        ((2, 2), ["love beautiful", "beautiful cat"]),
        ((1, 2), ["love", "beautiful", "cat", "love beautiful", "beautiful cat"]),
        ((3, 4), ["love beautiful cat"]),
        ((4, 4), []),
    ],
)
def test_ngrams(spark, ngram_range, expected):
    assert features(spark, ["love beautiful cat"], KeywordConfig(ngram_range=ngram_range)) == [expected]


def test_ngrams_of_short_and_missing_texts(spark):
    assert features(spark, ["love", "", None], KeywordConfig(ngram_range=(2, 2))) == [[], [], []]


@pytest.mark.parametrize("settings", [dict(ngram_range=(2, 1)), dict(ngram_range=(0, 1)), dict(min_ngram_df=0)])
def test_invalid_ngram_settings(settings):
    with pytest.raises(ValueError):
        KeywordConfig(**settings)


def test_stems_come_before_ngrams(spark):
    config = KeywordConfig(normalization="stem_en", ngram_range=(1, 2), **PLAIN)
    got = features(spark, ["Relaxing sound Relaxing", None, "relaxed relax"], config)
    assert got == [["relax", "sound", "relax", "relax sound", "sound relax"], [], ["relax", "relax", "relax relax"]]


# Published examples of the algorithm.
STEMS = {
    "caresses": "caress", "ties": "tie", "cries": "cri", "gas": "gas", "gaps": "gap", "kiwis": "kiwi",
    "agreed": "agre", "feed": "feed", "hoping": "hope", "hopping": "hop", "luxuriated": "luxuri",
    "cry": "cri", "by": "by", "say": "say", "consign": "consign", "consigned": "consign",
    "consistency": "consist", "consolations": "consol", "conspicuously": "conspicu", "knightly": "knight",
    "knots": "knot", "generically": "generic", "communication": "communic", "skies": "sky", "dying": "die",
    "news": "news", "inning": "inning", "innings": "inning", "succeeding": "succeed", "national": "nation",
    "rational": "ration", "hopefulness": "hope", "activities": "activ", "replacement": "replac",
    "adoption": "adopt", "falling": "fall", "amazing": "amaz", "yes's": "yes", "relaxing": "relax",
    "happily": "happili", "analogies": "analog", "controlling": "control", "sensibilities": "sensibl",
}


def test_stem_examples():
    assert {w: stem_word(w) for w in STEMS} == STEMS


def test_composing_holds_few_texts_as_python_strings():
    import tracemalloc

    import pyarrow as pa

    batch = pa.array(["é" + "x" * 10_000, None] * 1000)
    tracemalloc.start()
    composed = text._compose.func(batch)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(composed) == 2000 and composed[0].as_py() == "\xe9" + "x" * 10_000 and composed[1].as_py() is None
    assert peak < 8_000_000


@pytest.mark.parametrize("slice_chars", [1, 40, 1 << 24])
def test_counts_of_a_batch_add_up_whatever_its_slices(slice_chars):
    import pyarrow as pa

    from threadlens.functions.counts import WEIGHT_BITS, count_batches

    draw = random.Random(3)
    texts = [draw.choices(["Red", "fox", "owl", "12", "the", "coooool"], k=draw.randint(0, 7)) for _ in range(60)]
    videos = [draw.choice(["a", "b", None]) for _ in texts]
    runs = [[" ".join(t[:2]), " ".join(t[2:])] if len(t) > 2 else [" ".join(t)] * bool(t) for t in texts]
    arrivals = [draw.choice([None, *range(60)]) for _ in texts]
    types = [pa.string(), pa.list_(pa.string()), pa.bool_(), pa.int64()]
    columns = [pa.array(c, t) for c, t in zip((videos, runs, [not t for t in texts], arrivals), types)]
    batch = pa.RecordBatch.from_arrays(columns, names=["video_id", "_runs", "_blank", "_arrival"])
    names = ["docs", "blank", "df", "n", "w2", "w1", "w0"]
    whole = {}
    for out in count_batches([batch], 1, KeywordConfig(ngram_range=(1, 3)), names, slice_chars=slice_chars):
        for row in out.to_pylist():
            key = row["video_id"], row["token"]
            sums, seen = whole.setdefault(key, ([0] * 7, []))
            whole[key] = [a + row[n] for a, n in zip(sums, names)], [*seen, (row["first_arrival"], row["first_position"])]

    expected = {}
    for video, text, arrival in zip(videos, texts, arrivals):
        words = [{"Red": "red", "coooool": "cool"}.get(w, w) for w in text if w not in ("12", "the")]
        grams = [" ".join(words[i : i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)]
        unit = (1 << WEIGHT_BITS) // max(len(grams), 1)
        limbs = [unit >> 40, unit >> 20 & 0xFFFFF, unit & 0xFFFFF]
        add = {None: [1, not text, bool(grams), 0, 0, 0, 0]}
        add |= {g: [0, 0, 1, grams.count(g), *[grams.count(g) * limb for limb in limbs]] for g in grams}
        for token, counts in add.items():
            sums, seen = expected.setdefault((video, token), ([0] * 7, []))
            expected[video, token] = [a + b for a, b in zip(sums, counts)], seen
            if token and arrival is not None:
                seen.append((arrival, grams.index(token)))
    assert {k: v[0] for k, v in whole.items()} == {k: v[0] for k, v in expected.items()}
    for key, (_, seen) in whole.items():
        known = [s for s in seen if s[0] is not None]
        assert (min(known)[0] if known else None) == min((s[0] for s in expected[key][1]), default=None)
        assert all(s in expected[key][1] for s in known)
