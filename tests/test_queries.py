"""Every registered query against its SQL on the smallest tables, and the shape of plans."""

from __future__ import annotations

import os

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from oracles import _stems
from threadlens.functions.stem import IRREGULAR, KEPT_AFTER_PLURAL, stem_word
from oracle_check import compare, duck
from threadlens.plans.job_queries import JOB_QUERIES
from threadlens.plans.table_queries import BIGRAMS, QUERIES, UNIGRAMS, VIDEO, documents
from threadlens.operators.corpus import corpus_df
from threadlens.operators.keywords import tfidf_keywords

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def connection():
    return duck(FOLDER)


@pytest.mark.parametrize("name", sorted({**QUERIES, **JOB_QUERIES}))
def test_query(spark, connection, name):
    sql = oracle_sql().get(name)
    if sql is None:
        assert queries()[name](spark, FOLDER).count() > 0
    else:
        assert compare(spark, connection, FOLDER, name, queries()[name], sql) is None


def test_every_query_has_sql():
    assert {*QUERIES, *JOB_QUERIES} <= set(oracle_sql())


def test_stems_in_sql_equal_the_package(connection):
    """Irregular words and some thousand made of beginnings and suffixes."""
    ends = ["", "s", "es", "ies", "ied", "ing", "ed", "ly", "ness", "fulness", "ization", "ational", "ement", "ion", "al", "ative", "ogi", "li"]
    ends += ["eed", "y", "ll", "e", "'s", "'", "'s'", "eedly", "ingly"]
    starts = "gener commun arsen hop hopp cat yel sky dy b at bl enjoy fluff rel activ nation real hopeful toy bee ski x yy proceed succ early a'b l2l cry".split()
    words = {a + b for a in starts for b in ends} | {a + b + c for a in starts[:14] for b in ends[8:] for c in ends[1:8]}
    words = sorted(words | {*IRREGULAR, *KEPT_AFTER_PLURAL})
    values = ", ".join("('" + w.replace("'", "''") + "')" for w in words)
    rows = connection.execute(f"WITH w(token) AS (VALUES {values}), {_stems('w')} SELECT token, stem FROM stems").fetchall()
    assert len(rows) == len(words) and [(w, s, stem_word(w)) for w, s in rows if s != stem_word(w)] == []


def test_entry(spark):
    assert entry(spark).columns == ["video_id", "rank", "token", "score", "idf", "avg_tf", "df"]


def test_keywords_scan_the_texts_once(spark):
    rows = tfidf_keywords(documents(spark, FOLDER), VIDEO, UNIGRAMS)
    rows.collect()
    plan = rows._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("FileScan") == 1 and "ReusedExchange" in plan
    assert plan.count("regexp_extract_all") == 1
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


@pytest.mark.parametrize("name", ["stream_corpus_df", "stream_tfidf"])
def test_streams_read_tables_that_are_folders(spark, connection, tmp_path, name):
    """Tables of several files are folders: a stream must find their rows too."""
    spark.read.parquet(f"{FOLDER}/documents.parquet").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    assert compare(spark, connection, str(tmp_path), name, queries()[name], oracle_sql()[name]) is None


def test_ngrams_take_one_pass_over_the_texts(spark):
    """Cleaning and taking words out are most of the work of keywords of n-grams, so they run once."""
    rows = tfidf_keywords(documents(spark, FOLDER), VIDEO, BIGRAMS)
    rows.collect()
    plan = rows._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("FileScan") == 1 and plan.count("regexp_extract_all") == 1


def test_pairs_of_the_corpus_leave_a_batch_once(spark):
    """Rows that reach the shuffle are distinct within a batch, whatever number of its comments hold the feature."""
    texts = ["red fox", "red fox red fox", "blue red fox"] * 50
    rows = spark.createDataFrame([("v", t) for t in texts], "video_id STRING, text_clean STRING").coalesce(1)
    corpus = corpus_df(rows, BIGRAMS)
    assert sorted(map(tuple, corpus.collect())) == [(t, 1) for t in ("blue", "blue red", "fox", "fox red", "red", "red fox")]
    plan = corpus._jdf.queryExecution().optimizedPlan().toString()
    assert "MapInArrow" in plan and "Generate" not in plan


def test_a_bucket_of_the_corpus_names_a_video_once(spark):
    """What is shuffled holds the id of a video once per slice and bucket, not once per feature; null ids are a video."""
    import pyarrow as pa

    from threadlens.functions.counts import BUCKET, dealt_batches

    texts = [("v", "red fox blue fox"), (None, "red fox"), ("v", "red fox"), ("w", ""), ("w", None), ("w", "blue"), (None, "red fox")]
    batch = pa.RecordBatch.from_pydict({
        "video_id": pa.array([v for v, _ in texts], pa.string()),
        "_runs": pa.array([[t] if t else [] for _, t in texts], pa.list_(pa.string())),
        "_blank": pa.array([not t for _, t in texts]),
    })
    for slice_chars in (1 << 20, 8):
        pairs = set()
        for dealt in dealt_batches([batch], 1, BIGRAMS, slice_chars=slice_chars):
            rows = dealt.to_pylist()
            assert len({r[BUCKET] for r in rows}) == len(rows)
            for row in rows:
                assert len(set(row["video_id"])) == len(row["video_id"]) == len(row["token"])
                pairs |= {(v, t) for v, tokens in zip(row["video_id"], row["token"]) for t in tokens.split("\n")}
        held = {"v": ["red", "fox", "blue", "red fox", "fox blue", "blue fox"], None: ["red", "fox", "red fox"], "w": ["blue"]}
        assert pairs == {(v, t) for v, tokens in held.items() for t in tokens}
    rows = spark.createDataFrame(texts * 3, "video_id STRING, text_clean STRING")
    df = {"red": 2, "fox": 2, "red fox": 2, "blue": 2, "fox blue": 1, "blue fox": 1}
    for parts in (1, 4):
        assert dict(map(tuple, corpus_df(rows.repartition(parts), BIGRAMS).collect())) == df
    assert corpus_df(rows.where("false"), BIGRAMS).collect() == []
