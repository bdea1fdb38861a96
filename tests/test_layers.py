"""Sources, guards, references, jobs from raw pages to the report, and streams."""

from __future__ import annotations

import json
from datetime import datetime, timedelta, timezone
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from threadlens.config import KeywordConfig, TokenStatsConfig, require_utc
from threadlens.functions.times import iso_utc, parse_utc, report_time, run_stamp
from threadlens.operators import channels, guards
from threadlens.operators.cleaning import clean_comments
from threadlens.operators.keywords import scored_features, tfidf_keywords, top_keywords
from threadlens.operators.report import preview, three_decimals
from threadlens.plans import jobs
from threadlens.schemas import CHANNEL_REF, RAW_COMMENT
from threadlens.sources import artifacts, comments as store, pages, parts
from threadlens.sources.layers import read_keyed, write_keyed
from threadlens.streaming import incremental

UTC = timezone.utc
CHANNEL = "UC" + "a" * 22


def when(*parts):
    return datetime(*parts, tzinfo=UTC)


def test_clean_comments(spark):
    schema = "video_id STRING, comment_id STRING, text STRING, author STRING, like_count BIGINT, published_at STRING, is_reply BOOLEAN"
    rows = [
        ("v", "c1", "Hello   WORLD! https://example.com", "bob", None, "2026-01-01T10:00:00", True),
        ("v", "c2", "x", None, 3, "2026-01-01T10:00:00+02:00", None),
        ("v", "c3", "y", None, 3, None, False),
    ]
    got = clean_comments(spark.createDataFrame(rows, schema), when(2026, 2, 1)).orderBy("comment_id")
    shown = got.withColumn("at", iso_utc(F.col("published_at"))).collect()
    assert [(r.text_clean, r.author, r.like_count, r.is_reply, r.at) for r in shown] == [
        ("hello world! <url>", "bob", 0, True, "2026-01-01T10:00:00Z"),
        ("x", "", 3, False, "2026-01-01T08:00:00Z"),
        ("y", "", 3, False, "1970-01-01T00:00:00Z"),
    ]
    assert {r.preprocess_version for r in shown} == {"v1"} and len({r.processed_at for r in shown}) == 1


def test_times(spark):
    texts = ["2026-01-01", "2026-01-01T12:34:56Z", "2026-01-01 12:34:56.5+01:00", "nonsense", None]
    rows = spark.createDataFrame([(t,) for t in texts], "t STRING").select(parse_utc(F.col("t")).alias("m"))
    got = [tuple(r) for r in rows.select(iso_utc(F.col("m")), run_stamp(F.col("m")), report_time(F.col("m"))).collect()]
    assert got == [
        ("2026-01-01T00:00:00Z", "20260101T000000Z", "2026-01-01 00:00 UTC"),
        ("2026-01-01T12:34:56Z", "20260101T123456Z", "2026-01-01 12:34 UTC"),
        ("2026-01-01T11:34:56.500000Z", "20260101T113456Z", "2026-01-01 11:34 UTC"),
        (None, None, "N/A"),
        (None, None, "N/A"),
    ]
    assert require_utc(when(2026, 1, 1))
    for bad in (datetime(2026, 1, 1), datetime(2026, 1, 1, tzinfo=timezone(timedelta(hours=1)))):
        with pytest.raises(ValueError):
            require_utc(bad)


def raw_line(**changes):
    record = {"video_id": "v", "comment_id": "c", "text": "hé", "author": None, "like_count": 1,
              "published_at": "2026-01-01T10:00:00+00:00", "is_reply": False}
    record.update(changes)
    return json.dumps({k: v for k, v in record.items() if v != "absent"}, ensure_ascii=False)


def test_raw_reader(spark, tmp_path):
    (tmp_path / "v.jsonl").write_text(raw_line() + "\n\n" + raw_line(comment_id="d", published_at=None) + "\n")
    got = store.read_raw_comments(spark, str(tmp_path)).orderBy("comment_id").collect()
    assert [(r.comment_id, r.text, r.like_count) for r in got] == [("c", "hé", 1), ("d", "hé", 1)]
    assert got[0].arrival < got[1].arrival
    assert store.read_raw_comments(spark, str(tmp_path / "nothing")).count() == 0


@pytest.mark.parametrize(
    "bad",
    ['{"not ok"}', '{"ok": 1}', raw_line(extra=1), raw_line(text="absent"), raw_line(published_at="soon"), raw_line(like_count="many")],
)
def test_bad_raw_lines(spark, tmp_path, bad):
    (tmp_path / "v.jsonl").write_text(raw_line() + "\n" + bad + "\n")
    with pytest.raises(Exception, match="v.jsonl"):
        store.read_raw_comments(spark, str(tmp_path)).collect()
    good, rejected = store.read_raw_comments_leniently(spark, str(tmp_path))
    assert good.count() == 1
    row = rejected.first()
    assert row.line == bad and row.reason and row.origin.endswith("v.jsonl")


def test_keyed_tables(spark, tmp_path):
    path = str(tmp_path / "t")
    schema = "k STRING, x INT"

    def stored():
        return sorted(tuple(r) for r in read_keyed(spark, path, "k").select("k", "x").collect())

    with pytest.raises(FileNotFoundError):
        read_keyed(spark, path, "k")
    write_keyed(spark.createDataFrame([("a", 1), ("b", 2)], schema), path, ["k"])
    write_keyed(spark.createDataFrame([("b", 3), ("c", 4)], schema), path, ["k"])
    assert stored() == [("a", 1), ("b", 3), ("c", 4)]
    with pytest.raises(FileExistsError):
        write_keyed(spark.createDataFrame([("c", 9)], schema), path, ["k"], "refuse")
    write_keyed(spark.createDataFrame([("d", 5)], schema), path, ["k"], "refuse")
    write_keyed(spark.createDataFrame([("d", 6)], schema), path, ["k"], "append")
    assert stored() == [("a", 1), ("b", 3), ("c", 4), ("d", 5), ("d", 6)]
    pruned = read_keyed(spark, path, "k", ["a", "c"])
    assert sorted(r.k for r in pruned.collect()) == ["a", "c"]
    assert "PartitionFilters: [key_bucket" in pruned._jdf.queryExecution().executedPlan().toString()
    with pytest.raises(ValueError):
        guards.assert_unique(read_keyed(spark, path, "k"), ["k"])


def test_video_refs(spark):
    forms = {
        "id_1": "id_1", "   id_1   ": "id_1", "https://youtu.be/id_1": "id_1", "https://youtu.be/id_1/x?y": "id_1",
        "https://www.youtube.com/watch?v=id_1": "id_1", "https://youtube.com/watch?a=b&v=&v=id%5F1": "id_1",
        "https://youtube.com/shorts/id_1": "id_1", "https://youtube.com/embed/id_1?x": "id_1",
        "https://youtube.com/watch?x=1": "https://youtube.com/watch?x=1", "https://other.org/a": "https://other.org/a",
        "https://youtu.be/": "", "watch?v=id_1": "watch?v=id_1", "https://youtube.com/watch?v=%zz": "%zz",
    }
    rows = spark.createDataFrame([(f,) for f in forms], "ref STRING")
    assert {r.ref: r.video_id for r in channels.normalize_video_refs(rows, "ref").collect()} == forms


def test_channel_refs(spark):
    cid = "UC_123456789ABCDEFH-5632"
    forms = {
        cid: ("channel_id", cid, cid), f"https://www.youtube.com/channel/{cid}": ("channel_id", cid, cid),
        "@Test_channel": ("handle", "@Test_channel", "@test_channel"),
        " https://m.youtube.com/@Test_channel/videos ": ("handle", "@Test_channel", "@test_channel"),
        "http://youtube.com/user/Test_user": ("username", "Test_user", "test_user"),
        "show_me_error": (None,) * 3, "": (None,) * 3, "@ab": (None,) * 3, "https://youtube.com": (None,) * 3,
        "https://youtube.com/channel/UCshort": (None,) * 3, "https://example.com/@Test_channel": (None,) * 3,
        "www.youtube.com/@Test_channel": (None,) * 3,
    }
    rows = spark.createDataFrame([(f,) for f in forms], "ref STRING")
    got = channels.normalize_channel_refs(rows, "ref").collect()
    assert {r.ref: (r.kind, r.value, r.input_ref) for r in got} == forms


def test_reference_mapping(spark):
    schema = "raw_ref STRING, channel_id STRING, resolved_at_utc TIMESTAMP"
    empty = spark.createDataFrame([], CHANNEL_REF)
    first = channels.upsert_channel_refs(
        empty, spark.createDataFrame([("@Name", "A", when(2026, 1, 1)), ("https://youtube.com/user/U1", "B", when(2026, 1, 1))], schema)
    )
    second = channels.upsert_channel_refs(
        first, spark.createDataFrame([("https://youtube.com/@name", "C", when(2026, 1, 2)), ("bad", "D", when(2026, 1, 2))], schema)
    )
    assert sorted((r.input_ref, r.channel_id) for r in second.collect()) == [("@name", "C"), ("u1", "B")]
    asked = spark.createDataFrame([("@NAME",), ("@nobody",), ("bad",)], "raw_ref STRING")
    got = {r.raw_ref: (r.channel_id, r.resolved) for r in channels.resolve_channel_refs(asked, second).collect()}
    assert got == {"@NAME": ("C", True), "@nobody": ("@nobody", False), "bad": ("bad", False)}


def comment_item(cid, text, likes=0, shown=None, at="2026-01-01T12:34:56Z"):
    snippet = {"textOriginal": text, "textDisplay": shown, "authorDisplayName": "x", "likeCount": likes, "publishedAt": at}
    return {"snippet": {"topLevelComment": {"id": cid, "snippet": snippet}}}


def page_rows(spark, key, rows):
    return spark.createDataFrame([(k, n, json.dumps(p) if not isinstance(p, str) else p) for k, n, p in rows],
                                 f"{key} STRING, page_no BIGINT, payload STRING")


def test_comment_pages(spark):
    rows = page_rows(spark, "video_id", [
        ("v", 0, {"items": [comment_item("comm1", "Cool vid", 4), comment_item("comm2", "", shown="amazing cat")], "nextPageToken": "t"}),
        ("v", 1, {"items": [comment_item("comm3", None, at=None)]}), ("w", 0, {"items": []}), ("x", 0, {}),
    ])
    got = pages.strict(pages.flatten_comment_pages(rows)).orderBy("comment_id").collect()
    assert [(r.comment_id, r.text, r.like_count, r.page_no, r.item_no) for r in got] == [
        ("comm1", "Cool vid", 4, 0, 0), ("comm2", "amazing cat", 0, 0, 1), ("comm3", "", 0, 1, 0)]
    assert got[2].published_at is None and not got[0].is_reply


@pytest.mark.parametrize("page", ["{broken", {"items": [comment_item(None, "a")]}, {"items": [comment_item("", "a")]},
                                  {"items": [comment_item("c", "a", at="late")]}])
def test_bad_comment_pages(spark, page):
    flat = pages.flatten_comment_pages(page_rows(spark, "video_id", [("v", 0, page)]))
    with pytest.raises(Exception, match="invalid page item"):
        pages.strict(flat).collect()
    good, bad = pages.quarantine(flat)
    assert (good.count(), bad.count()) == (0, 1)


def video_item(vid, at="2026-01-01T00:00:00Z", channel="c", title="t"):
    return {"id": {"videoId": vid}, "snippet": {"title": title, "publishedAt": at, "channelId": channel}}


def test_video_pages(spark):
    good = page_rows(spark, "channel_id", [("c", 0, {"items": [video_item("a", title=None)]})])
    row = pages.strict(pages.flatten_video_pages(good)).first()
    assert (row.video_id, row.channel_id, row.title, row.view_count) == ("a", "c", "", None)
    for item in (video_item(None), video_item("a", at=None), video_item("a", channel="d")):
        flat = pages.flatten_video_pages(page_rows(spark, "channel_id", [("c", 0, {"items": [item]})]))
        with pytest.raises(Exception, match="invalid page item"):
            pages.strict(flat).collect()


def test_caps_and_discovery(spark):
    rows = spark.createDataFrame([("v", f"c{i}", i // 3, i % 3) for i in range(8)], "video_id STRING, comment_id STRING, page_no BIGINT, item_no BIGINT")
    for limit, expected in ((0, 1), (1, 1), (4, 4), (5000, 8), (None, 8)):
        assert sorted(r.comment_id for r in channels.cap_comments(rows, limit).collect()) == [f"c{i}" for i in range(expected)]
    both = rows.unionByName(rows.where("page_no = 0").withColumn("video_id", F.lit("w")))
    got = sorted((r.video_id, r.comment_id) for r in channels.cap_comments(both, 4).collect())
    assert got == [("v", f"c{i}") for i in range(4)] + [("w", f"c{i}") for i in range(3)]
    videos = spark.createDataFrame([(f"v{i}", "c", "t", when(2026, 1, i + 1), None) for i in range(5)],
                                   "video_id STRING, channel_id STRING, title STRING, published_at TIMESTAMP, view_count STRING")
    got = channels.discover_videos(videos, 2, when(2026, 1, 2), when(2026, 1, 4))
    assert sorted(r.video_id for r in got.collect()) == ["v2", "v3"]


def test_runs(spark):
    status = spark.createDataFrame([("c", "a", 10, None), ("c", "b", 1, None), ("c", "d", 7, None), ("e", "f", 5, "boom")],
                                   "channel_id STRING, video_id STRING, comment_count BIGINT, error STRING")
    got = {r.channel_id: r for r in channels.summarize_run(status).collect()}
    assert (got["c"].video_count, got["c"].comment_count, got["c"].error_count, got["c"].video_ids) == (3, 18, 0, ["a", "b", "d"])
    assert (got["e"].comment_count, got["e"].error_count, got["e"].video_ids) == (0, 1, [])
    totals = {r.channel_id: (r.processed_count, r.exit_code) for r in channels.preprocess_totals(status).collect()}
    assert totals == {"c": (3, 0), "e": (0, 1)}


def test_version_guards(spark):
    rows = spark.createDataFrame([("a", "v1"), ("a", None), ("b", "v1"), ("b", "v2"), ("c", None)], "video_id STRING, preprocess_version STRING")
    report = {r.video_id: r.verdict for r in guards.version_report(rows, ["video_id"]).collect()}
    assert report == {"a": "single", "b": "mixed", "c": "missing"}
    with pytest.raises(ValueError, match="'b'"):
        guards.assert_single_version(rows, ["video_id"])
    assert guards.single_version(rows.where("video_id = 'a'")) == "v1"
    for video in ("b", "c"):
        with pytest.raises(ValueError):
            guards.single_version(rows.where(F.col("video_id") == video))
    with pytest.raises(ValueError):
        guards.single_version(rows.limit(0))


def test_preview_and_numbers(spark):
    rows = spark.createDataFrame([([("cat", 2), ("dog", 1)],), ([],)], "top_tokens ARRAY<STRUCT<token: STRING, count: BIGINT>>")
    assert [r.preview for r in preview(rows).collect()] == ["cat:2, dog:1", "(none)"]
    numbers = spark.createDataFrame([(1 / 3,), (float("inf"),)], "x DOUBLE")
    assert [r[0] for r in numbers.select(three_decimals(F.col("x"))).collect()] == ["0.333", "inf"]


def test_jobs_end_to_end(spark, tmp_path):
    root = str(tmp_path / "data")
    texts = {
        "v1": ["I love that cat", "This cat is amazing", "amazing winter love it", "snow winter http://a.b"],
        "v2": ["funny dog", "dog and cat", "", "dog park walks"],
        "v3": ["bad"],
    }
    comment_pages = page_rows(spark, "video_id", [
        (v, 0, {"items": [comment_item(None if t == "bad" else f"{v}-{i}", t, i) for i, t in enumerate(ts)]})
        for v, ts in texts.items()
    ])
    video_pages = page_rows(spark, "channel_id", [(CHANNEL, 0, {"items": [video_item(v, channel=CHANNEL) for v in texts]})])
    refs = spark.createDataFrame([("@Handle", CHANNEL, when(2026, 1, 1))], "raw_ref STRING, channel_id STRING, resolved_at_utc TIMESTAMP")

    run = jobs.ingest_channels(spark, video_pages, comment_pages, root, refs=refs).first()
    assert (run.video_count, run.comment_count, run.error_count, run.video_ids) == (3, 8, 1, ["v1", "v2"])
    assert (run.video_limit, run.comment_limit, run.published_after) == (100, 5000, None)

    done = jobs.preprocess_channels(spark, root, ["@handle"]).first()
    assert (done.video_count, done.error_count, done.exit_code) == (2, 0, 0)
    assert store.read_clean_comments(spark, jobs.clean_path(root), ["v1"]).count() == 4
    with pytest.raises(FileNotFoundError):
        store.read_clean_comments(spark, jobs.clean_path(root), ["v1", "v9"])
    with pytest.raises(FileExistsError):
        jobs.preprocess(spark, root, ["v1"], overwrite=False)
    jobs.preprocess(spark, root, ["v1"])

    stats = {r.video_id: r for r in jobs.stats_by_video(spark, root).collect()}
    assert (stats["v2"].row_count, stats["v2"].empty_text_count) == (4, 1)
    assert [t.token for t in stats["v1"].top_tokens] == ["love", "cat", "amazing", "winter", "snow", "url"]
    assert stats["v1"].created_at_utc is not None and stats["v1"].preprocess_version == "v1"

    config = KeywordConfig(min_df=1, max_df=1.0)
    corpus = jobs.corpus_document_frequency(spark, root, config)
    assert corpus.video_count == 2 and {r.token: r.df_videos for r in corpus.tokens.collect()}["cat"] == 2
    with_corpus = jobs.keywords_by_video(spark, root, config, use_corpus=True).first()
    assert with_corpus.artifact_version == "tfidf_v3"
    # A corpus made by the corpus job serves the channel grain as well.
    assert jobs.keywords_by_channel(spark, root, config, use_corpus=True).first().artifact_version == "tfidf_v3"

    videos = {r.video_id: r for r in jobs.keywords_by_video(spark, root, config).collect()}
    assert videos["v1"].artifact_version == "tfidf_v2_1" and videos["v1"].min_ngram_df == 2
    assert (videos["v1"].min_df_raw, videos["v1"].max_df_raw) == ("1", "1.0")
    with pytest.raises(ValueError, match="do not belong together"):
        jobs.distinctive_by_video(spark, root, config)
    channel = jobs.keywords_by_channel(spark, root, config, refs=["@HANDLE"]).first()
    assert channel.channel_id == CHANNEL and channel.video_ids == ["v1", "v2"]

    jobs.stats_by_channel(spark, root)
    with pytest.raises(ValueError, match="v3"):
        jobs.distinctive_by_video(spark, root, config, videos=["v3"])
    with pytest.raises(FileNotFoundError, match="v9"):
        artifacts.read_artifact(spark, root, "tfidf", ["v1", "v9"])
    lifted = {r.video_id: r for r in jobs.distinctive_by_video(spark, root, config).collect()}
    assert lifted["v2"].keyword_count == len(lifted["v2"]["keywords"]) > 0
    dog = next(k for k in lifted["v2"]["keywords"] if k.token == "dog")
    assert dog.lift == pytest.approx(dog.video_score / dog.channel_score)

    lines = [r.line for r in jobs.report_channels(spark, root, ["@handle"], videos=["v2"], top_k=2).collect()]
    assert lines[0] == f"channel_id: {CHANNEL}"
    assert lines[1] == "latest_run: videos=3 | comments=8 | errors=1"
    assert lines[2] == "run_window: after=N/A | before=N/A"
    assert lines[4] == "  1. cat             count=3" and len(lines) == 4 + 2 + 2 + 2
    assert "lift=" in lines[8]

    with pytest.raises(FileNotFoundError):
        jobs.stats_by_channel(spark, root, refs=["@somebody"])
    with pytest.raises(FileNotFoundError):
        artifacts.read_artifact(spark, str(tmp_path / "empty"), "tfidf")


def test_unreadable_records_fail_their_video(spark, tmp_path):
    root = str(tmp_path)
    comment_pages = page_rows(spark, "video_id", [
        (v, 0, {"items": [comment_item(f"{v}-{i}", "some text", i) for i in range(2)]}) for v in ("v1", "v2")
    ])
    video_pages = page_rows(spark, "channel_id", [(CHANNEL, 0, {"items": [video_item(v, channel=CHANNEL) for v in ("v1", "v2")]})])
    jobs.ingest_channels(spark, video_pages, comment_pages, root).collect()
    broken = next(Path(jobs.raw_path(root)).rglob("part-*.json"))
    broken.with_name("part-broken.json").write_text('{"video_id":"v1","comment_id":"cut o\n')
    done = jobs.preprocess_channels(spark, root).first()
    assert (done.video_count, done.error_count, done.exit_code) == (2, 1, 1)
    assert {r.video_id for r in store.read_clean_comments(spark, jobs.clean_path(root)).collect()} == {"v2"}
    broken.with_name("part-garbage.json").write_text("garbage\n")
    done = {r.channel_id: (r.video_count, r.error_count, r.exit_code) for r in jobs.preprocess_channels(spark, root).collect()}
    assert done == {CHANNEL: (2, 1, 1), None: (0, 1, 1)}
    assert {r.line for r in spark.read.parquet(jobs.rejected_path(root)).collect()} == {"garbage", '{"video_id":"v1","comment_id":"cut o'}


def plan_of(rows):
    return rows._jdf.queryExecution().executedPlan().toString()


def kept_rows(spark):
    return len(spark.sparkContext._jsc.getPersistentRDDs())


def test_channel_ingest_discovers_and_judges_once(spark, tmp_path, monkeypatch):
    """The run record comes out of the kept members and comments; both are released."""
    root, before, status = str(tmp_path), kept_rows(spark), []
    comment_pages = page_rows(spark, "video_id", [
        ("v1", 0, {"items": [comment_item(f"a{i}", "one", i) for i in range(3)]}),
        ("v1", 0, {"items": [comment_item(f"a{i}", "one", i) for i in range(3)]}),
        ("v2", 0, {"items": [comment_item("b0", "two"), comment_item("", "no id")]}),
        ("v3", 0, {"items": [comment_item("c0", "three")]}),
        ("stranger", 0, {"items": [comment_item("d0", "four")]}),
        (None, 0, {"items": [comment_item("e0", "five")]}),
    ])
    listed = ("v1", "v2", "v3", "v3", "silent")
    video_pages = page_rows(spark, "channel_id", [(CHANNEL, 0, {"items": [video_item(v, channel=CHANNEL) for v in listed]})])

    def seen(rows, *rest):
        status.append(plan_of(rows).split("InMemoryRelation")[0])
        return channels.summarize_run(rows, *rest)

    monkeypatch.setattr(jobs, "summarize_run", seen)
    run = jobs.ingest_channels(spark, video_pages, comment_pages, root, comment_limit=4).first()
    assert (run.video_count, run.comment_count, run.error_count) == (5, 4 + 1 + 1, 1)
    assert run.video_ids == ["silent", "v1", "v3", "v3"]
    assert "InMemoryTableScan [channel_id" in status[0] and kept_rows(spark) == before


def test_raw_layer_is_parsed_once_for_valid_and_rejected_lines(spark, tmp_path, monkeypatch):
    """The valid lines come out of the kept records, which hold the text of rejected lines only."""
    root, before, plans = str(tmp_path), kept_rows(spark), []
    at = when(2026, 1, 1)
    run = [("c", at, at, ["v1", "v2", "v2"], 3, 3, 0, None, None, None, None)]
    from threadlens.schemas import CHANNEL_RUN

    artifacts.append_runs(spark.createDataFrame(run, CHANNEL_RUN), root)
    good = '{"video_id":"v1","comment_id":"a","text":"one"}'
    lines = [good, good, '{"video_id":"v2","comment_id":"b"}', "garbage", " ", '{"video_id":"v3","comment_id":"c","text":"x"}']
    spark.createDataFrame([(x,) for x in lines], "value STRING").coalesce(1).write.text(jobs.raw_path(root))

    def written(rows, *rest):
        plans.append(plan_of(rows))
        return store.write_clean_comments(rows, *rest)

    monkeypatch.setattr(jobs, "write_clean_comments", written)
    done = {r.channel_id: (r.video_count, r.error_count) for r in jobs.preprocess_channels(spark, root).collect()}
    assert done == {"c": (2, 1), None: (0, 1)}
    kept = store.read_clean_comments(spark, jobs.clean_path(root)).orderBy("arrival").collect()
    assert [(r.video_id, r.comment_id, r.arrival) for r in kept] == [("v1", "a", 0), ("v1", "a", 1)]
    rejected = spark.read.parquet(jobs.rejected_path(root)).collect()
    assert {(r.line, r.reason) for r in rejected} == {(lines[2], "missing: text"), ("garbage", "not a JSON comment record")}
    assert all(r.origin.endswith(".txt") for r in rejected)
    assert "InMemoryTableScan" in plans[0] and kept_rows(spark) == before
    held = store.parsed_files(spark, jobs.raw_path(root)).where("(value is null) != (_reason is null)")
    assert held.count() == 0


def test_equal_times_have_one_latest_run(spark):
    at = when(2026, 1, 1)
    rows = [("c", at, at, n) for n in (3, 9, 5)]
    runs = spark.createDataFrame(rows, "channel_id STRING, started_at_utc TIMESTAMP, finished_at_utc TIMESTAMP, video_count BIGINT")
    assert {channels.latest_runs(runs.repartition(n)).first().video_count for n in (1, 2, 3)} == {9}


def test_page_ingest_caps_each_video(spark, tmp_path):
    root = str(tmp_path)
    rows = page_rows(spark, "video_id", [
        ("v", n, {"items": [comment_item(f"c{n}{i}", f"text {n} {i}") for i in range(3)]}) for n in range(3)
    ])
    jobs.ingest_comment_pages(rows, root, limit=4)
    got = store.read_raw_comments(spark, jobs.raw_path(root)).orderBy("arrival").collect()
    assert [r.comment_id for r in got] == ["c00", "c01", "c02", "c10"]
    jobs.ingest_comment_pages(rows, root, limit=None, overwrite=False)
    assert store.read_raw_comments(spark, jobs.raw_path(root)).count() == 4 + 9


def test_missing_member_videos_stop_a_channel_job(spark, tmp_path):
    root = str(tmp_path)
    run = [("c", when(2026, 1, 1), when(2026, 1, 1, 12, 1, 30), ["v1", "gone"], 2, 1, 0, None, None, None, None)]
    from threadlens.schemas import CHANNEL_RUN

    artifacts.append_runs(spark.createDataFrame(run, CHANNEL_RUN), root)
    raw = spark.createDataFrame([("v1", "c1", "cat", None, None, None, None, 0)], RAW_COMMENT)
    store.write_clean_comments(clean_comments(raw), jobs.clean_path(root))
    with pytest.raises(FileNotFoundError, match="gone"):
        jobs.stats_by_channel(spark, root)


def test_channel_checks_share_one_pass_over_the_layer(spark, tmp_path, monkeypatch):
    """Missing videos and versions come out of the kept (video, version) pairs; videos no run lists may have any version."""
    root, before, plans = str(tmp_path), kept_rows(spark), []
    at = when(2026, 1, 1)
    from threadlens.schemas import CHANNEL_RUN

    runs = [(c, at, at, videos, len(videos), 2, 0, None, None, None, None) for c, videos in (("c", ["v1", "v1"]), ("d", ["v2"]))]
    artifacts.append_runs(spark.createDataFrame(runs, CHANNEL_RUN), root)
    raw = [(v, f"{v}{n}", text, None, None, None, None, n) for n in range(2) for v, text in (("v1", "cat"), ("v2", ""), ("v3", "cat"))]
    clean = clean_comments(spark.createDataFrame(raw, RAW_COMMENT))
    other = F.when(F.col("video_id") == "v3", "v0").otherwise(F.col("preprocess_version"))
    store.write_clean_comments(clean.withColumn("preprocess_version", other), jobs.clean_path(root))

    def seen(name):
        made = getattr(jobs, name)

        def run(*given):
            plans.append((name, plan_of(given[-1])))
            return made(*given)

        monkeypatch.setattr(jobs, name, run)

    seen("missing_videos")
    seen("single_version")
    comments, members, _, version = jobs._channel_input(spark, root, None)
    assert [name for name, plan in plans if "InMemoryTableScan" in plan] == ["missing_videos", "single_version"]
    assert (comments.count(), members.count(), version) == (6, 2, "v1") and kept_rows(spark) == before
    assert jobs._channel_input(spark, root, ["d"])[0].count() == 2
    mixed = F.when(F.col("comment_id") == "v21", F.lit("v0")).otherwise(F.col("preprocess_version"))
    store.write_clean_comments(clean.where("video_id = 'v2'").withColumn("preprocess_version", mixed), jobs.clean_path(root))
    with pytest.raises(ValueError, match="mixed: 'v0' to 'v1'"):
        jobs._channel_input(spark, root, None)
    assert jobs._channel_input(spark, root, ["c"])[3] == "v1" and kept_rows(spark) == before


def test_streams_equal_batch(spark, tmp_path):
    raw_dir = tmp_path / "raw"
    raw_dir.mkdir()
    config = KeywordConfig(min_df=1, max_df=1.0)

    def land(name, *rows):
        (raw_dir / name).write_text("".join(
            raw_line(video_id=v, comment_id=f"{name}{i}", text=t) + "\n" for i, (v, t) in enumerate(rows)))

    def drain():
        clean = incremental.write_clean_stream(incremental.stream_raw_comments(spark, str(raw_dir)), str(tmp_path / "clean"), str(tmp_path / "p1"))
        clean.trigger(availableNow=True).start().awaitTermination()
        counts = incremental.write_feature_parts(
            incremental.stream_clean_comments(spark, str(tmp_path / "clean")), ["video_id"], config, str(tmp_path / "parts"), str(tmp_path / "p2"))
        counts.trigger(availableNow=True).start().awaitTermination()

    land("a.jsonl", ("v1", "Red cat"), ("v2", "blue dog"), ("v1", ""))
    drain()
    land("b.jsonl", ("v1", "red RED bird"), ("v3", "cat"))
    drain()
    clean = spark.read.parquet(str(tmp_path / "clean"))
    assert clean.count() == 5
    stats = incremental.read_feature_parts(spark, str(tmp_path / "parts"), ["video_id"])
    streamed = top_keywords(scored_features(stats, ["video_id"], config), ["video_id"], config)
    batch = tfidf_keywords(clean, ["video_id"], config)
    assert sorted(map(tuple, streamed.collect())) == sorted(map(tuple, batch.collect()))
    df = {r.token: r.df_videos for r in incremental.corpus_df_of_parts(spark, str(tmp_path / "parts")).collect()}
    assert df == {"red": 1, "cat": 2, "blue": 1, "dog": 1, "bird": 1}

    counted, table = sorted(map(str, stats.collect())), str(tmp_path / "parts")
    assert incremental.compact_feature_parts(spark, table, ["video_id"]) == 0  # the last part may still be replayed
    assert sorted(map(str, incremental.read_feature_parts(spark, table, ["video_id"]).collect())) == counted

    live = incremental.running_token_counts(incremental.stream_clean_comments(spark, str(tmp_path / "clean")), ["video_id"], TokenStatsConfig())
    query = live.writeStream.outputMode("complete").format("memory").queryName("live_counts").trigger(availableNow=True).start()
    query.awaitTermination()
    assert {(r.video_id, r.token): r["count"] for r in spark.table("live_counts").collect()}[("v1", "red")] == 3


def test_run_log_stream(spark, tmp_path):
    from threadlens.schemas import CHANNEL_RUN

    run = [("c", when(2026, 1, d), when(2026, 1, d, 12, 1, 30), ["v"], 1, d, 0, None, None, None, None) for d in (1, 2)]
    spark.createDataFrame(run, CHANNEL_RUN).write.parquet(str(tmp_path / "landed"))
    stream = spark.readStream.schema(CHANNEL_RUN).parquet(str(tmp_path / "landed"))
    root = str(tmp_path / "root")
    incremental.write_run_stream(stream, f"{root}/gold/channel_runs", str(tmp_path / "p")).trigger(availableNow=True).start().awaitTermination()
    assert artifacts.read_latest_runs(spark, root).first().comment_count == 2


def test_parts_that_arrive_during_a_fold_stay(spark, tmp_path):
    path, schema = str(tmp_path / "t"), "k STRING, n BIGINT"

    def add(number, *rows):
        parts.write_part(spark.createDataFrame(list(rows), schema), path, number)

    def read():
        return {r.k: r.n for r in merge(parts.read_parts(spark, path, schema)).collect()}

    def merge(rows):
        return rows.groupBy("k").agg(F.sum("n").alias("n"))

    def merge_while_growing(rows):
        add(3, ("a", 1000))
        return merge(rows)

    def merge_and_fail(rows):
        merge(rows).write.parquet(f"{path}/bases/base=9")
        raise RuntimeError("lost")

    assert read() == {} and parts.fold_parts(spark, path, schema, merge) == -1
    add(0)  # a part without rows
    assert read() == {} and parts.fold_parts(spark, path, schema, merge) == -1
    add(1, ("a", 1), ("b", 5))
    add(2, ("a", 10))
    with pytest.raises(RuntimeError):
        parts.fold_parts(spark, path, schema, merge_and_fail)
    assert read() == {"a": 11, "b": 5}
    assert parts.fold_parts(spark, path, schema, merge_while_growing) == 1
    assert read() == {"a": 1011, "b": 5}
    add(3, ("a", 2000))  # a replay overwrites its own part
    add(4)  # without rows, so part 3 is the last that can be seen
    assert read() == {"a": 2011, "b": 5} and parts.fold_parts(spark, path, schema, merge) == 2
    add(5, ("b", 1))
    assert parts.fold_parts(spark, path, schema, merge) == 4 and parts.last_fold(spark, path) == 4
    assert read() == {"a": 2011, "b": 6}


def test_comments_that_come_again_count_once(spark, tmp_path):
    raw_dir = tmp_path / "raw"
    raw_dir.mkdir()
    config = KeywordConfig(min_df=1, max_df=1.0)

    def land(name, *rows):
        lines = [raw_line(video_id=v, comment_id=i, text=t, published_at="1999-01-01T00:00:00Z") for v, i, t in rows]
        (raw_dir / name).write_text("\n".join(lines) + "\n")

    def drain():
        comments = clean_comments(incremental.first_deliveries(incremental.stream_deliveries(spark, str(raw_dir))))
        counts = incremental.write_feature_parts(comments, ["video_id"], config, str(tmp_path / "n"), str(tmp_path / "p1"))
        counts.trigger(availableNow=True).start().awaitTermination()
        comments = clean_comments(incremental.stream_deliveries(spark, str(raw_dir)))
        table = incremental.write_df_table(comments, config, str(tmp_path / "df"), str(tmp_path / "p2"))
        table.trigger(availableNow=True).start().awaitTermination()

    land("a.jsonl", ("v1", "c1", "red cat"), ("v1", "c1", "red cat"), ("v2", "c1", "red dog"))
    drain()
    land("b.jsonl", ("v1", "c1", "red cat"), ("v1", "c2", "red cat"), ("v3", "c1", "cat"))
    drain()
    stats = incremental.read_feature_parts(spark, str(tmp_path / "n"), ["video_id"])
    got = {(r.video_id, r.token): (r.docs, r.df, r.n) for r in stats.collect()}
    assert got == {
        ("v1", None): (2, 2, 0), ("v1", "red"): (0, 2, 2), ("v1", "cat"): (0, 2, 2), ("v2", None): (1, 1, 0), ("v2", "red"): (0, 1, 1),
        ("v2", "dog"): (0, 1, 1), ("v3", None): (1, 1, 0), ("v3", "cat"): (0, 1, 1),
    }
    assert incremental.compact_df_table(spark, str(tmp_path / "df")) == 0
    assert {r.token: r.df_videos for r in incremental.read_df_table(spark, str(tmp_path / "df")).collect()} == {"red": 2, "cat": 2, "dog": 1}


@pytest.mark.parametrize("kind", ["token_stats", "tfidf", "channel_token_stats", "channel_tfidf", "distinctive_keywords"])
def test_an_artifact_without_rows_can_be_read(spark, tmp_path, kind):
    root, keys = str(tmp_path), artifacts.ARTIFACT_KEYS[kind]
    fields = ", ".join(f"{k} STRING" for k in keys) + ", keywords ARRAY<STRUCT<token: STRING, score: DOUBLE>>"
    artifacts.write_artifact(spark.createDataFrame([], fields), root, kind)
    empty = artifacts.read_artifact(spark, root, kind)
    assert empty.collect() == [] and empty.schema.simpleString() == spark.createDataFrame([], fields).schema.simpleString()
    with pytest.raises(FileNotFoundError):
        artifacts.read_artifact(spark, root, kind, ["x"])
    artifacts.write_artifact(spark.createDataFrame([tuple("x" for _ in keys) + ([],)], fields), root, kind)
    assert artifacts.read_artifact(spark, root, kind, ["x"]).count() == 1


@pytest.mark.parametrize("split", [300, 4000, 1 << 27])
def test_line_numbers_do_not_depend_on_splits(spark, tmp_path, split):
    expected = {}
    for folder in ("x", "y"):
        (tmp_path / folder).mkdir()
        place = 0
        for name in ("b.jsonl", "a.jsonl", "c.jsonl"):
            (tmp_path / folder / name).write_text("")
        for name, lines in (("a.jsonl", 40), ("b.jsonl", 0), ("c.jsonl", 90)):
            text = ""
            for i in range(lines):
                key = f"{folder}{name}{i}"
                text += raw_line(video_id="v", comment_id=key, text="t" * (i % 7)) + "\n"
                expected[key] = place
                place += 1
            (tmp_path / folder / name).write_text(text)
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    old = {n: spark.conf.get(n) for n in names}
    try:
        spark.conf.set(names[0], split)
        spark.conf.set(names[1], 0)
        rows = store.read_raw_comments(spark, str(tmp_path))
        assert {r.comment_id: r.arrival for r in rows.collect()} == expected
    finally:
        for n, value in old.items():
            spark.conf.set(n, value)
    assert {r.arrival for r in store.read_raw_comments(spark, str(tmp_path), number_lines=False).collect()} == {None}


@pytest.mark.parametrize("first", [False, True])
def test_state_of_df_table_is_packed_by_video(spark, tmp_path, first):
    """A value per bucket of videos, not a row per (video, token), whatever the names of the videos are; also behind another state."""
    raw = tmp_path / "raw"
    raw.mkdir()
    names = ["v\n1", 'v"2', "", "ü"]

    def land(name, *rows):
        fields = ("video_id", "comment_id", "text")
        (raw / name).write_text("".join(json.dumps(dict(zip(fields, row))) + "\n" for row in rows))

    def drain():
        comments = incremental.stream_deliveries(spark, str(raw))
        comments = clean_comments(incremental.first_deliveries(comments) if first else comments)
        config = KeywordConfig(ngram_range=(1, 2))
        table = incremental.write_df_table(comments, config, str(tmp_path / "df"), str(tmp_path / "progress"))
        query = table.trigger(availableNow=True).start()
        query.awaitTermination()
        return query.lastProgress["stateOperators"]

    land("a.json", *[(name, "c1", "red cat cat") for name in names], (None, "c1", "red"), (None, "c2", "red dog"))
    drain()
    land("b.json", *[(name, "c2", "red cat bird") for name in names[:2]], ("v5", "c1", "..."), (names[2], "c1", "red cat cat"))
    states = drain()
    assert [x["numRowsTotal"] <= 6 for x in states if x["operatorName"] == "applyInPandasWithState"] == [True]
    expected = {"red": 5, "cat": 4, "dog": 1, "bird": 2, "red cat": 4, "cat cat": 4, "red dog": 1, "cat bird": 2}
    assert {r.token: r.df_videos for r in incremental.read_df_table(spark, str(tmp_path / "df")).collect()} == expected
