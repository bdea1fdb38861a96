"""The training-data operators on small cases with brute force, library results and edge cases."""

import hashlib
import random
import re

import pytest

from threadlens.llm import byte_bpe, decontaminate, pii, preference_format, quality_rules, secret_scan, toxicity, url_filter
from threadlens.llm.queries import LLM_ORACLES, LLM_QUERIES, URL_EXTRA, URL_RULES, tokenizer

from oracle_check import compare, duck

FOLDER = "/root/testdata/sf0.001"
EXTRA = ["*", "1 as k", "'x' as h", "null as spans", "2 as bucket"]


@pytest.fixture(scope="module")
def connection():
    return duck(FOLDER)


@pytest.mark.parametrize("name", sorted(LLM_ORACLES))
def test_query_against_sql(spark, connection, name):
    assert compare(spark, connection, FOLDER, name, LLM_QUERIES[name], LLM_ORACLES[name]) is None


def frame(spark, rows, schema="doc_id long, text string"):
    return spark.createDataFrame(rows, schema).selectExpr(*EXTRA)


EDGES = [(None, None), (1, None), (2, ""), (3, "  \n\t"), (4, "word"), (4, "word"), (5, "x" * 200_000), (6, "token=abcdef 1.2.3.4 a@b.co\n" * 300)]


def test_secrets_and_ledger(spark):
    rows = [*EDGES, (7, "PASSWORD = 'abcdefg' AKIA" + "A" * 16 + " " + "0123456789abcdef" * 2), (8, "secret=ab token=abcdef"), (9, "ſecret=abcdefg to\u212aen=abcdefg")]
    docs = frame(spark, rows)
    ledger = secret_scan.scan(docs, path="doc_id")
    got = {(r.path, r.spans) for r in secret_scan.findings(docs, ledger, path="doc_id").collect()}
    compiled = [(i, r, re.compile(r.pattern)) for i, r in enumerate(secret_scan.RULES)]
    assert got == {(i, ",".join(f"{k}:{a}:{b}" for a, _, k, b in secret_scan.spans_of(t or "", compiled))) for i, t in rows}
    assert ("assign:0:19,access:21:41,hex:42:74") in {s for _, s in got}
    known = spark.createDataFrame(ledger.collect(), ledger.schema)
    assert secret_scan.scan(docs, known, path="doc_id").collect() == []
    more = frame(spark, [*rows, (10, "passwd: longenough")])
    assert secret_scan.scan(more, known, path="doc_id").count() == 1
    assert secret_scan.scan(docs, known, version="2", path="doc_id").count() == ledger.count()
    clean = {r.doc_id: r.text for r in secret_scan.redact(docs, known).collect()}
    assert clean[8] == "secret=ab [SECRET]" and clean[1] is None and "AKIA" not in clean[7]


def brute_pii(text):
    found = []
    for n, (kind, pattern) in enumerate({
        "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            luhn = sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(digits))) % 10 == 0
            good = {
                "email": True, "ip": kind == "ip" and all(int(x) <= 255 for x in m.group().split(".")),
                "card": 14 <= len(digits) <= 19 and luhn, "phone": 10 <= len(digits) <= 15}[kind]
            if good:
                found.append((m.start(), n, f"{kind}:{m.start()}:{m.end()}"))
    return ",".join(x[2] for x in sorted(found))


def test_pii_base_spans(spark):
    random.seed(3)
    parts = ["a@b.com", "x_y@", "1.2.3.4", ".5", "256.1.1.1", "4111 1111 1111 1111", "4111-1111-11111111 ", "1", " ", "é", "🙂", "+1 (234) 555-6789", "+", "-", "..", "\ue000"]
    rows = [(i, "".join(random.choice(parts) for _ in range(random.randint(0, 40)))) for i in range(100, 250)]
    rows += [*EDGES[1:], (7, "1 2 " * 20_000), (8, "a." * 20_000 + "@b" + ".c" * 20_000)]
    got = {(r.doc_id, ",".join(s for s in r.spans.split(",") if s.split(":")[0] in ("email", "ip", "card", "phone")), r.base_sha256) for r in pii.find_pii(frame(spark, rows)).collect()}
    assert got == {(i, b := brute_pii(t), hashlib.sha256(b.encode()).hexdigest()) for i, t in rows}
    assert pii.find_pii(frame(spark, [])).collect() == []


def test_reliabilities_trust_labelers_that_agree():
    chance = pii.reliabilities({(1, 1, -1): 80, (0, 0, -1): 80, (1, 0, -1): 10, (0, 1, 1): 5})
    assert chance[1, 1, -1] > 0.9 and chance[0, 0, -1] < 0.1


def test_urls(spark):
    rows = [(1, None), (2, "nothing"), (3, "http://Example.ORG/es/1"), (4, "http://a.example.org/en/12?x"), (5, "http://evil.net/a.org/x"), (6, "http://spam.net"), (7, "x://org/" + "y" * 5000), (7, "x://org/")]
    pages = spark.createDataFrame(rows, "page_id long, url string").selectExpr("*", "'q' as host", "'r' as rule")
    got = sorted((r.page_id, r.rule, r.verdict) for r in url_filter.judge_urls(pages, URL_RULES, URL_EXTRA).collect())
    assert got[:6] == [(1, None, "allow"), (2, None, "allow"), (3, "example.org/es/", "block"), (4, "example.org/en/1", "block"), (5, None, "allow"), (6, None, "block")]
    assert got[6:] == [(7, "org/", "allow")] * 2


def test_automaton_over_several_words():
    globs = ["a" * 70 + "*b", "**x/**", "*c", "ab", ""]
    hits = url_filter.Automaton(globs).hits([b"a" * 70 + b"zzb", b"a" * 69 + b"b", b"q/x/", b"q/c", b"qc", b"ab", b""])
    assert hits.tolist() == [[i == r for i in range(5)] if r is not None else [False] * 5 for r in (0, None, 1, None, 2, 3, 4)]


def test_quality(spark):
    text = " ".join(f"word{i}" for i in range(60))
    rows = [*EDGES, (7, text), (8, "a b c " * 40), (9, " ".join(f"w{i}#" for i in range(60)))]
    got = {r.doc_id: r for r in quality_rules.judge_quality(frame(spark, rows)).collect()}
    assert got[7].kept and not got[8].kept and got[8].base_failed and not got[9].kept and not got[9].base_failed
    assert got[1].n_words == 0 and got[1].base_failed and got[8].n_repeat_words == 120
    assert [r.doc_id for r in quality_rules.keep_documents(frame(spark, rows)).collect()] == [7]
    table = {r.rule: r for r in quality_rules.ablations(quality_rules.rule_ledger(frame(spark, rows)), quality_rules.STRICT).collect()}
    assert table["symbols"].n_failed == 1 and table["few_words"].n_failed == 7
    assert quality_rules.judge_quality(frame(spark, [])).collect() == []


def test_bpe_equals_library(spark):
    import tiktoken

    vocabulary, pattern = tokenizer()
    ranks = byte_bpe.read_ranks(vocabulary)
    library, codec = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}), byte_bpe.Codec(ranks, pattern)
    random.seed(1)
    texts = ["".join(random.choice(["ab", "a", "aaaa", " ", "\n", "é", "日本", "🙂", "the", "0123", "!!"]) for _ in range(100)) for _ in range(100)]
    for text in [*texts, "", "a" * 50_000, "".join(random.choice("abcdefgh") for _ in range(20_000))]:
        assert codec.encode(text) == library.encode_ordinary(text)
    for r in byte_bpe.round_trip(frame(spark, EDGES), vocabulary, pattern).collect():
        assert r.n_bytes == len({i: t or "" for i, t in EDGES}[r.doc_id])
    coded = byte_bpe.encode_documents(frame(spark, EDGES), vocabulary, pattern)
    assert {(r.doc_id, bytes(r.decoded)) for r in byte_bpe.decode_documents(coded, vocabulary).collect()} == {(i, (t or "").encode()) for i, t in EDGES}


def test_bpe_encodes_new_words_in_one_list(monkeypatch):
    import tiktoken

    vocabulary, pattern = tokenizer()
    ranks = byte_bpe.read_ranks(vocabulary)
    library = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    random.seed(2)
    words = [("".join(random.choice(["ab", "aa", "th", "é", "日本", "🙂", "in", "ß"]) for _ in range(random.randint(1, 12)))).encode() for _ in range(2000)]
    assert byte_bpe.Merges(ranks).encode(words) == [library._encode_single_piece(word) for word in words]
    # a byte that would join the words of the list belongs to tokens of its own only
    assert byte_bpe.Merges({b"a": 0, b"b": 1, b"\xff": 2, b"a\xff": 3, b"ab": 4}).encode([b"ba", b"bab"]) == [[1, 0], [1, 4]]
    # remembered words are short strings, few enough, and take part again after they were forgotten
    monkeypatch.setattr(byte_bpe, "CACHED_PIECES", 200)
    monkeypatch.setattr(byte_bpe, "LIST", 64)
    codec = byte_bpe.Codec(ranks, pattern)
    for _ in range(3):
        for start in range(0, len(words), 50):
            text = " ".join(word.decode() for word in words[start : start + 50])
            assert codec.encode(text) == library.encode_ordinary(text)
            assert len(codec.known) <= 200 and all(type(x) is str and len(w) <= byte_bpe.CACHED_CHARS for w, x in codec.known.items())


def test_decontamination(spark, monkeypatch):
    item = [f"q{i}" for i in range(20)]
    items = spark.createDataFrame([(1, " ".join(item)), (2, "short one"), (3, None), (4, ""), (1, " ".join(item))], "item_id long, text string")
    rows = [*EDGES, (7, "x " + ", ".join(item[:13]).upper() + " y"), (8, " ".join(item[:12])), (9, "a short ONE " + "z " * 60), (10, "short. one short one")]
    docs = frame(spark, rows)
    got = {r.doc_id: (r.n_words, r.n_hit, r.n_items, r.contaminated) for r in decontaminate.find_contamination(docs, items).collect()}
    assert got[7] == (15, 13, 1, True) and got[8] == (12, 0, 0, False) and got[9] == (63, 2, 1, False) and got[10] == (4, 4, 1, True)
    assert got[None] == got[1] == (0, 0, 0, False)
    monkeypatch.setattr(decontaminate, "BROADCAST_BYTES", 0)
    assert {r.doc_id: (r.n_words, r.n_hit, r.n_items, r.contaminated) for r in decontaminate.find_contamination(docs, items).collect()} == got
    assert decontaminate.find_contamination(docs, items.where("item_id = 3")).where("contaminated").count() == 0


def test_preferences(spark):
    turns = [(1, 0, "user", "hi"), (1, 1, "assistant", "yes"), (2, 0, "user", "hi"), (2, 1, "assistant", None), (3, 0, None, "x"), (1, 1, "assistant", "yes")]
    talks = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").selectExpr("*", "1 as a", "2 as b", "3 as n")
    pairs = spark.createDataFrame([(7, 1, 2), (8, 1, 1), (9, 3, 4)], "pair_id long, chosen_id long, rejected_id long")
    got = {r.pair_id: r for r in preference_format.format_preferences(talks, pairs).collect()}
    assert set(got) == {7, 8} and got[7].prompt == "<|user|>\nhi\n" and got[7].n_prompt_turns == 1
    a, b = map(int, got[7].chosen_mask.split(":"))
    assert got[7].chosen[a:b] == "yes" and got[7].rejected_mask == "14:14" and got[8].chosen == "" == got[8].chosen_mask


def test_toxicity_on_held_out_rows(spark):
    random.seed(2)
    rows = [(i, " ".join(random.choice(["the", "sky", "is", "blue", "tree"]) for _ in range(30)) + (" you vilest" + random.choice("abc") if i % 5 == 0 else "")) for i in range(1000)]
    labels = spark.createDataFrame([(i, int(i % 5 == 0)) for i, _ in rows] + [(0, None), (None, 1), (1, 2), (2, -1)], "doc_id long, toxic int")
    got = [r for r in toxicity.score_toxicity(frame(spark, [*rows, (2000, None), (None, "")]), labels).collect()]
    own = [r for r in got if r.held_out and r.doc_id < 1000]
    assert len(got) == 1002 and len(own) > 100 and all(0 <= r.score <= 1 for r in got)
    assert sum(r.predicted == int(r.doc_id % 5 == 0) for r in own) > 0.95 * len(own)
    none = toxicity.score_toxicity(frame(spark, rows[:3]), labels.where("toxic = 0")).collect()
    assert [r.score for r in none] == [0.0] * 3


def test_toxicity_features_by_plain_counting():
    weights = {"fool": 5.0, "^foo": 2.0, "^fool": 3.0, "idiot": 4.0}
    texts = [None, "", "You FOOL! f00l, fo*ol; ÄÖ übung É", "idiot " * 3 + "a b c d e f you", "x" * 1000 + " Fools", "1234 !!! ¿¡ 中文 you're an 1d10t"]
    known = toxicity.Known(weights)
    for text in texts * 2:
        raw = text or ""
        words = toxicity.tokens(raw)
        own = [weights.get(w, 0.0) for w in words]
        begin = [max(weights.get("^" + w[:k], 0.0) for k in toxicity.BEGINNINGS) for w in words]
        second = [i for i, w in enumerate(words) if w in toxicity.SECOND]
        near = sum(any(abs(i - j) <= 3 for j in second) for i in range(len(words)) if own[i] or begin[i])
        n, size = max(1, len(words)), max(1, len(raw))
        want = [sum(x > 0 for x in own) / n, sum(x > 0 for x in own), sum(own), sum(x > 0 for x in begin) / n, sum(x > 0 for x in begin), sum(begin),
                len(second) / n, near / n, sum(c.isupper() for c in raw) / size, sum(not c.isalnum() and not c.isspace() for c in raw) / size,
                raw.count("!") / n, sum(not w.isalpha() for w in toxicity.WORD.findall(raw.lower())) / n, max(own, default=0.0), max(begin, default=0.0)]
        assert toxicity.measure(text, known) == want


def test_toxicity_without_documents(spark):
    labels = spark.createDataFrame([(1, 1)], "doc_id long, toxic int")
    assert toxicity.score_toxicity(frame(spark, []), labels).collect() == []


def test_toxicity_lexicon_counts_all_training_rows(spark, monkeypatch):
    """Terms are counted beyond ``max_rows``, and labels without a document do not use up the bound."""
    random.seed(4)
    common = ["the", "sky", "is", "blue", "tree"]
    insults = ["".join(random.choice("bcdfghklmnpqrstvwxz") for _ in range(8)) for _ in range(60)]
    rows = [(i, " ".join(random.choice(common) for _ in range(30)) + (" you " + insults[i // 2 % 60] if i % 2 == 0 else "")) for i in range(1200)]
    labels = spark.createDataFrame([(i, int(i % 2 == 0)) for i, _ in rows] + [(i, 0) for i in range(10_000, 15_000)], "doc_id long, toxic int")
    seen, whole = [], toxicity.lexicon
    monkeypatch.setattr(toxicity, "lexicon", lambda labelled: seen.append(whole(labelled)) or seen[-1])
    own = [r for r in toxicity.score_toxicity(frame(spark, rows), labels, max_rows=60).collect() if r.held_out]
    assert set(insults) <= seen[0].keys()
    assert sum(r.predicted == int(r.doc_id % 2 == 0) for r in own) > 0.95 * len(own) > 100
