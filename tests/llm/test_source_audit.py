"""Source divergences against SQL, a plain-Python version, and sorted() for the pointer sort."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from oracle_check import compare, duck
from threadlens.llm import source_audit
from threadlens.llm.queries import LLM_ORACLES, LLM_QUERIES


def test_query_equals_sql(spark):
    folder, name = "/root/testdata/sf0.001", "op13_source_audit"
    assert compare(spark, duck(folder), folder, name, LLM_QUERIES[name], LLM_ORACLES[name]) is None


@pytest.mark.parametrize("levels", [0, 1, 2, 64])
def test_pointer_sort(levels):
    draw = random.Random(5)
    words = ["".join(draw.choice("abß東") for _ in range(draw.choice([1, 2, 7, 8, 9, 16, 17, 40]))) for _ in range(400)] + ["a" * 24, "a" * 25] * 5
    words += ["y" * 700 + c for c in "abcab"]
    texts = pa.array([" ".join(words[i : i + 7]) for i in range(0, len(words), 7)] + ["", None, "A1B"])
    data, offsets = source_audit._bytes(texts)
    starts, lengths, rows = source_audit.term_pointers(data, offsets)
    found = [data[s : s + n].tobytes().decode() for s, n in zip(starts, lengths)]
    assert found == [w.lower() for w in words] + ["a", "b"]
    order, run = source_audit.sort_pointers(data, starts, lengths, levels)
    ranked = [found[i] for i in order]
    assert ranked == sorted(found)
    assert [ranked[i] for i in run] == ranked and len(set(run.tolist())) == len(set(found))


def brute(rows, least, shown):
    docs = [[(text or ""), lang or "", source or ""] for text, lang, source in rows]
    held, counts, groups = Counter(), Counter(), defaultdict(set)
    for text, lang, source in docs:
        words = re.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", "".join(c.lower() if c < "\x80" else c for c in text))
        groups[lang].add(source)
        held.update((lang, w) for w in set(words))
        counts.update((lang, source, w) for w in words)
    out = []
    for lang, sources in groups.items():
        kept = [w for (x, w), n in held.items() if x == lang and n >= least]
        total = {s: sum(counts[lang, s, w] for w in kept) for s in sources}
        p = {(s, w): 1 + 10**9 * (counts[lang, s, w] + 1) // (total[s] + len(kept)) for s in sources for w in kept}
        q = {w: 1 + 10**9 * (sum(counts[lang, s, w] for s in sources) + 1) // (sum(total.values()) + len(kept)) for w in kept}
        for s in sources:
            pairs = [(-sum((p[s, w] - p[o, w]) ** 2 // p[o, w] for w in kept), o) for o in sources if o != s]
            terms = [(-((p[s, w] - q[w]) ** 2 // q[w]), w) for w in kept if counts[lang, s, w] and p[s, w] > q[w]]
            for part, found in (("pair", pairs), ("term", sorted(terms, key=lambda x: (x[0], x[1].encode()))[:shown])):
                out += [(lang, s, part, item, -v, i) for i, (v, item) in enumerate(sorted(found, key=lambda x: (x[0], x[1].encode())), 1)]
    return sorted(out)


ROWS = [
    ("The cat's hat, THE CAT 12cat", "en", "a"), ("cat hat é東京 cat", "en", "b"), ("hat é東京 the", "en", None), (None, "en", "c"),
    ("", "de", "x"), ("1 2 3", "de", "y"), ("die Katze", None, None), ("the the cat é東京 ÄÖ", "en", "a"), ("the the cat é東京 ÄÖ", "en", "a"),
    ("die Katze", "", ""), ("Die KATZE", None, "z"), ("w" * 5000 + " cat", "en", "b"),
]


@pytest.mark.parametrize("cells, slab", [(1 << 20, 256), (2, 1)])
def test_equals_brute_force(spark, monkeypatch, cells, slab):
    monkeypatch.setattr(source_audit, "BLOCK_CELLS", cells)
    monkeypatch.setattr(source_audit, "SLAB", slab)
    docs = spark.createDataFrame([(*r, 1, "t", 2) for r in ROWS], "text string, lang string, source string, doc_id int, term string, count int")
    for least, shown in ((3, 200), (1, 2)):
        got = sorted(tuple(r) for r in source_audit.audit_sources(docs.repartition(3), least, shown).collect())
        assert got == brute(ROWS, least, shown)


def test_large_counts_are_exact():
    counts = np.array([[10**12, 3]], np.int64)
    got = source_audit._shares(counts, np.array([10**12 + 7, 11], np.int64), 2)
    assert got.tolist() == [[1 + 10**9 * (10**12 + 1) // (10**12 + 9), 1 + 10**9 * 4 // 13]]


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string")
    assert source_audit.audit_sources(docs).collect() == []
