"""Repeated passages against a brute-force version."""

import random
from collections import Counter

from threadlens.llm.substring_dedup import remove_repeats


def brute(rows, window):
    split = [(i, (t or "").encode().split()) for i, t in rows]
    count = Counter(tuple(w[s : s + window]) for _, w in split for s in range(len(w) - window + 1))
    out = []
    for i, w in split:
        gone = set()
        for s in range(len(w) - window + 1):
            if count[tuple(w[s : s + window])] > 1:
                gone.update(range(s, s + window))
        out.append((i, len(w), len(gone), b" ".join(x for n, x in enumerate(w) if n not in gone).decode()))
    return out


def key(row):
    return tuple(str(x) for x in row)


def test_against_brute_force(spark):
    random.seed(5)
    shared = [[random.choice("abcdefgé") + str(random.randint(0, 50)) for _ in range(n)] for n in (10, 34, 35, 36, 60, 200)]
    rows = [(None, None), (1, None), (2, ""), (3, " \t\n"), (4, "one"), (5, " ".join(shared[4])), (5, " ".join(shared[4])), (6, "x " * 5000)]
    for i in range(10, 90):
        words = []
        for _ in range(random.randint(0, 6)):
            words += random.choice(shared) if random.random() < 0.5 else [str(random.randint(0, 10**6)) for _ in range(random.randint(1, 40))]
        rows.append((i, random.choice([" ", "\n", "\t "]).join(words)))
    frame = spark.createDataFrame(rows, "doc_id long, text string").withColumnRenamed("doc_id", "doc_id").selectExpr("*", "1 as k", "2 as h", "3 as spans")
    for window in (35, 6):
        got = [(r.doc_id, r.n_words, r.n_removed, r.kept) for r in remove_repeats(frame, window).collect()]
        assert sorted(got, key=key) == sorted(brute(rows, window), key=key)
        assert sum(r[2] for r in got) > 0


def test_no_documents(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert remove_repeats(empty).collect() == []


def test_rows_that_share_a_bit_of_the_filter(spark, monkeypatch):
    from threadlens.llm import substring_dedup

    monkeypatch.setattr(substring_dedup, "ROW_BITS", 1 << 15)
    rows = [(i, " ".join(f"{i if i % 3 else 'same'}w{j}" for j in range(40))) for i in range(-300, 3000)]
    got = [(r.doc_id, r.n_words, r.n_removed, r.kept) for r in remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()]
    assert sorted(got) == sorted(brute(rows, 35))
