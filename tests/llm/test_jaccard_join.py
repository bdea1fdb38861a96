"""The Jaccard join against all pairs."""

import random

import pyarrow as pa

from threadlens.llm import jaccard_join
from threadlens.llm.jaccard_join import join_classes


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def brute(rows):
    sets = []
    for _, text in rows:
        w = lower(text or "").encode().split()
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                parent[root(i)] = root(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        least[root(i)] = min(doc, least.get(root(i), doc))
    return sorted((doc, len(sets[i]), least[root(i)]) for i, (doc, _) in enumerate(rows))


def corpus(seed):
    random.seed(seed)
    words = ["W" + str(i) for i in range(40)] + ["é", "ü"]
    passage = [random.choice(words) for _ in range(30)]
    rows, texts = [(0, None), (1, ""), (2, "  \n"), (3, "A b"), (4, "a B"), (5, "a b c d e"), (6, "a b c d e f")], []
    seedling = [random.choice(words) for _ in range(120)]
    for i in range(10, 150):
        kind = random.random()
        if kind < 0.45:
            w = list(seedling)
            for _ in range(random.randint(0, 3)):
                w[random.randrange(len(w))] = random.choice(words)
        elif kind < 0.6 and texts:
            w = list(random.choice(texts))
            if w and random.random() < 0.7:
                w[random.randrange(len(w))] = "new"
        elif kind < 0.8:
            w = passage + [random.choice(words) for _ in range(random.randint(0, 60))]
        else:
            w = [random.choice(words) for _ in range(random.randint(1, 80))]
        texts.append(w)
        rows.append((i, " ".join(w)))
    rows.append((150, rows[-1][1]))
    return rows + [rows[20]]


def test_against_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "REST", 16)
    rows = corpus(11)
    frame = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as k", "'x' as h", "2 as c", "3 as n")
    got = sorted((r.doc_id, r.n_shingles, r.component_id) for r in join_classes(frame).collect())
    assert got == brute(rows)
    assert len({r[2] for r in got}) < len(rows)


def test_no_documents(spark):
    assert join_classes(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def chains(seed):
    """Families whose members share all prefix shingles, hence their regions, and link to the one before and after only."""
    random.seed(seed)
    rows = []
    for _ in range(8):
        words = [f"w{random.randrange(10**6)}" for _ in range(4)]
        for i in range(140):
            tries = [f"w{random.randrange(10**6)}" for _ in range(200)]
            value = jaccard_join.Sets(pa.array([" ".join([*words[-4:], w]) for w in tries])).value
            words.append(next(w for w, v in zip(tries, value) if (v < 2**60) == (i < 40)))
        rows += [" ".join(words[:44] + words[44 + 5 * i : 104 + 5 * i]) for i in range(8)]
    return list(zip(random.sample(range(1000), len(rows)), rows))


def test_links_between_cells(spark, monkeypatch):
    """Linked members of different pivots' cells meet, whether the cells are of one round or of several."""
    monkeypatch.setattr(jaccard_join, "SMALL", 4)
    monkeypatch.setattr(jaccard_join, "REST", 2)
    rounds, whole = [], jaccard_join.stored
    monkeypatch.setattr(jaccard_join, "stored", lambda frame, name: rounds.append(name) or whole(frame, name))
    rows = chains(5)
    got = sorted((r.doc_id, r.n_shingles, r.component_id) for r in join_classes(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert len({r[2] for r in got}) == 8 and got == brute(rows)
    assert rounds.count("pivots") >= 3


def test_form_letters(spark, monkeypatch):
    """A large group of texts with common passages, few of them linked, is done after one pivot, and names no pair twice."""
    random.seed(3)
    form, rows = [f"w{i}" for i in range(100)], []
    for i in range(150):
        words = list(form)
        for _ in range(random.choice([1, 2, 3, 4, 4, 4])):
            words[random.randrange(100)] = f"own{random.randrange(10**6)}"
        rows.append((i, " ".join(words[random.randrange(3) :])))
    rounds, whole, crossed, cross = [], jaccard_join.stored, [], jaccard_join.cross_pairs
    monkeypatch.setattr(jaccard_join, "stored", lambda frame, name: rounds.append(name) or whole(frame, name))
    monkeypatch.setattr(jaccard_join, "cross_pairs", lambda members: crossed.append(whole(cross(members), "crossed")) or crossed[-1])
    got = sorted((r.doc_id, r.n_shingles, r.component_id) for r in join_classes(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == brute(rows) and 10 < len({r[2] for r in got}) < 150
    assert rounds.count("pivots") == 1
    assert crossed[0].count() == crossed[0].distinct().count()
