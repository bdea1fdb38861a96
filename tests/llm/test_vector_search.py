"""Vector search against brute force: exact where every bucket is visited, by recall on the given tables."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from threadlens.llm import vector_search
from threadlens.llm.queries import LLM_QUERIES


def brute(rows, ask, top):
    kept = {(i, tuple(x + 0.0 for x in v)) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)}
    sizes = [len(v) for _, v in kept]
    size = max(set(sizes), key=lambda n: (sizes.count(n), n), default=0)
    kept = [(i, v) for i, v in kept if len(v) == size]
    out = []
    for i, v in kept:
        if ask(i):
            near = sorted((-sum(a * b for a, b in zip(v, w)), j) for j, w in kept if j != i)[:top]
            out += [(i, k, j, -s) for k, (s, j) in enumerate(near, 1)]
    return sorted(out)


def searched(spark, rows, top=20, **more):
    frame = spark.createDataFrame([(i, v, "x", 5) for i, v in rows], "vec_id long, embedding array<float>, v string, k1 int").repartition(3)
    return sorted(tuple(r) for r in vector_search.nearest(frame, F.col("id") % 20 == 0, top=top, **more).collect())


@pytest.mark.parametrize("top, block", [(20, 4096), (3, 2)])
def test_exact_when_all_is_visited(spark, monkeypatch, top, block):
    monkeypatch.setattr(vector_search, "INDEX_BLOCK", block)
    monkeypatch.setattr(vector_search, "QUERY_BLOCK", block)
    draw = np.random.default_rng(3)
    rows = [(i, [float(x) for x in draw.integers(-2, 3, 4)]) for i in range(90)]
    rows += [(100 + i, [1.0, 2.0, 0.0, -1.0]) for i in range(45)]  # a vector of many rows
    rows += [(200, None), (220, [0.0] * 4), (240, [1.0, None, 0.0, 0.0]), (260, [float("nan"), 1.0, 0.0, 0.0]), (280, [float("inf"), 1.0, 0.0, 0.0])]
    rows += [(300, [1.0, 2.0]), (None, [1.0, 1.0, 1.0, 1.0]), (320, []), (340, [-0.0, 0.0, 1.0, 0.0]), (341, [0.0, -0.0, 1.0, 0.0]), rows[0], rows[0]]
    assert searched(spark, rows, top, recall=1.0) == brute(rows, lambda i: i % 20 == 0, top)


def test_few_candidates(spark):
    rows = [(0, [1.0, 0.0]), (1, [0.5, 0.5]), (20, [0.0, 3.0])]
    assert searched(spark, rows) == brute(rows, lambda i: i % 20 == 0, 20)
    assert searched(spark, [(0, [1.0])]) == [] and searched(spark, [(1, [1.0])]) == [] and searched(spark, []) == []


def recall(found, table, top=20):
    kept = [(r["vec_id"], r["embedding"]) for r in table.collect()]
    ids, x = np.array([i for i, _ in kept]), np.array([v for _, v in kept], float)
    got, hits, total = {}, 0, 0
    for r in found.collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    for at in np.flatnonzero(ids % 20 == 0):
        near = x @ x[at]
        near[at] = -np.inf
        mine = sorted(got[ids[at]])
        assert [k for k, _, _ in mine] == list(range(1, top + 1))
        assert all(abs(s - x[at] @ x[ids == j][0]) < 1e-12 for _, j, s in mine)
        assert [(-s, j) for _, j, s in mine] == sorted((-s, j) for _, j, s in mine)
        hits += len({j for _, j, _ in mine} & set(ids[np.lexsort((ids, -near))[:top]]))
        total += top
    return hits / total


@pytest.mark.parametrize("folder, sample", [("sf0.01", 4096), ("sf0.1", 4096), ("sf0.1", 64)])
def test_recall_of_the_query(spark, monkeypatch, folder, sample):
    monkeypatch.setattr(vector_search, "SAMPLE_ROWS", sample)  # a sample of all rows would find everything
    found = LLM_QUERIES["op12_nearest_neighbours"](spark, f"/root/testdata/{folder}")
    assert found.columns == ["query_id", "rank", "vec_id", "score"]
    assert recall(found, spark.read.parquet(f"/root/testdata/{folder}/embeddings.parquet")) >= 0.9


@pytest.mark.parametrize("spread", [0.0, 1.0])
def test_clustered_vectors_visit_few_buckets(spark, monkeypatch, spread):
    draw, chosen = np.random.default_rng(8), []
    centres = draw.normal(size=(200, 24))
    centres *= (1 + spread * draw.uniform(0, 2, (200, 1))) / np.linalg.norm(centres, axis=1, keepdims=True)  # lengths differ with a spread
    x = centres[draw.integers(0, 200, 6000)] + 0.02 * draw.normal(size=(6000, 24))
    rows = spark.createDataFrame([(i, [float(c) for c in v]) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    fit = vector_search.fit
    monkeypatch.setattr(vector_search, "fit", lambda *a: chosen.append(fit(*a)) or chosen[-1])
    assert recall(vector_search.nearest(rows, F.col("id") % 20 == 0), rows) >= 0.9
    if not spread:
        assert chosen[0].axes.shape[1] >= 4 and chosen[0].probes <= 8


def test_order_is_by_success(spark):
    hashes = vector_search.Hashes.draw(3, 1.0).cut(1, 3)
    point = hashes.queries(np.array([[0.2, 0.5, -0.7]]))
    every, cost = hashes.order(point, 0, 6**3)
    assert sorted(every[0].tolist()) == list(range(6**3)) and (np.diff(cost[0]) >= 0).all()
    few, _ = hashes.order(point, 0, 10)
    assert few[0].tolist() == every[0][:10].tolist()
