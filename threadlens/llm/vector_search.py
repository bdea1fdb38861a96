"""Largest inner products by multiprobe p-stable hashing.

Vectors are scaled by the largest norm and given one more component, so that all have length one and a larger inner product
with a query is a smaller distance to it. A table hashes a vector by the cells that its Gaussian (2-stable) projections fall
into. A query visits buckets in the order of their estimated success: the probability that a neighbour as close as those of a
fitted sample falls into all of a bucket's cells, given the query's own projections. The candidates of all tables are
merged, and their scores are exact.

How many cells a bucket is made of, how many tables there are and how many buckets a query visits is fitted to a recall
that is measured: the true neighbours of a bounded sample of queries are found by comparing these with every row. If
no number of probes within bounds reaches the recall, a table has one bucket, which makes the search exact.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from threadlens.llm.scratch import stored

#: Bounds of the sample that the index is fitted on: queries, whose neighbours are found exactly, and rows, which show how full buckets are.
SAMPLE_QUERIES, SAMPLE_ROWS = 128, 4096
#: Recall on the sample that the number of probes is chosen for, and most probes of a query in one table.
RECALL, MOST_PROBES = 0.96, 1024
#: Width of a cell where projections have a variance of one, and cells on each side of zero (the last one is open).
WIDTH, HALF = 2.0, 3
#: Choices of the fit: functions of a bucket, tables. A visited bucket (a query's vector sent, its best rows sent back) costs as
#: much as so many compared rows.
FUNCTIONS, TABLES, VISIT_ROWS = (1, 2, 3, 4, 6, 8, 10, 12, 14, 16), (2, 4), 512
#: Rows of an index block and of a block of queries; a bucket with more of them is dealt to several.
INDEX_BLOCK, QUERY_BLOCK = 4096, 1024

_normal = np.vectorize(lambda x: 0.5 * (1 + math.erf(x / math.sqrt(2))), otypes=[float])


@dataclass(frozen=True)
class Hashes:
    """Hash functions of all tables: ``axes`` (tables, functions, dimension + 1) and ``shifts`` (tables, functions)."""

    axes: np.ndarray
    shifts: np.ndarray
    longest: float
    cosine: float = 0.5
    probes: int = 1

    @staticmethod
    def draw(dimension: int, longest: float, tables: int = max(TABLES), functions: int = max(FUNCTIONS), seed: int = 1) -> "Hashes":
        draw = np.random.default_rng(seed)
        return Hashes(draw.normal(size=(tables, functions, dimension + 1)), draw.uniform(0, WIDTH, (tables, functions)), longest)

    def cut(self, tables: int, functions: int) -> "Hashes":
        return replace(self, axes=self.axes[:tables, :functions], shifts=self.shifts[:tables, :functions])

    @property
    def tables(self) -> int:
        return len(self.axes)

    def rows(self, vectors: np.ndarray) -> np.ndarray:
        """Vectors of the index on the sphere: the added component makes up for a smaller length."""
        x = vectors / self.longest
        return np.hstack([x, np.sqrt(np.clip(1 - (x * x).sum(1, keepdims=True), 0, None))])

    def queries(self, vectors: np.ndarray) -> np.ndarray:
        return np.hstack([vectors / np.linalg.norm(vectors, axis=1, keepdims=True), np.zeros((len(vectors), 1))])

    def buckets(self, points: np.ndarray, table: int) -> np.ndarray:
        """The bucket of every point: its cells as digits."""
        cells = np.floor((points @ self.axes[table].T + self.shifts[table]) / WIDTH).astype(np.int64)
        digits = np.clip(cells + HALF, 0, 2 * HALF - 1)
        return digits @ (2 * HALF) ** np.arange(digits.shape[1], dtype=np.int64)

    def order(self, points: np.ndarray, table: int, probes: int) -> tuple[np.ndarray, np.ndarray]:
        """Buckets of every query in estimated success order (at most ``probes``), and the sums of -log of their cells' probabilities.

        Of the sums over the first functions only the ``probes`` lowest can lead to one of the lowest in the end.
        """
        at = points @ self.axes[table].T
        cells, spread = 2 * HALF, math.sqrt(max(1 - self.cosine**2, 1e-12))
        cost, code = np.zeros((len(points), 1)), np.zeros((len(points), 1), np.int64)
        for f in range(at.shape[1]):
            edges = np.arange(1 - HALF, HALF) * WIDTH - self.shifts[table, f]
            below = _normal((edges[None, :] - self.cosine * at[:, f : f + 1]) / spread)
            share = np.diff(np.hstack([np.zeros((len(at), 1)), below, np.ones((len(at), 1))]), axis=1)
            cost = (cost[:, :, None] - np.log(np.maximum(share, 1e-30))[:, None, :]).reshape(len(at), -1)
            code = (code[:, :, None] + np.arange(cells, dtype=np.int64) * cells**f).reshape(len(at), -1)
            if cost.shape[1] > probes:
                low = np.argpartition(cost, probes - 1, axis=1)[:, :probes]
                cost, code = np.take_along_axis(cost, low, 1), np.take_along_axis(code, low, 1)
        by_cost = np.lexsort((code, cost), axis=1)
        return np.take_along_axis(code, by_cost, 1), np.take_along_axis(cost, by_cost, 1)


def needed_probes(hashes: Hashes, queries: np.ndarray, owner: np.ndarray, neighbours: np.ndarray) -> np.ndarray:
    """For every (query, true neighbour) the number of probes after which some table has found it (MOST_PROBES + 1: never)."""
    need = np.full(len(owner), MOST_PROBES + 1)
    points = hashes.queries(queries)
    for table in range(hashes.tables):
        visited, _ = hashes.order(points, table, MOST_PROBES)
        hit = visited[owner] == hashes.buckets(hashes.rows(neighbours), table)[:, None]
        need = np.minimum(need, np.where(hit.any(1), hit.argmax(1) + 1, MOST_PROBES + 1))
    return need


def fit(hashes: Hashes, queries: np.ndarray, owner: np.ndarray, neighbours: np.ndarray, rows: np.ndarray, total: int, recall: float) -> Hashes:
    """The cheapest choice of functions, tables and probes that finds the share ``recall`` of the true neighbours."""
    if not len(owner) or not total:
        return replace(hashes.cut(1, 0), probes=1)
    norms = np.linalg.norm(queries[owner], axis=1) * hashes.longest
    hashes = replace(hashes, cosine=float(np.clip(((queries[owner] * neighbours).sum(1) / norms).mean(), 0.0, 0.999)))
    best, least = replace(hashes.cut(1, 0), probes=1), float(total)
    points, placed = hashes.queries(queries), hashes.rows(rows)
    for tables in TABLES:
        for functions in FUNCTIONS:
            tried = hashes.cut(tables, functions)
            need = np.sort(needed_probes(tried, queries, owner, neighbours))
            probes = int(need[min(math.ceil(recall * len(need)), len(need)) - 1])
            if probes > MOST_PROBES:
                break  # more functions need more probes
            seen = 0.0
            for table in range(tables):
                held, count = np.unique(tried.buckets(placed, table), return_counts=True)
                visited, _ = tried.order(points, table, probes)
                place = np.searchsorted(held, visited).clip(0, len(held) - 1)
                seen += np.where(held[place] == visited, count[place], 0).sum(1).mean() / len(rows) * total
            cost = seen + probes * tables * VISIT_ROWS
            # one bucket is for the case that nothing else reaches the recall
            if not best.axes.shape[1] or cost < least:
                best, least = replace(tried, probes=probes), cost
    return best


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    column = pa.concat_arrays(column.chunks) if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1) if len(column) else np.empty((0, 0))


def lower_bounds(queries: np.ndarray, vectors: np.ndarray, top: int) -> np.ndarray:
    """A score that ``top`` of the vectors reach, for every query."""
    if len(vectors) < top:
        return np.full(len(queries), -np.inf)
    return np.partition(queries @ vectors.T, len(vectors) - top, axis=1)[:, len(vectors) - top]


def best_rows(queries: np.ndarray, bounds: np.ndarray, vectors: np.ndarray, ids: list[np.ndarray], top: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of every query the ``top`` best (query, id, score), best first, ties to smaller ids. ``ids[i]`` are the rows that hold vector i.
    Vectors below a query's bound are left out.

    Products of matrices only choose; the scores of what they choose are sums in one order, so that equal vectors get
    equal scores wherever they meet a query. Vectors as good as the last one chosen are all taken.
    """
    near = queries @ vectors.T
    last = max(vectors.shape[0] - top, 0)
    bound = np.maximum(bounds, np.partition(near, last, axis=1)[:, last])
    slack = 1e-9 * np.linalg.norm(queries, axis=1) * np.linalg.norm(vectors, axis=1).max(initial=0)
    q, v = np.nonzero(near >= (bound - slack)[:, None])
    score = (queries[q] * vectors[v]).sum(1)
    many = np.array([len(x) for x in ids], np.int64)[v]
    q, score = np.repeat(q, many), np.repeat(score, many)
    rows = np.concatenate([ids[i] for i in v]) if len(v) else np.empty(0, np.int64)
    order = np.lexsort((rows, -score, q))
    q, rows, score = q[order], rows[order], score[order]
    kept = np.arange(len(q)) - np.searchsorted(q, q) < top
    return q[kept], rows[kept], score[kept]


def usable(vectors: DataFrame, id: str, vector: str) -> DataFrame:
    """(id, v, k1, k2): vectors as doubles, with a 128-bit name. Null ids, null or zero vectors and null or non-finite components take no part."""
    v = F.transform(F.col(vector).cast("array<double>"), lambda x: x + F.lit(0.0))
    rows = vectors.select(F.col(id).cast("long").alias("id"), v.alias("v")).where("id is not null and v is not null")
    fit = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0)
    return rows.where(fit).withColumns({"k1": F.xxhash64("v"), "k2": F.xxhash64(F.lit("second"), F.reverse("v"))})


def _classes(rows: DataFrame, is_query: Column, top: int) -> DataFrame:
    """One row per different vector: its ``top`` + 1 smallest ids (no further one can be in a result) and whether a query has it."""
    keys = ["k1", "k2"]
    one = rows.groupBy(*keys).agg(F.first("v").alias("v"), F.max(is_query).alias("asked"))
    ranked = rows.select("id", *keys).distinct().withColumn("place", F.row_number().over(Window.partitionBy(*keys).orderBy("id")))
    ids = ranked.where(F.col("place") <= top + 1).groupBy(*keys).agg(F.sort_array(F.collect_list("id")).alias("ids"))
    return one.join(ids, keys)


def _true_neighbours(classes: DataFrame, sample: list, top: int) -> list:
    """(query, v) of the ``top`` nearest other classes of every sampled query, by comparing these with every row."""
    asked = np.array([r["v"] for r in sample])
    names = [(r["k1"], r["k2"]) for r in sample]

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = _matrix(batch.column("v"))
            near = asked @ vectors.T
            at = {key: i for i, key in enumerate(zip(batch.column("k1").to_pylist(), batch.column("k2").to_pylist()))}
            for i, name in enumerate(names):
                if name in at:
                    near[i, at[name]] = -np.inf
            kept = np.argsort(-near, axis=1, kind="stable")[:, :top]
            q = np.repeat(np.arange(len(asked)), kept.shape[1])
            score = np.take_along_axis(near, kept, 1).ravel()
            real = score > -np.inf
            out = batch.select(["v", "k1", "k2"]).take(pa.array(kept.ravel()[real]))
            yield pa.RecordBatch.from_arrays([pa.array(q[real], pa.int32()), pa.array(score[real]), *out.columns], names=["q", "score", "v", "k1", "k2"])

    found = classes.select("v", "k1", "k2").mapInArrow(compare, "q int, score double, v array<double>, k1 long, k2 long")
    best = Window.partitionBy("q").orderBy(F.col("score").desc(), "k1", "k2")
    return found.withColumn("place", F.row_number().over(best)).where(F.col("place") <= top).select("q", "v").collect()


def nearest(vectors: DataFrame, is_query: Column, id: str = "vec_id", vector: str = "embedding", top: int = 20, recall: float = RECALL, seed: int = 1) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``top`` rows found with the largest inner product, for every row where ``is_query`` holds.

    ``is_query`` is a condition on ``id`` (the column ``id`` of this function's own rows). Ranks start at 1; equal scores go to smaller ids.
    A query never finds rows of its own id. Rows that repeat an id and its vector count once; an id with several vectors is a candidate
    with each, and as a query has a list for each. Vectors that are null, zero, or hold null or non-finite components take no part, nor do those of
    another length than the most frequent one (the longer of two). An empty table gives no rows; a query without candidates has none.

    Equal vectors are one class, so a vector that a third of all rows share is compared once. A bucket with more rows or queries
    than a block is dealt to several blocks, each pair of which is a task's group; nothing is left out of a visited bucket.
    """
    spark, keys = vectors.sparkSession, ["k1", "k2"]
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    rows = usable(vectors, id, vector)
    lengths = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.col("count").desc(), F.col("n").desc()).first()
    if lengths is None:
        return empty
    rows = rows.where(F.size("v") == lengths["n"])
    classes = stored(_classes(rows, is_query, top), "classes")
    squares = F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)
    facts = classes.agg(F.count("*").alias("n"), F.sqrt(F.max(squares)).alias("longest")).first()
    sample = classes.where("asked").orderBy(*keys).limit(SAMPLE_QUERIES).collect()
    if not sample:
        return empty
    shown = classes.orderBy("k2", "k1").limit(SAMPLE_ROWS).select("v", "ids").collect()
    true = _true_neighbours(classes, sample, top)
    hashes = fit(
        Hashes.draw(lengths["n"], facts["longest"], seed=seed), np.array([r["v"] for r in sample]), np.array([r["q"] for r in true], np.int64),
        np.array([r["v"] for r in true]).reshape(len(true), lengths["n"]), np.array([r["v"] for r in shown]), facts["n"], recall,
    )

    # the sampled rows are compared with every query: what top + 1 of them reach bounds what other rows are sent back
    seen = spark.sparkContext.broadcast((np.array([r["v"] for r in shown]), [np.array(r["ids"], np.int64) for r in shown]))
    names = ["k1", "k2", "vec_id", "score"]

    def compare_sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, len(whole), 256):
                batch = whole.slice(at, 256)
                q, rows, score = best_rows(_matrix(batch.column("v")), np.full(len(batch), -np.inf), *seen.value, top + 1)
                of = batch.select(["k1", "k2"]).take(pa.array(q))
                yield pa.RecordBatch.from_arrays([*of.columns, pa.array(rows, pa.int64()), pa.array(score)], names=names)

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            points = hashes.rows(_matrix(batch.column("v")))
            for table in range(hashes.tables):
                buckets = pa.array(hashes.buckets(points, table))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(batch), table, np.int32)), buckets, *batch.columns], names=["t", "bucket", *batch.schema.names])

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, len(whole), 256):
                batch = whole.slice(at, 256)
                vectors = _matrix(batch.column("v"))
                points = hashes.queries(vectors)
                batch = batch.append_column("bound", pa.array(lower_bounds(vectors, seen.value[0], top + 1)))
                for table in range(hashes.tables):
                    visited, _ = hashes.order(points, table, hashes.probes)
                    out = batch.take(pa.array(np.repeat(np.arange(len(batch)), visited.shape[1])))
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(out), table, np.int32)), pa.array(visited.ravel()), *out.columns], names=["t", "bucket", *out.schema.names])

    held = classes.select("v", "k1", "k2", "ids").mapInArrow(index, "t int, bucket long, v array<double>, k1 long, k2 long, ids array<long>")
    asked = classes.where("asked").select("v", "k1", "k2").mapInArrow(probe, "t int, bucket long, v array<double>, k1 long, k2 long, bound double")
    place = ["t", "bucket"]

    def blocks(frame: DataFrame, size: int, name: str) -> DataFrame:
        return frame.groupBy(*place).agg(F.expr(f"1 + (count(*) - 1) div {size}").alias(name))

    sizes = blocks(held, INDEX_BLOCK, "parts").join(blocks(asked, QUERY_BLOCK, "askers"), place)
    sizes = stored(sizes, "buckets")
    left = held.join(sizes, place).withColumn("part", F.expr("pmod(k1, parts)")).withColumn("asker", F.explode(F.expr("sequence(0L, askers - 1)")))
    right = asked.join(sizes, place).withColumn("asker", F.expr("pmod(k1, askers)")).withColumn("part", F.explode(F.expr("sequence(0L, parts - 1)")))
    block = [*place, "part", "asker"]
    right = right.select(*[F.col(c).alias(f"of_{c}") for c in [*block, "v", "k1", "k2", "bound"]])

    def compare(index: pa.Table, queries: pa.Table) -> pa.Table:
        vectors, ids = _matrix(index.column("v")), [np.array(x) for x in index.column("ids").to_pylist()]
        out = []
        for at in range(0, len(queries) if len(index) else 0, 256):
            some = queries.slice(at, 256)
            q, rows, score = best_rows(_matrix(some.column("of_v")), some.column("of_bound").to_numpy(), vectors, ids, top + 1)
            of = some.select(["of_k1", "of_k2"]).take(pa.array(q))
            out.append(pa.table([of.column(0), of.column(1), pa.array(rows, pa.int64()), pa.array(score)], names=names))
        return pa.concat_tables(out) if out else pa.table([pa.array([], t) for t in (pa.int64(), pa.int64(), pa.int64(), pa.float64())], names=names)

    pairs = left.groupBy(*block).cogroup(right.groupBy(*[f"of_{c}" for c in block])).applyInArrow(compare, "k1 long, k2 long, vec_id long, score double")
    sampled = classes.where("asked").select("v", "k1", "k2").mapInArrow(compare_sample, pairs.schema)
    merged = pairs.union(sampled).groupBy("k1", "k2", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy(*keys).orderBy(F.col("score").desc(), "vec_id")
    best = merged.withColumn("place", F.row_number().over(order)).where(F.col("place") <= top + 1)
    lists = best.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("place", "vec_id", "score"))).alias("found"))
    wanted = rows.where(is_query).select("id", *keys).distinct()
    others = F.slice(F.filter("found", lambda x: x["vec_id"] != F.col("id")), 1, top)
    ranked = wanted.join(lists, keys).select(F.col("id").alias("query_id"), F.posexplode(others).alias("pos", "x"))
    return ranked.select("query_id", (F.col("pos") + 1).alias("rank"), "x.vec_id", "x.score")
