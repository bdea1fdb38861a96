"""Exact Jaccard self-join of documents as a metric-space join.

The Jaccard distance of two shingle sets is a metric. Nearly all texts of a corpus are at distance 1 from each
other, so pivots taken blindly would tell nothing apart; a pivot only has to see documents that share a
necessary shingle with it. So each document first announces its prefix: the first n - ceil(0.8 n) + 1 of its
shingles in one global order, common ones last. Documents that share a prefix shingle form a region, and
linked documents share one. Copies count as one document (a class) throughout.

A region of a common shingle needs less than all its pairs. Every shingle that is not common stands before it, so members
that share one of those meet in its region too; the others share common shingles at most. A pair whose lesser number of
common shingles cannot reach the threshold is no pair of this region, and members without any possible partner stay out.

A region elects a pivot (later rounds several; classes without links first, then those of mostly common shingles, which are
nearest to what the region has in common), and every member's exact distance to it is found, once however many regions ask.
Members within the threshold join the pivot's cell and are connected by it. What links have connected so far, in any region,
shares a label and needs no comparison; all pairs of different labels do. The next region holds the others, and of the cell only
boundary documents x, with |d(x, p) - d(y, p)| <= threshold for some y of another label (triangle inequality), be it in
another pivot's cell or in none. A region of one label is done. Regions of a few members compare all pairs at first, and what
pivots leave of a region compares its pairs of different labels inside one task as soon as it has REST members at most: their
sketches first, then the exact sets of the few pairs that sketches do not rule out. Nothing is capped or approximated.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from threadlens.llm.scratch import stored
from threadlens.llm.words import Words, mix, slices

U = np.uint64
SHINGLE = 5
#: Links need 100 * |A & B| >= PERCENT * |A | B|.
PERCENT = 80
#: Regions of up to SMALL classes compare pairs directly, and those left by a pivot up to REST; shingles in more than COMMON texts come last.
SMALL, REST, COMMON = 16, 8192, 24
#: Pivots that a region elects: one at first, twice as many in each later round, up to so many.
SEATS = 64
#: The list of common shingles that is sent to all executors never has more entries; it only orders shingles.
COMMON_LIST = 1_000_000
SALTS = 16
#: Bytes of text that a task takes at a time; its memory is some sixty times this.
SLICE = 1 << 20
#: Cells of a small set's sketch, one byte each; twice as many while a cell would hold more than CELL shingles.
SKETCH, CELL = 128, 4
#: Members of a region that a task compares with all others at a time.
BLOCK = 64
#: Bytes of packed shingles in a bucket, about.
BUCKET = 8 << 20
#: Up to so many classes, the list of chosen texts is sent to all executors and no text is shuffled.
CHOSEN = 250_000
#: ``most`` bounds the shingles that two members share if they need this region: the member's common ones, or all.
_MEMBER = [("key", "<u8"), ("c", "<i8"), ("n", "<i4"), ("most", "<i4")]
_COUNT = [("key", "<u8"), ("n", "<u2")]


class Sets:
    """Distinct shingle hashes of each row, sorted within the row; a row of fewer words has one shingle."""

    def __init__(self, texts: pa.Array, size: int = SHINGLE):
        words = Words(texts, lower=True)
        value, at = words.windows(size)
        rows = words.rows[at]
        short = np.flatnonzero((words.counts > 0) & (words.counts < size))
        if len(short):
            whole = np.empty(len(short), U)
            for i, r in enumerate(short):
                x = U(words.counts[r])
                for h in words.hashes[words.first[r] : words.first[r + 1]]:
                    x = mix(np.array([x ^ h], U), 3)[0]
                whole[i] = x
            value, rows = np.concatenate([value, whole]), np.concatenate([rows, short])
        order = np.lexsort((value, rows))
        value, rows = value[order], rows[order]
        new = np.ones(len(value), bool)
        new[1:] = (value[1:] != value[:-1]) | (rows[1:] != rows[:-1])
        self.value, self.rows = value[new], rows[new]
        self.n = np.bincount(self.rows, minlength=len(texts))
        self.first = np.concatenate([[0], np.cumsum(self.n)])
        sums = [np.concatenate([np.zeros(1, U), np.cumsum(mix(self.value, s))]) for s in (5, 6)]
        a, b = (s[self.first[1:]] - s[self.first[:-1]] for s in sums)
        self.classes = mix(a ^ mix(b + self.n.astype(U), 7), 8).view(np.int64)

    def leaders(self) -> np.ndarray:
        """Whether a row is the first of its class here."""
        out = np.zeros(len(self.n), bool)
        out[np.unique(self.classes, return_index=True)[1]] = True
        return out & (self.n > 0)

    def fresh(self, seen: set[int]) -> np.ndarray:
        """Whether a row is the first of its class in this task, whose classes so far are ``seen``."""
        out = self.leaders()
        for i in np.flatnonzero(out):
            c = int(self.classes[i])
            out[i] = c not in seen
            seen.add(c)
        return out

    def among(self, common: np.ndarray) -> np.ndarray:
        """Whether a shingle is one of the sorted ``common``."""
        if not len(common):
            return np.zeros(len(self.value), bool)
        return common[np.minimum(np.searchsorted(common, self.value), len(common) - 1)] == self.value

    def sketches(self) -> list[bytes]:
        """Each row's numbers of shingles, up to 255, in the cells of its sketch."""
        cells = np.left_shift(SKETCH, np.ceil(np.log2(np.maximum(self.n / (SKETCH * CELL), 1))).astype(np.int64))
        start = np.concatenate([[0], np.cumsum(cells)])
        at = start[self.rows] + (mix(self.value, 4) & (cells[self.rows] - 1).astype(U)).astype(np.int64)
        counts = np.minimum(np.bincount(at, minlength=start[-1]), 255).astype(np.uint8)
        return [counts[i:j].tobytes() for i, j in zip(start[:-1], start[1:])]

    def prefixes(self, chosen: np.ndarray, share: int, last: np.ndarray | None = None) -> np.ndarray:
        """Indexes of the first n - ceil(share * n / 100) + 1 shingles of the chosen rows, those marked in ``last`` last."""
        index = np.flatnonzero(chosen[self.rows])
        if last is not None and last.any():
            index = index[np.lexsort((self.value[index], last[index], self.rows[index]))]
        n = np.where(chosen, self.n, 0)
        first = np.concatenate([[0], np.cumsum(n)])[:-1]
        rank = np.arange(len(index)) - first[self.rows[index]]
        return index[rank < (self.n - -(-share * self.n // 100) + 1)[self.rows[index]]]


def _bytes(column: pa.ChunkedArray) -> bytes:
    return b"".join(column.to_pylist())


def folded(sketch: np.ndarray, cells: int) -> np.ndarray:
    """The sketch of the same set with fewer cells."""
    return sketch.reshape(-1, cells).sum(axis=0, dtype=np.int64)


def classes_of(docs: DataFrame) -> DataFrame:
    """(doc_id, k, h, c, n, sketch): class, set size and sketch of every row; c is null for texts without words."""
    rows = docs.select("doc_id", F.xxhash64("doc_id").alias("k"), F.xxhash64("text").alias("h"), "text")
    schema = T.StructType([docs.schema["doc_id"]]).add("k", "long").add("h", "long").add("c", "long").add("n", "long").add("sketch", "binary")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, size=SLICE):
                sets = Sets(batch.column("text"))
                c = pa.array(sets.classes, pa.int64(), mask=sets.n == 0)
                out = [batch.column("doc_id"), batch.column("k"), batch.column("h"), c, pa.array(sets.n, pa.int64()), pa.array(sets.sketches(), pa.binary())]
                yield pa.RecordBatch.from_arrays(out, names=schema.names)

    return rows.mapInArrow(read, schema)


def common_shingles(docs: DataFrame, buckets: int) -> np.ndarray:
    """Shingles of more than COMMON texts, most frequent first up to COMMON_LIST, sorted.

    The counts cover all documents and shingles: a common one that is not in the list stands among the rare ones, so texts that
    have it seem to share more than common ones. The list steers speed; results are the same with any list.
    """
    schema = T.StructType().add("bucket", "integer").add("counts", "binary")

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for whole in batches:
            for batch in slices(whole, size=SLICE):
                sets = Sets(batch.column("text"))
                key, n = np.unique(sets.value[sets.fresh(seen)[sets.rows]], return_counts=True)
                out = np.empty(len(key), _COUNT)
                out["key"], out["n"] = key, np.minimum(n, 65535)
                yield from _by_bucket(out, buckets, schema.names)

    def total(table: pa.Table) -> pa.Table:
        rows = np.frombuffer(_bytes(table["counts"]), _COUNT)
        key, at = np.unique(rows["key"], return_inverse=True)
        n = np.bincount(at, weights=rows["n"])
        return pa.table({"key": key[n > COMMON].view(np.int64), "n": n[n > COMMON].astype(np.int64)})

    sent = docs.select("text").mapInArrow(send, schema).groupBy("bucket").applyInArrow(total, "key long, n long")
    top = stored(sent.orderBy(F.desc("n"), "key").limit(COMMON_LIST).select("key"), "common").toArrow()
    return np.sort(top["key"].to_numpy().view(U))


def _by_bucket(rows: np.ndarray, buckets: int, names: list[str]) -> Iterator[pa.RecordBatch]:
    bucket = (mix(rows["key"], 9) % U(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    rows, cut = rows[order], np.searchsorted(bucket[order], np.arange(buckets + 1))
    full = np.flatnonzero(np.diff(cut))
    yield pa.RecordBatch.from_arrays([pa.array(full, pa.int32()), pa.array([rows[cut[i] : cut[i + 1]].tobytes() for i in full], pa.binary())], names=names)


def may_link(n: np.ndarray, m: np.ndarray, most_n: np.ndarray, most_m: np.ndarray) -> np.ndarray:
    """Whether sets of sizes n and m that share no more than either ``most`` can reach the threshold."""
    n, m, most = n.astype(np.int64), m.astype(np.int64), np.minimum(most_n, most_m).astype(np.int64)
    return (100 * np.minimum(n, m) >= PERCENT * np.maximum(n, m)) & ((100 + PERCENT) * most >= PERCENT * (n + m))


def partnered(n: np.ndarray, most: np.ndarray) -> np.ndarray:
    """Whether a member of a region may link with some member, itself perhaps: one that is small enough, and for which it is."""
    order = np.argsort(n, kind="stable")
    reach = ((100 + PERCENT) * most.astype(np.int64) - PERCENT * n.astype(np.int64)) // PERCENT
    best = np.concatenate([[-1], np.maximum.accumulate(reach[order])])
    return best[np.searchsorted(n[order], reach, side="right")] >= n


def regions(docs: DataFrame, common: np.ndarray, buckets: int) -> DataFrame:
    """(region, a, b, n, m): pairs of small regions (b set, a < b, sizes n and m), and the members a (size n, ``most`` m) of larger ones (b null)."""
    shipped = docs.sparkSession.sparkContext.broadcast(common)
    schema = T.StructType().add("bucket", "integer").add("members", "binary")

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for whole in batches:
            for batch in slices(whole, size=SLICE):
                sets = Sets(batch.column("text"))
                last = sets.among(shipped.value)
                index = sets.prefixes(sets.fresh(seen), PERCENT, last)
                row, held = sets.rows[index], np.bincount(sets.rows[last], minlength=len(sets.n))
                out = np.empty(len(index), _MEMBER)
                out["key"], out["c"], out["n"] = sets.value[index], sets.classes[row], sets.n[row]
                out["most"] = np.where(last[index], held[row], sets.n[row])
                yield from _by_bucket(out, buckets, schema.names)

    def meet(table: pa.Table) -> pa.Table:
        rows = np.frombuffer(_bytes(table["members"]), _MEMBER)
        rows = rows[np.lexsort((rows["c"], rows["key"]))]
        new = np.ones(len(rows), bool)
        new[1:] = (rows["key"][1:] != rows["key"][:-1]) | (rows["c"][1:] != rows["c"][:-1])
        rows = rows[new]
        _, start, size = np.unique(rows["key"], return_index=True, return_counts=True)
        found = []
        for g in range(2, SMALL + 1):
            of = start[size == g]
            for i in range(g):
                for j in range(i + 1, g):
                    x, y = rows[of + i], rows[of + j]
                    near = may_link(x["n"], y["n"], x["most"], y["most"])
                    pair = np.empty(near.sum(), [("a", "<i8"), ("b", "<i8"), ("n", "<i4"), ("m", "<i4")])
                    pair["a"], pair["b"], pair["n"], pair["m"] = x["c"][near], y["c"][near], x["n"][near], y["n"][near]
                    found.append(pair)
        pairs = np.unique(np.concatenate(found)) if found else np.empty(0, [("a", "<i8"), ("b", "<i8"), ("n", "<i4"), ("m", "<i4")])
        large = np.flatnonzero(size > SMALL)
        many = [rows[i : i + g] for i, g in zip(start[large], size[large])]
        many = np.concatenate([rows[:0], *(m[partnered(m["n"], m["most"])] for m in many)])
        none = pa.nulls(len(many), pa.int64())
        return pa.table({
            "region": pa.chunked_array([pa.nulls(len(pairs), pa.int64()), pa.array(many["key"].copy().view(np.int64))]),
            "a": np.concatenate([pairs["a"], many["c"]]),
            "b": pa.chunked_array([pa.array(pairs["b"].copy()), none]),
            "n": np.concatenate([pairs["n"], many["n"]]).astype(np.int64),
            "m": np.concatenate([pairs["m"], many["most"]]).astype(np.int64)})

    sent = docs.select("text").mapInArrow(send, schema)
    return sent.groupBy("bucket").applyInArrow(meet, "region long, a long, b long, n long, m long")


def shingle_sets(docs: DataFrame, wanted: DataFrame, rows: DataFrame) -> DataFrame:
    """(c, shingles): the packed set of each class in ``wanted(c)``, from one document of it."""
    one = rows.join(wanted, "c", "left_semi").groupBy("c").agg(F.min(F.struct("k", "h")).alias("x")).select("c", "x.k", "x.h")
    one = stored(one, "chosen")
    texts = docs.select(F.xxhash64("doc_id").alias("k"), F.xxhash64("text").alias("h"), "text")
    chosen = texts.join(one.hint("broadcast" if one.count() <= CHOSEN else "shuffle_hash"), ["k", "h"]).select("c", "text")
    schema = T.StructType().add("c", "long").add("shingles", "binary")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, size=SLICE):
                sets = Sets(batch.column("text"))
                first = np.flatnonzero(sets.leaders())
                packed = [sets.value[sets.first[i] : sets.first[i + 1]].tobytes() for i in first]
                yield pa.RecordBatch.from_arrays([pa.array(sets.classes[first], pa.int64()), pa.array(packed, pa.binary())], names=schema.names)

    return chosen.mapInArrow(read, schema)


def possible(pairs: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """The ``pairs(a, b)`` whose ``sketches(c, n, sketch)`` do not rule out ``percent``.

    A sketch counts a set's shingles in cells; the sum of differences of two sketches is at most the size of the
    symmetric difference, so what is left out is certainly further apart. Sketches are a small part of a set's size.
    """
    sides = pairs.select("a", "b").join(sketches.select(F.col("c").alias("a"), "n", F.col("sketch").alias("x")), "a")
    sides = sides.join(sketches.select(F.col("c").alias("b"), F.col("n").alias("m"), F.col("sketch").alias("y")), "b").select("a", "b", "n", "m", "x", "y")
    schema = T.StructType().add("a", "long").add("b", "long")

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            apart = np.zeros(len(batch), np.int64)
            for i, (x, y) in enumerate(zip(batch.column("x"), batch.column("y"))):
                x, y = np.frombuffer(x.as_buffer(), np.uint8), np.frombuffer(y.as_buffer(), np.uint8)
                cells = min(len(x), len(y))
                apart[i] = np.abs(folded(x, cells) - folded(y, cells)).sum()
            both = batch.column("n").to_numpy() + batch.column("m").to_numpy()
            near = pa.array(100 * (both - apart) >= percent * (both + apart))
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(near), batch.column("b").filter(near)], names=schema.names)

    return stored(sides.mapInArrow(keep, schema), "possible")


def cross_pairs(members: DataFrame) -> DataFrame:
    """(a, b): the pairs of each region's ``members`` of different labels that neither sizes nor pivots nor sketches rule out.

    A region is compared in one task, BLOCK members with all others at a time. Regions overlap, so a pair is named by the least
    one it shares alone: of those where ``most`` leaves nothing out for either, else of all, which then agree on ``most``.
    """
    free = F.collect_list(F.when(F.col("most") >= F.col("n"), F.col("region"))).alias("free")
    members = members.join(members.groupBy("c").agg(free, F.collect_list("region").alias("every")), "c")
    schema = T.StructType().add("a", "long").add("b", "long")

    def compare(table: pa.Table) -> pa.Table:
        c, n, most, label, p, d = (table[x].to_numpy() for x in ("c", "n", "most", "label", "p", "d"))
        sketch = np.stack([folded(np.frombuffer(x.as_buffer(), np.uint8), SKETCH) for x in table["sketch"]]).astype(np.int32)
        free, every = ([frozenset(x) for x in table[y].to_pylist()] for y in ("free", "every"))
        region, found = table["region"][0].as_py(), [np.empty((0, 2), np.int64)]
        for start in range(0, len(c), BLOCK):
            of = slice(start, start + BLOCK)
            left, right = c[of, None], c[None, :]
            # a distance that is not known (NaN) rules nothing out
            apart = (p[of, None] == p[None, :]) & (np.abs(d[of, None] - d[None, :]) > (100 - PERCENT) / 100 + 1e-9)
            i, j = np.nonzero((left < right) & (label[of, None] != label[None, :]) & ~apart & may_link(n[of, None], n[None, :], most[of, None], most[None, :]))
            for k in range(0, len(i), 1 << 14):
                x, y = i[k : k + (1 << 14)] + start, j[k : k + (1 << 14)]
                both, far = n[x] + n[y], np.abs(sketch[x] - sketch[y]).sum(axis=1)
                near = 100 * (both - far) >= PERCENT * (both + far)
                x, y = x[near], y[near]
                here = np.array([min(free[u] & free[v] or every[u] & every[v]) == region for u, v in zip(x, y)], bool)
                found.append(np.stack([c[x[here]], c[y[here]]], axis=1))
        pairs = np.concatenate(found)
        return pa.table({"a": pairs[:, 0], "b": pairs[:, 1]})

    return members.withColumn("d", F.coalesce("d", F.lit(float("nan")))).groupBy("region").applyInArrow(compare, schema)


def distances(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b, same, either): sizes of intersection and union of the sets of each pair."""
    sides = pairs.join(sets.select(F.col("c").alias("a"), F.col("shingles").alias("x")), "a")
    sides = sides.join(sets.select(F.col("c").alias("b"), F.col("shingles").alias("y")), "b").select("a", "b", "x", "y")
    schema = T.StructType().add("a", "long").add("b", "long").add("same", "long").add("either", "long")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            same, either = [], []
            for x, y in zip(batch.column("x"), batch.column("y")):
                x, y = np.frombuffer(x.as_buffer(), U), np.frombuffer(y.as_buffer(), U)
                if len(x) > len(y):
                    x, y = y, x
                both = int((y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x).sum())
                same.append(both)
                either.append(len(x) + len(y) - both)
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(same, pa.int64()), pa.array(either, pa.int64())], names=schema.names)

    return sides.mapInArrow(compare, schema)


def components(edges: DataFrame) -> DataFrame:
    """(c, component): the least class reachable over ``edges(a, b)``, for every class with an edge.

    Each round takes the least label among neighbours, then the label of that label; tables are stored.
    """
    both = stored(edges.select("a", "b").union(edges.select("b", "a")).distinct(), "edges")
    labels = stored(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("c"), F.least("a", "m").alias("l")), "labels")
    while True:
        near = both.join(labels.select(F.col("c").alias("b"), F.col("l").alias("m")), "b").groupBy("a").agg(F.min("m").alias("m"))
        step = labels.join(near.withColumnRenamed("a", "c"), "c").select("c", "l", F.least("l", "m").alias("m"))
        jump = step.join(labels.select(F.col("c").alias("m"), F.col("l").alias("j")), "m").select("c", "l", F.least("m", "j").alias("m"))
        moved = stored(jump, "labels")
        labels = moved.select("c", F.col("m").alias("l"))
        if moved.where("m < l").isEmpty():
            return labels.select("c", F.col("l").alias("component"))


def merged(labels: DataFrame, edges: DataFrame) -> DataFrame:
    """The labels (c, component) after more ``edges(a, b)``: these are contracted to the components so far."""
    ends = edges.select("a", "b")
    for side in "ab":
        ends = ends.join(labels.select(F.col("c").alias(side), "component"), side, "left").withColumn(side, F.coalesce("component", side)).drop("component")
    ends = stored(ends.where("a != b").distinct(), "ends")
    if ends.isEmpty():
        return labels
    roots = components(ends)
    moved = labels.join(roots.select(F.col("c").alias("component"), F.col("component").alias("root")), "component", "left")
    return stored(moved.select("c", F.coalesce("root", "component").alias("component")).union(roots.join(labels, "c", "left_anti")), "labels")


def linked(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """(c, component): the least class reachable by links, for every linked class of ``rows`` (see ``classes_of``)."""
    spark = docs.sparkSession
    # a bucket takes at most some 6 bytes per shingle of its share of the documents
    size = rows.agg(F.sum("n")).first()[0] or 0
    buckets = max(2 * int(spark.conf.get("spark.sql.shuffle.partitions")), 6 * size // BUCKET)
    met = stored(regions(docs, common_shingles(docs, buckets), buckets), "regions")
    classes = met.select(F.col("a").alias("c")).union(met.where("b is not null").select("b")).distinct()
    sketches = rows.join(classes, "c", "left_semi").groupBy("c").agg(F.min("n").alias("n"), F.min("sketch").alias("sketch"))
    sketches = stored(sketches, "sketches")
    pairs = possible(met.where("b is not null").select("a", "b").distinct(), sketches, PERCENT)
    state = met.where("b is null").select("region", F.col("a").alias("c"), "n", F.col("m").alias("most"), F.lit(True).alias("open"))
    wanted = state.select("c").union(pairs.select("a")).union(pairs.select("b")).distinct()
    sets = stored(shingle_sets(docs, wanted, rows), "sets")
    near = F.col("same") * 100 >= PERCENT * F.col("either")
    # classes that links have connected so far, in any region, share a label and need no comparison among themselves
    labels = components(stored(distances(pairs, sets), "distances").where(near))
    seats = 1
    while not state.isEmpty():
        first = Window.partitionBy("region").orderBy(F.desc("open"), F.desc(F.col("most") / F.col("n")), F.xxhash64("c"), "c")
        pivots = state.withColumn("seat", F.row_number().over(first)).where(F.col("seat") <= seats)
        pivots = stored(pivots.select("region", F.col("c").alias("p"), F.col("n").alias("pn")), "pivots")
        faced = state.join(pivots, "region").select("region", "c", "n", "most", "p", "pn").where("c != p")
        # sizes further apart put a distance beyond twice the threshold; it stays unknown (null)
        reach = 100 * F.least("n", "pn") >= (2 * PERCENT - 100) * F.greatest("n", "pn")
        asked = faced.where(reach).select(F.least("c", "p").alias("a"), F.greatest("c", "p").alias("b")).distinct()
        found = stored(distances(possible(asked, sketches, 2 * PERCENT - 100), sets), "distances")
        labels = merged(labels, found.where(near))
        keyed = found.select("a", "b", (1 - F.col("same") / F.col("either")).alias("d"), near.alias("near"))
        placed = faced.withColumn("a", F.least("c", "p")).withColumn("b", F.greatest("c", "p")).join(keyed, ["a", "b"], "left")
        placed = placed.select("region", "c", "n", "most", "p", F.coalesce("near", F.lit(False)).alias("cell"), "d")
        # pivots have met everybody and leave
        rest = placed.join(pivots.select("region", F.col("p").alias("c")), ["region", "c"], "left_anti")
        rest = rest.join(labels, "c", "left").join(labels.select(F.col("c").alias("p"), F.col("component").alias("of")), "p", "left")
        rest = rest.select("region", "c", "n", "most", F.col("component").isNull().alias("open"), F.coalesce("component", "c").alias("label"),
                           "p", F.coalesce("of", "p").alias("of"), "cell", "d")
        rest = stored(rest, "cells")
        members = rest.groupBy("region", "c").agg(
            F.max("n").alias("n"), F.max("most").alias("most"), F.max("open").alias("open"), F.max("label").alias("label"),
            F.max("cell").alias("cell"), F.min(F.struct("p", "d")).alias("x"))
        least = rest.where("label != of").groupBy("region", "p").agg(F.min("d").alias("least"))
        # a member of a cell leaves if some pivot whose cell holds it puts all members of other labels out of its reach
        within = F.coalesce(F.col("d") >= F.col("least") - (100 - PERCENT) / 100 - 1e-9, F.lit(False))
        held = rest.where("cell").join(least, ["region", "p"], "left").groupBy("region", "c").agg(F.min(within).alias("boundary"))
        after = members.join(held, ["region", "c"], "left").where(~F.col("cell") | F.col("boundary"))
        after = stored(after.select("region", "c", "n", "most", "open", "label", F.col("x.p").alias("p"), F.col("x.d").alias("d")), "state")
        seats = min(2 * seats, SEATS)
        # a region of one label is done
        sizes = after.groupBy("region").agg(F.count("*").alias("size"), (F.min("label") < F.max("label")).alias("mixed")).where("mixed")
        small = after.join(sizes.where(F.col("size") <= REST), "region", "left_semi").join(sketches.select("c", "sketch"), "c")
        last = distances(possible(cross_pairs(small), sketches, PERCENT), sets)
        labels = merged(labels, stored(last, "distances").where(near))
        state = after.join(sizes.where(F.col("size") > REST), "region", "left_semi").select("region", "c", "n", "most", "open")
    return labels


def join_classes(docs: DataFrame) -> DataFrame:
    """(doc_id, k, h, n_shingles, class_id, component_id, component): one row per row of ``docs(doc_id, text)``.

    ``component_id`` is the least doc_id reachable by links, the row's own included; documents without words
    have an empty set and link with nothing. ``class_id`` is equal for equal sets (a 64-bit hash of set and
    size) and null for empty ones. Repeated rows are linked copies; null ids take part but never name a
    component that has another id; other columns are ignored; no documents give no rows. ``component`` is the
    least class of the component, null for empty sets: components differ in it even if their least ids are equal or null.
    """
    rows = stored(classes_of(docs), "classes")
    least = rows.where("c is not null").groupBy("c").agg(F.min("doc_id").alias("first"))
    named = linked(docs, rows)
    joined = least.join(named, "c", "left").select("c", "first", F.coalesce("component", "c").alias("component"))
    joined = stored(joined, "named")
    lowest = joined.groupBy("component").agg(F.min("first").alias("component_id"))
    table = joined.join(lowest, "component").select("c", "component_id", "component")
    salted = table.select("*", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    salt = F.pmod(F.xxhash64("k", "h"), F.lit(SALTS)).cast("int")
    out = rows.withColumn("salt", salt).join(salted, ["c", "salt"], "left")
    return out.select("doc_id", "k", "h", F.col("n").alias("n_shingles"), F.col("c").alias("class_id"), F.coalesce("component_id", "doc_id").alias("component_id"), "component")
