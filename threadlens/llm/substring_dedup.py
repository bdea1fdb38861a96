"""Removal of passages that repeat anywhere, by fixed-block anchors.

Every document is cut into non-overlapping blocks of 18 words, which are indexed; every rolling window of 18
words of every document probes that index. Any passage of 35 words holds a whole block, so two copies of
a passage always meet there. From the anchors that hit, windows of 35 words are extended one by
one and compared by 96-bit fingerprints; joined, they are the maximal repeats.

Probes and windows travel as packed arrays: a row per slice of text and bucket of hashes. A slice sends
each hash once (twice if it has it more often), so a passage that a third of all documents share
is no heavy key; windows that repeat inside a slice are settled there.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from threadlens.llm.scratch import stored
from threadlens.llm.words import Words, slices

U = np.uint64
#: Bytes of a probe's hash beyond its bucket.
PROBE_BYTES = 5
#: Bits of the filter of rows (8 MB), whatever the number of documents.
ROW_BITS = 1 << 26
_LOW = U((1 << 8 * PROBE_BYTES) - 1)


def _packed(keys: np.ndarray) -> bytes:
    return keys.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :PROBE_BYTES].tobytes()


def _unpacked(raw: bytes) -> np.ndarray:
    out = np.zeros((len(raw) // PROBE_BYTES, 8), np.uint8)
    out[:, :PROBE_BYTES] = np.frombuffer(raw, np.uint8).reshape(-1, PROBE_BYTES)
    return out.view("<u8").ravel()


class RowFilter:
    """Which rows may be among ``found(u)``: a bit for each u, modulo ``size``. Rows that share a bit only do needless work.

    Spark packs 32,768 neighbouring bits into one row, so the driver takes at most ``size`` / 8 bytes, however many rows are found.
    """

    def __init__(self, found: DataFrame):
        self.size = ROW_BITS
        bit = F.pmod(F.col("u"), F.lit(self.size)) + 1  # pages and their bits count from 1 and 0
        page, place = F.bitmap_bucket_number("bit").alias("page"), F.bitmap_bit_position("bit")
        pages = found.select(bit.alias("bit")).groupBy(page).agg(F.bitmap_construct_agg(place).alias("bits"))
        bits = np.zeros((self.size >> 15, 4096), np.uint8)
        for number, packed in pages.collect():
            bits[number - 1] = np.frombuffer(packed, np.uint8)
        self.shipped = found.sparkSession.sparkContext.broadcast(bits.ravel())

    def holds(self, batch: pa.RecordBatch) -> np.ndarray:
        """Whether each row of the batch may be among them."""
        at = batch.column("u").to_numpy() % self.size
        return (self.shipped.value[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)

    def keep(self, rows: DataFrame) -> DataFrame:
        """The rows that may be among them."""

        def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                yield batch.filter(pa.array(self.holds(batch)))

        return rows.mapInArrow(choose, rows.schema)


def _cuts(buckets: np.ndarray, n: int) -> np.ndarray:
    return np.searchsorted(buckets, np.arange(n + 1))


def _joined(column: pa.ChunkedArray) -> bytes:
    return b"".join(column.to_pylist())


def keyed(docs: DataFrame) -> DataFrame:
    """``docs`` as (doc_id, u, text): u is a 64-bit hash of id and text, by which places name their row; equal rows share it."""
    return docs.select("doc_id", F.xxhash64("doc_id", "text").alias("u"), "text")


def anchors(rows: DataFrame, block: int, buckets: int) -> DataFrame:
    """(u, block): the blocks whose words stand anywhere else too (up to false hits, which cost only time)."""
    schema = T.StructType().add("bucket", "integer").add("probes", "binary").add("blocks", "binary").add("places", "binary")

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole):
                words = Words(batch.column("text"), lower=False)
                hashes, at = words.windows(block)
                if not len(hashes):
                    continue
                bucket, low = ((hashes >> U(8 * PROBE_BYTES)) % U(buckets)).astype(np.int64), hashes & _LOW
                order = np.lexsort((low, bucket))
                b, x = bucket[order], low[order]
                third = np.zeros(len(b), bool)
                third[2:] = (b[2:] == b[:-2]) & (x[2:] == x[:-2])
                b, x = b[~third], x[~third]
                cut = _cuts(b, buckets)
                own = np.flatnonzero(words.places[at] % block == 0)
                own = own[np.argsort(bucket[own], kind="stable")]
                own_cut = _cuts(bucket[own], buckets)
                place = np.empty(len(own), [("u", "<i8"), ("n", "<i4")])
                of = words.rows[at[own]]
                place["u"] = batch.column("u").to_numpy()[of]
                place["n"] = words.places[at[own]] // block
                full = np.flatnonzero(np.diff(cut))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(full, pa.int32()),
                     pa.array([_packed(x[cut[i] : cut[i + 1]]) for i in full], pa.binary()),
                     pa.array([_packed(low[own[own_cut[i] : own_cut[i + 1]]]) for i in full], pa.binary()),
                     pa.array([place[own_cut[i] : own_cut[i + 1]].tobytes() for i in full], pa.binary())],
                    names=schema.names)

    def look_up(table: pa.Table) -> pa.Table:
        seen = np.sort(_unpacked(_joined(table["probes"])))
        twice = np.unique(seen[1:][seen[1:] == seen[:-1]])
        blocks = _unpacked(_joined(table["blocks"]))
        place = np.frombuffer(_joined(table["places"]), [("u", "<i8"), ("n", "<i4")])
        hit = place[np.isin(blocks, twice)]
        return pa.table({"u": hit["u"].copy(), "block": hit["n"].copy()})

    found = rows.select("u", "text").mapInArrow(probe, schema)
    return found.groupBy("bucket").applyInArrow(look_up, "u long, block int")


def repeated_windows(rows: DataFrame, hits: DataFrame, window: int, block: int, buckets: int) -> DataFrame:
    """(u, starts): per document the first words of the windows whose sequence starts elsewhere too."""
    per_doc = hits.groupBy("u").agg(F.collect_set("block").alias("blocks"))
    wanted = RowFilter(hits).keep(rows.select("u", "text")).join(per_doc.hint("shuffle_hash"), "u")
    parts = buckets
    place_type = [("u", "<i8"), ("n", "<i4")]
    schema = T.StructType().add("bucket", "integer").add("keys", "binary").add("places", "binary")

    def extend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole):
                words = Words(batch.column("text"), lower=False)
                a, at = words.windows(window, 1)
                if not len(a):
                    continue
                c, _ = words.windows(window, 2)
                blocks = batch.column("blocks")
                sizes = np.diff(np.asarray(blocks.offsets))
                listed = np.repeat(np.arange(len(batch), dtype=np.int64), sizes) << 32 | blocks.flatten().to_numpy().astype(np.int64)
                first = words.rows[at].astype(np.int64) << 32 | -(-words.places[at] // block)
                chosen = np.flatnonzero(np.isin(first, listed))
                if not len(chosen):
                    continue
                a, c, at = a[chosen], c[chosen] >> U(32), at[chosen]
                bucket = (c % U(buckets)).astype(np.int64)
                order = np.lexsort((c, a, bucket))
                a, c, at, bucket = a[order], c[order], at[order], bucket[order]
                new = np.ones(len(a), bool)
                new[1:] = (a[1:] != a[:-1]) | (c[1:] != c[:-1])
                group = np.cumsum(new) - 1
                count = np.bincount(group)
                heads = np.flatnonzero(new)
                local = count[group] > 1
                key = np.empty(len(heads), [("a", "<u8"), ("c", "<u4"), ("many", "u1")])
                key["a"], key["c"], key["many"] = a[heads], c[heads], count > 1
                place = np.empty(len(a), place_type)
                of = words.rows[at]
                place["u"], place["n"] = batch.column("u").to_numpy()[of], words.places[at]
                cut = _cuts(bucket[heads], buckets)
                full = np.flatnonzero(np.diff(cut))
                sent = [(key[cut[i] : cut[i + 1]].tobytes(), place[heads[cut[i] : cut[i + 1]]][count[cut[i] : cut[i + 1]] == 1].tobytes()) for i in full]
                numbers = list(full)
                mine = place[local]
                for start in range(0, len(mine), 1 << 16):
                    part = mine[start : start + (1 << 16)]
                    numbers.append(-1 - (int(part["n"][0]) + start) % buckets)
                    sent.append((b"", part.tobytes()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(numbers, pa.int32()), pa.array([k for k, _ in sent], pa.binary()), pa.array([p for _, p in sent], pa.binary())],
                    names=schema.names)

    def compare(table: pa.Table) -> pa.Table:
        place = np.frombuffer(_joined(table["places"]), place_type)
        if table["bucket"][0].as_py() >= 0:
            key = np.frombuffer(_joined(table["keys"]), [("a", "<u8"), ("c", "<u4"), ("many", "u1")])
            order = np.lexsort((key["c"], key["a"]))
            a, c = key["a"][order], key["c"][order]
            new = np.ones(len(a), bool)
            new[1:] = (a[1:] != a[:-1]) | (c[1:] != c[:-1])
            group = np.cumsum(new) - 1
            times = np.bincount(group, weights=1 + key["many"][order])
            repeated = np.empty(len(a), bool)
            repeated[order] = times[group] > 1
            place = place[repeated[key["many"] == 0]]
        # a packed row per part of the documents: each document's number of places, and the places
        part = place["u"] % parts
        order = np.lexsort((place["u"], part))
        place, part = place[order], part[order]
        cut = _cuts(part, parts)
        full = np.flatnonzero(np.diff(cut))
        rows = []
        for i in full:
            own = place[cut[i] : cut[i + 1]]
            u, n = np.unique(own["u"], return_counts=True)
            rows.append((u.astype("<i8").tobytes(), n.astype("<i4").tobytes(), own["n"].tobytes()))
        names = ("documents", "counts", "places")
        return pa.table({"part": pa.array(full, pa.int32()), **{name: pa.array([r[i] for r in rows], pa.binary()) for i, name in enumerate(names)}})

    def gather(table: pa.Table) -> pa.Table:
        u = np.repeat(np.frombuffer(_joined(table["documents"]), "<i8"), np.frombuffer(_joined(table["counts"]), "<i4"))
        n = np.frombuffer(_joined(table["places"]), "<i4")
        order = np.lexsort((n, u))
        u, n = u[order], n[order]
        head = np.flatnonzero(np.concatenate([np.ones(min(1, len(u)), bool), u[1:] != u[:-1]]))
        starts = pa.ListArray.from_arrays(pa.array(np.append(head, len(n)).astype(np.int32)), pa.array(n))
        return pa.table({"u": u[head], "starts": starts})

    sent = wanted.mapInArrow(extend, schema)
    packed = sent.groupBy("bucket").applyInArrow(compare, "part int, documents binary, counts binary, places binary")
    return packed.groupBy("part").applyInArrow(gather, "u long, starts array<int>")


def remove_repeats(docs: DataFrame, window: int = 35) -> DataFrame:
    """(doc_id, n_words, n_removed, kept, spans): every row of ``docs(doc_id, text)`` without its repeated passages.

    Words are runs of anything but space and the characters 9 to 13. A word goes if any window of
    ``window`` words that covers it starts anywhere else too, judged on the input; repeated rows count as elsewhere.
    ``kept`` is the rest joined by spaces, ``spans`` the maximal removed ranges of words as ``start:end``.
    Null and empty texts have no words; shorter texts lose nothing; other columns are ignored.
    """
    spark, block = docs.sparkSession, (window + 1) // 2
    buckets = 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = keyed(docs)
    hits = stored(anchors(rows, block, buckets), "anchors")
    starts = stored(repeated_windows(rows, hits, window, block, buckets), "repeats")
    # Only rows that may hold a repeat are shuffled with their texts; the others are finished where they are read.
    touched = RowFilter(starts)
    joined = touched.keep(rows).join(starts.hint("shuffle_hash"), "u", "left").select("doc_id", "text", "starts")
    schema = T.StructType([docs.schema["doc_id"]]).add("n_words", "long").add("n_removed", "long").add("kept", "string").add("spans", "string")

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole):
                out = []
                for text, starts in zip(batch.column("text").to_pylist(), batch.column("starts")):
                    words = (text or "").encode().split()
                    spans: list[list[int]] = []
                    if starts.is_valid:
                        for s in np.unique(starts.values.to_numpy()).tolist():
                            if spans and s <= spans[-1][1]:
                                spans[-1][1] = s + window
                            else:
                                spans.append([s, s + window])
                    kept, at = [], 0
                    for a, b in spans:
                        kept += words[at:a]
                        at = b
                    kept += words[at:]
                    out.append((len(words), len(words) - len(kept), b" ".join(kept).decode(), ",".join(f"{a}:{b}" for a, b in spans)))
                n, gone, kept, spans = zip(*out)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(kept, pa.string()), pa.array(spans, pa.string())],
                    names=schema.names)

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left = batch.filter(pa.array(~touched.holds(batch)))
            nothing = pa.nulls(len(left), pa.list_(pa.int32()))
            yield from cut([pa.RecordBatch.from_arrays([left.column("doc_id"), left.column("text"), nothing], names=["doc_id", "text", "starts"])])

    return joined.mapInArrow(cut, schema).union(rows.mapInArrow(whole, schema))
