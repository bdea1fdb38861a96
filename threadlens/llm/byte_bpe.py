"""Byte-level BPE encoding and decoding with a hierarchical-bitmap rank queue.

The pieces of pre-tokens form a linked list. For every rank there is a bucket of list positions; three
levels of 64-bit maps say which buckets hold something, so the next merge is found by three
find-first-set steps. Merges leave old entries in their buckets; an entry is checked when it is
taken and skipped if its pair has changed. The pre-tokens that a run of texts has anew stand in one list, apart by a byte that
no text holds: merges of one do not depend on the others, so a bucket serves all that have its pair.
A pre-token of n bytes takes O(n) queue steps, where the usual rescan takes O(n^2).
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from threadlens.llm.words import slices

#: Pre-tokens of up to so many characters are remembered, and at most so many of them per worker process.
CACHED_CHARS, CACHED_PIECES = 32, 300_000
#: Bytes of text whose pre-tokens are strings at a time.
RUN = 1 << 19
#: Bytes of new pre-tokens that are in one list, about.
LIST = 1 << 16
#: A byte that UTF-8 never has.
APART = b"\xff"


def read_ranks(path: str) -> dict[bytes, int]:
    """The vocabulary of a ``.tiktoken`` file: base64 of the bytes and rank in each line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}


class RankQueue:
    """Positions by merge rank; the lowest rank first.

    ``top`` has a bit per group of 4,096 ranks, ``middle`` per block of 64, ``low`` per rank. An emptied queue is all zeros
    again, so one queue serves all pieces of a worker.
    """

    __slots__ = ("buckets", "low", "middle", "top")

    def __init__(self, ranks: int = 1 << 18) -> None:
        self.buckets: dict[int, list[int]] = {}
        self.top, self.middle, self.low = 0, [0] * ((ranks >> 12) + 1), [0] * ((ranks >> 6) + 1)

    def open(self, rank: int, bucket: list[int]) -> None:
        """Adds a bucket of a rank that has none."""
        self.buckets[rank] = bucket
        block = rank >> 6
        if not self.low[block]:
            self.middle[rank >> 12] |= BITS[block & 63]
            self.top |= 1 << (rank >> 12)
        self.low[block] |= BITS[rank & 63]

    def fill(self, ranks: list[int]) -> None:
        """Adds every position with the rank that ``ranks`` has for it (negative: none)."""
        buckets = self.buckets
        for position, rank in enumerate(ranks):
            if rank >= 0:
                if rank in buckets:
                    buckets[rank].append(position)
                else:
                    self.open(rank, [position])

    def take_rank(self) -> tuple[int, list[int]] | None:
        """The lowest rank with its whole bucket, which leaves the queue."""
        top = self.top
        if not top:
            return None
        group = (top & -top).bit_length() - 1
        middle = self.middle[group]
        block = group << 6 | (middle & -middle).bit_length() - 1
        low = self.low[block]
        rank = block << 6 | (low & -low).bit_length() - 1
        low &= low - 1
        self.low[block] = low
        if not low:
            middle &= middle - 1
            self.middle[group] = middle
            if not middle:
                self.top = top & (top - 1)
        return rank, self.buckets.pop(rank)


BITS = [1 << i for i in range(64)]


class Merges:
    """The merges of a vocabulary, and an empty queue for them."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        # a token with APART is in no text; without those no pair reaches from one pre-token into the next
        self.ranks = {token: rank for token, rank in ranks.items() if APART not in token}
        of = self.ranks.get
        self.single = [of(bytes([a]), -1) for a in range(256)]
        self.pairs = [[of(bytes([a, b]), -1) for b in range(256)] for a in range(256)]
        self.queue = RankQueue(max(ranks.values(), default=0) + 1)

    def encode(self, pieces: list[bytes]) -> list[list[int]]:
        """Token ids of each pre-token (UTF-8, not empty).

        A merge of rank r makes a token that is new to the list, so the pairs it forms have a rank
        other than r; those of lower rank are merged first, before the rest of bucket r, which goes back
        into the queue for that. Of a bucket the leftmost position comes first.
        """
        whole = list(map(self.ranks.get, pieces))
        text = APART + APART.join(piece for piece, rank in zip(pieces, whole) if rank is None) + APART
        rank_of, queue, pairs = self.ranks.get, self.queue, self.pairs
        open_, take, held = queue.open, queue.take_rank, queue.buckets.get
        pair_rank = [pairs[a][b] for a, b in zip(text, text[1:])]
        pair_rank.append(-1)
        token = [self.single[a] for a in text]
        after, before = [*range(1, len(text) + 1)], [*range(-1, len(text))]
        queue.fill(pair_rank)
        while (entry := take()) is not None:
            rank, bucket = entry
            if len(bucket) > 1:
                bucket.sort(reverse=True)
            while bucket:
                at = bucket.pop()
                if pair_rank[at] != rank:
                    continue
                gone, left = after[at], before[at]
                end = after[gone]
                pair_rank[gone] = -1
                after[at], before[end], token[at] = end, at, rank
                lower = False
                new = pair_rank[at] = rank_of(text[at : after[end]], -1)
                if new >= 0:
                    lower = new < rank
                    if (other := held(new)) is None:
                        open_(new, [at])
                    else:
                        other.append(at)
                new = pair_rank[left] = rank_of(text[left:end], -1)
                if new >= 0:
                    lower = lower or new < rank
                    if (other := held(new)) is None:
                        open_(new, [left])
                    else:
                        other.append(left)
                if lower and bucket:
                    open_(rank, bucket)
                    break
        out, at = [], 1
        for piece, rank in zip(pieces, whole):
            if rank is not None:
                out.append([rank])
                continue
            ids, end = [], at + len(piece)
            while at < end:
                ids.append(token[at])
                at = after[at]
            out.append(ids)
            at = end + 1
        return out


def encode_piece(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Token ids of one pre-token."""
    return Merges(ranks).encode([piece])[0]


class Codec:
    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.split, self.merges = regex.compile(pattern), Merges(ranks)
        self.tokens = {str(rank): piece for piece, rank in ranks.items()}
        # decimal ids joined by commas; two generations: what is in use moves on, the rest goes with the older one
        self.known: dict[str, str] = {}
        self.older: dict[str, str] = {}

    def learn(self, words: Iterable[str]) -> None:
        """Encodes those of the distinct ``words`` that are not remembered, so that all are ``known``."""
        if len(self.known) >= CACHED_PIECES // 2:
            self.older, self.known = self.known, {}
        new, size = [], 0
        for word in words:
            if word in self.known:
                continue
            if (found := self.older.get(word)) is not None:
                self.known[word] = found
                continue
            new.append(word)
            size += len(word)
            if size >= LIST:
                self._encode(new)
                new, size = [], 0
        self._encode(new)

    def _encode(self, words: list[str]) -> None:
        for word, ids in zip(words, self.merges.encode([word.encode() for word in words])):
            self.known[word] = ",".join(map(str, ids))

    def written(self, texts: list[str]) -> Iterator[str]:
        """The ids of each text, decimal and joined by commas."""
        split = [self.split.findall(text) for text in texts]
        words = set().union(*split)
        self.learn(words)
        known = self.known
        for pieces in split:
            yield ",".join(map(known.__getitem__, pieces))
        for word in words:
            if len(word) > CACHED_CHARS:
                del known[word]
        if len(known) > CACHED_PIECES:  # one text had more
            known.clear()

    def encode(self, text: str) -> list[int]:
        return [int(i) for written in self.written([text]) for i in written.split(",") if i]

    def decode(self, ids: Iterable[int]) -> bytes:
        return self.decode_written(map(str, ids))

    def decode_written(self, ids: Iterable[str]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


_CODECS: dict[tuple[str, str], Codec] = {}


def _ship(docs: DataFrame, vocabulary: str, pattern: str):
    """A function that gives a task its worker process's codec of this vocabulary."""
    ranks = read_ranks(vocabulary)
    key = hashlib.sha256(repr(sorted(ranks.items())).encode()).hexdigest(), pattern
    shipped = docs.sparkSession.sparkContext.broadcast(ranks)

    def codec() -> Codec:
        from threadlens.llm import byte_bpe  # the worker's module, whose codecs outlive a task

        if key not in byte_bpe._CODECS:
            byte_bpe._CODECS.clear()
            byte_bpe._CODECS[key] = Codec(shipped.value, pattern)
        return byte_bpe._CODECS[key]

    return codec


def encode_documents(docs: DataFrame, vocabulary: str, pattern: str) -> DataFrame:
    """All columns of ``docs`` and ``ids`` (array of int): the token ids of every whole text.

    Null texts encode as empty texts: no ids. Repeated rows are encoded each. An own column ``ids``
    of the input is replaced. No shuffle; the vocabulary (tens of thousands of entries) is
    read on the driver and shipped once per executor.
    """
    shipped = _ship(docs, vocabulary, pattern)
    kept = docs.drop("ids")
    schema, names = T.StructType([*kept.schema.fields]).add("ids", T.ArrayType(T.IntegerType())), [*kept.columns, "ids"]

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = shipped()
        for whole in batches:
            for batch in slices(whole, size=RUN):
                written = codec.written([x or "" for x in batch.column("text").to_pylist()])
                ids = pa.array([[int(i) for i in w.split(",")] if w else [] for w in written], pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([*batch.columns, ids], names=names)

    return kept.mapInArrow(encode, schema)


def decode_documents(encoded: DataFrame, vocabulary: str) -> DataFrame:
    """All columns of ``encoded`` with ``ids`` replaced by ``decoded`` (binary); null ids decode to nothing."""
    shipped = encoded.sparkSession.sparkContext.broadcast(read_ranks(vocabulary))
    rest = [c for c in encoded.columns if c not in ("ids", "decoded")]
    schema = T.StructType([encoded.schema[c] for c in rest]).add("decoded", "binary")

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = {rank: piece for piece, rank in shipped.value.items()}
        for batch in batches:
            texts = [b"".join(map(tokens.__getitem__, ids or ())) for ids in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in rest], pa.array(texts, pa.binary())], names=[*rest, "decoded"])

    return encoded.select(*rest, "ids").mapInArrow(decode, schema)


def round_trip(docs: DataFrame, vocabulary: str, pattern: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256, n_bytes) of every row: encoded and decoded in one pass.

    ``ids_sha256`` is of the decimal ids joined by commas, ``decoded_sha256`` of the bytes that the ids
    decode to. Ids are remembered as they are written down, pre-token by pre-token, so no list of ids leaves the task.
    """
    shipped = _ship(docs, vocabulary, pattern)
    schema = T.StructType([docs.schema["doc_id"]]).add("n_tokens", "long").add("ids_sha256", "string").add("decoded_sha256", "string").add("n_bytes", "long")

    def both(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = shipped()
        for whole in batches:
            for batch in slices(whole, size=RUN):
                rows = []
                for written in codec.written([x or "" for x in batch.column("text").to_pylist()]):
                    ids = written.split(",") if written else []
                    raw = codec.decode_written(ids)
                    rows.append((len(ids), hashlib.sha256(written.encode()).hexdigest(), hashlib.sha256(raw).hexdigest(), len(raw)))
                n, a, b, size = zip(*rows)
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(a), pa.array(b), pa.array(size, pa.int64())], names=schema.names)

    return docs.select("doc_id", "text").mapInArrow(both, schema)
