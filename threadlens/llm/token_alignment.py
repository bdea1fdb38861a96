"""Alignment of two tokenizers by interval coalescing.

Tokens of A and B are byte intervals of the same text. All tokens of a batch of texts are sorted by
start (``lexsort``); where a start reaches the running maximum of the ends before it
(``maximum.accumulate``), both tokenizers end a token there, and a new group begins. Inside a group, each place
where the start changes opens an interval that belongs to exactly one A and one B token: those are the links.

How many documents hold a linked id pair is counted over the whole corpus. A chunk of a few megabytes of text
keeps a dictionary of its pairs; only dictionary entries are shuffled, never one row per token or document,
so a pair that is in every document costs one row per chunk.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from threadlens.llm.scratch import stored
from threadlens.llm.words import slices

#: Characters after which a long text is cut at the next place where no token of either side can span the cut.
PART_CHARS = 1 << 18
#: Bytes of text of a chunk, which has one dictionary, and characters that are sorted at a time.
CHUNK_BYTES, SORTED_CHARS = 8 << 20, 1 << 19
#: Parts that go to the tokenizers in one call.
ENCODED_AT_ONCE = 8
_CUT = re.compile("(?<=[0-9A-Za-z]) (?=[0-9A-Za-z])")


def byte_level_alphabet() -> dict[str, int]:
    """The character that byte-level vocabularies write for each byte: itself if it is printable Latin-1,
    else the next of those from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(0x100 + i): b for i, b in enumerate(hidden)}


# The pre-token pattern of byte-level vocabularies, and characters whose class (letter, number, space) is the same
# in every Unicode version since 1.1, so that any engine splits them alike.
PRE_TOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_PLAIN = re.compile("[\t\n\r -~\u00a1-\u017f]*")


def rank_encoder(a_json: str, alphabet: dict[str, int]):
    """The same vocabulary as an encoder by ranks, which is some times faster; None unless the file is a plain byte-level
    vocabulary whose ids follow its merges."""
    import tiktoken

    file = json.loads(a_json)
    model, split = file["model"], file.get("pre_tokenizer") or {}
    plain = file.get("normalizer") is None and split.get("type") == "ByteLevel" and split.get("use_regex") and not split.get("add_prefix_space")
    plain = plain and not any(model.get(x) for x in ("dropout", "ignore_merges", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback"))
    joined = ["".join(m) if isinstance(m, list) else m.replace(" ", "") for m in model["merges"]]
    ids = [model["vocab"].get(x) for x in joined]
    if not plain or ids != list(range(256, 256 + len(ids))) or any(model["vocab"].get(c, 256) > 255 for c in alphabet):
        return None
    ranks = {bytes(alphabet[c] for c in entry): model["vocab"][entry] for entry in [*alphabet, *joined]}
    return tiktoken.Encoding("plain", pat_str=PRE_TOKEN, mergeable_ranks=ranks, special_tokens={})


class Side:
    """What the alignment has to know of a vocabulary: the bytes of each token."""

    def __init__(self, tokens: list[bytes]):
        self.tokens = tokens
        self.sizes = np.array([len(t) for t in tokens], np.int64)


class Pair:
    """Both tokenizers, loaded from the contents of their files."""

    def __init__(self, a_json: str, b_model: bytes):
        # read by the library at its first batch: a task has one core, and threads of its own only spin
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(a_json)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=b_model)
        alphabet = byte_level_alphabet()
        entries = {i: entry for entry, i in self.a.get_vocab(with_added_tokens=True).items()}
        self.left = Side([bytes(alphabet.get(c, 0) for c in entries.get(i, "")) for i in range(max(entries, default=-1) + 1)])
        self.right = Side([self._piece(i) for i in range(self.b.get_piece_size())])
        self.by_rank = rank_encoder(a_json, alphabet)
        # a piece that goes on after a space would span the cuts of long texts
        self.cuts = not any("▁" in self.b.id_to_piece(i).lstrip("▁") for i in range(self.b.get_piece_size()))
        self.written, self.lengths = self._table()

    def _piece(self, i: int) -> bytes:
        if self.b.is_control(i) or self.b.is_unknown(i):
            return b""
        piece = self.b.id_to_piece(i)
        return bytes([int(piece[1:-1], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode()

    def _table(self) -> tuple[np.ndarray, np.ndarray]:
        """Each id as decimal text with the mark that follows it: inside a list, or at its end."""
        words = [f"{i}{mark}".encode() for tokens, end in ((self.left.tokens, "|"), (self.right.tokens, ";")) for i in range(len(tokens)) for mark in (",", end)]
        width = max(map(len, words))
        return np.frombuffer(b"".join(w.ljust(width, b"\0") for w in words), np.uint8).reshape(-1, width), np.array([len(w) for w in words])

    def parts(self, text: str) -> Iterator[str]:
        """The text in parts, each without the space in front of it that both tokenizers see."""
        start = 0
        while self.cuts and len(text) - start > PART_CHARS:
            cut = _CUT.search(text, start + PART_CHARS)
            if cut is None:
                break
            yield text[start : cut.start()]
            start = cut.end()
        yield text[start:]

    def encode(self, parts: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        """Ids of both sides. Parts of plain characters go by ranks, others through the file's own pre-tokenizer."""
        plain = [self.by_rank is not None and _PLAIN.fullmatch(p) is not None for p in parts]
        rest = iter(self.a.encode_batch_fast([" " + p for p, x in zip(parts, plain) if not x], add_special_tokens=False))
        a = [self.by_rank.encode_ordinary(" " + p) if x else next(rest).ids for p, x in zip(parts, plain)]
        return a, self.b.encode(parts, num_threads=1)

    def covers(self, part: str, a: list[int], b: list[int]) -> bool:
        """Whether the tokens of both sides spell the part and its space."""
        whole = (" " + part).encode()
        return b"".join(map(self.left.tokens.__getitem__, a)) == whole == b"".join(map(self.right.tokens.__getitem__, b))


@dataclass
class Coalesced:
    """Groups and links of texts laid end to end. ``group_a[i]`` is the group of A's token i; link j joins
    the tokens ``link_a[j]`` and ``link_b[j]``."""

    group_a: np.ndarray
    group_b: np.ndarray
    link_a: np.ndarray
    link_b: np.ndarray


def coalesce(sizes_a: np.ndarray, sizes_b: np.ndarray) -> Coalesced:
    """Interval coalescing of two rows of tokens over the same bytes, given the byte length of every token."""
    ends_a, ends_b = np.cumsum(sizes_a), np.cumsum(sizes_b)
    n, total = len(sizes_a), len(sizes_a) + len(sizes_b)
    if not total:
        none = np.empty(0, np.int64)
        return Coalesced(none, none, none, none)
    starts, ends = np.concatenate([ends_a - sizes_a, ends_b - sizes_b]), np.concatenate([ends_a, ends_b])
    order = np.lexsort((np.arange(total) >= n, starts))
    start, reach = starts[order], np.maximum.accumulate(ends[order])
    fresh = np.concatenate([[True], start[1:] >= reach[:-1]])
    group = np.cumsum(fresh) - 1
    is_a = order < n
    # the token of each side that is open at every place of the sorted row
    open_a = np.maximum.accumulate(np.where(is_a, order, -1))
    open_b = np.maximum.accumulate(np.where(is_a, -1, order - n))
    at = np.flatnonzero(np.concatenate([start[1:] != start[:-1], [True]]))
    return Coalesced(group[is_a], group[~is_a], open_a[at], open_b[at])


def write_groups(pair: Pair, ids_a: np.ndarray, ids_b: np.ndarray, found: Coalesced) -> tuple[bytes, np.ndarray]:
    """``a1,a2|b1;a3|b2;`` of all groups, and where the text of each token ends, tokens in written order."""
    n, m = len(ids_a), len(ids_b)
    groups = int(found.group_a[-1]) + 1 if n else 0
    before_a = np.concatenate([[0], np.cumsum(np.bincount(found.group_a, minlength=groups))])
    before_b = np.concatenate([[0], np.cumsum(np.bincount(found.group_b, minlength=groups))])
    codes = np.empty(n + m, np.int64)
    last_a = np.concatenate([found.group_a[1:] != found.group_a[:-1], [True]])[:n]
    last_b = np.concatenate([found.group_b[1:] != found.group_b[:-1], [True]])[:m]
    codes[np.arange(n) + before_b[found.group_a]] = ids_a * 2 + last_a
    codes[np.arange(m) + before_a[found.group_b + 1]] = (len(pair.left.tokens) + ids_b) * 2 + last_b
    flat = pair.written[codes].ravel()
    return flat[flat != 0].tobytes(), np.cumsum(pair.lengths[codes])


class Chunk:
    """The alignment of some whole texts."""

    def __init__(self, pair: Pair, texts: list[str | None], detail: bool):
        self.pair, self.detail = pair, detail
        rows = len(texts)
        self.whole = np.ones(rows, bool)
        self.n_a, self.n_b, self.n_groups, self.n_links = np.zeros((4, rows), np.int64)
        self.hashes = [hashlib.sha256() for _ in range(rows)]
        self.texts: list[list[bytes]] = [[] for _ in range(rows)]
        self.held: list[bytes] = [b""] * rows
        keys = [np.empty(0, np.int64)]
        times = [np.empty(0, np.int64)]
        waiting, size = [], 0
        for row, text in enumerate(texts):
            for part in pair.parts(text) if text else ():
                waiting.append((row, part))
                size += len(part)
                if size >= SORTED_CHARS:
                    for to, more in zip((keys, times), self._add(waiting)):
                        to.append(more)
                    waiting, size = [], 0
        for to, more in zip((keys, times), self._add(waiting)):
            to.append(more)
        self._index(np.concatenate(keys), np.concatenate(times))

    @property
    def pair_count(self) -> int:
        return len(self.pair.left.tokens) * len(self.pair.right.tokens)

    def _add(self, waiting: list[tuple[int, str]]) -> tuple[np.ndarray, np.ndarray]:
        """Aligns some parts; returns their links as row * pair_count + pair, with how often each occurs."""
        pair = self.pair
        rows, all_a, all_b = [], [], []
        # few texts at a time: what the tokenizers note of each token takes far more room than its id
        for at in range(0, len(waiting), ENCODED_AT_ONCE):
            parts = waiting[at : at + ENCODED_AT_ONCE]
            for (row, part), a, b in zip(parts, *pair.encode([part for _, part in parts])):
                if pair.covers(part, a, b):
                    rows.append(row)
                    all_a.append(np.array(a, np.int32))
                    all_b.append(np.array(b, np.int32))
                else:
                    self.whole[row] = False
        if not rows:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        rows = np.array(rows)
        many_a, many_b = np.array([len(x) for x in all_a]), np.array([len(x) for x in all_b])
        ids_a, ids_b = np.concatenate(all_a).astype(np.int64), np.concatenate(all_b).astype(np.int64)
        del all_a, all_b
        found = coalesce(pair.left.sizes[ids_a], pair.right.sizes[ids_b])
        row_a = np.repeat(rows, many_a)
        for counter, more in ((self.n_a, row_a), (self.n_b, np.repeat(rows, many_b)), (self.n_links, row_a[found.link_a])):
            counter += np.bincount(more, minlength=len(counter))
        first = np.flatnonzero(np.concatenate([[True], found.group_a[1:] != found.group_a[:-1]]))
        self.n_groups += np.bincount(row_a[first], minlength=len(self.n_groups))
        written, ends = write_groups(pair, ids_a, ids_b, found)
        ends = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(many_a + many_b)])]
        for i, row in enumerate(rows):
            # the mark behind a part's last group goes, or stands in front of the next part
            text = (b";" if self.texts[row] else b"") + written[ends[i] : ends[i + 1] - 1]
            self.hashes[row].update(text)
            self.texts[row].append(text if self.detail else b".")
        links = row_a[found.link_a] * self.pair_count + ids_a[found.link_a] * len(pair.right.tokens) + ids_b[found.link_b]
        return np.unique(links, return_counts=True)

    def _index(self, keys: np.ndarray, times: np.ndarray) -> None:
        """The dictionary of the chunk's pairs, how many documents hold each, and each document's links as places in it."""
        keys, place = np.unique(keys, return_inverse=True)
        times = np.bincount(place, times, len(keys)).astype(np.int64)
        rows = keys // self.pair_count
        kept = self.whole[rows]
        keys, times, rows = keys[kept], times[kept], rows[kept]
        self.pairs, place, self.docs = np.unique(keys % self.pair_count, return_inverse=True, return_counts=True)
        place, times = place.astype("<i4"), times.astype("<i4")
        first = np.searchsorted(rows, np.arange(len(self.whole) + 1))
        self.places = [place[x:y].tobytes() for x, y in zip(first, first[1:])]
        self.times = [times[x:y].tobytes() for x, y in zip(first, first[1:])]

    def members(self, ids: pa.Array) -> list[pa.Array]:
        counts = [pa.array(np.where(self.whole, n, 0)) for n in (self.n_a, self.n_b, self.n_groups, self.n_links)]
        shown = self.whole & (self.n_a > 0)
        digests = pa.array([h.hexdigest() if x else "" for h, x in zip(self.hashes, shown)], pa.string())
        out = [ids, *counts, digests, pa.array(self.places, pa.binary()), pa.array(self.times, pa.binary())]
        if self.detail:
            out.append(pa.array([b"".join(t).decode() if x else "" for t, x in zip(self.texts, shown)], pa.string()))
        return out


_PAIRS: dict[str, Pair] = {}


def _ship(docs: DataFrame, a_json: str, b_model: str):
    """A function that gives a task its worker process's tokenizers. The files are read on the driver."""
    a, b = Path(a_json).read_text("utf-8"), Path(b_model).read_bytes()
    key = hashlib.sha256(a.encode() + b"\0" + b).hexdigest()
    shipped = docs.sparkSession.sparkContext.broadcast((a, b))

    def pair() -> Pair:
        from threadlens.llm import token_alignment  # the worker's module, whose tokenizers outlive a task

        if key not in token_alignment._PAIRS:
            token_alignment._PAIRS.clear()
            token_alignment._PAIRS[key] = Pair(*shipped.value)
        return token_alignment._PAIRS[key]

    return pair


def align_documents(docs: DataFrame, a_json: str, b_model: str, detail: bool = False) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every row, and with ``detail`` also ``groups``.

    A (a ``tokenizers`` file with a byte-level vocabulary) encodes space + text, B (a ``sentencepiece`` model that puts
    the space itself) the text; strings of special tokens are plain text. ``groups`` is ``a1,a2|b1;a3|b2``. A pair's count
    is the number of documents that hold it linked; ``n_best`` counts links whose pair has the highest count of its A id
    (ties included), ``count_sum`` adds the counts of all links.

    Null and empty texts, and texts that a tokenizer changes (a text with U+2581, say), have no tokens: zeros and ''.
    Repeated rows are documents of their own, and equal ids do not matter. Other columns are ignored; an empty table gives
    no rows. A long text is cut where neither tokenizer can span the cut, so a task holds a few megabytes at a time;
    a run of megabytes without such a place (one space between two letters or digits) is held whole.
    """
    shipped = _ship(docs, a_json, b_model)
    fields = [docs.schema["doc_id"], *[T.StructField(n, T.LongType()) for n in ("n_a", "n_b", "n_groups", "n_links")]]
    fields += [T.StructField("groups_sha256", T.StringType()), T.StructField("places", T.BinaryType()), T.StructField("times", T.BinaryType())]
    if detail:
        fields.append(T.StructField("groups", T.StringType()))
    member = T.StructType(fields)
    longs = T.ArrayType(T.LongType())
    schema = T.StructType().add("chunk", "long").add("pairs", longs).add("docs", longs).add("members", T.ArrayType(member))

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = shipped()
        number = TaskContext.get().partitionId() << 32
        for whole in batches:
            for batch in slices(whole, size=CHUNK_BYTES):
                chunk = Chunk(pair, batch.column("text").to_pylist(), detail)
                columns = chunk.members(batch.column("doc_id"))
                members = pa.StructArray.from_arrays(columns, names=[f.name for f in fields])
                row = [pa.array([number]), *[pa.ListArray.from_arrays([0, len(x)], pa.array(x, pa.int64())) for x in (chunk.pairs, chunk.docs)]]
                row.append(pa.ListArray.from_arrays([0, len(members)], members))
                yield pa.RecordBatch.from_arrays(row, names=schema.names)
                number += 1

    table = stored(docs.select("doc_id", "text").mapInArrow(chunks, schema), "alignment")
    width = len(_vocabulary(b_model))
    held = table.select(F.col("chunk").alias("asked_by"), F.explode(F.arrays_zip("pairs", "docs")).alias("x")).select("asked_by", "x.pairs", "x.docs")
    counts = held.groupBy("pairs").agg(F.sum("docs").alias("count"))
    # an A id has at most as many partners as B has tokens
    best = F.max("count").over(Window.partitionBy(F.expr(f"pairs div {width}")))
    marked = counts.withColumn("best", F.col("count") == best)
    replies = held.select("asked_by", "pairs").join(marked, "pairs")

    names = [docs.schema["doc_id"].name, "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", *(["groups"] if detail else [])]
    kinds = {f.name: f for f in fields} | {n: T.StructField(n, T.LongType()) for n in ("n_best", "count_sum")}
    result = T.StructType([kinds[n] for n in names])

    def settle(left: pa.Table, right: pa.Table) -> pa.Table:
        order = np.argsort(right.column("pairs").to_numpy())
        count, best = right.column("count").to_numpy()[order], right.column("best").to_numpy()[order].astype(bool)
        members = left.column("members").combine_chunks()
        members = (members.chunk(0) if isinstance(members, pa.ChunkedArray) else members).flatten()
        rows = dict(zip([f.name for f in fields], members.flatten()))
        n_best, sums = [], []
        for places, times in zip(rows["places"].to_pylist(), rows["times"].to_pylist()):
            at, times = np.frombuffer(places, "<i4"), np.frombuffer(times, "<i4").astype(np.int64)
            sums.append(int((count[at] * times).sum()))
            n_best.append(int(times[best[at]].sum()))
        rows |= {"n_best": pa.array(n_best, pa.int64()), "count_sum": pa.array(sums, pa.int64())}
        return pa.table([rows[n] for n in names], names=names)

    return table.select("chunk", "members").groupBy("chunk").cogroup(replies.groupBy("asked_by")).applyInArrow(settle, result)


def _vocabulary(b_model: str) -> range:
    import sentencepiece

    return range(sentencepiece.SentencePieceProcessor(model_file=b_model).get_piece_size())
