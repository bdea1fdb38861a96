"""Counts of features within Arrow batches of comments: what a map task sums before the shuffle."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from typing import NamedTuple
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from threadlens.config import TokenRules
from threadlens.functions.text import kept_words

# Term-frequency weights are summed as integers in units of 2**-60. Integer sums do
# not depend on the order of the rows, so scores never depend on the partitioning.
# Three limbs of 20 bits keep each sum inside a BIGINT for up to 2**42 occurrences.
WEIGHT_BITS = 60
LIMB_BITS = 20
LIMB_MASK = (1 << LIMB_BITS) - 1

# Characters whose words are counted at a time, which bounds the arrays of a task, and rows that leave at a time.
SLICE_CHARS = 1 << 23
SLICE_ROWS = 1 << 17

# Groups that features are dealt to for their sums, far more than tasks; a group is summed in one step.
BUCKETS = 1 << 11
BUCKET = "_bucket"

# Columns of packed rows (see ``packed_batches``), characters whose counts are packed at a time, and bytes of tokens that are
# summed at a time; a bucket stays whole.
RUN_SIZES, CHARS, SIZES, LENGTHS = "_run_sizes", "_chars", "_sizes", "_lengths"
PACK_CHARS = 1 << 22
MERGE_BYTES = 1 << 23

# Between the tokens of a list that is one string: no token holds it.
SEPARATOR = "\n"


def count_batches(
    batches: Iterator[pa.RecordBatch],
    keys: int,
    rules: TokenRules,
    names: list[str],
    finish: Callable[[str], str] | None = None,
    slice_chars: int = SLICE_CHARS,
) -> Iterator[pa.RecordBatch]:
    """Per batch the counts of ``operators.features.feature_stats`` by the first ``keys`` columns and token.

    After the keys come ``_runs`` (see ``word_runs``), ``_blank`` and, if wanted, ``_arrival``. Without ``names`` the rows
    are the distinct (keys, token).
    """
    for batch in batches:
        for part in _slices(batch, keys, slice_chars):
            for rows in _rows(part, keys, rules, names, finish):
                for start in range(0, len(rows), SLICE_ROWS):
                    yield rows.slice(start, SLICE_ROWS)


def packed_batches(
    batches: Iterator[pa.RecordBatch],
    keys: int,
    rules: TokenRules,
    names: list[str],
    finish: Callable[[str], str] | None = None,
    slice_chars: int = PACK_CHARS,
) -> Iterator[pa.RecordBatch]:
    """The counts of ``count_batches`` as some thousand rows of bytes per slice, which Spark moves without opening them.

    After the keys comes a hash of them. A row holds what falls into one of ``BUCKETS``, dealt by keys and token, in runs of equal
    keys: keys and size of each run, the tokens one behind the other with their sizes (-1 is NULL), and their counts. Most features
    occur once in a slice: they have rows of their own, where the number of features of their comment stands for all counts.
    """
    for batch in batches:
        fields = batch.schema.names[:keys]
        for part in _slices(batch, keys + 1, slice_chars):
            grains, counted = _count(part, keys + 1, rules, names, finish, True)
            hashes = grains.pop().to_numpy().view("uint64")
            for x in counted:
                bucket = _bucket(x.mixed ^ hashes[x.grain]).astype("int64")
                once = x.counts.get("n", np.zeros(len(bucket))) == 1
                zeros = np.zeros(len(bucket), "int64")
                for some, columns in (
                    (once, {LENGTHS: x.lengths.astype("int32")} | dict.fromkeys(names)),
                    (~once, {LENGTHS: None} | {n: x.counts.get(n, zeros) for n in names}),
                ):
                    if some.any():
                        columns = {n: None if values is None else values[some] for n, values in columns.items()}
                        yield _packed(fields, grains, x.grain[some], x.token.filter(pa.array(some)), bucket[some], columns)


def _bucket(mixed: np.ndarray) -> np.ndarray:
    return (mixed * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(40)) % np.uint64(BUCKETS)


def _packed(
    fields: list[str],
    grains: list[pa.Array],
    grain: np.ndarray,
    token: pa.Array,
    bucket: np.ndarray,
    columns: dict[str, np.ndarray | None],
) -> pa.RecordBatch:
    order, run, head = _runs(bucket, grain)
    rows = np.append(run[head], len(order))
    runs = np.append(head, len(run))
    token, grain = token.take(pa.array(order)), grain[order]
    packed = {BUCKET: pa.array(bucket[order][rows[:-1]].astype("int32"))}
    for field, values in zip(fields, grains):
        packed[field] = pa.ListArray.from_arrays(pa.array(runs.astype("int32")), values.take(pa.array(grain[run])))
    packed[RUN_SIZES] = _bytes(np.diff(np.append(run, len(order))).astype("int32"), runs)
    packed |= _token_bytes(token, rows)
    for name, values in columns.items():
        packed[name] = pa.array([b""] * len(head)) if values is None else _bytes(values[order], rows)
    return pa.RecordBatch.from_pydict(packed)


def _runs(bucket: np.ndarray, grain: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order by bucket and grain, first row of each run that is equal in both, first run of each bucket)."""
    place = bucket * (int(grain.max(initial=0)) + 1) + grain
    order = _order(place)
    run = np.flatnonzero(np.diff(place[order], prepend=-1) != 0)
    return order, run, np.flatnonzero(np.diff(bucket[order][run], prepend=-1) != 0)


def _order(values: np.ndarray) -> np.ndarray:
    """Stable order of numbers from 0 on. Sorting them together with their places is some times faster than an argsort."""
    bits = len(values).bit_length()
    if int(values.max(initial=0)).bit_length() + bits > 62:
        return np.argsort(values, kind="stable")
    return np.sort(values << bits | np.arange(len(values))) & ((1 << bits) - 1)


def _bytes(values: np.ndarray, borders: np.ndarray) -> pa.Array:
    """The values between borders as they lie in memory."""
    offsets = (borders * values.itemsize).astype("int32")
    return pa.Array.from_buffers(pa.binary(), len(borders) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(values))])


def _token_bytes(token: pa.Array, borders: np.ndarray) -> dict[str, pa.Array]:
    _, offsets, chars = token.buffers()
    offsets = np.frombuffer(offsets, "int32", len(token) + 1, token.offset * 4)
    sizes = np.where(token.is_valid().to_numpy(zero_copy_only=False), np.diff(offsets), -1).astype("int32")
    chars = np.frombuffer(chars or b"", "uint8")[offsets[0] : offsets[-1]]
    return {CHARS: _bytes(chars, offsets[borders] - offsets[0]), SIZES: _bytes(sizes, borders)}


def _values(packed: pa.Table, name: str, kind: str) -> np.ndarray:
    """All values that ``_bytes`` has put into a column."""
    found = [np.empty(0, kind)]
    for chunk in packed.column(name).chunks:
        if len(chunk):
            _, offsets, data = chunk.buffers()
            offsets = np.frombuffer(offsets, "int32", len(chunk) + 1, chunk.offset * 4)
            found.append(np.frombuffer(data or b"", "uint8")[offsets[0] : offsets[-1]].view(kind))
    return np.concatenate(found)


def _tokens(packed: pa.Table) -> pa.LargeStringArray:
    sizes = _values(packed, SIZES, "int32")
    offsets = np.concatenate(([0], np.cumsum(np.maximum(sizes, 0), dtype="int64")))
    valid = np.packbits(sizes >= 0, bitorder="little")
    buffers = (pa.py_buffer(x) for x in (offsets, _values(packed, CHARS, "uint8"), valid))
    return pa.LargeStringArray.from_buffers(len(sizes), *buffers)


def merge_batches(
    batches: Iterator[pa.RecordBatch],
    keys: Sequence[str],
    names: list[str],
    lowest: int = 0,
    lowest_ngram: int = 0,
    merge_bytes: int = MERGE_BYTES,
) -> Iterator[pa.RecordBatch]:
    """The sums of packed rows by keys and token, without tokens of a ``df`` below ``lowest`` or, for more than one word,
    ``lowest_ngram``. The rows come in order of their bucket."""
    for held in _whole_buckets(batches, merge_bytes):
        rows = _merged(pa.Table.from_batches(held), keys, names, lowest, lowest_ngram)
        for start in range(0, len(rows), SLICE_ROWS):
            yield rows.slice(start, SLICE_ROWS)


def _whole_buckets(batches: Iterator[pa.RecordBatch], merge_bytes: int) -> Iterator[list[pa.RecordBatch]]:
    held, size, last = [], 0, None
    for batch in batches:
        if not len(batch):
            continue
        number = batch.column(BUCKET).to_numpy()
        before = np.concatenate(([0], np.cumsum(pc.binary_length(batch.column(CHARS)).to_numpy(), dtype="int64")))
        begin, borders = 0, np.flatnonzero(np.diff(number) != 0) + 1
        for border in ([] if number[0] == last else [0]) + borders.tolist():
            if size + before[border] - before[begin] >= merge_bytes:
                yield [*held, batch.slice(begin, border - begin)]
                held, size, begin = [], 0, border
        held.append(batch.slice(begin))
        size, last = size + before[-1] - before[begin], number[-1]
    if held:
        yield held


def _merged(packed: pa.Table, keys: Sequence[str], names: list[str], lowest: int, lowest_ngram: int) -> pa.RecordBatch:
    run_sizes = _values(packed, RUN_SIZES, "int32")
    values = [pa.concat_arrays(pc.list_flatten(packed.column(key)).chunks) for key in keys]
    grain, one = _grains(values, len(run_sizes))
    tokens = _tokens(packed).dictionary_encode(null_encoding="encode")
    code = tokens.indices.to_numpy().astype("int64") * len(one) + np.repeat(grain, run_sizes)
    order = _order(code)
    first = np.flatnonzero(np.diff(code[order], prepend=-1) != 0)

    # Rows whose counts follow from the number of features of their comment, and all others.
    of_row = [pc.binary_length(packed.column(name)).to_numpy() for name in (SIZES, LENGTHS)]
    once = np.repeat(of_row[1] > 0, of_row[0] // 4)
    unit = (1 << WEIGHT_BITS) // np.maximum(_values(packed, LENGTHS, "int32").astype("int64"), 1)
    follows = {"docs": 0, "blank": 0, "df": 1, "n": 1, **_limbs(unit)}

    def summed(name: str, order: np.ndarray, first: np.ndarray) -> np.ndarray:
        counts = np.empty(len(once), "int64")
        counts[once], counts[~once] = follows[name], _values(packed, name, "int64")
        return np.add.reduceat(counts[order], first) if len(first) else counts[:0]

    docs, df = summed("docs", order, first), summed("df", order, first)
    token = tokens.dictionary.take(pa.array(code[order][first] // len(one)))
    words = df >= lowest_ngram
    if not words.all():
        words[~words] = pc.fill_null(pc.equal(pc.count_substring(token.filter(pa.array(~words)), " "), 0), True).to_numpy(zero_copy_only=False)
    kept = (docs > 0) | ((df >= lowest) & words)
    sizes = np.diff(np.append(first, len(order)))
    order, sizes = order[np.repeat(kept, sizes)], sizes[kept]
    first = np.cumsum(sizes) - sizes
    held = pa.array(one[code[order][first] % len(one)])
    columns = {key: value.take(held) for key, value in zip(keys, values)}
    columns["token"] = token.filter(pa.array(kept)).cast(pa.string())
    return pa.RecordBatch.from_pydict(columns | {name: pa.array(summed(name, order, first)) for name in names})


def _limbs(units: np.ndarray) -> dict[str, np.ndarray]:
    return {"w0": units & LIMB_MASK, "w1": units >> LIMB_BITS & LIMB_MASK, "w2": units >> 2 * LIMB_BITS}


def listed_batches(
    batches: Iterator[pa.RecordBatch],
    keys: int,
    rules: TokenRules,
    finish: Callable[[str], str] | None = None,
    slice_chars: int = PACK_CHARS,
) -> Iterator[pa.RecordBatch]:
    """(keys, the tokens as one string), a row per slice, grain and size of n-grams; no token twice in a row."""
    for batch in batches:
        for part in _slices(batch, keys, slice_chars):
            grains, counted = _count(part, keys, rules, [], finish, False)
            for x in counted:
                order, run, _ = _runs(np.zeros(len(x.grain), "int64"), x.grain)
                borders = pa.array(np.append(run, len(order)).astype("int32"))
                held = pa.array(x.grain[order[run]])
                columns = {field: values.take(held) for field, values in zip(batch.schema.names[:keys], grains)}
                lists = pa.ListArray.from_arrays(borders, x.token.take(pa.array(order)))
                yield pa.RecordBatch.from_pydict(columns | {"tokens": pc.binary_join(lists, SEPARATOR)})


def list_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(token, lists of the batch that hold it) of lists that are strings."""
    for batch in batches:
        tokens = pc.value_counts(pc.split_pattern(batch.column(0), SEPARATOR).flatten())
        yield pa.RecordBatch.from_arrays([tokens.field(0), tokens.field(1)], ["token", "df_videos"])


def dealt_batches(
    batches: Iterator[pa.RecordBatch],
    keys: int,
    rules: TokenRules,
    finish: Callable[[str], str] | None = None,
    slice_chars: int = SLICE_CHARS,
) -> Iterator[pa.RecordBatch]:
    """One row for each of ``BUCKETS`` that the tokens of a slice fall into: lists of the keys of its grains and, beside them, of
    their tokens, those of a grain as one string. So a key is named once per bucket and not with each token."""
    for batch in batches:
        for part in _slices(batch, keys, slice_chars):
            grains, counted = _count(part, keys, rules, [], finish, True)
            if found := list(counted):
                grain = np.concatenate([x.grain for x in found])
                token = pa.concat_arrays([x.token for x in found])
                bucket = _bucket(np.concatenate([x.mixed for x in found])).astype("int64")
                order, run, head = _runs(bucket, grain)
                tokens = pa.ListArray.from_arrays(pa.array(np.append(run, len(order)).astype("int32")), token.take(pa.array(order)))
                borders, held = pa.array(np.append(head, len(run)).astype("int32")), pa.array(grain[order[run]])
                lists = {field: values.take(held) for field, values in zip(batch.schema.names[:keys], grains)}
                lists["token"] = pc.binary_join(tokens, SEPARATOR)
                numbers = pa.array(bucket[order[run[head]]].astype("int32"))
                yield pa.RecordBatch.from_pydict({BUCKET: numbers} | {n: pa.ListArray.from_arrays(borders, x) for n, x in lists.items()})


def spread(dealt: pa.Table, keys: Sequence[str]) -> pa.Table:
    """(token, number of the grains it is in) of a bucket's rows."""
    tokens = pc.split_pattern(pc.list_flatten(dealt.column("token")), SEPARATOR)
    grain, _ = _grains([pa.concat_arrays(pc.list_flatten(dealt.column(key)).chunks) for key in keys], len(tokens))
    opened = pa.table({"grain": np.repeat(grain.astype("int32"), pc.list_value_length(tokens)), "token": pc.list_flatten(tokens)})
    pairs = opened.group_by(["grain", "token"], use_threads=False).aggregate([])
    counted = pairs.group_by("token", use_threads=False).aggregate([([], "count_all")])
    return pa.table({"token": counted.column("token"), "df": counted.column("count_all")})


def _slices(batch: pa.RecordBatch, keys: int, slice_chars: int) -> Iterator[pa.RecordBatch]:
    """The batch in runs of comments of about so many characters; a single comment stays whole."""
    runs = batch.column(keys)
    # Lists of a batch lie one behind the other, so what stands before a list is the sum up to its first element.
    before = np.concatenate(([0], np.cumsum(pc.binary_length(runs.flatten()).to_numpy(zero_copy_only=False))))
    first = np.concatenate(([0], np.cumsum(runs.value_lengths().to_numpy(zero_copy_only=False))))[:-1]
    borders = [0, *(np.flatnonzero(np.diff(before[first] // slice_chars)) + 1).tolist(), len(batch)]
    return (batch.slice(a, b - a) for a, b in zip(borders, borders[1:]) if b > a)


def _grains(columns: list[pa.Array], rows: int) -> tuple[np.ndarray, np.ndarray]:
    """(number of the grain of each row, one row of each grain); NULL keys are keys."""
    grain, one = np.zeros(rows, "int64"), np.zeros(1, "int64")
    for column in columns:
        codes = column.dictionary_encode(null_encoding="encode")
        grain = grain * len(codes.dictionary) + codes.indices.to_numpy(zero_copy_only=False)
        _, one, grain = np.unique(grain, return_index=True, return_inverse=True)
    return grain, one


class Counted(NamedTuple):
    """Counts of features: rows (grain, token), and what ``operators.features.feature_stats`` names."""

    grain: np.ndarray
    token: pa.Array
    counts: dict[str, np.ndarray]
    first: tuple[pa.Array, pa.Array] | None
    mixed: np.ndarray | None  # hash of the token
    lengths: np.ndarray  # features of the first comment


def _rows(
    batch: pa.RecordBatch, keys: int, rules: TokenRules, names: list[str], finish: Callable[[str], str] | None
) -> Iterator[pa.RecordBatch]:
    grains, counted = _count(batch, keys, rules, names, finish, False)
    for x in counted:
        columns = {field: values.take(pa.array(x.grain)) for field, values in zip(batch.schema.names[:keys], grains)}
        columns["token"] = x.token
        columns |= {n: pa.array(np.broadcast_to(x.counts.get(n, 0), len(x.grain)).astype("int64")) for n in names}
        if x.first is not None:
            columns |= dict(zip(("first_arrival", "first_position"), x.first))
        yield pa.RecordBatch.from_pydict(columns)


def _count(
    batch: pa.RecordBatch,
    keys: int,
    rules: TokenRules,
    names: list[str],
    finish: Callable[[str], str] | None,
    hashed: bool,
) -> tuple[list[pa.Array], Iterator[Counted]]:
    """(keys of each grain, counts)."""
    grain, _ = _grains(batch.columns[:keys], len(batch))
    # Comments in order of grain and arrival: those of a grain are neighbours, and the first one is the one seen first.
    order = np.argsort(grain, kind="stable")
    if batch.num_columns > keys + 2:
        by_arrival = pc.sort_indices(batch.column(keys + 2), null_placement="at_end").to_numpy()
        order = by_arrival[np.argsort(grain[by_arrival], kind="stable")]
    batch = batch.take(pa.array(order))
    grain, one = _grains(batch.columns[:keys], len(batch))
    grains = [column.take(pa.array(one)) for column in batch.columns[:keys]]
    return grains, _counted(batch, keys, grain, len(one), rules, names, finish, hashed)


def _counted(
    batch: pa.RecordBatch,
    keys: int,
    grain: np.ndarray,
    grains: int,
    rules: TokenRules,
    names: list[str],
    finish: Callable[[str], str] | None,
    hashed: bool,
) -> Iterator[Counted]:
    arrival = batch.column(keys + 2) if batch.num_columns > keys + 2 else None
    row, code, words = kept_words(batch.column(keys), rules, finish)
    sizes = np.bincount(row, minlength=len(batch))
    starts = np.cumsum(sizes) - sizes
    smallest, largest = getattr(rules, "ngram_range", (1, 1))
    of_size = {n: np.maximum(sizes - (n - 1), 0) for n in range(smallest, largest + 1)}
    length = sum(of_size.values())
    unit = (1 << WEIGHT_BITS) // np.maximum(length, 1)

    # Hashes of strings, so that a token has one bucket whatever slice it is counted in.
    word_hash = np.array([crc32(word.encode()) for word in words.to_pylist()], "uint64") if hashed else None

    if names:
        blank = batch.column(keys + 1).to_numpy(zero_copy_only=False)
        totals = {"docs": np.bincount(grain), "blank": np.bincount(grain[blank], minlength=grains)}
        totals["df"] = np.bincount(grain[length > 0], minlength=grains)
        unseen = pa.nulls(grains, pa.int64())
        none = np.zeros(grains, "uint64")
        yield Counted(np.arange(grains), pa.nulls(grains, pa.string()), totals, None if arrival is None else (unseen, unseen), none, none)

    # An n-gram is the (n-1)-gram at the same place plus the word after it, as one number.
    at, gram = np.arange(len(row)), code.astype("int64")
    for n in range(1, largest + 1):
        if n > 1:
            inside = np.flatnonzero(at + (n - 1) < starts[row[at]] + sizes[row[at]])
            at = at[inside]
            gram = gram[inside] * len(words) + code[at + (n - 1)]
        if not len(at):
            return
        # Stable, so within a feature the comments stay in order: its grains are neighbours, and theirs.
        order = _order(gram)
        place = at[order]
        doc = row[place]
        new_gram = np.diff(gram[order], prepend=-1) != 0
        new = new_gram | (np.diff(grain[doc], prepend=-1) != 0)
        group = np.flatnonzero(new)
        if n >= smallest:
            head = place[group]
            token, mixed = words.take(pa.array(code[head])), None
            for k in range(1, n):
                token = pc.binary_join_element_wise(token, words.take(pa.array(code[head + k])), " ")
            counts, first = {}, None
            if names:
                size = np.diff(group, append=len(place))
                counts = {"df": np.ones(len(group), "int64"), "n": size}
                if "w2" in names:
                    counts |= _limbs(unit[doc[group]])
                # Most features occur once; only the rows of others need sums.
                many = size > 1
                held, begin = np.repeat(many, size), np.cumsum(size[many]) - size[many]
                if len(begin):
                    summed = {"df": (new | (np.diff(doc, prepend=-1) != 0)).astype("int64")[held]}
                    if "w2" in names:
                        summed |= _limbs(unit[doc[held]])
                    for name, values in summed.items():
                        counts[name][many] = np.add.reduceat(values, begin)
            if arrival is not None:
                shorter = sum((of_size[k] for k in range(smallest, n)), np.zeros(len(sizes), "int64"))
                position = head - starts[doc[group]] + shorter[doc[group]]
                seen = arrival.take(pa.array(doc[group]))
                first = seen, pc.if_else(pc.is_valid(seen), pa.array(position.astype("int64")), None)
            if hashed:
                mixed = word_hash[code[head]]
                for k in range(1, n):
                    mixed = mixed * np.uint64(0x01000193) + word_hash[code[head + k]]
            yield Counted(grain[doc[group]], token, counts, first, mixed, length[doc[group]])
        if n < largest:
            gram = np.empty(len(order), "int64")
            gram[order] = np.cumsum(new_gram) - 1
