"""Divergence of sources by token-start pointer sort.

A task lays the texts of a slice end to end and keeps a pointer to the start of every term. Pointers are ordered by
a multikey quicksort whose character is eight bytes wide: one level orders the pointers of every still open
run by their next eight bytes, equal ones stay together as a run for the next level. In the end a run is a
term; its pointers give the occurrences in each (lang, source) group and the documents that hold it. Only
those counts leave the task.

Divergences need every term of a language against every pair of its sources. Terms are dealt to blocks of a
fixed size, a block is a matrix of terms by sources, and only its sums by pair leave the task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from threadlens.llm.scratch import stored
from threadlens.llm.words import slices

SLICE_BYTES = 8 << 20
#: Cells (terms x sources) of a block on average, and sources that a task compares with all others.
BLOCK_CELLS, SLAB = 1 << 20, 256
#: Levels after which the few terms that are still equal (hundreds of bytes) are compared whole.
LEVELS = 64

# The contract's bounds.
LEAST_DOCUMENTS = 3
SHARES = 1_000_000_000
SHOWN_TERMS = 200

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True
_WORD = np.dtype(">u8")


def _bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The lower-cased bytes of a text column and the place where each text starts (and the last one ends)."""
    texts = texts.fill_null("").cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    return _LOWER[data], offsets - offsets[0]


def term_pointers(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, length and row of every term: a longest run of letters and bytes above 127 inside one text."""
    size = len(data)
    letter = _LETTER[data]
    border = np.zeros(size + 1, bool)
    border[offsets] = True
    before = np.concatenate([[False], letter])[:size] & ~border[:size]
    after = np.concatenate([letter[1:], [False]])[:size] & ~border[1:]
    starts, ends = np.flatnonzero(letter & ~before), np.flatnonzero(letter & ~after) + 1
    return starts, ends - starts, np.searchsorted(offsets, starts, side="right") - 1


def sort_pointers(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, levels: int = LEVELS) -> tuple[np.ndarray, np.ndarray]:
    """Multikey quicksort of the pointers: their order, and the run (equal terms) of each place of the order.

    Terms hold no zero byte, so a key padded with zeros tells a term from a longer one.
    """
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    # the eight bytes that start at every place, as one big-endian number
    wide = np.lib.stride_tricks.as_strided(padded[:1].view(np.uint8), (len(data) + 1, 8), (padded.strides[0], padded.strides[0]))
    order = np.arange(len(starts))
    run = np.zeros(len(starts), np.int64)  # number of the first place of the run that holds each place
    open_places = np.arange(len(starts))  # places whose run may still differ further on
    for level in range(levels):
        if not len(open_places):
            break
        pointers = order[open_places]
        left = lengths[pointers] - 8 * level
        keys = wide[starts[pointers] + np.minimum(8 * level, lengths[pointers])].copy().view(_WORD).ravel().astype(np.uint64)
        short = np.clip(8 - left, 0, 8).astype(np.uint64) * np.uint64(8)
        keys = np.where(short >= 64, np.uint64(0), keys >> np.minimum(short, np.uint64(63)) << np.minimum(short, np.uint64(63)))
        longer = left > 8  # a term that ends here comes before those that go on
        by_key = np.lexsort((longer, keys, run[open_places]))
        order[open_places] = pointers[by_key]
        keys, old, longer = keys[by_key], run[open_places], longer[by_key]
        fresh = np.concatenate([[True], (keys[1:] != keys[:-1]) | (longer[1:] != longer[:-1]) | (old[1:] != old[:-1])])
        run[open_places] = open_places[np.maximum.accumulate(np.where(fresh, np.arange(len(keys)), 0))]
        alone = fresh & np.concatenate([fresh[1:], [True]])
        open_places = open_places[~alone & longer]
    # what is left is equal in all bytes so far: whole terms decide
    pointers, old = order[open_places], run[open_places]
    terms = [data[starts[i] : starts[i] + lengths[i]].tobytes() for i in pointers]
    ranked = sorted(range(len(terms)), key=lambda i: (old[i], terms[i]))
    order[open_places] = pointers[ranked]
    for i, (at, k) in enumerate(zip(open_places, ranked)):
        if i == 0 or (old[k], terms[k]) != (old[ranked[i - 1]], terms[ranked[i - 1]]):
            first = at
        run[at] = first
    return order, run


def count_terms(docs: DataFrame) -> DataFrame:
    """(lang, source, term, count, documents) of every term of every group, and a row with a null term per group.

    One pass over whole texts; a task sends one row per term and group of a slice, which Spark adds up before and
    after the shuffle, so a frequent term or a large source costs a few rows per task.
    """
    read = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("text", "lang", "source")])
    schema = T.StructType().add("lang", "string").add("source", "string").add("term", "string").add("count", "long").add("documents", "long")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, size=SLICE_BYTES):
                langs, sources = batch.column("lang").dictionary_encode(), batch.column("source").dictionary_encode()
                width = len(sources.dictionary)
                group = langs.indices.to_numpy().astype(np.int64) * width + sources.indices.to_numpy()
                data, offsets = _bytes(batch.column("text"))
                starts, lengths, rows = term_pointers(data, offsets)
                order, run = sort_pointers(data, starts, lengths)
                # of equal runs: occurrences and documents by group
                rows = rows[order]
                by_row = np.lexsort((rows, group[rows], run))
                rows, run = rows[by_row], run[by_row]
                groups = group[rows]
                new_group = np.concatenate([[True], (run[1:] != run[:-1]) | (groups[1:] != groups[:-1])])[: len(run)]
                new_row = new_group | np.concatenate([[True], rows[1:] != rows[:-1]])[: len(run)]
                at = np.flatnonzero(new_group)
                counts = np.diff(np.append(at, len(run)))
                documents = np.add.reduceat(new_row.astype(np.int64), at) if len(at) else np.empty(0, np.int64)
                pointers = order[run[at]]
                present = np.unique(group)
                terms = _terms(data, starts[pointers], lengths[pointers])
                owner = np.concatenate([present, groups[at]])
                columns = [langs.dictionary.take(pa.array(owner // width)), sources.dictionary.take(pa.array(owner % width))]
                columns.append(pa.concat_arrays([pa.nulls(len(present), pa.string()), terms]))
                columns += [pa.array(np.concatenate([np.zeros(len(present), np.int64), x])) for x in (counts, documents)]
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    rows = read.mapInArrow(count, schema)
    return rows.groupBy("lang", "source", "term").agg(F.sum("count").alias("count"), F.sum("documents").alias("documents"))


def _terms(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> pa.Array:
    """The terms at some pointers as a string column."""
    ends = np.cumsum(lengths)
    place = np.repeat(starts - (ends - lengths), lengths) + np.arange(ends[-1] if len(ends) else 0)
    offsets = pa.py_buffer(np.concatenate([[0], ends]).astype(np.int64))
    return pa.LargeStringArray.from_buffers(len(starts), offsets, pa.py_buffer(data[place])).cast(pa.string())


def kept_terms(docs: DataFrame, least: int = LEAST_DOCUMENTS) -> DataFrame:
    """(lang, term, count, held) of the terms that ``least`` documents of a language hold, ``held`` being an array of (source,
    count); and one row per language with a null term, whose ``held`` names all sources of its documents."""
    by_term = count_terms(docs).groupBy("lang", "term")
    summed = by_term.agg(F.sum("count").alias("count"), F.sum("documents").alias("documents"), F.collect_list(F.struct("source", "count")).alias("held"))
    return summed.where(F.col("term").isNull() | (F.col("documents") >= least)).drop("documents")


def _shares(counts: np.ndarray, totals: np.ndarray | int, terms: int) -> np.ndarray:
    """1 + floor(shares * (count + 1) / (total + terms)), exactly: counts too large for 64 bits are taken as Python's integers."""
    if counts.size and int(counts.max()) >= (1 << 63) // SHARES - 1:
        counts = counts.astype(object)
    return (1 + SHARES * (counts + 1) // (totals + terms)).astype(np.int64)


def audit_sources(docs: DataFrame, least: int = LEAST_DOCUMENTS, shown: int = SHOWN_TERMS) -> DataFrame:
    """(lang, source, part, item, value, rank): how far the sources of a language differ in their terms.

    Terms are runs of letters A-Z and a-z and of characters above U+007F, of whole texts, A-Z lower-cased. A term's share in a
    source is smoothed by one and counted in billionths; the divergence of p from q is floor((p-q)^2 / q). Part ``pair``: every
    other source of the language, by the sum over all kept terms. Part ``term``: the ``shown`` terms of a
    source that are more frequent in it than in its language. Ranks go by value, then by the bytes of the item.

    Null text, lang and source are ''. Groups without a term and languages without a kept term have pair rows (0 in the
    latter). Repeated rows are documents of their own; ids and other columns are ignored. An empty table gives no rows.
    """
    terms = stored(kept_terms(docs, least), "terms")
    words = terms.where(F.col("term").isNotNull())
    totals = words.select("lang", F.explode("held").alias("x")).groupBy("lang", "x.source").agg(F.sum("x.count").alias("total"))
    groups = terms.where(F.col("term").isNull()).select("lang", F.explode("held.source").alias("source"))
    facts = groups.join(totals, ["lang", "source"], "left").groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("source", F.coalesce("total", F.lit(0)).alias("total")))).alias("sources"))
    sizes = words.groupBy("lang").agg(F.count("*").alias("terms"))
    facts = facts.join(sizes, "lang", "left").fillna(0, ["terms"])
    # two numbers for the whole corpus, so that no term has to meet its language's facts to find its block
    size = terms.agg(F.count("term").alias("terms"), F.coalesce(F.max(F.size("held")), F.lit(0)).alias("sources")).first()
    blocks, slabs = 1 + size["terms"] * size["sources"] // BLOCK_CELLS, 1 + max(size["sources"] - 1, 0) // SLAB
    every_slab = F.explode(F.sequence(F.lit(0), F.lit(slabs - 1)))
    places = words.select("lang", F.pmod(F.xxhash64("term"), F.lit(blocks)).alias("block"), every_slab.alias("slab"), "term", "count", "held")
    asked = facts.select("lang", "sources", "terms", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))).alias("block"))
    asked = asked.select("*", every_slab.alias("slab"))
    asked = asked.select(*[F.col(c).alias(f"of_{c}") for c in asked.columns])
    keys = ["lang", "block", "slab"]
    schema = "lang string, source string, part string, item string, value long"

    nothing = pa.table([pa.array([], t) for t in [pa.string()] * 4 + [pa.int64()]], names=["lang", "source", "part", "item", "value"])

    def compare(left: pa.Table, right: pa.Table) -> pa.Table:
        facts = right.to_pylist()[0]
        if not len(left) and facts["of_block"]:
            return nothing
        names, total = [x["source"] for x in facts["of_sources"]], np.array([x["total"] for x in facts["of_sources"]], np.int64)
        number, slab = facts["of_terms"], range(facts["of_slab"] * SLAB, min(len(names), (facts["of_slab"] + 1) * SLAB))
        words, whole = left.column("term").to_pylist(), left.column("count").to_numpy()
        counts = np.zeros((len(words), len(names)), np.int64)
        held = left.column("held").combine_chunks()
        held = held.chunk(0) if isinstance(held, pa.ChunkedArray) else held
        at = {name: i for i, name in enumerate(names)}
        flat = held.flatten()
        source = np.array([at[x] for x in flat.field("source").to_pylist()], np.int64)
        counts[np.repeat(np.arange(len(words)), held.value_lengths().to_numpy()), source] = flat.field("count").to_numpy()
        p = _shares(counts, total, number) if words else counts
        q = _shares(whole, sum(total.tolist()), number) if words else whole
        rows: list[tuple] = []
        for g in slab:
            away = p[:, g : g + 1] - p
            sums = (away * away // p).sum(axis=0).tolist()
            rows += [(names[g], "pair", name, value) for s, (name, value) in enumerate(zip(names, sums)) if s != g]
            more = np.flatnonzero((counts[:, g] > 0) & (p[:, g] > q))
            away = p[more, g] - q[more]
            best = sorted(zip((-(away * away // q[more])).tolist(), [words[i] for i in more]))[:shown]
            rows += [(names[g], "term", term, -value) for value, term in best]
        source, part, item, value = zip(*rows) if rows else ((), (), (), ())
        lang = pa.array([facts["of_lang"]] * len(rows), pa.string())
        texts = [pa.array(x, pa.string()) for x in (source, part, item)]
        return pa.table([lang, *texts, pa.array(value, pa.int64())], names=["lang", "source", "part", "item", "value"])

    found = stored(places.groupBy(*keys).cogroup(asked.groupBy(*[f"of_{k}" for k in keys])).applyInArrow(compare, schema), "divergences")
    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    pairs = found.where("part = 'pair'").groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"))
    pairs = pairs.withColumn("rank", F.row_number().over(order))
    best = found.where("part = 'term'").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= shown)
    return pairs.unionByName(best).select("lang", "source", "part", "item", "value", "rank")
