"""From clean texts to per-grain feature counts: one scan, one shuffle.

A document is one comment, and all of its tokens sit in one row. Everything that
needs "within a document" (n-grams, document length, first occurrence of a feature)
is therefore computed on arrays inside the row. The only shuffle is the final
``groupBy(grain, token)``, whose sums Spark combines on the map side first, so a
grain or token that holds a third of all rows reaches the reducers as at most one
row per map task.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import replace

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from threadlens.config import TokenRules
from threadlens.functions.counts import (
    BUCKET,
    CHARS,
    LENGTHS,
    LIMB_BITS,
    LIMB_MASK,
    RUN_SIZES,
    SIZES,
    WEIGHT_BITS,
    count_batches,
    dealt_batches,
    listed_batches,
    merge_batches,
    packed_batches,
    spread,
)
from threadlens.functions.stem import stem, stem_word
from threadlens.functions.text import is_blank, ngram_size, word_runs, word_tokens

# Size of the filter of ``supported_stats`` (1 MB): enough for about a million frequent words of all grains.
SUPPORT_BITS = 1 << 23


def normalizer(rules: TokenRules) -> Callable[[str], str] | None:
    """What the rules make of each filtered token; None leaves tokens as they are."""
    return stem_word if rules.normalization == "stem_en" else None


def document_tokens(comments: DataFrame, rules: TokenRules, text: str = "text_clean") -> DataFrame:
    """Adds ``tokens ARRAY<STRING>``: filtered, normalised, in reading order."""
    return comments.withColumn("tokens", word_tokens(F.col(text), rules, normalizer(rules)))


def document_features(comments: DataFrame, rules: TokenRules, text: str = "text_clean") -> DataFrame:
    """Adds ``features ARRAY<STRING>``: the n-grams of the filtered tokens, short ones first."""
    smallest, largest = getattr(rules, "ngram_range", (1, 1))
    return _with_ngrams(document_tokens(comments, rules, text), smallest, largest)


def _with_ngrams(documents: DataFrame, smallest: int, largest: int) -> DataFrame:
    """Adds ``features``: the n-grams of ``tokens``. An n-gram with a NULL word is NULL."""
    out, parts, grams = documents, [], "tokens"
    for n in range(1, largest + 1):
        if n > 1:
            # An n-gram is the (n-1)-gram at the same place plus the word after it.
            count = F.greatest(F.size("tokens") - (n - 1), F.lit(0))
            longer = F.zip_with(
                F.slice(grams, F.lit(1), count),
                F.slice("tokens", F.lit(n), count),
                lambda head, word: F.concat(head, F.lit(" "), word),
            )
            grams = f"grams_{n}"
            out = out.withColumn(grams, longer)
        if n >= smallest:
            parts.append(F.col(grams))
    features = parts[0] if len(parts) == 1 else F.concat(*parts)
    return out.withColumn("features", features).drop(*[f"grams_{n}" for n in range(2, largest + 1)])


def feature_stats(
    comments: DataFrame,
    grain: Sequence[str],
    rules: TokenRules,
    text: str = "text_clean",
    arrival: str | None = None,
    weights: bool = True,
) -> DataFrame:
    """Additive counts per (grain, token), plus one row per grain with a NULL token.

    * ``docs``, ``blank`` - NULL-token row only: all rows, rows with null or blank text
    * ``df`` - documents with the token; on the NULL-token row, documents with any feature
    * ``n`` - occurrences of the token
    * ``w2, w1, w0`` - sum over documents of count/length, in limbs (with ``weights``)

    With ``arrival`` (a BIGINT that orders the comments of a grain) two more columns
    say where the token was seen first: ``first_arrival`` and ``first_position``.
    """
    keys = list(grain)
    names = ["docs", "blank", "df", "n", *(["w2", "w1", "w0"] if weights else [])]
    rows = _counted_batches(comments, keys, rules, text, names, arrival)
    sums = {name: F.sum(name) for name in names}
    if arrival:
        sums["first_arrival"] = F.min("first_arrival")
        sums["first_position"] = F.min_by("first_position", "first_arrival")
    return _summed_once(rows, keys, sums)


def frequent_stats(
    comments: DataFrame,
    grain: Sequence[str],
    rules: TokenRules,
    lowest: int,
    lowest_ngram: int,
    text: str = "text_clean",
) -> DataFrame:
    """``feature_stats`` without features in fewer than ``lowest`` documents of their grain, or ``lowest_ngram`` for more than one word.

    Counts leave a batch of comments as bytes, dealt by grain and token to buckets, and are summed in Arrow. What is left out
    is seldom seen and most of all features, and is never a row of Spark's.
    """
    keys, names = list(grain), ["docs", "blank", "df", "n", "w2", "w1", "w0"]
    rows = comments.select(
        *keys,
        (F.xxhash64(*keys) if keys else F.lit(0).cast("bigint")).alias("_hash"),
        word_runs(F.col(text), rules).alias("_runs"),
        is_blank(F.col(text)).alias("_blank"),
    )
    fields = comments.select(*keys).schema.fields
    lists = [T.StructField(field.name, T.ArrayType(field.dataType)) for field in fields]
    blobs = [T.StructField(name, T.BinaryType()) for name in (RUN_SIZES, CHARS, SIZES, LENGTHS, *names)]
    packed = T.StructType([T.StructField(BUCKET, T.IntegerType()), *lists, *blobs])
    sums = [T.StructField("token", T.StringType()), *[T.StructField(name, T.LongType()) for name in names]]

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return packed_batches(batches, len(keys), rules, names, normalizer(rules))

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return merge_batches(batches, keys, names, lowest, lowest_ngram)

    dealt = rows.mapInArrow(pack, packed).repartition(BUCKET).sortWithinPartitions(BUCKET)
    return dealt.mapInArrow(merge, T.StructType([*fields, *sums]))


def feature_spread(
    comments: DataFrame, grain: Sequence[str], rules: TokenRules, text: str = "text_clean"
) -> DataFrame:
    """(token, df): in how many grains a feature occurs. The features of a batch are lists, one row per bucket: Spark shuffles some
    thousand rows of a batch instead of millions."""
    keys = list(grain)
    rows = comments.select(*keys, word_runs(F.col(text), rules).alias("_runs"), is_blank(F.col(text)).alias("_blank"))
    fields = [*comments.select(*keys).schema.fields, T.StructField("token", T.StringType())]
    lists = [T.StructField(field.name, T.ArrayType(field.dataType)) for field in fields]

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return dealt_batches(batches, len(keys), rules, normalizer(rules))

    dealt = rows.mapInArrow(deal, T.StructType([T.StructField(BUCKET, T.IntegerType()), *lists]))
    return dealt.groupBy(BUCKET).applyInArrow(lambda bucket: spread(bucket, keys), "token STRING, df BIGINT")


def feature_lists(comments: DataFrame, grain: Sequence[str], rules: TokenRules, text: str = "text_clean") -> DataFrame:
    """(grain, ``tokens``): the features of a batch of comments as one string, some rows per grain. Also for streams."""
    keys = list(grain)
    rows = comments.select(*keys, word_runs(F.col(text), rules).alias("_runs"), is_blank(F.col(text)).alias("_blank"))
    schema = T.StructType([*comments.select(*keys).schema.fields, T.StructField("tokens", T.StringType())])

    def lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return listed_batches(batches, len(keys), rules, normalizer(rules))

    return rows.mapInArrow(lists, schema)


def _counted_batches(
    comments: DataFrame,
    keys: list[str],
    rules: TokenRules,
    text: str,
    names: list[str],
    arrival: str | None,
) -> DataFrame:
    """The counts ``names`` of ``feature_stats``, summed within each Arrow batch.

    An occurrence is a few bytes of an array there, and a string only once per batch, grain and feature.
    """
    rows = comments.select(
        *keys,
        word_runs(F.col(text), rules).alias("_runs"),
        is_blank(F.col(text)).alias("_blank"),
        *([F.col(arrival).cast("bigint").alias("_arrival")] if arrival else []),
    )
    counts = names + (["first_arrival", "first_position"] if arrival else [])
    fields = [T.StructField("token", T.StringType()), *[T.StructField(name, T.LongType()) for name in counts]]
    schema = T.StructType([*comments.select(*keys).schema.fields, *fields])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return count_batches(batches, len(keys), rules, names, normalizer(rules))

    return rows.mapInArrow(count, schema)


def supported_stats(
    comments: DataFrame,
    grain: Sequence[str],
    rules: TokenRules,
    support: int,
    text: str = "text_clean",
    support_bits: int = SUPPORT_BITS,
) -> DataFrame:
    """``feature_stats`` without n-grams that cannot be in ``support`` documents of their grain.

    Each word of an n-gram is in at least the documents that hold the n-gram. So words are counted first;
    those with the support set bits of a filter of ``support_bits`` bits (hash of grain and word), and an n-gram is
    formed only where all of its words have theirs. Lengths follow from token counts, so the weights of what is left do
    not change. The filter has the same size whatever the data; words that share a bit only let more
    n-grams through, and the counts of those are as exact as ever. Counts of words are always whole.
    """
    smallest, largest = getattr(rules, "ngram_range", (1, 1))
    if largest < 2 or support < 2:
        return feature_stats(comments, grain, rules, text)
    keys = list(grain)
    tokens = document_tokens(comments, rules, text)
    sizes = [F.greatest(F.size("tokens") - (n - 1), F.lit(0)) for n in range(smallest, largest + 1)]
    lengths = tokens.withColumn("_length", sum(sizes[1:], sizes[0]))
    words = _count_features(lengths.withColumn("features", F.col("tokens")), keys, text, None, True)

    def place(word: Column) -> Column:
        return F.xxhash64(*keys, word).bitwiseAND(F.lit(support_bits - 1))

    bits = _bitmap(token_rows(words).where(F.col("df") >= support).select(place(F.col("token")).alias("bit")), support_bits)
    def supported(word: Column) -> Column:
        held = F.get("_bits", F.shiftright(place(word), 6).cast("int"))
        return F.bit_get(held, place(word).bitwiseAND(F.lit(63)).cast("int")) == 1

    # The optimiser moves the subquery to its one use, so no row carries a copy of the filter.
    marked = lengths.withColumn("_bits", bits)
    marked = marked.withColumn("tokens", F.transform("tokens", lambda word: F.when(supported(word), word))).drop("_bits")
    longer = _with_ngrams(marked, max(smallest, 2), largest).withColumn("features", F.array_compact("features"))
    if smallest > 1:
        words = words.where(F.col("docs") > 0)
    return words.unionByName(token_rows(_count_features(longer, keys, text, None, True)))


def _bitmap(rows: DataFrame, bits: int) -> Column:
    """A scalar subquery: an array of BIGINT words in which every ``bit`` of the rows is set."""
    slot, mask = F.shiftright("bit", 6).alias("slot"), F.expr("shiftleft(1L, cast(bit & 63 AS int))").alias("mask")
    none = rows.sparkSession.range(bits // 64).select(F.col("id").alias("slot"), F.lit(0).cast("bigint").alias("mask"))
    words = rows.select(slot, mask).union(none).groupBy("slot").agg(F.bit_or("mask").alias("mask"))
    packed = F.sort_array(F.collect_list(F.struct("slot", "mask")))
    return words.agg(F.transform(packed, lambda x: x["mask"])).scalar()


def _count_features(docs: DataFrame, keys: list[str], text: str, arrival: str | None, weights: bool) -> DataFrame:
    """The counts of ``feature_stats`` over documents with ``features`` and ``_length``."""
    docs = docs.select(
        *keys,
        *([F.col(arrival).alias("_arrival")] if arrival else []),
        is_blank(F.col(text)).alias("_blank"),
        "_length",
        _sorted_with_marker("features", bool(arrival)).alias("_sorted"),
    )
    docs = docs.withColumn("_unit", F.expr(f"{1 << WEIGHT_BITS}L div greatest(_length, 1)"))
    # The array always holds the marker, so "outer" changes no row; it only keeps Spark from
    # adding a size() > 0 filter that would tokenise every text a second time.
    rows = docs.select("*", F.posexplode_outer("_sorted").alias("_pos", "_item"))
    before = F.get(F.col("_sorted"), F.col("_pos") - 1)
    token, before = (F.col("_item.token"), before["token"]) if arrival else (F.col("_item"), before)
    marker = F.col("_pos") == 0
    first = ~marker & ~before.eqNullSafe(token)
    weight = F.when(marker, F.lit(0)).otherwise(F.col("_unit")).cast("bigint")
    columns = {
        "_marker": marker,
        "_in_doc": F.when(marker, F.col("_length") > 0).otherwise(first),
        "_blank_row": marker & F.col("_blank"),
    }
    sums = {
        "docs": F.count_if("_marker"),
        "blank": F.count_if("_blank_row"),
        "df": F.count_if("_in_doc"),
        "n": F.count_if(~F.col("_marker")),
    }
    if weights:
        columns["_weight"] = weight
        sums |= {
            "w2": F.sum(F.shiftright("_weight", 2 * LIMB_BITS)),
            "w1": F.sum(F.shiftright("_weight", LIMB_BITS).bitwiseAND(F.lit(LIMB_MASK))),
            "w0": F.sum(F.col("_weight").bitwiseAND(F.lit(LIMB_MASK))),
        }
    if arrival:
        columns["_first_arrival"] = F.when(first, F.col("_arrival"))
        columns["_first_position"] = F.when(first, F.col("_item.position"))
        sums["first_arrival"] = F.min("_first_arrival")
        sums["first_position"] = F.min_by("_first_position", "_first_arrival")
    rows = rows.select(*keys, token.alias("token"), *[c.alias(n) for n, c in columns.items()])
    return _summed_once(rows, keys, sums)


def _summed_once(rows: DataFrame, keys: list[str], sums: dict[str, Column]) -> DataFrame:
    """Grouped sums that several consumers share.

    Filters on token or grain and unused sums would otherwise be pushed below the
    aggregation, differently for each consumer, and the scan would run once per
    consumer. Rows that pass through inline() stop that (see ``computed_once``): every
    consumer asks for the same shuffle and Spark reuses it.
    """
    packed = F.array(F.struct(*keys, "token", *[c.alias(n) for n, c in sums.items()]))
    grouped = rows.groupBy(*keys, "token").agg(packed.alias("_row"))
    return grouped.select(F.inline_outer("_row"))


def dealt_once(stats: DataFrame, grain: Sequence[str], **salt: Column) -> DataFrame:
    """Counts that are shuffled once more, so that all consumers read what is left of them instead of each summing them. They are
    dealt by grain and ``salt``, a column more, and stay so for a join on both."""
    row = F.array(F.struct(*[c for c in stats.columns if c not in grain]))
    dealt = stats.withColumns(salt).repartition(*grain, *salt)
    return dealt.select(*grain, *salt, F.inline_outer(row))


def _sorted_with_marker(features: str, with_position: bool) -> Column:
    """Features sorted, so equal ones are neighbours, behind a NULL that stands for the row."""
    if not with_position:
        return F.concat(F.array(F.lit(None).cast("string")), F.sort_array(features))
    placed = F.transform(
        features, lambda f, i: F.struct(f.alias("token"), i.cast("bigint").alias("position"))
    )
    none = F.lit(None).cast("struct<token:string,position:bigint>")
    return F.concat(F.array(none), F.sort_array(placed))


def roll_up(stats: DataFrame, grain: Sequence[str]) -> DataFrame:
    """The same counts at a coarser grain: every field is a sum, so no text is read again."""
    names = [c for c in ("docs", "blank", "df", "n", "w2", "w1", "w0") if c in stats.columns]
    return _summed_once(stats, list(grain), {n: F.sum(n) for n in names})


def grain_totals(stats: DataFrame, grain: Sequence[str]) -> DataFrame:
    """Per grain: all rows, blank rows, documents with at least one feature."""
    return stats.where(F.col("docs") > 0).select(
        *grain,
        F.col("docs").alias("row_count"),
        F.col("blank").alias("blank_text_count"),
        F.col("df").alias("doc_count_non_empty"),
    )


def token_rows(stats: DataFrame) -> DataFrame:
    """Only the rows of real tokens."""
    return stats.where(F.col("docs") == 0)


def term_frequency_sum() -> Column:
    """Sum of count/length over the documents, from the integer limbs."""
    high, middle, low = [
        F.col(limb).cast("double") * F.lit(2.0 ** (shift - WEIGHT_BITS))
        for limb, shift in (("w2", 2 * LIMB_BITS), ("w1", LIMB_BITS), ("w0", 0))
    ]
    return high + (middle + low)


def document_ngrams(comments: DataFrame, key: str, rules: TokenRules, text: str = "text_clean") -> DataFrame:
    """One row per feature occurrence: key, position in the feature list, feature, words."""
    features = document_features(comments, rules, text).select(key, F.posexplode_outer("features"))
    return features.where(F.col("col").isNotNull()).select(
        key,
        F.col("pos").cast("bigint").alias("position"),
        F.col("col").alias("token"),
        ngram_size(F.col("col")).cast("bigint").alias("words"),
    )


def stem_vocabulary(comments: DataFrame, rules: TokenRules, text: str = "text_clean") -> DataFrame:
    """Every distinct filtered token of the comments with its English stem."""
    plain = replace(rules, normalization="none")
    words = document_tokens(comments, plain, text).select(
        F.explode(F.array_distinct("tokens")).alias("token")
    )
    return words.distinct().select("token", stem(F.col("token")).alias("stem"))
