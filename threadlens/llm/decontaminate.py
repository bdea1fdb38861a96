"""Benchmark decontamination as a prefix-filtered set join, in DataFrame functions only.

Every benchmark item gives windows of 13 words (one shorter window if the item is shorter). A document contains
a window only if it has all of its words, so the necessary prefix of a window is its single rarest
word. Rarity is counted over all documents, for the words of the benchmark. The join of document words with these
prefix words is the only candidate search; the place of the rare word fixes where the window would begin
(positional bound), it must fit in the document (length bound), and then its words are compared one by one.
Texts are never shuffled: what is joined and grouped are places of hits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Windows of up to so many bytes in all are sent to every executor; larger benchmarks are joined by shuffling.
BROADCAST_BYTES = 32 << 20
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW = 13


def words_of(text: str) -> Column:
    """Words of a text: A-Z lower-cased, then split at every other ASCII character. Null has none."""
    value = F.coalesce(F.col(text), F.lit(""))
    ascii_only = F.length(value) == F.octet_length(value)
    low = F.when(ascii_only, F.lower(value)).otherwise(F.translate(value, UPPER, UPPER.lower()))
    return F.array_remove(F.split(low, NOT_WORD), "")


def item_windows(benchmark: DataFrame, n: int = WINDOW) -> DataFrame:
    """(item, window): the distinct windows of each distinct item text; items without words have none.

    ``item`` is the id as text.
    """
    items = benchmark.select(F.col("item_id").cast("string").alias("item"), words_of("text").alias("w")).where(F.size("w") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - F.lit(n - 1), F.lit(1)))
    return items.select("item", F.explode(F.transform(starts, lambda i: F.slice("w", i, n))).alias("window")).distinct()


def is_small(windows: DataFrame) -> bool:
    """Whether the windows fit the bound for broadcasts; reads the benchmark only."""
    size = windows.agg(F.sum(F.octet_length(F.array_join("window", " ")) + F.octet_length("item") + 64)).first()[0]
    return (size or 0) <= BROADCAST_BYTES


def listed_words(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("h"), words_of("text").alias("w"))


def rarity(docs: DataFrame, windows: DataFrame, small: bool) -> DataFrame:
    """(word, df): in how many places of all documents each word of the benchmark stands.

    The benchmark's vocabulary is joined before counting, so only its words are counted, with
    partial sums in each task.
    """
    vocabulary = windows.select(F.explode("window").alias("word")).distinct()
    words = listed_words(docs).select(F.explode("w").alias("word"))
    found = words.join(F.broadcast(vocabulary) if small else vocabulary.hint("merge"), "word", "left_semi")
    counts = found.groupBy("word").agg(F.count("*").alias("df"))
    return vocabulary.join(counts, "word", "left").select("word", F.coalesce("df", F.lit(0)).alias("df"))


def prefixes(windows: DataFrame, ranks: DataFrame) -> DataFrame:
    """(word, at, window, items): each distinct window under its rarest word (ties: the lesser word, then
    the first place), which stands ``at`` words after its start."""
    one = windows.groupBy("window").agg(F.sort_array(F.collect_set("item")).alias("items"))
    placed = one.select("window", "items", F.posexplode("window").alias("at", "word")).join(ranks, "word")
    least = placed.groupBy("window").agg(F.min(F.struct("df", "word", "at")).alias("x"), F.first("items").alias("items"))
    return least.select(F.col("x.word").alias("word"), F.col("x.at").alias("at"), "window", "items")


def hits(docs: DataFrame, keyed: DataFrame, small: bool) -> DataFrame:
    """(doc_id, h, begin, n, items): every occurrence of every window.

    Small benchmarks are looked up beside the document's own word list. Otherwise the words are shuffled
    without it, and the candidates that remain are joined to the lists again.
    """
    begin = F.col("place") - F.col("at")
    fits = (begin >= 0) & (begin + F.size("window") <= F.size("w"))
    same = F.when(fits, F.slice("w", begin + 1, F.size("window")) == F.col("window")).otherwise(False)
    listed = listed_words(docs)
    if small:
        candidates = listed.select("doc_id", "h", "w", F.posexplode("w").alias("place", "word")).join(F.broadcast(keyed), "word")
    else:
        placed = listed.select("doc_id", "h", F.posexplode("w").alias("place", "word")).join(keyed.hint("merge"), "word").distinct()
        match = F.col("p.doc_id").eqNullSafe(F.col("l.doc_id")) & (F.col("p.h") == F.col("l.h"))
        texts = listed.dropDuplicates(["doc_id", "h"])
        candidates = placed.alias("p").join(texts.alias("l").hint("merge"), match).select("p.*", "l.w")
    return candidates.where(same).select("doc_id", "h", begin.alias("begin"), F.size("window").alias("n"), "items")


def find_contamination(docs: DataFrame, benchmark: DataFrame, n: int = WINDOW) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated, items): one row per row of ``docs(doc_id, text)``.

    ``n_hit`` counts the document's words inside any occurrence of a window of ``benchmark(item_id, text)``,
    ``items`` lists the items whose windows occur, sorted as strings. A document is contaminated if at least a twentieth of its words is hit.
    Null and empty texts have no words; an empty benchmark contaminates nothing; repeated documents
    get equal rows, repeated items count once; other columns are ignored.
    """
    windows = item_windows(benchmark, n)
    small = is_small(windows)
    found = hits(docs, prefixes(windows, rarity(docs, windows, small)), small)
    merged = F.aggregate(
        F.sort_array(F.collect_set(F.struct("begin", (F.col("begin") + F.col("n")).alias("end")))),
        F.struct(F.lit(0).alias("reach"), F.lit(0).alias("total")),
        lambda s, x: F.struct(
            F.greatest(s["reach"], x["end"]).alias("reach"),
            (s["total"] + F.greatest(x["end"] - F.greatest(s["reach"], x["begin"]), F.lit(0))).alias("total")),
        lambda s: s["total"])
    per_doc = found.groupBy("doc_id", "h").agg(
        merged.cast("long").alias("n_hit"), F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items")
    )
    rows = docs.select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("h"), F.size(words_of("text")).cast("long").alias("n_words"))
    same = F.col("r.doc_id").eqNullSafe(F.col("f.doc_id")) & (F.col("r.h") == F.col("f.h"))
    joined = rows.alias("r").join(per_doc.alias("f"), same, "left")
    out = joined.select(
        F.col("r.doc_id").alias("doc_id"), F.col("r.h").alias("h"), "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"))
    return out.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        ((F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"), F.array_join("items", ",").alias("items"), "h")
