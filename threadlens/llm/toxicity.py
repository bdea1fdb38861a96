"""Toxicity by gradient-boosted trees over a few dense features, with isotonic calibration.

Which words and word beginnings are toxic is learned from the labels: Spark counts, over the training rows, in how many toxic
and clean texts each occurs, and the strongest form a lexicon of fixed size. A document becomes densities of
lexicon words and beginnings, their nearness to words of the second person, and rates of capitals, punctuation
and obfuscated spelling. Trees are fitted on part of the training rows, the calibration on the rest.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import IsotonicRegression
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from threadlens.llm.scratch import stored
from threadlens.llm.words import slices

#: Labelled documents that trees and calibration are fitted on at most; fewer are all used. The lexicon counts all.
MAX_ROWS = 20_000
#: Training labels are broadcast to the texts up to so many; beyond, labels and texts are shuffled.
BROADCAST_ROWS = 1_000_000
#: Terms of the lexicon, the strongest of those that pass its conditions.
LEXICON = 5_000
BEGINNINGS = (4, 5, 6)
WORD = re.compile(r"[^\W\d_]+(?:[*@$0-9!._-]+[^\W\d_]+)*")
FILLER = re.compile(r"[*._-]")
PLAIN = re.compile(r"[\x00-\x7f]+")
CAPITALS = bytes(c for c in range(128) if chr(c).isupper())
NO_SIGNS = bytes(c for c in range(128) if chr(c).isalnum() or chr(c).isspace())
#: Distinct words that a task remembers at a time.
KNOWN_WORDS = 500_000
LEET = str.maketrans("@$0134567!", "asoleasgti")
#: Words of the second person in the languages of the corpus.
SECOND = frozenset("you your yours u ur du dich dir dein deine ihr euch sie tu te toi ton ta tes vous votre vos tú ti tus usted ustedes vosotros".split())
FEATURES = (
    "word_density", "word_hits", "word_weight", "begin_density", "begin_hits", "begin_weight",
    "second_density", "second_near", "capitals", "punctuation", "exclaims", "obfuscated", "word_peak", "begin_peak",
)


def tokens(text: str) -> list[str]:
    """Lower-cased words; signs and digits inside a word are read as the letters they stand for."""
    return [w if w.isalpha() else FILLER.sub("", w.translate(LEET)) for w in WORD.findall(text.lower())]


def lexicon(labelled: DataFrame, terms: int = LEXICON) -> dict[str, float]:
    """Weight (log odds times the root of its toxic texts) of the ``terms`` strongest toxic words, and word beginnings marked by ``^``.

    Counts are of texts, over all rows of ``labelled(text, toxic)``; tasks add up their own first.
    """
    schema = T.StructType().add("term", "string").add("bad", "long").add("good", "long")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole):
                sums = Counter(), Counter()
                for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
                    words = set(tokens(text or ""))
                    sums[toxic].update(words)
                    sums[toxic].update({"^" + w[:n] for w in words for n in BEGINNINGS if len(w) >= n})
                found = list(sums[0].keys() | sums[1].keys())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(found, pa.string()), pa.array([sums[1][t] for t in found], pa.int64()), pa.array([sums[0][t] for t in found], pa.int64())],
                    names=schema.names)

    totals = labelled.agg(F.sum("toxic").alias("bad"), F.sum(1 - F.col("toxic")).alias("good")).first()
    bad, good = totals["bad"] or 0, totals["good"] or 0
    if not bad:
        return {}
    counts = labelled.select("text", "toxic").mapInArrow(count, schema).groupBy("term").agg(F.sum("bad").alias("b"), F.sum("good").alias("g"))
    odds = F.log((F.col("b") + 0.1) / (bad + 0.2)) - F.log((F.col("g") + 0.5) / (good + 1.0))
    strong = counts.where("b >= 2").withColumn("w", odds).where("w > 1.5")
    # evidence: strength times the root of support, so that chance words of two or three texts weigh little
    top = strong.withColumn("e", F.col("w") * F.sqrt("b")).orderBy(F.desc("e"), "term").limit(terms).collect()
    return {r["term"]: r["e"] for r in top}


class Known(dict):
    """What a task knows of a found word: None, or (weight, weight of its beginning, second person, obfuscated)."""

    def __init__(self, weights: dict[str, float]):
        super().__init__()
        self.weights = weights

    def __missing__(self, found: str) -> tuple[float, float, bool, bool] | None:
        plain = found.isalpha()
        word = found if plain else FILLER.sub("", found.translate(LEET))
        own = self.weights.get(word, 0.0)
        begin = max((self.weights.get("^" + word[:k], 0.0) for k in BEGINNINGS if len(word) >= k), default=0.0)
        second = word in SECOND
        value = (own, begin, second, not plain) if own > 0 or begin > 0 or second or not plain else None
        if len(self) >= KNOWN_WORDS:
            self.clear()
        self[found] = value
        return value


def measure(text: str | None, known: Known) -> list[float]:
    """FEATURES of one text. Plain characters are counted by byte tables, others one by one."""
    text = text or ""
    found = WORD.findall(text.lower())
    n = max(1, len(found))
    told = [(i, x) for i, x in enumerate(map(known.__getitem__, found)) if x is not None]
    second = [i for i, x in told if x[2]]
    hits = [i for i, x in told if x[0] > 0 or x[1] > 0]
    near = 0
    if second and hits:
        at = np.searchsorted(second, hits)
        places = np.array([-(10**9), *second, 10**9])
        near = int((np.minimum(np.array(hits) - places[at], places[at + 1] - np.array(hits)) <= 3).sum())
    plain, rest = text.encode("ascii", "ignore"), PLAIN.sub("", text)
    capitals = len(plain) - len(plain.translate(None, CAPITALS)) + sum(map(str.isupper, rest))
    signs = len(plain.translate(None, NO_SIGNS)) + sum(not c.isalnum() and not c.isspace() for c in rest)
    size = max(1, len(text))
    own, begin = [x[0] for _, x in told if x[0] > 0], [x[1] for _, x in told if x[1] > 0]
    return [
        len(own) / n, float(len(own)), sum(own), len(begin) / n, float(len(begin)), sum(begin),
        len(second) / n, near / n, capitals / size, signs / size, text.count("!") / n, sum(x[3] for _, x in told) / n,
        max(own, default=0.0), max(begin, default=0.0),
    ]


def featured(docs: DataFrame, weights: dict[str, float]) -> DataFrame:
    """All columns of ``docs`` but ``text``, and FEATURES as doubles."""
    rest = [c for c in docs.columns if c != "text"]
    schema = T.StructType([docs.schema[c] for c in rest])
    for name in FEATURES:
        schema = schema.add(name, "double")
    shipped = docs.sparkSession.sparkContext.broadcast(weights)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Known(shipped.value)
        for whole in batches:
            for batch in slices(whole):
                rows = np.array([measure(x, known) for x in batch.column("text").to_pylist()])
                yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in rest], *[pa.array(rows[:, i]) for i in range(len(FEATURES))]], names=schema.names)

    return docs.select(*rest, "text").mapInArrow(read, schema)


def centred(bounds: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Centred isotonic curve: each flat stretch holds its value in its middle and is linear between middles, so scores keep their order."""
    if not len(bounds):
        return bounds, values
    level, block = np.unique(values, return_inverse=True)
    middle = np.bincount(block, weights=bounds) / np.bincount(block)
    return np.concatenate([bounds[:1], middle, bounds[-1:]]), np.concatenate([level[:1], level, level[-1:]])


def score_toxicity(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row of ``docs(doc_id, text)``.

    Labels are learned from rows of ``labels(doc_id, toxic)`` with crc32(doc_id) % 5 != 0 only. Null texts score as
    empty ones; labels other than 0 and 1 are ignored and a document labelled both ways counts as toxic; without toxic or
    without clean training rows every score is 0. Repeated rows get equal scores; other columns are ignored.
    The score is the value of the centred isotonic curve.
    """
    held = F.crc32(F.col("doc_id").cast("string")) % 5
    marks = labels.where("toxic in (0, 1) and doc_id is not null").groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    rows = docs.select("doc_id", "text")
    own = marks.where(held != 0)
    train = rows.join(F.broadcast(own) if own.count() <= BROADCAST_ROWS else own, "doc_id")
    weights = lexicon(train)
    # at most max_rows ids that have a document, chosen by hash and broadcast: trees and calibration see only these
    chosen = train.select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)
    sample = stored(featured(train.join(F.broadcast(chosen), "doc_id"), weights), "features")
    kinds = sample.select("toxic").distinct().count()
    known = F.coalesce((held == 0), F.lit(False)).alias("held_out")
    if kinds < 2:
        return rows.select("doc_id", known, F.lit(0.0).alias("score"), F.lit(0).alias("predicted"))
    assembled = VectorAssembler(inputCols=list(FEATURES), outputCol="features")
    fold = F.pmod(F.xxhash64("doc_id", F.lit(12)), F.lit(4))
    fitted = assembled.transform(sample.where(fold != 0).select(F.col("toxic").cast("double").alias("label"), *FEATURES)).select("label", "features").coalesce(2).persist()
    model = GBTClassifier(maxIter=15, maxDepth=3, seed=1, cacheNodeIds=False).fit(fitted)
    fitted.unpersist()
    raw = lambda frame: model.transform(assembled.transform(frame)).withColumn("p", vector_to_array("probability")[1])
    checked = raw(sample.where(fold == 0)).select(F.col("toxic").cast("double").alias("label"), F.col("p").alias("x"))
    # one weighted row per value of the trees: clean texts share a few
    steps = checked.groupBy("x").agg(F.avg("label").alias("label"), F.count("*").cast("double").alias("weight"))
    curve = IsotonicRegression(featuresCol="x", labelCol="label", weightCol="weight").fit(steps)
    bounds, values = centred(curve.boundaries.toArray(), curve.predictions.toArray())

    def calibrate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p = batch.column("p").to_numpy()
            score = np.interp(p, bounds, values) if len(bounds) else p
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(score), pa.array((score >= 0.5).astype(np.int32))], names=["doc_id", "held_out", "score", "predicted"])

    scored = raw(featured(rows, weights)).select("doc_id", known, "p")
    schema = T.StructType([docs.schema["doc_id"]]).add("held_out", "boolean").add("score", "double").add("predicted", "integer")
    return scored.mapInArrow(calibrate, schema)
