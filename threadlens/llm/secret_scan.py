"""Secret scanning with a ledger of content-addressed blobs.

Every version of every path is named by the SHA-256 of its text. The ledger holds, for each pair of blob
and rule version, the spans found. A scan reads only blobs that the ledger lacks for the current
rule version, each once however many paths and versions share it; findings are joined back to all paths.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from threadlens.llm.words import slices

#: Paths of one blob are spread over so many parts of the join.
SALTS = 16


def _either(word: str) -> str:
    """A pattern for ``word`` with A-Z in either case and nothing beyond ASCII."""
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


_NAMES = "|".join(_either(w) for w in ("password", "passwd", "secret", "token")) + "|" + _either("api") + "_?" + _either("key")


@dataclass(frozen=True)
class Rule:
    """Matches of ``pattern`` count if ``group`` has ``at_least`` characters; others are dropped."""

    kind: str
    pattern: str
    group: int = 0
    at_least: int = 1
    base: bool = True


RULES = (
    Rule("assign", rf"""({_NAMES})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", r"[0-9a-f]+", 0, 24),
    Rule("pem", r"-----BEGIN\x20[A-Z\x20]*PRIVATE\x20KEY-----", base=False),
    Rule("webtoken", r"eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 0, 40, base=False),
)
RULES_VERSION = "1"


def blobs(versions: DataFrame, path: str = "path") -> DataFrame:
    """(path, blob, text): a null text is the empty blob."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return versions.select(F.col(path).alias("path"), F.sha2(text, 256).alias("blob"), text.alias("text"))


def unseen(named: DataFrame, ledger: DataFrame | None, version: str) -> DataFrame:
    """(blob, path): of each blob without a ledger row of this rule version, the least path that holds it."""
    one = named.groupBy("blob").agg(F.min("path").alias("path"))
    if ledger is None:
        return one
    known = ledger.where(F.col("rules") == version).select("blob").distinct()
    return one.join(known, "blob", "left_anti")


def spans_of(text: str, compiled: Sequence[tuple[int, Rule, re.Pattern]]) -> list[tuple[int, int, str, int]]:
    found = []
    for number, rule, pattern in compiled:
        for m in pattern.finditer(text):
            if m.end(rule.group) - m.start(rule.group) >= rule.at_least:
                found.append((m.start(), number, rule.kind, m.end()))
    return sorted(found)


def scan(versions: DataFrame, ledger: DataFrame | None = None, rules: Sequence[Rule] = RULES, version: str = RULES_VERSION, path: str = "path") -> DataFrame:
    """New ledger rows (blob, rules, spans) for ``versions(path, text)``; append them to the ledger.

    ``spans`` is ``kind:start:end`` in order of start, then rule, joined by commas (code points, end
    exclusive), empty where nothing was found. A blob held by repeated rows may be read more than once
    but gives one row. Null texts are scanned as empty. No versions give no rows.
    """
    named = blobs(versions, path)
    wanted = unseen(named, ledger, version)
    same = (F.col("v.blob") == F.col("w.blob")) & F.col("v.path").eqNullSafe(F.col("w.path"))
    texts = named.alias("v").join(wanted.alias("w").hint("shuffle_hash"), same).select("v.blob", "v.text")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compiled = [(i, r, re.compile(r.pattern)) for i, r in enumerate(rules)]
        for whole in batches:
            for batch in slices(whole):
                spans = [",".join(f"{kind}:{a}:{b}" for a, _, kind, b in spans_of(x, compiled)) for x in batch.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays([batch.column("blob"), pa.array(spans, pa.string())], names=["blob", "spans"])

    found = texts.mapInArrow(read, T.StructType().add("blob", "string").add("spans", "string"))
    return found.groupBy("blob").agg(F.max("spans").alias("spans")).select("blob", F.lit(version).alias("rules"), "spans")


def findings(versions: DataFrame, ledger: DataFrame, version: str = RULES_VERSION, path: str = "path") -> DataFrame:
    """(path, blob, spans) for every row of ``versions``: its blob's spans in the ledger, else an empty string.

    Blobs without findings stay out of the join; those with some are copied SALTS times, so that the
    paths of a blob that a third of all rows hold do not meet in one task.
    """
    paths = blobs(versions, path).select("path", "blob").withColumn("salt", F.pmod(F.xxhash64("path"), F.lit(SALTS)))
    hits = ledger.where((F.col("rules") == version) & (F.col("spans") != "")).select("blob", "spans")
    hits = hits.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))).alias("salt"))
    return paths.join(hits, ["blob", "salt"], "left").select("path", "blob", F.coalesce("spans", F.lit("")).alias("spans"))


def digest(found: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """Counts of the base kinds, the hash of the base spans, and all spans, as columns beside path and blob."""
    each = F.when(F.col("spans") == "", F.array().cast("array<string>")).otherwise(F.split("spans", ","))
    base = [r.kind for r in rules if r.base]

    def of_kinds(wanted: list[str]) -> Column:
        return F.filter(each, lambda x: F.split(x, ":")[0].isin(wanted))

    counts = [F.size(of_kinds([k])).cast("long").alias(f"n_{k}") for k in base]
    kept = F.array_join(of_kinds(base), ",")
    return found.select("path", "blob", *counts, F.sha2(kept, 256).alias("base_sha256"), "spans")


def redact(docs: DataFrame, ledger: DataFrame, version: str = RULES_VERSION, mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with every span that the ledger has of its text (overlapping spans merged) replaced by ``mark``.

    Texts without spans stay as they are, nulls too. All columns are kept.
    """
    names = [f"c{i}" for i in range(len(docs.columns))]
    at = docs.columns.index("text")
    plain = docs.toDF(*names).select(
        *names, F.sha2(F.coalesce(names[at], F.lit("")), 256).alias("blob"), F.pmod(F.xxhash64(*names), F.lit(SALTS)).alias("salt"))
    hits = ledger.where((F.col("rules") == version) & (F.col("spans") != "")).select("blob", "spans")
    hits = hits.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))).alias("salt"))
    found = plain.join(hits, ["blob", "salt"], "left").select(*names, "spans")

    def cover(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for text, spans in zip(batch.column(at).to_pylist(), batch.column("spans").to_pylist()):
                if text is not None and spans:
                    merged: list[list[int]] = []
                    for a, b in sorted((int(a), int(b)) for _, a, b in (s.split(":") for s in spans.split(","))):
                        if merged and a <= merged[-1][1]:
                            merged[-1][1] = max(merged[-1][1], b)
                        else:
                            merged.append([a, b])
                    for a, b in reversed(merged):
                        text = text[:a] + mark + text[b:]
                texts.append(text)
            arrays = [pa.array(texts, pa.string()) if c == at else batch.column(c) for c in range(len(names))]
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    covered = found.mapInArrow(cover, T.StructType([T.StructField(n, f.dataType) for n, f in zip(names, docs.schema)]))
    return covered.toDF(*docs.columns)
