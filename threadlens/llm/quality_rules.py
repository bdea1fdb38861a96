"""Quality rules as a ledger of failure bits.

Every rule is evaluated once per document: its measurement and one bit of ``failures``. Policies are
versioned masks over those bits, so changing a policy, comparing two or leaving a rule out
never reads a text again: they are bitwise operations over the ledger.
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

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SYMBOL = re.compile(r"[#*$%&|<>]")
LETTERS = re.compile(r"[^\W\d_]+")

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper_words", "n_same_words", "n_letters")


@dataclass(frozen=True)
class Rule:
    """``bit`` of the ledger is set where ``fails`` (SQL over the measurements) holds."""

    bit: int
    name: str
    fails: str


#: Bits are never reused; a changed threshold is a new rule with a new bit.
RULES = (
    Rule(0, "few_words", "n_words < 50"),
    Rule(1, "repeated_windows", "100 * n_repeat_words > 50 * n_words"),
    Rule(2, "symbols", "10 * n_symbols > n_words"),
    Rule(3, "capitals", "2 * n_upper_words > n_words"),
    Rule(4, "same_word_runs", "10 * n_same_words > n_words"),
    Rule(5, "duplicate_lines", "2 * n_dup_lines > n_lines"),
    Rule(6, "word_length", "word_chars < 2 * n_words or word_chars > 15 * n_words"),
    Rule(7, "letters", "2 * n_letters < word_chars"),
)


@dataclass(frozen=True)
class Policy:
    version: str
    rules: tuple[str, ...]

    def mask(self, rules: Sequence[Rule] = RULES) -> int:
        bits = {r.name: r.bit for r in rules}
        return sum(1 << bits[name] for name in set(self.rules))


BASE = Policy("base", ("few_words", "repeated_windows"))
STRICT = Policy("v1", tuple(r.name for r in RULES))


def measure(text: str | None) -> tuple[int, ...]:
    """The measurements of one text, in the order of MEASURES; a null text counts as empty."""
    text = text or ""
    words = WORD.findall(text)
    n = len(words)
    marked, last = bytearray(n), {}
    for i, window in enumerate(zip(words, words[1:], words[2:])):
        if window in last:
            j = last[window]
            marked[i] = marked[i + 1] = marked[i + 2] = 1
            marked[j] = marked[j + 1] = marked[j + 2] = 1
        last[window] = i
    seen: set[str] = set()
    lines = duplicates = 0
    for line in text.split("\n"):
        if WORD.search(line):
            lines += 1
            duplicates += line in seen
            seen.add(line)
    upper = sum(1 for w in words if len(w) > 1 and w.isupper())
    same = sum(1 for a, b in zip(words, words[1:]) if a == b)
    letters = sum(map(len, LETTERS.findall(text)))
    return n, sum(map(len, words)), len(SYMBOL.findall(text)), duplicates, sum(marked), lines, upper, same, letters


def rule_ledger(docs: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """(doc_id, measurements, failures): one row per row of ``docs(doc_id, text)``, without a shuffle.

    Null texts measure as empty texts; repeated rows get a row each; other columns are ignored.
    """
    schema = T.StructType([docs.schema["doc_id"]])
    for name in MEASURES:
        schema = schema.add(name, "long")

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole):
                rows = [measure(x) for x in batch.column("text").to_pylist()]
                columns = [pa.array(c, pa.int64()) for c in zip(*rows)]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], names=["doc_id", *MEASURES])

    ledger = docs.select("doc_id", "text").mapInArrow(measured, schema)
    return ledger.withColumn("failures", failure_bits(rules))


def failure_bits(rules: Sequence[Rule]) -> Column:
    failures = F.lit(0).cast("long")
    for r in rules:
        failures = failures.bitwiseOR(F.when(F.expr(r.fails), F.lit(1 << r.bit)).otherwise(F.lit(0)).cast("long"))
    return failures


def fails(policy: Policy, rules: Sequence[Rule] = RULES) -> Column:
    return F.col("failures").bitwiseAND(F.lit(policy.mask(rules)).cast("long")) != 0


def ablations(ledger: DataFrame, policy: Policy, rules: Sequence[Rule] = RULES) -> DataFrame:
    """(version, rule, n_failed, n_only, n_kept_without): what each rule of a policy does, from the bits alone.

    ``n_only`` counts documents that no other rule of the policy rejects. An empty ledger gives zeros.
    The ledger is first reduced to one row per bit pattern, of which there are at most 2^rules.
    """
    mask = policy.mask(rules)
    patterns = ledger.groupBy(F.col("failures").bitwiseAND(F.lit(mask).cast("long")).alias("bits")).agg(F.count("*").alias("n"))
    table = F.explode(F.array(*[F.struct(F.lit(r.name).alias("rule"), F.lit(1 << r.bit).cast("long").alias("bit")) for r in rules if r.name in policy.rules]))
    hit = patterns.select("n", "bits", table.alias("r")).groupBy("r.rule").agg(
        F.sum(F.when(F.col("bits").bitwiseAND(F.col("r.bit")) != 0, F.col("n")).otherwise(0)).alias("n_failed"),
        F.sum(F.when(F.col("bits") == F.col("r.bit"), F.col("n")).otherwise(0)).alias("n_only"),
        F.sum(F.when(F.col("bits").bitwiseAND(F.bitwise_not(F.col("r.bit"))) == 0, F.col("n")).otherwise(0)).alias("n_kept_without"),
    )
    return hit.select(F.lit(policy.version).alias("version"), "rule", "n_failed", "n_only", "n_kept_without")


def judge_quality(docs: DataFrame, policy: Policy = STRICT, rules: Sequence[Rule] = RULES) -> DataFrame:
    """The ledger with ``base_failed`` and ``kept`` (neither the base nor ``policy`` rejects the document)."""
    ledger = rule_ledger(docs, rules)
    return ledger.withColumn("base_failed", fails(BASE, rules)).withColumn("kept", ~(fails(BASE, rules) | fails(policy, rules)))


def keep_documents(docs: DataFrame, policy: Policy = STRICT, rules: Sequence[Rule] = RULES) -> DataFrame:
    """The rows of ``docs`` that neither the base nor ``policy`` rejects, with all their columns and no shuffle.

    The measurements travel beside the row, so a text is read once and judged by the same bits.
    """
    names = [f"c{i}" for i in range(len(docs.columns))]
    at = docs.columns.index("text")
    schema = T.StructType([T.StructField(n, f.dataType) for n, f in zip(names, docs.schema)])
    for name in MEASURES:
        schema = schema.add(name, "long")

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, at):
                columns = [pa.array(c, pa.int64()) for c in zip(*map(measure, batch.column(at).to_pylist()))]
                yield pa.RecordBatch.from_arrays([*batch.columns, *columns], names=schema.names)

    ledger = docs.toDF(*names).mapInArrow(measured, schema).withColumn("failures", failure_bits(rules))
    return ledger.where(~(fails(BASE, rules) | fails(policy, rules))).select(*names).toDF(*docs.columns)
