"""The corpus pipeline: documents through quality rules, near-duplicate removal, decontamination, secret
redaction and tokenisation. Each stage is written as Parquet in the shared folder and read by the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadlens.llm import byte_bpe, decontaminate, jaccard_join, quality_rules, secret_scan
from threadlens.llm.queries import tokenizer
from threadlens.llm.scratch import stored
from threadlens.session import ship_package


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects, judged in the same pass that reads them."""
    ship_package(spark)
    return quality_rules.keep_documents(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each linked group: of the rows that name the component the one of least hashes, and once if it repeats.

    Texts without words are groups of their own. Of rows that are equal in id and text the least by a hash of all columns stays.
    """
    ship_package(spark)
    joined = jaccard_join.join_classes(docs).where(F.col("doc_id").eqNullSafe(F.col("component_id")))
    empty = F.col("component").isNull()
    own = [F.when(empty, F.col(c)).alias(f"own_{c}") for c in "kh"]
    lead = joined.groupBy("component", *own).agg(F.min(F.struct("k", "h")).alias("x")).select(F.col("x.k").alias("__k"), F.col("x.h").alias("__h"))
    # equal rows become one in their own task first, so none of their copies meet at the join
    keys = [F.xxhash64("doc_id").alias("__k"), F.xxhash64("text").alias("__h")]
    single = docs.groupBy(*keys).agg(F.min_by(F.struct(*docs.columns), F.xxhash64(*docs.columns)).alias("__row"))
    kept = single.join(lead.hint("shuffle_hash"), ["__k", "__h"])
    return kept.select("__row.*")


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by the benchmark. Only contaminated ids are joined to the texts."""
    benchmark = ship_package(spark).read.parquet(f"{sf_dir}/benchmark.parquet")
    bad = decontaminate.find_contamination(docs, benchmark).where("contaminated").select(F.xxhash64("doc_id").alias("__k"), F.col("h").alias("__h")).distinct()
    keyed = docs.withColumns({"__k": F.xxhash64("doc_id"), "__h": F.xxhash64(F.coalesce("text", F.lit("")))})
    return keyed.join(bad.hint("shuffle_hash"), ["__k", "__h"], "left_anti").select(*docs.columns)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets replaced by a mark."""
    ship_package(spark)
    ledger = stored(secret_scan.scan(docs, path="doc_id"), "ledger")
    return secret_scan.redact(docs, ledger)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, as counts and hashes beside its columns."""
    ship_package(spark)
    return byte_bpe.round_trip(docs, *tokenizer())


STAGES = [
    ("quality_rules", quality),
    ("jaccard_join", near_duplicates),
    ("decontamination", decontamination),
    ("secret_scan", secrets),
    ("byte_bpe", tokens),
]

#: Neither linked groups over whole tables nor byte-pair merges can be expressed in SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn over ``documents``."""
    docs = ship_package(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
