"""Cleans a text corpus and encodes what is left, stage by stage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickwell.llm import bpe, decontaminate, quality, secrets, simhash
from tickwell.llm.common import scratch, settle, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops what the base rules or the decision list learned from `labels` reject."""
    rules = quality.learned_rules(docs, table(spark, sf_dir, "labels"))
    return quality.keep_good(docs, rules)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the smallest doc_id of each group of near-duplicates."""
    return simhash.one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold an item of `benchmark`."""
    return decontaminate.without_items(docs, table(spark, sf_dir, "benchmark"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents with secrets."""
    return secrets.without_secrets(docs, secrets.Ledger(spark, scratch(spark, "blob-ledger")))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, the token ids of each text, their number, and the text decoded from them."""
    found = bpe.tokenize(docs.select("doc_id", "text"), bpe.vocabulary())
    return found.select(
        "doc_id",
        F.size("tokens.ids").cast("long").alias("n_tokens"),
        F.col("tokens.ids").alias("ids"),
        F.col("tokens.decoded").alias("decoded"),
    )


STAGES = [
    ("quality rules", quality_rules),
    ("SimHash near-dedup", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("secret scans", secret_scan),
    ("BPE encoding and decoding", encoding),
]

#: The learned rules and the encoding have no SQL; the tests hold run() against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; each is stored before the next reads it."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir), name.lower().replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
