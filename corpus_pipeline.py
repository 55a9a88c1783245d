"""Documents to training sequences, in stages that each read what the one before has kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from chronofeat.llm.digest_index import DigestIndex
from chronofeat.llm.packing import pack_documents
from chronofeat.llm.rules import learn, verdict_column
from chronofeat.llm.secrets import clean_secrets
from chronofeat.llm.simhash import keep_one
from chronofeat.session import stage_table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that neither the base rule nor a rule learned from the labels rejects go on.

    Null and empty texts have no words and go; repeated rows are judged alike; of an empty table
    nothing is left, and without labels only the base rule decides.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    verdict = "kept by rules"
    return verdict_column(docs, learn(docs, labels), verdict).where(f"`{verdict}`").drop(verdict)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest doc_id goes on, of equal rows one.

    Null counts as the empty text, and a null id as the smallest; an empty table stays empty.
    """
    index = DigestIndex(spark)
    kept = index.keep_new(docs)
    index.close()
    return kept


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents whose fingerprints are linked the one with the smallest doc_id goes on.

    Null and empty texts are linked with each other, null ids come last, of equal rows one goes on;
    an empty table stays empty.
    """
    return keep_one(docs)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark; n_chars follows where a text has changed. No document goes.

    Null and empty texts stay as they are, repeated rows are repeated, an empty table stays empty.
    """
    return clean_secrets(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of all documents with their sequence and place.

    A null text counts as empty and gives one piece of one id; repeated rows are packed each; an
    empty table gives none. Of further columns, whatever their names, nothing is returned.
    """
    return pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality_rules", quality_rules),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("secret_scan", secret_scan),
    ("best_fit_packing", best_fit_packing),
]

#: Learned rules, fingerprints and token ids have no SQL form; a test holds the rows against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to `documents`; each result is a Parquet table that the next stage reads."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stage_table(stage(spark, docs, sf_dir), name)
    return docs
