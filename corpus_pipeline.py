"""The corpus pipeline: toxic documents go, one document of each near-duplicate group stays,
secrets are masked, and what is left is packed into sequences.

Each stage takes (spark, docs, sf_dir). All but the last return the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from homeledger.llm import copies, packing, secrets, toxicity
from homeledger.llm.common import free_name
from homeledger.llm.queries import table, vocabulary
from homeledger.session import cut_lineage


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below the threshold, null and empty texts among them."""
    key, score = F.col("doc_id"), free_name(docs, "score")
    scorer = toxicity.fit(docs, table(spark, sf_dir, "labels"), ~toxicity.held_out(key))
    return scorer.score(docs, docs.columns, into=score).where(F.col(score) < toxicity.THRESHOLD).drop(score)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The row with the smallest id (null last) of each group of near copies: five-word shingles, Jaccard 0.8 or
    more. Rows of one id are told apart."""
    return copies.without_copies(docs)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, each secret replaced by a mark and n_chars counted anew."""
    return secrets.redacted(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents and their places in sequences."""
    return packing.pack_documents(docs, vocabulary())


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic), ("simhash", drop_near_duplicates), ("secrets", mask_secrets), ("packing", pack)]
ORACLE_SQL = None  # neither the trees nor the hashes nor the vocabulary are in SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after another, each one's result written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = cut_lineage(stage(spark, docs, sf_dir), name)
    return docs
