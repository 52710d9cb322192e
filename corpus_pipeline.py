"""The corpus pipeline: quality, exact and near duplicates, decontamination, tokens.

Each stage takes (spark, docs, sf_dir) and returns what it keeps of ``docs``, with the
columns of ``documents``; the last one returns the encoded documents.  Between stages
the rows are written as Parquet to the shared folder and read again.

Empty stages: a stage that is given no rows returns none.  Nulls, repeated rows and long
texts are handled as the operators' docstrings state.  SQL cannot state the quality,
near-duplicate and encoding stages, so ``ORACLE_SQL`` is None.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from ledgerlake.llm import bagminhash, byte_bpe, importance_resampling, radix_dedup, wu_manber
from ledgerlake.llm.shared import table, written


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that the importance-ratio classifier rejects."""
    model = importance_resampling.fit(docs, table(spark, sf_dir, "labels"))
    return importance_resampling.accepted(docs, model)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the row with the largest doc_id of each group of equal texts."""
    return radix_dedup.radix_dedup(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the row with the largest doc_id of each class of near duplicates."""
    return bagminhash.near_dedup(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents in which a benchmark window occurs."""
    return wu_manber.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, the ids of the text and the digests of ids and decoded text."""
    path = public_tokenizers.path(byte_bpe.RANKS)
    return byte_bpe.bpe_round_trip(docs, path, with_ids=True, carry=("lang", "source"))


STAGES = [
    ("quality classifier", quality),
    ("exact dedup", exact_dedup),
    ("MinHash near-dedup", near_dedup),
    ("benchmark decontamination", decontaminate),
    ("byte-level BPE encoding and decoding", encode),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, from ``documents`` on."""
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = written(docs, f"pipeline-{k}")
    return docs
