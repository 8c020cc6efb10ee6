"""The corpus pipeline: documents in, packed training sequences out.

Each stage works on what its predecessor kept, written as Parquet in the session's shared
folder and read again. All stages but the last return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimtide.llm import decontamination, jaccard_join, packing, personal_data, toxicity
from claimtide.llm.common import stored, text_session


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, learned from the labels of these documents, accepts."""
    text_session(spark)
    return toxicity.drop_toxic(docs, toxicity.learn(docs, _table(spark, sf_dir, "labels")))


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five-word shingles, 0.8 of them in common."""
    return jaccard_join.keep_one(docs, shingle=5, share=80)


def drop_leaked(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without test items."""
    return decontamination.drop_leaked(docs, _table(spark, sf_dir, "benchmark"))


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data masked in the text."""
    return personal_data.mask_personal_data(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of full sequences, along the curve."""
    pieces = packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"),
        "doc_tokens", "sequence_id", "offset",
    )


STAGES = [
    ("toxicity", drop_toxic),
    ("jaccard_join", keep_one_of_each_group),
    ("decontamination", drop_leaked),
    ("personal_data", mask_personal_data),
    ("packing", pack),
]

#: No stage but the masking could be said in SQL; tests/llm/ holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents in `sf_dir`; the packed pieces."""
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
