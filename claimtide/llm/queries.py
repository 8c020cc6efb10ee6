"""The registered queries of the text operators: whole tables in, whole results out."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimtide.llm import (
    decontamination, filter_audit, html_text, jaccard_join, neighbours, oracle, packing, personal_data, quality_lm, secret_scan, spelling,
    tiled_dedup, token_codes, toxicity,
)
from claimtide.llm.common import text_session


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return text_session(spark).read.parquet(f"{folder}/{name}.parquet")


def _joined(spans):
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def op1_html_text(spark: SparkSession, folder: str) -> DataFrame:
    return html_text.extract_text(_table(spark, folder, "pages"))


def op2_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    found = secret_scan.find_secrets(_table(spark, folder, "documents"))
    base = F.filter("spans", secret_scan.is_base)
    count = lambda kind: F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id", *(count(k).alias(f"n_{k}") for k in secret_scan.KINDS),
        F.sha2(_joined(base), 256).alias("base_sha256"), _joined(F.col("spans")).alias("spans"),
    )


def op3_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    found = personal_data.find_personal_data(_table(spark, folder, "documents"))
    base = F.filter("spans", lambda s: s["kind"].isin(*personal_data.BASE_KINDS))
    count = lambda kind: F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id", *(count(k).alias(f"n_{k}") for k in personal_data.BASE_KINDS),
        F.sha2(_joined(base), 256).alias("base_sha256"), _joined(F.col("spans")).alias("spans"),
        F.array_join(F.transform("spans", lambda s: s["score"].cast("string")), ",").alias("scores"),
    )


def op4_curve_packing(spark: SparkSession, folder: str) -> DataFrame:
    pieces = packing.pack(_table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"),
        "doc_tokens", "sequence_id", "offset",
    )


def op5_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    return neighbours.nearest(_table(spark, folder, "embeddings"), every=50, count=5)


def op6_token_codes(spark: SparkSession, folder: str) -> DataFrame:
    path = token_codes.codes_folder(spark)
    token_codes.write_codes(_table(spark, folder, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"))
    return token_codes.read_codes(spark, path)


def op7_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard_join.join_documents(_table(spark, folder, "documents"))


def op8_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    return toxicity.score_texts(docs, toxicity.learn(docs, _table(spark, folder, "labels")))


def op9_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontamination.find_leaks(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))


def op10_quality_lm(spark: SparkSession, folder: str) -> DataFrame:
    return quality_lm.judge(_table(spark, folder, "documents"), _table(spark, folder, "labels"))


def op11_embedding_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return tiled_dedup.group_vectors(_table(spark, folder, "embeddings"), threshold=0.9)


def op12_filter_audit(spark: SparkSession, folder: str) -> DataFrame:
    return filter_audit.audit(_table(spark, folder, "documents"), _table(spark, folder, "labels"))


def op13_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    return spelling.group_variants(_table(spark, folder, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        f.__name__: f
        for f in (
            op1_html_text, op2_secret_scan, op3_personal_data, op4_curve_packing, op5_neighbours, op6_token_codes, op7_jaccard_join, op8_toxicity,
            op9_decontamination, op10_quality_lm, op11_embedding_dedup, op12_filter_audit, op13_spelling_variants,
        )
    }


def oracle_sql() -> dict[str, str]:
    """The other queries can't be said in SQL, or only too slowly; tests/llm/ holds them against
    brute force, round trips and held-out labels."""
    return dict(oracle.ORACLE)
