"""One query per operator, over its whole table."""

from __future__ import annotations

from uuid import uuid4

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, centroids, contamination, conversations, exact, licenses, lines, mixing, neardup, pii, quality, secrets, vectors
from .common import settled, table


def op1_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    """A document's source stands for the owner, its source and language for the repository."""
    docs = table(spark, folder, "documents")
    repository = F.concat_ws("/", F.coalesce("source", F.lit("")), F.coalesce("lang", F.lit("")))
    return secrets.digests(secrets.scan(docs, repository=repository, owner=F.col("source")))


def op2_bpe(spark: SparkSession, folder: str, path: str = public_tokenizers.path("word_bpe_49k.json")) -> DataFrame:
    return bpe.digests(bpe.encode(table(spark, folder, "documents"), path))


def op3_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.digests(licenses.search(table(spark, folder, "documents")))


def op4_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """All documents as one batch into a new index, which is dropped when the answers are settled."""
    index = exact.DigestIndex(spark, f"digest_index_{uuid4().hex}")
    try:
        return settled(exact.ingest(table(spark, folder, "documents"), index))
    finally:
        index.drop()


def op5_minhash(spark: SparkSession, folder: str) -> DataFrame:
    return neardup.dedup(table(spark, folder, "documents"))


def op6_projection_passes(spark: SparkSession, folder: str) -> DataFrame:
    return vectors.dedup(table(spark, folder, "embeddings"))


def op7_source_mix(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.digests(mixing.mix(table(spark, folder, "documents")))


def op8_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return lines.digests(lines.remove(table(spark, folder, "documents").select("doc_id", "text")))


def op9_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    return pii.digests(pii.find(table(spark, folder, "documents")))


def op10_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return quality.classify(docs, quality.train(docs, quality.graded(table(spark, folder, "labels"))))


def op11_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    return conversations.audited(table(spark, folder, "conversations"))


def op12_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return contamination.digests(docs, *contamination.find(docs, table(spark, folder, "benchmark")))


def op13_centroids(spark: SparkSession, folder: str) -> DataFrame:
    return centroids.digests(*centroids.cluster(table(spark, folder, "embeddings")))


QUERIES = {
    "op1_secret_scan": op1_secret_scan,
    "op2_bpe": op2_bpe,
    "op3_license_scan": op3_license_scan,
    "op4_exact_dedup": op4_exact_dedup,
    "op5_minhash": op5_minhash,
    "op6_projection_passes": op6_projection_passes,
    "op7_source_mix": op7_source_mix,
    "op8_line_dedup": op8_line_dedup,
    "op9_personal_data": op9_personal_data,
    "op10_quality": op10_quality,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_decontamination": op12_decontamination,
    "op13_centroids": op13_centroids,
}
