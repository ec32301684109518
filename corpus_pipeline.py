"""A corpus from raw documents to tokens: the stages, each over all that its predecessor kept."""

from __future__ import annotations

from uuid import uuid4

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from marquee.llm import bpe, exact, mixing, neardup, quality
from marquee.llm.common import settled, table

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def good_quality(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that the ordinal classifier, fitted on the folder's labels, does not reject."""
    return quality.keep_good(docs, quality.train(docs, quality.graded(table(spark, folder, "labels"))))


def exact_copies(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document of each group of equal texts, against an index that starts empty."""
    index = exact.DigestIndex(spark, f"digest_index_{uuid4().hex}")
    try:
        answers = settled(exact.ingest(docs, index))
    finally:
        index.drop()
    return exact.keep_first(docs, answers)


def near_copies(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document of each group of near copies: five-word shingles, similarity of 0.8 or more."""
    return neardup.keep_first(docs, neardup.dedup(docs, words=5))


def source_mix(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.repeated(docs, mixing.mix(docs))


def tokens(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """doc_id, ids and decoded text of every document of the mix, with the digests of both."""
    return bpe.digests(bpe.encode(docs, TOKENIZER), "ids")


STAGES = [
    ("quality", good_quality),
    ("exact_dedup", exact_copies),
    ("near_dedup", near_copies),
    ("source_mix", source_mix),
    ("bpe", tokens),
]
#: SQL can fit no classifier, so run() is tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, folder: str) -> DataFrame:
    """All stages in turn over ``documents``; each stage's rows are settled before the next reads them."""
    docs = table(spark, folder, "documents")
    for place, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs if place == 0 else settled(docs), folder)
    return docs
