"""Exact dedup against a persistent digest index, bucketed and sorted by hash.

New data is reduced to one row per digest, anti-joined with the index by sort-merge on the buckets (the index
side is not shuffled) and what is new is appended. Everything runs in DataFrame operations.

Defined results: a NULL text counts as empty; equal texts agree after each run of blanks (space, tab to
carriage return) becomes one space; of equal texts the one known to the index stays, else the smallest
``doc_id`` (a NULL id only if there is no other). Of rows that repeat both id and text, one is kept. Ingesting
a batch again gives the same answer. Other columns are ignored, whatever their names. An empty table gives an
empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import packed, salt, settled, whole

BUCKETS = 64
BLANKS = r"[\x20\x09-\x0D]+"


def digest(text: Column) -> Column:
    return F.sha2(F.regexp_replace(whole(text), BLANKS, " "), 256)


class DigestIndex:
    """Table of (text_sha256, keep_id), bucketed and sorted by the digest."""

    def __init__(self, spark: SparkSession, name: str, buckets: int = BUCKETS):
        self.spark, self.name, self.buckets = spark, name, buckets
        if not spark.catalog.tableExists(name):
            self.append(spark.createDataFrame([], "text_sha256 string, keep_id long"))

    def append(self, rows: DataFrame) -> None:
        rows.write.mode("append").bucketBy(self.buckets, "text_sha256").sortBy("text_sha256").saveAsTable(self.name)

    def rows(self) -> DataFrame:
        return self.spark.table(self.name)

    def drop(self) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")


def ingest(docs: DataFrame, index: DigestIndex) -> DataFrame:
    """Dedup ``docs`` against ``index``, append what is new: doc_id, keep_id, group_size, kept, text_sha256.

    ``group_size`` counts the batch's rows. A digest's rows are spread over salts by id, so a group with a third
    of all rows is folded and answered in parts.
    """
    rows = settled(
        docs.select("doc_id", digest(F.col("text")).alias("text_sha256"))
        .groupBy("text_sha256", "doc_id")
        .agg(F.count("*").alias("copies"))
        .withColumn("_salt", salt("doc_id"))
    )
    parts = rows.groupBy("text_sha256", "_salt").agg(F.min("doc_id").alias("first_id"), F.sum("copies").alias("group_size"))
    batch = settled(
        parts.groupBy("text_sha256").agg(
            F.min("first_id").alias("first_id"), F.sum("group_size").alias("group_size"), F.collect_list("_salt").alias("_salts")
        )
    )
    fresh = batch.join(index.rows().hint("merge"), "text_sha256", "left_anti")
    index.append(fresh.select("text_sha256", F.col("first_id").alias("keep_id")))
    answers = (
        batch.join(index.rows().hint("merge"), "text_sha256")
        .select("text_sha256", "keep_id", "group_size", F.explode("_salts").alias("_salt"))
    )
    return (
        rows.join(answers, ["text_sha256", "_salt"])
        .withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
        .select(
            "doc_id",
            "keep_id",
            "group_size",
            (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)).alias("kept"),
            "text_sha256",
        )
    )


def keep_first(docs: DataFrame, answers: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, all columns as they were."""
    stay = answers.where("kept").select("doc_id", "text_sha256")
    rows = packed(docs, id=F.col("doc_id"), sha=digest(F.col("text")))
    same = F.col("id").eqNullSafe(F.col("doc_id")) & (F.col("sha") == F.col("text_sha256"))
    return rows.join(stay, same, "left_semi").dropDuplicates(["id", "sha"]).select("row.*")
