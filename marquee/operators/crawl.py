"""Crawl rounds with a kept set of seen pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.links import page_address

BUCKETS = 64


class SeenPages:
    """(abs_url, round) of every page fetched or handed out, as a table bucketed and sorted by address.

    A round combines its equal links, brings them to the buckets of the table and anti-joins: what was seen is not
    shuffled, and every answer is exact. What is handed out is appended, so no later round hands it out again.
    """

    def __init__(self, spark: SparkSession, table: str, buckets: int = BUCKETS) -> None:
        self.spark, self.table, self.buckets = spark, table, buckets
        if not spark.catalog.tableExists(table):
            self._append(spark.createDataFrame([], "abs_url string, round long"))

    def _append(self, rows: DataFrame) -> None:
        rows.write.mode("append").bucketBy(self.buckets, "abs_url").sortBy("abs_url").saveAsTable(self.table)

    def rows(self) -> DataFrame:
        return self.spark.table(self.table)

    def _unseen(self, addresses: DataFrame) -> DataFrame:
        asked = addresses.where(F.col("abs_url").isNotNull()).distinct()
        return asked.join(self.rows().hint("merge"), "abs_url", "left_anti")

    def fetched(self, pages: DataFrame, number: int = 0) -> None:
        """Note the addresses (url) of pages that are there already."""
        fresh = self._unseen(pages.select(page_address(F.col("url")).alias("abs_url")))
        self._append(fresh.withColumn("round", F.lit(number).cast("long")))

    def next_round(self, links: DataFrame) -> DataFrame:
        """(abs_url, round): pages that ``links`` (abs_url) lead to and that no round has seen; they count as seen now."""
        number = (self.rows().agg(F.max("round")).first()[0] or 0) + 1
        fresh = self._unseen(links.select(page_address(F.col("abs_url")).alias("abs_url")))
        self._append(fresh.withColumn("round", F.lit(number).cast("long")))
        return self.rows().where(F.col("round") == number)

    def drop(self) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.table}")
