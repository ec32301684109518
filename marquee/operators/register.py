"""Keys of names that last over loads."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .numbering import number_rows
from .skew import skew_join

BUCKETS = 64


class KeyRegister:
    """(name, key) of every name ever seen, as a table bucketed and sorted by name.

    A load anti-joins its distinct names with the register, whose side is not shuffled, numbers the new ones in name
    order after the highest key, and appends them. Names keep their keys; loading again changes nothing.
    """

    def __init__(self, spark: SparkSession, table: str, buckets: int = BUCKETS) -> None:
        self.spark, self.table, self.buckets = spark, table, buckets
        if not spark.catalog.tableExists(table):
            self._append(spark.createDataFrame([], "name string, key long"))

    def _append(self, rows: DataFrame) -> None:
        rows.write.mode("append").bucketBy(self.buckets, "name").sortBy("name").saveAsTable(self.table)

    def rows(self) -> DataFrame:
        return self.spark.table(self.table)

    def load(self, values: DataFrame, name: str = "name") -> DataFrame:
        """Register the distinct non-NULL ``name`` values; all rows of the register afterwards."""
        seen = values.select(F.col(name).alias("name")).where(F.col("name").isNotNull()).distinct()
        fresh = seen.join(self.rows().hint("merge"), "name", "left_anti")
        start = (self.rows().agg(F.max("key")).first()[0] or 0) + 1
        numbered = number_rows(fresh, "key", [F.lower("name"), "name"], start)
        self._append(numbered.select("name", "key"))
        return self.rows()

    def keyed(self, values: DataFrame, name: str, key: str, spread: list[str]) -> DataFrame:
        """``values`` with the key of their name; a name that very many rows share is spread over tasks."""
        known = self.rows().select(F.col("name").alias(name), F.col("key").alias(key))
        return skew_join(values, known, [name], spread=spread, how="left")

    def drop(self) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.table}")
