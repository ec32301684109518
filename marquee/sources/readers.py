"""Readers with explicit schemas."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import CATALOG_EITHER, CLEANED, INFO, PAGES, REVIEWS, TABLES
from .splits import read_json_arrays, read_tables_of_values

# A quote inside a value is doubled, so any CSV reader gets tabs, quotes and line ends back.
TSV = {"sep": "\t", "header": True, "quote": '"', "escape": '"', "multiLine": True}


def _json(spark: SparkSession, path: str, schema: T.StructType, one_array: bool) -> DataFrame:
    return read_json_arrays(spark, path, schema) if one_array else spark.read.schema(schema).json(path)


def read_catalog(spark: SparkSession, path: str, one_array: bool = False) -> DataFrame:
    """Movie records, nested or flat on disk, as nested rows.

    JSON Lines are read in one pass. ``one_array`` reads files that are a single JSON array each, in splits too, but in
    two passes (:mod:`.splits`).
    """
    records = _json(spark, path, CATALOG_EITHER, one_array)
    flat = F.struct(*[F.col(name) for name in INFO.names])
    return records.select(F.coalesce("info", flat).alias("info"), "meta_score", "user_score")


def read_reviews(spark: SparkSession, path: str, one_array: bool = False) -> DataFrame:
    return _json(spark, path, REVIEWS, one_array)


def read_cleaned(spark: SparkSession, path: str) -> DataFrame:
    """Cleaned reviews: a TSV folder or file with a header."""
    return read_tables_of_values(spark, path, CLEANED, **TSV)


def read_dimension(spark: SparkSession, path: str, name: str = "name") -> DataFrame:
    return read_tables_of_values(spark, path, T.StructType([T.StructField(name, T.StringType())]), **TSV)


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(PAGES).parquet(path)


def read_tables(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The relational model from its Parquet folder."""
    return {name: spark.read.schema(schema).parquet(f"{folder}/{name}") for name, schema in TABLES.items()}


def read_jdbc(spark: SparkSession, url: str, table: str, **options) -> DataFrame:
    """One relational table over JDBC; pass ``partitionColumn`` and bounds to read it in parallel."""
    return spark.read.format("jdbc").option("url", url).option("dbtable", table).options(**options).load()


def json_field(text: Column, name: str, kind: T.DataType) -> Column:
    """One field of a JSON text column, NULL when it is missing."""
    return F.from_json(text, T.StructType([T.StructField(name, kind)]))[name]


def flatten(records: DataFrame) -> DataFrame:
    """Nested records as flat columns, score fields prefixed with their block."""
    scores = [
        F.col(f"{block}.{field}").alias(f"{block}_{field}".replace(".", "_"))
        for block in ("meta_score", "user_score")
        for field in ("score", "distri.positive", "distri.mixed", "distri.negative", "review_link")
    ]
    return records.select("info.*", *scores)
