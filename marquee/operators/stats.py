"""Counts and statistics, each in one pass."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.sentiment import label


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """(name, n): the row count of each table."""
    result = None
    for name, table in tables.items():
        row = table.agg(F.count("*").alias("n")).select(F.lit(name).alias("name"), "n")
        result = row if result is None else result.unionByName(row)
    return result


def _mean(total: Column, count: Column) -> Column:
    return total.cast("double") / F.when(count > 0, count)


def review_statistics(reviews: DataFrame, by: str = "review_type") -> DataFrame:
    """Count and minimum, maximum and mean of sentiment and score per ``by``, and over all rows as ``all``.

    ``reviews`` has ``sentiment_score`` and ``score``. One roll-up replaces a job per figure.
    """
    figures = [F.grouping(by).alias("_all"), F.count("*").alias("n")]
    for column, short in (("sentiment_score", "sentiment"), ("score", "score")):
        figures += [
            F.min(column).alias(f"min_{short}"),
            F.max(column).alias(f"max_{short}"),
            _mean(F.sum(column), F.count(column)).alias(f"avg_{short}"),
        ]
    rolled = reviews.rollup(by).agg(*figures)
    return rolled.withColumn(by, F.when(F.col("_all") == 1, "all").otherwise(F.col(by))).drop("_all")


def item_sentiment(reviews: DataFrame, item: str, polarity: str = "polarity") -> DataFrame:
    """(item, n_reviews, polarity_sum, polarity_mean, verdict) of each item's reviews.

    The mean divides by all reviews, those without a polarity included, and rounds half to even.
    """
    totals = reviews.groupBy(item).agg(F.count("*").alias("n_reviews"), F.sum(polarity).alias("polarity_sum"))
    mean = F.bround(F.col("polarity_sum") / F.col("n_reviews"), 3).cast("decimal(4,3)")
    return totals.withColumn("polarity_mean", mean).withColumn("verdict", label(F.col("polarity_mean"), "movie"))


def score_distribution(reviews: DataFrame, item: str, polarity: str = "polarity") -> DataFrame:
    """(item, positive, mixed, negative): reviews per sentiment label."""
    kind = label(F.col(polarity))
    return reviews.groupBy(item).agg(
        F.count_if(kind == "Positive").alias("positive"),
        F.count_if(kind == "Neutral").alias("mixed"),
        F.count_if(kind == "Negative").alias("negative"),
    )
