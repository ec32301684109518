"""Review cleaning: raw feed to cleaned, scored reviews."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.sentiment import Lexicon, polarity, scored_by
from ..functions.text import clean
from ..functions.values import number


def clean_reviews(
    reviews: DataFrame, lexicon: Lexicon | None = None, scorer: Callable[[str], float] | None = None
) -> DataFrame:
    """Cleaned text and sentiment of the raw text for each review; row by row, no shuffle.

    ``scorer`` replaces the lexicon by the caller's own function of one text.
    """
    text = F.col("review")
    return reviews.select(
        "release_date",
        "movie_name",
        "review_type",
        "reviewer_name",
        "review_score",
        "review",
        clean(text).alias("review_clean"),
        (scored_by(text, scorer) if scorer else polarity(text, lexicon)).alias("sentiment_score"),
    )


def of_type(reviews: DataFrame, review_type: str) -> DataFrame:
    """Reviews of one type with the score as a number."""
    return reviews.where(F.col("review_type") == review_type).withColumn("review_score", number(F.col("review_score")))


def distinct_values(records: DataFrame) -> dict[str, DataFrame]:
    """Distinct actors, directors and genres of nested records."""
    lists = {"actors": "info.starring", "directors": "info.director", "genres": "info.genres"}
    return {
        name: records.select(F.explode(column).alias("name")).distinct() for name, column in lists.items()
    }
