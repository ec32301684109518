"""Title matching: reviews to movies, movies to listing ranks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .skew import skew_join

_UNDATED = "0001-01-01"


def match_reviews(reviews: DataFrame, catalog: DataFrame, review_id: str | list[str]) -> DataFrame:
    """Add ``movie_id`` to each review, NULL when no movie fits.

    ``reviews`` has (title, date, review id...), ``catalog`` (movie_id, title, date, position). A dated review
    belongs to the first movie with its title and date, an undated one to the first with its title.
    The catalogue is reduced to one row per lookup key before the join, so the join cannot multiply
    rows, and a title that holds much of the reviews is spread over many tasks.
    """
    ids = [review_id] if isinstance(review_id, str) else list(review_id)
    first = F.min_by("movie_id", "position").alias("movie_id")
    no_date = F.lit(_UNDATED).cast("date")
    dated = catalog.where(F.col("date").isNotNull()).groupBy("title", "date").agg(first)
    undated = catalog.groupBy("title").agg(first)
    lookup = dated.select("title", F.col("date").alias("_date"), F.lit(True).alias("_dated"), "movie_id").unionByName(
        undated.select("title", no_date.alias("_date"), F.lit(False).alias("_dated"), "movie_id")
    )
    keyed = reviews.withColumn("_date", F.coalesce("date", no_date)).withColumn("_dated", F.col("date").isNotNull())
    matched = skew_join(keyed, lookup, ["title", "_date", "_dated"], spread=ids, how="left")
    return matched.drop("_date", "_dated")


def assign_ranks(movies: DataFrame, ranks: DataFrame, key: str, unknown: int = -1) -> DataFrame:
    """Add ``rank`` to movies (key, title...) from the listing (title, rank), ``unknown`` without a match.

    A listed rank is used once: of several movies with one title the lowest ``key`` gets it, and a title
    listed twice counts with its last rank. Both sides are reduced to one row per title before they meet, and the rank comes back on the
    movie's own key, so no join has a hot key.
    """
    owners = movies.groupBy("title").agg(F.min(key).alias(key))
    listed = ranks.groupBy("title").agg(F.max("rank").alias("rank"))
    found = owners.join(listed, "title").select(key, "rank")
    return movies.join(found, key, "left").withColumn("rank", F.coalesce("rank", F.lit(unknown)))
