"""The relational model: nested records and cleaned reviews to twelve tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import values as V
from ..operators.matching import match_reviews
from ..operators.numbering import keys_by_name, number_in_order
from ..operators.pages import CRITIC, USER
from ..operators.skew import skew_join
from ..operators.stats import table_counts

# (list field, dimension table, key, name column, bridge table)
DIMENSIONS = [
    ("director", "directors", "director_id", "name", "directed"),
    ("starring", "actors", "actor_id", "name", "plays_in"),
    ("genres", "genres", "genre_id", "genre_type", "movie_genre"),
]


def movies_table(records: DataFrame) -> DataFrame:
    return records.select(
        F.col("info.id").alias("movie_id"),
        "info.title",
        V.page_date(F.col("info.date")).alias("release_date"),
        "info.distributor",
        F.col("info.rating").alias("ratings"),
        V.minutes(F.col("info.runtime")).alias("runtime"),
        "info.summary",
        V.user_score(F.col("user_score.score")).alias("m_u_score"),
        V.critic_score(F.col("meta_score.score")).alias("m_c_score"),
        "info.image",
    )


def dimension(lists: DataFrame, item: str, values: str, key: str, name: str) -> tuple[DataFrame, DataFrame]:
    """(dimension, bridge) of a list column: distinct values with a key, and the item-key pairs.

    A value that half the items share is spread over many tasks when the keys are looked up.
    """
    pairs = lists.select(item, F.explode(F.array_distinct(values)).alias(name)).where(F.col(name).isNotNull())
    keyed = keys_by_name(pairs, key, name)
    return keyed, skew_join(pairs, keyed, [name], spread=[item]).select(item, key)


def build_model(records: DataFrame, cleaned: DataFrame) -> dict[str, DataFrame]:
    """Twelve tables by name, plus ``unmatched``: reviews whose title and date are in no movie.

    Reviews keep their ``review_id`` when they have one, else they are numbered in file order, per kind. The
    texts are read once, when their table is written: they are not shuffled, and matching reads the key, title and
    date alone. Movies come first by file order.
    """
    model = {"movies": movies_table(records)}
    for field, table, key, name, bridge in DIMENSIONS:
        lists = records.select(F.col("info.id").alias("movie_id"), F.col(f"info.{field}").alias("values"))
        model[table], model[bridge] = dimension(lists, "movie_id", "values", key, name)
    model["stream_links"] = records.select(
        F.col("info.id").alias("movie_id"), F.explode(F.array_distinct("info.stream_link")).alias("url")
    )

    users, critics = (cleaned.where(F.col("review_type") == kind) for kind in (USER, CRITIC))
    if "review_id" in cleaned.columns:
        critics = critics.withColumnRenamed("review_id", "critic_id")
    else:
        users, critics = number_in_order(users, "review_id"), number_in_order(critics, "critic_id")
    score, polarity = F.col("review_score"), F.col("sentiment_score").try_cast("decimal(4,3)").alias("polarity")
    model["user_reviews"] = users.select(
        "review_id",
        F.col("review_clean").alias("u_c_review"),
        F.col("review").alias("u_review"),
        F.col("reviewer_name").alias("username"),
        V.user_score(score).alias("u_score"),
        polarity,
    )
    model["critic_reviews"] = critics.select(
        "critic_id",
        F.col("review_clean").alias("c_c_review"),
        F.col("review").alias("c_review"),
        V.critic_score(score).alias("c_score"),
        polarity,
    )

    def to_match(reviews: DataFrame, kind: str, key: str) -> DataFrame:
        return reviews.select(
            F.lit(kind).alias("kind"),
            F.col(key).alias("id"),
            F.col("movie_name").alias("title"),
            V.page_date(F.col("release_date")).alias("date"),
        )

    wanted = to_match(users, USER, "review_id").unionByName(to_match(critics, CRITIC, "critic_id"))
    catalog = model["movies"].select("movie_id", "title", F.col("release_date").alias("date"))
    links = match_reviews(wanted, number_in_order(catalog, "position"), ["kind", "id"])
    found = links.where(F.col("movie_id").isNotNull())
    model["reviews"] = found.where(F.col("kind") == USER).select("movie_id", F.col("id").alias("review_id"))
    model["critique"] = found.where(F.col("kind") == CRITIC).select("movie_id", F.col("id").alias("critic_id"))
    model["unmatched"] = links.where(F.col("movie_id").isNull()).drop("movie_id")
    return model


def model_summary(model: dict[str, DataFrame]) -> DataFrame:
    """(name, n): row counts, movies without a date and reviews without a movie."""
    tables = {name: model[name] for name in ("movies", "actors", "directors", "genres", "user_reviews", "critic_reviews")}
    tables["total_reviews"] = model["user_reviews"].select("polarity").unionAll(model["critic_reviews"].select("polarity"))
    tables["movies_without_date"] = model["movies"].where(F.col("release_date").isNull())
    tables["unmatched_reviews"] = model["unmatched"]
    return table_counts(tables)
