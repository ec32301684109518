"""Lookups on the model by id, title or name."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.numbering import first_rows, number_in_order, number_rows
from ..operators.stats import item_sentiment
from .search import SEARCHED_DIMENSIONS

def same_text(column: Column, value: str) -> Column:
    """Equality that ignores case."""
    return F.lower(column) == F.lit(value.lower())


def by_text(column: str) -> list[Column]:
    """Ascending order that ignores case first."""
    return [F.lower(column), F.col(column)]


def movie(model: dict[str, DataFrame], movie_id: int) -> DataFrame:
    return model["movies"].where(F.col("movie_id") == movie_id)


def image(model: dict[str, DataFrame], movie_id: int) -> DataFrame:
    return movie(model, movie_id).select("image")


def stream_links(model: dict[str, DataFrame], movie_id: int) -> DataFrame:
    return model["stream_links"].where(F.col("movie_id") == movie_id).select("url")


def genre_list(model: dict[str, DataFrame]) -> DataFrame:
    """(num, genre_id, genre_type) in name order; the keys already follow that order."""
    return number_rows(model["genres"], "num", [*by_text("genre_type"), "genre_id"])


def names_of_title(model: dict[str, DataFrame], title: str, role: str) -> DataFrame:
    """(num, key, name): the actors, directors or genres of the movies with this title."""
    dim, bridge, key, name = SEARCHED_DIMENSIONS[role]
    movies = model["movies"].where(same_text(F.col("title"), title)).select("movie_id")
    rows = model[bridge].join(movies, "movie_id").join(model[dim], key).select("movie_id", key, name)
    return number_rows(rows, "num", [*by_text(name), key, "movie_id"]).drop("movie_id")


def movies_of_name(model: dict[str, DataFrame], name: str, role: str, count: int | None = None) -> DataFrame:
    """(num, title, movie_id): the movies of an actor, director or genre in title order, the first ``count`` if given."""
    dim, bridge, key, column = SEARCHED_DIMENSIONS[role]
    wanted = model[dim].where(same_text(F.col(column), name)).select(key)
    ids = model[bridge].join(wanted, key, "left_semi").select("movie_id").distinct()
    rows = model["movies"].join(ids, "movie_id", "left_semi").select("title", "movie_id")
    return numbered(rows, [*by_text("title"), "movie_id"], count)


def movies_of_distributor(model: dict[str, DataFrame], distributor: str, count: int | None = None) -> DataFrame:
    rows = model["movies"].where(same_text(F.col("distributor"), distributor)).select("movie_id", "title")
    return numbered(rows, [*by_text("title"), "movie_id"], count)


def numbered(rows: DataFrame, order: list[Column | str], count: int | None) -> DataFrame:
    """All rows numbered in order, or the first ``count``."""
    return number_rows(rows, "num", order) if count is None else first_rows(rows, count, order, "num")


def user_reviews_of_title(model: dict[str, DataFrame], title: str, count: int | None = None) -> DataFrame:
    """User reviews of the movies with this title, highest score first."""
    ids = _review_ids(model, title, "reviews")
    rows = model["user_reviews"].join(ids, "review_id", "left_semi")
    rows = rows.select("review_id", "username", "u_score", "u_review", "polarity")
    return numbered(rows, [F.col("u_score").desc_nulls_last(), "review_id"], count)


def critic_reviews_of_title(model: dict[str, DataFrame], title: str, count: int | None = None) -> DataFrame:
    """Critic reviews of the movies with this title, most positive first."""
    ids = _review_ids(model, title, "critique")
    rows = model["critic_reviews"].join(ids, "critic_id", "left_semi")
    rows = rows.select("critic_id", "c_score", "c_review", "polarity")
    return numbered(rows, [F.col("polarity").desc_nulls_last(), "critic_id"], count)


def _review_ids(model: dict[str, DataFrame], title: str, bridge: str) -> DataFrame:
    movies = model["movies"].where(same_text(F.col("title"), title)).select("movie_id")
    return model[bridge].join(movies, "movie_id", "left_semi").drop("movie_id")


def movie_sentiment(model: dict[str, DataFrame], movie_id: int | None = None) -> DataFrame:
    """Mean user polarity and verdict of one movie, or of every movie."""
    links = model["reviews"] if movie_id is None else model["reviews"].where(F.col("movie_id") == movie_id)
    polarities = links.join(model["user_reviews"].select("review_id", "polarity"), "review_id")
    return item_sentiment(polarities, "movie_id")


def id_of_title(movies: DataFrame) -> DataFrame:
    """(title, movie_id): the first id of every title."""
    return movies.groupBy("title").agg(F.min("movie_id").alias("movie_id"))


def positions(movies: DataFrame) -> DataFrame:
    """(index, movie_id, title): movies with their place in the catalogue, from 0."""
    return number_in_order(movies.select("movie_id", "title"), "index", start=0).select("index", "movie_id", "title")


def index_of_title(placed: DataFrame, title: str) -> DataFrame:
    """Place of the first movie with this exact title."""
    return placed.where(F.col("title") == title).agg(F.min("index").alias("index"))


def title_of_index(placed: DataFrame, index: int) -> DataFrame:
    return placed.where(F.col("index") == index).select("title")


def title_of_id(movies: DataFrame, movie_id: int) -> DataFrame:
    return movies.where(F.col("movie_id") == movie_id).select("title")


def image_of_title(movies: DataFrame, title: str) -> DataFrame:
    """Image of the first movie with this exact title."""
    return movies.where(F.col("title") == title).orderBy("movie_id").limit(1).select("image")
