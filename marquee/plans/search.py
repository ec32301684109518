"""Keyword search over the model, and over its texts."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.values import MISSING, or_missing
from ..operators.lists import PAGE, joined_names, paged_lists
from ..operators.numbering import number_rows

# A keyword needs two ASCII letters or digits, and the two error messages.
KEYWORD = "[a-zA-Z0-9]+[^a-zA-Z0-9]*[a-zA-Z0-9]+"
NO_KEYWORD = "Please enter a keyword!!"
BAD_KEYWORD = "Please enter a valid keyword!!"

# The search fields besides title and distributor, and the sort orders.
SEARCHED_DIMENSIONS = {
    "actor": ("actors", "plays_in", "actor_id", "name"),
    "director": ("directors", "directed", "director_id", "name"),
    "genre": ("genres", "movie_genre", "genre_id", "genre_type"),
}
ORDERS = {"release_date": "release_date", "metacritic_score": "m_c_score", "user_score": "m_u_score"}

# Attributes that are shown with a label when they are missing.
SHOWN = ["release_date", "distributor", "ratings", "runtime", "m_c_score", "m_u_score", "summary"]

# (list name, dimension, bridge, key, name column)
LISTS = [(field, *SEARCHED_DIMENSIONS[field]) for field in ("director", "actor", "genre")]


def is_keyword(text: Column) -> Column:
    return text.rlike(KEYWORD)


def checked_keyword(keyword: str | None) -> str:
    """The keyword in lower case; ValueError when it is empty or has fewer than two letters or digits."""
    if not keyword:
        raise ValueError(NO_KEYWORD)
    if not re.search(KEYWORD, keyword):
        raise ValueError(BAD_KEYWORD)
    return keyword.lower()


def contains(column: Column, keyword: str, ignore_accents: bool = False) -> Column:
    """Case-insensitive substring test; ``%`` and ``_`` stand for themselves."""
    if ignore_accents:
        return F.contains(F.collate(column, "UNICODE_CI_AI"), F.collate(F.lit(keyword), "UNICODE_CI_AI"))
    return F.contains(F.lower(column), F.lit(keyword.lower()))


def found_movies(model: dict[str, DataFrame], field: str, keyword: str, ignore_accents: bool = False) -> DataFrame:
    """Rows of ``movies`` that match, each once: a semi-join on the ids, combined before they are shuffled."""
    keyword = checked_keyword(keyword)
    movies = model["movies"]
    if field in SEARCHED_DIMENSIONS:
        dim, bridge, key, name = SEARCHED_DIMENSIONS[field]
        hits = model[dim].where(contains(F.col(name), keyword, ignore_accents)).select(key)
        ids = model[bridge].join(hits, key, "left_semi").select("movie_id").distinct()
        return movies.join(ids, "movie_id", "left_semi")
    column = F.col("distributor" if field == "distributor" else "title")
    return movies.where(contains(column, keyword, ignore_accents))


def name_lists(model: dict[str, DataFrame], movies: DataFrame | None = None, limit: int = PAGE) -> DataFrame:
    """(movie_id, page, directors, actors, genres) of the given movies, or of all.

    Each bridge meets its names: they are broadcast when they are small, and a name of very many movies is
    split as a skewed partition. The three are paged and grouped as one.
    """
    entries = links = None
    for field, dim, bridge, key, name in LISTS:
        mine = model[bridge] if movies is None else model[bridge].join(movies.select("movie_id"), "movie_id", "left_semi")
        named = mine.select("movie_id", key).join(model[dim].select(key, F.col(name).alias("name")), key)
        named = named.select("movie_id", F.lit(field).alias("list"), F.col(key).alias("key"), "name")
        entries = named if entries is None else entries.unionByName(named)
        links = mine.select("movie_id") if links is None else links.unionByName(mine.select("movie_id"))
    lists = {f"{field}s": (F.col("list") == field, F.col("name")) for field, *_ in LISTS}
    entries = entries.withColumn("low", F.lower("name"))
    return paged_lists(entries, "movie_id", ["low", "name", "key"], lists, ["list"], limit, counted=links)


def with_names(movies: DataFrame, lists: DataFrame) -> DataFrame:
    """Movies with their name lists; a movie has further pages only when a list is longer than one page."""
    empty = F.array().cast("array<string>")
    joined = movies.join(lists, "movie_id", "left").withColumn("page", F.coalesce("page", F.lit(0).cast("long")))
    for field, *_ in LISTS:
        names = F.coalesce(f"{field}s", empty)
        later = (F.col("page") > 0) & (F.size(names) == 0)
        joined = joined.withColumn(f"{field}s", F.when(later, F.lit("")).otherwise(joined_names(names)))
    return joined


def ordered(movies: DataFrame, order_by: str = "release_date") -> DataFrame:
    """Movies numbered 1, 2, ... by release date (unless told a score), newest or highest first, NULLs last."""
    column = ORDERS.get(order_by, "release_date")
    return number_rows(movies, "num", [F.col(column).desc_nulls_last(), "movie_id"])


def search(
    model: dict[str, DataFrame],
    field: str = "title",
    keyword: str = "",
    order_by: str = "release_date",
    limit: int = PAGE,
    ignore_accents: bool = False,
    labels: bool = False,
) -> DataFrame:
    """Matching movies with number and name lists; with ``labels`` the attributes as text, ``N/A`` where missing."""
    hits = ordered(found_movies(model, field, keyword, ignore_accents), order_by)
    rows = with_names(hits, name_lists(model, hits, limit))
    return display_labels(rows, SHOWN) if labels else rows


def display_labels(rows: DataFrame, columns: list[str]) -> DataFrame:
    """The named columns as text with ``N/A`` for NULL, as shown to a reader."""
    return rows.withColumns({name: or_missing(F.col(name), MISSING) for name in columns})


def text_search(texts: dict[str, DataFrame], keyword: str, source: str = "all") -> DataFrame:
    """(source, id, text) of every text that holds the keyword; ``texts`` are frames of (id, text)."""
    keyword = checked_keyword(keyword)
    result = None
    for name, frame in texts.items():
        if source in ("all", name):
            hits = frame.where(contains(F.col("text"), keyword)).select(F.lit(name).alias("source"), "id", "text")
            result = hits if result is None else result.unionByName(hits)
    if result is None:
        raise ValueError(f"unknown source {source!r}")
    return result


def model_texts(model: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The texts a keyword can be looked for in: summaries, critic reviews, user reviews."""
    return {
        "summary": model["movies"].select(F.col("movie_id").alias("id"), F.col("summary").alias("text")),
        "critic_review": model["critic_reviews"].select(F.col("critic_id").alias("id"), F.col("c_review").alias("text")),
        "user_review": model["user_reviews"].select(F.col("review_id").alias("id"), F.col("u_review").alias("text")),
    }
