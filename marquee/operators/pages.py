"""Stored pages (page_id, url, html) to records, reviews and links."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fields as P
from ..functions.links import absolute, in_domains, page_address
from ..functions.markup import extract
from ..functions.text import RANK_EDGES, tidy
from ..functions.values import UNRATED, whole_number
from .matching import assign_ranks

CRITIC = "Critic Review"
USER = "User Review"


def listing_ranks(pages: DataFrame, title: str = P.LISTED_TITLE, rank: str = P.LISTED_RANK) -> DataFrame:
    """(page_id, pos, title, rank) of a listing: the titles and rank texts paired by position."""
    pairs = F.arrays_zip(P.every(F.col("html"), title).alias("title"), P.every(F.col("html"), rank).alias("rank"))
    return pages.select("page_id", F.posexplode(pairs).alias("pos", "pair")).select(
        "page_id", "pos", F.col("pair.title").alias("title"), whole_number(tidy(F.col("pair.rank"), RANK_EDGES)).alias("rank")
    )


def _score(url: Column, at: int) -> Column:
    """Score, distribution and review link of the ``at``-th block; NULL fields when it is missing."""
    block = F.get("scores", F.lit(at))
    return F.struct(
        block["score"].alias("score"),
        F.struct(*[block[kind].alias(kind) for kind in ("positive", "mixed", "negative")]).alias("distri"),
        absolute(block["link"], url).alias("review_link"),
    )


def page_scores(pages: DataFrame, spec: dict = P.MOVIE) -> DataFrame:
    """(page_id, meta_score, user_score) of each page."""
    found = extract(pages, {"scores": spec["scores"]})
    return found.select("page_id", _score(F.col("url"), 0).alias("meta_score"), _score(F.col("url"), 1).alias("user_score"))


def movie_records(pages: DataFrame, ranks: DataFrame | None = None, spec: dict = P.MOVIE) -> DataFrame:
    """Movie pages as nested records, with ``info.id`` from the listing's (title, rank), or -1.

    A page that is stored twice gives two records of one id.
    """
    found = extract(pages, spec).withColumn("rating", F.coalesce("rating", F.lit(UNRATED)))
    if ranks is None:
        ranked = found.withColumn("rank", F.lit(-1).cast("long"))
    else:
        ranks_of = assign_ranks(found.select("page_id", "title").distinct(), ranks, "page_id")
        ranked = found.join(ranks_of.groupBy("page_id").agg(F.max("rank").alias("rank")), "page_id")
    info = F.struct(
        F.col("rank").alias("id"), "title", "distributor", "date", "starring", "summary", "director", "genres",
        "rating", "runtime", "awards", "stream_link", "image",
    )
    return ranked.select(info.alias("info"), _score(F.col("url"), 0).alias("meta_score"), _score(F.col("url"), 1).alias("user_score"))


def _reviews(pages: DataFrame, spec: dict, kind: str, score: str) -> DataFrame:
    found = extract(pages, spec).withColumnRenamed("score", score)
    return found.select(F.lit(kind).alias("review_type"), "release_date", "movie_name", score, F.explode("reviews").alias("block"))


def critic_reviews(pages: DataFrame, spec: dict = P.CRITICS) -> DataFrame:
    """One row per critic review with a body; the page's own fields are repeated on each."""
    rows = _reviews(pages, spec, CRITIC, "meta_score")
    return rows.select("*", "block.review_score", "block.review").drop("block").where(F.col("review").isNotNull())


def user_reviews(pages: DataFrame, spec: dict = P.USERS) -> DataFrame:
    """One row per user review with an author: plain name or linked, body expanded or short."""
    rows = _reviews(pages, spec, USER, "user_review_score")
    return rows.select("*", "block.reviewer_name", "block.review_score", "block.review").drop("block").where(F.col("reviewer_name").isNotNull())


def review_feed(critics: DataFrame, users: DataFrame) -> DataFrame:
    """Both kinds in one feed; a field the other kind lacks is NULL."""
    return critics.unionByName(users, allowMissingColumns=True)


def page_links(pages: DataFrame, pattern: str = P.ANY_LINK) -> DataFrame:
    """(page_id, url, href): every link of every page that fits the pattern."""
    return pages.select("page_id", "url", F.explode(P.every(F.col("html"), pattern)).alias("href"))


def next_pages(pages: DataFrame, pattern: str = P.NEXT_PAGE) -> DataFrame:
    """(page_id, url, next_url): the following page, NULL on the last."""
    return pages.select("page_id", "url", absolute(P.first(F.col("html"), pattern), F.col("url")).alias("next_url"))


def resolve_links(links: DataFrame) -> DataFrame:
    """Add ``abs_url``, the link resolved against its page."""
    return links.withColumn("abs_url", absolute(F.col("href"), F.col("url")))


def allowed(links: DataFrame, domains: list[str], column: str = "abs_url") -> DataFrame:
    return links.where(in_domains(F.col(column), domains))


def frontier(links: DataFrame, fetched: DataFrame) -> DataFrame:
    """(abs_url): distinct pages not fetched yet, without fragments and other schemes than http and https.

    Equal links are combined before they are shuffled.
    """
    wanted = links.select(page_address(F.col("abs_url")).alias("abs_url")).where(F.col("abs_url").isNotNull()).distinct()
    return wanted.join(fetched.select(page_address(F.col("url")).alias("abs_url")), "abs_url", "left_anti")
