"""Named queries: each takes (spark, folder) and returns a DataFrame over whole tables."""

from __future__ import annotations

from collections.abc import Callable
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import fields as P
from ..functions import links as L
from ..functions import text as X
from ..functions import values as V
from ..functions.markup import Field, Group
from ..functions.sentiment import label, polarity
from ..operators import checks, lists, matching, numbering, pages, similar, stats
from ..operators.crawl import SeenPages
from ..operators.register import KeyRegister
from ..plans import detail, lookup, search
from ..plans.indexes import TextIndex
from ..plans.model import build_model, model_summary, movies_table
from ..plans.reviews import clean_reviews, distinct_values
from ..schemas import TABLES as SCHEMAS
from ..session import materialise, remove_folder, shared_folder
from ..sources import readers, splits, writers
from ..sources.readers import flatten, json_field
from ..sources.snapshots import Snapshots
from . import tables as A
from .tables import Given, GivenModel

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(build: Callable[[Given], DataFrame]) -> Callable[[Given], DataFrame]:
    QUERIES[build.__name__] = lambda spark, folder: build(Given(spark, folder))
    return build


# Values the reader of a lookup or a search asks for.
TITLE = "Small Ring"
TAG = "ring"
PERSON = "supplier#000000007"
DISTRIBUTOR = "BRAND#12"
SOURCE = "src7"
SIMILAR_TITLE = "red widget"
NEXT_TEXT = "and"
ALLOWED_DOMAINS = ["example.com"]


# Text


@query
def normalise_text(t: Given) -> DataFrame:
    return t.documents.select("doc_id", X.tidy(X.normalise(F.col("text"))).alias("t"))


@query
def tokenise(t: Given) -> DataFrame:
    tokens = t.documents.select("doc_id", F.explode(X.tokenise(X.normalise(F.col("text")))).alias("token"))
    return tokens.groupBy("doc_id", "token").agg(F.count("*").alias("n"))


@query
def clean_text(t: Given) -> DataFrame:
    return t.documents.select("doc_id", X.clean(F.col("text")).alias("review_clean"))


@query
def sentiment_doc(t: Given) -> DataFrame:
    return t.documents.select("doc_id", polarity(F.col("text")).alias("polarity"))


@query
def sentiment_label(t: Given) -> DataFrame:
    scored = t.documents.select("doc_id", polarity(F.col("text")).alias("polarity"))
    return scored.where(F.col("polarity").isNotNull()).select("doc_id", label(F.col("polarity")).alias("label"))


@query
def sentiment_verdict(t: Given) -> DataFrame:
    scored = t.documents.select("source", polarity(F.col("text")).alias("polarity"))
    return stats.item_sentiment(scored, "source").drop("polarity_sum")


@query
def movie_sentiment(t: Given) -> DataFrame:
    return lookup.movie_sentiment(GivenModel(t)).drop("polarity_sum")


@query
def review_stats(t: Given) -> DataFrame:
    scored = A.review_type(t).select(
        "review_type",
        polarity(F.col("text")).alias("sentiment_score"),
        V.number((F.col("n_chars") % 101).cast("string")).alias("score"),
    )
    result = stats.review_statistics(scored)
    return result.withColumns({name: F.round(name, 6) for name in ("avg_sentiment", "avg_score")})


@query
def label_distribution(t: Given) -> DataFrame:
    scored = t.documents.select("source", polarity(F.col("text")).alias("polarity"))
    return stats.score_distribution(scored, "source")


@query
def review_projection(t: Given) -> DataFrame:
    return t.documents.select("doc_id", "lang", "source")


# Values


@query
def parse_date(t: Given) -> DataFrame:
    date = V.page_date(F.col("date_text"))
    return A.page_date_text(t).select("o_orderkey", V.iso_date(date).alias("d"), date.isNull().alias("is_undated"))


@query
def parse_score(t: Given) -> DataFrame:
    text = F.when(F.col("p_size") % 7 == 0, "tbd").otherwise((F.col("p_size") * 2).cast("string"))
    return t.part.select(
        "p_partkey",
        V.critic_score(text).alias("score10"),
        V.whole_number(text).alias("whole"),
        F.round(V.number(text) / 7, 3).alias("rounded"),
    )


@query
def parse_minutes(t: Given) -> DataFrame:
    runtime = F.when(F.col("p_size") % 5 != 0, F.concat(F.col("p_size").cast("string"), F.lit(" min")))
    return t.part.select("p_partkey", V.minutes(runtime).alias("minutes"))


@query
def host_of_url(t: Given) -> DataFrame:
    return t.pages.select("page_id", L.link_host(F.col("url")).alias("host"))


@query
def na_labels(t: Given) -> DataFrame:
    first = GivenModel(t)["directed"].groupBy("movie_id").agg(F.min("director_id").alias("s_suppkey"))
    named = first.join(t.supplier.select("s_suppkey", F.col("s_name").alias("supplier")), "s_suppkey", "left")
    rows = t.part.join(named.withColumnRenamed("movie_id", "p_partkey"), "p_partkey", "left")
    rows = rows.select("p_partkey", F.nullif(F.col("p_brand"), F.lit("Brand#12")).alias("brand"), "supplier")
    return search.display_labels(rows, ["brand", "supplier"])


@query
def tag_normalise(t: Given) -> DataFrame:
    spelled = F.replace(F.replace("p_name", F.lit("small"), F.lit("Sci-Fi")), F.lit("red"), F.lit("Film-Noir"))
    body = F.concat(F.lit('<span class="blurb blurb_expanded">'), spelled, F.lit("<br></span> "))
    return t.part.select(F.col("p_partkey").alias("id"), X.fold_tags(X.strip_markup(body)).alias("tag"))


@query
def json_fields(t: Given) -> DataFrame:
    return t.events.select("event_id", json_field(F.col("props"), "k", T.LongType()).alias("k"))


@query
def nested_flatten(t: Given) -> DataFrame:
    flat = flatten(A.records(t))
    return flat.select("id", "title", F.array_join("genres", ",").alias("genres"), "meta_score_score", "user_score_score")


# Model


@query
def explode_distinct(t: Given) -> DataFrame:
    values = distinct_values(A.records(t))
    rows = None
    for kind, names in values.items():
        part = names.select(F.lit(kind).alias("kind"), "name")
        rows = part if rows is None else rows.unionByName(part)
    return rows


@query
def dim_keys(t: Given) -> DataFrame:
    return GivenModel(t)["genres"]


@query
def bridge(t: Given) -> DataFrame:
    return GivenModel(t)["movie_genre"].select(F.col("movie_id").alias("p_partkey"), "genre_id")


@query
def review_keys(t: Given) -> DataFrame:
    documents = t.documents.select(F.lit("documents").alias("src"), F.col("doc_id").alias("id"), F.length("text").alias("text_len"))
    turns = t.conversations.select(
        F.lit("conversations").alias("src"), F.col("conv_id").alias("id"), "turn", F.length("text").alias("text_len")
    )
    feed = pages.review_feed(documents, turns)
    return numbering.number_rows(feed, "review_id", ["src", "id", F.col("turn").asc_nulls_first()]).select(
        "review_id", "src", "id", "turn", "text_len"
    )


@query
def pk_violations(t: Given) -> DataFrame:
    return checks.duplicate_keys(t.lineitem, ["l_orderkey", "l_linenumber"])


@query
def fk_orphans(t: Given) -> DataFrame:
    return checks.orphans(t.documents, t.labels, "doc_id")


@query
def length_violations(t: Given) -> DataFrame:
    return checks.too_long(t.pages.select("page_id", "url"), "url", 40).select("page_id", "n")


@query
def range_violations(t: Given) -> DataFrame:
    return checks.out_of_range(t.customer.select("c_custkey", "c_acctbal"), "c_acctbal", "decimal(5,2)")


@query
def model_checks(t: Given) -> DataFrame:
    return checks.check_model(GivenModel(t))


def _orders_as_catalog(orders: DataFrame) -> DataFrame:
    return orders.select(
        F.col("o_orderkey").alias("movie_id"),
        F.col("o_custkey").alias("title"),
        F.to_date("o_orderdate").alias("date"),
        F.col("o_orderkey").alias("position"),
    )


def _lines_as_reviews(t: Given) -> DataFrame:
    lines = t.lineitem.select("l_orderkey", "l_linenumber").distinct()
    orders = t.orders.select(
        F.col("o_orderkey").alias("l_orderkey"),
        F.col("o_custkey").alias("title"),
        F.when(F.col("o_orderstatus") != "P", F.to_date("o_orderdate")).alias("date"),
    )
    return lines.join(orders, "l_orderkey")


@query
def match_review(t: Given) -> DataFrame:
    matched = matching.match_reviews(_lines_as_reviews(t), _orders_as_catalog(t.orders), ["l_orderkey", "l_linenumber"])
    return matched.select("l_orderkey", "l_linenumber", F.col("movie_id").alias("matched_orderkey"))


@query
def match_unmatched(t: Given) -> DataFrame:
    title = F.when(F.col("o_orderstatus") == "F", F.col("o_custkey")).otherwise(-1 - F.col("o_custkey"))
    renamed = _orders_as_catalog(t.orders.withColumn("o_custkey", title))
    matched = matching.match_reviews(_lines_as_reviews(t), renamed, ["l_orderkey", "l_linenumber"])
    return matched.where(F.col("movie_id").isNull()).select("l_orderkey", "l_linenumber")


@query
def rank_lookup(t: Given) -> DataFrame:
    listed = F.when(F.col("p_type") == "PROMO", F.col("p_name")).otherwise(F.concat("p_name", F.lit(" II")))
    ranks = t.part.groupBy(listed.alias("title")).agg(F.max("p_partkey").alias("rank"))
    movies = t.part.select("p_partkey", F.col("p_name").alias("title"))
    return matching.assign_ranks(movies, ranks, "p_partkey").select("p_partkey", "rank")


@query
def star_schema(t: Given) -> DataFrame:
    """Every bridge of the built model with names in place of keys; reviews of no movie are in no bridge."""
    model = build_model(A.records(t), A.cleaned(t))
    rows = []
    for name, dim, link, key, column in search.LISTS:
        rows.append(model[link].join(model[dim], key).select(F.lit(link).alias("link"), "movie_id", F.col(column).alias("value")))
    users = model["reviews"].join(model["user_reviews"], "review_id")
    rows.append(users.select(F.lit("reviews").alias("link"), "movie_id", F.col("username").alias("value")))
    critics = model["critique"].join(model["critic_reviews"], "critic_id")
    rows.append(critics.select(F.lit("critique").alias("link"), "movie_id", F.md5("c_review").alias("value")))
    rows.append(model["stream_links"].select(F.lit("stream_links").alias("link"), "movie_id", F.col("url").alias("value")))
    result = rows[0]
    for part in rows[1:]:
        result = result.unionByName(part)
    return result


@query
def star_movies(t: Given) -> DataFrame:
    return movies_table(A.records(t))


@query
def model_counts(t: Given) -> DataFrame:
    return model_summary(build_model(A.records(t), A.cleaned(t)))


# Lookups


@query
def table_counts(t: Given) -> DataFrame:
    model = GivenModel(t)
    return stats.table_counts({name: model[name] for name in ("movies", "actors", "directors", "user_reviews", "critique")})


@query
def names_of_item(t: Given) -> DataFrame:
    return _names(t, lists.PAGE).select("p_partkey", "names")


@query
def names_paged(t: Given) -> DataFrame:
    return _names(t, 10).select("p_partkey", "page", "names")


def _names(t: Given, limit: int) -> DataFrame:
    model = GivenModel(t)
    items = t.part.select(F.col("p_partkey").alias("movie_id"))
    rows = lists.names_per_item(items, model["plays_in"], model["actors"], "movie_id", "actor_id", "name", limit)
    return rows.withColumnRenamed("movie_id", "p_partkey")


@query
def names_of_title(t: Given) -> DataFrame:
    return lookup.names_of_title(GivenModel(t), TITLE, "director").select("num", "director_id", "name")


@query
def items_of_name(t: Given) -> DataFrame:
    return _as_parts(lookup.movies_of_name(GivenModel(t), PERSON, "actor"))


@query
def items_of_tag(t: Given) -> DataFrame:
    return _as_parts(lookup.movies_of_name(GivenModel(t), TAG, "genre", count=25))


@query
def items_by_brand(t: Given) -> DataFrame:
    return _as_parts(lookup.movies_of_distributor(GivenModel(t), DISTRIBUTOR, count=20))


def _as_parts(rows: DataFrame) -> DataFrame:
    return rows.select("num", F.col("movie_id").alias("p_partkey"), F.col("title").alias("p_name"))


@query
def reviews_of_item(t: Given) -> DataFrame:
    rows = t.documents.where(F.col("source") == SOURCE).select("doc_id", polarity(F.col("text")).alias("polarity"))
    return numbering.number_rows(rows, "num", [F.col("polarity").desc_nulls_last(), "doc_id"])


@query
def user_reviews_of_title(t: Given) -> DataFrame:
    return lookup.user_reviews_of_title(GivenModel(t), TITLE).select("num", "review_id", "username", "u_score", "polarity")


@query
def critic_reviews_of_title(t: Given) -> DataFrame:
    return lookup.critic_reviews_of_title(GivenModel(t), TITLE).select("num", "critic_id", "c_score", "polarity")


@query
def genre_list(t: Given) -> DataFrame:
    return lookup.genre_list(GivenModel(t))


@query
def image_links(t: Given) -> DataFrame:
    first = lookup.id_of_title(GivenModel(t)["movies"]).select("movie_id")
    return GivenModel(t)["movies"].join(first, "movie_id", "left_semi").select("movie_id", "image")


@query
def id_title_lookup(t: Given) -> DataFrame:
    return lookup.id_of_title(GivenModel(t)["movies"]).select("title", F.col("movie_id").alias("first_id"))


@query
def title_of_id(t: Given) -> DataFrame:
    """Titles of the parts that documents ask for by number, NULL where there is no such part."""
    asked = t.documents.select(F.col("doc_id").alias("movie_id"))
    return asked.join(GivenModel(t)["movies"].select("movie_id", "title"), "movie_id", "left")


@query
def title_positions(t: Given) -> DataFrame:
    """Every title with its first place in the catalogue, and the title found at that place."""
    placed = lookup.positions(t.part.select(F.col("p_partkey").alias("movie_id"), F.col("p_name").alias("title")))
    first = placed.groupBy("title").agg(F.min("index").alias("index"))
    return first.join(placed.select("index", F.col("title").alias("found")), "index").select("title", "index", "found")


@query
def links_of_movies(t: Given) -> DataFrame:
    links = GivenModel(t)["stream_links"]
    return links.select("movie_id", "url", L.link_host(F.col("url")).alias("host"))


@query
def clean_feed(t: Given) -> DataFrame:
    feed = A.cleaned(t).select("review_id", *(c for c in ("release_date", "movie_name", "review_type", "reviewer_name", "review_score", "review")))
    cleaned = clean_reviews(feed.withColumn("reviewer_name", F.col("review_id").cast("string")))
    return cleaned.select("reviewer_name", "movie_name", "release_date", "review_type", "review_score", "review_clean", "sentiment_score")


# Search


@query
def keyword_check(t: Given) -> DataFrame:
    return t.conversations.select("conv_id", "turn", search.is_keyword(F.col("text")).alias("ok"))


def _search(field: str, keyword: str) -> Callable[[Given], DataFrame]:
    def run(t: Given) -> DataFrame:
        rows = search.search(GivenModel(t), field, keyword)
        return rows.select(
            "num", "movie_id", "page", "title", "release_date", "distributor", "directors", "actors", "genres",
            "ratings", "runtime", "m_c_score", "m_u_score", "summary", "image",
        )

    run.__name__ = f"search_{field}"
    return query(run)


SEARCHED = {"title": "SMALL", "actor": "#00000001", "director": "00000000", "genre": "Ring", "distributor": "brand#1"}
for _field, _keyword in SEARCHED.items():
    _search(_field, _keyword)


@query
def search_order(t: Given) -> DataFrame:
    result = None
    for order in search.ORDERS:
        rows = search.ordered(GivenModel(t)["movies"], order)
        rows = rows.select(F.lit(order).alias("sorted_by"), F.col("num").alias("rank"), F.col("movie_id").alias("p_partkey"))
        result = rows if result is None else result.unionByName(rows)
    return result


@query
def search_count(t: Given) -> DataFrame:
    model = GivenModel(t)
    return stats.table_counts({field: search.found_movies(model, field, word) for field, word in SEARCHED.items()})


@query
def text_search(t: Given) -> DataFrame:
    texts = {
        "documents": t.documents.select(F.col("doc_id").alias("id"), "text"),
        "conversations": t.conversations.select(F.col("conv_id").alias("id"), "text"),
        "benchmark": t.benchmark.select(F.col("item_id").alias("id"), "text"),
    }
    return search.text_search(texts, "The").select("source", "id", "text")


@query
def feed_union(t: Given) -> DataFrame:
    users = t.conversations.where(F.col("role") == "user").select(
        F.lit("User Review").alias("review_type"), "conv_id", "turn", F.col("role").alias("reviewer")
    )
    critics = t.conversations.where(F.col("role") != "user").select(
        F.lit("Critic Review").alias("review_type"), "conv_id", "turn"
    )
    return pages.review_feed(critics, users)


# Similarity


def _tagged(t: Given) -> DataFrame:
    return A.part_items(t).select(F.col("p_partkey").alias("item"), F.col("p_name").alias("title"), "tags")


@query
def idf(t: Given) -> DataFrame:
    weights = similar.idf(similar.tag_sets(similar.with_tag_key(_tagged(t))))
    return weights.select("token", "df", F.round(F.col("idf").cast("double"), 6).alias("idf"))


@query
def tfidf(t: Given) -> DataFrame:
    return similar.tfidf(_tagged(t), "item").withColumn("weight", F.round("weight", 6))


@query
def cosine(t: Given) -> DataFrame:
    return similar.cosine_to(_tagged(t), "item", F.col("title") == SIMILAR_TITLE).withColumn("score", F.round("score", 6))


@query
def similar_title(t: Given) -> DataFrame:
    same = F.col("title") == SIMILAR_TITLE
    rows = similar.similar_to(_tagged(t), "item", same, exclude=same)
    return rows.withColumn("score", F.round("score", 6))


@query
def similar_topk(t: Given) -> DataFrame:
    return similar.similar_top(_tagged(t), "item").withColumn("score", F.round("score", 6))


@query
def similar_wide(t: Given) -> DataFrame:
    items = A.cast_items(t).withColumnRenamed("p_partkey", "item")
    return similar.similar_top(items, "item").withColumn("score", F.round("score", 6))


@query
def detail_wide(t: Given) -> DataFrame:
    rows = detail.similar_titles(A.cast_model(t))
    ids = F.transform("similar", lambda entry: entry["movie_id"].cast("string"))
    return rows.select("movie_id", F.array_join(ids, "|").alias("similar"))


@query
def detail_flat(t: Given) -> DataFrame:
    documents = detail.detail(GivenModel(t))

    def joined(column: str, field: str) -> Column:
        return F.array_join(F.transform(column, lambda entry: entry[field].cast("string")), "|", "-").alias(f"{column}_{field}")

    return documents.select(
        "movie_id", "page", "title", "directors", "actors", "genres", "m_u_score", "m_c_score",
        joined("links", "host"), joined("similar", "movie_id"), joined("critic_reviews", "label"),
        joined("user_reviews", "reviewer"), joined("user_reviews", "polarity"),
    )


# Pages


@query
def page_fields(t: Given) -> DataFrame:
    html = F.col("html")
    return t.pages.select(
        "page_id",
        P.first(html, r"<title>([^<]*)</title>").alias("title"),
        F.coalesce(P.first(html, r"<h1>([^<]*)</h1>"), P.first(html, r"<title>([^<]*)</title>")).alias("h1"),
        F.size(P.every(html, r"<a href=\"([^\"]*)\"")).alias("n_links"),
    )


# The given pages in the roles of movie and review pages.
GIVEN_MOVIE = P.MOVIE | {
    "title": Field(("article h1", "title")),
    "distributor": Field(("title",)),
    "starring": Field(("nav li a",), many=True),
    "summary": Field((".ad",)),
    "stream_link": Field(("nav li a@href",), many=True),
    "scores": Group("nav li", P.SCORE | {"score": Field(("a",)), "link": Field(("a@href",))}),
}
GIVEN_CRITICS = P.CRITICS | {"movie_name": Field(("title",)), "reviews": Group("nav li", {"review_score": Field(("i",)), "review": Field(("a",))})}
GIVEN_USERS = P.USERS | {
    "movie_name": Field(("title",)),
    "reviews": Group("nav li", {"reviewer_name": Field(("a@href",)), "review_score": Field(("i",)), "review": Field(("a",))}),
}


@query
def page_records(t: Given) -> DataFrame:
    titles = pages.extract(t.pages, {"title": GIVEN_MOVIE["title"]}).where(F.col("title").isNotNull())
    ranks = titles.groupBy("title").agg(F.max("page_id").alias("rank"))
    info = pages.movie_records(t.pages, ranks, GIVEN_MOVIE).select("info.*")
    lists = (F.array_join(name, "|").alias(name) for name in ("starring", "stream_link"))
    return info.select("id", "title", "distributor", "summary", "rating", *lists)


@query
def page_scores(t: Given) -> DataFrame:
    rows = pages.page_scores(t.pages, GIVEN_MOVIE)
    return rows.select("page_id", F.col("meta_score.score").alias("first"), F.col("user_score.score").alias("second"), F.col("meta_score.review_link").alias("link"))


@query
def page_reviews(t: Given) -> DataFrame:
    feed = pages.review_feed(pages.critic_reviews(t.pages, GIVEN_CRITICS), pages.user_reviews(t.pages, GIVEN_USERS))
    return feed.select("review_type", "movie_name", "reviewer_name", "review")


@query
def page_blocks(t: Given) -> DataFrame:
    blocks = t.pages.select("page_id", F.posexplode(P.every(F.col("html"), r"(?s)<p>(.*?)</p>")).alias("pos", "body"))
    return blocks.select("page_id", "pos", X.tidy(F.col("body")).alias("paragraph")).where(F.col("paragraph") != "")


@query
def page_pairs(t: Given) -> DataFrame:
    entry = r'<li><a href="[^"]*">([^<]*)</a></li>'
    pairs = F.arrays_zip(
        P.every(F.col("html"), r'<li><a href="([^"]*)">').alias("href"), P.every(F.col("html"), entry).alias("text")
    )
    return t.pages.select("page_id", F.posexplode(pairs).alias("pos", "pair")).select(
        "page_id", "pos", F.col("pair.href").alias("href"), F.col("pair.text").alias("text")
    )


@query
def page_links(t: Given) -> DataFrame:
    return pages.page_links(t.pages).select("page_id", "href")


@query
def resolve_links(t: Given) -> DataFrame:
    return pages.resolve_links(pages.page_links(t.pages)).select("page_id", "abs_url")


@query
def link_domains(t: Given) -> DataFrame:
    kept = pages.allowed(pages.resolve_links(pages.page_links(t.pages)), ALLOWED_DOMAINS)
    return kept.groupBy(L.host(F.col("abs_url")).alias("host")).agg(F.count("*").alias("n"))


@query
def frontier(t: Given) -> DataFrame:
    return pages.frontier(pages.resolve_links(pages.page_links(t.pages)), t.pages)


@query
def next_pages(t: Given) -> DataFrame:
    return pages.next_pages(t.pages, rf'<a href="([^"]*)">{NEXT_TEXT}</a>').select("page_id", "next_url")


@query
def listing_pairs(t: Given) -> DataFrame:
    return pages.listing_ranks(t.pages, title=r'<li><a href="[^"]*">([^<]*)</a></li>', rank=r"track\((\d+)\)")


# Stored tables: each query builds its own under a name of its own, and drops it when its answers are settled.


def own_name(kind: str) -> str:
    return f"{kind}_{uuid4().hex}"


@query
def file_order_keys(t: Given) -> DataFrame:
    return numbering.number_in_order(t.documents.select("doc_id"), "review_id")


INDEXED_WORDS = ("SMALL", "ring", "re", "d w", "II")
INDEXED_PHRASES = ("of the", "and, the", "ing th", "The")


@query
def indexed_titles(t: Given) -> DataFrame:
    """Titles found by trigrams, before and after a batch renames some."""
    index = TextIndex(t.spark, own_name("titles"))
    renamed = F.concat("p_name", F.lit(" II"))

    def found(state: str) -> DataFrame:
        result = None
        for word in INDEXED_WORDS:
            rows = index.containing(word).select(
                F.lit(state).alias("state"), F.lit(word).alias("keyword"), F.col("key").alias("movie_id"), F.col("text").alias("title")
            )
            result = rows if result is None else result.unionByName(rows)
        return materialise(result)

    try:
        index.add(t.part.select(F.col("p_partkey").alias("key"), F.col("p_name").alias("text")))
        before = found("before")
        index.add(t.part.where("p_size > 25").select(F.col("p_partkey").alias("key"), renamed.alias("text")))
        return before.unionByName(found("after"))
    finally:
        index.drop()


@query
def phrase_search(t: Given) -> DataFrame:
    """Phrases in all texts by word positions, and the same keywords by trigrams."""
    feed = (
        t.documents.select(F.lit("documents").alias("source"), F.col("doc_id").alias("id"), F.lit(0).cast("long").alias("turn"), "text")
        .unionByName(t.conversations.select(F.lit("conversations").alias("source"), F.col("conv_id").alias("id"), "turn", "text"))
        .unionByName(t.benchmark.select(F.lit("benchmark").alias("source"), F.col("item_id").alias("id"), F.lit(0).cast("long").alias("turn"), "text"))
    )
    index, result = TextIndex(t.spark, own_name("texts")), None
    try:
        index.add(feed.withColumn("key", F.xxhash64("source", "id", "turn")))
        for phrase in INDEXED_PHRASES:
            for how, rows in (("words", index.phrase(phrase)), ("trigrams", index.containing(phrase))):
                rows = rows.select(F.lit(how).alias("how"), F.lit(phrase).alias("phrase"), "source", "id", "turn")
                result = rows if result is None else result.unionByName(rows)
        return materialise(result)
    finally:
        index.drop()


@query
def key_register(t: Given) -> DataFrame:
    """Keys of names after a first load, a second one with all names, and the second one again."""
    register, result = KeyRegister(t.spark, own_name("names")), None
    try:
        for number, names in enumerate((t.supplier.where("s_nationkey % 2 = 0"), t.supplier, t.supplier), 1):
            rows = materialise(register.load(names, "s_name").select(F.lit(number).alias("load"), "name", "key"))
            result = rows if result is None else result.unionByName(rows)
        return result
    finally:
        register.drop()


@query
def snapshot_model(t: Given) -> DataFrame:
    """Row counts of all tables as a reader sees them that began before a second commit, and as a later one does."""
    model, snapshots = GivenModel(t), Snapshots(t.spark, f"{shared_folder(t.spark)}/{own_name('model')}")

    def counted(reader: str, tables: dict[str, DataFrame]) -> DataFrame:
        return stats.table_counts(tables | {"long_movies": tables["movies"].where("runtime > 25")}).withColumn("reader", F.lit(reader))

    try:
        snapshots.commit({name: model[name] for name in SCHEMAS})
        early = snapshots.read()
        longer = early["movies"].withColumn("runtime", F.col("runtime") + 10)
        snapshots.commit({"movies": longer, "stream_links": early["stream_links"].where("movie_id % 2 = 0")})
        return materialise(counted("early", early).unionByName(counted("late", snapshots.read())))
    finally:
        snapshots.drop()


@query
def split_files(t: Given) -> DataFrame:
    """Documents written as JSON arrays and as values with line breaks, and read back in splits."""
    folder = f"{shared_folder(t.spark)}/{own_name('files')}"
    docs = t.documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), F.struct("source", "lang").alias("origin"))
    flat = docs.select("doc_id", "text", "origin.source")
    writers.write_json_arrays(docs, f"{folder}/json")
    writers.write_tsv(flat, f"{folder}/tsv")
    nested = splits.read_json_arrays(t.spark, f"{folder}/json", docs.schema)
    values = splits.read_tables_of_values(t.spark, f"{folder}/tsv", flat.schema, **readers.TSV)
    read = nested.select(F.lit("json").alias("format"), "doc_id", F.coalesce("text", F.lit("")).alias("text"), "origin.source").unionByName(
        values.select(F.lit("tsv").alias("format"), "doc_id", F.coalesce("text", F.lit("")).alias("text"), "source")
    )
    try:
        return materialise(read)
    finally:
        remove_folder(t.spark, folder)


@query
def crawl_rounds(t: Given) -> DataFrame:
    """Pages that three rounds hand out, each round following the links of a third of the pages."""
    seen = SeenPages(t.spark, own_name("seen"))
    links = pages.resolve_links(pages.page_links(t.pages))
    try:
        seen.fetched(t.pages)
        for part in range(3):
            seen.next_round(links.where(F.col("page_id") % 3 == part))
        return materialise(seen.rows().where("round > 0"))
    finally:
        seen.drop()
