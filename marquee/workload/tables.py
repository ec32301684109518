"""The given tables in the roles of the catalogue: parts as movies, suppliers as people, documents as reviews."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import values as V
from ..functions.sentiment import polarity
from ..operators.pages import CRITIC, USER
from ..plans.model import dimension

class Given:
    """Reads the tables of one scale folder, each set up once."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder

    def __getattr__(self, table: str) -> DataFrame:
        if table.startswith("_"):
            raise AttributeError(table)
        rows = self.spark.read.parquet(f"{self.folder}/{table}.parquet")
        setattr(self, table, rows)
        return rows


def tags_of(name: Column) -> Column:
    return F.split(name, " ")


def page_date_text(given: Given) -> DataFrame:
    """Orders with their date as page text, ``TBA`` for pending ones."""
    text = F.when(F.col("o_orderstatus") == "P", "TBA").otherwise(F.date_format("o_orderdate", V.PAGE_DATE))
    return given.orders.withColumn("date_text", text)


def review_type(given: Given) -> DataFrame:
    """Documents with ``review_type``: critic when the document has a label, otherwise user."""
    labelled = given.labels.select("doc_id").distinct().withColumn("_labelled", F.lit(True))
    kind = F.when(F.col("_labelled"), CRITIC).otherwise(USER)
    return given.documents.join(labelled, "doc_id", "left").withColumn("review_type", kind).drop("_labelled")


def part_items(given: Given) -> DataFrame:
    return given.part.select("p_partkey", "p_name", tags_of(F.col("p_name")).alias("tags"))


def cast_items(given: Given) -> DataFrame:
    """Parts tagged with the names of all their suppliers."""
    named = _cast(given, "s_suppkey").join(given.supplier.select("s_suppkey", "s_name"), "s_suppkey")
    tags = named.groupBy(F.col("movie_id").alias("p_partkey")).agg(F.array_sort(F.collect_list("s_name")).alias("tags"))
    return given.part.select("p_partkey").join(tags, "p_partkey", "left")


def cast_model(given: Given) -> dict[str, DataFrame]:
    """What similar titles need of the model, with suppliers in the place of genres."""
    model = GivenModel(given)
    return {
        "movies": model["movies"],
        "genres": _people(given, "genre_id").withColumnRenamed("name", "genre_type"),
        "movie_genre": _cast(given, "genre_id"),
    }


def _movies(given: Given) -> DataFrame:
    shipped = given.lineitem.groupBy(F.col("l_partkey").alias("p_partkey")).agg(
        F.min(F.to_date("l_shipdate")).alias("release_date")
    )
    return given.part.join(shipped, "p_partkey", "left").select(
        F.col("p_partkey").alias("movie_id"),
        F.col("p_name").alias("title"),
        "release_date",
        F.col("p_brand").alias("distributor"),
        F.col("p_type").alias("ratings"),
        F.col("p_size").alias("runtime"),
        F.concat_ws(" ", "p_type", "p_brand").alias("summary"),
        (F.col("p_size") / 5).try_cast(V.SCORE_TYPE).alias("m_u_score"),
        (F.col("p_retailprice") / 100).try_cast(V.SCORE_TYPE).alias("m_c_score"),
        F.concat(F.lit("https://img.example.com/"), F.col("p_partkey").cast("string")).alias("image"),
    )


def _people(given: Given, key: str) -> DataFrame:
    return given.supplier.select(F.col("s_suppkey").alias(key), F.col("s_name").alias("name"))


def _cast(given: Given, key: str) -> DataFrame:
    return given.lineitem.select(F.col("l_partkey").alias("movie_id"), F.col("l_suppkey").alias(key)).distinct()


def _crew(given: Given, key: str) -> DataFrame:
    """The first supplier of a part for each return flag."""
    first = given.lineitem.groupBy(F.col("l_partkey").alias("movie_id"), "l_returnflag").agg(F.min("l_suppkey").alias(key))
    return first.select("movie_id", key).distinct()


def _reviews(given: Given, kind: str) -> DataFrame:
    return review_type(given).where(F.col("review_type") == kind)


BUILDERS: dict[str, Callable[[Given], DataFrame]] = {
    "movies": _movies,
    "actors": lambda given: _people(given, "actor_id"),
    "directors": lambda given: _people(given, "director_id"),
    "plays_in": lambda given: _cast(given, "actor_id"),
    "directed": lambda given: _crew(given, "director_id"),
    "stream_links": lambda given: given.pages.select(F.col("page_id").alias("movie_id"), "url"),
    "critic_reviews": lambda given: _reviews(given, CRITIC).select(
        F.col("doc_id").alias("critic_id"),
        F.col("text").alias("c_c_review"),
        F.col("text").alias("c_review"),
        V.critic_score((F.col("n_chars") % 100).cast("string")).alias("c_score"),
        polarity(F.col("text")).alias("polarity"),
    ),
    "user_reviews": lambda given: _reviews(given, USER).select(
        F.col("doc_id").alias("review_id"),
        F.col("text").alias("u_c_review"),
        F.col("text").alias("u_review"),
        F.col("source").alias("username"),
        V.user_score((F.col("n_chars") % 11).cast("string")).alias("u_score"),
        polarity(F.col("text")).alias("polarity"),
    ),
    "critique": lambda given: _reviews(given, CRITIC).select(
        F.col("doc_id").alias("movie_id"), F.col("doc_id").alias("critic_id")
    ),
    "reviews": lambda given: _reviews(given, USER).select(
        F.col("doc_id").alias("movie_id"), F.col("doc_id").alias("review_id")
    ),
}


class GivenModel(dict):
    """The relational model over the given tables; a table is set up when it is first asked for."""

    def __init__(self, given: Given) -> None:
        super().__init__()
        self.given = given

    def __missing__(self, table: str) -> DataFrame:
        if table in ("genres", "movie_genre"):
            lists = self.given.part.select(F.col("p_partkey").alias("movie_id"), tags_of(F.col("p_name")).alias("values"))
            self["genres"], self["movie_genre"] = dimension(lists, "movie_id", "values", "genre_id", "genre_type")
        else:
            self[table] = BUILDERS[table](self.given)
        return self[table]


def records(given: Given) -> DataFrame:
    """Parts as nested records, every field text or a list as on the pages."""
    size, none = F.col("p_size"), F.lit(None).cast("string")
    date = F.when(size % 7 == 0, "TBA").otherwise(
        F.date_format(F.date_add(F.lit("1995-01-01").cast("date"), size * 30), V.PAGE_DATE)
    )
    info = F.struct(
        F.col("p_partkey").alias("id"),
        F.col("p_name").alias("title"),
        F.col("p_brand").alias("distributor"),
        date.alias("date"),
        F.array(F.concat(F.lit("Actor "), size.cast("string")), F.col("p_type"), F.col("p_type")).alias("starring"),
        F.concat_ws(" ", "p_type", "p_brand").alias("summary"),
        F.array("p_brand").alias("director"),
        tags_of(F.col("p_name")).alias("genres"),
        F.col("p_type").alias("rating"),
        F.when(size % 5 != 0, F.concat(size.cast("string"), F.lit(" min"))).alias("runtime"),
        F.array().cast("array<string>").alias("awards"),
        F.array(F.concat(F.lit("https://play.example.com/"), F.col("p_partkey").cast("string"))).alias("stream_link"),
        F.concat(F.lit("https://img.example.com/"), F.col("p_partkey").cast("string")).alias("image"),
    )
    distri = F.struct(none.alias("positive"), none.alias("mixed"), none.alias("negative"))
    critic = F.struct((size * 2).cast("string").alias("score"), distri.alias("distri"), none.alias("review_link"))
    user = F.when(size % 7 == 0, "tbd").otherwise((size / 5).cast("string"))
    user = F.struct(user.alias("score"), distri.alias("distri"), none.alias("review_link"))
    return given.part.select(info.alias("info"), critic.alias("meta_score"), user.alias("user_score"))


def cleaned(given: Given) -> DataFrame:
    """Documents as cleaned reviews of the part with their key, some undated, some under an unknown title or none."""
    parts = records(given).select(F.col("info.id").alias("doc_id"), "info.title", "info.date")
    title = F.when(F.col("lang") == "es", F.concat(F.lit("Otra "), F.col("title"))).otherwise(F.col("title"))
    return review_type(given).join(parts, "doc_id", "left").select(
        F.col("doc_id").alias("review_id"),
        F.when(F.col("lang") != "fr", F.col("date")).alias("release_date"),
        title.alias("movie_name"),
        "review_type",
        F.concat_ws(" ", "source", F.col("doc_id").cast("string")).alias("reviewer_name"),
        (F.col("n_chars") % 10).cast("string").alias("review_score"),
        F.col("text").alias("review"),
        F.col("text").alias("review_clean"),
        polarity(F.col("text")).alias("sentiment_score"),
    )
