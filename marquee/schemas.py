"""Explicit schemas of the files and tables; nothing is inferred at read time."""

from __future__ import annotations

from pyspark.sql import types as T

_text = T.StringType()
_texts = T.ArrayType(T.StringType())


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


SCORE = _struct(
    score=_text,
    distri=_struct(positive=_text, mixed=_text, negative=_text),
    review_link=_text,
)

INFO = _struct(
    id=T.LongType(),
    title=_text,
    distributor=_text,
    date=_text,
    starring=_texts,
    summary=_text,
    director=_texts,
    genres=_texts,
    rating=_text,
    runtime=_text,
    awards=_texts,
    stream_link=_texts,
    image=_text,
)

# One nested record per movie. The crawl's flat form has the INFO fields at top level.
CATALOG = _struct(info=INFO, meta_score=SCORE, user_score=SCORE)
CATALOG_FLAT = T.StructType(INFO.fields + CATALOG.fields[1:])
CATALOG_EITHER = T.StructType(CATALOG.fields + INFO.fields)

# Critic and user reviews share one feed; fields of the other kind are NULL.
REVIEWS = _struct(
    review_type=_text,
    release_date=_text,
    movie_name=_text,
    meta_score=_text,
    user_review_score=_text,
    reviewer_name=_text,
    review_score=_text,
    review=_text,
)

CLEANED = _struct(
    release_date=_text,
    movie_name=_text,
    review_type=_text,
    reviewer_name=_text,
    review_score=_text,
    review=_text,
    review_clean=_text,
    sentiment_score=T.DecimalType(4, 3),
)

PAGES = _struct(page_id=T.LongType(), url=_text, html=_text)

_score = T.DecimalType(3, 1)
_polarity = T.DecimalType(4, 3)
_id = T.LongType()

TABLES = {
    "movies": _struct(
        movie_id=_id,
        title=_text,
        release_date=T.DateType(),
        distributor=_text,
        ratings=_text,
        runtime=T.IntegerType(),
        summary=_text,
        m_u_score=_score,
        m_c_score=_score,
        image=_text,
    ),
    "directors": _struct(director_id=_id, name=_text),
    "actors": _struct(actor_id=_id, name=_text),
    "genres": _struct(genre_id=_id, genre_type=_text),
    "stream_links": _struct(movie_id=_id, url=_text),
    "user_reviews": _struct(
        review_id=_id, u_c_review=_text, u_review=_text, username=_text, u_score=_score, polarity=_polarity
    ),
    "critic_reviews": _struct(critic_id=_id, c_c_review=_text, c_review=_text, c_score=_score, polarity=_polarity),
    "directed": _struct(movie_id=_id, director_id=_id),
    "plays_in": _struct(movie_id=_id, actor_id=_id),
    "movie_genre": _struct(movie_id=_id, genre_id=_id),
    "reviews": _struct(movie_id=_id, review_id=_id),
    "critique": _struct(movie_id=_id, critic_id=_id),
}

PRIMARY_KEYS = {
    "movies": ["movie_id"],
    "directors": ["director_id"],
    "actors": ["actor_id"],
    "genres": ["genre_id"],
    "stream_links": ["movie_id", "url"],
    "user_reviews": ["review_id"],
    "critic_reviews": ["critic_id"],
    "directed": ["movie_id", "director_id"],
    "plays_in": ["movie_id", "actor_id"],
    "movie_genre": ["movie_id", "genre_id"],
    "reviews": ["movie_id", "review_id"],
    "critique": ["movie_id", "critic_id"],
}

# (child table, column, parent table); the column has the same name on both sides.
FOREIGN_KEYS = [
    ("stream_links", "movie_id", "movies"),
    ("directed", "movie_id", "movies"),
    ("directed", "director_id", "directors"),
    ("plays_in", "movie_id", "movies"),
    ("plays_in", "actor_id", "actors"),
    ("movie_genre", "movie_id", "movies"),
    ("movie_genre", "genre_id", "genres"),
    ("reviews", "movie_id", "movies"),
    ("reviews", "review_id", "user_reviews"),
    ("critique", "movie_id", "movies"),
    ("critique", "critic_id", "critic_reviews"),
]

MAX_LENGTHS = {
    "movies": {"distributor": 100, "ratings": 16, "image": 256},
    "directors": {"name": 64},
    "actors": {"name": 64},
    "genres": {"genre_type": 32},
    "stream_links": {"url": 512},
    "user_reviews": {"username": 64},
}
