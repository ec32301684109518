from __future__ import annotations

import csv
import datetime
import json
import os
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from marquee.operators.checks import check_model
from marquee.plans import detail, lookup, search
from marquee.plans.model import build_model, model_summary
from marquee.plans.reviews import clean_reviews, distinct_values, of_type
from marquee.schemas import CLEANED, TABLES
from marquee.sources import readers, writers
from marquee.workload.tables import Given, GivenModel

GIVEN = "/root/testdata/sf0.001"


def info(id, title, date, starring=(), director=(), genres=(), links=(), **more):
    base = {
        "id": id, "title": title, "distributor": "Acme", "date": date, "starring": list(starring), "summary": f"About {title}",
        "director": list(director), "genres": list(genres), "rating": "R", "runtime": "126 min", "awards": [],
        "stream_link": list(links), "image": f"https://img.example.com/{id}.jpg",
    }
    return {**base, **more}


def score(value):
    return {"score": value, "distri": {"positive": "1", "mixed": None, "negative": None}, "review_link": None}


MOVIES = [
    (info(1, "Blue Harbor", "June 5, 2001", ["Ann Lee", "bo Ray"], ["Di Fox", "Di Fox"], ["Drama", "Sci-Fi"],
          ["https://play.example.org/1", "https://play.example.org/1", "https://tv.example.net/x"]), "87", "8.25"),
    (info(2, "Blue Harbor", "TBA", ["Ann Lee"], ["Cy Ode"], ["Drama"], runtime=None), "100", "tbd"),
    (info(3, "100% Wolf", "June 05, 2003", [], [], [], distributor=None, summary=None), "61", ""),
    (info(4, "100x Wolf", "May 1, 2003", ["Élan O'Hara"], ["Ann Lee"], ["Film-Noir", "Sci-Fi"]), "40", "4.0"),
    (info(5, "Quiet", None, ["Ann Lee"], ["Di Fox"], ["Drama", "Sci-Fi"], distributor="Blue Co"), "55", "5.5"),
]

REVIEWS = [
    ("Critic Review", "June 5, 2001", "Blue Harbor", None, "100", 'A "great"\tfilm,\nreally good'),
    ("Critic Review", "TBA", "Blue Harbor", None, "tbd", "Dull  text "),
    ("User Review", "June 5, 2001", "Blue Harbor", "ann", "9", "Not good \\ at all"),
    ("User Review", None, "Blue Harbor", "bo", "7", "I don't know"),
    ("User Review", "June 5, 2001", "Nowhere", "cy", "1", "awful"),
    ("User Review", "May 1, 2003", "100x Wolf", "dee", "", "..."),
    ("User Review", "May 1, 2003", "100x Wolf", "eve", "6", None),
    ("User Review", "June 9, 1999", "Quiet", "fay", "5", "fine"),
]


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    return tmp_path_factory.mktemp("data")


@pytest.fixture(scope="module")
def records(spark, folder):
    nested = [{"info": i, "meta_score": score(c), "user_score": score(u)} for i, c, u in MOVIES]
    path = folder / "movies.json"
    path.write_text(json.dumps(nested, indent=2))
    return readers.read_catalog(spark, str(path), one_array=True).cache()


@pytest.fixture(scope="module")
def cleaned(spark, folder):
    names = ["review_type", "release_date", "movie_name", "reviewer_name", "review_score", "review"]
    path = folder / "reviews.json"
    path.write_text(json.dumps([dict(zip(names, row)) for row in REVIEWS], indent=1))
    out = str(folder / "cleaned_reviews")
    writers.write_tsv(clean_reviews(readers.read_reviews(spark, str(path), one_array=True)), out)
    return readers.read_cleaned(spark, out).cache()


@pytest.fixture(scope="module")
def model(records, cleaned):
    return build_model(records, cleaned)


def rows_of(df, *columns):
    return sorted((tuple(row) for row in df.select(*(columns or df.columns)).collect()), key=repr)


def test_flat_records_read_the_same(spark, folder, records):
    flat = [{**i, "meta_score": score(c), "user_score": score(u)} for i, c, u in MOVIES]
    path = folder / "flat.json"
    path.write_text("\n".join(json.dumps(row) for row in flat))
    assert rows_of(readers.read_catalog(spark, str(path), one_array=False)) == rows_of(records)


def test_tsv_round_trip(spark, folder, cleaned):
    assert cleaned.schema == CLEANED
    found = {row["reviewer_name"] or row["review"][:4]: row for row in cleaned.collect()}
    assert found['A "g']["review"] == 'A "great"\tfilm,\nreally good'
    assert found['A "g']["review_clean"] == "great film really good"
    assert found["ann"]["review"] == "Not good \\ at all"
    assert found["bo"]["review_clean"] == "dont know"
    assert found["Dull"]["review_clean"] == "dull  text"
    assert found["cy"]["sentiment_score"] == Decimal("-1.000")
    texts = []
    for path in sorted((folder / "cleaned_reviews").glob("part-*")):
        with open(path, newline="") as file:
            texts += [row["review"] for row in csv.DictReader(file, delimiter="\t")]
    assert sorted(texts) == sorted(row[-1] or "" for row in REVIEWS)


def test_json_and_dimension_files(spark, folder, records, cleaned):
    writers.write_json(cleaned, str(folder / "as_json"))
    assert spark.read.schema(CLEANED).json(str(folder / "as_json")).count() == len(REVIEWS)
    for _ in range(2):  # the second run replaces the first
        writers.write_dimensions(distinct_values(records), str(folder))
    names = readers.read_dimension(spark, str(folder / "actors_tsv"))
    assert {row["name"] for row in names.collect()} == {"Ann Lee", "bo Ray", "Élan O'Hara"}


def test_model_round_trip(spark, folder, model):
    writers.write_tables(model, str(folder / "model"))
    back = readers.read_tables(spark, str(folder / "model"))
    for name, schema in TABLES.items():
        assert [(f.name, f.dataType) for f in model[name].schema] == [(f.name, f.dataType) for f in schema], name
        assert rows_of(back[name]) == rows_of(model[name])


def test_stored_bridges_are_read_by_key(spark, folder, model):
    writers.write_tables(model, str(folder / "clustered"))
    one = readers.read_tables(spark, str(folder / "clustered"))["plays_in"].where("movie_id = 1")
    assert rows_of(one, "actor_id") == [(1,), (2,)]
    assert "EqualTo(movie_id,1)" in one._jdf.queryExecution().executedPlan().toString()


def test_flatten(records):
    row = readers.flatten(records).where("id = 1").first()
    assert (row["title"], row["meta_score_score"], row["user_score_distri_positive"]) == ("Blue Harbor", "87", "1")


def test_movies_table(model):
    found = {row["movie_id"]: row for row in model["movies"].collect()}
    assert found[1]["release_date"] == datetime.date(2001, 6, 5)
    assert found[3]["release_date"] == datetime.date(2003, 6, 5)
    assert [found[i]["release_date"] for i in (2, 5)] == [None, None]
    assert [found[i]["m_u_score"] for i in (1, 2, 3)] == [Decimal("8.3"), None, None]
    assert found[2]["m_c_score"] == Decimal("10.0")
    assert [found[i]["runtime"] for i in (1, 2)] == [126, None]


def test_dimensions_and_bridges(model):
    assert rows_of(model["actors"]) == [(1, "Ann Lee"), (2, "bo Ray"), (3, "Élan O'Hara")]
    assert rows_of(model["genres"], "genre_type") == [("Drama",), ("Film-Noir",), ("Sci-Fi",)]
    named = model["directed"].join(model["directors"], "director_id")
    assert rows_of(named, "movie_id", "name") == [(1, "Di Fox"), (2, "Cy Ode"), (4, "Ann Lee"), (5, "Di Fox")]
    assert model["stream_links"].count() == 2


def test_reviews_meet_their_movie(model):
    users = model["reviews"].join(model["user_reviews"], "review_id")
    assert rows_of(users, "username", "movie_id") == [("ann", 1), ("bo", 1), ("dee", 4), ("eve", 4)]
    assert rows_of(model["critique"], "movie_id") == [(1,), (1,)]
    assert rows_of(model["unmatched"], "title") == [("Nowhere",), ("Quiet",)]
    scores = {row["username"]: row["u_score"] for row in model["user_reviews"].collect()}
    assert (scores["ann"], scores["dee"]) == (Decimal("9.0"), None)
    assert rows_of(model["critic_reviews"], "c_score") == [(Decimal("10.0"),), (None,)]
    assert rows_of(model["user_reviews"], "review_id") == [(n,) for n in range(1, 7)]


def test_model_passes_its_checks(model):
    assert check_model(model).where("violations > 0").isEmpty()


def test_model_summary(model):
    assert dict(rows_of(model_summary(model))) == {
        "movies": 5, "actors": 3, "directors": 3, "genres": 3, "user_reviews": 6, "critic_reviews": 2,
        "total_reviews": 8, "movies_without_date": 2, "unmatched_reviews": 2,
    }


def test_of_type(cleaned):
    critics = of_type(cleaned, "Critic Review")
    assert rows_of(critics, "review_score") == [(100.0,), (None,)]


@pytest.mark.parametrize(
    ("field", "keyword", "ids"),
    [
        ("title", "BLUE", [1, 2]),
        ("title", "100%", [3]),
        ("title", "100_", []),
        ("actor", "ann", [1, 2, 5]),
        ("actor", "o'h", [4]),
        ("director", "di fox", [1, 5]),
        ("genre", "sci", [1, 4, 5]),
        ("distributor", "blue", [5]),
        ("anything else", "quiet", [5]),
    ],
)
def test_search_fields(model, field, keyword, ids):
    if keyword == "100_":
        assert search.found_movies(model, field, "100_").isEmpty()
    assert sorted(row["movie_id"] for row in search.search(model, field, keyword).collect()) == ids


def test_search_without_accents(model):
    assert search.search(model, "actor", "elan").isEmpty()
    assert [row["movie_id"] for row in search.search(model, "actor", "elan", ignore_accents=True).collect()] == [4]


def test_search_rows(model):
    rows = search.search(model, "title", "blue harbor", "metacritic_score").orderBy("num").collect()
    assert [(r["num"], r["movie_id"], r["directors"], r["actors"], r["genres"]) for r in rows] == [
        (1, 2, "Cy Ode", "Ann Lee", "Drama"),
        (2, 1, "Di Fox", "Ann Lee,bo Ray", "Drama,Sci-Fi"),
    ]
    wolf = search.display_labels(search.search(model, "title", "100%"), ["distributor", "m_u_score", "summary"]).first()
    assert (wolf["directors"], wolf["distributor"], wolf["m_u_score"], wolf["summary"]) == ("N/A",) * 4


@pytest.mark.parametrize(
    ("order", "ids"),
    [("release_date", [3, 4, 1, 2, 5]), ("metacritic_score", [2, 1, 3, 5, 4]), ("user_score", [1, 5, 4, 2, 3]), ("x", [3, 4, 1, 2, 5])],
)
def test_search_orders(model, order, ids):
    rows = search.ordered(model["movies"], order).orderBy("num").collect()
    assert [row["movie_id"] for row in rows] == ids


def test_long_lists_go_on_over_pages(model):
    rows = search.search(model, "title", "blue harbor", limit=1).orderBy("movie_id", "page").collect()
    assert [(r["movie_id"], r["page"], r["directors"], r["actors"], r["genres"]) for r in rows] == [
        (1, 0, "Di Fox", "Ann Lee", "Drama"),
        (1, 1, "", "bo Ray", "Sci-Fi"),
        (2, 0, "Cy Ode", "Ann Lee", "Drama"),
    ]


@pytest.mark.parametrize(
    ("keyword", "message"),
    [("", search.NO_KEYWORD), (None, search.NO_KEYWORD), ("a", search.BAD_KEYWORD), ("%_'", search.BAD_KEYWORD), ("é1", search.BAD_KEYWORD)],
)
def test_keyword_errors(keyword, message):
    with pytest.raises(ValueError, match=message.replace("!", r"\!")):
        search.checked_keyword(keyword)


def test_keyword_rule_on_a_column(spark):
    words = ["ab", "a b", "a%b", "a", "", "é1", "1é2", "A"]
    df = spark.createDataFrame([(w,) for w in words], "k string").select("k", search.is_keyword(F.col("k")).alias("ok"))
    for row in df.collect():
        try:
            search.checked_keyword(row["k"])
            expected = True
        except ValueError:
            expected = False
        assert row["ok"] == expected, row["k"]


def test_text_search(model):
    texts = search.model_texts(model)
    assert rows_of(search.text_search(texts, "blue"), "source") == [("summary",), ("summary",)]
    assert rows_of(search.text_search(texts, "GOOD"), "source") == [("critic_review",), ("user_review",)]
    assert search.text_search(texts, "good", "user_review").count() == 1
    with pytest.raises(ValueError):
        search.text_search(texts, "good", "nothing")


def test_lookups(model):
    assert rows_of(lookup.image(model, 1)) == [("https://img.example.com/1.jpg",)]
    assert rows_of(lookup.stream_links(model, 1)) == [("https://play.example.org/1",), ("https://tv.example.net/x",)]
    assert rows_of(lookup.names_of_title(model, "blue harbor", "actor"), "num", "name") == [(1, "Ann Lee"), (2, "Ann Lee"), (3, "bo Ray")]
    assert rows_of(lookup.movies_of_name(model, "ann lee", "actor", 2), "num", "movie_id") == [(1, 1), (2, 2)]
    assert rows_of(lookup.movies_of_name(model, "SCI-FI", "genre"), "num", "movie_id") == [(1, 4), (2, 1), (3, 5)]
    assert rows_of(lookup.movies_of_distributor(model, "acme", 0)) == []
    assert rows_of(lookup.genre_list(model), "num", "genre_type") == [(1, "Drama"), (2, "Film-Noir"), (3, "Sci-Fi")]
    users = lookup.user_reviews_of_title(model, "Blue Harbor")
    assert rows_of(users, "num", "username", "u_score") == [(1, "ann", Decimal("9.0")), (2, "bo", Decimal("7.0"))]
    critics = lookup.critic_reviews_of_title(model, "Blue Harbor", 1)
    assert rows_of(critics, "num", "c_score") == [(1, Decimal("10.0"))]
    assert rows_of(lookup.id_of_title(model["movies"])) == [("100% Wolf", 3), ("100x Wolf", 4), ("Blue Harbor", 1), ("Quiet", 5)]
    assert rows_of(lookup.title_of_id(model["movies"], 5)) == [("Quiet",)]
    assert rows_of(lookup.title_of_id(model["movies"], 99)) == []
    assert rows_of(lookup.image_of_title(model["movies"], "Blue Harbor")) == [("https://img.example.com/1.jpg",)]


def test_places(model):
    placed = lookup.positions(model["movies"])
    assert rows_of(placed, "index", "movie_id") == [(at, at + 1) for at in range(5)]
    assert rows_of(lookup.index_of_title(placed, "Blue Harbor")) == [(0,)]
    assert rows_of(lookup.title_of_index(placed, 4)) == [("Quiet",)]


def test_movie_sentiment(model):
    found = {row["movie_id"]: row for row in lookup.movie_sentiment(model).collect()}
    assert (found[1]["n_reviews"], found[1]["polarity_mean"]) == (2, Decimal("-0.175"))
    assert (found[4]["n_reviews"], found[4]["polarity_mean"], found[4]["verdict"]) == (2, Decimal("0.000"), "Neutral")
    assert lookup.movie_sentiment(model, 1).count() == 1
    assert lookup.movie_sentiment(model, 2).count() == 0


def test_detail_documents(model):
    found = {row["movie_id"]: row for row in detail.detail(model).collect()}
    assert len(found) == 5
    blue = found[1]
    assert [(link["url"], link["host"]) for link in blue["links"]] == [
        ("https://play.example.org/1", "play.example.org"),
        ("https://tv.example.net/x", "tv.example.net"),
    ]
    assert [(s["movie_id"], s["title"]) for s in blue["similar"]][:1] == [(5, "Quiet")]
    assert sorted(r["label"] for r in blue["critic_reviews"]) == ["Neutral", "Positive"]
    assert [(r["reviewer"], r["label"]) for r in blue["user_reviews"]] == [("ann", "Negative"), ("bo", "Neutral")]
    assert [r["reviewer"] for r in found[4]["user_reviews"]] == ["dee"]
    assert (found[3]["similar"], found[3]["genres"]) == (None, "N/A")


@pytest.mark.skipif(not os.path.isdir(GIVEN), reason=f"{GIVEN} is not there")
def test_polarity_is_not_worked_out_in_filters(spark):
    entries = detail.review_entries(GivenModel(Given(spark, GIVEN)))
    plan = entries._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp_extract_all" in plan
    assert not [line for line in plan.splitlines() if "Filter " in line and "regexp_extract_all" in line]


def test_detail_of_one_movie_equals_its_document_among_all(model):
    every = {(row["movie_id"], row["page"]): row for row in detail.detail(model).collect()}
    for movie in (1, 3, 4):
        one = detail.detail(model, movie).collect()
        assert len(one) == 1
        assert one[0].asDict(recursive=True) == every[(movie, 0)].asDict(recursive=True)


def test_detail_pages(model):
    rows = {row["page"]: row for row in detail.detail(model, 1, limit=1, review_limit=1).collect()}
    assert sorted(rows) == [0, 1]
    assert [r["reviewer"] for page in (0, 1) for r in rows[page]["user_reviews"]] == ["ann", "bo"]
    assert [link["host"] for page in (0, 1) for link in rows[page]["links"]] == ["play.example.org", "tv.example.net"]
