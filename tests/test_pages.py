from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from marquee.functions import fields
from marquee.operators import pages as P
from marquee.schemas import CATALOG, PAGES

SITE = "https://www.movies.example.com"

MOVIE = f"""<html><head><title>x</title></head><body>
<div class="product_page_title oswald"><h1>Blue Harbor</h1></div>
<table><tr><td class="summary_wrap"><img class="summary_img" src="{SITE}/img/1.jpg" alt="">
<div class="details_section"><span class="distributor"><span class="label">Distributor:</span> <a href="/company/a">Acme</a></span>
<span class="release_date"><span class="label">Release Date:</span> <span>June 5, 2001</span></span></div>
<div class="summary_cast details_section"><div class="cast_label"><span class="label">Starring:</span></div>
<span><a href="/person/ann">Ann Lee</a>, <a href="/person/bo">Bo Ray</a></span></div>
<div class="summary_deck details_section"><span class="label">Summary:</span> <span><span class="inline_expand_collapse">
<span class="blurb blurb_collapsed">Short</span><span class="blurb blurb_expanded">The whole story.</span></span></span></div>
<div class="director"><span class="label">Director:</span> <a href="/person/d"><span>Di Fox</span></a></div>
<div class="genres"><span class="label">Genre(s):</span> <span><span>Drama</span>, <span>Sci-Fi</span></span></div>
<div class="rating"><span class="label">Rating:</span> <span> PG-13 </span></div>
<div class="runtime"><span class="label">Runtime:</span> <span>126 min</span></div>
<div class="details_section"><a class="esite_url" href="https://play.example.org/1">Play</a><a href="https://tv.example.net/1" class="esite_url">TV</a></div>
<div class="module list_rankings"><div class="ranking_title"><a href="/r">Best of 2001</a></div></div>
<div class="distribution"><div class="score"><a class="metascore_anchor" href="/movie/blue/critic-reviews"><div class="metascore_w larger">87</div></a></div>
<div class="chart positive"><div class="count fr">20</div></div><div class="chart mixed"><div class="count fr">3</div></div>
<div class="chart negative"><div class="count fr">1</div></div></div>
<div class="distribution"><a class="metascore_anchor" href="/movie/blue/user-reviews"><div class="metascore_w user">8.1</div></a>
<div class="chart positive"><div class="count fr">200</div></div><div class="chart mixed"><div class="count fr">30</div></div>
<div class="chart negative"><div class="count fr">10</div></div></div>
</body></html>"""

BARE = """<div class="product_page_title"><h1>Bare</h1></div>
<div class="summary_deck details_section"><span class="label">Summary:</span> <span><span>Only a line.</span></span></div>
<div class="distribution"><a class="metascore_anchor" href="/movie/bare/critic-reviews"><div class="metascore_w">40</div></a></div>"""

LISTING = """<td><span class="title numbered"> 1. </span> <a href="/movie/blue" class="title"><h3>Blue Harbor</h3></a></td>
<td><span class="title numbered">
  2.
</span> <a href="/movie/other" class="title"><h3>Other</h3></a></td>
<span class="flipper next"><a class="action" rel="next" href="/browse?page=2"><span>next</span></a></span>"""

HEAD = """<div class="next_to_side_col"><div class="product_page_title"><a href="/movie/blue"><h1>Blue Harbor</h1></a></div>
<table class="simple_summary"><tr><td class="left"><span class="release_date"><span class="label">Release Date:</span> <span>June 5, 2001</span></span></td>
<td class="num_wrapper"><span class="metascore_w">87</span></td></tr></table></div>"""

CRITICS = HEAD + """
<div class="review pad_top1 pad_btm1"><div class="left fl"><div class="metascore_w medium">100</div></div>
<div class="right fl"><div class="summary"><a class="no_hover" href="/x">
 A "great" film. </a></div></div></div>
<div class="review pad_top1 pad_btm1"><div class="left fl"><div class="metascore_w medium">60</div></div>
<div class="right fl"><div class="summary"></div></div></div>
<div class="review pad_top1 pad_btm1"><div class="right fl"><div class="summary"><a class="no_hover" href="/y">Fine.</a></div></div></div>"""

USERS = HEAD + """
<div class="review pad_top1"><div class="left"><div class="metascore_w">9</div></div><div class="right">
<div class="title pad_btm_half"><span class="author">plain</span></div><div class="summary"><div class="review_body"><span class="inline_expand_collapse">
<span class="blurb blurb_collapsed">One</span><span class="blurb blurb_expanded">One<br>two </span></span></div></div></div></div>
<div class="review pad_top1"><div class="right"><div class="title pad_btm_half"><span class="author"><a href="/u">linked</a></span></div>
<div class="summary"><div class="review_body"> <span> Short text </span></div></div></div></div>
<div class="review pad_top1"><div class="right"><div class="summary"><div class="review_body"><span>no author</span></div></div></div></div>
<div class="page_nav"><a class="action" href="/movie/blue/user-reviews?page=1">next</a></div>"""


@pytest.fixture(scope="module")
def frame(spark):
    def build(*htmls, url=f"{SITE}/movie/blue"):
        return spark.createDataFrame([(at, url, html) for at, html in enumerate(htmls)], PAGES)

    return build


def test_movie_record(spark, frame):
    ranks = spark.createDataFrame([("Blue Harbor", 12)], "title string, rank long")
    records = P.movie_records(frame(MOVIE), ranks)
    assert [f.name for f in records.schema] == CATALOG.names
    row = records.first()
    assert row["info"].asDict() == {
        "id": 12,
        "title": "Blue Harbor",
        "distributor": "Acme",
        "date": "June 5, 2001",
        "starring": ["Ann Lee", "Bo Ray"],
        "summary": "The whole story.",
        "director": ["Di Fox"],
        "genres": ["Drama", "Sci-Fi"],
        "rating": "PG-13",
        "runtime": "126 min",
        "awards": ["Best of 2001"],
        "stream_link": ["https://play.example.org/1", "https://tv.example.net/1"],
        "image": f"{SITE}/img/1.jpg",
    }
    assert row["meta_score"].asDict(recursive=True) == {
        "score": "87",
        "distri": {"positive": "20", "mixed": "3", "negative": "1"},
        "review_link": f"{SITE}/movie/blue/critic-reviews",
    }
    assert row["user_score"].asDict(recursive=True) == {
        "score": "8.1",
        "distri": {"positive": "200", "mixed": "30", "negative": "10"},
        "review_link": f"{SITE}/movie/blue/user-reviews",
    }


def test_bare_movie_record(frame):
    row = P.movie_records(frame(BARE)).first()
    info = row["info"]
    assert (info["id"], info["title"], info["summary"], info["rating"]) == (-1, "Bare", "Only a line.", "Not Rated")
    assert (info["awards"], info["genres"], info["runtime"], info["date"]) == ([], [], None, None)
    assert row["meta_score"]["score"] == "40"
    assert row["user_score"].asDict(recursive=True) == {
        "score": None,
        "distri": {"positive": None, "mixed": None, "negative": None},
        "review_link": None,
    }


def test_listing(frame):
    page = frame(LISTING, url=f"{SITE}/browse?page=1")
    assert [(r["title"], r["rank"]) for r in P.listing_ranks(page).orderBy("pos").collect()] == [("Blue Harbor", 1), ("Other", 2)]
    links = P.resolve_links(P.page_links(page, fields.LISTED_LINK))
    assert [r["abs_url"] for r in links.collect()] == [f"{SITE}/movie/blue", f"{SITE}/movie/other"]
    assert P.next_pages(page).first()["next_url"] == f"{SITE}/browse?page=2"
    assert P.next_pages(frame(MOVIE)).first()["next_url"] is None


def test_review_feed(frame):
    critics = P.critic_reviews(frame(CRITICS))
    assert [r["review"] for r in critics.collect()] == ['A "great" film.', "Fine."]
    assert [r["review_score"] for r in critics.collect()] == ["100", None]
    users = P.user_reviews(frame(USERS))
    found = [(r["reviewer_name"], r["review_score"], r["review"]) for r in users.collect()]
    assert found == [("plain", "9", "Onetwo"), ("linked", None, "Short text")]
    feed = P.review_feed(critics, users)
    for row in feed.collect():
        assert (row["movie_name"], row["release_date"]) == ("Blue Harbor", "June 5, 2001")
        assert (row["user_review_score"] is None) == (row["review_type"] == "Critic Review")
        assert (row["meta_score"] is None) == (row["review_type"] == "User Review")
    assert P.next_pages(frame(USERS), fields.NEXT_REVIEWS).first()["next_url"] == f"{SITE}/movie/blue/user-reviews?page=1"


def test_frontier(spark, frame):
    html = '<a href="/a">1</a><a href="/a">2</a><a href="https://evil.example.net/b">3</a><a href="/movie/blue">4</a><a href="c">5</a>'
    page = frame(html)
    links = P.allowed(P.resolve_links(P.page_links(page)), ["movies.example.com"])
    assert sorted(r["abs_url"] for r in P.frontier(links, page).collect()) == [f"{SITE}/a", f"{SITE}/movie/c"]


def test_blocks_end_with_their_nesting(frame):
    page = """<div id="a" class="review first pad_top1 pad_btm1"><div><div class="summary"></div></div></div>
    <div class="review pad_top1 pad_btm1" id=b><div class="metascore_w">70</div><div><a class="no_hover">Good &amp; long</a></div></div>
    <footer><a class="no_hover" href="/x">About us</a></footer>"""
    assert [(r["review_score"], r["review"]) for r in P.critic_reviews(frame(page)).collect()] == [("70", "Good & long")]


def test_nested_sections_and_later_scores(frame):
    page = """<div class="product_page_title"><h1>T</h1></div><div class="genres"><div><span>x<span>Drama</span></span></div><span><span>War</span></span></div>
    <div class="distribution"><div class="metascore_w">40</div></div><p class="metascore_w">99</p>"""
    row = P.movie_records(frame(page)).first()
    assert row["info"]["genres"] == ["Drama", "War"] and row["meta_score"]["score"] == "40" and row["user_score"]["score"] is None


def test_page_stored_twice(spark, frame):
    ranks = spark.createDataFrame([("Bare", 5)], "title string, rank long")
    twice = frame(BARE).unionAll(frame(BARE))
    assert [r["info"]["id"] for r in P.movie_records(twice, ranks).collect()] == [5, 5]


def test_frontier_without_fragments_and_other_schemes(spark):
    links = spark.createDataFrame([("http://h.com/x#a",), ("http://h.com/x#top",), ("mailto:a@b.c",), ("javascript:void(0)",), ("https://h.com/y#z",)], "abs_url string")
    fetched = spark.createDataFrame([("http://h.com/x#q",)], "url string")
    assert [r["abs_url"] for r in P.frontier(links, fetched).collect()] == ["https://h.com/y"]
