from __future__ import annotations

import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.functions import links as L
from marquee.functions import values as V
from marquee.sources.readers import json_field


@pytest.mark.parametrize(
    ("text", "date"),
    [
        ("June 5, 2001", datetime.date(2001, 6, 5)),
        ("June 05, 2001", datetime.date(2001, 6, 5)),
        ("TBA", None),
        ("", None),
        ("2001-06-05", None),
        (None, None),
    ],
)
def test_page_date(value, text, date):
    assert value(text, V.page_date) == date
    assert value(text, lambda c: V.iso_date(V.page_date(c))) == (date.isoformat() if date else None)


@pytest.mark.parametrize(
    ("text", "user", "critic"),
    [
        ("8.25", "8.3", "0.8"),
        ("100", "100.0", "10.0"),
        ("87", "87.0", "8.7"),
        ("tbd", None, None),
        ("", None, None),
        (None, None, None),
    ],
)
def test_scores(value, text, user, critic):
    fits = user is not None and Decimal(user) < 100
    assert value(text, V.user_score) == (Decimal(user) if fits else None)
    assert value(text, V.critic_score) == (Decimal(critic) if critic else None)


def test_numbers_and_minutes(value):
    assert value("126 min", V.minutes) == 126
    assert value(" 90 min", V.minutes) == 90
    assert value("long", V.minutes) is None
    assert value(None, V.minutes) is None
    assert value("12", V.whole_number) == 12
    assert value("x", V.whole_number) is None
    assert value("tbd", V.number) is None


def test_missing_values(value):
    assert value(None, V.or_missing) == "N/A"
    assert value("x", V.or_missing) == "x"
    assert value(None, lambda c: V.or_empty(F.split(c, ","))) == []


def test_json_field(value):
    assert value('{"k": 7}', lambda c: json_field(c, "k", T.LongType())) == 7
    assert value('{"j": 7}', lambda c: json_field(c, "k", T.LongType())) is None
    assert value("broken", lambda c: json_field(c, "k", T.LongType())) is None


PAGE = "https://www.site.com/browse/movies?page=2#top"


@pytest.mark.parametrize(
    ("link", "expected"),
    [
        ("https://other.org/x", "https://other.org/x"),
        ("//cdn.site.com/a", "https://cdn.site.com/a"),
        ("/movie/a", "https://www.site.com/movie/a"),
        ("detail", "https://www.site.com/browse/detail"),
        ("?page=3", "https://www.site.com/browse/movies?page=3"),
        ("#end", "https://www.site.com/browse/movies?page=2#end"),
        ("mailto:a@b.c", "mailto:a@b.c"),
        (None, None),
    ],
)
def test_absolute_links(value, link, expected):
    assert value(link, lambda c: L.absolute(c, F.lit(PAGE))) == expected


def test_absolute_links_as_the_standard_has_them(spark):
    from urllib.parse import urljoin

    base = "http://a/b/c/d;p?q"
    links = "g ./g g/ /g //g ?y g?y #s g#s g?y#s ;x g;x g;x?y#s . ./ .. ../ ../g ../.. ../../ ../../g ../../../g ../../../../g /./g /../g g. .g g.. ..g ./../g ./g/. g/./h g/../h g;x=1/./y g;x=1/../y g?y/./x g#s/../x http://b/x/../y mailto:x@y.z".split()
    rows = spark.createDataFrame([(link,) for link in links], "link string").select("link", L.absolute(F.col("link"), F.lit(base)).alias("found"))
    for row in rows.collect():
        want = row["link"] if ":" in row["link"] and "//" not in row["link"] else urljoin(base, row["link"])
        if row["link"] == "http://b/x/../y":
            want = "http://b/y"
        assert row["found"] == want, row["link"]


def test_absolute_links_from_odd_pages(value):
    assert value("a", lambda c: L.absolute(c, F.lit("http://site.com"))) == "http://site.com/a"
    assert value("a", lambda c: L.absolute(c, F.lit("http://site.com/"))) == "http://site.com/a"
    assert value("/a", lambda c: L.absolute(c, F.lit("not a url"))) is None


@pytest.mark.parametrize(
    ("url", "shown", "host"),
    [
        ("https://play.site.com/a/b", "play.site.com", "play.site.com"),
        ("https://User:pw@Play.Site.com:8080/a", "User:pw@Play.Site.com:8080", "play.site.com"),
        ("site.com", None, None),
        (None, None, None),
    ],
)
def test_hosts(value, url, shown, host):
    assert value(url, L.link_host) == shown
    assert value(url, L.host) == host


def test_domains(value):
    for url, expected in [
        ("https://www.site.com/a", True),
        ("https://site.com", True),
        ("https://notsite.com/a", False),
        ("https://site.com.evil.org/a", False),
        (None, False),
    ]:
        assert value(url, lambda c: L.in_domains(c, ["site.com"])) is expected
