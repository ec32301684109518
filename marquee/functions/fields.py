"""Where the site keeps its fields: selectors of page fields, and patterns of links and listings.

Class names and element order are the site's, so they are fixed values.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .markup import Field, Group


def _class(name: str) -> str:
    return rf'class="[^"]*\b{name}\b[^"]*"[^>]*>'


# A score block, the critics' first and the users' second.
SCORE = {
    "score": Field((".metascore_w",)),
    "positive": Field((".chart.positive .count.fr",)),
    "mixed": Field((".chart.mixed .count.fr",)),
    "negative": Field((".chart.negative .count.fr",)),
    "link": Field(("a.metascore_anchor@href",)),
}

# The movie page.
MOVIE = {
    "title": Field((".product_page_title h1",)),
    "distributor": Field((".distributor a",)),
    "date": Field((".release_date span",)),
    "starring": Field((".summary_cast a",), many=True),
    "summary": Field((".summary_deck .blurb_expanded", ".summary_deck span span")),
    "director": Field((".director a span",), many=True),
    "genres": Field((".genres span span",), many=True),
    "rating": Field((".rating span",)),
    "runtime": Field((".runtime span",)),
    "awards": Field((".ranking_title a",), many=True),
    "stream_link": Field(("a.esite_url@href",), many=True),
    "image": Field(("img.summary_img@src",)),
    "scores": Group(".distribution", SCORE),
}

# Review pages.
_REVIEWED = {
    "release_date": Field((".release_date span",)),
    "movie_name": Field((".product_page_title h1",)),
    "score": Field((".num_wrapper span",)),
}
CRITICS = _REVIEWED | {
    "reviews": Group("div.review.pad_top1.pad_btm1", {"review_score": Field((".metascore_w",)), "review": Field((".no_hover",))})
}
USERS = _REVIEWED | {
    "reviews": Group(
        "div.review.pad_top1",
        {
            "reviewer_name": Field((".author",)),
            "review_score": Field((".metascore_w",)),
            "review": Field((".review_body .blurb_expanded", ".review_body span")),
        },
    )
}

# Listing pages and page navigation.
LISTED_RANK = rf'{_class("numbered")}([^<]*)'
LISTED_TITLE = rf'(?s){_class("numbered")}.*?<h3[^>]*>([^<]*)'
LISTED_LINK = rf'(?s){_class("numbered")}[^<]*</span>\s*<a\b[^>]*\bhref="([^"]*)"'
NEXT_PAGE = rf'{_class("next")}\s*<a\b(?=[^>]*\baction\b)[^>]*\bhref="([^"]*)"'
NEXT_REVIEWS = rf'(?s){_class("page_nav")}.*?<a\b(?=[^>]*\baction\b)[^>]*\bhref="([^"]*)"'
ANY_LINK = r'href="([^"]*)"'


def first(html: Column, pattern: str) -> Column:
    """Text of the first match, NULL when there is none."""
    return F.nullif(F.regexp_extract(html, pattern, 1), F.lit(""))


def every(html: Column, pattern: str) -> Column:
    """Texts of all matches, an empty array when there is none."""
    return F.regexp_extract_all(html, F.lit(pattern), F.lit(1))
