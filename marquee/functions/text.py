"""Text cleaning: normalise, tokenise, drop stop words, trim, strip markup, fold tags."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .words import ENGLISH_STOP_WORDS, TAG_SPELLINGS

# Characters cut from both ends of scraped text and of a listing rank.
BLANKS = " \t\r\n"
RANK_EDGES = " .\n"

# What a regular expression calls whitespace.
WHITESPACE = " \t\n\x0b\f\r"

# Markup removed from an expanded review body.
BODY_MARKUP = ("</span>", '<span class="blurb blurb_expanded">', "<br>")


def normalise(text: Column) -> Column:
    """Delete all but ASCII letters and whitespace, then lower-case.

    Joining the runs to keep is several times faster than replacing each character to drop: a negated
    class is tested through shared type checks that slow each other down when many tasks run in one JVM.
    """
    return F.lower(F.array_join(F.regexp_extract_all(text, F.lit(r"[a-zA-Z\s]+"), F.lit(0)), ""))


def _split(text: Column) -> Column:
    return F.split(F.rtrim(text, F.lit(WHITESPACE)), r"\s")


def tokenise(text: Column) -> Column:
    """Lower-case and split at every single whitespace character.

    A run of blanks inside the text leaves empty tokens; blanks at the end leave none.
    """

    def split(lowered: Column) -> Column:
        blank = (lowered != "") & (F.rtrim(lowered, F.lit(WHITESPACE)) == "")
        return F.when(blank, F.array().cast("array<string>")).otherwise(_split(lowered))

    # The one-element array works the text out once for its three uses.
    return F.transform(F.array(F.lower(text)), split)[0]


def drop_stop_words(tokens: Column, words: tuple[str, ...] = ENGLISH_STOP_WORDS, lowered: bool = False) -> Column:
    """Keep the tokens that are not stop words, in order and whatever their case.

    ``lowered`` says that the tokens are in lower case already.
    """
    return F.filter(tokens, lambda token: ~(token if lowered else F.lower(token)).isin(*words))


def clean(text: Column) -> Column:
    """Normalised text without stop words, tokens joined by one space; NULL stays NULL."""
    return F.array_join(drop_stop_words(_split(normalise(text)), lowered=True), " ")


def tidy(text: Column, edges: str = BLANKS) -> Column:
    """Trim the given characters (blanks, tabs and line ends unless told otherwise)."""
    return F.trim(text, F.lit(edges))


def strip_markup(fragment: Column, pieces: tuple[str, ...] = BODY_MARKUP, breaks_as_space: bool = False) -> Column:
    """Remove fixed tags from a fragment; ``breaks_as_space`` keeps words apart at a line break."""
    if breaks_as_space:
        fragment = F.replace(fragment, F.lit("<br>"), F.lit(" "))
    for piece in pieces:
        fragment = F.replace(fragment, F.lit(piece), F.lit(""))
    return tidy(fragment)


def fold_tags(tags: Column) -> Column:
    """Write hyphenated tags as one word so that a tokeniser keeps them whole."""
    for spelling, folded in TAG_SPELLINGS.items():
        tags = F.replace(tags, F.lit(spelling), F.lit(folded))
    return tags
