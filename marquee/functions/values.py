"""Parsing of scraped values: dates, scores, minutes, missing values, JSON fields."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The date layout of the pages and the labels of missing values.
PAGE_DATE = "MMMM d, yyyy"
MISSING = "N/A"
UNRATED = "Not Rated"

SCORE_TYPE = "decimal(3,1)"


def page_date(text: Column) -> Column:
    """``June 5, 2001`` as a date; NULL for anything else, such as ``TBA``."""
    return F.try_to_date(text, PAGE_DATE)


def iso_date(date: Column) -> Column:
    return F.date_format(date, "yyyy-MM-dd")


def number(text: Column) -> Column:
    """Text as a double, NULL when it is not a number (``tbd``, empty)."""
    return text.try_cast("double")


def whole_number(text: Column) -> Column:
    return text.try_cast("long")


def user_score(text: Column) -> Column:
    """A score on the 0-10 scale."""
    return number(text).try_cast(SCORE_TYPE)


def critic_score(text: Column) -> Column:
    """A score on the 0-100 scale, brought to 0-10."""
    return (number(text) / 10).try_cast(SCORE_TYPE)


def minutes(runtime: Column) -> Column:
    """``126 min`` as 126."""
    return F.regexp_extract(runtime, r"^\s*(\S+)", 1).try_cast("int")


def or_missing(value: Column, label: str = MISSING) -> Column:
    """The value as text, or the label when it is NULL."""
    return F.coalesce(value.cast("string"), F.lit(label))


def or_empty(values: Column) -> Column:
    return F.coalesce(values, F.array().cast("array<string>"))
