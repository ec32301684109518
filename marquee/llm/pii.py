"""Personal data: patterns propose spans, checksums confirm them, nearby words adjust the score.

DataFrame operations alone, one projection over the text, no shuffle. Kinds: email, ip (parts up to 255),
card (Luhn), phone (9 to 15 digits) and, added by this operator, iban (mod 97). The score starts at the
kind's prior, rises with a word near the span that speaks of the kind and falls with one that speaks of
samples; it never removes a span.

A spaced iban is proposed with all the groups that may belong to it. It ends at the length of its country, else
where the groups end; without a known country, at the last group that leaves a valid code.

Defined results: a NULL text counts as empty; no spans give empty strings and a score of NULL; repeated rows
each get their own answer; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import labelled, matches, whole, written

# The kinds in their order. Repeats are possessive: nothing that follows could use what they
# give back, and the matcher then needs neither stack nor retries on long runs. The look-behinds only skip
# starts inside a run whose first place has already failed.
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9]){12,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": r"[A-Z]{2}[0-9]{2}(?:(?:\x20[A-Z0-9]{4}){2,7}(?:\x20[A-Z0-9]{1,3})?|[A-Z0-9]{11,30})",
}
# The start of an iban, so that a proposal swallows no other's start, and the lengths by country.
IBAN_START = r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?=(?:\x20[A-Z0-9]{4}){2}|[A-Z0-9]{11})"
IBAN_WIDTH = 43
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST", 26: "IS TR",
    27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC",
    33: "RU",
}
# Prior score of a kind and words that speak for it.
PRIORS = {"email": 0.7, "ip": 0.4, "card": 0.6, "phone": 0.5, "iban": 0.7}
WORDS = {
    "email": "mail|contact|write to|address",
    "ip": r"\bip\b|server|host|login|logged",
    "card": "card|visa|credit|payment|cvv",
    "phone": "phone|call|mobile|fax|tel",
    "iban": "iban|account|bank|transfer",
}
AGAINST = "example|sample|test|dummy|version"
NEAR = 40
BOOST, CUT = 0.25, 0.3


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Every second digit from the right is doubled, 9 taken off above 9, and the sum ends in 0."""
    figures = F.transform(F.split(F.reverse(number), ""), lambda figure: F.coalesce(figure.try_cast("int"), F.lit(0)))

    def add(state, figure):
        doubled = F.when(state["odd"], figure * 2).otherwise(figure)
        return F.struct((state["sum"] + doubled - F.when(doubled > 9, 9).otherwise(0)).alias("sum"), (~state["odd"]).alias("odd"))

    start = F.struct(F.lit(0).alias("sum"), F.lit(False).alias("odd"))
    return F.aggregate(figures, start, add, lambda state: state["sum"] % 10 == 0)


def mod97(code: Column) -> Column:
    """Country and check digits move to the end, letters become 10 to 35, and the number leaves 1."""
    compact = F.replace(code, F.lit(" "), F.lit(""))
    moved = F.concat(F.substr(compact, F.lit(5)), F.left(compact, F.lit(4)))

    def add(rest, sign):
        number = F.ascii(sign) - F.when(sign >= "A", 55).otherwise(48)
        return F.when(sign == "", rest).otherwise((rest * F.when(number > 9, 100).otherwise(10) + number) % 97)

    return F.aggregate(F.split(moved, ""), F.lit(0), add) == 1


def small_part(part: Column) -> Column:
    """At most 255, for a run of digits of any length."""
    figures = F.regexp_replace(part, "^0+", "")
    return (F.length(figures) <= 3) & (F.coalesce(figures.try_cast("int"), F.lit(0)) <= 255)


def confirmed(kind: str, text: Column, span: Column) -> Column:
    value = span["value"]
    if kind == "ip":
        return F.forall(F.split(value, r"\."), small_part)
    if kind == "card":
        return F.length(digits(value)).between(13, 19) & luhn(digits(value))
    if kind == "phone":
        return F.length(digits(value)).between(9, 15)
    if kind == "iban":
        return value.isNotNull()
    return F.lit(True)


def ibans(text: Column) -> Column:
    """Spans of :func:`matches` at each start of an iban, up to its end; the value is NULL without a valid end."""
    lengths = F.create_map(*(F.lit(part) for length, codes in IBAN_LENGTHS.items() for code in codes.split() for part in (code, length)))

    def ended(span: Column) -> Column:
        most = F.regexp_extract(F.substr(text, span["start"] + 1, F.lit(IBAN_WIDTH)), f"^(?:{PATTERNS['iban']})", 0)
        length = F.element_at(lengths, F.left(most, F.lit(2)))
        own = F.when(F.substr(most, F.lit(5), F.lit(1)) == " ", length + F.floor((length - 1) / 4).cast("int")).otherwise(length)
        groups = F.when(length.isNull(), F.array(*(F.lit(4 + 5 * number) for number in range(7, 1, -1)))).otherwise(F.array().cast("array<int>"))
        ends = F.concat(F.array(own, F.length(most)), groups)

        def valid(end: Column) -> Column:
            bare = ~F.substr(text, span["start"] + end + 1, F.lit(1)).rlike("[A-Za-z0-9]")
            return F.coalesce((end <= F.length(most)) & bare, F.lit(False)) & mod97(F.left(most, end))

        end = F.get(F.filter(ends, valid), F.lit(0))
        return F.struct(span["start"].alias("start"), (span["start"] + end).alias("end"), F.left(most, end).alias("value"))

    return F.transform(matches(text, IBAN_START), ended)


def score(kind: str, text: Column, span: Column) -> Column:
    """Prior plus what the words within :data:`NEAR` characters before and after say, between 0 and 1."""
    first = F.greatest(span["start"] - NEAR, F.lit(0))
    before = F.substr(text, first + 1, span["start"] - first)
    near = F.lower(F.concat_ws(" ", before, F.substr(text, span["end"] + 1, F.lit(NEAR))))
    raised = F.lit(PRIORS[kind]) + F.when(near.rlike(WORDS[kind]), BOOST).otherwise(0.0) - F.when(near.rlike(AGAINST), CUT).otherwise(0.0)
    return F.round(F.least(F.greatest(raised, F.lit(0.0)), F.lit(1.0)), 2)


def find(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and spans: array of (kind, start, end, value, score) by kind as listed, then start."""
    body = whole(F.col(text))

    def of(kind: str) -> Column:
        proposed = labelled(ibans(body) if kind == "iban" else matches(body, PATTERNS[kind]), kind, list(PATTERNS).index(kind))
        return F.transform(
            F.filter(proposed, lambda span: confirmed(kind, body, span)),
            lambda span: F.struct(
                span["kind"].alias("kind"), span["start"].alias("start"), span["end"].alias("end"),
                span["value"].alias("value"), score(kind, body, span).alias("score"),
            ),
        )

    return docs.select(F.col(doc_id).alias("doc_id"), F.concat(*map(of, PATTERNS)).alias("spans"))


def digests(found: DataFrame) -> DataFrame:
    """Counts and span strings of the contract from :func:`find`'s rows, and the highest score."""

    def number(kind: str) -> Column:
        return F.size(F.filter("spans", lambda span: span["kind"] == kind)).cast("long")

    base = F.filter("spans", lambda span: span["kind"] != "iban")
    return found.select(
        "doc_id",
        *(number(kind).alias(f"n_{kind}") for kind in PATTERNS),
        F.sha2(written(base), 256).alias("base_sha256"),
        written(F.col("spans")).alias("spans"),
        F.array_join(F.transform("spans", lambda span: span["score"].cast("string")), ",").alias("scores"),
        F.array_max(F.transform("spans", lambda span: span["score"])).alias("top_score"),
    )
