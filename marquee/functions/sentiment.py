"""Sentiment polarity and its labels, from built-in functions only."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from decimal import Decimal

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from .words import INTENSITY, NEGATORS, POLARITY

POLARITY_TYPE = "decimal(4,3)"
WORD = r"[a-z]+(?:'[a-z]+)?"
NEGATION = Decimal("-0.5")


@dataclass(frozen=True)
class Lexicon:
    """Words with a polarity in [-1, 1], words that scale the next one, and words that negate it."""

    polarity: dict[str, float] = field(default_factory=lambda: dict(POLARITY))
    intensity: dict[str, float] = field(default_factory=lambda: dict(INTENSITY))
    negators: tuple[str, ...] = NEGATORS


def _weights(entries: dict[str, float]) -> Column:
    """Word to weight as one constant map, which keeps the expression small to plan."""
    return F.str_to_map(F.lit(",".join(f"{word}:{weight}" for word, weight in entries.items())), F.lit(","), F.lit(":"))


def polarity(review: Column, lexicon: Lexicon | None = None) -> Column:
    """Mean polarity of the review's lexicon words, rounded to three decimals.

    The word before a hit may scale it; the word before that (or before the hit) may negate it, which
    multiplies by -0.5. Each hit is held in [-1, 1]. No hit gives 0, a NULL review gives NULL.

    The whole score is a per-row expression: no explode, no shuffle, no Python worker. Membership is a
    hash-set test, and the weight maps are only read for the few words that are hits.
    """
    lexicon = lexicon or Lexicon()
    weight, factor = _weights(lexicon.polarity), _weights(lexicon.intensity)

    def hit_score(words: Column, at: Column) -> Column:
        before = F.get(words, at - 1)
        scaled = F.coalesce(before.isin(*lexicon.intensity), F.lit(False))
        negator = F.when(scaled, F.get(words, at - 2)).otherwise(before)
        turn = F.when(negator.isin(*lexicon.negators), F.lit(NEGATION)).otherwise(F.lit(Decimal("1.0")))
        scale = F.when(scaled, factor[before]).otherwise("1").cast("decimal(4,2)")
        score = weight[F.get(words, at)].cast("decimal(4,2)") * scale * turn
        return F.greatest(F.lit(-1), F.least(F.lit(1), score)).cast("decimal(8,5)")

    def mean(words: Column) -> Column:
        places = F.filter(
            F.transform(words, lambda word, at: F.when(word.isin(*lexicon.polarity), at)), lambda at: at.isNotNull()
        )
        scores = F.transform(places, lambda at: hit_score(words, at))
        total = F.aggregate(
            scores,
            F.struct(F.lit(0).cast("decimal(20,5)").alias("sum"), F.lit(0).alias("n")),
            lambda acc, score: F.struct(
                (acc["sum"] + score).cast("decimal(20,5)").alias("sum"), (acc["n"] + 1).alias("n")
            ),
            lambda acc: F.when(acc["n"] == 0, F.lit(0)).otherwise(F.round(acc["sum"] / F.when(acc["n"] > 0, acc["n"]), 3)),
        )
        return total.cast(POLARITY_TYPE)

    # The one-element array binds the word list once for all the lambdas that look into it.
    words = F.regexp_extract_all(F.lower(review), F.lit(WORD), F.lit(0))
    return F.when(review.isNotNull(), F.transform(F.array(words), mean)[0])


def scored_by(review: Column, scorer: Callable[[str], float]) -> Column:
    """Polarity from the caller's own ``scorer``, run in Arrow batches and rounded to three decimals."""

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return texts.map(lambda text: None if text is None else float(scorer(text)))

    return F.round(score(review), 3).cast(POLARITY_TYPE)


def label(score: Column, variant: str = "review") -> Column:
    """Negative, Neutral or Positive; the variants differ only at exactly -0.3 and 0.3.

    ``review`` counts -0.3 as Neutral and 0.3 as Positive, ``movie`` the other way round.
    """
    low, high = F.lit(Decimal("-0.3")), F.lit(Decimal("0.3"))
    if variant == "review":
        negative, neutral = score < low, score < high
    elif variant == "movie":
        negative, neutral = score <= low, score <= high
    else:
        raise ValueError(f"unknown label variant {variant!r}")
    return F.when(negative, "Negative").when(neutral, "Neutral").when(score.isNotNull(), "Positive")
