from __future__ import annotations

from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.ml.feature import StopWordsRemover, Tokenizer
from pyspark.sql import functions as F

from marquee.functions import sentiment as S
from marquee.functions import text as X
from marquee.functions.words import ENGLISH_STOP_WORDS, INTENSITY, NEGATORS, POLARITY
from marquee.plans.reviews import clean_reviews

TEXTS = [
    "Don't miss   it!",
    "tab\there\nline  ",
    "   ",
    "",
    "...",
    "café été \"quoted\" back\\slash",
    "The END of the movie ",
    "\n leading",
    "a b c",
]


def test_stop_words_are_sparks(spark):
    assert list(ENGLISH_STOP_WORDS) == StopWordsRemover.loadDefaultStopWords("english")


def test_cleaning_equals_ml_transformers(spark):
    rows = spark.createDataFrame([(at, text) for at, text in enumerate(TEXTS)], "id int, review string")
    lowered = rows.withColumn("low", X.normalise(F.col("review")))
    tokens = Tokenizer(inputCol="low", outputCol="tokens").transform(lowered)
    kept = StopWordsRemover(inputCol="tokens", outputCol="kept").transform(tokens)
    result = kept.select(
        "tokens",
        X.tokenise(F.col("low")).alias("mine"),
        F.concat_ws(" ", "kept").alias("joined"),
        X.clean(F.col("review")).alias("cleaned"),
    ).collect()
    for row in result:
        assert row["mine"] == row["tokens"]
        assert row["cleaned"] == row["joined"]


def test_cleaned_text_has_letters_and_whitespace_only(value):
    for text in TEXTS:
        cleaned = value(text, X.clean)
        assert all(char.isascii() and (char.islower() or char.isspace()) for char in cleaned)


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="aT he\t\n.é", max_size=20), min_size=1, max_size=5))
def test_tokenise_splits_like_java(spark, texts):
    rows = spark.createDataFrame([(text,) for text in texts], "x string")
    java = Tokenizer(inputCol="x", outputCol="y").transform(rows).select("y", X.tokenise(F.col("x")).alias("z"))
    for row in java.collect():
        assert row["y"] == row["z"]


def test_null_review_stays_null(value):
    assert value(None, X.clean) is None
    assert value(None, S.polarity) is None


def test_stop_words_ignore_case(value):
    assert value("The Cat AND dog", lambda c: X.drop_stop_words(F.split(c, " "))) == ["Cat", "dog"]


def test_markup_and_tags(value):
    assert value('<span class="blurb blurb_expanded">one<br>two</span> ', X.strip_markup) == "onetwo"
    spaced = value('<span class="blurb blurb_expanded">one<br>two</span>', lambda c: X.strip_markup(c, breaks_as_space=True))
    assert spaced == "one two"
    assert value("Sci-Fi Film-Noir Talk-Show Reality-TV Drama", X.fold_tags) == "SciFi Noir TalkShow RealityTV Drama"
    assert value(" 12. \n", lambda c: X.tidy(c, X.RANK_EDGES)) == "12"
    assert value("\t x \r\n", X.tidy) == "x"


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("nothing here", "0.000"),
        ("good", "0.700"),
        ("very good", "0.910"),
        ("not good", "-0.350"),
        ("not very good", "-0.455"),
        ("no, good", "-0.350"),
        ("good bad", "0.000"),
        ("absolutely perfect", "1.000"),
        ("GOOD! fine? bad.", "0.133"),
        ("can't love", "-0.250"),
    ],
)
def test_polarity(value, text, expected):
    assert value(text, S.polarity) == Decimal(expected)


def test_polarity_agrees_with_a_plain_loop(spark):
    import re

    def plain(text):
        words = re.findall(S.WORD, text.lower())
        scores = []
        for at, word in enumerate(words):
            if word in POLARITY:
                scaled = at > 0 and words[at - 1] in INTENSITY
                before = at - 2 if scaled else at - 1
                score = Decimal(str(POLARITY[word]))
                if scaled:
                    score *= Decimal(str(INTENSITY[words[at - 1]]))
                if before >= 0 and words[before] in NEGATORS:
                    score *= Decimal("-0.5")
                scores.append(max(Decimal(-1), min(Decimal(1), score)))
        return round(float(sum(scores) / len(scores)), 3) if scores else 0.0

    import random

    rng = random.Random(5)
    vocabulary = list(POLARITY)[:30] + list(INTENSITY) + list(NEGATORS) + ["film", "plot", "actor"]
    texts = [" ".join(rng.choices(vocabulary, k=rng.randint(0, 30))) for _ in range(200)]
    rows = spark.createDataFrame([(text,) for text in texts], "x string").select("x", S.polarity(F.col("x")).alias("p")).collect()
    for row in rows:
        assert abs(float(row["p"]) - plain(row["x"])) < 0.0011


def test_own_lexicon_and_scorer(spark, value):
    lexicon = S.Lexicon(polarity={"gut": 0.5}, intensity={"sehr": 2.0}, negators=("nicht",))
    assert value("nicht sehr gut", lambda c: S.polarity(c, lexicon)) == Decimal("-0.500")
    rows = spark.createDataFrame([("abc",), (None,)], "x string")
    scored = rows.select(S.scored_by(F.col("x"), lambda text: len(text) / 9).alias("p")).collect()
    assert [row["p"] for row in scored] == [Decimal("0.333"), None]


@pytest.mark.parametrize(
    ("score", "review", "movie"),
    [
        ("-0.301", "Negative", "Negative"),
        ("-0.300", "Neutral", "Negative"),
        ("-0.299", "Neutral", "Neutral"),
        ("0.299", "Neutral", "Neutral"),
        ("0.300", "Positive", "Neutral"),
        ("0.301", "Positive", "Positive"),
        (None, None, None),
    ],
)
def test_labels(value, score, review, movie):
    assert value(score, lambda c: S.label(c.cast("decimal(4,3)"))) == review
    assert value(score, lambda c: S.label(c.cast("decimal(4,3)"), "movie")) == movie


def test_unknown_label_variant(spark):
    with pytest.raises(ValueError):
        S.label(F.col("x"), "page")


def test_clean_reviews_keeps_every_row_without_a_shuffle(spark):
    from marquee.schemas import CLEANED, REVIEWS

    rows = [("User Review", "June 5, 2001", "A", None, "8.1", "ann", "9", text) for text in [*TEXTS, None]]
    cleaned = clean_reviews(spark.createDataFrame(rows, REVIEWS))
    assert cleaned.count() == len(rows)
    assert [(f.name, f.dataType) for f in cleaned.schema] == [(f.name, f.dataType) for f in CLEANED]
    plan = cleaned._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan


def test_cleaning_accepts_a_stream(spark, tmp_path):
    from marquee.schemas import REVIEWS

    rows = [("User Review", "TBA", "A", None, "8", "ann", "9", "Really good")]
    spark.createDataFrame(rows, REVIEWS).write.parquet(str(tmp_path / "in"))
    stream = clean_reviews(spark.readStream.schema(REVIEWS).parquet(str(tmp_path / "in")))
    query = (
        stream.writeStream.format("parquet")
        .option("checkpointLocation", str(tmp_path / "state"))
        .trigger(availableNow=True)
        .start(str(tmp_path / "out"))
    )
    query.awaitTermination(60)
    found = spark.read.parquet(str(tmp_path / "out")).first()
    assert (found["review_clean"], found["sentiment_score"]) == ("really good", Decimal("0.910"))
