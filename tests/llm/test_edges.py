"""Nulls, empty and long texts, ties and repeated rows, empty tables and columns with clashing names."""

from __future__ import annotations

import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from marquee.llm import bpe, exact, licenses, lines, mixing, neardup, pii, quality, secrets, vectors
from marquee.llm.common import settled

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, id long, sha string, rep long, key string, "
    "size string, rank string, removed string, spans string, kept string, component string, row string, _salt string, content string"
)
CLASH = ("x",) * 11


def rows():
    long = "word " * 30_000 + "pässword=abcdefgh12 " + "z" * 50_000
    base = [
        (1, "password=abcdefgh12 call +1 (555) 123-4567 or mail a.b@c.de.", "en", "s1"),
        (2, None, "en", "s1"),
        (3, "", None, None),
        (None, "no id here", "en", "s2"),
        (4, long, "en", "s2"),
        (5, "line one\nline two\nline three\nline four", "en", "s3"),
        (5, "line one\nline two\nline three\nline four", "en", "s3"),
        (6, "zero\nline one\nline two\nline three", "de", None),
        (7, "under the mit license", "en", "s1"),
        (8, "under  the MIT\tlicense", "en", "s1"),
    ]
    return [(number, text, lang, source, None, *([9] + ["x"] + [9] + list(CLASH[:10]))) for number, text, lang, source in base]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rows(), SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture
def index(spark):
    found = exact.DigestIndex(spark, f"edges_{id(spark)}_{__import__('uuid').uuid4().hex}", buckets=2)
    yield found
    found.drop()


def model():
    good = [f"plain words of number {n} in a row that says something" for n in range(40)]
    bad = [f"junk{n}*** junk$$$ junk### junk*** again again" for n in range(40)]
    return quality.fit(good + bad, [2] * 40 + [0] * 40)


OPERATORS = {
    "secrets": lambda docs: secrets.digests(secrets.scan(docs)),
    "bpe": lambda docs: bpe.digests(bpe.encode(docs, public_tokenizers.path("word_bpe_49k.json"))),
    "licenses": lambda docs: licenses.digests(licenses.search(docs)),
    "neardup": lambda docs: neardup.dedup(docs),
    "mixing": lambda docs: mixing.digests(mixing.mix(docs, block=16)),
    "lines": lambda docs: lines.digests(lines.remove(docs)),
    "pii": lambda docs: pii.digests(pii.find(docs)),
    "quality": lambda docs: quality.classify(docs, model()),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_one_answer_per_row(docs, name):
    found = OPERATORS[name](docs).collect()
    assert sorted((row["doc_id"] is None, row["doc_id"] or 0) for row in found) == sorted((r[0] is None, r[0] or 0) for r in rows())


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_table(none, name):
    assert OPERATORS[name](none).count() == 0


def test_exact(docs, none, index):
    found = exact.ingest(docs, index).collect()
    assert len(found) == len(rows())
    by_id = {}
    for row in found:
        by_id.setdefault(row["doc_id"], []).append(row)
    assert [row["kept"] for row in by_id[2]] == [True] and by_id[3][0]["keep_id"] == 2
    assert sorted(row["kept"] for row in by_id[5]) == [False, True] and by_id[5][0]["group_size"] == 2
    assert by_id[8][0]["keep_id"] == 8  # letters differ
    again = exact.ingest(docs, index).collect()
    assert sorted(map(str, again)) == sorted(map(str, found))
    assert exact.ingest(none, index).count() == 0


def test_exact_keeps_rows_as_they_were(docs, index):
    kept = exact.keep_first(docs, settled(exact.ingest(docs, index)))
    assert kept.columns == docs.columns and kept.count() == 8


def test_index_lasts_over_batches(spark, index):
    first = spark.createDataFrame([(10, "a  b"), (11, "c")], "doc_id long, text string")
    second = spark.createDataFrame([(1, "a b"), (2, "d"), (3, "d")], "doc_id long, text string")
    exact.ingest(first, index).collect()
    found = {row["doc_id"]: (row["keep_id"], row["kept"]) for row in exact.ingest(second, index).collect()}
    assert found == {1: (10, False), 2: (2, True), 3: (2, False)}
    assert index.rows().count() == 3


def test_near_copies_stage_keeps_columns(docs):
    kept = neardup.keep_first(docs, neardup.dedup(docs))
    assert kept.columns == docs.columns
    assert {row["doc_id"] for row in kept.collect()} >= {1, 2, 3, 4, None}


def test_repeated_rows_of_the_mix(docs, none):
    mixed = mixing.repeated(docs, mixing.mix(docs, block=16))
    assert mixed.columns == docs.columns and mixed.where("text IS NULL OR text = ''").count() == 0
    assert mixing.repeated(none, mixing.mix(none)).count() == 0


def test_classifier_without_labels_keeps_all(docs, spark):
    ratings = quality.graded(spark.createDataFrame([], "doc_id long, quality int, toxic int"))
    fitted = quality.train(docs, ratings)
    assert fitted is None and quality.keep_good(docs, fitted).count() == docs.count()
    assert quality.classify(docs, fitted).where("kept").count() == docs.count()


def test_vectors(spark):
    nan, inf = float("nan"), float("inf")
    table = [
        (1, [1.0, 0.0], 1, "x"), (2, [2.0, 0.01], None, "x"), (3, None, 1, "x"), (4, [0.0, 0.0], 1, "x"), (5, [nan, 1.0], 1, "x"),
        (6, [inf, 1.0], 1, "x"), (7, [None, 1.0], 1, "x"), (8, [1.0, 0.0, 0.0], 1, "x"), (9, [1.0, 0.0], 2, "x"), (9, [1.0, 0.0], 2, "x"),
        (None, [1.0, 0.0], 2, "x"), (10, [], 1, "x"), (11, [0.0, 1.0], 1, "x"),
    ]
    frame = spark.createDataFrame(table, "vec_id long, embedding array<float>, label int, rep string")
    found = sorted(((r["vec_id"] or 0, r["n_links"], r["component_id"], r["kept"]) for r in vectors.dedup(frame).collect()))
    alone = [(n, 0, n, True) for n in (3, 4, 5, 6, 7, 8, 10, 11)]
    assert found == sorted([(0, 0, None, True), (1, 2, 1, True), (2, 2, 1, False), (9, 2, 1, False), (9, 2, 1, False), *alone])
    assert vectors.dedup(frame.limit(0)).count() == 0


def test_pipeline_stages(spark, docs, none, tmp_path):
    spark.createDataFrame([(1, 1, 0), (7, 0, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    plain = docs.select("doc_id", "text", "lang", "source", "n_chars")
    for start in (plain, plain.limit(0)):
        current = start
        for place, (_, stage) in enumerate(corpus_pipeline.STAGES):
            current = settled(stage(spark, current, str(tmp_path)))
            if place < len(corpus_pipeline.STAGES) - 1:
                assert current.columns == plain.columns
        assert "ids" in current.columns
    assert len(corpus_pipeline.STAGES) == 5 and F is not None
