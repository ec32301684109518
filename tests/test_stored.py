"""Stored tables: text index, key register, snapshots, crawl rounds."""

from __future__ import annotations

import random
from uuid import uuid4

import pytest
from pyspark.sql import functions as F

from marquee.operators.crawl import SeenPages
from marquee.operators.register import KeyRegister
from marquee.plans.indexes import TextIndex
from marquee.plans.search import checked_keyword
from marquee.sources.snapshots import Conflict, Snapshots


@pytest.fixture
def index(spark):
    made = TextIndex(spark, f"index_{uuid4().hex}", buckets=4)
    yield made
    made.drop()


def frame(spark, rows):
    return spark.createDataFrame(rows, "key long, text string, kind string")


def texts(seed, count):
    source = random.Random(seed)
    words = ["The", "ring", "of", "RINGS", "étage", "O'Neil", "x1", "a", "100%", "under_score", "日本語", "\U0001f600ok"]
    say = lambda: source.choice([" ", ", ", "  ", "-"]).join(source.choice(words) for _ in range(source.randint(0, 12)))
    return [(n, say(), "k") for n in range(count)]


KEYWORDS = ["ring", "RINGS of", "ng", "of, the", "the-ring", "a a", "neil", "0%, the", "r_s", "a", "x1 a", "étage the", "ring's", "e  o", "1", "s o", "ok", "日本語 a"]


def test_search_equals_a_scan(spark, index):
    rows = texts(1, 300) + [(900, None, "k"), (901, "", "k"), (902, "xring of", "k")]
    index.add(frame(spark, rows))
    for word in KEYWORDS:
        try:
            low = checked_keyword(word)
        except ValueError:
            continue
        want = sorted((key, text) for key, text, _ in rows if text is not None and low in text.lower())
        assert sorted((row["key"], row["text"]) for row in index.containing(word).collect()) == want, word
        assert sorted((row["key"], row["text"]) for row in index.phrase(word).collect()) == want, word
    with pytest.raises(ValueError):
        index.containing("%")


def test_changes_reach_the_postings(spark, index):
    index.add(frame(spark, [(1, "red ring", "a"), (2, "blue ring", "a"), (3, "green", "a")]))
    index.add(frame(spark, [(2, "blue widget", "b"), (4, "ring four", "b")]))
    index.remove(spark.createDataFrame([(1,)], "key long"))
    for found in (index.containing("ring"), index.phrase("ring")):
        assert {(row["key"], row["kind"]) for row in found.collect()} == {(4, "b")}
    assert {row["key"] for row in index.containing("widget").collect()} == {2}
    fresh = index.rebuild(f"index_{uuid4().hex}")
    assert fresh.table("texts").count() == 3 and fresh.containing("blue ring").count() == 0 and fresh.containing("ring").count() == 1
    fresh.drop()


def test_many_candidates_and_blocks(spark, index, monkeypatch):
    monkeypatch.setattr("marquee.plans.indexes.FEW", 5)
    monkeypatch.setattr("marquee.plans.indexes.BLOCK_TEXTS", 16)
    monkeypatch.setattr("marquee.plans.indexes.FILE_TEXTS", 50)
    rows = texts(2, 200)
    index.add(frame(spark, rows))
    for word in ("the ring", "ring", "a, the", "ng"):
        want = sorted(key for key, text, _ in rows if word in text.lower())
        assert sorted(row["key"] for row in index.containing(word).collect()) == want
        assert sorted(row["key"] for row in index.phrase(word).collect()) == want
    held = index.table("words").where("word = 'the'")
    assert held.count() > 5 and held.agg(F.max(F.size("entries"))).first()[0] <= 40


def test_postings_are_lists_of_blocks(spark, index, monkeypatch):
    """A trigram or word is one row per block, however many texts of the block have it."""
    monkeypatch.setattr("marquee.plans.indexes.BLOCK_TEXTS", 64)
    rows = texts(4, 400) + [(900 + at, "the the ring. " * at, "k") for at in range(20)]
    index.add(frame(spark, rows))
    index.add(frame(spark, [(3, "ring the", "k"), (905, "the ring the", "k")]))
    last = dict((key, text) for key, text, _ in rows) | {3: "ring the", 905: "the ring the"}
    for kind, name, most in (("grams", "gram", "the"), ("words", "word", "the")):
        held = index.table(kind)
        assert held.where(F.col(name) == most).count() <= 8
        assert held.count() == held.select(name, "block").distinct().count()
    for word in ("the ring", "ring the", "the the", "ring. the", "he ri"):
        want = sorted(key for key, text in last.items() if word in text.lower())
        assert sorted(row["key"] for row in index.phrase(word).collect()) == want, word
        assert sorted(row["key"] for row in index.containing(word).collect()) == want, word


def test_plan_reads_some_buckets_and_no_other_text(spark, index):
    index.add(frame(spark, texts(3, 300) + [(999, "a rare zqj word", "k")]))
    plan = index.containing("zqj")._jdf.queryExecution().executedPlan().treeString()
    assert "SelectedBucketsCount: 1 out of 4" in plan and "key IN (999)" in plan.replace("[999]", "(999)") or "999" in plan


def test_keys_last(spark):
    register = KeyRegister(spark, f"names_{uuid4().hex}", buckets=4)
    load = lambda names: {row["name"]: row["key"] for row in register.load(spark.createDataFrame([(n,) for n in names], "name string")).collect()}
    try:
        assert load(["b", "a", "b", None]) == {"a": 1, "b": 2}
        assert load(["0", "c", "a"]) == {"a": 1, "b": 2, "0": 3, "c": 4}
        assert load(["c", "0"]) == {"a": 1, "b": 2, "0": 3, "c": 4} and load([]) == load(["a"])
        pairs = spark.createDataFrame([(1, "a"), (2, "c"), (3, None), (4, "zz")], "id long, name string")
        assert {(row["id"], row["k"]) for row in register.keyed(pairs, "name", "k", ["id"]).collect()} == {(1, 1), (2, 4), (3, None), (4, None)}
        plan = register.rows().join(spark.createDataFrame([("a",)], "name string").hint("merge"), "name", "left_anti")
        assert plan is not None
    finally:
        register.drop()


@pytest.fixture
def folder(tmp_path):
    return f"file://{tmp_path}/model"


def numbers(spark, *values):
    return spark.createDataFrame([(value,) for value in values], "n long")


def test_readers_keep_their_snapshot(spark, folder):
    store = Snapshots(spark, folder)
    assert store.read() == {} and store.commit({"a": numbers(spark, 1), "b": numbers(spark, 5)}) == 1
    early = store.read()
    assert store.commit({"a": early["a"].select((F.col("n") + 1).alias("n"))}) == 2
    assert early["a"].collect()[0]["n"] == 1 and store.read()["a"].collect()[0]["n"] == 2
    assert store.read()["b"].collect()[0]["n"] == 5 and store.read(1)["a"].collect()[0]["n"] == 1
    store.expire()
    assert store.versions() == [2] and store.read()["b"].count() == 1
    store.drop()


def test_failed_write_leaves_the_old_model(spark, folder):
    store = Snapshots(spark, folder)
    store.commit({f"t{n}": numbers(spark, n) for n in range(12)})
    broken = {f"t{n}": numbers(spark, 100) for n in range(7)}
    broken["t7"] = numbers(spark, 1).select(F.raise_error(F.lit("no")).cast("long").alias("n"))
    with pytest.raises(Exception, match="no"):
        store.commit(broken)
    assert store.versions() == [1] and [store.read()[f"t{n}"].first()["n"] for n in range(12)] == list(range(12))
    store.expire()
    assert store.read()["t3"].first()["n"] == 3


def test_second_writer_is_told(spark, folder):
    store = Snapshots(spark, folder)
    store.commit({"a": numbers(spark, 1)})
    base = store.manifest()
    store.commit({"a": numbers(spark, 2)}, base)
    with pytest.raises(Conflict):
        store.commit({"a": numbers(spark, 3)}, base)
    assert store.read()["a"].first()["n"] == 2 and store.versions() == [1, 2]


def test_rounds_hand_out_a_page_once(spark):
    seen = SeenPages(spark, f"seen_{uuid4().hex}", buckets=4)
    links = lambda *urls: spark.createDataFrame([(url,) for url in urls], "abs_url string")
    try:
        seen.fetched(spark.createDataFrame([("http://a/#top",), ("http://b/",)], "url string"))
        rounds = [
            links("http://a/", "http://c/", "http://c/#x", None, "mailto:x@y"), links("http://c/", "http://d/", "http://b/"), links("http://d/", "http://c/")
        ]
        found = [sorted(row["abs_url"] for row in seen.next_round(one).collect()) for one in rounds]
        assert found == [["http://c/"], ["http://d/"], []]
    finally:
        seen.drop()
