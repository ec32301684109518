from __future__ import annotations

import datetime
import math
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from marquee.operators import checks, lists, matching, numbering, similar
from marquee.operators.skew import hot_keys, skew_join
from marquee.operators.stats import item_sentiment, review_statistics, score_distribution, table_counts
from marquee.plans import search


def rows_of(df):
    return sorted(tuple(row) for row in df.collect())


@pytest.fixture(scope="module")
def skewed(spark):
    """1,000 rows, a third under one key, some with a NULL key."""
    rows = [(at, "hot" if at % 3 == 0 else None if at % 50 == 1 else f"k{at % 40}") for at in range(1000)]
    return spark.createDataFrame(rows, "id long, key string").repartition(6)


def test_hot_keys_are_few(spark, skewed):
    assert rows_of(hot_keys(skewed, ["key"], floor=50)) == [("hot",)]
    assert rows_of(hot_keys(skewed, ["key"], most=1, floor=1)) == [("hot",)]
    assert hot_keys(skewed, ["key"], floor=0).count() <= 256
    assert hot_keys(skewed, ["key"]).isEmpty()


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_skew_join_equals_join(spark, skewed, how):
    small = spark.createDataFrame([("hot", 1), ("hot", 2), ("k1", 3), ("k2", 4), ("zz", 5), (None, 6)], "key string, v int")
    expected = skewed.join(small, "key", how)
    mine = skew_join(skewed, small, ["key"], spread=["id"], how=how, floor=50, salts=8)
    assert mine.columns == expected.columns
    key = [F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in expected.columns]
    assert rows_of(mine.select(*key)) == rows_of(expected.select(*key))


def test_skew_join_spreads_the_hot_key(spark, skewed):
    small = spark.createDataFrame([("hot", 1)], "key string, v int")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = skew_join(skewed, small, ["key"], spread=["id"], floor=50, salts=8)
        parts = joined.groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len(parts) > 1


def test_numbers_are_dense_and_ordered(spark):
    values = list(range(500))
    random.Random(1).shuffle(values)
    df = spark.createDataFrame([(v % 3, v) for v in values], "same int, v int").repartition(7)
    numbered = numbering.number_rows(df, "n", ["same", F.desc("v")]).collect()
    expected = sorted(((v % 3, v) for v in values), key=lambda row: (row[0], -row[1]))
    assert sorted((row["n"], row["same"], row["v"]) for row in numbered) == [(at + 1, *row) for at, row in enumerate(expected)]


def test_number_in_order_keeps_file_order(spark, tmp_path):
    for at in range(3):
        spark.range(at * 10, at * 10 + 10).coalesce(1).write.parquet(str(tmp_path / f"part={at}"))
    df = spark.read.parquet(*[str(tmp_path / f"part={at}") for at in range(3)])
    numbered = numbering.number_in_order(df, "n")
    assert sorted(row["n"] for row in numbered.collect()) == list(range(1, 31))
    within = numbered.withColumn("block", F.floor(F.col("id") / 10)).withColumn("step", F.col("n") - F.col("id"))
    assert within.groupBy("block").agg(F.countDistinct("step").alias("k")).where("k > 1").isEmpty()
    assert rows_of(numbered) == rows_of(numbered)


def test_file_order_does_not_depend_on_sizes_or_splits(spark, tmp_path):
    ends = [0, 10, 1_010, 101_010]
    for at, (start, end) in enumerate(zip(ends, ends[1:])):
        spark.range(start, end).selectExpr("id", "repeat(cast(id as string), 8) AS pad").coalesce(1).write.parquet(str(tmp_path / f"part={at}"))
    paths = [str(tmp_path / f"part={at}") for at in range(3)]
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in ("64k", "128m"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            numbered = numbering.number_in_order(spark.read.parquet(*paths).where("id >= 0").select("id"), "n")
            assert numbered.where("n <> id + 1").isEmpty() and numbered.count() == ends[-1]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_lists_follow_names_and_pages_are_lazy(spark):
    from marquee.operators import lists

    dim = spark.createDataFrame([(1, "Zed"), (2, "Ann"), (3, "bob"), (4, "Cy")], "k long, name string")
    bridge = spark.createDataFrame([(7, k) for k in (1, 2, 3, 4)] + [(8, 1)], "item long, k long")
    items = spark.createDataFrame([(7,), (8,), (9,)], "item long")
    jobs = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("lazy", "building a plan")
    found = lists.names_per_item(items, bridge, dim, "item", "k", "name", limit=3)
    assert len(jobs.getJobIdsForGroup("lazy")) == 0
    spark.sparkContext.setJobGroup("run", "running it")
    assert rows_of(found) == [(7, 0, "Ann,bob,Cy"), (7, 1, "Zed"), (8, 0, "Zed"), (9, 0, "N/A")]


def test_repeated_keys_without_a_table_of_all_keys(spark):
    rows = [(n, n % 3) for n in range(50)] + [(7, 1)] * 500 + [(8, 2), (None, 1), (None, 1), (None, None)]
    df = spark.createDataFrame(rows, "a long, b long")
    found = checks.table_violations(df, ["a", "b"], {})
    assert [tuple(row) for row in found.collect()] == [("primary key", "a,b", 3)]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate(keys=[a" not in plan and "WindowGroupLimit" in plan
    assert checks.table_violations(df.limit(0), ["a", "b"], {}).first()["violations"] == 0


def test_model_checks_scan_each_table_once(spark, tmp_path):
    from marquee.operators.checks import table_violations

    rows = [(1, "a" * 70, "x"), (1, "b", "y" * 9), (2, None, None)]
    spark.createDataFrame(rows, "k long, name string, note string").write.parquet(str(tmp_path / "t"))
    found = table_violations(spark.read.parquet(str(tmp_path / "t")), ["k"], {"name": 64, "note": 8})
    assert rows_of(found) == [("length", "name", 1), ("length", "note", 1), ("primary key", "k", 1)]
    assert found._jdf.queryExecution().optimizedPlan().toString().count("Relation [") == 1


def test_numbers_of_equal_rows(spark):
    df = spark.createDataFrame([("a",)] * 40, "x string").repartition(5)
    assert sorted(row["n"] for row in numbering.number_rows(df, "n", ["x"]).collect()) == list(range(1, 41))


def test_keys_by_name(spark):
    df = spark.createDataFrame([("b",), ("A",), ("a",), ("C",), (None,), ("b",)], "name string")
    assert rows_of(numbering.keys_by_name(df, "id", "name")) == [(1, "A"), (2, "a"), (3, "b"), (4, "C")]


def test_first_rows(spark):
    df = spark.range(10)
    assert rows_of(numbering.first_rows(df, 3, [F.desc("id")], "n")) == [(7, 3), (8, 2), (9, 1)]
    assert numbering.first_rows(df, 0, ["id"]).count() == 0
    assert numbering.first_rows(df, -1, ["id"]).count() == 0


def test_pages_hold_no_more_than_the_limit(spark):
    rows = [(1, k) for k in range(25)] + [(2, k) for k in range(3)]
    entries = spark.createDataFrame(rows, "item long, key long").repartition(4)
    placed = lists.paged(entries, ["item"], ["key"], 10).collect()
    assert sorted((r["item"], r["key"], r["page"]) for r in placed) == sorted((i, k, k // 10) for i, k in rows)
    assert {r["page"] for r in lists.paged(entries, ["item"], ["key"], 25).collect()} == {0}


def test_names_per_item(spark):
    items = spark.createDataFrame([(1,), (2,), (3,)], "item long")
    bridge = spark.createDataFrame([(1, 2), (1, 1), (2, 3)], "item long, key long")
    dim = spark.createDataFrame([(1, "Ann"), (2, "bob"), (3, "Cid")], "key long, name string")
    assert rows_of(lists.names_per_item(items, bridge, dim, "item", "key", "name")) == [
        (1, 0, "Ann,bob"),
        (2, 0, "Cid"),
        (3, 0, "N/A"),
    ]
    paged = lists.names_per_item(items, bridge, dim, "item", "key", "name", limit=1)
    assert rows_of(paged) == [(1, 0, "Ann"), (1, 1, "bob"), (2, 0, "Cid"), (3, 0, "N/A")]


@pytest.mark.parametrize("large", [lists.LARGE, 8])
def test_lists_of_large_items_equal_those_of_others(spark, monkeypatch, large):
    monkeypatch.setattr(lists, "LARGE", large)
    rows = [(1, "a", k, f"n{k * 7 % 25:02d}") for k in range(25)] + [(1, "b", k, f"m{k}") for k in range(4)]
    rows += [(2, "b", 1, "z"), (2, "b", 2, None), (3, "b", 1, None), (None, "a", 1, "lost")]
    entries = spark.createDataFrame(rows, "item long, kind string, key long, name string").repartition(4)
    wanted = {f"{kind}s": (F.col("kind") == kind, F.col("name")) for kind in ("a", "b")}
    paged = lists.paged_lists(entries, "item", ["name", "key"], wanted, ["kind"], 10)
    names = [f"n{at:02d}" for at in range(25)]
    assert sorted(tuple(row) for row in paged.collect()) == [
        (1, 0, names[:10], ["m0", "m1", "m2", "m3"]),
        (1, 1, names[10:20], []),
        (1, 2, names[20:], []),
        (2, 0, [], ["z"]),
        (3, 0, [], []),
    ]


def test_lists_need_no_rank_of_every_row(spark):
    movies = spark.createDataFrame([(1, 2), (1, 1)], "movie_id long, key long")
    dim = spark.createDataFrame([(1, "Ann"), (2, "bob")], "key long, name string")
    model = {}
    for _, table, bridge, key, name in search.LISTS:
        model[table], model[bridge] = dim.toDF(key, name), movies.toDF("movie_id", key)
    names = search.name_lists(model)
    assert rows_of(names) == [(1, 0, ["Ann", "bob"], ["Ann", "bob"], ["Ann", "bob"])]
    assert "Window" not in names._jdf.queryExecution().optimizedPlan().toString()


def test_similar_lists_bring_facts(spark):
    items = spark.createDataFrame([(1, ["red", "fox"]), (2, ["red"]), (3, ["blue"])], "id long, tags array<string>")
    facts = spark.createDataFrame([(1, "one"), (2, "two"), (3, "three")], "id long, title string")
    found = {row["id"]: row["best"] for row in similar.similar_lists(items, "id", facts=facts).collect()}
    assert [(other["other"], other["title"]) for other in found[1]] == [(2, "two")]
    assert [(other["other"], other["title"]) for other in found[2]] == [(1, "one")]


def test_checks_find_violations(spark):
    child = spark.createDataFrame([(1, "ab"), (1, "abc"), (2, "x"), (None, "y")], "k long, t string")
    parent = spark.createDataFrame([(1,)], "k long")
    assert rows_of(checks.duplicate_keys(child.dropna(), ["k"])) == [(1, 2)]
    assert rows_of(checks.orphans(child, parent, "k")) == [(2, 1)]
    assert rows_of(checks.too_long(child, "t", 2).select("t", "n")) == [("abc", 3)]
    wide = spark.createDataFrame([(5.0,), (123.0,), (None,)], "v double")
    assert rows_of(checks.out_of_range(wide, "v", "decimal(3,1)")) == [(123.0,)]


def test_review_matching(spark):
    day, other = datetime.date(2001, 6, 5), datetime.date(2005, 1, 1)
    catalog = spark.createDataFrame(
        [(10, "A", other, 1), (11, "A", day, 2), (12, "A", day, 3), (13, "B", None, 4), (14, "B", day, 5)],
        "movie_id long, title string, date date, position long",
    )
    reviews = spark.createDataFrame(
        [(1, "A", day), (2, "A", other), (3, "A", None), (4, "B", None), (5, "B", day), (6, "A", datetime.date(1990, 1, 1)), (7, "Z", None), (8, None, day)],
        "id long, title string, date date",
    )
    matched = matching.match_reviews(reviews, catalog, "id").select("id", F.coalesce("movie_id", F.lit(-1)))
    assert rows_of(matched) == [(1, 11), (2, 10), (3, 10), (4, 13), (5, 14), (6, -1), (7, -1), (8, -1)]


def test_ranks_are_used_once(spark):
    movies = spark.createDataFrame([(1, "A"), (2, "A"), (3, "B"), (4, "C")], "id long, title string")
    ranks = spark.createDataFrame([("A", 7), ("C", 1), ("C", 9), ("D", 4)], "title string, rank long")
    assert rows_of(matching.assign_ranks(movies, ranks, "id").select("id", "rank")) == [(1, 7), (2, -1), (3, -1), (4, 9)]


def test_statistics(spark):
    rows = [("a", "0.500", 8.0), ("a", "-0.500", None), ("b", None, 4.0)]
    df = spark.createDataFrame(rows, "review_type string, p string, score double")
    df = df.withColumn("sentiment_score", F.col("p").cast("decimal(4,3)"))
    found = {row["review_type"]: row for row in review_statistics(df).collect()}
    assert (found["all"]["n"], found["all"]["avg_score"], found["all"]["avg_sentiment"]) == (3, 6.0, 0.0)
    assert (found["a"]["min_score"], found["a"]["max_score"]) == (8.0, 8.0)
    assert found["b"]["avg_sentiment"] is None


def test_item_sentiment_counts_reviews_without_polarity(spark):
    df = spark.createDataFrame([(1, "0.600"), (1, None), (2, None)], "item long, p string")
    df = df.withColumn("polarity", F.col("p").cast("decimal(4,3)"))
    found = {row["item"]: row for row in item_sentiment(df, "item").collect()}
    assert (found[1]["n_reviews"], str(found[1]["polarity_mean"]), found[1]["verdict"]) == (2, "0.300", "Neutral")
    assert (found[2]["polarity_mean"], found[2]["verdict"]) == (None, None)


def test_distribution_and_counts(spark):
    df = spark.createDataFrame([(1, "0.3"), (1, "-0.3"), (1, "-0.4"), (1, None)], "item long, p string")
    df = df.withColumn("polarity", F.col("p").cast("decimal(4,3)"))
    assert rows_of(score_distribution(df, "item")) == [(1, 1, 1, 1)]
    assert rows_of(table_counts({"x": df, "y": spark.range(3)})) == [("x", 4), ("y", 3)]


def brute_force(items, count):
    """Every pair of items, plain floats."""
    tokens = {item: similar_tokens(tags) for item, tags in items}
    df = defaultdict(int)
    for words in tokens.values():
        for word in set(words):
            df[word] += 1
    n = len(items)

    def vector(words):
        return {w: words.count(w) * (math.log((1 + n) / (1 + df[w])) + 1) for w in set(words)}

    vectors = {item: vector(words) for item, words in tokens.items()}
    norm = {item: math.sqrt(sum(w * w for w in v.values())) for item, v in vectors.items()}
    result = {}
    for a, va in vectors.items():
        scores = []
        for b, vb in vectors.items():
            dot = sum(va[w] * vb[w] for w in va.keys() & vb.keys())
            if a != b and dot > 0:
                scores.append((-round(dot / norm[a] / norm[b], 5), b))
        result[a] = [(b, -s) for s, b in sorted(scores)[:count]]
    return result


def similar_tokens(tags):
    folded = " ".join(tags).replace("Sci-Fi", "SciFi").replace("Film-Noir", "Noir")
    return [word for word in "".join(c if c.isalnum() else " " for c in folded.lower()).split() if len(word) > 1 and word != "the"]


@pytest.fixture(scope="module")
def tagged():
    """120 items, a third with one and the same tag, some with repeated, hyphenated or no tags."""
    rng = random.Random(3)
    vocabulary = ["Drama", "Comedy", "Sci-Fi", "Film-Noir", "War", "Music", "Crime", "Family", "Action", "The"]
    items = []
    for at in range(120):
        if at % 3 == 0:
            tags = ["Drama"]
        elif at % 17 == 1:
            tags = []
        else:
            tags = rng.sample(vocabulary, rng.randint(1, 5))
            if at % 7 == 0:
                tags.append("War War")
        items.append((at, tags))
    return items


def test_similar_top_equals_brute_force(spark, tagged):
    df = spark.createDataFrame(tagged, "item long, tags array<string>")
    found = defaultdict(list)
    for row in similar.similar_top(df, "item", count=6).orderBy("item", "rk").collect():
        assert row["rk"] == len(found[row["item"]]) + 1 and row["other"] != row["item"]
        assert 0 < row["score"] <= 1.0000001
        found[row["item"]].append((row["other"], row["score"]))
    expected = brute_force(tagged, 6)
    for item, best in expected.items():
        assert [round(score, 4) for _, score in found[item]] == pytest.approx([score for _, score in best], abs=2e-4)
        clear = [b for b, score in best if score - best[-1][1] > 1e-4]
        assert [other for other, _ in found[item]][: len(clear)] == clear or set(clear) <= {o for o, _ in found[item]}


def test_similar_to_equals_similar_top(spark, tagged):
    df = spark.createDataFrame([(i, f"t{i}", tags) for i, tags in tagged], "item long, title string, tags array<string>")
    every = similar.similar_top(df, "item", count=6)
    for item in (0, 7, 14, 25):
        one = similar.similar_to(df, "item", F.col("title") == f"t{item}", count=6)
        expected = every.where(F.col("item") == item).select("rk", "other", F.round("score", 9))
        assert rows_of(one.select("rk", "other", F.round("score", 9))) == rows_of(expected)


def test_cosine_is_symmetric(spark, tagged):
    df = spark.createDataFrame(tagged, "item long, tags array<string>")
    first = {r["other"]: r["score"] for r in similar.cosine_to(df, "item", F.col("item") == 7).collect()}
    other = min(first)
    back = {r["other"]: r["score"] for r in similar.cosine_to(df, "item", F.col("item") == other).collect()}
    assert back[7] == pytest.approx(first[other])


def test_similar_excludes_a_title(spark):
    rows = [(1, "A", ["War"]), (2, "A", ["War"]), (3, "B", ["War"]), (4, "C", [])]
    df = spark.createDataFrame(rows, "item long, title string, tags array<string>")
    same = F.col("title") == "A"
    assert [r["other"] for r in similar.similar_to(df, "item", same).collect()] == [2, 3]
    assert [r["other"] for r in similar.similar_to(df, "item", same, exclude=same).collect()] == [3]
    assert similar.similar_to(df, "item", F.col("title") == "Z").count() == 0


def test_similar_top_takes_any_number_of_tags(spark):
    wide = [(1, [f"tag{at:02}" for at in range(20)]), (2, ["tag19"]), (3, ["tag01"]), (4, ["other", "tag01"])]
    df = spark.createDataFrame(wide, "item long, tags array<string>")
    top = similar.similar_top(df, "item").where("item = 1").orderBy("rk").collect()
    one = similar.similar_to(df, "item", F.col("item") == 1).orderBy("rk").collect()
    assert [(r["other"], r["score"]) for r in top] == [(r["other"], r["score"]) for r in one]
    assert {r["other"] for r in top} == {2, 3, 4}


def test_similar_top_equals_all_pairs(spark):
    import random

    source = random.Random(3)
    items = [(n, [f"t{min(int(source.expovariate(0.15)), 40):02}" for _ in range(source.randint(0, 18))]) for n in range(150)]
    df = spark.createDataFrame(items, "item long, tags array<string>")
    top = {}
    for row in similar.similar_top(df, "item", count=4).collect():
        top.setdefault(row["item"], []).append((row["rk"], row["other"], round(row["score"], 9)))
    vectors = {}
    for row in similar.tfidf(df, "item").collect():
        vectors.setdefault(row["item"], {})[row["token"]] = row["weight"]
    for number, mine in vectors.items():
        scores = []
        for other, theirs in vectors.items():
            shared = mine.keys() & theirs.keys()
            if other != number and shared:
                scores.append((-round(sum(mine[token] * theirs[token] for token in shared), 9), other))
        want = [(rk, other, -score) for rk, (score, other) in enumerate(sorted(scores)[:4], 1)]
        assert [score for *_, score in sorted(top.get(number, []))] == pytest.approx([score for *_, score in want], abs=1e-7)


def test_similar_top_forms_no_rows_of_pairs(spark, monkeypatch):
    """Many runs of sets, ties within and across them, and weights beyond 64 bits give what all pairs give."""
    monkeypatch.setattr("marquee.operators.similar.ASKING", 7)
    monkeypatch.setattr("marquee.operators.similar.OFFERED", 16)
    rng = random.Random(5)
    for repeated in (1, 40_000):
        items = [(n, ["common"] * (repeated if n == 3 else 1) + rng.sample([f"t{at:02}" for at in range(12)], 3)) for n in range(90)]
        df = spark.createDataFrame(items, "item long, tags array<string>")
        top = similar.similar_top(df, "item", count=5)
        assert "array_intersect" not in top._jdf.queryExecution().toString()
        found = defaultdict(list)
        for row in top.orderBy("item", "rk").collect():
            found[row["item"]].append((row["other"], row["score"]))
        for item in (0, 3, 40, 89):
            one = similar.similar_to(df, "item", F.col("item") == item, count=5).orderBy("rk").collect()
            assert found[item] == [(row["other"], row["score"]) for row in one]


def test_tfidf_vectors_have_length_one(spark, tagged):
    df = spark.createDataFrame(tagged, "item long, tags array<string>")
    lengths = similar.tfidf(df, "item").groupBy("item").agg(F.sum(F.col("weight") ** 2).alias("l")).collect()
    assert all(row["l"] == pytest.approx(1.0) for row in lengths)
    assert {row["item"] for row in lengths} == {i for i, tags in tagged if similar_tokens(tags)}


def test_similar_top_rules_out_what_shares_a_common_token_only(spark):
    """Most pairs share nothing but a token of all sets: few of them are scored, and the best are those of all pairs."""
    rng = random.Random(8)
    n = 3_000
    items = [(at, ["all"] * rng.choice([1, 1, 1, 3]) + [f"t{rng.randrange(2_000):04}" for _ in range(rng.randint(1, 9))]) for at in range(n)]
    df = spark.createDataFrame(items, "item long, tags array<string>")
    top = similar.similar_top(df, "item", count=4).orderBy("item", "rk").collect()
    found = defaultdict(list)
    for row in top:
        found[row["item"]].append((row["other"], row["score"]))
    for item in (0, 1, 1_500, n - 1):
        one = similar.similar_to(df, "item", F.col("item") == item, count=4).orderBy("rk").collect()
        assert found[item] == [(row["other"], row["score"]) for row in one]


def test_runs_leave_most_pairs_unscored(monkeypatch):
    """A run of sets that share a common token with all others adds up the products of the other tokens, not those of all pairs."""
    import numpy as np

    rng, n, wanted = np.random.default_rng(4), 4_096, 6

    def made(first):
        tokens = np.sort(rng.integers(0, 40_000, n * 8))
        places = rng.permutation(np.repeat(np.arange(n), 8)).astype(np.int32)
        weights, table = np.full(n * 8, 9 * similar.UNIT), np.full((n, 1), 8 * similar.UNIT)
        squares = np.bincount(places, minlength=n) * 81.0 + 64.0
        return [part.tobytes() for part in (np.arange(first, first + n), np.sqrt(squares), table, tokens, places, weights)]

    asking, sums = similar._Run(made(0), 1, wanted), np.zeros(similar.CHUNK * n, np.float32)
    scored = []
    real = similar._meet_sets
    monkeypatch.setattr(similar, "_meet_sets", lambda *given: (scored.append(len(given[2]) if given[3] else 0), real(*given)))
    for first in (n, 2 * n, 3 * n):
        similar._meet(asking, similar._Run(made(first), 1), False, sums)
    assert not sums.any() and (asking.others >= 0).all()
    assert sum(scored) < 2 * n  # of three runs that each share the token with all sets of this one
