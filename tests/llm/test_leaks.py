"""Decontamination against a plain search of every window in every document."""

from __future__ import annotations

import random
import re
import time
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from marquee.llm import contamination

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items):
    out = []
    cut = []
    for item, text in items:
        found = words(text)
        n = min(10, len(found))
        cut.append((item, n, {tuple(found[i : i + n]) for i in range(len(found) - n + 1)} if n else set()))
    for number, text in docs:
        found, hit, names = words(text), set(), set()
        for item, n, windows in cut:
            for i in range(len(found) - n + 1 if windows else 0):
                if tuple(found[i : i + n]) in windows:
                    hit |= set(range(i, i + n))
                    names.add(item)
        digest = sha256(",".join(sorted(str(name) for name in names if name is not None)).encode()).hexdigest()
        out.append((number, len(found), len(hit), len(names), digest, bool(hit)))
    return sorted(out, key=str)


def found(spark, docs, items):
    docs = spark.createDataFrame([(*row, "x", "y") for row in docs], "doc_id long, text string, key string, words string")
    items = spark.createDataFrame([(*row, "x") for row in items], "item_id long, text string, content string")
    return sorted(map(tuple, contamination.digests(docs, *contamination.find(docs, items)).collect()), key=str)


@pytest.fixture(scope="module")
def tables():
    source = random.Random(11)
    vocabulary = [f"w{n}" for n in range(40)] + ["É", "é", "STRASSE", "straße", "x1", "日本"]
    say = lambda n: source.choice([" ", ", ", "\n"]).join(source.choice(vocabulary) for _ in range(n))
    items = [(n, say(source.choice([3, 9, 10, 11, 30]))) for n in range(25)] + [(90, ""), (91, None), (92, "w1"), (93, "a " * 40), (None, say(12))]
    items += [(94, items[3][1]), (3, items[5][1])]
    docs = []
    for n in range(60):
        parts = [say(source.randint(0, 30))]
        for _ in range(source.randint(0, 3)):
            text = source.choice(items)[1] or ""
            kept = text.split()[source.randint(0, 2) :]
            parts += [" ".join(kept).upper() if source.random() < 0.3 else " ".join(kept), say(source.randint(0, 9))]
        docs.append((n, " ".join(parts)))
    docs += [(100, None), (101, ""), (102, "a " * 3000), (103, say(20_000)), (7, docs[7][1]), (7, docs[8][1]), (None, items[4][1])]
    return docs, items


def test_windows_against_brute_force(spark, tables):
    assert found(spark, *tables) == brute(*tables)


def test_blocks_of_windows(spark, tables, monkeypatch):
    monkeypatch.setattr(contamination, "BLOCK_BYTES", 4_000)
    assert found(spark, *tables) == brute(*tables)


def test_empty_tables(spark, tables):
    docs, items = tables
    assert found(spark, docs[:3], []) == brute(docs[:3], []) and found(spark, [], items) == []


def test_plan_is_native_and_leaves_texts_in_place(spark, tables):
    docs, items = (spark.createDataFrame(rows, schema) for rows, schema in zip(tables, ("doc_id long, text string", "item_id long, text string")))
    plan = contamination.digests(docs, *contamination.find(docs, items))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan


def test_every_sign_is_on_the_right_side_of_a_cut(spark):
    signs = [chr(n) for n in [*range(1, 0x300), 0x2028, 0xD7FF, 0xE000, 0xFFFD, 0xFFFF, 0x10000, 0x1F600, 0x10FFFF]]
    text = "".join(f"a{sign}b{sign * 2} " for sign in signs)
    split = spark.createDataFrame([(text,)], "text string").select(contamination.words(F.col("text")).alias("words")).first()["words"]
    assert split == re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", text)


def test_words_are_cut_as_fast_as_what_is_between_them(spark):
    """With eight tasks in one JVM, a class written as what it does not hold takes 4 to 10 times as long."""
    text = F.concat(F.repeat(F.lit("some wörds, 日本 Words and a sentence. "), 1_000), F.col("id").cast("string"))
    texts = spark.range(400, numPartitions=8).select(text.alias("text")).localCheckpoint()

    def taken(pattern):
        times = []
        for _ in range(4):
            start = time.perf_counter()
            texts.select(F.regexp_count("text", F.lit(pattern))).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        return min(times)

    assert taken(contamination.WORD) < 3 * taken(r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
