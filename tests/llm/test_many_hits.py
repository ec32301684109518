"""Texts with very many hits."""

from __future__ import annotations

import time

import pytest
from pyspark.sql import functions as F

from marquee.llm import pii, secrets
from marquee.llm.common import matches


def test_places_of_many_matches(spark):
    texts = ["", "x", "é ab é", "ab", "abab " * 7, "ab é" * 100_000]
    frame = spark.createDataFrame([(text,) for text in texts], "text string")
    start = time.time()
    for row in frame.select("text", matches(F.col("text"), "ab").alias("found")).collect():
        at, want = row["text"].find("ab"), []
        while at >= 0:
            want.append((at, at + 2, "ab"))
            at = row["text"].find("ab", at + 2)
        assert list(map(tuple, row["found"])) == want
    assert time.time() - start < 60


@pytest.mark.parametrize("scan", ["secrets", "pii"])
def test_many_hits_in_one_text(spark, scan):
    count = 20_000
    line = "token=abcdefgh12345 " if scan == "secrets" else "a@b.cd "
    frame = spark.createDataFrame([(1, line * count, "s")], "doc_id long, text string, source string")
    start = time.time()
    found = secrets.digests(secrets.scan(frame)) if scan == "secrets" else pii.digests(pii.find(frame))
    row = found.first()
    assert row["n_assign" if scan == "secrets" else "n_email"] == count
    print(scan, time.time() - start)
    assert time.time() - start < 120
