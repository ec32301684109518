"""License notices against a brute force over all runs of words."""

from __future__ import annotations

import random
import time

import duckdb
import pytest

from marquee.llm import licenses
from marquee.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"


def edits_between(text, notice):
    row = list(range(len(notice) + 1))
    for at, sign in enumerate(text):
        before, row = row, [at + 1]
        for place, own in enumerate(notice):
            row.append(before[place] if sign == own else 1 + min(before[place], before[place + 1], row[place]))
    return row[-1]


def brute(text):
    words = licenses.normal(text)[0].split()
    near, spans = [], []
    for which, (notice, _, most, exact) in enumerate(licenses.NOTICES):
        for first in range(len(words)):
            run = ""
            for last in range(first, len(words)):
                run = f"{run} {words[last]}".strip()
                if len(run) > len(notice) + most:
                    break
                if len(run) >= len(notice) - most and set(exact) <= set(run.split()) and (apart := edits_between(run, notice)) <= most:
                    near.append((apart, first, len(run), last, which, run))
    taken = []
    for apart, first, _, last, which, run in sorted(near):
        if all(other != which or last < start or end < first for other, start, end in taken):
            taken.append((which, first, last))
            spans.append((licenses.NOTICES[which][1], first, last, apart, run))
    return sorted(spans, key=lambda span: (span[1], span[2], span[0], span[3]))


def garbled(source, text, times):
    for _ in range(times):
        at, sign = source.randrange(len(text) + 1), source.choice("abeilst ")
        text = source.choice([text[:at] + sign + text[at:], text[:at] + text[at + 1 :], text[:at] + sign + text[at + 1 :]])
    return text


@pytest.mark.parametrize("seed", range(4))
def test_spans_of_made_texts(seed):
    source = random.Random(seed)
    other = ["license", "under", "the", "mit", "gnu", "bsd", "3", "all", "rights", "x", "public"]
    for _ in range(120):
        parts = []
        for _ in range(source.randint(1, 6)):
            parts.append(garbled(source, source.choice(licenses.NOTICES)[0], source.randint(0, 4)))
            parts += source.choices(other, k=source.randint(0, 3))
        text = " ".join(parts)
        assert licenses.fuzzy_places(licenses.normal(text)[0]) == brute(text), text


def test_query_against_all_runs(spark):
    texts = dict(duckdb.sql(f"SELECT doc_id, text FROM '{SMALL}/documents.parquet'").fetchall())
    for row in QUERIES["op3_license_scan"](spark, SMALL).collect():
        spans = brute(texts[row["doc_id"]])
        assert row["spans"] == ",".join(f"{label}:{first}:{last}:{apart}" for label, first, last, apart, _ in spans)
        base = {label for label, _ in licenses.base_places(licenses.normal(texts[row["doc_id"]])[0])}
        assert row["labels"] == ",".join(sorted(base | {span[0] for span in spans}))
        best = max([1 - apart / len(run) for _, _, _, apart, run in spans] or [0])
        assert row["score"] == pytest.approx(1.0 if base else max(best, 0))


def test_many_hits_in_one_text():
    words = licenses.normal("under the mit license, " * 100_000)[0]
    start = time.time()
    assert len(licenses.base_places(words)) == 100_000 and len(licenses.fuzzy_places(words)) == 100_000
    assert time.time() - start < 60
