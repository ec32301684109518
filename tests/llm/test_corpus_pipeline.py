"""The whole pipeline against a brute-force version."""

from __future__ import annotations

import hashlib
import re
from collections import Counter

import duckdb
import pandas as pd
import public_tokenizers
from brute import brute_near

import corpus_pipeline
from marquee.llm import bpe, quality
from marquee.llm.common import table
from marquee.llm.sql import SQL

FOLDER = "/root/testdata/sf0.001"


def test_pipeline_equals_brute_force(spark):
    docs = duckdb.sql(f"SELECT doc_id, text, lang, source, n_chars FROM '{FOLDER}/documents.parquet' ORDER BY doc_id").fetchall()
    model = quality.train(table(spark, FOLDER, "documents"), quality.graded(table(spark, FOLDER, "labels")))
    left = [doc for doc in docs if model.tails(doc[1] or "")[0] >= 0.5]
    assert 0 < len(left) < len(docs)

    first = {}
    for doc in left:
        first.setdefault(re.sub("[\x20\x09-\x0d]+", " ", doc[1] or ""), doc)
    left = list(first.values())

    near = brute_near([doc[:2] for doc in left], size=5)
    left = [doc for doc in left if near[doc[0]][2]]

    base = duckdb.connect()
    base.register("documents", pd.DataFrame(left, columns=["doc_id", "text", "lang", "source", "n_chars"]))
    copies = {number: round(taken / size + 1e-9) if size else 0 for number, size, _, _, taken in base.execute(SQL["op7_source_mix"]).fetchall()}

    coder, want = bpe.tokenizer(public_tokenizers.path("word_bpe_49k.json")), Counter()
    for number, text, *_ in left:
        ids = coder.encode(text or "", add_special_tokens=False).ids
        want[number, hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()] += copies[number]
    found = Counter((row["doc_id"], row["ids_sha256"]) for row in corpus_pipeline.run(spark, FOLDER).select("doc_id", "ids_sha256").collect())
    assert found == +want
