"""The registered queries of the embedding near-dedup and of the quality classifier against brute force, row by row."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter

import duckdb
import numpy as np
import pytest
import xxhash

from marquee.llm import quality
from marquee.llm.queries import QUERIES

SMALL, MEDIUM = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


def brute_links(rows: dict[int, list | None]) -> dict[int, tuple[int, int, bool]]:
    """n_links, component_id and kept of every vector, all compared with all."""

    def usable(row) -> bool:
        return bool(row) and all(x is not None and math.isfinite(x) for x in row) and any(row)

    good = sorted(number for number, row in rows.items() if usable(row))
    table = np.array([rows[number] for number in good], dtype=np.float64)
    table /= np.linalg.norm(table, axis=1, keepdims=True)
    near = table @ table.T >= 0.9
    np.fill_diagonal(near, False)
    found = {number: (0, number, True) for number in rows}
    seen = set()
    for at, number in enumerate(good):
        if at in seen:
            continue
        reached, todo = {at}, [at]
        while todo:
            for other in np.flatnonzero(near[todo.pop()]):
                if other not in reached:
                    reached.add(int(other))
                    todo.append(int(other))
        seen |= reached
        for other in reached:
            found[good[other]] = int(near[other].sum()), number, other == at
    return found


@pytest.fixture(scope="module")
def vectors_folder(spark, tmp_path_factory):
    """Groups of near vectors, a chain whose ends are far apart, exact copies, lone vectors and unusable ones."""
    source = np.random.default_rng(11)
    near = [centre + source.standard_normal((size, 64)) * 0.12 for centre, size in zip(source.standard_normal((40, 64)), [90, 30] + [4] * 38)]
    turns = np.arange(60) * 0.3
    chain = np.zeros((60, 64))
    chain[:, 0], chain[:, 1] = np.cos(turns / 4), np.sin(turns / 4)
    table = np.concatenate([*near, chain, source.standard_normal((600, 64))])
    table = np.concatenate([table, table[:200:5]])
    rows = [[float(x) for x in row] for row in table[source.permutation(len(table))]]
    rows += [None, [0.0] * 64, [float("nan")] + [1.0] * 63, [float("inf")] + [1.0] * 63, [None] + [1.0] * 63]
    folder = tmp_path_factory.mktemp("vectors")
    frame = spark.createDataFrame([(3 * n, row, "en") for n, row in enumerate(rows)], "vec_id long, embedding array<double>, label string")
    frame.write.parquet(str(folder / "embeddings.parquet"))
    return str(folder), {3 * n: row for n, row in enumerate(rows)}


def answers(spark, folder: str) -> dict[int, tuple[int, int, bool]]:
    rows = QUERIES["op6_projection_passes"](spark, folder).collect()
    found = {row["vec_id"]: (row["n_links"], row["component_id"], row["kept"]) for row in rows}
    assert len(found) == len(rows)
    return found


def test_projection_query_on_made_vectors(spark, vectors_folder):
    folder, rows = vectors_folder
    want = brute_links(rows)
    assert sum(links for links, *_ in want.values()) > 5000 and sum(not kept for *_, kept in want.values()) > 200
    assert answers(spark, folder) == want


def test_projection_query_on_the_given_table(spark):
    rows = dict(duckdb.sql(f"SELECT vec_id, embedding FROM '{SMALL}/embeddings.parquet'").fetchall())
    assert answers(spark, SMALL) == brute_links(rows)


def brute_tails(model: quality.Model, text: str) -> list[float]:
    """P(grade > k) from a plain loop over the words."""
    words, counts = text.split(), Counter()
    for word in words:
        outline = re.sub(r"(.)\1+", r"\1", re.sub(r"[^\W\d_]+", "a", re.sub(r"\d+", "0", word)))
        for feature in ("word " + word.lower().strip(".,;:!?"), "shape " + outline):
            counts[xxhash.xxh32_intdigest(feature) % (1 << 18)] += 1
    length = math.sqrt(sum(math.log1p(n) ** 2 for n in counts.values())) or 1.0
    pairs = [(math.log1p(n) / length, place) for place, n in counts.items()]
    repeats = sum(one == other for one, other in zip(words, words[1:]))
    pairs.append((1.0, xxhash.xxh32_intdigest(f"again {10 * repeats // max(1, len(words) - 1)}") % (1 << 18)))
    total = sum(value * float(model.weights[place]) for value, place in pairs)
    return [1 / (1 + math.exp(float(threshold) - total)) for threshold in model.thresholds]


def test_quality_query(spark):
    docs = duckdb.sql(f"SELECT doc_id, text FROM '{MEDIUM}/documents.parquet'").fetchall()
    grades: dict[int, int] = {}
    for number, good, toxic in duckdb.sql(f"SELECT doc_id, quality, toxic FROM '{MEDIUM}/labels.parquet'").fetchall():
        if good is not None and number is not None:
            grade = 0 if good == 0 else 1 if toxic == 1 else 2
            grades[number] = min(grade, grades.get(number, grade))
    rated = sorted((hashlib.md5(str(number).encode()).hexdigest(), number, text or "") for number, text in docs if number in grades)
    rated = sorted((number, text) for _, number, text in rated[: quality.MOST_LABELLED])
    model = quality.fit([text for _, text in rated], [grades[number] for number, _ in rated])
    found = {row["doc_id"]: row for row in QUERIES["op10_quality"](spark, MEDIUM).collect()}
    assert sorted(found) == sorted(number for number, _ in docs)
    assert 0 < sum(row["kept"] for row in found.values()) < len(docs)
    for number, text in docs:
        tails, row = brute_tails(model, text or ""), found[number]
        assert [row["p_ge_1"], row["p_ge_2"], row["expected_grade"]] == pytest.approx([*tails, sum(tails)], abs=1e-6)
        assert row["kept"] == (tails[0] >= 0.5) or abs(tails[0] - 0.5) < 1e-6
