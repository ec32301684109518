"""Centroid clustering against whole-number loops."""

from __future__ import annotations

import math
from hashlib import sha256

import numpy as np
import pytest

from marquee.llm import centroids
from marquee.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<float>, label int, cluster string, place string"


def brute(rows, clusters=40, rounds=5):
    kept = []
    for number, values in rows:
        if values is not None and len(values) == 64 and all(v is not None and math.isfinite(v) for v in values):
            kept.append((number, [math.floor(256 * float(np.float32(v))) for v in values]))
    order = sorted(kept, key=lambda one: (sha256(f"2:{'' if one[0] is None else one[0]}".encode()).hexdigest(), one[1]))
    centres = [values for _, values in order[:clusters]]

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(values, centre)), n) for n, centre in enumerate(centres)) for _, values in kept]

    for _ in range(rounds):
        groups = {}
        for (_, values), (_, n) in zip(kept, assign()):
            groups.setdefault(n, []).append(values)
        for n, group in groups.items():
            centres[n] = [sum(column) // len(group) for column in zip(*group)]
    last, inertia = assign(), {}
    for distance, n in last:
        inertia[n] = inertia.get(n, 0) + distance
    digest = lambda n: sha256(",".join(map(str, centres[n])).encode()).hexdigest()
    return sorted(
        ((number, n, distance, inertia[n], sum(inertia.values()), digest(n)) for (number, _), (distance, n) in zip(kept, last)), key=str
    )


def answers(frame):
    return sorted(map(tuple, frame.collect()), key=str)


def made(n, seed=5):
    source = np.random.default_rng(seed)
    centres = source.standard_normal((7, 64)) / 8
    return [(i, (centres[i % 7] + source.standard_normal(64) / 40).astype(np.float32).tolist()) for i in range(n)]


def frame(spark, rows):
    return spark.createDataFrame([(*row, 1, "x", "y") for row in rows], SCHEMA)


@pytest.mark.parametrize("width", [1, 2, 8])
def test_clusters(spark, width):
    nan, inf = float("nan"), float("inf")
    odd = [[nan] + [0.0] * 63, [inf] + [0.0] * 63, [None] + [0.0] * 63, [0.5] * 63, [0.5] * 65, [], None]
    rows = made(300) + [(900 + n, values) for n, values in enumerate(odd)]
    rows += [(5, made(300)[5][1]), (5, made(300)[6][1]), (None, made(1)[0][1]), (950, [0.0] * 64), (951, [-0.0] * 64)]
    found = centroids.digests(*centroids.cluster(frame(spark, rows).repartition(5), width=width))
    assert answers(found) == brute(rows)


def test_few_and_no_vectors(spark):
    few = made(3)
    assert answers(centroids.digests(*centroids.cluster(frame(spark, few)))) == brute(few)
    assert centroids.digests(*centroids.cluster(frame(spark, few).limit(0))).count() == 0


def test_exact_in_large_numbers(spark):
    rows = [(n, [float((-1) ** n * 2**19)] * 32 + [float(n % 5)] * 32) for n in range(60)]
    found = answers(centroids.digests(*centroids.cluster(frame(spark, rows), clusters=2)))
    want = brute(rows, clusters=2)
    assert [row[:3] for row in found] == [row[:3] for row in want]


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    rows = [tuple(row) for row in spark.read.parquet(f"{folder}/embeddings.parquet").select("vec_id", "embedding").collect()]
    assert answers(QUERIES["op13_centroids"](spark, folder)) == brute(rows)
