"""Centroid clustering in whole numbers, over dictionaries of subvectors.

Vectors are cut into blocks of ``WIDTH`` components. In each chunk of rows, the subvectors of a block are encoded by a
dictionary of the distinct ones, without loss; codes and dictionaries are settled once and serve every round. A round
computes the squared distances of each dictionary entry to the same block of every centroid, once, and adds
them up by code: a vector's distance is a sum of table rows, however many vectors share a subvector. All of it is exact
in 64-bit integers. Per round, a task hands on at most one row of sums per cluster; the driver learns the sums of
``clusters * 64`` components, and the tasks the centroids: both have a fixed size.

Defined results: a vector is kept if it has exactly ``SIZE`` components, none NULL or non-finite, and none beyond
``LARGEST`` in size (what is beyond has no squared distance that surely fits a long). Repeated rows are vectors of their own; a
NULL id is hashed as an empty one and orders before others. Equal hashes (rows of one id) start in the order of their
components. With fewer vectors than clusters each is a start. Ties go to the smaller number; an empty cluster keeps its centroid.
An inertia beyond a long is NULL. An empty table gives an empty result; other columns, whatever their names, are ignored.
There are no texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import settled

SIZE = 64
CLUSTERS = 40
ROUNDS = 5
SCALE = 256
WIDTH = 2
LARGEST = 2.0**19
MOST_LONG = 2**63 - 1
CHUNK = "ids array<long>, codes array<int>, sizes array<int>, entries array<long>"


def _rows(values: pa.Array, width: int) -> np.ndarray:
    return values.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def scaled(values: np.ndarray) -> np.ndarray:
    return np.floor(SCALE * values.astype(np.float64)).astype(np.int64)


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id and embedding of the vectors that are kept."""
    sound = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) <= F.lit(LARGEST)))
    return vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding").where((F.size("embedding") == SIZE) & sound)


def starts(vectors: DataFrame, clusters: int = CLUSTERS) -> np.ndarray:
    """The first vectors in the order of their ids' hashes, scaled: the only rows that reach the driver."""
    order = F.sha2(F.concat(F.lit("2:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    first = vectors.orderBy(order, "embedding").limit(clusters).select("embedding").collect()
    return scaled(np.array([row["embedding"] for row in first], np.float64).reshape(-1, SIZE))


def encoded(vectors: DataFrame, width: int = WIDTH) -> DataFrame:
    """Chunks of rows: their ids, a code for each block of each vector, and the blocks' dictionaries one after another."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            whole = scaled(_rows(batch.column("embedding"), SIZE))
            codes, sizes, entries = [], [], []
            for at in range(0, SIZE, width):
                found, code = np.unique(whole[:, at : at + width], axis=0, return_inverse=True)
                codes.append(code.reshape(-1).astype(np.int32))
                sizes.append(len(found))
                entries.append(found.reshape(-1))
            columns = [
                pa.array([batch.column("vec_id").to_pylist()], pa.list_(pa.int64())),
                pa.array([np.concatenate(codes)], pa.list_(pa.int32())),
                pa.array([sizes], pa.list_(pa.int32())),
                pa.array([np.concatenate(entries)], pa.list_(pa.int64())),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["ids", "codes", "sizes", "entries"])

    return vectors.mapInArrow(run, CHUNK)


def _chunks(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[pa.Array, np.ndarray, list[np.ndarray]]]:
    """Ids, codes (one row per block) and the dictionary of each block."""
    for batch in batches:
        for at in range(batch.num_rows):
            ids, codes, sizes, entries = (batch.column(name)[at].values for name in ("ids", "codes", "sizes", "entries"))
            ends = np.cumsum(sizes.to_numpy())[:-1]
            found = entries.to_numpy().reshape(-1, width)
            yield ids, codes.to_numpy().reshape(-1, len(ids)), np.split(found, ends)


def nearest(codes: np.ndarray, dictionaries: list[np.ndarray], centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of the nearest centroid and squared distance of each vector of a chunk."""
    total = np.zeros((codes.shape[1], len(centroids)), np.int64)
    at = 0
    for code, entries in zip(codes, dictionaries):
        width = entries.shape[1]
        table = ((entries[:, None, :] - centroids[None, :, at : at + width]) ** 2).sum(2)
        total += table[code]
        at += width
    best = total.argmin(1)
    return best, total[np.arange(len(best)), best]


def moved(chunks: DataFrame, centroids: np.ndarray, width: int = WIDTH) -> np.ndarray:
    """The centroids after one round."""
    many = len(centroids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, sums = np.zeros(many, np.int64), np.zeros((many, SIZE), np.int64)
        for _, codes, dictionaries in _chunks(batches, width):
            best, _ = nearest(codes, dictionaries, centroids)
            count += np.bincount(best, minlength=many)
            for block, (code, entries) in enumerate(zip(codes, dictionaries)):
                # How often a cluster holds an entry, then the entries that often.
                held = np.bincount(best * len(entries) + code, minlength=many * len(entries)).reshape(many, -1)
                sums[:, block * width : (block + 1) * width] += held @ entries
        some = np.flatnonzero(count)
        columns = [pa.array(some, pa.int32()), pa.array(count[some]), pa.array(list(sums[some]), pa.list_(pa.int64()))]
        yield pa.RecordBatch.from_arrays(columns, names=["cluster", "n", "sums"])

    parts = chunks.mapInArrow(run, "cluster int, n long, sums array<long>")
    wide = parts.select("cluster", "n", F.posexplode("sums").alias("place", "x"))
    exact = "decimal(38,0)"
    found = wide.groupBy("cluster", "place").agg(F.sum(F.col("n").cast(exact)).alias("n"), F.sum(F.col("x").cast(exact)).alias("x"))
    after = centroids.copy()
    for row in found.collect():
        after[row["cluster"], row["place"]] = int(row["x"]) // int(row["n"])
    return after


def assigned(chunks: DataFrame, centroids: np.ndarray, width: int = WIDTH) -> DataFrame:
    """vec_id, cluster and distance of every vector."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, codes, dictionaries in _chunks(batches, width):
            best, distance = nearest(codes, dictionaries, centroids)
            yield pa.RecordBatch.from_arrays([ids, pa.array(best, pa.int32()), pa.array(distance)], names=["vec_id", "cluster", "distance"])

    return chunks.mapInArrow(run, "vec_id long, cluster int, distance long")


def cluster(vectors: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS, width: int = WIDTH) -> tuple[DataFrame, np.ndarray]:
    """Every kept vector with its cluster and squared distance, and the final centroids."""
    kept = usable(vectors)
    centroids = starts(kept, clusters)
    chunks = settled(encoded(kept, width))
    for _ in range(rounds if len(centroids) else 0):
        centroids = moved(chunks, centroids, width)
    return assigned(chunks, centroids, width), centroids


def digests(found: DataFrame, centroids: np.ndarray) -> DataFrame:
    """The vectors with the inertia of their cluster and of all, and the digest of their centroid.

    The facts of the clusters are at most one row for each, so they may be broadcast.
    """
    found = settled(found)
    sums = {row["cluster"]: int(row["x"]) for row in found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("x")).collect()}
    fits = lambda n: n if n <= MOST_LONG else None
    facts = [
        (number, fits(sums[number]), fits(sum(sums.values())), sha256(",".join(map(str, centroids[number].tolist())).encode()).hexdigest())
        for number in sorted(sums)
    ]
    schema = T._parse_datatype_string("cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.join(F.broadcast(found.sparkSession.createDataFrame(facts, schema)), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )
