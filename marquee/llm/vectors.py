"""Near-duplicate vectors by sorted projection passes.

Each pass gives a vector the signs of its products with random directions, as one number that sorts like the
list of signs. All passes are sorted at once and ranked densely; a rank's block of ``window`` rows is compared
with itself and the block before, in double precision, so no vector is compared with more than three windows of
neighbours in a pass, whatever the data. Verified pairs of all passes are united to components.

Within a component every pair is then checked exactly, in blocks of bounded size, and each vector gets the
number of vectors that it is directly linked with; pairs are counted where they are compared and never listed.

The number of passes is measured, not assumed, as signs hardly split a crowd of similar vectors. Each row takes
a probe through all passes: a made-up partner at the threshold that leans to the row's crowd as the row does.
A row whose probe has come within reach in enough passes (:func:`hits`) is done; the others go through more
passes, among themselves. The number of passes after which a row is done follows how often its pairs meet, so
that a pair at the threshold is missed with probability 0.01 in any crowd; closer pairs are missed less. Where
that takes more comparisons than all pairs of the rows left, these are compared instead, in blocks.

Defined results: a vector that is NULL, empty or zero or has a NULL or non-finite component links with nothing, as do
vectors of different length; equal vectors are one class and link with each other; each row is answered by its
own vector, rows that repeat id and vector count once, classes that share their smallest id count as one; a
NULL id has links with nothing, no component, and stays; an empty table gives an empty result; other columns are
ignored, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import settled, with_facts
from .components import components

LEAST_COSINE = 0.9
WINDOW = 256
SIGNS = 40
MISS = 0.01
BLOCK = 1024
ROUND = 64
CROWD = 32
_PLACE_BITS = 33  # monotonically_increasing_id has the place within the partition below these


def passes(rows: int, window: int = WINDOW, least: float = LEAST_COSINE, miss: float = MISS) -> int:
    """First passes: those after which a pair at the threshold is missed with probability ``miss`` where each sign
    halves the rows."""
    agree = 1 - math.acos(least) / math.pi
    found = min(agree ** math.log2(max(2.0, rows / window)), 0.99)
    return max(3, math.ceil(math.log(miss) / math.log(1 - found)))


def matrices(column: pa.Array | pa.ChunkedArray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows of each length and their vectors at unit length, in double precision."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    lengths = np.asarray(column.value_lengths().to_numpy(zero_copy_only=False), np.int64)
    flat = np.asarray(column.flatten().to_numpy(zero_copy_only=False), np.float64)
    starts = np.cumsum(lengths) - lengths
    for length in np.unique(lengths):
        rows = np.flatnonzero(lengths == length)
        found = flat[starts[rows, None] + np.arange(length)]
        yield rows, found / np.sqrt((found * found).sum(1))[:, None]


def hits(miss: float = MISS) -> int:
    """Passes that have to bring a row's probe within reach.

    A partner that meets the row as often as the probe is missed until the n-th hit with probability below 2^-n;
    one hit more, as either end of a pair may be done first.
    """
    return math.ceil(math.log2(1 / miss)) + 1


def probes(found: np.ndarray, names: np.ndarray, order: np.ndarray, least: float, seed: int) -> np.ndarray:
    """Per unit vector, one at cosine ``least`` with the same part along the mean of its neighbours in ``order``.

    The rest points anywhere: a sum of two from fixed lists of directions, chosen by name, so reruns agree.
    """
    sums = np.concatenate([np.zeros((1, found.shape[1])), np.cumsum(found[order], 0)])
    first = np.clip(np.arange(len(order)) - CROWD, 0, None)
    last = np.minimum(np.arange(len(order)) + CROWD + 1, len(order))
    mean = np.empty_like(found)
    mean[order] = sums[last] - sums[first] - found[order]

    def unit(rows: np.ndarray) -> np.ndarray:
        size = np.linalg.norm(rows, axis=1, keepdims=True)
        return np.divide(rows, size, out=np.zeros_like(rows), where=size > 1e-9)

    def along(rows: np.ndarray, others: np.ndarray) -> np.ndarray:
        return (rows * others).sum(1, keepdims=True) * others

    mean = unit(mean)
    common = along(found, mean)
    own = found - common
    rest = (own * own).sum(1, keepdims=True)
    cosine = np.clip(np.divide(rest - (1 - least), rest, out=np.zeros_like(rest), where=rest > 1e-9), 0, 1)
    source = np.random.default_rng([seed, found.shape[1], 1])
    one, other = source.standard_normal((997, found.shape[1])), source.standard_normal((1009, found.shape[1]))
    away = one[names % 997] + other[names % 1009]
    away -= along(away, mean)
    away = unit(away - along(away, unit(own)))
    return common + cosine * own + np.sqrt(rest * (1 - cosine * cosine)) * away


def _codes(count: int, seed: int, least: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = (1 << np.arange(SIGNS - 1, -1, -1)).astype(np.int64)
        for batch in batches:
            names = batch.column("rep").cast(pa.int64()).to_numpy(zero_copy_only=False)
            codes, tried = np.zeros((2, batch.num_rows, count), np.int64)
            for rows, found in matrices(batch.column("vector")):
                directions = np.random.default_rng([seed, found.shape[1]]).standard_normal((found.shape[1], count * SIGNS))

                def signs(vectors: np.ndarray) -> np.ndarray:
                    return (vectors @ directions > 0).reshape(len(rows), count, SIGNS) @ weights

                codes[rows] = signs(found)
                order = np.lexsort((names[rows], codes[rows, 0]))
                tried[rows] = signs(probes(found, names[rows], order, least, seed))
            lists = (pa.array(list(part), pa.list_(pa.int64())) for part in (codes, tried))
            yield pa.RecordBatch.from_arrays([batch.column("rep"), *lists], names=["rep", "codes", "probes"])

    return run


def ranked(coded: DataFrame) -> DataFrame:
    """Rows of (pass, code, rep, probe) with their dense rank in that order, from a range sort and partition offsets."""
    order = ["pass", "code", "rep"]
    placed = settled(coded.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id()))
    part = F.shiftright("_at", _PLACE_BITS)
    sizes = placed.groupBy(part.alias("_part")).agg(F.count("*").alias("_size"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"))
    place = F.col("_at").bitwiseAND(F.lit((1 << _PLACE_BITS) - 1))
    return placed.withColumn("_part", part).join(offsets, "_part").select("rep", "pass", "code", "probe", (F.col("_offset") + place).alias("rank"))


def met(ranks: DataFrame, window: int) -> DataFrame:
    """rep and met: the passes in which a row's probe falls between the block before the row's and the one behind."""
    block = F.expr(f"rank div {window}")
    starts = ranks.where(F.col("rank") % window == 0).select(block.alias("at"), F.struct("pass", "code").alias("start"))
    near = starts.select("start", F.explode(F.array(F.lit(1), F.lit(-2))).alias("ahead"), "at").select((F.col("at") + F.col("ahead")).alias("block"), "ahead", "start")
    reach = near.groupBy("block").agg(F.min(F.when(F.col("ahead") == 1, F.col("start"))).alias("low"), F.min(F.when(F.col("ahead") == -2, F.col("start"))).alias("high"))
    probe = F.struct("pass", F.col("probe").alias("code"))
    within = (F.col("low").isNull() | (probe >= F.col("low"))) & (F.col("high").isNull() | (probe < F.col("high")))
    return ranks.withColumn("block", block).join(reach, "block", "left").groupBy("rep").agg(F.sum(within.cast("long")).alias("met"))


def _close(least: float):
    def run(table: pa.Table) -> pa.Table:
        """Each vector with the smallest one it is tied to within the block: enough to unite them all."""
        reps = table.column("rep").to_numpy()
        ones, others = [], []
        for rows, found in matrices(table.column("vector")):
            order = np.argsort(reps[rows], kind="stable")
            names, found = reps[rows][order], found[order]
            near = found @ found.T >= least
            np.fill_diagonal(near, True)
            alone = near.sum(1) < 2
            names, near = names[~alone], near[np.ix_(~alone, ~alone)]
            if not len(names):
                continue
            label, before = near.argmax(1), None
            while not np.array_equal(label, before):
                before = label
                label = np.where(near, label[None, :], len(label)).min(1)
            ones.append(names)
            others.append(names[label])
        ones, others = np.concatenate([np.empty(0, np.int64), *ones]), np.concatenate([np.empty(0, np.int64), *others])
        tied = ones != others
        return pa.table({"a": pa.array(ones[tied], pa.int64()), "b": pa.array(others[tied], pa.int64())})

    return run


def _counted(least: float):
    def run(table: pa.Table) -> pa.Table:
        """Per vector, the sizes of the classes it is linked with among this block's pairs of chunks."""
        reps, members, chunks, home, away, sizes = (
            table.column(name).to_numpy() for name in ("rep", "component", "chunk", "home", "away", "size")
        )
        total = np.zeros(len(reps), np.int64)
        for rows, found in matrices(table.column("vector")):
            near = (found @ found.T >= least) & (members[rows, None] == members[None, rows]) & (reps[rows, None] != reps[None, rows])
            if home[0] != away[0]:
                near &= chunks[rows, None] != chunks[None, rows]
            total[rows] = near @ sizes[rows]
        return pa.table({"rep": pa.array(reps, pa.int64()), "links": pa.array(total, pa.int64())})

    return run


def all_pairs(classes: DataFrame, rows: int, least: float = LEAST_COSINE, block: int = BLOCK) -> DataFrame:
    """a, b: ties between classes (rep, vector) from every pair of chunks."""
    parts = math.ceil(rows / block)
    chunked = classes.select("rep", "vector", F.pmod(F.xxhash64("rep", F.lit(11)), F.lit(parts)).cast("int").alias("chunk"))
    pairs = chunked.select("rep", "vector", "chunk", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("other"))
    dealt = pairs.select("rep", "vector", F.least("chunk", "other").alias("home"), F.greatest("chunk", "other").alias("away"))
    return dealt.groupBy("home", "away").applyInArrow(_close(least), "a long, b long").distinct()


def found_links(classes: DataFrame, rows: int, least: float = LEAST_COSINE, window: int = WINDOW, miss: float = MISS, seed: int = 0) -> DataFrame:
    """a, b: ties between classes (rep, vector) from all passes."""
    enough, count, done = hits(miss), passes(rows, window, least, miss), 0
    left, found = classes.select("rep", "vector", F.lit(0).cast("long").alias("met")), None
    while rows:
        if count * 4 * window >= rows and done:
            return found.unionByName(all_pairs(left, rows, least)).distinct()
        count = min(count, ROUND)
        coded = left.select("rep", "vector").mapInArrow(_codes(count, seed + done, least), "rep long, codes array<long>, probes array<long>")
        both = F.posexplode(F.arrays_zip("codes", "probes")).alias("pass", "both")
        ranks = ranked(coded.select("rep", both).select("rep", "pass", F.col("both.codes").alias("code"), F.col("both.probes").alias("probe")))
        block = F.expr(f"rank div {window}")
        spread = ranks.join(left.select("rep", "vector"), "rep").select("rep", "vector", F.explode(F.array(block, block + 1)).alias("block"))
        ties = spread.groupBy("block").applyInArrow(_close(least), "a long, b long").distinct()
        found = ties if found is None else settled(found.unionByName(ties).distinct())
        done += count
        scored = left.withColumnRenamed("met", "_met").join(met(ranks, window), "rep")
        left = settled(scored.select("rep", "vector", (F.col("_met") + F.col("met")).alias("met")).where(F.col("met") < enough))
        more = (enough - F.col("met")) / F.greatest(F.col("met").cast("double"), F.lit(0.5)) * done
        rows, count = left.agg(F.count("*"), F.ceil(F.coalesce(F.avg(more), F.lit(0.0)))).first()
    return found if found is not None else all_pairs(classes, 1, least)


def direct_links(classes: DataFrame, united: DataFrame, rows: int, least: float = LEAST_COSINE, block: int = BLOCK) -> DataFrame:
    """rep, component and links: how many vectors of other classes a class is directly linked with.

    A component of more than ``block`` classes is dealt into chunks, and each pair of chunks is one group;
    smaller components share groups.
    """
    members = classes.join(united.select(F.col("node").alias("rep"), "component"), "rep")
    sized = with_facts(members, ["component"], ["rep"], width=("sum", F.lit(1)))
    parts = F.ceil(F.col("width") / block).cast("int")
    chunked = sized.withColumn("parts", parts).withColumn("chunk", F.pmod(F.xxhash64("rep", F.lit(7)), "parts").cast("int"))
    pairs = chunked.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    shared = F.pmod(F.xxhash64("component"), F.lit(max(1, rows // block)))
    group = F.when(F.col("parts") == 1, -1 - shared).otherwise(F.col("component"))
    dealt = pairs.select(
        "rep", "component", "size", "vector", "chunk", group.alias("group"), F.least("chunk", "other").alias("home"), F.greatest("chunk", "other").alias("away")
    )
    counts = dealt.groupBy("group", "home", "away").applyInArrow(_counted(least), "rep long, links long")
    return counts.groupBy("rep").agg(F.sum("links").alias("links")).join(united.select(F.col("node").alias("rep"), "component"), "rep")


def dedup(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", least: float = LEAST_COSINE, window: int = WINDOW, miss: float = MISS) -> DataFrame:
    """vec_id, n_links, component_id and kept of every row."""
    vector = F.col(embedding).cast("array<double>")
    infinite = F.lit(float("inf"))
    finite = F.forall(vector, lambda part: part.isNotNull() & ~F.isnan(part) & (F.abs(part) < infinite))
    usable = F.coalesce(finite & F.exists(vector, lambda part: part != 0) & F.col(vec_id).isNotNull(), F.lit(False))
    rows = vectors.select(F.col(vec_id).alias("vec_id"), F.when(usable, vector).alias("vector"))
    distinct = rows.where("vector IS NOT NULL").withColumn("h1", F.xxhash64("vector")).withColumn("h2", F.xxhash64(F.lit(1), "vector"))
    named = with_facts(
        distinct.groupBy("h1", "h2", "vec_id").agg(F.first("vector").alias("vector")), ["h1", "h2"], ["vec_id"],
        rep=("min", F.col("vec_id")), size=("sum", F.lit(1)),
    )
    named = settled(named.select("h1", "h2", "vec_id", "rep", "size", F.when(F.col("vec_id") == F.col("rep"), F.col("vector")).alias("vector")))
    classes = named.where("vector IS NOT NULL").select("rep", "size", "vector")
    count = classes.count()
    united = components(found_links(classes, count, least, window, miss))
    linked = direct_links(classes, united, count, least)
    answers = named.join(linked, "rep", "left").select(
        F.col("vec_id").alias("_id"), "h1", "h2", F.coalesce("component", "rep").alias("component"), (F.coalesce("links", F.lit(0)) + F.col("size") - 1).alias("links")
    )
    hashed = rows.withColumn("_h1", F.xxhash64("vector")).withColumn("_h2", F.xxhash64(F.lit(1), "vector"))
    same = (F.col("vec_id") == F.col("_id")) & (F.col("_h1") == F.col("h1")) & (F.col("_h2") == F.col("h2"))
    component = F.coalesce("component", "vec_id")
    return hashed.drop("vector").join(answers, same, "left").select(
        "vec_id",
        F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"),
    )
