"""Near-duplicate texts: MinHash with tensored banding, confirmed on full shingle sets.

A document has two small collections of ``COLLECTION`` band hashes, each over ``ROWS`` minhashes. A table key is
a pair of one hash of either collection, so 2 * COLLECTION * ROWS minhashes serve COLLECTION ** 2 tables of
2 * ROWS rows each, about the square root of what as many independent tables take. A pair at similarity s
meets in some table with probability (1 - (1 - s ** ROWS) ** COLLECTION) ** 2: 0.9993 at 0.8, 0.99999 at 0.87.

Documents with the same shingle set are one class with one representative. In each table bucket the smallest
representative leads. Every document is first compared on the full sets with the smallest of its leaders, and the
pairs found tie it to that leader; other leaders are asked only about documents that are not tied to the same
one already, and what all of them tell is united. Members that are then not in their leader's component, its strays, are
compared on the full sets with all of the leader's members: runs of strays meet runs of members as arrays, a pair of runs
in a row, and only links that tie two components leave the task. So no pair of documents is ever a row but those
with a leader, and a large group of near copies, however alike, makes as many rows as it has members and runs.

Defined results: letters A-Z are lowered, words are what stands between ASCII blanks; a NULL text counts as
empty; an empty one has no set and links with nothing; fewer words than a shingle has are one shingle; rows of
one doc_id count as one document and share its component; a row without id links with nothing, has no component
and stays; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import packed, settled, small_batches, whole, with_facts
from .components import components

SHINGLE = 2
PERCENT = 80
COLLECTION, ROWS = 11, 3
REMEMBERED = 100_000
BATCH = 250
# Bytes of texts in a run of strays or members, and pairs of runs that a task takes at a time.
RUN, RUNS_AT_ONCE = 1 << 21, 4
# Sets of fewer members reach 80 % only with themselves.
LEAST_SET = 4
SIGNATURE = "doc_id long, n_shingles long, set_hash string, left array<long>, right array<long>"

_ODD = np.uint64(0x9E3779B97F4A7C15)


class _Hashes(dict):
    """64-bit hashes of words, forgotten all at once beyond a bound."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        self[word] = found = xxhash.xxh3_64_intdigest(word)
        return found


_KNOWN = _Hashes()


def _mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def shingles(text: str, words: int = SHINGLE) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's shingles."""
    found = text.encode("utf-8", "surrogatepass").lower().split()
    hashes = np.fromiter(map(_KNOWN.__getitem__, found), np.uint64, len(found))
    if not len(hashes):
        return hashes
    width = min(words, len(hashes))
    rolled = hashes[: len(hashes) - width + 1].copy()
    for at in range(1, width):
        rolled = rolled * _ODD + hashes[at : len(hashes) - width + 1 + at]
    return np.unique(_mixed(rolled + np.uint64(width)))


_SEEDS = _mixed(np.arange(1, 2 * COLLECTION * ROWS + 1, dtype=np.uint64) * _ODD)


def bands(members: np.ndarray) -> np.ndarray:
    """2 * COLLECTION band hashes, one half for either collection."""
    least = np.full(len(_SEEDS), np.iinfo(np.uint64).max, np.uint64)
    for start in range(0, len(members), 4096):
        block = (members[None, start : start + 4096] ^ _SEEDS[:, None]) * _ODD
        block ^= block >> np.uint64(32)
        block *= np.uint64(0xD6E8FEB86659FD93)
        np.minimum(least, block.min(1), out=least)
    rows = least.reshape(2 * COLLECTION, ROWS)
    hashed = rows[:, 0]
    for at in range(1, ROWS):
        hashed = _mixed(hashed * _ODD + rows[:, at])
    return hashed.view(np.int64)


def signatures(docs: DataFrame, words: int = SHINGLE) -> DataFrame:
    """doc_id, n_shingles, set_hash (128 bits) and the two collections of band hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, sets, left, right = [], [], [], []
            for text in batch.column("text").to_pylist():
                members = shingles(text, words)
                hashes = bands(members) if len(members) >= LEAST_SET else np.empty(0, np.int64)
                sizes.append(len(members))
                sets.append(xxhash.xxh3_128_hexdigest(members.tobytes()))
                left.append(hashes[:COLLECTION])
                right.append(hashes[COLLECTION:])
            longs = pa.list_(pa.int64())
            columns = [batch.column("doc_id").cast(pa.int64()), pa.array(sizes, pa.int64()), pa.array(sets, pa.string())]
            columns += [pa.array(left, longs), pa.array(right, longs)]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_shingles", "set_hash", "left", "right"])

    return docs.select("doc_id", whole(F.col("text")).alias("text")).mapInArrow(run, SIGNATURE)


def confirmed(pairs: DataFrame, texts: DataFrame, words: int = SHINGLE) -> DataFrame:
    """a, b, both (size of the intersection) and either (of the union) on the full sets of both texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            both, either, last = [], [], (None, None)
            for one, other in zip(batch.column("text_a").to_pylist(), batch.column("text_b").to_pylist()):
                if last[0] != one:
                    last = (one, shingles(one, words))
                second = shingles(other, words)
                same = len(np.intersect1d(last[1], second, assume_unique=True))
                both.append(same)
                either.append(len(last[1]) + len(second) - same)
            columns = [batch.column("a"), batch.column("b"), pa.array(both, pa.int64()), pa.array(either, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["a", "b", "both", "either"])

    first = texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a"))
    second = texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b"))
    return pairs.select("a", "b").join(first, "a").join(second, "b").mapInArrow(run, "a long, b long, both long, either long")


def _ties(strays: tuple, members: tuple, percent: int) -> Iterator[tuple[int, int]]:
    """Links (stray, member) that tie all components between which the two runs have any link.

    A run is (ids, components, sets). A component that a link has tied to another takes its name, so what follows from
    earlier links is not told again.
    """
    ids, places, sets = members
    named, place = np.unique(np.concatenate([strays[1], places]), return_inverse=True)
    mine, theirs = place[: len(strays[1])], place[len(strays[1]) :]
    sizes = np.array([len(one) for one in sets])
    known, codes = np.unique(np.concatenate(sets), return_inverse=True)
    starts = np.cumsum(sizes) - sizes
    for at, (stray, own) in enumerate(zip(strays[0], strays[2])):
        held = np.zeros(len(known), bool)
        found = np.minimum(np.searchsorted(known, own), len(known) - 1)
        held[found[known[found] == own]] = True
        both = np.add.reduceat(held[codes], starts, dtype=np.int64)
        near = np.flatnonzero((both * 100 >= (len(own) + sizes - both) * percent) & (theirs != mine[at]))
        others, first = np.unique(theirs[near], return_index=True)
        yield from ((stray, ids[one]) for one in near[first])
        for run in (mine, theirs):
            run[np.isin(run, others)] = mine[at]


def ties(members: DataFrame, texts: DataFrame, words: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """a, b: links on the full sets between members (lead, lead_in, rep, rep_in) of one leader, as many as tie all
    components that such links join; one of the two is a stray, in another component than the leader.

    Strays and members of a leader are dealt by a hash of the ids to runs of about ``RUN`` bytes of texts, so a task
    holds no more than a few runs, whatever a leader's members are.
    """
    sizes = texts.groupBy(F.col("doc_id").alias("rep")).agg(F.sum(F.octet_length("text")).alias("size"))
    stray = F.col("lead_in") != F.col("rep_in")
    sized = members.join(sizes, "rep").select("lead", "rep", "rep_in", stray.alias("stray"), "size")
    asked = F.when(F.col("stray"), F.col("size")).otherwise(0)
    facts = with_facts(sized, ["lead"], ["rep"], offered=("sum", F.col("size")), asking=("sum", asked))
    runs, parts = (F.floor(F.col(name) / RUN) + 1 for name in ("offered", "asking"))
    at = F.xxhash64("rep")
    dealt = settled(facts.select("lead", "rep", "rep_in", "stray", runs.alias("runs"), F.pmod(at, runs).alias("run"), F.pmod(at, parts).alias("part")))

    def packed_runs(rows: DataFrame, keys: list[str], name: str) -> DataFrame:
        told = rows.join(texts.withColumnRenamed("doc_id", "rep"), "rep").repartition("lead", "run")
        return told.groupBy(*keys).agg(F.collect_list(F.struct("rep", "rep_in", "text")).alias(name))

    every = F.sequence(F.lit(0).cast("long"), F.col("runs") - 1)
    asking = dealt.where("stray").select("lead", "rep", "rep_in", "part", F.explode(every).alias("run"))
    asking = packed_runs(asking, ["lead", "run", "part"], "strays")
    met = asking.join(packed_runs(dealt, ["lead", "run"], "members"), ["lead", "run"])

    def read(entries: pa.StructArray) -> tuple:
        sets = [shingles(text, words) for text in entries.field("text").to_pylist()]
        kept = [at for at, one in enumerate(sets) if len(one)]
        ids, places = (entries.field(name).to_numpy(zero_copy_only=False)[kept] for name in ("rep", "rep_in"))
        return ids, places, [sets[at] for at in kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for one, other in zip(batch.column("strays"), batch.column("members")):
                pair = read(one.values), read(other.values)
                if all(len(ids) for ids, *_ in pair):
                    found += _ties(*pair, percent)
            yield pa.RecordBatch.from_arrays([pa.array([link[side] for link in found], pa.int64()) for side in (0, 1)], names=["a", "b"])

    with small_batches(texts.sparkSession, RUNS_AT_ONCE):
        return settled(met.select("strays", "members").mapInArrow(run, "a long, b long"))


def table_rows(classes: DataFrame) -> DataFrame:
    """key and rep: one row per pair of a left and a right band hash."""
    lefts = classes.select("rep", "right", F.posexplode("left").alias("i", "first"))
    pairs = lefts.select("rep", "i", "first", F.posexplode("right").alias("j", "second"))
    return pairs.select(F.xxhash64("first", "second", "i", "j").alias("key"), "rep")


def united(classes: DataFrame, docs: DataFrame, words: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """node and component of the representatives that are linked with another: links of all pairs that the tables
    bring together."""
    near = F.col("both") * 100 >= F.col("either") * percent
    rows = table_rows(classes)
    heads = settled(rows.groupBy("key").agg(F.min("rep").alias("lead"), F.max("rep").alias("last")).where("lead < last").select("key", "lead"))
    members = settled(rows.join(heads, "key").where("rep <> lead").select("lead", "rep").distinct())
    met = members.select(F.explode(F.array("lead", "rep")).alias("doc_id")).distinct()
    texts = settled(docs.select("doc_id", whole(F.col("text")).alias("text")).join(met, "doc_id", "left_semi"))

    def judged(pairs: DataFrame) -> DataFrame:
        found = confirmed(pairs.select("a", "b"), texts, words).groupBy("a", "b")
        return settled(found.agg(F.max(near).alias("near")))

    def placed(tied: DataFrame) -> DataFrame:
        """``members`` with the component of either side."""
        one, other = (tied.select(F.col("node").alias(name), F.col("component").alias(f"{name}_in")) for name in ("lead", "rep"))
        return members.join(one, "lead", "left").join(other, "rep", "left").select(
            "lead", "rep", F.coalesce("lead_in", "lead").alias("lead_in"), F.coalesce("rep_in", "rep").alias("rep_in")
        )

    # One leader for each document first: most of what the other leaders could tell is known then.
    first = judged(members.groupBy(F.col("rep").alias("b")).agg(F.min("lead").alias("a")))
    parent = first.where("near").select(F.col("b").alias("node"), F.col("a").alias("component"))
    above = parent.select(F.col("node").alias("component"), F.col("component").alias("above"))
    lifted = parent.join(above, "component", "left").select("node", F.coalesce("above", "component").alias("component"))
    apart = placed(lifted).where("lead_in <> rep_in").select(F.col("lead").alias("a"), F.col("rep").alias("b"))
    second = judged(apart.join(first, ["a", "b"], "left_anti"))
    tied = settled(components(first.unionByName(second).where("near").select("a", "b")))
    known = placed(tied)
    leads = known.where("lead_in <> rep_in").select("lead").distinct()
    contested = settled(known.join(leads, "lead", "left_semi"))
    if contested.isEmpty():
        return tied
    links = ties(contested, texts, words, percent)
    # They are added to the finished components.
    above = tied.where("node <> component").select(F.col("node").alias("a"), F.col("component").alias("b"))
    return settled(components(above.unionByName(links)))


def dedup(docs: DataFrame, words: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every row of ``docs`` (doc_id, text)."""
    with small_batches(docs.sparkSession, BATCH):
        signed = settled(signatures(docs, words))
        linked = signed.where("n_shingles > 0 AND doc_id IS NOT NULL")
        classed = settled(with_facts(linked, ["set_hash"], ["doc_id"], rep=("min", F.col("doc_id"))))
        classes = classed.where(f"doc_id = rep AND n_shingles >= {LEAST_SET}").select("rep", "left", "right")
        tied = united(classes, docs, words, percent)
    # A document that repeats its id with other texts has several classes: all of them are one component.
    same = classed.select("doc_id", "rep").distinct()
    ties = settled(same.join(tied.select(F.col("node").alias("rep"), "component"), "rep", "left").select("doc_id", F.coalesce("component", "rep").alias("component")))
    several = settled(ties.groupBy("doc_id").agg(F.min("component").alias("component"), F.max("component").alias("last")))
    if not several.where("component <> last").isEmpty():
        ties = components(ties.select(F.col("doc_id").alias("a"), F.col("component").alias("b"))).withColumnRenamed("node", "doc_id")
        several = ties.groupBy("doc_id").agg(F.min("component").alias("component"))
    placed = signed.join(several.select("doc_id", "component"), "doc_id", "left")
    component = F.coalesce("component", "doc_id")
    return placed.select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )


def keep_first(docs: DataFrame, answers: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, all columns as they were."""
    gone = answers.where("NOT kept").select("doc_id").distinct()
    return packed(docs, id=F.col("doc_id")).join(gone, F.col("id") == F.col("doc_id"), "left_anti").select("row.*")
