"""Tag similarity: TF-IDF over tag tokens, cosine, and the best k per item.

All items with the same tokens share one vector, so weights are worked out per distinct tag set. Weights
are decimals: sums come out the same in any order, and equal scores compare as equal.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import drop_stop_words, fold_tags
from ..functions.words import ENGLISH_STOP_WORDS
from ..session import materialise
from .numbering import first_rows, number_rows
from .skew import hot_counts, skew_join

TOKEN = r"(?U)\b\w\w+\b"
WEIGHT = "decimal(16,7)"
PRODUCT = "decimal(38,14)"
UNIT = 10**7  # of a weight as a whole number
ASKING, OFFERED = 16_384, 32_768  # tag sets of a run, fewer when they have more than so many tokens each:
PACK_TOKENS = 64
LEAST_RUNS = 48  # asking runs, when there are sets enough
CHUNK = 128  # asking sets that are scored at a time
HEAVY, HEAVY_SHARE = 32, 16  # tokens kept as a table: so many, each in more than one of so many items
PACK = ("numbers", "roots", "table", "tokens", "places", "weights")


def tag_tokens(tags: Column, stop_words: tuple[str, ...] = ENGLISH_STOP_WORDS) -> Column:
    """Sorted lower-case tokens of an item's tags; a token of two tags counts twice."""
    words = F.regexp_extract_all(F.lower(fold_tags(F.array_join(tags, " "))), F.lit(TOKEN), F.lit(0))
    return F.array_sort(drop_stop_words(words, stop_words, lowered=True))


def with_tag_key(items: DataFrame, tags: str = "tags", **options) -> DataFrame:
    """Add ``tag_key``, the item's tokens in one string; empty when it has none."""
    return items.withColumn("tag_key", F.coalesce(F.array_join(tag_tokens(F.col(tags), **options), " "), F.lit("")))


def tag_sets(keyed: DataFrame) -> DataFrame:
    """(tag_key, members): the distinct tag sets, the empty one included, and how many items have each.

    Everything else is worked out from these; the plan's uses of them share one exchange.
    """
    return keyed.groupBy("tag_key").agg(F.count("*").alias("members"))


def _to_items(keyed: DataFrame, sets: DataFrame, per_set: DataFrame, item: str) -> DataFrame:
    """Items with the columns of their tag set; a set that very many items share is spread out."""
    return skew_join(keyed, per_set, ["tag_key"], spread=[item], hot=hot_counts(sets, ["tag_key"], "members"))


def _set_tokens(sets: DataFrame) -> DataFrame:
    """(tag_key, members, token, tf), one row per distinct token of each tag set."""
    tokens = F.split("tag_key", " ")
    counted = F.transform(
        F.array_distinct(tokens),
        lambda token: F.struct(
            token.alias("token"), F.size(F.filter(tokens, lambda other: other == token)).alias("tf")
        ),
    )
    return sets.where(F.col("tag_key") != "").select("tag_key", "members", F.inline(counted))


def _numbered_tokens(numbered: DataFrame) -> DataFrame:
    """(number, word, tf), one row per distinct token of each tag set; the tokens of a set are in order, so equal ones are a run."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            lists = pc.split_pattern(batch.column("tag_key"), " ")
            words, sizes = lists.flatten(), lists.value_lengths().to_numpy(zero_copy_only=False)
            new = np.ones(len(words), bool)
            new[1:] = pc.not_equal(words[1:], words[:-1]).to_numpy(zero_copy_only=False)
            new[np.cumsum(sizes) - sizes] = True
            at = np.flatnonzero(new)
            numbers = np.repeat(batch.column("number").to_numpy(), sizes)[at]
            yield pa.RecordBatch.from_arrays(
                [pa.array(numbers), words.take(pa.array(at)), pa.array(np.diff(at, append=len(words)).astype(np.int32))], names=["number", "word", "tf"]
            )

    return numbered.select("number", "tag_key").mapInArrow(run, "number long, word string, tf int")


def idf(sets: DataFrame) -> DataFrame:
    """(token, df, idf): items holding the token and ln((1 + n) / (1 + df)) + 1 over all n items."""
    total = sets.agg(F.sum("members")).scalar()
    tokens = sets.where(F.col("tag_key") != "").select("members", F.explode(F.array_distinct(F.split("tag_key", " "))).alias("token"))
    counts = tokens.groupBy("token").agg(F.sum("members").alias("df"))
    return counts.withColumn("idf", (F.log((F.lit(1.0) + total) / (F.lit(1.0) + F.col("df"))) + 1).cast(WEIGHT))


def set_weights(sets: DataFrame) -> DataFrame:
    """(tag_key, token, tf, weight, idf) with weight = tf * idf, not yet normalised.

    The join is left to the optimiser: the vocabulary is broadcast when it measures small, and a token
    of very many sets is split as a skewed partition when it does not.
    """
    joined = _set_tokens(sets).select("tag_key", "token", "tf").join(idf(sets).select("token", "idf"), "token")
    return joined.select("tag_key", "token", "tf", (F.col("tf") * F.col("idf")).cast(WEIGHT).alias("weight"), "idf")


def _square(weight: str = "weight") -> Column:
    return F.sum(F.col(weight) * F.col(weight)).cast(PRODUCT)


def tfidf(items: DataFrame, item: str, tags: str = "tags") -> DataFrame:
    """(item, token, weight): each item's weights, scaled to length 1."""
    keyed = with_tag_key(items, tags).select(item, "tag_key")
    sets = tag_sets(keyed)
    rows = _to_items(keyed, sets, set_vectors(sets), item)
    return rows.select(item, "square", F.inline("entries")).select(
        item, "token", (F.col("weight").cast("double") / F.sqrt(F.col("square").cast("double"))).alias("weight")
    )


def set_vectors(sets: DataFrame) -> DataFrame:
    """(tag_key, entries, square): the set's (token, tf, weight, idf) entries and its squared length.

    A group here is one tag set, as large as its own ``tag_key``.
    """
    entry = F.struct("token", "tf", "weight", "idf")
    return set_weights(sets).groupBy("tag_key").agg(
        F.array_sort(F.collect_list(entry)).alias("entries"), _square().alias("square")
    )


def _cosine(dot: Column, square: Column, other_square: Column) -> Column:
    return dot.cast("double") / (F.sqrt(square.cast("double")) * F.sqrt(other_square.cast("double")))


def _first_members(keyed: DataFrame, item: str, count: int) -> DataFrame:
    """The ``count`` lowest items of each tag set; every task keeps no more than that before the shuffle."""
    place = F.row_number().over(Window.partitionBy("tag_key").orderBy(item))
    return keyed.where(F.col("tag_key") != "").withColumn("_place", place).where(F.col("_place") <= count).drop("_place")


def _target_scores(sets: DataFrame, target: DataFrame) -> DataFrame:
    """(tag_key, score) of every tag set that shares a token with ``target``, a frame of at most one item."""
    vectors = set_vectors(sets)
    wanted = vectors.join(F.broadcast(target.select("tag_key").limit(1)), "tag_key", "left_semi")
    wanted = wanted.select(F.inline("entries"), F.col("square").alias("target_square"))
    wanted = wanted.select("token", F.col("weight").alias("target_weight"), "target_square")
    # One row per token of one item is broadcast.
    shared = vectors.select("tag_key", "square", F.inline("entries")).join(F.broadcast(wanted), "token")
    dot = F.sum(F.col("weight") * F.col("target_weight")).cast(PRODUCT)
    sums = shared.groupBy("tag_key", "square", "target_square").agg(dot.alias("dot"))
    return sums.select("tag_key", _cosine(F.col("dot"), F.col("square"), F.col("target_square")).alias("score"))


def _first(keyed: DataFrame, item: str, target: Column) -> DataFrame:
    return keyed.where(target).orderBy(item).limit(1).select(item, "tag_key")


def cosine_to(items: DataFrame, item: str, target: Column, tags: str = "tags") -> DataFrame:
    """(item, other, score) of the first item that meets ``target`` against every other that shares a token.

    One pass over the items: the target's few tokens are the only broadcast.
    """
    keyed = with_tag_key(items, tags)
    first = _first(keyed, item, target)
    sets = tag_sets(keyed)
    own = first.select(item).scalar()
    others = _to_items(keyed.select(F.col(item).alias("other"), "tag_key"), sets, _target_scores(sets, first), "other")
    return others.where(F.col("other") != own).select(own.alias(item), "other", "score")


def similar_to(
    items: DataFrame, item: str, target: Column, tags: str = "tags", count: int = 10, exclude: Column | None = None
) -> DataFrame:
    """(other, score, rk), the ``count`` items most like the first one that meets ``target``; ties go to the lower id.

    Only the target itself is left out, unless ``exclude`` says which items are (all of one title, say).
    """
    keyed = with_tag_key(items, tags)
    first = _first(keyed, item, target)
    scores = _target_scores(tag_sets(keyed), first)
    candidates = keyed.where(~exclude) if exclude is not None else keyed.where(F.col(item) != first.select(item).scalar())
    members = _first_members(candidates.select(item, "tag_key"), item, count)
    best = members.join(scores, "tag_key").select(F.col(item).alias("other"), "score")
    return first_rows(best, count, [F.desc("score"), "other"], "rk")


def _numbered_sets(keyed: DataFrame, item: str) -> DataFrame:
    """(tag_key, members, first, number): the tag sets that have tokens, numbered from 0 by their lowest item."""
    sets = keyed.where(F.col("tag_key") != "").groupBy("tag_key").agg(F.count("*").alias("members"), F.min(item).alias("first"))
    return number_rows(sets, "number", ["first"], start=0)


@contextmanager
def _row_by_row(spark: SparkSession) -> Iterator[None]:
    """Steps settled inside hand Python one row at a time, and cross joins read both sides in place."""
    names = {"spark.sql.execution.arrow.maxRecordsPerBatch": "1", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {name: spark.conf.get(name) for name in names}
    for name, value in names.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def _packed(pieces: list[pa.RecordBatch], heavy: np.ndarray) -> pa.RecordBatch:
    """One row with all sets of a run: numbers, roots, the weights of ``heavy`` tokens as a table, the others by token."""
    rows = pa.Table.from_batches(pieces).combine_chunks()
    columns = {name: rows.column(name).chunk(0) for name in ("number", "root", "tokens", "weights")}
    tokens, weights = (columns[name].flatten().to_numpy(zero_copy_only=False) for name in ("tokens", "weights"))
    places = np.repeat(np.arange(len(rows), dtype=np.int32), columns["tokens"].value_lengths().to_numpy(zero_copy_only=False))
    table = np.zeros((len(rows), len(heavy)), np.int64)
    common = np.isin(tokens, heavy)
    table[places[common], np.searchsorted(heavy, tokens[common])] = weights[common]
    order = np.flatnonzero(~common)
    order = order[np.argsort(tokens[order], kind="stable")]
    parts = (columns["number"].to_numpy(), columns["root"].to_numpy(), table, tokens[order], places[order], weights[order])
    return pa.RecordBatch.from_arrays(
        [rows.column("pack").chunk(0)[:1], *(pa.array([part.tobytes()], pa.binary()) for part in parts)], names=["pack", *PACK]
    )


def _packs(vectors: DataFrame, pack: Column, parts: int, heavy: np.ndarray) -> DataFrame:
    """One row per run of sets (:func:`_packed`), about a partition each, in the order of the runs."""
    rows = vectors.select(pack.alias("pack"), "number", "root", "tokens", "weights")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces: list[pa.RecordBatch] = []
        for batch in batches:
            packs = batch.column("pack").to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(packs)) + 1).tolist(), batch.num_rows]
            for start, end in zip(cuts, cuts[1:]):
                if pieces and end > start and pieces[0].column("pack")[0].as_py() != packs[start]:
                    yield _packed(pieces, heavy)
                    pieces = []
                if end > start:
                    pieces.append(batch.slice(start, end - start))
        if pieces:
            yield _packed(pieces, heavy)

    ordered = rows.repartitionByRange(parts, "pack").sortWithinPartitions("pack")
    return materialise(ordered.mapInArrow(run, ", ".join(["pack long", *(f"{name} binary" for name in PACK)])))


class _Run:
    """A run of tag sets, and as the asking one its best sets so far: ``scores`` and ``others``, ``wanted`` per set."""

    def __init__(self, parts: list[bytes], many: int, wanted: int = 0) -> None:
        read = lambda at, kind: np.frombuffer(parts[at], kind)
        self.numbers, self.roots = read(0, np.int64), read(1, np.float64)
        self.table = read(2, np.int64).reshape(len(self.numbers), many)
        self.tokens, self.places, self.weights = read(3, np.int64), read(4, np.int32).astype(np.intp), read(5, np.int64)
        self.scaled_table = (self.table / (UNIT * self.roots[:, None])).astype(np.float32)
        self.reach = np.sqrt((self.scaled_table.astype(np.float64) ** 2).sum(1))
        if wanted:
            order = np.argsort(self.places, kind="stable")
            self.tokens, self.places, self.weights = self.tokens[order], self.places[order], self.weights[order]
            self.counts = np.bincount(self.places, minlength=len(self.numbers))
            self.starts = np.cumsum(self.counts) - self.counts
            self.scores, self.others = np.zeros((len(self.numbers), wanted)), np.full((len(self.numbers), wanted), -1, np.int64)
            # Sums of single floats are this near, as all terms are positive.
            self.slack = (self.counts + many + 16) * 2.0**-22
        else:
            first = np.flatnonzero(np.diff(self.tokens, prepend=-1))
            self.known, self.starts = self.tokens[first], first
            self.counts = np.diff(first, append=len(self.tokens))
        self.scaled = (self.weights / (UNIT * self.roots[self.places])).astype(np.float32)


def _spans(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """start, start + 1, ... for each count, one after another."""
    return np.repeat(starts - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())


def _ranks(groups: np.ndarray) -> np.ndarray:
    """Place of each row in its group, for sorted groups."""
    first = np.flatnonzero(np.diff(groups, prepend=-1))
    return np.arange(len(groups)) - np.repeat(first, np.diff(first, append=len(groups)))


def _meet(asking: _Run, offered: _Run, wide: bool, sums: np.ndarray) -> None:
    """Takes the best sets of ``offered`` over into ``asking``; ``sums`` is a buffer of zeros and stays one.

    Pairs with a common token that is not heavy are found by postings. A pair with heavy ones alone is at most as near as the
    lengths of the heavy parts, and such pairs are looked at for the sets only that this could bring something.
    """
    if not len(offered.numbers):
        return
    least = asking.scores[:, -1] * (1 - asking.slack)
    reach = asking.reach * offered.reach.max() * (1 + 1e-5)
    every = (reach > 0) & (reach >= least)
    at = np.searchsorted(offered.known, asking.tokens)
    at[at == len(offered.known)] = 0
    met = offered.known[at] == asking.tokens if len(offered.known) else np.zeros(len(at), bool)
    counts = np.where(met, offered.counts[at] if len(offered.known) else 0, 0)
    starts = offered.starts[at] if len(offered.known) else at
    for whole in (True, False):
        sets = np.flatnonzero(every == whole)
        for start in range(0, len(sets), CHUNK):
            _meet_sets(asking, offered, sets[start : start + CHUNK], whole, starts, counts, least, wide, sums)


def _meet_sets(asking: _Run, offered: _Run, sets: np.ndarray, whole: bool, starts: np.ndarray, counts: np.ndarray, least: np.ndarray, wide: bool, sums: np.ndarray) -> None:
    width, wanted = len(offered.numbers), asking.scores.shape[1]
    entries = _spans(asking.starts[sets], asking.counts[sets])
    owner = np.repeat(np.arange(len(sets)), asking.counts[sets])
    each = counts[entries]
    rows = _spans(starts[entries], each)
    if not whole and not len(rows):
        return
    cells = np.repeat(owner * width, each) + offered.places[rows]
    products = offered.scaled[rows] * np.repeat(asking.scaled[entries], each)
    floor = least[sets]
    if whole or len(rows) * 4 > len(sets) * width:
        total = asking.scaled_table[sets] @ offered.scaled_table.T
        np.add.at(total.reshape(-1), cells, products)
        if width > 4 * wanted:
            best = np.partition(total, width - wanted, 1)[:, width - wanted] if (floor <= 0).any() else floor
            floor = np.maximum(floor, best * (1 - 2 * asking.slack[sets]))
        near = (total >= floor[:, None]) & (total > 0)
        found = np.flatnonzero(near)
        taken = np.flatnonzero(near.reshape(-1)[cells])
    else:
        np.add.at(sums, cells, products)
        lacking = floor - asking.reach[sets] * (offered.reach.max() * (1 + 1e-5))
        summed = sums[cells]
        sums[cells] = 0
        taken = np.flatnonzero(summed >= np.repeat(lacking[owner], each))
        bound = asking.reach[sets][cells[taken] // width] * offered.reach[cells[taken] % width] * (1 + 1e-5)
        taken = taken[summed[taken] + bound >= floor[cells[taken] // width]]
        found = np.unique(cells[taken])
    if not len(found):
        return
    kind = object if wide else np.int64
    mine, theirs = found // width, found % width
    dot = (asking.table[sets[mine]].astype(kind) * offered.table[theirs].astype(kind)).sum(1) if asking.table.shape[1] else np.zeros(len(found), kind)
    entry = entries[np.searchsorted(np.cumsum(each), taken, side="right")]
    np.add.at(dot, np.searchsorted(found, cells[taken]), offered.weights[rows[taken]].astype(kind) * asking.weights[entry].astype(kind))
    # Few are near enough to be worked out exactly.
    lengths = asking.roots[sets[mine]] * offered.roots[theirs]
    about = dot.astype(float) / UNIT**2 / lengths
    order = np.lexsort((-about, mine))
    last = order[_ranks(mine[order]) == wanted - 1]
    bar = asking.scores[sets, -1]
    bar[mine[last]] = np.maximum(bar[mine[last]], about[last])
    kept = np.flatnonzero((about >= bar[mine] * (1 - 1e-12)) & (about > 0))
    mine, theirs = mine[kept], theirs[kept]
    # As the decimal is cast to a double: the quotient of whole numbers is rounded once.
    exact = np.array([int(value) / UNIT**2 for value in dot[kept].tolist()])
    changed = np.unique(mine)
    group = np.concatenate([mine, np.repeat(changed, wanted)])
    score = np.concatenate([exact / lengths[kept], asking.scores[sets[changed]].reshape(-1)])
    other = np.concatenate([offered.numbers[theirs], asking.others[sets[changed]].reshape(-1)])
    order = np.lexsort((np.where(other < 0, np.iinfo(np.int64).max, other), -score, group))
    rank = _ranks(group[order])
    order, rank = order[rank < wanted], rank[rank < wanted]
    asking.scores[sets[group[order]], rank] = score[order]
    asking.others[sets[group[order]], rank] = other[order]


def _best_sets(vectors: DataFrame, wanted: int, heavy: list[int]) -> DataFrame:
    """(number, other, score): the ``wanted`` best sets for every set, itself among them; ties go to the lower number.

    ``vectors`` has (number, tokens, weights, root), weights as whole numbers. A task holds a run of sets and reads all runs
    of sets one after another, those with the longest part in ``heavy`` tokens first: no pair of sets is ever a row, only the
    best of all runs are. The work is that of all pairs with a common token that is not heavy, a multiplication each, and
    of the pairs with heavy tokens that :func:`_meet` cannot rule out.
    """
    spark, common = vectors.sparkSession, np.array(sorted(heavy), np.int64)
    part = F.aggregate(
        F.zip_with("tokens", "weights", lambda token, weight: F.when(token.isin(heavy), (weight / UNIT) * (weight / UNIT)).otherwise(0.0)), F.lit(0.0), lambda total, one: total + one
    ) if heavy else F.lit(0.0)
    facts = vectors.agg(F.count("*"), F.sum(F.size("tokens")), F.max("root")).first()
    sets, entries, longest = facts[0], facts[1] or 0, facts[2] or 0.0
    wide = longest**2 * UNIT**2 >= 2.0**62  # no dot product is larger than the longest square
    placed = number_rows(vectors.withColumn("part", F.sqrt(part) / F.col("root")), "place", [F.desc("part"), F.col("number")], start=0)

    def size(limit: int) -> int:
        return max(1, min(limit, limit * PACK_TOKENS * sets // max(entries, 1)))

    few, many = min(size(ASKING), -(-sets // LEAST_RUNS) or 1), size(OFFERED)
    first = max(1, many // 16)
    asking = _packs(placed, F.floor(F.col("place") / few), -(-sets // few) or 1, common)
    # The first runs are short: what they bring rules most of the others out.
    later = F.floor((F.col("place") - 4 * first) / many) + 2
    pack = F.when(F.col("place") < first, 0).when(F.col("place") < 4 * first, 1).otherwise(later).cast("long")
    offered = _packs(placed, pack, -(-sets // many) + 2, common)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs: dict[int, _Run] = {}
        sums = np.zeros(0, np.float32)
        for batch in batches:
            for row in range(batch.num_rows):
                read = lambda start: [memoryview(batch.column(start + at)[row].as_buffer()) for at in range(len(PACK))]  # noqa: B023, E731
                key = batch.column(0)[row].as_py()
                if key not in runs:
                    runs[key] = _Run(read(1), len(common), wanted)
                other = _Run(read(2 + len(PACK)), len(common))
                if len(sums) < CHUNK * len(other.numbers):
                    sums = np.zeros(CHUNK * len(other.numbers), np.float32)
                _meet(runs[key], other, wide, sums)
        for found in runs.values():
            at, place = np.nonzero(found.others >= 0)
            yield pa.RecordBatch.from_arrays(
                [pa.array(found.numbers[at]), pa.array(found.others[at, place]), pa.array(found.scores[at, place])], names=["number", "other", "score"]
            )

    theirs = offered.coalesce(1).select(*(F.col(name).alias(f"other_{name}") for name in ("pack", *PACK)))
    pairs = theirs.crossJoin(asking).select("pack", *PACK, "other_pack", *(f"other_{name}" for name in PACK))
    with _row_by_row(spark):
        return materialise(pairs.mapInArrow(run, "number long, other long, score double"))


def similar_lists(
    items: DataFrame, item: str, tags: str = "tags", count: int = 10, facts: DataFrame | None = None
) -> DataFrame:
    """(item, best): for every item its ``count`` most similar others as (other, score, ...), exact, ties to the lower id.

    The further columns of ``facts``, a frame with one row per item, are added to the others while they are still one list
    per tag set.

    Works on distinct tag sets, with any number of tags. Sets are numbered by their lowest item, and tokens are numbered
    too, so runs of sets are plain arrays; every run is scored against every other (:func:`_best_sets`). The
    items' keys and the vectors, one row per tag set, are settled once; past them, only numbers of sets move, no tokens.
    """
    wanted = count + 1
    keyed = materialise(with_tag_key(items, tags).select(item, "tag_key"))
    sets = tag_sets(keyed)
    numbered = _numbered_sets(keyed, item)
    vocabulary = number_rows(idf(sets).select(F.col("token").alias("word"), "df", "idf"), "token", ["word"])
    often = vocabulary.where(F.col("df") > F.lit(keyed.count() / HEAVY_SHARE)).orderBy(F.desc("df"), "token").limit(HEAVY)
    heavy = [row["token"] for row in often.select("token").collect()]
    weighted = _numbered_tokens(numbered).join(vocabulary, "word").select("number", "token", (F.col("tf") * F.col("idf")).cast(WEIGHT).alias("weight"))
    entry = F.struct("token", (F.col("weight") * UNIT).cast("long").alias("weight"))
    gathered = weighted.groupBy("number").agg(F.collect_list(entry).alias("entries"), _square().alias("square"))
    vectors = materialise(
        gathered.select("number", F.col("entries.token").alias("tokens"), F.col("entries.weight").alias("weights"), F.sqrt(F.col("square").cast("double")).alias("root"))
    )
    best_sets = _best_sets(vectors, wanted, heavy)
    # Each of the best items is in one of the best sets, ordered by score and lowest item.
    rows = materialise(_to_items(keyed, sets, numbered.select("tag_key", "number"), item).select(item, "number"))
    place = F.row_number().over(Window.partitionBy("number").orderBy(item))
    members = rows.withColumn("_place", place).where(F.col("_place") <= wanted).select(F.col(item).alias("other_item"), F.col("number").alias("other"))
    best = Window.partitionBy("number").orderBy(F.desc("score"), "other_item")
    kept = best_sets.join(members, "other").withColumn("_place", F.row_number().over(best)).where(F.col("_place") <= wanted)
    named = [] if facts is None else [name for name in facts.columns if name != item]
    if facts is not None:
        kept = kept.join(facts.withColumnRenamed(item, "other_item"), "other_item", "left")
    entry = F.struct("_place", F.col("other_item").alias("other"), "score", *named)
    lists = kept.groupBy("number").agg(F.sort_array(F.collect_list(entry)).alias("best"))

    rows = skew_join(rows, lists, ["number"], spread=[item], hot=hot_counts(numbered, ["number"], "members"))
    others = F.slice(F.filter("best", lambda entry: entry["other"] != F.col(item)), 1, count)
    return rows.select(item, others.alias("best"))


def similar_top(items: DataFrame, item: str, tags: str = "tags", count: int = 10) -> DataFrame:
    """(item, other, score, rk): the lists of :func:`similar_lists`, one row per item and other."""
    lists = similar_lists(items, item, tags, count)
    return lists.select(item, F.posexplode("best").alias("_at", "_best")).select(
        item, F.col("_best.other").alias("other"), F.col("_best.score").alias("score"), (F.col("_at") + 1).alias("rk")
    )
