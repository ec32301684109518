"""Mixing sources to target weights by a low-discrepancy schedule.

The words of the mix are dealt in slots of equal size. Slot n takes the point n * A / M modulo 1, with M and A
neighbouring Fibonacci numbers (the golden ratio in whole numbers), and goes to the source in whose part of
the cumulative targets the point falls; so every stretch of the schedule has the targets' shares. The slots of
a source are ranked, and rank r takes the r-th block of equal size of the source's shuffled documents, read
over and over at most ``most_copies`` times. The last blocks are cut at the target.

Nothing is ranked in one task: documents are placed within hash ranges of their source, slots within chunks of
the schedule, and only sizes of ranges and chunks are summed up in order.

Defined results: a NULL text has size 0 and takes nothing; NULL is a source like others, the last one; repeated
rows are placed one after another, each with its own answer; an empty table, or one without words, takes
nothing; other columns are ignored. Documents are shuffled by a hash of the id and the seed, so reruns agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import packed, settled, whole

# Neighbouring Fibonacci numbers.
MODULUS, FACTOR = 1_134_903_170, 701_408_733
WEIGHTS = (1, 2, 3)
MOST_COPIES = 3
BLOCK = 256
RANGES = 4096
CHUNK = 65_536
CELLS = 1024
SPARE = 64


def sizes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", seed: int = 0) -> DataFrame:
    """doc_id, source, size in words, place in the shuffle and its hash range."""
    key = F.md5(F.concat_ws(":", F.coalesce(F.col(doc_id).cast("string"), F.lit("")), F.lit(str(seed))))
    return docs.select(
        F.col(doc_id).alias("doc_id"),
        F.col(source).alias("source"),
        F.regexp_count(whole(F.col(text)), F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("size"),
        F.xxhash64(whole(F.col(text))).alias("content"),
        key.alias("key"),
        F.conv(F.substring(key, 1, 3), 16, 10).cast("int").alias("range"),
    )


def running(value: Column, *keys: Column | str, order: list) -> Column:
    """Sum of ``value`` over the rows before this one."""
    before = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(value).over(before), F.lit(0).cast("long"))


def targets(sized: DataFrame, weights: tuple = WEIGHTS, most_copies: int = MOST_COPIES) -> DataFrame:
    """source, source_size, target and the part [lower, upper) of the unit interval.

    Weights are dealt to the sources by code point, NULL last. A share above ``most_copies`` times its source's
    size is cut there and the rest reshared by weight: with the sources in order of size per weight, exactly a
    first few are cut, and all others get the same words per weight. One row per source is ordered here.
    """
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weighed = sources.withColumn("place", place).withColumn(
        "weight", F.element_at(F.array(*(F.lit(weight).cast("long") for weight in weights)), (F.col("place") % len(weights) + 1).cast("int"))
    )
    order = [F.col("source_size") / F.col("weight"), "place"]
    everything = Window.partitionBy()
    shared = weighed.select(
        "*",
        F.sum("source_size").over(everything).alias("total"),
        running(F.col("source_size"), order=order).alias("cut_before"),
        (F.sum("weight").over(everything) - running(F.col("weight"), order=order)).alias("weight_left"),
    )
    most = F.lit(most_copies).cast("long")
    level = (F.col("total") - most * F.col("cut_before")) / F.col("weight_left")
    cut = most * F.col("source_size") < level * F.col("weight")
    levels = shared.withColumn("level", level).withColumn("cut", cut)
    final = F.min(F.when(~F.col("cut"), F.struct(*order, "level"))).over(everything)["level"]
    filled = levels.withColumn("target", F.when(F.col("cut"), most * F.col("source_size")).otherwise(final * F.col("weight")).cast("double"))
    by_place = Window.orderBy("place").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    bounded = filled.withColumn("upper", F.try_divide(F.sum("target").over(by_place), F.col("total")))
    lower = F.lag("upper", 1, 0.0).over(Window.orderBy("place"))
    return bounded.select("source", "source_size", "target", "total", "place", lower.alias("lower"), "upper")


def schedule(spark: SparkSession, shares: DataFrame, block: int = BLOCK) -> DataFrame:
    """place (of the source), slot and rank: which slots go to which source, ranked within it.

    As many slots as the targets need and a few more; what lies beyond a target is cut when blocks are taken. A
    source whose part the points hit too rarely gets the slots that it lacks behind all others, so that each
    source reaches its target at any size of the corpus. Sources are found over cells of the unit interval by an
    equal join.
    """
    total = F.max("total")
    need = F.ceil(total / block) + F.ceil(total / block / 16) + SPARE * F.count("*")
    planned = shares.agg(F.coalesce(need, F.lit(0)).cast("long").alias("slots"), F.count("*").alias("sources"))
    chunks = planned.select(
        "slots", F.explode(F.sequence(F.lit(0).cast("long"), (F.col("slots") / CHUNK).cast("long"))).alias("chunk")
    )
    slots = (
        chunks.repartition("chunk")
        .select("slots", "chunk", F.explode(F.sequence(F.col("chunk") * CHUNK, F.col("chunk") * CHUNK + CHUNK - 1)).alias("slot"))
        .where(F.col("slot") < F.col("slots"))
        .withColumn("point", F.col("slot") % MODULUS * FACTOR % MODULUS / F.lit(float(MODULUS)))
        .withColumn("cell", (F.col("point") * CELLS).cast("int"))
    )
    last = F.lit(CELLS - 1)
    cells = shares.where("target > 0").select(
        "place", "lower", "upper", F.explode(F.sequence(F.greatest((F.col("lower") * CELLS).cast("int"), F.lit(0)), F.least((F.col("upper") * CELLS).cast("int"), last))).alias("cell")
    )
    # Spark takes exploded sequences for small; what grows with the corpus is never broadcast.
    dealt = slots.hint("merge").join(cells, "cell").where((F.col("point") >= F.col("lower")) & (F.col("point") < F.col("upper"))).select("place", "chunk", "slot")
    counts = dealt.groupBy("place", "chunk").agg(F.count("*").alias("count"))
    offsets = counts.select("place", "chunk", running(F.col("count"), "place", order=["chunk"]).alias("offset"))
    within = F.row_number().over(Window.partitionBy("place", "chunk").orderBy("slot")) - 1
    ranks = dealt.withColumn("within", within).hint("merge").join(offsets, ["place", "chunk"]).select("place", "slot", (F.col("offset") + F.col("within")).alias("rank"))
    had = counts.groupBy("place").agg(F.sum("count").alias("had"))
    wanted = shares.select("place", F.ceil(F.round("target") / block).cast("long").alias("wanted"))
    short = wanted.join(had, "place", "left").withColumn("had", F.coalesce("had", F.lit(0).cast("long"))).where("had < wanted")
    lacking = short.crossJoin(F.broadcast(planned)).withColumn("rank", F.explode(F.sequence(F.col("had"), F.col("wanted") - 1)))
    return ranks.unionByName(lacking.select("place", (F.col("slots") + F.col("rank") * F.col("sources") + F.col("place")).alias("slot"), "rank"))


def shuffled(sized: DataFrame, shares: DataFrame) -> DataFrame:
    """``sized`` with its source's figures and the document's first word in the source's shuffled stream."""
    shares = shares.select(F.col("source").alias("_source"), "source_size", "target", "place")
    known = sized.join(shares, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    ranges = known.groupBy("place", "range").agg(F.sum("size").alias("words"))
    starts = ranges.select("place", "range", running(F.col("words"), "place", order=["range"]).alias("base"))
    order = ["key", "doc_id", "size", "content"]
    return (
        known.withColumn("inner", running(F.col("size"), "place", "range", order=order))
        .join(starts, ["place", "range"])
        .withColumn("first", F.col("base") + F.col("inner"))
        .drop("base", "inner")
    )


def mix(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: tuple = WEIGHTS,
    most_copies: int = MOST_COPIES,
    block: int = BLOCK,
    seed: int = 0,
) -> DataFrame:
    """doc_id, source, size, content, source_size, target and taken: the words of the document that the mix takes."""
    sized = settled(sizes(docs, doc_id, text, source, seed))
    shares = settled(targets(sized, weights, most_copies))
    placed = shuffled(sized, shares)
    length = F.lit(block).cast("long")
    reads = placed.where("size > 0").withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(most_copies - 1).cast("long"))))
    begin = F.col("first") + F.col("copy") * F.col("source_size")
    pieces = reads.select("*", begin.alias("begin"), (begin + F.col("size")).alias("end")).withColumn(
        "rank", F.explode(F.sequence(F.expr(f"begin div {block}"), F.expr(f"(end - 1) div {block}")))
    )
    stop = F.least((F.col("rank") + 1) * length, F.round("target").cast("long"), F.col("end"))
    words = F.greatest(stop - F.greatest(F.col("rank") * length, F.col("begin")), F.lit(0).cast("long"))
    slots = schedule(docs.sparkSession, shares, block).select("place", "rank", F.lit(True).alias("dealt"))
    columns = ["doc_id", "source", "size", "content", "source_size", "target"]
    taken = (
        pieces.withColumn("words", words)
        .join(slots.hint("merge"), ["place", "rank"], "left")
        .groupBy("place", "first", *columns)
        .agg(F.sum(F.when(F.col("dealt"), F.col("words")).otherwise(0)).alias("taken"))
        .select(*columns, "taken")
    )
    return taken.unionByName(placed.where("size = 0").select(*columns, F.lit(0).cast("long").alias("taken")))


def repeated(docs: DataFrame, mixed: DataFrame, doc_id: str = "doc_id", source: str = "source", text: str = "text") -> DataFrame:
    """``docs`` as the mix has them: each row as often as its words were taken, to the nearest whole number.

    Only the documents at a source's cut are taken in part. Rows alike in id, source and text share the sum of
    their copies.
    """
    copies = mixed.groupBy("doc_id", "source", "content").agg(F.sum(F.when(F.col("size") > 0, F.round(F.col("taken") / F.col("size"))).otherwise(0)).cast("int").alias("copies"))
    rows = packed(docs, id=F.col(doc_id), origin=F.col(source), hash=F.xxhash64(whole(F.col(text)))).dropDuplicates(["id", "origin", "hash"])
    same = F.col("id").eqNullSafe(F.col("doc_id")) & F.col("origin").eqNullSafe(F.col("source")) & (F.col("hash") == F.col("content"))
    joined = rows.join(copies.where("copies > 0"), same)
    return joined.select("row", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("row.*")


def digests(mixed: DataFrame) -> DataFrame:
    return mixed.select("doc_id", "size", "source_size", "target", "taken")
