"""Benchmark decontamination: a prefix-filtered set join of item windows with documents.

Every item is cut into windows of ``WINDOW`` words (a shorter item is one window). A window is the set of its shingles of
``SEED`` words at their places. Shingles are ordered by rarity over all documents and windows. A window must be contained
whole, so none of its shingles may be missing, and the necessary prefix of that order is its one rarest shingle: only it is
joined with the shingles of the documents. The place of the shingle in the window and in the document says where the
window would start (positional bound), and the rest of the document must hold its length (length bound); what passes is verified
word by word. Everything runs in DataFrame operators.

Windows are broadcast in blocks whose size is measured to stay below ``BLOCK_BYTES``; a benchmark of any size takes more
blocks, each of them one pass over the documents. Texts of documents are never shuffled.

Defined results: letters A-Z are lowered; words are runs of ASCII letters, digits and other signs beyond ASCII; a NULL text has
no words; rows that repeat an id with the same text get the same answer each; items that repeat count by their distinct
ids, and a NULL id as an item without name, which is counted but not listed; items without words have no window. Ties in
rarity go to the smaller hash, then the earlier place. Very long texts are one row each and are walked once per block; an empty
benchmark hits nothing; an empty document table gives an empty result. Other columns, whatever their names, are ignored.
"""

from __future__ import annotations

from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import settled, whole

WINDOW = 10
SEED = 5
BLOCK_BYTES = 32 << 20
ROW_BYTES = 64  # of a broadcast row besides its window's text
# Written as what a word holds: written as what it does not hold, it took 4 to 10 times as long with 8 tasks in one JVM.
WORD = r"[0-9A-Za-z\x{80}-\x{10FFFF}]+"


def lowered(text: Column) -> Column:
    return F.translate(text, ascii_uppercase, ascii_lowercase)


def words(text: Column) -> Column:
    """Words of a text, letters as they are: few of them are ever compared, and those are lowered then."""
    return F.regexp_extract_all(whole(text), F.lit(WORD), F.lit(0))


def windows(items: DataFrame, window: int = WINDOW) -> DataFrame:
    """content (words joined by blanks), n_words and item_id: each distinct window of each item."""
    cut = items.select("item_id", words(lowered(F.col("text"))).alias("words")).where(F.size("words") > 0)
    start = F.explode(F.sequence(F.lit(1), F.greatest(F.size("words") - window + 1, F.lit(1))))
    cut = cut.select("item_id", "words", start.alias("start"))
    return cut.select(F.slice("words", F.col("start"), window).alias("part"), "item_id").select(
        F.array_join("part", " ").alias("content"), F.size("part").alias("n_words"), "item_id"
    ).distinct()


def _hashed(list_of_words: Column) -> Column:
    """Words that are equal with A-Z lowered have equal hashes; others may have, as all letters are lowered here."""
    return F.transform(list_of_words, lambda word: F.xxhash64(F.lower(word)))


def _shingles(rows: DataFrame, hashes: str, width: int) -> DataFrame:
    """``rows`` once per shingle of ``width`` words: its place (from 0) and hash."""
    # The filter comes behind the explosion: before it, each text would be split once more for it.
    last = F.greatest(F.size(hashes) - width, F.lit(0))
    placed = rows.select("*", F.explode(F.sequence(F.lit(0), last)).alias("place")).where(F.col("place") + width <= F.size(hashes))
    return placed.withColumn("shingle", F.xxhash64(F.lit(width), F.slice(hashes, F.col("place") + 1, width)))


def _document_key() -> Column:
    return F.sha2(F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), whole(F.col("text"))), 256)


def _blocks(rows: DataFrame, size: Column) -> list[DataFrame]:
    """``rows`` in parts, by their shingle, each small enough to be broadcast."""
    total = rows.agg(F.sum(size)).first()[0] or 0
    many = -(-total // BLOCK_BYTES)
    if many == 1:
        return [F.broadcast(rows)]
    return [F.broadcast(rows.where(F.pmod("shingle", F.lit(many)) == at)) for at in range(many)]


def occurrences(docs: DataFrame, wanted: DataFrame, seed: int = SEED) -> DataFrame:
    """key, content, start and n_words (of the window) of each window of ``wanted`` in ``docs`` (key, words)."""
    spark = docs.sparkSession
    kinds = wanted.select("content", "n_words").distinct()
    kinds = kinds.select("content", "n_words", _hashed(F.split("content", " ")).alias("hashes"))
    widths = [row[0] for row in kinds.select(F.least("n_words", F.lit(seed))).distinct().collect()]  # at most ``seed``
    hashed = docs.withColumn("hashes", _hashed(F.col("words")))
    nothing = spark.createDataFrame([], "key string, content string, start int, n_words int")
    for width in sorted(widths):
        own = kinds.where(F.least("n_words", F.lit(seed)) == width)
        seeds = settled(_shingles(own, "hashes", width).select("content", "n_words", "place", "shingle"))
        known = settled(seeds.groupBy("shingle").agg(F.count("*").alias("held")))
        seen = _shingles(hashed.select("hashes"), "hashes", width).select("shingle")
        counted = [seen.join(block.select("shingle"), "shingle").groupBy("shingle").count() for block in _blocks(known, F.lit(ROW_BYTES))]
        rarity = known.select("shingle", F.col("held").alias("count"))
        for part in counted:
            rarity = rarity.unionByName(part)
        rarity = rarity.groupBy("shingle").agg(F.sum("count").alias("rarity"))
        first = F.min(F.struct("rarity", "shingle", "place")).alias("first")
        prefixes = settled(
            seeds.join(rarity, "shingle").groupBy("content", "n_words").agg(first).select("content", "n_words", "first.shingle", F.col("first.place").alias("offset"))
        )
        for block in _blocks(prefixes, F.octet_length("content") + ROW_BYTES):
            met = _shingles(hashed, "hashes", width).join(block, "shingle").withColumn("start", F.col("place") - F.col("offset"))
            inside = met.where("start >= 0 AND start + n_words <= size(words)")
            same = lowered(F.array_join(F.slice("words", F.col("start") + 1, F.col("n_words")), " ")) == F.col("content")
            nothing = nothing.unionByName(inside.where(same).select("key", "content", "start", "n_words"))
    return nothing


def find(docs: DataFrame, items: DataFrame, window: int = WINDOW, seed: int = SEED) -> tuple[DataFrame, DataFrame]:
    """Places of item windows in documents (key, start, end in words), and the items met (key, item_id), each once.

    ``key`` stands for a document's id and text: :func:`keyed` gives it.
    """
    wanted = settled(windows(items, window))
    split = docs.select(_document_key().alias("key"), words(F.col("text")).alias("words"))
    found = settled(occurrences(split, wanted, seed).distinct())
    spans = found.select("key", "start", (F.col("start") + F.col("n_words")).alias("end")).distinct()
    met = found.select("key", "content").distinct().join(wanted.select("content", "item_id"), "content").select("key", "item_id").distinct()
    return spans, met


def keyed(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", _document_key().alias("key"), F.regexp_count(whole(F.col("text")), F.lit(WORD)).cast("long").alias("n_words"))


def digests(docs: DataFrame, spans: DataFrame, met: DataFrame) -> DataFrame:
    """One row per row of ``docs``: words, words hit, items met and their digest."""
    earlier = F.max("end").over(Window.partitionBy("key").orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1))
    fresh = F.greatest(F.col("end") - F.greatest("start", F.coalesce(earlier, F.lit(0))), F.lit(0))
    hit = spans.select("key", fresh.alias("fresh")).groupBy("key").agg(F.sum("fresh").cast("long").alias("n_hit"))
    name = F.col("item_id").cast("string")
    listed = met.groupBy("key").agg(F.count("*").alias("n_items"), F.sort_array(F.collect_list(name)).alias("items"))
    facts = hit.join(listed, "key")
    return keyed(docs).join(facts, "key", "left").select(
        "doc_id",
        "n_words",
        F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
        F.coalesce("n_items", F.lit(0).cast("long")).alias("n_items"),
        F.sha2(F.coalesce(F.array_join("items", ","), F.lit("")), 256).alias("items_sha256"),
        F.coalesce(F.col("n_hit") > 0, F.lit(False)).alias("contaminated"),
    )
