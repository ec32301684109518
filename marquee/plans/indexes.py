"""Stored indexes for text search: substrings by trigrams, phrases by word positions. Neither reads all texts.

A :class:`TextIndex` keeps five tables. ``texts`` has every version of every text, bucketed by key; the last version counts, a
NULL text is a removed one. Each batch deals its texts to blocks, where each has a slot; ``blocks`` has the keys of a block's
slots. ``grams`` has one row per block and three-sign substring, with the slots of the texts that have it, bucketed by their first
two signs: a search names the heads and trigrams that it needs, so Spark reads their buckets only, and a keyword of two signs
takes its head's bucket. ``words`` has one row per word and block, with the word's slots and places: a word that every text has is
as many rows as there are blocks, and lists of a search meet block by block. ``vocabulary`` has the distinct words, for the
broken words at a phrase's ends.

Postings only propose: what they find is verified on the last version of the text. So a changed text needs no search for its old
postings; they propose it in vain until :meth:`TextIndex.rebuild`.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .search import checked_keyword

BUCKETS = 32
BLOCK_TEXTS = 1024
FILE_TEXTS = 200_000  # texts of a batch per file of a bucket
FEW = 1_000  # keys or words that a filter may list; beyond, they are joined
END = "\u0000"  # stands behind a text, so that its last two signs start a trigram too
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"  # of a lowered text
_BLOCK_BITS = 32
_PLACE_BITS = 32  # of an entry: the word's place; above them the text's slot in its block


def grams(text: Column) -> Column:
    """Distinct trigrams of a lowered text and its end, in one walk over the text."""
    return F.array_distinct(F.regexp_extract_all(F.concat(text, F.lit(END)), F.lit("(?s)(?=(.{3}))"), F.lit(1)))


def _in_all(lists: DataFrame, name: str, count: int) -> DataFrame:
    """(block, ``name``): what all ``count`` lists of a block have in common; blocks with fewer lists have nothing."""
    every = lists.groupBy("block").agg(F.collect_list(name).alias("lists")).where(F.size("lists") == count)
    common = F.aggregate(F.slice("lists", 2, count), F.get("lists", F.lit(0)), F.array_intersect)
    return every.select("block", common.alias(name)).where(F.size(name) > 0)


def _starts(at: int) -> Column:
    """Entries of a phrase's word at ``at``, moved back by as much: those of one phrase then agree on its first word."""
    place = F.lit((1 << _PLACE_BITS) - 1)
    later = F.filter("entries", lambda entry: entry.bitwiseAND(place) >= at)
    return F.transform(later, lambda entry: entry - at)


class TextIndex:
    """Texts (key long, text, further columns of the caller) with postings, under one name in the catalogue."""

    def __init__(self, spark: SparkSession, name: str, buckets: int = BUCKETS) -> None:
        self.spark, self.name, self.buckets = spark, name, buckets

    def table(self, kind: str) -> DataFrame:
        return self.spark.table(f"{self.name}_{kind}")

    def _append(self, kind: str, rows: DataFrame, count: int, *order: str) -> None:
        """Each task writes one bucket, or one of its parts: a large batch has several per bucket, dealt by the last sort column."""
        parts = max(1, -(-count // FILE_TEXTS))
        bucket, part = F.pmod(F.hash(order[0]), F.lit(self.buckets)), F.pmod(F.xxhash64(order[-1]), F.lit(parts))
        self._write(kind, rows.repartition(self.buckets * parts, bucket, part), *order)

    def _write(self, kind: str, rows: DataFrame, *order: str) -> None:
        rows.write.mode("append").bucketBy(self.buckets, order[0]).sortBy(*order).saveAsTable(f"{self.name}_{kind}")

    def _version(self) -> int:
        if not self.spark.catalog.tableExists(f"{self.name}_texts"):
            return 0
        return self.table("texts").agg(F.max("version")).first()[0] or 0

    def add(self, rows: DataFrame) -> int:
        """Add new or changed texts as one batch; its version. Texts that are not in ``rows`` are not read."""
        version = self._version() + 1
        # Texts go to the files as their tasks come: they need no shuffle.
        self._write("texts", rows.withColumn("version", F.lit(version)), "key")
        self._post(self.table("texts").where(F.col("version") == version).select("key", "text"), version)
        return version

    def remove(self, keys: DataFrame) -> int:
        """Remove texts by key: their last version becomes NULL."""
        columns = self.table("texts").drop("version").schema
        empty = {field.name: F.lit(None).cast(field.dataType) for field in columns if field.name != "key"}
        return self.add(keys.select("key").distinct().select("key", *(value.alias(name) for name, value in empty.items())))

    def _post(self, texts: DataFrame, version: int) -> None:
        count = texts.count()
        blocks = max(1, -(-count // BLOCK_TEXTS))
        block = F.lit(version << _BLOCK_BITS) + F.pmod(F.xxhash64("key"), F.lit(blocks))
        low = texts.where(F.col("text").isNotNull()).select("key", F.lower("text").alias("text"), block.alias("block"))
        # A block's texts are in one partition, so its postings are put together there, and only whole lists move on.
        slot = (F.row_number().over(Window.partitionBy("block").orderBy("key")) - 1).alias("slot")
        keys = low.select("key", "block").repartition(blocks, "block").select("block", slot, "key")
        by_slot = F.array_sort(F.collect_list(F.struct("slot", "key")))
        self._append("blocks", keys.groupBy("block").agg(by_slot["key"].alias("keys")), 0, "block")
        dealt = low.repartition(blocks, "block").select("block", slot, "text")
        found = dealt.select("block", "slot", F.explode(grams(F.col("text"))).alias("gram"))
        posted = found.groupBy("block", "gram").agg(F.sort_array(F.collect_list("slot")).alias("slots"))
        self._append("grams", posted.select(F.substring("gram", 1, 2).alias("head"), "gram", "block", "slots"), count, "head", "gram", "block")
        placed = dealt.select("block", "slot", F.posexplode(F.regexp_extract_all("text", F.lit(WORD), F.lit(0))).alias("place", "word"))
        entry = F.shiftleft(F.col("slot").cast("long"), _PLACE_BITS) + F.col("place")
        posted = placed.groupBy("block", "word").agg(F.sort_array(F.collect_list(entry)).alias("entries"))
        self._append("words", posted.select("word", "block", "entries"), count, "word", "block")
        words = self.table("words").where(F.shiftright("block", _BLOCK_BITS) == version).select("word").distinct()
        self._append("vocabulary", words, 0, "word")

    def _keys(self, slots: DataFrame) -> DataFrame:
        """The keys of the texts in ``slots`` (block, slots)."""
        joined = slots.join(self.table("blocks"), "block")
        keys = F.transform("slots", lambda slot: F.get("keys", slot.cast("int")))
        return joined.select(F.explode(keys).alias("key")).distinct()

    def current(self, texts: DataFrame | None = None) -> DataFrame:
        """The last version of every text, or of those in ``texts``: grouped by the bucket key, without a shuffle."""
        rows = self.table("texts") if texts is None else texts
        others = [name for name in rows.columns if name not in ("key", "version")]
        last = rows.groupBy("key").agg(F.max_by(F.struct(*others), "version").alias("last"))
        return last.select("key", "last.*").where(F.col("text").isNotNull())

    def _verified(self, keys: DataFrame, keyword: str) -> DataFrame:
        """Texts of the candidates that hold the keyword. Few candidates are listed in the filter of the scan, which then
        reads their buckets only; others are joined, and the texts stay in their buckets."""
        few = [row["key"] for row in keys.limit(FEW + 1).collect()]
        texts = self.table("texts")
        rows = texts.where(F.col("key").isin(few)) if len(few) <= FEW else texts.join(keys, "key", "left_semi")
        return self.current(rows).where(F.contains(F.lower("text"), F.lit(keyword)))

    def containing(self, keyword: str) -> DataFrame:
        """Texts that hold the keyword, case ignored: candidates have all its trigrams."""
        keyword = checked_keyword(keyword)
        postings = self.table("grams")
        if len(keyword) < 3:
            return self._verified(self._keys(postings.where(F.col("head") == keyword).select("block", "slots")), keyword)
        wanted = sorted({keyword[at : at + 3] for at in range(len(keyword) - 2)})
        hits = postings.where(F.col("head").isin(sorted({gram[:2] for gram in wanted})) & F.col("gram").isin(wanted))
        return self._verified(self._keys(hits.select("block", "slots").transform(_in_all, "slots", len(wanted))), keyword)

    def _words_like(self, test: Column) -> Column:
        """The postings' words that pass: listed when few, else tested one by one."""
        few = [row["word"] for row in self.table("vocabulary").where(test).select("word").distinct().limit(FEW + 1).collect()]
        return F.col("word").isin(few) if len(few) <= FEW else test

    def phrase(self, phrase: str) -> DataFrame:
        """Texts that hold the phrase, case ignored, with its blanks and punctuation; it may start and end within a word."""
        phrase = checked_keyword(phrase)
        found = list(re.finditer(WORD, phrase))
        tests = []
        for at, match in enumerate(found):
            word, col = match.group(), F.col("word")
            starts_inside, ends_inside = at == 0 and match.start() == 0, at == len(found) - 1 and match.end() == len(phrase)
            if starts_inside and ends_inside:
                tests.append(self._words_like(F.contains(col, F.lit(word))))
            elif starts_inside:
                tests.append(self._words_like(F.endswith(col, F.lit(word))))
            elif ends_inside:
                tests.append(self._words_like(F.startswith(col, F.lit(word))))
            else:
                tests.append(col == word)
        postings = self.table("words")
        parts = [postings.where(test).select(F.lit(at).alias("at"), "block", _starts(at).alias("starts")) for at, test in enumerate(tests)]
        hits = reduce(DataFrame.unionByName, parts).groupBy("block", "at").agg(F.flatten(F.collect_list("starts")).alias("starts"))
        lined_up = hits.select("block", "starts").transform(_in_all, "starts", len(parts))
        slots = F.array_distinct(F.transform("starts", lambda start: F.shiftright(start, _PLACE_BITS)))
        return self._verified(self._keys(lined_up.select("block", slots.alias("slots"))), phrase)

    def rebuild(self, name: str) -> TextIndex:
        """A new index of the current texts, without old versions and their postings."""
        fresh = TextIndex(self.spark, name, self.buckets)
        fresh.add(self.current())
        return fresh

    def drop(self) -> None:
        for kind in ("texts", "blocks", "grams", "words", "vocabulary"):
            self.spark.sql(f"DROP TABLE IF EXISTS {self.name}_{kind}")
