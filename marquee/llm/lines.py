"""Line dedup by overlapping windows of three lines.

Each three consecutive lines are hashed; windows that occur more than once in the whole corpus stay where they
occur first (by doc_id, then place) and the lines that later occurrences cover are removed. Covered places are
merged, so a repeated passage of any length of three lines or more goes as one range. A removed line always
stands in an earlier place too, so no line's last copy is lost.

Only window hashes (128 bits) are shuffled for the search; a window in a third of all documents is folded per
salt before its hash is gathered, and answers go back to the salts.

Defined results: lines are what stands between line feeds; a NULL text counts as empty, one empty line; windows
of blanks alone are not compared; texts of fewer than three lines stay as they are; rows that repeat both id and
text count as one document and each get its answer; a NULL id comes first; an empty table gives an empty result;
other columns are kept by :func:`remove`, but for those that have the names of its own results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import packed, settled, whole, with_facts

WINDOW = 3


def lines_of(text: Column) -> Column:
    return F.split(whole(text), "\n", -1)


def windows(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = WINDOW) -> DataFrame:
    """doc_id, content (hash of the text), place of the window's first line, and the window's hash."""
    rows = docs.select(
        F.col(doc_id).alias("doc_id"), F.xxhash64(whole(F.col(text))).alias("content"), lines_of(F.col(text)).alias("lines")
    ).where(F.size("lines") >= width)
    shifted = [F.slice("lines", F.lit(1 + at), F.size("lines") - width + 1) for at in range(width)]
    zipped = F.arrays_zip(*(part.alias(f"line{at}") for at, part in enumerate(shifted)))
    exploded = rows.select("doc_id", "content", F.posexplode(zipped).alias("place", "window"))
    parts = [F.col("window").getField(f"line{at}") for at in range(width)]
    return exploded.where(F.trim(F.concat(*parts)) != "").select(
        "doc_id", "content", F.col("place").cast("long").alias("place"), F.xxhash64(*parts).alias("h1"), F.xxhash64(F.lit(1), *reversed(parts)).alias("h2")
    )


def covered(found: DataFrame, width: int = WINDOW) -> DataFrame:
    """doc_id, content and removed: the sorted places of lines that later occurrences cover."""
    where = F.struct("doc_id", "place", "content")
    marked = with_facts(found.distinct(), ["h1", "h2"], ["doc_id", "content", "place"], first=("min", where), count=("sum", F.lit(1)))
    later = marked.where((F.col("count") > 1) & ~where.eqNullSafe(F.col("first")))
    places = later.select("doc_id", "content", F.explode(F.sequence("place", F.col("place") + width - 1)).alias("line"))
    return places.groupBy("doc_id", "content").agg(F.array_sort(F.collect_set("line")).alias("removed"))


def ranges(places: Column) -> Column:
    """Sorted places as ranges ``first-last``, comma-joined."""
    starts = F.filter(places, lambda place: ~F.array_contains(places, place - 1))
    ends = F.filter(places, lambda place: ~F.array_contains(places, place + 1))
    return F.array_join(F.zip_with(starts, ends, lambda a, b: F.concat_ws("-", a.cast("string"), b.cast("string"))), ",")


def remove(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = WINDOW) -> DataFrame:
    """``docs`` with the text that stays, and n_lines, n_removed and removed (the places)."""
    gone = settled(covered(settled(windows(docs, doc_id, text, width)), width)).select(
        F.col("doc_id").alias("of"), F.col("content").alias("hash"), "removed"
    )
    rows = packed(docs, id=F.col(doc_id), text=whole(F.col(text)))
    lines = lines_of(F.col("text"))
    removed = F.coalesce("removed", F.array().cast("array<long>"))
    stays = F.filter(lines, lambda line, place: ~F.array_contains(F.col("removed"), place.cast("long")))
    cleaned = F.when(F.col("removed").isNull(), F.col("text")).otherwise(F.array_join(stays, "\n"))
    taken = {text, "n_lines", "n_removed", "removed"}
    return rows.join(gone, F.col("id").eqNullSafe(F.col("of")) & (F.xxhash64("text") == F.col("hash")), "left").select(
        *(F.col(f"row.`{name}`") for name in docs.columns if name not in taken),
        cleaned.alias(text),
        F.size(lines).cast("long").alias("n_lines"),
        F.size(removed).cast("long").alias("n_removed"),
        removed.alias("removed"),
    )


def digests(cleaned: DataFrame) -> DataFrame:
    return cleaned.select("doc_id", "n_lines", "n_removed", ranges(F.col("removed")).alias("removed"), "text")
