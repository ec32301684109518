"""JSON arrays and tables with line breaks in quoted values, read in many splits of each file.

A file is read as text pieces that end at a sign no record can end without: ``}`` for JSON objects, the line end for
separated values. Where a record ends depends on what stands before (a piece may begin in a string, an object may
hold objects), so two passes are made. The first folds each split into what it does to a reader that comes to it
outside or inside of a quoted value; the few numbers of all splits are added up in file order. The second pass then
knows how each split begins, puts its pieces together to records, and only the pieces of records that cross a
split's edge, at most two a split, meet those of other splits. Texts are not shuffled otherwise, and the reader is
Spark's own, so any file system and compression will do (a compressed file stays one split).

Defined results: the objects of one or more top-level arrays, or of JSON Lines; elements that are no objects must
not occur. In separated values a quote inside a quoted value is doubled and unquoted values hold no quote, as the
writers of this package have it; empty lines are skipped; a carriage return before a record's end is not part of
it. An empty file or array has no rows. A record that its file does not finish is parsed as far as it goes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialise

SPLIT = ["file", "block"]
FOLD = "file string, block long, flips int, net_out long, net_in long"
PARTS = "file string, block long, kind int, text string"
WHOLE, HEAD, TAIL = 0, 1, 2
FEW_SPLITS = 80_000


def _count(text: Column, sign: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(sign), F.lit("")))


def _pieces(spark: SparkSession, path: str | list[str], end: str) -> DataFrame:
    """file, block, place and value of every piece, without its end sign."""
    metadata = (F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))
    return spark.read.text(path, lineSep=end).select(*metadata, "value").withColumn("place", F.monotonically_increasing_id())


def _json_marks(pieces: DataFrame) -> DataFrame:
    """flips (quotes), and the braces opened by a piece that begins outside and by one that begins inside a string.

    A backslash never stands right before a piece's end: its partner would be the brace, which no escape has.
    """
    bare = pieces.withColumn("_bare", F.regexp_replace("value", r"(?s)\\.", ""))

    def opened(text: Column) -> Column:
        return _count(F.regexp_replace(text, r'"[^"]*+"?+', ""), "{")

    marks = {"flips": _count(F.col("_bare"), '"'), "open_out": opened(F.col("_bare")), "open_in": opened(F.concat(F.lit('"'), "_bare"))}
    return bare.withColumns(marks).drop("_bare")


def _table_marks(pieces: DataFrame) -> DataFrame:
    return pieces.withColumns({"flips": _count(F.col("value"), '"'), "open_out": F.lit(0), "open_in": F.lit(0)})


def _walk(flips: np.ndarray, opens: tuple[np.ndarray, np.ndarray], inside: int, depth: int, close: int) -> tuple[np.ndarray, np.ndarray]:
    """After each piece: whether it is inside a quoted value, and how many objects are open."""
    after = (inside + np.cumsum(flips)) % 2
    before = np.concatenate([[inside], after[:-1]])
    return after, depth + np.cumsum(np.where(before == 1, opens[1], opens[0]) - close * (after == 0))


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[tuple[str, int], pa.RecordBatch]]:
    """Slices of the batch, each of one split."""
    codes = batch.column("file").dictionary_encode()
    files, blocks = codes.indices.to_numpy(), batch.column("block").to_numpy()
    edges = np.flatnonzero((files[1:] != files[:-1]) | (blocks[1:] != blocks[:-1])) + 1
    for start, stop in zip([0, *edges], [*edges, len(blocks)]):
        if stop > start:
            yield (codes.dictionary[files[start]].as_py(), int(blocks[start])), batch.slice(start, stop - start)


def _numbers(batch: pa.RecordBatch) -> tuple[np.ndarray, tuple[np.ndarray, np.ndarray]]:
    flips, out, within = (batch.column(name).to_numpy().astype(np.int64) for name in ("flips", "open_out", "open_in"))
    return flips, (out, within)


def _folded(marked: DataFrame, close: int) -> DataFrame:
    """One row per split: how it changes a reader's state."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, states = None, {}

        def row() -> pa.RecordBatch:
            (_, out), (odd, within) = states[0], states[1]
            values = [split[0]], [split[1]], [1 - odd], [out], [within]
            types = pa.string(), pa.int64(), pa.int32(), pa.int64(), pa.int64()
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(values, types)], names=["file", "block", "flips", "net_out", "net_in"])

        for batch in batches:
            for found, rows in _runs(batch):
                if found != split:
                    if split is not None:
                        yield row()
                    split, states = found, {0: (0, 0), 1: (1, 0)}
                for start, (inside, depth) in states.items():
                    after, depths = _walk(*_numbers(rows), inside, depth, close)
                    states[start] = int(after[-1]), int(depths[-1])
        if split is not None:
            yield row()

    return marked.select(*SPLIT, "flips", "open_out", "open_in").mapInArrow(run, FOLD)


def _begun(folds: DataFrame) -> DataFrame:
    """inside and depth of a reader that comes to each split."""
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    inside = folds.withColumn("inside", F.coalesce(F.sum("flips").over(earlier), F.lit(0)) % 2)
    net = inside.withColumn("net", F.when(F.col("inside") == 1, F.col("net_in")).otherwise(F.col("net_out")))
    return net.select(*SPLIT, "inside", F.coalesce(F.sum("net").over(earlier), F.lit(0)).alias("depth"))


def _cut(begun: DataFrame, close: int, end: str, header: bool) -> DataFrame:
    """Whole records, and the first and last pieces of splits that begin or end within one; no ``header``, which is
    the first record of a file and has no line break."""
    last = "}" if close else ""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, inside, depth, head, held, skip = None, 0, 0, False, [], False

        def rows(kinds: list[int], texts: list[str]) -> pa.RecordBatch:
            columns = [pa.array([split[0]] * len(kinds), pa.string()), pa.array([split[1]] * len(kinds), pa.int64())]
            return pa.RecordBatch.from_arrays([*columns, pa.array(kinds, pa.int32()), pa.array(texts, pa.string())], names=["file", "block", "kind", "text"])

        def rest() -> Iterator[pa.RecordBatch]:
            if split is not None and (inside or depth > 0):
                # A split without an end is a head that the next split's head follows.
                yield rows([HEAD if head else TAIL], [end.join([*held, ""])])

        for batch in batches:
            for found, part in _runs(batch):
                if found != split:
                    yield from rest()
                    split, inside, depth = found, part.column("inside")[0].as_py(), part.column("depth")[0].as_py()
                    head, held, skip = bool(inside or depth > 0), [], header and found[1] == 0
                after, depths = _walk(*_numbers(part), inside, depth, close)
                values, start = part.column("value").to_pylist(), 0
                kinds, texts = [], []
                for stop in np.flatnonzero((after == 0) & (depths == 0)) + 1:
                    if not skip:
                        kinds.append(HEAD if head else WHOLE)
                        texts.append(end.join([*held, *values[start:stop]]) + last)
                    head, held, start, skip = False, [], stop, False
                if kinds:
                    yield rows(kinds, texts)
                held.extend(values[start:])
                inside, depth = int(after[-1]), int(depths[-1])
        yield from rest()

    return begun.mapInArrow(run, PARTS)


def _joined(parts: DataFrame) -> DataFrame:
    """``text`` of every record, the crossing ones put together."""
    crossing = parts.where(F.col("kind") != WHOLE)
    order = Window.partitionBy("file").orderBy("block", "kind")
    # A split's head belongs to the record that the last tail before it began.
    numbered = crossing.select(*SPLIT, "kind", "text", F.sum((F.col("kind") == TAIL).cast("int")).over(order).alias("record"))
    pieces = F.array_sort(F.collect_list(F.struct("block", "kind", "text")))
    whole = numbered.groupBy("file", "record").agg(F.array_join(F.transform(pieces, lambda piece: piece["text"]), "").alias("text"))
    return parts.where(F.col("kind") == WHOLE).select("text").unionByName(whole.select("text"))


def _records(pieces: DataFrame, close: int, end: str, header: bool = False) -> DataFrame:
    """``text`` of every record; ``close`` says how many objects a piece's end closes."""
    starts = materialise(_begun(_folded(pieces, close)).withColumnsRenamed({"file": "_file", "block": "_block"}))
    few = starts.count() <= FEW_SPLITS
    known = pieces.join(F.broadcast(starts) if few else starts, (F.col("file") == F.col("_file")) & (F.col("block") == F.col("_block")), "left")
    # Should the splits be planned otherwise the second time, nothing is guessed.
    sure = F.when(F.col("inside").isNotNull(), F.col("inside")).otherwise(F.raise_error(F.lit("a file's splits changed while it was read")))
    chosen = known.select(*SPLIT, "place", "value", "flips", "open_out", "open_in", sure.cast("int").alias("inside"), "depth")
    # A join with what is broadcast leaves the pieces as they were read; any other needs their order again.
    return _joined(_cut(chosen if few else chosen.sortWithinPartitions(*SPLIT, "place"), close, end, header))


def json_texts(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``text``: every object of the arrays at ``path`` as JSON text."""
    records = _records(_json_marks(_pieces(spark, path, "}")), 1, "}")
    return records.select(F.expr("substring(text, instr(text, '{'))").alias("text"))


def read_json_arrays(spark: SparkSession, path: str | list[str], schema: T.StructType) -> DataFrame:
    return json_texts(spark, path).select(F.from_json("text", schema).alias("record")).select("record.*")


def table_texts(spark: SparkSession, path: str | list[str], header: bool = True) -> DataFrame:
    """``text``: every record of the separated values at ``path``, the header of each file left out."""
    records = _records(_table_marks(_pieces(spark, path, "\n")), 0, "\n", header)
    return records.select(F.regexp_replace("text", r"\r\z", "").alias("text")).where("text <> ''")


def read_tables_of_values(spark: SparkSession, path: str | list[str], schema: T.StructType, **options) -> DataFrame:
    """Separated values with line breaks in quoted values, by ``options`` of the CSV reader."""
    chosen = {name: str(value).lower() if isinstance(value, bool) else str(value) for name, value in options.items() if name not in ("multiLine", "header")}
    records = table_texts(spark, path, str(options.get("header", True)).lower() == "true")
    return records.select(F.from_csv("text", schema.simpleString(), chosen).alias("record")).select("record.*")
