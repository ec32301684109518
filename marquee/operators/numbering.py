"""Dense numbers without a single-partition window."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialise

_ROW_BITS = 33  # monotonically_increasing_id keeps the row's place in its partition in the low 33 bits


def number_in_order(df: DataFrame, name: str, start: int = 1) -> DataFrame:
    """Number the rows densely in file order: files by path, rows by their place in the file.

    ``df`` comes straight from files, through filters and projections only. The row counts of the splits are
    added up in the order of their place; nothing else is sorted, shuffled or written, and other splits of the same
    files give the same numbers. The join has one row per split and is left to the optimiser. Rows that
    come from no file are settled and numbered in their present order.
    """
    try:
        located = df.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"))
        placed = located.withColumn("_place", F.monotonically_increasing_id())
    except AnalysisException:
        placed = _settled(df)
    return _numbered(placed, name, start)


def _numbered(placed: DataFrame, name: str, start: int) -> DataFrame:
    split = ["_file", "_block"]
    sizes = placed.groupBy(*split).agg(F.min("_place").alias("_first"), F.count("*").alias("_size"))
    earlier = Window.orderBy(*split).rowsBetween(Window.unboundedPreceding, -1)
    offset = F.coalesce(F.sum("_size").over(earlier), F.lit(0)) - F.col("_first") + F.lit(start)
    offsets = sizes.select(*split, offset.alias("_offset"))
    return placed.join(offsets, split).withColumn(name, F.col("_offset") + F.col("_place")).drop(*split, "_place", "_offset")


def _settled(df: DataFrame) -> DataFrame:
    """``df`` with its partitions and row order fixed; a partition stands for a split."""
    placed = materialise(df.withColumn("_place", F.monotonically_increasing_id()))
    return placed.withColumns({"_file": F.lit(""), "_block": F.shiftright("_place", _ROW_BITS)})


def number_rows(df: DataFrame, name: str, order: list[Column | str], start: int = 1) -> DataFrame:
    """Number the rows densely in ``order``, which should be total.

    A range exchange and a sort inside each partition stand in for one global sort task. Since the order
    is total, rows that agree on its first columns can still be split over many partitions.
    """
    keys = [F.col(key) if isinstance(key, str) else key for key in order]
    ranged = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    return _numbered(_settled(ranged), name, start)


def keys_by_name(names: DataFrame, key: str, name: str) -> DataFrame:
    """Distinct non-NULL values of ``name`` with a key dense from 1 in name order, case ignored first."""
    distinct = names.select(name).where(F.col(name).isNotNull()).distinct()
    return number_rows(distinct, key, [F.lower(name), name]).select(key, name)


def first_rows(df: DataFrame, count: int, order: list[Column | str], name: str | None = None) -> DataFrame:
    """The first ``count`` rows in ``order``, numbered from 1 when ``name`` is given.

    The limit comes before the number, so the window only sees ``count`` rows.
    """
    top = df.orderBy(*order).limit(max(count, 0))
    if name is None:
        return top
    return top.withColumn(name, F.row_number().over(Window.orderBy(*order)).cast("long"))
