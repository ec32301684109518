"""Name lists per item, paged so that no group outgrows one row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.values import MISSING
from .skew import hot_counts, skew_join

PAGE = 1000
BUCKETS = 65_536
LARGE = 100_000  # entries that one task may rank and one array may hold


def _sign(value: Column, kind: str) -> Column:
    """A number that rises with the value: a number itself, or a text's first seven bytes."""
    if kind != "string":
        return F.coalesce(value.cast("long"), F.lit(0).cast("long"))
    bytes_ = F.substring(F.encode(F.coalesce(value, F.lit("")), "UTF-8"), 1, 7)
    return F.conv(F.rpad(F.hex(bytes_), 14, "0"), 16, 10).cast("long")


def _bucket(spread: list[str]) -> Column:
    return F.pmod(F.xxhash64(*spread), F.lit(BUCKETS)).cast("int")


def _split(
    entries: DataFrame, group: list[str], spread: list[str], counted: DataFrame | None = None
) -> tuple[DataFrame, DataFrame | None]:
    """The rows of ``entries`` in groups of at most :data:`LARGE` rows, and the other rows, if there are any.

    Values of ``spread``, a part of ``group``, are dealt to buckets by their hash, and each bucket's rows are counted
    in a job of its own; all rows of a bucket with more than ``LARGE`` go the second way. The broadcast is those buckets' numbers,
    65,536 at most. ``counted`` may stand for ``entries`` in the count: a cheaper frame with no fewer rows of any
    group. Rows with a NULL in ``group`` are in no group.
    """
    counts = (entries if counted is None else counted).dropna(subset=spread).groupBy(_bucket(spread).alias("_bucket")).count()
    large = [(row["_bucket"],) for row in counts.where(F.col("count") > LARGE).collect()]
    known = entries.dropna(subset=group)
    if not large:
        return known, None
    buckets = F.broadcast(entries.sparkSession.createDataFrame(large, "_bucket int"))
    keyed = known.withColumn("_bucket", _bucket(spread))
    return (
        keyed.join(buckets, "_bucket", "left_anti").select(*entries.columns),
        keyed.join(buckets, "_bucket", "left_semi").select(*entries.columns),
    )


def _placed_whole(entries: DataFrame, group: list[str], order: list[str]) -> DataFrame:
    """Add ``_place``, the rank from 0 within the group, ranking each group in one task."""
    return entries.withColumn("_place", F.row_number().over(Window.partitionBy(*group).orderBy(*order)) - 1)


def _placed_in_parts(entries: DataFrame, group: list[str], order: list[str], limit: int) -> DataFrame:
    """Add ``_place`` as well, for groups of any size.

    Every group's size is joined back. A group within the limit is one part; a larger one is cut by
    the first order column into as many parts of equal width as it has pages, rows are ranked within their part,
    and the sizes of the earlier parts are added. No task ranks a whole wide group unless its first order
    values are all alike.
    """
    numbered = entries.withColumn("_sign", _sign(F.col(order[0]), dict(entries.dtypes)[order[0]]))
    sizes = numbered.groupBy(*group).agg(F.count("*").alias("_n"), F.min("_sign").alias("_least"), F.max("_sign").alias("_most"))
    sized = skew_join(numbered, sizes, group, spread=order, hot=hot_counts(sizes, group, "_n"))
    width = (F.col("_most") - F.col("_least") + 1).cast("double")
    part = F.floor((F.col("_sign") - F.col("_least")) / width * F.ceil(F.col("_n") / limit))
    parted = sized.withColumn("_part", F.when(F.col("_n") <= limit, F.lit(0)).otherwise(part).cast("long"))
    counts = parted.where(F.col("_n") > limit).groupBy(*group, "_part").agg(F.count("*").alias("_size"))
    earlier = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select(*group, "_part", F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_before"))
    rank = F.row_number().over(Window.partitionBy(*group, "_part").orderBy(*order)) - 1
    placed = parted.withColumn("_rank", rank).join(before, [*group, "_part"], "left")
    return placed.select(*entries.columns, (F.coalesce("_before", F.lit(0)) + F.col("_rank")).alias("_place"))


def _page(limit: int) -> Column:
    return F.floor(F.col("_place") / limit).alias("page")


def paged(entries: DataFrame, group: list[str], order: list[str], limit: int = PAGE, ahead: bool = False) -> DataFrame:
    """Add ``page`` so that a (group, page) pair holds at most ``limit`` entries, in ``order``.

    Every group's size is joined back, lazily, and large groups are cut in parts. With ``ahead`` a job counts the rows
    first, and only groups it finds large (:func:`_split`) go that way; the others are ranked whole, each in one task.
    ``order`` must be total within a group.
    """
    few, many = _split(entries, group, group) if ahead else (None, entries)
    placed = None if many is None else _placed_in_parts(many, group, order, limit)
    if few is not None:
        whole = _placed_whole(few, group, order)
        placed = whole if placed is None else whole.unionByName(placed)
    return placed.select(*entries.columns, _page(limit))


def paged_lists(
    entries: DataFrame,
    item: str,
    order: list[str],
    lists: dict[str, tuple[Column, Column]],
    by: list[str] | None = None,
    limit: int = PAGE,
    counted: DataFrame | None = None,
) -> DataFrame:
    """(item, page, ...): each of ``lists``, a (condition, value), as an array in ``order``, NULLs left out.

    A page holds at most ``limit`` entries of each list; the conditions say which values of ``by`` a list is for. The
    rows are shuffled once, by the item, and a list is sorted as an array before it is cut into pages. Large items
    are paged first (see :func:`_split`, also on ``counted``), so no array holds more than :data:`LARGE` entries.
    """
    few, many = _split(entries, [item, *(by or [])], [item], counted)

    def values(pairs: Column) -> Column:
        return F.transform(F.filter(pairs, lambda pair: pair["_value"].isNotNull()), lambda pair: pair["_value"])

    def collected(keys: list[str]) -> list[Column]:
        return [
            F.sort_array(F.collect_list(F.when(where, F.struct(*keys, value.alias("_value"))))).alias(name)
            for name, (where, value) in lists.items()
        ]

    whole = few.repartition(item).groupBy(item).agg(*collected(order))
    last = F.floor((F.greatest(F.lit(1), *(F.size(name) for name in lists)) - 1) / limit)
    whole = whole.withColumn("page", F.explode(F.sequence(F.lit(0).cast("long"), last)))
    start = (F.col("page") * limit + 1).cast("int")
    whole = whole.select(item, "page", *(values(F.slice(name, start, limit)).alias(name) for name in lists))
    if many is None:
        return whole
    placed = _placed_in_parts(many, [item, *(by or [])], order, limit)
    cut = placed.withColumn("page", _page(limit)).groupBy(item, "page").agg(*collected(["_place"]))
    return whole.unionByName(cut.select(item, "page", *(values(F.col(name)).alias(name) for name in lists)))


def sorted_list(order: list[str], value: Column) -> Column:
    """The values of a group as an array in ``order``; only for groups made by :func:`paged`."""
    pairs = F.collect_list(F.when(value.isNotNull(), F.struct(*order, value.alias("_value"))))
    return F.transform(F.sort_array(pairs), lambda pair: pair["_value"])


def joined_names(names: Column) -> Column:
    """Names separated by commas, or the missing label when there is none."""
    return F.when(F.size(names) > 0, F.array_join(names, ",")).otherwise(F.lit(MISSING))


def names_per_item(
    items: DataFrame, bridge: DataFrame, dim: DataFrame, item: str, key: str, name: str, limit: int = PAGE
) -> DataFrame:
    """(item, page, names): each item's names ascending and comma-separated, ``N/A`` when it has none.

    An item with more than ``limit`` names goes on over further pages. The names are broadcast when they
    measure small; otherwise a name of very many items is split as a skewed partition.
    """
    order = ["_low", name, key]
    named = bridge.select(item, key).join(dim.select(key, name), key).withColumn("_low", F.lower(name))
    lists = paged(named, [item], order, limit).groupBy(item, "page").agg(sorted_list(order, F.col(name)).alias("_names"))
    return (
        items.select(item)
        .join(lists, item, "left")
        .select(
            item,
            F.coalesce("page", F.lit(0)).alias("page"),
            joined_names(F.coalesce("_names", F.array().cast("array<string>"))).alias("names"),
        )
    )
