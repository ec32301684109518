"""Integrity checks: each returns the violations, so an empty result is a pass."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..schemas import FOREIGN_KEYS, MAX_LENGTHS, PRIMARY_KEYS


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Key values that occur more than once, with the number of rows."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where(F.col("n") > 1)


def orphans(child: DataFrame, parent: DataFrame, key: str, parent_key: str | None = None) -> DataFrame:
    """Child key values with no parent, with the number of child rows.

    The child is reduced to its distinct keys first, so a key held by a third of the rows joins once.
    """
    counted = child.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n"))
    return counted.join(parent.select(F.col(parent_key or key).alias(key)), key, "left_anti")


def too_long(df: DataFrame, column: str, limit: int) -> DataFrame:
    """Rows whose text is longer than the limit, with its length."""
    return df.withColumn("n", F.length(column)).where(F.col("n") > limit)


def out_of_range(df: DataFrame, column: str, kind: str) -> DataFrame:
    """Rows whose value does not fit the decimal type."""
    return df.where(F.col(column).isNotNull() & F.col(column).try_cast(kind).isNull())


def table_violations(df: DataFrame, keys: list[str], limits: dict[str, int]) -> DataFrame:
    """(check, columns, violations) of the primary key and the lengths of one table, in one pass.

    Rows are combined per key, which counts repeated keys and adds up the long texts, then to one row. Without texts
    to look at, as in the long bridges, a repeated key is one second row: rows are sorted, which holds less than
    a hash table of all keys and may spill, and no more than two rows of a key are moved.
    """
    if limits:
        long = [F.coalesce(F.count_if(F.length(column) > limit), F.lit(0)).alias(f"_long{at}") for at, (column, limit) in enumerate(limits.items())]
        per_key = df.groupBy(*keys).agg(F.count("*").alias("_n"), *long)
        sums = [F.coalesce(F.sum(f"_long{at}"), F.lit(0)).alias(f"_long{at}") for at in range(len(limits))]
        totals = per_key.agg(F.count_if(F.col("_n") > 1).alias("_repeated"), *sums)
    else:
        place = F.row_number().over(Window.partitionBy(*keys).orderBy(*keys))
        seconds = df.select(*keys).withColumn("_place", place).where(F.col("_place") == 2)
        totals = seconds.agg(F.count("*").alias("_repeated"))
    rows = [F.struct(F.lit("primary key").alias("check"), F.lit(",".join(keys)).alias("columns"), F.col("_repeated").alias("violations"))]
    rows += [F.struct(F.lit("length").alias("check"), F.lit(column).alias("columns"), F.col(f"_long{at}").alias("violations")) for at, column in enumerate(limits)]
    return totals.select(F.inline(F.array(*rows)))


def check_model(model: dict[str, DataFrame]) -> DataFrame:
    """(check, table, columns, violations) over every key, reference and length of the model."""
    columns = ["check", "table", "columns", "violations"]
    found = [
        table_violations(model[table], keys, MAX_LENGTHS.get(table, {})).withColumn("table", F.lit(table)).select(*columns)
        for table, keys in PRIMARY_KEYS.items()
    ]
    for child, key, parent in FOREIGN_KEYS:
        counted = orphans(model[child], model[parent], key).agg(F.count("*").alias("violations"))
        found.append(counted.select(F.lit("foreign key").alias("check"), F.lit(child).alias("table"), F.lit(key).alias("columns"), "violations"))
    result = found[0]
    for part in found[1:]:
        result = result.unionByName(part)
    return result
