"""Joins that stay balanced when a few keys hold much of the data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MOST = 256  # hot keys looked for; any other key holds less than 1/256 of the rows
FLOOR = 10_000  # a key with no more rows than this is no burden for one task
SALTS = 64


def hot_counts(counts: DataFrame, on: list[str], n: str, most: int = MOST, floor: int = FLOOR) -> DataFrame:
    """The ``most`` keys with the highest count ``n`` above ``floor``, so never more than ``most`` rows.

    Every key with more than ``1/most`` of the rows is among them, since fewer than ``most`` keys can be.
    The order is total, so both sides of a join get the same keys even when this is worked out twice.
    """
    return counts.where(F.col(n) > floor).orderBy(F.desc(n), *on).limit(most).select(*on)


def hot_keys(df: DataFrame, on: list[str], most: int = MOST, floor: int = FLOOR) -> DataFrame:
    """Keys that hold much of ``df``; the counts are combined before the shuffle, one partial row per task and key."""
    counts = df.select(*on).dropna().groupBy(*on).agg(F.count("*").alias("_n"))
    return hot_counts(counts, on, "_n", most, floor)


def skew_join(
    big: DataFrame,
    small: DataFrame,
    on: list[str],
    spread: list[str | Column],
    how: str = "inner",
    hot: DataFrame | None = None,
    floor: int = FLOOR,
    salts: int = SALTS,
) -> DataFrame:
    """Equi-join that spreads the rows of each hot key of ``big`` over ``salts`` partitions.

    ``spread`` names columns of ``big`` that differ between rows of one key; their hash picks the salt,
    so a retried task sends each row to the same place. Only the rows of ``small`` under a hot key are
    repeated. Rows with a NULL key match nothing and are spread as well. The broadcast holds the hot keys
    alone, at most 256 rows whatever the data. ``how`` may be inner, left, left_semi or left_anti. ``hot``
    saves the counting pass when the hot keys are known; it must come from :func:`hot_counts`.
    """
    hot = F.broadcast((hot_keys(big, on, floor=floor) if hot is None else hot).withColumn("_hot", F.lit(True)))
    unmatched = F.lit(False)
    for key in on:
        unmatched = unmatched | F.col(key).isNull()
    scatter = F.pmod(F.xxhash64(*spread), F.lit(salts))
    salt = F.when(F.col("_hot") | unmatched, scatter).otherwise(F.lit(0)).cast("int")
    every_salt = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    left = big.join(hot, on, "left").withColumn("_salt", salt).drop("_hot")
    right = small.join(hot, on, "left").withColumn("_salt", F.explode(every_salt)).drop("_hot")
    return left.join(right, [*on, "_salt"], how).drop("_salt")
