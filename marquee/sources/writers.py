"""Writers; each replaces what is at its path."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import PRIMARY_KEYS, TABLES


def write_tsv(df: DataFrame, path: str) -> None:
    """Tab-separated with a header, every value quoted, quotes doubled, blanks at its ends kept."""
    df.write.mode("overwrite").csv(
        path,
        sep="\t",
        header=True,
        quote='"',
        escape='"',
        quoteAll=True,
        ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
    )


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def write_json_arrays(df: DataFrame, path: str) -> None:
    """Files that are a single JSON array each, one object a line."""

    def bracketed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = "["
        for batch in batches:
            for start in range(0, batch.num_rows, 1000):
                lines = []
                for text in batch.column("value").slice(start, 1000).to_pylist():
                    lines.append(before)
                    before = text + ","
                yield pa.RecordBatch.from_arrays([pa.array(lines, pa.string())], names=["value"])
        yield pa.RecordBatch.from_arrays([pa.array([before.removesuffix(","), "]"], pa.string())], names=["value"])

    texts = df.select(F.to_json(F.struct(*df.columns)).alias("value"))
    texts.mapInArrow(bracketed, "value string").write.mode("overwrite").text(path)


def write_dimensions(dimensions: dict[str, DataFrame], folder: str) -> None:
    """One TSV folder per dimension, named ``<dimension>_tsv``."""
    for name, values in dimensions.items():
        write_tsv(values, f"{folder}/{name}_tsv")


def arranged(name: str, table: DataFrame) -> DataFrame:
    """Movies and bridges range-partitioned and sorted by their whole key, so a lookup by movie skips most row
    groups and a movie with very many rows still lies in many files. Reviews are in key order already."""
    if "movie_id" not in PRIMARY_KEYS.get(name, ()):
        return table
    return table.repartitionByRange(*PRIMARY_KEYS[name]).sortWithinPartitions(*PRIMARY_KEYS[name])


def write_tables(model: dict[str, DataFrame], folder: str) -> None:
    """The relational model as one Parquet folder per table, each arranged by its key.

    Tables are replaced one by one, so a model must not be written over the folder it is read from: for that, and
    for writes that appear as a whole, see :class:`marquee.sources.snapshots.Snapshots`.
    """
    for name in TABLES:
        arranged(name, model[name]).write.mode("overwrite").parquet(f"{folder}/{name}")
