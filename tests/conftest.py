from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from marquee.session import session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    spark = session(
        "tests", "local[8]", spark__sql__shuffle__partitions="4", spark__ui__enabled="false", spark__driver__memory="6g"
    )
    spark.sparkContext.setLogLevel("ERROR")
    yield spark
    spark.stop()


@pytest.fixture(scope="session")
def value(spark):
    """Evaluate one expression over one text value."""
    from pyspark.sql import functions as F

    def evaluate(text, build):
        return spark.createDataFrame([(text,)], "x string").select(build(F.col("x")).alias("y")).first()["y"]

    return evaluate
