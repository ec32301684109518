"""Every named query against its SQL on the smallest folder."""

from __future__ import annotations

import os

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from marquee.workload.oracle import ORACLE
from marquee.workload.queries import QUERIES
from scripts.parity import connect, difference

FOLDER = os.environ.get("PARITY_DIR", "/root/testdata/sf0.001")
needs_data = pytest.mark.skipif(not os.path.isdir(FOLDER), reason=f"{FOLDER} is not there")


@pytest.fixture(scope="module")
def base():
    return connect(FOLDER)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE) and QUERIES.keys() <= queries().keys() and ORACLE.keys() <= oracle_sql().keys()


@needs_data
def test_entry_runs(spark):
    assert entry(spark).columns == ["doc_id", "review_clean"]


@needs_data
@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_its_sql(spark, base, name):
    assert difference(spark, base, FOLDER, name) is None
