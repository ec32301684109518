"""Queries against their SQL."""

from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2] / "scripts"))

import parity  # noqa: E402

from marquee.llm.sql import SQL  # noqa: E402

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", SQL)
def test_same_as_sql(spark, name):
    assert parity.difference(spark, parity.connect(FOLDER), FOLDER, name) is None
