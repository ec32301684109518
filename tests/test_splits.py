"""Files read in many splits against the readers that take each file whole."""

from __future__ import annotations

import json
import random

import pytest
from pyspark.sql import types as T

from marquee.sources import readers, splits, writers

def struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


TEXT, LONG = T.StringType(), T.LongType()
SCHEMA = struct(id=LONG, text=TEXT, inner=struct(a=TEXT, more=T.ArrayType(struct(b=TEXT))))
SIGNS = ['"', "\\", "}", "{", "\n", ",", "]", "[", "é", "\t", "a", "b c", "}}", '\\"', "\U0001f600"]


def made(seed: int, count: int = 400) -> list[dict]:
    choice = random.Random(seed)
    text = lambda most: "".join(choice.choices(SIGNS, k=choice.randrange(most)))
    rows = []
    for number in range(count):
        inner = {"a": text(8), "more": [{"b": text(6)} for _ in range(choice.randrange(3))]} if choice.random() < 0.6 else None
        # Some records are longer than several splits.
        rows.append({"id": number, "text": text(3000 if number % 97 == 0 else 25), "inner": inner})
    return rows


@pytest.fixture(params=[67, 500, 1 << 20])
def small_splits(spark, request):
    """Splits of a few bytes, so that strings, escapes and records are cut at many places."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {name: spark.conf.get(name) for name in names}
    for name in names:
        spark.conf.set(name, str(request.param))
    yield request.param
    for name, value in before.items():
        spark.conf.set(name, value)


def in_order(df):
    return sorted(df.collect(), key=lambda row: (row[0], row[1] or ""))


@pytest.mark.parametrize("indent", [None, 2])
def test_json_arrays(spark, tmp_path, small_splits, indent):
    count = 400 if small_splits > 67 else 60
    for part in range(2):
        (tmp_path / f"{part}.json").write_text(json.dumps(made(part, count), indent=indent, ensure_ascii=part == 0))
    found = splits.read_json_arrays(spark, str(tmp_path), SCHEMA)
    assert in_order(found) == in_order(spark.read.schema(SCHEMA).json(str(tmp_path), multiLine=True))
    if small_splits <= 500:
        assert splits._pieces(spark, str(tmp_path), "}").rdd.getNumPartitions() > 20


def test_tables_with_line_breaks(spark, tmp_path, small_splits):
    schema = struct(id=LONG, text=TEXT, more=TEXT)
    rows = [(row["id"], row["text"], row["inner"] and row["inner"]["a"]) for row in made(5, 400 if small_splits > 67 else 60)]
    path = str(tmp_path / "out")
    writers.write_tsv(spark.createDataFrame(rows, schema).coalesce(2), path)
    whole = spark.read.schema(schema).csv(path, **readers.TSV)
    assert in_order(splits.read_tables_of_values(spark, path, schema, **readers.TSV)) == in_order(whole)


def test_more_splits_than_are_broadcast(spark, tmp_path, small_splits, monkeypatch):
    monkeypatch.setattr(splits, "FEW_SPLITS", 0)
    (tmp_path / "one.json").write_text(json.dumps(made(9, 60)))
    found = splits.read_json_arrays(spark, str(tmp_path), SCHEMA)
    assert in_order(found) == in_order(spark.read.schema(SCHEMA).json(str(tmp_path), multiLine=True))


def test_texts_are_not_shuffled(spark, tmp_path):
    (tmp_path / "one.json").write_text(json.dumps(made(1)))
    plan = splits.json_texts(spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    # The only exchanges are above the pieces of records that cross an edge.
    assert "SortMergeJoin" not in plan and plan.count("Exchange hashpartitioning") <= 2


def test_edges(spark, tmp_path):
    for name, text in {"empty": "", "none": "[]\n", "spaces": " [ ] ", "lines": '{"id": 1}\n{"id": 2}', "one": '[{"id": 3, "inner": {"a": "}"}}]'}.items():
        (tmp_path / f"{name}.json").write_text(text)
    assert [row["id"] for row in in_order(splits.read_json_arrays(spark, str(tmp_path), SCHEMA))] == [1, 2, 3]
    values = tmp_path / "values"
    values.mkdir()
    (values / "a.tsv").write_bytes(b'id\ttext\r\n1\t"x\ny"\r\n\r\n2\tz')
    (values / "b.tsv").write_bytes(b"id\ttext\n")
    (values / "c.tsv").write_bytes(b"")
    found = splits.read_tables_of_values(spark, str(values), struct(id=LONG, text=TEXT), **readers.TSV)
    assert in_order(found) == [(1, "x\ny"), (2, "z")]


def test_written_arrays(spark, tmp_path):
    path = tmp_path / "arrays"
    writers.write_json_arrays(spark.range(3000).repartition(3), str(path))
    read = [row["id"] for file in path.glob("part-*") for row in json.loads(file.read_text())]
    assert sorted(read) == list(range(3000))
    writers.write_json_arrays(spark.range(0), str(path))
    assert splits.read_json_arrays(spark, str(path), struct(id=LONG)).count() == 0
