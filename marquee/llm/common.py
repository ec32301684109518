"""What several operators of this folder share: settled steps, whole tables, facts of groups, spans in texts."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SALTS = 64
LOCAL_FOLDER = "file:///tmp/checkpoints"


def settled(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder of ``spark.checkpoint.dir`` and read from there.

    A lost executor costs its running tasks only, and what reads the step twice computes it once. Where the
    setting is missing, a local session (tests) gets a folder of its own; a cluster gets an error.
    """
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        folder = df.sparkSession.conf.get("spark.checkpoint.dir", None)
        if folder is None:
            if not context.master.startswith("local["):
                raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
            folder = LOCAL_FOLDER
        context.setCheckpointDir(folder)
    return df.checkpoint()


@contextmanager
def small_batches(spark: SparkSession, rows: int) -> Iterator[None]:
    """Steps settled inside hand Python at most ``rows`` rows at a time: for rows with whole texts."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def whole(text: Column) -> Column:
    """The text, a missing one as an empty one."""
    return F.coalesce(text, F.lit(""))


def packed(docs: DataFrame, **more: Column) -> DataFrame:
    """``docs`` as one column ``row``, with further columns whose names then clash with none of theirs."""
    return docs.select(F.struct(*(F.col(f"`{name}`") for name in docs.columns)).alias("row"), *(column.alias(name) for name, column in more.items()))


def salt(*columns: Column | str) -> Column:
    return F.pmod(F.xxhash64(*columns), F.lit(SALTS))


def with_facts(rows: DataFrame, keys: list[str], spread: list[str], **facts: tuple[str, Column]) -> DataFrame:
    """``rows`` with facts of their group: ``name=("min" | "max" | "sum", column)``; keys are not NULL.

    A group of any size is spread over :data:`SALTS` parts by its rows' ``spread`` columns. Facts are folded
    per part, then per group, and go back to the parts that the group has: neither the fold nor the join
    sees more than one part in one place, and what goes back is at most as long as the rows.
    """
    fold = {"min": F.min, "max": F.max, "sum": F.sum}
    salted = rows.withColumn("_salt", salt(*spread))
    parts = salted.groupBy(*keys, "_salt").agg(*(fold[how](value).alias(name) for name, (how, value) in facts.items()))
    groups = parts.groupBy(*keys).agg(
        *(fold[how](name).alias(name) for name, (how, _) in facts.items()), F.collect_list("_salt").alias("_salts")
    )
    back = groups.withColumn("_salt", F.explode("_salts")).drop("_salts")
    return salted.join(back, [*keys, "_salt"]).drop("_salt")


def _places(steps: Column) -> Column:
    """(start, end) of each (gap, width), by running sums in blocks of about the root of their number.

    Appending to an array copies it, so blocks keep n hits from copying n * n / 2 spans.
    """
    width = F.ceil(F.sqrt(F.size(steps))).cast("int")
    spans = "array<struct<start:int,end:int>>"
    blocks = F.transform(F.sequence(F.lit(0), width), lambda block: F.slice(steps, block * width + 1, width))

    def inside(at: Column, block: Column) -> Column:
        def step(state, one):
            end = state["at"] + one["gap"] + one["width"]
            span = F.struct((end - one["width"]).alias("start"), end.alias("end"))
            return F.when(one.isNull(), state).otherwise(F.struct(end.alias("at"), F.concat(state["spans"], F.array(span)).alias("spans")))

        return F.aggregate(block, F.struct(at.alias("at"), F.array().cast(spans).alias("spans")), step, lambda state: state["spans"])

    def started(cut: Column) -> Column:
        sums = F.transform(cut, lambda block: F.aggregate(block, F.lit(0), lambda sum_, one: sum_ + F.coalesce(one["gap"] + one["width"], F.lit(0))))
        none = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("starts"))

        def step(state, length):
            return F.struct((state["at"] + length).alias("at"), F.concat(state["starts"], F.array(state["at"])).alias("starts"))

        return F.zip_with(F.aggregate(sums, none, step, lambda state: state["starts"]), cut, inside)

    return F.flatten(F.get(F.transform(F.array(blocks), started), F.lit(0)))


def matches(text: Column, pattern: str, group: int = 0) -> Column:
    """Leftmost non-overlapping matches: array of (start, end, value), ends exclusive, in code points.

    The pieces between the matches give the gaps, so the text is read by the JVM's regular expressions alone.
    ``value`` is the group's text.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = found if group == 0 else F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    steps = F.zip_with(
        found,
        F.split(text, pattern, -1),
        lambda hit, gap: F.when(hit.isNotNull(), F.struct(F.length(gap).alias("gap"), F.length(hit).alias("width"))),
    )
    spans = F.get(F.transform(F.array(steps), _places), F.lit(0))
    joined = F.zip_with(
        spans,
        values,
        lambda span, value: F.struct(span["start"].alias("start"), span["end"].alias("end"), value.alias("value")),
    )
    return F.when(text.rlike(pattern), joined).otherwise(F.array().cast("array<struct<start:int,end:int,value:string>>"))


def labelled(spans: Column, kind: str, place: int) -> Column:
    """Spans with their kind and its place in the list of kinds."""
    return F.transform(
        spans,
        lambda span: F.struct(
            span["start"].alias("start"), F.lit(place).alias("place"), F.lit(kind).alias("kind"),
            span["end"].alias("end"), span["value"].alias("value"),
        ),
    )


def written(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined in the array's order."""
    return F.array_join(
        F.transform(spans, lambda span: F.concat_ws(":", span["kind"], span["start"].cast("string"), span["end"].cast("string"))), ","
    )

