"""Secret scan with corpus-wide ownership frequency, in DataFrame operations alone.

Patterns propose candidates. Each candidate value is hashed, and the corpus is asked in how many repositories
and owners the hash occurs. A value that several owners share is a copied example; one that few owners have
and that looks random is a live credential of theirs. The verdicts are added as spans of their own over the
value, ``live`` and ``copied``; the patterns' spans always stay.

Defined results: a NULL text counts as empty; a NULL repository or owner counts as one more repository or
owner; repeated rows each get the whole answer and count as one place; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import labelled, matches, settled, whole, written

# Kinds in their order, pattern, group that holds the value, least length of the value.
KINDS = (
    (
        "assign",
        r"([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"
        r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        2,
        8,
    ),
    ("access", "AKIA[A-Z0-9]+", 0, 16),
    ("hex", "[0-9a-f]{32,}", 0, 32),
)
LIVE, COPIED = "live", "copied"
MOST_OWNERS = 2
LEAST_DISTINCT = 6
PLACEHOLDER = "(?i)example|changeme|placeholder|your_|dummy|xxxx|1234567"


def candidates(text: Column) -> Column:
    """All candidates of the patterns, by start, then kind."""

    def of(place: int, kind: str, pattern: str, group: int, least: int) -> Column:
        found = labelled(matches(text, pattern, group), kind, place)
        return F.filter(found, lambda span: F.length(span["value"]) >= least)

    return F.array_sort(F.concat(*(of(place, *kind) for place, kind in enumerate(KINDS))))


def ownership(spans: DataFrame, value: str, repository: str, owner: str) -> DataFrame:
    """``value``, n_repositories, n_owners: distinct counts folded in two steps, so that a value in a third of
    all rows reaches its last task as one row per owner."""
    return (
        spans.groupBy(value, owner, repository)
        .agg(F.lit(1).alias("_one"))
        .groupBy(value, owner)
        .agg(F.count("*").alias("_repositories"))
        .groupBy(value)
        .agg(F.sum("_repositories").alias("n_repositories"), F.count("*").alias("n_owners"))
    )


def scan(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    repository: Column | None = None,
    owner: Column | None = None,
    most_owners: int = MOST_OWNERS,
) -> DataFrame:
    """doc_id, spans (array, with n_repositories, n_owners and verdict) of every row of ``docs``.

    The candidates of each row are settled first: texts are read once and are never shuffled. Only rows with
    candidates take part in the count and in the join of the answers.
    """
    scanned = settled(
        docs.select(
            F.col(doc_id).alias("doc_id"),
            candidates(whole(F.col(text))).alias("found"),
            F.coalesce(repository if repository is not None else F.col("source"), F.lit("")).alias("repository"),
            F.coalesce(owner if owner is not None else F.col("source"), F.lit("")).alias("owner"),
        ).withColumn("row", F.xxhash64("found"))
    )
    hits = scanned.where(F.size("found") > 0).select(
        "doc_id", "repository", "owner", "row", F.explode("found").alias("span")
    ).withColumn("value_sha256", F.sha2(F.col("span.value"), 256))
    counts = ownership(hits, "value_sha256", "repository", "owner")
    places = hits.select("doc_id", "row", "span", "value_sha256").distinct()
    value = F.col("span.value")
    looks_live = (F.size(F.array_distinct(F.split(value, ""))) >= LEAST_DISTINCT) & ~value.rlike(PLACEHOLDER)
    verdict = F.when(F.col("n_owners") > most_owners, COPIED).when(looks_live, LIVE)
    judged = (
        places.join(counts, "value_sha256")
        .withColumn("verdict", verdict)
        .groupBy("doc_id", "row")
        .agg(F.collect_list(F.struct("span.start", "span.place", "span.kind", "span.end", "span.value", "value_sha256", "n_repositories", "n_owners", "verdict")).alias("judged"))
    )
    answers = judged.withColumnRenamed("doc_id", "_id").withColumnRenamed("row", "_row")
    none = F.array().cast(judged.schema["judged"].dataType)
    return (
        scanned.join(answers, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("row") == F.col("_row")), "left")
        .select("doc_id", F.array_sort(F.coalesce("judged", none)).alias("spans"))
    )


def digests(scanned: DataFrame) -> DataFrame:
    """Counts and span strings of the contract from :func:`scan`'s rows, and in how many repositories and owners the
    row's most copied value is."""

    def number(kind: str) -> Column:
        return F.size(F.filter("spans", lambda span: span["kind"] == kind)).cast("long")

    def verdicts(kind: str, place: int) -> Column:
        chosen = F.filter("spans", lambda span: span["verdict"] == kind)
        return F.transform(
            chosen,
            lambda span: F.struct(
                (span["end"] - F.length(span["value"])).alias("start"), F.lit(place).alias("place"), F.lit(kind).alias("kind"), span["end"].alias("end")
            ),
        )

    base = F.transform("spans", lambda span: F.struct(span["start"].alias("start"), span["place"].alias("place"), span["kind"].alias("kind"), span["end"].alias("end")))
    everything = F.array_sort(F.concat(base, F.array_distinct(verdicts(LIVE, len(KINDS))), F.array_distinct(verdicts(COPIED, len(KINDS) + 1))))
    return scanned.select(
        "doc_id",
        *(number(kind).alias(f"n_{kind}") for kind, *_ in KINDS),
        F.sha2(written(base), 256).alias("base_sha256"),
        written(everything).alias("spans"),
        F.size(F.filter("spans", lambda span: span["verdict"] == LIVE)).cast("long").alias("n_live"),
        F.size(F.filter("spans", lambda span: span["verdict"] == COPIED)).cast("long").alias("n_copied"),
        *(F.coalesce(F.array_max(F.transform("spans", lambda span: span[name])), F.lit(0).cast("long")).alias(name) for name in ("n_repositories", "n_owners")),
    )
