"""Fuzzy search for short license notices.

A notice with at most k edits, split into k + 1 pieces, holds at least one piece unchanged. An automaton finds
these exact seeds in one pass over the text's words; every run of whole words around a seed that has the
notice's naming words is verified by the regular-expression library's matching with at most k errors. Of runs of one
notice that overlap, those with fewer edits stand, then the earlier, then the shorter. Runs as Arrow batches per partition: no
shuffle, memory bounded by a batch of rows.

Defined results: a NULL text counts as empty (no words, no places, score 0); repeated rows each get their own
answer; a very long text is walked once, whatever the number of its hits; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

# Exact phrases and their labels.
PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}
# Notices searched with errors, their labels, the most edits allowed and the words that name the
# license, which no edit may touch.
NOTICES = (
    ("under the mit license", "mit", 2, ("mit",)),
    ("apache license version 2", "apache-2", 2, ("2",)),
    ("cc by nc", "cc-by-nc", 1, ("cc", "nc")),
    ("gnu general public license", "gpl", 3, ("gnu",)),
    ("mozilla public license", "mpl", 3, ()),
    ("bsd 3 clause license", "bsd-3-clause", 2, ("bsd", "3")),
    ("creative commons attribution", "cc-by", 3, ()),
    ("all rights reserved", "proprietary", 2, ("all",)),
)
# Words are what stands between ASCII signs other than digits and letters; A-Z are lowered.
_TO_WORDS = {code: chr(code) if chr(code).isdigit() or chr(code).islower() else chr(code).lower() if chr(code).isupper() else " " for code in range(128)}
SCHEMA = "doc_id long, n_words long, base array<struct<label:string,word:long>>, spans array<struct<label:string,first_word:long,last_word:long,edits:int,text:string>>"

PLACE = pa.struct([("label", pa.string()), ("word", pa.int64())])
SPAN = pa.struct([("label", pa.string()), ("first_word", pa.int64()), ("last_word", pa.int64()), ("edits", pa.int32()), ("text", pa.string())])


def normal(text: str | None) -> tuple[str, int]:
    """The words, joined by one blank and with one at either end, and their number."""
    words = [word for word in (text or "").translate(_TO_WORDS).split(" ") if word]
    return (f" {' '.join(words)} " if words else " "), len(words)


def pieces(notice: str, edits: int) -> list[tuple[int, str]]:
    """``edits + 1`` consecutive pieces and their offsets: the pigeonhole seeds."""
    cuts = [len(notice) * part // (edits + 1) for part in range(edits + 2)]
    return [(start, notice[start:end]) for start, end in zip(cuts, cuts[1:])]


@lru_cache(maxsize=4)
def seeds(notices: tuple) -> tuple:
    """Automaton from seed to the notices and offsets it may stand for."""
    import ahocorasick

    places: dict[str, list[tuple[int, int]]] = {}
    for which, (notice, _, edits, _) in enumerate(notices):
        for offset, piece in pieces(notice, edits):
            places.setdefault(piece, []).append((which, offset))
    automaton = ahocorasick.Automaton()
    for piece, users in places.items():
        automaton.add_word(piece, (len(piece), users))
    automaton.make_automaton()
    return automaton


@lru_cache(maxsize=64)
def patterns(notice: str, edits: int) -> list[regex.Pattern]:
    """The notice with at most 0, 1, ... edits."""
    return [regex.compile(f"(?:{regex.escape(notice, literal_spaces=True)}){{e<={most}}}") for most in range(edits + 1)]


@lru_cache(maxsize=65536)
def distance(text: str, notice: str, edits: int) -> int | None:
    """The fewest edits with which the whole text is the notice, or None beyond ``edits``: bounded-error matching."""
    if abs(len(text) - len(notice)) > edits or not patterns(notice, edits)[-1].fullmatch(text):
        return None
    return next(most for most, pattern in enumerate(patterns(notice, edits)) if pattern.fullmatch(text))


def base_places(words: str) -> list[tuple[str, int]]:
    """(label, word number) of each place where a phrase's words stand one after another; blanks are counted once."""
    hits = []
    for phrase, label in PHRASES.items():
        at = words.find(f" {phrase} ")
        while at >= 0:
            hits.append((at, label))
            at = words.find(f" {phrase} ", at + 1)
    found, word, last = [], 0, 0
    for at, label in sorted(hits):
        word, last = word + words.count(" ", last, at), at
        found.append((label, word))
    return found


def fuzzy_places(words: str, notices: tuple = NOTICES) -> list[tuple[str, int, int, int, str]]:
    """(label, first word, last word, edits, text) of each notice found with at most its edits."""
    runs: set[tuple[int, int, int]] = set()
    for end, (length, users) in seeds(notices).iter(words):
        seed = end + 1 - length
        for which, offset in users:
            notice, _, edits, _ = notices[which]
            for first in range(max(1, seed - offset - edits), min(seed, seed - offset + edits) + 1):
                if words[first - 1] == " " and words[first] != " ":
                    last = words.find(" ", max(end + 1, first + len(notice) - edits), first + len(notice) + edits + 1)
                    while last >= 0:
                        runs.add((which, first, last))
                        last = words.find(" ", last + 1, first + len(notice) + edits + 1)
    near = []
    for which, first, last in runs:
        notice, _, edits, exact = notices[which]
        text = words[first:last]
        if set(exact).issubset(text.split(" ")) and (apart := distance(text, notice, edits)) is not None:
            near.append((apart, first, last, which))
    found, taken = [], {}
    for apart, first, last, which in sorted(near):
        ends = taken.setdefault(which, [])
        at = bisect_left(ends, (first,))
        if (at == 0 or ends[at - 1][1] <= first) and (at == len(ends) or last <= ends[at][0]):
            ends.insert(at, (first, last))
            found.append((which, first, last, apart))
    found.sort(key=lambda span: span[1])
    spans, word, at = [], -1, 0
    for which, first, last, apart in found:
        word, at = word + words.count(" ", at, first), first
        text = words[first:last]
        spans.append((notices[which][1], word, word + text.count(" "), apart, text))
    return sorted(spans, key=lambda span: (span[1], span[2], span[0], span[3]))


def search(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", notices: tuple = NOTICES) -> DataFrame:
    """doc_id, n_words, base places and fuzzy spans (words from 0) of each row."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("base", pa.list_(PLACE)), ("spans", pa.list_(SPAN))])
        for batch in batches:
            counts, bases, spans = [], [], []
            for body in batch.column("text").to_pylist():
                words, count = normal(body)
                counts.append(count)
                bases.append([dict(zip(("label", "word"), place)) for place in base_places(words)])
                spans.append([dict(zip(("label", "first_word", "last_word", "edits", "text"), span)) for span in fuzzy_places(words, notices)])
            ids = batch.column("doc_id").cast(pa.int64())
            yield pa.RecordBatch.from_arrays([ids, *(pa.array(rows, field.type) for rows, field in zip((counts, bases, spans), list(schema)[1:]))], schema=schema)

    return docs.selectExpr(f"`{doc_id}` AS doc_id", f"`{text}` AS text").mapInArrow(scan, SCHEMA)


def digests(found: DataFrame) -> DataFrame:
    """The contract's columns from :func:`search`'s rows: score is 1 for a base place, else 1 - edits / length of
    the best span, 0 without any."""
    return found.selectExpr(
        "doc_id",
        "n_words",
        "CAST(size(base) AS long) AS n_base",
        "array_min(transform(base, place -> place.word)) AS first_word",
        "array_max(transform(base, place -> place.word)) AS last_word",
        "array_join(array_sort(array_distinct(transform(base, place -> place.label))), ',') AS base_labels",
        "array_join(array_sort(array_distinct(concat(transform(base, place -> place.label), transform(spans, span -> span.label)))), ',') AS labels",
        "CASE WHEN size(base) > 0 THEN 1.0D ELSE coalesce(greatest(array_max(transform(spans, span -> 1D - span.edits / length(span.text))), 0D), 0D) END AS score",
        "array_join(transform(spans, span -> concat_ws(':', span.label, span.first_word, span.last_word, span.edits)), ',') AS spans",
    )
