"""Repair of the turn structure of conversations: Viterbi with survivor coalescence.

A repaired conversation has the role initials ``(s?(ua)+)?``. Row by row, each state of that pattern keeps its cheapest edits so
far as a node of a backpointer tree, whose nodes count the references of their children and of the states. As soon as
all surviving states share an ancestor, the edits above it are final, leave the tree and are handed on, so that only the
undecided rows of a conversation are in memory. Ties go to the least string of edit initials: survivors are ranked by their complete
undecided strings, and a row's new strings compare by the rank of what they extend, then by what they add (no survivor's string
is a prefix of another's, as each ends with the edit of the same row). States that cannot win any more, not
even a tie, are left out, or else the state of an empty conversation would survive forever and nothing would be final.

Faults are found by DataFrame operators; rows of a conversation then stream through a task, sorted, a batch at a time. A
conversation of any length takes the memory of its undecided rows only, but all its rows pass one task in order, as its digest
asks for; sorting spills.

Defined results: rows of a conversation are ordered by turn (NULL first), then role and text; a NULL role or text is one blank,
a NULL conversation id is a conversation of its own. Empty and blank texts are faults; a text of any length is one row. Repeated rows
are duplicates. An empty table gives an empty result; other columns, whatever their names, are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


BLANK, DUPLICATE, TRUNCATED = "blank", "duplicate", "truncated"
SEEN = r"[^\x20\x09-\x0D]"
ENDED = r"[.!?][\x20\x09-\x0D]*\z"
DELETE, CHANGE, CUT = 3, 2, 1  # what edits cost; CUT: a truncated row that stays
NOTHING, SYSTEM, USER, ASSISTANT = range(4)  # states: what the repaired rows end with
_NEXT = (USER, USER, ASSISTANT, USER)  # the state that a new or renamed row leads to
_NAME = {USER: "user", ASSISTANT: "assistant"}
_KEEPS = ({"s": SYSTEM, "u": USER}, {"u": USER}, {"a": ASSISTANT}, {"u": USER})
_HELD_ROWS, _HELD_SIGNS = 2_000, 4_000_000

EDITS = "conv_id long, place long, edit string, turn long, role string, text string, fault string, new_role string"


def filled(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role and text, with one blank for a NULL role or text."""
    blank = F.lit(" ")
    return rows.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", blank).alias("role"), F.coalesce("text", blank).alias("text"),
    )


def damaged(rows: DataFrame) -> DataFrame:
    """Rows after repeatable damage, by the hash of conversation and turn."""
    part = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(part("conv_id"), F.lit(":"), part("turn"))) % 20
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("kind") == 4, "user").otherwise(F.col("role"))
    copies = F.sequence(F.lit(1), F.when(F.col("kind") == 3, 2).otherwise(1))
    return (
        filled(rows).withColumn("kind", kind).where("kind <> 0")
        .select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(copies).alias("copy"))
        .drop("copy")
    )


def with_faults(rows: DataFrame) -> DataFrame:
    """Rows with their first fault, or NULL, sorted within partitions that hold whole conversations: one shuffle."""
    dealt = filled(rows).repartition("conv_id")
    order = [F.asc_nulls_first("turn"), "role", "text"]
    earlier = F.row_number().over(Window.partitionBy("conv_id", "role", "text").orderBy(F.asc_nulls_first("turn")))
    numbered = dealt.withColumn("nth", earlier)
    fault = (
        F.when(~F.col("text").rlike(SEEN), BLANK).when(F.col("nth") > 1, DUPLICATE).when(~F.col("text").rlike(ENDED), TRUNCATED)
    )
    return (
        numbered.withColumn("fault", fault).sortWithinPartitions(F.asc_nulls_first("conv_id"), *order, "nth")
        .select("conv_id", "turn", "role", "text", "fault")
    )


class _Node:
    """One row's edits on a path: ``edits`` (inserts, then the row's own) from ``state``."""

    __slots__ = ("parent", "children", "state", "edits", "row", "alive")

    def __init__(self, parent, state, edits, row):
        self.parent, self.state, self.edits, self.row = parent, state, edits, row
        self.children, self.alive = [], False


class Repair:
    """One conversation: rows go in, final edits come out as (edit, row or None, new role or None)."""

    def __init__(self):
        self.root = _Node(None, NOTHING, "", None)
        self.root.alive = True
        self.best = {NOTHING: (0, 0, self.root)}  # state: cost, rank among the survivors, node

    def add(self, initial: str, fault: str | None, row) -> Iterator[tuple]:
        found: dict[int, tuple] = {}

        def offer(state, cost, rank, edits, node, start):
            if state not in found or (cost, rank, edits) < found[state][:3]:
                found[state] = (cost, rank, edits, node, start)

        must_go = fault in (BLANK, DUPLICATE)
        stay = CUT if fault == TRUNCATED else 0
        for start, (cost, rank, node) in self.best.items():
            offer(start, cost + DELETE, rank, "D", node, start)
            state, inserts = start, ""
            for _ in range(0 if must_go else 3):
                kept = _KEEPS[state].get(initial)
                if kept is not None:
                    offer(kept, cost + stay, rank, inserts + "K", node, start)
                offer(_NEXT[state], cost + CHANGE + stay, rank, inserts + "R", node, start)
                state, inserts, cost = _NEXT[state], inserts + "I", cost + CHANGE
        self._drop_hopeless(found)
        old = [node for _, _, node in self.best.values()]
        ordered = sorted(found.items(), key=lambda one: one[1][1:3])
        self.best = {}
        for rank, (state, (cost, _, edits, node, start)) in enumerate(ordered):
            child = _Node(node, start, edits, row)
            child.alive = True
            node.children.append(child)
            self.best[state] = (cost, rank, child)
        for node in old:
            node.alive = False
            while node.parent is not None and not node.children and not node.alive:
                node.parent.children.remove(node)
                node = node.parent
        while not self.root.alive and len(self.root.children) == 1:
            self.root = self.root.children[0]
            self.root.parent = None
            yield from self._edits(self.root)

    @staticmethod
    def _drop_hopeless(found: dict[int, tuple]) -> None:
        """States that another one beats whatever follows. What follows "s" or nothing can follow an answer as well,
        at the price of one deletion for a system row that may only come first; an insert leads from question to answer and back."""
        far = float("inf")
        user, answer = (found[state][0] if state in found else far for state in (USER, ASSISTANT))
        ready = min(answer, user + CHANGE)
        for state, most in ((NOTHING, ready + DELETE), (SYSTEM, ready), (USER, answer + CHANGE), (ASSISTANT, user + CHANGE)):
            if state in found and found[state][0] > most:
                del found[state]

    @staticmethod
    def _edits(node: _Node) -> Iterator[tuple]:
        state = node.state
        for edit in node.edits:
            if edit == "I":
                state = _NEXT[state]
                yield edit, None, _NAME[state]
            elif edit == "R":
                yield edit, node.row, _NAME[_NEXT[state]]
            else:
                yield edit, node.row, None

    def end(self) -> Iterator[tuple]:
        """What is still undecided, with inserts behind the last row where they are cheaper."""
        ends = []
        for start, (cost, rank, node) in self.best.items():
            state, inserts = start, ""
            while state not in (NOTHING, ASSISTANT):
                state, inserts = _NEXT[state], inserts + "I"
            ends.append((cost + CHANGE * len(inserts), rank, inserts, node, start))
        _, _, inserts, node, start = min(ends, key=lambda one: one[:3])
        path = []
        while node is not self.root:
            path.append(node)
            node = node.parent
        for node in reversed(path):
            yield from self._edits(node)
        yield from self._edits(_Node(None, start, inserts, None))


def repaired(rows: DataFrame) -> DataFrame:
    """Edits of every conversation in order; the rows with ``edit`` other than "D" are the repaired conversation.

    ``place`` counts a conversation's edits from 0. An inserted row has the new role and no turn; a kept one no new role. Rows
    come out sorted, each conversation within one partition.
    """
    names = [part.split()[0] for part in EDITS.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.string()]
        held, signs = [], 0
        one, conv, place = None, None, 0

        def batch_of(rows):
            columns = zip(*rows) if rows else [[] for _ in names]
            return pa.RecordBatch.from_arrays([pa.array(list(values), kind) for values, kind in zip(columns, kinds)], names=names)

        def hold(edits):
            nonlocal place, signs
            for edit, row, new in edits:
                turn, role, text, fault = row or (None, None, "", None)
                held.append((conv, place, edit, turn, role, text, fault, new))
                place += 1
                signs += len(text)

        for batch in batches:
            columns = (batch.column(name).to_pylist() for name in ("conv_id", "turn", "role", "text", "fault"))
            for number, turn, role, text, fault in zip(*columns):
                if one is None or number != conv:
                    if one is not None:
                        hold(one.end())
                    one, conv, place = Repair(), number, 0
                hold(one.add(role[:1], fault, (turn, role, text, fault)))
                if len(held) >= _HELD_ROWS or signs >= _HELD_SIGNS:
                    yield batch_of(held)
                    held, signs = [], 0
        if one is not None:
            hold(one.end())
        yield batch_of(held)

    return with_faults(rows).mapInArrow(run, EDITS)


class _Digest:
    """Figures of one conversation, from its edits in order."""

    def __init__(self, conv):
        self.conv, self.turns, self.first, self.last = conv, 0, None, None
        self.faults = dict.fromkeys((BLANK, DUPLICATE, TRUNCATED), 0)
        self.illegal, self.cost, self.audit, self.before, self.text = 0, 0, [], None, None

    def add(self, edit, turn, role, text, fault, new):
        self.audit.append(edit)
        if edit != "I":
            if fault:
                self.faults[fault] += 1
            if turn is not None and turn != self.last:
                self.turns, self.last = self.turns + 1, turn
                self.first = turn if self.first is None else self.first
            if self.before is not None and (self.before, role[:1]) not in {("s", "u"), ("u", "a"), ("a", "u")}:
                self.illegal += 1
            self.before = role[:1]
        self.cost += {"K": 0, "D": DELETE}.get(edit, CHANGE) + (CUT if fault == TRUNCATED and edit != "D" else 0)
        if edit != "D":
            line = f"{new or role}:{text}".encode("utf-8", "surrogatepass")
            if self.text is None:
                self.text = sha256(line)
            else:
                self.text.update(b"\n" + line)

    def row(self):
        gaps = 0 if self.first is None else self.last - self.first + 1 - self.turns
        return (self.conv, gaps, *self.faults.values(), self.illegal, self.cost, "".join(self.audit), (self.text or sha256()).hexdigest())


DIGESTS = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


def digests(edits: DataFrame) -> DataFrame:
    """Figures of each conversation, from :func:`repaired` as it comes: sorted, no conversation over two partitions."""
    names = [part.split()[0] for part in DIGESTS.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64()] * 7 + [pa.string()] * 2
        one, done = None, []

        def batch_of(rows):
            columns = zip(*rows) if rows else [[] for _ in names]
            return pa.RecordBatch.from_arrays([pa.array(list(values), kind) for values, kind in zip(columns, kinds)], names=names)

        for batch in batches:
            columns = (batch.column(name).to_pylist() for name in ("conv_id", "place", "edit", "turn", "role", "text", "fault", "new_role"))
            for number, place, edit, turn, role, text, fault, new in zip(*columns):
                if place == 0:
                    if one is not None:
                        done.append(one.row())
                    one = _Digest(number)
                one.add(edit, turn, role, text, fault, new)
            if done:
                yield batch_of(done)
                done = []
        yield batch_of(done if one is None else [*done, one.row()])

    return edits.mapInArrow(run, DIGESTS)


def audited(rows: DataFrame, damage: bool = True) -> DataFrame:
    """One row per conversation of ``rows``; one that has no row left has zeros, no edits and the digest of an empty text."""
    found = digests(repaired(damaged(rows) if damage else rows)).withColumn("known", F.coalesce(F.col("conv_id").cast("string"), F.lit("")))
    every = rows.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    every = every.withColumn("known", F.coalesce(F.col("conv_id").cast("string"), F.lit("")))
    zero: Column = F.lit(0).cast("long")
    filled_in = {name: F.coalesce(name, zero) for name in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")}
    filled_in |= {"audit": F.coalesce("audit", F.lit("")), "repaired_sha256": F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256))}
    return every.join(found.drop("conv_id"), "known", "left").select("conv_id", *(value.alias(name) for name, value in filled_in.items()))
