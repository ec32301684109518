"""Conversation repair against every possible list of edits, and against a plain dynamic programme."""

from __future__ import annotations

import random
import re
from collections import defaultdict
from hashlib import sha256
from itertools import product
from zlib import crc32

import duckdb
import pytest

from marquee.llm import conversations
from marquee.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
BLANKS = " \t\n\x0b\x0c\r"
SCHEMA = "conv_id long, turn long, role string, text string"


def damage(rows):
    for conv, turn, role, text in rows:
        role, text = (" " if value is None else value for value in (role, text))
        kind = crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if kind == 1:
            text = ""
        if kind == 2:
            text = re.sub("[.!?]", "", text)
        if kind == 4:
            role = "user"
        if kind:
            yield from [(conv, turn, role, text)] * (2 if kind == 3 else 1)


def faults(rows):
    seen = set()
    for _, role, text in rows:
        bare = text.strip(BLANKS)
        yield "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else None
        seen.add((role, text))


def every_edit(rows, found):
    """Each list of edits of a short conversation: cost, initials, repaired rows."""
    options = []
    for (_, role, text), fault in zip(rows, found):
        stay = 1 if fault == "truncated" else 0
        own = [(3, "D", [])]
        if fault not in ("blank", "duplicate"):
            own += [(stay, "K", [(role, text)])] + [(2 + stay, "R", [(name, text)]) for name in ("user", "assistant")]
        options.append(own)
    inserts = [(0, "", [])] + [(2 * n, "I" * n, [(name, "") for name in names]) for n in (1, 2) for names in product(("user", "assistant"), repeat=n)]
    parts = [inserts] + [[(a[0] + b[0], a[1] + b[1], a[2] + b[2]) for a in own for b in inserts] for own in options]
    for chosen in product(*parts):
        yield sum(c for c, _, _ in chosen), "".join(e for _, e, _ in chosen), [row for _, _, rows in chosen for row in rows]


def cheapest(rows, found):
    legal = lambda kept: re.fullmatch("(s?(ua)+)?", "".join(role[:1] or "-" for role, _ in kept))
    return min((one for one in every_edit(rows, found) if legal(one[2])), key=lambda one: one[:2])


def by_strings(rows, found):
    """State to the least (cost, initials, repaired rows), whole strings kept: for longer conversations."""
    follow = {"": "su", "s": "u", "u": "a", "a": "u"}
    best = {"": (0, "", [])}

    def least(offers):
        out = {}
        for state, cost, edits, kept in offers:
            if state not in out or (cost, edits) < out[state][:2]:
                out[state] = (cost, edits, kept)
        return out

    def inserted(best):
        offers = [(state, *one) for state, one in best.items()]
        for state, (cost, edits, kept) in best.items():
            for _ in range(2):
                state = "a" if state == "u" else "u"
                cost, edits, kept = cost + 2, edits + "I", [*kept, ({"u": "user", "a": "assistant"}[state], "")]
                offers.append((state, cost, edits, kept))
        return least(offers)

    for (_, role, text), fault in zip(rows, found):
        stay, offers = (1 if fault == "truncated" else 0), []
        for state, (cost, edits, kept) in inserted(best).items():
            offers.append((state, cost + 3, edits + "D", kept))
            if fault not in ("blank", "duplicate"):
                if role[:1] and role[:1] in follow[state]:
                    offers.append((role[0], cost + stay, edits + "K", [*kept, (role, text)]))
                for name in ("user", "assistant"):
                    if name[0] in follow[state]:
                        offers.append((name[0], cost + 2 + stay, edits + "R", [*kept, (name, text)]))
        best = least(offers)
    best = inserted(best)
    return min((best[state] for state in ("", "a") if state in best), key=lambda one: one[:2])


def wanted(rows, solve, damaged=True):
    groups = defaultdict(list, {conv: [] for conv, *_ in rows})
    for conv, *rest in damage(rows) if damaged else rows:
        groups[conv].append(tuple(rest))
    out = {}
    for conv, group in groups.items():
        group.sort(key=lambda row: (row[0] is not None, row[0] or 0, row[1].encode(), row[2].encode()))
        found = list(faults(group))
        turns = {turn for turn, _, _ in group if turn is not None}
        initials = [role[:1] for _, role, _ in group]
        cost, audit, kept = solve(group, found)
        out[conv] = (
            max(turns) - min(turns) + 1 - len(turns) if turns else 0, *(found.count(kind) for kind in ("blank", "duplicate", "truncated")),
            sum((a, b) not in {("s", "u"), ("u", "a"), ("a", "u")} for a, b in zip(initials, initials[1:])),
            cost, audit, sha256("\n".join(f"{role}:{text}" for role, text in kept).encode()).hexdigest(),
        )
    return out


def answers(frame):
    return {row[0]: tuple(row)[1:] for row in frame.collect()}


def test_repair_query(spark):
    rows = duckdb.sql(f"SELECT conv_id, turn, role, text FROM '{FOLDER}/conversations.parquet'").fetchall()
    assert answers(QUERIES["op11_conversation_repair"](spark, FOLDER)) == wanted(rows, by_strings)


def made(seed, conversations_, most):
    source = random.Random(seed)
    roles = ["user", "assistant", "system", "user", "assistant", "tool", ""]
    said = ["One.", "Two?", "Three", " ", "", "Four! \n", "Five", "Six.", "Seven."]
    rows = []
    for conv in range(conversations_):
        for turn in range(source.randint(0, most)):
            text = source.choice(said)
            rows.append((conv, source.choice([turn, turn, turn + 5, None]), source.choice(roles), text if source.random() < 0.5 else f"{turn}{text}"))
    return rows


def test_short_conversations_against_every_edit(spark):
    rows = made(3, 60, 3)
    assert answers(conversations.audited(spark.createDataFrame(rows, SCHEMA), damage=False)) == wanted(rows, cheapest, False)
    assert wanted(rows, cheapest, False) == wanted(rows, by_strings, False)


def test_long_conversations(spark):
    rows = made(4, 40, 60) + [(900, n, "user", f"{n}.") for n in range(300)] + [(901, n, "system", f"{n}") for n in range(100)]
    assert answers(conversations.audited(spark.createDataFrame(rows, SCHEMA))) == wanted(rows, by_strings)


def test_decided_rows_leave_memory():
    one, most = conversations.Repair(), 0
    for n in range(20_000):
        role = "su"[n > 0] if n % 2 == 0 or n == 1 else "a"
        list(one.add(role if n > 1 else "su"[n], None, (n, role, "x.", None)))
        held, open_nodes = 0, [one.root]
        if n % 500 == 0:
            while open_nodes:
                node = open_nodes.pop()
                held += 1
                open_nodes += node.children
            most = max(most, held)
    assert most < 40


def test_edges_of_conversations(spark):
    long = "word " * 200_000
    rows = [(None, None, None, None), (None, 1, "user", "a."), (1, None, "user", long), (1, 0, "assistant", "ok."), (2, 5, "x", ""), (2, 5, "x", "")]
    rows += [(3, 1, "user", "q?"), (3, 1, "assistant", "a."), (3, 1, "user", "q?")]
    frame = spark.createDataFrame([(*row, "x", "y") for row in rows], f"{SCHEMA}, fault string, place string")
    assert answers(conversations.audited(frame)) == wanted(rows, by_strings)
    assert conversations.audited(frame.limit(0)).count() == 0
    edits = conversations.repaired(frame).where("conv_id = 3").orderBy("place").collect()
    assert "".join(row["edit"] for row in edits) == "IKKDI" and [row["place"] for row in edits] == [0, 1, 2, 3, 4]


@pytest.mark.parametrize("seed", range(3))
def test_streamed_edits_equal_the_whole(seed):
    rows = [tuple(row[1:]) for row in made(seed, 1, 40)]
    rows = [(turn, role, text) for turn, role, text in rows]
    found = list(faults(rows))
    one, edits = conversations.Repair(), []
    for (turn, role, text), fault in zip(rows, found):
        edits += one.add(role[:1], fault, (turn, role, text, fault))
    edits += one.end()
    assert "".join(edit for edit, _, _ in edits) == by_strings(rows, found)[1]
