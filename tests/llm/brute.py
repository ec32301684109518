"""Brute-force versions that several tests share."""

from __future__ import annotations

import re
from collections import Counter, defaultdict


def brute_near(rows, size=2):
    sets = {}
    for number, text in rows:
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        words = [word for word in re.split("[\x20\x09-\x0d]+", low) if word]
        sets[number] = {tuple(words[i : i + size]) for i in range(len(words) - size + 1)} or ({tuple(words)} if words else set())
    parent = {number: number for number in sets}

    def root(number):
        while parent[number] != number:
            number = parent[number]
        return number

    users = defaultdict(list)
    for number in sorted(sets):
        shared = Counter(other for one in sets[number] for other in users[one])
        for one in sets[number]:
            users[one].append(number)
        for other, both in shared.items():
            if 100 * both >= 80 * (len(sets[number]) + len(sets[other]) - both):
                a, b = root(number), root(other)
                parent[max(a, b)] = min(a, b)
    return {number: (len(sets[number]), root(number), root(number) == number) for number in sets}
