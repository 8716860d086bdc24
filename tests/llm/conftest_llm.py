"""Helpers for the tests of the corpus operators."""

import re

import pyarrow.parquet as pq
from conftest_rows import CLASH, LONG, ROWS, WORDS, documents, prose  # noqa: F401

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def table_rows(sf, name):
    return pq.read_table(f"{sf}/{name}.parquet").to_pylist()


def shingles(text, k):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if len(words) < k:
        return {tuple(words)} if words else set()
    return {tuple(words[i:i + k]) for i in range(len(words) - k + 1)}


def linked_components(sets, percent):
    """Least key of each key's component by brute force; ``sets`` is a list of (key, set)."""
    parent = list(range(len(sets)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, (_, a) in enumerate(sets):
        for j in range(i):
            b = sets[j][1]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                x, y = find(i), find(j)
                parent[max(x, y)] = min(x, y)
    out = []
    for i, (key, s) in enumerate(sets):
        keys = [sets[j][0] for j in range(len(sets)) if find(j) == find(i) and sets[j][0] is not None]
        out.append(key if not s else min(keys, default=None))
    return out
