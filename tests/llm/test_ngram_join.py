import random

import numpy as np
import pytest
from conftest_llm import documents, linked_components, prose, shingles, table_rows

from lumenfit.llm import ngram_join, queries


def check(rows, got, k, percent):
    sets = [(key, shingles(text, k)) for key, text in rows]
    want = sorted((repr(key), len(s), repr(c)) for (key, s), c in zip(sets, linked_components(sets, percent)))
    assert sorted((repr(r[0]), r[1], repr(r[2])) for r in got) == want
    return len({c for _, _, c in want})


def edited(rng, words, share):
    return " ".join(f"new{rng.random()}" if rng.random() < share else w for w in words)


def test_query_against_brute_force(spark, sf):
    rows = [(r["doc_id"], r["text"]) for r in table_rows(sf, "documents")]
    assert check(rows, queries.op10_jaccard(spark, sf).collect(), 4, 85) < len(rows)


@pytest.mark.parametrize("k, percent, node", [(4, 85, 256), (5, 80, 256), (4, 85, 12), (3, 60, 7)])
def test_families_of_near_copies(spark, monkeypatch, k, percent, node):
    """Families whose members are around the threshold, more of them than a node takes, and passages in common."""
    monkeypatch.setattr(ngram_join, "NODE", node)
    monkeypatch.setattr(ngram_join, "BLOCK", 20)
    rng = random.Random(k * percent)
    rows, key = [], 0
    for family in range(6):
        words = [f"w{rng.randrange(500)}" for _ in range(rng.choice([30, 80, 200]))]
        for _ in range(40):
            rows.append((key, edited(rng, words, rng.choice([0, 0.01, 0.02, 0.03, 0.05]))))
            key += 1
    passage = prose(5, 60)
    rows += [(key + i, f"{passage} {prose(i * 3, 20)} {' '.join(f'z{rng.randrange(900)}' for _ in range(30))}") for i in range(40)]
    got = ngram_join.jaccard_components(documents(spark, [(i, t, "a") for i, t in rows]).repartition(4), k=k, percent=percent).collect()
    check(rows, got, k, percent)


def test_messy_rows(messy, empty):
    rows = [(r["doc_id"], r["text"]) for r in messy.collect()]
    got = ngram_join.jaccard_components(messy, k=4, percent=85).collect()
    check(rows, got, 4, 85)
    kept = ngram_join.deduplicated(messy, k=4, percent=85)
    assert kept.columns == messy.columns
    assert {r["doc_id"] for r in kept.collect()} == {None, 1, 2, 3, 4, 5, 6, 7}
    assert ngram_join.jaccard_components(empty).count() == 0 and ngram_join.deduplicated(empty).count() == 0


def test_chain_of_links(spark):
    """A component is what links reach, however far its ends are apart."""
    words = [f"w{i}" for i in range(200)]
    rows = []
    for step in range(60):
        words[step * 3 % 200] = f"changed{step}"
        rows.append((step, " ".join(words)))
    got = ngram_join.jaccard_components(documents(spark, [(i, t, "a") for i, t in rows]), k=4, percent=85).collect()
    assert {r["component_id"] for r in got} == {0}
    check(rows, got, 4, 85)


def test_links_are_complete_in_a_group():
    rng = np.random.default_rng(1)
    base = np.unique(rng.integers(0, 2**63, 400).astype(np.uint64))
    tokens = []
    for i in range(120):
        own = rng.integers(0, 2**63, rng.integers(1, 60)).astype(np.uint64)
        tokens.append(np.unique(np.concatenate([rng.choice(base, 380, replace=False), own])))
    names = np.arange(120)
    edges = ngram_join.links(names, tokens, names, 85)
    parent = list(range(120))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in edges:
        parent[find(b)] = find(a)
    sets = [(i, set(t.tolist())) for i, t in enumerate(tokens)]
    want = linked_components(sets, 85)
    assert len({(find(i), w) for i, w in enumerate(want)}) == len(set(want)) == len({find(i) for i in range(120)})


def test_bounds_hold_for_any_bitmap():
    rng = np.random.default_rng(8)
    for _ in range(50):
        a = np.unique(rng.integers(0, 2**63, rng.integers(1, 6000)).astype(np.uint64))
        b = np.unique(np.concatenate([rng.choice(a, len(a) // 2), rng.integers(0, 2**63, rng.integers(1, 3000)).astype(np.uint64)]))
        log = ngram_join.width(max(len(a), len(b)))
        while log >= 10:
            marks = np.stack([ngram_join.signature(a, log), ngram_join.signature(b, log)])
            hidden = ngram_join.hidden_tokens(marks, np.array([len(a), len(b)]))
            assert np.intersect1d(a, b).size <= int(np.bitwise_count(marks[0] & marks[1]).sum()) + hidden.min()
            log -= 1
            assert log < 10 or np.array_equal(ngram_join.halved(marks), np.stack([ngram_join.signature(a, log), ngram_join.signature(b, log)]))


def test_one_row_of_each_component(spark):
    """Keys that repeat with other texts, rows that repeat and null keys: rows are counted, not keys."""
    one, two, three, four, five = (" ".join(f"t{t}w{i}" for i in range(40)) for t in range(5))
    rows = [(1, one, "a"), (2, one + " more", "a"), (2, two, "b"), (2, three, "c"), (9, three, "c"),  # 2 is a copy of 1, clean, and represents 9
            (5, four, "a"), (5, four, "a"), (5, four, "b"), (None, four, "n"),
            (None, five, "n"), (None, five, "n"), (None, five + " more", "n"), (7, "", "a"), (7, "", "a"), (None, None, "a")]
    docs = documents(spark, rows).repartition(4)
    kept = ngram_join.deduplicated(docs)
    assert kept.columns == docs.columns
    got = [(r["doc_id"], r["text"]) for r in kept.collect()]
    last = [r for r in got if r[0] is None and r[1]]
    assert len(last) == 1 and last[0][1] in (five, five + " more")
    assert sorted(map(repr, set(got) - set(last))) == sorted(map(repr, {(1, one), (2, two), (2, three), (5, four), (7, ""), (None, None)})) and len(got) == 8
