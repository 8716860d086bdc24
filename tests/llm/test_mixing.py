from collections import defaultdict

import pytest
from conftest_llm import table_rows, documents, prose

from lumenfit.llm import mixing, queries


def expected_targets(sizes, weights=(1, 2, 3), cap=3):
    """The contract step by step: share, cap, share the excess again."""
    names = sorted([s for s in sizes if s is not None]) + ([None] if None in sizes else [])
    weight = {s: weights[i % 3] for i, s in enumerate(names)}
    target, full, left = {}, set(), sum(sizes.values())
    while True:
        rest = [s for s in names if s not in full]
        total = sum(weight[s] for s in rest)
        share = {s: left * weight[s] / total for s in rest} if total else {}
        over = [s for s in rest if share[s] > cap * sizes[s]]
        if not over:
            return target | share
        for s in over:
            target[s] = cap * sizes[s]
            left -= target[s]
            full.add(s)


def test_query_against_brute_force(spark, sf):
    docs = {r["doc_id"]: r for r in table_rows(sf, "documents")}
    rows = queries.op1_mixing(spark, sf).collect()
    assert len(rows) == len(docs)
    sizes, taken, target = defaultdict(int), defaultdict(int), {}
    for r in rows:
        source, size = docs[r["doc_id"]]["source"], len((docs[r["doc_id"]]["text"] or "").split())
        assert r["size"] == size and r["taken"] <= 3 * size and r["taken"] == r["copies"] * size
        sizes[source] += size
        taken[source] += r["taken"]
        target[source] = r["target"]
    assert target == pytest.approx(expected_targets(sizes))
    for s in sizes:
        assert abs(taken[s] - target[s]) <= max(0.05 * target[s], 60)
    assert sorted(rows) == sorted(queries.op1_mixing(spark, sf).collect())


def test_messy_rows(messy):
    rows = mixing.mix(messy).collect()
    assert len(rows) == messy.count()
    by = {(r["doc_id"], r["source"]): r for r in rows}
    assert by[2, "a"]["size"] == by[3, "b"]["size"] == by[7, "c"]["size"] == 0
    assert by[4, None]["source_size"] == 100
    out = mixing.mixed_documents(messy)
    assert out.columns == messy.columns
    assert out.count() == sum(r["copies"] for r in rows)


def test_empty_and_wordless(spark, empty):
    assert mixing.mix(empty).count() == 0
    assert mixing.mixed_documents(empty).count() == 0
    assert [r["taken"] for r in mixing.mix(documents(spark, [(1, None, "a"), (2, "", None)])).collect()] == [0, 0]


def test_two_margins(spark):
    """Several margins at once: the dual's solution meets all of them."""
    cells = spark.createDataFrame([("a", "x", 100), ("a", "y", 50), ("b", "x", 30), ("b", "y", 120)], "s string, l string, cell_size long")
    by_s = spark.createDataFrame([("a", 180.0), ("b", 120.0)], "s string, target double")
    by_l = spark.createDataFrame([("x", 160.0), ("y", 140.0)], "l string, target double")
    rows = mixing.balance(cells, {"s": by_s, "l": by_l}, 3.0, tolerance=1e-4).collect()
    mass = lambda c, v: sum(r["cell_size"] * r["rate"] for r in rows if r[c] == v)
    assert mass("s", "a") == pytest.approx(180, rel=1e-2) and mass("l", "x") == pytest.approx(160, rel=1e-2)


def test_hot_source_is_rounded_in_cells(spark):
    docs = documents(spark, [(i, prose(i, 5 + i % 40), "hot" if i % 3 else f"s{i % 7}") for i in range(900)])
    rows = mixing.mix(docs, rows_per_cell=50).collect()
    for s in {r["source"] for r in rows}:
        own = [r for r in rows if r["source"] == s]
        assert abs(sum(r["taken"] for r in own) - own[0]["target"]) <= 60


def test_rows_that_share_key_source_and_size_are_decided_one_by_one(spark, monkeypatch):
    monkeypatch.setattr(mixing, "CHUNK", 64)
    rows = [(None, prose(0, 10), "a")] * 700 + [(None, prose(i, 10), "a") for i in range(300)] + [(i, prose(i, 20), "b") for i in range(200)] + [(7, prose(1, 30), "c")] * 40
    docs = documents(spark, rows).repartition(5)
    plan = mixing.mix(docs).collect()
    assert len(plan) == len(rows)
    for s in "abc":
        own = [r for r in plan if r["source"] == s]
        assert abs(sum(r["taken"] for r in own) - own[0]["target"]) <= 60 and all(r["taken"] <= 3 * r["size"] for r in own)
    out = [(r["doc_id"], r["text"], r["source"]) for r in mixing.mixed_documents(docs).collect()]
    count, given = defaultdict(int), defaultdict(int)
    for r in out:
        count[r] += 1
    for r in rows:
        given[r] += 1
    assert all(n <= 3 * given[r] for r, n in count.items())
    for s in "abc":
        assert sum(len(t.split()) for _, t, x in out if x == s) == sum(r["taken"] for r in plan if r["source"] == s)
    again = mixing.mixed_documents(docs.orderBy("text").repartition(3))
    assert sorted(map(str, out)) == sorted(str((r["doc_id"], r["text"], r["source"])) for r in again.collect())
