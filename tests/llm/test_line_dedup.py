import pytest
from conftest_llm import documents

import __spark_entry__ as entry
from check_oracles import compare, connection
from lumenfit.llm import line_dedup, queries


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_query_against_sql(spark, sf):
    name = "op8_line_dedup"
    assert compare(spark, connection(sf), sf, name, queries.QUERIES[name], entry.oracle_sql()[name])[0].startswith("ok")


def test_threshold_is_exact_near_it(spark):
    rows = [(i, f"line on nine\nown {i}", f"s{i}") for i in range(9)] + [(100 + i, f" line on ten \r\nown too {i}", f"s{i}") for i in range(10)]
    got = {r["doc_id"]: r for r in line_dedup.dedup_lines(documents(spark, rows), min_sites=10).collect()}
    assert all(got[i]["n_removed"] == 0 for i in range(9))
    assert all(got[100 + i]["text"] == f"own too {i}" for i in range(10))


def test_same_site_does_not_spread(spark):
    got = line_dedup.dedup_lines(documents(spark, [(i, "again and again", "one") for i in range(50)] + [(99, "again and again", None)])).collect()
    assert {r["n_removed"] for r in got} == {0}


def test_sketches_decide_far_from_the_threshold(spark):
    rows = [(i, f"everywhere\n\nonly {i}", f"s{i}") for i in range(400)]
    got = line_dedup.dedup_lines(documents(spark, rows)).collect()
    assert {r["n_removed"] for r in got} == {1} and {r["text"] for r in got} == {f"\nonly {i}" for i in range(400)}


def test_messy_rows(messy, empty):
    rows = line_dedup.dedup_lines(messy, min_sites=2).collect()
    assert len(rows) == messy.count()
    by = {r["doc_id"]: r for r in rows}
    assert by[2]["text"] is None and by[2]["n_lines"] == 0 and by[3]["text"] == "" and by[7]["n_lines"] == 0
    assert by[1]["text"] == "" and by[1]["n_removed"] == 1  # the same line on sources a and b
    assert by[4]["n_removed"] == 0  # no source, and a line of its own
    assert line_dedup.dedup_lines(empty).count() == 0


@pytest.mark.parametrize("rows, places", [(1_000_000, 8_000_000), (0, 0)])
def test_long_copies_in_linear_time(spark, monkeypatch, rows, places):
    """Copies of a text of many lines, most of which go; with broadcasts and, forbidden those, with salted joins."""
    import time

    monkeypatch.setattr(line_dedup, "BROADCAST_ROWS", rows)
    monkeypatch.setattr(line_dedup, "BROADCAST_PLACES", places)
    text = "\n".join(f"line {i}" if i % 3 else f"own {i}" for i in range(30_000))
    docs = documents(spark, [(i, text if i % 2 else text.replace("own", f"own{i}"), f"s{i}") for i in range(12)])
    start = time.time()
    found = {r["doc_id"]: r for r in line_dedup.dedup_lines(docs).collect()}
    assert time.time() - start < 120
    for i, r in found.items():
        kept = [line for line in (text if i % 2 else text.replace("own", f"own{i}")).split("\n") if not line.startswith("line")]
        assert r["n_lines"] == 30_000 and r["n_removed"] == 20_000 and r["text"] == "\n".join(kept)
