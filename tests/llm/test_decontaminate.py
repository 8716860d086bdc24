import hashlib
import re

import pytest
from conftest_llm import LOWER, documents, prose, table_rows

import __spark_entry__ as entry
from check_oracles import compare, connection
from lumenfit.llm import decontaminate, queries

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def brute(docs, items):
    windows = {}
    for item, text in items:
        w = words(text)
        n = min(10, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            windows.setdefault(tuple(w[i:i + n]), set()).add(item)
    out = {}
    for key, text in docs:
        w, hit, found = words(text), set(), set()
        for n in {len(x) for x in windows}:
            for i in range(len(w) - n + 1):
                if tuple(w[i:i + n]) in windows:
                    hit.update(range(i, i + n))
                    found |= windows[tuple(w[i:i + n])]
        ids = ",".join(sorted(str(x) for x in found))
        out[key] = (len(w), len(hit), len(found), hashlib.sha256(ids.encode()).hexdigest(), bool(hit))
    return out


def test_query_against_sql_and_brute_force(spark, sf):
    name = "op5_decontamination"
    assert compare(spark, connection(sf), sf, name, queries.QUERIES[name], entry.oracle_sql()[name])[0].startswith("ok")
    want = brute([(r["doc_id"], r["text"]) for r in table_rows(sf, "documents")], [(r["item_id"], r["text"]) for r in table_rows(sf, "benchmark")])
    got = {r["doc_id"]: tuple(r)[1:] for r in queries.op5_decontamination(spark, sf).collect()}
    assert got == want and any(r[4] for r in got.values())


@pytest.mark.parametrize("limit", [decontaminate.BLOCK_BYTES, 60])
def test_messy_rows(spark, messy, empty, monkeypatch, limit):
    monkeypatch.setattr(decontaminate.blocks, "__defaults__", ("item_id", "text", limit))
    items = [(1, prose(1, 40)), (2, "alpha3"), (3, None), (4, ""), (5, prose(4, 12)), (5, prose(4, 12)), (None, prose(2, 30)), (6, "ALPHA3, beta!"), (7, prose(3, 60_000)[500:700])]
    bench = spark.createDataFrame(items, "item_id long, text string")
    rows = decontaminate.contamination(messy, bench).collect()
    docs = messy.select("doc_id", "text").collect()
    want = brute([((d[0], d[1]), d[1]) for d in docs], [("" if i is None else i, t) for i, t in items])
    texts = {(r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"], r["contaminated"]) for r in rows}
    assert len(rows) == len(docs) and texts == set(want.values())
    clean = decontaminate.clean(messy, bench)
    assert clean.columns == messy.columns and clean.count() == sum(not want[d[0], d[1]][4] for d in docs)
    spans = decontaminate.matches(messy, bench).collect()
    assert sum(e - s for r in spans for s, e in zip(r["starts"], r["ends"])) == sum(want[d[0], d[1]][1] for d in docs)
    assert decontaminate.contamination(empty, bench).count() == 0
    none = spark.createDataFrame([], bench.schema)
    assert not any(r["contaminated"] for r in decontaminate.contamination(messy, none).collect())


def test_passage_in_documents_far_apart(spark):
    passage = " ".join(f"passage{i}" for i in range(40))
    docs = documents(spark, [(i, f"{prose(i, 200)} {passage if i % 3 == 0 else ''} {prose(i + 5, 100)}", "a") for i in range(30)]).repartition(5)
    bench = spark.createDataFrame([(1, passage)], "item_id long, text string")
    rows = {r["doc_id"]: r for r in decontaminate.contamination(docs, bench).collect()}
    for i, r in rows.items():
        assert r["contaminated"] == (i % 3 == 0)
        if r["contaminated"]:
            assert r["longest_words"] >= 40
