import re
from collections import Counter, defaultdict

import pytest
from conftest_llm import LOWER, documents, prose, table_rows
from pyspark.sql import functions as F

from lumenfit.llm import divergence

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def brute(rows, min_docs=10, top=10):
    """``rows`` are (lang, source, text)."""
    counts, df = defaultdict(Counter), defaultdict(Counter)
    for lang, source, text in rows:
        words = TERM.findall((text or "").translate(LOWER))
        counts[lang or "", source or ""].update(words)
        df[lang or ""].update(set(words))
    kept = {lang: sorted((t for t, n in c.items() if n >= min_docs), key=str.encode) for lang, c in df.items()}

    def shares(c, terms):
        n = sum(c[t] for t in terms)
        return [1 + 10**9 * (c[t] + 2) // (n + 2 * len(terms)) for t in terms]

    out = set()
    p = {g: shares(c, kept[g[0]]) for g, c in counts.items()}
    apart = lambda a, b: (a - b) ** 2 // (a + b)
    for lang, source in counts:
        pairs = [(-sum(map(apart, p[lang, source], p[g])), g[1]) for g in counts if g[0] == lang and g[1] != source]
        whole = sum((c for g, c in counts.items() if g[0] == lang), Counter())
        terms = [(-apart(x, y), t) for t, x, y in zip(kept[lang], p[lang, source], shares(whole, kept[lang])) if counts[lang, source][t] and x > y]
        for part, found, most in (("pair", pairs, None), ("term", terms, top)):
            for rank, (value, item) in enumerate(sorted(found, key=lambda x: (x[0], x[1].encode()))[:most], 1):
                out.add((lang, source, part, item, -value, rank))
    return out


def rows(df):
    found = [tuple(r[c] for c in ("lang", "source", "part", "item", "value", "rank")) for r in df.collect()]
    assert len(found) == len(set(found))
    return set(found)


def test_given_table_in_any_order_and_tile(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    wanted = brute([(r["lang"], r["source"], r["text"]) for r in table_rows(sf, "documents")])
    assert rows(divergence.audit(docs, tile=300)) == wanted
    assert rows(divergence.audit(docs.orderBy(F.desc("text")).repartition(7))) == wanted


def test_messy_rows(spark, messy, empty):
    wanted = brute([(r["lang"], r["source"], r["text"]) for r in messy.collect()], 2)
    assert rows(divergence.audit(messy, min_docs=2)) == wanted and wanted
    # without kept terms pairs remain, at 0
    bare = rows(divergence.audit(messy, min_docs=1000))
    assert bare == brute([(r["lang"], r["source"], r["text"]) for r in messy.collect()], 1000) and {r[4] for r in bare} == {0}
    assert rows(divergence.audit(empty)) == set()


def test_null_groups_and_one_source(spark):
    docs = spark.createDataFrame([(1, "a b", None, None), (2, "a", "", "x"), (3, "b", None, "x"), (4, "c", "de", "x"), (5, None, "de", "x")], "doc_id long, text string, lang string, source string")
    assert rows(divergence.audit(docs, min_docs=1)) == brute([(r["lang"], r["source"], r["text"]) for r in docs.collect()], 1)


def test_term_counts(spark):
    docs = documents(spark, [(i, prose(i % 7, 30), "ab"[i % 2]) for i in range(40)])
    found = {r["term"]: r for r in divergence.term_counts(docs, min_docs=3).collect()}
    df, n = Counter(), Counter()
    for r in docs.collect():
        words = TERM.findall(r["text"].translate(LOWER))
        df.update(set(words))
        n.update(words)
    assert set(found) == {t for t, k in df.items() if k >= 3}
    for t, r in found.items():
        assert (r["docs"], sum(s["n"] for s in r["sources"]), r["n_sources"]) == (df[t], n[t], len(r["sources"]))


def test_counts_beyond_64_bits():
    import numpy as np

    counts = np.array([[3 * 10**12, 1]])
    assert divergence._shares(counts, np.array([3 * 10**12 + 1] * 2), 2).tolist() == [[1 + 10**9 * (c + 2) // (3 * 10**12 + 5) for c in counts[0].tolist()]]


@pytest.mark.parametrize("width", [1, 30])
def test_many_sources(spark, width):
    docs = documents(spark, [(i, prose(i % 11, 25), f"s{i % width}") for i in range(90)])
    assert rows(divergence.audit(docs, tile=10)) == brute([(r["lang"], r["source"], r["text"]) for r in docs.collect()])
