import math
import random
import re
from collections import Counter

import pytest
from conftest_llm import LOWER, documents, prose, table_rows

from lumenfit.llm import lexical

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(docs, items, k=10):
    """``docs`` and ``items`` are (key, text); ranked (item, rank, key, score)."""
    counts = [(key, Counter(terms(text))) for key, text in docs]
    n = sum(1 for _, c in counts if c)
    total = sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    asked = {}
    for item, text in items:
        asked.setdefault(item, set()).update(terms(text))
    out = set()
    for item, words in asked.items():
        scores = []
        for key, c in counts:
            m = 10 + 90 * sum(c.values()) * n // total if c else 0
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t in words if c[t])
            if score > 0:
                scores.append((-score, key is None, key))
        out |= {(item, rank, key, -score) for rank, (score, _, key) in enumerate(sorted(scores, key=lambda x: (x[0], x[1], x[2] or 0))[:k], 1)}
    return out


def rows(df):
    found = [tuple(r[c] for c in ("item_id", "rank", "doc_id", "score")) for r in df.collect()]
    assert len(found) == len(set(found))
    return set(found)


@pytest.fixture()
def small_shards(monkeypatch):
    monkeypatch.setattr(lexical, "WINDOW", 16)
    monkeypatch.setattr(lexical, "BLOCK", 4)


def test_given_tables(spark, sf):
    docs, items = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/benchmark.parquet")
    index = lexical.build(docs.repartition(5))
    wanted = brute([(r["doc_id"], r["text"]) for r in table_rows(sf, "documents")], [(r["item_id"], r["text"]) for r in table_rows(sf, "benchmark")])
    assert rows(lexical.search(index, items)) == wanted
    # items in several blocks, and another number of documents
    assert rows(lexical.search(index, items, items=7, k=3)) == {r for r in wanted if r[1] <= 3}


def test_one_shard_against_every_document(small_shards):
    """Essential lists, block bounds and windows of one shard, all on the driver, against scoring everything."""
    import numpy as np
    import pyarrow as pa

    from lumenfit.llm.common import ALNUM
    from lumenfit.llm.pointers import Pointers

    rng = random.Random(7)
    words = [f"w{i}" for i in range(30)]
    texts = [" ".join(rng.choices(words, weights=[1 / (i + 1) for i in range(30)], k=rng.randint(0, 60))) for _ in range(300)]
    texts[10:14] = [texts[9]] * 4
    p = Pointers(pa.array(texts), ALNUM)
    edge, tf = p.runs(p.rows)
    packed = [x.to_pylist() for x in lexical.packed(p.word[edge], p.rows[edge], tf, p.per_row[p.rows[edge]])]
    scoring = lexical.Scoring(sum(1 for t in texts if t), int(p.per_row.sum()))
    df = np.bincount(p.word[edge])
    lists = {w: lexical.List(*(c[i] for c in packed), scoring.weight(int(df[i])), scoring, p.per_row) for i, w in enumerate(p.words().to_pylist())}
    skipped = 0
    for query in ([rng.sample(words, k) for k in (1, 2, 5, 12, 30)] + [["w0", "w29"]]) * 3:
        asked = [lists[w] for w in query if w in lists]
        for x in asked:
            x.unpacked.clear()
        found = lexical.best_of(asked, len(texts), 10)
        wanted = sorted((rank, key, score) for _, rank, key, score in brute(list(enumerate(texts)), [(0, " ".join(query))]))
        assert [(i, place, score) for i, (score, place) in enumerate(found, 1)] == wanted
        skipped += sum(len(x.heads) - len(x.unpacked) for x in asked)
    assert skipped > 0  # some blocks were never unpacked


def test_messy_rows(spark, messy, empty):
    items = spark.createDataFrame([(1, prose(4, 50)), (2, None), (3, ""), (None, prose(1, 5)), (4, "alpha0 none"), (4, prose(2, 9)), (5, "zzz unseen"), (1, prose(4, 50))], "item_id long, text string")
    wanted = brute([(r["doc_id"], r["text"]) for r in messy.collect()], [(r["item_id"], r["text"]) for r in items.collect()])
    found = lexical.search(lexical.build(messy), items).collect()
    # equal rows have equal ranks' worth of places: compare with repeats
    assert sorted(map(str, ((r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in found))) == sorted(map(str, wanted))
    assert rows(lexical.search(lexical.build(empty), items)) == set()
    assert rows(lexical.search(lexical.build(messy), items.limit(0))) == set()


def test_ties_go_to_the_smaller_key(spark):
    docs = documents(spark, [(k, "same words here", "a") for k in range(50, 0, -1)] + [(None, "same words here", "a"), (99, "other text", "b")]).repartition(4)
    items = spark.createDataFrame([("q", "words")], "item_id string, text string")
    assert [r["doc_id"] for r in lexical.search(lexical.build(docs), items).orderBy("rank").collect()] == list(range(1, 11))


def test_lengths_beyond_64_bits():
    import numpy as np

    scoring, n = lexical.Scoring(10**12, 10**15), 10**9
    assert scoring.term(np.array([5]), np.array([n])).tolist() == [5 * 10**9 // (5000 + 8 * (10 + 90 * n * 10**12 // 10**15))]
