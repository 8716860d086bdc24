import zlib

import numpy as np
import pyarrow as pa
import pytest
from conftest_llm import LONG, ROWS, table_rows
from pyspark.sql import functions as F

from lumenfit.llm import queries, token_store


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(queries.tokenizer_path())


def ids(tokenizer, text):
    return np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [token_store.END], "<u4")


def test_query_is_an_exact_round_trip(spark, sf, tokenizer):
    rows = sorted(queries.op3_token_store(spark, sf).collect())
    docs = sorted(table_rows(sf, "documents"), key=lambda r: r["doc_id"])
    start = 0
    for r, d in zip(rows, docs, strict=True):
        want = ids(tokenizer, d["text"])
        assert tuple(r) == (d["doc_id"], start, len(want), zlib.crc32(want.tobytes()))
        start += len(want)


def test_messy_rows(spark, messy, empty, tokenizer):
    store = token_store.write(messy, queries.tokenizer_path())
    rows = token_store.read(messy, store).collect()
    order = sorted(ROWS, key=lambda r: (r[0] is not None, r[0] or 0))
    assert len(rows) == len(order)
    got = sorted((r["start"], r["doc_id"], bytes(r["ids"])) for r in rows)
    assert [(k, raw) for _, k, raw in got] == [(k, ids(tokenizer, t).tobytes()) for k, t, _ in order]
    missing = spark.createDataFrame([(4,), (77,)], "doc_id long")
    assert {r["doc_id"] for r in token_store.lookup(missing, store).collect()} <= {4}
    nothing = token_store.write(empty, queries.tokenizer_path())
    assert token_store.read(messy, nothing).count() == 0 and token_store.read(empty, nothing).count() == 0


@pytest.mark.parametrize("text", ["It's DON'T we'll", "İstanbul ΣΑΣ ß ﬁ", "a\x1cb\x85c\xa0d", "<|startoftext|>x <|endoftext|>", "é ééé É, ½ 12a3", "日本語 テキスト", "x,,.y? (z)*&%$", "a'sb. c'.", "ª º µ", LONG[:5000]])
def test_cached_words_equal_the_tokenizer(tokenizer, text):
    encoder = token_store.Encoder(queries.tokenizer_path())
    for _ in range(2):
        assert encoder.encode(text) == np.array(tokenizer.encode(text, add_special_tokens=False).ids, encoder.kind).tobytes()


def test_perfect_hash():
    rng = np.random.default_rng(5)
    h1, h2 = (rng.integers(-2**63, 2**63, 5000) for _ in range(2))
    levels = token_store.perfect_hash(h1, h2)
    assert sorted(token_store.ranks(levels, h1, h2)) == list(range(5000))
    assert token_store.perfect_hash(h1[:0], h2[:0]) == []
    with pytest.raises(ValueError):
        token_store.perfect_hash(np.array([1, 1]), np.array([2, 2]))


def test_many_shards(spark, monkeypatch):
    monkeypatch.setattr(token_store, "SHARD_BYTES", 400)
    docs = spark.range(200).select(F.col("id").alias("doc_id"), F.concat(F.lit("word "), F.col("id").cast("string")).alias("text"))
    store = token_store.write(docs, queries.tokenizer_path())
    assert store.shards(spark).count() > 5
    rows = sorted(token_store.read(docs, store).collect())
    assert [r["start"] for r in rows] == np.concatenate([[0], np.cumsum([r["n_tokens"] for r in rows])[:-1]]).tolist()
    assert isinstance(pa.array([1]), pa.Array)


@pytest.mark.parametrize("text", ["a <|ENDOFTEXT|> b", "<|EndOfText|>", "<|STARTOFTEXT|> x <|startoftext|>", "<|endoftext|>", "x<|endoftext|>Y <|endoftext|>"])
def test_added_tokens_in_any_case(tokenizer, text):
    encoder = token_store.Encoder(queries.tokenizer_path())
    assert np.frombuffer(encoder.encode(text), encoder.kind).tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_one_key_over_several_shards_in_any_order(spark, tokenizer, monkeypatch):
    monkeypatch.setattr(token_store, "SHARD_BYTES", 2_000)
    rows = [(5, f"text number {i % 150}") for i in range(400)] + [(9, "the same text")] * 400 + [(1, "first"), (12, "last"), (None, "no key")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = []
    for part in (docs.repartition(3), docs.orderBy(F.desc("text")).repartition(5)):
        store = token_store.write(part, queries.tokenizer_path())
        where = {r["doc_id"]: r for r in token_store.lookup(part, store).collect()}
        assert where[5]["last"] > where[5]["shard"] and where[9]["last"] > where[9]["shard"] and where[9]["records"] == 400
        found.append(sorted(map(tuple, token_store.read(part, store, ids=False).collect()), key=lambda r: r[1]))
    assert found[0] == found[1] and len(found[0]) == len(rows)
    start = 0
    for key, at, n, _ in found[0]:
        assert at == start
        start += n
    wanted = sorted((len(i), zlib.crc32(i.tobytes())) for i in (ids(tokenizer, t) for _, t in rows))
    assert sorted(r[2:] for r in found[0]) == wanted and [r[0] for r in found[0]] == [None, 1] + [5] * 400 + [9] * 400 + [12]
