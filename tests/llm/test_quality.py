import zlib

import numpy as np
import pytest
from conftest_llm import table_rows

from lumenfit.llm import quality, queries


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    rows = {r["doc_id"]: r for r in queries.op2_quality(spark, sf).collect()}
    assert len(rows) == len(table_rows(sf, "documents"))
    for i, r in rows.items():
        assert r["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3)
    held = [(r["quality"], rows[r["doc_id"]]["predicted"]) for r in table_rows(sf, "labels") if rows[r["doc_id"]]["held_out"]]
    assert np.mean([a == b for a, b in held]) > 0.9
    assert np.mean([b for a, b in held if a == 1]) > 0.95


def test_messy_rows(spark, messy, empty):
    labels = spark.createDataFrame([(1, 1), (4, 0), (None, 1), (5, None), (8, 1)], "doc_id long, quality int")
    model = quality.fit(messy, labels)
    rows = quality.score(messy, model).collect()
    assert len(rows) == messy.count() and all(0 <= r["score"] <= 1 for r in rows)
    by = {r["doc_id"]: r["score"] for r in rows}
    assert by[2] == by[3]  # null reads as empty
    assert quality.score(empty, model).count() == 0
    kept = quality.accepted(messy, model, 0.0)
    assert kept.columns == messy.columns and kept.count() == messy.count()
    assert {r["doc_id"] for r in quality.accepted(messy, model, 0.5).collect()} == {k for k, v in by.items() if v >= 0.5}


def test_without_labels_nothing_is_rejected(spark, messy):
    model = quality.fit(messy, spark.createDataFrame([], "doc_id long, quality int"))
    assert {r["score"] for r in quality.score(messy, model).collect()} == {0.5}


def test_gradient():
    """Training must lower the loss of a bag that only one passage explains, and attend to it."""
    rng = np.random.default_rng(1)
    counts = rng.integers(1, 6, 300)
    x = rng.normal(0, 0.1, (counts.sum(), quality.N_FEATURES))
    labels, at = rng.integers(0, 2, 300).astype(float), 0
    ends = np.cumsum(counts)
    for label, end, n in zip(labels, ends, counts):
        if not label:
            x[end - 1 - at % n, 3] += 2
        at += 1
    model = quality.train(x, counts, labels)
    assert np.mean((model.score(x, counts) >= 0.5) == labels) > 0.97


@pytest.mark.parametrize("text, count", [("", 1), ("a", 1), (" ".join(["w"] * 64), 1), (" ".join(["w"] * 65), 2)])
def test_passages(text, count):
    data = np.frombuffer(text.encode(), np.uint8)
    x, counts = quality.encode(data, np.array([0, len(data)]))
    assert counts.tolist() == [count] and len(x) == count


def plain_score(text, model):
    """One text, one passage, one feature at a time."""
    import math
    import re

    data = (text or "").encode()
    found = [(m.start(), m.group()) for m in re.finditer(rb"[^\x20\x09-\x0D]+", data)]
    low = [w.translate(bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")) for _, w in found]
    bags = []
    for at in range(0, max(len(found), 1), quality.PASSAGE):
        x = np.zeros(quality.N_FEATURES)
        part = found[at:at + quality.PASSAGE]
        if part:
            begin = 0 if at == 0 else part[0][0]
            end = found[at + quality.PASSAGE][0] if at + quality.PASSAGE < len(found) else len(data)
            for c in data[begin:end]:
                x[quality.CLASS[c]] += 1 / (end - begin)
            x = np.sqrt(x)
            n = len(part)
            x[quality.N_CLASS:] = [
                sum(i > 0 and data[i] == data[i - 1] and data[i] not in b" \t\n\x0b\x0c\r" for i in range(begin, end)) / (end - begin),
                math.log1p(sum(len(w) for _, w in part) / n), sum(65 <= w[0] <= 90 for _, w in part) / n,
                sum(w[-1] < 128 and not chr(w[-1]).isalnum() and 33 <= w[-1] < 127 for _, w in part) / n,
                sum(i >= 1 and low[i] == low[i - 1] for i in range(at, at + n)) / n, sum(i >= 2 and low[i] == low[i - 2] for i in range(at, at + n)) / n,
                len(set(low[at:at + n])) / n, math.log1p(n) / 4]
        bags.append((x.astype(np.float32) - model.mean) / model.scale)
    p = model.weights
    hidden = [np.tanh(x @ p["W"] + p["b"]) for x in bags]
    gates = [float((np.tanh(h @ p["V"]) / (1 + np.exp(-(h @ p["U"])))) @ p["w"]) for h in hidden]
    attention = np.exp(np.array(gates) - max(gates))
    z = sum(a * h for a, h in zip(attention / attention.sum(), hidden))
    return float(1 / (1 + np.exp(-(z @ p["c"] + p["d"][0]))))


def test_scores_against_a_loop_over_passages(spark, sf, messy):
    model = queries.quality_model(spark, sf)
    texts = {r["doc_id"]: r["text"] for r in table_rows(sf, "documents")}
    rows = queries.op2_quality(spark, sf).collect()
    for r in rows[::4]:
        assert r["score"] == pytest.approx(plain_score(texts[r["doc_id"]], model), abs=1e-5)
    odd = [(r["doc_id"], r["text"]) for r in messy.select("doc_id", "text").collect() if r["text"] is None or len(r["text"]) < 5_000]
    found = sorted(r["score"] for r in quality.score(messy.where("text is null or length(text) < 5000"), model).collect())
    assert found == pytest.approx(sorted(plain_score(t, model) for _, t in odd), abs=1e-5)
