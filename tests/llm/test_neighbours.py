import numpy as np
import pytest
from conftest_llm import table_rows

from lumenfit.llm import neighbours, queries


def exact(rows, k=20, every=20):
    ids = np.array([r[0] for r in rows])
    vectors = np.array([r[1] for r in rows], float)
    out = {}
    for q in ids[ids % every == 0]:
        scores = (vectors * vectors[ids == q][0]).sum(1)
        order = [i for i in np.lexsort((ids, -scores)) if ids[i] != q][:k]
        out[int(q)] = [(int(ids[i]), scores[i]) for i in order]
    return out


def test_recall_of_the_query(spark):
    sf = "/root/testdata/sf0.1"
    want = exact([(r["vec_id"], r["embedding"]) for r in table_rows(sf, "embeddings")])
    got = {}
    for r in sorted(queries.op7_neighbours(spark, sf).collect()):
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    assert set(got) == set(want)
    recall = np.mean([len({v for _, v, _ in got[q]} & {v for v, _ in want[q]}) / len(want[q]) for q in want])
    assert recall >= 0.9
    for q, rows in got.items():
        assert [r[0] for r in rows] == list(range(1, 21)) and rows == sorted(rows, key=lambda r: (-r[2], r[1]))


def test_several_shards_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "SHARD", 300)
    monkeypatch.setattr(neighbours, "BLOCK", 20)
    monkeypatch.setattr(neighbours, "SAMPLE", 100)
    rng = np.random.default_rng(4)
    rows = [(i, (rng.normal(size=16) * (1 + i % 4)).tolist()) for i in range(1500)]
    want = exact(rows)
    got = neighbours.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    hits = sum(r["vec_id"] in {v for v, _ in want[r["query_id"]]} for r in got)
    assert len(got) == 20 * len(want) and hits / len(got) >= 0.9


def test_copies_nulls_and_short_tables(spark):
    v = [1.0, 2.0, 3.0]
    rows = [(i, v) for i in range(100)] + [(200, None), (201, [0.0, 0.0, 0.0]), (202, [1.0, None, 2.0]), (203, [float("nan"), 1.0, 1.0]), (204, [float("inf"), 1.0, 1.0]),
            (None, v), (220, [3.0, 2.0, 1.0]), (240, [1.0, 2.0]), (0, v)]
    table = spark.createDataFrame([(i, x, 1, 2.0) for i, x in rows], "vec_id long, embedding array<double>, rank int, score double")
    got = {}
    for r in sorted(neighbours.nearest(table).collect()):
        got.setdefault(r["query_id"], []).append(r["vec_id"])
    assert set(got) == {0, 20, 40, 60, 80, 220}
    assert got[0] == list(range(1, 21)) and got[40] == list(range(20)) and got[220] == list(range(20))
    few = neighbours.nearest(spark.createDataFrame([(0, v), (1, v), (2, [1.0, 1.0, 1.0])], "vec_id long, embedding array<double>")).collect()
    assert [(r["rank"], r["vec_id"]) for r in sorted(few)] == [(1, 1), (2, 2)]
    assert neighbours.nearest(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


@pytest.mark.parametrize("x, p", [(7.344, 0.5), (15.507, 0.95), (20.09, 0.99)])
def test_chi_square(x, p):
    assert neighbours.chi_square(np.array([x]))[0] == pytest.approx(p, abs=1e-3)
    assert neighbours.stopping_ratio(p) == pytest.approx(x, rel=1e-3)
