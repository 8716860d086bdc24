import numpy as np
import pytest
from pyspark.sql import functions as F

from lumenfit.functions import distance, metrics, scalar
from lumenfit.operators import linalg


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


def test_scalars(spark):
    assert one(spark, scalar.safe_divide(F.lit(1.0), F.lit(0.0))) == pytest.approx(1e8)
    assert one(spark, scalar.sigmoid(F.lit(0.0))) == 0.5
    assert one(spark, scalar.sigmoid(F.lit(-10000.0))) > 0
    assert one(spark, scalar.normalize(F.lit(3.0), 1, 2)) == pytest.approx(1)
    assert one(spark, scalar.minmax_scale(F.lit(3.0), 1, 5)) == pytest.approx(0.5)
    assert one(spark, scalar.add_bias([2, 3])) == [1.0, 2.0, 3.0]
    got = one(spark, scalar.softmax([1, 2, 1000]))
    assert sum(got) == pytest.approx(1) and got[2] == pytest.approx(1)
    assert one(spark, scalar.linear([F.lit(1.0), F.lit(2.0), F.lit(3.0)], [1, 10, 100], 0.5)) == 321.5


def test_distances(spark):
    a, b = np.array([1.0, 2.0, 3.0]), np.array([4.0, 0.0, 3.5])
    assert one(spark, distance.euclidean_distance(list(a), list(b))) == pytest.approx(np.linalg.norm(a - b))
    assert one(spark, distance.manhattan_distance(list(a), list(b))) == pytest.approx(np.abs(a - b).sum())
    assert one(spark, distance.minkowski_distance(list(a), list(b))) == pytest.approx((np.abs(a - b) ** 3).sum() ** (1 / 3))
    cosine = a @ b / (np.linalg.norm(a) * np.linalg.norm(b) + 1e-8)
    assert one(spark, distance.cosine_similarity(list(a), list(b))) == pytest.approx(cosine)
    with pytest.raises(ValueError, match="chebyshev"):
        distance.pairwise_distance(list(a), list(b), "chebyshev")


def test_two_class_metrics(spark):
    df = spark.createDataFrame([(1, 1), (0, 1), (1, 0), (1, 1)], "y int, p int")
    row = df.agg(*[m.expr(F.col("y"), F.col("p")).alias(n) for n, m in metrics.METRICS.items()]).first()
    assert row["accuracy"] == 0.5
    for name in ("precision", "recall", "f1"):
        assert row[name] == pytest.approx(2 / 3, abs=1e-6)
    assert metrics.confusion_matrix(df, "y", "p").first()["matrix"] == [[0, 1], [1, 2]]
    assert {(r.truth, r.predicted): r.n for r in metrics.confusion_table(df, "y", "p").collect()} == {
        (1, 1): 2, (0, 1): 1, (1, 0): 1}


def test_regression_metrics(spark):
    y, p = np.array([1.0, 2.0, 4.0]), np.array([1.5, 2.0, 3.0])
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(y, p)], "y double, p double")
    row = df.agg(*[metrics.METRICS[n].expr("y", "p").alias(n) for n in ("mse", "mae", "rmse", "r2")]).first()
    assert row["mse"] == pytest.approx(np.mean((y - p) ** 2)) and row["mae"] == pytest.approx(0.5)
    assert row["rmse"] == pytest.approx(np.sqrt(row["mse"]))
    assert row["r2"] == pytest.approx(1 - ((y - p) ** 2).sum() / (((y - y.mean()) ** 2).sum() + 1e-8))
    constant = spark.createDataFrame([(1.0, 1.0), (1.0, 2.0)], "y double, p double")
    assert constant.agg(metrics.r2_plain("y", "p")).first()[0] is None


def test_weighted_scores(spark):
    df = spark.createDataFrame([(0, 0), (0, 1), (1, 1), (2, 1), (2, 2), (2, 2)], "y int, p int")
    row = metrics.weighted_scores(df, "y", "p").first()
    assert row["recall"] == pytest.approx((2 * 0.5 + 1 * 1 + 3 * 2 / 3) / 6)
    assert row["precision"] == pytest.approx((2 * 1 + 1 * 1 / 3 + 3 * 1) / 6)


@pytest.fixture(scope="module")
def numbers(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(loc=[5, -2, 100], size=(300, 3))
    y = x @ [1.0, 2.0, -0.5] + 4 + rng.normal(scale=0.01, size=300)
    rows = [(*map(float, r), float(v), i % 3) for i, (r, v) in enumerate(zip(x, y))]
    return x, y, spark.createDataFrame(rows, "a double, b double, c double, y double, g int").repartition(3).cache()


def test_moments_both_ways(numbers):
    x, _, df = numbers
    columns = [F.col(c) for c in "abc"]
    for found in (linalg.moments(df, columns, ["g"]), linalg._moments_by_block(df, columns, ["g"])):
        for g in range(3):
            part = x[np.arange(len(x)) % 3 == g]
            assert found[(g,)].n == len(part)
            np.testing.assert_allclose(found[(g,)].mean, part.mean(axis=0))
            np.testing.assert_allclose(found[(g,)].comoment, np.cov(part.T, bias=True) * len(part), atol=1e-8)
        merged = linalg.merge_all(list(found.values()))
        np.testing.assert_allclose(merged.second(), x.T @ x, rtol=1e-10)


def test_products(spark, numbers):
    x, y, df = numbers
    gram = {(r.i, r.j): r.v for r in linalg.gramian(df, ["a", "b", "c"]).collect()}
    for i in range(3):
        for j in range(3):
            assert gram[i, j] == pytest.approx((x.T @ x)[i, j])
    a = np.arange(6.0).reshape(2, 3)
    b = np.array([[1.0, 0.0], [2.0, 1.0], [0.0, -1.0]])
    long = lambda m: spark.createDataFrame([(i, j, float(v)) for (i, j), v in np.ndenumerate(m)], "i int, j int, v double")
    product = {(r.i, r.j): r.v for r in linalg.matrix_product(long(a), long(b)).collect()}
    assert all(product[i, j] == (a @ b)[i, j] for i in range(2) for j in range(2))
    assert {(r.i, r.j): r.v for r in linalg.transpose(long(a)).collect()} == {(j, i): v for (i, j), v in np.ndenumerate(a)}
    s = np.array([[2.0, 1.0], [1.0, 3.0]])
    right = spark.createDataFrame([(0, 1.0), (1, 2.0)], "i int, v double")
    got = [r.v for r in linalg.solve(long(s), right).orderBy("i").collect()]
    np.testing.assert_allclose(got, np.linalg.solve(s, [1, 2]))


def test_gradient_and_least_squares(numbers):
    x, y, df = numbers
    w, b = np.array([0.1, 0.2, 0.3]), 0.5
    error = x @ w + b - y
    got = {r.feature: r.value for r in linalg.gradient(df, ["a", "b", "c"], "y", list(w), b).collect()}
    np.testing.assert_allclose([got[c] for c in "abc"], x.T @ error / len(y))
    assert got["bias"] == pytest.approx(error.mean())
    fit = {r.feature: r.value for r in linalg.least_squares(df, ["a", "b", "c"], "y").collect()}
    expected = np.linalg.lstsq(np.c_[x, np.ones(len(x))], y, rcond=None)[0]
    np.testing.assert_allclose([fit[c] for c in ("a", "b", "c", "intercept")], expected, rtol=1e-6)


def test_tiles_against_numpy(spark):
    rng = np.random.default_rng(2)
    a, b = rng.normal(size=(23, 31)), rng.normal(size=(31, 17))
    a[rng.random(a.shape) < 0.6] = 0
    long = lambda m: spark.createDataFrame([(int(i), int(j), float(v)) for (i, j), v in np.ndenumerate(m) if v], "i long, j long, v double")
    product = np.zeros((23, 17))
    for r in linalg.tiled_product(long(a), long(b), tile=5, inner_tiles=2).collect():
        product[r.i, r.j] = r.v
    np.testing.assert_allclose(product, a @ b, atol=1e-12)
    assert linalg.tiled_product(long(a).limit(0), long(b)).count() == 0


@pytest.mark.parametrize("inner", [64, 1])
def test_rows_of_a_product_without_its_entries(spark, monkeypatch, inner):
    rng = np.random.default_rng(4)
    a, b = rng.integers(-2, 3, size=(23, 9)).astype(float), rng.integers(-2, 3, size=(9, 17)).astype(float)
    long = lambda m: spark.createDataFrame([(int(i), int(j), float(v)) for (i, j), v in np.ndenumerate(m) if v], "i long, j long, v double")
    x, y = long(a), long(b)
    x = x.union(x.where("i = 3"))  # a key that repeats adds up
    a[3] *= 2
    if inner > 1:  # the table of entries must not be made
        monkeypatch.setattr(linalg, "_tile_products", None)
    product = a @ b
    expected = {i: (row.sum(), row[row != 0].max(), int((row != 0).sum())) for i, row in enumerate(product) if row.any()}
    for cells in (30, 10_000):
        found = {r.i: (r.total, r.most, r.n) for r in linalg.product_rows(x, y, tile=3, inner_tiles=inner, cells=cells).collect()}
        assert found == expected
    assert linalg.product_rows(x.limit(0), y).count() == 0


def test_triangle_of_ill_conditioned_columns(spark):
    """Products of these columns lose the third one to rounding; their triangular factor does not."""
    rng = np.random.default_rng(3)
    x = rng.normal(size=(4_000, 2))
    near = x[:, 0] + 1e-9 * x[:, 1]
    y = 3 * near - 2 * x[:, 0] + 5
    df = spark.createDataFrame([(float(p), float(q), float(t)) for p, q, t in zip(x[:, 0], near, y)], "a double, n double, y double").repartition(40)
    found = {r.feature: r.value for r in linalg.least_squares(df, ["a", "n"], "y").collect()}
    assert found["n"] == pytest.approx(3, abs=1e-4) and found["a"] == pytest.approx(-2, abs=1e-4) and found["intercept"] == pytest.approx(5, abs=1e-8)
    r = linalg.triangle(df, [F.col("a"), F.col("n")], fan=3)
    np.testing.assert_allclose(r.T @ r, np.stack([x[:, 0], near]) @ np.stack([x[:, 0], near]).T, rtol=1e-10)
