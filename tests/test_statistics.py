import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from lumenfit.operators import correlation, outliers, profile, quantiles, typing

MOMENTS = [1.0, 2.0, 2.0, 5.0, 9.0, 9.0, 30.0]


def column(spark, values, kind="double", name="x"):
    return spark.createDataFrame([(v,) for v in values], f"{name} {kind}")


def profiled(df, **options):
    return {r["column"]: r for r in profile.profile(df, **options).collect()}


@pytest.mark.parametrize("values, expected", [([3.0, 1.0, 2.0], 2.0), ([4.0, 1.0, 3.0, 2.0], 2.5)])
def test_median(spark, values, expected):
    assert column(spark, values).agg(profile.median("x")).first()[0] == expected


def test_mode_tie_takes_smallest(spark):
    df = column(spark, [2.0, 9.0, 2.0, 9.0])
    assert df.agg(profile.mode("x")).first()[0] == 2.0
    assert profile.mode_table(df, ["x"]).first()["mode"] == 2.0


def test_profile_moments_and_outliers(spark):
    got = profiled(column(spark, MOMENTS))["x"]
    assert got["skew"] == pytest.approx(1.61515299, abs=1e-8)
    assert got["kurtosis"] == pytest.approx(4.22083483, abs=1e-8)
    assert got["std"] == pytest.approx(9.37647948, abs=1e-8)
    assert (got["lower"], got["upper"]) == (2 - 10.5, 9 + 10.5)
    assert (got["outliers"], got["median"], got["n_unique"]) == (1, 5.0, 5)


def test_constant_column(spark):
    got = profiled(column(spark, [7.0, 7.0, 7.0]))["x"]
    assert [got[c] for c in ("std", "skew", "kurtosis", "outliers")] == pytest.approx([0, 0, 0, 0], abs=1e-12)


def test_profile_kinds(spark):
    df = spark.createDataFrame(
        [(1, "a", True, None), (2, "", False, None), (2, "b", True, None), (None, "b", True, None)],
        "n int, t string, b boolean, empty double")
    got = profiled(df)
    assert [got[c]["kind"] for c in ("n", "t", "b", "empty")] == ["numerical", "categorical", "boolean", "numerical"]
    assert got["t"]["mode"] == "b" and got["t"]["missing"] == 1 and got["t"]["n_unique"] == 2
    assert got["b"]["mean"] == 0.75 and got["b"]["mode"] == "1.0"
    assert got["n"]["missing"] == 1 and got["n"]["mean"] == pytest.approx(5 / 3)
    assert got["empty"]["missing"] == 4 and got["empty"]["mean"] is None


def test_nan_policy(spark):
    df = column(spark, MOMENTS + [float("nan")])
    skip, passed = profiled(df)["x"], profiled(df, nan_policy="propagate")["x"]
    assert skip["missing"] == 1 and skip["outliers"] == 1
    assert math.isnan(passed["mean"]) and passed["outliers"] == 0
    with pytest.raises(ValueError):
        profile.profile(df, nan_policy="other")


@pytest.mark.parametrize("seed", [0, 1])
def test_narrowing_equals_numpy(spark, seed):
    rng = np.random.default_rng(seed)
    hot = np.where(rng.random(4000) < 0.35, 3.0, rng.normal(size=4000))  # a third are one value
    skewed = rng.lognormal(sigma=3, size=4000)
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(hot, skewed)], "a double, b double")
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.99, 1.0]
    got = quantiles.exact_percentiles(df, ["a", "b"], probs, small=20, accuracy=30)
    for name, values in (("a", hot), ("b", skewed)):
        np.testing.assert_allclose(got[name], np.quantile(values, probs), rtol=1e-12)
    plain = quantiles.exact_percentiles(df, ["a", "b"], probs)
    np.testing.assert_allclose(plain["b"], got["b"], rtol=1e-12)


def test_profile_is_the_same_beyond_the_small_limit(spark):
    rng = np.random.default_rng(5)
    df = column(spark, [float(v) for v in rng.integers(0, 50, 500)] + [float(v) for v in rng.normal(size=500)])
    assert profiled(df)["x"] == profiled(df, small=10)["x"]


def test_approximate_profile(spark):
    got = profiled(column(spark, MOMENTS), approximate=True)["x"]
    assert got["median"] == 5.0 and got["n_unique"] == 5


def test_summary_and_inspector(spark):
    df = spark.createDataFrame([(1.0, 2.0, "a"), (2.0, 4.0, None), (3.0, 6.0, "b"), (90.0, 180.0, "b"), (2.0, 4.0, "b")],
                               "x double, y double, t string")
    inspector = profile.DataInspector()
    found = inspector.fit(df)
    assert found["n_rows"] == 5 and found["numeric_cols"] == ["x", "y"] and found["categorical_cols"] == ["t"]
    assert found["missing_filled"] == 1 and found["outliers_flagged"] == 2
    pairs = inspector.correlated_pairs(df).collect()
    assert [(r["col_i"], r["col_j"]) for r in pairs] == [("x", "y")] and pairs[0]["r"] == pytest.approx(1)
    assert inspector.outliers(df.withColumn("id", F.lit(1)), ["id"]).count() == 2
    row = profile.profile_summary(inspector.profile).first()
    assert row["n_cols"] == 3 and row["outliers_flagged"] == 2


def test_missing_kinds(spark):
    df = column(spark, ["1", None, "NaN", "", "nan", "  "], "string")
    assert typing.check_nan(df).first()[0] == 5
    assert typing.handle_missing(df).where("x is not null").count() == 1
    assert typing.check_nan(column(spark, [1.0, None, float("nan")])).first()[0] == 2


@pytest.mark.parametrize("text, number", [
    ("1_000", None), ("1d", None), ("inf", None), ("abc", None), (" -2.5e3 ", -2500.0), (".5", 0.5), ("7.", 7.0)])
def test_numeric_text(spark, text, number):
    assert typing.to_numeric(column(spark, [text], "string")).first()[0] == number


def test_column_types(spark):
    df = spark.createDataFrame([("1", "a", True, 1, ""), ("", "2", False, 2, None), ("2.5", "x", True, 3, "nan")],
                               "n string, t string, b boolean, i int, e string")
    assert typing.detect_column_types(df) == {
        "n": "numerical", "t": "categorical", "b": "boolean", "i": "numerical", "e": "categorical"}
    table = {r["column"]: r for r in typing.column_types(df).collect()}
    assert table["t"]["unparsable"] == 2 and table["n"]["missing"] == 1 and table["e"]["kind"] == "categorical"


def test_unsupported_type(spark):
    with pytest.raises(ValueError, match="'d'"):
        typing.detect_column_types(spark.sql("select date'2020-01-01' as d"))


@pytest.mark.parametrize("n, task", [(20, "classification"), (21, "regression"), (500, "regression")])
def test_detect_task(spark, n, task):
    assert typing.detect_task(spark.range(n).withColumnRenamed("id", "y"), "y") == task


def test_validate(spark):
    df = spark.createDataFrame([([1.0, 2.0], 1), ([1.0], 0)], "v array<double>, y int")
    with pytest.raises(ValueError, match="same length"):
        typing.validate_input(df, "v", "y")
    typing.validate_input(df.limit(1), "v", "y")
    with pytest.raises(ValueError, match="not found among"):
        typing.validate_input(df, "v", "z")
    features, target = typing.split_target(df, "y")
    assert features.columns == ["v"] and target.columns == ["y"]


def test_outliers(spark):
    df = spark.createDataFrame(list(enumerate(MOMENTS)), "id int, x double")
    rows = outliers.detect_outliers(df, ["id"]).collect()
    assert [(r["id"], r["column"], r["value"]) for r in rows] == [(6, "x", 30.0)]
    assert outliers.outlier_values(outliers.detect_outliers(df, ["id"]), "x").first()[0] == 30.0
    assert outliers.outlier_counts(df, ["x"]).first()["outliers"] == 1
    assert outliers.bounds_table(df, ["x"]).first()["lower"] == -8.5


def test_correlation(spark):
    rng = np.random.default_rng(1)
    x, y = rng.normal(size=200), rng.normal(size=200)
    z = x + 0.1 * y
    df = spark.createDataFrame([(float(a), float(b), float(c), 7.0) for a, b, c in zip(x, y, z)],
                               "x double, y double, z double, k double")
    got = {(r["col_i"], r["col_j"]): r["r"] for r in correlation.correlation_matrix(df, list("xyzk")).collect()}
    assert len(got) == 16
    expected = np.corrcoef([x, y, z])
    for i, a in enumerate("xyz"):
        for j, b in enumerate("xyz"):
            assert got[a, b] == pytest.approx(expected[i, j], abs=1e-8)
    assert got["k", "k"] == 0 and got["x", "k"] == 0
    plain = {(r["col_i"], r["col_j"]): r["r"] for r in correlation.correlation_matrix(df, list("xk"), guarded=False).collect()}
    assert plain["x", "k"] is None and plain["x", "x"] == pytest.approx(1)
    assert correlation.correlation_matrix(df, ["x"], guarded=False).count() == 0
    pairs = correlation.correlated_pairs(df, list("xyzk")).collect()
    assert [(r["col_i"], r["col_j"]) for r in pairs] == [("x", "z")]


def test_wide_correlation(spark, monkeypatch):
    rng = np.random.default_rng(2)
    rows = [(float(a), None if i % 5 == 0 else float(a + b), float(b), 7.0) for i, (a, b) in enumerate(rng.normal(size=(90, 2)))]
    df = spark.createDataFrame(rows, "x double, y double, z double, k double").repartition(3)
    for guarded in (True, False):
        read = lambda: {(r["col_i"], r["col_j"]): r["r"] for r in correlation.correlation_matrix(df, list("xyzk"), guarded).collect()}
        monkeypatch.setattr(correlation, "WIDE", 24)
        narrow = read()
        monkeypatch.setattr(correlation, "WIDE", 2)
        assert read() == {k: v if v is None else pytest.approx(v, abs=1e-9) for k, v in narrow.items()}
