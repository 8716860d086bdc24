"""Columns of more categories than columns should hold: the same meaning at any width."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from lumenfit.models.base import Matrix
from lumenfit.models.knn import KNearestNeighbors
from lumenfit.models.linear import LinearRegression
from lumenfit.models.logistic import LogisticRegression
from lumenfit.models.naive_bayes import GaussianNB
from lumenfit.models.tree import DecisionTree, RandomForest
from lumenfit.operators import prepare
from lumenfit.operators.sparse import SparseOneHot
from lumenfit.operators.split import kfold

FAMILIES = [
    (LinearRegression, {"lr": 0.01, "epochs": 30}, "z"), (LogisticRegression, {"lr": 0.1, "epochs": 30}, "y"), (GaussianNB, {"var_smoothing": 1e-2}, "y"),
    (KNearestNeighbors, {"k": 3}, "y"), (KNearestNeighbors, {"k": 4, "metric": "manhattan", "task": "regression"}, "z"),
    (DecisionTree, {"max_depth": 3}, "y"), (DecisionTree, {"max_depth": 3, "task": "regression"}, "z"), (RandomForest, {"n_trees": 3, "max_depth": 2, "max_features": 100}, "y"),
]


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(5)
    rows = []
    for i in range(240):
        c, e = int(rng.integers(0, 9)), int(rng.integers(0, 4))
        x = float(rng.normal())
        rows.append((i, x, f"c{c}" if i % 17 else None, f"e{e}", int(x + (c in (2, 5)) * 2 + rng.normal() * 0.3 > 0.7), x + c * (e == 1) + float(rng.normal()) * 0.1, i % 3))
    return spark.createDataFrame(rows, "row_id long, x double, c string, e string, y int, z double, fold int")


@pytest.fixture(scope="module")
def both(table):
    """The same table prepared with columns of indicators, and with sparse ones."""
    found = []
    for width in (1000, 2):
        fitted = prepare.Preprocessor(max_width=width).fit(table, ["c", "x", "e"])
        found.append((fitted, fitted.matrix(table, ["row_id", "y", "z", "fold"]).persist()))
    assert not found[0][0].wide and found[1][0].wide == ["c", "e"] and found[0][0].feature_names == found[1][0].feature_names
    return found


@pytest.mark.parametrize("family, params, label", FAMILIES)
def test_models_agree_with_columns_of_indicators(both, family, params, label):
    task = "classification" if label == "y" else "regression"
    outcomes = []
    for fitted, df in both:
        m = Matrix(df, ("row_id",), label, task=task)
        model = family.fit_matrix(m, params)
        predicted = np.array([r["prediction"] for r in model.transform(df).orderBy("row_id").select("prediction").collect()], float)
        scored = family.out_of_fold(m, [params], 3).groupBy("fold").agg(F.sum("prediction").alias("s"), F.count("prediction").alias("n")).orderBy("fold").collect()
        outcomes.append((predicted, [r["s"] for r in scored], [r["n"] for r in scored], model.importances()))
    (a, folds_a, n_a, weights_a), (b, folds_b, n_b, weights_b) = outcomes
    np.testing.assert_allclose(a, b, rtol=1e-7, atol=1e-9)
    np.testing.assert_allclose(folds_a, folds_b, rtol=1e-7)
    assert n_a == n_b
    if weights_a is not None:
        np.testing.assert_allclose(weights_a, weights_b, rtol=1e-6, atol=1e-9)


def test_tree_names_a_category(both, spark):
    tables = [DecisionTree(2, task="regression").fit(df, "z").to_table(spark).orderBy("node_id").collect() for _, df in both]
    assert [r["feature"] for r in tables[0]] == [r["feature"] for r in tables[1]] and any("e_e1" == r["feature"] for r in tables[0])


def test_binned_trees_split_on_categories(both):
    predicted = [[r["prediction"] for r in DecisionTree(3, solver="binned", bins=300).fit(df, "y").transform(df).orderBy("row_id").collect()] for _, df in both]
    assert predicted[0] == predicted[1]


def test_unknown_categories_have_no_indicator(both, spark):
    new = spark.createDataFrame([(1, 0.1, "never", "e1", 0, 0.0, 0)], "row_id long, x double, c string, e string, y int, z double, fold int")
    scored = []
    for fitted, df in both:
        model = LinearRegression(0.01, 30).fit(df, "z")
        scored.append(model.transform(fitted.matrix(new, ["row_id"])).first()["prediction"])
    assert scored[0] == pytest.approx(scored[1], rel=1e-9)


def test_pairs_and_moments(spark):
    df = spark.createDataFrame([(1, "b", 2.0), (2, "a", 3.0), (3, "b", 5.0), (4, None, 7.0), (5, "", 1.0)], "id long, t string, v double")
    found = SparseOneHot("t").fit(df)
    assert (found.size, found.rows, found.fill) == (2, 5, "b")
    assert sorted(tuple(r) for r in found.pairs(df, ["id"]).collect()) == [(1, 1, 1.0), (2, 0, 1.0), (3, 1, 1.0), (4, 1, 1.0), (5, 1, 1.0)]
    assert sorted(tuple(r) for r in found.moments(df, ["v"]).collect()) == [(0, 1, 3.0), (1, 4, 15.0)]
    scaled = SparseOneHot("t", scaled=True).fit(df)
    assert {r["index"]: round(r["value"], 6) for r in scaled.pairs(df.where("id < 3"), ["id"]).collect()} == {1: 0.5, 0: 2.0}
    assert {r["index"]: round(r["value"], 6) for r in scaled.base(spark).collect()} == {0: -0.5, 1: -2.0}
    with pytest.raises(ValueError, match="no value"):
        SparseOneHot("t").fit(df.where("id > 3"))


@pytest.mark.parametrize("width", [1_000, 1_001, 100_000])
def test_width_does_not_change_the_meaning(spark, width):
    """Labels hang on the number's parity and one category; the fit must see that category whatever the width."""
    n = max(4_000, 2 * width)
    df = spark.range(n).select(
        F.col("id").alias("row_id"), F.format_string("c%06d", F.col("id") % width).alias("c"), (F.col("id") % 2).cast("double").alias("x"),
        (F.when(F.col("id") % width == 7, 5000.0).otherwise(0.0) + F.col("id") % 2).alias("z"))
    fitted = prepare.Preprocessor().fit(df, ["c", "x"])
    assert bool(fitted.wide) == (width > 1_000) and len(fitted.feature_names) == width + 1
    matrix = fitted.matrix(df, ["row_id", "z"])
    model = LinearRegression(0.1, 5).fit(matrix, "z")
    assert model.importance_table(spark).first()["feature"] == "c_c000007"
    tree = DecisionTree(1, task="regression").fit(matrix, "z")
    assert tree.to_table(spark).where("node_id = 1").first()["feature"] == "c_c000007"


def test_ordinal_codes_on_request(table):
    fitted = prepare.Preprocessor(max_width=2, wide="ordinal").fit(table, ["c"])
    assert fitted.feature_names == ["c"] and fitted.wide == ["c"] and not fitted.sparse


def test_search_over_wide_text(spark, table):
    from lumenfit.plans.autofit import autofit

    small = {"LogisticRegression": {"lr": [0.1], "epochs": [20]}, "DecisionTree_clf": {"max_depth": [2]}, "RandomForest_clf": {"n_trees": [3], "max_depth": [2]}, "KNN_clf": {"k": [3]}, "GaussianNB": {"var_smoothing": [1e-2]}}
    results = [autofit(table.select("row_id", "x", "c", "e", "y"), "y", keys=["row_id"], max_width=w, cv_folds=3, time_budget=1000, grids=small) for w in (1000, 2)]
    a, b = ({(x.family): x.scores["accuracy"] for x in r.lines} for r in results)
    assert len(a) == 5 and a == pytest.approx(b)
    assert results[0].report["best_model"] == results[1].report["best_model"]
