import numpy as np
import pytest
from pyspark.sql import functions as F

from lumenfit.functions.metrics import METRICS, Metric
from lumenfit.models import descent, knn, linear, naive_bayes, tree
from lumenfit.models.base import Matrix
from lumenfit.models.knn import KNearestNeighbors
from lumenfit.models.linear import LinearRegression
from lumenfit.models.logistic import LogisticRegression
from lumenfit.models.naive_bayes import GaussianNB
from lumenfit.models.tree import DecisionTree, RandomForest
from lumenfit.operators.split import bootstrap, feature_subset, kfold
from lumenfit.plans import search
from lumenfit.sources.fixtures import classification_table, regression_table


@pytest.fixture(scope="module")
def data(spark):
    """Three numeric features (one with few values, one with copies), a class and a number."""
    rng = np.random.default_rng(11)
    x = np.c_[rng.normal(size=150), rng.integers(0, 4, 150), np.round(rng.normal(size=150), 1)]
    y = ((x[:, 0] + 0.5 * x[:, 1] + rng.normal(scale=0.5, size=150)) > 0.8).astype(int)
    z = x @ [1.0, -2.0, 0.5] + rng.normal(scale=0.2, size=150)
    rows = [(i, *map(float, r), int(a), float(b)) for i, (r, a, b) in enumerate(zip(x, y, z))]
    df = spark.createDataFrame(rows, "row_id long, a double, b double, c double, y int, z double")
    df = kfold(df, ["row_id"], 4).repartition(3).cache()
    fold = np.array([r[0] for r in df.orderBy("row_id").select("fold").collect()])
    return x, y, z, fold, df


def matrix(df, label, task="classification"):
    return Matrix(df, ("row_id",), label, ["a", "b", "c"], task=task)


def fold_scores(m, family, configs, metric):
    found = search.cross_validate(m, family, configs, 4, [METRICS[metric]]).collect()
    return {(r["config"], r["fold"]): r["value"] for r in found}


def predictions(model, df):
    return np.array([r[0] for r in model.transform(df).orderBy("row_id").select("prediction").collect()])


# --- linear and logistic ---

def descend(x, y, lr, epochs, link, factor):
    w, b = np.zeros(x.shape[1]), 0.0
    for _ in range(epochs):
        e = link(x @ w + b) - y
        w, b = w - lr * factor * x.T @ e / len(y), b - lr * factor * e.sum() / len(y)
    return w, b


SIGMOID = lambda z: 1 / (1 + np.exp(-np.clip(z, -500, 500)))


@pytest.mark.parametrize("many", [300, 1])
def test_linear_equals_row_descent(data, monkeypatch, many):
    monkeypatch.setattr(linear, "MANY_FEATURES", many)  # moments, or passes over the rows
    x, _, z, fold, df = data
    model = LinearRegression(0.05, 150).fit(df, "z", ["a", "b", "c"])
    w, b = descend(x, z, 0.05, 150, lambda v: v, 2)
    np.testing.assert_allclose(np.r_[model.weights, model.bias], np.r_[w, b], rtol=1e-9)
    np.testing.assert_allclose(predictions(model, df), x @ w + b, rtol=1e-9)
    np.testing.assert_allclose(model.importances(), np.abs(w) / np.abs(w).sum(), rtol=1e-6)
    assert model.score(df, "z") == pytest.approx(1 - ((z - x @ w - b) ** 2).sum() / ((z - z.mean()) ** 2).sum())
    got = fold_scores(matrix(df, "z", "regression"), LinearRegression, [{"lr": 0.01}, {"lr": 0.05}], "mse")
    for i, lr in enumerate((0.01, 0.05)):
        for f in range(4):
            w, b = descend(x[fold != f], z[fold != f], lr, 200, lambda v: v, 2)
            assert got[i, f] == pytest.approx(np.mean((x[fold == f] @ w + b - z[fold == f]) ** 2))


def test_normal_solver(spark):
    houses = regression_table(spark, 120)
    model = LinearRegression(solver="normal").fit(houses, "Price", ["Area", "Rooms", "Age"])
    assert model.score(houses, "Price") > 0.999999


@pytest.mark.parametrize("cells", [descent.ONE_TASK_CELLS, 0])
def test_logistic_equals_row_descent(data, monkeypatch, cells):
    monkeypatch.setattr(descent, "ONE_TASK_CELLS", cells)
    monkeypatch.setattr(descent, "DRIVER_CELLS", cells)
    x, y, _, fold, df = data
    epochs = 60 if cells else 4
    model = LogisticRegression(0.1, epochs).fit(df, "y", ["a", "b", "c"])
    w, b = descend(x, y, 0.1, epochs, SIGMOID, 1)
    np.testing.assert_allclose(np.r_[model.weights, model.bias], np.r_[w, b], rtol=1e-9)
    assert (predictions(model, df) == (SIGMOID(x @ w + b) >= 0.5)).all()
    assert model.score(df, "y") == pytest.approx(np.mean((SIGMOID(x @ w + b) >= 0.5) == y))
    full = {}
    configs = [{"lr": 0.1, "epochs": epochs}, {"lr": 0.01, "epochs": 2}]
    oof = LogisticRegression.out_of_fold(matrix(df, "y"), configs, 4, full=full)
    got = {(r["config"], r["fold"]): r["accuracy"] for r in search.fold_metrics(oof, [METRICS["accuracy"]]).collect()}
    for f in range(4):
        w, b = descend(x[fold != f], y[fold != f], 0.1, epochs, SIGMOID, 1)
        assert got[0, f] == pytest.approx(np.mean((SIGMOID(x[fold == f] @ w + b) >= 0.5) == y[fold == f]))
    np.testing.assert_allclose(full[0].weights, model.weights, rtol=1e-9)


def test_logistic_merges_identical_rows(spark):
    rows = [(float(i % 3), (i % 3 == 2) * 1) for i in range(300)]
    df = spark.createDataFrame(rows, "a double, y int")
    model = LogisticRegression(0.5, 50).fit(df, "y", ["a"])
    x, y = np.array([[r[0]] for r in rows]), np.array([r[1] for r in rows])
    w, b = descend(x, y, 0.5, 50, SIGMOID, 1)
    np.testing.assert_allclose([model.weights[0], model.bias], [w[0], b], rtol=1e-9)


# --- naive Bayes ---

def bayes(x, y, q, eps):
    classes = np.unique(y)
    s = [np.log(np.mean(y == c)) + (-0.5 * np.log(2 * np.pi * (x[y == c].var(axis=0) + eps))
         - (q - x[y == c].mean(axis=0)) ** 2 / (2 * (x[y == c].var(axis=0) + eps))).sum(axis=1) for c in classes]
    return classes[np.argmax(s, axis=0)]


@pytest.mark.parametrize("terms", [0, 10_000])
def test_naive_bayes(data, monkeypatch, terms):
    monkeypatch.setattr(naive_bayes, "EXPRESSION_TERMS", terms)  # Arrow batches or expressions
    monkeypatch.setattr(naive_bayes, "WIDE", 24 if terms else 1)
    x, y, _, fold, df = data
    model = GaussianNB().fit(df, "y", ["a", "b", "c"])
    assert (predictions(model, df) == bayes(x, y, x, 1e-9)).all()
    assert model.to_table(df.sparkSession).count() == 6
    got = fold_scores(matrix(df, "y"), GaussianNB, [{"var_smoothing": 1e-9}, {"var_smoothing": 2.0}], "accuracy")
    for i, eps in enumerate((1e-9, 2.0)):
        for f in range(4):
            p = bayes(x[fold != f], y[fold != f], x[fold == f], eps)
            assert got[i, f] == pytest.approx(np.mean(p == y[fold == f]))


# --- trees ---

def impurity(y, task, w):
    if task == "regression":
        m = np.average(y, weights=w)
        return np.average((y - m) ** 2, weights=w)
    p = np.array([w[y == c].sum() for c in np.unique(y)]) / w.sum()
    return 1 - (p**2).sum()


def brute(x, y, w, depth, max_depth, least, task, features):
    """Exhaustive tree: ((feature, threshold, gain * n), left, right) or a leaf value."""
    keep = w > 0
    x, y, w = x[keep], y[keep], w[keep]
    if task == "regression":
        leaf = np.average(y, weights=w)
    else:
        leaf = max(np.unique(y), key=lambda c: (w[y == c].sum(), -c))
    if depth >= max_depth or w.sum() < least or len(np.unique(y)) == 1:
        return leaf
    base, best = impurity(y, task, w), None
    for f in features:
        for v in np.unique(x[:, f])[:-1]:
            low = x[:, f] <= v
            imp = (w[low].sum() * impurity(y[low], task, w[low]) + w[~low].sum() * impurity(y[~low], task, w[~low])) / w.sum()
            r = round(imp / base, 12)
            if r < 1 and (best is None or r < best[0]):
                best = (r, f, v, (base - imp) * w.sum())
    if best is None:
        return leaf
    low = x[:, best[1]] <= best[2]
    side = lambda m: brute(x[m], y[m], w[m], depth + 1, max_depth, least, task, features)
    return (best[1], best[2], best[3]), side(low), side(~low)


def walk(node, row):
    while isinstance(node, tuple):
        node = node[1] if row[node[0][0]] <= node[0][1] else node[2]
    return node


def splits(node):
    return [] if not isinstance(node, tuple) else [node[0]] + splits(node[1]) + splits(node[2])


def shares(node, d):
    out = np.zeros(d)
    for f, _, g in splits(node):
        out[f] += g
    return out / out.sum() if out.sum() else out


@pytest.mark.parametrize("task, label", [("classification", "y"), ("regression", "z")])
@pytest.mark.parametrize("limits", [(500_000, 256), (40, 256), (10, 4)])
def test_tree_equals_exhaustive_search(data, monkeypatch, task, label, limits):
    monkeypatch.setattr(tree, "VALUES_PER_GROUP", limits[0])
    monkeypatch.setattr(tree, "PARTS", limits[1])
    x, y, z, _, df = data
    target = y if task == "classification" else z
    bins = None if limits[0] > 1000 else 5
    model = DecisionTree(4, 2, task, bins).fit(df, label, ["a", "b", "c"])
    expected = brute(x, target, np.ones(len(x)), 0, 4, 2, task, range(3))
    got = sorted((r["feature"], r["threshold"]) for r in model.to_table(df.sparkSession).where("feature is not null").collect())
    assert got == sorted(("abc"[f], v) for f, v, _ in splits(expected))
    np.testing.assert_allclose(predictions(model, df), [walk(expected, r) for r in x], rtol=1e-9)
    np.testing.assert_allclose(model.importances(), shares(expected, 3), rtol=1e-6)


def test_tree_grid_from_one_growth(data):
    x, y, _, fold, df = data
    configs = search.generate_combinations({"max_depth": [1, 3], "min_samples_split": [2, 40]})
    got = fold_scores(matrix(df, "y"), DecisionTree, configs, "accuracy")
    for i, c in enumerate(configs):
        for f in range(4):
            t = brute(x[fold != f], y[fold != f], np.ones((fold != f).sum()), 0, c["max_depth"], c["min_samples_split"],
                      "classification", range(3))
            assert got[i, f] == pytest.approx(np.mean([walk(t, r) for r in x[fold == f]] == y[fold == f]))


def test_learnable_table_is_solved_by_depth_two(spark):
    df = classification_table(spark, 120)
    model = DecisionTree(2).fit(df, "Survived", ["Age", "Income"])
    assert model.score(df, "Survived") == 1.0
    assert sum(model.importances()) == pytest.approx(1)


@pytest.mark.parametrize("task, label", [("classification", "y"), ("regression", "z")])
def test_forest_equals_weighted_trees(data, task, label):
    x, y, z, _, df = data
    target = y if task == "classification" else z
    weights = np.array([r[0] for r in bootstrap(df, ["row_id"], 4, 7).orderBy("row_id").select("weights").collect()])
    forest = RandomForest(4, 3, max_features=2, task=task).fit(df, label, ["a", "b", "c"], ["row_id"], seed=7)
    trees = [brute(x, target, weights[:, t].astype(float), 0, 3, 2, task, feature_subset(3, 2, 7, t)) for t in range(4)]
    votes = np.array([[walk(t, r) for r in x] for t in trees])
    np.testing.assert_allclose(predictions(forest, df), tree.vote(votes, task), rtol=1e-9)
    total = np.sum([shares(t, 3) for t in trees], axis=0)
    np.testing.assert_allclose(forest.importances(), total / total.sum(), rtol=1e-6)


def test_forest_needs_keys_and_prefixes_agree(data):
    *_, df = data
    with pytest.raises(ValueError, match="keys"):
        RandomForest(2).fit(df, "y", ["a"])
    full = {}
    RandomForest.out_of_fold(matrix(df, "y"), [{"n_trees": 2}, {"n_trees": 4}], 4, full=full)
    few, many = (full[i].to_table(df.sparkSession).collect() for i in (0, 1))
    assert few == [r for r in many if r["tree_id"] < 2]


@pytest.mark.parametrize("rows", [[(1, 1.0, 1)], [(1, 1.0, 1), (2, 5.0, 1)], [(1, 3.0, 0), (2, 3.0, 1)]])
def test_tree_without_a_split(spark, rows):
    df = spark.createDataFrame(rows, "row_id long, a double, y int")
    model = DecisionTree().fit(df, "y", ["a"])
    assert model.to_table(spark).count() == 1 and model.importances() == [0.0]


def test_vote_tie_takes_smallest():
    assert list(tree.vote(np.array([[2.0, 1.0], [0.0, 1.0]]), "classification")) == [0.0, 1.0]


# --- nearest neighbours ---

def nearest(x, y, q, k, metric, task, ids, exclude=None):
    out = []
    for i, p in enumerate(q):
        d = np.abs(x - p).sum(axis=1) if metric == "manhattan" else np.sqrt(((x - p) ** 2).sum(axis=1))
        use = np.ones(len(x), dtype=bool) if exclude is None else exclude[0] != exclude[1][i]
        order = [j for j in np.lexsort((ids, d)) if use[j]][:k]
        labels = y[order]
        values, counts = np.unique(labels, return_counts=True)
        out.append(values[counts.argmax()] if task == "classification" else labels.mean())
    return np.array(out)


@pytest.mark.parametrize("metric", ["euclidean", "manhattan"])
@pytest.mark.parametrize("options", [{}, {"n_pivots": 6, "chunk": 17}, {"chunk": 10}])
def test_neighbours(data, metric, options):
    x, y, _, _, df = data
    model = KNearestNeighbors(5, metric).fit(df, "y", ["a", "b", "c"])
    got = np.array([r[0] for r in model.transform(df, **options).orderBy("row_id").select("prediction").collect()])
    assert (got == nearest(x, y, x, 5, metric, "classification", np.arange(len(x)))).all()


@pytest.mark.parametrize("pivots", [None, 5])
def test_neighbours_across_folds(data, monkeypatch, pivots):
    if pivots:
        monkeypatch.setattr(knn, "ROWS_PER_PIVOT", 30)
    x, _, z, fold, df = data
    got = fold_scores(matrix(df, "z", "regression"), KNearestNeighbors, [{"k": 3}, {"k": 5, "metric": "manhattan"}], "mae")
    for i, (k, metric) in enumerate(((3, "euclidean"), (5, "manhattan"))):
        p = nearest(x, z, x, k, metric, "regression", np.arange(len(x)), (fold, fold))
        for f in range(4):
            assert got[i, f] == pytest.approx(np.mean(np.abs(p - z)[fold == f]))


def test_copies_and_ties(spark):
    """A third of the rows are one vector; ties go to the smaller key."""
    rows = [(i, 1.0 if i % 3 == 0 else float(i), i % 2) for i in range(90)]
    df = spark.createDataFrame(rows, "row_id long, a double, y int")
    found = KNearestNeighbors(3).fit(df, "y", ["a"]).neighbours(df, n_pivots=4, chunk=8).orderBy("qid", "rank").collect()
    assert [r["tid"] for r in found if r["qid"] == 3] == [0, 1, 3]
    assert len(found) == 270


def test_neighbours_with_text_keys_and_bad_input(spark):
    df = spark.createDataFrame([("p", 1, 0.0, 0), ("p", 2, 1.0, 1), ("q", 1, 2.0, 1)], "s string, n int, a double, y int")
    model = KNearestNeighbors(1).fit(df, "y", ["a"], ["s", "n"])
    assert {(r["s"], r["n"]): r["prediction"] for r in model.transform(df).collect()} == {("p", 1): 0, ("p", 2): 1, ("q", 1): 1}
    assert model.score(df, "y") == 1.0
    with pytest.raises(ValueError, match="metric"):
        KNearestNeighbors(metric="cosine")


@pytest.mark.parametrize("metric", ["euclidean", "manhattan"])
def test_shortlist_against_all_distances(metric):
    """Ties, copies, an outlier that leaves few 16-bit steps, and points far from the origin."""
    rng = np.random.default_rng(5)
    normal = lambda n, d: rng.normal(size=(n, d))
    cases = [(normal(300, 20), normal(2_000, 20)), (rng.integers(0, 3, (90, 3)) * 1.0, rng.integers(0, 3, (1_500, 3)) * 1.0),
             (normal(50, 4) * 1e6, normal(1_200, 4) + 1e7), (normal(60, 5), np.r_[normal(1_300, 5), np.full((1, 5), 1e9)]), (np.ones((20, 2)), np.ones((700, 2)))]
    for q, t in cases:
        place = rng.permutation(len(t))
        full = np.abs(q[:, None] - t[None]).sum(2) if metric == "manhattan" else np.sqrt(((q[:, None] - t[None]) ** 2).sum(2))
        for k in (1, 4):
            a, b, dist = knn._search(q, t, place, k, metric, ())
            assert a.tolist() == np.repeat(np.arange(len(q)), k).tolist()
            np.testing.assert_allclose(dist.reshape(-1, k), np.sort(full, axis=1)[:, :k], rtol=1e-12)
            if len(np.unique(t, axis=0)) < 30:
                assert b.tolist() == [j for row in full for j in np.lexsort((place, row))[:k]]
    # pieces of whole numbers, and no table of all distances
    assert len(knn._Shortlist(cases[0][1], 4, metric).of(cases[0][0])[0]) < 20 * len(cases[0][0])


def test_cells_that_rule_out_nothing_meet_in_few_chunks(spark, monkeypatch):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(600, 30))
    df = spark.createDataFrame([(i, [float(v) for v in r], i % 3) for i, r in enumerate(x)], "row_id long, x array<double>, qf int")
    queries, train = df.select(F.col("row_id").alias("qid"), "x", "qf"), df.select(F.col("row_id").alias("tid"), "x", F.lit(0.0).alias("y"), F.col("qf").alias("tf"))
    sent = []
    sides = knn._join_sides
    monkeypatch.setattr(knn, "_join_sides", lambda *a: sent.append(sides(*a)) or sent[-1])
    found = knn.neighbours(queries, train, 3, width=30, exclude_fold=True, n_pivots=12, chunk=50).collect()
    assert [side.count() for side in sent[0]] == [600 * 8, 600 * 8]  # not once for each of 36 cells and folds
    away = np.sqrt(((x[:, None] - x[None]) ** 2).sum(2))
    away[np.arange(600)[:, None] % 3 == np.arange(600)[None] % 3] = np.inf
    expected = {(i, j) for i, row in enumerate(away) for j in np.argsort(row)[:3]}
    assert {(r["qid"], r["tid"]) for r in found} == expected


def test_approximate_queries_are_sent_once_to_a_pack_of_cells(spark):
    rng = np.random.default_rng(7)
    x = rng.normal(size=(500, 6))
    x[:200] = x[0]  # one cell is many chunks
    df = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "row_id long, x array<double>")
    queries, train = df.select(F.col("row_id").alias("qid"), "x", F.lit(-1).alias("qf")), df.select(F.col("row_id").alias("tid"), "x", F.lit(0.0).alias("y"), F.lit(-1).alias("tf"))
    rows = lambda found: {(r["qid"], r["rank"]): r["tid"] for r in found.collect()}
    exact = rows(knn.neighbours(queries, train, 3, width=6))
    everything = knn.approximate_neighbours(queries, train, 3, width=6, probes=100, cells=40, chunk=60)
    assert rows(everything) == exact
    some = rows(knn.approximate_neighbours(queries, train, 3, width=6, probes=6, cells=40, chunk=60))
    assert len(some) == 1500 and np.mean([some[k] == exact[k] for k in exact]) > 0.5


# --- search ---

def test_direction_of_metrics(data):
    *_, df = data
    m = matrix(df, "z", "regression")
    found = search.GridSearch(LinearRegression, {"lr": [1e-6, 0.05]}, k=4).fit(m)
    scores = [line.scores["mse"] for line in found.lines]
    assert scores[1] < scores[0] and found.best_params == {"lr": 0.05}
    assert found.best_score == scores[1] and found.best_estimator.bias != 0
    assert search.evaluate_model(m, LinearRegression, {"lr": 0.05}, 4) == pytest.approx(scores[1])


def test_random_search_and_ties(data):
    *_, df = data
    grid = {"max_depth": [1, 2], "min_samples_split": [2, 3]}
    a = search.RandomSearch(DecisionTree, grid, k=4, n_iter=8, seed=3).fit(matrix(df, "y"))
    b = search.RandomSearch(DecisionTree, grid, k=4, n_iter=8, seed=3).fit(matrix(df, "y"))
    assert [line.params for line in a.lines] == [line.params for line in b.lines]
    assert all(line.params not in [o.params for o in a.lines[:i]] for i, line in enumerate(a.lines))
    first = max(a.lines, key=lambda line: line.scores["accuracy"])
    assert a.best_params == first.params


def test_own_metric_and_own_estimator(data):
    *_, df = data

    class Majority:
        def __init__(self, value=1):
            self.value = value

        def fit(self, df, label, features):
            return self

        def transform(self, df):
            return df.withColumn("prediction", F.lit(self.value))

    hits = Metric("share_of_ones", lambda y, p: F.avg((p == 1).cast("double")), False)
    found = search.GridSearch(Majority, {"value": [1, 0]}, k=4, metric=hits).fit(matrix(df, "y"))
    assert found.best_params == {"value": 0} and found.best_score == 0


def test_combinations():
    assert search.generate_combinations({"a": [1, 2], "b": [3]}) == [{"a": 1, "b": 3}, {"a": 2, "b": 3}]
    assert search.generate_combinations({}) == [{}]
    assert len(search.generate_combinations(search.default_grid("RandomForest_clf"))) == 4


# --- solvers -----------------------------------------------------------------------------------

def test_blocks_are_packed_where_their_rows_are(spark):
    """Few rows are few blocks' tasks, but the partitions they come from are not chained in one task."""
    rows = spark.range(640, numPartitions=16)
    for x in (F.array(F.col("id").cast("double")), F.array(F.lit(1.0))):
        blocks, _ = descent._pack(rows, x, F.spark_partition_id(), F.lit(0), 1)
        labels = {y for b in blocks.collect() for y in np.frombuffer(b["y"])}
        assert labels == set(range(16)) and blocks.rdd.getNumPartitions() == 1


def test_lbfgs_reaches_the_optimum_of_a_long_descent(data):
    x, y, _, _, df = data
    long = LogisticRegression(0.5, 6_000).fit(df, "y", ["a", "b", "c"])
    quick = LogisticRegression(solver="lbfgs")
    model = quick.fit(df, "y", ["a", "b", "c"])
    np.testing.assert_allclose([*model.weights, model.bias], [*long.weights, long.bias], rtol=1e-3, atol=1e-3)
    assert quick.passes <= 300  # a twentieth
    p = 1 / (1 + np.exp(-(x @ model.weights + model.bias)))
    assert np.abs(np.append(x.T @ (p - y), (p - y).sum())).max() / len(y) <= 1e-6


def test_lbfgs_folds_with_a_penalty(data):
    x, y, _, fold, df = data
    m = Matrix(df, ("row_id",), "y", ["a", "b", "c"])
    found = LogisticRegression.out_of_fold(m, [{"solver": "lbfgs", "l2": 0.1}, {"lr": 0.1, "epochs": 50}], 3)
    assert found.groupBy("config").count().count() == 2
    with pytest.raises(ValueError, match="penalty"):
        LogisticRegression(l2=1.0)


def test_binned_trees_equal_exact_ones_where_buckets_hold_every_value(data):
    _, _, _, _, df = data
    rough = df.select("row_id", "y", "z", *[(F.floor(F.col(c) * 4) / 4).alias(c) for c in ("a", "b", "c")]).persist()
    for label, task in (("y", "classification"), ("z", "regression")):
        trees = [DecisionTree(4, task=task, solver=s).fit(rough, label, ["a", "b", "c"]).to_table(rough.sparkSession).drop("gain").orderBy("node_id").collect() for s in ("exact", "binned")]
        assert len(trees[0]) > 5
        for r, s in zip(*trees, strict=True):
            assert r[:7] == s[:7] or np.allclose([v for v in r[3:] if v is not None], [v for v in s[3:] if v is not None], rtol=1e-9)


def test_subset_of_features_per_node(data):
    _, _, _, _, df = data
    forest = RandomForest(6, 4, max_features=1, subset="node", solver="binned").fit(df, "y", ["a", "b", "c"], ["row_id"])
    per_tree = [{node.feature for node, split in t.nodes.values() if split} for t in forest.trees]
    assert max(len(f) for f in per_tree) > 1  # one feature per node, several in a tree
    again = RandomForest(6, 4, max_features=1, subset="node", solver="binned").fit(df.repartition(5), "y", ["a", "b", "c"], ["row_id"])
    assert sorted(map(tuple, forest.to_table(df.sparkSession).drop("gain").collect()), key=str) == sorted(map(tuple, again.to_table(df.sparkSession).drop("gain").collect()), key=str)


def test_no_row_per_row_and_tree(data):
    from lumenfit.models.tree import _Grower

    _, _, _, _, df = data
    grower = _Grower(Matrix(df, ("row_id",), "y", ["a", "b", "c"]), [None], 20, 3, 2, None, 42, None)
    assert grower._blocks().count() <= df.rdd.getNumPartitions()


def test_blocks_of_a_batch_are_taken_one_at_a_time():
    """An Arrow batch can hold all blocks of a partition; copies of all of them would double what a worker holds."""
    import pyarrow as pa

    class Column:
        def __init__(self, cells):
            self.cells = cells

        def __getitem__(self, row):
            return self.cells[row]

    class Batch:
        num_rows = 2

        def column(self, name):
            v = {"x": np.arange(6.0), "b": np.arange(6, dtype=np.uint16), "y": np.arange(3.0), "fold": np.zeros(3, np.int32), "w": np.ones(3, np.uint8)}[name]
            return Column(pa.array([v.tobytes(), v.tobytes() if name != "b" else b""], pa.binary()))

    (x, codes, y, fold, w), (_, none, *_) = tree._unpacked([Batch()], 2, 1)
    assert x.tolist() == [[0, 1], [2, 3], [4, 5]] and codes.tolist() == [[0, 1], [2, 3], [4, 5]] and none is None
    assert y.tolist() == [0, 1, 2] and fold.tolist() == [0, 0, 0] and w.tolist() == [[1], [1], [1]]


def test_approximate_neighbours_reach_their_recall(spark):
    rng = np.random.default_rng(11)
    centres = rng.normal(size=(40, 12)) * 4
    x = centres[rng.integers(0, 40, 4_000)] + rng.normal(size=(4_000, 12))
    df = spark.createDataFrame([(i, [float(v) for v in r], i % 2) for i, r in enumerate(x)], "row_id long, features array<double>, y int").persist()
    few = KNearestNeighbors(10, approx=True, probes=8).fit(df, "y")
    one = KNearestNeighbors(10, approx=True, probes=1).fit(df, "y")
    asked = df.where("row_id % 10 = 0")
    assert few.recall(asked, 200) >= 0.9 > one.recall(asked, 200)
    assert KNearestNeighbors(10).approx is False
    rows = few.neighbours(asked).groupBy("qid").count().collect()
    assert len(rows) == 400 and all(r["count"] == 10 for r in rows)
    m = Matrix(kfold(df, ["row_id"], 3), ("row_id",), "y")
    found = KNearestNeighbors.out_of_fold(m, [{"k": 3}, {"k": 3, "approx": True, "probes": 64}], 3).groupBy("config", "fold").agg(F.sum("prediction")).collect()
    assert {tuple(r)[1:] for r in found if r[0] == 0} == {tuple(r)[1:] for r in found if r[0] == 1}


@pytest.mark.parametrize("task", ["classification", "regression"])
def test_opened_buckets_share_groups(spark, monkeypatch, task):
    """Where labels are noise every bucket is opened: a group for each would cost more than its search."""
    asked = []
    teams = tree._teams
    monkeypatch.setattr(tree, "_teams", lambda opened, rows: asked.append((opened, teams(opened, rows))) or asked[-1][1])
    monkeypatch.setattr(tree, "VALUES_PER_GROUP", 1_000)
    rng = np.random.default_rng(3)
    x, y = rng.integers(0, 900, (3000, 2)).astype(float), rng.integers(0, 3, 3000)
    df = spark.createDataFrame([(float(a), float(b), int(c)) for (a, b), c in zip(x, y)], "a double, b double, y int").repartition(3)
    model = DecisionTree(3, 2, task).fit(df, "y", ["a", "b"])
    assert asked and max(opened for opened, _ in asked) > 50 and max(n for _, n in asked) < 5
    expected = brute(x, y.astype(float), np.ones(len(x)), 0, 3, 2, task, range(2))
    got = sorted((r["feature"], r["threshold"]) for r in model.to_table(spark).where("feature is not null").collect())
    assert got == sorted(("ab"[f], v) for f, v, _ in splits(expected))


@pytest.mark.parametrize("metric", ["euclidean", "manhattan"])
@pytest.mark.parametrize("exclude", [True, False])
def test_boxes_rule_out_most_of_lines_with_long_tails(spark, monkeypatch, metric, exclude):
    """Categories and one number far from even: few pairs of rows meet, and the neighbours are those of all pairs."""
    monkeypatch.setattr(knn, "ROWS_PER_BOX", 30)
    monkeypatch.setattr(knn, "CHUNK", 60)
    rng = np.random.default_rng(8)
    n = 3000
    x = np.zeros((n, 5))
    x[np.arange(n), rng.integers(0, 4, n)] = 3.0
    x[:, 4] = np.round(rng.lognormal(0, 1.5, n), 2)
    fold = rng.integers(0, 3, n)
    sent, sides = [], knn._boxed
    monkeypatch.setattr(knn, "_boxed", lambda *a: sent.append(sides(*a)) or sent[-1])
    rows = spark.createDataFrame([(i, r.tolist(), float(i % 2), int(f)) for i, (r, f) in enumerate(zip(x, fold))], "id int, x array<double>, y double, f int")
    queries, train = rows.select(F.col("id").alias("qid"), "x", F.col("f").alias("qf")), rows.select(F.col("id").alias("tid"), "x", "y", F.col("f").alias("tf"))
    found = {}
    for r in knn.neighbours(queries, train, 3, metric, width=5, exclude_fold=exclude).orderBy("qid", "rank").collect():
        found.setdefault(r["qid"], []).append(r["tid"])
    away = np.abs(x[:, None] - x[None]).sum(axis=2) if metric == "manhattan" else np.sqrt(((x[:, None] - x[None]) ** 2).sum(axis=2))
    if exclude:
        away[fold[:, None] == fold[None]] = np.inf
    assert [found[i] for i in range(n)] == np.lexsort((np.broadcast_to(np.arange(n), away.shape), away))[:, :3].tolist()
    by = ["cell", "fold", "qc", "tc"]
    met = sent[0][0].groupBy(*by).agg(F.count(F.lit(1)).alias("q")).join(sent[0][1].groupBy(*by).agg(F.count(F.lit(1)).alias("t")), by)
    assert met.agg(F.sum(F.col("q") * F.col("t"))).first()[0] < 0.1 * n * n
