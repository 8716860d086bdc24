"""Fixed-parameter leaderboards over all model families, on a plainly prepared table."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, functions as F

from ..functions.metrics import METRICS, weighted_scores
from ..models.base import Matrix
from ..models.knn import KNearestNeighbors
from ..models.linear import LinearRegression
from ..models.logistic import LogisticRegression
from ..models.naive_bayes import GaussianNB
from ..models.tree import DecisionTree, RandomForest
from ..operators.prepare import Preprocessor, clean_target
from ..operators.split import kfold, stratified_kfold
from ..session import durable
from .search import fold_metrics, out_of_fold

# The families and parameters that are compared.
CLASSIFIERS = {
    "DecisionTree": (DecisionTree, {"max_depth": 5, "min_samples_split": 5}),
    "RandomForest": (RandomForest, {"n_trees": 100, "max_depth": 5}),
    "LogisticRegression": (LogisticRegression, {"lr": 0.1, "epochs": 200}),
    "GaussianNB": (GaussianNB, {}),
    "KNN": (KNearestNeighbors, {"k": 5}),
}
REGRESSORS = {
    "LinearRegression": (LinearRegression, {"solver": "normal"}),
    "DecisionTree": (DecisionTree, {"max_depth": 5, "min_samples_split": 5}),
    "RandomForest": (RandomForest, {"n_trees": 100, "max_depth": 5}),
    "KNN": (KNearestNeighbors, {"k": 5}),
}


def baseline_matrix(df: DataFrame, target: str, keys: list[str], features: list[str], task: str,
                    k: int = 5, seed: int = 42) -> Matrix:
    """Codes for all text, mean imputation, standard scores; stratified folds for classes."""
    labelled, _ = clean_target(df, target)
    kind = "int" if task == "classification" else "double"
    labelled = labelled.withColumn("label", F.col(f"`{target}`").cast(kind))
    if task == "classification":
        labelled = stratified_kfold(labelled, keys, "label", k, seed)
    else:
        labelled = kfold(labelled, keys, k, seed)
    fitted = Preprocessor(encoding="ordinal").fit(labelled, features)
    return Matrix(durable(fitted.matrix(labelled, [*keys, "label", "fold"])), tuple(keys), task=task)


def leaderboard(m: Matrix, k: int = 5, models: dict | None = None, seed: int = 42) -> DataFrame:
    """(position, family, metrics, seconds) rounded to 4 and 2 places, one line per family.

    Classifiers get accuracy and support-weighted f1, precision and recall; regressors r2 and mae.
    """
    models = models or (CLASSIFIERS if m.task == "classification" else REGRESSORS)
    lines = []
    for position, (name, (family, params)) in enumerate(models.items()):
        start = time.time()
        predictions = out_of_fold(family, m, [params], k, seed).persist()
        try:
            scores = _scores(predictions, m.task).first().asDict()
        finally:
            predictions.unpersist()
        values = [round(scores[c], 4) for c in _columns(m.task)]
        lines.append((position, name, *values, round(time.time() - start, 2)))
    columns = ", ".join(f"{c} double" for c in _columns(m.task))
    return m.df.sparkSession.createDataFrame(lines, f"position int, family string, {columns}, seconds double")


def _columns(task: str) -> list[str]:
    return ["accuracy", "f1", "precision", "recall"] if task == "classification" else ["r2", "mae"]


def _scores(predictions: DataFrame, task: str) -> DataFrame:
    if task != "classification":
        folds = fold_metrics(predictions, [METRICS["r2"], METRICS["mae"]])
    else:
        folds = fold_metrics(predictions, [METRICS["accuracy"]]).join(
            weighted_scores(predictions, "label", "prediction", ["config", "fold"]), ["config", "fold"])
    return folds.agg(*[F.avg(c).alias(c) for c in _columns(task)])
