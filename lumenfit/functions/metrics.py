"""Evaluation metrics as aggregate expressions, and the registry that gives each its direction.

Every function takes the true and the predicted column and returns an aggregate, so several
metrics, for all configurations and folds, come out of one ``groupBy().agg()``.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from .scalar import EPS, as_column


def mse(y, p) -> Column:
    error = as_column(y) - as_column(p)
    return F.avg(error * error)


def mae(y, p) -> Column:
    return F.avg(F.abs(as_column(y) - as_column(p)))


def rmse(y, p) -> Column:
    return F.sqrt(mse(y, p))


def r2_score(y, p) -> Column:
    y, p = as_column(y), as_column(p)
    return F.lit(1.0) - F.sum((y - p) * (y - p)) / (F.var_pop(y) * F.count(y) + F.lit(EPS))


def r2_plain(y, p) -> Column:
    """R2 without the guard; null when the target is constant."""
    y, p = as_column(y), as_column(p)
    spread = F.when(F.min(y) < F.max(y), F.var_pop(y) * F.count(y))
    return F.lit(1.0) - F.sum((y - p) * (y - p)) / spread


def accuracy(y, p) -> Column:
    return F.avg((as_column(y) == as_column(p)).cast("double"))


def _count(y, p, truth: int, guess: int) -> Column:
    return F.count_if((as_column(y) == F.lit(truth)) & (as_column(p) == F.lit(guess)))


def precision(y, p) -> Column:
    hits = _count(y, p, 1, 1)
    return hits / (hits + _count(y, p, 0, 1) + F.lit(EPS))


def recall(y, p) -> Column:
    hits = _count(y, p, 1, 1)
    return hits / (hits + _count(y, p, 1, 0) + F.lit(EPS))


def f1_score(y, p) -> Column:
    a, b = precision(y, p), recall(y, p)
    return F.lit(2.0) * a * b / (a + b + F.lit(EPS))


def confusion_counts(y, p) -> list[Column]:
    """The cells tn, fp, fn, tp of the two-class table."""
    cells = {"tn": (0, 0), "fp": (0, 1), "fn": (1, 0), "tp": (1, 1)}
    return [_count(y, p, t, g).alias(name) for name, (t, g) in cells.items()]


def confusion_matrix(df: DataFrame, y: str, p: str) -> DataFrame:
    """The two-class table, row by row: ``[[tn, fp], [fn, tp]]``."""
    row = df.agg(*confusion_counts(y, p))
    return row.select(
        F.array(F.array("tn", "fp"), F.array("fn", "tp")).alias("matrix"), "tn", "fp", "fn", "tp"
    )


def confusion_table(df: DataFrame, y: str, p: str) -> DataFrame:
    """Counts per (true, predicted) pair for any number of classes."""
    return df.groupBy(F.col(y).alias("truth"), F.col(p).alias("predicted")).agg(
        F.count(F.lit(1)).alias("n")
    )


def weighted_scores(df: DataFrame, y: str, p: str, by: list[str] | None = None) -> DataFrame:
    """Support-weighted precision, recall and f1 over all classes (0 where undefined).

    The rows shrink to class-pair counts before anything else happens.
    """
    by = by or []
    pairs = df.groupBy(*by, F.col(y).cast("double").alias("_y"), F.col(p).cast("double").alias("_p"))
    pairs = pairs.agg(F.count(F.lit(1)).alias("_n"))
    sides = pairs.select(*by, "_n", F.explode(F.array(
        F.struct(F.col("_y").alias("cls"), F.lit(1).alias("true"), F.lit(0).alias("pred"),
                 (F.col("_y") == F.col("_p")).cast("int").alias("hit")),
        F.struct(F.col("_p").alias("cls"), F.lit(0).alias("true"), F.lit(1).alias("pred"),
                 F.lit(0).alias("hit")),
    )).alias("s"))
    classes = sides.groupBy(*by, F.col("s.cls").alias("cls")).agg(
        F.sum(F.col("_n") * F.col("s.true")).alias("support"),
        F.sum(F.col("_n") * F.col("s.pred")).alias("guessed"),
        F.sum(F.col("_n") * F.col("s.hit")).alias("hits"),
    )
    ratio = lambda a, b: F.when(b > 0, a / b).otherwise(F.lit(0.0))
    hits, support, guessed = F.col("hits"), F.col("support"), F.col("guessed")
    weighted = lambda c: F.sum(support * c) / F.sum(support)
    return classes.groupBy(*by).agg(
        weighted(ratio(hits, guessed)).alias("precision"),
        weighted(ratio(hits, support)).alias("recall"),
        weighted(ratio(F.lit(2.0) * hits, support + guessed)).alias("f1"),
    )


@dataclass(frozen=True)
class Metric:
    """An aggregate of (true, predicted) and whether larger values are better."""

    name: str
    expr: Callable[[Column, Column], Column]
    higher_is_better: bool = True


METRICS = {
    m.name: m
    for m in (
        Metric("accuracy", accuracy),
        Metric("f1", f1_score),
        Metric("precision", precision),
        Metric("recall", recall),
        Metric("mae", mae, False),
        Metric("mse", mse, False),
        Metric("rmse", rmse, False),
        Metric("r2", r2_score),
    )
}
TASK_METRICS = {
    "classification": ["accuracy", "f1", "precision", "recall"],
    "regression": ["mae", "mse", "r2"],
}
SEARCH_METRIC = {"classification": METRICS["accuracy"], "regression": METRICS["mse"]}
