"""What all model families share: importances, scoring and the out-of-fold interface.

A family trains on a *matrix*: a DataFrame with the row keys, a label, the features (one array
column or several scalar columns) and, for cross-validation, a fold number. Its ``out_of_fold``
trains every configuration on every fold's complement in shared passes and returns one row per
(row, configuration): ``config, fold, label, prediction``.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ..functions.metrics import accuracy, r2_plain
from ..functions.scalar import IMPORTANCE_EPS
from ..session import partition_count, with_partition

# Expressions up to this many terms stay column expressions; larger ones score Arrow batches.
EXPRESSION_TERMS = 200
# Driver-side statistics are kept per class; beyond this the target is not a class label.
MAX_CLASSES = 10_000


@dataclass(frozen=True)
class Matrix:
    """A prepared table and the roles of its columns."""

    df: DataFrame
    keys: tuple[str, ...]
    label: str = "label"
    features: object = "features"
    fold: str = "fold"
    task: str = "classification"

    def with_df(self, df: DataFrame) -> "Matrix":
        return Matrix(df, self.keys, self.label, self.features, self.fold, self.task)


class Model:
    """A fitted model: ``transform`` adds ``prediction`` by column expressions."""

    task = "classification"
    names: list[str] = []

    def prediction(self, df: DataFrame) -> Column:
        raise NotImplementedError

    def transform(self, df: DataFrame) -> DataFrame:
        return df.withColumn("prediction", self.prediction(df))

    def importances(self) -> list[float] | None:
        return None

    def score(self, df: DataFrame, label: str) -> float | None:
        """Accuracy, or R2 (none for a constant target)."""
        measure = accuracy if self.task == "classification" else r2_plain
        return self.transform(df).agg(measure(F.col(label), F.col("prediction"))).first()[0]

    def importance_table(self, spark) -> DataFrame:
        scores = feature_importance(self, self.names)
        rows = [(i, name, score) for i, (name, score) in enumerate(scores)]
        return spark.createDataFrame(rows, "position int, feature string, importance double")


def has_wide(df: DataFrame, features) -> bool:
    """Whether the feature array holds columns of sparse indicators."""
    return not isinstance(features, (list, tuple)) and bool(df.schema[features].metadata.get("wide"))


def feature_importance(model: Model, names: list[str]) -> list[tuple[str, float]]:
    """Normalised importances, largest first; uniform when a family has none of its own."""
    scores = model.importances()
    scores = np.array(scores if scores is not None else [1.0] * len(names), dtype=float)
    scores = scores / (scores.sum() + IMPORTANCE_EPS)
    order = np.argsort(-scores, kind="stable")
    return [(names[i], float(scores[i])) for i in order]


def absolute_share(weights: np.ndarray) -> list[float]:
    size = np.abs(weights)
    return (size / (size.sum() + IMPORTANCE_EPS)).tolist()


def explode_configs(m: Matrix, scores: Column, k: int) -> DataFrame:
    """One row per configuration from an array of per-configuration predictions.

    Rows with a fold number of k or more only ever train.
    """
    held_out = m.df.where(F.col(m.fold) < k)
    scored = held_out.select(F.col(m.fold).alias("fold"), F.col(m.label).cast("double").alias("label"),
                             F.posexplode(scores).alias("config", "prediction"))
    return scored.select("config", "fold", "label", "prediction")


def by_fold(m: Matrix, k: int, expr) -> Column:
    """``expr(f)`` for rows of fold f, the expression of the model that did not see them."""
    column = None
    for f in range(k):
        branch = (F.col(m.fold) == f, expr(f))
        column = F.when(*branch) if column is None else column.when(*branch)
    return column


def class_counts(df: DataFrame, y: str, name: str) -> tuple[dict[float, int], int]:
    """Rows per distinct label, and the table's number of partitions."""
    counts = with_partition(df).groupBy(y).agg(F.count(F.lit(1)).alias("n"), partition_count())
    rows = counts.limit(MAX_CLASSES + 1).collect()
    if len(rows) > MAX_CLASSES:
        raise ValueError(f"'{name}' has more than {MAX_CLASSES} classes; use regression")
    return {r[y]: r["n"] for r in rows}, max([r["partitions"] for r in rows], default=1)


def list_array(matrix: np.ndarray) -> pa.Array:
    """An (rows, width) matrix as an Arrow list column."""
    rows, width = matrix.shape
    offsets = np.arange(rows + 1, dtype=np.int32) * width
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(matrix.ravel()))
