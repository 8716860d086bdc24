"""Linear regression by gradient descent on second moments.

The squared-error gradient depends on the table only through ``X'X``, ``X'y`` and the column sums,
so one pass over the table serves every learning rate and number of epochs, and per-fold moments
serve every cross-validation split: training moments are the merge of the other folds. Only tables
with very many features, whose squared width outgrows their rows, are descended pass by pass.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from ..functions.scalar import columns_of, linear, vector, width_of
from ..operators.linalg import Moments, block, merge_all, moments, solve_moments
from ..operators.sparse import feature_names, layout_of
from . import descent
from .base import (EXPRESSION_TERMS, Matrix, Model, absolute_share, by_fold, explode_configs, has_wide,
                   list_array)


# Beyond this many features the co-moments cost more than passes over the rows.
MANY_FEATURES = 300


def descend(m: Moments, lr: float, epochs: int) -> tuple[np.ndarray, float]:
    """Full-batch descent from zero; ``m`` holds the moments of (features, label)."""
    d = len(m.mean) - 1
    second, means = m.second() / m.n, m.mean
    a, c, x, y = second[:d, :d], second[:d, d], means[:d], means[d]
    w, b = np.zeros(d), 0.0
    with np.errstate(all="ignore"):
        for _ in range(epochs):
            step_w, step_b = a @ w + x * b - c, x @ w + b - y
            w, b = w - 2 * lr * step_w, b - 2 * lr * step_b
    return w, float(b)


class LinearModel(Model):
    task = "regression"

    def __init__(self, features, names, weights, bias):
        self.features, self.names, self.weights, self.bias = features, names, weights, bias

    def prediction(self, df: DataFrame) -> Column:
        return linear_scores(df, self.features, [[(self.weights, self.bias)]], None)[0]

    def importances(self):
        return absolute_share(self.weights)


class LinearRegression:
    """``solver="gd"`` runs the fixed number of epochs; ``"normal"`` solves least squares."""

    def __init__(self, lr: float = 0.01, epochs: int = 200, solver: str = "gd"):
        self.lr, self.epochs, self.solver = lr, epochs, solver

    def _solve(self, m: Moments):
        return solve_moments(m) if self.solver == "normal" else descend(m, self.lr, self.epochs)

    def _by_passes(self, df: DataFrame, features) -> bool:
        if has_wide(df, features):
            if self.solver == "normal":
                raise ValueError("columns of sparse indicators have no normal equations here: use solver='gd'")
            return True
        return self.solver != "normal" and width_of(df, features) > MANY_FEATURES

    def fit(self, df: DataFrame, label: str = "label", features="features") -> LinearModel:
        if self._by_passes(df, features):
            settings = [(2 * self.lr, self.epochs, -1)]
            (found,) = descent.descend(df, features, label, F.lit(0), settings, False)
            return LinearModel(features, feature_names(df, features), *found)
        columns = columns_of(df, features) + [F.col(label).cast("double")]
        found = moments(df, columns)
        if not found:
            raise ValueError("the table has no rows")
        w, b = self._solve(found[()])
        return LinearModel(features, feature_names(df, features), w, b)

    @classmethod
    def fit_matrix(cls, m: Matrix, params: dict, seed: int = 42) -> LinearModel:
        return cls(**params).fit(m.df, m.label, m.features)

    @classmethod
    def out_of_fold(cls, m: Matrix, configs: list[dict], k: int, seed: int = 42) -> DataFrame:
        made = [cls(**c) for c in configs]
        if all(c._by_passes(m.df, m.features) for c in made):
            settings = [(2 * c.lr, c.epochs, f) for c in made for f in range(k)]
            found = descent.descend(m.df, m.features, m.label, F.col(m.fold), settings, False)
            models = [found[i * k : (i + 1) * k] for i in range(len(made))]
        else:
            per_fold = moments(m.df, columns_of(m.df, m.features) + [F.col(m.label).cast("double")], [m.fold])
            train = [merge_all([v for g, v in per_fold.items() if g[0] != f]) for f in range(k)]
            models = [[c._solve(train[f]) for f in range(k)] for c in made]
        scores = linear_scores(m.df, m.features, models, m)
        return explode_configs(m, F.array(*scores), k)


def linear_scores(df, features, models, m: Matrix | None) -> list[Column]:
    """``x w + b`` per configuration; ``models[config][fold]`` is ``(weights, bias)``."""
    d, k = width_of(df, features), len(models[0])
    if d * k * len(models) <= EXPRESSION_TERMS and not has_wide(df, features):
        x = columns_of(df, features)
        if m is None:
            return [linear(x, *config[0]) for config in models]
        return [by_fold(m, k, lambda f: linear(x, *config[f])) for config in models]
    weights = np.array([[np.append(w, b) for w, b in config] for config in models])
    layout = layout_of(df, features)

    @F.arrow_udf("array<double>")
    def score(xs, folds):
        x = block(xs, d)
        fold = folds.to_numpy(zero_copy_only=False)
        out = np.full((len(x), len(weights)), np.nan)
        for f in range(k):
            rows = fold == f
            with np.errstate(all="ignore"):
                out[rows] = layout.scores(x[rows], weights[:, f])
        return list_array(out)

    scores = score(vector(df, features), F.col(m.fold) if m else F.lit(0))
    return [scores[c] for c in range(len(models))]
