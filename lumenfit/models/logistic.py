"""Logistic regression for 0/1 labels, by full-batch gradient descent or by L-BFGS."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.scalar import sigmoid
from ..operators.sparse import feature_names
from .base import Matrix, Model, absolute_share, explode_configs
from .descent import descend, minimise
from .linear import linear_scores


class LogisticModel(Model):
    def __init__(self, features, names, weights, bias):
        self.features, self.names, self.weights, self.bias = features, names, weights, bias

    def probability(self, df: DataFrame) -> Column:
        return sigmoid(linear_scores(df, self.features, [[(self.weights, self.bias)]], None)[0])

    def prediction(self, df: DataFrame) -> Column:
        return (self.probability(df) >= 0.5).cast("int")

    def importances(self):
        return absolute_share(self.weights)


class LogisticRegression:
    """``solver="gd"`` runs the fixed number of epochs; ``"lbfgs"`` goes on until no gradient entry exceeds ``tolerance``
    (at most ``epochs`` passes), with an optional ``l2`` penalty. Each of its passes is a distributed job, whatever the size."""

    def __init__(self, lr: float = 0.01, epochs: int = 200, solver: str = "gd", l2: float = 0.0, tolerance: float = 1e-6):
        if solver not in ("gd", "lbfgs"):
            raise ValueError("solver must be 'gd' or 'lbfgs'")
        if l2 and solver == "gd":
            raise ValueError("the penalty needs solver='lbfgs'")
        self.lr, self.epochs, self.solver, self.l2, self.tolerance = lr, epochs, solver, l2, tolerance
        self.passes = epochs

    def fit(self, df: DataFrame, label: str = "label", features="features") -> LogisticModel:
        if self.solver == "lbfgs":
            ((w, b),), self.passes = minimise(df, features, label, F.lit(0), [-1], True, self.l2, self.tolerance, self.epochs)
        else:
            (w, b), = descend(df, features, label, F.lit(0), [(self.lr, self.epochs, -1)], True)
        return LogisticModel(features, feature_names(df, features), w, b)

    @classmethod
    def fit_matrix(cls, m: Matrix, params: dict, seed: int = 42) -> LogisticModel:
        return cls(**params).fit(m.df, m.label, m.features)

    @classmethod
    def out_of_fold(cls, m: Matrix, configs: list[dict], k: int, seed: int = 42,
                    full: dict | None = None) -> DataFrame:
        """``full`` receives the models of all rows, trained in the same passes."""
        folds = [*range(k)] + ([-1] if full is not None else [])
        made = [cls(**c) for c in configs]
        plain = [c for c in made if c.solver == "gd"]
        settings = [(c.lr, c.epochs, f) for c in plain for f in folds]
        descended = iter(descend(m.df, m.features, m.label, F.col(m.fold), settings, True) if plain else [])
        found = []
        for c in made:
            if c.solver == "gd":
                found += [next(descended) for _ in folds]
            else:
                found += minimise(m.df, m.features, m.label, F.col(m.fold), folds, True, c.l2, c.tolerance, c.epochs)[0]
        models = [found[i * len(folds) :][:k] for i in range(len(configs))]
        if full is not None:
            for i in range(len(configs)):
                full[i] = LogisticModel(m.features, feature_names(m.df, m.features), *found[i * len(folds) + k])
        scores = linear_scores(m.df, m.features, models, m)
        return explode_configs(m, F.array(*[(sigmoid(z) >= 0.5).cast("double") for z in scores]), k)
