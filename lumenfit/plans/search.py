"""Hyper-parameter search under cross-validation.

A family trains all its configurations and folds in shared passes (``out_of_fold``); one grouped
aggregate then gives every metric of every (configuration, fold). Folds are fixed by key and seed,
so configurations are compared on the same splits.
"""

from __future__ import annotations

import inspect
import itertools
import math
import random
import time
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, functions as F

from ..functions.metrics import METRICS, SEARCH_METRIC, TASK_METRICS, Metric
from ..models.base import Matrix, Model
from ..models.knn import KNearestNeighbors
from ..models.linear import LinearRegression
from ..models.logistic import LogisticRegression
from ..models.naive_bayes import GaussianNB
from ..models.tree import DecisionTree, RandomForest

# The default model families of each task and their parameter grids.
FAMILIES = {
    "classification": {
        "LogisticRegression": LogisticRegression,
        "DecisionTree_clf": DecisionTree,
        "RandomForest_clf": RandomForest,
        "KNN_clf": KNearestNeighbors,
        "GaussianNB": GaussianNB,
    },
    "regression": {
        "LinearRegression": LinearRegression,
        "DecisionTree_reg": DecisionTree,
        "RandomForest_reg": RandomForest,
        "KNN_reg": KNearestNeighbors,
    },
}
GRIDS = {
    "DecisionTree": {"max_depth": [3, 5], "min_samples_split": [2, 5]},
    "RandomForest": {"n_trees": [10, 30], "max_depth": [3, 5]},
    "LogisticRegression": {"lr": [0.01, 0.1], "epochs": [200]},
    "LinearRegression": {"lr": [0.01, 0.1], "epochs": [200]},
    "KNN": {"k": [3, 5], "metric": ["euclidean"]},
    "GaussianNB": {"var_smoothing": [1e-9, 1e-7]},
}


def default_grid(name: str) -> dict:
    return GRIDS.get(name.removesuffix("_clf").removesuffix("_reg"), {})


def generate_combinations(grid: dict) -> list[dict]:
    """Every combination of the grid's values, the last parameter varying fastest."""
    return [dict(zip(grid, values)) for values in itertools.product(*grid.values())]


def sample_params(grid: dict, generator: random.Random) -> dict:
    """One uniform choice per parameter."""
    return {name: generator.choice(values) for name, values in grid.items()}


def generic_out_of_fold(family, m: Matrix, configs: list[dict], k: int) -> DataFrame:
    """Out-of-fold predictions of any estimator with ``fit(df, label, features)`` -> ``transform``."""
    parts = []
    for i, params in enumerate(configs):
        for f in range(k):
            model = family(**params).fit(m.df.where(F.col(m.fold) != f), m.label, m.features)
            scored = model.transform(m.df.where(F.col(m.fold) == f))
            parts.append(scored.select(
                F.lit(i).alias("config"), F.lit(f).alias("fold"),
                F.col(m.label).cast("double").alias("label"), F.col("prediction").cast("double")))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def out_of_fold(family, m: Matrix, configs: list[dict], k: int, seed: int = 42,
                full: dict | None = None) -> DataFrame:
    """Out-of-fold predictions. Families that train in passes over the rows also put the models
    of all rows, by configuration number, into ``full``: they come almost for free."""
    method = getattr(family, "out_of_fold", None)
    if method is None:
        return generic_out_of_fold(family, m, configs, k)
    if full is not None and "full" in inspect.signature(method).parameters:
        return method(m, configs, k, seed, full=full)
    return method(m, configs, k, seed)


def fold_metrics(predictions: DataFrame, metrics: list[Metric]) -> DataFrame:
    """(config, fold, metric columns) from out-of-fold predictions."""
    y, p = F.col("label"), F.col("prediction")
    return predictions.groupBy("config", "fold").agg(*[m.expr(y, p).alias(m.name) for m in metrics])


def cross_validate(m: Matrix, family, configs: list[dict], k: int, metrics: list[Metric],
                   seed: int = 42) -> DataFrame:
    """Long ``(config, fold, metric, value)``."""
    wide = fold_metrics(out_of_fold(family, m, configs, k, seed), metrics)
    return wide.unpivot(["config", "fold"], [x.name for x in metrics], "metric", "value")


def mean_scores(folds: DataFrame) -> DataFrame:
    """(config, metric, value): mean over the folds."""
    return folds.groupBy("config", "metric").agg(F.avg("value").alias("value"))


def evaluate_model(m: Matrix, family, params: dict, k: int, metric: Metric | None = None,
                   seed: int = 42) -> float:
    """Mean fold score of one configuration."""
    metric = metric or SEARCH_METRIC[m.task]
    return mean_scores(cross_validate(m, family, [params], k, [metric], seed)).first()["value"]


@dataclass
class Scored:
    """One leaderboard line."""

    family: str
    params: dict
    scores: dict[str, float]
    seconds: float = 0.0
    status: str = "ok"


def better(metric: Metric, new: float | None, old: float | None) -> bool:
    """Whether ``new`` is strictly better; undefined scores never are."""
    if new is None or math.isnan(new):
        return False
    if old is None:
        return True
    return new > old if metric.higher_is_better else new < old


def usable_metrics(task: str, metric: Metric) -> list[Metric]:
    named = {name: METRICS[name] for name in TASK_METRICS[task]}
    named[metric.name] = metric
    return list(named.values())


@dataclass
class _Search:
    family: type
    param_grid: dict
    k: int = 5
    metric: Metric | None = None
    seed: int = 42
    name: str = ""
    best_params: dict | None = None
    best_score: float | None = None
    best_scores: dict = field(default_factory=dict)
    best_estimator: Model | None = None
    best_config: int | None = None
    lines: list[Scored] = field(default_factory=list)
    complete: dict[int, Model] = field(default_factory=dict)

    def configs(self) -> list[dict]:
        raise NotImplementedError

    def fit(self, m: Matrix, refit: bool = True):
        metric = self.metric or SEARCH_METRIC[m.task]
        wanted, configs = usable_metrics(m.task, metric), self.configs()
        start = time.time()
        predictions = out_of_fold(self.family, m, configs, self.k, self.seed, self.complete)
        folds = fold_metrics(predictions, wanted)
        rows = folds.collect()  # configurations times folds
        seconds = time.time() - start
        for i, params in enumerate(configs):
            mine = [r for r in rows if r["config"] == i]
            scores = {x.name: _mean([r[x.name] for r in mine]) for x in wanted}
            self.lines.append(Scored(self.name or self.family.__name__, params, scores,
                                     seconds / len(configs)))
            if better(metric, scores[metric.name], self.best_score):
                self.best_params, self.best_score = params, scores[metric.name]
                self.best_scores, self.best_config = scores, i
        if refit and self.best_params is not None:
            self.best_estimator = self.refit(m)
        return self

    def refit(self, m: Matrix) -> Model:
        """The best configuration on all rows."""
        if self.best_config in self.complete:
            return self.complete[self.best_config]
        if hasattr(self.family, "fit_matrix"):
            return self.family.fit_matrix(m, self.best_params, self.seed)
        return self.family(**self.best_params).fit(m.df, m.label, m.features)

    def leaderboard(self, spark) -> DataFrame:
        return leaderboard_table(spark, self.lines)


class GridSearch(_Search):
    """Every combination; the first of equally good ones wins."""

    def configs(self) -> list[dict]:
        return generate_combinations(self.param_grid)


@dataclass
class RandomSearch(_Search):
    """``n_iter`` draws with replacement; repeated draws are scored once."""

    n_iter: int = 10

    def configs(self) -> list[dict]:
        generator = random.Random(self.seed)
        draws = [sample_params(self.param_grid, generator) for _ in range(self.n_iter)]
        return [c for i, c in enumerate(draws) if c not in draws[:i]]


def _mean(values: list[float | None]) -> float:
    if not values or any(v is None for v in values):
        return math.nan
    return sum(values) / len(values)


LEADERBOARD = ("family string, params map<string,string>, scores map<string,double>, "
               "seconds double, status string")


def leaderboard_table(spark, lines: list[Scored]) -> DataFrame:
    rows = [
        (s.family, {k: str(v) for k, v in s.params.items()},
         {k: float(v) for k, v in s.scores.items()}, float(s.seconds), s.status)
        for s in lines
    ]
    return spark.createDataFrame(rows, LEADERBOARD)
