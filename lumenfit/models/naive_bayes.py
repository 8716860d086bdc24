"""Gaussian naive Bayes from per-class moments.

One aggregate by class (and fold) is the whole fit; cross-validation merges the other folds'
moments, so all folds and smoothing values cost one pass for fitting and one for scoring.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ..functions.scalar import columns_of, names_of, total, vector, width_of
from ..operators.linalg import block
from ..operators.sparse import MODEL_CATEGORIES, Layout, layout_of
from ..session import durable
from .base import EXPRESSION_TERMS, Matrix, Model, by_fold, explode_configs, list_array

# Driver-side statistics are kept per class and fold; beyond this many groups fitting fails.
MAX_GROUPS = 100_000
# Up to this many features the moments of classes are column aggregates.
WIDE = 24


@dataclass
class ClassMoments:
    n: int
    mean: np.ndarray
    m2: np.ndarray

    def merge(self, o: "ClassMoments") -> "ClassMoments":
        n, gap = self.n + o.n, o.mean - self.mean
        return ClassMoments(n, self.mean + gap * (o.n / n), self.m2 + o.m2 + gap**2 * (self.n * o.n / n))


@dataclass
class Gaussians:
    """Classes in order with their priors, means and smoothed variances; for each column of sparse indicators also
    the log likelihood of its constant vector by class, and what a category adds to it by (class, category)."""

    classes: np.ndarray
    prior: np.ndarray
    mean: np.ndarray
    var: np.ndarray
    wide: list[tuple[np.ndarray, np.ndarray]] = field(default_factory=list)


def class_moments(df: DataFrame, label: str, features, by: list[str]) -> dict[tuple, ClassMoments]:
    """``{(class, *group): moments}``; every class and group is a merged aggregate."""
    if width_of(df, features) > WIDE:
        return _class_moments_by_block(df, label, features, by)
    columns = columns_of(df, features)
    named = df.select(F.col(label).cast("int").alias("_class"), *by,
                      *[c.alias(f"x{i}") for i, c in enumerate(columns)])
    cells = [F.count(F.lit(1)).alias("n")]
    cells.append(F.array(*[F.avg(f"x{i}") for i in range(len(columns))]).alias("mean"))
    cells.append(F.array(*[F.var_pop(f"x{i}") for i in range(len(columns))]).alias("var"))
    rows = named.groupBy("_class", *by).agg(*cells).limit(MAX_GROUPS + 1).collect()
    if len(rows) > MAX_GROUPS:
        raise ValueError(f"'{label}' has too many classes; use regression")
    return {
        (r["_class"], *[r[b] for b in by]): ClassMoments(
            r["n"], np.array(r["mean"]), np.array(r["var"]) * r["n"])
        for r in rows
    }


def _class_moments_by_block(df, label, features, by) -> dict[tuple, ClassMoments]:
    """Many features: each task reduces its Arrow batches to moments per group, and the partial
    moments of a group are merged in a second, small step."""
    d, merge = width_of(df, features), ClassMoments.merge
    group = F.concat_ws(":", F.col(label).cast("int").cast("string"), *[F.col(b).cast("string") for b in by])
    packed = df.select(group.alias("g"), vector(df, features).alias("x"))

    def as_batch(found):
        return pa.table({
            "g": pa.array(list(found)), "n": pa.array([m.n for m in found.values()], pa.int64()),
            "mean": list_array(np.array([m.mean for m in found.values()])),
            "m2": list_array(np.array([m.m2 for m in found.values()]))})

    def partial(batches):
        found: dict[str, ClassMoments] = {}
        for batch in batches:
            x, g = block(batch.column("x"), d), np.array(batch.column("g").to_pylist(), dtype=object)
            for name in set(g):
                rows = x[g == name]
                mean = rows.mean(axis=0)
                part = ClassMoments(len(rows), mean, ((rows - mean) ** 2).sum(axis=0))
                found[name] = merge(found[name], part) if name in found else part
        if found:
            yield from as_batch(found).to_batches()

    def merged_group(table):
        means, m2 = block(table.column("mean"), d), block(table.column("m2"), d)
        whole = None
        for n, mean, square in zip(table.column("n").to_pylist(), means, m2):
            part = ClassMoments(n, mean, square)
            whole = part if whole is None else merge(whole, part)
        return as_batch({table.column("g")[0].as_py(): whole})

    schema = "g string, n long, mean array<double>, m2 array<double>"
    rows = packed.mapInArrow(partial, schema).groupBy("g").applyInArrow(merged_group, schema)
    rows = rows.limit(MAX_GROUPS + 1).collect()
    if len(rows) > MAX_GROUPS:
        raise ValueError(f"'{label}' has too many classes; use regression")
    return {
        tuple(int(v) for v in r["g"].split(":")): ClassMoments(r["n"], np.array(r["mean"]), np.array(r["m2"]))
        for r in rows
    }


def dense_part(df: DataFrame, features, layout: Layout) -> tuple[DataFrame, object]:
    """The table and its dense features alone."""
    if not layout.wides:
        return df, features
    cells = F.transform(F.lit(layout.dense.tolist()), lambda i: F.get(features, i)) if len(layout.dense) else F.array().cast("array<double>")
    return df.withColumn("_dense", cells).withMetadata("_dense", {"width": len(layout.dense)}), "_dense"


def category_counts(df: DataFrame, label: str, features, by: list[str], layout: Layout) -> dict[tuple, list[np.ndarray]]:
    """``{(class, *group): [rows per category of each sparse column]}``; counts are merged before they are shuffled."""
    if not layout.wides:
        return {}
    codes = F.array(*[F.struct(F.lit(j).alias("j"), F.get(features, F.lit(w.slot)).cast("long").alias("code")) for j, w in enumerate(layout.wides)])
    cells = df.select(F.col(label).cast("int").alias("_class"), *by, F.inline(codes)).where("code >= 0")
    counts = durable(cells.groupBy("_class", *by, "j", "code").agg(F.count(F.lit(1)).alias("n")))
    if counts.count() > MODEL_CATEGORIES:
        raise ValueError(f"'{label}' has more than {MODEL_CATEGORIES} pairs of class and category")
    table, found = counts.toPandas(), {}
    for group, rows in table.groupby(["_class", *by]):
        cells = found[tuple(int(v) for v in group)] = [np.zeros(w.size) for w in layout.wides]
        for j, part in rows.groupby("j"):
            cells[int(j)][part["code"].to_numpy()] = part["n"].to_numpy()
    return found


def with_indicators(g: Gaussians, counts: dict[int, list[np.ndarray]], sizes: dict[int, int], smoothing: float, layout: Layout) -> Gaussians:
    """Add the likelihoods of sparse indicators: with the share of a class's rows in a category, an indicator's
    mean and variance are known, and all rows outside of the category share one likelihood."""
    for j, w in enumerate(layout.wides):
        zero = [np.zeros(w.size)] * len(layout.wides)
        share = np.array([counts.get(int(c), zero)[j] / sizes[int(c)] for c in g.classes])
        var = w.gap**2 * share * (1 - share) + smoothing
        base = (-0.5 * np.log(2 * np.pi * var) - (w.gap * share) ** 2 / (2 * var)).sum(axis=1)
        g.wide.append((base, w.gap**2 * (2 * share - 1) / (2 * var)))
    return g


def gaussians(moments: dict[int, ClassMoments], smoothing: float) -> Gaussians:
    classes = sorted(moments)
    n = sum(moments[c].n for c in classes)
    return Gaussians(
        np.array(classes, dtype=float),
        np.array([moments[c].n / n for c in classes]),
        np.array([moments[c].mean for c in classes]),
        np.array([moments[c].m2 / moments[c].n for c in classes]) + smoothing,
    )


def merged(moments: dict[tuple, ClassMoments], left_out: int) -> dict[int, ClassMoments]:
    """Class moments over all folds but one."""
    found: dict[int, ClassMoments] = {}
    for (c, fold), part in sorted(moments.items()):
        if fold != left_out:
            found[c] = found[c].merge(part) if c in found else part
    return found


def _expression(x: list[Column], g: Gaussians) -> Column:
    """Most likely class of a row, the smallest on a tie."""
    options = []
    constant = np.log(g.prior) - 0.5 * np.log(2 * np.pi * g.var).sum(axis=1)
    for c in range(len(g.classes)):
        terms = [(xj - F.lit(float(mu))) * (xj - F.lit(float(mu))) * F.lit(float(0.5 / v))
                 for xj, mu, v in zip(x, g.mean[c], g.var[c])]
        score = F.lit(float(constant[c])) - total(terms)
        options.append(F.struct(score.alias("s"), F.lit(-float(g.classes[c])).alias("c")))
    return -F.array_max(F.array(*options))["c"]


def _likeliest(x: np.ndarray, g: Gaussians, layout: Layout) -> np.ndarray:
    score = np.empty((len(x), len(g.classes)))
    dense = layout.plain(x)
    for c in range(len(g.classes)):
        constant = np.log(g.prior[c]) - 0.5 * np.log(2 * np.pi * g.var[c]).sum()
        score[:, c] = constant - ((dense - g.mean[c]) ** 2 / (2 * g.var[c])).sum(axis=1)
    for w, (base, added) in zip(layout.wides, g.wide):
        codes = w.codes(x)
        known = codes >= 0
        score += base
        score[known] += added[:, codes[known]].T
    return g.classes[score.argmax(axis=1)]


def nb_scores(df, features, models: list[list[Gaussians]], m: Matrix | None) -> list[Column]:
    """Predicted class per configuration; ``models[config][fold]``."""
    d, k = width_of(df, features), len(models[0])
    layout = layout_of(df, features)
    if sum(g.mean.size for config in models for g in config) <= EXPRESSION_TERMS and not layout.wides:
        x = columns_of(df, features)
        if m is None:
            return [_expression(x, config[0]) for config in models]
        return [by_fold(m, k, lambda f: _expression(x, config[f])) for config in models]

    @F.arrow_udf("array<double>")
    def score(xs, folds):
        x = block(xs, d)
        fold = folds.to_numpy(zero_copy_only=False)
        out = np.full((len(x), len(models)), np.nan)
        for f in range(k):
            rows = fold == f
            for c, config in enumerate(models):
                out[rows, c] = _likeliest(x[rows], config[f], layout)
        return list_array(out)

    scores = score(vector(df, features), F.col(m.fold) if m else F.lit(0))
    return [scores[c] for c in range(len(models))]


def _roles(df: DataFrame, label: str, features, layout: Layout) -> tuple:
    dense, name = dense_part(df, features, layout)
    return dense, label, name


def _dense_names(df: DataFrame, features, layout: Layout) -> list[str]:
    names = names_of(df, features)
    return [names[s] for s in layout.dense] if layout.wides else names


def _counts_without(counts: dict[tuple, list[np.ndarray]], left_out: int) -> dict[int, list[np.ndarray]]:
    """Category counts by class over all folds but one."""
    found: dict[int, list[np.ndarray]] = {}
    for (c, fold), cells in counts.items():
        if fold != left_out:
            found[c] = [a + b for a, b in zip(found[c], cells)] if c in found else cells
    return found


class GaussianNBModel(Model):
    def __init__(self, features, names, parameters: Gaussians):
        self.features, self.names, self.parameters = features, names, parameters
        self.dense = list(names)

    def prediction(self, df: DataFrame) -> Column:
        return nb_scores(df, self.features, [[self.parameters]], None)[0].cast("int")

    def to_table(self, spark) -> DataFrame:
        """``(class, prior, feature, mean, var)`` of the dense features."""
        g = self.parameters
        rows = [
            (int(g.classes[c]), float(g.prior[c]), name, float(g.mean[c, j]), float(g.var[c, j]))
            for c in range(len(g.classes)) for j, name in enumerate(self.dense)
        ]
        return spark.createDataFrame(rows, "class int, prior double, feature string, mean double, var double")


class GaussianNB:
    def __init__(self, var_smoothing: float = 1e-9):
        self.var_smoothing = var_smoothing

    def fit(self, df: DataFrame, label: str = "label", features="features") -> GaussianNBModel:
        layout = layout_of(df, features)
        found = {c[0]: v for c, v in class_moments(*_roles(df, label, features, layout), []).items()}
        if not found:
            raise ValueError("the table has no rows")
        counts = {c[0]: v for c, v in category_counts(df, label, features, [], layout).items()}
        sizes = {c: v.n for c, v in found.items()}
        return GaussianNBModel(features, _dense_names(df, features, layout), with_indicators(gaussians(found, self.var_smoothing), counts, sizes, self.var_smoothing, layout))

    @classmethod
    def fit_matrix(cls, m: Matrix, params: dict, seed: int = 42) -> GaussianNBModel:
        return cls(**params).fit(m.df, m.label, m.features)

    @classmethod
    def out_of_fold(cls, m: Matrix, configs: list[dict], k: int, seed: int = 42) -> DataFrame:
        layout = layout_of(m.df, m.features)
        found = class_moments(*_roles(m.df, m.label, m.features, layout), [m.fold])
        train = [merged(found, f) for f in range(k)]
        counts = category_counts(m.df, m.label, m.features, [m.fold], layout)
        rest = [_counts_without(counts, f) for f in range(k)]

        def model(smoothing: float, f: int) -> Gaussians:
            return with_indicators(gaussians(train[f], smoothing), rest[f], {c: v.n for c, v in train[f].items()}, smoothing, layout)

        models = [[model(cls(**c).var_smoothing, f) for f in range(k)] for c in configs]
        scores = nb_scores(m.df, m.features, models, m)
        return explode_configs(m, F.array(*[s.cast("double") for s in scores]), k)
