"""Vector distances as column expressions over array columns (or literal vectors)."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .scalar import EPS, as_array


def _fold(a, b, term) -> Column:
    a, b = as_array(a).cast("array<double>"), as_array(b).cast("array<double>")
    return F.aggregate(F.zip_with(a, b, term), F.lit(0.0), lambda acc, x: acc + x)


def euclidean_distance(a, b) -> Column:
    return F.sqrt(_fold(a, b, lambda x, y: (x - y) * (x - y)))


def manhattan_distance(a, b) -> Column:
    return _fold(a, b, lambda x, y: F.abs(x - y))


def minkowski_distance(a, b, p: float = 3) -> Column:
    return F.pow(_fold(a, b, lambda x, y: F.pow(F.abs(x - y), F.lit(float(p)))), F.lit(1.0 / p))


def cosine_similarity(a, b) -> Column:
    dot = _fold(a, b, lambda x, y: x * y)
    norms = F.sqrt(_fold(a, a, lambda x, y: x * y)) * F.sqrt(_fold(b, b, lambda x, y: x * y))
    return dot / (norms + F.lit(EPS))


METRICS = {"euclidean": euclidean_distance, "manhattan": manhattan_distance}


def pairwise_distance(vectors, point, metric: str = "euclidean") -> Column:
    """Distance of every row's vector to one given vector. An unknown metric is an error."""
    if metric not in METRICS:
        raise ValueError(f"unknown metric {metric!r}; use one of {sorted(METRICS)}")
    return METRICS[metric](vectors, point)


def euclidean_distance_vectorized(vectors, point) -> Column:
    return euclidean_distance(vectors, point)
