"""Scalar and vector column functions. All stay inside the JVM."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

# Fixed value: the guard added to denominators of statistics, metrics and distances.
EPS = 1e-8
# Fixed value: the guard used when importances are normalised.
IMPORTANCE_EPS = 1e-10


def as_column(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_array(v) -> Column:
    """A vector given as column, column name or list of numbers."""
    if isinstance(v, (list, tuple)):
        return F.array(*[F.lit(float(x)) for x in v])
    return as_column(v)


def safe_divide(a, b) -> Column:
    return as_column(a) / (as_column(b) + F.lit(EPS))


def sigmoid(z) -> Column:
    bounded = F.least(F.greatest(as_column(z), F.lit(-500.0)), F.lit(500.0))
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-bounded))


def softmax(v) -> Column:
    """Softmax of an array column; the row maximum is subtracted so that nothing underflows."""
    v = as_array(v)
    powers = F.transform(v, lambda x: F.exp(x - F.array_max(v)))
    total = F.aggregate(powers, F.lit(0.0), lambda acc, x: acc + x)
    return F.transform(powers, lambda x: x / total)


def normalize(c, mean, std) -> Column:
    """Standard score with the statistics the caller supplies."""
    return (as_column(c) - _number(mean)) / (_number(std) + F.lit(EPS))


def minmax_scale(c, low, high) -> Column:
    return (as_column(c) - _number(low)) / (_number(high) - _number(low) + F.lit(EPS))


def add_bias(v) -> Column:
    """Prepend the constant 1 to a vector."""
    return F.concat(F.array(F.lit(1.0)), as_array(v))


def _number(v) -> Column:
    return v if isinstance(v, Column) else F.lit(float(v))


def total(columns: list[Column]) -> Column:
    """Sum of columns as a balanced tree, which keeps wide expressions shallow."""
    if not columns:
        return F.lit(0.0)
    while len(columns) > 1:
        columns = [
            reduce(lambda a, b: a + b, columns[i : i + 2]) for i in range(0, len(columns), 2)
        ]
    return columns[0]


def linear(columns: list[Column], weights, bias: float = 0.0) -> Column:
    """``sum(column * weight) + bias`` as one generated expression."""
    terms = [c * F.lit(float(w)) for c, w in zip(columns, weights)]
    return total(terms) + F.lit(float(bias))


def columns_of(df, features) -> list[Column]:
    """The features as scalar columns: a list of names, or the name of one array column."""
    if isinstance(features, (list, tuple)):
        return [as_column(c).cast("double") for c in features]
    return [F.col(features)[i].cast("double") for i in range(width_of(df, features))]


def width_of(df, features) -> int:
    """Number of features; an array column carries it in its metadata or in its first row."""
    if isinstance(features, (list, tuple)):
        return len(features)
    meta = df.schema[features].metadata
    if "width" in meta:
        return int(meta["width"])
    row = df.select(F.size(features)).first()
    if row is None:
        raise ValueError("the table has no rows")
    return int(row[0])


def names_of(df, features) -> list[str]:
    if isinstance(features, (list, tuple)):
        return [str(c) for c in features]
    meta = df.schema[features].metadata
    return list(meta.get("names", [f"col_{i}" for i in range(width_of(df, features))]))


def vector(df, features) -> Column:
    """The features as one array column."""
    if isinstance(features, (list, tuple)):
        return F.array(*columns_of(df, features))
    return F.col(features).cast("array<double>")
