"""Pearson correlation of all column pairs, from one pass over the table."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ..functions.scalar import EPS, as_column
from .linalg import WIDE, block

SCHEMA = "col_i string, col_j string, r double"


def _parts(x: Column, y: Column):
    """Count, co-moment and both spreads over the rows in which both cells are present.

    The built-in aggregates merge central moments pairwise, so nothing cancels and no first pass
    for the means is needed. ``corr`` itself fails on constant columns under ANSI mode.
    """
    both = x.isNotNull() & y.isNotNull()
    n = F.count_if(both)
    return (n, F.covar_pop(x, y) * n, F.var_pop(F.when(both, x)) * n, F.var_pop(F.when(both, y)) * n)


def _constant(x: Column, y: Column) -> Column:
    """Whether either column is constant. Merged moments are not exactly zero then, so the range
    decides."""
    return (F.min(x) == F.max(x)) | (F.min(y) == F.max(y))


def pearson_correlation(x, y) -> Column:
    """Guarded correlation as an aggregate; 0 when either column is constant."""
    x, y = as_column(x), as_column(y)
    _, sxy, sxx, syy = _parts(x, y)
    return F.when(_constant(x, y), F.lit(0.0)).otherwise(sxy / (F.sqrt(sxx * syy) + F.lit(EPS)))


def plain_correlation(x, y) -> Column:
    """Correlation without the guard; null when either column is constant."""
    x, y = as_column(x), as_column(y)
    _, sxy, sxx, syy = _parts(x, y)
    return F.when(~_constant(x, y), sxy / F.nullif(F.sqrt(sxx * syy), F.lit(0.0)))


def correlation_matrix(df: DataFrame, columns: list[str], guarded: bool = True) -> DataFrame:
    """Long matrix ``(col_i, col_j, r)`` including both triangles and the diagonal."""
    if not guarded and len(columns) < 2:
        return df.sparkSession.createDataFrame([], SCHEMA)
    if len(columns) > WIDE:
        return _wide_matrix(df, columns, guarded)
    measure = pearson_correlation if guarded else plain_correlation
    cells = []
    for i, a in enumerate(columns):
        for b in columns[i:]:
            r = measure(F.col(f"`{a}`").cast("double"), F.col(f"`{b}`").cast("double"))
            cells.append(F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), r.alias("r")))
    upper = df.agg(F.array(*cells).alias("cells")).select(F.inline("cells"))
    mirrored = F.array(
        F.struct(F.col("a").alias("col_i"), F.col("b").alias("col_j"), "r"),
        F.struct(F.col("b").alias("col_i"), F.col("a").alias("col_j"), "r"),
    )
    sides = F.when(F.col("a") == F.col("b"), F.slice(mirrored, 1, 1)).otherwise(mirrored)
    return upper.select(F.inline(sides))


def _wide_matrix(df: DataFrame, columns: list[str], guarded: bool) -> DataFrame:
    """Many columns: sums over Arrow blocks, shifted by the means, one small matrix per task.

    ``n``, ``sx`` and ``sxx`` count only the rows in which both cells are present.
    """
    d, named = len(columns), [F.col(f"`{c}`").cast("double") for c in columns]
    first = df.agg(*[F.struct(F.avg(c), F.min(c) < F.max(c)).alias(f"c{i}") for i, c in enumerate(named)]).first()
    shift = np.array([s[0] or 0.0 for s in first])
    varies = np.array([bool(s[1]) for s in first])

    def partial(batches):
        sums = np.zeros((4, d, d))
        for batch in batches:
            x = np.array(block(batch.column("x"), d))
            have = ~np.isnan(x)
            x, m = np.where(have, x - shift, 0.0), have.astype(float)
            sums += np.stack([m.T @ m, x.T @ m, (x * x).T @ m, x.T @ x])
        yield pa.record_batch({"s": pa.array([sums.ravel().tolist()], pa.list_(pa.float64()))})

    cells = F.transform(F.array(*named), lambda v: F.coalesce(v, F.lit(float("nan")))).alias("x")
    parts = df.select(cells).mapInArrow(partial, "s array<double>")
    rows = parts.select(F.posexplode("s").alias("i", "v")).groupBy("i").agg(F.sum("v").alias("v")).collect()
    flat = np.zeros(4 * d * d)
    for r in rows:
        flat[r["i"]] = r["v"]
    n, sx, sxx, sxy = flat.reshape(4, d, d)
    with np.errstate(all="ignore"):
        spread = np.sqrt(np.maximum(sxx - sx * sx / n, 0) * np.maximum(sxx.T - sx.T * sx.T / n, 0))
        r = (sxy - sx * sx.T / n) / (spread + EPS if guarded else spread)
    r = np.where(np.outer(varies, varies), r, 0.0 if guarded else np.nan)
    rows = [(columns[i], columns[j], None if np.isnan(v) else float(v)) for (i, j), v in np.ndenumerate(r)]
    return df.sparkSession.createDataFrame(rows, SCHEMA)


def correlated_pairs(df: DataFrame, columns: list[str], threshold: float = 0.7) -> DataFrame:
    """Pairs, in column order, whose absolute correlation reaches the threshold."""
    place = {c: i for i, c in enumerate(columns)}
    matrix = correlation_matrix(df, columns, guarded=False)
    order = F.create_map(*[F.lit(v) for c in place.items() for v in c]) if place else None
    if order is None:
        return matrix
    return matrix.where(
        (order[F.col("col_i")] < order[F.col("col_j")]) & (F.abs("r") >= F.lit(float(threshold)))
    )
