"""Outliers by the interquartile rule: outside ``[q1 - 1.5 iqr, q3 + 1.5 iqr]``, strictly."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .quantiles import SMALL, approx_percentiles, exact_percentiles
from .typing import NUMERICAL, detect_column_types, typed


def iqr_bounds(df: DataFrame, columns: list[str], approximate: bool = False,
               small: int = SMALL) -> dict[str, tuple[float, float]]:
    if approximate:
        cuts = approx_percentiles(df, columns, [0.25, 0.75])
    else:
        cuts = exact_percentiles(df, columns, [0.25, 0.75], small)
    return {
        c: (q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1))
        for c, (q1, q3) in cuts.items() if q1 is not None
    }


def bounds_table(df: DataFrame, columns: list[str], **options) -> DataFrame:
    rows = [(c, lo, hi) for c, (lo, hi) in iqr_bounds(df, columns, **options).items()]
    return df.sparkSession.createDataFrame(rows, "column string, lower double, upper double")


def detect_outliers(
    df: DataFrame, keys: list[str], columns: list[str] | None = None,
    bounds: dict[str, tuple[float, float]] | None = None, **options,
) -> DataFrame:
    """(keys, column, value, lower, upper) for every outlying cell.

    The bounds enter the plan as literals and only outlying cells are expanded to rows, so the
    second scan is narrow: no join and no shuffle.
    """
    if columns is None:
        candidates = [c for c in df.columns if c not in keys]
        kinds = detect_column_types(df, candidates)
        columns = [c for c in candidates if kinds[c] == NUMERICAL]
    df = typed(df, {c: NUMERICAL for c in columns})
    bounds = bounds or iqr_bounds(df, columns, **options)
    cells = []
    for c in columns:
        if c not in bounds:
            continue
        (lo, hi), x = bounds[c], F.col(f"`{c}`")
        cells.append(F.when((x < lo) | (x > hi), F.struct(
            F.lit(c).alias("column"), x.alias("value"),
            F.lit(lo).alias("lower"), F.lit(hi).alias("upper"))))
    kept = F.filter(F.array(*cells), lambda s: s.isNotNull())
    return df.select(*keys, F.inline(kept))


def outlier_counts(df: DataFrame, columns: list[str], **options) -> DataFrame:
    """(column, lower, upper, outliers); columns without outliers are listed with 0."""
    bounds = iqr_bounds(df, columns, **options)
    cells = [
        F.struct(
            F.lit(c).alias("column"), F.lit(lo).alias("lower"), F.lit(hi).alias("upper"),
            F.count_if((F.col(f"`{c}`") < lo) | (F.col(f"`{c}`") > hi)).alias("outliers"),
        )
        for c, (lo, hi) in bounds.items()
    ]
    return df.agg(F.array(*cells).alias("a")).select(F.inline("a"))


def outlier_values(outliers: DataFrame, column: str) -> DataFrame:
    """The outlying values of one column, as rows."""
    return outliers.where(F.col("column") == column).select("value")
