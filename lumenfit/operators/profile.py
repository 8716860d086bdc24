"""Descriptive statistics and the column-by-column profile of a table."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..functions.scalar import EPS, as_column
from .quantiles import (SMALL, approx_percentiles, exact_percentiles, interpolate, rank_hits,
                        wanted_ranks)
from .typing import (BOOLEAN, CATEGORICAL, NUMERICAL, detect_column_types, is_missing, typed)

QUARTILES = [0.25, 0.5, 0.75]
PROFILE_SCHEMA = (
    "position int, column string, kind string, mean double, median double, mode string, std double, "
    "skew double, kurtosis double, n_unique bigint, missing bigint, lower double, upper double, "
    "outliers bigint"
)


# --- single aggregates -------------------------------------------------------------------------

def mean(c) -> Column:
    return F.avg(as_column(c))


def median(c) -> Column:
    """Exact middle value, for groups of bounded size; see ``exact_percentiles`` beyond that."""
    return F.median(as_column(c))


def mode(c) -> Column:
    """Most frequent value, the smallest on a tie; ``mode_table`` serves high cardinalities."""
    return F.mode(as_column(c), deterministic=True)


def variance(c) -> Column:
    return F.var_pop(as_column(c))


def std(c) -> Column:
    return F.stddev_pop(as_column(c))


def skewness(c) -> Column:
    """Mean cubed standard score with the guarded deviation.

    The built-in one-pass central moments are rescaled by the guard, so no second scan is needed.
    """
    c = as_column(c)
    s = F.stddev_pop(c)
    return F.when(s > 0, F.skewness(c) * F.pow(s / (s + EPS), F.lit(3.0))).when(s == 0, F.lit(0.0))


def kurtosis(c) -> Column:
    """Mean fourth power of the standard score (not the excess) with the guarded deviation."""
    c = as_column(c)
    s = F.stddev_pop(c)
    plain = (F.kurtosis(c) + 3.0) * F.pow(s / (s + EPS), F.lit(4.0))
    return F.when(s > 0, plain).when(s == 0, F.lit(0.0))


def value_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, value, n) for columns of one common type.

    A value that fills a third of the table is merged on the map side.
    """
    cells = df.select([F.col(f"`{c}`") for c in columns]).unpivot([], list(columns), "column", "value")
    return cells.where(F.col("value").isNotNull()).groupBy("column", "value").agg(
        F.count(F.lit(1)).alias("n"))


def mode_table(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, mode, n_unique): the most frequent value, the smallest on a tie."""
    return modes_of(value_counts(df, columns))


def modes_of(counts: DataFrame) -> DataFrame:
    """Modes from value counts by hash aggregates only: the highest count per column is found first
    and sent back (one row per column), so the counted values are never sorted."""
    top = counts.groupBy("column").agg(F.max("n").alias("top"), F.count(F.lit(1)).alias("n_unique"))
    hits = counts.join(F.broadcast(top), "column").where(F.col("n") == F.col("top"))
    return hits.groupBy("column").agg(F.min("value").alias("mode"), F.max("n_unique").alias("n_unique"))


# --- profile -----------------------------------------------------------------------------------

def profile(
    df: DataFrame, columns: list[str] | None = None, nan_policy: str = "skip",
    approximate: bool = False, small: int = SMALL,
) -> DataFrame:
    """One row per column with its kind and the statistics that apply to it.

    ``nan_policy="propagate"`` makes the moments of a column with missing cells NaN and reports
    no outliers for it. ``approximate=True`` uses sketches for percentiles and distinct counts.

    Scans: typing (text columns only), moments, percentiles, outlier counts, value counts. Only
    the last shuffles, and it shuffles merged value counts. Up to ``small`` rows the percentiles
    are read off the value counts as well.
    """
    if nan_policy not in ("skip", "propagate"):
        raise ValueError("nan_policy must be 'skip' or 'propagate'")
    columns = columns or df.columns
    kinds = detect_column_types(df, columns)
    data = typed(df.select([F.col(f"`{c}`") for c in columns]), kinds)
    numeric = [c for c in columns if kinds[c] == NUMERICAL]
    flags = [c for c in columns if kinds[c] == BOOLEAN]
    text = [c for c in columns if kinds[c] == CATEGORICAL]

    moments, n = _moments(data, numeric, flags, text)
    if approximate:
        cuts = approx_percentiles(data, numeric, QUARTILES)
        modes = _rough_counts(data, columns)
    elif n <= small:
        cuts, modes = _value_statistics(data, moments, numeric)
        modes.update(_modes(data, flags, text))
    else:
        cuts = exact_percentiles(data, numeric, QUARTILES, small)
        modes = _modes(data, numeric, flags, text)
    fences = {c: _fence(q) for c, q in cuts.items()}
    outliers = _outlier_counts(data, fences)

    rows = []
    for position, c in enumerate(columns):
        m, (mode_value, n_unique) = moments[c], modes.get(c, (None, 0))
        row = dict.fromkeys(("mean", "median", "std", "skew", "kurtosis", "lower", "upper"))
        row.update(position=position, column=c, kind=kinds[c], missing=m["missing"], n_unique=n_unique, outliers=0)
        row["mode"] = None if mode_value is None else str(mode_value)
        if kinds[c] == NUMERICAL:
            row.update({k: m[k] for k in ("mean", "std", "skew", "kurtosis")})
            row.update(median=cuts[c][1], lower=fences[c][0], upper=fences[c][1])
            row["outliers"] = outliers.get(c, 0)
            if nan_policy == "propagate" and m["missing"]:
                row.update(dict.fromkeys(("mean", "std", "skew", "kurtosis"), math.nan), outliers=0)
        elif kinds[c] == BOOLEAN:
            row["mean"] = m["mean"]
        rows.append(tuple(row[name.strip().split(" ")[0]] for name in PROFILE_SCHEMA.split(",")))
    return df.sparkSession.createDataFrame(rows, PROFILE_SCHEMA)


def _fence(q):
    if q[0] is None:
        return None, None
    width = q[2] - q[0]
    return q[0] - 1.5 * width, q[2] + 1.5 * width


def _moments(data, numeric, flags, text) -> tuple[dict[str, dict], int]:
    """Moments and missing cells per column, and the number of rows; one pass."""
    cells = []
    for c in numeric:
        x = F.col(f"`{c}`")
        cells.append(F.struct(
            F.count_if(x.isNull()).alias("missing"), F.count(x).alias("n"), F.avg(x).alias("mean"), std(x).alias("std"),
            skewness(x).alias("skew"), kurtosis(x).alias("kurtosis"),
        ).alias(c))
    for c in flags:
        x = F.col(f"`{c}`")
        cells.append(F.struct(F.count_if(x.isNull()).alias("missing"),
                              F.avg(x.cast("int")).alias("mean")).alias(c))
    for c in text:
        cells.append(F.struct(F.count_if(F.col(f"`{c}`").isNull()).alias("missing")).alias(c))
    row = data.agg(*cells, F.count(F.lit(1)).alias("#rows")).first()
    return {c: row[c].asDict() for c in numeric + flags + text}, row["#rows"]


def _outlier_counts(data, fences) -> dict[str, int]:
    cells = [
        F.count_if((F.col(f"`{c}`") < lo) | (F.col(f"`{c}`") > hi)).alias(c)
        for c, (lo, hi) in fences.items() if lo is not None
    ]
    return data.agg(*cells).first().asDict() if cells else {}


def _modes(data, *groups) -> dict[str, tuple]:
    """(mode, distinct values) per column; each group of columns has one type.
    Booleans count as 0 and 1."""
    found = {}
    flags = [c for group in groups for c in group if data.schema[c].dataType.simpleString() == "boolean"]
    data = data.withColumns({c: F.col(f"`{c}`").cast("double") for c in flags}) if flags else data
    for group in groups:
        if group:
            for r in mode_table(data, group).collect():
                found[r["column"]] = (r["mode"], r["n_unique"])
    return found


def _value_statistics(data, moments, numeric) -> tuple[dict, dict]:
    """Quartiles, modes and distinct counts of a table of bounded size, from value counts."""
    sizes = {c: moments[c]["n"] for c in numeric}
    ranks, values, modes = wanted_ranks(sizes, QUARTILES), {}, {}
    if numeric:
        counts = value_counts(data, numeric).persist()
        try:
            order = W.partitionBy("column").orderBy("value")
            ranked = counts.withColumn(
                "upto", F.sum("n").over(order.rowsBetween(W.unboundedPreceding, W.currentRow)))
            hit = rank_hits(ranks, F.col("column"), F.col("upto"), F.col("n"))
            for r in ranked.where(hit).collect():
                for c, rank in ranks:
                    if c == r["column"] and r["upto"] - r["n"] <= rank < r["upto"]:
                        values[(c, rank)] = r["value"]
            modes = {r["column"]: (r["mode"], r["n_unique"]) for r in modes_of(counts).collect()}
        finally:
            counts.unpersist()
    return interpolate(sizes, QUARTILES, values), modes


def _rough_counts(data, columns) -> dict[str, tuple]:
    cells = [F.approx_count_distinct(F.col(f"`{c}`")).alias(c) for c in columns]
    return {c: (None, n) for c, n in data.agg(*cells).first().asDict().items()}


def profile_summary(profiled: DataFrame) -> DataFrame:
    """Column lists by kind, in table order, and the totals of a profile, as one row."""
    placed = lambda kind: F.array_sort(F.collect_list(F.when(F.col("kind") == kind, F.struct("position", "column"))))
    named = lambda kind: placed(kind)["column"]
    return profiled.agg(
        F.count(F.lit(1)).alias("n_cols"),
        named(NUMERICAL).alias("numeric_cols"),
        named(CATEGORICAL).alias("categorical_cols"),
        F.sum("outliers").alias("outliers_flagged"),
        F.sum("missing").alias("missing_filled"),
    )


class DataInspector:
    """Profile a table, then ask for its correlated columns."""

    def __init__(self, nan_policy: str = "skip", approximate: bool = False):
        self.nan_policy, self.approximate = nan_policy, approximate
        self.column_types: dict[str, str] = {}
        self.profile: DataFrame | None = None

    def fit(self, df: DataFrame, columns: list[str] | None = None) -> dict:
        self.profile = profile(df, columns, self.nan_policy, self.approximate)
        rows = [r.asDict() for r in self.profile.collect()]
        self.column_types = {r["column"]: r["kind"] for r in rows}
        pick = lambda kind: [r["column"] for r in rows if r["kind"] == kind]
        return {
            "statistics": {r["column"]: r for r in rows},
            "column_types": self.column_types,
            "n_rows": df.count(),
            "n_cols": len(rows),
            "numeric_cols": pick(NUMERICAL),
            "categorical_cols": pick(CATEGORICAL),
            "outliers_flagged": sum(r["outliers"] for r in rows),
            "missing_filled": sum(r["missing"] for r in rows),
        }

    def _numeric(self):
        return [c for c, kind in self.column_types.items() if kind == NUMERICAL]

    def outliers(self, df: DataFrame, keys: list[str]) -> DataFrame:
        from .outliers import detect_outliers

        return detect_outliers(typed(df, self.column_types), keys, self._numeric())

    def correlation_matrix(self, df: DataFrame) -> DataFrame:
        from .correlation import correlation_matrix

        return correlation_matrix(typed(df, self.column_types), self._numeric(), guarded=False)

    def correlated_pairs(self, df: DataFrame, threshold: float = 0.7) -> DataFrame:
        from .correlation import correlated_pairs

        return correlated_pairs(typed(df, self.column_types), self._numeric(), threshold)
