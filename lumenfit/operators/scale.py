"""Scalers for the numerical columns of a table; fitted statistics enter plans as literals."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.scalar import minmax_scale, normalize
from .typing import NUMERICAL, detect_column_types, typed


class _Scaler:
    def __init__(self):
        self.kinds: dict[str, str] = {}
        self.statistics: dict[str, tuple[float, float]] = {}

    def fit(self, df: DataFrame, columns: list[str] | None = None):
        self.kinds = detect_column_types(df, columns)
        numeric = [c for c, kind in self.kinds.items() if kind == NUMERICAL]
        data = typed(df, {c: NUMERICAL for c in numeric})
        cells = [F.struct(*self._aggregates(F.col(f"`{c}`"))).alias(c) for c in numeric]
        row = data.agg(*cells).first() if cells else {}
        self.statistics = {c: tuple(row[c]) for c in numeric if row[c][0] is not None}
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        data = typed(df, {c: NUMERICAL for c in self.statistics})
        return data.withColumns(
            {c: self._scaled(F.col(f"`{c}`"), *s) for c, s in self.statistics.items()}
        )

    def fit_transform(self, df: DataFrame, columns: list[str] | None = None) -> DataFrame:
        return self.fit(df, columns).transform(df)


class StandardScaler(_Scaler):
    """(x - mean) / (population deviation + guard)."""

    _aggregates = staticmethod(lambda c: [F.avg(c).alias("a"), F.stddev_pop(c).alias("b")])
    _scaled = staticmethod(normalize)


class MinMaxScaler(_Scaler):
    """(x - min) / (range + guard)."""

    _aggregates = staticmethod(lambda c: [F.min(c).alias("a"), F.max(c).alias("b")])
    _scaled = staticmethod(minmax_scale)
