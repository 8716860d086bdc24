"""Fill missing cells: mean, median or mode for numbers, mode for everything else."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .profile import mode_table
from .quantiles import exact_percentiles
from .typing import BOOLEAN, NUMERICAL, detect_column_types, typed


class SimpleImputer:
    def __init__(self, strategy: str = "mean"):
        if strategy not in ("mean", "median", "mode", "most_frequent"):
            raise ValueError(f"unknown strategy {strategy!r}")
        self.strategy = strategy
        self.kinds: dict[str, str] = {}
        self.statistics: dict[str, object] = {}

    def fit(self, df: DataFrame, columns: list[str] | None = None) -> "SimpleImputer":
        columns = columns or df.columns
        self.kinds = detect_column_types(df, columns)
        data = typed(df.select([F.col(f"`{c}`") for c in columns]), self.kinds)
        numeric = [c for c in columns if self.kinds[c] == NUMERICAL]
        if self.strategy == "mean" and numeric:
            row = data.agg(*[F.avg(F.col(f"`{c}`")).alias(c) for c in numeric]).first()
            self.statistics.update(row.asDict())
        elif self.strategy == "median":
            cuts = exact_percentiles(data, numeric, [0.5])
            self.statistics.update({c: q[0] for c, q in cuts.items()})
        self._fit_modes(data, columns)
        for c in columns:
            if self.statistics.get(c) is None:
                raise ValueError(f"column '{c}' has no value to impute from")
        return self

    def _fit_modes(self, data, columns) -> None:
        """Modes for the columns still open, grouped by type so that each group is one count."""
        groups: dict[str, list[str]] = {}
        for c in columns:
            if c not in self.statistics:
                groups.setdefault(self.kinds[c], []).append(c)
        for group in groups.values():
            for r in mode_table(data, group).collect():
                self.statistics[r["column"]] = r["mode"]

    def transform(self, df: DataFrame) -> DataFrame:
        data = typed(df, self.kinds)
        fills = {}
        for c, fill in self.statistics.items():
            value = F.lit(bool(fill)) if self.kinds[c] == BOOLEAN else F.lit(fill)
            fills[c] = F.coalesce(F.col(f"`{c}`"), value)
        return data.withColumns(fills)

    def fit_transform(self, df: DataFrame, columns: list[str] | None = None) -> DataFrame:
        return self.fit(df, columns).transform(df)
