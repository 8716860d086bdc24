"""Indicators of text with any number of categories, as (index, value) pairs instead of columns.

A row has one category, so its indicators differ from a constant vector in one place. What is kept per row
is that place and by how much it differs; what is kept per category is its number of rows, a table. Everything that models
need of the indicators follows from sums per category: a dense column of them is never made, and a column of 1,001
categories means the same as one of 1,000.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.scalar import EPS
from ..session import durable, stored
from .encode import BROADCAST_BYTES, numbered
from .typing import is_missing

# Models hold a few numbers per category on the driver and in each task: 20 million are 160 MB.
MODEL_CATEGORIES = 20_000_000


@dataclass
class SparseOneHot:
    """The fitted categories of one column: a table ``(category, code, n)`` in code point order of the categories.

    Missing cells count as the most frequent category (the first of equally frequent ones). ``scaled`` gives
    standard scores of the indicators instead of 0 and 1.
    """

    column: str
    scaled: bool = False
    size: int = 0
    rows: int = 0
    fill: str | None = None
    small: bool = False
    path: str = ""

    def fit(self, df: DataFrame) -> "SparseOneHot":
        missing = is_missing(df, self.column)
        counts = df.groupBy(F.when(~missing, F.col(f"`{self.column}`").cast("string")).alias("category")).agg(F.count(F.lit(1)).alias("n"))
        counts = durable(counts)
        present = counts.where("category is not null")
        self.size, text, self.rows = counts.agg(F.count("category"), F.sum(F.octet_length("category")), F.sum("n")).first()
        if not self.size:
            raise ValueError(f"column '{self.column}' has no value to impute from")
        self.fill = present.orderBy(F.desc("n"), "category").first()["category"]
        self.small = text + 24 * self.size <= BROADCAST_BYTES
        whole = counts.withColumn("category", F.coalesce("category", F.lit(self.fill))).groupBy("category").agg(F.sum("n").alias("n"))
        codes = numbered(present, self.size)
        self.path = stored((F.broadcast(codes) if self.small else codes).join(whole, "category").select("category", "code", "n"))
        return self

    def table(self, spark: SparkSession) -> DataFrame:
        """``(category, code, n, mean, std)``: the indicator's moments over all fitted rows."""
        share = F.col("n") / F.lit(float(self.rows))
        return spark.read.parquet(self.path).withColumns({"mean": share, "std": F.sqrt(share * (1 - share))})

    def _off(self) -> Column:
        return (0.0 - F.col("mean")) / (F.col("std") + EPS) if self.scaled else F.lit(0.0)

    def _gap(self) -> Column:
        return 1.0 / (F.col("std") + EPS) if self.scaled else F.lit(1.0)

    def placed(self, df: DataFrame, code: str, gap: str) -> DataFrame:
        """Add the index of the row's category and what its indicator adds to the constant vector; unknown
        categories give -1 and 0."""
        lookup = self.table(df.sparkSession).select(F.col("category").alias("_category"), F.col("code").alias("_code"), self._gap().alias("_gap"))
        lookup = F.broadcast(lookup) if self.small else lookup
        filled = F.when(is_missing(df, self.column), F.lit(self.fill)).otherwise(F.col(f"`{self.column}`").cast("string"))
        joined = df.join(lookup, filled == F.col("_category"), "left")
        joined = joined.withColumns({code: F.coalesce("_code", F.lit(-1)).cast("long"), gap: F.coalesce("_gap", F.lit(0.0))})
        return joined.drop("_category", "_code", "_gap")

    def pairs(self, df: DataFrame, keep: list[str]) -> DataFrame:
        """Long rows ``(keep..., index, value)``: the one place of each row that is hot, and its value. All other
        places have the value of :meth:`base`. Rows of unknown categories have no hot place and no row here."""
        hot = self.placed(df, "index", "value").where(F.col("index") >= 0)
        if not self.scaled:
            return hot.select(*[F.col(f"`{c}`") for c in keep], "index", "value")
        base = self.base(df.sparkSession).select(F.col("index").alias("_index"), F.col("value").alias("_off"))
        joined = hot.join(F.broadcast(base) if self.small else base, F.col("index") == F.col("_index"))
        return joined.select(*[F.col(f"`{c}`") for c in keep], "index", (F.col("value") + F.col("_off")).alias("value"))

    def base(self, spark: SparkSession) -> DataFrame:
        """``(index, value)``: the constant vector of a row without any category."""
        return self.table(spark).select(F.col("code").alias("index"), self._off().alias("value"))

    def moments(self, df: DataFrame, columns: list[str], by: list[str] = ()) -> DataFrame:
        """Per category (and group): ``(by..., index, n, sum_<column>...)``, the products of the indicators with other columns."""
        cells = [F.sum(F.col(f"`{c}`").cast("double")).alias(f"sum_{c}") for c in columns]
        return self.placed(df, "index", "_gap").where("index >= 0").groupBy(*by, "index").agg(F.count(F.lit(1)).alias("n"), *cells)

    def metadata(self, slot: int) -> dict:
        return {"slot": slot, "size": self.size, "rows": self.rows, "scaled": self.scaled, "path": self.path, "column": self.column}


@dataclass
class Wide:
    """A sparse column inside a feature array: its code stands at ``slot``, its gap behind it. ``at`` is the place of its first
    indicator among all features; ``off`` and ``gap`` are the constant vector and what a category adds to its place."""

    slot: int
    at: int
    off: np.ndarray
    gap: np.ndarray

    @property
    def size(self) -> int:
        return len(self.off)

    def codes(self, x: np.ndarray) -> np.ndarray:
        return x[:, self.slot].astype(np.int64)


class Layout:
    """How an array of ``slots`` numbers stands for ``features`` features: most slots are a feature each."""

    def __init__(self, slots: int, wides: list[Wide]):
        self.slots, self.wides = slots, wides
        hidden = {s for w in wides for s in (w.slot, w.slot + 1)}
        self.dense = np.array([s for s in range(slots) if s not in hidden], int)
        self.features = len(self.dense) + sum(w.size for w in wides)
        place, self.at = 0, []
        sizes = {w.slot: w for w in wides}
        for s in range(slots):
            if s in sizes:
                sizes[s].at = place
                place += sizes[s].size
            elif s not in hidden:
                self.at.append(place)
                place += 1
        self.at = np.array(self.at, int)

    def place(self, slot: int, category: int | None = None) -> int:
        """Place among all features of a slot's feature, or of one category of a sparse slot."""
        if category is not None:
            return next(w.at for w in self.wides if w.slot == slot) + category
        return int(self.at[np.searchsorted(self.dense, slot)])

    def plain(self, x: np.ndarray) -> np.ndarray:
        """The dense features of a block of rows."""
        return x[:, self.dense] if self.wides else x

    def scores(self, x: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """Rows by models: the products with all features; ``weights`` are models by features and the bias last."""
        out = self.plain(x) @ weights[:, self.at].T + weights[:, -1]
        for w in self.wides:
            mine = weights[:, w.at:w.at + w.size]
            out += mine @ w.off
            codes = w.codes(x)
            known = codes >= 0
            out[known] += mine[:, codes[known]].T * w.gap[codes[known], None]
        return out

    def gradient(self, x: np.ndarray, error: np.ndarray, total: np.ndarray) -> None:
        """Add the products of all features with ``error`` (rows by models) to ``total`` (models by features and more)."""
        total[:, self.at] += error.T @ self.plain(x)
        for w in self.wides:
            codes = w.codes(x)
            known = codes >= 0
            gap = w.gap[codes[known]]
            whole = error.sum(axis=0)
            for m in range(len(total)):
                total[m, w.at:w.at + w.size] += np.bincount(codes[known], error[known, m] * gap, w.size) + whole[m] * w.off


def layout_of(df: DataFrame, features) -> Layout:
    """The layout of a feature array, with its categories' statistics; lists of columns and plain arrays are dense."""
    from ..functions.scalar import width_of

    wides = [] if isinstance(features, (list, tuple)) else df.schema[features].metadata.get("wide", [])
    total = sum(w["size"] for w in wides)
    if total > MODEL_CATEGORIES:
        raise ValueError(f"{total} categories: models hold up to {MODEL_CATEGORIES}")
    found = []
    for w in wides:
        counts = np.zeros(w["size"])
        table = df.sparkSession.read.parquet(w["path"]).select("code", "n").toPandas()  # two numbers per category, bounded above
        counts[table["code"].to_numpy()] = table["n"].to_numpy()
        share = counts / w["rows"]
        spread = np.sqrt(share * (1 - share)) + EPS
        off, gap = (-share / spread, 1.0 / spread) if w["scaled"] else (np.zeros(len(share)), np.ones(len(share)))
        found.append(Wide(int(w["slot"]), 0, off, gap))
    return Layout(width_of(df, features), found)


def feature_names(df: DataFrame, features) -> list[str]:
    """The names of all features; sparse columns stand for one per category, read from their tables."""
    from ..functions.scalar import names_of

    slots = names_of(df, features)
    wides = [] if isinstance(features, (list, tuple)) else df.schema[features].metadata.get("wide", [])
    if not wides:
        return slots
    by_slot = {int(w["slot"]): w for w in wides}
    hidden = {s + 1 for s in by_slot}
    names: list[str] = []
    for s, name in enumerate(slots):
        if s in by_slot:
            names += category_names(df.sparkSession, by_slot[s]["path"], by_slot[s]["column"], by_slot[s]["size"])
        elif s not in hidden:
            names.append(name)
    return names


def category_names(spark: SparkSession, path: str, column: str, size: int) -> list[str]:
    """``column_category`` in code order, for as many categories as models hold."""
    if size > MODEL_CATEGORIES:
        raise ValueError(f"{size} categories: models hold up to {MODEL_CATEGORIES}")
    table = spark.read.parquet(path).select("code", "category").toPandas().sort_values("code")
    return [f"{column}_{v}" for v in table["category"]]
