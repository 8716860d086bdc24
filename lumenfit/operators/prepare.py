"""Impute, encode and scale a whole table in one fitted, reusable transform.

Fitting reads the table for the typing of text columns, once for all numeric statistics and once
for the category counts. The statistics of the encoded and imputed columns that the scaler needs
follow from those numbers, so no pass over the encoded table is made. The transform is a single
projection of column expressions.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.scalar import EPS, normalize
from .encode import MAX_WIDTH, LabelEncoder, OneHotEncoder, _bytes
from .profile import mode_table
from .quantiles import exact_percentiles
from .sparse import SparseOneHot, category_names
from .typing import (BOOLEAN, CATEGORICAL, NUMERICAL, detect_column_types, is_missing,
                     numeric_cell, require_column, typed)


# Indicators of a column with more categories than this are computed as one array.
FEW_CATEGORIES = 8


@dataclass
class _Piece:
    """The features one source column gives: names, means and deviations, and how to compute them."""

    source: str
    names: list[str]
    means: list[float]
    stds: list[float]
    kind: str
    fill: object
    categories: list[str] = field(default_factory=list)
    # Codes of a column with more categories than a literal should hold: joined, not looked up.
    encoder: LabelEncoder | None = None
    # Indicators of a column with more categories than columns should hold: (index, value) pairs.
    sparse: SparseOneHot | None = None

    def value(self) -> Column:
        """The source cell, filled."""
        x = F.col(f"`{self.source}`")
        if self.kind == CATEGORICAL:
            return F.coalesce(x, F.lit(self.fill))
        return F.coalesce(x.cast("double"), F.lit(float(self.fill)))

    @property
    def one_hot(self) -> bool:
        return self.kind == CATEGORICAL and len(self.names) > 1

    @property
    def joined(self) -> str:
        return f"_code of {self.source}"

    @property
    def slots(self) -> list[str]:
        """The numbers this piece takes in a feature array: a sparse piece is its code and its gap."""
        return [self.joined, f"_gap of {self.source}"] if self.sparse is not None else self.names

    def code(self) -> Column:
        if self.encoder is not None:
            return F.col(f"`{self.joined}`")
        encoder = LabelEncoder()
        encoder.mapping = {c: i for i, c in enumerate(self.categories)}
        return encoder.code(self.value())

    def columns(self, scale: bool) -> list[Column]:
        if self.one_hot:
            encoder = OneHotEncoder()
            encoder.categories = self.categories
            cells = [c.cast("double") for c in encoder.indicators(self.value())]
        else:
            cells = [self.code().cast("double") if self.kind == CATEGORICAL else self.value()]
        if not scale:
            return cells
        return [normalize(c, m, s) for c, m, s in zip(cells, self.means, self.stds)]

    def array(self, scale: bool) -> Column:
        """The features as an array. Wide indicators differ from a constant array in one place."""
        if self.sparse is not None:
            return F.array(*[F.col(f"`{c}`").cast("double") for c in self.slots])
        if len(self.names) <= FEW_CATEGORIES:
            return F.array(*self.columns(scale))
        off, on = [0.0] * len(self.names), [1.0] * len(self.names)
        if scale:
            off = [(0.0 - m) / (s + EPS) for m, s in zip(self.means, self.stds)]
            on = [(1.0 - m) / (s + EPS) for m, s in zip(self.means, self.stds)]
        # One lookup per row: the constant array with one place exchanged.
        hot = F.transform(F.array(self.code()), lambda code: F.when(code < 0, F.lit(off)).otherwise(F.concat(
            F.slice(F.lit(off), F.lit(1), code.cast("int")), F.array(F.get(F.lit(on), code.cast("int"))),
            F.slice(F.lit(off), code.cast("int") + 2, F.lit(len(off))))))
        return F.get(hot, 0)


@dataclass
class FittedPreprocessor:
    """The frozen transform: a projection of column expressions."""

    kinds: dict[str, str]
    pieces: list[_Piece]
    scale: bool
    scale_encoded: bool

    @property
    def feature_names(self) -> list[str]:
        """All features in order. Categories of sparse columns are read from their tables, which is bounded as
        the models are."""
        found = lambda s: category_names(SparkSession.active(), s.path, s.column, s.size)
        return [n for p in self.pieces for n in (found(p.sparse) if p.sparse is not None else p.names)]

    @property
    def fills(self) -> dict[str, object]:
        return {p.source: p.fill for p in self.pieces}

    @property
    def wide(self) -> list[str]:
        """Columns whose codes are joined from a table: sparse indicators, or ordinal codes."""
        return [p.source for p in self.pieces if p.encoder is not None or p.sparse is not None]

    @property
    def sparse(self) -> dict[str, SparseOneHot]:
        """The encoders of the columns whose indicators are (index, value) pairs."""
        return {p.source: p.sparse for p in self.pieces if p.sparse is not None}

    def _coded(self, df: DataFrame) -> DataFrame:
        for piece in self.pieces:
            if piece.encoder is not None:
                filled = df.withColumn(piece.joined, piece.value())
                df = piece.encoder.transform(filled, piece.joined)
            if piece.sparse is not None:
                df = piece.sparse.placed(df, *piece.slots)
        return df

    def _scaled(self, piece: _Piece) -> bool:
        return self.scale and (self.scale_encoded or piece.kind != CATEGORICAL)

    def transform(self, df: DataFrame, keep: list[str] | None = None) -> DataFrame:
        """Keep the given columns and add one double column per feature. A sparse column stays the number of its
        category (-1 if unknown); :meth:`pairs` gives its indicators."""
        cells = [c.alias(n) for p in self.pieces for n, c in zip(
            p.names, [F.col(f"`{p.joined}`").cast("double")] if p.sparse is not None else p.columns(self._scaled(p)))]
        return self._coded(typed(df, self.kinds)).select(*[F.col(f"`{c}`") for c in keep or []], *cells)

    def matrix(self, df: DataFrame, keep: list[str] | None = None) -> DataFrame:
        """Keep the given columns and add the features as one array column ``features``."""
        names = [n for p in self.pieces for n in p.slots]
        wide = [p.sparse.metadata(names.index(p.slots[0])) for p in self.pieces if p.sparse is not None]
        vector = F.concat(*[p.array(self._scaled(p)) for p in self.pieces])
        vector = vector.alias("features", metadata={"width": len(names), "names": names, **({"wide": wide} if wide else {})})
        return self._coded(typed(df, self.kinds)).select(*[F.col(f"`{c}`") for c in keep or []], vector)

    def pairs(self, df: DataFrame, column: str, keep: list[str]) -> DataFrame:
        """The indicators of a sparse column as long rows ``(keep..., index, value)``, see :class:`SparseOneHot`."""
        return self.sparse[column].pairs(df, keep)


class Preprocessor:
    """``fit`` returns the frozen transform; ``fit_transform`` applies it at once.

    Numbers pass, at most two categories become a code, more become indicators, and everything
    is standardised (``scale_encoded=False`` leaves codes and indicators alone). A ``scaler``
    other than "standard" scales nothing. ``encoding="ordinal"`` gives codes to all text, whatever
    its width. Text of more than ``max_width`` categories is indicators like any other, kept as
    (index, value) pairs (``wide="sparse"``); codes (``wide="ordinal"``) or an error are on request.
    """

    def __init__(self, scaler: str | None = "standard", imputer_strategy: str = "mean",
                 encoding: str = "auto", scale_encoded: bool = True, max_width: int = MAX_WIDTH, wide: str = "sparse"):
        if wide not in ("sparse", "ordinal", "error"):
            raise ValueError("wide must be 'sparse', 'ordinal' or 'error'")
        self.wide = wide
        self.scaler, self.strategy = scaler, imputer_strategy
        self.encoding, self.scale_encoded, self.max_width = encoding, scale_encoded, max_width

    def fit(self, df: DataFrame, columns: list[str]) -> FittedPreprocessor:
        kinds = detect_column_types(df, columns)
        data = typed(df.select([F.col(f"`{c}`") for c in columns]), kinds)
        numeric = [c for c in columns if kinds[c] != CATEGORICAL]
        text = [c for c in columns if kinds[c] == CATEGORICAL]
        numbers = self._numeric_statistics(data, kinds, numeric)
        wide = self._wide_columns(data, text)
        counts, rows = self._category_counts(data, [c for c in text if c not in wide])
        pieces = [
            self._number(c, numbers[c], kinds[c]) if kinds[c] != CATEGORICAL
            else self._sparse_category(data, c) if c in wide and self.wide == "sparse" and self.encoding != "ordinal"
            else self._wide_category(data, c) if c in wide else self._category(c, counts[c], rows) for c in columns
        ]
        return FittedPreprocessor(kinds, pieces, self.scaler == "standard", self.scale_encoded)

    def fit_transform(self, df: DataFrame, columns: list[str], keep: list[str] | None = None) -> DataFrame:
        return self.fit(df, columns).transform(df, keep)

    # --- fitting ---

    def _numeric_statistics(self, data, kinds, numeric) -> dict[str, dict]:
        if not numeric:
            return {}
        cells = []
        for c in numeric:
            x = F.col(f"`{c}`").cast("double")
            cells.append(F.struct(
                F.count(F.lit(1)).alias("rows"), F.count(x).alias("n"), F.avg(x).alias("mean"),
                F.var_pop(x).alias("var"),
            ).alias(c))
        row = data.agg(*cells).first()
        found = {c: row[c].asDict() for c in numeric}
        for c in numeric:
            if not found[c]["n"]:
                raise ValueError(f"column '{c}' has no value to impute from")
        # new rows may lack what the fitted rows had, so every column gets its fill
        plain = [c for c in numeric if kinds[c] == NUMERICAL]
        fills = {c: float(found[c]["mean"] > 0.5) for c in numeric if kinds[c] == BOOLEAN}
        if self.strategy == "mean":
            fills.update({c: found[c]["mean"] for c in plain})
        elif self.strategy == "median":
            fills.update({c: q[0] for c, q in exact_percentiles(data, plain, [0.5]).items()})
        elif plain:
            fills.update({r["column"]: r["mode"] for r in mode_table(data, plain).collect()})
        for c in numeric:
            found[c]["fill"] = fills[c]
        return found

    def _wide_columns(self, data, text) -> set[str]:
        """Text columns with more than ``max_width`` categories, counted no further than that."""
        found = {c for c in text if data.select(F.col(f"`{c}`")).where(F.col(f"`{c}`").isNotNull()).distinct().limit(self.max_width + 1).count() > self.max_width}
        if found and self.wide == "error" and self.encoding != "ordinal":
            raise self._too_wide(", ".join(sorted(found)))
        return found

    def _category_counts(self, data, text):
        """Counts per category of columns whose width has been checked."""
        if not text:
            return {}, None
        cells = data.select([F.col(f"`{c}`") for c in text]).unpivot([], text, "column", "value")
        counts: dict[str, dict] = {c: {} for c in text}
        # at most max_width categories of each column
        for r in cells.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n")).collect():
            counts[r["column"]][r["value"]] = r["n"]
        return counts, sum(counts[text[0]].values())

    def _wide_category(self, data, c) -> _Piece:
        """Codes in sorted order from a joined table; the scaler's statistics are aggregates over (code, n)."""
        encoder = LabelEncoder().fit(data, c)
        x = F.col(f"`{c}`")
        counts = data.groupBy(x.alias("category")).agg(F.count(F.lit(1)).alias("n"))
        present = counts.where("category is not null")
        fill = present.orderBy(F.desc("n"), "category").first()["category"]
        filled = counts.withColumn("category", F.coalesce("category", F.lit(fill))).groupBy("category").agg(F.sum("n").alias("n"))
        coded = filled.join(encoder.to_table(data.sparkSession), "category")
        mean = F.sum(F.col("code") * F.col("n")) / F.sum("n")
        whole = coded.agg(mean.alias("m")).first()["m"]
        var = coded.agg((F.sum(F.col("n") * F.pow(F.col("code") - whole, 2)) / F.sum("n")).alias("v")).first()["v"]
        return _Piece(c, [c], [whole], [math.sqrt(var)], CATEGORICAL, fill, encoder=encoder)

    def _sparse_category(self, data, c) -> _Piece:
        """Indicators at any width; the scaler's statistics are the shares of the categories."""
        found = SparseOneHot(c, self.scaler == "standard" and self.scale_encoded).fit(data)
        return _Piece(c, [c], [], [], CATEGORICAL, found.fill, sparse=found)

    def _too_wide(self, c):
        return ValueError(f"column '{c}' has more than {self.max_width} categories; drop it, "
                          "label-encode it or raise max_width")

    def _number(self, c, s, kind) -> _Piece:
        mean, var, fill, share = s["mean"], s["var"], s["fill"], s["n"] / s["rows"]
        whole = share * mean + (1 - share) * fill
        var = share * (var + (mean - whole) ** 2) + (1 - share) * (fill - whole) ** 2
        return _Piece(c, [c], [whole], [math.sqrt(var)], kind, fill)

    def _category(self, c, counts, rows) -> _Piece:
        present = {v: n for v, n in counts.items() if v is not None}
        if not present:
            raise ValueError(f"column '{c}' has no value to impute from")
        fill = min(present, key=lambda v: (-present[v], _bytes(v)))
        present[fill] += counts.get(None, 0)
        names = sorted(present, key=_bytes)
        shares = [present[v] / rows for v in names]
        if len(names) > 2 and self.encoding != "ordinal":
            return _Piece(c, [f"{c}_{v}" for v in names], shares, [math.sqrt(p * (1 - p)) for p in shares],
                          CATEGORICAL, fill, names)
        mean = sum(i * p for i, p in enumerate(shares))
        var = sum(p * (i - mean) ** 2 for i, p in enumerate(shares))
        return _Piece(c, [c], [mean], [math.sqrt(var)], CATEGORICAL, fill, names)


def clean_target(df: DataFrame, target: str) -> tuple[DataFrame, LabelEncoder | None]:
    """The target as a double column: numbers as they are, text as sorted codes.

    Rows without a target are left out (their number is ``missing_targets``).
    """
    require_column(df, target)
    present = df.where(~is_missing(df, target))
    if detect_column_types(df, [target])[target] != CATEGORICAL:
        return present.withColumn(target, numeric_cell(df, target)), None
    encoder = LabelEncoder().fit(present, target)
    coded = encoder.transform(present, target)
    return coded.withColumn(target, F.col(f"`{target}`").cast("double")), encoder


def missing_targets(df: DataFrame, target: str) -> int:
    return df.where(is_missing(df, target)).count()
