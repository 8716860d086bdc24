"""Linear algebra over tables: second moments, products, gradients and least squares.

A table with n rows and d features is reduced on the executors to d x d statistics; only those
reach the driver. Products of two large matrices are made of packed tiles.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from ..functions.scalar import columns_of, linear, names_of, vector
from ..session import durable

# Up to this many columns the moments are column aggregates; beyond it, Arrow blocks.
WIDE = 4
# A matrix side up to this many entries is broadcast in a product.
BROADCAST_ENTRIES = 1_000_000
# Side of a packed tile, and inner tiles that one group multiplies.
TILE = 256
INNER_TILES = 64
# Numbers in a strip of rows or columns of a product that is reduced by row, and in a piece of that product.
SIDE_CELLS = 4_000_000
PIECE_CELLS = 2_000_000


@dataclass
class Moments:
    """Row count, means and centred co-moments; two sets merge exactly (Chan et al.)."""

    n: int
    mean: np.ndarray
    comoment: np.ndarray

    def merge(self, other: "Moments") -> "Moments":
        n = self.n + other.n
        if not self.n or not other.n:
            return self if self.n else other
        gap = other.mean - self.mean
        mean = self.mean + gap * (other.n / n)
        comoment = self.comoment + other.comoment
        comoment = comoment + np.outer(gap, gap) * (self.n * other.n / n)
        return Moments(n, mean, comoment)

    def second(self) -> np.ndarray:
        """Uncentred sums of products."""
        return self.comoment + self.n * np.outer(self.mean, self.mean)


def merge_all(parts: list[Moments]) -> Moments:
    total = parts[0]
    for part in parts[1:]:
        total = total.merge(part)
    return total


def moments(df: DataFrame, columns: list[Column], by: list[str] | None = None) -> dict[tuple, Moments]:
    """``{group: Moments}`` of the given columns; groups are folds or classes, never rows."""
    by = by or []
    if len(columns) <= WIDE:
        return _moments_by_expression(df, columns, by)
    return _moments_by_block(df, columns, by)


def _moments_by_expression(df, columns, by):
    d = len(columns)
    named = df.select(*by, *[c.cast("double").alias(f"x{i}") for i, c in enumerate(columns)])
    cells = [F.count(F.lit(1)).alias("n")]
    cells += [F.avg(f"x{i}").alias(f"m{i}") for i in range(d)]
    cells += [F.covar_pop(f"x{i}", f"x{j}").alias(f"c{i}_{j}") for i in range(d) for j in range(i, d)]
    found = {}
    for r in named.groupBy(*by).agg(*cells).collect():
        if not r["n"]:
            continue
        c = np.zeros((d, d))
        for i in range(d):
            for j in range(i, d):
                c[i, j] = c[j, i] = r[f"c{i}_{j}"] * r["n"]
        found[tuple(r[b] for b in by)] = Moments(r["n"], np.array([r[f"m{i}"] for i in range(d)]), c)
    return found


def _moments_by_block(df, columns, by):
    """Wide tables: products of Arrow blocks, shifted by the overall means, summed per cell."""
    d = len(columns)
    packed = df.select(F.struct(*by).alias("g") if by else F.lit(0).alias("g"),
                       F.array(*columns).alias("x"))
    shift = packed.select([F.avg(F.col("x")[i]).alias(f"m{i}") for i in range(d)]).first()
    shift = np.array([0.0 if v is None else v for v in shift])
    kind = packed.schema["g"].dataType.simpleString()

    def partial(batches):
        sums: dict = {}
        keys: dict = {}
        for batch in batches:
            x = block(batch.column("x"), d) - shift
            groups = batch.column("g").to_pylist()
            labels = [repr(g) for g in groups]
            for label in set(labels):
                rows = x[np.array([k == label for k in labels])]
                keys.setdefault(label, groups[labels.index(label)])
                state = sums.setdefault(label, [0, np.zeros(d), np.zeros((d, d))])
                state[0] += len(rows)
                state[1] += rows.sum(axis=0)
                state[2] += rows.T @ rows
        for label, (n, s, ss) in sums.items():
            cells = np.concatenate([[float(n)], s, ss.ravel()])
            yield pa.record_batch({
                "g": pa.array([keys[label]], type=batch.schema.field("g").type),
                "cells": pa.array([cells.tolist()], type=pa.list_(pa.float64())),
            })

    parts = packed.mapInArrow(partial, f"g {kind}, cells array<double>")
    summed = parts.select("g", F.posexplode("cells").alias("i", "v")).groupBy("g", "i").agg(
        F.sum("v").alias("v")
    )
    cells: dict = {}
    for r in summed.collect():
        cells.setdefault(tuple(r["g"]) if by else (), np.zeros(1 + d + d * d))[r["i"]] = r["v"]
    found = {}
    for group, v in cells.items():
        n, s = int(v[0]), v[1 : 1 + d]
        found[group] = Moments(n, shift + s / n, v[1 + d :].reshape(d, d) - np.outer(s, s) / n)
    return found


def block(column: pa.Array, d: int) -> np.ndarray:
    """An Arrow list column as an (rows, d) matrix, without copying."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, d)


def gramian(df: DataFrame, features) -> DataFrame:
    """``X'X`` in long form ``(i, j, v)``, both triangles."""
    columns = columns_of(df, features)
    if len(columns) > WIDE:
        second = next(iter(moments(df, columns).values())).second()
        rows = [(i, j, float(v)) for (i, j), v in np.ndenumerate(second)]
        return df.sparkSession.createDataFrame(rows, "i int, j int, v double")
    named = df.select([c.alias(f"x{i}") for i, c in enumerate(columns)])
    cells = []
    for i in range(len(columns)):
        for j in range(i, len(columns)):
            s = F.sum(F.col(f"x{i}") * F.col(f"x{j}"))
            cells.append(F.struct(F.lit(i).alias("i"), F.lit(j).alias("j"), s.alias("v")))
    upper = named.agg(F.array(*cells).alias("a")).select(F.inline("a"))
    both = F.array(F.struct("i", "j", "v"), F.struct(F.col("j").alias("i"), F.col("i").alias("j"), "v"))
    return upper.select(F.inline(F.when(F.col("i") == F.col("j"), F.slice(both, 1, 1)).otherwise(both)))


def matrix_product(a: DataFrame, b: DataFrame) -> DataFrame:
    """``A B`` for matrices in long form ``(i, j, v)``; absent entries are zeros.

    A right side whose counted size allows it is broadcast, products being summed before they are shuffled; larger
    ones are multiplied by :func:`tiled_product`.
    """
    if b.limit(BROADCAST_ENTRIES + 1).count() <= BROADCAST_ENTRIES:
        left = a.select(F.col("i").alias("row"), F.col("j").alias("inner"), F.col("v").alias("x"))
        right = b.select(F.col("i").alias("inner"), F.col("j").alias("col"), F.col("v").alias("y"))
        products = left.join(F.broadcast(right), "inner")
        return products.groupBy(F.col("row").alias("i"), F.col("col").alias("j")).agg(F.sum(F.col("x") * F.col("y")).alias("v"))
    return tiled_product(a, b)


def tiled_product(a: DataFrame, b: DataFrame, tile: int = TILE, inner_tiles: int = INNER_TILES) -> DataFrame:
    """``A B`` for two large matrices in long form with whole numbers as indices.

    Both are packed into tiles of ``tile`` by ``tile``, and the tiles that belong to one tile of the result meet in groups of at
    most ``inner_tiles`` inner tiles, which multiply and add them up; a result tile of several groups is summed. No entry
    is joined on its inner index, so a full row or column is many tiles.
    """
    left = durable(_tiles(a, tile, "rows", "inner"))
    right = durable(_tiles(b, tile, "inner", "cols"))
    return _tile_products(left, right, tile, inner_tiles)


def _tile_products(left: DataFrame, right: DataFrame, tile: int, inner_tiles: int) -> DataFrame:
    """The entries of the product of two tables of tiles."""
    # Which tiles meet: the directory of the other side, a row per tile.
    to_cols = right.select("inner", "cols").withColumnRenamed("inner", "_k")
    to_rows = left.select("inner", "rows").withColumnRenamed("inner", "_k")
    group = ["rows", "cols", "part"]
    part = F.floor(F.col("inner") / inner_tiles).alias("part")
    # the aliases give each side its own columns, which a co-grouping of related tables needs
    own = [*(F.col(c).alias(c) for c in ("rows", "cols")), part, *(F.col(c).alias(c) for c in ("inner", "i", "j", "v"))]
    mine = left.join(to_cols, F.col("inner") == F.col("_k")).select(*own)
    theirs = right.join(to_rows, F.col("inner") == F.col("_k")).select(*own)

    def multiply(x: pa.Table, y: pa.Table) -> pa.Table:
        other = {k: r for r, k in enumerate(y.column("inner").to_pylist())}
        total = np.zeros((tile, tile))
        for r, k in enumerate(x.column("inner").to_pylist()):
            if k in other:
                total += _dense(x, r, tile) @ _dense(y, other[k], tile)
        i, j = np.nonzero(total)
        n = len(i)
        first = lambda c: (x if x.num_rows else y).column(c)[0].as_py() * tile
        return pa.table({"i": pa.array(i + first("rows") if n else i, pa.int64()), "j": pa.array(j + first("cols") if n else j, pa.int64()), "v": pa.array(total[i, j])})

    products = mine.groupBy(*group).cogroup(theirs.groupBy(*group)).applyInArrow(multiply, "i long, j long, v double")
    if _inner_span(left, right, inner_tiles) <= 1:
        return products  # every entry comes from one group
    return products.groupBy("i", "j").agg(F.sum("v").alias("v"))


def _inner_span(left: DataFrame, right: DataFrame, size: int = 1) -> int:
    """How many stretches of ``size`` inner tiles lie between the first and the last inner tile."""
    part = F.floor(F.col("inner") / size)
    low, high = left.select("inner").union(right.select("inner")).agg(F.min(part), F.max(part)).first()
    return 0 if low is None else high - low + 1


def product_rows(a: DataFrame, b: DataFrame, tile: int = TILE, inner_tiles: int = INNER_TILES, cells: int = SIDE_CELLS) -> DataFrame:
    """``(i, total, most, n)``: sum, maximum and number of the entries of each row of ``A B``, as :func:`tiled_product` gives them.

    The product itself is never written or shuffled: strips of rows and of columns, each of at most about ``cells`` numbers, meet in
    one group, which multiplies them piece by piece and keeps three numbers per row. A side is sent once for each strip of the other
    one. Where the inner side is longer than ``inner_tiles`` tiles, an entry is a sum over several groups and the entries are needed.
    """
    left = durable(_tiles(a, tile, "rows", "inner"))
    right = durable(_tiles(b, tile, "inner", "cols"))
    deep = _inner_span(left, right)
    if deep > inner_tiles:
        entries = _tile_products(left, right, tile, inner_tiles).where("v <> 0")
        return entries.groupBy("i").agg(F.sum("v").alias("total"), F.max("v").alias("most"), F.count(F.lit(1)).alias("n"))
    size = max(1, cells // (tile * tile * max(1, deep)))
    strip = lambda c: F.floor(F.col(c) / size)
    place = ["inner", "i", "j", "v"]
    left = left.select(strip("rows").alias("_r"), "rows", *place)
    right = right.select(strip("cols").alias("_c"), "cols", *place)
    pairs = left.select("_r", "inner").distinct().join(right.select("_c", "inner").distinct(), "inner").select(F.col("_r").alias("r"), F.col("_c").alias("c")).distinct()
    pairs = durable(pairs)
    pairs = F.broadcast(pairs) if pairs.limit(BROADCAST_ENTRIES + 1).count() <= BROADCAST_ENTRIES else pairs
    # the aliases give each side its own columns, which a co-grouping of related tables needs
    own = lambda side: [F.col(c).alias(c) for c in ("r", "c", side, *place)]
    mine = left.join(pairs, F.col("_r").eqNullSafe(F.col("r"))).select(*own("rows"))
    theirs = right.join(pairs, F.col("_c").eqNullSafe(F.col("c"))).select(*own("cols"))

    def multiply(x: pa.Table, y: pa.Table) -> pa.Table:
        out = {"i": np.zeros(0, np.int64), "total": np.zeros(0), "most": np.zeros(0), "n": np.zeros(0, np.int64)}
        if x.num_rows and y.num_rows:
            (row, xk, xv), (yk, col, yv) = _entries(x, "rows", "inner", tile), _entries(y, "inner", "cols", tile)
            inner = np.intersect1d(xk, yk)
            rows, a_ = _strip(row, xk, xv, inner)
            _, b_ = _strip(col, yk, yv, inner)
            found = []
            step = max(1, PIECE_CELLS // max(1, len(b_)))
            for start in range(0, len(rows), step):
                p = a_[start:start + step] @ b_.T
                n = np.count_nonzero(p, axis=1)
                some = n > 0
                most = p.max(axis=1) if n.min() == p.shape[1] else np.where(p != 0, p, -np.inf).max(axis=1, initial=-np.inf)
                found.append((rows[start:start + step][some], p.sum(axis=1)[some], most[some], n[some]))
            out = {c: np.concatenate(v) for c, v in zip(out, zip(*found))}
        return pa.table({"i": pa.array(out["i"], pa.int64()), "total": pa.array(out["total"]), "most": pa.array(out["most"]), "n": pa.array(out["n"], pa.int64())})

    parts = mine.groupBy("r", "c").cogroup(theirs.groupBy("r", "c")).applyInArrow(multiply, "i long, total double, most double, n long")
    return parts.groupBy("i").agg(F.sum("total").alias("total"), F.max("most").alias("most"), F.sum("n").alias("n"))


def _entries(table: pa.Table, rows: str, cols: str, tile: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row numbers, column numbers and values of all entries of packed tiles."""
    lists = [table.column(c).combine_chunks() for c in ("i", "j", "v")]
    lengths = np.diff(lists[0].offsets.to_numpy())
    i, j, v = (c.flatten().to_numpy() for c in lists)
    first = [np.repeat(table.column(c).to_numpy() * tile, lengths) for c in (rows, cols)]
    return first[0] + i, first[1] + j, v


def _strip(row: np.ndarray, k: np.ndarray, v: np.ndarray, inner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The occurring rows and their dense values at the inner places that both sides have."""
    rows, at = np.unique(row, return_inverse=True)
    out = np.zeros((len(rows), len(inner)))
    place = np.searchsorted(inner, k)
    known = np.isin(k, inner)
    out[at[known], place[known]] = v[known]
    return rows, out


def _tiles(a: DataFrame, tile: int, rows: str, cols: str) -> DataFrame:
    """Packed tiles ``(rows, cols, i, j, v)`` with places inside the tile; equal places are summed."""
    place = lambda c: F.pmod(F.col(c), F.lit(tile)).cast("int")
    cells = a.select(F.floor(F.col("i") / tile).alias(rows), F.floor(F.col("j") / tile).alias(cols), place("i").alias("i"), place("j").alias("j"), F.col("v").cast("double").alias("v"))
    cells = cells.groupBy(rows, cols, "i", "j").agg(F.sum("v").alias("v")).groupBy(rows, cols).agg(F.collect_list(F.struct("i", "j", "v")).alias("c"))
    return cells.select(rows, cols, F.col("c.i").alias("i"), F.col("c.j").alias("j"), F.col("c.v").alias("v"))


def _dense(table: pa.Table, row: int, tile: int) -> np.ndarray:
    out = np.zeros((tile, tile))
    i, j, v = (table.column(c)[row].values.to_numpy() for c in ("i", "j", "v"))
    out[i, j] = v
    return out


def transpose(a: DataFrame) -> DataFrame:
    return a.select(F.col("j").alias("i"), F.col("i").alias("j"), "v")


def to_matrix(df: DataFrame, key: str, features) -> DataFrame:
    """A table as long form ``(i = key, j = feature number, v)``."""
    x = F.posexplode(vector(df, features)).alias("j", "v")
    return df.select(F.col(key).alias("i"), x)


def gradient(df: DataFrame, features, label: str, weights: list[float], bias: float) -> DataFrame:
    """Mean squared-error gradient as ``(feature, value)`` rows, the bias last. One pass."""
    columns, names = columns_of(df, features), names_of(df, features)
    named = df.select(*[c.alias(f"x{i}") for i, c in enumerate(columns)],
                      F.col(label).cast("double").alias("y"))
    x = [F.col(f"x{i}") for i in range(len(columns))]
    errors = named.withColumn("e", linear(x, weights, bias) - F.col("y"))
    cells = [
        F.struct(F.lit(n).alias("feature"), F.avg(F.col("e") * c).alias("value"))
        for n, c in zip(names + ["bias"], x + [F.lit(1.0)])
    ]
    return errors.agg(F.array(*cells).alias("a")).select(F.inline("a"))


def least_squares(df: DataFrame, features, label: str, intercept: bool = True) -> DataFrame:
    """Coefficients ``(feature, value)`` minimising the squared error, the intercept last.

    From the triangular factor of the table (:func:`triangle`), which is as well conditioned as the table itself; products
    of columns would square its condition. Of equally good coefficients, as with collinear columns, the shortest are returned.
    """
    names, columns = names_of(df, features), columns_of(df, features)
    lead = [F.lit(1.0)] if intercept else []
    r = triangle(df, [*lead, *columns, F.col(label).cast("double")])
    # Behind the column of ones the factor is that of the centred table.
    at = len(lead)
    w = np.linalg.lstsq(r[at:-1, at:-1], r[at:-1, -1], rcond=1e-12)[0]
    rows = [(n, float(v)) for n, v in zip(names, w)]
    if intercept:
        rows.append(("intercept", float((r[0, -1] - r[0, 1:-1] @ w) / r[0, 0])))
    return df.sparkSession.createDataFrame(rows, "feature string, value double")


def triangle(df: DataFrame, columns: list[Column], fan: int = 16) -> np.ndarray:
    """The triangular factor R of a tall table (``R'R`` is its Gramian): tasks factor their blocks, and the factors are stacked and
    factored again, ``fan`` at a time, until one is left. Its size is that of the columns squared."""
    d = len(columns)
    rows = df.select(F.array(*columns).alias("x"))

    def factored(parts) -> np.ndarray:
        r = np.zeros((0, d))
        for part in parts:
            r = np.linalg.qr(np.vstack([r, part]), mode="r")
        return np.vstack([r, np.zeros((d - len(r), d))])

    def blocks(batches):
        context = TaskContext.get()
        r = factored(block(b.column("x"), d) for b in batches if b.num_rows)
        yield pa.record_batch({"node": pa.array([context.partitionId()], pa.int64()), "r": pa.array([r.tobytes()], pa.binary())})

    def stacked(table: pa.Table) -> pa.Table:
        order = np.argsort(np.asarray(table.column("node")))
        r = factored(np.frombuffer(table.column("r")[int(i)].as_py()).reshape(-1, d) for i in order)
        return pa.table({"node": pa.array([table.column("parent")[0].as_py()], pa.int64()), "r": pa.array([r.tobytes()], pa.binary())})

    level = durable(rows.mapInArrow(blocks, "node long, r binary"))
    while (n := level.count()) > 1:
        level = level.withColumn("parent", F.floor(F.col("node") / fan))
        level = durable(level.groupBy("parent").applyInArrow(stacked, "node long, r binary"))
    if not n:
        raise ValueError("the table has no rows")
    found = np.frombuffer(level.first()["r"]).reshape(d, d)
    if not found.any():
        raise ValueError("the table has no rows")
    return found


def solve_moments(m: Moments) -> tuple[np.ndarray, float]:
    """Least squares from the moments of (features, label)."""
    d = len(m.mean) - 1
    w = np.linalg.lstsq(m.comoment[:d, :d], m.comoment[:d, d], rcond=None)[0]
    return w, float(m.mean[d] - w @ m.mean[:d])
