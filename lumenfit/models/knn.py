"""Exact k nearest neighbours as a partitioned join.

Plan, following the published pivot scheme for kNN joins (Lu et al., VLDB 2012):

1. A few training rows serve as pivots; every row is assigned to its nearest pivot's cell.
2. Per cell only sizes, radii and the k smallest pivot distances are collected. By the triangle
   inequality they bound the k-th neighbour distance of every query of a cell, and so the shell of
   each training cell that can hold a neighbour. Training rows outside every shell are not sent.
3. Cells are cut into hashed chunks of bounded size on both sides; each (query chunk, training
   chunk) meets in one group, which emits k candidates per query and never the pairs. Query cells that
   can rule out little are put together and meet the table in a few large chunks, all folds at once.
4. The candidates of a query are ranked by (distance, training key) and cut to k.

Narrow vectors go to the boxes of a tree of cuts instead of to pivots where boxes rule out most pairs: a few rows far off make a
pivot's cell so large that it meets the whole table, but not a box.

Copies of a training vector beyond the k smallest keys (per fold) cannot be neighbours of anything
and are removed by a group limit that works before the shuffle, so copied rows cost nothing.
"""

from __future__ import annotations

import heapq
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..functions.scalar import names_of, vector, width_of
from ..operators.linalg import block
from ..operators.split import row_hash
from ..session import durable
from .base import Matrix, Model, has_wide, list_array

CHUNK = 8_192
ROWS_PER_PIVOT = 4_000
MAX_PIVOTS = 256
METRICS = ("euclidean", "manhattan")


def distances(x: np.ndarray, points: np.ndarray, metric: str, wide: tuple[int, ...] = ()) -> np.ndarray:
    """Every row of x to every point; summed dimension by dimension. ``wide`` names the slots of sparse columns."""
    out = np.zeros((len(x), len(points)))
    for j in dense_slots(x.shape[1], wide):
        gap = x[:, j, None] - points[None, :, j]
        out += np.abs(gap) if metric == "manhattan" else gap * gap
    for j in wide:
        out += unlike(x[:, None, j:j + 2], points[None, :, j:j + 2], metric)
    return out if metric == "manhattan" else np.sqrt(out)


def dense_slots(width: int, wide: tuple[int, ...]) -> list[int]:
    hidden = {s for w in wide for s in (w, w + 1)}
    return [j for j in range(width) if j not in hidden]


def unlike(a: np.ndarray, b: np.ndarray, metric: str) -> np.ndarray:
    """What a sparse column adds to a distance: rows of one category agree in all indicators, others differ in two.
    The last axis is (code, gap)."""
    part = np.abs(a[..., 1]) + np.abs(b[..., 1]) if metric == "manhattan" else a[..., 1] ** 2 + b[..., 1] ** 2
    return np.where(a[..., 0] == b[..., 0], 0.0, part)


def nearest(q: np.ndarray, t: np.ndarray, k: int, metric: str, wide: tuple[int, ...] = ()):
    """Indices (query, training) of all pairs that may be among a query's k nearest.

    For the Euclidean metric a matrix product shortlists within its error margin.
    """
    if metric == "manhattan":
        rough, margin = distances(q, t, metric, wide), 0.0
    else:
        added = [unlike(q[:, None, j:j + 2], t[None, :, j:j + 2], metric) for j in wide]
        plain = dense_slots(q.shape[1], wide)
        q, t = (q[:, plain], t[:, plain]) if wide else (q, t)
        centre = t.mean(axis=0)
        a, b = q - centre, t - centre
        qq, tt = (a * a).sum(axis=1), (b * b).sum(axis=1)
        rough = qq[:, None] + tt[None, :] - 2.0 * (a @ b.T)
        rough = sum(added, rough)
        margin = 1e-9 * (qq[:, None] + tt.max() + sum((a.max() for a in added), 0.0))
    if k >= len(t):
        return np.nonzero(np.ones_like(rough, dtype=bool))
    limit = np.partition(rough, k - 1, axis=1)[:, k - 1 : k] + margin
    return np.nonzero(rough <= limit)


# Rows by columns of one piece of distances: whole numbers in a processor's cache, and matrix products.
PIECES = {"manhattan": (256, 512), "euclidean": (256, 8_192)}
# Rough distances that pass for more than this share of a piece are told apart by finer numbers.
TOO_MANY = 0.25


class _Shortlist:
    """Training rows prepared for :meth:`of`, which finds all pairs that may be among a query's k nearest.

    Pieces of rough distances with a known error are compared with the best bound so far of each query's k-th distance, so only
    the first piece is ranked. Squared Euclidean distances come from one matrix product. Manhattan distances are sums of
    ``max(q, t)``, since ``|q - t| = 2 max(q, t) - q - t``, over 16-bit numbers, or over floats where those are too coarse.
    """

    def __init__(self, t: np.ndarray, k: int, metric: str):
        self.t, self.k, self.metric = t, k, metric
        self.centre = t.mean(axis=0)
        moved = t - self.centre
        self.largest = np.abs(moved).max(initial=0.0)
        if metric == "euclidean":
            squares = (moved * moved).sum(axis=1)
            self.most, self.sides = squares.max(), np.c_[moved, squares].T
        else:
            self.moved, self.kinds = moved, {}

    def _numbers(self, rows: np.ndarray, kind) -> np.ndarray:
        if kind is np.float32:
            return rows.astype(kind)
        return np.clip(np.rint(rows / self.step), -self.high, self.high).astype(kind)

    def of(self, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        height, self.length = PIECES[self.metric]
        found = [self._some(q[start:start + height], start) for start in range(0, len(q), height)]
        return tuple(np.concatenate(c) for c in zip(*found))

    def _some(self, q: np.ndarray, start: int) -> tuple[np.ndarray, np.ndarray]:
        moved = q - self.centre
        bound, best = np.full(len(q), np.inf), np.full((len(q), self.k), np.inf)
        kind = None
        if self.metric == "euclidean":
            squares = (moved * moved).sum(axis=1)
            left, margin = np.c_[-2.0 * moved, np.ones(len(q))], 1e-9 * (squares + self.most)
        else:
            kind = np.int16 if np.abs(moved).max(initial=0.0) <= 2 * self.largest else np.float32
            side = self._side(moved, kind)
        held = [[], [], []]
        for at in range(0, len(self.t), self.length):
            if kind is None:
                rough = left @ self.sides[:, at:at + self.length]
                scale, shift, error = 1.0, squares, margin
            else:
                rough, scale, shift, error = self._sums(side, at, kind)
            if at == 0:
                kth = np.partition(rough, self.k - 1, axis=1)[:, self.k - 1] if rough.shape[1] >= self.k else np.full(len(q), np.inf)
                bound = np.minimum(bound, kth * scale + shift + error)
            a, b = self._passing(rough, self._limit(bound, scale, shift, error, rough.dtype))
            if kind is np.int16 and len(a) > TOO_MANY * rough.size and rough.shape[1] > 4 * self.k:
                kind = np.float32
                side = self._side(moved, kind)
                rough, scale, shift, error = self._sums(side, at, kind)
                a, b = self._passing(rough, self._limit(bound, scale, shift, error, rough.dtype))
            if not len(a):
                continue
            value = rough[a, b] * scale + shift[a]
            error = np.broadcast_to(error, len(q))[a]
            for c, v in zip(held, (a, b + at, value - error)):
                c.append(v)
            upper = value + error
            order = np.lexsort((upper, a))
            rank = np.arange(len(a)) - np.searchsorted(a, np.arange(len(q)))[a]  # a is sorted
            first = rank < self.k
            more = np.full((len(q), self.k), np.inf)
            more[a[first], rank[first]] = upper[order][first]
            best = np.partition(np.concatenate([best, more], axis=1), self.k - 1, axis=1)[:, :self.k]
            bound = np.minimum(bound, best[:, -1])
        if not held[0]:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        a, b, lower = (np.concatenate(c) for c in held)
        keep = lower <= bound[a]
        return a[keep] + start, b[keep]

    def _side(self, moved: np.ndarray, kind):
        """The queries' numbers and sums, once the training rows' are made."""
        if kind not in self.kinds:
            d = self.moved.shape[1]
            if kind is np.int16:
                # a sum of d terms of at most 1.5 times this size fits 16 bits; queries reach twice as far as training rows
                self.high = max(1, 32_000 * 2 // (3 * d))
                self.step = max(2 * self.largest / self.high, 1e-300)
            numbers = self._numbers(self.moved, kind)
            sums = numbers.sum(axis=1, dtype=np.int64 if kind is np.int16 else np.float64)
            half = (sums // 2 if kind is np.int16 else sums / 2).astype(kind)
            self.kinds[kind] = (np.ascontiguousarray(numbers.T), half)
        numbers = self._numbers(moved, kind)
        return numbers, numbers.sum(axis=1, dtype=np.int64 if kind is np.int16 else np.float64), np.abs(moved).sum(axis=1)

    def _sums(self, side, at: int, kind):
        """``(rough, scale, shift, error)``: a distance is ``rough * scale + shift``, give or take ``error``."""
        numbers, sums, sizes = side
        t, half = self.kinds[kind]
        t, half = t[:, at:at + self.length], half[at:at + self.length]
        out = np.repeat(-half[None, :], len(numbers), axis=0)
        larger = np.empty_like(out)
        for j in range(len(t)):
            np.maximum(numbers[:, j, None], t[j][None, :], out=larger)
            np.add(out, larger, out=out)
        d = len(t)
        if kind is np.int16:
            return out, 2.0 * self.step, -self.step * sums, self.step * (1.000001 * d + 2)
        return out, 2.0, -sums, 4 * (d + 8) * 2.0 ** -24 * (sizes + d * self.largest)

    @staticmethod
    def _passing(rough: np.ndarray, limit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return np.divmod(np.flatnonzero(rough <= limit[:, None]), rough.shape[1])

    @staticmethod
    def _limit(bound, scale, shift, error, kind):
        limit = (bound + error - shift) / scale
        if kind == np.int16:
            return np.clip(np.ceil(limit), -32_768, 32_767).astype(kind)
        return np.nextafter(limit.astype(kind), np.array(np.inf, kind))


def _search(q: np.ndarray, t: np.ndarray, place: np.ndarray, k: int, metric: str, wide: tuple[int, ...]):
    """``(query, training, dist)`` of the k nearest of ``t`` for each row of ``q``, ties by ``place``."""
    found = {"q": [], "t": [], "dist": []}
    plain = not wide and k < len(t) and q.shape[1] and np.abs(t).max(initial=0.0) < 1e15 and np.abs(q).max(initial=0.0) < 1e15
    finder = _Shortlist(t, k, metric).of if plain else None
    # without a shortlist a step's distances are a table
    step = 512 if plain else max(1, min(512, STEP_CELLS // max(1, len(t))))
    for start in range(0, len(q), step):
        _append(found, q, t, np.arange(start, min(start + step, len(q))), place, k, metric, wide, finder)
    return tuple(np.concatenate(v) for v in found.values())


# Distances that are worked out at once where nothing is known of them beforehand.
STEP_CELLS = 4_000_000


def _join_block(k: int, metric: str, d: int, exclude: bool, wide: tuple[int, ...]):
    """The group function: k candidates per query of a chunk from one training chunk. Queries with ``probed`` cells look at
    training rows of those cells only."""
    def run(queries: pa.Table, train: pa.Table) -> pa.Table:
        parts = []
        if queries.num_rows and train.num_rows:
            q, t = block(queries.column("x"), d), block(train.column("x"), d)
            place = key_places(train.column("tid"))
            qf, tf = queries.column("qf").to_numpy(), train.column("tf").to_numpy()
            # rows without a vector are not told apart here; with folds they are an error
            sizes = (queries.num_rows, train.num_rows) if exclude else (len(q), len(t))
            for mine, other in _meetings(queries, train, sizes):
                for fold in np.unique(qf[mine]) if exclude else [None]:
                    rows = mine if fold is None else mine[qf[mine] == fold]
                    held = other if fold is None else other[tf[other] != fold]
                    if len(held):
                        a, b, dist = _search(q[rows], t[held], place[held], k, metric, wide)
                        parts.append((rows[a], held[b], dist))
        mine, theirs, dist = (np.concatenate(c) for c in zip(*parts)) if parts else (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
        if "probed" in queries.column_names and len(mine):
            # of the candidates from several cells, k
            order = np.lexsort((place[theirs], dist, mine))
            mine, theirs, dist = mine[order], theirs[order], dist[order]
            keep = np.arange(len(mine)) - np.searchsorted(mine, mine) < k
            mine, theirs, dist = mine[keep], theirs[keep], dist[keep]
        return pa.table({
            "qid": queries.column("qid").take(pa.array(mine, pa.int64())),
            "tid": train.column("tid").take(pa.array(theirs, pa.int64())),
            "dist": pa.array(dist.astype(float)),
            "y": train.column("y").take(pa.array(theirs, pa.int64())),
        })
    return run


def _meetings(queries: pa.Table, train: pa.Table, sizes: tuple[int, int]):
    """Rows of both sides that meet: all, or for each cell those queries that probe it."""
    everyone = np.arange(sizes[0]), np.arange(sizes[1])
    probed = queries.column("probed").combine_chunks() if "probed" in queries.column_names else None
    if probed is None or not len(probed.flatten()):
        yield everyone
        return
    asked, cells = np.repeat(everyone[0], np.diff(probed.offsets.to_numpy())), probed.flatten().to_numpy()
    held = train.column("tcell").to_numpy()
    by_query, by_cell = np.argsort(cells, kind="stable"), np.argsort(held, kind="stable")
    for cell in np.unique(held):
        left, right = np.searchsorted(cells[by_query], [cell, cell + 1])
        if left < right:
            first, last = np.searchsorted(held[by_cell], [cell, cell + 1])
            yield asked[by_query[left:right]], by_cell[first:last]


def _append(found, q, t, rows, place, k, metric, wide=(), finder=None) -> None:
    """The k nearest of ``t`` for each of ``q[rows]``, ties by training key."""
    q = q[rows]
    a, b = finder(q) if finder else nearest(q, t, k, metric, wide)
    plain = dense_slots(q.shape[1], wide)
    gap = q[a] - t[b] if not wide else q[a][:, plain] - t[b][:, plain]
    dist = np.abs(gap).sum(axis=1) if metric == "manhattan" else (gap * gap).sum(axis=1)
    for j in wide:
        dist = dist + unlike(q[a, j:j + 2], t[b, j:j + 2], metric)
    dist = dist if metric == "manhattan" else np.sqrt(dist)
    order = np.lexsort((place[b], dist, a))
    a, b, dist = a[order], b[order], dist[order]
    starts = np.searchsorted(a, np.arange(len(q)))
    keep = np.arange(len(a)) - starts[a] < k
    found["q"].append(rows[a[keep]])
    found["t"].append(b[keep])
    found["dist"].append(dist[keep])


def neighbours(
    queries: DataFrame, train: DataFrame, k: int, metric: str = "euclidean", *, width: int,
    exclude_fold: bool = False, n_pivots: int | None = None, chunk: int = CHUNK, seed: int = 42,
    wide: tuple[int, ...] = (),
) -> DataFrame:
    """``(qid, tid, dist, y, rank)`` with rank 1..k. ``wide`` names the slots of sparse columns in ``x``.

    ``queries`` has ``qid, x array<double>, qf int``; ``train`` has ``tid, x, y double, tf int``;
    the keys may be of any orderable type. With ``exclude_fold`` a query ignores training rows of its own fold.
    """
    if metric not in METRICS:
        raise ValueError(f"unknown metric {metric!r}; use one of {METRICS}")
    if k < 1:
        raise ValueError("k must be at least 1")
    size = train.count()
    if not size:
        raise ValueError("no training rows")
    boxes = None if n_pivots or wide or width > BOX_WIDTH or size < 2 * ROWS_PER_BOX else _boxed(queries, train, k, metric, exclude_fold, chunk, size, width, seed)
    n_pivots = n_pivots or min(MAX_PIVOTS, size // ROWS_PER_PIVOT)
    if boxes is not None:
        pieces = boxes
    elif n_pivots > 1:
        pivots = _pivots(train, n_pivots, seed)
        queries = _assign(queries, pivots, metric, width, wide)
        # several small aggregates and the join read the reduced training rows
        train = durable(_without_copies(_assign(train, pivots, metric, width, wide), k, exclude_fold))
        pieces = _join_sides(queries, train, *_routes(queries, train, pivots, k, metric, exclude_fold, chunk, wide, width))
    else:
        train = _without_copies(train, k, exclude_fold)
        pieces = _one_cell_sides(queries, train, size, exclude_fold, chunk)
    schema = (f"qid {queries.schema['qid'].dataType.simpleString()}, "
              f"tid {train.schema['tid'].dataType.simpleString()}, dist double, y double")
    joined = pieces[0].groupBy("cell", "fold", "qc", "tc").cogroup(
        pieces[1].groupBy("cell", "fold", "qc", "tc")
    ).applyInArrow(_join_block(k, metric, width, exclude_fold, wide), schema)
    best = W.partitionBy("qid").orderBy("dist", "tid")
    return joined.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


def approximate_neighbours(
    queries: DataFrame, train: DataFrame, k: int, metric: str = "euclidean", *, width: int, probes: int = 8,
    cells: int | None = None, exclude_fold: bool = False, chunk: int = CHUNK, seed: int = 42, wide: tuple[int, ...] = (),
) -> DataFrame:
    """``(qid, tid, dist, y, rank)`` like :func:`neighbours`, found in the ``probes`` nearest of about ``sqrt(n)`` cells only.

    Training rows stand in the cell of their nearest pivot. A query goes to its nearest cells, where its distances are exact; what
    it can miss is a neighbour in a cell further off (:func:`recall` measures how many). Cells are cut into chunks of bounded size,
    so a cell with most of the rows is many groups.
    """
    if metric not in METRICS or k < 1 or probes < 1:
        raise ValueError(f"the metric is one of {METRICS}, k and probes are at least 1")
    size = train.count()
    if not size:
        raise ValueError("no training rows")
    pivots = _pivots(train, cells or max(1, min(MAX_CELLS, int(size ** 0.5))), seed)
    train = durable(_assign(train, pivots, metric, width, wide))
    # Cells next to each other share a pack of bounded size, a larger cell is a pack of several chunks: a row per pivot.
    size = train.count()
    large = _large(size, chunk, width)
    packs, chunks, room = {}, [], 0
    for r in sorted(train.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).collect()):
        if r["n"] > room:
            chunks.append(max(1, -(-r["n"] // large)))
            room = large * chunks[-1]
        packs[r["cell"]] = len(chunks) - 1
        room -= r["n"]
    pack_of = F.create_map(*[F.lit(v) for pair in packs.items() for v in pair])
    chunks_of = F.array(*[F.lit(n) for n in chunks])
    take = min(probes, len(pivots))

    @F.arrow_udf("array<int>")
    def nearest_cells(xs):
        x = block(xs, width)
        out = np.empty((len(x), take), np.int32)
        for start in range(0, len(x), 4096):
            away = distances(x[start : start + 4096], pivots, metric, wide)
            out[start : start + 4096] = np.argpartition(away, take - 1, axis=1)[:, :take]
        return list_array(out)

    # A query goes once to each pack that has one of its cells; where all cells are probed, their names are not needed.
    every = take == len(pivots)
    probed = F.array().cast("array<int>") if every else nearest_cells("x")
    asked = queries.select("qid", "x", "qf", probed.alias("probed"))
    places = F.array(*[F.lit(i) for i in range(len(chunks))]) if every else F.array_distinct(F.filter(F.transform("probed", lambda c: F.try_element_at(pack_of, c)), lambda c: c.isNotNull()))
    asked = asked.select("*", F.explode(places).alias("pack"))
    qcs = max(1, -(-queries.count() // large))
    left = asked.select("pack", F.explode(F.sequence(F.lit(0), F.get(chunks_of, F.col("pack")) - 1)).alias("tc"), F.pmod(F.xxhash64("qid"), F.lit(qcs)).cast("int").alias("qc"), "qid", "x", "qf", "probed")
    held = train.withColumn("pack", F.try_element_at(pack_of, F.col("cell")))
    # the aliases give each side its own columns, which a co-grouping of related tables needs
    right = held.select(
        F.col("pack").alias("pack"), F.pmod(F.xxhash64("tid"), F.get(chunks_of, F.col("pack"))).cast("int").alias("tc"), F.explode(F.sequence(F.lit(0), F.lit(qcs - 1))).alias("qc"),
        F.col("tid").alias("tid"), F.col("x").alias("x"), F.col("y").alias("y"), F.col("tf").alias("tf"), F.col("cell").alias("tcell"))
    schema = (f"qid {queries.schema['qid'].dataType.simpleString()}, tid {train.schema['tid'].dataType.simpleString()}, dist double, y double")
    group = ["pack", "tc", "qc"]
    joined = left.groupBy(*group).cogroup(right.groupBy(*group)).applyInArrow(_join_block(k, metric, width, exclude_fold, wide), schema)
    best = W.partitionBy("qid").orderBy("dist", "tid")
    return joined.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


# Cells of the approximate search, and queries that its recall is measured on.
MAX_CELLS = 4_096
RECALL_QUERIES = 500


def recall(found: DataFrame, queries: DataFrame, train: DataFrame, k: int, metric: str = "euclidean", *, width: int, seed: int = 42,
           sample: int = RECALL_QUERIES, **options) -> float:
    """Share of the exact ``k`` nearest distances that ``found`` reaches, over up to ``sample`` queries drawn by key hash."""
    drawn = durable(queries.withColumn("_h", row_hash(["qid"], seed)).orderBy("_h").limit(sample).drop("_h"))
    exact = neighbours(drawn, train, k, metric, width=width, **options).select(F.col("qid").alias("_q"), F.col("rank").alias("_r"), F.col("dist").alias("_d"))
    both = exact.join(found, (F.col("qid") == F.col("_q")) & (F.col("rank") == F.col("_r")), "left")
    return both.agg(F.avg(F.when(F.col("dist") <= F.col("_d") * (1 + 1e-9) + 1e-12, 1.0).otherwise(0.0))).first()[0]


def _without_copies(train: DataFrame, k: int, exclude: bool) -> DataFrame:
    """Of equal vectors (within a fold) only the k smallest keys can be anyone's neighbour."""
    copies = W.partitionBy("x", "tf") if exclude else W.partitionBy("x")
    numbered = train.withColumn("_c", F.row_number().over(copies.orderBy("tid")))
    return numbered.where(F.col("_c") <= k).drop("_c")


def _pivots(train: DataFrame, n: int, seed: int) -> np.ndarray:
    """Up to n different vectors, drawn by key hash."""
    rows = train.select("x", row_hash(["tid"], seed).alias("h")).orderBy("h").limit(4 * n).collect()
    return np.array(list(dict.fromkeys(tuple(r["x"]) for r in rows))[:n], dtype=float)


def _assign(df: DataFrame, pivots: np.ndarray, metric: str, width: int, wide: tuple[int, ...] = ()) -> DataFrame:
    """Add the nearest pivot's number ``cell`` and the distance to it ``away``."""
    @F.arrow_udf("array<double>")
    def locate(xs):
        x = block(xs, width)
        found = np.empty((len(x), 2))
        for start in range(0, len(x), 4096):
            away = distances(x[start : start + 4096], pivots, metric, wide)
            cell = away.argmin(axis=1)
            found[start : start + 4096, 0] = cell
            found[start : start + 4096, 1] = away[np.arange(len(cell)), cell]
        return list_array(found)

    placed = df.withColumn("_at", locate("x"))
    return placed.withColumns({"cell": F.col("_at")[0].cast("int"), "away": F.col("_at")[1]}).drop("_at")


# Rows of a box, about, and the most boxes; the rows that they are found from, and the numbers in those; the widest vectors; the share of
# all pairs from which on boxes do not pay, and the same share among the rows that they are found from, where bounds are looser.
ROWS_PER_BOX = 250
MAX_BOXES = 2_048
SAMPLED, SAMPLED_CELLS = 16_384, 1_000_000
BOX_WIDTH = 64
SHARE, SAMPLED_SHARE = 0.2, 0.3


class _Boxes:
    """A tree of cuts of single dimensions, by which every row belongs to one box.

    The box that costs most, in rows and width, is cut first, so that the few rows far off are cut as finely as the many in the middle.
    """

    def __init__(self, x: np.ndarray, most: int):
        self.axis, self.cut, self.low, self.high = [-1], [0.0], [0], [0]
        waiting, self.count = [self._entry(x, 0)], 1
        while waiting and self.count < most:
            cost, at, x = heapq.heappop(waiting)
            if not cost:
                break
            axis = int(np.argmax(np.ptp(x, axis=0)))
            values = x[:, axis]
            # between the middle of the rows and the middle of the box
            cut = (np.median(values) + (values.min() + values.max()) / 2) / 2
            below = values[values <= cut]
            cut = below.max() if len(below) and below.max() < values.max() else values.min()
            self.axis[at], self.cut[at] = axis, cut
            for side, some in ((self.low, x[values <= cut]), (self.high, x[values > cut])):
                side[at] = len(self.axis)
                for column, value in ((self.axis, -1), (self.cut, 0.0), (self.low, side[at]), (self.high, side[at])):
                    column.append(value)
                heapq.heappush(waiting, self._entry(some, side[at]))
            self.count += 1
        self.axis, self.cut, self.low, self.high = (np.array(c) for c in (self.axis, self.cut, self.low, self.high))

    @staticmethod
    def _entry(x: np.ndarray, at: int) -> tuple:
        return -len(x) * float(np.linalg.norm(np.ptp(x, axis=0))), at, x

    def of(self, x: np.ndarray) -> np.ndarray:
        at, rows = np.zeros(len(x), int), np.arange(len(x))
        while len(rows):
            rows = rows[self.axis[at[rows]] >= 0]
            here = at[rows]
            at[rows] = np.where(x[rows, self.axis[here]] <= self.cut[here], self.low[here], self.high[here])
        return at.astype(np.int32)


def _boxed(queries, train, k, metric, exclude, chunk, size, width, seed):
    """Both sides of the join by boxes, or none where boxes rule out too little.

    A box with k training rows (of other folds) bounds the k-th distance of every query of another by the distance of their
    furthest corners; boxes whose nearest points are further apart than that do not meet.
    """
    drawn = train.select("x", row_hash(["tid"], seed).alias("h")).orderBy("h").limit(min(SAMPLED, SAMPLED_CELLS // max(1, width))).collect()
    if any(r["x"] is None or len(r["x"]) != width or None in r["x"] for r in drawn):
        return None
    x = np.array([r["x"] for r in drawn], float)
    if not width or not np.isfinite(x).all():
        return None
    tree = _Boxes(x, min(MAX_BOXES, size // ROWS_PER_BOX))
    cells = tree.of(x)
    some = [x[cells == c] for c in np.unique(cells)]
    some = [{"cell": c, "fold": -1, "n": len(v), "ends": np.r_[v.min(axis=0), v.max(axis=0)]} for c, v in enumerate(some)]
    if len(some) < 2 or _box_routes(some, some, k, metric, False, chunk, width, SAMPLED_SHARE) is None:
        return None

    @F.arrow_udf("int")
    def locate(xs):
        return pa.array(tree.of(block(xs, width)), pa.int32())

    def corners(batches):
        """Per box and fold the rows of a task, and their least and largest numbers."""
        for batch in batches:
            if not batch.num_rows:
                continue
            x, box, fold = block(batch.column("x"), width), batch.column("cell").to_numpy(), batch.column("fold").to_numpy(zero_copy_only=False)
            order = np.lexsort((fold, box))
            x, box, fold = x[order], box[order], fold[order]
            starts = np.flatnonzero(np.r_[True, (box[1:] != box[:-1]) | (fold[1:] != fold[:-1])])
            yield pa.record_batch({
                "cell": pa.array(box[starts], pa.int32()), "fold": pa.array(fold[starts], pa.int32()), "n": pa.array(np.diff(np.r_[starts, len(x)]), pa.int64()),
                "low": list_array(np.minimum.reduceat(x, starts)), "high": list_array(np.maximum.reduceat(x, starts))})

    def described(df, fold):
        found = df.select("x", "cell", F.coalesce(F.col(fold).cast("int"), F.lit(-2)).alias("fold")).mapInArrow(corners, "cell int, fold int, n long, low array<double>, high array<double>")
        ends = [f(F.get(c, F.lit(j))) for f, c in ((F.min, "low"), (F.max, "high")) for j in range(width)]
        return found.groupBy("cell", "fold").agg(F.sum("n").alias("n"), F.array(*ends).alias("ends")).collect()

    train = _without_copies(train.withColumn("cell", locate("x")), k, exclude)
    train, queries = durable(train), queries.withColumn("cell", locate("x"))
    held, asked = described(train, "tf"), described(queries, "qf")
    places = _box_routes(held, asked, k, metric, exclude, chunk, width)
    if places is None:
        return None
    places, routes = (queries.sparkSession.createDataFrame(rows, schema) for rows, schema in zip(places, (BOX_PLACES, BOX_ROUTES)))
    numbers = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    left = queries.join(F.broadcast(places), "cell").select(
        "cell", F.lit(-1).alias("fold"), F.pmod(F.xxhash64("qid"), "qcs").alias("qc"), "qid", "x", "qf", numbers("tcs").alias("tc"))
    right = train.join(F.broadcast(routes), F.col("cell") == F.col("tcell"))
    # the aliases give each side its own columns, which a co-grouping of related tables needs
    right = right.select(F.col("qcell").alias("cell"), F.lit(-1).alias("fold"), numbers("qcs").alias("qc"), F.pmod(F.xxhash64("tid"), "tcs").alias("tc"),
                         F.col("tid").alias("tid"), F.col("x").alias("x"), F.col("y").alias("y"), F.col("tf").alias("tf"))
    return left, right


BOX_PLACES = "cell int, qcs long, tcs long"
BOX_ROUTES = "qcell int, tcell int, qcs long, tcs long"


def _box_routes(held, asked, k, metric, exclude, chunk, width, share=None):
    """``(places, routes)`` of :func:`_boxed`; none where boxes rule out too little or hold numbers that are not finite."""
    def joined(rows):
        cells = sorted({r["cell"] for r in rows})
        at = {c: i for i, c in enumerate(cells)}
        low, high = np.full((len(cells), width), np.inf), np.full((len(cells), width), -np.inf)
        for r in rows:
            ends = np.array(r["ends"], float)
            low[at[r["cell"]]] = np.minimum(low[at[r["cell"]]], ends[:width])
            high[at[r["cell"]]] = np.maximum(high[at[r["cell"]]], ends[width:])
        return cells, at, low, high

    cells, at, low, high = joined(held)
    mine, here, least, most = joined(asked)
    if not all(np.isfinite(v).all() for v in (low, high, least, most)):
        return None
    folds = sorted({r["fold"] for r in [*held, *asked]}) if exclude else [None]
    sizes = {f: np.zeros(len(cells)) for f in folds}
    asking, theirs = np.zeros(len(mine)), [set() for _ in mine]
    for r in held:
        for f in folds:
            sizes[f][at[r["cell"]]] += r["n"] if f is None or r["fold"] != f else 0
    for r in asked:
        asking[here[r["cell"]]] += r["n"]
        theirs[here[r["cell"]]].add(r["fold"] if exclude else None)
    total = np.zeros(len(cells))
    for r in held:
        total[at[r["cell"]]] += r["n"]
    length = (lambda v: v.sum(axis=1)) if metric == "manhattan" else (lambda v: np.sqrt((v * v).sum(axis=1)))
    slack = 1e-9 * (1.0 + float(length(np.maximum(high.max(axis=0), most.max(axis=0))[None] - np.minimum(low.min(axis=0), least.min(axis=0))[None])[0]))
    places, routes, met = [], [], 0.0
    for i, cell in enumerate(mine):
        far = length(np.maximum(np.abs(high - least[i]), np.abs(most[i] - low)))
        near = length(np.maximum(0.0, np.maximum(low - most[i], least[i] - high)))
        order, reach = np.argsort(far), 0.0
        for f in theirs[i]:
            enough = np.flatnonzero(np.cumsum(sizes[f][order]) >= k)
            reach = max(reach, far[order[enough[0]]] if len(enough) else np.inf)
        needed = np.flatnonzero(near <= reach + slack)
        rows = float(total[needed].sum())
        met += asking[i] * rows
        if met > (share or SHARE) * asking.sum() * total.sum():
            return None
        qcs, tcs = max(1, -(-int(asking[i]) // chunk)), max(1, -(-int(rows) // _large(int(rows), chunk, width)))
        places.append((cell, qcs, tcs))
        routes += [(cell, cells[j], qcs, tcs) for j in needed]
    return places, routes


def _large(rows: int, chunk: int, width: int) -> int:
    """Rows of a chunk where every chunk meets every other: an eighth of the table, within bounds that a task can hold."""
    return max(chunk, min(-(-rows // 8), 8 * chunk, CHUNK_CELLS // max(1, width)))


# Numbers in such a chunk, and the share of the training rows from which on a query cell meets all of them.
CHUNK_CELLS = 4_000_000
EVERYONE = 0.25


def _routes(queries, train, pivots, k, metric, exclude, chunk, wide=(), width=1) -> tuple[DataFrame, DataFrame]:
    """Where each query cell goes ``(qcell, qfold, cell, fold, qcs, tcs)``, and which shells of the training cells go there.

    Query cells that can rule out little are one group: each of them would be sent nearly the whole table.
    """
    fold = F.col("qf") if exclude else F.lit(-1)
    asked = queries.groupBy("cell", fold.alias("fold")).agg(
        F.count(F.lit(1)).alias("n"), F.max("away").alias("radius")).collect()
    near = W.partitionBy("cell", "tf").orderBy("away")
    held = train.withColumn("_r", F.row_number().over(near)).where(F.col("_r") <= k)
    closest = held.groupBy("cell", "tf").agg(F.collect_list("away").alias("near")).collect()
    probs = [i / 10 for i in range(11)]
    sizes = train.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("away").alias("radius"), F.percentile_approx("away", probs, 100).alias("marks")).collect()
    total = sum(s["n"] for s in sizes)
    apart = distances(pivots, pivots, metric, wide)
    slack = 1e-9 * (1.0 + apart.max() + max(s["radius"] for s in sizes))
    places, shells, everyone = [], [], []
    for a in asked:
        cell, f = a["cell"], a["fold"]
        reach = np.concatenate([
            a["radius"] + apart[cell, c["cell"]] + np.array(c["near"])
            for c in closest if not exclude or c["tf"] != f
        ] or [np.array([])])
        theta = np.sort(reach)[k - 1] if len(reach) >= k else np.inf
        spread = theta + a["radius"] + slack
        needed = [
            (s["cell"], apart[cell, s["cell"]] - spread, apart[cell, s["cell"]] + spread, s)
            for s in sizes if apart[cell, s["cell"]] - spread <= s["radius"]
        ]
        inside = sum(s["n"] * float(np.diff(np.interp([lo, hi], s["marks"], probs))[0]) for _, lo, hi, s in needed)
        if inside >= EVERYONE * total:
            everyone.append(a)
            continue
        qcs = max(1, -(-a["n"] // chunk))
        tcs = max(1, -(-sum(s["n"] for *_, s in needed) // chunk))
        places.append((cell, f, cell, f, qcs, tcs))
        shells += [(cell, f, c, float(lo), float(hi), qcs, tcs) for c, lo, hi, _ in needed]
    if everyone:
        asking = sum(a["n"] for a in everyone)
        qcs, tcs = -(-asking // _large(asking, chunk, width)), -(-total // _large(total, chunk, width))
        places += [(a["cell"], a["fold"], -1, -1, qcs, tcs) for a in everyone]
        shells += [(-1, -1, s["cell"], -np.inf, np.inf, qcs, tcs) for s in sizes]
    spark = queries.sparkSession
    return spark.createDataFrame(places, PLACES), spark.createDataFrame(shells, ROUTES)


PLACES = "qcell int, qfold int, gcell int, gfold int, qcs long, tcs long"
ROUTES = "gcell int, gfold int, tcell int, lo double, hi double, qcs long, tcs long"


def _one_cell_sides(queries, train, size, exclude, chunk):
    """Both sides when there is a single cell and nothing to rule out: chunk counts are literals."""
    fold = F.col("qf") if exclude else F.lit(-1)
    asked = queries.groupBy(fold.alias("fold")).agg(F.count(F.lit(1)).alias("n")).collect()
    chunks = lambda n: F.lit(max(1, -(-n // chunk))).cast("long")
    tcs = chunks(size)
    routes = F.array(*[F.struct(F.lit(a["fold"]).alias("fold"), chunks(a["n"]).alias("qcs")) for a in asked])
    mine = F.filter(routes, lambda r: (r["fold"] == -1) | (r["fold"] == F.col("qf")))
    other = F.filter(routes, lambda r: (r["fold"] == -1) | (r["fold"] != F.col("tf")))
    numbers = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), n - 1))
    left = queries.select("*", F.inline(mine)).select(
        F.lit(0).alias("cell"), "fold", F.pmod(F.xxhash64("qid"), "qcs").alias("qc"), "qid", "x", "qf",
        numbers(tcs).alias("tc"))
    right = train.select("*", F.inline(other)).select(
        F.lit(0).alias("cell"), "fold", numbers(F.col("qcs")).alias("qc"),
        F.pmod(F.xxhash64("tid"), tcs).alias("tc"), "tid", "x", "y", "tf")
    return left, right


def _join_sides(queries, train, places, shells):
    """Both sides keyed by (query cell, fold, query chunk, training chunk).

    The route table has at most pivots^2 * folds rows and is broadcast.
    """
    left = queries.join(F.broadcast(places), (F.col("cell") == F.col("qcell")) & ((F.col("qfold") == -1) | (F.col("qfold") == F.col("qf"))))
    # the aliases give each side its own columns, which a co-grouping of related tables needs
    left = left.select(F.col("gcell").alias("cell"), F.col("gfold").alias("fold"), F.pmod(F.xxhash64("qid"), "qcs").alias("qc"), "qid", "x", "qf",
                       F.explode(F.sequence(F.lit(0).cast("long"), F.col("tcs") - 1)).alias("tc"))
    right = train.join(F.broadcast(shells), (F.col("cell") == F.col("tcell")) & F.col("away").between(F.col("lo"), F.col("hi"))
                       & ((F.col("gfold") == -1) | (F.col("gfold") != F.col("tf"))))
    right = right.select(F.col("gcell").alias("cell"), F.col("gfold").alias("fold"),
                         F.explode(F.sequence(F.lit(0).cast("long"), F.col("qcs") - 1)).alias("qc"),
                         F.pmod(F.xxhash64("tid"), "tcs").alias("tc"), "tid", "x", "y", "tf")
    return left, right


def vote_column(labels: Column, task: str) -> Column:
    """The vote of an array of neighbour labels (smallest on a tie), or their mean."""
    if task != "classification":
        return F.aggregate(labels, F.lit(0.0), lambda s, v: s + v) / F.size(labels)
    counted = F.transform(F.array_distinct(labels), lambda c: F.struct(
        F.size(F.filter(labels, lambda v: v == c)).alias("n"), (-c).alias("c")))
    return -F.array_max(counted)["c"]


def _votes(found: DataFrame) -> DataFrame:
    """Neighbour labels per query in rank order (at most k of them)."""
    ranked = F.array_sort(F.collect_list(F.struct("rank", "y")))
    return found.groupBy("qid").agg(F.transform(ranked, lambda s: s["y"]).alias("labels"))


class KNNModel(Model):
    """Keeps the training table; ``transform`` joins, so it needs the queries' key column."""

    def __init__(self, df, label, features, names, keys, k, metric, task, approx=False, probes=8):
        self.df, self.label, self.features, self.names = df, label, features, names
        self.keys, self.k, self.metric, self.task = keys, k, metric, task
        self.approx, self.probes = approx, probes

    def _sides(self, df: DataFrame) -> tuple[DataFrame, DataFrame]:
        queries = df.select(key_column(self.keys).alias("qid"),
                            vector(df, self.features).alias("x"), F.lit(-1).alias("qf"))
        train = self.df.select(key_column(self.keys).alias("tid"),
                               vector(self.df, self.features).alias("x"),
                               F.col(self.label).cast("double").alias("y"), F.lit(-1).alias("tf"))
        return queries, train

    def recall(self, df: DataFrame, sample: int = RECALL_QUERIES) -> float:
        """Measured recall of this model's neighbours on a sample of ``df``."""
        queries, train = self._sides(df)
        return recall(self.neighbours(df), queries, train, self.k, self.metric, width=width_of(self.df, self.features), sample=sample, wide=wide_slots(self.df, self.features))

    def neighbours(self, df: DataFrame, **options) -> DataFrame:
        queries, train = self._sides(df)
        if self.approx:
            return approximate_neighbours(queries, train, self.k, self.metric, width=width_of(self.df, self.features), probes=self.probes,
                                          wide=wide_slots(self.df, self.features), **options)
        return neighbours(queries, train, self.k, self.metric, width=width_of(self.df, self.features),
                          wide=wide_slots(self.df, self.features), **options)

    def transform(self, df: DataFrame, **options) -> DataFrame:
        votes = _votes(self.neighbours(df, **options)).select(
            F.col("qid").alias("_qid"), vote_column(F.col("labels"), self.task).alias("prediction"))
        if self.task == "classification":
            votes = votes.withColumn("prediction", F.col("prediction").cast("int"))
        return df.join(votes, key_column(self.keys) == F.col("_qid"), "left").drop("_qid")


class KNearestNeighbors:
    """Exact unless ``approx=True`` asks for the search of the ``probes`` nearest cells only; it is never chosen by itself."""

    def __init__(self, k: int = 3, metric: str = "euclidean", task: str = "classification", approx: bool = False, probes: int = 8):
        if metric not in METRICS:
            raise ValueError(f"unknown metric {metric!r}; use one of {METRICS}")
        self.k, self.metric, self.task, self.approx, self.probes = k, metric, task, approx, probes

    def fit(self, df: DataFrame, label: str = "label", features="features",
            keys: list[str] | None = None) -> KNNModel:
        names = names_of(df, features)
        return KNNModel(df, label, features, names, keys or ["row_id"], self.k, self.metric, self.task, self.approx, self.probes)

    @classmethod
    def fit_matrix(cls, m: Matrix, params: dict, seed: int = 42) -> KNNModel:
        return cls(**{"task": m.task, **params}).fit(m.df, m.label, m.features, list(m.keys))

    @classmethod
    def out_of_fold(cls, m: Matrix, configs: list[dict], k: int, seed: int = 42) -> DataFrame:
        """One join per metric at the largest k serves all folds and every smaller k."""
        made = [cls(**{"task": m.task, **c}) for c in configs]
        key, x, y = key_column(m.keys), vector(m.df, m.features), F.col(m.label).cast("double")
        queries = m.df.where(F.col(m.fold) < k).select(key.alias("qid"), x.alias("x"), F.col(m.fold).alias("qf"))
        train = m.df.select(key.alias("tid"), x.alias("x"), y.alias("y"), F.col(m.fold).alias("tf"))
        truth = m.df.select(key.alias("qid"), F.col(m.fold).alias("fold"), y.alias("label"))
        parts = []
        for metric, approx, probes in sorted({(c.metric, c.approx, c.probes if c.approx else 0) for c in made}):
            members = [(i, c.k) for i, c in enumerate(made) if c.metric == metric and c.approx == approx and (not approx or c.probes == probes)]
            search = partial(approximate_neighbours, probes=probes) if approx else neighbours
            found = search(queries, train, max(n for _, n in members), metric,
                               width=width_of(m.df, m.features), exclude_fold=True, seed=seed, wide=wide_slots(m.df, m.features))
            offers = F.array(*[
                F.struct(F.lit(i).alias("config"),
                         vote_column(F.slice("labels", 1, n), m.task).alias("prediction"))
                for i, n in members])
            voted = _votes(found).select("qid", F.inline(offers))
            parts.append(voted.join(truth, "qid").select("config", "fold", "label", "prediction"))
        out = parts[0]
        for part in parts[1:]:
            out = out.unionByName(part)
        return out


def wide_slots(df: DataFrame, features) -> tuple[int, ...]:
    """The slots at which sparse columns stand in a feature array."""
    return tuple(int(w["slot"]) for w in df.schema[features].metadata["wide"]) if has_wide(df, features) else ()


def key_column(keys) -> Column:
    """The row key as one orderable column: composite keys are structs, so different keys never meet."""
    if len(keys) == 1:
        return F.col(keys[0])
    return F.struct(*[F.col(f"`{k}`").alias(f"k{i}") for i, k in enumerate(keys)])


def key_places(keys: pa.ChunkedArray) -> np.ndarray:
    """The place of each key in key order, null first as in Spark."""
    keys = keys.combine_chunks()
    parts = keys.flatten() if pa.types.is_struct(keys.type) else [keys]
    table = pa.table({f"k{i}": part for i, part in enumerate(parts)})
    order = pc.sort_indices(table, sort_keys=[(name, "ascending") for name in table.column_names], null_placement="at_start").to_numpy()
    places = np.empty(len(order), np.int64)
    places[order] = np.arange(len(order))
    return places
