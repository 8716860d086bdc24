"""Full-batch gradient descent by passes over packed rows.

Three things keep an epoch cheap: rows are packed once into binary blocks, so an epoch moves bytes
and not cells; identical rows are merged with a weight when that pays; and every configuration and
fold is a row of one weight matrix, so all of them (and the final models of all rows) advance in the
same pass. Only that matrix lives on the driver, and each epoch is a separate job over the stored
blocks, so no lineage builds up.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, functions as F

from ..functions.scalar import vector, width_of
from ..operators.linalg import block
from ..operators.sparse import Layout, layout_of
from ..session import ROWS_PER_TASK, partition_count, spread, with_partition

# Rows are merged when a sketch says that at most this share of them is distinct.
MERGE_SHARE = 0.25
# A table of at most this many packed numbers (32 MB, a fraction of one input split) is a single
# task's work anyway, and then all epochs run in that task; every larger table costs one
# distributed pass per epoch.
ONE_TASK_CELLS = 4_000_000
# Partial sums up to this many numbers are added up by the driver, more by an aggregate.
DRIVER_CELLS = 1_000_000


def _pack(df: DataFrame, x: Column, y: Column, fold: Column, d: int) -> tuple[DataFrame, int]:
    """Blocks ``(x, y, w, fold)`` of packed doubles, and the number of rows in them.

    Identical rows become one row with a weight when a sketch says it pays.
    """
    rows = df.select(x.alias("x"), y.cast("double").alias("y"), fold.cast("double").alias("fold"))
    n, distinct, partitions = with_partition(rows).agg(
        F.count(F.lit(1)), F.approx_count_distinct(F.xxhash64("x", "y", "fold")), partition_count()
    ).first()
    if not n:
        raise ValueError("the table has no rows")
    merged, tasks = distinct <= MERGE_SHARE * n, -(-n // ROWS_PER_TASK)
    if merged:
        rows = rows.groupBy("x", "y", "fold").agg(F.count(F.lit(1)).cast("double").alias("w"))
        n = int(1.1 * distinct)
        tasks = max(1, -(-n // ROWS_PER_TASK))
    else:
        rows = spread(rows.withColumn("w", F.lit(1.0)), n, partitions)

    def pack(batches):
        for batch in batches:
            if batch.num_rows:
                x = np.ascontiguousarray(block(batch.column("x"), d))
                cells = {"x": x.tobytes()}
                for name in ("y", "w", "fold"):
                    cells[name] = batch.column(name).to_numpy(zero_copy_only=False).tobytes()
                yield pa.record_batch({c: pa.array([v], pa.binary()) for c, v in cells.items()})

    blocks = rows.mapInArrow(pack, "x binary, y binary, w binary, fold binary")
    # Packed blocks are dealt anew: fewer tasks further up would each hold the sorts and hash tables of many partitions.
    return (blocks.repartition(tasks) if merged or partitions > tasks else blocks), n


def _unpack(batches, d: int):
    """The (x, y, w, fold) arrays of every block."""
    for batch in batches:
        for raw in zip(*(batch.column(c).to_pylist() for c in ("x", "y", "w", "fold"))):
            x, y, w, fold = (np.frombuffer(b) for b in raw)
            yield x.reshape(-1, d), y, w, fold


def _link(z: np.ndarray, logistic: bool) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(z, -500.0, 500.0))) if logistic else z


def _sums(blocks, weights: np.ndarray, held_out: np.ndarray, layout: Layout, logistic: bool, loss: bool = False) -> np.ndarray:
    """Per model: the summed gradient (features, then bias), the number of training rows and, with ``loss``, the summed
    log loss or half the summed squared error."""
    d = layout.features
    total = np.zeros((len(weights), d + 2 + loss))
    for x, y, w, fold in blocks:
        z = layout.scores(x, weights)
        guess = _link(z, logistic)
        use = (fold[:, None] != held_out) * w[:, None]
        error = (guess - y[:, None]) * use
        layout.gradient(x, error, total)
        total[:, d] += error.sum(axis=0)
        total[:, d + 1] += use.sum(axis=0)
        if loss:
            each = np.logaddexp(0.0, z) - y[:, None] * z if logistic else (z - y[:, None]) ** 2 / 2
            total[:, d + 2] += (each * use).sum(axis=0)
    return total


class _Descent:
    """Weights of all models and the step that moves them."""

    def __init__(self, settings, layout: Layout, logistic: bool):
        self.rates = np.array([s[0] for s in settings], dtype=float)
        self.epochs = np.array([s[1] for s in settings])
        self.held_out = np.array([s[2] for s in settings], dtype=float)
        self.weights = np.zeros((len(settings), layout.features + 1))
        self.layout, self.logistic = layout, logistic

    def run(self, sums) -> np.ndarray:
        """``sums(weights, held_out)`` gives the gradient sums of the models still training."""
        with np.errstate(all="ignore"):
            for epoch in range(int(self.epochs.max())):
                live = self.epochs > epoch
                found = sums(self.weights[live], self.held_out[live])
                self.weights[live] -= self.rates[live, None] * found[:, :-1] / found[:, -1:]
        return self.weights


def descend(df: DataFrame, features, label: str, fold: Column, settings,
            logistic: bool) -> list[tuple[np.ndarray, float]]:
    """Train one model per ``(rate, epochs, held_out_fold)`` in shared passes: with the logistic
    link, or without one (the gradient of half the squared error)."""
    d = width_of(df, features)
    blocks, n = _pack(df, vector(df, features), F.col(label), fold, d)
    tasks = -(-n // ROWS_PER_TASK)
    descent = _Descent(settings, layout_of(df, features), logistic)
    if n * (d + 3) <= ONE_TASK_CELLS:
        weights = _in_one_task(blocks, descent)
    else:
        blocks = blocks.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            weights = descent.run(lambda w, out: _distributed_sums(blocks, w, out, descent, tasks))
        finally:
            blocks.unpersist()
    return [(w[:-1], float(w[-1])) for w in weights]


def _in_one_task(blocks: DataFrame, descent: _Descent) -> np.ndarray:
    """A table whose size was checked: all epochs in the one task that holds it."""
    layout, logistic = descent.layout, descent.logistic

    def train(batches):
        held = sorted(_unpack(batches, layout.slots), key=lambda b: tuple(c.tobytes() for c in b))
        weights = descent.run(lambda w, out: _sums(held, w, out, layout, logistic))
        yield pa.record_batch({"s": pa.array([weights.ravel().tolist()], pa.list_(pa.float64()))})

    (row,) = blocks.repartition(1).mapInArrow(train, "s array<double>").collect()
    return np.array(row["s"]).reshape(-1, layout.features + 1)


def _distributed_sums(blocks: DataFrame, weights, held_out, descent: _Descent, tasks: int, loss: bool = False) -> np.ndarray:
    """One pass: partial sums per task, added up by an aggregate."""
    layout, logistic = descent.layout, descent.logistic
    width = layout.features + 2 + loss

    def partial(batches):
        total = _sums(_unpack(batches, layout.slots), weights, held_out, layout, logistic, loss)
        yield pa.record_batch({"s": pa.array([total.ravel().tolist()], pa.list_(pa.float64()))})

    parts = blocks.mapInArrow(partial, "s array<double>")
    cells = len(weights) * width
    if tasks * cells <= DRIVER_CELLS:
        summed = np.sum([r["s"] for r in parts.collect()], axis=0)
    else:
        rows = parts.select(F.posexplode("s").alias("i", "v")).groupBy("i").agg(F.sum("v").alias("v"))
        summed = np.zeros(cells)
        for r in rows.collect():
            summed[r["i"]] = r["v"]
    return summed.reshape(len(weights), width)


# --- quasi-Newton ------------------------------------------------------------------------------

# Past steps that shape the next direction, and the decrease that a step must give.
MEMORY = 10
ARMIJO = 1e-4


class _QuasiNewton:
    """One model's limited-memory BFGS: the point, its gradient, past steps, and the trial that waits for its loss."""

    def __init__(self, width: int, held_out: int):
        self.point, self.held_out = np.zeros(width), held_out
        self.trial, self.step, self.done = self.point, 0.0, False
        self.loss, self.gradient = np.inf, np.zeros(width)
        self.steps: list[tuple[np.ndarray, np.ndarray]] = []

    def told(self, loss: float, gradient: np.ndarray, tolerance: float) -> None:
        """Accept the trial or halve the step; then the next trial."""
        first = not np.isfinite(self.loss)
        slope = 0.0 if first else self.gradient @ self.direction
        if not first and not loss <= self.loss + ARMIJO * self.step * slope:
            self.step /= 2
            self.done = self.step < 1e-10  # no decrease is left to find in this direction
            self.trial = self.point + self.step * self.direction
            return
        if not first:
            move, change = self.trial - self.point, gradient - self.gradient
            if move @ change > 1e-12 * (change @ change):
                self.steps = [*self.steps[1 - MEMORY:], (move, change)]
        self.point, self.loss, self.gradient = self.trial, loss, gradient
        self.done = bool(np.abs(gradient).max() <= tolerance)
        self.direction = -self._curved(gradient)
        # The first step has no curvature to go by: at most one in length.
        self.step = 1.0 if self.steps else min(1.0, 1.0 / max(np.linalg.norm(gradient), 1e-300))
        self.trial = self.point + self.step * self.direction

    def _curved(self, gradient: np.ndarray) -> np.ndarray:
        """The inverse curvature of the past steps applied to the gradient, by two loops."""
        q, kept = gradient.copy(), []
        for move, change in reversed(self.steps):
            a = (move @ q) / (move @ change)
            q -= a * change
            kept.append(a)
        if self.steps:
            move, change = self.steps[-1]
            q *= (move @ change) / (change @ change)
        for (move, change), a in zip(self.steps, reversed(kept)):
            q += (a - (change @ q) / (move @ change)) * move
        return q


def minimise(df: DataFrame, features, label: str, fold: Column, held_out: list[int], logistic: bool, l2: float = 0.0,
             tolerance: float = 1e-6, passes: int = 200) -> tuple[list[tuple[np.ndarray, float]], int]:
    """Minimise the mean loss (plus ``l2 / 2`` times the squared weights) of one model per held-out fold by L-BFGS.

    Every pass is one distributed aggregate that gives loss and gradient of all models at their trials; the two-loop recursion
    and the line search see those sums alone. A model stops when no gradient entry exceeds ``tolerance``. Returns the models and the passes.
    """
    d = width_of(df, features)
    blocks, n = _pack(df, vector(df, features), F.col(label), fold, d)
    layout, tasks = layout_of(df, features), -(-n // ROWS_PER_TASK)
    carrier = _Descent([(0.0, 0, f) for f in held_out], layout, logistic)
    models = [_QuasiNewton(layout.features + 1, f) for f in held_out]
    blocks = blocks.persist(StorageLevel.MEMORY_AND_DISK)
    used = 0
    try:
        for used in range(1, passes + 1):
            live = [m for m in models if not m.done]
            sums = _distributed_sums(blocks, np.array([m.trial for m in live]), np.array([m.held_out for m in live], float), carrier, tasks, True)
            for m, row in zip(live, sums):
                rows, penalty = row[-2], l2 * np.append(m.trial[:-1], 0.0)
                m.told(row[-1] / rows + 0.5 * float(penalty @ m.trial), row[:-2] / rows + penalty, tolerance)
            if all(m.done for m in models):
                break
    finally:
        blocks.unpersist()
    return [(m.point[:-1], float(m.point[-1])) for m in models], used
