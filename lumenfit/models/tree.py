"""Decision trees and random forests, grown level by level for many trees at once.

Rows are packed once into blocks: features, bucket numbers, labels, and how often each tree draws each row. All trees of all
folds grow together over these blocks; no row is ever copied per tree, fold or feature. On a level a task finds the
node of every row in every tree by replaying the splits above, and adds the rows up.

1. *Histogram.* Features are cut once into buckets by quantile sketches. Statistics per (model,
   node, feature, bucket, class) are counted in each block and merged by an aggregate. From a node's few
   buckets, running sums give the exact impurity of splitting at every bucket edge.
2. *Refinement.* A split inside a bucket cannot beat the impurity obtained by setting the whole
   bucket aside as pure, because merging groups never lowers weighted impurity. Only buckets whose
   bound reaches the best edge are opened: large ones are cut again by quantiles, small ones are
   searched value by value. Buckets with a single value (codes, indicators, small integers) never
   are.

The result is the split an exhaustive search over all distinct values finds, with ties going to the
first feature and smallest value. No feature is ever sorted as a whole, every group that reaches a
task has bounded size, and the driver holds one row per tree node.

``solver="binned"`` stops at the bucket edges (up to 256 buckets, one per value where a feature has few values): one job per
level, and of two siblings only the smaller one is counted, the other is its parent less that. ``subset="node"`` lets a
forest draw a subset of the features for each node instead of each tree. A column of sparse indicators is split
on one category against all others, which is what a split on the indicator's own column would be.

A tree limited to depth 3 is the top of the tree limited to depth 5, and the first 10 trees of a
forest are the forest of 10, so a whole grid over depth, split size and tree count is read off one
growth.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, functions as F

from ..functions.scalar import columns_of, vector, width_of
from ..operators.linalg import block
from ..operators.sparse import Layout, feature_names, layout_of
from ..operators.split import feature_subset, poisson_weights
from ..session import durable, partition_count, spread, with_partition
from .base import Matrix, Model, class_counts, explode_configs, list_array

# Impurities are compared relative to their node, at this many decimals, so that the order of
# summation does not decide ties.
DECIMALS = 12
BROADCAST_ROWS = 200_000
EXPRESSION_DEPTH = 6
# A node (rows times features) or an opened bucket is searched value by value up to this size;
# beyond it, by buckets that are cut in PARTS again.
VALUES_PER_GROUP = 2_000_000
PARTS = 256
SUMS = ["s0", "s1", "s2"]
# Small nodes are scored together in groups of about this many cells.
CELLS_PER_TEAM = 50_000
# Opened buckets are searched together in groups of about this many drawn rows.
ROWS_PER_TEAM = 200_000
# Rows of a packed block, and the number no fold has.
ROWS_PER_BLOCK = 50_000
NO_FOLD = -2
PARTIAL = "model int, node long, f int, part long, cls int, low double, high double, s0 double, s1 double, s2 double"
VALUES = "model int, node long, f int, v double, part long, cls int, s0 double, s1 double, s2 double"
OFFERS = ("model int, node long, f int, part long, open boolean, ratio double, v double, n double, "
          "left array<double>, right array<double>")


# --- node tables -------------------------------------------------------------------------------

@dataclass
class Node:
    depth: int
    stats: list[float]
    n: float
    value: float
    feature: int | None = None
    threshold: float | None = None
    gain: float = 0.0
    # A split on one category of a sparse column: its rows go right.
    category: int | None = None


@dataclass
class Grown:
    """All nodes of all models: ``trees[model][node]``; node 1 is the root, children 2i, 2i+1."""

    trees: dict[int, dict[int, Node]] = field(default_factory=dict)

    def cut(self, model: int, max_depth: int, min_samples_split: int) -> "Tree":
        """The tree a smaller depth or a larger split size would have grown."""
        grown, kept = self.trees[model], {}
        waiting = [1]
        while waiting:
            i = waiting.pop()
            node = grown[i]
            split = (node.feature is not None and node.depth < max_depth
                     and node.n >= min_samples_split)
            kept[i] = (node, split)
            if split:
                waiting += [2 * i, 2 * i + 1]
        return Tree(kept)


class Tree:
    """A tree as flat arrays: feature (-1 in leaves), threshold, left, right, value."""

    def __init__(self, nodes: dict[int, tuple[Node, bool]]):
        self.nodes = nodes
        order = sorted(nodes)
        place = {i: p for p, i in enumerate(order)}
        size = len(order)
        self.feature = np.full(size, -1)
        self.threshold, self.value = np.zeros(size), np.zeros(size)
        self.category = np.full(size, -1)
        self.left, self.right = np.arange(size), np.arange(size)
        self.depth = 0
        for i in order:
            node, split = nodes[i]
            p = place[i]
            self.value[p] = node.value
            self.depth = max(self.depth, node.depth)
            if split:
                self.feature[p], self.threshold[p] = node.feature, node.threshold
                self.category[p] = -1 if node.category is None else node.category
                self.left[p], self.right[p] = place[2 * i], place[2 * i + 1]

    def route(self, x: np.ndarray) -> np.ndarray:
        """Number of the leaf that each row ends in."""
        at = np.zeros(len(x), dtype=int)
        rows = np.arange(len(x))
        for _ in range(self.depth):
            cell = x[rows, np.maximum(self.feature[at], 0)]
            low = np.where(self.category[at] >= 0, cell != self.category[at], cell <= self.threshold[at])
            at = np.where(low, self.left[at], self.right[at])
        return at

    def predict(self, x: np.ndarray) -> np.ndarray:
        return self.value[self.route(x)]

    def expression(self, x: list[Column], at: int = 0) -> Column:
        if self.feature[at] < 0:
            return F.lit(float(self.value[at]))
        cell = x[self.feature[at]]
        low = cell != F.lit(float(self.category[at])) if self.category[at] >= 0 else cell <= F.lit(float(self.threshold[at]))
        return F.when(low, self.expression(x, self.left[at])).otherwise(
            self.expression(x, self.right[at]))

    def gains(self, layout: Layout) -> np.ndarray:
        """Total impurity decrease per feature, normalised within the tree."""
        found = np.zeros(layout.features)
        for node, split in self.nodes.values():
            if split:
                found[layout.place(node.feature, node.category)] += node.gain
        return found / found.sum() if found.sum() > 0 else found


# --- growing -----------------------------------------------------------------------------------

class _Grower:
    def __init__(self, m: Matrix, folds: list[int | None], n_trees: int | None, max_depth: int,
                 min_samples_split: int, max_features: int | None, seed: int, bins: int | None,
                 solver: str = "exact", subset: str = "tree"):
        self.m, self.folds, self.n_trees = m, folds, n_trees
        self.max_depth, self.min_split = max_depth, min_samples_split
        self.max_features, self.seed, self.bins = max_features, seed, bins
        self.layout = layout_of(m.df, m.features)
        self.d = self.layout.slots
        self.classify = m.task == "classification"
        self.spark = m.df.sparkSession
        self.centre, self.classes = 0.0, []
        self.values_per_group = VALUES_PER_GROUP
        self.binned, self.per_node = solver == "binned", subset == "node"
        self.cuts: list[np.ndarray] = []
        self.models = len(folds) * (n_trees or 1)
        self.before: DataFrame | None = None

    def model(self, fold_position: int, tree: int) -> int:
        return fold_position * (self.n_trees or 1) + tree

    def grow(self) -> Grown:
        blocks = self._blocks().persist(StorageLevel.MEMORY_AND_DISK)
        try:
            grown = self._roots(blocks)
            for depth in range(self.max_depth):
                active = self._active(grown, depth)
                if not active:
                    break
                self._split(grown, blocks, depth, active)
            return grown
        finally:
            blocks.unpersist()

    # rows, packed once

    def _blocks(self) -> DataFrame:
        """Blocks of packed rows: features, bucket numbers, label, fold and the draws of every tree."""
        m = self.m
        n, partitions = self._survey()
        y = F.col(m.label).cast("double")
        cells = [vector(m.df, m.features).alias("x"), y.alias("y")]
        cells.append(F.col(m.fold).cast("int").alias("fold") if self.folds != [None] else F.lit(-1).alias("fold"))
        if self.n_trees:
            cells.append(poisson_weights([F.col(f"`{k}`") for k in m.keys], self.seed, self.n_trees).alias("draws"))
        else:
            cells.append(F.array(F.lit(1)).alias("draws"))
        work = n * self.d * self.models // 10  # a cell is a tenth of a row's work
        base = spread(m.df.select(*cells), max(n, work), partitions)
        if self.binned or self._bucketed(n):
            self.cuts = self._quantiles(n)
        d, cuts, trees = self.d, self.cuts, self.n_trees or 1
        classes = np.array(self.classes) if self.classify else None
        centre = self.centre

        def pack(batches):
            held, rows = [], 0
            for batch in batches:
                if batch.num_rows:
                    held.append(batch)
                    rows += batch.num_rows
                if rows >= ROWS_PER_BLOCK:
                    yield packed(pa.concat_batches(held))
                    held, rows = [], 0
            if held:
                yield packed(pa.concat_batches(held))

        def packed(batch):
            x = np.ascontiguousarray(block(batch.column("x"), d))
            y = batch.column("y").to_numpy(zero_copy_only=False)
            label = np.searchsorted(classes, y).astype(np.float64) if classes is not None else y - centre
            codes = np.stack([np.searchsorted(c, x[:, j], side="left") for j, c in enumerate(cuts)], axis=1).astype(np.uint16) if cuts else np.zeros(0, np.uint16)
            w = block(batch.column("draws"), trees).astype(np.uint8)
            fold = batch.column("fold").to_numpy(zero_copy_only=False).astype(np.int32)
            return pa.record_batch({c: pa.array([v.tobytes()], pa.binary()) for c, v in (("x", x), ("b", codes), ("y", label), ("fold", fold), ("w", w))})

        return base.mapInArrow(pack, "x binary, b binary, y binary, fold binary, w binary")

    def _bucketed(self, n: int) -> bool:
        """Whether nodes may be too large to be searched value by value at once."""
        return 1.25 * n * self.d * self.models > self.values_per_group

    def _survey(self) -> tuple[int, int]:
        """Number of rows and of partitions; notes the classes or the label's mean."""
        y = self.m.df.select(F.col(self.m.label).cast("double").alias("y"))
        if self.classify:
            counts, partitions = class_counts(y, "y", self.m.label)
            self.classes, n = sorted(counts), sum(counts.values())
        else:
            n, self.centre, partitions = with_partition(y).agg(
                F.count(F.lit(1)), F.avg("y"), partition_count()).first()
        if not n:
            raise ValueError("the table has no rows")
        return n, partitions

    def _quantiles(self, n: int) -> list[np.ndarray]:
        """Where each feature is cut. A feature of few values is cut at every value, any other by quantiles."""
        bins = self.bins or (64 if n < 10_000_000 else 256 if n < 1_000_000_000 else 2048)
        if self.binned:
            bins = self.bins or 256
        d, dense, most = self.d, self.layout.dense.tolist(), 2 * bins

        def summaries(batches):
            """Distinct values of each feature (null in their place where there are too many), and every n-th value in order."""
            found: dict[int, np.ndarray | None] = {j: np.zeros(0) for j in dense}
            for batch in batches:
                x = np.sort(block(batch.column("x"), d)[:, dense], axis=0)
                step = max(1, min(64, len(x) // 256))
                kept = x[step // 2::step]
                yield _summary(np.tile(dense, len(kept)), kept.ravel(), True)
                for k, (j, known) in enumerate(found.items()):
                    if known is not None:
                        values = x[np.append(True, x[1:, k] != x[:-1, k])[:len(x)], k]
                        known = np.union1d(known, values) if len(values) <= most else None
                        found[j] = known if known is not None and len(known) <= most else None
            for j, known in found.items():
                yield _summary(np.full(1 if known is None else len(known), j), np.array([np.nan]) if known is None else known, False)

        probs = [i / bins for i in range(1, bins)]
        rows = self.m.df.select(vector(self.m.df, self.m.features).alias("x")).mapInArrow(summaries, "f int, v double, sampled boolean")
        plain = ~F.col("sampled")
        found = rows.groupBy("f").agg(F.count_if(plain & F.col("v").isNull()).alias("unknown"), F.array_sort(F.collect_set(F.when(plain, F.col("v")))).alias("v"),
                                      F.percentile_approx(F.when(F.col("sampled"), F.col("v")), probs, 10 * bins).alias("q"))
        few = (F.col("unknown") == 0) & (F.size("v") <= most)
        cuts = [np.zeros(0)] * d
        for r in found.select("f", F.when(few, F.col("v")).otherwise(F.coalesce("q", F.array())).alias("cuts")).collect():  # a row per feature
            cuts[r["f"]] = np.unique(np.array(r["cuts"], float))
        return cuts

    # nodes on the driver

    def _node(self, depth: int, stats: list[float]) -> Node:
        if self.classify:
            n, value = sum(stats), self.classes[int(np.argmax(stats))]
        else:
            n, value = stats[0], self.centre + stats[1] / stats[0]
        return Node(depth, stats, n, float(value))

    def _mass_of(self, s: list[float]) -> float:
        if self.classify:
            return sum(s) - sum(c * c for c in s) / sum(s)
        return max(0.0, s[2] - s[1] ** 2 / s[0])

    def _roots(self, blocks: DataFrame) -> Grown:
        grown, found = Grown(), {}
        held_out, trees, width = self._held_out(), self.n_trees or 1, len(self.classes) if self.classify else 0

        def sums(batches):
            total = np.zeros((len(held_out) * trees, width or 3))
            for _, _, y, fold, w in _unpacked(batches, self_d, trees):
                for position, out in enumerate(held_out):
                    mine = w[fold != out].astype(float)
                    z = y[fold != out]
                    for t in range(trees):
                        at = position * trees + t
                        if width:
                            total[at] += np.bincount(z.astype(np.int64), mine[:, t], width)
                        else:
                            total[at] += mine[:, t].sum(), mine[:, t] @ z, mine[:, t] @ (z * z)
            model, column = np.nonzero(total)
            yield pa.record_batch({"model": pa.array(model, pa.int32()), "i": pa.array(column, pa.int32()), "v": pa.array(total[model, column])})

        self_d = self.d
        for r in blocks.mapInArrow(sums, "model int, i int, v double").groupBy("model", "i").agg(F.sum("v").alias("v")).collect():
            found.setdefault(r["model"], [0.0] * (width or 3))[r["i"]] = r["v"]
        for model, stats in found.items():
            grown.trees[model] = {1: self._node(0, stats)}
        return grown

    def _held_out(self) -> list[int]:
        """The fold that each position leaves out; no row has the number of the position that leaves none out."""
        return [NO_FOLD if f is None else f for f in self.folds]

    def _active(self, grown: Grown, depth: int) -> list[tuple[int, int]]:
        """Nodes of a level that may split: large enough and not pure."""
        found = []
        for model, nodes in grown.trees.items():
            noise = 1e-12 * self._mass_of(nodes[1].stats)
            for i, node in nodes.items():
                if node.depth == depth and node.n >= self.min_split:
                    if self._mass_of(node.stats) > noise:
                        found.append((model, i))
        return found

    def _features_of(self, model: int, node: int) -> tuple[list[int], dict[int, np.ndarray] | None]:
        """Slots a node may split on, and the categories of each sparse slot (all of them without a subset): for a forest
        the seeded subset of the features of its tree, or of the node itself."""
        sparse = [w.slot for w in self.layout.wides]
        if not self.n_trees:
            return sorted([*self.layout.dense.tolist(), *sparse]), None
        tree = model % self.n_trees
        chosen = np.array(feature_subset(self.layout.features, self.max_features, self.seed, (tree << 32) + node if self.per_node else tree))
        slots = self.layout.dense[np.isin(self.layout.at, chosen)].tolist()
        codes = {w.slot: chosen[(chosen >= w.at) & (chosen < w.at + w.size)] - w.at for w in self.layout.wides}
        return sorted(slots + [s for s in sparse if len(codes[s])]), codes

    def _small(self, rows: list[tuple], schema: str) -> DataFrame:
        """A driver table of tree nodes, broadcast while it is small."""
        df = self.spark.createDataFrame(rows, schema)
        return F.broadcast(df) if len(rows) <= BROADCAST_ROWS else df

    # one level

    def _level(self, grown: Grown, nodes: list[tuple[int, int]]) -> "_Level":
        """What a task needs to know of a level: all trees so far, and the nodes it works on with their features."""
        trees = {}
        for model, i in nodes:
            trees.setdefault(model, []).append(i)
        parts = {}
        for model, ids in trees.items():
            routes = Tree({i: (node, node.feature is not None) for i, node in grown.trees[model].items()})
            place = {i: p for p, i in enumerate(sorted(grown.trees[model]))}
            local = np.full(len(place), -1)
            local[[place[i] for i in ids]] = np.arange(len(ids))
            allowed = np.zeros((len(ids), self.d), bool)
            codes = []
            for k, i in enumerate(ids):
                slots, categories = self._features_of(model, i)
                allowed[k, slots] = True
                codes.append(categories)
            small = np.array([self._is_small(grown, model, i) for i in ids])
            parts[model] = (routes, local, np.array(ids, np.int64), allowed, small, codes)
        return _Level(parts, self._held_out(), self.n_trees or 1, self.d, len(self.classes) if self.classify else 0,
                      [w.slot for w in self.layout.wides], bool(self.cuts))

    def _is_small(self, grown: Grown, model: int, node: int) -> bool:
        """Whether all cells of a node fit one group, which then skips the buckets."""
        if self.binned:
            return False
        cells = grown.trees[model][node].n * len(self._features_of(model, node)[0])
        return not self.cuts or cells <= max(2_000, self.values_per_group // self.models)

    def _counts(self, grown: Grown, blocks: DataFrame, depth: int, active) -> DataFrame:
        """Merged statistics per (model, node, feature, part, class): partial histograms of blocks, added up."""
        names = ["model", "node", "f", "part", "cls"]
        nodes = active
        derived: list[tuple] = []
        if self.binned and depth and not self.n_trees:
            nodes, derived = self._siblings(grown, depth, active)
        level = self._level(grown, nodes)
        found = blocks.mapInArrow(level.histograms, PARTIAL).groupBy(*names, F.when(F.col("part") == -1, F.col("low")).alias("value")).agg(
            F.min("low").alias("low"), F.max("high").alias("high"), *[F.sum(s).alias(s) for s in SUMS])
        if not self.binned:
            return found
        if derived:
            # The larger of two siblings is its parent less the smaller one: its rows are not looked at.
            table = self._small(derived, "model int, parent long, smaller long, larger long")
            whole = self.before.withColumnRenamed("node", "parent").join(table, ["model", "parent"])
            less = found.withColumnRenamed("node", "smaller").join(table, ["model", "smaller"])
            sign = lambda rows, by: rows.select("model", F.col("larger").alias("node"), "f", "part", "cls", *[(by * F.col(s)).alias(s) for s in SUMS])
            rest = sign(whole, 1.0).unionByName(sign(less, -1.0)).groupBy(*names).agg(*[F.sum(s).alias(s) for s in SUMS]).where("s0 > 0.5")
            found = found.select(*names, *SUMS).unionByName(rest)
        if not self.n_trees and depth + 1 < self.max_depth:
            found = self.before = durable(found.select(*names, *SUMS))
        return found.withColumns({"low": F.lit(0.0), "high": F.lit(0.0)})

    def _siblings(self, grown: Grown, depth: int, active) -> tuple[list[tuple], list[tuple]]:
        """The nodes to look at, and the ``(model, parent, smaller, larger)`` of those that follow."""
        nodes, derived = set(), []
        for model, i in active:
            other = i ^ 1
            mine, theirs = grown.trees[model][i].n, grown.trees[model][other].n
            if (mine, i) > (theirs, other):
                derived.append((model, i // 2, other, i))
                nodes.add((model, other))
            else:
                nodes.add((model, i))
        return sorted(nodes), derived

    def _split(self, grown: Grown, blocks: DataFrame, depth: int, active) -> None:
        """Find and record the best split of every active node."""
        kernel = _kernel(len(self.classes) if self.classify else None, self.cuts if self.binned else None)
        counts = self._counts(grown, blocks, depth, active)
        best: dict[tuple, tuple] = {}
        sparse = [w.slot for w in self.layout.wides]
        if sparse:
            counts = durable(counts)
            self._best_categories(grown, counts.where(F.col("f").isin(sparse)), active, best)
            counts = counts.where(~F.col("f").isin(sparse))
        if self.binned:
            counts = counts.join(self._small([(m, i) for m, i in active], "model int, node long"), ["model", "node"], "left_semi")
        cells = sum(min(grown.trees[m][i].n, 1024) * self.d for m, i in active)
        teams = max(1, min(len(active), int(cells // CELLS_PER_TEAM) + 1))
        counts = counts.withColumn("team", F.pmod(F.xxhash64("model", "node"), F.lit(teams)))
        scored = counts.groupBy("team").applyInArrow(lambda t: kernel(t, None), OFFERS)
        if self.binned or all(self._is_small(grown, *a) for a in active):
            for r in scored.where("not open").collect():
                self._offer(best, (r["model"], r["node"]), (r["ratio"], r["f"], r["v"], r["left"], r["right"]))
            return self._record(grown, best, depth)
        rows = scored.limit(BROADCAST_ROWS + 1).collect()  # an offer per node, and the buckets that may hide a better one
        if len(rows) > BROADCAST_ROWS:
            self._narrow(grown, blocks, active, scored, best, kernel)
            return self._record(grown, best, depth)
        for r in rows:
            if not r["open"]:
                self._offer(best, (r["model"], r["node"]), (r["ratio"], r["f"], r["v"], r["left"], r["right"]))
        floor = lambda r: best[(r["model"], r["node"])][0] if (r["model"], r["node"]) in best else 1.0
        doubtful = [r for r in rows if r["open"] and r["ratio"] <= floor(r)]
        if any(r["n"] > self.values_per_group for r in doubtful):
            self._narrow(grown, blocks, active, scored, best, kernel)
        elif doubtful:
            wanted: dict[tuple, list] = {}
            for r in doubtful:
                wanted.setdefault((r["model"], r["node"]), []).append((r["f"], r["part"]))
            level = self._level(grown, active)
            inside = blocks.mapInArrow(lambda batches: level.values(batches, wanted), VALUES)
            finer = inside.withColumns({"parent": F.col("part"), "part": F.lit(-1).cast("long")})
            by = ["model", "node", "f", "parent"]
            sides = self.spark.createDataFrame([(r["model"], r["node"], r["f"], r["part"], r["left"], r["right"], float(floor(r))) for r in doubtful],
                                               "model int, node long, f int, parent long, left array<double>, right array<double>, floor double")
            teams = _teams(len(doubtful), sum(r["n"] for r in doubtful))
            for r in _in_teams(self._histogram(finer, [*by, "part"]), sides, teams, kernel).collect():
                self._offer(best, (r["model"], r["node"]), (r["ratio"], r["f"], r["v"], r["left"], r["right"]))
        self._record(grown, best, depth)

    def _narrow(self, grown: Grown, blocks: DataFrame, active, scored: DataFrame, best: dict, kernel) -> None:
        """Open buckets, as tables, until none is left: for levels with many open buckets, or with very large ones."""
        stored, cells = [], None
        try:
            while True:
                scored = scored.persist(StorageLevel.MEMORY_AND_DISK)
                stored.append(scored)
                opened, largest, rows = self._collect(scored, best)
                if not opened:
                    return
                cells, scored = self._open(cells, scored, best, opened, largest, _teams(opened, rows), kernel, lambda names: self._inside(grown, blocks, active, names))
        finally:
            for df in stored:
                df.unpersist()

    def _offer(self, best: dict, key: tuple, offer: tuple) -> None:
        """Keep the better split: lower ratio, then the first feature, then the smaller value."""
        place = lambda o: (o[0], self.layout.place(o[1], *o[5:]), o[2])
        if key not in best or place(offer) < place(best[key]):
            best[key] = offer

    def _best_categories(self, grown: Grown, counts: DataFrame, active, best: dict) -> None:
        """The best single category of each sparse column against all others: a split on its indicator. The others are the
        node less the category, so only categories that a node holds are looked at, and what is collected is a row per node and column."""
        width = len(self.classes) if self.classify else 3
        cells = [F.coalesce(F.sum(F.when(F.col("cls") == c, F.col("s0"))), F.lit(0.0)) for c in range(width)] if self.classify else [F.sum(s) for s in SUMS]
        each = counts.groupBy("model", "node", "f", "part").agg(F.array(*cells).alias("right"))
        whole = self._small([(m, i, [float(v) for v in grown.trees[m][i].stats]) for m, i in active], "model int, node long, whole array<double>")
        each = each.join(whole, ["model", "node"]).withColumn("left", F.zip_with("whole", "right", lambda a, b: a - b))

        def mass(s: Column) -> Column:
            if self.classify:
                n = F.aggregate(s, F.lit(0.0), lambda a, b: a + b)
                return F.when(n > 0.5, n - F.aggregate(s, F.lit(0.0), lambda a, b: a + b * b) / n).otherwise(0.0)
            return F.when(F.get(s, 0) > 0.5, F.greatest(F.lit(0.0), F.get(s, 2) - F.get(s, 1) * F.get(s, 1) / F.get(s, 0))).otherwise(0.0)

        size = F.aggregate("left", F.lit(0.0), lambda a, b: a + b) if self.classify else F.get("left", 0)
        ratio = F.round((mass(F.col("left")) + mass(F.col("right"))) / mass(F.col("whole")), DECIMALS)
        offers = each.where((F.col("part") >= 0) & (size > 0.5)).groupBy("model", "node", "f").agg(F.min(F.struct(ratio.alias("ratio"), "part", "left", "right")).alias("o"))
        for r in offers.collect():
            o = r["o"]
            self._offer(best, (r["model"], r["node"]), (o["ratio"], r["f"], float(o["part"]), o["left"], o["right"], int(o["part"])))

    def _inside(self, grown: Grown, blocks: DataFrame, active, names: DataFrame | None) -> DataFrame:
        """The rows of some buckets (of all, without names), merged by value: ``(model, node, f, part, v, cls, sums)``."""
        wanted = None
        if names is not None:
            wanted = {}
            for r in names.collect():
                wanted.setdefault((r["model"], r["node"]), []).append((r["f"], r["part"]))
        level = self._level(grown, active)
        return blocks.mapInArrow(lambda batches: level.values(batches, wanted), VALUES)

    def _histogram(self, cells: DataFrame, keys: list[str]) -> DataFrame:
        """Merged statistics per part and class; part -1 is kept value by value."""
        value = F.when(F.col("part") == -1, F.col("v"))
        return cells.groupBy(*keys, "cls", value.alias("value")).agg(
            F.min("v").alias("low"), F.max("v").alias("high"), *[F.sum(s).alias(s) for s in SUMS])

    def _collect(self, scored: DataFrame, best: dict) -> tuple[int, float, float]:
        """Keep each node's best offer; returns how many buckets stay open, the largest and the rows of all."""
        opened, largest, rows = 0, 0.0, 0.0
        summary = scored.groupBy("model", "node").agg(
            F.min(F.when(~F.col("open"), F.struct("ratio", "f", "v", "left", "right"))).alias("offer"),
            F.count_if("open").alias("opened"), F.max(F.when(F.col("open"), F.col("n"))).alias("largest"),
            F.sum(F.when(F.col("open"), F.col("n"))).alias("rows"))
        for r in summary.collect():
            key, offer = (r["model"], r["node"]), r["offer"]
            if offer is not None:
                self._offer(best, key, (offer["ratio"], offer["f"], offer["v"], offer["left"], offer["right"]))
            opened, largest, rows = opened + r["opened"], max(largest, r["largest"] or 0.0), rows + (r["rows"] or 0.0)
        return opened, largest, rows

    def _open(self, cells, scored, best, opened, largest, teams, kernel, rows_inside):
        """The rows of the open buckets in finer parts, and those parts' offers."""
        where = ["model", "node", "f", "part"]
        floors = self._small([(m, i, b[0]) for (m, i), b in best.items()],
                             "model int, node long, floor double")
        doubtful = scored.where("open").join(floors, ["model", "node"], "left")
        doubtful = doubtful.where(F.col("ratio") <= F.coalesce("floor", F.lit(1.0)))
        table = doubtful.select(*where, "left", "right", F.coalesce("floor", F.lit(1.0)).alias("floor"))
        few = opened <= BROADCAST_ROWS
        names = table.select(*where)
        if cells is None:
            inside = rows_inside(names) if few else rows_inside(None).join(names, where)
        else:
            inside = cells.join(F.broadcast(names) if few else names, where)
        if largest <= self.values_per_group:
            finer = inside.withColumns({"parent": F.col("part"), "part": F.lit(-1).cast("long")})
        else:
            probs = [i / PARTS for i in range(1, PARTS)]
            # the smallest value is always a cut, so that every round separates something
            cuts = inside.groupBy(*where).agg(F.array_union(
                F.percentile_approx("v", probs, 10 * PARTS), F.array(F.min("v"))).alias("cuts"))
            finer = inside.join(F.broadcast(cuts) if few else cuts, where)
            place = F.size(F.filter("cuts", lambda c: c < F.col("v")))
            finer = finer.withColumns({"parent": F.col("part"), "part": F.col("part") * (2 * PARTS) + place})
            finer = finer.drop("cuts")
        counts = self._histogram(finer, ["model", "node", "f", "parent", "part"])
        sides = table.select("model", "node", "f", F.col("part").alias("parent"), "left", "right", "floor")
        sides = sides.select(*[F.col(c).alias(c) for c in sides.columns])
        return finer.drop("parent"), _in_teams(counts.select(*[F.col(c).alias(c) for c in counts.columns]), sides, teams, kernel)

    def _record(self, grown: Grown, best: dict, depth: int) -> None:
        for (model, i), (ratio, feature, threshold, left, right, *category) in best.items():
            if not ratio < 1:
                continue
            nodes = grown.trees[model]
            node = nodes[i]
            node.feature, node.threshold = feature, threshold
            node.category = category[0] if category else None
            whole = self._mass_of([a + b for a, b in zip(left, right)])
            node.gain = whole - self._mass_of(left) - self._mass_of(right)
            nodes[2 * i] = self._node(depth + 1, list(left))
            nodes[2 * i + 1] = self._node(depth + 1, list(right))


def _teams(opened: int, rows: float) -> int:
    return max(1, min(opened, int(rows // ROWS_PER_TEAM) + 1))


def _in_teams(counts: DataFrame, sides: DataFrame, teams: int, kernel) -> DataFrame:
    """The offers of opened buckets. There are many of them in a forest, and a group costs more than the search of a small bucket,
    so each group has many."""
    team = F.pmod(F.xxhash64("model", "node", "f", "parent"), F.lit(teams)).alias("team")
    return counts.select("*", team).groupBy("team").cogroup(sides.select("*", team).groupBy("team")).applyInArrow(kernel, OFFERS)


def _summary(f: np.ndarray, v: np.ndarray, sampled: bool) -> pa.RecordBatch:
    return pa.record_batch({"f": pa.array(f, pa.int32()), "v": pa.array(v, pa.float64(), mask=np.isnan(v)), "sampled": pa.array(np.full(len(v), sampled))})


def _unpacked(batches, d: int, trees: int):
    """The (features, buckets, labels, folds, draws) of every block."""
    for batch in batches:
        # an Arrow batch can hold all blocks of a partition: one is copied at a time
        for row in range(batch.num_rows):
            x, b, y, fold, w = (batch.column(c)[row].as_buffer() for c in ("x", "b", "y", "fold", "w"))
            yield (np.frombuffer(x).reshape(-1, d), np.frombuffer(b, np.uint16).reshape(-1, d) if b.size else None, np.frombuffer(y),
                   np.frombuffer(fold, np.int32), np.frombuffer(w, np.uint8).reshape(-1, trees))


@dataclass
class _Level:
    """A level as tasks see it. ``models[model]`` has the tree so far, the position of each of its places among the nodes
    that are worked on (-1: none), their numbers, the slots each may split on, whether it is searched value by value, and the
    categories it may split on."""

    models: dict[int, tuple]
    held_out: list[int]
    trees: int
    d: int
    classes: int
    sparse: list[int]
    bucketed: bool

    def _rows(self, x, fold, w):
        """Per model the rows at its nodes: ``(model, rows, local node, draws)``."""
        for model, (tree, local, *_) in self.models.items():
            draws = w[:, model % self.trees]
            mine = np.flatnonzero((fold != self.held_out[model // self.trees]) & (draws > 0))
            at = local[tree.route(x[mine])]
            keep = at >= 0
            yield model, mine[keep], at[keep], draws[mine[keep]].astype(float)

    def _sums(self, key: np.ndarray, size: int, w: np.ndarray, y: np.ndarray):
        """Occurring keys (with the class inside, if there are classes) and their sums."""
        if self.classes:
            key, size = key * self.classes + y.astype(np.int64), size * self.classes
        inverse = key
        if size > 4 * len(key) + 1024:
            key, inverse = np.unique(key, return_inverse=True)
            size = len(key)
        else:
            key = np.arange(size)
        sums = [np.bincount(inverse, w, size)]
        sums += [np.zeros(size)] * 2 if self.classes else [np.bincount(inverse, w * y, size), np.bincount(inverse, w * y * y, size)]
        some = np.flatnonzero(sums[0])
        cls = key[some] % self.classes if self.classes else np.zeros(len(some), np.int64)
        return key[some] // max(self.classes, 1), cls, [v[some] for v in sums]

    def histograms(self, batches):
        for x, b, y, fold, w in _unpacked(batches, self.d, self.trees):
            ranks = {}
            found = []
            for model, rows, at, draws in self._rows(x, fold, w):
                _, _, ids, allowed, small, codes = self.models[model]
                for f in np.flatnonzero(allowed.any(axis=0)).tolist():
                    for by_value in (False, True):
                        some = allowed[at, f] & (small[at] == by_value)
                        if f in self.sparse:
                            if by_value:
                                continue
                            some = allowed[at, f]
                        if not some.any():
                            continue
                        r, node, n, z = rows[some], at[some], draws[some], y[rows[some]]
                        if f in self.sparse:
                            code = x[r, f].astype(np.int64) + 1  # unknown categories are one of their own
                            width = int(code.max()) + 1
                            key, cls, sums = self._sums(node * width + code, len(ids) * width, n, z)
                            part = key % width - 1
                            if codes[0] is not None:
                                open_ = np.zeros(len(key), bool)
                                for k in np.unique(key // width).tolist():
                                    mine = key // width == k
                                    open_[mine] = np.isin(part[mine], codes[k][f])
                                key, cls, part, sums = key[open_], cls[open_], part[open_], [v[open_] for v in sums]
                            low = high = np.zeros(len(key))
                        elif by_value:
                            if f not in ranks:
                                ranks[f] = np.unique(x[:, f], return_inverse=True)
                            values, code = ranks[f]
                            width = len(values)
                            key, cls, sums = self._sums(node * width + code[r], len(ids) * width, n, z)
                            part, low = np.full(len(key), -1), values[key % width]
                            high = low
                        else:
                            code, v = b[r, f].astype(np.int64), x[r, f]
                            width = int(code.max()) + 1
                            places = node * width + code
                            key, cls, sums = self._sums(places, len(ids) * width, n, z)
                            least, most = np.full(len(ids) * width, np.inf), np.full(len(ids) * width, -np.inf)
                            np.minimum.at(least, places, v)
                            np.maximum.at(most, places, v)
                            part, low, high = key % width, least[key], most[key]
                        found.append((np.full(len(key), model), ids[key // width], np.full(len(key), f), part, cls, low, high, *sums))
            if found:
                yield _record_batch(("model", "node", "f", "part", "cls", "low", "high", *SUMS), found)

    def values(self, batches, wanted: dict | None):
        """Rows of the wanted buckets by value."""
        for x, b, y, fold, w in _unpacked(batches, self.d, self.trees):
            found = []
            for model, rows, at, draws in self._rows(x, fold, w):
                _, _, ids, allowed, small, _ = self.models[model]
                for k, i in enumerate(ids.tolist()):
                    if wanted is not None and (model, i) not in wanted:
                        continue
                    here = np.flatnonzero(at == k)
                    slots = {f for f, _ in wanted[(model, i)]} if wanted is not None else set(np.flatnonzero(allowed[k]).tolist()) - set(self.sparse)
                    for f in sorted(slots):
                        code = b[rows[here], f].astype(np.int64) if not small[k] else np.full(len(here), -1)
                        inside = here if wanted is None else here[np.isin(code, [p for s, p in wanted[(model, i)] if s == f])]
                        if not len(inside):
                            continue
                        v = x[rows[inside], f]
                        values, rank = np.unique(v, return_inverse=True)
                        key, cls, sums = self._sums(rank, len(values), draws[inside], y[rows[inside]])
                        first = np.zeros(len(values), np.int64)
                        first[rank] = b[rows[inside], f] if not small[k] else -1
                        found.append((np.full(len(key), model), np.full(len(key), i), np.full(len(key), f), values[key], first[key], cls, *sums))
            if found:
                yield _record_batch(("model", "node", "f", "v", "part", "cls", *SUMS), found)


def _record_batch(names, found: list[tuple]) -> pa.RecordBatch:
    kinds = {"model": pa.int32(), "node": pa.int64(), "f": pa.int32(), "part": pa.int64(), "cls": pa.int32()}
    return pa.record_batch({c: pa.array(np.concatenate(cells), kinds.get(c, pa.float64())) for c, cells in zip(names, zip(*found))})


def _masses(s: np.ndarray, classify: bool) -> np.ndarray:
    """Node size times impurity per row of statistics: Gini, or squared error around the mean."""
    with np.errstate(all="ignore"):
        if classify:
            n = s.sum(axis=-1)
            return np.where(n > 0, n - (s * s).sum(axis=-1) / np.where(n > 0, n, 1.0), 0.0)
        n = s[..., 0]
        spread = s[..., 2] - s[..., 1] ** 2 / np.where(n > 0, n, 1.0)
        return np.where(n > 0, np.maximum(spread, 0.0), 0.0)


def _kernel(classes: int | None, cuts: list[np.ndarray] | None = None):
    """The group function that scores the buckets of nodes (or the parts of opened buckets).

    Emits the best edge and the buckets in which a better threshold may hide. ``outer`` carries
    the statistics left and right of each opened bucket. With ``cuts`` the edges are those cuts and nothing hides.
    """
    width = classes or 3

    def score(table: pa.Table, outer: pa.Table | None) -> pa.Table:
        inside = () if outer is None else ("parent",)
        columns = ("model", "node", "f", *inside, "part", "low", "high", "cls", *SUMS)
        got = {c: table.column(c).to_numpy() for c in columns}
        cut = np.where(got["part"] == -1, got["low"], got["part"])
        order = np.lexsort((cut, *(got[c] for c in inside), got["f"], got["node"], got["model"]))
        got, cut = {c: v[order] for c, v in got.items()}, cut[order]
        # one line per (node, feature, bucket or value); classes become columns
        step = lambda *names: np.any([got[c][1:] != got[c][:-1] for c in names], axis=0)
        new = np.r_[True, step("model", "node", "f", *inside) | (cut[1:] != cut[:-1])]
        line = np.cumsum(new) - 1
        stats = np.zeros((line[-1] + 1, width))
        if classes:
            np.add.at(stats, (line, got["cls"]), got["s0"])
        else:
            stats[:] = np.stack([got[c] for c in SUMS], axis=1)
        low, high = got["low"][new].copy(), got["high"][new].copy()
        np.minimum.at(low, line, got["low"])
        np.maximum.at(high, line, got["high"])
        got = {c: got[c][new] for c in ("model", "node", "f", *inside, "part")}
        if cuts is not None:
            edges = [np.append(c, np.inf) for c in cuts]
            low = high = np.array([edges[f][p] for f, p in zip(got["f"], got["part"])])
        own = ("model", "node", "f", "parent") if inside else ("model", "node")
        starts = np.nonzero(np.r_[True, step(*own)])[0]
        sides = {tuple(r[c] for c in own): r for r in outer.to_pylist()} if inside else {}
        if inside and classes and np.array_equal(low, high):
            return _inner_offers(starts, [sides[tuple(got[c][a] for c in own)] for a in starts.tolist()], got, high, stats)
        found = []
        for a, b in zip(starts, np.r_[starts[1:], len(low)]):
            key = tuple(got[c][a] for c in own)
            found.append(_offers(key, sides.get(key), got["f"][a:b], got["part"][a:b], low[a:b], high[a:b],
                                 stats[a:b], bool(classes)))
        return pa.concat_tables(found)

    return score


def _offers(key, outer, f, part, low, high, stats, classify) -> pa.Table:
    width = stats.shape[1]
    first = np.r_[True, f[1:] != f[:-1]]
    running = stats.cumsum(axis=0)
    start = np.nonzero(first)[0][np.cumsum(first) - 1]
    left = running - running[start] + stats[start]
    if outer is None:
        before, after, floor = np.zeros(width), np.zeros(width), 1.0
        whole = left[np.r_[first[1:], True]][0]
    else:
        before, after, floor = np.array(outer["left"]), np.array(outer["right"]), outer["floor"]
        whole = before + left[-1] + after
    left = left + before
    right = whole - left
    mass = _masses(whole, classify)
    halves = lambda a, b: np.round((_masses(a, classify) + _masses(b, classify)) / mass, DECIMALS)
    ratio, bound = halves(left, right), halves(left - stats, right)
    size = (lambda s: s.sum(axis=1)) if classify else (lambda s: s[:, 0])
    usable = np.nonzero(size(right) > 0.5)[0]
    chosen = []
    if len(usable):
        chosen = [usable[np.lexsort((high[usable], f[usable], ratio[usable]))[0]]]
        floor = min(floor, ratio[chosen[0]])
    doubtful = np.nonzero((low < high) & (bound < 1) & (bound <= floor))[0]
    rows = np.r_[np.array(chosen, dtype=int), doubtful]
    is_open = np.r_[np.zeros(len(chosen), dtype=bool), np.ones(len(doubtful), dtype=bool)]
    lefts = np.where(is_open[:, None], left[rows] - stats[rows], left[rows])
    return pa.table({
        "model": pa.array(np.full(len(rows), key[0]), pa.int32()),
        "node": pa.array(np.full(len(rows), key[1]), pa.int64()),
        "f": pa.array(f[rows], pa.int32()),
        "part": pa.array(part[rows]),
        "open": pa.array(is_open),
        "ratio": pa.array(np.where(is_open, bound[rows], ratio[rows])),
        "v": pa.array(high[rows]),
        "n": pa.array(size(stats)[rows]),
        "left": list_array(lefts),
        "right": list_array(right[rows]),
    })


def _inner_offers(starts, sides, got, high, stats) -> pa.Table:
    """The best edge of each of many opened buckets whose classes are counted value by value, all at once: sums of counts are exact."""
    lines = np.arange(len(stats))
    bucket = np.searchsorted(starts, lines, side="right") - 1
    before, after = (np.array([r[c] for r in sides], float) for c in ("left", "right"))
    running = stats.cumsum(axis=0)
    left = running - (running[starts] - stats[starts])[bucket]
    last = np.r_[starts[1:], len(stats)] - 1
    whole = before + left[last] + after
    left += before[bucket]
    right = whole[bucket] - left
    ratio = np.round((_masses(left, True) + _masses(right, True)) / _masses(whole, True)[bucket], DECIMALS)
    ratio = np.where(right.sum(axis=1) > 0.5, ratio, np.inf)
    least = np.minimum.reduceat(ratio, starts)
    # lines are in the order of their values: of equal ones the first
    rows = np.minimum.reduceat(np.where(ratio == least[bucket], lines, len(lines)), starts)[np.isfinite(least)]
    return pa.table({
        "model": pa.array(got["model"][rows], pa.int32()), "node": pa.array(got["node"][rows], pa.int64()), "f": pa.array(got["f"][rows], pa.int32()),
        "part": pa.array(got["part"][rows], pa.int64()), "open": pa.array(np.zeros(len(rows), bool)), "ratio": pa.array(ratio[rows]), "v": pa.array(high[rows]),
        "n": pa.array(stats[rows].sum(axis=1)), "left": list_array(left[rows]), "right": list_array(right[rows]),
    })


# --- models ------------------------------------------------------------------------------------

def vote(predictions: np.ndarray, task: str) -> np.ndarray:
    """(trees, rows) to one value per row: majority (smallest class on a tie) or mean."""
    if task != "classification":
        return predictions.mean(axis=0)
    classes = np.unique(predictions)
    counts = np.stack([(predictions == c).sum(axis=0) for c in classes])
    return classes[counts.argmax(axis=0)]


class TreeEnsemble(Model):
    """One tree or a forest."""

    def __init__(self, features, names: list[str], task: str, trees: list[Tree], layout: Layout):
        self.features, self.names, self.task, self.trees, self.layout = features, names, task, trees, layout

    def prediction(self, df: DataFrame) -> Column:
        if len(self.trees) == 1 and self.trees[0].depth <= EXPRESSION_DEPTH:
            value = self.trees[0].expression(columns_of(df, self.features))
        else:
            trees, task, d = self.trees, self.task, self.layout.slots

            @F.arrow_udf("double")
            def ensemble(xs):
                x = block(xs, d)
                return pa.array(vote(np.stack([t.predict(x) for t in trees]), task))

            value = ensemble(vector(df, self.features))
        return value.cast("int") if self.task == "classification" else value

    def importances(self) -> list[float]:
        gains = np.sum([t.gains(self.layout) for t in self.trees], axis=0)
        return (gains / gains.sum() if gains.sum() > 0 else gains).tolist()

    def to_table(self, spark) -> DataFrame:
        """``(tree_id, node_id, feature, threshold, left_id, right_id, value, n, gain)``."""
        rows = []
        for t, tree in enumerate(self.trees):
            for i, (node, split) in sorted(tree.nodes.items()):
                ids = (2 * i, 2 * i + 1) if split else (None, None)
                name = self.names[self.layout.place(node.feature, node.category)] if split else None
                rows.append((t, i, name, float(node.threshold) if split else None, *ids,
                             node.value, float(node.n), float(node.gain) if split else 0.0))
        return spark.createDataFrame(
            rows, "tree_id int, node_id long, feature string, threshold double, left_id long, "
            "right_id long, value double, n double, gain double")


class _TreeFamily:
    """Shared fitting of trees and forests."""

    n_trees: int | None = None
    max_features: int | None = None
    subset = "tree"

    def _matrix(self, df, label, features, keys) -> Matrix:
        return Matrix(df, tuple(keys or ()), label, features, task=self.task)

    def fit(self, df: DataFrame, label: str = "label", features="features",
            keys: list[str] | None = None, seed: int = 42) -> TreeEnsemble:
        if self.n_trees and not keys:
            raise ValueError("a forest needs the row keys to draw its samples from")
        m = self._matrix(df, label, features, keys)
        grower = _Grower(m, [None], self.n_trees, self.max_depth, self.min_samples_split,
                         self.max_features, seed, self.bins, self.solver, self.subset)
        grown = grower.grow()
        trees = [grown.cut(t, self.max_depth, self.min_samples_split) for t in sorted(grown.trees)]
        return TreeEnsemble(features, feature_names(df, features), self.task, trees, grower.layout)

    @classmethod
    def fit_matrix(cls, m: Matrix, params: dict, seed: int = 42) -> TreeEnsemble:
        return cls(**{"task": m.task, **params}).fit(m.df, m.label, m.features, list(m.keys), seed)

    @classmethod
    def out_of_fold(cls, m: Matrix, configs: list[dict], k: int, seed: int = 42,
                    full: dict | None = None) -> DataFrame:
        """``full`` receives the models of all rows, grown along with the folds'."""
        made = [cls(**{"task": m.task, **c}) for c in configs]
        parts = []
        # one growth per feature subset and solver; every other setting is read off the same trees
        kind = lambda c: (c.max_features or 0, c.solver, c.subset, c.bins or 0)
        for wanted in sorted({kind(c) for c in made}):
            members = [i for i, c in enumerate(made) if kind(c) == wanted]
            ensembles, complete, layout = cls._grow_grid(m, [made[i] for i in members], k, seed, full is not None)
            if full is not None:
                names = feature_names(m.df, m.features)
                full.update({i: TreeEnsemble(m.features, names, m.task, trees, layout)
                             for i, trees in zip(members, complete)})
            scored = explode_configs(m, _out_of_fold_scores(m, ensembles, k), k)
            number = F.element_at(F.array(*[F.lit(i) for i in members]), F.col("config") + 1)
            parts.append(scored.withColumn("config", number))
        out = parts[0]
        for part in parts[1:]:
            out = out.unionByName(part)
        return out

    @staticmethod
    def _grow_grid(m: Matrix, made: list, k: int, seed: int, full: bool):
        """``[config][fold] -> trees`` (and ``[config] -> trees`` of all rows) from one growth at
        the largest settings."""
        first = made[0]
        most = max(c.n_trees or 0 for c in made) or None
        folds = [*range(k)] + ([None] if full else [])
        grower = _Grower(m, folds, most, max(c.max_depth for c in made),
                         min(c.min_samples_split for c in made), first.max_features, seed, first.bins, first.solver, first.subset)
        grown = grower.grow()

        def trees(c, position):
            numbers = [grower.model(position, t) for t in range(c.n_trees or 1)]
            return [grown.cut(i, c.max_depth, c.min_samples_split) for i in numbers if i in grown.trees]

        return ([[trees(c, f) for f in range(k)] for c in made],
                [trees(c, k) for c in made] if full else [], grower.layout)


def _out_of_fold_scores(m: Matrix, ensembles, k: int) -> Column:
    d, task = width_of(m.df, m.features), m.task

    @F.arrow_udf("array<double>")
    def score(xs, folds):
        x = block(xs, d)
        fold = folds.to_numpy(zero_copy_only=False)
        out = np.full((len(x), len(ensembles)), np.nan)
        for f in range(k):
            rows = fold == f
            if rows.any():
                part = x[rows]
                for c, config in enumerate(ensembles):
                    out[rows, c] = vote(np.stack([t.predict(part) for t in config[f]]), task)
        return list_array(out)

    return score(vector(m.df, m.features), F.col(m.fold))


class DecisionTree(_TreeFamily):
    """``solver="binned"`` splits at the edges of up to ``bins`` buckets, "exact" at any value."""

    def __init__(self, max_depth: int = 5, min_samples_split: int = 2,
                 task: str = "classification", bins: int | None = None, solver: str = "exact"):
        self.max_depth, self.min_samples_split = max_depth, min_samples_split
        self.task, self.bins, self.solver = task, bins, _solver(solver)


class RandomForest(_TreeFamily):
    """Each tree sees a Poisson(1) resample of the rows and its own subset of the features, or
    with ``subset="node"`` a subset for every node."""

    def __init__(self, n_trees: int = 10, max_depth: int = 5, min_samples_split: int = 2,
                 max_features: int | None = None, task: str = "classification",
                 bins: int | None = None, solver: str = "exact", subset: str = "tree"):
        if subset not in ("tree", "node"):
            raise ValueError("subset must be 'tree' or 'node'")
        self.n_trees, self.max_depth, self.min_samples_split = n_trees, max_depth, min_samples_split
        self.max_features, self.task, self.bins = max_features, task, bins
        self.solver, self.subset = _solver(solver), subset


def _solver(name: str) -> str:
    if name not in ("exact", "binned"):
        raise ValueError("solver must be 'exact' or 'binned'")
    return name
