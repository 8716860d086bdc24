"""N-gram Jaccard join: exact links between word-shingle sets, found with signature trees.

1. Every text becomes a set of shingle hashes; equal sets are one vertex. Only sets in which enough shingles occur
   elsewhere can have a link at all: of the first ``n - a + l`` hashes of a set (``a`` the least overlap of a link)
   at least ``l`` must be shared. All other sets are done.
2. The remaining vertices are packed into nodes: those with the same least hash, up to ``NODE`` each. A node holds the
   OR of its members' token bitmaps, their size range and the most tokens that a bitmap hides.
3. Nodes that share a prefix token meet in one group, which builds a signature tree over them and traverses it against
   itself: a pair of tree nodes is dropped when the sizes differ too much, when all members are connected already, or
   when the common bits cannot hold the overlap that a link needs.
4. Surviving node pairs fetch the sets and descend to member pairs; exact overlaps decide. Pairs that are connected
   already are not tested again, so a group of copies costs a spanning tree and not all its pairs.

Links are vertices of different texts; connected components come from label propagation over tables.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..session import durable
from .common import LANES, NOT_SPACE, chained, list_array, mixed, row_count, signed, slices, small, texts, words

NODE = 256
FAN = 8
# Nodes of one token that meet in one group; more are dealt over pairs of chunks.
BLOCK = 10_000


def least_overlap(n, percent: int):
    """Fewest common shingles of a link of a set of ``n``: a partner has at least ``percent`` of them."""
    return (n * percent + 99) // 100


def _spare(n, percent: int):
    """``l`` of the filter for a set of ``n``."""
    return 1 + n * (100 - percent) // 300


def sets(data: np.ndarray, offsets: np.ndarray, k: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of every row; fewer than ``k`` words are one shingle."""
    _, _, rows, hashes = words(data, offsets, NOT_SPACE)
    counts = np.bincount(rows, minlength=len(offsets) - 1)
    first = np.concatenate([[0], np.cumsum(counts)])
    shingles = chained(hashes, k)
    out = []
    for i, n in enumerate(counts):
        if n >= k:
            out.append(np.unique(shingles[first[i]:first[i + 1] - k + 1]))
        elif n:
            out.append(chained(hashes[first[i]:first[i + 1]], int(n)) ^ np.uint64(LANES[0]))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def _name(tokens: np.ndarray) -> int:
    """64-bit name of a set."""
    total = mixed(tokens ^ np.uint64(LANES[3])).sum(dtype=np.uint64, keepdims=True)
    return int(signed(mixed(total + np.array([len(tokens)], np.uint64) * np.uint64(LANES[5])))[0])


def vertices(docs: DataFrame, key: str, text: str, k: int, percent: int) -> DataFrame:
    """``(key, text_hash, n, h, prefix)`` for each row: size and name of its set, and the hashes that the filter looks at."""
    docs = docs.select(key, F.xxhash64(text).alias("text_hash"), text)

    def shingled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text):
                found = sets(*texts(part.column(text)), k)
                n = np.array([len(s) for s in found], np.int64)
                length = np.minimum(n, n - least_overlap(n, percent) + _spare(n, percent)) * (n > 0)
                flat = np.concatenate([s[:m] for s, m in zip(found, length)]) if len(found) else np.zeros(0, np.uint64)
                yield pa.RecordBatch.from_arrays(
                    [part.column(key), part.column("text_hash"), pa.array(n), pa.array([_name(s) for s in found], pa.int64()), list_array(signed(flat), length, pa.int64())],
                    [key, "text_hash", "n", "h", "prefix"])

    long = T.LongType()
    return docs.mapInArrow(shingled, T.StructType([docs.schema[key], T.StructField("text_hash", long), T.StructField("n", long), T.StructField("h", long), T.StructField("prefix", T.ArrayType(long))]))


def full_sets(docs: DataFrame, wanted: DataFrame, key: str, text: str, k: int, percent: int) -> DataFrame:
    """``(h, n, first, tokens, bits, width, prefix)`` of the wanted vertices, read from one document each.

    ``bits`` is the signature of ``2^width`` bits; ``prefix`` are the hashes of which a link shares at least one.
    """
    rows = docs.select(key, F.xxhash64(text).alias("text_hash"), text)
    rows = rows.join(small(wanted.select(F.col("label.key").alias("_k"), F.col("label.text_hash").alias("_t"))), (F.col("text_hash") == F.col("_t")) & F.col(key).eqNullSafe(F.col("_k"))).select(text)

    def shingled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text):
                found = [s for s in sets(*texts(part.column(text)), k) if len(s)]
                marks = [signature(s, width(len(s))) for s in found]
                length = np.array([len(s) - least_overlap(len(s), percent) + 1 for s in found], int)
                flat = np.concatenate([s[:m] for s, m in zip(found, length)]) if found else np.zeros(0, np.uint64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([_name(s) for s in found], pa.int64()), pa.array([len(s) for s in found], pa.int64()),
                     pa.array([int(signed(s[:1])[0]) for s in found], pa.int64()), pa.array([s.tobytes() for s in found], pa.binary()),
                     pa.array([m.tobytes() for m in marks], pa.binary()), pa.array([width(len(s)) for s in found], pa.int64()), list_array(signed(flat), length, pa.int64())],
                    ["h", "n", "first", "tokens", "bits", "width", "prefix"])

    return rows.mapInArrow(shingled, "h long, n long, first long, tokens binary, bits binary, width long, prefix array<long>")


def width(n: int) -> int:
    """Logarithm of the number of bits for a set of ``n``: two to four bits per token."""
    return max(10, int(2 * n - 1).bit_length())


def signature(tokens: np.ndarray, log_bits: int) -> np.ndarray:
    """Bitmap of a set. Half the bits give the OR of the two halves, see :func:`halved`."""
    bits = np.zeros(1 << log_bits, bool)
    bits[(tokens >> np.uint64(20)) & np.uint64((1 << log_bits) - 1)] = True
    return np.packbits(bits).view(np.uint64)


def halved(bitmaps: np.ndarray) -> np.ndarray:
    half = bitmaps.shape[1] // 2
    return bitmaps[:, :half] | bitmaps[:, half:]


def hidden_tokens(bitmaps: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """How many tokens of each set share a bit with another one of it."""
    return sizes - np.bitwise_count(bitmaps).sum(1, dtype=np.int64)


class Tree:
    """Levels of OR-combined bitmaps, size ranges and hidden tokens over leaves in a given order."""

    def __init__(self, bitmaps: np.ndarray, low: np.ndarray, high: np.ndarray, hidden: np.ndarray):
        self.levels = [(bitmaps, low, high, hidden)]
        while len(self.levels[-1][1]) > FAN:
            bitmaps, low, high, hidden = self.levels[-1]
            at = np.arange(0, len(low), FAN)
            self.levels.append((np.bitwise_or.reduceat(bitmaps, at), np.minimum.reduceat(low, at), np.maximum.reduceat(high, at), np.maximum.reduceat(hidden, at)))

    def pairs(self, percent: int, roots: Callable[[], np.ndarray], batch: int = 2048) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs of leaves ``i < j`` that may hold a link, in batches.

        ``roots`` gives a component per leaf as it stands now; pairs within one component are pruned.
        """
        top = len(self.levels) - 1
        n = len(self.levels[top][1])
        i, j = np.triu_indices(n)
        stack = [(top, i, j)]
        while stack:
            level, i, j = stack.pop()
            if len(i) > batch:
                stack.append((level, i[batch:], j[batch:]))
                i, j = i[:batch], j[:batch]
            bitmaps, low, high, hidden = self.levels[level]
            keep = (high[i] * 100 >= low[j] * percent) & (high[j] * 100 >= low[i] * percent)
            one = self._uniform(level, roots())
            keep &= ~((one[i] == one[j]) & (one[i] != -1))
            if level == 0:
                keep &= i != j
            i, j = i[keep], j[keep]
            common = np.bitwise_count(bitmaps[i] & bitmaps[j]).sum(1, dtype=np.int64) + np.minimum(hidden[i], hidden[j])
            keep = common * (100 + percent) >= (low[i] + low[j]) * percent
            i, j = i[keep], j[keep]
            if not len(i):
                continue
            if level == 0:
                yield i, j
                continue
            size = len(self.levels[level - 1][1])
            a = (i[:, None, None] * FAN + np.arange(FAN)[None, :, None]) + np.zeros((1, 1, FAN), int)
            b = (j[:, None, None] * FAN + np.arange(FAN)[None, None, :]) + np.zeros((1, FAN, 1), int)
            ok = (a < size) & (b < size) & ((i != j)[:, None, None] | (a <= b))
            stack.append((level - 1, a[ok], b[ok]))

    def _uniform(self, level: int, roots: np.ndarray) -> np.ndarray:
        for _ in range(level):
            at = np.arange(0, len(roots), FAN)
            low, high = np.minimum.reduceat(roots, at), np.maximum.reduceat(roots, at)
            roots = np.where(low == high, low, -1)
        return roots


class Union:
    """Components of a small group; roots are positions."""

    def __init__(self, start: np.ndarray):
        _, first, inverse = np.unique(start, return_index=True, return_inverse=True)
        self.parent = first[inverse.ravel()]

    def find(self, i: int) -> int:
        while self.parent[i] != i:
            self.parent[i] = i = self.parent[self.parent[i]]
        return i

    def roots(self) -> np.ndarray:
        while True:
            up = self.parent[self.parent]
            if np.array_equal(up, self.parent):
                return up
            self.parent = up


def links(names: np.ndarray, tokens: list[np.ndarray], components: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Pairs (member, root) that connect the members of a group as all their links would, together with their components."""
    _, once = np.unique(names, return_index=True)
    order = once[np.lexsort((np.array([len(tokens[i]) for i in once]), components[once]))]
    if len(order) < 2:
        return []
    names, tokens, components = names[order], [tokens[i] for i in order], components[order]
    sizes = np.array([len(t) for t in tokens], np.int64)
    marks = np.stack([signature(t, width(int(sizes.max()))) for t in tokens])
    tree = Tree(marks, sizes, sizes, hidden_tokens(marks, sizes))
    # Exact overlaps come from bitmaps over the group's own repeated tokens, made when the first pair asks.
    union, local = Union(components), None
    for i, j in tree.pairs(percent, union.roots):
        if local is None:
            local = _local_bitmaps(tokens)
        at = 0
        step = 32
        while at < len(i):
            a, b = i[at:at + step], j[at:at + step]
            at += step
            step = min(step * 2, 2048)
            roots = union.roots()
            apart = roots[a] != roots[b]
            a, b = a[apart], b[apart]
            overlap = np.bitwise_count(local[a] & local[b]).sum(1, dtype=np.int64)
            for x, y in zip(*(v[overlap * (100 + percent) >= (sizes[a] + sizes[b]) * percent] for v in (a, b))):
                rx, ry = union.find(x), union.find(y)
                if rx != ry:
                    union.parent[max(rx, ry)] = min(rx, ry)
    if local is None:
        return []
    # Stars: components of stars take few rounds.
    roots = union.roots()
    return [(int(names[i]), int(names[r])) for i, r in enumerate(roots) if i != r]


def _local_bitmaps(tokens: list[np.ndarray]) -> np.ndarray:
    """One bit per token that at least two members hold."""
    flat = np.concatenate(tokens)
    values, inverse, counts = np.unique(flat, return_inverse=True, return_counts=True)
    place = np.cumsum(counts > 1) - 1
    member = np.repeat(np.arange(len(tokens)), [len(t) for t in tokens])
    shared = (counts > 1)[inverse]
    words_ = (int((counts > 1).sum()) + 63) // 64 or 1
    out = np.zeros((len(tokens), words_), np.uint64)
    bit = place[inverse][shared]
    np.bitwise_or.at(out, (member[shared], bit >> 6), np.uint64(1) << (bit & 63).astype(np.uint64))
    return out


def _linked(rows: DataFrame, by: list[str], full: DataFrame, percent: int) -> DataFrame:
    """Edges found inside groups of rows ``(by..., h, n, component)``; the sets join in last. Small groups share a call."""
    count, size = rows.agg(F.count(F.lit(1)), F.sum("n") * 8).first()
    n = max(1, count // 2000, (size or 0) >> 24)
    rows = small(rows.select(F.pmod(F.xxhash64(*by), F.lit(n)).alias("_bucket"), *by, F.col("h").alias("_h"), "component"))
    rows = full.select("h", "tokens").join(rows, F.col("h") == F.col("_h"))

    def link(group: pa.Table) -> pa.Table:
        names, components = (np.asarray(group.column(c)) for c in ("h", "component"))
        keys = [np.asarray(group.column(c)) for c in by]
        order = np.lexsort(keys)
        change = np.zeros(len(order), bool)
        for key in keys:
            change[1:] |= key[order][1:] != key[order][:-1]
        blob, edges = group.column("tokens"), []
        for part in np.split(order, np.flatnonzero(change)):
            if len(part) > 1:
                edges += links(names[part], [np.frombuffer(blob[int(i)].as_py(), np.uint64) for i in part], components[part], percent)
        return pa.table({"a": pa.array([e[0] for e in edges], pa.int64()), "b": pa.array([e[1] for e in edges], pa.int64())})

    return rows.select("_bucket", *by, "h", "component", "tokens").groupBy("_bucket").applyInArrow(link, "a long, b long")


def components(edges: DataFrame) -> DataFrame:
    """``(h, component)`` of all ends of ``edges``: the least name reachable. Tables cut the lineage of each round."""
    both = durable(edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))))
    state = durable(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("c")))
    while True:
        near = both.join(state.select(F.col("a").alias("b"), "c"), "b").groupBy("a").agg(F.min("c").alias("d"))
        step = state.join(near, "a").select("a", "c", F.least("c", "d").alias("d"))
        jump = step.select(F.col("a").alias("_v"), F.col("d").alias("_up"))
        new = durable(step.join(jump, F.col("d") == F.col("_v"), "left").select("a", "c", F.least("d", F.coalesce("_up", "d")).alias("d")))
        moved = new.where("c <> d").limit(1).count()
        state = new.select("a", F.col("d").alias("c"))
        if not moved:
            return state.select(F.col("a").alias("h"), F.col("c").alias("component"))


def _with_component(rows: DataFrame, found: DataFrame | None) -> DataFrame:
    if found is None:
        return rows.withColumn("component", F.col("h"))
    return rows.join(small(found), "h", "left").withColumn("component", F.coalesce("component", "h"))


def _salt(column: str, count: Column, size: int) -> Column:
    return F.pmod(F.xxhash64(column, F.lit(5)), F.ceil(count / size))


def graph(full: DataFrame, percent: int) -> DataFrame:
    """Spanning links of all vertices in ``full``, as ``(a, b)``."""
    vertex = full.select("h", "n", "first", "width").dropDuplicates(["h"])
    sizes = durable(vertex.groupBy(F.col("first").alias("_f")).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1"))
    # Quick rounds: vertices with the same least hash by chunks; where these are several, one of each component again.
    near = durable(vertex.join(small(sizes), F.col("first") == F.col("_f")).drop("_f"))
    edges = durable(_linked(near.withColumn("component", F.col("h")).withColumn("chunk", _salt("h", F.col("_n"), NODE)), ["first", "chunk"], full, percent))
    found = durable(components(edges))
    hot = near.where(F.col("_n") > NODE)
    while hot.limit(1).count():
        one = _with_component(hot, found).groupBy("first", "component").agg(F.min(F.struct("h", "n")).alias("_v"))
        left = one.groupBy(F.col("first").alias("_f")).agg(F.count(F.lit(1)).alias("_m")).where("_m > 1")
        one = durable(one.join(left, F.col("first") == F.col("_f")).select("first", "_m", "component", F.col("_v.h").alias("h"), F.col("_v.n").alias("n")))
        more = durable(_linked(one.withColumn("chunk", _salt("h", F.col("_m"), NODE)), ["first", "chunk"], full, percent))
        if not more.limit(1).count():
            break
        edges = found.select(F.col("h").alias("a"), F.col("component").alias("b")).where("a <> b").union(more)
        found = durable(components(edges))
        hot = hot.join(one.where(F.col("_m") > NODE).select(F.col("first").alias("_f")).distinct(), F.col("first") == F.col("_f"), "left_semi")
    stars = found.select(F.col("h").alias("a"), F.col("component").alias("b")).where("a <> b")
    return stars.union(durable(_across(vertex, found, full, percent)))


def _across(vertex: DataFrame, found: DataFrame, full: DataFrame, percent: int) -> DataFrame:
    """Links between vertices of different components, exact: every pair that shares a prefix token is covered."""
    # A node is a component or, beyond ``NODE`` vertices, a chunk of one: its bitmap stays tight.
    placed = _with_component(vertex, found)
    sizes = placed.groupBy(F.col("component").alias("_c")).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > NODE)
    placed = placed.join(small(durable(sizes)), F.col("component") == F.col("_c"), "left")
    chunk = F.coalesce(_salt("h", F.col("_n"), NODE), F.lit(0))
    placed = durable(placed.select("h", "n", "component", F.xxhash64("component", chunk, F.col("width")).alias("node")))

    # Prefix tokens of nodes, each node once per token with its OR-combined bitmap.
    n_groups = max(1, row_count(placed) // 5000)

    def summarised(group: pa.Table) -> pa.Table:
        node, n, component, log_bits = (np.asarray(group.column(c)) for c in ("node", "n", "component", "width"))
        order = np.argsort(node, kind="stable")
        bits, prefixes = group.column("bits"), group.column("prefix")
        out = {c: [] for c in ("node", "width", "bits", "low", "high", "hidden", "component", "size", "prefix")}
        for part in np.split(order, np.flatnonzero(np.diff(node[order])) + 1):
            prefix = np.unique(np.concatenate([np.asarray(prefixes[int(i)].values) for i in part]))
            marks = np.frombuffer(b"".join(bits[int(i)].as_py() for i in part), np.uint64).reshape(len(part), -1)
            low, log = int(n[part].min()), int(log_bits[part[0]])
            # A node meets others at its own width and, if partners of its members may be narrower, at half of it.
            while True:
                values = (int(node[part[0]]), log, np.bitwise_or.reduce(marks).tobytes(), low, int(n[part].max()), int(hidden_tokens(marks, n[part]).max()), int(component[part[0]]), len(part), prefix)
                for c, v in zip(out, values):
                    out[c].append(v)
                if width(int(least_overlap(low, percent))) == log:
                    break
                marks, log = halved(marks), log - 1
        kinds = (pa.int64(), pa.int64(), pa.binary(), *[pa.int64()] * 5, pa.list_(pa.int64()))
        return pa.table({c: pa.array(v, k) for (c, v), k in zip(out.items(), kinds)})

    rows = full.select("h", "bits", "width", "prefix").join(small(placed.withColumnRenamed("h", "_h")), F.col("h") == F.col("_h"))
    nodes = durable(rows.withColumn("_g", F.pmod(F.xxhash64("node"), F.lit(n_groups))).groupBy("_g").applyInArrow(
        summarised, "node long, width long, bits binary, low long, high long, hidden long, component long, size long, prefix array<long>"))
    member = nodes.select("node", "width", "component", F.explode("prefix").alias("token"))
    # A token matters where it meets two components.
    token = member.groupBy("token", "width").agg(F.count(F.lit(1)).alias("_n"), F.min("component").alias("_lo"), F.max("component").alias("_hi"))
    token = durable(token.where(F.col("_lo") < F.col("_hi")).withColumn("_q", F.ceil(F.col("_n") / BLOCK)).select("token", "width", "_q"))
    met = member.select("node", "width", "token").join(small(token), ["token", "width"]).withColumn("_i", F.pmod(F.xxhash64("node"), F.col("_q")))
    met = met.withColumn("_j", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_q") - 1)))
    met = durable(met.select("token", "width", "node", F.least("_i", "_j").alias("_a"), F.greatest("_i", "_j").alias("_b")))
    # Some 16 MB of bitmaps for a call.
    n_met = max(1, (met.agg(F.sum(F.expr("shiftleft(1L, cast(width - 3 as int)) + 64L"))).first()[0] or 0) >> 24)

    def survivors(group: pa.Table) -> pa.Table:
        keys = [np.asarray(group.column(c)) for c in ("token", "width", "_a", "_b")]
        order = np.lexsort(keys)
        change = np.zeros(len(order), bool)
        for key in keys:
            change[1:] |= key[order][1:] != key[order][:-1]
        node, low, high, hidden, component, size = (np.asarray(group.column(c)) for c in ("node", "low", "high", "hidden", "component", "size"))
        bits, found = group.column("bits"), set()
        for part in np.split(order, np.flatnonzero(change)):
            if len(part) < 2:
                continue
            part = part[np.lexsort((low[part], component[part]))]
            roots = np.unique(component[part], return_inverse=True)[1].ravel()
            marks = np.frombuffer(b"".join(bits[int(i)].as_py() for i in part), np.uint64).reshape(len(part), -1)
            tree = Tree(marks, low[part], high[part], hidden[part])
            for i, j in tree.pairs(percent, lambda: roots):
                a, b = part[i], part[j]
                swap = (size[a] > size[b]) | ((size[a] == size[b]) & (node[a] > node[b]))
                found.update(zip(node[np.where(swap, b, a)].tolist(), node[np.where(swap, a, b)].tolist()))
        found = sorted(found)
        return pa.table({"x": pa.array([f[0] for f in found], pa.int64()), "y": pa.array([f[1] for f in found], pa.int64())})

    met = nodes.select(F.col("node").alias("_node"), F.col("width").alias("_width"), "bits", "low", "high", "hidden", "component", "size").join(
        met, (F.col("_node") == F.col("node")) & (F.col("_width") == F.col("width")))
    pairs = met.withColumn("_g", F.pmod(F.xxhash64("token", "width", "_a", "_b"), F.lit(n_met))).groupBy("_g").applyInArrow(survivors, "x long, y long").distinct()
    # The larger node of a pair, y, meets all its partners together, or so many chunks of them.
    pairs = durable(pairs)
    partners = pairs.groupBy(F.col("y").alias("_y")).agg(F.ceil(F.count(F.lit(1)) / NODE).alias("_q"))
    pairs = durable(pairs.join(small(durable(partners)), F.col("y") == F.col("_y")).select("x", "y", F.pmod(F.xxhash64("x"), F.col("_q")).alias("part")))
    sides = pairs.select("y", "part", F.col("x").alias("_node")).union(pairs.select("y", "part", F.col("y").alias("_node")).distinct())
    sides = durable(sides.join(small(placed), F.col("_node") == F.col("node")).select("y", "part", "h", "n", "component"))
    return _linked(sides, ["y", "part"], full, percent)


def _placed(docs: DataFrame, key: str, text: str, k: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """``vertices`` of all rows, and ``(h, component)`` of the sets that have links."""
    rows = durable(vertices(docs, key, text, k, percent))
    some = rows.where("n > 0")
    sets_ = durable(some.groupBy("h", "n").agg(F.count(F.lit(1)).alias("copies"), F.min(F.struct("text_hash", F.col(key).alias("key"))).alias("label")))
    token = some.select("h", F.explode("prefix").alias("token"))
    shared = token.groupBy("token").agg(F.min("h").alias("_lo"), F.max("h").alias("_hi")).where("_lo < _hi").select("token")
    hits = token.join(shared, "token", "left_semi").groupBy("h").agg(F.count(F.lit(1)).alias("_c"))
    # A partner has at least ``a`` shingles, so the filter of the smaller of the two is at least that of ``a``.
    a = F.floor((F.col("n") * percent + 99) / 100)
    need = 1 + F.floor(a * (100 - percent) / 300)
    suspects = durable(sets_.join(hits, "h").where(F.col("_c") >= need * F.col("copies")).select("h", "label"))
    return rows, components(graph(durable(full_sets(docs, suspects, key, text, k, percent)), percent))


def _least(rows: DataFrame, found: DataFrame, least: Column) -> DataFrame:
    """``(_h, least)`` of each set of ``rows``: the least value in its component."""
    own = rows.where("n > 0").groupBy("h").agg(F.min(least).alias("_own"))
    own = durable(own.join(found, "h", "left").withColumn("component", F.coalesce("component", "h")))
    ids = own.groupBy("component").agg(F.min("_own").alias("least"))
    return own.join(ids, "component").select(F.col("h").alias("_h"), "least")


def jaccard_components(docs: DataFrame, key: str = "doc_id", text: str = "text", k: int = 5, percent: int = 80) -> DataFrame:
    """``(key, n_shingles, component_id)`` for each row of ``docs``.

    Words are split at ASCII white space, A-Z lower-cased; a text of fewer than ``k`` words is one shingle. Two rows
    link when ``100 * overlap >= percent * union``; ``component_id`` is the least key reachable by links. Null, empty
    and wordless texts have no shingle and are their own component. Rows with equal sets belong together, repeated
    rows as well; null keys take part, and only a component of null keys has a null id. An empty table stays empty.
    """
    rows, found = _placed(docs, key, text, k, percent)
    named = _least(rows, found, F.col(key)).withColumnRenamed("least", "component_id")
    out = rows.join(named, (F.col("h") == F.col("_h")) & (F.col("n") > 0), "left")
    return out.select(key, F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col(key)).alias("component_id"))


def deduplicated(docs: DataFrame, key: str = "doc_id", text: str = "text", k: int = 5, percent: int = 80) -> DataFrame:
    """One row of each component with all columns; texts without words all stay.

    The row kept is the one with the least key (null last), then text hash, then hash of the whole row. Decisions are
    per key and text: a key may repeat with other texts, rows may repeat, keys may be null.
    """
    rows, found = _placed(docs, key, text, k, percent)
    kept = _least(rows, found, F.struct(F.col(key).isNull().alias("none"), F.col(key).alias("key"), F.col("text_hash").alias("text_hash")))
    rows = rows.where("n > 0").select(F.col(key).alias("_gone"), "text_hash", "h").join(kept, F.col("h") == F.col("_h"))
    stays = F.col("_gone").eqNullSafe(F.col("least.key")) & (F.col("text_hash") == F.col("least.text_hash"))
    rows = durable(rows.select("_gone", F.col("text_hash").alias("_hash"), stays.alias("_stays")))
    gone = rows.where(~F.col("_stays")).select("_gone", "_hash").distinct()
    # Of a kept row that repeats, one is chosen by an aggregate; the rest of the table is not shuffled.
    repeated = durable(rows.where("_stays").groupBy("_gone", "_hash").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("_gone", "_hash"))
    apart = small(durable(gone.union(repeated)))
    rows = docs.select(F.struct("*").alias("_row"), F.col(key).alias("_k"), F.xxhash64(text).alias("_t"))
    same = F.col("_k").eqNullSafe(F.col("_gone")) & (F.col("_t") == F.col("_hash"))
    out = rows.join(apart, same, "left_anti").select("_row")
    if repeated.limit(1).count():
        ones = rows.join(small(repeated), same, "left_semi").groupBy("_k", "_t")
        out = out.union(ones.agg(F.min_by("_row", F.xxhash64(F.to_json("_row"))).alias("_row")).select("_row"))
    return out.select("_row.*")
