"""Approximate nearest neighbours by largest inner product, from low-dimensional stable projections.

Appending ``sqrt(M^2 - |x|^2)`` (``M`` the largest norm) turns inner products into Euclidean distances. Gaussian
(2-stable) projections map vectors to ``DIMENSIONS`` numbers, so that ``projected^2 / distance^2`` is chi-square with
``DIMENSIONS`` degrees. Every shard of vectors is a kd-tree over its projections; a query takes leaves in order of
projected distance, verifies their vectors exactly and stops when the chi-square test holds: an unseen vector nearer
than the current k-th would lie in the leaves seen with probability ``confidence``. Shards answer alone and answers merge.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from ..session import durable
from .common import row_count

DIMENSIONS = 8
LEAF = 64
SHARD = 8192
# Queries of one broadcast block, and rows of the sample that gives each query a first bound.
BLOCK = 4096
SAMPLE = 2048
CONFIDENCE = 0.97


def chi_square(x: np.ndarray, even: int = DIMENSIONS) -> np.ndarray:
    """Distribution function of chi-square with an even number of degrees."""
    half = np.minimum(x / 2, 700.0)
    term, total = np.ones_like(half), np.ones_like(half)
    for i in range(1, even // 2):
        term = term * half / i
        total = total + term
    return 1 - np.exp(-half) * total


def stopping_ratio(confidence: float) -> float:
    """Squared projected distance over squared distance at which the test holds (bisection)."""
    low, high = 0.0, 200.0
    for _ in range(100):
        middle = (low + high) / 2
        low, high = (middle, high) if chi_square(np.array([middle]))[0] < confidence else (low, middle)
    return high


class KdTree:
    """Median splits along the widest side, down to ``LEAF`` points; leaves keep their bounding boxes."""

    def __init__(self, points: np.ndarray):
        self.leaves: list[np.ndarray] = []
        stack = [np.arange(len(points))]
        while stack:
            at = stack.pop()
            if len(at) <= LEAF:
                self.leaves.append(at)
                continue
            axis = int(np.argmax(np.ptp(points[at], axis=0)))
            order = at[np.argpartition(points[at, axis], len(at) // 2)]
            stack += [order[len(at) // 2:], order[:len(at) // 2]]
        self.low = np.stack([points[x].min(0) for x in self.leaves])
        self.high = np.stack([points[x].max(0) for x in self.leaves])

    def distances(self, queries: np.ndarray) -> np.ndarray:
        """Squared distance from each query to each leaf's box."""
        out = np.zeros((len(queries), len(self.leaves)))
        for d in range(queries.shape[1]):
            q = queries[:, d:d + 1]
            gap = np.maximum(np.maximum(self.low[None, :, d] - q, q - self.high[None, :, d]), 0)
            out += gap * gap
        return out


def exact(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Row-wise inner products; the same vectors give the same number wherever they stand."""
    return (left * right).sum(axis=1)


def shard_answers(ids: np.ndarray, vectors: np.ndarray, queries: tuple, k: int, largest: float, confidence: float, seed: int) -> tuple[np.ndarray, ...]:
    """(query id, vector id, score) of up to ``k`` neighbours of each query in this shard that reach the query's bound."""
    order = np.argsort(ids, kind="stable")
    ids, vectors = ids[order], vectors[order]
    # Copies of one vector: the k + 1 least ids can answer, no other ever does.
    _, code = np.unique(vectors, axis=0, return_inverse=True)
    by_code = np.argsort(code.ravel(), kind="stable")
    sorted_code = code.ravel()[by_code]
    place = np.arange(len(ids)) - np.searchsorted(sorted_code, sorted_code)
    keep = np.sort(by_code[place <= k])
    ids, vectors = ids[keep], vectors[keep]

    q_ids, q_vectors, bound = queries
    size = vectors.shape[1]
    axes = np.random.default_rng(seed).normal(size=(size + 1, DIMENSIONS))
    rest = np.sqrt(np.maximum(largest**2 - exact(vectors, vectors), 0))
    tree = KdTree(vectors @ axes[:size] + rest[:, None] * axes[size])
    squares = exact(q_vectors, q_vectors) + largest**2
    ratio, slack = stopping_ratio(confidence), 1e-9 * max(largest, 1e-300) * np.sqrt(exact(q_vectors, q_vectors))
    out = []
    for start in range(0, len(q_ids), 512):
        part = slice(start, min(start + 512, len(q_ids)))
        n = part.stop - start
        boxes = tree.distances(q_vectors[part] @ axes[:size])
        sequence = np.argsort(boxes, axis=1, kind="stable")
        best = np.full((n, k), -np.inf)
        floor = bound[part].copy()
        hits: list[tuple] = []
        active = np.arange(n)
        for step in range(sequence.shape[1]):
            leaf = sequence[active, step]
            # 2-stable test on the next leaf: at this projected distance a better vector would have been seen.
            reach = squares[part][active] - 2 * floor[active]
            go = boxes[active, leaf] <= ratio * np.maximum(reach, 0)
            active, leaf = active[go], leaf[go]
            if not len(active):
                break
            for number in np.unique(leaf):
                who, members = active[leaf == number], tree.leaves[number]
                scores = q_vectors[part][who] @ vectors[members].T
                scores[q_ids[part][who][:, None] == ids[members][None, :]] = -np.inf
                good = (scores >= (floor[who] - slack[part][who])[:, None]) & (scores > -np.inf)
                if good.any():
                    a, b = np.nonzero(good)
                    hits.append((who[a], members[b], scores[a, b]))
                    best[who] = -np.sort(-np.concatenate([best[who], np.where(good, scores, -np.inf)], axis=1), axis=1)[:, :k]
                    floor[who] = np.maximum(floor[who], best[who, k - 1])
        if hits:
            a, b, scores = (np.concatenate(x) for x in zip(*hits))
            near = scores >= floor[a] - slack[part][a]
            a, b = a[near], b[near]
            real = exact(q_vectors[part][a], vectors[b])
            order = np.lexsort((ids[b], -real, a))
            a, b, real = a[order], b[order], real[order]
            first = np.arange(len(a)) - np.searchsorted(a, a) < k
            out.append((q_ids[part][a[first]], ids[b[first]], real[first]))
    if not out:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    return tuple(np.concatenate(x) for x in zip(*out))


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.asarray(flat.flatten(), dtype=np.float64).reshape(len(flat), -1)


def usable(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``(id, v)`` in double precision without vectors that are null, zero, or hold null or non-finite components."""
    v = F.col(vector).cast("array<double>")
    rows = vectors.select(F.col(key).cast("long").alias("id"), v.alias("v")).where("id is not null and v is not null")
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return rows.where(~bad & F.exists("v", lambda x: x != 0))


def _answer(block, k: int, largest: float, confidence: float, seed: int):
    def answer(group: pa.Table) -> pa.Table:
        found = shard_answers(np.asarray(group.column("id")), _matrix(group.column("v")), block.value, k, largest, confidence, seed)
        return pa.table(dict(zip(("query_id", "vec_id", "score"), found)))

    return answer


def nearest(vectors: DataFrame, k: int = 20, every: int = 20, key: str = "vec_id", vector: str = "embedding", confidence: float = CONFIDENCE,
            seed: int = 29) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the ``k`` nearest found of each query, a row whose id is divisible by ``every``.

    Candidates are all rows but those with the query's own id; ties go to the smaller id. Unusable vectors (see
    :func:`usable`) and vectors of another length than most take no part; rows without id neither. Rows that repeat
    an id and vector are one. Fewer candidates than ``k`` give shorter answers; an empty table gives none.
    """
    spark = vectors.sparkSession
    rows = usable(vectors, key, vector)
    length = rows.groupBy(F.size("v").alias("_n")).agg(F.count(F.lit(1)).alias("_c")).orderBy(F.desc("_c"), F.desc("_n")).limit(1).collect()
    width = length[0]["_n"] if length else 0
    rows = durable(rows.where(F.size("v") == width).dropDuplicates())
    n = row_count(rows)
    largest = (rows.agg(F.max(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x))).first()[0] or 0.0) ** 0.5

    # A first bound: the k-th best of a bounded sample of rows. Never above the true k-th best.
    share = min(1.0, SAMPLE / max(n, 1))
    sample = rows.where(F.pmod(F.xxhash64("id"), F.lit(1 << 30)) < int(share * (1 << 30))).toPandas().sort_values("id")
    s_ids, s_vectors = sample["id"].to_numpy(np.int64), np.array(sample["v"].tolist(), float).reshape(len(sample), width)
    asked = rows.where(F.pmod("id", F.lit(every)) == 0)
    blocks = max(1, -(-row_count(asked) // BLOCK))
    shards = max(1, -(-n // SHARD))
    dealt = durable(rows.withColumn("_shard", F.pmod(F.xxhash64("id", F.lit(3)), F.lit(shards))))
    merged = None
    for b in range(blocks):
        table = asked.where(F.pmod(F.xxhash64("id", F.lit(4)), F.lit(blocks)) == b).toPandas().sort_values("id")
        q_ids, q_vectors = table["id"].to_numpy(np.int64), np.array(table["v"].tolist(), float).reshape(len(table), width)
        scores = q_vectors @ s_vectors.T if len(q_ids) else np.zeros((0, len(s_ids)))
        scores[q_ids[:, None] == s_ids[None, :]] = -np.inf
        bound = np.sort(scores, axis=1)[:, -k] if scores.shape[1] >= k else np.full(len(q_ids), -np.inf)
        block = spark.sparkContext.broadcast((q_ids, q_vectors, bound - 1e-9 * (1 + np.abs(np.where(np.isfinite(bound), bound, 0)))))

        answers = dealt.groupBy("_shard").applyInArrow(_answer(block, k, largest, confidence, seed), "query_id long, vec_id long, score double")
        merged = answers if merged is None else merged.union(answers)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc("vec_id"))
    ranked = merged.dropDuplicates(["query_id", "vec_id", "score"]).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
