"""Benchmark decontamination with suffix arrays over the training text.

Each task turns its documents into a shard: the word sequence of all of them, words outside the benchmark's vocabulary
being a common stopper. The shard's suffix array holds the suffixes that can carry a match, sorted by as
many words as a window has. Every test suffix is binary-searched in the shard; the rows between its bounds are its
occurrences. Runs of occurrences on one diagonal are the longest verbatim matches.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from .common import ALNUM, list_array, slices, texts, words

WINDOW = 10
# A block of the benchmark holds at most so many bytes of text; larger benchmarks are searched block by block.
BLOCK_BYTES = 32 << 20


def _packed(ids: np.ndarray, at: np.ndarray, depth: int) -> np.ndarray:
    """Keys of the suffixes at ``at``: big-endian words, so that byte order is the order of word sequences."""
    padded = np.concatenate([ids, np.zeros(depth, np.uint32)])
    rows = padded[at[:, None] + np.arange(depth)].astype(">u4")
    return np.ascontiguousarray(rows).view(f"S{4 * depth}").ravel() if len(at) else np.zeros(0, f"S{4 * depth}")


class Block:
    """The test suffixes of some benchmark items: windows by length, each with the items it stands in."""

    def __init__(self, rows: list, window: int = WINDOW):
        items = [r[0] or "" for r in rows]
        arrow = pa.array([r[1] or "" for r in rows], pa.large_string())
        data, offsets = texts(arrow)
        _, _, of, hashes = words(data, offsets, ALNUM)
        self.vocabulary = np.unique(hashes)
        ids = (np.searchsorted(self.vocabulary, hashes) + 1).astype(np.uint32)
        self.items = items
        edges = np.searchsorted(of, np.arange(len(items) + 1))
        starts: dict[int, list] = {}
        owners: dict[int, list] = {}
        for i in range(len(items)):
            n = int(edges[i + 1] - edges[i])
            if n:
                length = min(n, window)
                at = np.arange(edges[i], edges[i + 1] - length + 1)
                starts.setdefault(length, []).append(at)
                owners.setdefault(length, []).append(np.full(len(at), i))
        self.windows = {}
        for length in starts:
            at, owner = np.concatenate(starts[length]), np.concatenate(owners[length])
            keys = ids[at[:, None] + np.arange(length)]
            distinct, inverse = np.unique(keys, axis=0, return_inverse=True)
            order = np.argsort(inverse.ravel(), kind="stable")
            bounds = np.searchsorted(inverse.ravel()[order], np.arange(len(distinct) + 1))
            pairs = np.unique(distinct[:, :2], axis=0).astype(np.uint64)
            pair_keys = pairs[:, 0] << np.uint64(32) | (pairs[:, 1] if length > 1 else np.uint64(0))
            self.windows[length] = (distinct, owner[order], bounds, np.unique(pair_keys))

    def word_ids(self, hashes: np.ndarray) -> np.ndarray:
        if not len(self.vocabulary):
            return np.zeros(len(hashes), np.uint32)
        at = np.minimum(np.searchsorted(self.vocabulary, hashes), len(self.vocabulary) - 1)
        return np.where(self.vocabulary[at] == hashes, at + 1, 0).astype(np.uint32)

    def matches(self, hashes: np.ndarray, rows: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """Per window length: word positions of occurrences, and the items that own each, as (length, positions, item index, position index)."""
        ids = self.word_ids(hashes)
        if not len(ids):
            return
        # How many words of the vocabulary follow within the row, the word itself included.
        stop = np.flatnonzero((ids == 0) | np.concatenate([rows[1:] != rows[:-1], [True]]))
        nearest = stop[np.searchsorted(stop, np.arange(len(ids)))]
        run = nearest - np.arange(len(ids)) + (ids[nearest] != 0)
        following = np.concatenate([ids[1:], [0]]).astype(np.uint64)
        for length, (distinct, owner, bounds, pairs) in self.windows.items():
            at = np.flatnonzero(run >= length)
            pair = ids[at].astype(np.uint64) << np.uint64(32) | (following[at] if length > 1 else np.uint64(0))
            found = np.minimum(np.searchsorted(pairs, pair), len(pairs) - 1)
            at = at[pairs[found] == pair]
            if not len(at):
                continue
            keys = _packed(ids, at, length)
            order = np.argsort(keys, kind="stable")
            suffixes = keys[order]
            tests = _packed(distinct.ravel(), np.arange(len(distinct)) * length, length)
            low, high = np.searchsorted(suffixes, tests, "left"), np.searchsorted(suffixes, tests, "right")
            for w in np.flatnonzero(high > low):
                positions = at[order[low[w]:high[w]]]
                yield length, positions, owner[bounds[w]:bounds[w + 1]], w


def blocks(benchmark: DataFrame, item: str = "item_id", text: str = "text", limit: int = BLOCK_BYTES) -> list:
    """Broadcast blocks of the benchmark: each is read alone and holds about ``limit`` bytes of text."""
    spark = benchmark.sparkSession
    benchmark = benchmark.select(F.col(item).cast("string").alias("item"), F.col(text).alias("text"))
    total = benchmark.agg(F.sum(F.octet_length("text") + 16)).first()[0] or 0
    n = max(1, -(-total // limit))
    part = F.pmod(F.xxhash64("item", "text"), F.lit(n))
    return [spark.sparkContext.broadcast(vars(Block(sorted(map(tuple, benchmark.where(part == k).collect()), key=str)))) for k in range(n)]


def _hits(part: pa.RecordBatch, text: str, parts: list) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[dict]]:
    """Row of each word, hit flag of each word, words per row, and per row the items with their longest match."""
    data, offsets = texts(part.column(text))
    starts, ends, rows, hashes = words(data, offsets, ALNUM)
    mark = np.zeros(len(rows) + 1, np.int64)
    items: list[dict] = [{} for _ in range(part.num_rows)]
    for state in parts:
        block = Block.__new__(Block)
        block.__dict__ = state.value
        for length, positions, owners, _ in block.matches(hashes, rows):
            np.add.at(mark, positions, 1)
            np.add.at(mark, positions + length, -1)
            for row in np.unique(rows[positions]):
                for i in owners:
                    items[row].setdefault(block.items[i], None)
    hit = np.cumsum(mark[:-1]) > 0
    return rows, hit, np.bincount(rows, minlength=part.num_rows), items


def contamination(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text") -> DataFrame:
    """``(key, n_words, n_hit, n_items, items_sha256, contaminated, longest_start, longest_words)`` for each row.

    ``longest_*`` locates the longest run of hit words. Null and empty texts have no words; null or empty items
    match nothing; repeated items and rows are treated alike. An empty benchmark hits nothing.
    """
    parts = blocks(benchmark, item, item_text)
    docs = docs.select(key, text)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text):
                rows, hit, counts, items = _hits(part, text, parts)
                n_hit = np.bincount(rows, hit, minlength=part.num_rows).astype(np.int64)
                digest = [hashlib.sha256(",".join(sorted(x)).encode()).hexdigest() for x in items]
                first = np.concatenate([[0], np.cumsum(counts)])
                longest = np.full((part.num_rows, 2), -1)
                for r in np.flatnonzero(n_hit):
                    edge = np.flatnonzero(np.diff(np.concatenate([[0], hit[first[r]:first[r + 1]].astype(np.int8), [0]])))
                    best = int(np.argmax(edge[1::2] - edge[::2]))
                    longest[r] = edge[2 * best], edge[2 * best + 1] - edge[2 * best]
                yield pa.RecordBatch.from_arrays([
                    part.column(key), pa.array(counts, pa.int64()), pa.array(n_hit), pa.array([len(x) for x in items], pa.int64()), pa.array(digest, pa.string()),
                    pa.array(n_hit > 0), pa.array(longest[:, 0], pa.int64()), pa.array(np.maximum(longest[:, 1], 0), pa.int64())], schema.names)

    schema = T.StructType([docs.schema[key]] + [T.StructField(n, t) for n, t in (
        ("n_words", T.LongType()), ("n_hit", T.LongType()), ("n_items", T.LongType()), ("items_sha256", T.StringType()), ("contaminated", T.BooleanType()),
        ("longest_start", T.LongType()), ("longest_words", T.LongType()))])
    return docs.mapInArrow(search, schema)


def matches(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text") -> DataFrame:
    """``(key, items, starts, ends)``: per contaminated row the items, and the word ranges of its maximal hit runs."""
    parts = blocks(benchmark, item, item_text)
    docs = docs.select(key, text)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text):
                rows, hit, counts, items = _hits(part, text, parts)
                first = np.concatenate([[0], np.cumsum(counts)])
                kept = [r for r in range(part.num_rows) if items[r]]
                edges = [np.flatnonzero(np.diff(np.concatenate([[0], hit[first[r]:first[r + 1]].astype(np.int8), [0]]))) for r in kept]
                runs = np.array([len(e) // 2 for e in edges], int)
                flat = np.concatenate(edges) if edges else np.zeros(0, int)
                yield pa.RecordBatch.from_arrays([
                    part.column(key).take(pa.array(kept, pa.int64())), pa.array([sorted(items[r]) for r in kept], pa.list_(pa.string())),
                    list_array(flat[::2], runs, pa.int64()), list_array(flat[1::2], runs, pa.int64())], [key, "items", "starts", "ends"])

    longs = T.ArrayType(T.LongType())
    return docs.mapInArrow(search, T.StructType([docs.schema[key], T.StructField("items", T.ArrayType(T.StringType())), T.StructField("starts", longs), T.StructField("ends", longs)]))


def clean(docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id", item_text: str = "text") -> DataFrame:
    """The rows of ``docs`` that hold no benchmark window, with all their columns; no shuffle."""
    parts = blocks(benchmark, item, item_text)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text):
                rows, hit, _, _ = _hits(part, text, parts)
                yield part.filter(pa.array(np.bincount(rows, hit, minlength=part.num_rows) == 0))

    return docs.mapInArrow(search, docs.schema)
