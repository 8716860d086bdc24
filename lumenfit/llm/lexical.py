"""Ranked lexical search with Block-Max MaxScore over document-sharded inverted lists.

``build`` turns each shard of texts into inverted lists: sorted word pointers give the postings of every term, cut
into blocks of ``BLOCK`` and packed. A block's head says which documents it spans and holds the frontier of its
(frequency, length) pairs, those that no other posting beats in both; whatever the corpus statistics turn out to be, the
block's best score is that of one of them, so an index serves any union of shards.

``search`` deals the lists of the asked terms to (shard, block of items). There, documents are walked in windows. The
bounds of whole lists split an item's lists: those whose bounds sum to no more than the score to beat cannot lift a
document alone (non-essential), so candidates come from the essential lists. A candidate is then held against the maxima of
the blocks that could hold it in the other lists, best list first, and only blocks that still have candidates are
unpacked. Each shard returns its best documents, and Spark merges those.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from ..session import durable, shared_folder
from .common import ALNUM, row_count, small
from .pointers import Pointers, shards

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
# Postings of a block, documents of a window, and items that a task answers at once.
BLOCK = 64
WINDOW = 1024
ITEMS = 256
HEAD = np.dtype([("first", "<u4"), ("last", "<u4"), ("at", "<u4"), ("front", "<u4"), ("count", "u1"), ("gap", "u1"), ("freq", "u1"), ("pairs", "u1")])
PAIR = np.dtype([("tf", "<u4"), ("n", "<u4")])


def terms_of(text: Column) -> Column:
    """The terms of a text with repeats; null has none."""
    low = F.translate(F.coalesce(text, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.regexp_extract_all(low, F.lit(TERM), F.lit(0))


def _width(largest: np.ndarray) -> np.ndarray:
    """Bytes that hold a number: 1, 2 or 4."""
    return np.where(largest < 1 << 8, 1, np.where(largest < 1 << 16, 2, 4))


def _binary(data: np.ndarray, edges: np.ndarray) -> pa.Array:
    return pa.BinaryArray.from_buffers(pa.binary(), len(edges) - 1, [None, pa.py_buffer(edges.astype(np.int32)), pa.py_buffer(data)])


def packed(term: np.ndarray, doc: np.ndarray, tf: np.ndarray, n: np.ndarray) -> tuple[pa.Array, pa.Array, pa.Array]:
    """Heads, frontiers and bodies of all lists; postings come in order of (term, document), terms count from 0."""
    size = len(term)
    start = np.flatnonzero(np.concatenate([[True], term[1:] != term[:-1]])[:size])
    place = np.arange(size) - start[term]
    edge = np.flatnonzero(place % BLOCK == 0)
    block = np.cumsum(place % BLOCK == 0) - 1
    count = np.diff(np.append(edge, size))
    gap = np.where(place % BLOCK == 0, 0, doc - np.concatenate([[0], doc[:-1]]))
    wide_gap, wide_tf = _width(np.maximum.reduceat(gap, edge)), _width(np.maximum.reduceat(tf, edge))
    at = np.concatenate([[0], np.cumsum(count * (wide_gap + wide_tf))])
    body = np.zeros(at[-1], np.uint8)
    within = np.arange(size) - edge[block]
    for values, width, base in ((gap, wide_gap, at[:-1]), (tf, wide_tf, at[:-1] + count * wide_gap)):
        to, wide = base[block] + within * width[block], width[block]
        for k in range(4):
            some = wide > k
            body[to[some] + k] = values[some] >> 8 * k & 255
    # The frontier: by falling frequency, those shorter than all before them in the block.
    order = np.lexsort((n, -tf, block))
    height = n[order] - block[order] * (int(n.max()) + 1)
    keep = np.concatenate([[True], height[1:] < np.minimum.accumulate(height)[:-1]])
    pairs = np.empty(int(keep.sum()), PAIR)
    pairs["tf"], pairs["n"] = tf[order][keep], n[order][keep]
    per_block = np.bincount(block[order][keep], minlength=len(edge))
    front = np.concatenate([[0], np.cumsum(per_block)])
    lists = np.append(np.searchsorted(edge, start), len(edge))
    owner = np.repeat(np.arange(len(start)), np.diff(lists))
    heads = np.empty(len(edge), HEAD)
    heads["first"], heads["last"], heads["count"], heads["gap"], heads["freq"], heads["pairs"] = doc[edge], doc[edge + count - 1], count, wide_gap, wide_tf, per_block
    heads["at"], heads["front"] = at[:-1] - at[lists[owner]], front[:-1] - front[lists[owner]]
    return (_binary(heads.view(np.uint8), lists * HEAD.itemsize), _binary(pairs.view(np.uint8), front[lists] * PAIR.itemsize), _binary(body, at[lists]))


@dataclass(frozen=True)
class Index:
    """A folder with one row per (shard, term), and one per shard without term: its documents and their lengths."""

    folder: str
    documents: int
    terms: int

    def rows(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(self.folder)

    def lists(self, spark: SparkSession) -> DataFrame:
        return self.rows(spark).where("term is not null")


def build(docs: DataFrame, key: str = "doc_id", text: str = "text", folder: str | None = None) -> Index:
    """Index the whole texts of all rows. Each row is a document; null and empty texts have no terms and are in no list.

    Keys may be null or repeat: a row then stands for itself. Nothing is shuffled; a shard is what one task read.
    """
    spark = docs.sparkSession
    folder = folder or f"{shared_folder(spark).rstrip('/')}/lexical-{uuid.uuid4().hex}"
    docs = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text"))

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, part in enumerate(shards(batches, "_text")):
            # Places follow the keys, so that equal scores keep the smaller key.
            part = part.take(pc.sort_indices(part, sort_keys=[("_key", "ascending")], null_placement="at_end"))
            pointers = Pointers(part.column("_text"), ALNUM)
            lengths = pointers.per_row
            shard = (TaskContext.get().partitionId() << 24) + number
            edge, tf = pointers.runs(pointers.rows)
            word, doc = pointers.word[edge], pointers.rows[edge]
            columns = [pa.array(np.full(1, shard)), pa.nulls(1, pa.string()), pa.array([int((lengths > 0).sum())], pa.int64()), pa.array([int(lengths.sum())], pa.int64()),
                       *(pa.nulls(1, pa.binary()) for _ in range(3)), pa.ListArray.from_arrays(pa.array([0, len(part)], pa.int32()), part.column("_key")), pa.array([lengths.astype("<i8").tobytes()])]
            yield pa.RecordBatch.from_arrays(columns, names)
            if len(word):
                heads, fronts, bodies = packed(word, doc, tf, lengths[doc])
                terms = len(heads)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(terms, shard)), pointers.words(), pa.array(np.bincount(word), pa.int64()), pa.array(np.add.reduceat(tf, np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))), pa.int64()),
                     heads, fronts, bodies, pa.nulls(terms, columns[-2].type), pa.nulls(terms, pa.binary())], names)

    schema = T.StructType([T.StructField(c, t) for c, t in (
        ("shard", T.LongType()), ("term", T.StringType()), ("docs", T.LongType()), ("words", T.LongType()), ("heads", T.BinaryType()), ("fronts", T.BinaryType()), ("bodies", T.BinaryType()),
        ("keys", T.ArrayType(docs.schema["_key"].dataType)), ("lengths", T.BinaryType()))])
    names = schema.names
    docs.mapInArrow(index, schema).write.parquet(folder)
    documents, words = spark.read.parquet(folder).where("term is null").agg(F.sum("docs"), F.sum("words")).first()
    return Index(folder, documents or 0, words or 0)


class Scoring:
    """Scores in whole numbers; ``n`` documents with terms hold ``total`` terms. They rise with the frequency and fall with the length."""

    def __init__(self, n: int, total: int):
        self.n, self.total = n, total

    def term(self, tf: np.ndarray, length: np.ndarray) -> np.ndarray:
        if length.size and 90 * self.n * int(length.max()) >= 1 << 63:
            length = length.astype(object)
        m = (10 + 90 * length * self.n // self.total).astype(np.int64)
        return 1_000_000_000 * tf // (1000 * tf + 8 * m)

    def weight(self, df: int) -> int:
        return math.floor(1000 * math.log((2 * self.n + 2) / (2 * df + 1)))


class List:
    """One term's postings in a shard: bounds at hand, blocks unpacked on demand and kept for the next item."""

    def __init__(self, heads: bytes, fronts: bytes, body: bytes, weight: int, scoring: Scoring, lengths: np.ndarray):
        self.heads, self.body, self.weight, self.scoring, self.lengths = np.frombuffer(heads, HEAD), body, weight, scoring, lengths
        pairs = np.frombuffer(fronts, PAIR)
        best = scoring.term(pairs["tf"].astype(np.int64), pairs["n"].astype(np.int64))
        self.bounds = weight * np.maximum.reduceat(best, self.heads["front"].astype(np.int64))
        self.first, self.last = self.heads["first"].astype(np.int64), self.heads["last"].astype(np.int64)
        self.bound = int(self.bounds.max())
        self.unpacked: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def block(self, b: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents of a block, and what the term adds to each."""
        if b not in self.unpacked:
            _, _, at, _, count, gap, freq, _ = self.heads[b].tolist()
            doc = self.first[b] + np.cumsum(np.frombuffer(self.body, f"<u{gap}", count, at).astype(np.int64))
            tf = np.frombuffer(self.body, f"<u{freq}", count, at + gap * count).astype(np.int64)
            self.unpacked[b] = doc, self.weight * self.scoring.term(tf, self.lengths[doc])
        return self.unpacked[b]

    def add(self, blocks: np.ndarray, total: np.ndarray, low: int) -> None:
        """Add the postings of some blocks to the window that starts at ``low``."""
        for b in blocks.tolist():
            doc, score = self.block(b)
            if doc[0] < low or doc[-1] >= low + len(total):
                inside = (doc >= low) & (doc < low + len(total))
                doc, score = doc[inside], score[inside]
            total[doc - low] += score


def best_of(lists: list[List], documents: int, k: int) -> list[tuple[int, int]]:
    """The ``k`` best ``(score, place)`` of a shard, best first, equal scores by place."""
    lists = sorted(lists, key=lambda x: x.bound)
    below = np.cumsum([x.bound for x in lists])
    heap: list[tuple[int, int]] = []
    threshold = 0
    for low in range(0, documents, WINDOW):
        high = min(low + WINDOW, documents)
        # The first lists together stay at or under the score to beat: a document they alone hold cannot enter.
        split = int(np.searchsorted(below, threshold, "right"))
        if split == len(lists):
            break
        total = np.zeros(high - low, np.int64)
        for x in lists[split:]:
            x.add(np.arange(np.searchsorted(x.last, low), np.searchsorted(x.first, high)), total, low)
        alive = np.flatnonzero(total)
        for i in range(split - 1, -1, -1):
            alive = alive[total[alive] + below[i] > threshold]
            if not len(alive):
                break
            x, rest = lists[i], int(below[i - 1]) if i else 0
            b = np.searchsorted(x.last, alive + low)
            inside = b < len(x.last)
            inside[inside] = x.first[b[inside]] <= alive[inside] + low
            limit = np.zeros(len(alive), np.int64)
            limit[inside] = x.bounds[b[inside]]
            hopeful = total[alive] + limit + rest > threshold
            blocks = np.unique(b[hopeful & inside])
            alive = alive[hopeful]
            if len(blocks):
                x.add(blocks, total, low)
        alive = alive[total[alive] > threshold]
        heap = sorted(heap + [(-int(total[a]), low + int(a)) for a in alive.tolist()])[:k]
        if len(heap) == k:
            threshold = -heap[-1][0]
    return [(-s, place) for s, place in heap]


def search(index: Index, queries: DataFrame, item: str = "item_id", text: str = "text", key: str = "doc_id", k: int = 10, items: int = ITEMS) -> DataFrame:
    """``(item, rank, key, score)``: each item's ``k`` documents of the highest scores above 0, equal scores by ascending key.

    Rows that share an item id are one item with the terms of all of them; a null id is an id. Items without terms, or
    whose terms no document holds, have no row. Null keys rank last among equal scores. Lists are cut to the asked
    terms before they are shuffled; items come in blocks of about ``items``, and a list goes to the blocks that ask for it.
    """
    spark = queries.sparkSession
    asked = queries.select(F.col(item).alias("_item"), F.explode(terms_of(F.col(text))).alias("_term")).distinct()
    asked = durable(asked)
    blocks = max(1, -(-row_count(asked.select("_item").distinct()) // items))
    block = F.pmod(F.xxhash64(F.lit(5), F.col("_item").isNull(), F.col("_item")), F.lit(blocks))
    wanted = durable(asked.groupBy(block.alias("_block"), "_term").agg(F.collect_list(F.struct(F.col("_item").alias("item"))).alias("_items")))
    rows = index.rows(spark)
    found = index.lists(spark).join(small(wanted.select("_term").distinct()), F.col("term") == F.col("_term"))
    df = durable(found.groupBy("_term").agg(F.sum("docs").alias("_df")))
    wanted = durable(wanted.join(df, "_term"))
    lists = index.lists(spark).join(small(wanted), F.col("term") == F.col("_term"))
    lists = lists.select("shard", "_block", "heads", "fronts", "bodies", "keys", "lengths", "_df", "_items")
    # The documents of a shard go to each block of items.
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long")))
    owners = rows.where("term is null").select("shard", every.alias("_block"), "heads", "fronts", "bodies", "keys", "lengths", F.lit(0).cast("long").alias("_df"), F.array().cast(lists.schema["_items"].dataType).alias("_items"))
    scoring = Scoring(index.documents, index.terms)
    names = [item, key, "score"]

    def answer(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        held = group.column("lengths").is_valid().to_numpy()
        keys = group.column("keys").filter(pa.array(held)).combine_chunks().flatten()
        lengths = np.frombuffer(group.column("lengths").filter(pa.array(held))[0].as_py(), "<i8")
        lists = group.filter(pa.array(~held))
        made = [List(*row, scoring.weight(n), scoring, lengths) for *row, n in zip(*(lists.column(c).to_pylist() for c in ("heads", "fronts", "bodies", "_df")))]
        asks = lists.column("_items").combine_chunks()
        owner = np.repeat(np.arange(len(lists)), np.asarray(pc.list_value_length(asks)))
        ids = asks.flatten().field("item").dictionary_encode("encode") if len(owner) else None
        out: tuple[list, list, list] = ([], [], [])
        if ids is not None:
            code = np.asarray(ids.indices)
            order = np.argsort(code, kind="stable")
            for q, terms in zip(np.unique(code), np.split(owner[order], np.flatnonzero(np.diff(code[order])) + 1)):
                for score, place in best_of([made[t] for t in terms], len(lengths), k):
                    for c, v in zip(out, (int(q), place, score)):
                        c.append(v)
        ask = ids.dictionary if ids is not None else pa.nulls(0, asks.type.value_type.field("item").type)
        return pa.table([ask.take(pa.array(out[0], pa.int64())), keys.take(pa.array(out[1], pa.int64())), pa.array(out[2], pa.int64())], names=["_item", "_key", "_score"])

    schema = T.StructType([T.StructField("_item", queries.schema[item].dataType), T.StructField("_key", rows.schema["keys"].dataType.elementType), T.StructField("_score", T.LongType())])
    best = lists.unionByName(owners).groupBy("shard", "_block").applyInArrow(answer, schema)
    order = Window.partitionBy("_item").orderBy(F.desc("_score"), F.col("_key").asc_nulls_last())
    ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select(F.col("_item").alias(names[0]), "rank", F.col("_key").alias(names[1]), F.col("_score").alias("score"))
