"""Token-ID output: raw id shards with a minimal perfect hash index over the document keys.

A store is a folder. ``shard-NNNNNN.ids`` holds the ids of consecutive documents back to back, little-endian, 2 bytes
each if the vocabulary allows it, else 4; then the offsets of its records (in ids, 8 bytes each, one more than there
are records) and a trailer ``(records, width, magic)``. Parquet tables beside the shards: ``shards`` (ids before each
shard) and ``index``, one row per hash bucket: a minimal perfect hash of the bucket's keys and, at the place it gives
a key, a fingerprint, the first shard and record, how many records the key has, its last shard and how many it has there.
A lookup hashes the key, reads one index row, checks the fingerprint and reads two offsets and the ids: constant time,
whatever the size of the store. Records of one key stand in the order of their texts' hashes, over as many shards as they need.

Shards are written under a task-attempt name and renamed, so a retried task replaces its own shard.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from ..session import shared_folder
from .common import mixed, slices, worker_state

END = 2
SHARD_BYTES = 24 << 20
BUCKET_KEYS = 8192
# Words of one generation of the cache; the generation before is kept beside it.
CACHE_WORDS = 500_000
MAGIC = 0x31535F534449
# What the index holds of a key: its first shard and record, its records, its last shard and its records there.
PLACES = {"shard": "<i4", "record": "<i8", "records": "<i8", "last": "<i4", "tail": "<i8"}

# ByteLevel's printable stand-ins for bytes: printable Latin-1 stays, the others follow from 256 on.
_plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
_BYTES = {b: b for b in _plain} | {b: 256 + i for i, b in enumerate(sorted(set(range(256)) - set(_plain)))}


class Encoder:
    """Whole texts to ids with a cache of words.

    The tokenizer splits at white space before anything else, so a text's ids are those of its words in a row. A word
    of letters goes straight to the model; everything else to the full tokenizer.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.kind = np.dtype("<u2") if self.tokenizer.get_vocab_size() <= 1 << 16 else np.dtype("<u4")
        # Added tokens are matched in the raw text, before it is lower-cased.
        self.added = [(t.content, t.content.lower()) for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.cache: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    @classmethod
    def of(cls, path: str) -> "Encoder":
        made = worker_state().setdefault("encoders", {})
        if path not in made:
            made[path] = cls(path)
        return made[path]

    def _raw(self, ids) -> bytes:
        return np.array(ids, self.kind).tobytes()

    def _full(self, text: str) -> bytes:
        return self._raw(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def _letters(self, word: str) -> bytes:
        return self._raw([t.id for t in self.tokenizer.model.tokenize(word.encode().decode("latin-1").translate(_BYTES))])

    def _known(self, word: str, make) -> bytes:
        ids = self.cache.get(word)
        if ids is None:
            ids = self.cache[word] = self.older.get(word) or make(word)
        return ids

    def _word(self, word: str, lowered: bool) -> bytes:
        if not lowered:
            return self._full(word)
        core = word.rstrip(".,;:!?|%$&*#()")
        if not core.isalpha():
            return self._full(word)
        if len(core) == len(word):
            return self._letters(word)
        return self._known(core, self._letters) + self._known(word[len(core):], self._full)

    def encode(self, text: str) -> bytes:
        if any(c in text for c in "\x1c\x1d\x1e\x1f"):
            return self._full(text)  # Python's split would cut there
        try:
            text.encode("latin-1")
            raw, lowered, text = text, True, text.lower()
            if any(low in text and text.count(low) != raw.count(token) for token, low in self.added):
                return self._full(raw)  # some stand in another case, and are plain text there
        except UnicodeEncodeError:
            lowered = False  # case mappings beyond Latin-1 can depend on context
        words = text.split()
        try:
            return b"".join(map(self.cache.get, words))
        except TypeError:
            if len(self.cache) > CACHE_WORDS:
                self.cache, self.older = {}, self.cache
            for word in words:
                if word not in self.cache:
                    self._known(word, lambda w: self._word(w, lowered))
            return b"".join(map(self.cache.get, words))


def key_hashes(key: str) -> list[Column]:
    """Two 64-bit hashes of a key of any type; null is a key."""
    return [F.xxhash64(F.lit(17), F.col(key).isNull(), F.col(key)).alias("_h1"), F.xxhash64(F.lit(91), F.col(key), F.col(key).isNull()).alias("_h2")]


def bucket_of(buckets: int) -> Column:
    return F.pmod(F.col("_h1"), F.lit(buckets)).alias("_bucket")


def _slots(h1: np.ndarray, h2: np.ndarray, level: int, size: int) -> np.ndarray:
    return (mixed(h1.view(np.uint64) * np.uint64(2 * level + 1) ^ mixed(h2.view(np.uint64) + np.uint64(level))) % np.uint64(size)).astype(np.int64)


def perfect_hash(h1: np.ndarray, h2: np.ndarray) -> list[np.ndarray]:
    """Levels of bit arrays: a key's level is the first in which it is alone on its slot; its number is the rank of that bit."""
    levels = []
    while len(h1):
        size = max(2 * len(h1), 8)
        slot = _slots(h1, h2, len(levels), size)
        alone = np.bincount(slot, minlength=size) == 1
        levels.append(alone)
        stay = ~alone[slot]
        h1, h2 = h1[stay], h2[stay]
        if len(levels) > 200:
            raise ValueError("two keys have the same hashes")
    return levels


def ranks(levels: list[np.ndarray], h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
    """Number of each key, -1 where no level has it."""
    out = np.full(len(h1), -1, np.int64)
    left, before = np.arange(len(h1)), 0
    for depth, bits in enumerate(levels):
        slot = _slots(h1[left], h2[left], depth, len(bits))
        hit = bits[slot]
        out[left[hit]] = before + (np.cumsum(bits) - 1)[slot[hit]]
        before += int(bits.sum())
        left = left[~hit]
    return out


@dataclass(frozen=True)
class Store:
    folder: str
    buckets: int
    width: int

    def shards(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(f"{self.folder}/shards")

    def index(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(f"{self.folder}/index")


def write(docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text", end: int = END, folder: str | None = None) -> Store:
    """Encode and write all rows in ascending key order (null first); returns the store.

    Null and empty texts are records of the end id alone. Repeated keys are consecutive records under one index
    entry, in the order of their texts' hashes, whatever order the rows come in; a key with many rows, or many copies
    of one row, is dealt to several shards. An empty table makes an empty store.
    """
    spark = docs.sparkSession
    folder = folder or f"{shared_folder(spark).rstrip('/')}/token-ids-{uuid.uuid4().hex}"
    docs = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text"))
    by_key = docs.groupBy("_key").agg(F.sum(F.octet_length("_text")).alias("_s"), F.count(F.lit(1)).alias("_n"))
    size, rows, most = by_key.agg(F.sum("_s"), F.sum("_n"), F.max(F.coalesce("_s", F.lit(0)) + 16 * F.col("_n"))).first()
    rows = rows or 0
    parts = max(1, -(-((size or 0) + 16 * rows) // SHARD_BYTES))
    # Equal rows may stand in any order: their number in the input only deals them to shards.
    docs = docs.withColumns({"_th": F.xxhash64(F.coalesce("_text", F.lit(""))), "_salt": F.monotonically_increasing_id() % 4096})
    # A key that fits a shard is not split, and where all do the ranges are drawn without reading texts.
    ranges = ["_key", "_th", "_salt"] if (most or 0) > SHARD_BYTES else ["_key"]
    ordered = docs.repartitionByRange(parts, *ranges).sortWithinPartitions("_key", "_th", "_text").select("_key", *key_hashes("_key"), "_text")

    def shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, context = Encoder.of(tokenizer), TaskContext.get()
        number, store = context.partitionId(), None
        offsets, last = [0], np.array([end], encoder.kind).tobytes()
        width = encoder.kind.itemsize
        for batch in batches:
            for part in slices(batch, "_text"):
                if store is None:
                    store, path = fs.FileSystem.from_uri(folder)
                    name = f"{path}/shard-{number:06d}.ids"
                    draft = f"{path}/_draft-{number:06d}-{context.taskAttemptId()}"
                    store.create_dir(path, recursive=True)
                    out = store.open_output_stream(draft)
                sizes = []
                for value in part.column("_text").to_pylist():
                    ids = encoder.encode(value or "") + last
                    out.write(ids)
                    sizes.append(len(ids) // width)
                records = np.arange(len(offsets) - 1, len(offsets) - 1 + len(sizes))
                offsets.extend((offsets[-1] + np.cumsum(sizes)).tolist())
                yield pa.RecordBatch.from_arrays(
                    [part.column("_key"), part.column("_h1"), part.column("_h2"), pa.array(np.full(len(sizes), number), pa.int64()), pa.array(records), pa.array(sizes, pa.int64())],
                    ["_key", "_h1", "_h2", "shard", "record", "ids"])
        if store is not None:
            out.write(np.array(offsets, "<i8").tobytes())
            out.write(np.array([len(offsets) - 1, width, MAGIC], "<i8").tobytes())
            out.close()
            if store.get_file_info(name).type != fs.FileType.NotFound:
                store.delete_file(name)  # of an attempt that was lost after its rename
            store.move(draft, name)

    long = T.LongType()
    schema = T.StructType([ordered.schema["_key"], *(T.StructField(c, long) for c in ("_h1", "_h2", "shard", "record", "ids"))])
    entries_at = f"{folder}/entries"
    ordered.mapInArrow(shard, schema).write.parquet(entries_at)
    entries = spark.read.parquet(entries_at)
    per_shard = entries.groupBy("shard").agg(F.sum("ids").alias("ids"), F.count(F.lit(1)).alias("records"))
    before = F.coalesce(F.sum("ids").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    per_shard.withColumn("ids_before", before).write.parquet(f"{folder}/shards")

    place = F.struct("shard", "record")
    by_shard = entries.groupBy("_key", "_h1", "_h2", "shard").agg(F.min("record").alias("record"), F.count(F.lit(1)).alias("n"))
    keys = by_shard.groupBy("_key", "_h1", "_h2").agg(F.min(place).alias("_first"), F.max(F.struct("shard", "n")).alias("_last"), F.sum("n").alias("records"))
    keys = keys.select("_key", "_h1", "_h2", "_first.shard", "_first.record", "records", F.col("_last.shard").alias("last"), F.col("_last.n").alias("tail"))
    buckets = max(1, -(-rows // BUCKET_KEYS))

    def build(group: pa.Table) -> pa.Table:
        h1, h2 = (np.asarray(group.column(c)).astype(np.int64) for c in ("_h1", "_h2"))
        levels = perfect_hash(h1, h2)
        order = np.argsort(ranks(levels, h1, h2))
        pack = lambda x, kind: x[order].astype(kind).tobytes()
        return pa.table({
            "bucket": pa.array([group.column("_bucket")[0].as_py()], pa.int64()), "sizes": pa.array([[len(x) for x in levels]], pa.list_(pa.int64())),
            "bits": pa.array([[np.packbits(x).tobytes() for x in levels]], pa.list_(pa.binary())), "fingerprints": pa.array([pack(h2.view(np.uint64) >> np.uint64(32), "<u4")], pa.binary()),
            **{name: pa.array([pack(np.asarray(group.column(name)), kind)], pa.binary()) for name, kind in PLACES.items()}})

    schema = "bucket long, sizes array<long>, bits array<binary>, fingerprints binary, " + ", ".join(f"{name} binary" for name in PLACES)
    keys.withColumn("_bucket", bucket_of(buckets)).drop("_key").groupBy("_bucket").applyInArrow(build, schema).write.parquet(f"{folder}/index")
    return Store(folder, buckets, Encoder.of(tokenizer).kind.itemsize)


def lookup(keys: DataFrame, store: Store, key: str = "doc_id") -> DataFrame:
    """``(key, shard, record, records, last, tail)`` of the distinct keys that the store holds; others have no row."""
    index = store.index(keys.sparkSession)
    asked = keys.select(F.col(key).alias("_key")).distinct().select("_key", *key_hashes("_key")).withColumn("_bucket", bucket_of(store.buckets))

    def find(asked: pa.Table, index: pa.Table) -> pa.Table:
        if not asked.num_rows or not index.num_rows:
            return pa.table({c: pa.array([], t) for c, t in zip(["_key", *PLACES], [asked.schema.field("_key").type] + [pa.int64()] * len(PLACES))})
        row = index.to_pylist()[0]
        levels = [np.unpackbits(np.frombuffer(b, np.uint8))[:n].astype(bool) for b, n in zip(row["bits"], row["sizes"])]
        h1, h2 = (np.asarray(asked.column(c)) for c in ("_h1", "_h2"))
        place = ranks(levels, h1, h2)
        prints = np.frombuffer(row["fingerprints"], "<u4")
        ok = np.flatnonzero((place >= 0) & (prints[place] == (h2.view(np.uint64) >> np.uint64(32))))
        found = {c: np.frombuffer(row[c], k)[place[ok]].astype(np.int64) for c, k in PLACES.items()}
        return pa.table({"_key": asked.column("_key").take(pa.array(ok)), **found})

    long = T.LongType()
    schema = T.StructType([asked.schema["_key"], *(T.StructField(c, long) for c in PLACES)])
    found = asked.groupBy("_bucket").cogroup(index.groupBy("bucket")).applyInArrow(find, schema)
    return found.withColumnRenamed("_key", key)


def _records(file: pa.NativeFile, record: int, count: int, tail: tuple[int, int]) -> list[np.ndarray]:
    records, width = tail
    table = file.size() - 24 - 8 * (records + 1)
    offsets = np.frombuffer(file.read_at(8 * (count + 1), table + 8 * record), "<i8")
    raw = np.frombuffer(file.read_at(int(offsets[-1] - offsets[0]) * width, int(offsets[0]) * width), f"<u{width}")
    return [(int(o), raw[o - offsets[0]:e - offsets[0]]) for o, e in zip(offsets[:-1], offsets[1:])]


def read(keys: DataFrame, store: Store, key: str = "doc_id", ids: bool = True) -> DataFrame:
    """The records of the asked keys, found by the index: ``(key, start, n_tokens, ids_crc32[, ids])``.

    ``start`` counts the ids of all records before; ``ids_crc32`` covers the ids as little-endian 32-bit numbers.
    """
    spark, folder = keys.sparkSession, store.folder
    where = lookup(keys, store, key).withColumnRenamed(key, "_key")
    # A key's records in each of its shards: from its first record on, whole shards between, its tail in the last one.
    base = store.shards(spark).select(F.col("shard").alias("_shard"), "ids_before", F.col("records").alias("_all"))
    where = where.select("_key", "record", "records", "last", "tail", F.col("shard").alias("_first"), F.explode(F.sequence("shard", "last")).alias("shard"))
    where = where.join(base, F.col("shard") == F.col("_shard"))
    start = F.when(F.col("shard") == F.col("_first"), F.col("record")).otherwise(0)
    count = F.when(F.col("_first") == F.col("last"), F.col("records")).when(F.col("shard") == F.col("last"), F.col("tail")).otherwise(F.col("_all") - start)
    where = where.select("_key", "shard", start.alias("record"), count.alias("records"), "ids_before")

    def fetch(group: pa.Table) -> pa.Table:
        store_fs, path = fs.FileSystem.from_uri(folder)
        order = np.argsort(np.asarray(group.column("record")), kind="stable")
        records, counts = (np.asarray(group.column(c)) for c in ("record", "records"))
        out = {c: [] for c in ("at", "offset", "n_tokens", "ids_crc32", "ids")}
        with store_fs.open_input_file(f"{path}/shard-{group.column('shard')[0].as_py():06d}.ids") as file:
            n, width, magic = np.frombuffer(file.read_at(24, file.size() - 24), "<i8")
            if magic != MAGIC:
                raise ValueError("not a shard")
            for i in order:
                for offset, found in _records(file, int(records[i]), int(counts[i]), (int(n), int(width))):
                    raw = found.astype("<u4").tobytes()
                    for c, v in zip(out, (int(i), offset, len(found), zlib.crc32(raw), raw if ids else None)):
                        out[c].append(v)
        return pa.table({
            "_key": group.column("_key").take(pa.array(out["at"], pa.int64())), "start": pa.array(np.asarray(group.column("ids_before"))[np.array(out["at"], int)] + np.array(out["offset"], np.int64), pa.int64()),
            "n_tokens": pa.array(out["n_tokens"], pa.int64()), "ids_crc32": pa.array(out["ids_crc32"], pa.int64()), "ids": pa.array(out["ids"], pa.binary())})

    schema = T.StructType([where.schema["_key"], *(T.StructField(c, T.LongType()) for c in ("start", "n_tokens", "ids_crc32")), T.StructField("ids", T.BinaryType())])
    rows = where.groupBy("shard").applyInArrow(fetch, schema)
    out = rows.select(F.col("_key").alias(key), "start", "n_tokens", "ids_crc32", "ids")
    return out if ids else out.drop("ids")
