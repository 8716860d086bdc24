"""Helpers shared by the operators: tables, Arrow batches and vectorised words."""

from __future__ import annotations

import sys
import types
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F

# Rows of one Arrow batch, and text bytes that are worked on at once inside a task.
BATCH_ROWS = 1000
SLICE_BYTES = 1 << 21

# Odd multipliers: of word hashes, the finaliser's pair, and the weights of words within a shingle.
BASE = 0x9E3779B97F4A7C15
MIX1, MIX2 = 0xBF58476D1CE4E5B9, 0x94D049BB133111EB
LANES = [(0xD6E8FEB86659FD93 * (2 * i + 1)) % 2**64 | 1 for i in range(16)]

# ASCII white space: the separators of words where a contract says [^\x20\x09-\x0D]+.
_byte = np.arange(256)
NOT_SPACE = ~((_byte == 0x20) | ((_byte >= 0x09) & (_byte <= 0x0D)))
# Digits, letters and everything beyond ASCII (every byte of a UTF-8 sequence is at least 0x80).
ALNUM = ((_byte >= 0x30) & (_byte <= 0x39)) | ((_byte >= 0x41) & (_byte <= 0x5A)) | ((_byte >= 0x61) & (_byte <= 0x7A)) | (_byte >= 0x80)
LOWER = np.where((_byte >= 0x41) & (_byte <= 0x5A), _byte + 32, _byte).astype(np.uint8)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables. Arrow batches of this session hold at most ``BATCH_ROWS`` rows from now on,
    so that a batch of long texts fits a Python worker."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and row offsets of a string column; null is empty."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], np.int64)[column.offset:column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows with about ``limit`` text bytes; a longer text is a run of its own."""
    if not batch.num_rows:
        return
    _, offsets = texts(batch.column(column))
    start = 0
    while start < batch.num_rows:
        end = int(np.searchsorted(offsets, offsets[start] + limit, "right")) - 1
        end = max(end, start + 1)
        yield batch.slice(start, end - start)
        start = end


def worker_state() -> dict:
    """A dictionary that lives as long as the Python process. Functions travel to workers by value, so a module's
    own variables would start anew with every task."""
    return vars(sys.modules.setdefault("_lumenfit_llm_state", types.ModuleType("_lumenfit_llm_state")))


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser of 64-bit numbers."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(MIX1)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(MIX2)
    return x ^ (x >> np.uint64(31))


def spans(flag: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of each maximal run of true bytes; no run crosses rows."""
    n = len(flag)
    if not n:
        none = np.zeros(0, np.int64)
        return none, none, none
    first = np.zeros(n + 1, bool)
    first[offsets] = True
    before = np.concatenate([[False], flag[:-1]])
    after = np.concatenate([flag[1:], [False]])
    starts = np.flatnonzero(flag & (~before | first[:-1]))
    ends = np.flatnonzero(flag & (~after | first[1:])) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


# Bytes of a super-character; longer words than LONG_WORD are hashed one by one.
STEP = 8
LONG_WORD = 1024


def super_characters(data: np.ndarray, at: np.ndarray, left: np.ndarray) -> np.ndarray:
    """The next eight bytes from each place on as one number in byte order, zero beyond the ``left`` bytes of the word.
    ``data`` ends in eight spare bytes."""
    view = np.ndarray((len(data) - STEP + 1,), ">u8", data, strides=(1,))
    keys = view[at].astype(np.uint64)
    cut = np.clip(STEP - left, 0, STEP).astype(np.uint64) * np.uint64(8)
    # a shift by 64 is undefined: such words have ended
    return np.where(cut >= 64, np.uint64(0), keys >> np.minimum(cut, np.uint64(63)) << np.minimum(cut, np.uint64(63)))


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each word: eight bytes at a time, with a bijective finaliser between, so that no two words collide
    by the algebra of the hash as they do under polynomials modulo 2^64."""
    sizes = ends - starts
    out = mixed(sizes.astype(np.uint64) * np.uint64(BASE) + np.uint64(BASE))
    long = sizes > LONG_WORD
    for i in np.flatnonzero(long).tolist():
        out[i] = xxhash.xxh64_intdigest(data[starts[i]:ends[i]].tobytes())
    todo, depth = np.flatnonzero(~long), 0
    while len(todo):
        keys = super_characters(data, starts[todo] + depth, sizes[todo] - depth)
        out[todo] = mixed((out[todo] ^ keys) * np.uint64(BASE))
        depth += STEP
        todo = todo[sizes[todo] > depth]
    return out


def words(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, ...]:
    """Start, end, row and 64-bit hash of each word, with A-Z lower-cased."""
    starts, ends, rows = spans(inside[data], offsets)
    return starts, ends, rows, word_hashes(np.concatenate([LOWER[data], np.zeros(STEP, np.uint8)]), starts, ends)


def chained(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of the ``k`` consecutive words from each position on."""
    n = max(len(hashes) - k + 1, 0)
    out = np.full(n, k, np.uint64)
    for j in range(k):
        out += hashes[j:j + n] * np.uint64(LANES[j])
    return mixed(out)


def signed(x: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(x).view(np.int64)


def list_array(values: np.ndarray, lengths: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, kind))


def row_count(df: DataFrame) -> int:
    return df.agg(F.count(F.lit(1))).first()[0]


# Rows of a table of a few longs that may be broadcast (some 50 MB in memory); a longer one is joined by shuffle.
BROADCAST_ROWS = 1_000_000


def small(df: DataFrame) -> DataFrame:
    """``df``, to be broadcast if it has been counted to be short enough."""
    return F.broadcast(df) if row_count(df) <= BROADCAST_ROWS else df
