"""Word pointers over Arrow text buffers: a multikey quicksort of word starts, and the runs of equal words it leaves.

A pointer is the place in a UTF-8 buffer where a word starts. Sorting moves pointers, never words: all open ranges are
partitioned at once by their next eight bytes (one super-character), ranges of equal pointers go one super-character
deeper, and ranges of one pointer or of words that have ended are done. No byte of a word is looked at twice.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from .common import LOWER, STEP, slices, spans, super_characters, texts

# Text bytes of one shard: what a task sorts at once.
SHARD_BYTES = 8 << 20


def shards(batches: Iterator[pa.RecordBatch], column: str, limit: int = SHARD_BYTES) -> Iterator[pa.RecordBatch]:
    """Arrow batches joined, or cut, to about ``limit`` text bytes; a longer text is a shard of its own."""
    held, size = [], 0
    for batch in batches:
        for part in slices(batch, column, limit):
            more = int(texts(part.column(column))[1][-1])
            if held and size + more > limit:
                yield pa.concat_batches(held)
                held, size = [], 0
            held.append(part)
            size += more
    if held:
        yield pa.concat_batches(held)


class Pointers:
    """Sorted pointers of the words of some texts, with A-Z lower-cased.

    ``rows`` and ``starts`` are in sorted order: by word bytes, then by row and place. ``word`` numbers the distinct
    words; ``first`` is the sorted position of each word's first pointer, and one more at the end.
    """

    def __init__(self, column: pa.Array, inside: np.ndarray):
        data, offsets = texts(column)
        starts, ends, rows = spans(inside[data], offsets)
        self.data = np.concatenate([LOWER[data], np.zeros(STEP, np.uint8)])
        order, new = multikey_sort(self.data, starts, ends)
        self.starts, self.ends, self.rows = starts[order], ends[order], rows[order]
        self.word = np.cumsum(new) - 1
        self.first = np.append(np.flatnonzero(new), len(starts))
        self.per_row = np.bincount(rows, minlength=len(column))

    def words(self) -> pa.Array:
        """The distinct words in order."""
        at = self.first[:-1]
        lengths = self.ends[at] - self.starts[at]
        edges = np.concatenate([[0], np.cumsum(lengths)])
        places = np.repeat(self.starts[at] - edges[:-1], lengths) + np.arange(edges[-1])
        return pa.LargeStringArray.from_buffers(len(at), pa.py_buffer(edges.astype(np.int64)), pa.py_buffer(self.data[places])).cast(pa.string())

    def runs(self, of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Equal runs of (word, ``of``), ``of`` being a number per pointer that ascends within each word: where each run
        starts, and its length."""
        n = len(self.word)
        edge = np.flatnonzero(np.concatenate([[True], (self.word[1:] != self.word[:-1]) | (of[1:] != of[:-1])])[:n])
        return edge, np.diff(np.append(edge, n))


def multikey_sort(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Stable order of the words ``data[start:end]`` by bytes, and flags of those that differ from the one before.

    ``data`` ends in eight spare bytes; words hold no zero byte, so that a shorter word sorts before its extensions.
    """
    if not len(starts):
        return np.zeros(0, np.int64), np.zeros(0, bool)
    keys = super_characters(data, starts, ends - starts)
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    new = np.concatenate([[True], keys[1:] != keys[:-1], [True]])
    todo, depth = np.flatnonzero(keys & np.uint64(255)), STEP
    while True:
        todo = todo[~(new[todo] & new[todo + 1])]
        if not len(todo):
            return order, new[:-1]
        here, run = order[todo], np.cumsum(new[todo])
        keys = super_characters(data, np.minimum(starts[here] + depth, len(data) - STEP), ends[here] - starts[here] - depth)
        place = np.lexsort((keys, run))
        order[todo], keys = here[place], keys[place]
        new[todo[1:]] |= keys[1:] != keys[:-1]
        todo = todo[(keys & np.uint64(255)) != 0]
        depth += STEP
