"""Source divergence audit: how far the term distributions of the sources of a language lie apart, and by which terms.

Terms are counted by sorting word-start pointers over Arrow buffers, a shard of texts at a time: rows are put in the
order of their (language, source), the pointers are sorted by their words, and the equal runs then yield how often a
source has a term and in how many documents. Spark adds the shards up. The audit itself is integer arithmetic over
tiles of terms by sources; every tile gives a partial sum per pair of sources and its best terms per source.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from ..session import durable
from .common import row_count
from .pointers import Pointers, shards

# Letters and everything beyond ASCII.
LETTER = np.array([0x41 <= b <= 0x5A or 0x61 <= b <= 0x7A or b >= 0x80 for b in range(256)])
SCALE = 1_000_000_000
# Terms of one tile, and cells (terms by sources) that a task holds at once.
TILE_TERMS = 20_000
CELLS = 2_000_000


def _named(docs: DataFrame, lang: str, source: str, *more) -> DataFrame:
    """Language and source as text, null being the empty text."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    return docs.select(text(lang).alias("lang"), text(source).alias("source"), *more)


def _sorted_shard(part: pa.RecordBatch) -> pa.RecordBatch:
    """Terms of a shard: ``(lang, source, term, n, docs)``, a row per (language, source) and term."""
    part = part.take(pc.sort_indices(part, sort_keys=[("lang", "ascending"), ("source", "ascending")]))
    langs, sources = (np.asarray(part.column(c).dictionary_encode().indices) for c in ("lang", "source"))
    group = np.cumsum(np.concatenate([[False], (langs[1:] != langs[:-1]) | (sources[1:] != sources[:-1])]))
    sorted_words = Pointers(part.column("text"), LETTER)
    # One run per (term, document), then one per (term, group).
    at, counts = sorted_words.runs(sorted_words.rows)
    word, of = sorted_words.word[at], group[sorted_words.rows[at]]
    edge = np.flatnonzero(np.concatenate([[True], (word[1:] != word[:-1]) | (of[1:] != of[:-1])])[:len(at)])
    docs = np.diff(np.append(edge, len(at)))
    n = np.add.reduceat(counts, edge) if len(edge) else counts
    heads = pa.array(np.searchsorted(group, of[edge]))
    return pa.RecordBatch.from_arrays([part.column("lang").take(heads), part.column("source").take(heads), sorted_words.words().take(pa.array(word[edge])),
                                       pa.array(n, pa.int64()), pa.array(docs, pa.int64())], ["lang", "source", "term", "n", "docs"])


def term_counts(docs: DataFrame, lang: str = "lang", source: str = "source", text: str = "text", min_docs: int = 10) -> DataFrame:
    """``(lang, term, docs, n_sources, sources)`` of the terms that at least ``min_docs`` documents of a language hold.

    ``sources`` lists ``(source, n)``. A row is a document; null and empty texts have no terms; null languages and
    sources are the empty text. Partial counts are merged before each shuffle, so a frequent term or a hot source is a
    row per task.
    """
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in shards(batches, "text"):
            yield _sorted_shard(part)

    rows = _named(docs, lang, source, F.col(text).alias("text")).where(F.length("text") > 0)
    found = rows.mapInArrow(count, "lang string, source string, term string, n long, docs long")
    each = found.groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    terms = each.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.count(F.lit(1)).alias("n_sources"), F.collect_list(F.struct("source", "n")).alias("sources"))
    return terms.where(F.col("docs") >= min_docs)


def _shares(counts: np.ndarray, totals: np.ndarray, v: int) -> np.ndarray:
    """``1 + floor(SCALE * (count + 2) / (total + 2 v))``, exact whatever the size."""
    below = totals + 2 * v
    if counts.size and (int(counts.max()) + 2) * SCALE >= 1 << 63:
        counts, below = counts.astype(object), below.astype(object)
    return (1 + SCALE * (counts + 2) // below).astype(np.int64)


def _apart(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // (p + q)


def _tile(terms: pa.Table, groups: pa.Table, top: int) -> pa.Table:
    """Partial rows of a tile: ``(lang, source, part, item, value)``; pairs once, the lower source first."""
    groups = groups.sort_by("source")
    names, totals, v = groups.column("source").combine_chunks(), np.asarray(groups.column("total")), int(groups.column("v")[0].as_py())
    lang, width = groups.column("lang")[0], len(names)
    place = {name: i for i, name in enumerate(names.to_pylist())}
    pairs = np.zeros((width, width), np.int64)
    out = []

    def rows(source, part, item, value):
        n = len(value)
        out.append(pa.table({"lang": pa.repeat(lang.cast(pa.string()), n), "source": names.take(pa.array(source, pa.int64())), "part": pa.repeat(pa.scalar(part), n), "item": item, "value": pa.array(value, pa.int64())}))

    terms = terms.sort_by("term")
    whole = int(groups.column("lang_total")[0].as_py())
    step = max(1, CELLS // width)
    for at in range(0, len(terms), step):
        chunk = terms.slice(at, step)
        words, lists = chunk.column("term").combine_chunks(), chunk.column("sources").combine_chunks()
        sizes = np.asarray(pc.list_value_length(lists))
        flat = lists.flatten()
        seen = flat.field("source").dictionary_encode()
        known = np.array([place[s] for s in seen.dictionary.to_pylist()], np.int64)
        counts = np.zeros((len(chunk), width), np.int64)
        counts[np.repeat(np.arange(len(chunk)), sizes), known[np.asarray(seen.indices)]] = np.asarray(flat.field("n"))
        p = np.ascontiguousarray(_shares(counts, totals, v).T)
        q = _shares(counts.sum(axis=1), np.array([whole]), v)
        for i in range(width):
            for j in range(i + 1, width):
                pairs[i, j] += _apart(p[i], p[j]).sum()
            over = np.flatnonzero((counts[:, i] > 0) & (p[i] > q))
            value = _apart(p[i][over], q[over])
            best = np.argsort(-value, kind="stable")[:top]
            rows(np.full(len(best), i), "term", words.take(pa.array(over[best])), value[best])
    i, j = np.triu_indices(width, 1)
    rows(i, "pair", names.take(pa.array(j, pa.int64())), pairs[i, j])
    return pa.concat_tables(out)


def audit(docs: DataFrame, lang: str = "lang", source: str = "source", text: str = "text", min_docs: int = 10, top: int = 10, tile: int = TILE_TERMS) -> DataFrame:
    """``(lang, source, part, item, value, rank)``: for each source of a language its distance from every other source
    (part ``pair``, triangular discrimination of the smoothed shares, in parts of ``SCALE``) and the ``top`` terms that
    set it apart from its language (part ``term``); ``rank`` counts from 1 in each part.

    Sources without terms take part with their smoothing; a language without kept terms has pairs of value 0, one
    with a single source has none. Null languages, sources and texts are empty ones; repeated rows count each; an empty
    table gives no rows. Pairs are the result itself: a language gives as many as the square of its sources.
    """
    groups = _named(docs, lang, source).distinct()
    terms = durable(term_counts(docs, lang, source, text, min_docs))
    totals = terms.select("lang", F.explode("sources").alias("s")).groupBy("lang", F.col("s.source").alias("source")).agg(F.sum("s.n").alias("total"))
    kept = terms.groupBy("lang").agg(F.count(F.lit(1)).alias("v"))
    info = groups.join(totals, ["lang", "source"], "left").join(kept, "lang", "left").fillna(0, ["total", "v"])
    info = info.withColumn("lang_total", F.sum("total").over(Window.partitionBy("lang")))
    info = durable(info.withColumn("tiles", F.greatest(F.lit(1).cast("long"), F.ceil(F.col("v") / tile)).cast("long")))
    # Tiles of a language by hash of the term; a source's row goes to each of them.
    tiles = kept.select("lang", F.ceil(F.col("v") / tile).cast("long").alias("tiles"))
    tiles = F.broadcast(tiles) if row_count(tiles) <= 10_000 else tiles
    dealt = terms.join(tiles, "lang").select("lang", F.pmod(F.xxhash64("term"), F.col("tiles")).alias("tile"), "term", "sources")
    spread = info.withColumn("tile", F.explode(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1)))

    def fold(terms: pa.Table, groups: pa.Table) -> pa.Table:
        return _tile(terms, groups, top)

    parts = dealt.groupBy("lang", "tile").cogroup(spread.groupBy("lang", "tile")).applyInArrow(fold, "lang string, source string, part string, item string, value long")
    parts = durable(parts)
    pair = parts.where("part = 'pair'").groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"))
    both = pair.select(F.explode(F.array(
        F.struct("lang", "source", "part", "item", "value"),
        F.struct("lang", F.col("item").alias("source"), "part", F.col("source").alias("item"), "value"))).alias("r")).select("r.*")
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = lambda rows: rows.withColumn("rank", F.row_number().over(order))
    return ranked(both).unionByName(ranked(parts.where("part = 'term'")).where(F.col("rank") <= top))
