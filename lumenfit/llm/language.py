"""Language identification of mixed-language text: scripts narrow the candidates, a Viterbi path over words labels spans.

A word is a maximal run of letters (and marks) of one script. Its score for a language is the log likelihood of its byte
trigrams, borders included, under that language's smoothed trigram counts; only languages that were seen to write in
the word's script are candidates. Staying in a language is free, switching costs ``penalty``; the best path over a text's words
gives its spans. Learning is one pass that adds counts up, over all labelled rows.
"""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F, types as T

from .common import slices, texts, worker_state

# Trigram classes of a model, as a power of two: 2^15 counts for each language.
LG_GRAMS = 15
# Cost of a switch in nats, and the share of its letters from which a language is a candidate for a script.
PENALTY = 12.0
SHARE = 0.001
# No language may be chosen where it is no candidate, unless none is.
BARRED = np.float32(-1e4)
# A model is broadcast: so many languages take 128 MB.
MAX_LANGUAGES = 1000

# Blocks of the Unicode standard by script, first and last code point.
SCRIPTS = {
    "Latin": [(0x0041, 0x024F), (0x0250, 0x02AF), (0x1D00, 0x1DBF), (0x1E00, 0x1EFF), (0x2C60, 0x2C7F), (0xA720, 0xA7FF), (0xAB30, 0xAB6F), (0xFB00, 0xFB06), (0xFF21, 0xFF5A)],
    "Greek": [(0x0370, 0x03FF), (0x1F00, 0x1FFF)],
    "Cyrillic": [(0x0400, 0x052F), (0x1C80, 0x1C8F), (0x2DE0, 0x2DFF), (0xA640, 0xA69F)],
    "Armenian": [(0x0530, 0x058F), (0xFB13, 0xFB17)],
    "Hebrew": [(0x0590, 0x05FF), (0xFB1D, 0xFB4F)],
    "Arabic": [(0x0600, 0x06FF), (0x0750, 0x077F), (0x0870, 0x08FF), (0xFB50, 0xFDFF), (0xFE70, 0xFEFF)],
    "Devanagari": [(0x0900, 0x097F), (0xA8E0, 0xA8FF)],
    "Bengali": [(0x0980, 0x09FF)],
    "Gurmukhi": [(0x0A00, 0x0A7F)],
    "Gujarati": [(0x0A80, 0x0AFF)],
    "Oriya": [(0x0B00, 0x0B7F)],
    "Tamil": [(0x0B80, 0x0BFF)],
    "Telugu": [(0x0C00, 0x0C7F)],
    "Kannada": [(0x0C80, 0x0CFF)],
    "Malayalam": [(0x0D00, 0x0D7F)],
    "Sinhala": [(0x0D80, 0x0DFF)],
    "Thai": [(0x0E00, 0x0E7F)],
    "Lao": [(0x0E80, 0x0EFF)],
    "Tibetan": [(0x0F00, 0x0FFF)],
    "Myanmar": [(0x1000, 0x109F)],
    "Georgian": [(0x10A0, 0x10FF), (0x1C90, 0x1CBF), (0x2D00, 0x2D2F)],
    "Hangul": [(0x1100, 0x11FF), (0x3130, 0x318F), (0xA960, 0xA97F), (0xAC00, 0xD7FF)],
    "Ethiopic": [(0x1200, 0x139F), (0x2D80, 0x2DDF)],
    "Khmer": [(0x1780, 0x17FF)],
    "Mongolian": [(0x1800, 0x18AF)],
    "Kana": [(0x3040, 0x30FF), (0x31F0, 0x31FF), (0xFF66, 0xFF9F)],
    "Han": [(0x2E80, 0x2FDF), (0x3005, 0x3007), (0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x323AF)],
}
OTHER = len(SCRIPTS) + 1


def script_table() -> np.ndarray:
    """Script number of each code point, 0 for what is no letter and ``OTHER`` for letters of scripts that are not listed.
    Marks belong to the script of their block."""
    state = worker_state()
    if "scripts" not in state:
        kinds = [unicodedata.category(chr(c))[0] for c in range(sys.maxunicode + 1)]
        letter = np.array([k == "L" for k in kinds])
        of = np.zeros(len(kinds), np.uint8)
        for number, ranges in enumerate(SCRIPTS.values(), 1):
            for first, last in ranges:
                of[first:last + 1] = number
        mark = np.array([k == "M" for k in kinds])
        state["scripts"] = np.where(letter, np.where(of > 0, of, OTHER), np.where(mark & (of > 0), of, 0)).astype(np.uint8)
    return state["scripts"]


def code_points(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place of the first byte, and number, of each code point of a UTF-8 buffer."""
    lead = np.flatnonzero((data & 0xC0) != 0x80)
    first = data[lead].astype(np.int64)
    after = lambda k: data[np.minimum(lead + k, len(data) - 1)].astype(np.int64) & 0x3F
    out = first.copy()
    for low, high, mask, more in ((0xC0, 0xE0, 0x1F, 1), (0xE0, 0xF0, 0x0F, 2), (0xF0, 0x100, 0x07, 3)):
        some = (first >= low) & (first < high)
        if some.any():
            value = first & mask
            for k in range(1, more + 1):
                value = value << 6 | after(k)
            out[some] = value[some]
    return lead, out


@dataclass
class Words:
    """The words of some texts: code point span, row, script, letters, and the trigram classes of their bytes."""

    start: np.ndarray
    end: np.ndarray
    row: np.ndarray
    script: np.ndarray
    grams: np.ndarray
    edges: np.ndarray

    @classmethod
    def of(cls, column: pa.Array) -> "Words":
        # A blank before each text, so that a first word has a border of its own.
        spaced = pc.binary_join_element_wise(pa.scalar("", pa.large_string()), pc.utf8_lower(pc.fill_null(column.cast(pa.large_string()), "")), pa.scalar(" ", pa.large_string()))
        data, offsets = texts(spaced)
        lead, points = code_points(data)
        kind = script_table()[points]
        # Marks without a listed script, joiners and the like end a word; so does a change of script.
        change = np.flatnonzero(np.concatenate([[True], kind[1:] != kind[:-1]])[:len(kind)])
        stop = np.append(change[1:], len(kind))
        word = kind[change] > 0
        start, end = change[word], stop[word]
        places = np.append(lead, len(data))
        low, high = places[start], places[end]
        row = np.searchsorted(offsets, low, "right") - 1
        first = np.searchsorted(lead, offsets[:-1])  # code points before each text
        # Trigrams around each byte of a word; whatever is outside of it is a blank.
        sizes = high - low
        edges = np.concatenate([[0], np.cumsum(sizes)])
        at = np.repeat(low - edges[:-1], sizes) + np.arange(edges[-1])
        middle = data[at].astype(np.uint32)
        before, after = np.concatenate([[0], middle[:-1]]).astype(np.uint32)[:len(middle)], np.concatenate([middle[1:], [0]]).astype(np.uint32)[:len(middle)]
        before[edges[:-1]] = 0x20
        after[edges[1:] - 1] = 0x20
        grams = ((before << np.uint32(16) | middle << np.uint32(8) | after) * np.uint32(0x9E3779B1)) >> np.uint32(32 - LG_GRAMS)
        # utf8_lower maps code point by code point, so places in the lower-cased text are those of the text.
        return cls(start - first[row] - 1, end - first[row] - 1, row, kind[change][word], grams.astype(np.int64), edges)

    @property
    def letters(self) -> np.ndarray:
        return self.end - self.start


@dataclass
class Model:
    """Languages in code point order, log likelihoods ``(language, trigram class)`` and candidates ``(script, language)``."""

    languages: list[str]
    weights: np.ndarray
    candidates: np.ndarray


def train(docs: DataFrame, lang: str = "lang", text: str = "text", share: float = SHARE) -> Model:
    """Learn from all rows with a language and a text; an empty table learns no language.

    Each task adds up its counts per language before they are shuffled, so that a frequent language is a row per
    task and trigram class. What reaches the driver is the model: 2^15 counts and 29 scripts for each language.
    """
    size = 1 << LG_GRAMS

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[str, np.ndarray] = {}
        for batch in batches:
            for part in slices(batch, "text"):
                words = Words.of(part.column("text"))
                names = part.column("lang").dictionary_encode()
                of = np.asarray(names.indices)[words.row]
                for i, name in enumerate(names.dictionary.to_pylist()):
                    mine = of == i
                    counts = found.setdefault(name, np.zeros(size + OTHER + 1, np.int64))
                    counts[:size] += np.bincount(words.grams[np.repeat(mine, np.diff(words.edges))], minlength=size)
                    counts[size:] += np.bincount(words.script[mine], words.letters[mine], OTHER + 1).astype(np.int64)
        for name, counts in found.items():
            at = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays([pa.repeat(pa.scalar(name), len(at)), pa.array(at), pa.array(counts[at])], ["lang", "at", "n"])

    rows = docs.select(F.col(lang).cast("string").alias("lang"), F.col(text).alias("text")).where("lang is not null and text is not null")
    languages = sorted(r["lang"] for r in rows.select("lang").distinct().limit(MAX_LANGUAGES + 1).collect())
    if len(languages) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    counts = np.zeros((len(languages), size + OTHER + 1), np.int64)
    # One row per language, of a fixed size at most.
    added = rows.mapInArrow(count, "lang string, at long, n long").groupBy("lang", "at").agg(F.sum("n").alias("n"))
    place = {name: i for i, name in enumerate(languages)}
    for r in added.groupBy("lang").agg(F.collect_list("at").alias("at"), F.collect_list("n").alias("n")).toLocalIterator():
        counts[place[r["lang"]], r["at"]] = r["n"]
    grams, scripts = counts[:, :size], counts[:, size:]
    weights = np.log((grams + 0.5) / (grams.sum(axis=1, keepdims=True) + 0.5 * size)).astype(np.float32)
    candidates = scripts.T > share * np.maximum(scripts.sum(axis=1), 1)
    return Model(languages, weights, candidates)


def word_scores(words: Words, model: Model) -> np.ndarray:
    """Score of each word for each language; languages that are no candidates for its script are barred."""
    out = np.zeros((len(words.row), len(model.languages)), np.float32)
    if len(out):
        for i in range(len(model.languages)):
            out[:, i] = np.add.reduceat(model.weights[i][words.grams], words.edges[:-1])
        known = model.candidates[words.script]
        known |= ~known.any(axis=1, keepdims=True)
        out -= out.max(axis=1, keepdims=True, where=known, initial=-np.inf)
        out[~known] = BARRED
    return out


def viterbi(scores: np.ndarray, row: np.ndarray, rows: int, penalty: float) -> np.ndarray:
    """The best path of each text: a language number per word. All texts go forward together, a word at a time, the long
    ones first; equal paths stay rather than switch and prefer the smaller number."""
    sizes = np.bincount(row, minlength=rows)
    order = np.argsort(-sizes, kind="stable")
    order = order[:int((sizes > 0).sum())]
    start = np.concatenate([[0], np.cumsum(sizes)])[order]
    alive = len(order) - np.searchsorted(sizes[order][::-1], np.arange(sizes[order[0]] if len(order) else 0), "right")
    best = np.zeros((len(order), scores.shape[1]))
    stay = np.ones(scores.shape, bool)
    source = np.zeros(len(row), np.int32)
    for t, n in enumerate(alive.tolist()):
        at, now = start[:n] + t, best[:n]
        if t:
            top = now.argmax(axis=1)
            moved = now[np.arange(n), top] - penalty
            stay[at] = keep = now >= moved[:, None]
            source[at] = top
            now = np.where(keep, now, moved[:, None])
        best[:n] = now + scores[at]
    label = best.argmax(axis=1) if len(order) else np.zeros(0, np.int64)
    out = np.zeros(len(row), np.int32)
    for t in range(len(alive) - 1, -1, -1):
        n = int(alive[t])
        at = start[:n] + t
        out[at] = label[:n]
        label[:n] = np.where(stay[at, label[:n]], label[:n], source[at])
    return out


def label(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text", penalty: float = PENALTY) -> DataFrame:
    """``(key, lang_pred, score, spans)`` for each row: the language with the most letters, its share of the letters, and
    the spans ``(start, end, lang)`` in code points, from a span's first letter to its last.

    Null texts and texts without a letter are ``und`` with score 0 and no spans, and so is all text where no language has been learned. Letters of
    scripts that no language was seen in go with what stands around them. Equal shares choose the language that
    is first in code point order. Rows are independent: keys may be null or repeat.
    """
    spark = docs.sparkSession
    held = spark.sparkContext.broadcast(model)  # at most MAX_LANGUAGES languages
    docs = docs.select(F.col(key), F.col(text))
    limit = max(1 << 18, (8 << 20) // max(4, len(model.languages)))

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = held.value
        names = pa.array([*model.languages, "und"], pa.string())
        none = len(model.languages)
        for batch in batches:
            for part in slices(batch.rename_columns(["_key", "_text"]), "_text", limit):
                words, n = Words.of(part.column("_text")), part.num_rows
                if not none:
                    words = Words(*(x[:0] for x in (words.start, words.end, words.row, words.script, words.grams)), words.edges[:1])
                path = viterbi(word_scores(words, model), words.row, n, penalty) if none else np.zeros(0, np.int32)
                letters = np.zeros((n, none + 1))
                np.add.at(letters, (words.row, path), words.letters)
                total = letters.sum(axis=1)
                letters[:, none] = total == 0
                pred = letters.argmax(axis=1)
                score = np.where(total > 0, letters[np.arange(n), pred] / np.maximum(total, 1), 0.0)
                edge = np.flatnonzero(np.concatenate([[True], (path[1:] != path[:-1]) | (words.row[1:] != words.row[:-1])])[:len(path)])
                last = np.append(edge[1:], len(path)) - 1 if len(edge) else edge
                spans = pa.StructArray.from_arrays([pa.array(words.start[edge], pa.int64()), pa.array(words.end[last], pa.int64()), names.take(pa.array(path[edge]))], ["start", "end", "lang"])
                per_row = np.bincount(words.row[edge], minlength=n)
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(per_row)]), pa.int32()), spans)
                yield pa.RecordBatch.from_arrays([part.column("_key"), names.take(pa.array(pred)), pa.array(score), lists], [key, "lang_pred", "score", "spans"])

    span = T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType()), T.StructField("lang", T.StringType())])
    schema = T.StructType([docs.schema[0], T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("spans", T.ArrayType(span))])
    return docs.mapInArrow(walk, schema)
