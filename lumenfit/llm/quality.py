"""Quality classifier: attention-based multiple-instance learning over the passages of a document.

A document is a bag of passages of ``PASSAGE`` words. Each passage is encoded (character classes, word shapes,
repetition), embedded by ``h = tanh(x W + b)``, weighted by gated attention ``softmax(w . (tanh(h V) * sigmoid(h U)))``
and the weighted sum is scored. Only documents carry labels; the attention learns which passages decide.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from .common import NOT_SPACE, mixed, slices, texts, words

PASSAGE = 64
# Bounds of the labelled sample: documents, and passages of one of them (evenly spaced; scoring uses all).
SAMPLE_DOCS = 6000
SAMPLE_PASSAGES = 64

# Character classes: each ASCII punctuation mark, and lower, upper, digit, space, line end, beyond ASCII, other.
_b = np.arange(256)
_PUNCT = [c for c in range(33, 127) if not chr(c).isalnum()]
CLASS = np.full(256, len(_PUNCT) + 6)
CLASS[_PUNCT] = np.arange(len(_PUNCT))
for _i, _inside in enumerate([(_b >= 97) & (_b <= 122), (_b >= 65) & (_b <= 90), (_b >= 48) & (_b <= 57), _b == 32, _b == 10, _b >= 128]):
    CLASS[_inside] = len(_PUNCT) + _i
N_CLASS = len(_PUNCT) + 7
N_FEATURES = N_CLASS + 8


def encode(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Features of every passage, and the number of passages of every row (at least one: a text without words is one zero row)."""
    n_rows = len(offsets) - 1
    starts, ends, rows, hashes = words(data, offsets, NOT_SPACE)
    per_row = np.bincount(rows, minlength=n_rows)
    before = np.concatenate([[0], np.cumsum(per_row)])
    counts = np.maximum(-(-per_row // PASSAGE), 1)
    base = np.concatenate([[0], np.cumsum(counts)])
    passage = base[rows] + (np.arange(len(rows)) - before[rows]) // PASSAGE
    total = int(base[-1])
    out = np.zeros((total, N_FEATURES), np.float32)
    if not len(rows):
        return out, counts
    # Bytes belong to the passage of the last word that starts at or before them; leading space to the first one.
    word_of = np.clip(np.searchsorted(starts, np.arange(len(data)), "right") - 1, 0, None)
    byte_row = np.repeat(np.arange(n_rows), np.diff(offsets))
    byte_passage = np.where(rows[word_of] == byte_row, passage[word_of], base[byte_row])
    kinds = CLASS[data]
    size = np.bincount(byte_passage, minlength=total).astype(np.float32)
    shares = np.bincount(byte_passage * N_CLASS + kinds, minlength=total * N_CLASS).reshape(total, N_CLASS) / np.maximum(size, 1)[:, None]
    out[:, :N_CLASS] = np.sqrt(shares)
    same = np.zeros(len(data), bool)
    same[1:] = (data[1:] == data[:-1]) & (byte_row[1:] == byte_row[:-1]) & NOT_SPACE[data[1:]]
    n_words = np.bincount(passage, minlength=total).astype(np.float32)
    per_word = np.maximum(n_words, 1)
    upper = (data[starts] >= 65) & (data[starts] <= 90)
    marked = (data[ends - 1] < 128) & (kinds[ends - 1] < len(_PUNCT))

    def repeated(gap: int) -> np.ndarray:
        hit = np.zeros(len(rows), bool)
        hit[gap:] = (hashes[gap:] == hashes[:-gap]) & (rows[gap:] == rows[:-gap])
        return np.bincount(passage, hit, minlength=total) / per_word

    distinct = np.unique(mixed(hashes ^ mixed(passage.astype(np.uint64))), return_index=True)[1]
    extra = [np.bincount(byte_passage, same, minlength=total) / np.maximum(size, 1), np.log1p(np.bincount(passage, ends - starts, minlength=total) / per_word),
             np.bincount(passage, upper, minlength=total) / per_word, np.bincount(passage, marked, minlength=total) / per_word,
             repeated(1), repeated(2), np.bincount(passage[distinct], minlength=total) / per_word, np.log1p(n_words) / 4]
    out[:, N_CLASS:] = np.stack(extra, 1)
    out[base[:-1][per_row == 0]] = 0  # texts of white space alone are empty, whatever texts they come with
    return out, counts


def _segments(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return np.concatenate([[0], np.cumsum(counts)[:-1]]), np.repeat(np.arange(len(counts)), counts)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


class Model:
    """Parameters of the network; ``score`` gives a probability per bag."""

    def __init__(self, weights: dict, mean: np.ndarray, scale: np.ndarray):
        self.weights, self.mean, self.scale = weights, mean, scale

    def forward(self, x: np.ndarray, counts: np.ndarray) -> dict:
        p = self.weights
        first, of = _segments(counts)
        x = (x - self.mean) / self.scale
        h = np.tanh(x @ p["W"] + p["b"])
        t, g = np.tanh(h @ p["V"]), _sigmoid(h @ p["U"])
        e = (t * g) @ p["w"]
        a = np.exp(e - np.maximum.reduceat(e, first)[of])
        a = a / np.add.reduceat(a, first)[of]
        z = np.add.reduceat(a[:, None] * h, first)
        return {"x": x, "of": of, "first": first, "h": h, "t": t, "g": g, "a": a, "z": z, "y": _sigmoid(z @ p["c"] + p["d"])}

    def score(self, x: np.ndarray, counts: np.ndarray) -> np.ndarray:
        return self.forward(x, counts)["y"] if len(counts) else np.zeros(0)


def train(x: np.ndarray, counts: np.ndarray, labels: np.ndarray, hidden: int = 24, gates: int = 12, epochs: int = 30, batch: int = 128, rate: float = 0.004, seed: int = 7) -> Model:
    """Adam on the cross-entropy of bags. Without labels every score is 0.5."""
    rng = np.random.default_rng(seed)
    shapes = {"W": (N_FEATURES, hidden), "b": (hidden,), "V": (hidden, gates), "U": (hidden, gates), "w": (gates,), "c": (hidden,), "d": (1,)}
    weights = {k: rng.normal(0, 1 / np.sqrt(s[0]), s) * (len(s) > 1 or k in "wc") for k, s in shapes.items()}
    if not len(labels):
        return Model(weights | {"c": np.zeros(hidden)}, np.zeros(N_FEATURES), np.ones(N_FEATURES))
    model = Model(weights, x.mean(0), x.std(0) + 0.02)
    moment, square = ({k: np.zeros(s) for k, s in shapes.items()} for _ in range(2))
    edges, step = np.concatenate([[0], np.cumsum(counts)]), 0
    for epoch in range(epochs):
        order = rng.permutation(len(labels))
        for part in (order[i:i + batch] for i in range(0, len(order), batch)):
            rows = np.concatenate([np.arange(edges[i], edges[i + 1]) for i in part])
            f, p = model.forward(x[rows], counts[part]), model.weights
            of, h, a, t, g = f["of"], f["h"], f["a"], f["t"], f["g"]
            dy = (f["y"] - labels[part]) / len(part)
            dz = dy[:, None] * p["c"]
            da = (h * dz[of]).sum(1)
            de = a * (da - np.add.reduceat(a * da, f["first"])[of])
            dt, dg = de[:, None] * p["w"] * g * (1 - t * t), de[:, None] * p["w"] * t * g * (1 - g)
            dh = (a[:, None] * dz[of] + dt @ p["V"].T + dg @ p["U"].T) * (1 - h * h)
            grad = {"W": f["x"].T @ dh, "b": dh.sum(0), "V": h.T @ dt, "U": h.T @ dg, "w": (t * g).T @ de, "c": f["z"].T @ dy, "d": dy.sum(keepdims=True)}
            step += 1
            for k in p:
                moment[k] = 0.9 * moment[k] + 0.1 * grad[k]
                square[k] = 0.999 * square[k] + 0.001 * grad[k] ** 2
                lr = rate * (0.2 if epoch >= epochs * 2 // 3 else 1)
                p[k] = p[k] - lr * (moment[k] / (1 - 0.9**step)) / (np.sqrt(square[k] / (1 - 0.999**step)) + 1e-8) - lr * 1e-3 * p[k]
    return model


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality", sample: int = SAMPLE_DOCS) -> Model:
    """Train on at most about ``sample`` labelled documents, those whose keys hash lowest.

    Rows without key or label do not count; a key that is labelled twice counts for each of its labels.
    """
    known = labels.where(F.col(key).isNotNull() & F.col(label).isNotNull()).select(F.col(key).alias("_key"), F.col(label).cast("double").alias("_label"))
    n = known.agg(F.count(F.lit(1))).first()[0]
    share = min(1.0, sample / max(n, 1))
    chosen = known.where(F.pmod(F.xxhash64("_key", F.lit(11)), F.lit(1 << 30)) < int(share * (1 << 30)))
    # The sample is bounded, so the documents need no shuffle.
    bags = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text")).join(F.broadcast(chosen), "_key")

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "_text"):
                x, counts = encode(*texts(part.column("_text")))
                ends, out = np.cumsum(counts), []
                for end, count in zip(ends, counts):
                    rows = np.unique(np.linspace(end - count, end - 1, min(count, SAMPLE_PASSAGES)).astype(int))
                    out.append(x[rows].tobytes())
                yield pa.RecordBatch.from_arrays([part.column("_key"), part.column("_label"), pa.array(out, pa.binary())], ["_key", "_label", "_bag"])

    schema = T.StructType([bags.schema["_key"], bags.schema["_label"], T.StructField("_bag", T.BinaryType())])
    # Bounded by the sample: at most ``sample`` bags of ``SAMPLE_PASSAGES`` passages.
    rows = bags.mapInArrow(encoded, schema).toPandas().sort_values(["_key", "_label"], kind="stable")
    bags_x = [np.frombuffer(b, np.float32).reshape(-1, N_FEATURES) for b in rows["_bag"]]
    x = np.concatenate(bags_x) if bags_x else np.zeros((0, N_FEATURES), np.float32)
    return train(x.astype(np.float64), np.array([len(b) for b in bags_x], int), rows["_label"].to_numpy(float))


def _scores(model: Model, part: pa.RecordBatch, text: str) -> np.ndarray:
    return model.score(*encode(*texts(part.column(text))))


def score(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, score)`` for each row, over whole texts. Null and empty texts get the score of an empty passage."""
    docs = docs.select(key, text)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text):
                yield pa.RecordBatch.from_arrays([part.column(key), pa.array(_scores(model, part, text), pa.float64())], [key, "score"])

    return docs.mapInArrow(scored, T.StructType([docs.schema[key], T.StructField("score", T.DoubleType())]))


def accepted(docs: DataFrame, model: Model, threshold: float = 0.3, text: str = "text") -> DataFrame:
    """The rows of ``docs`` whose score reaches ``threshold``, with all their columns; no shuffle."""

    def filtered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text):
                yield part.filter(pa.array(_scores(model, part, text) >= threshold))

    return docs.mapInArrow(filtered, docs.schema)
