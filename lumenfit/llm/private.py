"""Personal data: fixed patterns, and a linear-chain conditional random field over word shapes.

Words that hold a digit or an @ form chains; a plain word between them always is outside, so the chains are decoded
apart without loss. The field has tags outside/email/ip/card/phone, features of the shapes of a word and its
neighbours, and transitions; it is trained on a small labelled table and decoded by Viterbi in numpy batches.
Tagged runs that are valid for their kind and overlap no pattern span are additional spans.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from bisect import bisect_left
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from .common import row_count, slices

KINDS = ("email", "ip", "card", "phone")
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
MARK = re.compile(r"[0-9@]")
DIGITS = re.compile(r"[0-9]")
# What the field's runs are searched for.
GROUP = re.compile(r"[0-9]+")
HOST = re.compile(r"@[A-Za-z0-9.-]*[A-Za-z0-9]")
FIELD_IP = re.compile(r"[0-9]{1,3}(?:\.[0-9]{1,3}){3}")
FIELD_CARD = re.compile(r"[0-9][0-9 .-]*[0-9]")
FIELD_PHONE = re.compile(r"\+[0-9][0-9 ().-]*[0-9]")
# Bounds of the training sample: documents it is drawn from, chains.
SAMPLE_DOCS = 8000
SAMPLE_CHAINS = 1500
SHAPES = 1024
TAGS = len(KINDS) + 1


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _digits(value: str) -> str:
    return "".join(DIGITS.findall(value))


def _card(value: str) -> bool:
    digits = _digits(value)
    return 12 <= len(digits) <= 19 and luhn(digits)


def _ip(value: str) -> bool:
    return all(int(p[-4:]) <= 255 and len(p.lstrip("0")) <= 3 for p in value.split("."))


def _phone(value: str) -> bool:
    return 9 <= len(_digits(value)) <= 15


def emails(text: str, host: re.Pattern = DOMAIN) -> list[tuple[int, int]]:
    """Leftmost matches of local part, @ and domain: from each @ the local part extends to the left as far as it may."""
    found, at, done = [], text.find("@"), 0
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        domain = host.match(text, at) if start < at else None
        if domain:
            found.append((start, domain.end()))
            done = domain.end()
        at = text.find("@", max(at + 1, done))
    return found


def base_spans(text: str) -> tuple[list[tuple[int, int, int]], list[tuple[int, int]]]:
    """(start, kind, end) of the fixed patterns in order, and the spans of matches that failed their check."""
    found, failed = [(a, 0, b) for a, b in emails(text)], []
    for kind, pattern, valid in ((1, IP, _ip), (2, CARD, _card), (3, PHONE, _phone)):
        for m in pattern.finditer(text):
            if valid(m.group()):
                found.append((m.start(), kind, m.end()))
            elif m.end() - m.start() > 8:
                failed.append(m.span())
    return sorted(found), failed


def chains(text: str) -> list[list[tuple[int, int]]]:
    """Word spans of each maximal run of words that hold a digit or an @."""
    out: list[list[tuple[int, int]]] = []
    end = -1
    for m in MARK.finditer(text):
        if m.start() < end:
            continue
        a = m.start()
        while a > max(end, 0) and not text[a - 1].isspace():
            a -= 1
        b, n = m.end(), len(text)
        while b < n and not text[b].isspace():
            b += 1
        if out and text[out[-1][-1][1]:a].isspace():
            out[-1].append((a, b))
        else:
            out.append([(a, b)])
        end = b
    return out


def shape(word: str) -> str:
    """Digits d, letters a, marks as they are; runs of one class shortened to their length class."""
    out, i = [], 0
    while i < len(word):
        c = "d" if word[i].isdigit() else "a" if word[i].isalpha() else word[i]
        j = i + 1
        while j < len(word) and c == ("d" if word[j].isdigit() else "a" if word[j].isalpha() else word[j]):
            j += 1
        n = j - i
        out.append(c + ("" if c not in "da" else str(n) if c == "d" and n <= 4 else "5-11" if c == "d" and n < 12 else "12-19" if c == "d" and n < 20 else "+"))
        i = j
    return "".join(out)


def _features(words: list[str]) -> np.ndarray:
    """Feature numbers of each word: its shape, its first and last mark, and the shapes beside it."""
    shapes = ["<", *(shape(w) for w in words), ">"]
    code = lambda kind, s: zlib.crc32(f"{kind}{s}".encode()) % SHAPES
    return np.array([[code("0", shapes[i]), code("1", shapes[i][:2] + shapes[i][-1]), code("2", shapes[i - 1]), code("3", shapes[i + 1]), code("4", "@" in shapes[i])]
                     for i in range(1, len(shapes) - 1)], np.int64).reshape(-1, 5)


class Field:
    """Weights of features and transitions."""

    def __init__(self):
        self.emit, self.move = np.zeros((SHAPES, TAGS)), np.zeros((TAGS, TAGS))
        self.emit[:, 0] = 1e-3  # without training every word is outside

    def _padded(self, groups: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        lengths = np.array([len(g) for g in groups])
        scores = np.zeros((len(groups), lengths.max(), TAGS))
        for i, g in enumerate(groups):
            scores[i, :len(g)] = self.emit[g].sum(1)
        return scores, lengths

    def decode(self, groups: list[np.ndarray]) -> list[np.ndarray]:
        """Viterbi, many chains in step; chains of like length share a batch."""
        out: list = [None] * len(groups)
        order = sorted(range(len(groups)), key=lambda i: len(groups[i]))
        start = 0
        while start < len(order):
            part = order[start:start + 512]
            while len(part) > 1 and len(groups[part[-1]]) * len(part) > 1 << 16:
                part = part[:len(part) // 2]
            start += len(part)
            scores, lengths = self._padded([groups[i] for i in part])
            n, steps = scores.shape[:2]
            back = np.zeros((n, steps, TAGS), np.int8)
            best = scores[:, 0]
            finals = np.where((lengths == 1)[:, None], best, 0.0)
            for t in range(1, steps):
                all_ = best[:, :, None] + self.move
                back[:, t] = all_.argmax(1)
                best = all_.max(1) + scores[:, t]
                finals[lengths == t + 1] = best[lengths == t + 1]
            tag = finals.argmax(1)
            tags = np.zeros((n, steps), np.int8)
            for t in range(steps - 1, -1, -1):
                live = lengths > t
                tags[live, t] = tag[live]
                if t:
                    tag = np.where(live, back[np.arange(n), t, tag], tag)
            for i, at in enumerate(part):
                out[at] = tags[i, :lengths[i]]
        return out

    def fit(self, groups: list[np.ndarray], tags: list[np.ndarray], epochs: int = 120, rate: float = 0.1, ridge: float = 1e-3) -> "Field":
        """Maximum likelihood by full-batch Adam; gradients from forward and backward sums."""
        if not groups:
            return self
        lengths = np.array([len(g) for g in groups])
        n, steps = len(groups), int(lengths.max())
        live = np.arange(steps)[None] < lengths[:, None]
        gold = np.zeros((n, steps, TAGS))
        for i, t in enumerate(tags):
            gold[i, np.arange(len(t)), t] = 1
        flat, at = np.concatenate(groups), np.flatnonzero(live.ravel())
        gold_move = np.einsum("nti,ntj->ij", gold[:, :-1], gold[:, 1:])
        state = [(np.zeros_like(w), np.zeros_like(w)) for w in (self.emit, self.move)]
        soft = lambda x, axis: np.log(np.exp(x - x.max(axis, keepdims=True)).sum(axis)) + x.max(axis)
        for epoch in range(1, epochs + 1):
            scores, _ = self._padded(groups)
            ahead, behind = np.zeros_like(scores), np.zeros_like(scores)
            ahead[:, 0] = scores[:, 0]
            for t in range(1, steps):
                ahead[:, t] = np.where(live[:, t, None], soft(ahead[:, t - 1, :, None] + self.move, 1) + scores[:, t], ahead[:, t - 1])
            for t in range(steps - 2, -1, -1):
                behind[:, t] = np.where(live[:, t + 1, None], soft(self.move + (scores[:, t + 1] + behind[:, t + 1])[:, None, :], 2), 0)
            total = soft(ahead[:, -1], 1)
            marginal = np.exp(ahead + behind - total[:, None, None]) * live[..., None]
            pair = np.zeros((TAGS, TAGS))
            for t in range(1, steps):
                joint = ahead[:, t - 1, :, None] + self.move + (scores[:, t] + behind[:, t])[:, None, :] - total[:, None, None]
                pair += (np.exp(joint) * live[:, t, None, None]).sum(0)
            delta = ((marginal - gold) * live[..., None]).reshape(-1, TAGS)[at]
            grad = np.zeros_like(self.emit)
            for f in range(flat.shape[1]):
                np.add.at(grad, flat[:, f], delta)
            for (m, v), w, g in zip(state, (self.emit, self.move), (grad / n + ridge * self.emit, (pair - gold_move) / n + ridge * self.move)):
                m *= 0.9
                m += 0.1 * g
                v *= 0.99
                v += 0.01 * g * g
                w -= rate * (m / (1 - 0.9**epoch)) / (np.sqrt(v / (1 - 0.99**epoch)) + 1e-8)
        return self


def labelled(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """A small labelled table ``(words, tags)``: chains of a bounded sample of documents, tagged by the fixed patterns.

    Chains with a match that failed its check are left out: they are what the field is for.
    """
    n = row_count(docs)
    share = min(1.0, SAMPLE_DOCS / max(n, 1))
    chosen = docs.where(F.pmod(F.xxhash64(key, F.lit(19)), F.lit(1 << 30)) < int(share * (1 << 30))).select(text)

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, tags = [], []
            for value in batch.column(0).to_pylist():
                value = value or ""
                base, failed = base_spans(value)
                for chain in chains(value):
                    if len(chain) > 40 or any(a < chain[-1][1] and chain[0][0] < b for a, b in failed):
                        continue
                    words.append([value[a:b][:64] for a, b in chain])
                    tags.append([next((k + 1 for x, k, y in base if x < b and a < y), 0) for a, b in chain])
            yield pa.RecordBatch.from_arrays([pa.array(words, pa.list_(pa.string())), pa.array(tags, pa.list_(pa.int64()))], ["words", "tags"])

    return chosen.mapInArrow(pick, "words array<string>, tags array<bigint>").distinct()


def train(table: DataFrame, chains_: int = SAMPLE_CHAINS) -> Field:
    """Fit the field to at most ``chains_`` chains, those that hash lowest, and to each joined with the next one:
    what stands side by side keeps its tags, which teaches where one kind ends and another begins."""
    rows = [(r[0], r[1]) for r in table.orderBy(F.xxhash64("words"), "words").limit(chains_).collect()]
    rows += [(a[0] + b[0], a[1] + b[1]) for a, b in zip(rows, rows[1:])]
    return Field().fit([_features(r[0]) for r in rows], [np.array(r[1]) for r in rows])


def _cards(value: str) -> list[tuple[int, int]]:
    """Consecutive groups of digits that are cards: those that leave the fewest digits over, then the fewest cards."""
    groups = [m.span() for m in GROUP.finditer(value)]
    digits = [int(value[i]) for a, b in groups for i in range(a, b)]
    first = [0, *accumulate(b - a for a, b in groups)]
    # Luhn sums from the left, with the digits at odd or even places doubled.
    sums = [[0, *accumulate(d if i % 2 == q else 2 * d - 9 * (d > 4) for i, d in enumerate(digits))] for q in (0, 1)]
    best, take = [(0, 0)], [0]
    for j in range(1, len(first)):
        end = first[j]
        best.append((best[-1][0] + end - first[j - 1], best[-1][1]))
        take.append(0)
        for i in range(j - 1, -1, -1):
            if end - first[i] > 19:
                break
            if end - first[i] >= 12 and (sums[(end - 1) % 2][end] - sums[(end - 1) % 2][first[i]]) % 10 == 0:
                cost = best[i][0], best[i][1] + 1
                if cost < best[j]:
                    best[j], take[j] = cost, j - i
    out, j = [], len(groups)
    while j:
        if take[j]:
            out.append((groups[j - take[j]][0], groups[j - 1][1]))
        j -= take[j] or 1
    return out[::-1]


def _ips(value: str) -> list[tuple[int, int]]:
    found, m = [], FIELD_IP.search(value)
    while m:
        good = _ip(m.group())
        if good:
            found.append(m.span())
        m = FIELD_IP.search(value, m.end() if good else GROUP.match(value, m.start()).end())
    return found


def _phones(value: str) -> list[tuple[int, int]]:
    """From each + on, the longest run of groups of digits that is a phone number."""
    found = []
    for m in FIELD_PHONE.finditer(value):
        n, end = 0, 0
        for group in GROUP.finditer(value, m.start(), m.end()):
            n += group.end() - group.start()
            if n > 15:
                break
            end = group.end() if n >= 9 else 0
        if end:
            found.append((m.start(), end))
    return found


def _valid(kind: int, value: str) -> list[tuple[int, int]]:
    """Where in a tagged run personal data lies: every valid place, several side by side as well."""
    if kind == 0:
        return emails(value, HOST)
    if kind == 1:
        return _ips(value)
    if kind == 2:
        return [(m.start() + a, m.start() + b) for m in FIELD_CARD.finditer(value) for a, b in _cards(m.group())]
    return _phones(value)


def extra_spans(text: str, taken: list[tuple[int, int, int]], found: list[list[tuple[int, int]]], tags: list[np.ndarray]) -> list[tuple[int, int, str]]:
    """(start, end, kind) of valid places in tagged runs that overlap no pattern span."""
    out = []
    starts, reach = [x for x, _, _ in taken], list(accumulate((y for _, _, y in taken), max))
    for chain, tag in zip(found, tags):
        i = 0
        while i < len(chain):
            j = i + 1
            while j < len(chain) and tag[j] == tag[i]:
                j += 1
            if tag[i]:
                a, b = chain[i][0], chain[j - 1][1]
                for x, y in _valid(int(tag[i]) - 1, text[a:b]):
                    before = bisect_left(starts, a + y)
                    if not before or reach[before - 1] <= a + x:
                        out.append((a + x, a + y, f"crf_{KINDS[tag[i] - 1]}"))
            i = j
    return out


def scan(docs: DataFrame, field: Field, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_crf)`` for each row; counts are of pattern spans.

    Null and empty texts have no spans. Rows are independent: repeats give equal results.
    """
    docs = docs.select(key, text)

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text):
                values = [v or "" for v in part.column(text).to_pylist()]
                found = [chains(v) for v in values]
                features = [_features([v[a:b] for a, b in c]) for v, cs in zip(values, found) for c in cs]
                tags = field.decode(features) if features else []
                counts, digests, spans, extras, at = [], [], [], [], 0
                for value, cs in zip(values, found):
                    base = base_spans(value)[0] if cs else []
                    extra = extra_spans(value, base, cs, tags[at:at + len(cs)])
                    at += len(cs)
                    counts.append([sum(1 for s in base if s[1] == k) for k in range(4)])
                    digests.append(hashlib.sha256(",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in base).encode()).hexdigest())
                    both = sorted([(a, k, b, KINDS[k]) for a, k, b in base] + [(a, len(KINDS), b, kind) for a, b, kind in extra])
                    spans.append(",".join(f"{kind}:{a}:{b}" for a, _, b, kind in both))
                    extras.append(len(extra))
                counts = np.array(counts, np.int64).reshape(-1, 4)
                yield pa.RecordBatch.from_arrays(
                    [part.column(key), *(pa.array(counts[:, i]) for i in range(4)), pa.array(digests, pa.string()), pa.array(spans, pa.string()), pa.array(extras, pa.int64())],
                    [key, *(f"n_{k}" for k in KINDS), "base_sha256", "spans", "n_crf"])

    long = T.LongType()
    return docs.mapInArrow(scanned, T.StructType([docs.schema[key], *(T.StructField(f"n_{k}", long) for k in KINDS), T.StructField("base_sha256", T.StringType()),
                                                 T.StructField("spans", T.StringType()), T.StructField("n_crf", long)]))
