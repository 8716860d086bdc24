"""Secret scans: fixed patterns, and probabilistic automata inferred from labelled credentials.

Labelled strings of a kind become a prefix tree over character classes; states whose continuations are statistically
compatible (Hoeffding bounds, recursively) merge into a probabilistic automaton. There is one automaton per kind of credential, from
values found by the fixed patterns and from formats that issuers publish, and one per kind of ordinary token. Every run of
token characters is a candidate and is scored by all of them, a batch of texts at a time, as likelihood per character; a
candidate that some credential format explains much better than ordinary tokens of its own make is an additional span.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F, types as T

from .common import row_count, slices, spans, texts

KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
NAMES = ("password", "passwd", "secret", "token", "apikey", "api_key")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{24,}")
# Candidates are maximal runs of these characters, less the marks of TRIM at their ends, from LEAST characters on.
TOKEN = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=.-"
TRIM = b".-/"
LEAST = 8
# Bounds of the training sample: documents it is drawn from, strings of a kind.
SAMPLE_DOCS = 8000
SAMPLE_STRINGS = 150
# Published formats of credentials as (prefix, alphabet, characters behind the prefix).
DIGITS = "0123456789"
BASE62 = DIGITS + "ABCDEFGHIJKLMNOPQRSTUVWXYZ" + "abcdefghijklmnopqrstuvwxyz"
FORMATS = {
    "access": ("AKIA", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", 16),
    "session": ("ASIA", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", 16),
    "personal": ("ghp_", BASE62, 36),
    "live": ("sk_live_", BASE62, 24),
    "service": ("sk-live-", BASE62, 32),
    "browser": ("AIza", BASE62 + "_-", 35),
    "project": ("glpat-", BASE62 + "_-", 20),
    "bot": ("xoxb-", DIGITS, 12),
    "opaque": ("", BASE62, 32),
    "long": ("", BASE62, 40),
    "encoded": ("", BASE62 + "+/", 40),
    "digest": ("", DIGITS + "ABCDEF", 40),
    "short": ("", DIGITS + "abcdef", 20),
}
# Added spans: log-likelihood above ordinary tokens, per character and in all.
MARGIN = 0.4
EVIDENCE = 9.0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the fixed patterns, in order; code points."""
    found = []
    low = text.lower()
    if any(name in low for name in NAMES):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m.group(1)) >= 6]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def base_values(text: str, spans: list[tuple[int, int, int]]) -> list[str]:
    """The credential inside each span: an assignment's value, else the span."""
    return [ASSIGN.match(text, a).group(1) if kind == 0 else text[a:b] for a, kind, b in spans]


# Character classes: digits, hex letters, other letters, each case for itself, and every mark.
CLASSES = "dflFL+/_=.-"
CLASS_OF = np.full(256, -1, np.int8)
for _c in TOKEN.encode():
    _kind = "d" if 0x30 <= _c <= 0x39 else "F" if 0x41 <= _c <= 0x46 else "L" if 0x47 <= _c <= 0x5A else "f" if 0x61 <= _c <= 0x66 else "l" if 0x67 <= _c <= 0x7A else chr(_c)
    CLASS_OF[_c] = CLASSES.index(_kind)


def _classes(value: str) -> list[int]:
    """Class numbers of the characters of a value; others count as a mark."""
    found = CLASS_OF[np.frombuffer(value.encode(), np.uint8)]
    return np.where(found < 0, CLASSES.index("-"), found).tolist()


# What an ordinary token is made of: digits 1, lower case 2, capitals 4, marks 8; 16 for a capital in front alone.
_PART = np.array([1, 2, 2, 4, 4, 8, 8, 8, 8, 8, 8])


def make_of(classes: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The make of each token: which parts it has, and whether a capital stands in front only."""
    if not len(starts):
        return np.zeros(0, np.int64)
    ends = starts + lengths
    edges = np.stack([starts, ends], axis=1).ravel()
    parts = np.concatenate([_PART[classes], [0]])
    has = np.bitwise_or.reduceat(parts, edges)[::2]
    capitals = np.concatenate([[0], np.cumsum(parts[:-1] == 4)])
    alone = (capitals[ends] - capitals[starts] == 1) & (parts[starts] == 4)
    return has + 16 * alone


def published() -> list[tuple[str, str]]:
    """``(format, value)`` of the published formats: values by rule, from digests of their numbers."""
    out = []
    for name, (prefix, alphabet, size) in FORMATS.items():
        for i in range(SAMPLE_STRINGS):
            number = int.from_bytes(b"".join(hashlib.sha512(f"{name}:{i}:{k}".encode()).digest() for k in range(2)), "big")
            value = ""
            for _ in range(size):
                number, place = divmod(number, len(alphabet))
                value += alphabet[place]
            out.append((name, prefix + value))
    return out


class Automaton:
    """A deterministic probabilistic automaton merged from the prefix tree of ``values``."""

    ALPHABET = len(CLASSES) + 1  # classes and the end, for smoothing

    def __init__(self, values: list[str], alpha: float = 0.05):
        self.visits, self.ends, self.next, self.counts = [0], [0], [{}], [{}]
        for value in values:
            state = 0
            self.visits[0] += 1
            for c in _classes(value):
                self.counts[state][c] = self.counts[state].get(c, 0) + 1
                if c not in self.next[state]:
                    self.next[state][c] = len(self.next)
                    for column, empty in ((self.visits, 0), (self.ends, 0), (self.next, {}), (self.counts, {})):
                        column.append(dict(empty) if isinstance(empty, dict) else empty)
                state = self.next[state][c]
                self.visits[state] += 1
            self.ends[state] += 1
        self._merge(alpha)

    def _differ(self, a: int, n: int, b: int, m: int, alpha: float) -> bool:
        if not n or not m:
            return False
        return abs(a / n - b / m) > math.sqrt(0.5 * math.log(2 / alpha)) * (1 / math.sqrt(n) + 1 / math.sqrt(m))

    def _compatible(self, red: int, blue: int, alpha: float) -> bool:
        stack = [(red, blue)]
        while stack:
            p, q = stack.pop()
            if self._differ(self.ends[p], self.visits[p], self.ends[q], self.visits[q], alpha):
                return False
            for c in self.counts[p].keys() | self.counts[q].keys():
                if self._differ(self.counts[p].get(c, 0), self.visits[p], self.counts[q].get(c, 0), self.visits[q], alpha):
                    return False
                if c in self.next[p] and c in self.next[q]:
                    stack.append((self.next[p][c], self.next[q][c]))
        return True

    def _fold(self, red: int, blue: int) -> None:
        """Add the tree below ``blue`` to ``red``."""
        stack = [(red, blue)]
        while stack:
            p, q = stack.pop()
            self.visits[p] += self.visits[q]
            self.ends[p] += self.ends[q]
            for c, n in self.counts[q].items():
                self.counts[p][c] = self.counts[p].get(c, 0) + n
                if c in self.next[p]:
                    stack.append((self.next[p][c], self.next[q][c]))
                else:
                    self.next[p][c] = self.next[q][c]

    def _merge(self, alpha: float) -> None:
        red = [0]
        while True:
            blue = sorted({(s, p, c) for p in red for c, s in self.next[p].items() if s not in red}, key=lambda x: (-self.visits[x[0]], x[0]))
            if not blue:
                return
            state, parent, c = blue[0]
            for r in red:
                if self._compatible(r, state, alpha):
                    self.next[parent][c] = r
                    self._fold(r, state)
                    break
            else:
                red.append(state)

    def compiled(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Log likelihood and next state by (state, class), and log likelihood of ending; unseen steps cost the
        smoothing and stay in place. Only states that can be reached count."""
        reached, place = [0], {0: 0}
        for p in reached:
            for q in self.next[p].values():
                if q not in place:
                    place[q] = len(reached)
                    reached.append(q)
        step = np.zeros((len(reached), len(CLASSES)))
        to = np.zeros((len(reached), len(CLASSES)), np.int32)
        end = np.zeros(len(reached))
        for i, p in enumerate(reached):
            below = self.visits[p] + 0.1 * self.ALPHABET
            for c in range(len(CLASSES)):
                step[i, c] = math.log((self.counts[p].get(c, 0) + 0.1) / below)
                to[i, c] = place[self.next[p].get(c, p)]
            end[i] = math.log((self.ends[p] + 0.1) / below)
        return step, to, end

    def likelihood(self, value: str) -> float:
        """Log-likelihood per character, the end included."""
        step, to, end = self.compiled()
        state, total = 0, 0.0
        for c in _classes(value):
            total += step[state, c]
            state = to[state, c]
        return (total + end[state]) / (len(value) + 1)


def likelihoods(machine: tuple, classes: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The likelihood per character of many tokens at once, a character of each at a time, the long ones first."""
    step, to, end = machine
    order = np.argsort(-lengths, kind="stable")
    starts, sizes = starts[order], lengths[order]
    total, state = np.zeros(len(order)), np.zeros(len(order), np.int32)
    alive = len(order) - np.searchsorted(sizes[::-1], np.arange(sizes[0] if len(sizes) else 0), "right")
    for t, n in enumerate(alive.tolist()):
        c = classes[starts[:n] + t]
        now = state[:n]
        total[:n] += step[now, c]
        state[:n] = to[now, c]
    out = np.empty(len(order))
    out[order] = (total + end[state]) / (sizes + 1)
    return out


def candidates(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All candidates of some texts: the class of every byte, and each candidate's first byte, length and row."""
    data, offsets = texts(column)
    classes = CLASS_OF[data].astype(np.int64)
    starts, ends, rows = spans(classes >= 0, offsets)
    trim = np.isin(data, np.frombuffer(TRIM, np.uint8))
    # The next byte from each place that is kept, and the last one before.
    n = len(data)
    places = np.arange(n)
    ahead = np.minimum.accumulate(np.where(trim, n, places)[::-1])[::-1] if n else places
    behind = np.maximum.accumulate(np.where(trim, -1, places)) if n else places
    if len(starts):
        starts, ends = ahead[starts], behind[ends - 1] + 1
    keep = ends - starts >= LEAST
    return classes, starts[keep], (ends - starts)[keep], rows[keep]


def labelled(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """A small labelled table ``(kind, value)`` from a bounded sample of documents: credentials by pattern, ordinary long tokens as ``other``."""
    n = row_count(docs)
    share = min(1.0, SAMPLE_DOCS / max(n, 1))
    chosen = docs.where(F.pmod(F.xxhash64(key, F.lit(13)), F.lit(1 << 30)) < int(share * (1 << 30))).select(text)

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text):
                kinds, values = [], []
                column = part.column(text)
                plain = [v or "" for v in column.to_pylist()]
                taken = [base_spans(v) for v in plain]
                for value, found in zip(plain, taken):
                    kinds += [KINDS[s[1]] for s in found]
                    values += base_values(value, found)
                classes, starts, lengths, rows = candidates(column)
                free = ~_covered(column, starts, starts + lengths, rows, taken)
                starts, lengths = starts[free], lengths[free]
                data, _ = texts(column)
                kinds += [f"plain {m}" for m in make_of(classes, starts, lengths).tolist()]
                values += [data[a:a + n].tobytes().decode() for a, n in zip(starts.tolist(), lengths.tolist())]
                yield pa.RecordBatch.from_arrays([pa.array(kinds, pa.string()), pa.array(values, pa.string())], ["kind", "value"])

    return chosen.mapInArrow(pick, "kind string, value string").distinct()


def train(table: DataFrame) -> dict[str, Automaton]:
    """One automaton per kind, from the ``SAMPLE_STRINGS`` values of a kind that hash lowest (four times as many ordinary ones), and one per published format.
    Kinds of ordinary tokens (at most 32 of them) are named ``plain`` and their make."""
    order = Window.partitionBy("kind").orderBy(F.xxhash64("value"), "value")
    rows = table.withColumn("_r", F.row_number().over(order)).where(F.col("_r") <= F.when(F.col("kind").startswith("plain"), 4 * SAMPLE_STRINGS).otherwise(SAMPLE_STRINGS)).select("kind", "value").collect()
    found: dict[str, list[str]] = {}
    for kind, value in sorted(map(tuple, rows)) + [(f"format {k}", v) for k, v in published()]:
        found.setdefault(kind, []).append(value)
    return {kind: Automaton(values) for kind, values in found.items()}


def _covered(column: pa.Array, starts: np.ndarray, ends: np.ndarray, rows: np.ndarray, taken: list) -> np.ndarray:
    """Which byte ranges touch a base span of their row; base spans are in code points."""
    out = np.zeros(len(starts), bool)
    data, offsets = texts(column)
    for row in np.unique(rows).tolist():
        if taken[row]:
            lead = np.append(np.flatnonzero((data[offsets[row]:offsets[row + 1]] & 0xC0) != 0x80), offsets[row + 1] - offsets[row]) + offsets[row]
            mine = np.flatnonzero(rows == row)
            low = np.array([lead[a] for a, _, _ in taken[row]])
            high = np.maximum.accumulate([lead[b] for _, _, b in taken[row]])
            last = np.searchsorted(low, ends[mine], "left") - 1
            out[mine] = (last >= 0) & (high[np.maximum(last, 0)] > starts[mine])
    return out


def extra_spans(column: pa.Array, taken: list[list[tuple[int, int, int]]], machines: dict[str, tuple]) -> list[list[tuple[int, int, str]]]:
    """Per text the ``(start, end, kind)`` of candidates that look like a credential: the best format well above ordinary tokens
    of the same make, or above all of them where that make was not seen; code points."""
    out: list[list] = [[] for _ in taken]
    classes, starts, lengths, rows = candidates(column)
    plain = {k: m for k, m in machines.items() if k.startswith("plain ")}
    if not len(starts) or not plain:
        return out
    best = np.max([likelihoods(m, classes, starts, lengths) for k, m in machines.items() if k not in plain], axis=0)
    make, usual = make_of(classes, starts, lengths), np.full(len(starts), -np.inf)
    known = np.zeros(len(starts), bool)
    for kind, machine in plain.items():
        mine = np.flatnonzero(make == int(kind.split()[1]))
        known[mine] = True
        usual[mine] = likelihoods(machine, classes, starts[mine], lengths[mine])
    rest = np.flatnonzero(~known)
    for machine in plain.values() if len(rest) else ():
        usual[rest] = np.maximum(usual[rest], likelihoods(machine, classes, starts[rest], lengths[rest]))
    above = best - usual
    some = np.flatnonzero((above > MARGIN) & (above * (lengths + 1) > EVIDENCE))
    some = some[~_covered(column, starts[some], starts[some] + lengths[some], rows[some], taken)]
    data, offsets = texts(column)
    for i in some.tolist():
        row = int(rows[i])
        before = int(((data[offsets[row]:starts[i]] & 0xC0) != 0x80).sum())
        out[row].append((before, before + int(lengths[i]), "format"))
    return out


def scan(docs: DataFrame, automata: dict[str, Automaton], key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, n_assign, n_access, n_hex, base_sha256, spans, n_format)`` for each row; counts are of base spans.

    Null and empty texts have no spans. Rows are independent: repeats give equal results.
    """
    docs = docs.select(key, text)
    machines = {kind: automaton.compiled() for kind, automaton in automata.items()}

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text):
                counts, digests, joint, formats = [], [], [], []
                taken = [base_spans(value or "") for value in part.column(text).to_pylist()]
                for base, extra in zip(taken, extra_spans(part.column(text), taken, machines)):
                    counts.append([sum(1 for s in base if s[1] == k) for k in range(3)])
                    joined = ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in base)
                    digests.append(hashlib.sha256(joined.encode()).hexdigest())
                    both = sorted([(a, k, b, KINDS[k]) for a, k, b in base] + [(a, len(KINDS), b, kind) for a, b, kind in extra])
                    joint.append(",".join(f"{kind}:{a}:{b}" for a, _, b, kind in both))
                    formats.append(len(extra))
                counts = np.array(counts, np.int64).reshape(-1, 3)
                yield pa.RecordBatch.from_arrays(
                    [part.column(key), *(pa.array(counts[:, i]) for i in range(3)), pa.array(digests, pa.string()), pa.array(joint, pa.string()), pa.array(formats, pa.int64())],
                    [key, "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_format"])

    long = T.LongType()
    return docs.mapInArrow(scanned, T.StructType([docs.schema[key], *(T.StructField(f"n_{k}", long) for k in KINDS), T.StructField("base_sha256", T.StringType()),
                                                 T.StructField("spans", T.StringType()), T.StructField("n_format", long)]))
