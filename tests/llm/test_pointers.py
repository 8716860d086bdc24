import random
import re

import pyarrow as pa
from conftest_llm import LOWER
from hypothesis import given, settings, strategies as st

from lumenfit.llm.common import ALNUM
from lumenfit.llm.pointers import Pointers, shards

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def found(texts):
    p = Pointers(pa.array(texts, pa.string()), ALNUM)
    words = p.words().to_pylist()
    assert [w.encode() for w in words] == sorted({w.encode() for w in words})
    return [(words[i], int(r)) for i, r in zip(p.word, p.rows)]


def brute(texts):
    return sorted(((w, i) for i, t in enumerate(texts) for w in TERM.findall((t or "").translate(LOWER))), key=lambda x: (x[0].encode(), x[1]))


def test_long_words_with_common_starts():
    rng = random.Random(1)
    stems = ["a" * 8, "a" * 16, "a" * 17, "abcdefgh", "abcdefghi", "é" * 9, "x" * 3000, "x" * 3001, "Q" * 8]
    texts = [" ".join(rng.choices(stems, k=40)) for _ in range(30)] + [None, "", " . "]
    assert found(texts) == brute(texts)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="aAbß9 .\U0001d400", max_size=60)), max_size=6))
def test_any_texts(texts):
    assert found(texts) == brute(texts)


def test_shards_hold_whole_rows():
    batches = [pa.RecordBatch.from_arrays([pa.array(["x" * n for n in sizes])], ["t"]) for sizes in ([10, 200, 5], [90, 0, 20], [])]
    parts = [[len(x) for x in b.column("t").to_pylist()] for b in shards(iter(batches), "t", 100)]
    assert sum(parts, []) == [10, 200, 5, 90, 0, 20] and all(sum(p) <= 100 or len(p) == 1 for p in parts)


def test_word_hashes_tell_words_apart():
    """Thue-Morse words and their complements collide under every polynomial modulo 2^64; equal words agree anywhere."""
    from lumenfit.llm.common import texts, words

    morse = "".join("ab"[bin(i).count("1") % 2] for i in range(1024))
    pieces = [morse, morse.translate(str.maketrans("ab", "ba")), morse[:512], "a", "A", "aa", "a" * 8, "a" * 9, "a" * 16, "x" * 5000, "X" * 5000, "x" * 5001]
    data, offsets = texts(pa.array([" ".join(pieces), *pieces]))
    _, _, rows, hashes = words(data, offsets, ALNUM)
    assert hashes[rows == 0].tolist() == hashes[rows > 0].tolist()
    assert len(set(hashes.tolist())) == len({p.lower() for p in pieces})
