import itertools
import unicodedata

import numpy as np
import pyarrow as pa
import pytest
from conftest_llm import documents, table_rows

from lumenfit.llm import language, queries

LINES = {"en": "the quick brown fox jumps over the lazy dog and then it was gone with the wind", "de": "der schnelle braune fuchs springt über den faulen hund und dann war es still im wald",
         "ru": "быстрая коричневая лиса прыгает через ленивую собаку и потом стало тихо в лесу"}


@pytest.fixture(scope="module")
def model(spark):
    rows = [(i, text, lang, "s") for i, (lang, text) in enumerate(list(LINES.items()) * 4)] + [(90, None, "xx", "s"), (91, "no language", None, "s")]
    return language.train(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string"))


def test_model(model):
    assert model.languages == ["de", "en", "ru"]
    assert np.allclose(np.exp(model.weights.astype(float)).sum(axis=1), 1, atol=1e-3)
    latin, cyrillic = list(language.SCRIPTS).index("Latin") + 1, list(language.SCRIPTS).index("Cyrillic") + 1
    assert model.candidates[latin].tolist() == [True, True, False] and model.candidates[cyrillic].tolist() == [False, False, True]


def test_words_against_characters():
    texts = ["Ein Übermut, ok", None, "", "дом-house 12 あア漢字x", "ª…—!", "हिन्दी ñandú", "𝐀b", "trailing "]
    words = language.Words.of(pa.array(texts, pa.string()))
    table, wanted = language.script_table(), []
    for row, text in enumerate(texts):
        kinds = [int(table[ord(c)]) for c in text or ""]
        at = 0
        for kind, run in itertools.groupby(kinds):
            n = len(list(run))
            if kind:
                wanted.append((row, at, at + n, kind))
            at += n
    assert list(zip(words.row.tolist(), words.start.tolist(), words.end.tolist(), words.script.tolist())) == wanted
    letters = [c for t in texts for c in t or "" if unicodedata.category(c)[0] == "L"]
    assert all(table[ord(c)] for c in letters) and not table[ord("—")] and not table[ord("7")]


def test_viterbi_against_every_path():
    rng = np.random.default_rng(3)
    sizes = [5, 0, 1, 4, 6]
    row = np.repeat(np.arange(len(sizes)), sizes)
    scores = rng.normal(size=(len(row), 3)).astype(np.float32) * 2
    found = language.viterbi(scores, row, len(sizes), 1.5)
    for r, n in enumerate(sizes):
        mine, at = scores[row == r].astype(float), found[row == r]
        value = lambda p: sum(mine[i, x] for i, x in enumerate(p)) - 1.5 * sum(a != b for a, b in zip(p, p[1:]))
        assert len(at) == n and (not n or np.isclose(value(at), max(value(p) for p in itertools.product(range(3), repeat=n))))


def test_mixed_text_is_labelled_in_spans(spark, model):
    text = f"{LINES['en']}. {LINES['de']}! {LINES['ru']}?"
    (row,) = language.label(documents(spark, [(1, text, "a")]), model).collect()
    spans = [(text[s["start"]:s["end"]], s["lang"]) for s in row["spans"]]
    assert spans == [(LINES[c], c) for c in ("en", "de", "ru")]
    letters = {c: sum(ch.isalpha() for ch in t) for c, t in LINES.items()}
    assert row["lang_pred"] == max(letters, key=letters.get) and row["score"] == pytest.approx(max(letters.values()) / sum(letters.values()))


def test_messy_rows(spark, messy, empty, model):
    rows = language.label(messy, model).collect()
    assert sorted(str(r["doc_id"]) for r in rows) == sorted(str(r["doc_id"]) for r in messy.collect())
    odd = documents(spark, [(1, None, "a"), (2, "", "a"), (3, "12 — !", "a"), (4, "ภาษาไทย", "a"), (None, LINES["de"], None), (6, "  ", "a")])
    found = {r["doc_id"]: r for r in language.label(odd, model).collect()}
    assert all((found[k]["lang_pred"], found[k]["score"], found[k]["spans"]) == ("und", 0.0, []) for k in (1, 2, 3, 6))
    assert found[4]["lang_pred"] in model.languages and found[None]["lang_pred"] == "de"
    nothing = language.train(empty)
    assert nothing.languages == [] and {r["lang_pred"] for r in language.label(messy, nothing).collect()} == {"und"}
    assert language.label(empty, model).count() == 0


def test_held_out_accuracy(spark, sf):
    truth = {r["doc_id"]: r["lang"] for r in table_rows(sf, "documents")}
    rows = queries.op13_language(spark, sf).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(truth) and all(0 <= r["score"] <= 1 for r in rows)
    held = [r for r in rows if r["held_out"]]
    assert len(held) > 30 and sum(r["lang_pred"] == truth[r["doc_id"]] for r in held) >= 0.97 * len(held)


def test_the_order_of_rows_changes_nothing(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    a, b = language.train(docs), language.train(docs.orderBy("text").repartition(5))
    assert a.languages == b.languages and np.array_equal(a.weights, b.weights) and np.array_equal(a.candidates, b.candidates)
