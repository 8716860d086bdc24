"""Secrets and personal data against the patterns as they stand in the contract."""

import hashlib
import re

import numpy as np
import pyarrow as pa
import pytest
from conftest_llm import table_rows
from hypothesis import given, settings, strategies as st

from lumenfit.llm import private, queries, secrets

SECRET = [("assign", re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A), lambda m: len(m.group(2)) >= 6),
          ("access", re.compile("AKIA[A-Z0-9]+"), lambda m: len(m.group()) >= 20), ("hex", re.compile("[0-9a-f]+"), lambda m: len(m.group()) >= 24)]


def digits(m):
    return re.sub("[^0-9]", "", m.group())


def luhn(s):
    return sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(s))) % 10 == 0


PRIVATE = [("email", re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), lambda m: True),
           ("ip", re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"), lambda m: all(int(p) <= 255 for p in m.group().split("."))),
           ("card", re.compile(r"[0-9]([\x20-]?[0-9])+"), lambda m: 12 <= len(digits(m)) <= 19 and luhn(digits(m))),
           ("phone", re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"), lambda m: 9 <= len(digits(m)) <= 15)]


def spans(text, patterns):
    return sorted((m.start(), i, m.end()) for i, (_, p, ok) in enumerate(patterns) for m in p.finditer(text or "") if ok(m))


def joined(found, patterns):
    return ",".join(f"{patterns[k][0]}:{a}:{b}" for a, k, b in found)


@pytest.mark.parametrize("query, patterns", [(queries.op4_secrets, SECRET), (queries.op6_private, PRIVATE)])
def test_query_against_the_patterns(spark, query, patterns):
    sf = "/root/testdata/sf0.01"
    rows = {r["doc_id"]: r for r in query(spark, sf).collect()}
    for d in table_rows(sf, "documents"):
        found, r = spans(d["text"], patterns), rows.pop(d["doc_id"])
        assert r["base_sha256"] == hashlib.sha256(joined(found, patterns).encode()).hexdigest()
        assert [r[f"n_{p[0]}"] for p in patterns] == [sum(k == i for _, k, _ in found) for i in range(len(patterns))]
        assert set(joined(found, patterns).split(",")) - {""} <= set(r["spans"].split(","))
    assert not rows


PIECES = st.lists(st.sampled_from(["a", "@", ".", "1", "255", "256", "-", " ", "+1", "(555)", "555-0100", "4111111111111111", "x@y.zz", "1.2.3.4", "\n", "é", "@@", "00", "+"]), max_size=14)


@given(PIECES)
@settings(max_examples=400, deadline=None)
def test_private_patterns(pieces):
    text = "".join(pieces)
    assert private.base_spans(text)[0] == spans(text, PRIVATE)


@given(st.lists(st.sampled_from(["password", "token", "api_key", "APIKEY", "=", ":", " ", '"', "'", "abc123", "deadbeef", "AKIA", "ABCDEFGH12345678", "0123456789abcdef01234567", "K", "-"]), max_size=12))
@settings(max_examples=400, deadline=None)
def test_secret_patterns(pieces):
    text = "".join(pieces)
    assert secrets.base_spans(text) == spans(text, SECRET)


def test_messy_rows(messy, empty):
    for module in (secrets, private):
        model = module.train(module.labelled(messy))
        assert module.scan(messy, model).count() == messy.count()
        assert {r["spans"] for r in module.scan(messy.where("text is null or text = ''"), model).collect()} == {""}
        model = module.train(module.labelled(empty))
        assert module.scan(empty, model).count() == 0


def test_long_runs_stay_linear():
    for text in ("a" * 300_000, "1" * 300_000, "@" * 50_000, "+1" + " " * 200_000, "password" + " " * 200_000, "1." * 100_000):
        private.base_spans(text)
        secrets.base_spans(text)
        private.chains(text)


def test_automata_tell_formats_apart():
    rng = np.random.default_rng(3)
    keys = ["".join(rng.choice(list("0123456789abcdef"), 32)) for _ in range(150)]
    plain = {"plain 2": ["".join(rng.choice(list("etaoinshrdlu"), 18)) for _ in range(150)], "plain 1": ["".join(rng.choice(list("0123456789"), 16)) for _ in range(150)]}
    automata = {"hex": secrets.Automaton(keys)} | {k: secrets.Automaton(v) for k, v in plain.items()}
    assert len(automata["hex"].next) > 0
    new = "".join(rng.choice(list("0123456789abcdef"), 22))  # too short for the pattern
    text = f"see 4532015112830366 and {new} or internationalization"
    (found,) = secrets.extra_spans(pa.array([text]), [[]], {k: a.compiled() for k, a in automata.items()})
    assert [text[a:b] for a, b, _ in found] == [new]


def test_field_finds_what_the_patterns_lose(spark):
    """A number that swallows its neighbour fails its check; the field splits the two."""
    cards = [c for c in (str(4532015112830000 + i * 7) for i in range(2000)) if private.luhn(c)]
    train = [(i, f"word +1 ({200 + i}) 555-{1000 + i} word {cards[i]} and x{i}@mail.example.com or 10.0.0.{i} end 2.0 v{i}", "a") for i in range(200)]
    docs = spark.createDataFrame(train, "doc_id long, text string, source string")
    field = private.train(private.labelled(docs))
    text = "call +1 (269) 555-3296 4532015112830366 now"
    assert spans(text, PRIVATE) == []
    row = private.scan(spark.createDataFrame([(1, text)], "doc_id long, text string"), field).first()
    assert row["n_crf"] == 2 and "crf_phone:5:22" in row["spans"] and "crf_card:23:39" in row["spans"]


def test_viterbi_against_all_paths():
    rng = np.random.default_rng(2)
    field = private.Field()
    field.emit, field.move = rng.normal(size=field.emit.shape), rng.normal(size=field.move.shape)
    groups = [rng.integers(0, private.SHAPES, (n, 5)) for n in (1, 2, 4, 3)]
    for group, got in zip(groups, field.decode(groups)):
        scores = field.emit[group].sum(1)
        paths = np.stack(np.meshgrid(*[range(private.TAGS)] * len(group), indexing="ij"), -1).reshape(-1, len(group))
        total = scores[np.arange(len(group)), paths].sum(1) + field.move[paths[:, :-1], paths[:, 1:]].sum(1)
        assert got.tolist() == paths[total.argmax()].tolist()


def test_every_valid_place_of_a_run():
    """Neighbours of one kind in one tagged run, and places beyond any prefix of it."""
    cards = "4111 1111 1111 1111 5500 0000 0000 0004"
    many = " ".join([cards] * 20)
    phones = " ".join(f"+1 (269) 555-{1000 + i}" for i in range(30))
    hosts = ", ".join(f"user{i}@host{i}" for i in range(60))
    ips = ",".join(f"10.0.{i}.300,10.0.{i}.7" for i in range(60))
    for kind, text, want in [(3, cards, [cards[:19], cards[20:]]), (3, many, [cards[:19], cards[20:]] * 20), (4, phones, [f"+1 (269) 555-{1000 + i}" for i in range(30)]),
                             (4, "+1 (269) 555-3296 4532015112830366", ["+1 (269) 555-3296"]), (1, hosts, [f"user{i}@host{i}" for i in range(60)]),
                             (1, "x" * 300 + "@mail", ["x" * 300 + "@mail"]), (3, "1234 1234", [])]:
        assert spans(text, PRIVATE) == [] or kind == 4
        chain = private.chains(text)
        got = private.extra_spans(text, [], chain, [np.full(len(c), kind) for c in chain])
        assert [text[a:b] for a, b, _ in got] == want
    chain = private.chains(ips)
    got = [ips[a:b] for a, b, _ in private.extra_spans(ips, [], chain, [np.full(len(c), 2) for c in chain])]
    assert [v for v in got if v.endswith(".7")] == [f"10.0.{i}.7" for i in range(60)]
    first = [(0, 2, 19)]
    assert [cards[a:b] for a, b, _ in private.extra_spans(cards, first, private.chains(cards), [np.full(8, 3)])] == [cards[20:]]
    assert private.shape("1." * 20 + "@") != private.shape("1." * 20 + "x")
    for text, kind in (("1 " * 200_000, 3), ("1.1" * 100_000, 2), ("+1 " * 100_000, 4), ("a@" * 100_000, 1)):
        chain = private.chains(text)
        private.extra_spans(text, [], chain, [np.full(len(c), kind) for c in chain])


PLANTED = {"hex": ("", "0123456789abcdef", 22), "HEX": ("", "0123456789ABCDEF", 40), "session": ("ASIA", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", 16), "ghp": ("ghp_", secrets.BASE62, 36),
           "live": ("sk-live-", secrets.BASE62, 28), "random": ("", secrets.BASE62, 40), "project": ("glpat-", secrets.BASE62, 20), "encoded": ("", secrets.BASE62 + "+/", 44)}


@pytest.fixture(scope="module")
def automata(spark):
    return secrets.train(secrets.labelled(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")))


def test_planted_credentials_are_found_and_words_left_alone(spark, automata):
    import random

    rng, rows = random.Random(4), []
    words = [w for d in table_rows("/root/testdata/sf0.01", "documents")[:200] for w in d["text"].split()[:40]]
    for name, (prefix, alphabet, n) in PLANTED.items():
        for i in range(60):
            value = prefix + "".join(rng.choice(alphabet) for _ in range(n))
            rows.append((len(rows), " ".join(rng.sample(words, 12)) + f" é «{value}» " + " ".join(rng.sample(words, 12)), name, value))
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    found = {r["doc_id"]: r["spans"] for r in secrets.scan(docs, automata).collect()}
    hits, false = {}, 0
    for key, text, name, value in rows:
        start = text.index(value)
        spans = [tuple(map(int, s.split(":")[1:])) for s in found[key].split(",") if s]
        hits[name] = hits.get(name, 0) + any(a < start + len(value) and start < b for a, b in spans)
        false += sum(not (a < start + len(value) and start < b) for a, b in spans)
    assert sum(hits.values()) >= 0.9 * len(rows) and min(hits.values()) >= 0.75 * 60, hits
    assert false <= 0.02 * len(rows)


def test_added_spans_against_a_walk_of_every_candidate(automata):
    """Likelihoods, makes, places and overlaps, one candidate at a time."""
    texts = ["ghp_0aZ9bY8cX7dW6eV5fU4gT3hS2iR1jQ0kP9lO and ünd Wörter 0123456789abcdef0123", "password=abc12345xyz 9aF3kLm0QzX7vB2nR8tY4wE6uI1oP5sD", None, "", "--..//", "plainwords Only HERE and Zz9Yy8Xx7Ww6Vv5Uu4Tt3Ss2"]
    column = pa.array(texts, pa.string())
    taken = [secrets.base_spans(t or "") for t in texts]
    machines = {k: a.compiled() for k, a in automata.items()}
    wanted = []
    for text, base in zip(texts, taken):
        mine = []
        for m in re.finditer(r"[A-Za-z0-9+/_=.-]+", text or ""):
            a, b = m.span()
            while a < b and text[a] in ".-/":
                a += 1
            while b > a and text[b - 1] in ".-/":
                b -= 1
            value = text[a:b]
            if len(value) < secrets.LEAST or any(x < b and a < y for x, _, y in base):
                continue
            capitals = [c.isupper() for c in value]
            make = sum(n * any(f) for n, f in ((1, [c.isdigit() for c in value]), (2, [c.islower() for c in value]), (4, capitals), (8, [not c.isalnum() for c in value])))
            make += 16 * (sum(capitals) == 1 and capitals[0])
            plain = [k for k in automata if k.startswith("plain ")]
            same = [k for k in plain if k == f"plain {make}"] or plain
            above = max(automata[k].likelihood(value) for k in automata if k not in plain) - max(automata[k].likelihood(value) for k in same)
            if above > secrets.MARGIN and above * (len(value) + 1) > secrets.EVIDENCE:
                mine.append((a, b, "format"))
        wanted.append(mine)
    assert secrets.extra_spans(column, taken, machines) == wanted and sum(map(len, wanted)) >= 3
