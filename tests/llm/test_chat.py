from collections import Counter

import pytest

import __spark_entry__ as entry
from check_oracles import compare, connection
from lumenfit.llm import chat, queries

SCHEMA = "conv_id long, turn long, role string, text string, assistant string, masks string, part string"


def turns(spark, rows):
    return spark.createDataFrame([(*r, "x", "x", "x") for r in rows], SCHEMA)


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_query_against_sql(spark, sf):
    assert compare(spark, connection(sf), sf, "op9_chat", queries.QUERIES["op9_chat"], entry.oracle_sql()["op9_chat"])[0].startswith("ok")


def test_three_participants(spark):
    rows = chat.rotate(turns(spark, [(1, 0, "ann", "hi"), (1, 1, "bob", "yo é"), (1, 2, "cyd", ""), (1, 3, "ann", "bye")])).collect()
    by = {r["assistant"]: r for r in rows}
    assert set(by) == {"ann", "bob", "cyd"}
    assert by["bob"]["text"] == "<|user name=ann|>\nhi<|end|>\n<|assistant|>\nyo é<|end|>\n<|user name=cyd|>\n<|end|>\n<|user name=ann|>\nbye<|end|>\n"
    for who, said in (("ann", ["hi<|end|>", "bye<|end|>"]), ("bob", ["yo é<|end|>"]), ("cyd", ["<|end|>"])):
        r = by[who]
        assert [r["text"][a:b] for a, b in zip(r["mask_starts"], r["mask_ends"])] == said
        assert r["n_turns"] == 4 and r["n_own"] == len(said)


def test_messy_rows(spark):
    rows = [(1, 0, None, None), (1, None, "a", "lost"), (None, 0, "a", "x"), (None, 0, "b", "y"), (2, 5, "a", "twice"), (2, 5, "a", "twice"), (3, 0, "a", "w " * 50_000)]
    out = chat.rotate(turns(spark, rows)).collect()
    assert Counter((r["conv_id"], r["assistant"]) for r in out) == {(1, ""): 2, (1, "a"): 2, (None, "a"): 1, (None, "b"): 1, (2, "a"): 1, (3, "a"): 1}
    assert next(r for r in out if r["conv_id"] == 2)["n_turns"] == 2
    assert chat.rotate(turns(spark, [])).count() == 0


def test_long_dialogues_become_parts(spark):
    rows = [(1, i, "ab"[i % 2], f"t{i}") for i in range(1000)] + [(2, 7, "a", f"same number {i}") for i in range(500)]
    out = chat.rotate(turns(spark, rows), part_turns=100).collect()
    assert max(r["n_turns"] for r in out) <= 180
    one = sorted((r for r in out if r["conv_id"] == 1 and r["assistant"] == "a"), key=lambda r: r["part"])
    assert len(one) == 10 and "".join(r["text"] for r in one).count("<|end|>") == 1000
    assert sum(r["n_turns"] for r in out if r["conv_id"] == 2) == 500


@pytest.mark.parametrize("range_rows", [50_000, 7])
def test_pieces_are_consecutive_and_bounded(spark, monkeypatch, range_rows):
    """Parts of repeated rows, null numbers and one turn many times are cut in the order of the dialogue."""
    monkeypatch.setattr(chat, "RANGE_ROWS", range_rows)
    rows = [(1, i, "ab"[i % 2], f"t{i:03}") for i in range(130)] * 2 + [(None, None, "cd"[i % 2], f"n{i * 37 % 90:03}") for i in range(90)]
    rows += [(2, 3, "a", "again")] * 130 + [(2, 3, "b", "then"), (2, 2, "b", "first"), (3, 0, "a", "x")]
    out = chat.rotate(turns(spark, rows).repartition(3), part_turns=40).collect()
    for conv in (1, 2, 3, None):
        own = [r for r in rows if r[0] == conv]
        want = [(-1 if p is None else p // 40, p, s, c) for _, p, s, c in sorted(own, key=lambda r: (-1 if r[1] is None else r[1], r[2], r[3]))]
        for who in {r[2] for r in own}:
            pieces = sorted((r for r in out if r["conv_id"] == conv and r["assistant"] == who), key=lambda r: (r["part"], r["piece"]))
            side = lambda s, c: ("<|assistant|>" if s == who else f"<|user name={s}|>") + f"\n{c}<|end|>\n"
            assert "".join(r["text"] for r in pieces) == "".join(side(s, c) for _, _, s, c in want)
            for part in {p for p, *_ in want}:
                n = sum(p == part for p, *_ in want)
                assert [r["n_turns"] for r in pieces if r["part"] == part] == [min(40, n - at) for at in range(0, n, 40)]
