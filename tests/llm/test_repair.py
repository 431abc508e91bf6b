"""Conversation repair against an exhaustive search, and against SQL."""

import hashlib
import itertools
import random
import re

import odd  # noqa: F401  (the folder of these tests is on the path)
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

import compare
from footfall.llm import catalog, conversation_repair, oracles
from footfall.llm.conversation_repair import FINISH, Program, Row

SF = "/root/testdata/sf0.001"
SCHEMA = "conv_id long, turn long, role string, text string, extra string, ck string, pos int"
LEGAL = re.compile(r"(s?(ua)+)?")


def search(rows):
    """Cheapest edits of (initial, forced, truncated) rows by trying all, with up to two inserts at each place."""
    best = None
    own = [[("D", "", 2)] if f else [("D", "", 2), ("K", i or "?", 5 * t), ("R", "u", 1 + 5 * t), ("R", "a", 1 + 5 * t)] for i, f, t in rows]
    inserts = [("I" * k, "".join(x), 5 * k) for k in range(3) for x in itertools.product("ua", repeat=k)]

    def go(at, audit, roles, cost):
        nonlocal best
        if best is not None and cost > best[0]:
            return
        if at == len(own):
            for a, r, c in inserts:
                if LEGAL.fullmatch(roles + r) and (best is None or (cost + c, audit + a) < best[:2]):
                    best = (cost + c, audit + a, roles + r)
            return
        for (a, r, c), (a2, r2, c2) in itertools.product(inserts, own[at]):
            if re.fullmatch(r"s?(ua)*u?", roles + r + r2):
                go(at + 1, audit + a + a2, roles + r + r2, cost + c + c2)

    go(0, "", "", 0)
    return best


row = st.tuples(st.sampled_from(["s", "u", "a", "t", ""]), st.booleans(), st.booleans())


@settings(max_examples=250, deadline=None)
@given(st.lists(row, max_size=4), st.integers(1, 3))
def test_program_equals_search(rows, step):
    program = Program([Row(i, f, t, 1) for i, f, t in rows], list(FINISH))
    if rows:
        found, state = program.walk(0, True)
        cost, audit, roles = search(rows)
        assert "".join(found)[::2] == audit and state in (0, 3)
        assert min(program.kept[0][:1]) == cost


def test_checkpoints_are_few():
    program = Program([Row("u", False, False, 1)] * 400, list(FINISH))
    assert len(program.kept) <= 22
    assert "".join(program.walk(0, True)[0])[::2] == search([("u", False, False)] * 4)[1] * 100


def plain(rows):
    """Per conversation: the counts, the audit and the hash, by the program run over the whole list."""
    found = {}
    for conv in {r[0] for r in rows}:
        own = [(t, " " if r is None else r, " " if x is None else x) for c, t, r, x in (r[:4] for r in rows) if c == conv]
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        seen, faults = set(), []
        for _, role, text in own:
            stripped = text.strip(" \t\n\x0b\x0c\r")
            faults.append("blank" if not stripped else "duplicate" if (role, text) in seen else "" if stripped[-1] in ".!?" else "truncated")
            seen.add((role, text))
        program = Program([Row(r[1][:1], f in ("blank", "duplicate"), f == "truncated", 1) for r, f in zip(own, faults)], list(FINISH))
        walk = program.walk(0, True)[0]
        lines = []
        for (_, role, text), moves in zip(own, walk):
            for edit, to in zip(moves[::2], moves[1::2]):
                if edit != "D":
                    lines.append({"u": "user", "a": "assistant", "=": role}[to] + ":" + ("" if edit == "I" else text))
        turns = [r[0] for r in own if r[0] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(own, own[1:]))
        counts = [faults.count(f) for f in ("blank", "duplicate", "truncated")]
        sha = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        found[conv] = (gaps, *counts, illegal, program.kept[0][0], "".join(walk)[::2], sha)
    return found


def digests(spark, rows):
    docs = spark.createDataFrame([(*r, "x", "y", 1) for r in rows], SCHEMA)
    return {r[0]: tuple(r)[1:] for r in conversation_repair.summary(docs, conversation_repair.edits(docs)).collect()}


def conversations(seed, n, longest):
    rng = random.Random(seed)
    texts = ["Hello there.", "cut off", "  ", "", "Fine!\n", "why?", None, "a. b", "ends \x0b.\t"]
    rows = []
    for conv in range(n):
        for turn in range(rng.randrange(1, longest)):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None])
            text = rng.choice(texts) if rng.random() < 0.5 else f"text {rng.randrange(40)}."
            turn = rng.choice([turn, turn, turn, turn + 3, None])
            rows += [(conv if conv else None, turn, role, text)] * rng.choice([1, 1, 1, 2])
    rng.shuffle(rows)
    return rows


def test_repair_equals_plain(spark):
    rows = conversations(3, 40, 9)
    assert digests(spark, rows) == plain(rows)


def test_long_conversations_lie_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(conversation_repair, "PIECE_BITS", 2)
    monkeypatch.setattr(conversation_repair, "COPIES", 3)
    rows = conversations(4, 4, 120) + [(2, 7, "user", "the same again.")] * 20
    assert digests(spark, rows) == plain(rows)


def test_repaired_rows(spark):
    rows = [(1, 0, "assistant", "First."), (1, 1, "user", "Then."), (1, 2, "user", ""), (2, None, None, None)]
    docs = spark.createDataFrame([(*r, "x", "y", 1) for r in rows], SCHEMA)
    found = conversation_repair.repaired(docs).orderBy("conv_id", "pos", "step").collect()
    assert [(r.conv_id, r.edit, r.role, r.text) for r in found] == [(1, "R", "user", "First."), (1, "R", "assistant", "Then.")]
    assert conversation_repair.edits(docs.filter("false")).collect() == []
    assert conversation_repair.summary(docs.filter("false"), conversation_repair.edits(docs.filter("false"))).collect() == []


def test_conversation_without_rows(spark):
    docs = spark.createDataFrame([(5, 1, "user", "x."), (None, 1, "user", "x.")], "conv_id long, turn long, role string, text string")
    found = conversation_repair.summary(docs, conversation_repair.edits(docs.filter("false"))).collect()
    assert {tuple(r) for r in found} == {(c, 0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest()) for c in (5, None)}


@pytest.mark.parametrize("sf", [SF, "/root/testdata/sf0.01"])
def test_query_equals_sql(spark, sf):
    name = "op12_conversation_repair"
    assert compare.differences(catalog.QUERIES[name](spark, sf), compare.oracle(sf), oracles.SQL[name]) == []
