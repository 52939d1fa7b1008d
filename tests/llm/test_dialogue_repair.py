"""Repair of conversations against a search over all edits, and edge cases."""

from __future__ import annotations

import hashlib
import heapq
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from creditloom.llm import dialogue_repair as repair

ROWS = "conv_id long, turn long, role string, text string"
SPACE = " \t\n\x0b\x0c\r"


def faults(rows):
    seen, out = set(), []
    for role, text in rows:
        body = text.rstrip(SPACE)
        if not body:
            out.append("b")
        elif (role, text) in seen:
            out.append("d")
        else:
            out.append("" if body[-1] in ".!?" else "t")
        seen.add((role, text))
    return out


def cheapest(rows):
    """The least (cost, audit) over all edit sequences, by a search that knows no suffixes."""
    marks = faults(rows)
    heap, done = [(0, "", 0, "")], set()
    while heap:
        cost, audit, at, roles = heapq.heappop(heap)
        if at == len(rows) and re.fullmatch("(s?(ua)+)?", roles):
            return cost, audit
        last = roles[-2:] if len(roles) > 1 else roles
        if (at, last) in done:
            continue
        done.add((at, last))
        legal = [r for r in "sua" if re.fullmatch("s?(ua)*u?", roles + r)]
        for r in legal:
            if r != "s" and len(roles) < 2 * len(rows) + 4:
                heapq.heappush(heap, (cost + 5, audit + "I", at, roles + r))
        if at < len(rows):
            heapq.heappush(heap, (cost + 2, audit + "D", at + 1, roles))
            if marks[at] in ("", "t"):
                more = 5 if marks[at] else 0
                for r in legal:
                    if rows[at][0][:1] == r:
                        heapq.heappush(heap, (cost + more, audit + "K", at + 1, roles + r))
                    if r != "s":
                        heapq.heappush(heap, (cost + more + 1, audit + "R", at + 1, roles + r))
    raise AssertionError("no repair")


def plain(rows):
    """All columns of the contract of one conversation's (turn, role, text) rows in order."""
    turns = [t for t, _, _ in rows if t is not None]
    pairs = [(role, text) for _, role, text in rows]
    marks = faults(pairs)
    cost, audit = cheapest(pairs)
    messages, at = [], 0
    roles = ""
    for letter in audit:
        role, text = ("", "") if letter == "I" else pairs[at]
        at += letter != "I"
        if letter == "D":
            continue
        want = "assistant" if roles.endswith("u") else "user"
        role = role if letter == "K" else want
        roles += role[0]
        messages.append(f"{role}:{text}")
    starts = [role[:1] for role, _ in pairs]
    return (
        max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
        marks.count("b"),
        marks.count("d"),
        marks.count("t"),
        sum(a + b not in ("su", "ua", "au") for a, b in zip(starts, starts[1:])),
        cost,
        audit,
        hashlib.sha256("\n".join(messages).encode()).hexdigest(),
    )


COLUMNS = "gaps blank duplicate truncated illegal cost audit repaired_sha256".split()


def judged(spark, rows, conversations=None):
    df = spark.createDataFrame(rows, ROWS)
    verdict = repair.judge(df, conversations)
    hashes = repair.digests(df, verdict).withColumnRenamed("conv_id", "its")
    both = verdict.join(hashes, verdict.conv_id.eqNullSafe(hashes.its))
    return {r.conv_id: tuple(r[c] for c in COLUMNS) for r in both.collect()}


row = st.sampled_from(
    [(role, text) for role in ("system", "user", "assistant", "tool") for text in
     ("Yes.", "No!", "cut off", " ", "other?")]
)


def audit_of(rows):
    """The automaton's answer for one conversation."""
    kinds = {"s": 0, "u": 1, "a": 2}
    marks = {"": 0, "b": 1, "d": 2, "t": 3}
    symbols = [chr(65 + 4 * kinds.get(r[:1], 3) + marks[f]) for (r, _), f in zip(rows, faults(rows))]
    automaton = repair.Automaton()
    node, cost, path = automaton.end, 0, [automaton.end]
    for symbol in reversed(symbols):
        node, more = automaton.step(symbol, node)
        cost += more
        path.append(node)
    audit, state = "", 0
    cost += automaton.classes[node][0][0]
    for node in reversed(path):
        letter, state = automaton.classes[node][1][state]
        while letter == "I":
            audit += letter
            letter, state = automaton.classes[node][1][state]
        audit += letter
    return cost, audit


@settings(max_examples=300, deadline=None)
@given(st.lists(row, max_size=9))
def test_automaton_finds_the_cheapest_least_audit(rows):
    assert audit_of(rows) == cheapest(rows)


def test_whole_conversations_match_the_search(spark):
    import random

    draw = random.Random(3)
    talks = {
        c: sorted(
            [
                (
                    draw.choice([None, *range(9)]),
                    draw.choice(["system", "user", "assistant", "user", "assistant", "x", " "]),
                    draw.choice(["Yes.", "No!", "cut", " \n", "a. ", "what?\t", "é…"]),
                )
                for _ in range(draw.randrange(1, 12))
            ],
            key=lambda r: (r[0] is not None, r[0], r[1], hashlib.md5(r[2].encode()).hexdigest()),
        )
        for c in range(60)
    }
    rows = [(c, *r) for c, own in talks.items() for r in own]
    draw.shuffle(rows)
    assert judged(spark, rows) == {c: plain(own) for c, own in talks.items()}


def test_empty_null_and_missing_conversations(spark):
    empty = hashlib.sha256(b"").hexdigest()
    rows = [(None, None, None, None), (None, 1, "user", "Hi."), (1, 0, "", "x.")]
    ids = spark.createDataFrame([(None,), (1,), (2,), (2,)], "conv_id long")
    got = judged(spark, rows, ids)
    assert got[2] == (0, 0, 0, 0, 0, 0, "", empty)
    assert got[None] == plain([(None, " ", " "), (1, "user", "Hi.")])
    assert got[1] == plain([(0, "", "x.")])
    assert judged(spark, []) == {}


def test_rewritten_messages_are_legal_and_hash_alike(spark, clashing):
    rows = [(1, t, r, x) for t, (r, x) in enumerate(
        [("user", "Hi."), ("user", "Hi."), ("user", "And?"), ("assistant", "cut")])]
    df = clashing(spark.createDataFrame(rows, ROWS))
    verdict = repair.judge(df)
    messages = repair.rewrite(df, verdict).orderBy("conv_id", "place").collect()
    assert [(m.place, m.role, m.text, m.edit) for m in messages] == [
        (0, "user", "Hi.", "K"),
        (1, "assistant", "And?", "R"),
    ]
    said = "\n".join(f"{m.role}:{m.text}" for m in messages)
    digest = repair.digests(df, verdict).first().repaired_sha256
    assert digest == hashlib.sha256(said.encode()).hexdigest()


@pytest.mark.parametrize("n", [5000])
def test_one_very_long_conversation(spark, n):
    rows = [(7, t, "user" if t % 2 == 0 else "assistant", f"{t}.") for t in range(n)]
    got = judged(spark, rows)[7]
    assert got[:7] == (0, 0, 0, 0, 0, 0, "K" * n)
