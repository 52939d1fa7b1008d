from __future__ import annotations

import hashlib
import random

from hypothesis import given, settings
from hypothesis import strategies as st

from creditloom.llm import fuzzy_hash


def plain_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        above, row = row, [i + 1]
        for j, y in enumerate(b):
            row.append(min(row[-1] + 1, above[j + 1] + 1, above[j] + (x != y)))
    return row[-1]


@settings(deadline=None)
@given(st.text("abcd", max_size=70), st.text("abcd", max_size=70))
def test_edit_distance(a, b):
    assert fuzzy_hash.edit_distance(a, b) == plain_distance(a, b)


@settings(deadline=None, max_examples=60)
@given(st.text(max_size=40), st.integers(0, 60))
def test_signatures(text, times):
    mark = fuzzy_hash.fingerprint(text * times)
    block, *signatures = mark.split(":")
    assert mark == fuzzy_hash.fingerprint(text * times)
    assert int(block) % 3 == 0 and all(len(s) <= fuzzy_hash.LETTERS for s in signatures)
    assert fuzzy_hash.likeness(mark, mark) == 1.0


def prose(rng, size):
    return " ".join("".join(rng.choice("etaoinshr") for _ in range(rng.randrange(2, 9))) for _ in range(size))


def test_likeness_follows_edits():
    rng = random.Random(6)
    for size in (40, 200, 3000):
        one, other = prose(rng, size), prose(rng, size)
        mark = fuzzy_hash.fingerprint(one)
        changed = fuzzy_hash.fingerprint(one.replace(one[size : size + 5], "edited", 1))
        half = fuzzy_hash.fingerprint(fuzzy_hash.edited_text(one, other))
        assert 0.6 < fuzzy_hash.likeness(mark, changed) <= 1
        assert 0.25 < fuzzy_hash.likeness(mark, half) < 0.8
        assert fuzzy_hash.likeness(mark, fuzzy_hash.fingerprint(other)) == 0.0
        assert fuzzy_hash.likeness(mark, half) == fuzzy_hash.likeness(half, mark)


def test_every_document_meets_the_next(spark, documents, clashing):
    rng = random.Random(8)
    rows = [(rng.randrange(400), prose(rng, rng.randrange(1, 80)), "s") for _ in range(150)]
    rows += [(500, None, "s"), (501, "", "s"), (None, "no id", "s"), (502, "é漢" * 9, "s"), (502, "é漢" * 9, "s"),
             (503, prose(rng, 20_000), "s")]
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, (r[1] or "").encode()))
    want = []
    for (doc, text, _), (_, following, _) in zip(order, [*order[1:], order[0]]):
        text, following = text or "", following or ""
        edited = fuzzy_hash.edited_text(text, following)
        marks = [fuzzy_hash.fingerprint(t) for t in (text, edited, following)]
        want.append((doc, len(text), hashlib.sha256(edited.encode()).hexdigest(), marks[0], marks[1],
                     fuzzy_hash.likeness(marks[0], marks[1]), fuzzy_hash.likeness(marks[0], marks[2])))
    df = clashing(documents(rows)).repartition(7)
    got = [tuple(r) for r in fuzzy_hash.fingerprints(df).select(*fuzzy_hash.SCHEMA.names).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_one_and_none(documents):
    assert fuzzy_hash.fingerprints(documents([])).collect() == []
    (only,) = fuzzy_hash.fingerprints(documents(["abcdef"])).collect()
    assert only.edited_sha256 == hashlib.sha256(b"abcabc").hexdigest() and only.near_next == 1.0
