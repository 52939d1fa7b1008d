from __future__ import annotations

import re

import pytest

from creditloom.llm import licenses
from creditloom.operators.keyed import KeyedPolicy

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
UP = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

TEXTS = [
    None, "", "cc by", "CC-BY cc by cc BY", "cc cc by by", "All rights reserved.", "all rights",
    "GNU General Public License, all Rights\n\nReserved; cc\tby", "ccby", "cc_by écc by ccé by",
    "general general public license public license", "Licensed under the Apache License, Version 2.0.",
    "licensed, under the new Apache license version 2.0", "Licensed under CC BY-NC 4.0", "MIT License",
    "of the to the " * 500, "filler " * 30_000 + "all rights reserved", "cc by " * 4000,
    "Released under the MIT License.", "all rights reserved", "all rights reserved",
]


def plain(text):
    words = WORD.findall((text or "").translate(str.maketrans(UP, UP.lower())))
    hits = [
        (i, label)
        for label, phrase in licenses.BASE
        for i in range(len(words))
        if words[i : i + len(phrase.split())] == phrase.split()
    ]
    starts = [i for i, _ in hits]
    return (
        len(words),
        len(hits),
        min(starts, default=None),
        max(starts, default=None),
        ",".join(sorted({label for _, label in hits})),
    )


@pytest.mark.parametrize("policy", [None, KeyedPolicy(broadcast_rows=0)])
def test_base_phrases_at_every_place(documents, clashing, policy):
    rows = [(i // 2 if i > 18 else i, t, "s") for i, t in enumerate(TEXTS)] + [(None, "cc by", "s")]
    got = licenses.scan(clashing(documents(rows)), policy).collect()
    found = sorted((str(r.doc_id), r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in got)
    want = sorted((str(d), *plain(t)) for d, t, _ in rows)
    key = lambda row: tuple(str(v) for v in row)
    assert sorted(found, key=key) == sorted(want, key=key)
    for r in got:
        assert set(filter(None, r.base_labels.split(","))) <= set(filter(None, r.labels.split(",")))
        assert 0 <= r.score <= 1 and (r.score == 1 or not r.n_base)


def test_notices(documents):
    got = {r.doc_id: r.labels for r in licenses.scan(documents(TEXTS)).collect()}
    assert got[11] == "apache-2.0"
    assert got[12] == "apache-2.0"  # a word was added
    assert got[13] == "cc-by,cc-by-nc"
    assert got[18] == "mit"
    assert got[14] == got[15] == ""


def test_no_documents(documents):
    assert licenses.scan(documents([])).collect() == []


def test_grams_stay_within_a_text():
    from creditloom.llm.common import word_grams

    texts = ["a b c", "", "d", "e f"]
    grams, words, counts = word_grams(texts, 2)
    assert words.tolist() == [3, 0, 1, 2] and counts.tolist() == [2, 0, 0, 1]
    assert grams.tolist() == [*word_grams(["a b c"], 2)[0], *word_grams(["e f"], 2)[0]]
