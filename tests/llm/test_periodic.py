"""Periodic runs against brute force over all periods."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from creditloom.llm import periodic, queries

SF_DIR = "/root/testdata/sf0.001"


def plain_runs(words):
    """(start, length, period) of all runs: for every period, where words that far apart agree."""
    found = {}
    for q in range(1, len(words) // 3 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(24, 3 * q):
                found.setdefault((i, j + q), q)
            i = j + 1
    return sorted((s, e - s, q) for (s, e), q in found.items())


def fast_runs(texts):
    words = np.array([w for text in texts for w in text], np.int64)
    ends = np.cumsum([len(text) for text in texts])
    start, stop, period = periodic.runs(words, ends)
    out = [[] for _ in texts]
    for s, e, q in zip(start.tolist(), stop.tolist(), period.tolist()):
        own = int(np.searchsorted(ends, s, "right"))
        begin = int(ends[own]) - len(texts[own])
        out[own].append((s - begin, e - s, q))
    return out


piece = st.one_of(
    st.lists(st.integers(0, 2), max_size=12),
    st.tuples(st.lists(st.integers(0, 3), min_size=1, max_size=9), st.integers(2, 20)).map(
        lambda p: p[0] * p[1]
    ),
)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(piece, max_size=6), min_size=1, max_size=4))
def test_runs_match_all_periods(texts):
    texts = [[w for p in text for w in p] for text in texts]
    assert fast_runs(texts) == [plain_runs(text) for text in texts]


@pytest.mark.parametrize("seed", range(12))
def test_nested_and_copied_repetitions(seed):
    draw = random.Random(seed)
    text = []
    while len(text) < 600:
        kind = draw.random()
        if kind < 0.3:
            text += [draw.randrange(40) for _ in range(draw.randrange(1, 30))]
        elif kind < 0.8:
            inner = [draw.randrange(3) for _ in range(draw.randrange(1, 6))] * draw.randrange(1, 9)
            outer = inner + [draw.randrange(3) for _ in range(draw.randrange(4))]
            text += (outer * draw.randrange(2, 6))[: draw.randrange(10, 250)]
        elif text:
            at = draw.randrange(len(text))
            text += text[at : at + draw.randrange(100)]
    assert fast_runs([text]) == [plain_runs(text)]


def test_long_texts_take_no_time_of_a_square():
    again = list(np.random.default_rng(0).integers(0, 300, 1000)) * 200
    assert fast_runs([[0] * 200_000]) == [[(0, 200_000, 1)]]
    assert fast_runs([again]) == [[(0, 200_000, 1000)]]


def test_rows_nulls_repeats_and_clashes(spark, documents, clashing):
    run = "a b " * 12
    rows = [(1, None, "s"), (2, "", "s"), (3, " \t\n", "s"), (None, run, "s"), (5, run, "s"),
            (5, run, "s"), (6, "x " + run + "a y", "s"), (7, "a b " * 11, "s")]
    got = sorted(
        (r.doc_id or 0, r.n_words, [tuple(x) for x in r.runs], r.collapsed)
        for r in periodic.find_runs(clashing(documents(rows))).collect()
    )
    assert got == [
        (0, 24, [(0, 24, 2)], "a b"),
        (1, 0, [], ""),
        (2, 0, [], ""),
        (3, 0, [], ""),
        (5, 24, [(0, 24, 2)], "a b"),
        (5, 24, [(0, 24, 2)], "a b"),
        (6, 27, [(1, 25, 2)], "x a b y"),
        (7, 22, [], " ".join("ab" * 11)),
    ]
    assert periodic.find_runs(documents([])).collect() == []


def plain_row(doc, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n, h = len(words), zlib.crc32(str(doc).encode())
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = plain_runs(words)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    lines = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None,) * 3)
    milli = 1000 * best[1] // best[2] if runs else None
    digests = [hashlib.sha256(t.encode()).hexdigest() for t in (lines, kept)]
    return (doc, len(runs), *best, milli, *digests)


def test_query_matches_brute_force(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    short = {d.doc_id: d.text for d in docs if len(d.text or "") < 40_000}
    columns = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli",
               "runs_sha256", "collapsed_sha256"]
    result = queries.op13_periodic_runs(spark, SF_DIR).select(*columns).collect()
    assert len(result) == len(docs)
    got = {r.doc_id: tuple(r) for r in result if r.doc_id in short}
    want = {doc: plain_row(doc, text) for doc, text in short.items()}
    assert got == want and any(r[1] for r in want.values())
