from __future__ import annotations

import re
from collections import Counter, defaultdict

import pytest

from creditloom.llm import mixing

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_targets(sizes, weights, epochs):
    """Water-filling by clamping one source after the other."""
    total, clamped = sum(sizes.values()), {}
    while True:
        open_ = [s for s in sizes if s not in clamped]
        left = total - sum(clamped.values())
        weight = sum(weights[s] for s in open_)
        share = {s: left * weights[s] / weight for s in open_} if open_ else {}
        over = [s for s in open_ if share[s] > epochs * sizes[s]]
        if not over:
            return {**clamped, **share}
        clamped.update({s: epochs * sizes[s] for s in over})


ROWS = [
    *[(i, "word " * (1 + i % 7), "big") for i in range(300)],
    *[(300 + i, f"t{i} a\tb\n\x0bc d e", "mid") for i in range(60)],
    (400, "only five words are here", "tiny"),
    (401, None, "tiny"),
    (402, "", "none"),
    (403, "null source text", None),
    (403, "null source text", None),
    (None, "no id", "mid"),
    (404, "x " * 30_000, "Big"),
]


@pytest.mark.parametrize("weights", [(1, 2, 3), (1, 50, 9, 200)])
def test_targets_and_words_taken(documents, clashing, weights):
    got = mixing.mix(clashing(documents(ROWS)), weights).collect()
    sizes = Counter()
    for _, text, source in ROWS:
        sizes[source] += len(WORD.findall(text or ""))
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    targets = plain_targets(sizes, weight, mixing.MAX_EPOCHS)
    assert len(got) == len(ROWS)
    taken = defaultdict(int)
    for r in got:
        taken[r.source] += r.taken
        assert r.source_size == sizes[r.source]
        assert r.target == pytest.approx(targets[r.source])
        assert 0 <= r.taken <= 3 * r.size
    assert {s: abs(taken[s] - targets[s]) <= 0.5 for s in sizes} == dict.fromkeys(sizes, True)


def test_runs_agree(documents):
    one, two = (mixing.mix(documents(ROWS).repartition(n)).collect() for n in (1, 5))
    name = lambda r: (r.doc_id is None, r.doc_id, r.size, r.taken)
    assert sorted(map(name, one)) == sorted(map(name, two))


def test_documents_are_given_whole(documents, clashing):
    docs = clashing(documents(ROWS))
    out = mixing.mixed_documents(docs)
    assert out.columns == docs.columns
    given = Counter((r.doc_id, r.text, r.source) for r in out.collect())
    wanted = Counter()
    for r in mixing.mix(docs).collect():
        times = r.whole + (r.part > 0 and 2 * r.part >= r.size)
        row = next(x for x in ROWS if x[0] == r.doc_id)
        wanted[row] += times
    assert +wanted == given
    assert set(given) <= set(ROWS)


@pytest.mark.parametrize("size,weight,times", [(100, 1, 1), (60, 1, 2), (400, 1, 0)])
def test_a_source_whose_only_document_is_at_the_cut(documents, monkeypatch, size, weight, times):
    """The nearer one of all and nothing is given of the last repetition."""
    monkeypatch.setattr(mixing, "WEIGHTS", (weight, 3))
    rows = [(1, "a " * size, "a")] + [(n, "b " * 10, "b") for n in range(2, 32)]
    monkeypatch.setattr(mixing.mix, "__defaults__", ((weight, 3), mixing.MAX_EPOCHS, mixing.SEED))
    taken = {r.doc_id: r for r in mixing.mix(documents(rows)).collect()}[1]
    out = [r.text for r in mixing.mixed_documents(documents(rows)).collect() if r.doc_id == 1]
    assert out == ["a " * size] * round(taken.taken / size)
    assert len(out) == times


def test_no_documents(documents):
    assert mixing.mix(documents([])).collect() == []
    assert mixing.mixed_documents(documents([])).collect() == []


def test_no_words(documents):
    got = mixing.mix(documents([None, "", " \t\n"])).collect()
    assert [(r.size, r.target, r.taken) for r in got] == [(0, 0.0, 0)] * 3
