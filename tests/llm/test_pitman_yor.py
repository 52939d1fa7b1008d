"""The word model: counts and base scores exactly, sampling against exact and plain forms."""

from __future__ import annotations

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from creditloom.llm import pitman_yor as model
from creditloom.llm import queries

SF_DIR = "/root/testdata/sf0.001"


def words(text):
    lower = "".join(c.lower() if c.isascii() else c for c in text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", lower), "\n"]


def plain_base(rows):
    """(n_tokens, n_known, train_tokens, base_score) of all (text, held_out) rows."""
    counts = Counter(w for text, held in rows if not held for w in words(text))
    total, vocabulary = sum(counts.values()), len(counts)
    for text, _ in rows:
        own = words(text)
        base = sum(math.log10((counts[w] + 0.1) / (total + 0.1 * (vocabulary + 1))) for w in own)
        yield len(own), sum(counts[w] > 0 for w in own), total, base


def check_base(got, rows):
    for r, want in zip(got, plain_base(rows), strict=True):
        assert (r.n_tokens, r.n_known, r.train_tokens) == want[:3]
        assert r.base_score == pytest.approx(want[3], rel=1e-9)


def test_query_counts_and_base_scores(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").orderBy("doc_id").collect()
    got = {r.doc_id: r for r in queries.op11_pitman_yor(spark, SF_DIR).collect()}
    rows = [(d.text, zlib.crc32(str(d.doc_id).encode()) % 10 == 0) for d in docs]
    check_base([got[d.doc_id] for d in docs], rows)
    assert all(got[d.doc_id].held_out == held for d, (_, held) in zip(docs, rows))
    held = [r for r in got.values() if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)
    assert all(math.isfinite(r.score) and r.score < 0 for r in got.values())


def test_rows_nulls_repeats_and_clashes(spark, documents, clashing):
    texts = [(1, None, "s"), (2, "", "s"), (3, " \t ", "s"), (None, "Some words", "s"),
             (5, "some WORDS É", "s"), (5, "some WORDS É", "s"), (7, "é unseen", "held")]
    got = model.score(clashing(documents(texts)), F.col("source") == "held").collect()
    got.sort(key=lambda r: (r.doc_id or 0, r.n_tokens))
    order = [texts[3], texts[0], texts[1], texts[2], *texts[4:]]
    check_base(got, [(t, s == "held") for _, t, s in order])
    assert got[4].score == got[5].score and got[1].score == got[2].score == got[3].score
    assert model.score(documents([]), F.lit(False)).collect() == []
    none = model.score(documents(["a b", ""]), F.lit(True)).collect()
    assert [(r.n_known, r.train_tokens, r.score) for r in none] == [(0, 0, 0.0)] * 2


def test_small_blocks_and_buckets_change_nothing_but_the_draws(spark, documents, monkeypatch):
    draw = random.Random(5)
    texts = [" ".join(draw.choices("abcdefgh", k=draw.randrange(30))) for _ in range(80)]
    held = F.col("doc_id") % 4 == 0
    whole = model.score(documents(texts), held).orderBy("doc_id").collect()
    for name, value in (("BLOCK_BYTES", 200), ("BUCKET_PAIRS", 100), ("PART_WORDS", 3)):
        monkeypatch.setattr(model, name, value)
    cut = model.score(documents(texts), held).orderBy("doc_id").collect()
    check_base(cut, [(t, n % 4 == 0) for n, t in enumerate(texts)])
    assert [r.base_score for r in whole] == pytest.approx([r.base_score for r in cut])
    assert sum(r.score for r in whole) == pytest.approx(sum(r.score for r in cut), rel=0.02)


@pytest.mark.parametrize("discount,strength,customers", [(0.5, 0.3, 6), (0.8, 2.0, 9)])
def test_seating_follows_its_posterior(discount, strength, customers):
    """Dishes seated over and over have tables as often as the exact formula says."""
    # Generalised Stirling numbers: ways to seat n customers at t tables, by weight.
    ways = np.zeros((customers + 1, customers + 2))
    ways[0, 0] = 1
    for n in range(customers):
        for t in range(n + 1):
            ways[n + 1, t + 1] += ways[n, t]
            ways[n + 1, t] += ways[n, t] * (n - discount * t)
    exact = ways[customers, 1 : customers + 1] * strength ** np.arange(1, customers + 1)
    exact /= exact.sum()
    many = 20_000
    tables = np.ones(many, np.int64)
    sizes = np.full(many, customers)
    draw = np.random.default_rng(0)
    for _ in range(20):
        tables, sizes = model.reseat(
            draw, np.full(many, customers), tables, sizes, np.full(many, strength), discount
        )
        assert sizes.sum() == many * customers and len(sizes) == tables.sum() and sizes.min() > 0
    seen = np.bincount(tables, minlength=customers + 1)[1:] / many
    assert np.abs(seen - exact).max() < 0.02


@pytest.mark.parametrize(
    "discount,strength,customers,rounds",
    [(0.5, 3.0, 60, 1), (0.7, 20.0, 300, 1), (0.6, 8.0, 900, 3), (0.4, 100.0, 900, 5)],
)
def test_all_customers_get_up_in_a_round(discount, strength, customers, rounds):
    """From one table each, large dishes come to their posterior in a round or a few."""
    ways = model._log_ways(customers, discount)[customers, 1:]
    exact = ways + np.log(strength) * np.arange(1, customers + 1)
    exact = np.exp(exact - exact.max())
    exact /= exact.sum()
    many = 3_000
    tables, sizes = np.ones(many, np.int64), np.full(many, customers)
    draw = np.random.default_rng(3)
    for _ in range(rounds):
        tables, sizes = model.reseat(
            draw, np.full(many, customers), tables, sizes, strength, discount
        )
        assert sizes.sum() == many * customers and len(sizes) == tables.sum() and sizes.min() > 0
    seen = np.bincount(tables, minlength=customers + 1)[1:] / many
    assert np.abs(np.cumsum(seen) - np.cumsum(exact)).max() < 0.05


def test_dishes_of_both_kinds_keep_their_order():
    customers = np.array([5, 3_000_000, 2, 900, 400])
    tables, sizes = np.ones(5, np.int64), customers
    draw = np.random.default_rng(4)
    for _ in range(5):
        strength = np.array([1.0, 300.0, 0.1, 2.0, 3.0])
        tables, sizes = model.reseat(draw, customers, tables, sizes, strength, 0.7)
        assert np.add.reduceat(sizes, np.cumsum(tables) - tables).tolist() == customers.tolist()
    assert tables[1] > 300 and tables[2] <= 2


def plain_model(learned, rounds, seed):
    """A Gibbs sampler customer by customer over Python lists; returns the word probabilities."""
    draw = random.Random(seed)
    uses = [(b, w) for own in learned for b, w in zip(["\n", *own], own)]
    counts = Counter(uses)
    vocabulary = len({w for _, w in uses})
    once, twice = (sum(c == k for c in counts.values()) for k in (1, 2))
    discount = (once + 1) / (once + 2 * twice + 2)
    rooms = defaultdict(lambda: defaultdict(list))  # restaurant -> dish -> sizes of tables
    root = "root"

    def figures(room):
        tables = sum(len(s) for s in rooms[room].values())
        return tables, sum(map(sum, rooms[room].values()))

    def chance(room, w):
        parent = 1 / (vocabulary + 1) if room == root else chance(root, w)
        tables, customers = figures(room)
        own = rooms[room].get(w, [])
        top = sum(own) - discount * len(own) + (1 + discount * tables) * parent
        return top / (1 + customers)

    def sit(room, w):
        parent = 1 / (vocabulary + 1) if room == root else chance(root, w)
        sizes = rooms[room][w]
        weights = [s - discount for s in sizes] + [(1 + discount * figures(room)[0]) * parent]
        at = draw.choices(range(len(weights)), weights)[0]
        if at < len(sizes):
            sizes[at] += 1
        else:
            sizes.append(1)
            if room != root:
                sit(root, w)

    def leave(room, w):
        sizes = rooms[room][w]
        at = draw.choices(range(len(sizes)), sizes)[0]
        sizes[at] -= 1
        if not sizes[at]:
            del sizes[at]
            if room != root:
                leave(root, w)

    for b, w in uses:
        sit(("after", b), w)
    for _ in range(rounds):
        for b, w in uses:
            leave(("after", b), w)
            sit(("after", b), w)
    return lambda b, w: chance(("after", b), w)


def test_scores_are_near_those_of_a_plain_sampler(spark, documents, monkeypatch):
    monkeypatch.setattr(model, "ROUNDS", 6)
    draw = random.Random(9)
    follow = {w: draw.choices("abcdefghijkl", k=4) for w in "abcdefghijkl"}
    texts = []
    for _ in range(120):
        own = [draw.choice("abcdefghijkl")]
        for _ in range(draw.randrange(12)):
            own.append(draw.choice(follow[own[-1]]) if draw.random() < 0.8 else draw.choice("xyz"))
            own[-1] = own[-1] if own[-1] in follow else draw.choice("abc")
        texts.append(" ".join(own))
    rows = [(n, t, "held" if n % 5 == 0 else "s") for n, t in enumerate(texts)]
    got = model.score(documents(rows), F.col("source") == "held").collect()
    held = {r.doc_id: r.score for r in got if r.held_out}
    chances = [plain_model([words(t) for _, t, s in rows if s == "s"], 12, seed) for seed in (1, 2)]
    want = {}
    for n, t, s in rows:
        if s == "held":
            own = words(t)
            pairs = list(zip(["\n", *own], own))
            want[n] = sum(math.log10(sum(c(b, w) for c in chances) / 2) for b, w in pairs)
    assert held.keys() == want.keys()
    assert sum(held.values()) == pytest.approx(sum(want.values()), rel=0.01)
    for n in want:
        assert held[n] == pytest.approx(want[n], rel=0.1, abs=0.3)
