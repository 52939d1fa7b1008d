from __future__ import annotations

import os
import platform
import random
import subprocess
import sys
import tracemalloc
import uuid
import zlib

import numpy as np
import pytest

from creditloom.llm import common, near_dup, toxicity

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
LABELS = "doc_id long, quality int, toxic int"


def sample(rng, toxic, size):
    plain = ["".join(rng.choice(["the", "on", "er", "in", "at"]) for _ in range(3)) for _ in range(60)]
    words = [rng.choice(plain) for _ in range(size)]
    if toxic:
        for _ in range(1 + size // 60):
            words[rng.randrange(size)] = rng.choice(["grumbold", "grumbolt", "fizzwag", "fizzwags"])
    return " ".join(words)


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(4)
    return [(i, sample(rng, i % 3 == 0, rng.randrange(5, 300)), i % 3 == 0) for i in range(600)]


def test_held_out_accuracy(spark, documents, clashing, corpus):
    rows = [(i, text, "s") for i, text, _ in corpus]
    labels = spark.createDataFrame([(i, 1, int(t)) for i, _, t in corpus], LABELS)
    docs = clashing(documents([*rows, (900, None, "s"), (901, "", "s"), (None, "grumbold", "s")]))
    got = {r.doc_id: r for r in toxicity.judge(docs, labels).collect()}
    assert len(got) == len(rows) + 3
    for doc, r in got.items():
        assert r.held_out == (zlib.crc32(("" if doc is None else str(doc)).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
    held = [(got[i].predicted, t) for i, _, t in corpus if got[i].held_out]
    assert sum(p == t for p, t in held) / len(held) > 0.95
    assert got[900].score == got[901].score < 0.5
    left = toxicity.clean_documents(docs, labels)
    assert left.columns == docs.columns
    assert {r.doc_id for r in left.collect()} == {i for i, r in got.items() if not r.predicted}


def test_held_out_labels_change_nothing(spark, documents, corpus):
    docs = documents([(i, text, "s") for i, text, _ in corpus[:80]])
    true = [(i, 1, int(t)) for i, _, t in corpus[:80]]
    flipped = [(i, q, 1 - t if zlib.crc32(str(i).encode()) % 5 == 0 else t) for i, q, t in true]
    one, two = (
        sorted((r.doc_id, r.score) for r in toxicity.judge(docs, spark.createDataFrame(rows, LABELS)).collect())
        for rows in (true, flipped)
    )
    assert one == two


def test_misspellings_share_vectors(corpus):
    model = toxicity.train([t for _, t, _ in corpus], [int(y) for _, _, y in corpus])
    known, unseen, plain = model.words(["grumbold", "grumboldd", "theoner"])
    assert known > unseen > plain


def test_no_labels_and_no_documents(spark, documents):
    none = spark.createDataFrame([], LABELS)
    assert [r.score for r in toxicity.judge(documents(["a", None]), none).collect()] == [0.5, 0.5]
    assert toxicity.judge(documents([]), none).collect() == []
    odd = spark.createDataFrame([(0, 1, None), (1, None, 1), (1, 0, 1), (None, 0, 0), (2, 0, 7)], LABELS)
    got = toxicity.judge(documents(["a", "b", "c"]), odd).collect()
    assert all(r.score > 0.5 for r in got)  # one class is all there is to learn


def test_word_hashes_do_not_depend_on_company():
    alone = {w: sorted(toxicity.gram_ids([w])[0].tolist()) for w in ("a", "word", "é漢", "x" * 5000)}
    rows, owner = toxicity.gram_ids(list(alone))
    for n, own in enumerate(alone.values()):
        assert sorted(rows[owner == n].tolist()) == own


def test_sample_is_bounded(spark, documents, corpus):
    docs = documents([(i, text, "s") for i, text, _ in corpus])
    labels = spark.createDataFrame([(i, 1, int(t)) for i, _, t in corpus], LABELS)
    rows = toxicity.sample_rows(docs, labels, per_class=20).collect()
    assert np.bincount([r.toxic for r in rows]).tolist() == [20, 20]
    assert all(zlib.crc32(str(r.doc_id).encode()) % 5 for r in rows)


def test_mean_loss_weighs_classes_alike():
    scores, labels = np.array([0.9, 0.5, 0.2, 0.2, 0.2]), np.array([1, 1, 0, 0, 0])
    want = -(np.log([0.9, 0.5]).mean() + np.log(0.8)) / 2
    assert toxicity.mean_loss(scores, labels) == pytest.approx(want)


def test_decay_is_chosen_on_an_inner_fold(monkeypatch, corpus):
    rows = random.Random(1).sample(corpus, 60)
    texts, labels = [t for _, t, _ in rows], [int(y) for _, _, y in rows]
    given = []
    real = toxicity.train

    def train(some, marks, **kwargs):
        given.append((len(some), kwargs.get("decay")))
        return real(some, marks, steps=3, **kwargs)

    monkeypatch.setattr(toxicity, "train", train)
    toxicity.train_tuned(texts, labels)
    assert [n for n, _ in given] == [40] * len(toxicity.DECAYS) + [60]
    assert given[-1][1] in toxicity.DECAYS
    given.clear()
    toxicity.train_tuned(texts[:2], labels[:2])  # too few for a fold
    assert given == [(2, None)]


def test_training_holds_few_bytes_a_word():
    draw = random.Random(1)
    pool = [f"w{n}" for n in range(2000)]
    texts = [" ".join(draw.choices(pool, k=3000)) for _ in range(100)]
    tracemalloc.start()
    toxicity.train(texts, [n % 2 for n in range(100)], buckets=4096, steps=3)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 48 * 100 * 3000  # with tuples of windows and copies by word it took 57


def test_scoring_holds_few_texts_as_words():
    """A batch of many texts is not held as words all at once; scores do not depend on it."""
    rng = np.random.default_rng(3)
    words = [f"w{i}" for i in range(500)]
    texts = ["", *(" ".join(rng.choice(words, 250)) for _ in range(5000)), "w1 " * 400_000]
    model = toxicity.Model(rng.normal(0, 1, 1 << 10).astype("f4"), 0.1)
    tracemalloc.start()
    got = toxicity.scores_of(texts[:-1], model, {})
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 40 * toxicity.SCORE_CHARS  # all words at once take 67 MB
    got += toxicity.scores_of(texts[-1:], model, {})
    alone = [toxicity.scores_of([text], model, {})[0] for text in texts]
    assert got == alone


def test_python_gets_few_texts_at_a_time(spark, documents, monkeypatch):
    """Not the thousands of rows that Spark hands over at once unless it is told otherwise."""
    whole = toxicity.scores_of

    def counted(texts, model, known):
        assert len(texts) <= common.BATCH_ROWS
        return whole(texts, model, known)

    monkeypatch.setattr(toxicity, "scores_of", counted)
    docs = documents([f"w{n}" for n in range(2 * common.BATCH_ROWS + 1)]).coalesce(1)
    none = spark.createDataFrame([], LABELS)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert toxicity.judge(docs, none).count() == docs.count()
    assert toxicity.judge(docs, none).select("score").distinct().collect() == [(0.5,)]
    assert toxicity.clean_documents(docs, none).collect() == []
    assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == before


HELD = """
import re, sys
import numpy as np
from creditloom.llm.common import give_back

def held():
    found = open("/proc/self/smaps_rollup").read()
    return int(re.search(r"Pss_Anon: +([0-9]+)", found)[1]) // 1024

rest = [np.ones(1000) for _ in range(25_000)]
last = np.ones(1000)  # lies behind them, so that the heap cannot shrink from its end
del rest
full = held()
give_back()
assert full - held() > 100, (full, held())
"""


def test_free_memory_goes_back():
    if not sys.platform.startswith("linux") or platform.libc_ver()[0] != "glibc":
        pytest.skip("other systems have other allocators")
    subprocess.run([sys.executable, "-c", HELD], check=True, env=os.environ | {"PYTHONPATH": ROOT})


def test_tasks_end_by_giving_memory_back(spark, documents, monkeypatch, tmp_path):
    """Scoring and the steps of near duplicates that see texts."""

    def noted():
        (tmp_path / uuid.uuid4().hex).touch()

    monkeypatch.setattr(toxicity, "give_back", noted)
    monkeypatch.setattr(near_dup, "give_back", noted)
    docs = documents(["a b c d e f g", "h"]).coalesce(1)
    toxicity.judge(docs, spark.createDataFrame([], LABELS))
    scored = len(list(tmp_path.iterdir()))
    near_dup.sketch(docs)
    assert 0 < scored < len(list(tmp_path.iterdir()))


def test_training_holds_few_bytes_an_ngram():
    draw = random.Random(2)
    pool = ["".join(draw.choices("abcdefghijklmnop", k=12)) for _ in range(40_000)]
    texts = [" ".join(pool[i::100]) for i in range(100)]
    grams = 40_000 * (12 + 11 + 10 + 1)
    tracemalloc.start()
    toxicity.train(texts, [n % 2 for n in range(100)], buckets=4096, steps=3)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 30 * grams  # with all of them as floats at once it took 36


def test_training_does_not_depend_on_blocks(monkeypatch, corpus):
    texts, labels = ["", *(t for _, t, _ in corpus)], [0, *(int(y) for _, _, y in corpus)]
    whole = toxicity.train(texts, labels, steps=5)
    monkeypatch.setattr(toxicity, "BLOCK", 7)
    parts = toxicity.train(texts, labels, steps=5)
    assert parts.bias == whole.bias and np.array_equal(parts.weights, whole.weights)
    monkeypatch.setattr(toxicity, "BLOCK_WORDS", 11)
    parts = toxicity.train(texts, labels, steps=5)
    assert np.allclose(parts.weights, whole.weights, atol=1e-6)
