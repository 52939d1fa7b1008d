"""Toxicity by subword bags: averaged embeddings under a linear softmax, trained together.

A word is the bag of its character n-grams (with marks at its ends), hashed to rows of an
embedding table; its vector is their mean. A window of a text is the mean of its words'
vectors, and a linear softmax over two classes scores it. A text is as toxic as its worst
windows: the log of the mean of their exponentials joins the windows' scores, so a few
words count in a long text as in a short one. Words never seen share n-grams, and so
vectors, with words that were.

Table and softmax are trained together, by full-batch Adam in numpy, on a bounded sample of
labelled rows; how strongly weights decay is chosen on an inner fold of it. For scoring they fold into one weight per n-gram, a table of fixed size.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from creditloom.llm.common import give_back, small_batches, text_of
from creditloom.sources.staging import stage

WINDOW = 12
"""Words that are averaged; windows overlap by half."""
BUCKETS = 1 << 17
GRAMS = (3, 4, 5)
SAMPLE = 3_000
"""At most so many labelled rows of each class are learned from, the first by hash."""
SAMPLE_CHARS = 24_000_000
"""At most so many characters of them, in the same order."""
WORD_CACHE = 300_000
SCORE_CHARS = 1 << 20
"""Texts of about so many characters are cut into words at a time; a longer one comes alone."""
BLOCK_WORDS = 10_000
"""Words whose n-grams training looks at at a time; fewer than 65,536."""
BLOCK = 1 << 14
"""Tokens, or rows of the embedding table, that training looks at at a time."""
SHARPNESS = 8.0
HELD_OUT = 5
THRESHOLD = 0.5

MIN_TEXTS = 6
"""N-grams of fewer texts of the sample get no weight."""
STEPS = 60
DECAYS = (1e-5, 1e-4, 1e-3)
"""How strongly weights are drawn to 0; the one that is least wrong on an inner fold is taken."""
INNER = 3
"""One in so many rows of the sample is the inner fold."""
CLEAN_SHARE = 0.6
"""Part of the total weight that the clean class has in training."""

_STEP, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)
_WORD = re.compile(r"[^\W_]+")


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def gram_ids(words: list[str], buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray]:
    """Table rows of all n-grams of the words, whole words included, and whose they are.

    Polynomial hashes over code points, modulo 2**64, mixed and folded to the table.
    """
    marked = "".join([f"<{word}>" for word in words])
    code = np.frombuffer(marked.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    sizes = np.fromiter(map(len, words), np.int64, len(words)) + 2
    ends = np.cumsum(sizes)
    owner = np.repeat(np.arange(len(words)), sizes)
    room = ends[owner] - np.arange(len(code))  # characters from here to the word's end
    rows, whose = [], []
    for n in GRAMS:
        start = np.flatnonzero(room >= n)
        h = np.full(len(start), n, np.uint64)
        for i in range(n):
            h = h * _STEP + code[start + i]
        rows.append(h)
        whose.append(owner[start])
    power = np.cumprod(np.full(len(code), _STEP, np.uint64)) if len(code) else code
    # Place within the word decides the power, so equal words hash alike.
    place = np.arange(len(code)) - (ends - sizes)[owner]
    rows.append(np.add.reduceat(code * power[place], ends - sizes) if len(code) else code)
    whose.append(np.arange(len(words)))
    h = np.concatenate(rows)
    h ^= h >> np.uint64(29)
    h *= _MIX
    h ^= h >> np.uint64(32)
    return (h % np.uint64(buckets)).astype(np.int64), np.concatenate(whose)


def window_bounds(count: int, window: int) -> list[tuple[int, int]]:
    """Half-overlapping windows that cover ``count`` words; one empty window for none."""
    step = window // 2
    return [(i, min(count, i + window)) for i in range(0, max(1, count - step), step)]


@dataclass
class Model:
    """Folded weights: the score of a window is ``bias`` plus its words' mean weight."""

    weights: np.ndarray
    bias: float
    sharpness: float = SHARPNESS

    def words(self, words: list[str]) -> np.ndarray:
        """The weight of each word: the mean over its n-grams."""
        grams, owner = gram_ids(words, len(self.weights))
        counts = np.bincount(owner, minlength=len(words))
        return np.bincount(owner, self.weights[grams], len(words)) / np.maximum(1, counts)

    def text(self, scores: np.ndarray) -> float:
        """Probability of the toxic class for the words' scores of one text."""
        sums = np.concatenate([[0.0], np.cumsum(scores)])
        bounds = np.array(window_bounds(len(scores), WINDOW))
        sizes = np.maximum(1, bounds[:, 1] - bounds[:, 0])
        logits = self.bias + (sums[bounds[:, 1]] - sums[bounds[:, 0]]) / sizes
        return float(_sigmoid(_pool(logits, self.sharpness)))


def _pool(logits: np.ndarray, sharpness: float) -> float:
    top = logits.max()
    return top + np.log(np.exp((logits - top) * sharpness).sum()) / sharpness


def _sigmoid(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -60, 60)))


def train(
    texts: list[str],
    labels: list[int],
    dim: int = 8,
    steps: int = STEPS,
    rate: float = 0.1,
    seed: int = 5,
    buckets: int = BUCKETS,
    min_texts: int = MIN_TEXTS,
    decay: float = DECAYS[0],
    clean_share: float = CLEAN_SHARE,
    sharpness: float = SHARPNESS,
) -> Model:
    """Fit table and softmax to texts and labels of 0 and 1; classes weigh the same.

    Two equal classes' softmax depends on the difference of its two columns only, which is
    the direction kept here. No text, or a single class, gives a constant score of the
    class (0.5 for none).

    What has a number per token or n-gram is computed a block at a time, in an order that
    blocks do not change, so that no more than one array of such numbers is held as floats.
    """
    y = np.array(labels, float)
    if len(y) == 0 or y.min() == y.max():
        prior = 0.5 if len(y) == 0 else float(y[0])
        return Model(np.zeros(buckets, np.float32), 8.0 * (prior - 0.5) * 2)
    index: dict[str, int] = {}
    numbers, bounds, at = [], [], 0
    for text in texts:
        own = [index.setdefault(w, len(index)) for w in words_of(text)]
        numbers.append(np.array(own, np.int32))
        bounds.append(np.array(window_bounds(len(own), WINDOW)) + at)
        at += len(own)
    owner = np.repeat(np.arange(len(texts)), [len(b) for b in bounds])
    tokens, (starts, ends) = np.concatenate(numbers), np.concatenate(bounds).T.copy()
    del bounds
    sizes = np.maximum(1, ends - starts).astype(float)
    per_text = [len(own) for own in numbers]
    in_texts = _texts_of_words(numbers, len(index))
    words = list(index)
    del index, numbers
    grams = _grams_of_many(words, buckets)
    del words
    # An n-gram of a few texts would only learn those texts by heart.
    learned = np.flatnonzero(_to_grams(in_texts, grams, buckets) >= min_texts)
    weigh = _WordWeights(grams, len(in_texts))
    give_back()  # the words
    first = np.searchsorted(owner, np.arange(len(texts)))
    sums = np.zeros(at + 1)  # by token, for words' weights and for windows' shares in turn

    rng = np.random.default_rng(seed)
    table = rng.normal(0, 0.1, (buckets, dim))
    table[np.setdiff1d(np.arange(buckets), learned)] = 0  # the others say nothing
    soft, bias = rng.normal(0, 0.5, dim), np.zeros(1)
    weight = np.where(y == 1, (1 - clean_share) / y.sum(), clean_share / (1 - y).sum())
    state = [[np.zeros_like(p), np.zeros_like(p)] for p in (table[learned], soft, bias)]
    for step in range(1, steps + 1):
        per_word = weigh(table @ soft)
        sums[0] = 0
        for a, b in _blocks(at, BLOCK):
            sums[a + 1 : b + 1] = per_word[tokens[a:b]]
        np.cumsum(sums[1:], out=sums[1:])
        logits = bias[0] + (sums[ends] - sums[starts]) / sizes
        top = np.maximum.reduceat(logits, first)
        share = np.exp((logits - top[owner]) * sharpness)
        total = np.add.reduceat(share, first)
        pooled = top + np.log(total) / sharpness
        wrong = (_sigmoid(pooled) - y) * weight
        # Back: text to windows, to words, to n-grams; all are scalars along one direction.
        to_window = wrong[owner] * share / total[owner]
        per_token = to_window / sizes
        for a, b in _blocks(at + 1, BLOCK):
            sums[a:b] = _sums_at(starts, per_token, a, b)
            sums[a:b] -= _sums_at(ends, per_token, a, b)
        np.cumsum(sums, out=sums)
        to_word = np.zeros(len(per_word))
        for a, b in _blocks(at, BLOCK):
            np.add.at(to_word, tokens[a:b], sums[a:b])
        to_gram = _to_grams(to_word / weigh.counts, grams, buckets)[learned]
        to_soft = table[learned].T @ to_gram + 1e-5 * soft
        for a, b in _blocks(len(learned), BLOCK):
            some = learned[a:b]
            grad = np.outer(to_gram[a:b], soft) + decay * table[some]
            table[some] -= _adam([m[a:b] for m in state[0]], grad, step, rate)
        soft -= _adam(state[1], to_soft, step, rate)
        bias -= _adam(state[2], np.array([to_window.sum()]), step, rate)
    # Centred on the clean class: an n-gram without weight then counts as a usual one does.
    line = table @ soft
    per_word, size, start = weigh(line), 0, 0
    for own, label in zip(per_text, y):
        if label == 0:
            sums[size : size + own] = per_word[tokens[start : start + own]]
            size += own
        start += own
    usual = float(sums[:size].mean()) if size else 0.0
    line[learned] -= usual
    return Model(line.astype(np.float32), float(bias[0]) + usual, sharpness)


def mean_loss(scores: np.ndarray, labels: np.ndarray) -> float:
    """Mean negative log-probability of the right class, both classes weighing the same."""
    right = np.clip(np.where(labels == 1, scores, 1 - scores), 1e-6, 1)
    return -float(np.mean([np.log(right[labels == c]).mean() for c in (0, 1)]))


def train_tuned(texts: list[str], labels: list[int]) -> Model:
    """:func:`train` with the decay that does best on rows left out of a first training.

    Rows come in a random order, so every INNER-th is a fair fold. Without both classes in it
    there is nothing to choose by, and the first decay is taken.
    """
    y = np.array(labels)
    inner = np.arange(len(y)) % INNER == 0
    if len(y) == 0 or min(y[inner].sum(), (1 - y[inner]).sum()) == 0:
        return train(texts, labels)
    rest = np.flatnonzero(~inner).tolist()
    left_out = np.flatnonzero(inner).tolist()
    losses = []
    for decay in DECAYS:
        model = train([texts[i] for i in rest], [labels[i] for i in rest], decay=decay)
        give_back()  # what a training held, before the next one
        scores = scores_of((texts[i] for i in left_out), model, {})
        losses.append(mean_loss(np.array(scores), y[inner]))
    return train(texts, labels, decay=DECAYS[int(np.argmin(losses))])


def _blocks(size: int, step: int) -> list[tuple[int, int]]:
    """Bounds of consecutive stretches of at most ``step`` that cover ``size``."""
    return [(start, min(size, start + step)) for start in range(0, size, step)]


def _sums_at(places: np.ndarray, values: np.ndarray, start: int, stop: int) -> np.ndarray:
    """Sums of the values by their place, for the places from ``start`` to ``stop``; in order."""
    a, b = np.searchsorted(places, (start, stop))
    return np.bincount(places[a:b] - start, values[a:b], stop - start)


def _adam(moments: list[np.ndarray], grad: np.ndarray, step: int, rate: float) -> np.ndarray:
    """How far to go down; the moments are changed in place."""
    moments[0] *= 0.9
    moments[0] += 0.1 * grad
    moments[1] *= 0.99
    moments[1] += 0.01 * grad * grad
    spread = np.sqrt(moments[1] / (1 - 0.99**step))
    return rate * (moments[0] / (1 - 0.9**step)) / (spread + 1e-9)


Grams = list[tuple[int, int, np.ndarray, np.ndarray]]
"""For each block of words its bounds, the table rows of its n-grams and the word of each in it."""


def _grams_of_many(words: list[str], buckets: int) -> Grams:
    """:func:`gram_ids` of many words, some at a time, in numbers of few bytes."""
    parts = []
    for a, b in _blocks(len(words), BLOCK_WORDS):
        rows, owner = gram_ids(words[a:b], buckets)
        parts.append((a, b, rows.astype(np.int32), owner.astype(np.uint16)))
    return parts


class _WordWeights:
    """The weight of each word, the mean over its n-grams, for a weight per n-gram."""

    def __init__(self, grams: Grams, words: int):
        self.grams, self.counts = grams, np.ones(words)
        for a, b, _, owner in grams:
            self.counts[a:b] = np.bincount(owner, minlength=b - a)

    def __call__(self, line: np.ndarray) -> np.ndarray:
        sums = np.zeros(len(self.counts))
        for a, b, rows, owner in self.grams:
            sums[a:b] = np.bincount(owner, line[rows], b - a)
        return sums / self.counts


def _to_grams(per_word: np.ndarray, grams: Grams, buckets: int) -> np.ndarray:
    """Sums over the words that have the n-gram."""
    sums = np.zeros(buckets)
    for a, b, rows, owner in grams:
        np.add.at(sums, rows, per_word[a:b][owner])
    return sums


def _texts_of_words(numbers: list[np.ndarray], words: int) -> np.ndarray:
    """How many texts hold each word; ``numbers`` are those of each text's words.

    Summed over the words of an n-gram, that is at least the number of texts that hold it.
    """
    per_word = np.zeros(words)
    for own in numbers:
        per_word[np.unique(own)] += 1
    return per_word


def fold(doc_id: Column) -> Column:
    """crc32 of the identifier as text, modulo 5; a null identifier is an empty text."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))), F.lit(HELD_OUT))


def sample_rows(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE) -> DataFrame:
    """Labelled training rows, ``per_class`` of each class at most.

    Rows of the held-out fold are never used, nor labels other than 0 and 1. A document
    with two labels counts as toxic. The choice is the first rows by a hash of the
    identifier, taken per class with a bounded heap in each task.
    """
    known = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int"))
        .filter(F.col("toxic").isin(0, 1) & (fold(F.col("doc_id")) != 0))
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
    )
    order = F.xxhash64("doc_id", F.lit(17))
    picked = [
        known.filter(F.col("toxic") == c).orderBy(order, "doc_id").limit(per_class)
        for c in (0, 1)
    ]
    chosen = picked[0].unionByName(picked[1])
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of("text").alias("text"))
    return texts.join(F.broadcast(chosen), "doc_id").dropDuplicates(["doc_id"])


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """Train on the sample; it is bounded by SAMPLE rows per class and SAMPLE_CHARS."""
    rows = sample_rows(docs, labels).select(
        "doc_id", "toxic", "text", F.xxhash64("doc_id", F.lit(17)).alias("at")
    )
    rows = stage(rows.withColumn("long", F.length("text")), "labelled-sample")
    total = rows.agg(F.coalesce(F.sum("long"), F.lit(0))).first()[0]
    if total > SAMPLE_CHARS:  # whole texts that fit the bound, by the same order
        share = SAMPLE_CHARS / total
        rows = rows.filter(F.pmod("at", F.lit(1 << 20)) < int(share * (1 << 20)))

    def learn(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = [row for batch in batches for row in batch.to_pylist()]
        got.sort(key=lambda r: (r["at"], r["doc_id"]))
        model = train_tuned([r["text"] for r in got], [r["toxic"] for r in got])
        row = ([model.weights.tobytes()], [model.bias], [model.sharpness])
        del got
        give_back()
        yield pa.RecordBatch.from_arrays(
            [pa.array(c) for c in row], names=["weights", "bias", "sharpness"]
        )

    # The bounded sample in one task; a table of fixed size comes back.
    with small_batches(rows.sparkSession):
        made = (
            rows.select("text", "toxic", "at", "doc_id")
            .repartition(1)
            .mapInArrow(learn, "weights binary, bias double, sharpness double")
            .first()
        )
    if made is None:  # nothing to learn from
        return train([], [])
    return Model(np.frombuffer(made.weights, np.float32), made.bias, made.sharpness)


def score(text: Column, model: Model) -> Column:
    """0 to 1: the toxic class of a whole text; for plans made with :func:`small_batches`.

    A null or empty text has one empty window. The model is sent to the tasks once; its
    size is that of the table, whatever the data.
    """
    parts = (model.weights, model.bias, model.sharpness)
    shared = SparkSession.active().sparkContext.broadcast(parts)

    def run(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model, known = Model(*shared.value), {}
        for series in texts:
            yield pd.Series(scores_of(series, model, known), dtype="float64")
        known.clear()
        give_back()

    return F.pandas_udf(run, "double")(text_of(text))


def _some_at_a_time(texts: Iterable[str]) -> Iterator[list[str]]:
    """The texts in order, in lists of about SCORE_CHARS characters."""
    part, total = [], 0
    for text in texts:
        if part and total + len(text) > SCORE_CHARS:
            yield part
            part, total = [], 0
        part.append(text)
        total += len(text)
    if part:
        yield part


def scores_of(texts: Iterable[str], model: Model, known: dict[str, float]) -> list[float]:
    """The score of each text; ``known`` keeps the weights of words.

    Words take many times the room of their text, so few texts are cut into words at a time.
    """
    scores = []
    for part in _some_at_a_time(texts):
        split = [words_of(t) for t in part]
        words = set().union(*split)
        if len(known) + len(words) > WORD_CACHE:
            known.clear()
        new = list(words.difference(known))
        for start in range(0, len(new), 10_000):
            some = new[start : start + 10_000]
            known.update(zip(some, model.words(some).tolist()))
        scores += [
            model.text(np.fromiter(map(known.__getitem__, own), float, len(own))) for own in split
        ]
    return scores


def judge(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` and ``predicted`` of every document.

    Labels are read from the training folds only. One row per input row; repeated rows and
    null identifiers are scored like any other.
    """
    model = fit(docs, labels)
    scored = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), score(F.col("text"), model).alias("score")
    )
    with small_batches(docs.sparkSession):
        scored = stage(scored, "toxicity-scores")
    return scored.select(
        "doc_id",
        (fold(F.col("doc_id")) == 0).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def clean_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that are not judged toxic, with all their columns; staged."""
    clean = docs.filter(score(F.col("text"), fit(docs, labels)) < THRESHOLD)
    with small_batches(docs.sparkSession):
        return stage(clean, "not-toxic")
