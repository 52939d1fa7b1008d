"""Periodic runs in the words of a text, found over a grammar.

A run is a stretch of words that repeats with a smallest period, at least ``EXPONENT`` times
and over ``LEAST`` words, and that no neighbouring word extends. The words of a batch of texts
are numbered and rewritten by Re-Pair: in each round the pairs that are locally the most
frequent become nonterminals, until no pair is left twice; what remains of each stretch is
paired off evenly. The repetitions that cross the boundary between the two halves of a
nonterminal are computed once, at one of its places, and carried to all places where the
grammar derives it. Every run lies in a lowest nonterminal, whose boundary it crosses, so
merging what was carried gives exactly the maximal runs.

Every window of ``WINDOW`` words inside a run occurs again in its text, as a run is at least
three periods and 24 words long. Stretches without such windows cannot hold a run; the grammar
is built over the others.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditloom.llm.common import byte_sums, slices, text_of

LEAST = 24
EXPONENT = 3
WINDOW = 8
"""At most LEAST - 2 * (LEAST // EXPONENT) + 1, so that every window of a run recurs in it."""
AT_ONCE = 1 << 20
"""Candidate periods that are extended together."""

_MIX = np.uint64(0xD6E8FEB86659FD93)


def _scatter(values: np.ndarray, seed: int) -> np.ndarray:
    h = (values.astype(np.uint64) + np.uint64(seed + 1)) * _MIX
    h = (h ^ (h >> np.uint64(32))) * _MIX
    return h ^ (h >> np.uint64(29))


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The numbers start, start + 1, ... of every range, and the range of each."""
    owner = np.repeat(np.arange(len(sizes)), sizes)
    return np.arange(len(owner)) - (np.cumsum(sizes) - sizes)[owner] + starts[owner], owner


def stretches(words: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and stops of the parts whose every window occurs again in the same text.

    Windows are compared by hash; a collision keeps a part that need not be kept, no more.
    """
    size = len(words) - WINDOW + 1
    if size < 1:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    scattered = _scatter(words, 0)
    window = np.zeros(size, np.uint64)
    for i in range(WINDOW):
        window = window * _MIX + scattered[i : i + size]
    text = np.searchsorted(ends, np.arange(len(words)), "right")
    key = _scatter(window, 1) + text[:size].astype(np.uint64) * _MIX
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    again = np.zeros(size, bool)
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    again &= text[:size] == text[WINDOW - 1 :]
    edges = np.flatnonzero(np.diff(np.concatenate([[False], again, [False]])))
    starts, stops = edges[::2], edges[1::2] + WINDOW - 1
    long = stops - starts >= LEAST
    return starts[long], stops[long]


class Grammar:
    """Nonterminals: a place of each, its length, its boundary, and all places it derives."""

    def __init__(self, words: np.ndarray, starts: np.ndarray, stops: np.ndarray):
        self.at, self.part = _ranges(starts, stops - starts)
        values, self.symbols = np.unique(words[self.at], return_inverse=True)
        self.lengths = np.ones(len(values), np.int64)
        self.terminals = len(values)
        self.first: list[np.ndarray] = []
        self.middle: list[np.ndarray] = []
        self.derived: list[tuple[np.ndarray, np.ndarray]] = []
        while self._round():
            pass
        while self._fold():
            pass

    def _round(self) -> bool:
        """Replace all pairs that are more frequent than the pairs they overlap with."""
        joint = self.part[1:] == self.part[:-1]
        pair = self.symbols[:-1] * len(self.lengths) + self.symbols[1:]
        pairs, which = np.unique(np.where(joint, pair, -1), return_inverse=True)
        place = np.arange(len(which))
        # Of overlapping equal pairs, as in a row of one word, every other one counts.
        fresh = np.ones(len(which), bool)
        fresh[1:] = which[1:] != which[:-1]
        begun = np.maximum.accumulate(np.where(fresh, place, 0))
        usable = joint & ((place - begun) % 2 == 0)
        times = np.bincount(which[usable], minlength=len(pairs))
        usable &= times[which] > 1
        ties = np.random.default_rng(len(pairs)).permutation(len(pairs))
        weight = np.where(usable, times[which] * len(pairs) + ties[which], -1)
        around = np.concatenate([[-1], weight, [-1]])
        wins = usable & (weight > around[:-2]) & (weight > around[2:])
        wins &= np.bincount(which[wins], minlength=len(pairs))[which] > 1
        won = np.flatnonzero(wins)
        if len(won):
            _, first, rule = np.unique(which[won], return_index=True, return_inverse=True)
            self._replace(won, first, rule)
        return len(won) > 0

    def _fold(self) -> bool:
        """Join every other neighbour of what is left of a stretch."""
        joint = self.part[1:] == self.part[:-1]
        place = np.arange(len(self.part))
        fresh = np.ones(len(self.part), bool)
        fresh[1:] = ~joint
        begun = np.maximum.accumulate(np.where(fresh, place, 0))
        won = np.flatnonzero(joint & ((place - begun)[:-1] % 2 == 0))
        if len(won):
            each = np.arange(len(won))
            self._replace(won, each, each)
        return len(won) > 0

    def _replace(self, won: np.ndarray, first: np.ndarray, rule: np.ndarray) -> None:
        left, right = self.symbols[won[first]], self.symbols[won[first] + 1]
        symbol = len(self.lengths) + rule
        self.first.append(self.at[won[first]])
        self.middle.append(self.at[won[first]] + self.lengths[left])
        self.derived.append((symbol - self.terminals, self.at[won]))
        self.lengths = np.concatenate([self.lengths, self.lengths[left] + self.lengths[right]])
        self.symbols[won] = symbol
        keep = np.ones(len(self.symbols), bool)
        keep[won + 1] = False
        self.symbols, self.at, self.part = self.symbols[keep], self.at[keep], self.part[keep]


class _Equal:
    """How far words agree onwards or backwards from two places, by hashes of spans."""

    def __init__(self, words: np.ndarray, seed: int):
        self.sums, self.inverse = byte_sums(_scatter(words, seed))

    def _same(self, a: np.ndarray, b: np.ndarray, size: np.ndarray | int) -> np.ndarray:
        one = (self.sums[a + size] - self.sums[a]) * self.inverse[a]
        return one == (self.sums[b + size] - self.sums[b]) * self.inverse[b]

    def reach(self, a: np.ndarray, b: np.ndarray, limit: np.ndarray, back: bool) -> np.ndarray:
        """Words from ``a`` and ``b`` on (or before them) that agree, up to ``limit``."""
        far = np.zeros(len(a), np.int64)
        step = 1 << int(limit.max(initial=0)).bit_length()
        while step:
            open_ = np.flatnonzero(far + step <= limit)
            x, y, done = a[open_], b[open_], far[open_]
            at = (x - done - step, y - done - step) if back else (x + done, y + done)
            far[open_[self._same(*at, step)]] += step
            step >>= 1
        return far


def crossing(
    words: np.ndarray, first: np.ndarray, middle: np.ndarray, length: np.ndarray, equal: _Equal
) -> tuple[np.ndarray, ...]:
    """Repetitions across each boundary: nonterminal, start, stop (in ``words``) and period.

    One of the two sides holds a period and a half, so the word next to the boundary on that
    side comes again a period further; these places are the candidates.
    """
    ids = np.unique(words, return_inverse=True)[1]
    order = np.argsort(ids, kind="stable")
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    keys = ids[order] * len(words) + order
    last = first + length
    most = length // EXPONENT
    found = [(np.zeros(0, np.int64),) * 4]
    for right in (True, False):
        here = middle if right else middle - 1
        reach = np.minimum(most, last - 1 - here if right else here - first)
        if right:
            low = place[here] + 1
            high = np.searchsorted(keys, ids[here] * len(words) + here + reach, "right")
        else:
            low = np.searchsorted(keys, ids[here] * len(words) + here - reach, "left")
            high = place[here]
        sizes = np.maximum(0, high - low)
        done = np.cumsum(sizes)
        begin = 0
        while begin < len(sizes):
            limit = done[begin] - sizes[begin] + AT_ONCE
            stop = max(begin + 1, int(np.searchsorted(done, limit, "right")))
            at, owner = _ranges(low[begin:stop], sizes[begin:stop])
            owner += begin
            begin = stop
            period = np.abs(order[at] - here[owner])
            half = (period - 1) // 2
            x = here[owner] + half if right else here[owner] - half - period
            inside = (x >= first[owner]) & (x + period < last[owner])
            owner, period, x = owner[inside], period[inside], x[inside]
            fits = words[x] == words[x + period]
            owner, period = owner[fits], period[fits]
            a = middle[owner] if right else middle[owner] - period
            b = a + period
            start = a - equal.reach(a, b, a - first[owner], True)
            stop_ = b + equal.reach(a, b, last[owner] - b, False)
            size = stop_ - start
            good = (size >= LEAST) & (size >= EXPONENT * period)
            good &= (start < middle[owner]) & (stop_ > middle[owner])
            found.append((owner[good], start[good], stop_[good], period[good]))
    owner, start, stop_, period = map(np.concatenate, zip(*found))
    return _smallest(owner, start, stop_, period)


def _smallest(*columns: np.ndarray) -> tuple[np.ndarray, ...]:
    """Of rows that agree in all but the last column, the one with the least of it."""
    order = np.lexsort(columns[::-1])
    columns = tuple(c[order] for c in columns)
    new = np.ones(len(order), bool)
    if len(order):
        new[1:] = np.any([c[1:] != c[:-1] for c in columns[:-1]], axis=0)
    return tuple(c[new] for c in columns)


def _merged(start: np.ndarray, stop: np.ndarray, period: np.ndarray) -> tuple[np.ndarray, ...]:
    """Repetitions of one period that overlap by a period or more are one."""
    order = np.lexsort((start, period))
    start, stop, period = start[order], stop[order], period[order]
    if not len(start):
        return start, stop, period
    width = int(stop.max()) + 1
    level = np.maximum.accumulate(stop + period * width) - period * width
    new = np.ones(len(start), bool)
    new[1:] = (period[1:] != period[:-1]) | (start[1:] > level[:-1] - period[1:])
    at = np.flatnonzero(new)
    start, period, stop = start[at], period[at], np.maximum.reduceat(stop, at)
    return _smallest(start, stop, period)


def runs(words: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, stops and periods of all runs, by start and period.

    ``words`` are the numbered words of some texts, one after another, and ``ends`` says where
    each text ends. No run spans two texts.
    """
    starts, stops = stretches(words, ends)
    if not len(starts):
        return starts, stops, starts
    grammar = Grammar(words, starts, stops)
    first, middle = np.concatenate(grammar.first), np.concatenate(grammar.middle)
    length = grammar.lengths[grammar.terminals :]
    rules, places = map(np.concatenate, zip(*grammar.derived))
    by_rule = np.argsort(rules, kind="stable")
    places = places[by_rule]
    begins = np.searchsorted(rules[by_rule], np.arange(len(length)))
    times = np.bincount(rules, minlength=len(length))
    long = np.flatnonzero(length >= LEAST)
    for seed in count():
        equal = _Equal(words, seed)
        rule, start, stop, period = crossing(
            words, first[long], middle[long], length[long], equal
        )
        rule = long[rule]
        at, owner = _ranges(begins[rule], times[rule])
        shift = places[at] - first[rule][owner]
        start, stop, period = _merged(start[owner] + shift, stop[owner] + shift, period[owner])
        a, owner = _ranges(start, stop - start - period)
        if np.array_equal(words[a], words[a + period[owner]]):  # else: hashes collided
            order = np.lexsort((period, start))
            return start[order], stop[order], period[order]


def _split(texts: list[str]) -> tuple[list[list[bytes]], np.ndarray, np.ndarray]:
    """The words of each text, their numbers one after another, and where texts end."""
    split = [t.encode("utf-8", "surrogatepass").split() for t in texts]
    known: dict[bytes, int] = {}
    number = known.setdefault
    ids = np.fromiter((number(w, len(known)) for own in split for w in own), np.int64)
    return split, ids, np.cumsum([len(own) for own in split])


RUN = "array<struct<start: bigint, length: bigint, period: bigint>>"
FOUND = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def _find(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text"):
        split, ids, ends = _split(batch["text"].to_pylist())
        start, stop, period = runs(ids, ends)
        text = np.searchsorted(ends, start, "right")
        begins = ends - [len(own) for own in split]
        within = pa.StructArray.from_arrays(
            [pa.array(start - begins[text]), pa.array(stop - start), pa.array(period)],
            fields=list(FOUND),
        )
        offsets = np.searchsorted(text, np.arange(len(split) + 1)).astype(np.int32)
        keep = np.ones(len(ids), bool)
        keep[_ranges(start + period, stop - start - period)[0]] = False
        joined = [b" ".join(own) for own in split]
        for i in np.unique(text).tolist():
            kept = np.flatnonzero(keep[begins[i] : ends[i]]).tolist()
            joined[i] = b" ".join([split[i][k] for k in kept])
        yield pa.RecordBatch.from_arrays(
            [
                batch["doc_id"],
                pa.array([len(own) for own in split], pa.int64()),
                pa.ListArray.from_arrays(pa.array(offsets), within),
                pa.array([j.decode("utf-8", "surrogatepass") for j in joined], pa.string()),
            ],
            names=["doc_id", "n_words", "runs", "collapsed"],
        )


def find_runs(docs: DataFrame) -> DataFrame:
    """All runs of every document, and its text with each run cut to its first period.

    Columns: ``doc_id``, ``n_words``, ``runs`` (start and length in words, and period; by
    start, then period) and ``collapsed`` (words joined by one space; a word goes if any run
    contains it after that run's first period). One row per input row, repeated rows too. Null
    and empty texts have no words and no runs. Texts are read whole, however long; a very long
    one is worked on alone. Other columns are ignored.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of("text").alias("text"))
    schema = f"doc_id long, n_words long, runs {RUN}, collapsed string"
    return rows.mapInArrow(_find, schema)
