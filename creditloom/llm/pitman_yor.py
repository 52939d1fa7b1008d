"""Scores of texts by a hierarchical Pitman-Yor model of words.

Every word that occurs as a context has a restaurant whose customers are the words that
follow it. Its tables send one customer each to the restaurant all contexts share, their
parent, whose own tables draw from all words alike. The seating is sampled by blocks of Gibbs: in
every round all customers of a word get up and sit down again, at tables of the same word by
their sizes less a discount, or at new ones by what the parent expects. Several samples are kept,
and a text's score adds up the logarithms of the word probabilities averaged over them.

Work is dealt in three ways, each with bounded pieces: texts in blocks, pairs of neighbouring
words in buckets by a hash of both (so no restaurant, however busy, has to be in one task),
and words in parts. A block counts its own words and pairs first, and sends each of them once, in
packed arrays; what a bucket must know of a word, and the reverse, travels the same way. A round
of sampling sees the totals of other buckets as they were after the round before.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditloom.llm.common import slices, small_batches, text_of
from creditloom.sources.staging import discard, stage

BLOCK_BYTES = 16 << 20
"""Text that a block counts together, about; a longer text is a block of its own."""
BUCKET_PAIRS = 1_000_000
PART_WORDS = 300_000
"""Entries of one bucket and of one part that the blocks send, at most about."""
ROUNDS, SAMPLES = 3, 2
"""Rounds of sampling, and how many of the last ones are kept."""
FEW = 400
"""Up to so many customers of a dish the number of their tables is drawn exactly."""
GET_UP = (1.0, 0.25, 1.0, 0.06, 1.0, 0.25, 1.0, 0.015)
"""Shares of the tables of larger dishes that get up, pass by pass; all do in every other one."""
SEATED_AT_ONCE = 4_000_000
"""Customers of dishes that are drawn together, about."""
STRENGTH = 1.0
SEED = 11
ADD = 0.1
"""What the base score adds to every count."""

CODED = (
    "block long, docs array<bigint>, held array<boolean>, sizes array<bigint>, n_words long, "
    "tokens binary, words binary, counts binary"
)
MESSAGE = "part long, src long, kind string, n long, x long, y long, a binary, b binary, c binary"
_FIELDS = pa.schema(
    [(n, pa.int64()) for n in ("part", "src")]
    + [("kind", pa.string())]
    + [(n, pa.int64()) for n in "nxy"]
    + [(n, pa.binary()) for n in "abc"]
)
_MIX = np.uint64(0xD6E8FEB86659FD93)


def _scatter(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    h = (a.astype(np.uint64) * _MIX + b.astype(np.uint64)) * _MIX
    h = (h ^ (h >> np.uint64(32))) * _MIX
    return h ^ (h >> np.uint64(29))


# Messages: rows of MESSAGE that carry arrays to a part, bucket or block.


def pack(array: np.ndarray) -> bytes:
    """The numbers of an array, the first bytes of all before the second ones, compressed."""
    raw = np.ascontiguousarray(array.reshape(-1)).view(np.uint8)
    raw = np.ascontiguousarray(raw.reshape(-1, array.dtype.itemsize).T).tobytes()
    return len(raw).to_bytes(8, "little") + pa.compress(raw, "zstd", asbytes=True)


def unpack(data: bytes, dtype: str) -> np.ndarray:
    size, width = int.from_bytes(data[:8], "little"), np.dtype(dtype).itemsize
    raw = pa.decompress(data[8:], size, "zstd", asbytes=True)
    parts = np.frombuffer(raw, np.uint8).reshape(width, -1)
    return np.ascontiguousarray(parts.T).view(dtype).reshape(-1)


def _send(part, src, kind: str, *arrays: np.ndarray, x: int = 0, y: int = 0) -> tuple:
    packed = [pack(a) for a in arrays] + [None] * (3 - len(arrays))
    return (int(part), int(src), kind, arrays[0].size, int(x), int(y), *packed)


def _table(messages: list[tuple]) -> pa.Table:
    columns = list(zip(*messages)) or [()] * len(_FIELDS)
    return pa.table([pa.array(c, f.type) for c, f in zip(columns, _FIELDS)], schema=_FIELDS)


class _Inbox:
    """The messages of one group, by kind and then by sender."""

    def __init__(self, table: pa.Table):
        self.rows: dict[str, list[dict]] = {}
        for row in table.to_pylist():
            self.rows.setdefault(row["kind"], []).append(row)
        for rows in self.rows.values():
            rows.sort(key=lambda r: (r["src"], r["x"]))

    def of(self, kind: str) -> list[dict]:
        return self.rows.get(kind, [])

    def joined(self, kind: str, field: str, dtype: str) -> np.ndarray:
        parts = [unpack(row[field], dtype) for row in self.of(kind)]
        return np.concatenate(parts) if parts else np.zeros(0, dtype)


def _by_target(target: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int, int]]]:
    """An order that puts equal targets together, and each target with its range in it."""
    order = np.argsort(target, kind="stable")
    sorted_ = target[order]
    starts = np.flatnonzero(np.concatenate([[True], sorted_[1:] != sorted_[:-1]]))[: len(target)]
    stops = np.append(starts[1:], len(target))
    return order, list(zip(sorted_[starts].tolist(), starts.tolist(), stops.tolist()))


def _back(order: np.ndarray, replies: np.ndarray) -> np.ndarray:
    """Replies that came by target, in the order in which was asked."""
    out = np.empty_like(replies)
    out[..., order] = replies
    return out


def _grouped(messages: DataFrame, step: Callable[[int, _Inbox], list[tuple]]) -> DataFrame:
    """One call of ``step`` for all messages to one part."""

    def run(table: pa.Table) -> pa.Table:
        return _table(step(table["part"][0].as_py(), _Inbox(table)))

    return messages.groupBy("part").applyInArrow(run, MESSAGE)


def _of_kind(messages: DataFrame, *kinds: str) -> DataFrame:
    return messages.filter(F.col("kind").isin(*kinds))


# Blocks of texts.


def _block(number: int, rows: list[tuple]) -> dict:
    """One block: its texts as numbers of its own words, and its counts of training words.

    Every text ends with word 0, the end, which is also what precedes its first word.
    """
    known: dict[bytes, int] = {b"": 0}
    name = known.setdefault
    coded = []
    for _, _, text in rows:
        own = text.encode("utf-8", "surrogatepass").lower().split()
        numbers = chain((name(w, len(known)) for w in own), (0,))
        coded.append(np.fromiter(numbers, "<u4", len(own) + 1))
    tokens, sizes = np.concatenate(coded), [len(c) for c in coded]
    learned = np.repeat([not held for _, held, _ in rows], sizes)
    counts = np.bincount(tokens[learned], minlength=len(known)).astype("<i8")
    hashes = b"".join([hashlib.blake2b(w, digest_size=8).digest() for w in known])
    return {
        "block": number,
        "docs": [doc for doc, _, _ in rows],
        "held": [held for _, held, _ in rows],
        "sizes": sizes,
        "n_words": len(known),
        "tokens": pack(tokens),
        "words": pack(np.frombuffer(hashes, "<u8")),
        "counts": pack(counts),
    }


def _code(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.bool_()), pa.list_(pa.int64())]
    schema = pa.schema(
        list(zip(("block", "docs", "held", "sizes"), kinds))
        + [("n_words", pa.int64())]
        + [(n, pa.binary()) for n in ("tokens", "words", "counts")]
    )
    number = TaskContext.get().partitionId() << 32
    rows: list[tuple] = []
    size = 0
    for batch in slices(batches, "text", BLOCK_BYTES):
        own = list(zip(*[batch[c].to_pylist() for c in ("doc_id", "held_out", "text")]))
        more = sum(len(t) for _, _, t in own)
        if rows and size + more > BLOCK_BYTES:
            yield pa.RecordBatch.from_pylist([_block(number, rows)], schema)
            number, rows, size = number + 1, [], 0
        rows += own
        size += more
    if rows:
        yield pa.RecordBatch.from_pylist([_block(number, rows)], schema)


def _block_pairs(coded: dict) -> tuple[np.ndarray, ...]:
    """First and second word of the block's different pairs, the pair of each token, counts."""
    tokens = unpack(coded["tokens"], "<u4").astype(np.int64)
    n = coded["n_words"]
    before = np.concatenate([[0], tokens[:-1]])
    pairs, which = np.unique(before * n + tokens, return_inverse=True)
    learned = np.repeat(~np.array(coded["held"], bool), coded["sizes"])
    return pairs // n, pairs % n, which, np.bincount(which[learned], minlength=len(pairs))


def _word_order(coded: dict, parts: int) -> tuple[np.ndarray, list[tuple[int, int, int]]]:
    hashes = unpack(coded["words"], "<u8")
    return _by_target((hashes % np.uint64(parts)).astype(np.int64))


def _ask_words(parts: int):
    def ask(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for coded in batch.to_pylist():
                hashes, counts = unpack(coded["words"], "<u8"), unpack(coded["counts"], "<i8")
                order, ranges = _word_order(coded, parts)
                found = [
                    _send(p, coded["block"], "word", hashes[order[i:j]], counts[order[i:j]])
                    for p, i, j in ranges
                ]
                yield from _table(found).to_batches()

    return ask


def _number_words(parts: int):
    """Words of a part get places and their counts, for every block that asked.

    Frequent words come first, as small numbers pack well. A word's number is its place times
    ``parts``, and its part.
    """

    def number(part: int, inbox: _Inbox) -> list[tuple]:
        hashes = inbox.joined("word", "a", "<u8")
        words, which = np.unique(hashes, return_inverse=True)
        total = np.bincount(which, inbox.joined("word", "b", "<i8")).astype("<i8")
        order = np.argsort(-total, kind="stable")
        place = np.empty_like(order)
        place[order] = np.arange(len(order))
        which, total = place[which], total[order]
        out, at = [], 0
        for row in inbox.of("word"):
            own = which[at : at + row["n"]]
            at += len(own)
            out.append(_send(row["src"], part, "ids", own.astype("<u4"), total[own]))
        seen = int((total > 0).sum())
        return [*out, _send(part, part, "counts", total, x=int(total.sum()), y=seen)]

    return number


def _ids(coded: dict, inbox: _Inbox, parts: int) -> tuple[np.ndarray, np.ndarray]:
    hashes = unpack(coded["words"], "<u8")
    order, _ = _word_order(coded, parts)
    places = _back(order, inbox.joined("ids", "a", "<u4")).astype("<i8")
    return places * parts + (hashes % np.uint64(parts)).astype("<i8"), order


def _buckets_of(first: np.ndarray, second: np.ndarray, buckets: int):
    return _by_target((_scatter(first, second) % np.uint64(buckets)).astype(np.int64))


def _ask_pairs(parts: int, buckets: int, id_type: str):
    def ask(left: pa.Table, right: pa.Table) -> pa.Table:
        coded, inbox = left.to_pylist()[0], _Inbox(right)
        ids, _ = _ids(coded, inbox, parts)
        first, second, _, counts = _block_pairs(coded)
        first, second = ids[first], ids[second]
        order, ranges = _buckets_of(first, second, buckets)
        first, second = first[order].astype(id_type), second[order].astype(id_type)
        counts = counts[order].astype("<u4")
        return _table(
            [
                _send(b, coded["block"], "pairs", first[i:j], second[i:j], counts[i:j])
                for b, i, j in ranges
            ]
        )

    return ask


# Buckets of pairs.


def _count_pairs(parts: int, id_type: str):
    """Counts of a bucket's pairs, and what is known of them without sampling.

    A pair that occurs once has one table. Pairs that occur again are sampled; they start at
    one table as well. ``codes`` tell each block 0 for a pair never learned, 1 for one learned
    once, and from 2 on the place among the others. ``tables`` count tables by word, as a
    context and as a dish.
    """

    def merge(bucket: int, inbox: _Inbox) -> list[tuple]:
        first = inbox.joined("pairs", "a", id_type)
        second = inbox.joined("pairs", "b", id_type)
        order = np.lexsort((second, first))
        a, b = first[order], second[order]
        new = np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])])[: len(a)]
        which = np.empty(len(a), np.int64)
        which[order] = np.cumsum(new) - 1
        a, b = a[new], b[new]
        total = np.bincount(which, inbox.joined("pairs", "c", "<u4"), len(a)).astype(np.int64)
        again, once = total > 1, total == 1
        code = np.where(again, np.cumsum(again) + 1, once).astype("<u4")
        out, at = [], 0
        for row in inbox.of("pairs"):
            own = which[at : at + row["n"]]
            at += len(own)
            out.append(_send(bucket, row["src"], "codes", code[own]))
        seats = [a[again], b[again], total[again].astype("<u4")]
        out.append(_send(bucket, bucket, "seats", *seats, x=once.sum(), y=(total == 2).sum()))
        words = np.unique(np.concatenate(seats[:2])).astype("<i8")
        order, ranges = _by_target(words % parts)
        places = (words // parts).astype("<u4")[order]
        out += [_send(p, bucket, "want", places[i:j]) for p, i, j in ranges]
        learned = total > 0
        words, which = np.unique(np.concatenate([a[learned], b[learned]]), return_inverse=True)
        half = len(which) // 2
        as_context = np.bincount(which[:half], minlength=len(words)).astype("<u4")
        as_dish = np.bincount(which[half:], minlength=len(words)).astype("<u4")
        words = words.astype(np.int64)
        order, ranges = _by_target(words % parts)
        places = (words // parts).astype("<u4")
        for p, i, j in ranges:
            own = order[i:j]
            out.append(_send(p, bucket, "tables", places[own], as_context[own], as_dish[own]))
        return out

    return merge


def _log_ways(customers: int, discount: float) -> np.ndarray:
    """Logarithms of generalised Stirling numbers: row n, place t for n customers at t tables."""
    out = np.full((customers + 1, customers + 1), -np.inf)
    out[0, 0] = 0
    t = np.arange(customers + 1)
    for n in range(customers):
        joined = out[n, : n + 1] + np.log(np.maximum(n - discount * t[: n + 1], 1e-300))
        out[n + 1, : n + 1] = joined
        out[n + 1, 1 : n + 2] = np.logaddexp(out[n + 1, 1 : n + 2], out[n, : n + 1])
    return out


def reseat(
    draw: np.random.Generator,
    customers: np.ndarray,
    tables: np.ndarray,
    sizes: np.ndarray,
    strength: np.ndarray | float,
    discount: float,
) -> tuple[np.ndarray, np.ndarray]:
    """Gibbs sampling of the seating of dishes: ``tables`` of each and their ``sizes`` in turn.

    All customers of every dish get up together and sit down again. A seating is as likely as the
    product over its tables of ``strength``, the restaurant's weight of new tables times the
    parent's probability of the dish, and of size less ``discount`` for each who joins. Up to
    FEW customers the number of tables is drawn from its exact distribution; as only that
    number bears on the model, the first table is given all that the others leave. Dishes
    of more customers go through :func:`_reseat_many`, in time that grows with their tables.
    """
    if not len(customers):
        return tables, sizes
    strength = np.broadcast_to(np.asarray(strength, float), customers.shape)
    taken = np.empty(len(customers), np.int64)
    few, seated = customers <= FEW, []
    small = np.flatnonzero(few)
    ways = _log_ways(int(customers[small].max(initial=0)), discount)
    ends = np.cumsum(customers[small])
    for part in np.split(small, np.flatnonzero(np.diff(ends // SEATED_AT_ONCE)) + 1):
        taken[part] = _draw_tables(draw, ways, customers[part], strength[part])
    several = np.flatnonzero(~few)
    if len(several):
        its_sizes = sizes[np.repeat(~few, tables)]
        taken[several], seated = _reseat_many(
            draw, customers[several], tables[several], its_sizes, strength[several], discount
        )
    out = np.ones(int(taken.sum()), np.int64)
    out[(np.cumsum(taken) - taken)[small]] = customers[small] - taken[small] + 1
    out[np.repeat(~few, taken)] = seated
    return taken, out


def _draw_tables(
    draw: np.random.Generator, ways: np.ndarray, customers: np.ndarray, strength: np.ndarray
) -> np.ndarray:
    """Numbers of tables, each from its distribution: ``ways`` times powers of ``strength``."""
    if not len(customers):
        return customers
    start = np.cumsum(customers) - customers
    t = np.arange(int(customers.sum())) - np.repeat(start, customers) + 1
    weight = ways[np.repeat(customers, customers), t] + t * np.repeat(np.log(strength), customers)
    weight = np.exp(weight - np.repeat(np.maximum.reduceat(weight, start), customers))
    run = np.cumsum(weight)
    before = run[start] - weight[start]
    goal = before + draw.random(len(start)) * np.add.reduceat(weight, start)
    at = np.searchsorted(run, goal, "right")
    return np.clip(at - start, 0, customers - 1) + 1


def _reseat_many(
    draw: np.random.Generator,
    customers: np.ndarray,
    tables: np.ndarray,
    sizes: np.ndarray,
    strength: np.ndarray,
    discount: float,
) -> tuple[np.ndarray, np.ndarray]:
    """Metropolis steps over whole tables; the largest table of each dish stands first after it.

    But for the largest, the tables of a dish are points of a Poisson process: ``strength`` /
    ``discount`` of them on average, with sizes of Sibuya's distribution, weighed by the chance of
    a table of the customers that are left for the largest. Both are tilted alike towards small
    tables, by a power of the size, so that the others seldom need more customers than there are.
    In each pass every other table gets up with a probability of GET_UP, new ones of that share
    are drawn, the largest table takes what remains, and the ratio of the weights decides.
    """
    low, high = np.zeros(len(customers)), 1 - 1 / customers
    for _ in range(40):  # the tilt at which tables are expected to take all customers
        tilt = (low + high) / 2
        above = strength * tilt * (1 - tilt) ** (discount - 1) + 1 / (1 - tilt) > customers
        low, high = np.where(above, low, tilt), np.where(above, tilt, high)
    tilt = np.log(high)
    dish = np.repeat(np.arange(len(tables)), tables)
    order = np.lexsort((-sizes, dish))
    start = np.cumsum(tables) - tables
    rest = np.ones(len(sizes), bool)
    rest[start] = False
    others, owner = sizes[order][rest], dish[rest]

    def weight(others: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        largest = customers - np.bincount(owner, others, len(customers)).astype(np.int64)
        most = np.zeros(len(customers), np.int64)
        np.maximum.at(most, owner, others)
        alike = np.bincount(owner, others == largest[owner], len(customers))
        size = np.maximum(largest, 1).astype(float)
        chance = _log_gamma(size - discount) - _log_gamma(size + 1) - np.log1p(alike) + largest * tilt
        return np.where(largest >= np.maximum(most, 1), chance, -np.inf), largest

    now, largest = weight(others, owner)
    for share in GET_UP:
        stays = draw.random(len(others)) >= share
        came = draw.poisson(share * strength / discount)
        whose = np.repeat(np.arange(len(customers)), came)
        rate = np.maximum(draw.beta(discount, 1 - discount, len(whose)), 1e-15)
        fresh = np.minimum(draw.geometric(rate), customers[whose] + 1)
        kept = np.log(1 - draw.random(len(fresh))) < fresh * tilt[whose]
        fresh, whose = fresh[kept], whose[kept]
        after, left = weight(
            np.concatenate([others[stays], fresh]), np.concatenate([owner[stays], whose])
        )
        moves = np.log(1 - draw.random(len(customers))) < after - now
        now, largest = np.where(moves, after, now), np.where(moves, left, largest)
        stays |= ~moves[owner]
        fresh, whose = fresh[moves[whose]], whose[moves[whose]]
        others = np.concatenate([others[stays], fresh])
        owner = np.concatenate([owner[stays], whose])
    dish = np.concatenate([np.arange(len(customers)), owner])
    order = np.argsort(dish, kind="stable")
    return np.bincount(dish), np.concatenate([largest, others])[order]


def _log_gamma(values: np.ndarray) -> np.ndarray:
    return np.fromiter(map(math.lgamma, values.tolist()), float, len(values))


def _base(low: np.ndarray, root: tuple[int, int, int], discount: float) -> np.ndarray:
    """The parent's probability of words, from customers less discounts."""
    tables, customers, vocabulary = root
    return (low + (STRENGTH + discount * tables) / (vocabulary + 1)) / (STRENGTH + customers)


def _seat_pairs(parts: int, id_type: str, turn: int, root: tuple, discount: float):
    """One round in a bucket, against the parent and the contexts as they were before it."""

    def seat(bucket: int, inbox: _Inbox) -> list[tuple]:
        row = inbox.of("seats")[0]
        first, second = unpack(row["a"], id_type), unpack(row["b"], id_type)
        customers = unpack(row["c"], "<u4").astype(np.int64)
        words, which = np.unique(np.concatenate([first, second]), return_inverse=True)
        order, ranges = _by_target(words.astype(np.int64) % parts)
        context, dish = which[: len(first)], which[len(first) :]
        its_tables = _back(order, inbox.joined("facts", "a", "<u4"))[context]
        base = _base(_back(order, inbox.joined("facts", "b", "<f4").astype(float)), root, discount)
        before = inbox.of("seating")
        if before:
            tables = unpack(before[0]["a"], "<u4").astype(np.int64)
            sizes = unpack(before[0]["b"], "<u4").astype(np.int64)
        else:
            tables, sizes = np.ones(len(customers), np.int64), customers
        strength = (STRENGTH + discount * its_tables) * base[dish]
        draw = np.random.default_rng([SEED, turn, bucket])
        tables, sizes = reseat(draw, customers, tables, sizes, strength, discount)
        # More than one table each; the first ones are known.
        extra = tables - 1
        as_context = np.bincount(context, extra, len(words)).astype("<u4")[order]
        as_dish = np.bincount(dish, extra, len(words)).astype("<u4")[order]
        out = [_send(bucket, bucket, "seating", tables.astype("<u4"), sizes.astype("<u4"), x=turn)]
        return out + [
            _send(p, bucket, "more", as_context[i:j], as_dish[i:j]) for p, i, j in ranges
        ]

    return seat


# Parts of words.


def _first_tables(part: int, inbox: _Inbox) -> list[tuple]:
    """Tables of each word as a context and as a dish when every pair has one."""
    size = inbox.of("counts")[0]["n"]
    at = inbox.joined("tables", "a", "<u4")
    sums = [np.bincount(at, inbox.joined("tables", f, "<u4"), size) for f in "bc"]
    return [_send(part, part, "least", *[s.astype("<i8") for s in sums])]


def _seat_words(turn: int, tables_before: int, vocabulary: int, discount: float):
    """The parent's restaurant: customers are the tables of all contexts.

    ``state`` keeps tables by context and what the parent gives each word before smoothing; the
    same goes as ``facts`` to the buckets that want it.
    """

    def seat(part: int, inbox: _Inbox) -> list[tuple]:
        least = inbox.of("least")[0]
        of_context = unpack(least["a"], "<i8").copy()
        customers = unpack(least["b"], "<i8").copy()
        more = {row["src"]: row for row in inbox.of("more")}
        for row in inbox.of("want"):
            if row["src"] in more:
                at = unpack(row["a"], "<u4")
                of_context[at] += unpack(more[row["src"]]["a"], "<u4")
                customers[at] += unpack(more[row["src"]]["b"], "<u4")
        tables = (customers > 0).astype(np.int64)
        sizes = customers[customers > 0]
        for row in inbox.of("root"):
            tables, sizes = _carried(
                customers,
                unpack(row["a"], "<u4").astype(np.int64),
                unpack(row["b"], "<i8"),
            )
        several = customers > 1
        weight = (STRENGTH + discount * tables_before) / (vocabulary + 1)
        draw = np.random.default_rng([SEED, turn, part, 1])
        of_several = np.repeat(several, tables)
        seated, sat = reseat(
            draw, customers[several], tables[several], sizes[of_several], weight, discount
        )
        tables[several] = seated
        sizes = np.ones(int(tables.sum()), np.int64)
        sizes[np.repeat(several, tables)] = sat
        low = (customers - discount * tables).astype("<f4")
        root = [tables.astype("<u4"), sizes.astype("<i8")]
        of_context = of_context.astype("<u4")
        out = [
            _send(part, part, "root", *root, x=customers.sum(), y=tables.sum()),
            _send(part, part, "state", of_context, low, x=turn),
        ]
        for row in inbox.of("want"):
            at = unpack(row["a"], "<u4")
            out.append(_send(row["src"], part, "facts", of_context[at], low[at]))
        return out

    return seat


def _carried(customers: np.ndarray, tables: np.ndarray, sizes: np.ndarray):
    """A seating of ``customers`` that keeps as much as can be of an earlier one.

    Who came joins the first table of a dish and who went leaves it; where it is too small
    for that, all tables keep one customer and the first one the rest.
    """
    tables, sizes = np.minimum(tables, customers), sizes.copy()
    seated = tables > 0
    start = (np.cumsum(tables) - tables)[seated]
    if len(sizes) != tables.sum():  # some dish has fewer customers than tables now
        sizes = np.ones(int(tables.sum()), np.int64)
    if len(start):
        sums = np.add.reduceat(sizes, start)
        sizes[start] += customers[seated] - sums
        short = np.repeat(sizes[start] < 1, tables[seated])
        sizes[short] = 1
        sums = np.add.reduceat(sizes, start)
        sizes[start] += customers[seated] - sums
    fresh = (customers > 0) & ~seated
    if fresh.any():
        owner = np.concatenate([np.repeat(np.arange(len(tables)), tables), np.flatnonzero(fresh)])
        sizes = np.concatenate([sizes, customers[fresh]])[np.argsort(owner, kind="stable")]
        tables = tables + fresh
    return tables, sizes


# Scores.


def _pair_answers(bucket: int, inbox: _Inbox) -> list[tuple]:
    """For every block the counts of its pairs, and their tables in each sample."""
    customers = np.concatenate([[0, 1], inbox.joined("seats", "c", "<u4")]).astype("<u4")
    samples = [
        np.concatenate([[0, 1], unpack(row["a"], "<u4")]).astype("<u4")
        for row in inbox.of("seating")
    ]
    out = []
    for row in inbox.of("codes"):
        code = unpack(row["a"], "<u4")
        tables = np.stack([s[code] for s in samples])
        out.append(_send(row["src"], bucket, "hits", customers[code], tables))
    return out


def _word_answers(part: int, inbox: _Inbox) -> list[tuple]:
    """For every block what each sample says of its words."""
    contexts = [unpack(r["a"], "<u4") for r in inbox.of("state")]
    lows = [unpack(r["b"], "<f4") for r in inbox.of("state")]
    out = []
    for row in inbox.of("ids"):
        at = unpack(row["a"], "<u4")
        context, low = np.stack([c[at] for c in contexts]), np.stack([s[at] for s in lows])
        out.append(_send(row["src"], part, "of-words", context, low))
    return out


SCORED = (
    "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"
)


def _score_block(parts: int, buckets: int, roots: list[tuple], total: int, discount: float):
    vocabulary = roots[0][2]

    def rows_of(inbox: _Inbox, kind: str, field: str, dtype: str) -> np.ndarray:
        each = [unpack(r[field], dtype).reshape(len(roots), -1) for r in inbox.of(kind)]
        return np.concatenate(each, axis=1)

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        coded, inbox = left.to_pylist()[0], _Inbox(right)
        ids, order = _ids(coded, inbox, parts)
        n = _back(order, inbox.joined("ids", "b", "<i8"))
        its_tables = _back(order, rows_of(inbox, "of-words", "a", "<u4"))
        low = _back(order, rows_of(inbox, "of-words", "b", "<f4"))
        first, second, which, _ = _block_pairs(coded)
        order, _ = _buckets_of(ids[first], ids[second], buckets)
        customers = _back(order, inbox.joined("hits", "a", "<u4")).astype(float)
        tables = _back(order, rows_of(inbox, "hits", "b", "<u4"))
        chance = np.zeros(len(first))
        for s, root in enumerate(roots):
            parent = _base(low[s].astype(float), root, discount)[second]
            new = STRENGTH + discount * its_tables[s][first]
            own = np.maximum(customers - discount * tables[s], 0)
            chance += (own + new * parent) / (STRENGTH + n[first])
        pair_score = np.log10(chance / len(roots))
        tokens = unpack(coded["tokens"], "<u4")
        base = np.log10((n + ADD) / (total + ADD * (vocabulary + 1)))
        starts = np.cumsum(coded["sizes"]) - coded["sizes"]
        known = (n[tokens] > 0).astype(np.int64)
        sums = [np.add.reduceat(v, starts) for v in (known, base[tokens], pair_score[which])]
        columns = [coded["docs"], coded["held"], coded["sizes"], *sums]
        kinds = [pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.float64()]
        names = ["doc_id", "held_out", "n_tokens", "n_known", "base_score", "score"]
        return pa.table([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    return score


def _cogrouped(coded: DataFrame, messages: DataFrame, step, schema: str) -> DataFrame:
    """One call of ``step`` for every block and all messages to it."""
    return coded.groupBy("block").cogroup(messages.groupBy("part")).applyInArrow(step, schema)


def _kept(df: DataFrame, label: str) -> DataFrame:
    return stage(df, label, compression="zstd")


def score(docs: DataFrame, held_out: Column) -> DataFrame:
    """Scores of all documents by a model learned from those that are not ``held_out``.

    Columns: ``doc_id``, ``held_out``, ``n_tokens`` (words and one end), ``n_known`` (tokens that
    occur in learned texts), ``train_tokens``, ``base_score`` (log10 of smoothed word frequencies)
    and ``score`` (log10 of the model's probability of the text). One row per input row, repeated
    rows too. Words are runs without white space, A-Z in lower case. Null and empty texts are the
    end alone; if nothing is learned, all words are alike. Texts are read whole, however long.
    ``held_out`` is a condition on the documents, null is false; other columns are ignored.
    """
    spark = docs.sparkSession
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(held_out, F.lit(False)).alias("held_out"),
        text_of("text").alias("text"),
    )
    with small_batches(spark):
        coded = _kept(rows.mapInArrow(_code, CODED), "coded")
    with small_batches(spark, 4):  # of whole blocks
        return _scored(coded)


def _scored(coded: DataFrame) -> DataFrame:
    size = coded.agg(
        F.coalesce(F.sum("n_words"), F.lit(0)).alias("words"),
        F.coalesce(
            F.sum(F.aggregate("sizes", F.lit(0).cast("long"), lambda a, n: a + n)), F.lit(0)
        ).alias("tokens"),
    ).first()
    # By size alone: more of them would only mean more and smaller messages.
    parts = size.words // PART_WORDS + 1
    buckets = size.tokens // BUCKET_PAIRS + 1
    asked = coded.select("block", "words", "counts").mapInArrow(_ask_words(parts), MESSAGE)
    words = _kept(_grouped(asked, _number_words(parts)), "words")
    known = _of_kind(words, "counts").agg(
        F.coalesce(F.sum("x"), F.lit(0)).alias("total"),
        F.coalesce(F.sum("y"), F.lit(0)).alias("vocabulary"),
        F.coalesce(F.max("n"), F.lit(0)).alias("longest"),
    ).first()
    id_type = "<u4" if (known.longest + 1) * parts < 1 << 32 else "<i8"
    ids = _of_kind(words, "ids")
    pairs = _cogrouped(coded, ids, _ask_pairs(parts, buckets, id_type), MESSAGE)
    counted = _kept(_grouped(pairs, _count_pairs(parts, id_type)), "pairs")
    once, twice = _of_kind(counted, "seats").agg(
        F.coalesce(F.sum("x"), F.lit(0)), F.coalesce(F.sum("y"), F.lit(0))
    ).first()
    discount = (once + 1) / (once + 2 * twice + 2)  # as the counts of counts suggest
    both = _of_kind(words, "counts").unionByName(_of_kind(counted, "tables"))
    least = _kept(_grouped(both, _first_tables), "least")
    want, seats = _of_kind(counted, "want"), _of_kind(counted, "seats")
    vocabulary, tables = known.vocabulary, known.vocabulary
    words_seated = pairs_seated = None
    samples, roots = [], []
    for turn in range(ROUNDS + 1):
        told = [least, want]
        if turn:
            told += [_of_kind(pairs_seated, "more"), _of_kind(words_seated, "root")]
        seat = _seat_words(turn, tables, vocabulary, discount)
        after = _kept(_grouped(_all(told), seat), "word-seats")
        if 0 < turn <= ROUNDS - SAMPLES + 1:
            discard(words_seated)
        words_seated = after
        customers, tables = _of_kind(after, "root").agg(
            F.coalesce(F.sum("x"), F.lit(0)), F.coalesce(F.sum("y"), F.lit(0))
        ).first()
        root = (tables, customers, vocabulary)
        sampled = turn > ROUNDS - SAMPLES
        if sampled:
            samples += [_of_kind(after, "state"), _of_kind(pairs_seated, "seating")]
            roots.append(root)
        if turn < ROUNDS:
            told = [seats, _of_kind(after, "facts")]
            told += [_of_kind(pairs_seated, "seating")] if turn else []
            seat = _seat_pairs(parts, id_type, turn, root, discount)
            after = _kept(_grouped(_all(told), seat), "pair-seats")
            if turn and not sampled:
                discard(pairs_seated)
            pairs_seated = after
    hits = _grouped(_all([_of_kind(counted, "codes"), seats, *samples[1::2]]), _pair_answers)
    swapped = ids.withColumns({"part": F.col("src"), "src": F.col("part")})
    of_words = _grouped(_all([swapped, *samples[::2]]), _word_answers)
    answers = _all([ids, hits, of_words])
    step = _score_block(parts, buckets, roots, known.total, discount)
    scored = _cogrouped(coded, answers, step, SCORED)
    return scored.withColumn("train_tokens", F.lit(known.total).cast("long"))


def _all(messages: list[DataFrame]) -> DataFrame:
    out = messages[0]
    for more in messages[1:]:
        out = out.unionByName(more)
    return out
