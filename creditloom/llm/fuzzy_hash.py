"""Document fingerprints by context-triggered piecewise hashing.

A rolling hash over the last ``SPAN`` bytes of a text ends a chunk wherever it hits a
boundary value of the block size, so boundaries depend on what is around them and not on
their place. Each chunk is hashed to one of 64 letters. The block size grows with the text
until the signature has at most ``LETTERS`` letters; the signatures at two and four times
that size are kept as well, so that texts of other lengths can be compared. Nothing is cut
off.

Fingerprint: ``block size:signature:at twice the block size:at four times``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from creditloom.llm.common import byte_sums, span_hashes, text_of
from creditloom.sources.staging import stage

SPAN = 7
LETTERS = 64
SMALLEST = 3
COMMON_RUN = 4
"""Signatures without a common run of so many letters (or the shorter one's) are unlike."""
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"

_ROLL = np.uint32(0x01000193)


def fingerprint(text: str) -> str:
    """The fingerprint of a whole text, over its UTF-8 bytes."""
    data = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    size = len(data)
    if size == 0:
        return f"{SMALLEST}:::"
    rolling = np.zeros(size, np.uint32)
    for back in range(min(SPAN, size) - 1, -1, -1):  # Horner; the window fills up at the start
        rolling *= _ROLL
        rolling[back:] += data[: size - back]
    rolling ^= rolling >> np.uint32(15)
    rolling *= np.uint32(0x2C1B3C6D)
    rolling ^= rolling >> np.uint32(12)
    # A boundary of a block size is one of every smaller block size.
    ends = np.flatnonzero(rolling % np.uint32(SMALLEST) == SMALLEST - 1)
    block = SMALLEST
    while len(ends) >= LETTERS:
        block *= 2
        ends = ends[rolling[ends] % np.uint32(block) == block - 1]
    prefix = byte_sums(data)
    signatures = [_letters(prefix, ends)]
    for times in (2, 4):
        wider = np.uint32(times * block)
        ends = ends[rolling[ends] % wider == wider - 1]
        signatures.append(_letters(prefix, ends))
    return ":".join([str(block), *signatures])


def _letters(prefix: tuple[np.ndarray, np.ndarray], ends: np.ndarray) -> str:
    """A letter for each chunk; the last chunk reaches to the end of the text."""
    size = len(prefix[0]) - 1
    stops = ends + 1
    if not len(stops) or stops[-1] != size:
        stops = np.append(stops, size)
    chunks = span_hashes(prefix, np.concatenate([[0], stops[:-1]]), stops)
    return "".join([ALPHABET[i] for i in (chunks >> np.uint64(58)).tolist()])


def edit_distance(a: str, b: str) -> int:
    """Levenshtein distance, a column of the table at a time as bits of an integer."""
    if not a or not b:
        return len(a) + len(b)
    full, top = (1 << len(a)) - 1, 1 << (len(a) - 1)
    places: dict[str, int] = {}
    for i, letter in enumerate(a):
        places[letter] = places.get(letter, 0) | (1 << i)
    up, down, distance = full, 0, len(a)
    for letter in b:
        same = places.get(letter, 0)
        cross = (((same & up) + up) ^ up) | same | down
        rises, falls = down | (full & ~(cross | up)), up & cross
        distance += bool(rises & top) - bool(falls & top)
        rises, falls = ((rises << 1) | 1) & full, (falls << 1) & full
        up = falls | (full & ~((same | down) | rises))
        down = rises & (same | down)
    return distance


def _common_run(a: str, b: str, run: int) -> bool:
    runs = {a[i : i + run] for i in range(len(a) - run + 1)}
    return any(b[i : i + run] in runs for i in range(len(b) - run + 1))


def _alike(a: str, b: str) -> float:
    if a == b:
        return 1.0
    shorter = min(len(a), len(b))
    if not shorter or not _common_run(a, b, min(COMMON_RUN, shorter)):
        return 0.0
    return 1.0 - edit_distance(a, b) / max(len(a), len(b))


def likeness(one: str, other: str) -> float:
    """0 to 1: one minus the relative edit distance of signatures at a common block size.

    Equal fingerprints give 1; without a common block size, or a common run of letters at
    one, they are unlike (0). Of several common block sizes the best counts.
    """
    if one == other:
        return 1.0
    at, *signatures = one.split(":")
    other_at, *other_signatures = other.split(":")
    found = {int(at) << i: letters for i, letters in enumerate(signatures)}
    pairs = [
        (found[int(other_at) << i], letters)
        for i, letters in enumerate(other_signatures)
        if int(other_at) << i in found
    ]
    return max((_alike(a, b) for a, b in pairs), default=0.0)


def edited_text(text: str, following: str) -> str:
    """The last half of the text replaced by as much of the beginning of the other."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


SCHEMA = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_chars", pa.int64()),
        ("edited_sha256", pa.string()),
        ("fingerprint", pa.string()),
        ("edited_fingerprint", pa.string()),
        ("near_edited", pa.float64()),
        ("near_next", pa.float64()),
    ]
)
RESULT = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
    "edited_fingerprint string, near_edited double, near_next double"
)


def compare(doc_id, text: str, mark: str, following: str, next_mark: str) -> tuple:
    """A result row for a text, its fingerprint, the next text and its fingerprint."""
    edited = edited_text(text, following)
    edited_mark = mark if edited == text else fingerprint(edited)
    return (
        doc_id,
        len(text),
        hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(),
        mark,
        edited_mark,
        likeness(mark, edited_mark),
        likeness(mark, next_mark),
    )


def _in_order(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Results of a sorted range, but its last row; that and the first are given as texts."""
    part = TaskContext.get().partitionId()
    head = last = None
    for batch in batches:
        rows = []
        for doc, text in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist()):
            row = (doc, text, fingerprint(text))
            if last is None:
                head = row
            else:
                rows.append(compare(*last, text, row[2]))
            last = row
        yield _batch(rows, part, None, [None] * len(rows))
    if last is not None:
        empty = [(row[0], *[None] * 6) for row in (head, last)]
        yield _batch(empty[:1], part, "head", [head[1]])
        yield _batch(empty[1:], part, "tail", [last[1]])


def _batch(rows: list[tuple], part: int, kind: str | None, texts: list) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [[] for _ in SCHEMA]
    arrays = [pa.array(c, f.type) for c, f in zip(columns, SCHEMA)]
    count = len(rows)
    return pa.RecordBatch.from_arrays(
        [
            *arrays,
            pa.array([part] * count, pa.int32()),
            pa.array([kind] * count, pa.string()),
            pa.array(texts, pa.string()),
        ],
        names=[*SCHEMA.names, "part", "kind", "text"],
    )


def _across(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [
            compare(doc, text, fingerprint(text), following, fingerprint(following))
            for doc, text, following in zip(*[batch[i].to_pylist() for i in range(3)])
        ]
        columns = list(zip(*rows)) if rows else [[] for _ in SCHEMA]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(columns, SCHEMA)], schema=SCHEMA
        )


def fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited form, and how like they are.

    Columns as ``RESULT``; one row per input row. Null text is empty. The next document is
    that of the next larger identifier, after the last the first; null identifiers come
    first, rows of equal identifiers are in the order of their texts. Other columns are
    ignored.

    Documents are dealt by ranges of identifiers, sorted, and read once in order. What meets
    across a border of ranges, one document on either side, is compared afterwards.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of("text").alias("text"))
    in_order = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    done = stage(
        in_order.mapInArrow(_in_order, f"{RESULT}, part int, kind string, text string"),
        "fingerprints",
    )
    borders = done.filter(F.col("kind").isNotNull()).select("part", "kind", "doc_id", "text")
    heads, tails = borders.filter("kind = 'head'"), borders.filter("kind = 'tail'")
    # One row per range that has documents: few, and thin.
    order = Window.orderBy("part")
    following = heads.select(
        "part",
        F.coalesce(
            F.lead("part").over(order),
            F.first("part").over(order.rowsBetween(Window.unboundedPreceding, 0)),
        ).alias("next_part"),
    )
    nexts = heads.select(F.col("part").alias("next_part"), F.col("text").alias("following"))
    pairs = tails.join(following, "part").join(nexts, "next_part")
    across = pairs.select("doc_id", "text", "following").mapInArrow(_across, RESULT)
    return done.filter(F.col("kind").isNull()).select(*SCHEMA.names).unionByName(across)
