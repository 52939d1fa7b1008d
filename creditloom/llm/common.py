"""Helpers that several text operators share."""

from __future__ import annotations

import ctypes
import sys
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager
from types import ModuleType
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from creditloom.sources.staging import stage

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(column: str | Column) -> Column:
    """The text, an empty one for null."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def ascii_lower(column: Column) -> Column:
    """A-Z in lower case; every other character stays."""
    return F.translate(column, UPPER, LOWER)


def slices(
    batches: Iterable[pa.RecordBatch], column: str, limit: int = 1 << 20
) -> Iterator[pa.RecordBatch]:
    """The same rows in batches whose texts have about ``limit`` bytes at most.

    A text longer than that comes alone and whole. This bounds what the vectorised
    steps of a task hold, whatever the length of the texts around it.
    """
    for batch in batches:
        sizes = pc.binary_length(batch[column]).fill_null(0).to_pylist()
        start = total = 0
        for i, size in enumerate(sizes):
            if i > start and total + size > limit:
                yield batch.slice(start, i - start)
                start, total = i, 0
            total += size
        if start < batch.num_rows:
            yield batch.slice(start)


def kept_in_worker(name: str, make: Callable[[], Any]) -> Any:
    """What a Python worker keeps from task to task, made by its first one.

    Functions come to a worker by value, and with them what their modules hold; a module of the
    worker's own outlives them.
    """
    kept = sys.modules.setdefault("_kept_in_worker", ModuleType("_kept_in_worker")).__dict__
    if name not in kept:
        kept[name] = make()
    return kept[name]


def give_back() -> None:
    """Hand the memory that is free in this process to the system; a task's function ends with it.

    A Python worker waits for tasks to come, and would keep what the largest one took.
    """
    pa.default_memory_pool().release_unused()
    if sys.platform == "linux":
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc only
        if trim is not None:
            trim(0)


BATCH_ROWS = 1_000
"""Rows of whole texts that Spark and a Python worker exchange at a time."""


@contextmanager
def small_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> Iterator[None]:
    """Plans made inside exchange at most so many rows at once with Python.

    Batches are held outside the heap on both sides, and Spark's usual number is meant for
    rows of numbers. The session's own setting, if smaller, stays.
    """
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(min(rows, int(before)) if int(before) > 0 else rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def global_rank(df: DataFrame, order: list[Column], name: str, parts: int) -> DataFrame:
    """Add the 0-based place of every row in one total order, without a single task.

    Rows are dealt by range and staged, numbered within their range, and shifted by the
    row counts of the ranges before; that table has one row per range.
    """
    dealt = stage(
        df.repartitionByRange(parts, *order).withColumn("_part", F.spark_partition_id()),
        "ranked",
    )
    counts = dealt.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = counts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_shift"))
    within = Window.partitionBy("_part").orderBy(*order)
    return (
        dealt.withColumn("_nth", F.row_number().over(within).cast("long") - 1)
        .join(F.broadcast(shifts), "_part")
        .withColumn(name, F.col("_shift") + F.col("_nth"))
        .drop("_part", "_nth", "_shift")
    )


HOT_SHARE = 10_000
"""A key is hot if it holds more than 1 / HOT_SHARE of all rows: at most so many exist."""


def meet(rows: DataFrame, facts: DataFrame, key: list[str], count: str, total: int) -> DataFrame:
    """Left join of ``rows`` with ``facts``, one row per (non-null) key, whatever the skew.

    ``facts[count]`` is the number of rows of the key and ``total`` that of all rows. Hot
    keys hold more than total / HOT_SHARE rows each, so no more than HOT_SHARE of them are
    broadcast, a bound that does not grow with the data. The rows of hot keys then need no
    second partner, and a random-looking key of their own spreads them over the join with
    the other facts.
    """
    keep = [c for c in facts.columns if c not in key]
    limit = max(1, total // HOT_SHARE)
    hot = facts.filter(F.col(count) > limit)
    rest = facts.filter(F.col(count) <= limit)
    found = rows.join(
        F.broadcast(hot.select(*key, F.struct(*keep).alias("_hot"))), key, "left"
    )
    aside = F.when(F.col("_hot").isNotNull(), F.xxhash64(*rows.columns, F.spark_partition_id()).bitwiseOR(F.lit(1)))
    met = found.withColumn("_aside", F.coalesce(aside, F.lit(0).cast("long"))).join(
        rest.select(*key, F.struct(*keep).alias("_fact"), F.lit(0).cast("long").alias("_aside")),
        [*key, "_aside"],
        "left",
    )
    fact = F.coalesce("_hot", "_fact")
    return met.select(*rows.columns, *[fact[c].alias(c) for c in keep])


_STEP, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


def byte_sums(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Prefix sums of a polynomial over bytes, and the inverse powers of its base."""
    back = np.uint64(pow(int(_STEP), -1, 1 << 64))
    powers, inverse = np.full((2, len(data) + 1), _STEP)
    inverse[:] = back
    powers[0] = inverse[0] = 1
    np.cumprod(powers, out=powers)
    np.cumprod(inverse, out=inverse)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(data * powers[:-1], out=sums[1:])
    return sums, inverse


def span_hashes(
    prefix: tuple[np.ndarray, np.ndarray], starts: np.ndarray, stops: np.ndarray
) -> np.ndarray:
    """64-bit hashes of spans of bytes, the same wherever a span lies.

    ``prefix`` is that of :func:`byte_sums`; one serves all spans, as powers of an odd number
    can be divided out modulo 2**64.
    """
    sums, inverse = prefix
    h = (sums[stops] - sums[starts]) * inverse[starts]
    h += (stops - starts).astype(np.uint64) * _STEP
    h = (h ^ (h >> np.uint64(31))) * _MIX
    return h ^ (h >> np.uint64(29))


#: Word characters of lower-cased UTF-8: digits, a-z and all bytes of non-ASCII characters.
_IS_WORD = np.zeros(256, bool)
_IS_WORD[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_PAIR = np.uint64(0xD6E8FEB86659FD93)


def word_grams(texts: list[str], k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all ``k`` consecutive words, the number of words and of hashes per text.

    Words are runs of digits, letters (A-Z in lower case) and non-ASCII characters. All
    texts are hashed at once; a hash never spans two of them.
    """
    encoded = [t.encode("utf-8", "surrogatepass") for t in texts]
    joined = np.frombuffer(b" ".join([*encoded, b""]).lower(), np.uint8)
    inside = np.concatenate([[False], _IS_WORD[joined], [False]])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, stops = edges[::2], edges[1::2]
    begins = np.cumsum([0, *[len(e) + 1 for e in encoded]])
    counts = np.diff(np.searchsorted(starts, begins))
    words = span_hashes(byte_sums(joined), starts, stops)
    size = max(0, len(words) - k + 1)
    grams = words[:size].copy()
    for i in range(1, k):
        grams = grams * _PAIR + words[i : size + i]
    grams ^= grams >> np.uint64(32)
    owner = np.repeat(np.arange(len(texts)), counts)
    whole = owner[:size] == owner[len(words) - size :]
    return grams[whole], counts, np.maximum(0, counts - k + 1)


def text_key(column: str = "text") -> Column:
    """A hash that, with the identifier, names a row of the documents."""
    return F.xxhash64(text_of(column))


def leave_out(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """The documents without the rows that ``gone`` names, with all their columns.

    ``gone`` has ``doc_id``, ``text_key`` and ``repeat``, one row per name. Where ``repeat``
    is true, the row that stays has the same name; one of the rows of that name is left.
    """
    # Packed, so that no column of the documents can clash with a name used here.
    packed = docs.select(
        F.struct("*").alias("d"), F.col("doc_id").cast("long").alias("a"), text_key().alias("b")
    )
    same = F.col("a").eqNullSafe(F.col("doc_id")) & (F.col("b") == F.col("text_key"))
    joined = packed.join(gone, same, "left")
    single = joined.filter(F.col("repeat").isNull()).select("d.*")
    if gone.filter("repeat").isEmpty():
        return single
    return single.unionByName(joined.filter("repeat").dropDuplicates(["a", "b"]).select("d.*"))
