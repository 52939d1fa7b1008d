"""Joining facts about a key back to the rows of that key, whatever the skew.

The rows are wide and may pile up on few keys; the facts are one thin row per key.
Facts are aggregated first (partial aggregation keeps a hot key to one record per
map task), staged, and counted. Few facts are broadcast, so the wide rows are not
shuffled at all. With many facts both sides meet in one shuffle, in which the rows of a
hot key are dealt over several salts and its one fact is repeated for each of them.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import add, and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from creditloom.sources.staging import stage

ROWS = "_rows"
HOT_SHARE = 10_000
"""Hot keys hold 1 / HOT_SHARE of all rows each, so there are no more than that."""


@dataclass(frozen=True)
class KeyedPolicy:
    """Size limits of keyed joins."""

    broadcast_rows: int = 500_000
    """Facts are broadcast up to this many rows (measured, never estimated) ..."""
    broadcast_bytes: int = 64 << 20
    """... and up to this many bytes of key text."""
    hot_rows: int = 1_000_000
    """A key with at least this many rows, and 1 / HOT_SHARE of all, is hot; a salt of it
    gets about so many rows."""


DEFAULT_POLICY = KeyedPolicy()


def has_key(keys: Sequence[str]) -> Column:
    """True where every key column is present."""
    return reduce(and_, [F.col(k).isNotNull() for k in keys])


def key_facts(df: DataFrame, keys: Sequence[str], *facts: Column) -> DataFrame:
    """One row per complete key: its row count (``_rows``) and the given aggregates."""
    return df.filter(has_key(keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias(ROWS), *facts)


def repeated_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Complete keys held by more than one row, with their row count."""
    return key_facts(df, keys).filter(F.col(ROWS) > 1)


def hottest(
    facts: DataFrame, rows: DataFrame, keys: Sequence[str], policy: KeyedPolicy
) -> DataFrame | None:
    """Staged keys whose rows would overload a single task, with a number of ``_salts``.

    ``facts`` counts the rows per key. None when there are no such keys.
    """
    total = rows.agg(F.count(F.lit(1))).scalar()
    least = F.greatest(F.lit(policy.hot_rows), F.ceil(total / HOT_SHARE))
    salts = F.ceil(F.col(ROWS) / least).cast("int") + 1
    hot = stage(facts.filter(F.col(ROWS) >= least).select(*keys, salts.alias("_salts")), "hot-keys")
    return None if hot.isEmpty() else hot


def hot_keys(
    df: DataFrame, keys: Sequence[str], policy: KeyedPolicy = DEFAULT_POLICY
) -> DataFrame | None:
    """Staged hot keys of ``df``, or None when it has none."""
    return hottest(key_facts(df, keys), df, keys, policy)


def join_one(
    rows: DataFrame,
    facts: DataFrame,
    keys: Sequence[str],
    how: str = "left",
    hot: DataFrame | None = None,
) -> DataFrame:
    """Join ``rows`` to ``facts`` (unique on ``keys``) without a hot shuffle partition.

    ``hot`` lists the keys to deal over salts (see :func:`hottest`). The salt of a row
    follows from its values and its task, so a task that is run again deals alike, and
    copies of one row are spread as their tasks are. Rows lacking a key never travel to
    the partition of the null key.
    """
    if how not in ("left", "inner"):
        raise ValueError(f"how must be 'left' or 'inner', not {how!r}")
    keys = list(keys)
    keyed = rows.filter(has_key(keys))
    if hot is None:
        out = keyed.join(facts, keys, how)
    else:
        few = F.broadcast(hot)
        draw = F.pmod(F.xxhash64(*keyed.columns) + F.spark_partition_id(), F.col("_salts"))
        dealt = keyed.join(few, keys, "left").select(
            *keyed.columns, F.coalesce(draw, F.lit(0)).cast("int").alias("_salt")
        )
        each = F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1)
        repeated = facts.join(few, keys, "left").select(
            *facts.columns, F.explode(each).alias("_salt")
        )
        out = dealt.join(repeated, [*keys, "_salt"], how).drop("_salt")
    if how == "left":
        out = out.unionByName(rows.filter(~has_key(keys)), allowMissingColumns=True)
    return out


def fits_broadcast(facts: DataFrame, keys: Sequence[str], policy: KeyedPolicy) -> bool:
    """Measure a staged table against the broadcast limits (runs one small job)."""
    width = reduce(add, [F.octet_length(F.col(k).cast("string")) for k in keys])
    size = facts.agg(
        F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(width), F.lit(0)).alias("width")
    ).first()
    return size.n <= policy.broadcast_rows and size.width <= policy.broadcast_bytes


def flag_rows(
    rows: DataFrame,
    facts: DataFrame,
    keys: Sequence[str],
    flag: str,
    policy: KeyedPolicy = DEFAULT_POLICY,
) -> DataFrame:
    """Add a boolean column: is the row's key among ``facts``?

    ``facts`` is the outcome of :func:`key_facts`, filtered to the wanted keys. It is
    written and counted here, which runs one thin job before the plan is returned.
    """
    keys = list(keys)
    facts = stage(facts.select(*keys, ROWS), "key-facts")
    marks = facts.select(*keys, F.lit(True).alias(flag))
    if fits_broadcast(facts, keys, policy):
        out = rows.join(F.broadcast(marks), keys, "left")
    else:
        out = join_one(rows, marks, keys, "left", hottest(facts, rows, keys, policy))
    return out.select(*rows.columns, F.coalesce(F.col(flag), F.lit(False)).alias(flag))


def require_unique(df: DataFrame, keys: Sequence[str], label: str) -> DataFrame:
    """The same rows; running them fails on a null key or a second row of a key.

    For use right before a join on the key: the check needs rows grouped and sorted by
    key, which the join wants anyway, so no shuffle is added. It holds one row at a
    time, however often a key repeats.
    """
    keys = list(keys)
    nth = F.row_number().over(Window.partitionBy(*keys).orderBy(*keys))
    return (
        df.withColumn("_nth", nth)
        .filter(_refuse(~has_key(keys), F.col("_nth") > 1, keys, label))
        .drop("_nth")
    )


def require_unique_first(df: DataFrame, keys: Sequence[str], label: str) -> DataFrame:
    """As :func:`require_unique`, for rows that no join follows.

    The rows stay where they are. A subquery aggregates the keys alone beforehand.
    """
    keys = list(keys)
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias(ROWS))
    repeats = per_key.agg(F.coalesce(F.max(ROWS), F.lit(0))).scalar()
    return df.filter(_refuse(~has_key(keys), repeats > 1, keys, label))


def _refuse(null_key: Column, repeated: Column, keys: list[str], label: str) -> Column:
    def fail(why: str) -> Column:
        return F.raise_error(f"{label}: {why} {keys}").cast("boolean")

    return (
        F.when(null_key, fail("null in key"))
        .when(repeated, fail("duplicate key"))
        .otherwise(F.lit(True))
    )
