"""Type-2 history: every version of a record, with the span in which it was valid.

Each batch is a full snapshot of the source, or with ``partial`` only its new and
changed records. One full outer join of the current versions with the batch decides,
per key, between insert, update, delete and no change; closed versions never enter the
join. Time is an argument (``as_of``), so a batch that is run twice gives the same
result.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditloom.functions.hashing import framed_md5, joined_md5
from creditloom.operators.keyed import require_unique, require_unique_first

# The columns history adds to a record.
META = ("valid_from", "valid_to", "is_current", "is_deleted_in_source", "row_hash", "sk_id")

INSERT, UPDATE, DELETE, NOOP, HELD = "insert", "update", "delete", "noop", "held"


def timestamp(value: str | datetime | Column) -> Column:
    """A timestamp column; text is read in the session time zone."""
    if isinstance(value, Column):
        return value.cast("timestamp")
    return F.lit(str(value)).cast("timestamp")


def tracked_columns(columns: Sequence[str]) -> list[str]:
    return [c for c in columns if c not in META]


def row_hash(columns: Sequence[str], compat: bool = False) -> Column:
    """Hash deciding whether a record changed. ``compat`` skips nulls when joining."""
    make = joined_md5 if compat else framed_md5
    return make([F.col(c) for c in columns])


def surrogate_key(keys: Sequence[str], valid_from: Column) -> Column:
    return joined_md5([*[F.col(k) for k in keys], valid_from])


def _key_list(keys: Sequence[str] | str) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def initial(
    incoming: DataFrame,
    keys: Sequence[str] | str,
    as_of: str | datetime | Column,
    tracked: Sequence[str] | None = None,
    compat_hash: bool = False,
    trusted: bool = False,
) -> DataFrame:
    """History of the first snapshot: every record is current.

    Repeated and null keys are refused; ``trusted`` says they were ruled out before.
    """
    keys = _key_list(keys)
    rows = incoming if trusted else require_unique_first(incoming, keys, "snapshot")
    return _hashed(rows, tracked, compat_hash).withColumns(_opening(keys, as_of))


def _hashed(
    rows: DataFrame, tracked: Sequence[str] | None, compat_hash: bool
) -> DataFrame:
    watched = tracked_columns(rows.columns if tracked is None else tracked)
    return rows.withColumn("row_hash", row_hash(watched, compat_hash))


def _opening(keys: list[str], as_of: str | datetime | Column) -> dict[str, Column]:
    """What history adds to a record whose version starts now."""
    start = timestamp(as_of)
    return {
        "valid_from": start,
        "valid_to": F.lit(None).cast("timestamp"),
        "is_current": F.lit(True),
        "is_deleted_in_source": F.lit(False),
        "sk_id": surrogate_key(keys, start),
    }


def _matched(
    current: DataFrame,
    incoming: DataFrame,
    keys: list[str],
    tracked: Sequence[str] | None,
    compat_hash: bool,
    held_keys: DataFrame | None,
    partial: bool,
    also: Sequence[Column] = (),
) -> tuple[DataFrame, list[str]]:
    """Current beside incoming records, one row per key, with ``change_type``.

    Column *n* of a version is ``_old_n`` on one side and ``_new_n`` on the other. The
    columns stay flat, as nesting them would copy every row once more.
    """
    incoming = incoming.withColumn("_held", F.lit(False))
    watched = [c for c in incoming.columns if c != "_held"] if tracked is None else tracked
    if held_keys is not None:
        # A held key takes part as a row without values, so no second join is needed.
        held = held_keys.select(*keys).dropna().dropDuplicates().withColumn("_held", F.lit(True))
        incoming = incoming.unionByName(held, allowMissingColumns=True)
    incoming = require_unique(incoming, keys, "snapshot")
    fresh = _hashed(incoming, watched, compat_hash)
    if also:
        fresh = fresh.withColumn("_also", F.array(*also))
    columns = [c for c in fresh.columns if c not in ("_held", "_also", *META)]
    columns += [c for c in current.columns if c not in (*columns, *META)] + list(META)

    def side(df: DataFrame, prefix: str) -> list[Column]:
        return [
            F.col(c).alias(f"{prefix}_{n}") for n, c in enumerate(columns) if c in df.columns
        ]

    left = current.select(*keys, F.lit(True).alias("_had"), *side(current, "_old"))
    extra = ["_also"] if also else []
    right = fresh.select(*keys, "_held", *extra, *side(fresh, "_new"))
    had, has = F.col("_had").isNotNull(), F.col("_held").isNotNull()
    hash_at = columns.index("row_hash")
    same = F.col(f"_old_{hash_at}").eqNullSafe(F.col(f"_new_{hash_at}"))
    if also:
        same = same | F.coalesce(F.array_contains("_also", F.col(f"_old_{hash_at}")), F.lit(False))
    change = (
        F.when(F.col("_held"), F.when(had, NOOP).otherwise(HELD))
        .when(~had, INSERT)
        .when(~has, NOOP if partial else DELETE)
        .when(same, NOOP)
        .otherwise(UPDATE)
    )
    joined = left.join(right, keys, "full_outer").withColumn("change_type", change)
    return joined, columns


def _versions(
    joined: DataFrame,
    columns: list[str],
    keys: list[str],
    as_of: str | datetime | Column,
    *extra: Column,
) -> DataFrame:
    """One row for each version a key has after the batch: the old one, closed if it
    changed or is gone, and the opened one, if any. ``_opens`` tells them apart."""
    change = F.col("change_type")
    opens = (
        F.when(change == INSERT, F.array(F.lit(True)))
        .when(change == UPDATE, F.array(F.lit(False), F.lit(True)))
        .otherwise(F.array(F.lit(False)))
    )
    kept, opening = change == NOOP, _opening(keys, as_of)
    closing = {
        "valid_to": timestamp(as_of),
        "is_current": F.lit(False),
        "is_deleted_in_source": change == DELETE,
    }
    present = set(joined.columns)

    def column(n: int, name: str) -> Column:
        def given(side: str) -> Column:
            # A column that only the other side has is null on this one.
            return F.col(f"{side}_{n}") if f"{side}_{n}" in present else F.lit(None)

        value = F.when(F.col("_opens"), opening.get(name, given("_new")))
        if name in closing:
            value = value.when(~kept, closing[name])
        return value.otherwise(given("_old")).alias(name)

    return joined.withColumn("_opens", F.explode(opens)).select(
        *[column(n, c) for n, c in enumerate(columns)], *extra
    )


def changes(
    current: DataFrame,
    incoming: DataFrame,
    keys: Sequence[str] | str,
    as_of: str | datetime | Column,
    tracked: Sequence[str] | None = None,
    compat_hash: bool = False,
    held_keys: DataFrame | None = None,
    partial: bool = False,
    also: Sequence[Column] = (),
) -> DataFrame:
    """Only what a batch writes: opened and closed versions, with ``change_type``.

    ``merge_key`` holds the key of a closed version and is null for an opened one.
    An update gives one row of each kind. ``also`` are other hashes of incoming records under
    which a version counts as the same, such as those of fewer columns.
    """
    keys = _key_list(keys)
    joined, columns = _matched(
        current, incoming, keys, tracked, compat_hash, held_keys, partial, also
    )
    merge_key = F.when(
        ~F.col("_opens"), F.concat_ws("|", *[F.col(k).cast("string") for k in keys])
    )
    return _versions(
        joined.filter(F.col("change_type").isin(INSERT, UPDATE, DELETE)),
        columns,
        keys,
        as_of,
        merge_key.alias("merge_key"),
        F.col("change_type"),
    )


def opened_and_closed(
    written: DataFrame, keys: Sequence[str] | str, as_of: str | datetime | Column
) -> DataFrame:
    """The versions that a batch opened and closed, with ``change_type``, from what it wrote.

    Only changed records are joined: those that were closed tell updates from inserts.
    """
    keys = _key_list(keys)
    closed = written.filter(~F.col("is_current")).withColumn(
        "change_type", F.when(F.col("is_deleted_in_source"), DELETE).otherwise(UPDATE)
    )
    updated = closed.filter(F.col("change_type") == UPDATE).select(*keys, "change_type")
    opened = written.filter(F.col("is_current") & (F.col("valid_from") == timestamp(as_of)))
    opened = opened.join(updated, keys, "left").fillna({"change_type": INSERT})
    return closed.unionByName(opened)


def advance(
    current: DataFrame,
    incoming: DataFrame,
    keys: Sequence[str] | str,
    as_of: str | datetime | Column,
    tracked: Sequence[str] | None = None,
    compat_hash: bool = False,
    held_keys: DataFrame | None = None,
    partial: bool = False,
) -> DataFrame:
    """The new current versions together with those this batch closed.

    Versions closed earlier are not needed and not returned.
    """
    keys = _key_list(keys)
    joined, columns = _matched(
        current, incoming, keys, tracked, compat_hash, held_keys, partial
    )
    return _versions(joined.filter(F.col("change_type") != HELD), columns, keys, as_of)


def apply_batch(
    history: DataFrame | None,
    incoming: DataFrame,
    keys: Sequence[str] | str,
    as_of: str | datetime | Column,
    tracked: Sequence[str] | None = None,
    compat_hash: bool = False,
    held_keys: DataFrame | None = None,
    partial: bool = False,
) -> DataFrame:
    """The complete history after a snapshot; ``history`` is None on the first one.

    Write the result before the next batch: both its current and its closed part are
    used there. To write only what a batch touches, see ``sources.history_store``.
    """
    if history is None:
        return initial(incoming, keys, as_of, tracked, compat_hash)
    moved = advance(
        current(history), incoming, keys, as_of, tracked, compat_hash, held_keys, partial
    )
    return history.filter(~F.col("is_current")).unionByName(moved, allowMissingColumns=True)


def current(history: DataFrame) -> DataFrame:
    """The version of each live record that is valid now."""
    return history.filter(F.col("is_current"))


def as_of(history: DataFrame, moment: str | datetime | Column) -> DataFrame:
    """The versions that were valid at a moment."""
    at = timestamp(moment)
    return history.filter(
        (F.col("valid_from") <= at) & (F.col("valid_to").isNull() | (F.col("valid_to") > at))
    )
