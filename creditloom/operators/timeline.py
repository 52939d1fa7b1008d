"""Histories out of observations, in whatever order and grouping these arrive.

An observation says that a record was seen with certain values at a moment. The history of a
key follows from all its observations and the moments of the full snapshots: consecutive
observations of the same values are one version, a version ends where the next begins, and a
key that a later full snapshot lacks was gone by then. Several versions of a key in one batch, and
batches that come late, are thus no special cases.

Neighbours are found in ranges of key and moment, so a key with very many observations is
dealt over tasks like any other rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from creditloom.operators.history import META, row_hash, surrogate_key, timestamp, tracked_columns
from creditloom.sources.staging import stage

SEEN_AT = "seen_at"


def observe(
    batch: DataFrame,
    at: str | datetime | Column,
    tracked: Sequence[str] | None = None,
    compat_hash: bool = False,
) -> DataFrame:
    """The records of a batch with ``row_hash`` and ``seen_at``, a moment or a column of it."""
    watched = tracked_columns(batch.columns if tracked is None else tracked)
    return batch.withColumns({"row_hash": row_hash(watched, compat_hash), SEEN_AT: timestamp(at)})


def dealt(rows: DataFrame, keys: Sequence[str], order: Sequence[str], tasks: int) -> DataFrame:
    """The rows in ranges of key and order, staged, with the number of their ``_range``."""
    ranged = rows.repartitionByRange(tasks, *keys, *order)
    return stage(ranged.withColumn("_range", F.spark_partition_id()), "ranges")


def neighbour(
    rows: DataFrame, keys: Sequence[str], order: Sequence[str], name: str, value: Column, step: int
) -> DataFrame:
    """Add ``value`` of the next (1) or last (-1) row of the same key; null where there is none.

    ``rows`` are :func:`dealt` or some of those. The row over the edge of a range is found
    among one row per range.
    """
    place = F.struct(*keys, *order)
    this = F.struct(F.struct(*keys).alias("key"), value.alias("value"))
    within = Window.partitionBy("_range").orderBy(*keys, *order)
    edge = F.min_by(this, place) if step > 0 else F.max_by(this, place)
    each = Window.orderBy("_range")
    edges = rows.groupBy("_range").agg(edge.alias("_edge"))
    over = F.lead("_edge") if step > 0 else F.lag("_edge")
    edges = edges.select("_range", over.over(each).alias("_edge"))
    beside = F.lead(this) if step > 0 else F.lag(this)
    found = F.coalesce(beside.over(within), F.col("_edge"))
    return (
        rows.join(F.broadcast(edges), "_range")
        .withColumn("_found", found)
        .withColumn(
            name, F.when(F.col("_found.key").eqNullSafe(F.struct(*keys)), F.col("_found.value"))
        )
        .drop("_edge", "_found")
    )


def chain(
    seen: DataFrame, keys: Sequence[str], snapshots: Sequence[str | datetime] = ()
) -> DataFrame:
    """When each version was valid: ``keys``, ``row_hash`` and the columns of history.

    ``seen`` has keys, ``row_hash`` and ``seen_at``; ``snapshots`` are the moments of the full
    snapshots. Observations that say the same at one moment count once; if they differ,
    running the result fails.
    """
    keys, spark = list(keys), seen.sparkSession
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = [SEEN_AT, "row_hash"]
    rows = dealt(seen.select(*keys, *order), keys, order, tasks)
    this = F.struct(*order)
    rows = neighbour(rows, keys, order, "_before", this, -1)
    rows = neighbour(rows, keys, order, "_after", this, 1)

    moments = F.array_sort(F.array(*map(timestamp, snapshots)).cast("array<timestamp>"))

    def gone(after: Column) -> Column:
        """The first full snapshot after a moment."""
        return F.get(F.filter(moments, lambda m: m > after), F.lit(0))

    at, before = F.col(SEEN_AT), F.col("_before")
    changed = before["row_hash"] != F.col("row_hash")
    missed = F.coalesce(gone(before[SEEN_AT]) < at, F.lit(False))
    clash = changed & (before[SEEN_AT] == at)
    opens = F.when(clash, F.raise_error("two versions of a key at one moment").cast("boolean"))
    opens = opens.otherwise(before.isNull() | changed | missed)
    rows = stage(
        rows.select(
            *keys,
            *order,
            "_range",
            opens.alias("_opens"),
            F.col("_after").isNull().alias("_last"),
            F.when(missed, gone(before[SEEN_AT])).otherwise(at).alias("_ended"),
            missed.alias("_missed"),
        ).filter("_opens or _last"),
        "edges-of-versions",
    )
    follows = F.struct("_opens", "_ended", "_missed", SEEN_AT)
    rows = neighbour(rows, keys, order, "_next", follows, 1).filter("_opens")
    after = F.col("_next")
    left = gone(F.coalesce(after[SEEN_AT], at))  # of a last version, after it was last seen
    ended = F.when(after["_opens"], after["_ended"]).otherwise(left)
    deleted = F.when(after["_opens"], after["_missed"]).otherwise(left.isNotNull())
    return rows.select(
        *keys,
        "row_hash",
        at.alias("valid_from"),
        ended.alias("valid_to"),
        ended.isNull().alias("is_current"),
        deleted.alias("is_deleted_in_source"),
        surrogate_key(keys, at).alias("sk_id"),
    )


def with_values(
    versions: DataFrame, values: DataFrame, keys: Sequence[str], order: str
) -> DataFrame:
    """Give versions the columns of the record, from any earliest row of the same hash."""
    name = [*keys, "row_hash"]
    columns = [c for c in values.columns if c not in (*name, *META, SEEN_AT, order)]
    first = values.groupBy(*name).agg(F.min_by(F.struct(*columns), order).alias("_record"))
    return versions.join(first, name).select(
        *keys,
        *[F.col(f"_record.`{c}`").alias(c) for c in columns],
        *[c for c in META],
    )


def history_of(
    observations: DataFrame, keys: Sequence[str], snapshots: Sequence[str | datetime] = ()
) -> DataFrame:
    """The complete history that :func:`observe`-d records give, all at once."""
    kept = stage(observations, "observations")
    return with_values(chain(kept, keys, snapshots), kept, keys, SEEN_AT)
