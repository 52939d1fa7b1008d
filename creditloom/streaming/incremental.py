"""A raw table followed as a stream: each micro-batch becomes the next batch of history."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from creditloom.operators.keyed import DEFAULT_POLICY, KeyedPolicy
from creditloom.plans.jobs import ingest
from creditloom.sources.staging import stage


def follow(
    name: str,
    rows: DataFrame,
    root: str,
    checkpoint: str,
    as_of: Callable[[int], str | datetime],
    partial: bool = True,
    once: bool = False,
    policy: KeyedPolicy = DEFAULT_POLICY,
    **trigger: object,
) -> StreamingQuery:
    """Check and version every micro-batch of ``rows`` into the history under ``root``.

    Batch numbers are those of the stream. A batch that is tried again writes the same
    folders, so a restart neither loses nor repeats versions, as long as ``as_of`` gives
    the same time for the same number. ``partial`` batches hold new and changed records;
    otherwise each one must be a full snapshot. With ``once`` duplicate checks see the rows of
    all batches (see ``jobs.ingest``). ``trigger`` goes to the stream writer.
    """

    def apply(batch: DataFrame, number: int) -> None:
        # Read the sources once; checking goes over the rows several times.
        arrived = stage(batch, "arrived")
        ingest(
            name, arrived, root, number, as_of(number), partial=partial, once=once, policy=policy
        )

    writer = rows.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start()
