"""Exact duplicates by a tree of aggregations of digest runs.

Rows are numbered by their partition of the input, modulo ``RUNS``, and aggregated by digest
and number; each is a run. In each round ``FAN_IN`` neighbouring numbers become one, until one
row per digest is left. A round is a plain hash aggregation: this stands in for a multiway
merge of sorted runs, in binomial rounds; no run is sorted or merged in order. A digest that a
third of all rows share reaches a task at most once per run that is merged there and task
before, so no round has a hot key.

A digest is verified by the byte length and a second, independent hash of the text: rows
are merged only if all three agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditloom.llm.common import ascii_lower, leave_out, meet, text_key, text_of
from creditloom.sources.staging import stage

FAN_IN = 8
RUNS = FAN_IN**3
"""Run numbers; partitions beyond them share one, which the first round merges."""
KEY = ["digest", "size", "proof"]


def normalised(text: str | Column) -> Column:
    """Texts are equal if they are identical after lower-casing A-Z; null is empty."""
    return ascii_lower(text_of(text))


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One thin staged row per document: identifier, run, digest and its proof."""
    thin = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.pmod(F.spark_partition_id(), F.lit(RUNS)).alias("run"),
        normalised(text_col).alias("_text"),
        text_key(text_col).alias("text_key"),
    )
    return stage(
        thin.select(
            "doc_id",
            "run",
            F.monotonically_increasing_id().alias("row"),
            F.unhex(F.sha2("_text", 256)).alias("digest"),
            F.octet_length("_text").alias("size"),
            F.xxhash64("_text").alias("proof"),
            "text_key",
        ),
        "digests",
    )


def merge_runs(runs: DataFrame) -> DataFrame:
    """Rounds of hash aggregations over FAN_IN runs each; returns one row per digest.

    ``top`` is the (identifier, row) that stays: the largest identifier, and of repeated
    ones the last row. A row without an identifier stays only in a group of such rows.
    """
    merged = runs.select(
        *KEY, "run", F.struct("doc_id", "row", "text_key").alias("top"), F.lit(1).cast("long").alias("rows")
    )
    width = RUNS
    while width > 1:
        width //= FAN_IN
        merged = (
            merged.withColumn("run", F.floor(F.col("run") / FAN_IN).cast("int"))
            .groupBy(*KEY, "run")
            .agg(F.max("top").alias("top"), F.sum("rows").alias("rows"))
        )
    return merged.drop("run")


def dedup_exact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each document with the identifier that stays for its text.

    Columns: ``doc_id``, ``keep_id``, ``group_size``, ``kept`` and ``text_sha256``, and
    ``text_key`` and ``keep_key``, the hashes that name the row and the one that stays. One
    row per input row. Null and empty texts are one group. Of equal texts the row with the
    largest identifier stays; of rows that also share the identifier exactly one is
    ``kept``. Null identifiers are smaller than all others. Other columns are ignored.
    """
    rows = digests(docs, id_col, text_col)
    groups = stage(merge_runs(rows).filter("rows > 1"), "digest-groups")
    met = meet(rows.drop("run"), groups, KEY, "rows", rows.count())
    top = F.coalesce("top", F.struct("doc_id", "row", "text_key"))
    return met.select(
        "doc_id",
        top["doc_id"].alias("keep_id"),
        F.coalesce("rows", F.lit(1).cast("long")).alias("group_size"),
        (top["row"] == F.col("row")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
        "text_key",
        F.coalesce(top["text_key"], F.col("text_key")).alias("keep_key"),
    )


def keep_documents(docs: DataFrame) -> DataFrame:
    """The documents that stay, with all their columns.

    Of rows that repeat both identifier and text, one stays if its group keeps them.
    """
    judged = dedup_exact(docs).filter(~F.col("kept"))
    gone = judged.groupBy("doc_id", "text_key").agg(
        F.max(F.expr("doc_id <=> keep_id AND text_key = keep_key")).alias("repeat")
    )
    return leave_out(docs, stage(gone, "exact-copies"))
