"""Mixing sources to target weights by capped water-filling.

Every source has a weight and a cap of ``max_epochs`` times its words. Sources whose share
exceeds the cap are clamped to it, and what they leave is shared by weight among the
others, until no share exceeds its cap. A source is then repeated whole as often as its
target holds, and the rest comes from a seeded order of its documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from creditloom.llm.common import global_rank, meet, text_of
from creditloom.sources.staging import stage

MAX_EPOCHS = 3
WEIGHTS = (1, 2, 3)
"""Weights of the sources in order, repeating."""
SEED = 7
CELLS = 4096
"""Cells of the seeded order of a source; only the one at the cut is sorted by document."""
WORD = r"[^\x20\x09-\x0D]+"


def words(text: Column) -> Column:
    """Number of words; null and empty texts have none."""
    return F.regexp_count(text_of(text), F.lit(WORD)).cast("long")


def draw(seed: int) -> Column:
    """Place of a document in the seeded order of its source."""
    return F.xxhash64(F.lit(seed), F.col("doc_id").cast("long"), F.col("text"))


def fill(sources: DataFrame, total: int, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """Add ``target`` to a staged table of ``source_size`` and ``weight``.

    Each round is one aggregation to a single row. A round clamps at least one more
    distinct ratio of cap and weight; the level only rises, so clamped sources stay so.
    """
    cap = F.col("source_size") * max_epochs
    level = 0.0
    while True:
        full = cap <= F.col("weight") * level
        state = sources.agg(
            F.sum(F.when(full, cap)).alias("clamped"),
            F.sum(F.when(~full, F.col("weight"))).alias("open"),
        ).first()
        if not state.open:
            break
        risen = (total - (state.clamped or 0)) / state.open
        if risen <= level:
            break
        level = risen
    share = F.col("weight") * F.lit(float(level))
    return sources.withColumn("target", F.least(share, cap.cast("double")))


def mix(
    docs: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    max_epochs: int = MAX_EPOCHS,
    seed: int = SEED,
) -> DataFrame:
    """Every document with the words that the mix takes of it.

    Columns: ``doc_id``, ``source``, ``size`` (words), ``source_size``, ``target`` (of the
    source), ``whole`` (full repetitions), ``part`` (words of one more, partial or full
    repetition) and ``taken`` (whole * size + part). One row per input row.

    Sources are ordered by code point, null last, and take the weights in turn. A source's
    words taken are its target rounded down or up. All runs agree: the order of a source's
    documents is a seeded hash of identifier and text, ties by identifier and row.
    Repeated rows count separately; a source without words has target 0.
    """
    rows = stage(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            F.col("source").cast("string").alias("source"),
            # A key that is never null.
            F.concat(
                F.col("source").isNull().cast("string"), F.coalesce("source", F.lit(""))
            ).alias("key"),
            words(F.col("text")).alias("size"),
            draw(seed).alias("draw"),
            F.monotonically_increasing_id().alias("row"),
        ).withColumn("cell", F.pmod(F.col("draw"), F.lit(CELLS)).cast("int")),
        "mix-sizes",
    )
    # Words of each cell of each source, and of each source: at most CELLS rows per source.
    cells = stage(
        rows.groupBy("key", "cell").agg(
            F.first("source").alias("source"),
            F.sum("size").alias("cell_size"),
            F.count(F.lit(1)).alias("rows"),
        ),
        "mix-cells",
    )
    plan = source_plan(cells, weights, max_epochs)
    met = meet(rows, plan, ["key"], "rows", rows.count())
    # Before the cell of the cut all documents give one more repetition, after it none do.
    # Within that cell, 1 / CELLS of the source, the words run out at some document.
    at_cut = F.col("cell") == F.col("cut")
    order = Window.partitionBy("key").orderBy("draw", "doc_id", "row")
    run = F.sum("size").over(order) - F.col("size")
    part = F.greatest(F.lit(0).cast("long"), F.least(F.col("size"), F.col("left") - run))
    given = (
        met.filter(at_cut)
        .withColumn("part", part)
        .unionByName(
            met.filter(~at_cut).withColumn(
                "part", F.when(F.col("cell") < F.col("cut"), F.col("size")).otherwise(0)
            )
        )
    )
    return given.select(
        "doc_id",
        "source",
        "size",
        "source_size",
        "target",
        "whole",
        "part",
        (F.col("whole") * F.col("size") + F.col("part")).alias("taken"),
        "draw",
    )


def source_plan(cells: DataFrame, weights: tuple[int, ...], max_epochs: int) -> DataFrame:
    """One staged row per source: size, target, whole repetitions, and the cut.

    ``cut`` is the cell in which the words of the partial repetition run out and ``left``
    what is still to be given when that cell begins.
    """
    spark = cells.sparkSession
    sums = cells.groupBy("key").agg(
        F.first("source").alias("source"),
        F.sum("cell_size").alias("source_size"),
        F.sum("rows").alias("rows"),
    )
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranked = global_rank(sums, [F.col("source").asc_nulls_last()], "rank", parts)
    turn = F.element_at(
        F.array(*[F.lit(float(w)) for w in weights]),
        (F.pmod(F.col("rank"), F.lit(len(weights))) + 1).cast("int"),
    )
    sources = stage(ranked.drop("source").withColumn("weight", turn), "mix-sources")
    total = sources.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
    size, goal = F.col("source_size"), F.round("target").cast("long")
    whole = F.when(size > 0, F.floor(goal / size)).otherwise(0).cast("long")
    plan = (
        fill(sources, total, max_epochs)
        .withColumn("whole", whole)
        .withColumn("rest", goal - F.col("whole") * size)
        .drop("weight", "rank")
    )
    order = Window.partitionBy("key").orderBy("cell")
    begins = F.sum("cell_size").over(order) - F.col("cell_size")
    cuts = (
        cells.select("key", "cell", "cell_size", begins.alias("begins"))
        .join(plan.select("key", "rest"), "key")
        .filter(F.col("begins") + F.col("cell_size") > F.col("rest"))
        .groupBy("key")
        .agg(
            F.min_by(
                F.struct("cell", (F.col("rest") - F.col("begins")).alias("left")), "cell"
            ).alias("at")
        )
        .select("key", F.col("at.cell").alias("cut"), F.col("at.left").alias("left"))
    )
    # A source without words has no cut: nothing of it is taken.
    return stage(plan.join(cuts, "key", "left").fillna({"cut": -1, "left": 0}), "mix-plan")


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The mix itself: rows of documents, each repeated whole as often as it is taken.

    A document of which the mix takes a part is given once more if that is at least
    half of it, so no text is cut and a source misses its target by half a document at most.
    Documents that are taken no time are left out. Texts without words are repeated as often as
    their source. Null and repeated rows, ties and empty tables are as in :func:`mix`. Rows that
    share identifier, source and text together give what was taken of all of them.
    """
    name = ["doc_id", "source", "draw"]
    most = (F.col("part") > 0) & (2 * F.col("part") >= F.col("size"))
    times = F.col("whole") + most.cast("long")
    given = stage(
        mix(docs)
        .groupBy(*name)
        .agg(F.sum(times).alias("times"), F.count(F.lit(1)).alias("copies"))
        .filter("times > 0"),
        "mix-given",
    )
    # Packed, so that no column of the documents can clash with a name used here.
    packed = docs.select(
        F.struct("*").alias("d"),
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        draw(SEED).alias("draw"),
    )
    if not given.filter("copies > 1").isEmpty():
        packed = packed.dropDuplicates(name)
    a, b = packed.alias("a"), given.alias("b")
    same = [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in name]
    rows = a.join(b, same).select(
        "a.d", F.explode(F.sequence(F.lit(1).cast("long"), F.col("b.times"))).alias("nth")
    )
    return rows.select(*[F.col(f"d.`{c}`").alias(c) for c in docs.columns])
