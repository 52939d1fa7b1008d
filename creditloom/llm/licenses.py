"""License scans by diagonal voting.

Rolling hashes of ``K`` words of every text are joined with the positions of the same hashes
in license templates. A match votes for the diagonal on which text and template lie, that
is text position minus template position. Votes are counted by diagonal, neighbouring
diagonals (where words were added or left out) are merged, and the spans of text that have
enough votes are verified on the words themselves.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from difflib import SequenceMatcher

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from creditloom.llm.common import slices, text_of, word_grams
from creditloom.operators.keyed import KeyedPolicy
from creditloom.sources.staging import stage

K = 2
GAP = 2
"""Diagonals up to so far apart are one place."""
MIN_VOTES = 0.5
"""Part of a template's hashes that has to vote for a place."""
MIN_SHARE = 0.9
"""Part of a template's words that a verified place holds, in order."""

#: Phrases that must be found at every place, with their labels.
BASE = (
    ("cc-by", "cc by"),
    ("gpl", "general public license"),
    ("reserved", "all rights reserved"),
)
#: Beginnings of well-known license notices, with their labels.
TEMPLATES = (
    ("apache-2.0", "licensed under the apache license version 2 0"),
    ("mit", "released under the mit license"),
    (
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this "
        "software and associated documentation files",
    ),
    (
        "bsd",
        "redistribution and use in source and binary forms with or without modification are "
        "permitted provided that the following conditions are met",
    ),
    ("gpl-3.0", "licensed under the gnu general public license version 3"),
    ("lgpl", "gnu lesser general public license"),
    ("mpl-2.0", "subject to the terms of the mozilla public license v 2 0"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-sa", "licensed under cc by sa 4 0"),
    ("cc-by-sa", "creative commons attribution sharealike"),
)
#: Hashes of two such words stand in too many texts to be a vote.
COMMON_WORDS = set("a and any are for in is it of or that the this to was with".split())

_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")

def words_of(text: str) -> list[bytes]:
    """Words of a text in lower-case (A-Z only): runs of letters, digits and non-ASCII."""
    return _WORD.findall(text.encode("utf-8", "surrogatepass").lower())


def template_grams(spark: SparkSession) -> DataFrame:
    """``hash``, ``template``, ``place`` and ``grams`` (votes that the template can get).

    As many rows as the templates have words, whatever the data. Templates are numbered in
    the order of BASE and TEMPLATES.
    """
    rows = []
    for number, (_, phrase) in enumerate(BASE + TEMPLATES):
        hashes = word_grams([phrase], K)[0].view(np.int64).tolist()
        words = phrase.split()
        votes = [
            (h, place)
            for place, h in enumerate(hashes)
            if not COMMON_WORDS.issuperset(words[place : place + K])
        ]
        rows += [(h, number, place, len(votes)) for h, place in votes]
    return spark.createDataFrame(rows, "hash long, template int, place int, grams int")


def _hash_texts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text"):
        hashes, _, counts = word_grams(batch["text"].to_pylist(), K)
        offsets = pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32())
        lists = pa.ListArray.from_arrays(offsets, pa.array(hashes.view(np.int64)))
        yield pa.RecordBatch.from_arrays(
            [batch["doc_id"], batch["text_key"], lists], names=["doc_id", "text_key", "hashes"]
        )


def vote(rows: DataFrame) -> DataFrame:
    """Places with enough votes: ``doc_id``, ``text_key``, ``template``, ``low``, ``high``.

    ``low`` and ``high`` are the diagonals between which the place lies. All hashes of all
    texts take part in the join; the templates are the bounded side.
    """
    spark = rows.sparkSession
    hashed = rows.mapInArrow(_hash_texts, "doc_id long, text_key long, hashes array<bigint>")
    each = hashed.select("doc_id", "text_key", F.posexplode("hashes").alias("at", "hash"))
    name = ["doc_id", "text_key", "template"]
    diagonal = (F.col("at") - F.col("place")).alias("diagonal")
    counted = (
        each.join(F.broadcast(template_grams(spark)), "hash")
        .groupBy(*name, "grams", diagonal)
        .agg(F.count_distinct("place").alias("votes"))
    )
    # A phrase that has to stand word by word gets all its votes on one diagonal.
    whole = (F.col("template") >= len(BASE)) | (F.col("votes") == F.col("grams"))
    order = Window.partitionBy(*name).orderBy("diagonal")
    far = F.col("diagonal") - F.lag("diagonal").over(order) > GAP
    return (
        counted.filter(whole)
        .withColumn("_far", F.coalesce(far, F.lit(True)).cast("int"))
        .withColumn("_place", F.sum("_far").over(order))
        .groupBy(*name, "grams", "_place")
        .agg(
            F.min("diagonal").alias("low"),
            F.max("diagonal").alias("high"),
            F.sum("votes").alias("votes"),
        )
        .filter(F.col("votes") >= MIN_VOTES * F.col("grams"))
        .select(*name, "low", "high")
    )


def verify(words: list[bytes], places: list[dict]) -> tuple[dict[int, str], set[str], float]:
    """Base phrases by the place where they start, the other labels, and the best share."""
    base: dict[tuple[int, int], str] = {}
    labels: set[str] = set()
    best = 0.0
    for place in places:
        number, low, high = place["template"], place["low"], place["high"]
        label, phrase = (BASE + TEMPLATES)[number]
        wanted = [w.encode() for w in phrase.split()]
        if number < len(BASE):
            for at in range(max(0, low), high + 1):
                if words[at : at + len(wanted)] == wanted:
                    base[at, number] = label
                    best = 1.0
            continue
        span = words[max(0, low - GAP) : high + len(wanted) + GAP]
        blocks = SequenceMatcher(None, wanted, span, autojunk=False).get_matching_blocks()
        share = sum(b.size for b in blocks) / len(wanted)
        if share >= MIN_SHARE:
            labels.add(label)
            best = max(best, share)
    return base, labels, best


RESULT = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_words", pa.int64()),
        ("n_base", pa.int64()),
        ("first_word", pa.int64()),
        ("last_word", pa.int64()),
        ("base_labels", pa.string()),
        ("labels", pa.string()),
        ("score", pa.float64()),
    ]
)


def _scan_texts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text"):
        texts = batch["text"].to_pylist()
        counts = word_grams(texts, K)[1].tolist()
        rows = []
        for doc, text, places, count in zip(
            batch["doc_id"].to_pylist(), texts, batch["places"].to_pylist(), counts
        ):
            base, labels, best = verify(words_of(text), places) if places else ({}, set(), 0.0)
            starts = [at for at, _ in base]
            named = set(base.values())
            rows.append(
                (
                    doc,
                    count,
                    len(base),
                    min(starts, default=None),
                    max(starts, default=None),
                    ",".join(sorted(named)),
                    ",".join(sorted(named | labels)),
                    best,
                )
            )
        columns = list(zip(*rows)) if rows else [[] for _ in RESULT]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(columns, RESULT)], schema=RESULT
        )


def scan(docs: DataFrame, policy: KeyedPolicy | None = None) -> DataFrame:
    """Licenses of every document; columns as ``RESULT``.

    One row per input row. Null text is empty: no words, no labels (empty strings), score 0.
    ``score`` is 1 with a base phrase, else the best share of a template's words. Rows that
    repeat identifier and text get the same result. Other columns are ignored.

    Texts with places are joined back to be verified: the places are broadcast if their
    measured size is within the policy, else rows meet in a shuffle.
    """
    policy = policy or KeyedPolicy()
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of("text").alias("text"))
    rows = rows.withColumn("text_key", F.xxhash64("text"))
    each = F.struct("template", "low", "high")
    places = stage(
        vote(rows).groupBy("doc_id", "text_key").agg(F.collect_set(each).alias("places")),
        "license-places",
    )
    size = places.agg(
        F.count(F.lit(1)).alias("rows"),
        F.coalesce(F.sum(F.size("places") * 12 + 32), F.lit(0)).alias("bytes"),
    ).first()
    r, p = rows.alias("r"), places.alias("p")
    if size.rows <= policy.broadcast_rows and size.bytes <= policy.broadcast_bytes:
        p = F.broadcast(p)
    same = F.col("r.doc_id").eqNullSafe(F.col("p.doc_id")) & (
        F.col("r.text_key") == F.col("p.text_key")
    )
    found = r.join(p, same, "left").select("r.doc_id", "r.text", "p.places")
    kinds = {pa.int64(): "long", pa.string(): "string", pa.float64(): "double"}
    return found.mapInArrow(_scan_texts, ", ".join(f"{f.name} {kinds[f.type]}" for f in RESULT))
