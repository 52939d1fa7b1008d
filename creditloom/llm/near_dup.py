"""Near duplicates by Order MinHash.

Texts are sequences of five-word shingles, each labelled with how often it occurred before
in its text. For each of ``SKETCHES`` random orders the ``TAKEN`` smallest labelled shingles
are sampled and kept in the order of the text, so a sketch agrees if the same shingles
follow each other alike. Rows that share a sketch meet the row chosen for that sketch, and
pairs are verified by aligning their shingles: what two texts share in the same order, over
all that either has, must reach ``SIMILAR``. Links join rows to classes.

A group of copies is a star and not a clique: rows of equal words are one node, and of the
nodes that share a sketch all meet one chosen node, the same one for as many sketches as can be.
That joins most of what is alike. Nodes that are then left in a group of several classes are
joined exactly: they meet all that share one of their rarest shingles, and no similar pair is
without one. Pairs whose numbers of shingles rule out that they are similar never meet.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditloom.llm.common import (
    give_back,
    leave_out,
    meet,
    slices,
    small_batches,
    text_key,
    text_of,
    word_grams,
)
from creditloom.operators.keyed import KeyedPolicy
from creditloom.sources.staging import stage

WORDS = 5
SIMILAR = 0.8
SKETCHES = 16
TAKEN = 3
SEED = 29
PARTNERS = 512
"""Partners of one node that a task meets together; more are spread by a salt."""
CELL_BITS = 22
"""Labelled shingles are counted in 2**CELL_BITS cells, by their first bits."""
MARKS = 16
"""Words of 64 bits in a text's marks."""
SLICE_BYTES = 1 << 18
"""Texts of about so many bytes are cut into shingles at a time; a longer one comes alone."""
SLACK = 1e-6
"""Bounds on shared shingles are taken so much wider, for rounding."""

_MIX_A, _MIX_B = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
_TOP = np.uint64(0xFFFFFFFFFFFFFFFF)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * _MIX_A
    h = (h ^ (h >> np.uint64(29))) * _MIX_B
    return h ^ (h >> np.uint64(32))


def shingles(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Labelled shingles of all texts in text order, and how many each text has.

    A text of fewer than five words has one shingle, all of it; without words it has none.
    """
    grams, words, counts = word_grams(texts, WORDS)
    short = np.flatnonzero((words > 0) & (words < WORDS))
    if len(short):
        whole = {}
        for length in np.unique(words[short]).tolist():
            of_length = short[words[short] == length]
            whole.update(
                zip(of_length.tolist(), word_grams([texts[i] for i in of_length], length)[0])
            )
        places = np.cumsum(counts)[short] - counts[short]
        values = np.array([whole[i] for i in short.tolist()], np.uint64)
        grams = np.insert(grams, places, _mix(values))
        counts[short] = 1
    owner = np.repeat(np.arange(len(texts)), counts)
    key = _mix(grams + owner.astype(np.uint64) * _MIX_A)
    order = np.argsort(key, kind="stable")
    new = np.ones(len(key), bool)
    new[1:] = key[order][1:] != key[order][:-1]
    begins = np.flatnonzero(new)
    nth = np.empty(len(key), np.uint64)
    runs = np.diff(np.append(begins, len(key)))
    nth[order] = np.arange(len(key)) - np.repeat(begins, runs)
    return _mix(grams + nth * _MIX_B), counts


def sketches(labelled: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """One row of SKETCHES hashes per text; texts without shingles get zeros."""
    out = np.zeros((len(counts), SKETCHES), np.uint64)
    full = np.flatnonzero(counts)
    if not len(full):
        return out
    sizes = counts[full]
    starts = np.cumsum(sizes) - sizes
    owner = np.repeat(np.arange(len(full)), sizes)
    for sketch in range(SKETCHES):
        seed = np.uint64((SEED + 2 * sketch + 1) * int(_MIX_A) % (1 << 64))
        values = _mix(labelled ^ seed)
        places = np.zeros((TAKEN, len(full)), np.int64)
        for nth in range(TAKEN):
            least = np.minimum.reduceat(values, starts)
            hit = np.flatnonzero(values == least[owner])
            texts, first = np.unique(owner[hit], return_index=True)
            places[nth, texts] = hit[first]
            values[hit[first]] = _TOP  # a text with fewer shingles names its last again
        places.sort(axis=0)
        h = np.full(len(full), seed)
        for row in places:
            h = _mix(h * _MIX_B + labelled[row])
        out[full, sketch] = h
    return out


def aligned(a: np.ndarray, b: np.ndarray) -> float:
    """Shared labelled shingles in the same order, over all of either; 0 below SIMILAR.

    A labelled shingle stands once in a text, so the best alignment is the longest rising
    run of places in ``b`` by place in ``a``. It only has to be looked for in the band around
    the diagonal that so many differing shingles can leave.
    """
    if not len(a) or not len(b):
        return 0.0
    _, at, to = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    total = len(a) + len(b)
    floor = SIMILAR / (1 + SIMILAR) * total  # shared ones that SIMILAR asks for
    band = total - 2 * floor
    near = np.abs(at - to) <= band
    if near.sum() < floor:
        return 0.0
    to = to[near][np.argsort(at[near])]
    if not np.all(to[1:] > to[:-1]):
        rising: list[int] = []
        for place in to.tolist():
            i = bisect_left(rising, place)
            rising[i : i + 1] = [place]
        to = rising
    share = len(to) / (total - len(to))
    return share if share >= SIMILAR else 0.0


def marks(labelled: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """One row of 64 * MARKS bits per text: whether an odd number of its shingles falls on each.

    A shingle that two texts share changes the same bit of both, so no more bits differ than
    there are shingles that only one of them has.
    """
    bits = 64 * MARKS
    owner = np.repeat(np.arange(len(counts)), counts)
    at = (_mix(labelled ^ np.uint64(SEED)) % np.uint64(bits)).astype(np.int64)
    odd = np.bincount(owner * bits + at, minlength=len(counts) * bits) & 1
    return np.packbits(odd.astype(bool)).view(np.int64).reshape(len(counts), MARKS)


SKETCHED = (
    "doc_id long, text_key long, words_a long, words_b long, size long, sketches array<bigint>"
)


def _sketch_texts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text", SLICE_BYTES):
        labelled, counts = shingles(batch["text"].to_pylist())
        found = sketches(labelled, counts)
        # The words of a text in order, as two sums; without words its own key stands in.
        ends = np.cumsum(counts)
        place = np.arange(len(labelled)) - np.repeat(ends - counts, counts)
        sums = []
        for step in (_MIX_A, _MIX_B):
            each = np.concatenate(
                [[np.uint64(0)], np.cumsum(_mix(labelled + place.astype(np.uint64) * step))]
            )
            own = each[ends] - each[ends - counts]
            key = batch["text_key"].to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            sums.append(np.where(counts > 0, own, key).view(np.int64))
        width = np.where(counts > 0, SKETCHES, 0)
        offsets = pa.array(np.concatenate([[0], np.cumsum(width)]), pa.int32())
        lists = pa.ListArray.from_arrays(offsets, pa.array(found[counts > 0].ravel().view(np.int64)))
        words = [pa.array(sums[0]), pa.array(sums[1]), pa.array(counts.astype(np.int64))]
        yield pa.RecordBatch.from_arrays(
            [batch["doc_id"], batch["text_key"], *words, lists],
            names=["doc_id", "text_key", "words_a", "words_b", "size", "sketches"],
        )
    give_back()


def _verify_pairs(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of texts that are similar; the texts of chosen nodes come again and again."""
    for whole in batches:
        for batch in slices(slices([whole], "text", SLICE_BYTES), "other_text", SLICE_BYTES):
            others = batch["other"].to_numpy()
            _, first, back = np.unique(others, return_index=True, return_inverse=True)
            a = _split(batch["text"].to_pylist())
            b = _split(batch["other_text"].take(pa.array(first)).to_pylist())
            near = [aligned(own, b[i]) for own, i in zip(a, back.tolist())]
            keep = pa.array([n > 0 for n in near])
            out = pa.RecordBatch.from_arrays(
                [batch["node"], batch["other"], pa.array(near, pa.float64())],
                names=["node", "other", "similarity"],
            )
            yield out.filter(keep)
    give_back()


def _split(texts: list[str]) -> list[np.ndarray]:
    labelled, counts = shingles(texts)
    return np.split(labelled, np.cumsum(counts)[:-1])


def sketch(docs: DataFrame) -> DataFrame:
    """Staged sketches, one row per document, with a ``row`` number to tell rows apart."""
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        text_key().alias("text_key"),
        text_of("text").alias("text"),
    )
    made = rows.mapInArrow(_sketch_texts, SKETCHED)
    with small_batches(docs.sparkSession):
        return stage(made.withColumn("row", F.monotonically_increasing_id()), "sketches")


def _buckets(nodes: DataFrame) -> DataFrame:
    """``node``, its ``size`` and a ``bucket`` for each of its sketches."""
    each = nodes.filter(F.size("sketches") > 0).select(
        "node", "size", F.posexplode("sketches").alias("i", "sketch")
    )
    return each.select("node", "size", F.xxhash64("i", "sketch").alias("bucket"))


def _met(bucket_rows: DataFrame) -> DataFrame:
    """The rows of buckets that hold several nodes, with the chosen node as ``hub``; staged.

    All buckets choose by one order of the nodes, so nodes that share many buckets meet few
    others. One aggregation chooses and counts; buckets of one node end there. The rows of a
    large bucket learn its choice from a broadcast of bounded size.
    """
    order = F.struct(F.xxhash64("node"), "node")
    hub = F.min_by(F.struct("node", "size"), order).alias("hub")
    chosen = bucket_rows.groupBy("bucket").agg(hub, F.count(F.lit(1)).alias("nodes"))
    chosen = stage(chosen.filter("nodes > 1"), "buckets")
    total = chosen.agg(F.coalesce(F.sum("nodes"), F.lit(0))).first()[0]
    met = meet(bucket_rows, chosen, ["bucket"], "nodes", total)
    return stage(met.filter("hub is not null").drop("nodes"), "met-buckets")


def _star_pairs(met: DataFrame) -> DataFrame:
    """``node`` and ``other``: the nodes with the hubs of their buckets, once; staged."""
    alike = _may_be_similar(F.col("size"), F.col("hub.size"))
    pairs = met.filter(alike & (F.col("node") != F.col("hub.node")))
    return stage(pairs.select("node", F.col("hub.node").alias("other")).distinct(), "candidates")


def _may_be_similar(a: Column, b: Column) -> Column:
    """The shorter one can share no more shingles than it has."""
    return F.least(a, b) >= F.lit(SIMILAR) * F.greatest(a, b) - SLACK


def _linked(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Those of staged pairs that are similar; staged. ``texts`` has ``node`` and ``text``."""
    partners = stage(
        pairs.groupBy("other")
        .agg(F.count(F.lit(1)).alias("partners"))
        .withColumn("salts", F.ceil(F.col("partners") / PARTNERS).cast("int")),
        "partners",
    )
    total = partners.agg(F.coalesce(F.sum("partners"), F.lit(0))).first()[0]
    salted = meet(pairs, partners, ["other"], "partners", total).select(
        "node", "other", F.pmod(F.xxhash64("node"), F.col("salts")).cast("int").alias("salt")
    )
    spread = partners.select(
        "other", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt")
    )
    others = spread.join(texts.withColumnsRenamed({"node": "other", "text": "other_text"}), "other")
    both = salted.join(texts, "node").join(others, ["other", "salt"])
    checked = both.select("node", "text", "other", "other_text").mapInArrow(
        _verify_pairs, "node long, other long, similarity double"
    )
    with small_batches(pairs.sparkSession):
        return stage(checked, "links")


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``class`` (its smallest node) of all nodes with links; staged.

    Larger neighbours are joined to the smallest neighbour and then all to the smallest one,
    in turn, until every link is one to the smallest node of its class. A step is an
    aggregation and a join by node that spreads nodes with many links.
    """
    edges = stage(
        links.select(
            F.greatest("node", "other").alias("u"), F.least("node", "other").alias("v")
        ).distinct(),
        "edges",
    )
    before = None
    while True:
        state = edges.agg(
            F.count(F.lit(1)).alias("n"),
            F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s"),
        ).first()
        if state == before:
            return stage(
                edges.select(F.col("u").alias("node"), F.col("v").alias("class")).unionByName(
                    edges.select(F.col("v").alias("node"), F.col("v").alias("class")).distinct()
                ),
                "classes",
            )
        before = state
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        joined = _to_least(both, F.col("v") > F.col("u"))
        down = stage(joined.filter("u != v").distinct(), "edges-large")
        joined = _to_least(down, F.lit(True))
        smallest = joined.unionByName(
            down.groupBy("u").agg(F.min("v").alias("v")).filter("u != v")
        )
        edges = stage(
            smallest.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
            .filter("u != v")
            .distinct(),
            "edges-small",
        )


def _to_least(edges: DataFrame, which: Column) -> DataFrame:
    """For every node the links (v, least of the node and its neighbours), where ``which``."""
    least = stage(
        edges.groupBy("u").agg(
            F.least(F.col("u"), F.min("v")).alias("least"), F.count(F.lit(1)).alias("links")
        ),
        "least",
    )
    total = least.agg(F.coalesce(F.sum("links"), F.lit(0))).first()[0]
    met = meet(edges.filter(which), least, ["u"], "links", total)
    return met.select(F.col("v").alias("u"), F.col("least").alias("v"))


def candidate_texts(docs: DataFrame, named: DataFrame, policy: KeyedPolicy) -> DataFrame:
    """Staged ``node`` and ``text`` of the nodes in ``named`` (node, doc_id, text_key)."""
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        text_key().alias("text_key"),
        text_of("text").alias("text"),
    )
    few = named.count() <= policy.broadcast_rows
    r, n = rows.alias("r"), (F.broadcast(named) if few else named).alias("n")
    same = F.col("r.doc_id").eqNullSafe(F.col("n.doc_id")) & (
        F.col("r.text_key") == F.col("n.text_key")
    )
    # Rows that repeat identifier and text are one node.
    return stage(
        r.join(n, same).select("n.node", "r.text").dropDuplicates(["node"]), "candidate-texts"
    )


def classify(docs: DataFrame, policy: KeyedPolicy | None = None) -> DataFrame:
    """The class of every document.

    Columns: ``doc_id``, ``text_key`` (names the row), ``class_id`` (the smallest identifier
    of the class), ``class_size``, ``kept`` (one row of each class, one with the smallest
    identifier) and ``keep_key`` (names that row). One row per input row. Texts of the same words are one class, however long; texts
    without words are in a class with equal texts only. Null is empty. Null identifiers come
    last. Other columns are ignored.
    """
    policy = policy or KeyedPolicy()
    rows = sketch(docs)
    name = ["words_a", "words_b"]
    first = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row", "text_key")
    chosen = F.struct("row", "doc_id", "text_key", "size", "sketches")
    nodes = stage(
        rows.groupBy(*name)
        .agg(F.min_by(chosen, first).alias("f"), F.count(F.lit(1)).alias("copies"))
        .select(
            *name,
            "copies",
            F.col("f.row").alias("node"),
            *[F.col(f"f.{c}").alias(c) for c in ("doc_id", "text_key", "size", "sketches")],
        ),
        "nodes",
    )
    buckets = _met(_buckets(nodes))
    pairs = _star_pairs(buckets)
    named = nodes.join(buckets.select("node").distinct(), "node").select(
        "node", "doc_id", "text_key"
    )
    texts = candidate_texts(docs, stage(named, "named"), policy)
    classes = components(_linked(pairs, texts))
    crowd = _crowd(buckets, classes)
    if not crowd.isEmpty():
        places = _rare_places(crowd, texts, policy)
        stars = _new_pairs(_token_stars(places), pairs)
        classes = _merged(classes, _linked(stars, texts))
        pairs = stage(pairs.unionByName(stars), "met-pairs")
        apart = _marked(_still_apart(places, classes), texts, policy)
        rest = _new_pairs(_all_alike(apart), pairs)
        classes = _merged(classes, _linked(rest, texts))
    return _judged(rows, nodes, classes)


def _merged(classes: DataFrame, links: DataFrame) -> DataFrame:
    """The classes after more links; staged."""
    if links.isEmpty():
        return classes
    joined = classes.select("node", F.col("class").alias("other"))
    return components(joined.unionByName(links.select("node", "other")))


def _crowd(bucket_rows: DataFrame, classes: DataFrame) -> DataFrame:
    """``node`` and ``class`` of the nodes in buckets in which several classes are left; staged."""
    known = stage(
        bucket_rows.join(classes, "node", "left").select(
            "node", "bucket", F.coalesce("class", "node").alias("class")
        ),
        "bucket-classes",
    )
    mixed = (F.min("class") != F.max("class")).alias("mixed")
    several = known.groupBy("bucket").agg(mixed, F.count(F.lit(1)).alias("nodes"))
    several = stage(several.filter("mixed"), "mixed-buckets")
    met = meet(known, several, ["bucket"], "nodes", known.count())
    return stage(met.filter("mixed").select("node", "class").distinct(), "crowd-nodes")


def _new_pairs(found: DataFrame, pairs: DataFrame) -> DataFrame:
    """The pairs that are not among ``pairs`` in either order; staged."""
    return stage(
        found.join(pairs, ["node", "other"], "left_anti").join(
            pairs.toDF("other", "node"), ["node", "other"], "left_anti"
        ),
        "again",
    )


def _cell_counts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many labelled shingles of a task's texts fall in each cell."""
    total = np.zeros(1 << CELL_BITS, np.int64)
    for batch in slices(batches, "text", SLICE_BYTES):
        cells, n = np.unique(_cells(shingles(batch["text"].to_pylist())[0]), return_counts=True)
        total[cells] += n
    hit = np.flatnonzero(total)
    for start in range(0, len(hit), 1 << 17):
        some = hit[start : start + (1 << 17)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(some, pa.int32()), pa.array(total[some])], names=["cell", "n"]
        )
    give_back()


def _cells(labelled: np.ndarray) -> np.ndarray:
    return (labelled >> np.uint64(64 - CELL_BITS)).astype(np.int64)


def _mark_texts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text", SLICE_BYTES):
        found = marks(*shingles(batch["text"].to_pylist()))
        offsets = pa.array(np.arange(len(found) + 1) * MARKS, pa.int32())
        lists = pa.ListArray.from_arrays(offsets, pa.array(found.ravel()))
        yield pa.RecordBatch.from_arrays([batch["node"], lists], names=["node", "marks"])
    give_back()


def _marked(rows: DataFrame, texts: DataFrame, policy: KeyedPolicy) -> DataFrame:
    """The rows with the ``marks`` of their nodes' texts; staged."""
    who = stage(rows.groupBy("node").agg(F.count(F.lit(1)).alias("n")), "marked-nodes")
    few = who.count() <= policy.broadcast_rows
    thin = who.select("node")
    made = texts.join(F.broadcast(thin) if few else thin, "node").select("node", "text")
    with small_batches(rows.sparkSession):
        made = stage(made.mapInArrow(_mark_texts, "node long, marks array<bigint>"), "marks")
    return stage(rows.join(made, "node"), "marked")


def _levels(crowd: DataFrame) -> np.ndarray:
    """A small number for each cell that rises with how many shingles fall in it, from 0 for one.

    The number of cells is fixed, so the answer has a fixed size.
    """
    counted = crowd.select("text").mapInArrow(_cell_counts, "cell int, n long")
    level = F.least(F.lit(255), F.ceil(F.log2(F.sum("n")) * 6)).cast("int")
    found = counted.groupBy("cell").agg(level.alias("level")).filter("level > 0").toArrow()
    out = np.zeros(1 << CELL_BITS, np.uint8)
    out[found["cell"].to_numpy()] = found["level"].to_numpy()
    return out


PLACED = "token long, node long, class long, size long, place long, first boolean"


def _rarest(levels: np.ndarray):
    """For mapInArrow: the rarest labelled shingles of each text, by their ``place`` in an
    order that is the same for all texts.

    Similar texts share one of them, and that is ``first`` in the shorter one. A shingle that is
    alone in its cell is in one text only, so it keeps its place and is not given.
    """

    def placed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", SLICE_BYTES):
            labelled, counts = shingles(batch["text"].to_pylist())
            owner = np.repeat(np.arange(len(counts)), counts)
            level = levels[_cells(labelled)]
            order = np.lexsort((labelled, level, owner))
            size = counts[owner]
            place = np.arange(len(order)) - np.repeat(np.cumsum(counts) - counts, counts)
            keep = (place <= size - np.ceil(SIMILAR * size - SLACK)) & (level[order] > 0)
            first = place <= size - np.ceil(2 * SIMILAR / (1 + SIMILAR) * size - SLACK)
            own = pa.array(owner[keep])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(labelled[order][keep].view(np.int64)),
                    batch["node"].take(own),
                    batch["class"].take(own),
                    pa.array(size[keep].astype(np.int64)),
                    pa.array(place[keep].astype(np.int64)),
                    pa.array(first[keep]),
                ],
                names=["token", "node", "class", "size", "place", "first"],
            )
        give_back()

    return placed


def _rare_places(who: DataFrame, texts: DataFrame, policy: KeyedPolicy) -> DataFrame:
    """The rarest shingles of the nodes that several classes share, with their places; staged.

    A prefix filter: similar texts share so many labelled shingles that one is among the
    rarest of each. Rare ones come first, so those of a common template are left to the
    end and bring together only texts that differ in little else.
    """
    few = who.count() <= policy.broadcast_rows
    crowd = stage(texts.join(F.broadcast(who) if few else who, "node"), "crowd")
    with small_batches(crowd.sparkSession):
        levels = _levels(crowd)
        rows = stage(
            crowd.select("node", "class", "text").mapInArrow(_rarest(levels), PLACED), "rarest"
        )
    return _of_several(rows)


def _of_several(rows: DataFrame) -> DataFrame:
    """The rows of shingles that several classes hold, and one text first; staged."""
    shared = rows.groupBy("token").agg(
        F.count(F.lit(1)).alias("n"),
        (F.min("class") != F.max("class")).alias("several"),
        F.max("first").alias("begins"),
    )
    shared = stage(shared.filter("several and begins").select("token", "n"), "shared-tokens")
    met = meet(rows, shared, ["token"], "n", rows.count()).filter(F.col("n").isNotNull())
    return stage(met.select("token", "node", "class", "size", "place", "first"), "shared-places")


def _token_stars(places: DataFrame) -> DataFrame:
    """Nodes with the hub of each of their shared shingles, if that is of another class.

    Each shingle chooses its own hub, so a node meets many of its kind, but no more than it has
    shingles; where several are similar, that joins nearly all without all pairs.
    """
    order = F.struct(F.xxhash64("token", "node"), "node")
    hub = F.min_by(F.struct("node", "size", "class"), order).alias("hub")
    hubs = stage(places.groupBy("token").agg(hub, F.count(F.lit(1)).alias("n")), "token-hubs")
    met = meet(places, hubs, ["token"], "n", places.count())
    alike = _may_be_similar(F.col("size"), F.col("hub.size"))
    pairs = met.filter(alike & (F.col("class") != F.col("hub.class")))
    return stage(pairs.select("node", F.col("hub.node").alias("other")).distinct(), "token-stars")


def _still_apart(places: DataFrame, classes: DataFrame) -> DataFrame:
    """The places by the classes as they are now, of shingles that still join several; staged."""
    now = places.drop("class").join(classes, "node", "left")
    return _of_several(now.withColumn("class", F.coalesce("class", "node")))


def _all_alike(rows: DataFrame) -> DataFrame:
    """Every pair of nodes of different classes that can be similar; staged.

    Places and sizes bound what a pair that shares a rare shingle can share besides, and marks
    that differ tell of shingles it does not share, so few pairs are left whose texts have to
    meet. Per shingle, pairs have one node at least that is not of its most frequent class, and
    meetings are dealt over salts of both sides.
    """
    facts = stage(
        rows.groupBy("token", "class")
        .agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("first").cast("long")).alias("firsts"))
        .groupBy("token")
        .agg(
            F.max_by("class", F.struct("n", "class")).alias("main"),
            F.sum("n").alias("n"),
            F.ceil(F.sum("firsts") / PARTNERS).cast("int").alias("a_salts"),
            F.ceil(F.sum("n") / PARTNERS).cast("int").alias("b_salts"),
        ),
        "token-classes",
    )
    met = meet(rows, facts, ["token"], "n", rows.count()).withColumn(
        "of_main", F.col("class") == F.col("main")
    )

    def dealt(column: str, salts: str) -> Column:
        return F.pmod(F.xxhash64(column), F.col(salts)).cast("int")

    def spread(salts: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(salts) - 1))

    a = met.filter("first").select(
        "token",
        "of_main",
        dealt("node", "a_salts").alias("a_salt"),
        spread("b_salts").alias("b_salt"),
        *["node", "class", "size", "place", "marks"],
    )
    sides = F.when(F.col("of_main"), F.array(F.lit(False))).otherwise(
        F.array(F.lit(False), F.lit(True))
    )
    b = (
        met.withColumn("side", F.explode(sides))
        .withColumn("a_salt", spread("a_salts"))
        .select(
            "token",
            F.col("side").alias("of_main"),
            "a_salt",
            dealt("node", "b_salts").alias("b_salt"),
            F.col("node").alias("other"),
            F.col("class").alias("its"),
            F.col("size").alias("its_size"),
            F.col("place").alias("its_place"),
            F.col("marks").alias("its_marks"),
        )
    )
    least = F.ceil(F.lit(SIMILAR / (1 + SIMILAR)) * (F.col("size") + F.col("its_size")) - SLACK)
    unlike = sum(
        F.bit_count(F.col("marks")[i].bitwiseXOR(F.col("its_marks")[i])) for i in range(MARKS)
    )
    pairs = a.join(b, ["token", "of_main", "a_salt", "b_salt"]).filter(
        (F.col("class") != F.col("its"))
        & (F.struct("size", "node") < F.struct(F.col("its_size"), F.col("other")))
        & (F.col("place") <= F.col("size") - least)
        & (F.col("its_place") <= F.col("its_size") - least)
        & (unlike <= F.col("size") + F.col("its_size") - 2 * least)
    )
    return stage(pairs.select("node", "other").distinct(), "alike")


def _judged(rows: DataFrame, nodes: DataFrame, classes: DataFrame) -> DataFrame:
    """Classes back to all rows, by the words that rows of one node share."""
    name = ["words_a", "words_b"]
    known = nodes.join(classes, "node", "left").select(
        *name, "copies", "node", "doc_id", "text_key", F.coalesce("class", "node").alias("class")
    )
    known = stage(known, "node-classes")
    first = F.struct(F.col("doc_id").isNull(), "doc_id", "node")
    of_class = stage(
        known.groupBy("class").agg(
            F.min_by(F.struct("doc_id", "node", "text_key"), first).alias("top"),
            F.sum("copies").alias("class_size"),
            F.count(F.lit(1)).alias("members"),
        ),
        "class-sizes",
    )
    facts = meet(known.select(*name, "copies", "class"), of_class, ["class"], "members", known.count())
    facts = stage(facts.filter("class_size > 1").drop("members", "class"), "class-facts")
    thin = rows.select("doc_id", "text_key", *name, "row")
    met = meet(thin, facts, name, "copies", rows.count())
    top = F.coalesce("top", F.struct("doc_id", F.col("row").alias("node"), "text_key"))
    return met.select(
        "doc_id",
        "text_key",
        top["doc_id"].alias("class_id"),
        F.coalesce("class_size", F.lit(1).cast("long")).alias("class_size"),
        (top["node"] == F.col("row")).alias("kept"),
        top["text_key"].alias("keep_key"),
    )


def keep_documents(docs: DataFrame) -> DataFrame:
    """One document of each class, with all its columns."""
    judged = classify(docs).filter(~F.col("kept"))
    gone = judged.groupBy("doc_id", "text_key").agg(
        F.max(F.expr("doc_id <=> class_id AND text_key = keep_key")).alias("repeat")
    )
    return leave_out(docs, stage(gone, "near-copies"))
