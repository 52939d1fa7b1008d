"""Repair of conversations by the cheapest edits that give a legal order of roles.

Every row of a conversation becomes one symbol, its role and its first fault, and the symbols
in order its signature. What the rest of a conversation costs depends on its signature's
suffix and on the state of the grammar ``(s?(ua)+)?`` alone. So the distinct signatures of all
conversations are sorted by their ends, where those that share a suffix follow each other, and
read from the end into an automaton: a suffix is one path of nodes, made once, and equal
nodes (the same cost-to-go, up to a constant, and the same best edit in each grammar state) are one.
Edits are then replayed over the rows, which never leave their order and are never gathered.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterable, Iterator
from os.path import commonprefix

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditloom.llm.common import global_rank, meet, slices, small_batches
from creditloom.sources.staging import stage

REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
"""Costs of edits, and of a truncated row that stays. Keeping a row is free."""
SPACE = " \t\n\x0b\x0c\r"
ROLES = ("s", "u", "a")
"""Initials of the grammar's roles; any other role is a fourth kind."""
BLANK, DUPLICATE, CUT = 1, 2, 3
CHUNK = 4096
"""Symbols of a conversation that are first joined to one string."""

# States of the grammar: nothing yet, after the system, after a user, after an assistant.
NEXT = (2, 2, 3, 2)
NEXT_ROLE = ("user", "user", "assistant", "user")
KEEPS = ({0: 1}, {0: 2, 1: 2, 3: 2}, {2: 3}, {})
"""For each kind of role, the states in which a row may stay and the states that follow."""
LEGAL = {(0, 1), (1, 2), (2, 1)}


def clean_rows(rows: DataFrame) -> DataFrame:
    """The columns that are used; a null role or text is one space."""
    return rows.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text"),
    )


def _kind(role: Column) -> Column:
    initial = F.substring(role, 1, 1)
    found = [F.when(initial == r, i) for i, r in enumerate(ROLES)]
    return F.coalesce(*found, F.lit(len(ROLES)))


def signatures(rows: DataFrame) -> DataFrame:
    """``conv_id``, ``signature`` and ``gaps`` of all conversations that have rows.

    Rows are ranked over all conversations at once by range, so that the rows of a very
    long one are dealt over tasks; its symbols meet in chunks.
    """
    spark = rows.sparkSession
    body = F.rtrim("text", F.lit(SPACE))
    thin = clean_rows(rows).select(
        "conv_id",
        "turn",
        "role",
        F.md5("text").alias("tie"),
        _kind(F.col("role")).alias("kind"),
        (body == "").alias("blank"),
        (~F.substring(body, -1, 1).isin(".", "!", "?")).alias("cut"),
        F.xxhash64("conv_id", "role", "text").alias("a"),
        F.xxhash64(F.lit(1), "text", "role", "conv_id").alias("b"),
    )
    order = [F.col(c) for c in ("conv_id", "turn", "role", "tie")]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranked = stage(global_rank(thin, order, "rank", parts).drop("role", "tie"), "ranked-rows")
    again = (
        ranked.groupBy("a", "b")
        .agg(F.min("rank").alias("first"), F.count(F.lit(1)).alias("n"))
        .filter("n > 1")
    )
    met = meet(ranked, stage(again, "repeated-rows"), ["a", "b"], "n", ranked.count())
    fault = (
        F.when(F.col("blank"), BLANK)
        .when(F.col("rank") > F.col("first"), DUPLICATE)
        .when(F.col("cut"), CUT)
        .otherwise(0)
    )
    symbol = F.char(ord("A") + 4 * F.col("kind") + fault)

    def joined(place: str, text: str | Column) -> Column:
        pairs = F.sort_array(F.collect_list(F.struct(F.col(place).alias("p"), text)))
        return F.array_join(F.transform(pairs, lambda p: p["t"]), "")

    whole = (
        met.groupBy("conv_id", F.floor(F.col("rank") / CHUNK).alias("chunk"))
        .agg(joined("rank", symbol.alias("t")).alias("t"))
        .groupBy("conv_id")
        .agg(joined("chunk", F.col("t")).alias("signature"))
    )
    turns = ranked.select("conv_id", "turn").distinct().groupBy("conv_id")
    missing = F.max("turn") - F.min("turn") + 1 - F.count("turn")
    gaps = turns.agg(F.coalesce(missing, F.lit(0)).cast("long").alias("gaps"))
    return whole.join(gaps.withColumnRenamed("conv_id", "its"), F.expr("conv_id <=> its")).drop(
        "its"
    )


class Automaton:
    """Classes of suffixes: cost-to-go in each state above the least one, and the best edit.

    A class is entered by the symbol before a suffix; each step is computed once. Of equally
    cheap edits the first in the alphabet is best; two edits from one state never share a
    letter, so this gives the least audit.
    """

    def __init__(self):
        self.known: dict[tuple, int] = {}
        self.classes: list[tuple[tuple, tuple]] = []
        self.steps: dict[tuple[str, int], tuple[int, int]] = {}
        self.end = self._class([0, None, None, 0], [("", 0), None, None, ("", 0)])[0]

    def _class(self, costs: list, edits: list) -> tuple[int, int]:
        for _ in costs:
            for state, to in enumerate(NEXT):
                if costs[to] is None:
                    continue
                option = (costs[to] + INSERT, "I")
                if costs[state] is None or option < (costs[state], edits[state][0]):
                    costs[state], edits[state] = option[0], ("I", to)
        least = min(costs)
        key = (tuple(c - least for c in costs), tuple(edits))
        if key not in self.known:
            self.known[key] = len(self.classes)
            self.classes.append(key)
        return self.known[key], least

    def step(self, symbol: str, after: int) -> tuple[int, int]:
        """The class of a suffix with ``symbol`` before it, and what its costs rise by."""
        found = self.steps.get((symbol, after))
        if found is None:
            kind, fault = divmod(ord(symbol) - ord("A"), 4)
            ahead = self.classes[after][0]
            more = TRUNCATED if fault == CUT else 0
            costs, edits = [], []
            for state in range(4):
                options = [(ahead[state] + DELETE, "D", state)]
                if fault not in (BLANK, DUPLICATE):
                    to = NEXT[state]
                    options.append((ahead[to] + REROLE + more, "R", to))
                    if state in KEEPS[kind]:
                        to = KEEPS[kind][state]
                        options.append((ahead[to] + more, "K", to))
                cost, letter, to = min(options)
                costs.append(cost)
                edits.append((letter, to))
            found = self.steps[symbol, after] = self._class(costs, edits)
        return found


def _solve(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Cost, audit and counts of signatures that come sorted by their ends."""
    automaton = Automaton()
    before = ""
    path, rise = array("q", [automaton.end]), array("q", [0])
    for batch in slices(batches, "signature"):
        costs, audits, counts = [], [], []
        for signature in batch["signature"].to_pylist():
            back = signature[::-1]
            shared = len(commonprefix((before, back)))
            del path[shared + 1 :], rise[shared + 1 :]
            for symbol in back[shared:]:
                node, more = automaton.step(symbol, path[-1])
                path.append(node)
                rise.append(rise[-1] + more)
            before = back
            audit, state = [], 0
            costs.append(rise[-1] + automaton.classes[path[-1]][0][0])
            for node in reversed(path):
                edits = automaton.classes[node][1]
                letter, state = edits[state]
                while letter == "I":
                    audit.append(letter)
                    letter, state = edits[state]
                audit.append(letter)
            audits.append("".join(audit))
            counts.append(_counts(signature))
        names = ["signature", "blank", "duplicate", "truncated", "illegal", "cost", "audit"]
        numbers = [pa.array(c, pa.int64()) for c in zip(*counts)]
        yield pa.RecordBatch.from_arrays(
            [batch["signature"], *numbers, pa.array(costs, pa.int64()), pa.array(audits)],
            names=names,
        )


def _counts(signature: str) -> tuple[int, ...]:
    codes = np.frombuffer(signature.encode(), np.uint8) - ord("A")
    faults = np.bincount(codes % 4, minlength=4)
    pairs = np.bincount(4 * (codes[:-1] // 4) + codes[1:] // 4, minlength=16)
    legal = sum(int(pairs[4 * a + b]) for a, b in LEGAL)
    return (*faults[[BLANK, DUPLICATE, CUT]].tolist(), int(pairs.sum()) - legal)


def judge(rows: DataFrame, conversations: DataFrame | None = None) -> DataFrame:
    """What is wrong with every conversation and the cheapest edits that mend it; staged.

    ``rows`` have ``conv_id``, ``turn``, ``role`` and ``text``; ``conversations`` may name
    conversations (``conv_id``) that have no rows. Columns: ``conv_id``, ``gaps`` (turn numbers
    that are missing), ``blank``, ``duplicate``, ``truncated`` (rows by first fault),
    ``illegal`` (neighbouring rows whose roles do not follow each other), ``cost`` and
    ``audit`` (initials of Keep, Rerole, Delete, Insert in order). One row per conversation.

    Rows go by turn, nulls first; rows of one turn by role and a hash of the text. A null role
    or text is one space; a null ``conv_id`` is a conversation of its own. Without rows all
    numbers are 0 and the audit is empty. Texts are read whole. Other columns are ignored.
    """
    ids = (rows if conversations is None else conversations).select(
        F.col("conv_id").cast("long").alias("conv_id")
    )
    none = ids.distinct().select(
        "conv_id", F.lit("").alias("signature"), F.lit(0).cast("long").alias("gaps")
    )
    known = stage(
        signatures(rows)
        .unionByName(none)
        .groupBy("conv_id")
        .agg(F.max("signature").alias("signature"), F.max("gaps").alias("gaps")),
        "signatures",
    )
    # By a hash of their own, since signatures can be long.
    known = known.withColumns({"a": F.xxhash64("signature"), "b": F.xxhash64(F.lit(1), "signature")})
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    distinct = (
        known.groupBy("a", "b")
        .agg(F.first("signature").alias("signature"), F.count(F.lit(1)).alias("n"))
        .withColumn("back", F.reverse("signature"))
        .repartitionByRange(parts, "back")
        .sortWithinPartitions("back")
    )
    schema = (
        "signature string, blank long, duplicate long, truncated long, illegal long, "
        "cost long, audit string"
    )
    with small_batches(rows.sparkSession):
        solved = stage(distinct.select("signature").mapInArrow(_solve, schema), "solved")
    solved = solved.select(
        F.xxhash64("signature").alias("a"),
        F.xxhash64(F.lit(1), "signature").alias("b"),
        *[c for c in solved.columns if c != "signature"],
    ).join(known.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n")), ["a", "b"])
    met = meet(known.drop("signature"), stage(solved, "solved-counts"), ["a", "b"], "n", known.count())
    return stage(met.drop("a", "b", "n"), "judged")


ORDERED = "conv_id long, row boolean, turn long, role string, tie string, text string, audit string"


def _ordered(rows: DataFrame, judged: DataFrame) -> DataFrame:
    """All rows by conversation and order, before them one with the audit."""
    columns = ["conv_id", "row", "turn", "role", "tie", "text", "audit"]
    null = F.lit(None)
    heads = judged.select(
        "conv_id",
        F.lit(False).alias("row"),
        null.cast("long").alias("turn"),
        *[null.cast("string").alias(c) for c in ("role", "tie", "text")],
        "audit",
    )
    body = clean_rows(rows).select(
        "*", F.md5("text").alias("tie"), F.lit(True).alias("row"), null.cast("string").alias("audit")
    )
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (
        heads.unionByName(body.select(*columns))
        .repartition(parts, "conv_id")
        .sortWithinPartitions("conv_id", "row", "turn", "role", "tie")
    )


def _replay(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    """The messages (conv_id, role, text, edit) of the repaired conversations in order.

    Each conversation is announced by a tuple without role. One row is held at a time.
    """
    conv = audit = None
    at = state = 0
    for batch in slices(batches, "text"):
        for own, is_row, role, text, its in zip(
            *[batch[c].to_pylist() for c in ("conv_id", "row", "role", "text", "audit")]
        ):
            if not is_row:
                conv, audit, at, state = own, its, 0, 0
                yield conv, None, None, None
            else:
                letter = audit[at]
                at += 1
                if letter == "R":
                    yield conv, NEXT_ROLE[state], text, letter
                    state = NEXT[state]
                elif letter == "K":
                    yield conv, role, text, letter
                    state = KEEPS["sua".index(role[0])][state]
            while at < len(audit) and audit[at] == "I":
                at += 1
                yield conv, NEXT_ROLE[state], "", "I"
                state = NEXT[state]


def rewrite(rows: DataFrame, judged: DataFrame) -> DataFrame:
    """The repaired conversations: ``conv_id``, ``place`` (from 0), ``role``, ``text``, ``edit``."""

    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        place = size = 0
        for conv, role, text, edit in _replay(batches):
            if role is None:
                place = 0
                continue
            held.append((conv, place, role, text, edit))
            place += 1
            size += len(text)
            if size > 1 << 20 or len(held) >= 10_000:
                yield batch(held)
                held, size = [], 0
        if held:
            yield batch(held)

    def batch(held: list[tuple]) -> pa.RecordBatch:
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string())
        columns = [pa.array(c, k) for c, k in zip(zip(*held), kinds)]
        return pa.RecordBatch.from_arrays(columns, ["conv_id", "place", "role", "text", "edit"])

    schema = "conv_id long, place long, role string, text string, edit string"
    return _ordered(rows, judged).mapInArrow(write, schema)


def digests(rows: DataFrame, judged: DataFrame) -> DataFrame:
    """``conv_id`` and ``repaired_sha256`` over the messages ``role:text``, joined by newlines; staged.

    Messages are hashed as they pass, so a conversation of any length takes no memory.
    """

    def digest(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names: list[int | None] = []
        hashes: list[str] = []
        state = None
        first = True
        for conv, role, text, _ in _replay(batches):
            if role is None:
                if state is not None:
                    hashes.append(state.hexdigest())
                names.append(conv)
                state, first = hashlib.sha256(), True
                continue
            message = f"{role}:{text}" if first else f"\n{role}:{text}"
            state.update(message.encode("utf-8", "surrogatepass"))
            first = False
            if len(names) > 10_000:
                yield out(names[:-1], hashes)
                names, hashes = names[-1:], []
        if state is not None:
            hashes.append(state.hexdigest())
            yield out(names, hashes)

    def out(names: list, hashes: list) -> pa.RecordBatch:
        columns = [pa.array(names, pa.int64()), pa.array(hashes, pa.string())]
        return pa.RecordBatch.from_arrays(columns, ["conv_id", "repaired_sha256"])

    made = _ordered(rows, judged).mapInArrow(digest, "conv_id long, repaired_sha256 string")
    with small_batches(rows.sparkSession):
        return stage(made, "digests")
