"""Chat logs as training text: event-sourced reconstruction, rendering, loss mask.

A log is a list of events of a conversation in the order of ``seq``. An event concerns one
``turn`` and is of a ``kind``:

* ``message``: the turn's role and text;
* ``delta``: more text at the end of the turn (as streamed);
* ``edit``: new text of the turn in place of what it had;
* ``regenerate``: as an edit, and all later turns logged until then are void.

Template: a turn is ``### `` role, newline, text, ``</turn>`` newline. Inside roles and
texts the control strings and the escape character are replaced one to one::

    \\  ->  \\e      ###  ->  \\h      </turn>  ->  \\t      (in roles, newline -> \\n)

Every backslash of an escaped string starts one of these pairs, so the inverse is unique,
whatever the text, also one that is escaped already.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from creditloom.llm.common import text_of

HEAD, END = "### ", "</turn>"
RESETS = ("message", "edit", "regenerate")
LEARNED = "assistant"
EVENT = "conv_id long, seq long, turn long, kind string, role string, text string"


def _swap(column: Column, pairs: list[tuple[str, str]]) -> Column:
    for old, new in pairs:
        column = F.replace(column, F.lit(old), F.lit(new))
    return column


TEXT_PAIRS = [("\\", "\\e"), ("###", "\\h"), (END, "\\t")]
ROLE_PAIRS = [*TEXT_PAIRS, ("\n", "\\n")]


def escape(column: Column) -> Column:
    return _swap(column, TEXT_PAIRS)


def unescape(column: Column) -> Column:
    return _swap(column, [(new, old) for old, new in reversed(TEXT_PAIRS)])


def escape_role(column: Column) -> Column:
    return _swap(column, ROLE_PAIRS)


def unescape_role(column: Column) -> Column:
    return _swap(column, [(new, old) for old, new in reversed(ROLE_PAIRS)])


def reconstruct(events: DataFrame) -> DataFrame:
    """Final messages: ``conv_id``, ``turn``, ``role``, ``text``; one row per live turn.

    The last message, edit or regeneration of a turn starts its text and later deltas are
    appended. A turn is void from a regeneration of an earlier turn until it is logged
    again. The role is the last one given. A turn of deltas alone starts empty. Null text is
    empty, a null kind is a message; null conversations form one. Events with the same
    ``seq`` are taken in the order of turn, kind, role and text. Other columns are ignored.
    """
    log = events.select(
        "conv_id",
        "seq",
        "turn",
        F.coalesce("kind", F.lit("message")).alias("kind"),
        "role",
        text_of("text").alias("text"),
    )
    order = ["seq", "turn", "kind", "role", "text"]
    later = Window.partitionBy("conv_id").orderBy(*[F.col(c).desc() for c in order])
    later = later.rowsBetween(Window.unboundedPreceding, -1)
    redone = F.min(F.when(F.col("kind") == "regenerate", F.col("turn"))).over(later)
    live = log.withColumn("_redone", redone).filter(
        F.col("_redone").isNull() | F.col("turn").isNull() | (F.col("turn") <= F.col("_redone"))
    )
    step = F.struct("seq", (F.col("kind") != "delta").cast("int").alias("_reset"), *order[2:])
    # Where the text of a turn starts: its last reset.
    start = F.max(F.when(F.col("kind").isin(*RESETS), step))
    role = F.max_by("role", F.when(F.col("role").isNotNull(), step))
    turn = Window.partitionBy("conv_id", "turn")
    folded = (
        live.withColumn("_step", step)
        .withColumn("_start", start.over(turn))
        .withColumn("_role", role.over(turn))
        .filter(F.col("_start").isNull() | (F.col("_step") >= F.col("_start")))
    )
    parts = F.sort_array(F.collect_list(F.struct("_step", "text")))
    return folded.groupBy("conv_id", "turn").agg(
        F.first("_role").alias("role"), F.array_join(F.transform(parts, lambda p: p["text"]), "").alias("text")
    )


def render(messages: DataFrame) -> DataFrame:
    """One row per conversation: ``formatted`` text and its ``loss_spans``.

    A span names a turn's place from 0 and the characters ``[start, end)`` of that turn, as
    rendered, which a model learns from; ``at`` is where the turn begins in the whole text.
    Turns are in the order of ``turn``, then role and text, nulls first. A null role is
    empty. The text of one conversation has to fit in memory, as it is one value.
    """
    role, text = escape_role(text_of("role")), escape(text_of("text"))
    head = F.concat(F.lit(HEAD), role, F.lit("\n"))
    turns = messages.select(
        "conv_id",
        F.struct(
            F.col("turn"),
            text_of("role").alias("role"),
            F.concat(head, text, F.lit(END + "\n")).alias("shown"),
            F.length(head).alias("start"),
            (F.length(head) + F.length(text)).alias("end"),
        ).alias("t"),
    )
    before = Window.partitionBy("conv_id").orderBy("t")
    placed = turns.select(
        "conv_id",
        "t",
        (F.row_number().over(before) - 1).alias("place"),
        (
            F.sum(F.length("t.shown")).over(before.rowsBetween(Window.unboundedPreceding, 0))
            - F.length("t.shown")
        ).alias("at"),
    )
    each = F.struct("place", "t.shown", "t.role", "t.start", "t.end", "at")
    spans = F.filter("turns", lambda t: t["role"] == LEARNED)
    return (
        placed.groupBy("conv_id")
        .agg(F.sort_array(F.collect_list(each)).alias("turns"))
        .select(
            "conv_id",
            F.array_join(F.transform("turns", lambda t: t["shown"]), "").alias("formatted"),
            F.transform(
                spans,
                lambda t: F.struct(
                    t["place"].alias("place"),
                    t["at"].alias("at"),
                    t["start"].alias("start"),
                    t["end"].alias("end"),
                ),
            ).alias("loss_spans"),
        )
    )


def parse(formatted: DataFrame) -> DataFrame:
    """Read formatted conversations back: ``turns`` of role and text, and ``learned`` texts."""
    shown = F.split("formatted", END + "\n", -1)
    shown = F.slice(shown, 1, F.size(shown) - 1)
    cut = formatted.withColumn("_shown", shown)

    def read(piece: Column) -> Column:
        line = F.locate("\n", piece)
        return F.struct(
            unescape_role(F.substring(piece, F.lit(len(HEAD) + 1), line - len(HEAD) - 1)).alias(
                "role"
            ),
            unescape(F.substring(piece, line + 1, F.length(piece))).alias("text"),
        )

    def learned(span: Column) -> Column:
        piece = F.get(F.col("_shown"), span["place"])
        return unescape(F.substring(piece, span["start"] + 1, span["end"] - span["start"]))

    return cut.select(
        "conv_id",
        "formatted",
        "loss_spans",
        F.transform("_shown", read).alias("turns"),
        F.transform("loss_spans", learned).alias("learned"),
    )


def format_log(events: DataFrame) -> DataFrame:
    """Events to formatted conversations."""
    return render(reconstruct(events))
