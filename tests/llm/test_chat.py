from __future__ import annotations

import hashlib
from collections import defaultdict

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from creditloom.llm import chat

MESSAGE = "conv_id long, turn long, role string, text string"


def log(spark, rows):
    return spark.createDataFrame(rows, chat.EVENT)


def test_deltas_edits_and_regenerations(spark):
    rows = [
        (1, 1, 0, "message", "user", "Hi"),
        (1, 2, 1, "message", "assistant", ""),
        (1, 3, 1, "delta", None, "Hel"),
        (1, 4, 1, "delta", None, "lo"),
        (1, 5, 2, "message", "user", "More"),
        (1, 6, 3, "delta", "assistant", "streamed "),
        (1, 7, 3, "delta", "assistant", "only"),
        (1, 8, 0, "edit", None, "Hi there"),
        (2, 1, 0, "message", "user", "Q"),
        (2, 2, 1, "message", "assistant", "bad"),
        (2, 3, 2, "message", "user", "void from here"),
        (2, 4, 1, "regenerate", None, None),
        (2, 5, 1, "delta", None, "good"),
        (2, 6, 2, "message", "user", "again"),
        (None, None, None, None, None, None),
    ]
    got = {(r.conv_id, r.turn): (r.role, r.text) for r in chat.reconstruct(log(spark, rows)).collect()}
    assert got == {
        (1, 0): ("user", "Hi there"),
        (1, 1): ("assistant", "Hello"),
        (1, 2): ("user", "More"),
        (1, 3): ("assistant", "streamed only"),
        (2, 0): ("user", "Q"),
        (2, 1): ("assistant", "good"),
        (2, 2): ("user", "again"),
        (None, None): (None, ""),
    }


ODD = ["", "\\", "\\e", "###", "####", "##", "# #", "</turn>", "</turn>\n", "<</turn>", "\\t", "\\\\h",
       "### assistant\n", "\\### Assistant: </turn> ok", "é\n\n", "\n", "a" * 30]


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(
    st.integers(-3, 3), st.sampled_from([None, "user", "assistant", "a\nb", "### x", "\\n", "</turn>"]),
    st.none() | st.lists(st.sampled_from(ODD), max_size=4).map("".join)), min_size=1, max_size=12))
def test_round_trip(spark, turns):
    rows = [(conv, n, role, text) for n, (conv, role, text) in enumerate(turns)]
    read = chat.parse(chat.render(spark.createDataFrame(rows, MESSAGE))).collect()
    wanted = defaultdict(list)
    for conv, _, role, text in rows:
        wanted[conv].append((role or "", text or ""))
    got = {r.conv_id: [(t.role, t.text) for t in r.turns] for r in read}
    assert got == wanted
    for r in read:
        assert r.learned == [text for role, text in wanted[r.conv_id] if role == "assistant"]
        for span in r.loss_spans:  # the mask is a mask of the formatted text
            shown = r.formatted[span["at"] + span["start"] : span["at"] + span["end"]]
            assert "</turn>" not in shown and "###" not in shown


def test_empty_log_and_other_columns(spark):
    assert chat.format_log(log(spark, [])).collect() == []
    rows = log(spark, [(1, 1, 1, "message", "assistant", "x" * 300_000)])
    rows = rows.select("*", F.lit(1).alias("place"), F.lit(2).alias("formatted"))
    (r,) = chat.parse(chat.format_log(rows)).collect()
    assert hashlib.sha256(r.learned[0].encode()).hexdigest() == hashlib.sha256(b"x" * 300_000).hexdigest()
