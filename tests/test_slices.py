"""Histories by slices and from observations, against the plain model of whole snapshots."""

from __future__ import annotations

import glob
import os
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from creditloom.operators import timeline
from creditloom.sources import slice_store
from creditloom.sources.slice_store import Store
from tests.test_history import DAY, SCENARIO, SCHEMA, model, snapshot, versions


@pytest.fixture
def store(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(slice_store, "ROWS_PER_SLICE", 1)

    def make(name="h"):
        return Store(spark, f"{tmp_path}/{name}", SCHEMA, ("id",))

    return make


def test_snapshots_in_order(spark, store):
    past = store()
    for n, rows in enumerate(SCENARIO):
        for _ in range(2):  # a repeated batch changes nothing
            past.apply(n, snapshot(spark, rows), DAY[n])
        assert versions(past.read_history(n)) == model(SCENARIO[: n + 1])
    assert past.last_batch() == len(SCENARIO) - 1


@pytest.mark.parametrize("order", [(1, 0, 2, 3), (3, 1, 0, 2), (2, 3, 1, 0)])
def test_snapshots_in_any_order(spark, store, order):
    past = store()
    for batch, day in enumerate(order):
        past.apply(batch, snapshot(spark, SCENARIO[day]), DAY[day])
    assert versions(past.read_history(3)) == model(SCENARIO)


records = st.dictionaries(st.integers(0, 4), st.sampled_from(["x", "y", None]), max_size=5)


@settings(max_examples=3, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(records, min_size=2, max_size=5), st.randoms())
def test_history_does_not_depend_on_the_order(spark, store, drawn, rnd):
    days = [[(k, a, None) for k, a in day.items()] for day in drawn]
    order = list(range(len(days)))
    rnd.shuffle(order)
    past = store(f"h{rnd.random()}")
    for batch, day in enumerate(order):
        past.apply(batch, snapshot(spark, days[day]), DAY[day])
    assert versions(past.read_history(len(days) - 1)) == model(days)


def upserts(days):
    """What partial batches of these (day, id, a) leave, by a plain walk through time."""
    out = {}
    for day, key, a in sorted(days):
        spans = out.setdefault(key, [])
        if spans and spans[-1][0] == a:
            continue
        if spans:
            spans[-1][3:] = [DAY[day], False, False]
        spans.append([a, None, DAY[day], None, True, False])
    return {k: [tuple(v) for v in spans] for k, spans in out.items()}


def test_many_versions_in_one_batch_and_late_ones(spark, store):
    draw = random.Random(4)
    days = [(d, k, draw.choice("xy")) for d in range(8) for k in range(12) if draw.random() < 0.6]
    kept = "id int, a string, b string, at string"
    for cut in (1, 2, 5):
        past = store(f"cut{cut}")
        shuffled = days if cut == 2 else draw.sample(days, len(days))
        size = -(-len(days) // cut)
        for n in range(cut):
            part = [(k, a, None, DAY[d]) for d, k, a in shuffled[n * size : (n + 1) * size]]
            past.apply(n, spark.createDataFrame(part, kept), at="at", partial=True)
        assert versions(past.read_history(cut - 1)) == upserts(days)


def test_a_hot_key_is_dealt_over_ranges(spark):
    rows = [(7, "xy"[n // 3 % 2], None, n) for n in range(3000)] + [(8, "z", None, 5)]
    df = spark.createDataFrame(rows, "id int, a string, b string, n int").repartition(8)
    rows = df.select("id", "a", "b", F.timestamp_seconds("n").alias("at"))
    seen = timeline.observe(rows, F.col("at"), ["id", "a"])
    ranges = timeline.dealt(seen.drop("at"), ["id"], ["seen_at"], 4)
    assert ranges.filter("id = 7").select("_range").distinct().count() > 1
    got = timeline.history_of(seen.drop("at"), ["id"]).collect()
    spans = sorted((r.valid_from, r.valid_to) for r in got if r.id == 7)
    assert len(spans) == 1000 and sum(r.is_current for r in got) == 2
    assert all(a[1] == b[0] for a, b in zip(spans, spans[1:]))


def test_two_versions_at_one_moment_are_refused(spark, store):
    rows = [(1, "x", None), (1, "y", None)]
    with pytest.raises(Exception, match="one moment"):
        past = store()
        part = spark.createDataFrame([(*r, DAY[0]) for r in rows], f"{SCHEMA}, at string")
        past.apply(0, part, at="at", partial=True)


def size_of(path):
    return {
        f: os.path.getsize(f) for f in glob.glob(f"{path}/**/*.parquet", recursive=True)
    }


def test_a_small_batch_writes_its_slices_only(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(slice_store, "ROWS_PER_SLICE", 100)
    past = Store(spark, f"{tmp_path}/h", SCHEMA, ("id",))
    many = [(k, f"text {k}", None) for k in range(5000)]
    past.apply(0, spark.createDataFrame(many, SCHEMA), DAY[0])
    assert past.slices() == 50
    first = size_of(past.path)
    few = [(k, "new", None) for k in (1, 2, 9999)] + [(3, "text 3", None)]
    past.apply(1, spark.createDataFrame(few, SCHEMA), DAY[1], partial=True)
    touched = {s for b, s in past.folders("current") if b == 1}
    assert 1 <= len(touched) <= 3
    added = sum(n for f, n in size_of(past.path).items() if f not in first)
    assert added < 0.15 * sum(first.values())
    # Only the slices of the batch's keys are read.
    files = past.read_current(0, list(touched)).inputFiles()
    assert len({f.rsplit("/", 1)[0] for f in files}) == len(touched)
    now = {r.id: r.a for r in past.read_current(1).collect()}
    assert now[1] == now[9999] == "new" and now[4] == "text 4" and len(now) == 5001
    assert past.read_changes(1).count() == 5


def test_superseded_slices_go(spark, store):
    past = store()
    for n in range(4):
        past.apply(n, snapshot(spark, [(1, str(n), None), (2, "same", None)]), DAY[n])
    of_one = [b for b, s in past.folders("current")]
    assert sorted(set(of_one)) in ([0, 2, 3], [2, 3])
    assert versions(past.read_history(3))[2] == [("same", None, DAY[0], None, True, False)]
    # The batch before the last can still be read, as can all closed versions.
    assert {r.id: r.a for r in past.read_current(2).collect()} == {1: "2", 2: "same"}
    assert len(versions(past.read_history(3))[1]) == 4


def test_nothing_is_left_and_comes_back(spark, store):
    days = [[(1, "a", "a")], [], [], [(1, "a", "a")]]
    past = store()
    for n, rows in enumerate(days):
        past.apply(n, snapshot(spark, rows), DAY[n])
    assert versions(past.read_history(3)) == model(days)


def test_what_cannot_be_is_refused(spark, store):
    past = store()
    rows = snapshot(spark, SCENARIO[0])
    with pytest.raises(ValueError, match="as_of"):
        past.apply(0, rows, at="a")
    past.apply(0, rows, DAY[3])
    with pytest.raises(ValueError, match="late"):
        past.apply(1, rows, DAY[0], held_keys=rows.select("id"))
