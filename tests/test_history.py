"""Several days of snapshots, against a straightforward model in Python."""

from __future__ import annotations

import hashlib

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from creditloom.operators import history
from creditloom.sources import history_store
from creditloom.sources.staging import stage

DAY = [f"2024-01-0{n} 00:00:00" for n in range(1, 9)]
SCHEMA = "id int, a string, b string"


def snapshot(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).coalesce(2)


def run(spark, days, **kwargs):
    past = None
    for n, rows in enumerate(days):
        past = stage(history.apply_batch(past, snapshot(spark, rows), "id", DAY[n], **kwargs), "t")
    return past


def versions(df):
    """id -> list of (a, b, from, to, current, deleted) by start."""
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.id, r.valid_from)):
        out.setdefault(r.id, []).append(
            (r.a, r.b, str(r.valid_from), None if r.valid_to is None else str(r.valid_to),
             r.is_current, r.is_deleted_in_source)
        )
    return out


def model(days):
    out = {}
    live = {}
    for n, rows in enumerate(days):
        today = {r[0]: (r[1], r[2]) for r in rows}
        for key in set(live) | set(today):
            if live.get(key) == today.get(key):
                continue
            if key in live:
                out[key][-1][3:] = [DAY[n], False, key not in today]
            if key in today:
                out.setdefault(key, []).append([*today[key], DAY[n], None, True, False])
        live = today
    return {k: [tuple(v) for v in vs] for k, vs in out.items()}


SCENARIO = [
    [(1, "x", "p"), (2, "y", None), (3, "z", "q")],
    [(1, "x", "p"), (2, "y", "r"), (4, "n", "n")],   # 2 changes, 3 leaves, 4 is new
    [(1, "x", "p"), (2, "y", "s"), (3, "z", "q")],   # 2 changes again, 3 is back, 4 leaves
    [(1, "x", "p"), (2, "y", "s"), (3, "z", "q")],   # nothing
]


def test_scenario(spark):
    assert versions(run(spark, SCENARIO)) == model(SCENARIO)
    assert len(model(SCENARIO)[2]) == 3
    assert [v[4] for v in model(SCENARIO)[3]] == [False, True]


def test_changes(spark):
    now = history.current(run(spark, SCENARIO[:1]))
    staged = history.changes(now, snapshot(spark, SCENARIO[1]), "id", DAY[1]).collect()
    assert sorted((r.id, r.change_type, r.merge_key, r.is_current, r.is_deleted_in_source) for r in staged
                  if r.merge_key is not None) == [
        (2, "update", "2", False, False), (3, "delete", "3", False, True)]
    assert sorted((r.id, r.change_type, r.is_current) for r in staged if r.merge_key is None) == [
        (2, "update", True), (4, "insert", True)]
    again = history.changes(now, snapshot(spark, SCENARIO[0]), "id", DAY[1])
    assert again.count() == 0


def test_hash_and_surrogate_key(spark):
    past = run(spark, SCENARIO[:2])
    rows = {(r.id, str(r.valid_from)): r for r in past.collect()}
    assert all(r.row_hash for r in rows.values())
    new = rows[(2, DAY[1])]
    assert new.sk_id == hashlib.md5(f"2|{DAY[1]}".encode()).hexdigest()
    assert new.row_hash == hashlib.md5(b"1:2|1:y|1:r").hexdigest()
    assert rows[(2, DAY[0])].row_hash == hashlib.md5(b"1:2|1:y|-").hexdigest()


def test_hash_tells_nulls_and_separators_apart(spark):
    df = snapshot(spark, [(1, "a", None), (2, None, "a"), (3, "a|1:b", "c"), (4, "a", "1:b|1:c")])
    framed = {r.id: r.h for r in df.select("id", history.row_hash(["a", "b"]).alias("h")).collect()}
    assert len(set(framed.values())) == 4
    compat = {
        r.id: r.h for r in df.select("id", history.row_hash(["a", "b"], compat=True).alias("h")).collect()
    }
    assert compat[1] == compat[2] == hashlib.md5(b"a").hexdigest()
    moved = [[(1, "a", None)], [(1, None, "a")]]
    assert len(versions(run(spark, moved))[1]) == 2
    assert len(versions(run(spark, moved, compat_hash=True))[1]) == 1


def test_missing_hash_counts_as_changed(spark):
    past = run(spark, SCENARIO[:1]).withColumn("row_hash", history.F.lit(None).cast("string"))
    after = history.apply_batch(past, snapshot(spark, SCENARIO[0]), "id", DAY[1])
    assert {k: len(v) for k, v in versions(after).items()} == {1: 2, 2: 2, 3: 2}


def test_bad_keys_are_refused(spark):
    twice = snapshot(spark, [(1, "a", "b"), (1, "a", "c")])
    null = snapshot(spark, [(None, "a", "b")])
    past = run(spark, SCENARIO[:1])
    for bad, why in ((twice, "duplicate key"), (null, "null in key")):
        with pytest.raises(Exception, match=why):
            history.initial(bad, "id", DAY[0]).collect()
        with pytest.raises(Exception, match=why):
            history.apply_batch(past, bad, "id", DAY[1]).collect()


def test_composite_keys(spark):
    def rows(*values):
        return spark.createDataFrame(values, "k int, l string, v string")

    past = history.initial(rows((1, "a", "x"), (1, "b", "x")), ["k", "l"], DAY[0])
    after = history.apply_batch(past, rows((1, "a", "y"), (1, "b", "x")), ["k", "l"], DAY[1])
    got = sorted((r.k, r.l, r.v, r.is_current) for r in after.collect())
    assert got == [(1, "a", "x", False), (1, "a", "y", True), (1, "b", "x", True)]
    staged = history.changes(past, rows((1, "b", "x")), ["k", "l"], DAY[1]).collect()
    assert [r.merge_key for r in staged] == ["1|a"]


def test_held_keys(spark):
    past = run(spark, [[(1, "a", "a"), (2, "b", "b"), (3, "c", "c")]])
    held = spark.createDataFrame([(2,), (2,), (9,), (None,)], "id int")
    after = history.apply_batch(past, snapshot(spark, [(1, "a", "a")]), "id", DAY[1], held_keys=held)
    got = versions(after)
    assert sorted(got) == [1, 2, 3]
    assert got[2][0][4:] == (True, False)
    assert got[3][0][4:] == (False, True)


def test_partial_batches_delete_nothing(spark):
    past = run(spark, SCENARIO[:1])
    after = history.apply_batch(
        past, snapshot(spark, [(2, "y", "new"), (4, "n", "n")]), "id", DAY[1], partial=True
    )
    got = {k: [v[4:] for v in vs] for k, vs in versions(after).items()}
    assert got == {
        1: [(True, False)], 2: [(False, False), (True, False)], 3: [(True, False)], 4: [(True, False)]
    }


def test_only_tracked_columns_matter(spark):
    days = [[(1, "a", "p")], [(1, "a", "q")]]
    assert len(versions(run(spark, days, tracked=["a"]))[1]) == 1
    assert len(versions(run(spark, days, tracked=["b", *history.META]))[1]) == 2


def test_new_column(spark):
    past = run(spark, [[(1, "a", "p"), (2, "b", "q")]])
    wide = spark.createDataFrame([(1, "a", "p", 7)], "id int, a string, b string, c int")
    after = history.apply_batch(past, wide, "id", DAY[1])
    got = {(r.id, r.is_current): r.c for r in after.collect()}
    assert got == {(1, False): None, (1, True): 7, (2, False): None}
    narrow = history.apply_batch(after, snapshot(spark, [(1, "a", "p")]), "id", DAY[2])
    assert {c for c in narrow.columns} == {c for c in after.columns}


def test_as_of(spark):
    past = run(spark, SCENARIO)
    for n, rows in enumerate(SCENARIO):
        seen = history.as_of(past, DAY[n]).collect()
        assert sorted((r.id, r.a, r.b or "") for r in seen) == sorted((i, a, b or "") for i, a, b in rows)
    assert history.as_of(past, "2023-01-01 00:00:00").count() == 0


def test_store(spark, tmp_path):
    path = f"{tmp_path}/history"
    for n, rows in enumerate(SCENARIO):
        batch = snapshot(spark, rows)
        if n == 0:
            moved = history.initial(batch, "id", DAY[0])
        else:
            moved = history.advance(history_store.read_current(spark, path, n - 1), batch, "id", DAY[n])
        for _ in range(2):  # a repeated batch changes nothing
            history_store.publish(moved, path, n)
        assert versions(history_store.read_history(spark, path, n)) == model(SCENARIO[: n + 1])
    current = history_store.read_current(spark, path, 3)
    assert sorted(r.id for r in current.collect()) == [1, 2, 3]
    assert dict(current.dtypes)["is_current"] == "boolean"
    # An earlier state can still be read.
    assert versions(history_store.read_history(spark, path, 0)) == model(SCENARIO[:1])


def test_store_reads_one_folder_for_the_current_slice(spark, tmp_path):
    path = f"{tmp_path}/history"
    for n in range(3):
        history_store.publish(history.initial(snapshot(spark, SCENARIO[0]), "id", DAY[n]), path, n)
    files = history_store.read_current(spark, path, 2).inputFiles()
    assert files and all("batch=2" in f for f in files)
    plan = history_store.read_current(spark, path, 2)._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(is_current" in plan


def test_store_when_nothing_is_left(spark, tmp_path):
    path, schema = f"{tmp_path}/history", history_store.history_schema(SCHEMA)
    days = [[(1, "a", "a")], [], [], [(1, "a", "a")]]
    history_store.publish(history.initial(snapshot(spark, days[0]), "id", DAY[0]), path, 0)
    for n in (1, 2, 3):
        before = history_store.read_current(spark, path, n - 1, schema)
        moved = history.advance(before, snapshot(spark, days[n]), "id", DAY[n])
        history_store.publish(moved, path, n)
    assert versions(history_store.read_history(spark, path, 3, schema)) == model(days)


records = st.dictionaries(
    st.integers(0, 4), st.tuples(st.sampled_from(["x", "y", None]), st.sampled_from(["p", None])),
    max_size=5,
)


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(records, min_size=1, max_size=4))
def test_history_properties(spark, drawn):
    days = [[(k, a, b) for k, (a, b) in day.items()] for day in drawn]
    got = versions(run(spark, days))
    assert got == model(days)
    for key, spans in got.items():
        assert sum(v[4] for v in spans) == (key in drawn[-1])
        for before, after in zip(spans, spans[1:]):
            assert before[3] is not None and before[3] <= after[2]
