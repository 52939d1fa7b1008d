"""Splitting, explaining and measuring whole tables."""

from __future__ import annotations

import json
from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from creditloom.operators import quality
from creditloom.operators.keyed import KeyedPolicy
from creditloom.operators.quality import Rule
from creditloom.plans import rules

OK = Rule("V", "allowed_values_check", ("v",), "must be ok", params={"allowed_values": ["ok"]})

# Policies that force each way of meeting a key: broadcast, plain shuffle, and shuffle
# with a broadcast of the hot keys.
POLICIES = {
    "broadcast": KeyedPolicy(),
    "too many bytes": KeyedPolicy(broadcast_bytes=0),
    "shuffle": KeyedPolicy(broadcast_rows=0),
    "hot": KeyedPolicy(broadcast_rows=0, hot_rows=2),
    "all hot": KeyedPolicy(broadcast_rows=0, hot_rows=1),
}


def table(spark, rows):
    return spark.createDataFrame(rows, "k int, v string")


def multiset(df):
    return Counter(tuple(r) for r in df.collect())


def expected_clean(rows, compat=False):
    bad = {k for k, v in rows if v not in ("ok", None) and k is not None}
    out = []
    for k, v in rows:
        if k is None:
            if compat or v in ("ok", None):
                out.append((k, v))
        elif k not in bad:
            out.append((k, v))
    return Counter(out)


ROWS = [
    (1, "ok"), (1, "ok"), (2, "ok"), (2, "bad"), (2, "ok"), (3, "bad"), (3, "bad"),
    (None, "ok"), (None, "bad"), (None, "bad"), (4, None),
]


@pytest.mark.parametrize("policy", POLICIES)
@pytest.mark.parametrize("compat", [False, True])
def test_keyed_split(spark, policy, compat):
    got = quality.split(table(spark, ROWS), [OK], ["k"], compat=compat, policy=POLICIES[policy])
    assert multiset(got.clean) == expected_clean(ROWS, compat)
    assert multiset(got.bad) == Counter([(2, "bad"), (3, "bad"), (None, "bad")])


@pytest.mark.parametrize("policy", POLICIES)
def test_duplicate_rule_under_every_policy(spark, policy):
    rule = Rule("D", "member_id_duplication", ("k",))
    got = quality.split(table(spark, ROWS), [rule], ["k"], policy=POLICIES[policy])
    assert multiset(got.clean) == Counter(
        [(None, "ok"), (None, "bad"), (None, "bad"), (4, None)]
    )
    assert multiset(got.bad) == Counter([(1, "ok"), (2, "ok"), (2, "bad"), (3, "bad")])


def test_one_key_with_a_third_of_all_rows(spark):
    df = spark.range(30_000).selectExpr(
        "cast(if(id % 3 = 0, -1, id) as int) as k", "if(id = 3, 'bad', 'ok') as v"
    )
    policy = KeyedPolicy(broadcast_rows=0, hot_rows=100)
    got = quality.split(df, [OK], ["k"], policy=policy)
    assert got.clean.count() == 20_000
    assert quality.repeated_rows(df, ["k"], policy).count() == 10_000


@pytest.mark.parametrize("policy", POLICIES)
def test_composite_repeats(spark, policy):
    df = spark.createDataFrame(
        [(1, "a", 0), (1, "a", 1), (1, "b", 2), (None, "a", 3), (None, "a", 4)],
        "k int, l string, n int",
    )
    rows = quality.repeated_rows(df, ["k", "l"], POLICIES[policy]).collect()
    assert sorted(r.n for r in rows) == [0, 1]


def test_unkeyed_split(spark):
    rows = [(1, "ok"), (1, "ok"), (2, "bad"), (2, "bad"), (2, "bad"), (3, "bad")]
    df = table(spark, rows)
    assert multiset(quality.split(df, [OK]).clean) == Counter([(1, "ok")] * 2)
    compat = quality.split(df, [OK], compat=True).clean
    assert multiset(compat) == Counter([(1, "ok")] * 2 + [(2, "bad")] * 2)


def test_unkeyed_compat_in_chunks(spark, monkeypatch):
    monkeypatch.setattr(quality, "COPIES_PER_TASK", 7)
    rows = [(1, "bad")] * 50 + [(2, "bad")] * 8 + [(3, "bad")] * 7 + [(None, "bad")]
    got = quality.split(table(spark, rows), [OK], compat=True).clean
    assert multiset(got) == Counter({(1, "bad"): 49, (2, "bad"): 7, (3, "bad"): 6})


@pytest.mark.parametrize("size", [1, 500, 501, 10_000])
def test_any_number_of_allowed_values(spark, size):
    values = ["v1", *[f"v{n}" for n in range(2, size + 1)]]
    rows = [(1, "v1"), (3, "nope"), (4, None), (5, "nope"), (5, "nope")]
    df = table(spark, rows)
    listed = spark.createDataFrame([(v,) for v in values], "x string")
    for given in (values, listed):
        rule = Rule("L", "allowed_values_check", ("v",), params={"allowed_values": given})
        got = quality.split(df, [rule, OK], ["k"])
        assert got.bad.columns == ["k", "v"]
        assert multiset(quality.failed_rows(df, rule)) == Counter([(3, "nope"), (5, "nope")])
        assert multiset(quality.split(df, [rule]).clean) == Counter([(1, "v1"), (4, None)])
        assert quality.metrics(df, [rule]).first().failed_rows == 3


@pytest.mark.parametrize("size", [1, 501])
def test_a_null_among_allowed_values(spark, size):
    """As in SQL: what is not in the list might be the null, so nothing fails."""
    values = [None, *[f"v{n}" for n in range(size)]]
    listed = spark.createDataFrame([(v,) for v in values], "x string")
    df = table(spark, [(1, "v0"), (2, "nope")])
    for given in (values, listed):
        rule = Rule("L", "allowed_values_check", ("v",), params={"allowed_values": given})
        assert quality.failed_rows(df, rule).count() == 0


@pytest.mark.parametrize("size", [2, 602])
def test_allowed_numbers_of_another_type(spark, size):
    df = spark.createDataFrame([(1,), (2,), (700,)], "n int").selectExpr("cast(n as decimal(9,2)) n")
    rule = Rule("L", "allowed_values_check", ("n",), params={"allowed_values": list(range(1, size + 1))})
    assert [int(r.n) for r in quality.failed_rows(df, rule).collect()] == [700]


def test_amounts_that_no_sum_can_hold(spark):
    big = "9" * 32
    rows = [("1", "1", "2"), ("1.0000004", "0", "1"), (big, big, "1"), ("NaN", "1", "1"), ("9" * 20, "9" * 20, "3")]
    df = spark.createDataFrame(rows, "a string, b string, total string")
    rule = Rule("S", "calculation_check", ("total",), params={"dependent_columns": ("a", "b")})
    assert multiset(quality.failed_rows(df, rule)) == Counter([rows[1]])
    storable = Rule("T", "storable_check", ("a",), params={"type": "decimal(18,2)"})
    assert multiset(quality.failed_rows(df, storable)) == Counter(rows[2:])



def test_details_and_annotate(spark):
    null = Rule("N", "null_check", ("v", "k"), "must be there")
    df = table(spark, [(1, "bad"), (1, "bad"), (None, None), (5, "ok")])
    detail = quality.failure_details(df, [OK, null]).collect()
    assert {tuple(r) for r in detail} == {
        (1, "bad", "V", "allowed_values_check", "must be ok", "v"),
        (None, None, "N", "null_check", "must be there", "v"),
        (None, None, "N", "null_check", "must be there", "k"),
    }
    assert len(detail) == 3
    fails = {tuple(r[:2]): [f.rule_id for f in r[2]] for r in quality.annotate(df, [OK, null]).collect()}
    assert fails == {(1, "bad"): ["V"], (None, None): ["N", "N"], (5, "ok"): []}


def test_no_rules_and_no_columns(spark):
    df = table(spark, ROWS)
    for given_rules in ([], [Rule("Z", "null_check", ("absent",))]):
        got = quality.split(df, given_rules, ["k"])
        assert got.clean.count() == len(ROWS)
        assert got.bad.count() == 0
        assert got.detail.columns == ["k", "v", *quality.DETAIL_COLUMNS]
        assert got.detail.count() == 0
        assert got.metrics.count() == 0
    assert got.skipped == [("Z", "absent")]
    assert {tuple(r)[2] == [] for r in quality.annotate(df, []).collect()} == {True}
    with pytest.raises(ValueError, match="absent"):
        quality.split(df, [Rule("Z", "null_check", ("absent",))], strict=True)


def test_empty_detail_can_be_written(spark, tmp_path):
    quality.split(table(spark, [(1, "ok")]), []).detail.write.csv(f"{tmp_path}/detail")


def test_map_columns_are_refused(spark):
    df = spark.sql("select map('a', 1) as m")
    with pytest.raises(ValueError, match="map columns"):
        quality.bad_rows(df, [Rule("N", "null_check", ("m",))])


def test_metrics_threshold(spark):
    df = spark.range(100).selectExpr("if(id < 2, null, id) as a", "if(id < 3, null, id) as b")
    rule = Rule("N", "null_check", ("a", "b"), threshold=0.98)
    rows = {r.field: r for r in quality.metrics(df, [rule]).collect()}
    assert (rows["a"].failed_rows, rows["a"].percentage, rows["a"].passed) == (2, 0.02, True)
    assert (rows["b"].failed_rows, rows["b"].passed) == (3, False)


def test_rule_files(spark, tmp_path):
    entries = [
        {"rule_id": "A", "tables": ["t", "u"], "columns": ["x ", "y"], "type": "null_check",
         "check": "present", "threshold": 0.9},
        {"rule_id": "B", "tables": ["u"], "columns": ["v"], "type": "allowed_values_check",
         "check": "known", "allowed_values": ["ok"]},
    ]
    path = tmp_path / "rules.json"
    path.write_text(json.dumps(entries))
    by_table = quality.rules_by_table(quality.load_rules(str(path)))
    assert {t: [r.rule_id for r in rs] for t, rs in by_table.items()} == {"t": ["A"], "u": ["A", "B"]}
    assert by_table["t"][0].columns == ("x", "y")
    assert by_table["u"][1].params == {"allowed_values": ["ok"]}
    bad = quality.failed_rows(table(spark, ROWS), by_table["u"][1])
    assert {r.v for r in bad.collect()} == {"bad"}


def test_shipped_rules():
    ids = {t: [r.rule_id for r in rs] for t, rs in rules.BY_TABLE.items()}
    assert ids == {
        "member_details": ["R1", "R3", "R4", "R5", "R6", "R10"],
        "loan_details": ["R1", "R6", "R7", "R10"],
        "loan_repayment": ["R1", "R8", "R9", "R10"],
        "loan_defaulters": ["R1", "R2", "R6"],
    }
    assert {r.threshold for r in rules.RULES} == {0.98}


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.lists(
        st.tuples(
            st.one_of(st.none(), st.integers(0, 4)), st.sampled_from(["ok", "bad", None])
        ),
        max_size=20,
    ),
    st.sampled_from(sorted(POLICIES)),
)
def test_split_properties(spark, rows, policy):
    got = quality.split(table(spark, rows), [OK], ["k"], policy=POLICIES[policy])
    clean = multiset(got.clean)
    assert clean == expected_clean(rows)
    bad_keys = {r.k for r in got.bad.collect()} - {None}
    assert not bad_keys & {k for k, _ in clean}
    counts = got.audit.first()
    assert (counts.raw_rows, counts.clean_rows) == (len(rows), sum(clean.values()))
