"""Point tables at their edges, the composite and the letters."""

from __future__ import annotations

from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from creditloom.operators import scoring
from creditloom.operators.keyed import KeyedPolicy
from creditloom.operators.scoring import DEFAULT_PARAMS as P
from creditloom.operators.scoring import ScoreParams
from creditloom.sources.tables import SCHEMAS


def value(v):
    return None if v is None else Decimal(str(v))


def points(spark, column, rows, schema):
    df = spark.createDataFrame(rows, schema)
    return [r[0] for r in df.select(column).collect()]


@pytest.mark.parametrize("paid,due,expected", [
    (None, 100, 0), (0, 100, 100), (49.99, 100, 100), (50, 100, 100), (99.99, 100, 100),
    (100, 100, 500), (100.01, 100, 650), (150, 100, 650), (150.01, 100, 800), (50, None, 0),
    (-7, -10, 100), (-1, -10, 800),
])
def test_last_payment(spark, paid, due, expected):
    c = scoring.last_payment_points(F.col("a"), F.col("b"), P)
    assert points(spark, c, [(value(paid), value(due))], "a decimal(18,2), b decimal(18,2)") == [expected]


@pytest.mark.parametrize("paid,funded,expected", [
    (None, 1000, 0), (-1, 1000, None), (0, 1000, 0), (0.01, 1000, 500), (499.99, 1000, 500),
    (500, 1000, 650), (5, None, None), (0, None, 0), (0, 0, 650), (None, None, 0),
])
def test_total_payment(spark, paid, funded, expected):
    c = scoring.total_payment_points(F.col("a"), F.col("b"), P)
    assert points(spark, c, [(value(paid), value(funded))], "a decimal(18,2), b decimal(18,2)") == [expected]


@pytest.mark.parametrize("many", [750, 100, 0])
def test_counts(spark, many):
    given_counts = [None, -1, 0, 1, 2, 3, 5, 6]
    got = points(spark, scoring.count_points(F.col("n"), many, P), [(n,) for n in given_counts], "n int")
    assert got == [many, None, 800, 250, 250, 100, 100, many]


def test_default_points_use_their_own_last_step(spark):
    records = spark.createDataFrame([("m", 6, 6, 6)], "member_id string, public_record int, "
                                    "public_record_bankruptcies int, inquiry_last_6_months int")
    late = spark.createDataFrame([("m", 6)], "member_id string, delinq_2_years int")
    row = scoring.defaulter_points(records, late).first()
    assert tuple(row) == ("m", 750, 100, 100, 0)


@pytest.mark.parametrize("status,expected", [
    ("Fully Paid", 800), ("Does not meet the credit policy. Status:Fully Paid", 800),
    ("Current", 500), ("In Grace Period", 250), ("Late (16-30 days)", 100),
    ("Late (31-120 days)", 100), ("Charged Off", 0), ("Default", 0), (None, 0),
])
def test_status(spark, status, expected):
    assert points(spark, scoring.status_points(F.col("s"), P), [(status,)], "s string") == [expected]


@pytest.mark.parametrize("home,expected", [
    ("OWN", 800), ("unknown", 800), ("RENT", 500), ("MORTGAGE", 250), ("ANY", 100),
    (None, 100), ("NONE", None), ("OTHER", None),
])
def test_home(spark, home, expected):
    assert points(spark, scoring.home_points(F.col("h"), P), [(home,)], "h string") == [expected]


@pytest.mark.parametrize("funded,limit,expected", [
    (100, 1000, 800), (100.01, 1000, 650), (200, 1000, 650), (200.01, 1000, 500),
    (300, 1000, 500), (300.01, 1000, 250), (500, 1000, 250), (500.01, 1000, 100),
    (700, 1000, 100), (700.01, 1000, 0), (100, None, 0), (None, 1000, 0),
])
def test_limit(spark, funded, limit, expected):
    c = scoring.limit_points(F.col("a"), F.col("b"), P)
    assert points(spark, c, [(value(funded), value(limit))], "a decimal(18,2), b decimal(18,2)") == [expected]


@pytest.mark.parametrize("grade,sub,expected", [
    *[("A", f"A{i}", v) for i, v in enumerate(("800", "760", "720", "680", "640"), 1)],
    *[("B", f"B{i}", v) for i, v in enumerate(("650", "617.5", "585", "552.5", "520"), 1)],
    *[("C", f"C{i}", v) for i, v in enumerate(("500", "475", "450", "425", "400"), 1)],
    *[("D", f"D{i}", v) for i, v in enumerate(("250", "237.5", "225", "212.5", "200"), 1)],
    *[("E", f"E{i}", v) for i, v in enumerate(("100", "95", "90", "85", "80"), 1)],
    ("F", "F1", "0"), ("G", None, "0"), ("A", "B2", None), (None, None, None),
    ("H", "H1", None), ("A", "A6", None), ("A", None, None), ("A", "A10", None),
])
def test_grade(spark, grade, sub, expected):
    c = scoring.grade_points(F.col("g"), F.col("s"), P)
    assert points(spark, c, [(grade, sub)], "g string, s string") == [value(expected)]


@pytest.mark.parametrize("score,expected", [
    ("2500", "B"), ("2500.0001", "A"), ("2000", "C"), ("2000.0001", "B"), ("1500", "D"),
    ("1000", "E"), ("750", "F"), ("750.0001", "E"), ("-1", "F"), (None, None),
])
def test_letter(spark, score, expected):
    assert points(spark, scoring.letter(F.col("x"), P), [(value(score),)], "x decimal(17,4)") == [expected]


def loan_tables(spark, loans, members=("m1",)):
    """loans: (id, member). Every loan and member is the worked example's."""
    lent = spark.createDataFrame(
        [(i, m, Decimal(1000), Decimal(100), "Current") for i, m in loans],
        "id string, member_id string, funded_amount decimal(18,2), "
        "installment decimal(18,2), loan_status string",
    )
    paid = spark.createDataFrame(
        [(i, Decimal(500), Decimal(100)) for i, _ in loans],
        "id string, total_payment decimal(18,2), last_payment_amount decimal(18,2)",
    )
    people = spark.createDataFrame(
        [(m, "OWN", "A", "A2", Decimal("6000")) for m in members],
        "member_id string, home_ownership string, grade string, sub_grade string, "
        "total_high_credit_limit decimal(18,2)",
    )
    records = spark.createDataFrame(
        [(m, 0, 0, 1) for m in members],
        "member_id string, public_record int, public_record_bankruptcies int, "
        "inquiry_last_6_months int",
    )
    late = spark.createDataFrame([(m, 0) for m in members], "member_id string, delinq_2_years int")
    return paid, lent, people, records, late


def test_worked_example(spark):
    got = scoring.score(*loan_tables(spark, [("1", "m1")])).collect()
    assert [tuple(r) for r in got] == [
        ("m1", Decimal("230.00"), Decimal("1192.50"), Decimal("948.5000"), Decimal("2371.0000"), "B")
    ]


def test_types(spark):
    scored = scoring.score(*loan_tables(spark, [("1", "m1")]))
    kinds = {f.name: f.dataType.simpleString() for f in scored.schema.fields}
    assert kinds == {
        "member_id": "string",
        "payment_history_pts": "decimal(13,2)",
        "defaulters_history_pts": "decimal(13,2)",
        "financial_health_pts": "decimal(16,4)",
        "loan_score": "decimal(17,4)",
        "loan_final_grade": "string",
    }


def test_second_loan_of_a_member(spark):
    tables = loan_tables(spark, [("1", "m1"), ("2", "m1"), ("3", "m2")], ("m1", "m2"))
    with pytest.raises(Exception, match="loans: duplicate key"):
        scoring.score(*tables).collect()
    got = scoring.score(*tables, grain="loan").collect()
    assert sorted((r.id, r.member_id, r.loan_final_grade) for r in got) == [
        ("1", "m1", "B"), ("2", "m1", "B"), ("3", "m2", "B")
    ]
    hot = scoring.score(*tables, grain="loan", policy=KeyedPolicy(hot_rows=2))
    assert sorted(tuple(r) for r in hot.collect()) == sorted(tuple(r) for r in got)
    with pytest.raises(ValueError, match="grain"):
        scoring.score(*tables, grain="lender")


def test_member_tables_must_be_unique(spark):
    paid, lent, people, records, late = loan_tables(spark, [("1", "m1")])
    with pytest.raises(Exception, match="member tables: duplicate key"):
        scoring.score(paid, lent, people.union(people), records, late).collect()


def test_one_table_of_counts(spark):
    paid, lent, people, records, late = loan_tables(spark, [("1", "m1")])
    joined = scoring.score(paid, lent, people, records.join(late, "member_id"), None)
    assert joined.first().loan_score == Decimal("2371.0000")


def test_parameters(spark):
    changed = ScoreParams.from_mapping({"project.good_grade_pts": 2400, "bad_rated_pts": 250})
    assert changed.good_grade_pts == 2400
    scored = scoring.score(*loan_tables(spark, [("1", "m1")]), params=changed)
    assert scored.first().loan_final_grade == "C"
    with pytest.raises(ValueError, match="unknown score parameters"):
        ScoreParams.from_mapping({"nope": 1})


def test_distribution_counts_null_letters(spark):
    df = spark.createDataFrame([("a", "B"), ("b", "B"), ("c", None)], "member_id string, loan_final_grade string")
    assert {tuple(r) for r in scoring.distribution(df).collect()} == {("B", 2), (None, 1)}


amounts = st.one_of(st.none(), st.integers(-50, 2000).map(Decimal))
counts = st.one_of(st.none(), st.integers(-1, 8))
cases = st.tuples(
    amounts, amounts, amounts, amounts, amounts, counts, counts, counts, counts,
    st.sampled_from(["OWN", "RENT", "MORTGAGE", "ANY", "NONE", None]),
    st.sampled_from("ABCDEFGH"), st.integers(1, 6),
    st.sampled_from(["Fully Paid", "Current", "Default", None]),
)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(cases, min_size=1, max_size=25))
def test_score_range(spark, drawn):
    paid, lent, people, records, late = [], [], [], [], []
    for n, (total, last, funded, due, limit, a, b, c, d, home, grade, sub, status) in enumerate(drawn):
        key = str(n)
        paid.append((key, total, last))
        lent.append((key, key, funded, due, status))
        people.append((key, home, grade, f"{grade}{sub}", limit))
        records.append((key, a, b, c))
        late.append((key, d))
    scored = scoring.score(
        spark.createDataFrame(paid, "id string, total_payment decimal(18,2), last_payment_amount decimal(18,2)"),
        spark.createDataFrame(lent, "id string, member_id string, funded_amount decimal(18,2), installment decimal(18,2), loan_status string"),
        spark.createDataFrame(people, "member_id string, home_ownership string, grade string, sub_grade string, total_high_credit_limit decimal(18,2)"),
        spark.createDataFrame(records, "member_id string, public_record int, public_record_bankruptcies int, inquiry_last_6_months int"),
        spark.createDataFrame(late, "member_id string, delinq_2_years int"),
    ).collect()
    assert len(scored) == len(drawn)
    for row in scored:
        assert (row.loan_score is None) == (row.loan_final_grade is None)
        if row.loan_score is not None:
            assert 170 <= row.loan_score <= 2850


def test_declared_schemas_fit_scoring():
    assert "total_high_credit_limit decimal(18,2)" in SCHEMAS["members"]
