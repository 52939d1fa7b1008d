from __future__ import annotations

from decimal import Decimal

import pytest

from creditloom.operators import cleaning

AT = "2024-01-01 00:00:00"


def one(spark, values, kind="string"):
    return spark.createDataFrame([(v,) for v in values], f"c {kind}")


def column(df, name="c"):
    return [r[name] for r in df.select(name).collect()]


@pytest.mark.parametrize("text,years", [
    (" 36 months", 3), ("60 months", 5), ("11 months", 0), ("30 months", 2), ("none", None), (None, None),
])
def test_years(spark, text, years):
    assert column(cleaning.with_years(one(spark, [text]), "c", "y"), "y") == [years]


@pytest.mark.parametrize("text,years", [
    ("10+ years", 10), ("< 1 year", 1), ("n/a", None), ("5 years", 5), ("1* years", None), (None, None), ("", None),
])
def test_employment_years(spark, text, years):
    assert column(cleaning.with_employment_years(one(spark, [text]), "c")) == [years]


def test_vocabulary(spark):
    df = cleaning.to_vocabulary(one(spark, ["car", "boat", None, "other"]), "c", cleaning.PURPOSES)
    assert column(df) == ["car", "other", "other", "other"]


def test_total_and_zero(spark):
    df = spark.createDataFrame(
        [(1, 2, 99), (0, 0, 5), (1, None, 7), (-1, 1, 3), (-2, 1, 3)], "a int, b int, t int"
    )
    got = cleaning.with_total(df, "t", ["a", "b"])
    assert column(got, "t") == [3, 0, None, 0, -1]
    assert column(cleaning.drop_zero(got, "t"), "t") == [3, -1]


def test_numeric_dates(spark):
    values = ["2015", "2015.0", " 7 ", "13-2015", "Dec-2015", "", None]
    got = column(cleaning.scrub_numeric(one(spark, values), ["c"]))
    assert got == [None, None, None, "13-2015", "Dec-2015", "", None]


def test_mean(spark):
    assert column(cleaning.impute_mean(one(spark, [1, 2, None], "int"), "c")) == [1, 2, 2]
    assert column(cleaning.impute_mean(one(spark, [None, None], "int"), "c")) == [None, None]
    assert column(cleaning.impute_mean(one(spark, [], "int"), "c")) == []


def test_mean_is_part_of_the_plan(spark):
    """No job runs until the result is used."""
    df = one(spark, [1, None], "int").selectExpr("if(c = 1, raise_error('ran'), c) as c")
    cleaning.impute_mean(df.selectExpr("cast(c as int) as c"), "c")


def test_long_text(spark):
    assert column(cleaning.scrub_long(one(spark, ["NY", "NYC", "", None]), "c")) == ["NY", "N/A", "", None]


def test_members(spark):
    df = spark.createDataFrame(
        [("1", "10+ years", "NY"), ("1", "10+ years", "NY"), ("2", "n/a", "STATE"), ("3", "1 year", None)],
        "member_id string, emp_length string, address_state string",
    )
    got = sorted(tuple(r)[:3] for r in cleaning.clean_members(df, AT).collect())
    # The mean is over distinct rows: (10 + 1) / 2 rounds to 6.
    assert got == [("1", 10, "NY"), ("2", 6, "N/A"), ("3", 1, None)]


def test_members_distinct_is_shuffled_once(spark):
    df = spark.createDataFrame([("1", "n/a", "NY")], "member_id string, emp_length string, address_state string")
    out = cleaning.clean_members(df, AT)
    out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "ReusedExchange" in plan


def test_repayment(spark):
    schema = (
        "id string, total_principal_received decimal(18,2), total_interest_received decimal(18,2), "
        "total_late_fee_received decimal(18,2), total_payment decimal(18,2), "
        "last_payment_date string, next_payment_date string"
    )
    rows = [
        ("1", Decimal(1), Decimal(2), Decimal(3), Decimal(9), "Dec-2015", "2015"),
        ("2", Decimal(0), Decimal(0), Decimal(0), Decimal(9), "Dec-2015", None),
        ("3", Decimal(1), None, Decimal(0), Decimal(9), "Dec-2015", None),
    ]
    got = cleaning.clean_repayment(spark.createDataFrame(rows, schema), AT).collect()
    assert [(r.id, r.total_payment, r.last_payment_date, r.next_payment_date, str(r.ingestion_date)) for r in got] == [
        ("1", Decimal("6.00"), "Dec-2015", None, AT)
    ]


def test_defaulters(spark):
    df = spark.createDataFrame(
        [("m", "0.0", 1.5, "2", "x", None, "3.9", "4", "5")],
        "member_id string, delinq_2_years string, delinq_amount double, public_record string, "
        "public_record_bankruptcies string, inquiry_last_6_months string, total_rec_late_fee string, "
        "months_since_last_delinq string, months_since_last_record string",
    )
    late, records = cleaning.split_defaulters(df)
    assert [f.simpleString() for f in late.schema] == [
        "member_id:string", "delinq_2_years:int", "delinq_amount:double", "months_since_last_delinq:int"
    ]
    assert tuple(late.first()) == ("m", 0, 1.5, 4)
    assert records.first().asDict() == {
        "member_id": "m", "public_record": 2, "public_record_bankruptcies": None,
        "months_since_last_record": 5, "inquiry_last_6_months": None,
    }
    counts = cleaning.credit_counts(df).first().asDict()
    assert counts["delinq_2_years"] == 0 and counts["public_record"] == 2
