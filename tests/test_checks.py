"""Each check at and around its edge, as metric and as row filter."""

from __future__ import annotations

import pytest

from creditloom.functions.checks import LABELS
from creditloom.operators import quality
from creditloom.operators.quality import Rule


def failing(spark, check, values, kind="string", **params):
    df = spark.createDataFrame([(v,) for v in values], f"c {kind}")
    rule = Rule("X", check, ("c",), params=params)
    rows = quality.failed_rows(df, rule).collect()
    distinct = {r.c for r in rows}
    assert len(rows) == len(distinct)
    return distinct


CASES = [
    ("float_check", ["1", "1.5", "-2e3", "x", "", None], {"x", ""}, {}),
    ("int_check", ["1", " 7 ", "1.5", "0.0", "x", "99999999999", None],
     {"1.5", "0.0", "x", "99999999999"}, {}),
    ("int_check", ["1", "1.5", "0.0", "-3.", "x", "1e3", "99999999999", None],
     {"x", "1e3", "99999999999"}, {"decimals": "truncate"}),
    ("field_value_check", ["", "A", "AB", "ABC", None], {"ABC"}, {}),
    ("field_value_check", ["AB", "ABC", "ABCD"], {"ABCD"}, {"max_len": 3}),
    ("grade_check", ["", "A", "A1", None], {"A1"}, {}),
    ("zip_code_check", ["12345", "1234", "123456", "", None], {"1234", "123456", ""}, {}),
    ("zip_code_check", ["123", "1234"], {"1234"}, {"exact_len": 3}),
    ("allowed_values_check", ["a", "b", "z", None], {"z"}, {"allowed_values": ["a", "b"]}),
    ("allowed_values_check", ["a", None], {"a"}, {}),
    ("string_check", ["Dec-2015", "dec-2015", "December-2015", "13-2015", "2015", "", None],
     {"December-2015", "13-2015", "2015", ""}, {}),
    ("null_check", ["", "a", None], {None}, {}),
    ("member_id_duplication", ["a", "a", "b", None, None], {"a"}, {}),
]


@pytest.mark.parametrize("check,values,expected,params", CASES)
def test_rows(spark, check, values, expected, params):
    assert failing(spark, check, values, **params) == expected


def test_calculation_ignores_rows_with_a_null(spark):
    df = spark.createDataFrame(
        [(3, 1, 2), (4, 1, 2), (None, 1, 2), (4, None, 2)], "t int, a int, b int"
    )
    rule = Rule("X", "calculation_check", ("t",), params={"dependent_columns": ["a", "b"]})
    assert [tuple(r) for r in quality.failed_rows(df, rule).collect()] == [(4, 1, 2)]


def test_calculation_tolerance_and_text(spark):
    df = spark.createDataFrame([("3.00", "1", "2"), ("3.01", "1", "2"), ("oops", "1", "2")],
                               "t string, a string, b string")
    deps = {"dependent_columns": ["a", "b"]}
    exact = Rule("X", "calculation_check", ("t",), params=deps)
    loose = Rule("X", "calculation_check", ("t",), params={**deps, "tolerance": 0.05})
    assert [r.t for r in quality.failed_rows(df, exact).collect()] == ["3.01"]
    assert quality.failed_rows(df, loose).count() == 0


def test_unknown_check_and_bad_params():
    with pytest.raises(ValueError, match="unknown check type"):
        Rule("X", "no_such_check", ("c",))
    with pytest.raises(ValueError, match="decimals"):
        quality.ROW_CHECKS["int_check"]("c", decimals="round")


def test_calculation_needs_its_columns(spark):
    df = spark.createDataFrame([(1,)], "t int")
    with pytest.raises(ValueError, match="no such columns"):
        quality.annotate(
            df, [Rule("X", "calculation_check", ("t",), params={"dependent_columns": ["a"]})]
        )


@pytest.mark.parametrize("check", sorted(LABELS))
def test_measure(spark, check):
    df = spark.createDataFrame(
        [("x", 9), ("x", 1), (None, 2), (None, 3)], "c string, n int"
    )
    params = {
        "calculation_check": {"dependent_columns": ["n"]},
        "storable_check": {"type": "decimal(18,2)"},
    }.get(check, {})
    column = "n" if check == "calculation_check" else "c"
    expected = {
        "float_check": 2,
        "int_check": 2,
        "field_value_check": 0,
        "grade_check": 0,
        "zip_code_check": 2,
        "member_id_duplication": 2,
        "allowed_values_check": 2,
        "calculation_check": 0,
        "string_check": 2,
        "null_check": 2,
        "storable_check": 2,
    }[check]
    got = quality.measure(df, check, column, **params)
    assert got == {
        "field": column,
        "check": LABELS[check],
        "total_rows": 4,
        "failed_rows": expected,
        "percentage": expected / 4,
    }


def test_measure_empty_table(spark):
    empty = spark.createDataFrame([], "c string")
    for check in ("null_check", "member_id_duplication"):
        got = quality.measure(empty, check, "c")
        assert (got["total_rows"], got["failed_rows"], got["percentage"]) == (0, 0, 0.0)
    with pytest.raises(ValueError, match="no column"):
        quality.measure(empty, "null_check", "absent")
