"""Predicates of the data-quality checks: each is true where a value FAILS.

A predicate may also be null (an operand is missing); callers read null as
"did not fail".
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from creditloom.functions import text


def not_float(column: str) -> Column:
    c = F.col(column)
    return c.isNotNull() & c.try_cast("float").isNull()


def not_int(column: str, decimals: str = "reject") -> Column:
    """``decimals='truncate'`` lets plain decimal text such as ``'0.0'`` pass."""
    if decimals not in ("reject", "truncate"):
        raise ValueError(f"decimals must be 'reject' or 'truncate', not {decimals!r}")
    c = F.col(column)
    read = text.truncated_int if decimals == "truncate" else text.strict_int
    return c.isNotNull() & read(c).isNull()


def longer_than(column: str, max_len: int) -> Column:
    return F.length(F.col(column)) > max_len


def length_differs(column: str, exact_len: int) -> Column:
    return F.length(F.col(column)) != exact_len


def not_allowed(column: str, allowed_values: Sequence[object] = ()) -> Column:
    """With no allowed values, every value that is present fails; with a null among them
    none does, as ``not in`` has it in SQL."""
    c = F.col(column)
    if not allowed_values:
        return c.isNotNull()
    return c.isNotNull() & ~c.isin(list(allowed_values))


def sum_differs(
    column: str,
    dependent_columns: Sequence[str],
    tolerance: object | None = None,
    read_as: str | None = None,
) -> Column:
    """Value is not the sum of other columns; a null operand never fails.

    ``read_as`` names the numeric type to read text columns with. Text that is no such
    number, and a sum past the type, count as null: other checks report them.
    """
    if not dependent_columns:
        raise ValueError("a calculation check needs dependent_columns")

    def number(name: str) -> Column:
        return F.col(name) if read_as is None else F.col(name).try_cast(read_as)

    total = reduce(F.try_add, [number(d) for d in dependent_columns])
    if read_as is not None:
        total = total.try_cast(read_as)
    if tolerance is None:
        return number(column) != total
    return F.abs(F.try_subtract(number(column), total)) > F.lit(tolerance)


def not_month_year(column: str) -> Column:
    c = F.col(column)
    return c.isNotNull() & text.month_year(c).isNull()


def not_storable(column: str, type: str, numbers_only: bool = False) -> Column:
    """The value is present, but null once it is read as the type.

    ``numbers_only`` leaves text that is no number to the check for numbers.
    """
    c = F.col(column)
    lost = c.isNotNull() & c.try_cast(type).isNull()
    return lost & c.try_cast("float").isNotNull() if numbers_only else lost


def missing(column: str) -> Column:
    return F.col(column).isNull()


# Check names used in rule files, and the label each one carries in
# metric rows.
DUPLICATE = "member_id_duplication"
CALCULATION = "calculation_check"
ALLOWED = "allowed_values_check"
LABELS = {
    "float_check": "Datatype - float",
    "int_check": "Datatype - int",
    "field_value_check": "Field Value - 2 characters",
    "grade_check": "Field Value - 1 character",
    "zip_code_check": "Field Value - 5 characters",
    "member_id_duplication": "Member ID Duplication",
    "allowed_values_check": "Allowed Values",
    "calculation_check": "Calculation check",
    "string_check": "String check",
    "null_check": "Null check",
    "storable_check": "Storable",
}

ROW_CHECKS: dict[str, Callable[..., Column]] = {
    "float_check": not_float,
    "int_check": not_int,
    "field_value_check": lambda column, max_len=2: longer_than(column, max_len),
    "grade_check": lambda column, max_len=1: longer_than(column, max_len),
    "zip_code_check": lambda column, exact_len=5: length_differs(column, exact_len),
    "allowed_values_check": not_allowed,
    "calculation_check": sum_differs,
    "string_check": not_month_year,
    "null_check": missing,
    "storable_check": not_storable,
}
