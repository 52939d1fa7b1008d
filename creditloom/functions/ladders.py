"""Stepwise point tables as column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def first_match(cases: Sequence[tuple[Column, object]], otherwise: object = None) -> Column:
    """Value of the first true condition; ``otherwise`` when none is true."""
    out = None
    for condition, result in cases:
        out = (F if out is None else out).when(condition, result)
    return out if otherwise is None else out.otherwise(otherwise)


def ladder(
    value: Column,
    steps: Sequence[tuple[object, object]],
    above: object,
    missing: object,
    floor: object | None = None,
) -> Column:
    """Points of the first step whose inclusive upper bound holds ``value``.

    ``above`` is paid past the last step and ``missing`` when the value or its bounds
    are null. Values under ``floor`` (when given) score null. Bounds may be columns,
    so a step can depend on the row.
    """
    cases = [] if floor is None else [(value < floor, F.lit(None))]
    cases += [(value <= bound, points) for bound, points in steps]
    cases.append((value > steps[-1][0], above))
    return first_match(cases, missing)
