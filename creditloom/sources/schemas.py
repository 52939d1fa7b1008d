"""Schemas that change: one type that holds the values of two, and columns that come later."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The types each type can be widened to without losing a value.
WIDER: dict[str, tuple[str, ...]] = {
    "tinyint": ("smallint", "int", "bigint", "float", "double"),
    "smallint": ("int", "bigint", "float", "double"),
    "int": ("bigint", "double"),
    "float": ("double",),
    "date": ("timestamp_ntz",),
}
DIGITS = {"tinyint": 3, "smallint": 5, "int": 10, "bigint": 19}


def common_type(old: T.DataType, new: T.DataType) -> T.DataType | None:
    """The least type that holds all values of both; None when there is none."""
    if old == new:
        return old
    a, b = old.simpleString(), new.simpleString()
    if b in WIDER.get(a, ()):
        return new
    if a in WIDER.get(b, ()):
        return old
    whole, scale = [], []
    for kind in (old, new):
        if isinstance(kind, T.DecimalType):
            whole.append(kind.precision - kind.scale)
            scale.append(kind.scale)
        elif kind.simpleString() in DIGITS:
            whole.append(DIGITS[kind.simpleString()])
            scale.append(0)
        else:
            return None
    width = max(whole) + max(scale)
    return T.DecimalType(width, max(scale)) if width <= 38 else None


def reconcile(old: T.StructType, new: T.StructType) -> T.StructType:
    """The columns of both, old ones first; each of the least type that holds all its values.

    A column that only one side has is null for the other's rows. ValueError where no type
    holds the values of both, as when text meets numbers.
    """
    fields = []
    added = {f.name: f for f in new.fields}
    for field in old.fields:
        kind = field.dataType
        if field.name in added:
            kind = common_type(kind, added.pop(field.name).dataType)
            if kind is None:
                other = new[field.name].dataType.simpleString()
                was = field.dataType.simpleString()
                raise ValueError(f"column {field.name}: {was} and {other} have no common type")
        fields.append(T.StructField(field.name, kind))
    return T.StructType(fields + [T.StructField(f.name, f.dataType) for f in added.values()])


def as_before(column: str, old: T.DataType, new: T.DataType) -> Column:
    """The text that a value had under an earlier type, for comparing hashes.

    A value that the earlier type cannot hold keeps its text, which then differs.
    """
    value = F.col(column)
    if old == new:
        return value.cast("string")
    narrow = value.try_cast(old)
    return F.when(narrow.cast(new).eqNullSafe(value), narrow.cast("string")).otherwise(
        value.cast("string")
    )
