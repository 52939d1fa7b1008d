"""Hashes over several columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def joined_md5(cols: Sequence[Column]) -> Column:
    """md5 of the values joined with ``|``. Nulls are skipped, so
    ``(a, null, b)`` and ``(a, b, null)`` collide."""
    return F.md5(F.concat_ws("|", *[c.cast("string") for c in cols]))


def framed_md5(cols: Sequence[Column]) -> Column:
    """md5 over length-prefixed values: no two different rows share the hashed text.

    A value is written ``<length>:<text>`` and a null ``-``, so neither nulls nor
    separators inside a value can make two rows look alike.
    """
    framed = []
    for c in cols:
        text = c.cast("string")
        framed.append(
            F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("-"))
        )
    return F.md5(F.concat_ws("|", *framed))
