from __future__ import annotations

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def documents(spark):
    """Documents from texts or (doc_id, text, source) rows."""

    def make(rows):
        full = []
        for n, row in enumerate(rows):
            doc, text, source = row if isinstance(row, tuple) else (n, row, "s")
            full.append((doc, text, "en", source, None if text is None else len(text)))
        return spark.createDataFrame(full, DOCS)

    return make


#: Names that operators use inside; documents may have columns of the same names.
CLASHES = (
    "row", "digest", "run", "rows", "key", "node", "bucket", "class", "d", "a", "b", "repeat",
    "size", "draw", "cell", "part", "whole", "copies", "score", "text_key", "_hot", "_fact",
    "_aside", "_part", "places", "piece", "ids", "length", "other", "_shard", "sketches",
)


@pytest.fixture
def clashing():
    """The same rows with extra columns whose names clash."""

    def add(df):
        from pyspark.sql import functions as F

        return df.select("*", *[F.lit("x").alias(c) for c in CLASHES if c not in df.columns])

    return add
