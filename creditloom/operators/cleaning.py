"""Cleaning of accepted rows."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditloom.functions import text
from creditloom.operators.history import timestamp

# Purposes a loan may have.
PURPOSES = (
    "debt_consolidation",
    "credit_card",
    "home_improvement",
    "major_purchase",
    "medical",
    "small_business",
    "car",
    "vacation",
    "moving",
    "house",
    "wedding",
    "renewable_energy",
    "educational",
    "other",
)


def with_ingestion_date(df: DataFrame, as_of: str | datetime | Column) -> DataFrame:
    return df.withColumn("ingestion_date", timestamp(as_of))


def with_years(df: DataFrame, source: str = "term", target: str = "term_years") -> DataFrame:
    """Whole years of a term given in months as text."""
    return df.withColumn(target, text.years_from_months(F.col(source)))


def to_vocabulary(
    df: DataFrame, column: str, allowed: Sequence[str], fallback: str = "other"
) -> DataFrame:
    """Keep known values; everything else, null too, becomes ``fallback``."""
    c = F.col(column)
    return df.withColumn(column, F.when(c.isin(list(allowed)), c).otherwise(F.lit(fallback)))


def with_total(df: DataFrame, target: str, parts: Sequence[str]) -> DataFrame:
    """Sum of columns, null when one is null or the sum fits no number; keeps the type of an
    existing target."""
    total = F.col(parts[0])
    for part in parts[1:]:
        total = F.try_add(total, F.col(part))
    if target in df.columns:
        total = total.try_cast(df.schema[target].dataType)
    return df.withColumn(target, total)


def drop_zero(df: DataFrame, column: str) -> DataFrame:
    """Remove rows whose value is zero or null."""
    return df.filter(F.col(column) != 0)


def scrub_numeric(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Null out text that is merely a number, such as a year in place of a month."""
    return df.withColumns(
        {c: F.when(text.truncated_int(F.col(c)).isNull(), F.col(c)) for c in columns}
    )


def with_employment_years(df: DataFrame, column: str = "emp_length") -> DataFrame:
    """``'10+ years'`` becomes 10, ``'< 1 year'`` 1 and ``'n/a'`` null."""
    return df.withColumn(column, text.digits_only(F.col(column), keep="0-9*"))


def impute_mean(df: DataFrame, column: str) -> DataFrame:
    """Fill nulls with the column's rounded mean; all-null columns stay null.

    The mean is a scalar subquery of the same plan, so nothing runs until the result
    is used and nothing passes through the driver.
    """
    mean = df.select(F.round(F.avg(column), 0).cast(df.schema[column].dataType)).scalar()
    return df.withColumn(column, F.coalesce(F.col(column), mean))


def scrub_long(df: DataFrame, column: str, max_len: int = 2, fallback: str = "N/A") -> DataFrame:
    """Replace text longer than ``max_len``."""
    c = F.col(column)
    return df.withColumn(column, F.when(F.length(c) > max_len, F.lit(fallback)).otherwise(c))


def clean_loans(loans: DataFrame, as_of: str | datetime | Column) -> DataFrame:
    return (
        with_ingestion_date(loans, as_of)
        .transform(with_years)
        .transform(to_vocabulary, "purpose", PURPOSES)
    )


def clean_repayment(repayment: DataFrame, as_of: str | datetime | Column) -> DataFrame:
    received = (
        "total_principal_received",
        "total_interest_received",
        "total_late_fee_received",
    )
    return (
        with_ingestion_date(repayment, as_of)
        .transform(with_total, "total_payment", received)
        .transform(drop_zero, "total_payment")
        .transform(scrub_numeric, ("last_payment_date", "next_payment_date"))
    )


def clean_members(members: DataFrame, as_of: str | datetime | Column) -> DataFrame:
    """Distinct members with employment years, imputed where unknown."""
    return (
        members.dropDuplicates()
        .transform(with_employment_years)
        .transform(impute_mean, "emp_length")
        .transform(scrub_long, "address_state")
        .transform(with_ingestion_date, as_of)
    )


def _counts(df: DataFrame, plain: Sequence[str], counts: Sequence[str], order: Sequence[str]) -> DataFrame:
    values = {c: F.col(c) for c in plain}
    values.update({c: text.truncated_int(F.col(c)).alias(c) for c in counts})
    return df.select(*[values[c] for c in order])


def delinquencies(defaulters: DataFrame) -> DataFrame:
    order = ("member_id", "delinq_2_years", "delinq_amount", "months_since_last_delinq")
    return _counts(
        defaulters,
        ("member_id", "delinq_amount"),
        ("delinq_2_years", "months_since_last_delinq"),
        order,
    )


def public_records(defaulters: DataFrame) -> DataFrame:
    counts = (
        "public_record",
        "public_record_bankruptcies",
        "months_since_last_record",
        "inquiry_last_6_months",
    )
    return _counts(defaulters, ("member_id",), counts, ("member_id", *counts))


def credit_counts(defaulters: DataFrame) -> DataFrame:
    """All counts of both parts in one table, for scoring without a join."""
    counts = (
        "delinq_2_years",
        "public_record",
        "public_record_bankruptcies",
        "inquiry_last_6_months",
    )
    return _counts(defaulters, ("member_id",), counts, ("member_id", *counts))


def split_defaulters(defaulters: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Delinquencies and public records of the same table; each reads its own columns."""
    return delinquencies(defaulters), public_records(defaulters)
