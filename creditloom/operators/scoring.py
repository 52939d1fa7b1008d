"""Weighted three-part risk score of loans, ending in a letter grade.

The loan side (repayment joined to loans on ``id``) is built once and carries every
loan column a later step needs; the member side (members, public records and
delinquencies, one row each per member) is joined and reduced to points first. The
two meet in a single join on ``member_id``.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, fields
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditloom.functions.ladders import first_match, ladder
from creditloom.operators.keyed import (
    DEFAULT_POLICY,
    KeyedPolicy,
    hot_keys,
    join_one,
    require_unique,
)


@dataclass(frozen=True)
class ScoreParams:
    """Points, cut-offs and weights of the model (fixed values as defaults)."""

    unacceptable_rated_pts: int = 0
    very_bad_rated_pts: int = 100
    bad_rated_pts: int = 250
    good_rated_pts: int = 500
    very_good_rated_pts: int = 650
    excellent_rated_pts: int = 800

    unacceptable_grade_pts: int = 750
    very_bad_grade_pts: int = 1000
    bad_grade_pts: int = 1500
    good_grade_pts: int = 2000
    very_good_grade_pts: int = 2500

    payment_weight: Decimal = Decimal("0.20")
    default_weight: Decimal = Decimal("0.45")
    health_weight: Decimal = Decimal("0.35")

    sub_grade_factors: tuple[Decimal, ...] = (
        Decimal("1.00"),
        Decimal("0.95"),
        Decimal("0.90"),
        Decimal("0.85"),
        Decimal("0.80"),
    )

    @classmethod
    def from_mapping(cls, values: Mapping[str, object]) -> ScoreParams:
        """From names such as ``good_rated_pts``, with or without a dotted prefix."""
        known = {f.name for f in fields(cls)}
        given = {name.rsplit(".", 1)[-1]: value for name, value in values.items()}
        unknown = sorted(set(given) - known)
        if unknown:
            raise ValueError(f"unknown score parameters: {unknown}")
        return cls(**given)


DEFAULT_PARAMS = ScoreParams()


# --- points of single columns -------------------------------------------------------


def last_payment_points(paid: Column, installment: Column, p: ScoreParams) -> Column:
    """Last payment against the installment due."""
    half, over = installment * Decimal("0.5"), installment * Decimal("1.50")
    return first_match(
        [
            (paid.isNull() | installment.isNull(), p.unacceptable_rated_pts),
            ((paid < half) | (paid < installment), p.very_bad_rated_pts),
            (paid == installment, p.good_rated_pts),
            (paid <= over, p.very_good_rated_pts),
        ],
        otherwise=p.excellent_rated_pts,
    )


def total_payment_points(paid: Column, funded: Column, p: ScoreParams) -> Column:
    """Share of the funded amount repaid; null for a negative total, or for a positive
    one against an unknown amount."""
    half = funded * Decimal("0.50")
    return first_match(
        [
            (paid >= half, p.very_good_rated_pts),
            ((paid > 0) & (paid < half), p.good_rated_pts),
            (paid.isNull() | (paid == 0), p.unacceptable_rated_pts),
        ]
    )


def count_points(count: Column, many: int, p: ScoreParams) -> Column:
    """None, one or two, three to five, more. ``many`` also stands for unknown; a
    negative count scores null."""
    steps = [(0, p.excellent_rated_pts), (2, p.bad_rated_pts), (5, p.very_bad_rated_pts)]
    return ladder(count, steps, above=many, missing=many, floor=0)


def status_points(status: Column, p: ScoreParams) -> Column:
    s = F.lower(status)
    late = s.contains("late (16-30 days)") | s.contains("late (31-120 days)")
    return first_match(
        [
            (s.contains("fully paid"), p.excellent_rated_pts),
            (s.contains("current"), p.good_rated_pts),
            (s.contains("in grace period"), p.bad_rated_pts),
            (late, p.very_bad_rated_pts),
        ],
        otherwise=p.unacceptable_rated_pts,
    )


def home_points(ownership: Column, p: ScoreParams) -> Column:
    """By the end of the text, so ``unknown`` counts as owned; other text is null."""
    o = F.lower(ownership)
    return first_match(
        [
            (o.endswith("own"), p.excellent_rated_pts),
            (o.endswith("rent"), p.good_rated_pts),
            (o.endswith("mortgage"), p.bad_rated_pts),
            (o.isNull() | o.endswith("any"), p.very_bad_rated_pts),
        ]
    )


def limit_points(funded: Column, limit: Column, p: ScoreParams) -> Column:
    """Funded amount against the member's total credit limit."""
    shares = (
        ("0.10", p.excellent_rated_pts),
        ("0.20", p.very_good_rated_pts),
        ("0.30", p.good_rated_pts),
        ("0.50", p.bad_rated_pts),
        ("0.70", p.very_bad_rated_pts),
    )
    steps = [(limit * Decimal(share), points) for share, points in shares]
    return ladder(
        funded, steps, above=p.unacceptable_rated_pts, missing=p.unacceptable_rated_pts
    )


def grade_points(grade: Column, sub_grade: Column, p: ScoreParams) -> Column:
    """Points of the grade times the factor of its sub-grade.

    F and G score nothing whatever the sub-grade; for the others a sub-grade that is
    missing or of another grade scores null.
    """
    base = first_match(
        [
            (grade == "A", p.excellent_rated_pts),
            (grade == "B", p.very_good_rated_pts),
            (grade == "C", p.good_rated_pts),
            (grade == "D", p.bad_rated_pts),
            (grade == "E", p.very_bad_rated_pts),
        ]
    )
    factor = first_match(
        [
            (sub_grade == F.concat(grade, F.lit(str(step))), share)
            for step, share in enumerate(p.sub_grade_factors, start=1)
        ]
    )
    return (
        F.when(grade.isin("F", "G"), F.lit(p.unacceptable_rated_pts))
        .otherwise(base * factor)
        .cast("decimal(12,2)")
    )


def letter(score: Column, p: ScoreParams) -> Column:
    steps = [
        (p.unacceptable_grade_pts, "F"),
        (p.very_bad_grade_pts, "E"),
        (p.bad_grade_pts, "D"),
        (p.good_grade_pts, "C"),
        (p.very_good_grade_pts, "B"),
    ]
    return ladder(score, steps, above="A", missing=None)


# --- steps --------------------------------------------------------------------------


def payment_history(
    repayment: DataFrame, loans: DataFrame, params: ScoreParams = DEFAULT_PARAMS
) -> DataFrame:
    """Payment points per loan, with the loan columns later steps use."""
    paid = repayment.select("id", "last_payment_amount", "total_payment")
    lent = loans.select("id", "member_id", "installment", "funded_amount", "loan_status")
    return paid.join(lent, "id").select(
        "id",
        "member_id",
        last_payment_points(F.col("last_payment_amount"), F.col("installment"), params).alias(
            "last_payment_pts"
        ),
        total_payment_points(F.col("total_payment"), F.col("funded_amount"), params).alias(
            "total_payment_pts"
        ),
        "funded_amount",
        "loan_status",
    )


def defaulter_points(
    public_records: DataFrame,
    delinquencies: DataFrame | None,
    params: ScoreParams = DEFAULT_PARAMS,
) -> DataFrame:
    """Credit-record points per member.

    When both kinds of count already stand in one table, pass it as
    ``public_records`` with no ``delinquencies``, which saves the join.
    """
    worst, bad = params.unacceptable_rated_pts, params.very_bad_rated_pts
    if delinquencies is not None:
        late = delinquencies.select("member_id", "delinq_2_years")
        public_records = public_records.join(late, "member_id")
    return public_records.select(
        "member_id",
        # Many or unknown delinquencies earn the grade cut-off, not the rated points.
        count_points(F.col("delinq_2_years"), params.unacceptable_grade_pts, params).alias(
            "delinq_pts"
        ),
        count_points(F.col("public_record"), bad, params).alias("public_records_pts"),
        count_points(F.col("public_record_bankruptcies"), bad, params).alias(
            "public_bankruptcies_pts"
        ),
        count_points(F.col("inquiry_last_6_months"), worst, params).alias("enq_pts"),
    )


def member_points(members: DataFrame, params: ScoreParams = DEFAULT_PARAMS) -> DataFrame:
    """Points per member that need no loan, and the limit to hold a loan against."""
    return members.select(
        "member_id",
        home_points(F.col("home_ownership"), params).alias("home_pts"),
        grade_points(F.col("grade"), F.col("sub_grade"), params).alias("grade_pts"),
        "total_high_credit_limit",
    )


def loan_points(
    payments: DataFrame,
    members: DataFrame,
    params: ScoreParams = DEFAULT_PARAMS,
    hot_members: DataFrame | None = None,
) -> DataFrame:
    """Every point column, one row per loan; ``members`` has one row per member."""
    joined = join_one(payments, members, ["member_id"], "inner", hot_members)
    return joined.withColumns(
        {
            "loan_status_pts": status_points(F.col("loan_status"), params),
            "credit_limit_pts": limit_points(
                F.col("funded_amount"), F.col("total_high_credit_limit"), params
            ),
        }
    ).drop("loan_status", "funded_amount", "total_high_credit_limit")


def composite(points: DataFrame, params: ScoreParams = DEFAULT_PARAMS) -> DataFrame:
    """The three weighted parts and their sum; null when any part is."""

    def weighted(weight: Decimal, *names: str) -> Column:
        total = F.col(names[0])
        for name in names[1:]:
            total = total + F.col(name)
        return total * F.lit(weight)

    keys = [c for c in ("id", "member_id") if c in points.columns]
    return points.select(
        *keys,
        weighted(params.payment_weight, "last_payment_pts", "total_payment_pts").alias(
            "payment_history_pts"
        ),
        weighted(
            params.default_weight,
            "delinq_pts", "public_records_pts", "public_bankruptcies_pts", "enq_pts",
        ).alias("defaulters_history_pts"),
        weighted(
            params.health_weight,
            "loan_status_pts", "home_pts", "credit_limit_pts", "grade_pts",
        ).alias("financial_health_pts"),
    ).withColumn(
        "loan_score",
        F.col("payment_history_pts")
        + F.col("defaulters_history_pts")
        + F.col("financial_health_pts"),
    )


def graded(scores: DataFrame, params: ScoreParams = DEFAULT_PARAMS) -> DataFrame:
    return scores.withColumn("loan_final_grade", letter(F.col("loan_score"), params))


def all_points(
    repayment: DataFrame,
    loans: DataFrame,
    members: DataFrame,
    public_records: DataFrame,
    delinquencies: DataFrame | None,
    params: ScoreParams = DEFAULT_PARAMS,
    grain: str = "member",
    policy: KeyedPolicy = DEFAULT_POLICY,
) -> DataFrame:
    """Every point column of every loan.

    ``grain='member'`` names a loan by its member and so refuses, while running, a
    member with a second loan (the duplicate check keeps such loans out).
    ``grain='loan'`` keeps the loan ``id`` and takes any number of loans per member.
    """
    if grain not in ("member", "loan"):
        raise ValueError(f"grain must be 'member' or 'loan', not {grain!r}")
    payments = payment_history(repayment, loans, params)
    hot = hot_keys(loans, ["member_id"], policy) if grain == "loan" else None
    return points_of(payments, members, public_records, delinquencies, params, grain, hot)


def points_of(
    payments: DataFrame,
    members: DataFrame,
    public_records: DataFrame,
    delinquencies: DataFrame | None,
    params: ScoreParams = DEFAULT_PARAMS,
    grain: str = "member",
    hot_members: DataFrame | None = None,
) -> DataFrame:
    """As :func:`all_points`, from a :func:`payment_history`; every join is by member."""
    facts = defaulter_points(public_records, delinquencies, params).join(
        member_points(members, params), "member_id"
    )
    facts = require_unique(facts, ["member_id"], "member tables")
    if grain == "loan":
        return loan_points(payments, facts, params, hot_members)
    payments = require_unique(payments.filter("member_id is not null"), ["member_id"], "loans")
    return loan_points(payments.drop("id"), facts, params)


def stages(
    repayment: DataFrame,
    loans: DataFrame,
    members: DataFrame,
    public_records: DataFrame,
    delinquencies: DataFrame | None,
    params: ScoreParams = DEFAULT_PARAMS,
) -> dict[str, DataFrame]:
    """The steps by name, each made of the one before, for loans of any number a member.

    Nothing runs until one is used; registered as views, SQL can begin at any of them.
    """
    # The names of the steps.
    paid = payment_history(repayment, loans, params)
    defaults = paid.join(defaulter_points(public_records, delinquencies, params), "member_id")
    overall = loan_points(defaults, member_points(members, params), params)
    return {
        "payment_history": paid,
        "defaulters_score": defaults,
        "overall_member_score": overall,
        "loan_score_eval": graded(composite(overall, params), params),
    }


def score(
    repayment: DataFrame,
    loans: DataFrame,
    members: DataFrame,
    public_records: DataFrame,
    delinquencies: DataFrame | None,
    params: ScoreParams = DEFAULT_PARAMS,
    grain: str = "member",
    policy: KeyedPolicy = DEFAULT_POLICY,
) -> DataFrame:
    """Weighted parts, score and letter of every loan; see :func:`all_points`."""
    points = all_points(
        repayment, loans, members, public_records, delinquencies, params, grain, policy
    )
    return graded(composite(points, params), params)


def distribution(scored: DataFrame) -> DataFrame:
    """Number of loans per letter, the null letter included."""
    return scored.groupBy("loan_final_grade").agg(F.count("member_id").alias("loans"))


def moved_distribution(before: DataFrame, changes: DataFrame) -> DataFrame:
    """A distribution after the ``changes`` of a history of grades: every version that was
    opened adds one to its letter, every one that was closed takes one away."""
    sign = F.when(F.col("is_current"), 1).otherwise(-1)
    moves = changes.groupBy("loan_final_grade").agg(F.sum(sign).alias("loans"))
    total = before.unionByName(moves).groupBy("loan_final_grade").agg(F.sum("loans").alias("loans"))
    return total.filter("loans > 0")
