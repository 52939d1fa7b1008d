"""The data-quality rules of the loan tables."""

from __future__ import annotations

from creditloom.operators.cleaning import PURPOSES
from creditloom.operators.quality import Rule, rules_by_table

MEMBERS, LOANS = "member_details", "loan_details"
REPAYMENT, DEFAULTERS = "loan_repayment", "loan_defaulters"

THRESHOLD = 0.98

# Ids, tables, columns and messages as they appear in reject reports.
# R3 names a column no table has; it is reported as skipped. Counts arrive as text
# like '0.0', which R2 accepts.
RULES = (
    Rule(
        "R1",
        "float_check",
        (
            "annual_income",
            "total_high_credit_limit",
            "join_annual_income",
            "loan_amount",
            "funded_amount",
            "interest_rate",
            "installment",
            "total_principal_received",
            "total_interest_received",
            "total_late_fee_received",
            "total_payment",
            "last_payment_amount",
            "delinq_amount",
        ),
        "Field data type is not float",
        THRESHOLD,
        (MEMBERS, LOANS, REPAYMENT, DEFAULTERS),
    ),
    Rule(
        "R2",
        "int_check",
        (
            "delinq_2_years",
            "public_record",
            "public_record_bankruptcies",
            "inquiry_last_6_months",
            "months_since_last_delinq",
            "months_since_last_record",
        ),
        "Field data type is not int",
        THRESHOLD,
        (DEFAULTERS,),
        {"decimals": "truncate"},
    ),
    Rule(
        "R3",
        "field_value_check",
        ("subgrade",),
        "Accpeted length of field value is 2",
        THRESHOLD,
        (MEMBERS,),
    ),
    Rule(
        "R4",
        "grade_check",
        ("grade",),
        "Accpeted length of field value is 1",
        THRESHOLD,
        (MEMBERS,),
    ),
    Rule(
        "R5",
        "zip_code_check",
        ("zip_code",),
        "Accpeted length of field value is 5",
        THRESHOLD,
        (MEMBERS,),
    ),
    Rule(
        "R6",
        "member_id_duplication",
        ("member_id",),
        "Member ID count shouldn't be more than 1 for a member",
        THRESHOLD,
        (MEMBERS, LOANS, DEFAULTERS),
    ),
    Rule(
        "R7",
        "allowed_values_check",
        ("purpose",),
        "Member ID count shouldn't be more than 1 for a member",
        THRESHOLD,
        (LOANS,),
        {"allowed_values": PURPOSES},
    ),
    Rule(
        "R8",
        "calculation_check",
        ("total_payment",),
        "Total payment amount is not summing up to principal received + interest received"
        " + late fee received",
        THRESHOLD,
        (REPAYMENT,),
        {
            "dependent_columns": (
                "total_principal_received",
                "total_interest_received",
                "total_late_fee_received",
            )
        },
    ),
    Rule(
        "R9",
        "string_check",
        ("last_payment_date", "next_payment_date"),
        "Value should be in string and in the format mmm-yyyy",
        THRESHOLD,
        (REPAYMENT,),
    ),
    Rule(
        "R10",
        "null_check",
        (
            "annual_income",
            "loan_amount",
            "funded_amount",
            "term",
            "interest_rate",
            "installment",
            "issue_month_year",
            "loan_status",
            "purpose",
            "title",
            "total_principal_received",
            "total_interest_received",
            "total_late_fee_received",
            "total_payment",
            "last_payment_amount",
            "delinq_2_years",
            "public_record",
            "public_record_bankruptcies",
            "inquiry_last_6_months",
            "months_since_last_delinq",
            "months_since_last_record",
        ),
        "Value should not be null",
        THRESHOLD,
        (MEMBERS, LOANS, REPAYMENT),
    ),
)

BY_TABLE = rules_by_table(RULES)


def rule(rule_id: str) -> Rule:
    return next(r for r in RULES if r.rule_id == rule_id)
