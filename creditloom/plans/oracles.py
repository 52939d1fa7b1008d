"""The queries of the catalogue once more, as plain SQL for an independent engine.

Written from the definition of each result, not from the Spark plans: history, for
example, is read off the sequence of snapshots with window functions here.
"""

from __future__ import annotations

DAYS = ("2024-01-01 00:00:00", "2024-01-02 00:00:00", "2024-01-03 00:00:00")

# --- derived tables -------------------------------------------------------------------

MEMBERS = """
members AS (
  SELECT CAST(c_custkey AS VARCHAR) AS member_id,
         c_name AS emp_title,
         CASE c_custkey % 12 WHEN 0 THEN 'n/a' WHEN 1 THEN '< 1 year' WHEN 11 THEN '10+ years'
              ELSE (c_custkey % 12) || ' years' END AS emp_length,
         CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'OWN' WHEN 'BUILDING' THEN 'RENT'
              WHEN 'FURNITURE' THEN 'MORTGAGE' WHEN 'HOUSEHOLD' THEN 'ANY'
              ELSE CASE c_custkey % 10 WHEN 0 THEN 'NONE' WHEN 1 THEN NULL ELSE 'RENT' END
         END AS home_ownership,
         CASE WHEN c_acctbal < 0 THEN NULL ELSE CAST(c_acctbal AS DECIMAL(18,2)) END
           AS annual_income,
         CASE WHEN c_nationkey = 7 THEN 'STATE7'
              ELSE chr(CAST(65 + c_nationkey AS INT)) || chr(CAST(90 - c_nationkey AS INT))
         END AS address_state,
         CASE WHEN c_custkey % 97 = 0 THEN '9xx'
              ELSE lpad(CAST(c_custkey % 1000 AS VARCHAR), 3, '0') || 'xx' END AS zip_code,
         'US' AS address_country,
         chr(CAST(65 + c_custkey % 7 AS INT)) AS grade,
         chr(CAST(65 + c_custkey % 7 AS INT)) || (1 + c_custkey % 5) AS sub_grade,
         'Verified' AS verification_status,
         CAST(CAST(c_acctbal AS DECIMAL(18,2)) * 100 AS DECIMAL(18,2))
           AS total_high_credit_limit,
         'Individual' AS application_type,
         CAST(NULL AS DECIMAL(18,2)) AS join_annual_income,
         CAST(NULL AS VARCHAR) AS verification_status_joint
  FROM customer)
"""

LOANS = """
loans AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS id, CAST(o_custkey AS VARCHAR) AS member_id,
         CAST(o_totalprice AS DECIMAL(18,2)) AS loan_amount,
         CAST(o_totalprice AS DECIMAL(18,2)) AS funded_amount,
         CASE o_orderkey % 2 WHEN 0 THEN ' 36 months' ELSE ' 60 months' END AS term,
         CAST(5 + o_orderkey % 20 AS DOUBLE) AS interest_rate,
         CASE WHEN o_orderkey % 50 = 0 THEN NULL ELSE
           CAST((CAST(CAST(o_totalprice AS DECIMAL(18,2)) * 100 AS BIGINT) // 36) / 100.0
                AS DECIMAL(18,2)) END AS installment,
         strftime(o_orderdate, '%b-%Y') AS issue_month_year,
         CASE o_orderstatus WHEN 'F' THEN 'Fully Paid' WHEN 'O' THEN 'Current'
              ELSE CASE o_orderkey % 4 WHEN 0 THEN 'In Grace Period'
                   WHEN 1 THEN 'Late (16-30 days)' WHEN 2 THEN 'Charged Off'
                   ELSE 'Default' END END AS loan_status,
         CASE o_orderpriority WHEN '1-URGENT' THEN 'debt_consolidation'
              WHEN '2-HIGH' THEN 'credit_card' WHEN '3-MEDIUM' THEN 'home_improvement'
              WHEN '4-NOT SPECIFIED' THEN 'not_specified' ELSE 'other' END AS purpose,
         CASE o_orderpriority WHEN '1-URGENT' THEN 'debt_consolidation'
              WHEN '2-HIGH' THEN 'credit_card' WHEN '3-MEDIUM' THEN 'home_improvement'
              WHEN '4-NOT SPECIFIED' THEN 'not_specified' ELSE 'other' END AS title
  FROM orders)
"""

# All orders of a member as one, and their line items under its key.
MEMBER_ORDERS = """
member_orders AS (
  SELECT min(o_orderkey) AS o_orderkey, o_custkey,
         sum(CAST(o_totalprice AS DECIMAL(18,2))) AS o_totalprice,
         max(o_orderstatus) AS o_orderstatus, max(o_orderdate) AS o_orderdate,
         min(o_orderpriority) AS o_orderpriority
  FROM orders GROUP BY o_custkey),
member_lines AS (
  SELECT l.* REPLACE (m.o_orderkey AS l_orderkey)
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN member_orders m ON m.o_custkey = o.o_custkey)
"""

REPAYMENT = """
lines AS (
  SELECT *, CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * 100 AS BIGINT) AS cents,
         CAST(round(l_discount * 100) AS BIGINT) AS off,
         CAST(round(l_tax * 100) AS BIGINT) AS tax
  FROM lineitem),
loan_repayment AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS id,
         CAST((CAST(sum(cents * (100 - off)) AS BIGINT) // 100) / 100.0 AS DECIMAL(18,2))
           AS total_principal_received,
         CAST((CAST(sum(cents * tax) AS BIGINT) // 100) / 100.0 AS DECIMAL(18,2))
           AS total_interest_received,
         CAST(15 * count(*) FILTER (l_returnflag = 'R') AS DECIMAL(18,2))
           AS total_late_fee_received,
         CAST(CAST(sum(cents) AS BIGINT) / 100.0 AS DECIMAL(18,2)) AS total_payment,
         CAST((max(cents) // 8) / 100.0 AS DECIMAL(18,2)) AS last_payment_amount,
         CASE WHEN o_orderkey % 41 = 0 THEN '13-2015' WHEN o_orderkey % 43 = 0 THEN '2015'
              ELSE strftime(any_value(o_orderdate), '%b-%Y') END AS last_payment_date,
         CASE WHEN any_value(o_orderstatus) = 'F' THEN NULL
              ELSE strftime(any_value(o_orderdate), '%b-%Y') END AS next_payment_date
  FROM orders JOIN lines ON l_orderkey = o_orderkey
  GROUP BY o_orderkey),
balanced AS (
  SELECT * REPLACE (
    CAST(total_payment - total_late_fee_received
         - CASE CAST(id AS BIGINT) % 3 WHEN 0 THEN 1 ELSE 0 END AS DECIMAL(18,2))
      AS total_principal_received,
    CAST(0 AS DECIMAL(18,2)) AS total_interest_received)
  FROM loan_repayment)
"""

RAW_REPAYMENT = """
raw AS (
  SELECT id, CAST(total_principal_received AS VARCHAR) AS total_principal_received,
         CASE WHEN CAST(id AS BIGINT) % 7 = 0 THEN '0.0000004'
              ELSE CAST(total_interest_received AS VARCHAR) END AS total_interest_received,
         CAST(total_late_fee_received AS VARCHAR) AS total_late_fee_received,
         CASE WHEN CAST(id AS BIGINT) % 11 = 0 THEN 'NaN'
              WHEN CAST(id AS BIGINT) % 13 = 0 THEN '1e30'
              WHEN CAST(id AS BIGINT) % 17 = 0 THEN '12345678901234567890'
              WHEN CAST(id AS BIGINT) % 19 = 0 THEN '12345678901234567890123456789012'
              ELSE CAST(total_payment AS VARCHAR) END AS total_payment
  FROM balanced)
"""

DEFAULTERS = """
counted AS (
  SELECT o_custkey AS k,
         count(*) FILTER (l_returnflag = 'R') % 8 AS late,
         count(*) FILTER (l_returnflag = 'R' AND l_linenumber = 7) % 7 AS records,
         count(*) FILTER (l_quantity >= 49) % 3 AS bankruptcies,
         count(*) FILTER (round(l_tax * 100) = 8) % 7 AS inquiries
  FROM orders JOIN lineitem ON l_orderkey = o_orderkey
  GROUP BY o_custkey),
loan_defaulters AS (
  SELECT CAST(k AS VARCHAR) AS member_id, CAST(late AS VARCHAR) AS delinq_2_years,
         CAST(late * 50 AS DECIMAL(18,2)) AS delinq_amount,
         CAST(records AS VARCHAR) AS public_record,
         CAST(bankruptcies AS VARCHAR) AS public_record_bankruptcies,
         CAST(inquiries AS VARCHAR) AS inquiry_last_6_months,
         '0.0' AS total_rec_late_fee,
         CASE WHEN late > 0 THEN CAST(k % 120 AS VARCHAR) END AS months_since_last_delinq,
         CASE WHEN records > 0 THEN CAST(k % 120 AS VARCHAR) END AS months_since_last_record
  FROM counted),
messy AS (
  SELECT * REPLACE (CASE WHEN CAST(member_id AS BIGINT) % 17 = 0 THEN 'abc'
                         WHEN CAST(member_id AS BIGINT) % 19 = 0 THEN '1.5'
                         ELSE delinq_2_years END AS delinq_2_years)
  FROM loan_defaulters)
"""


def whole(c: str) -> str:
    """Integer part of plain decimal text, as SQL."""
    return (
        f"TRY_CAST(NULLIF(regexp_extract(trim({c}), '^([+-]?[0-9]+)(\\.[0-9]*)?$', 1), '') AS INT)"
    )


# --- scoring --------------------------------------------------------------------------


def ladder(c: str, many: int) -> str:
    return (
        f"CASE WHEN {c} = 0 THEN 800 WHEN {c} BETWEEN 1 AND 2 THEN 250 "
        f"WHEN {c} BETWEEN 3 AND 5 THEN 100 WHEN {c} > 5 OR {c} IS NULL THEN {many} END"
    )


PAYMENT_POINTS = """
  CASE WHEN p.last_payment_amount IS NULL OR l.installment IS NULL THEN 0
       WHEN p.last_payment_amount < l.installment THEN 100
       WHEN p.last_payment_amount = l.installment THEN 500
       WHEN p.last_payment_amount * 2 <= l.installment * 3 THEN 650
       ELSE 800 END AS last_payment_pts,
  CASE WHEN p.total_payment * 2 >= l.funded_amount THEN 650
       WHEN p.total_payment > 0 AND l.funded_amount IS NOT NULL THEN 500
       WHEN p.total_payment = 0 OR p.total_payment IS NULL THEN 0 END AS total_payment_pts
"""


def per_member(sql: str) -> str:
    """The same over the orders of a member as one."""
    return sql.replace("FROM orders", "FROM member_orders").replace(
        "FROM lineitem", "FROM member_lines"
    )


def points(loans: str) -> str:
    """CTEs up to ``points``: every point column of every loan in ``loans``."""
    # Limits are compared times ten, so that decimals stay exact.
    limit, funded = "m.total_high_credit_limit", "l.funded_amount"
    given = f"{LOANS}, {REPAYMENT}"
    if loans == "member_loans":
        loans, given = "loans", f"{MEMBER_ORDERS}, {per_member(LOANS)}, {per_member(REPAYMENT)}"
    return f"""WITH {MEMBERS}, {given}, {DEFAULTERS},
    points AS (
      SELECT l.id, l.member_id, {PAYMENT_POINTS},
        {ladder("CAST(d.delinq_2_years AS INT)", 750)} AS delinq_pts,
        {ladder("CAST(d.public_record AS INT)", 100)} AS public_records_pts,
        {ladder("CAST(d.public_record_bankruptcies AS INT)", 100)} AS public_bankruptcies_pts,
        {ladder("CAST(d.inquiry_last_6_months AS INT)", 0)} AS enq_pts,
        CASE WHEN l.loan_status = 'Fully Paid' THEN 800 WHEN l.loan_status = 'Current' THEN 500
             WHEN l.loan_status = 'In Grace Period' THEN 250
             WHEN l.loan_status LIKE 'Late (%' THEN 100 ELSE 0 END AS loan_status_pts,
        CASE WHEN lower(m.home_ownership) LIKE '%own' THEN 800
             WHEN lower(m.home_ownership) LIKE '%rent' THEN 500
             WHEN lower(m.home_ownership) LIKE '%mortgage' THEN 250
             WHEN lower(m.home_ownership) LIKE '%any' OR m.home_ownership IS NULL THEN 100
        END AS home_pts,
        CASE WHEN {funded} * 10 <= {limit} THEN 800 WHEN {funded} * 10 <= {limit} * 2 THEN 650
             WHEN {funded} * 10 <= {limit} * 3 THEN 500 WHEN {funded} * 10 <= {limit} * 5 THEN 250
             WHEN {funded} * 10 <= {limit} * 7 THEN 100 ELSE 0 END AS credit_limit_pts,
        CASE WHEN m.grade IN ('F', 'G') THEN 0.0
             WHEN left(m.sub_grade, 1) <> m.grade THEN NULL
             ELSE CAST(CASE m.grade WHEN 'A' THEN 800 WHEN 'B' THEN 650 WHEN 'C' THEN 500
                       WHEN 'D' THEN 250 WHEN 'E' THEN 100 END
                  * (21 - CAST(right(m.sub_grade, 1) AS INT)) AS DOUBLE) / 20 END AS grade_pts
      FROM loan_repayment p
      JOIN {loans} l ON l.id = p.id
      JOIN members m ON m.member_id = l.member_id
      JOIN loan_defaulters d ON d.member_id = l.member_id)"""


def scored(loans: str) -> str:
    """CTEs up to ``scored``: weighted parts and score, in exact hundredths."""
    return f"""{points(loans)},
    parts AS (
      SELECT id, member_id,
        CAST(20 * (last_payment_pts + total_payment_pts) AS BIGINT) AS pay,
        CAST(45 * (delinq_pts + public_records_pts + public_bankruptcies_pts + enq_pts)
             AS BIGINT) AS dflt,
        CAST(35 * 100 * (loan_status_pts + home_pts + credit_limit_pts) AS BIGINT)
          + CAST(35 * 100 * grade_pts AS BIGINT) AS health
      FROM points),
    scored AS (
      SELECT id, member_id, pay / 100.0::DOUBLE AS payment_history_pts,
        dflt / 100.0::DOUBLE AS defaulters_history_pts,
        health / 10000.0::DOUBLE AS financial_health_pts,
        (100 * pay + 100 * dflt + health) AS raw,
        (100 * pay + 100 * dflt + health) / 10000.0::DOUBLE AS loan_score
      FROM parts),
    graded AS (
      SELECT *, CASE WHEN raw > 25000000 THEN 'A' WHEN raw > 20000000 THEN 'B'
                     WHEN raw > 15000000 THEN 'C' WHEN raw > 10000000 THEN 'D'
                     WHEN raw > 7500000 THEN 'E' WHEN raw IS NOT NULL THEN 'F'
                END AS loan_final_grade
      FROM scored)"""


RESCUED = """SELECT o_orderkey, customer, e.field AS field, e.given AS given
FROM (
  SELECT o_orderkey, customer, unnest(CASE WHEN len(lost) > 0 THEN lost ELSE [NULL] END) AS e
  FROM (
    SELECT o_orderkey, CASE WHEN o_orderkey % 41 <> 0 THEN o_custkey END AS customer,
           list_filter([
             CASE WHEN o_orderkey % 41 = 0 THEN {{'field': 'customer', 'given': 'oops'}} END,
             CASE WHEN o_orderkey % 43 = 0 THEN {{'field': 'price', 'given': '12 EUR'}}
                  {empty} END,
             CASE WHEN o_orderkey % 53 = 0 THEN {{'field': 'placed', 'given': '31.12.1999'}} END
           ], lambda x: x IS NOT NULL) AS lost
    FROM orders))"""


# --- history --------------------------------------------------------------------------

SNAPSHOTS = """
day0 AS (SELECT * FROM customer),
day1 AS (
  SELECT c_custkey, c_name, c_nationkey, c_acctbal,
         c_mktsegment || CASE c_custkey % 10 WHEN 0 THEN '_1' ELSE '' END AS c_mktsegment
  FROM customer WHERE c_custkey % 13 <> 0
  UNION ALL
  SELECT c_custkey + 1000000, c_name, c_nationkey, c_acctbal, c_mktsegment
  FROM customer WHERE c_custkey % 25 = 0),
day2 AS (
  SELECT c_custkey, c_name, c_nationkey, c_acctbal,
         c_mktsegment || CASE WHEN c_custkey % 10 = 0 AND c_custkey < 1000000 THEN '_2'
                              ELSE '' END AS c_mktsegment
  FROM day1
  UNION ALL
  SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment
  FROM customer WHERE c_custkey % 26 = 0)
"""


def framed(columns: list[str]) -> str:
    parts = ", ".join(
        f"coalesce(length(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')"
        for c in columns
    )
    return f"md5(concat_ws('|', {parts}))"


ROW_HASH = framed(["c_custkey", "c_name", "c_nationkey", "c_mktsegment"])


def versions(last: int) -> str:
    """CTEs up to ``versions``: the history after the snapshots of days 0..last."""
    stamps = ", ".join(f"({n}, '{DAYS[n]}')" for n in range(last + 1))
    states = " UNION ALL ".join(
        f"SELECT {n} AS d, *, {ROW_HASH} AS h FROM day{n}" for n in range(last + 1)
    )
    return f"""WITH {SNAPSHOTS},
    days(d, stamp) AS (VALUES {stamps}),
    states AS ({states}),
    grid AS (
      SELECT k.c_custkey AS k, days.d, days.stamp, s.*
      FROM (SELECT DISTINCT c_custkey FROM states) k, days
      LEFT JOIN states s ON s.c_custkey = k.c_custkey AND s.d = days.d),
    seen AS (
      SELECT *, lag(h) OVER (PARTITION BY k ORDER BY grid.d) AS before FROM grid),
    opened AS (SELECT * FROM seen WHERE h IS NOT NULL AND before IS DISTINCT FROM h),
    ends AS (
      SELECT o.k, o.d AS opened_on, min(g.d) AS closed_on
      FROM opened o JOIN grid g ON g.k = o.k AND g.d > o.d AND g.h IS DISTINCT FROM o.h
      GROUP BY o.k, o.d),
    versions AS (
      SELECT o.c_custkey, o.c_name, o.c_nationkey, o.c_acctbal, o.c_mktsegment,
             o.h AS row_hash, o.stamp AS valid_from, g.stamp AS valid_to,
             e.closed_on IS NULL AS is_current,
             e.closed_on IS NOT NULL AND g.h IS NULL AS is_deleted_in_source,
             md5(concat_ws('|', CAST(o.c_custkey AS VARCHAR), o.stamp)) AS sk_id
      FROM opened o
      LEFT JOIN ends e ON e.k = o.k AND e.opened_on = o.d
      LEFT JOIN grid g ON g.k = e.k AND g.d = e.closed_on)"""


def upserts(*states: str) -> str:
    """CTEs up to ``versions``: the history that partial batches leave."""
    return f"""WITH {SNAPSHOTS},
    states AS ({" UNION ALL ".join(states)}),
    hashed AS (SELECT *, {ROW_HASH} AS h FROM states),
    seen AS (SELECT *, lag(h) OVER (PARTITION BY c_custkey ORDER BY stamp) AS before FROM hashed),
    opened AS (
      SELECT *, lead(stamp) OVER (PARTITION BY c_custkey ORDER BY stamp) AS ended
      FROM seen WHERE before IS DISTINCT FROM h),
    versions AS (
      SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment, h AS row_hash,
             stamp AS valid_from, ended AS valid_to, ended IS NULL AS is_current,
             false AS is_deleted_in_source,
             md5(concat_ws('|', CAST(c_custkey AS VARCHAR), stamp)) AS sk_id
      FROM opened)"""


def day(n: int, where: str = "true") -> str:
    return f"SELECT '{DAYS[n]}' AS stamp, * FROM day{n} WHERE {where}"


# --- data quality ---------------------------------------------------------------------

LINES = """
odd AS (
  SELECT {key} AS order_key, l_linenumber, l_partkey,
         l_returnflag || CASE WHEN (l_partkey * 7 + l_suppkey) % 61 = 0 THEN '?' ELSE '' END
           AS mode
  FROM lineitem)
"""
PLAIN_LINES = LINES.format(key="l_orderkey")
NULL_LINES = LINES.format(key="CASE WHEN l_orderkey % 10 <> 0 THEN l_orderkey END")

CLEAN_LOANS_BAD = (
    "purpose NOT IN ('debt_consolidation', 'credit_card', 'home_improvement', 'other')"
)

MEMBER_FAILS = """
  SELECT member_id, 'R5' AS rule_id, 'zip_code_check' AS check_type,
         'Accpeted length of field value is 5' AS check_description, 'zip_code' AS failed_column
  FROM members WHERE length(zip_code) <> 5
  UNION ALL
  SELECT member_id, 'R10', 'null_check', 'Value should not be null', 'annual_income'
  FROM members WHERE annual_income IS NULL
"""

MEMBER_COLUMNS = """
  member_id, emp_title, emp_length, home_ownership, CAST(annual_income AS DOUBLE) AS annual_income,
  address_state, zip_code, address_country, grade, sub_grade, verification_status,
  CAST(total_high_credit_limit AS DOUBLE) AS total_high_credit_limit, application_type,
  CAST(join_annual_income AS DOUBLE) AS join_annual_income, verification_status_joint
"""

LOAN_COLUMNS = """
  id, member_id, CAST(loan_amount AS DOUBLE) AS loan_amount,
  CAST(funded_amount AS DOUBLE) AS funded_amount, term, interest_rate,
  CAST(installment AS DOUBLE) AS installment, issue_month_year, loan_status, purpose, title
"""


def metric_line(rule: str, check: str, field: str, label: str, failed: str, table: str) -> str:
    return f"""SELECT '{rule}' AS rule_id, '{check}' AS check_type, '{field}' AS field,
      '{label}' AS "check", (SELECT count(*) FROM {table}) AS total_rows,
      ({failed}) AS failed_rows"""


def metric_report(lines: list[str]) -> str:
    return f"""SELECT *, CAST(failed_rows AS DOUBLE) / total_rows AS percentage,
      CAST(0.98 AS DOUBLE) AS threshold,
      1.0::DOUBLE - CAST(failed_rows AS DOUBLE) / total_rows >= 0.98::DOUBLE AS passed
    FROM ({" UNION ALL ".join(lines)})"""


def count_where(table: str, condition: str) -> str:
    return f"SELECT count(*) FROM {table} WHERE {condition}"


LOAN_REPORT = metric_report(
    [
        *[
            metric_line("R1", "float_check", c, "Datatype - float", "SELECT 0", "loans")
            for c in ("loan_amount", "funded_amount", "interest_rate", "installment")
        ],
        metric_line(
            "R6", "member_id_duplication", "member_id", "Member ID Duplication",
            "SELECT count(*) FROM (SELECT member_id FROM loans GROUP BY 1 HAVING count(*) > 1)",
            "loans",
        ),
        metric_line(
            "R7", "allowed_values_check", "purpose", "Allowed Values",
            count_where("loans", CLEAN_LOANS_BAD), "loans",
        ),
        *[
            metric_line(
                "R10", "null_check", c, "Null check", count_where("loans", f"{c} IS NULL"), "loans"
            )
            for c in (
                "loan_amount", "funded_amount", "term", "interest_rate", "installment",
                "issue_month_year", "loan_status", "purpose", "title",
            )
        ],
    ]
)

MEMBER_REPORT = metric_report(
    [
        *[
            metric_line("R1", "float_check", c, "Datatype - float", "SELECT 0", "members")
            for c in ("annual_income", "total_high_credit_limit", "join_annual_income")
        ],
        metric_line(
            "R4", "grade_check", "grade", "Field Value - 1 character",
            count_where("members", "length(grade) > 1"), "members",
        ),
        metric_line(
            "R5", "zip_code_check", "zip_code", "Field Value - 5 characters",
            count_where("members", "length(zip_code) <> 5"), "members",
        ),
        metric_line(
            "R6", "member_id_duplication", "member_id", "Member ID Duplication",
            "SELECT count(*) FROM (SELECT member_id FROM members GROUP BY 1 HAVING count(*) > 1)",
            "members",
        ),
        metric_line(
            "R10", "null_check", "annual_income", "Null check",
            count_where("members", "annual_income IS NULL"), "members",
        ),
    ]
)

GOOD_MEMBERS = "annual_income IS NOT NULL AND length(zip_code) = 5"
EMP_YEARS = "TRY_CAST(regexp_replace(emp_length, '[^0-9*]', '', 'g') AS INT)"


def cleaned_members(where: str) -> str:
    """CTE ``tidy``: members with employment years imputed and states scrubbed."""
    return f"""
    kept AS (SELECT DISTINCT * REPLACE ({EMP_YEARS} AS emp_length) FROM members WHERE {where}),
    tidy AS (
      SELECT * REPLACE (
        coalesce(emp_length, (SELECT CAST(round(avg(emp_length)) AS INT) FROM kept))
          AS emp_length,
        CASE WHEN length(address_state) > 2 THEN 'N/A' ELSE address_state END AS address_state)
      FROM kept)"""


ORACLES: dict[str, str] = {
    "flagship_loan_grade": f"""{scored("member_loans")}
      SELECT member_id, payment_history_pts, defaulters_history_pts, financial_health_pts,
             loan_score, loan_final_grade FROM graded""",
    "loan_grain_grade": f"""{scored("loans")}
      SELECT id, member_id, payment_history_pts, defaulters_history_pts, financial_health_pts,
             loan_score, loan_final_grade FROM graded""",
    "grade_distribution": f"""{scored("member_loans")}
      SELECT loan_final_grade, count(member_id) AS loans FROM graded GROUP BY 1""",
    "payment_points": f"""WITH {LOANS}, {REPAYMENT}
      SELECT l.id, l.member_id, {PAYMENT_POINTS} FROM loan_repayment p JOIN loans l ON l.id = p.id""",
    "default_points": f"""{points("member_loans")}
      SELECT member_id, last_payment_pts, total_payment_pts, delinq_pts, public_records_pts,
             public_bankruptcies_pts, enq_pts FROM points""",
    "health_points": f"""{points("loans")}
      SELECT id, member_id, loan_status_pts, home_pts, credit_limit_pts,
             CAST(grade_pts AS DOUBLE) AS grade_pts FROM points""",
    "composite_score": f"""{scored("loans")}
      SELECT id, member_id, payment_history_pts, defaulters_history_pts, financial_health_pts,
             loan_score FROM scored""",
    "grade_cut": f"""{scored("loans")}
      SELECT loan_final_grade, min(loan_score) AS lowest, max(loan_score) AS highest,
             CAST(sum(raw) AS BIGINT) / 10000.0::DOUBLE AS total, count(*) AS loans
      FROM graded GROUP BY 1""",
    "dq_float": """
      SELECT DISTINCT event_id, CASE WHEN event_id % 29 = 0 THEN 'n/a'
             ELSE json_extract_string(props, '$.k') || 'x1' END AS amount
      FROM events WHERE event_id % 29 = 0 OR event_id % 31 = 0""",
    "dq_int": f"""WITH {DEFAULTERS}
      SELECT member_id, delinq_2_years FROM messy
      WHERE NOT regexp_matches(delinq_2_years, '^[+-]?[0-9]+$')""",
    "dq_int_truncating": f"""WITH {DEFAULTERS}
      SELECT member_id, delinq_2_years, 'R2' AS rule_id, 'delinq_2_years' AS failed_column
      FROM messy WHERE {whole("delinq_2_years")} IS NULL""",
    "dq_max_len": f"""WITH {MEMBERS}
      SELECT member_id, address_state FROM members WHERE length(address_state) > 2""",
    "dq_grade_len": f"""WITH {MEMBERS}
      SELECT member_id, sub_grade AS grade FROM members WHERE CAST(member_id AS BIGINT) % 23 = 0""",
    "dq_exact_len": f"""WITH {MEMBERS}
      SELECT member_id, zip_code FROM members WHERE length(zip_code) <> 5""",
    "dq_duplicate_key": """
      SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_returnflag
      FROM lineitem QUALIFY count(*) OVER (PARTITION BY l_orderkey, l_linenumber) > 1""",
    "dq_duplicate_single": f"""WITH {LOANS}
      SELECT id, member_id, CAST(funded_amount AS DOUBLE) AS funded_amount
      FROM loans QUALIFY count(*) OVER (PARTITION BY member_id) > 1""",
    "dq_duplicate_metric": """
      WITH n AS (SELECT o_custkey, count(*) AS c FROM orders GROUP BY 1)
      SELECT 'member_id' AS field, 'Member ID Duplication' AS "check",
             CAST(sum(c) AS BIGINT) AS total_rows, count(*) FILTER (c > 1) AS failed_rows,
             CAST(count(*) FILTER (c > 1) AS DOUBLE) / CAST(sum(c) AS BIGINT) AS percentage
      FROM n""",
    "dq_allowed_values": """
      SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderpriority = '4-NOT SPECIFIED'""",
    "dq_allowed_values_long": """
      SELECT DISTINCT o_orderkey, o_custkey FROM orders
      WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_custkey % 7 <> 0)""",
    "dq_calculation_text": f"""WITH {REPAYMENT}, {RAW_REPAYMENT}
      SELECT id, total_principal_received, total_interest_received, total_payment FROM raw
      WHERE TRY_CAST(total_principal_received AS DECIMAL(38,18))
            + TRY_CAST(total_interest_received AS DECIMAL(38,18))
            + TRY_CAST(total_late_fee_received AS DECIMAL(38,18))
            <> TRY_CAST(total_payment AS DECIMAL(38,18))""",
    "dq_calculation": f"""WITH {REPAYMENT}
      SELECT id, CAST(total_principal_received AS DOUBLE) AS total_principal_received,
             CAST(total_late_fee_received AS DOUBLE) AS total_late_fee_received,
             CAST(total_payment AS DOUBLE) AS total_payment
      FROM balanced
      WHERE total_principal_received + total_interest_received + total_late_fee_received
            <> total_payment""",
    "dq_month_year": f"""WITH {REPAYMENT}
      SELECT id, last_payment_date, next_payment_date, 'last_payment_date' AS failed_column
      FROM loan_repayment
      WHERE last_payment_date IS NOT NULL AND try_strptime(last_payment_date, '%b-%Y') IS NULL
      UNION ALL
      SELECT id, last_payment_date, next_payment_date, 'next_payment_date'
      FROM loan_repayment
      WHERE next_payment_date IS NOT NULL AND try_strptime(next_payment_date, '%b-%Y') IS NULL""",
    "dq_null": """
      SELECT doc_id, lang, source FROM documents
      WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE quality IS NOT NULL)""",
    "dq_annotate": f"""WITH {LOANS}
      SELECT id,
             CAST(CASE WHEN count(*) OVER m > 1 THEN 1 ELSE 0 END
               + CASE WHEN {CLEAN_LOANS_BAD} THEN 1 ELSE 0 END
               + CASE WHEN installment IS NULL THEN 1 ELSE 0 END AS INT) AS n_fails,
             concat_ws(',', CASE WHEN count(*) OVER m > 1 THEN 'R6:member_id' END,
                       CASE WHEN {CLEAN_LOANS_BAD} THEN 'R7:purpose' END,
                       CASE WHEN installment IS NULL THEN 'R10:installment' END) AS fails
      FROM loans WINDOW m AS (PARTITION BY member_id)""",
    "dq_failed_rows": f"""WITH {LOANS}
      SELECT DISTINCT {LOAN_COLUMNS} FROM loans WHERE installment IS NULL""",
    "dq_details": f"WITH {MEMBERS} {MEMBER_FAILS}",
    "dq_details_loans": f"""WITH {LOANS}
      SELECT id, member_id, 'R6' AS rule_id, 'member_id_duplication' AS check_type,
             'member_id' AS failed_column
      FROM loans WHERE member_id IN (SELECT member_id FROM loans GROUP BY 1 HAVING count(*) > 1)
      UNION ALL
      SELECT id, member_id, 'R7', 'allowed_values_check', 'purpose'
      FROM loans WHERE {CLEAN_LOANS_BAD}
      UNION ALL
      SELECT id, member_id, 'R10', 'null_check', 'installment'
      FROM loans WHERE installment IS NULL""",
    "dq_bad_union": f"""WITH {MEMBERS}
      SELECT DISTINCT {MEMBER_COLUMNS} FROM members WHERE NOT ({GOOD_MEMBERS})""",
    "dq_clean_keyed": f"""WITH {PLAIN_LINES}
      SELECT * FROM odd o
      WHERE NOT EXISTS (SELECT 1 FROM odd b WHERE b.order_key = o.order_key AND b.mode LIKE '%?')""",
    "dq_clean_nullsafe": f"""WITH {NULL_LINES}
      SELECT * FROM odd o
      WHERE mode NOT LIKE '%?'
        AND NOT EXISTS (SELECT 1 FROM odd b WHERE b.order_key = o.order_key AND b.mode LIKE '%?')""",
    "dq_clean_keyed_compat": f"""WITH {NULL_LINES}
      SELECT * FROM odd o
      WHERE NOT EXISTS (SELECT 1 FROM odd b WHERE b.order_key = o.order_key AND b.mode LIKE '%?')""",
    "dq_clean_unkeyed": f"""WITH {PLAIN_LINES}
      SELECT l_linenumber, mode FROM odd WHERE mode IN ('A', 'N', 'R')""",
    "dq_clean_unkeyed_compat": f"""WITH {PLAIN_LINES}
      SELECT l_linenumber, mode FROM odd
      EXCEPT ALL
      SELECT DISTINCT l_linenumber, mode FROM odd WHERE mode LIKE '%?'""",
    "dq_audit_counts": f"""WITH {PLAIN_LINES},
      hit AS (SELECT DISTINCT order_key FROM odd WHERE mode LIKE '%?')
      SELECT (SELECT count(*) FROM odd) AS raw_rows,
             (SELECT count(*) FROM odd WHERE order_key NOT IN (SELECT order_key FROM hit))
               AS clean_rows,
             (SELECT count(*) FROM (SELECT DISTINCT * FROM odd WHERE mode LIKE '%?'))
               AS bad_rows""",
    "dq_metrics_threshold": f"WITH {LOANS} {LOAN_REPORT}",
    "dq_metrics_members": f"WITH {MEMBERS} {MEMBER_REPORT}",
    "scd2_initial": f"{versions(0)} SELECT * FROM versions",
    "scd2_apply": f"{versions(1)} SELECT * FROM versions",
    "scd2_second_batch": f"{versions(2)} SELECT * FROM versions",
    "scd2_partial_batches": f"""{upserts(day(0), day(1, "c_custkey % 7 = 1"), day(2, "c_custkey % 7 = 2"))}
      SELECT * FROM versions""",
    "scd2_versions_in_batch": f"{upserts(day(0), day(1), day(2))} SELECT * FROM versions",
    "scd2_late_batch": f"{versions(2)} SELECT * FROM versions",
    "scd2_gained_column": f"""WITH {SNAPSHOTS},
      now AS (
        SELECT c_custkey, CASE WHEN c_custkey % 10 = 0 THEN 'renamed' ELSE c_name END AS name,
               c_nationkey, c_mktsegment
        FROM day1),
      state AS (
        SELECT d.c_custkey, d.c_name, d.c_nationkey, n.c_custkey IS NULL AS gone,
               n.name IS DISTINCT FROM d.c_name AS differs
        FROM day0 d LEFT JOIN now n USING (c_custkey))
      SELECT c_custkey, c_name, CAST(c_nationkey AS BIGINT) AS c_nationkey,
             CAST(NULL AS VARCHAR) AS c_mktsegment, '{DAYS[0]}' AS valid_from,
             CASE WHEN differs THEN '{DAYS[1]}' END AS valid_to, NOT differs AS is_current,
             gone AS is_deleted_in_source
      FROM state
      UNION ALL
      SELECT n.c_custkey, n.name, n.c_nationkey, n.c_mktsegment, '{DAYS[1]}', NULL, true, false
      FROM now n LEFT JOIN day0 d USING (c_custkey) WHERE n.name IS DISTINCT FROM d.c_name""",
    "scd2_observed": f"{versions(2)} SELECT * FROM versions",
    "scd2_current": f"{versions(2)} SELECT * FROM versions WHERE is_current",
    "scd2_as_of": f"""{versions(2)}
      SELECT c_custkey, c_name, c_nationkey, c_mktsegment, valid_from FROM versions
      WHERE valid_from <= '2024-01-02 12:00:00'
        AND (valid_to IS NULL OR valid_to > '2024-01-02 12:00:00')""",
    "scd2_repeat": f"""{versions(2)}
      SELECT is_current, is_deleted_in_source, valid_from, valid_to, count(*) AS versions
      FROM versions GROUP BY ALL""",
    "scd2_reactivate": f"""{versions(2)}
      SELECT c_custkey, b.c_mktsegment, b.valid_from AS back_at, a.valid_to AS left_at
      FROM versions a JOIN versions b USING (c_custkey)
      WHERE a.is_deleted_in_source AND b.is_current""",
    "scd2_changes": f"""WITH {SNAPSHOTS},
      old AS (SELECT *, {ROW_HASH} AS h FROM day0), new AS (SELECT *, {ROW_HASH} AS h FROM day1),
      opening AS (
        SELECT n.*, CASE WHEN o.c_custkey IS NULL THEN 'insert' ELSE 'update' END AS change_type
        FROM new n LEFT JOIN old o USING (c_custkey) WHERE o.h IS DISTINCT FROM n.h),
      closing AS (
        SELECT o.*, CASE WHEN n.c_custkey IS NULL THEN 'delete' ELSE 'update' END AS change_type
        FROM old o LEFT JOIN new n USING (c_custkey) WHERE o.h IS DISTINCT FROM n.h)
      SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment, h AS row_hash,
             '{DAYS[1]}' AS valid_from, CAST(NULL AS VARCHAR) AS valid_to, true AS is_current,
             false AS is_deleted_in_source, md5(c_custkey || '|{DAYS[1]}') AS sk_id,
             CAST(NULL AS VARCHAR) AS merge_key, change_type
      FROM opening
      UNION ALL
      SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment, h, '{DAYS[0]}', '{DAYS[1]}',
             false, change_type = 'delete', md5(c_custkey || '|{DAYS[0]}'),
             CAST(c_custkey AS VARCHAR), change_type
      FROM closing""",
    "scd2_held": f"""{versions(1)}
      SELECT c_custkey, c_mktsegment,
             is_current OR (is_deleted_in_source AND c_custkey % 26 = 0) AS is_current,
             is_deleted_in_source AND c_custkey % 26 <> 0 AS is_deleted_in_source,
             CASE WHEN is_deleted_in_source AND c_custkey % 26 = 0 THEN NULL ELSE valid_to END
               AS valid_to
      FROM versions""",
    "scd2_compat_hash": f"""WITH {MEMBERS}
      SELECT member_id, md5(concat_ws('|', home_ownership, grade, sub_grade)) AS row_hash
      FROM members""",
    "clean_term_years": f"""WITH {LOANS}
      SELECT id, term, CASE WHEN term LIKE '%36%' THEN 3 ELSE 5 END AS term_years FROM loans""",
    "clean_purpose": f"""WITH {LOANS}
      SELECT id, CASE WHEN purpose = 'not_specified' THEN 'other' ELSE purpose END AS purpose
      FROM loans""",
    "clean_loans": f"""WITH {LOANS}
      SELECT * REPLACE (CASE WHEN purpose = 'not_specified' THEN 'other' ELSE purpose END
                          AS purpose),
             '{DAYS[0]}' AS ingestion_date,
             CAST(regexp_replace(term, '[^0-9]', '', 'g') AS INT) // 12 AS term_years
      FROM (SELECT {LOAN_COLUMNS} FROM loans)""",
    "clean_repayment": f"""WITH {REPAYMENT},
      summed AS (SELECT *, total_principal_received + total_interest_received
                           + total_late_fee_received AS total FROM loan_repayment)
      SELECT id, CAST(total_principal_received AS DOUBLE) AS total_principal_received,
             CAST(total_interest_received AS DOUBLE) AS total_interest_received,
             CAST(total_late_fee_received AS DOUBLE) AS total_late_fee_received,
             CAST(total AS DOUBLE) AS total_payment,
             CAST(last_payment_amount AS DOUBLE) AS last_payment_amount,
             CASE WHEN last_payment_date <> '2015' THEN last_payment_date END AS last_payment_date,
             next_payment_date, '{DAYS[0]}' AS ingestion_date
      FROM summed WHERE total <> 0""",
    "clean_members": f"""WITH {MEMBERS}, {cleaned_members("true")}
      SELECT * REPLACE (CAST(annual_income AS DOUBLE) AS annual_income,
                        CAST(total_high_credit_limit AS DOUBLE) AS total_high_credit_limit,
                        CAST(join_annual_income AS DOUBLE) AS join_annual_income),
             '{DAYS[0]}' AS ingestion_date
      FROM tidy""",
    "clean_distinct": f"WITH {PLAIN_LINES} SELECT DISTINCT l_linenumber, mode FROM odd",
    "split_delinquencies": f"""WITH {DEFAULTERS}
      SELECT member_id, {whole("delinq_2_years")} AS delinq_2_years,
             CAST(delinq_amount AS DOUBLE) AS delinq_amount,
             {whole("months_since_last_delinq")} AS months_since_last_delinq
      FROM messy""",
    "split_defaulters": f"""WITH {DEFAULTERS}
      SELECT member_id, CAST(public_record AS INT) AS public_record,
             CAST(public_record_bankruptcies AS INT) AS public_record_bankruptcies,
             CAST(months_since_last_record AS INT) AS months_since_last_record,
             CAST(inquiry_last_6_months AS INT) AS inquiry_last_6_months
      FROM messy""",
    "typed_reads_views": f"""WITH {MEMBERS}, {LOANS}, {REPAYMENT}, {DEFAULTERS}
      SELECT m.grade, count(*) AS loans, CAST(sum(r.total_payment) AS DOUBLE) AS repaid,
             CAST(sum(CAST(d.delinq_2_years AS INT)) AS BIGINT) AS delinquencies,
             CAST(sum(CAST(d.public_record AS INT)) AS BIGINT) AS records
      FROM loan_repayment r JOIN loans l ON l.id = r.id
      JOIN members m ON m.member_id = l.member_id
      JOIN loan_defaulters d ON d.member_id = l.member_id
      GROUP BY 1""",
    "rejects_by_rule": f"""WITH {MEMBERS}
      SELECT rule_id, check_type, failed_column, count(*) AS rejects
      FROM ({MEMBER_FAILS}) GROUP BY 1, 2, 3""",
    "csv_roundtrip": f"WITH {MEMBERS} SELECT {MEMBER_COLUMNS} FROM members",
    "csv_positional": """
      SELECT o_orderkey AS id, o_totalprice AS price, o_orderstatus AS status FROM orders""",
    "csv_malformed": """
      SELECT o_orderkey, CASE WHEN o_orderkey % 41 <> 0 THEN o_custkey END AS customer
      FROM orders""",
    # An empty CSV field is null; an empty JSON text is a value that is no number.
    "csv_rescued": RESCUED.format(empty=""),
    "json_rescued": RESCUED.format(
        empty="WHEN o_orderkey % 47 = 0 THEN {'field': 'price', 'given': ''}"
    ),
    "csv_corrupt_lines": """
      SELECT o_orderkey, CAST(NULL AS BIGINT) AS customer, o_orderkey || ',oops' AS line
      FROM orders WHERE o_orderkey % 41 = 0""",
    "json_roundtrip": """
      SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, user_id, event_type, value, props
      FROM events""",
    "json_documents": """
      SELECT event_type, count(*) AS events, count(DISTINCT user_id) AS users FROM events
      GROUP BY event_type""",
    "parquet_partitioned_roundtrip": """
      SELECT o_orderkey, o_custkey, o_totalprice, o_orderstatus FROM orders""",
    "parquet_one_partition": """
      SELECT o_orderkey, o_custkey, o_totalprice, o_orderstatus FROM orders
      WHERE o_orderstatus = 'F'""",
    "parquet_merged_schema": """
      SELECT c_custkey, c_mktsegment, CAST(NULL AS VARCHAR) AS supplier FROM customer
      UNION ALL
      SELECT s_suppkey, NULL, s_name FROM supplier""",
    "job_grades": f"""{scored("member_loans")},
      good_members AS (SELECT member_id FROM members WHERE {GOOD_MEMBERS}),
      good_loans AS (
        SELECT id FROM loans WHERE installment IS NOT NULL AND NOT ({CLEAN_LOANS_BAD})),
      good_repayment AS (
        SELECT id FROM balanced
        WHERE total_principal_received + total_interest_received + total_late_fee_received
              = total_payment
          AND last_payment_date NOT IN ('2015', '13-2015') AND total_payment <> 0),
      good_defaulters AS (SELECT member_id FROM messy WHERE delinq_2_years <> 'abc'),
      late AS (
        SELECT g.*, p.pay, p.health,
               CASE WHEN m.delinq_2_years = '1.5' THEN
                 45 * (250 + t.public_records_pts + t.public_bankruptcies_pts + t.enq_pts)
               ELSE p.dflt END AS dflt
        FROM graded g JOIN parts p USING (id) JOIN points t USING (id)
        JOIN messy m ON m.member_id = g.member_id),
      total AS (SELECT *, 100 * pay + 100 * dflt + health AS sum FROM late)
      SELECT member_id, payment_history_pts, dflt / 100.0::DOUBLE AS defaulters_history_pts,
             financial_health_pts, sum / 10000.0::DOUBLE AS loan_score,
             CASE WHEN sum > 25000000 THEN 'A' WHEN sum > 20000000 THEN 'B'
                  WHEN sum > 15000000 THEN 'C' WHEN sum > 10000000 THEN 'D'
                  WHEN sum > 7500000 THEN 'E' WHEN sum IS NOT NULL THEN 'F'
             END AS loan_final_grade
      FROM total
      WHERE member_id IN (FROM good_members) AND id IN (FROM good_loans)
        AND id IN (FROM good_repayment) AND member_id IN (FROM good_defaulters)""",
    "job_members_processed": f"""WITH {MEMBERS}, {cleaned_members(GOOD_MEMBERS)}
      SELECT member_id, emp_length, address_state, CAST(annual_income AS DOUBLE) AS annual_income,
             '{DAYS[0]}' AS ingestion_date
      FROM tidy""",
    "job_members_csv": f"""WITH {MEMBERS}, {cleaned_members(GOOD_MEMBERS)}
      SELECT member_id, CAST(emp_length AS VARCHAR) AS emp_length, address_state,
             CAST(annual_income AS DOUBLE) AS annual_income
      FROM tidy""",
    "job_unstorable_values": f"""WITH {REPAYMENT}, {RAW_REPAYMENT}
      SELECT id, total_payment, 'total_payment' AS failed_column FROM raw
      WHERE TRY_CAST(total_payment AS DECIMAL(18,2)) IS NULL""",
    "rejects_when_none": f"""WITH {MEMBERS}
      SELECT count(*) AS members, CAST(0 AS BIGINT) AS rejects FROM members
      WHERE {GOOD_MEMBERS}""",
    "job_duplicates_across_batches": f"""WITH {LOANS},
      arrived AS (
        SELECT *, count(*) OVER (PARTITION BY member_id) AS n FROM loans
        WHERE CAST(id AS BIGINT) % 8 < 2 OR CAST(id AS BIGINT) % 11 = 0)
      SELECT id, member_id, CASE WHEN n > 1 THEN 'rejected' ELSE 'kept' END AS state
      FROM arrived
      WHERE n > 1 OR (installment IS NOT NULL AND NOT ({CLEAN_LOANS_BAD}))""",
    "job_audit": f"""WITH {MEMBERS}
      SELECT count(*) AS raw_rows, count(*) FILTER ({GOOD_MEMBERS}) AS clean_rows,
             count(*) FILTER (NOT ({GOOD_MEMBERS})) AS bad_rows
      FROM members""",
    "job_changes": f"""WITH {MEMBER_ORDERS}, {per_member(LOANS)},
      good AS (SELECT * FROM loans WHERE installment IS NOT NULL AND NOT ({CLEAN_LOANS_BAD})),
      state AS (
        SELECT id, loan_status, loan_status = 'Current' AS pays,
               CAST(id AS BIGINT) IN (SELECT l_orderkey FROM lineitem) AS stays
        FROM good)
      SELECT id, loan_status, 'delete' AS change_type, false AS is_current
      FROM state WHERE NOT stays
      UNION ALL
      SELECT id, loan_status, 'update', false FROM state WHERE stays AND pays
      UNION ALL
      SELECT id, 'Fully Paid', 'update', true FROM state WHERE stays AND pays""",
    "job_loans_two_batches": f"""WITH {MEMBER_ORDERS}, {per_member(LOANS)},
      good AS (SELECT * FROM loans WHERE installment IS NOT NULL AND NOT ({CLEAN_LOANS_BAD})),
      state AS (
        SELECT id, loan_status, funded_amount,
               CAST(id AS BIGINT) IN (SELECT l_orderkey FROM lineitem) AS stays,
               loan_status = 'Current' AS pays
        FROM good)
      SELECT id, loan_status, CAST(funded_amount AS DOUBLE) AS funded_amount,
             '{DAYS[0]}' AS valid_from, CASE WHEN pays OR NOT stays THEN '{DAYS[1]}' END AS valid_to,
             NOT pays AND stays AS is_current, NOT stays AS is_deleted_in_source
      FROM state
      UNION ALL
      SELECT id, 'Fully Paid', CAST(funded_amount AS DOUBLE), '{DAYS[1]}', NULL, true, false
      FROM state WHERE pays AND stays""",
}

ORACLES["grades_bucketed"] = ORACLES["flagship_loan_grade"]
ORACLES["job_grades_from_changes"] = f"""
SELECT loan_final_grade, count(member_id) AS loans FROM ({ORACLES["job_grades"]}) GROUP BY 1"""
ORACLES |= {
    "stage_payment_history": f"""WITH {LOANS}, {REPAYMENT},
      paid AS (
        SELECT l.loan_status, {PAYMENT_POINTS}
        FROM loan_repayment p JOIN loans l ON l.id = p.id)
      SELECT loan_status, count(*) AS loans, CAST(sum(last_payment_pts) AS BIGINT) AS last_pts,
             CAST(sum(total_payment_pts) AS BIGINT) AS total_pts
      FROM paid GROUP BY 1""",
    "stage_defaulters_score": f"""{points("loans")}
      SELECT id, last_payment_pts + total_payment_pts AS paid_pts,
             delinq_pts + public_records_pts + public_bankruptcies_pts + enq_pts AS record_pts
      FROM points""",
    "stage_overall_member_score": f"""{scored("loans")}
      SELECT id, member_id, payment_history_pts, defaulters_history_pts FROM scored""",
    "stage_loan_score_eval": f"""{scored("loans")}
      SELECT loan_final_grade, count(member_id) AS loans, min(loan_score) AS least,
             max(loan_score) AS most
      FROM graded GROUP BY 1""",
}
