"""Loan tables derived from the star-schema test tables.

The star schema has no nulls and no dirt, so both are put in by arithmetic on the
keys. Money is exact: cents are handled as integers and end as decimals.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"


# Columns of the test tables that are read. Naming them spares a job per
# read that would look them up in the files.
COLUMNS = {
    "customer": """c_custkey bigint, c_name string, c_nationkey int, c_acctbal double,
        c_mktsegment string""",
    "orders": """o_orderkey bigint, o_custkey bigint, o_orderstatus string,
        o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string""",
    "lineitem": """l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int,
        l_quantity double, l_extendedprice double, l_discount double, l_tax double,
        l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz""",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "events": """event_id bigint, ts timestamp_ntz, user_id bigint, event_type string,
        value double, props string""",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "labels": "doc_id bigint, quality int, toxic int",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(COLUMNS[name]).parquet(f"{sf_dir}/{name}.parquet")


def _cents(amount: str) -> str:
    """Hundredths of a double with two decimals, as an integer."""
    return f"cast(rint({amount} * 100) as bigint)"


def _money(cents: str) -> str:
    return f"cast(cast({cents} as decimal(16,0)) * 0.01BD as {MONEY})"


def members(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").selectExpr(
        "cast(c_custkey as string) as member_id",
        "c_name as emp_title",
        """case c_custkey % 12 when 0 then 'n/a' when 1 then '< 1 year' when 11 then '10+ years'
           else concat(c_custkey % 12, ' years') end as emp_length""",
        """case when c_mktsegment = 'AUTOMOBILE' then 'OWN'
                when c_mktsegment = 'BUILDING' then 'RENT'
                when c_mktsegment = 'FURNITURE' then 'MORTGAGE'
                when c_mktsegment = 'HOUSEHOLD' then 'ANY'
                when c_custkey % 10 = 0 then 'NONE'
                when c_custkey % 10 = 1 then null
                else 'RENT' end as home_ownership""",
        f"if(c_acctbal >= 0, {_money(_cents('c_acctbal'))}, null) as annual_income",
        """if(c_nationkey = 7, 'STATE7', concat(char(65 + c_nationkey), char(90 - c_nationkey)))
           as address_state""",
        """if(c_custkey % 97 = 0, '9xx',
              concat(lpad(cast(c_custkey % 1000 as string), 3, '0'), 'xx')) as zip_code""",
        "'US' as address_country",
        "char(65 + c_custkey % 7) as grade",
        "concat(char(65 + c_custkey % 7), 1 + c_custkey % 5) as sub_grade",
        "'Verified' as verification_status",
        f"cast({_cents('c_acctbal')} as {MONEY}) as total_high_credit_limit",
        "'Individual' as application_type",
        f"cast(null as {MONEY}) as join_annual_income",
        "cast(null as string) as verification_status_joint",
    )


def _loans(orders: DataFrame) -> DataFrame:
    purpose = """case o_orderpriority when '1-URGENT' then 'debt_consolidation'
                 when '2-HIGH' then 'credit_card' when '3-MEDIUM' then 'home_improvement'
                 when '4-NOT SPECIFIED' then 'not_specified' else 'other' end"""
    installment = _money(f"{_cents('o_totalprice')} div 36")
    return orders.selectExpr(
        "cast(o_orderkey as string) as id",
        "cast(o_custkey as string) as member_id",
        f"{_money(_cents('o_totalprice'))} as loan_amount",
        f"{_money(_cents('o_totalprice'))} as funded_amount",
        "if(o_orderkey % 2 = 0, ' 36 months', ' 60 months') as term",
        "cast(5 + o_orderkey % 20 as double) as interest_rate",
        f"if(o_orderkey % 50 = 0, null, {installment}) as installment",
        "date_format(o_orderdate, 'MMM-yyyy') as issue_month_year",
        """case when o_orderstatus = 'F' then 'Fully Paid'
                when o_orderstatus = 'O' then 'Current'
                when o_orderkey % 4 = 0 then 'In Grace Period'
                when o_orderkey % 4 = 1 then 'Late (16-30 days)'
                when o_orderkey % 4 = 2 then 'Charged Off'
                else 'Default' end as loan_status""",
        f"{purpose} as purpose",
        f"{purpose} as title",
    )


def loans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order as a loan; members have about ten each."""
    return _loans(table(spark, sf_dir, "orders"))


def _member_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All orders of a member as one: the lowest key, the sum of the prices."""
    return (
        table(spark, sf_dir, "orders")
        .groupBy("o_custkey")
        .agg(
            F.min("o_orderkey").alias("o_orderkey"),
            F.expr(f"sum({_cents('o_totalprice')}) / 100D").alias("o_totalprice"),
            F.max("o_orderstatus").alias("o_orderstatus"),
            F.max("o_orderdate").alias("o_orderdate"),
            F.min("o_orderpriority").alias("o_orderpriority"),
        )
    )


def member_loans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One loan per member, made of all their orders."""
    return _loans(_member_orders(spark, sf_dir))


def _by_order(spark: SparkSession, sf_dir: str, *totals: str, by: str = "o_orderkey") -> DataFrame:
    """Totals over the line items of each order, or of all orders ``by`` another column."""
    lines = table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey as o_orderkey",
        f"{_cents('l_extendedprice')} as cents",
        f"{_cents('l_discount')} as discount",
        f"{_cents('l_tax')} as tax",
        "l_returnflag = 'R' as returned",
        "l_linenumber",
        "l_quantity",
    )
    if by != "o_orderkey":
        lines = lines.join(table(spark, sf_dir, "orders").select("o_orderkey", by), "o_orderkey")
    return lines.groupBy(by).agg(*[F.expr(total) for total in totals])


def loan_repayment(spark: SparkSession, sf_dir: str, per_member: bool = False) -> DataFrame:
    """Line items of an order as payments on its loan, or on its member's only loan."""
    orders = _member_orders(spark, sf_dir) if per_member else table(spark, sf_dir, "orders")
    key = "o_custkey" if per_member else "o_orderkey"
    month = "date_format(o_orderdate, 'MMM-yyyy')"
    totals = _by_order(
        spark,
        sf_dir,
        "sum(cents * (100 - discount)) as discounted",
        "sum(cents * tax) as taxed",
        "count_if(returned) as returned",
        "sum(cents) as total",
        "max(cents) as largest",
        by=key,
    )
    return orders.join(totals, key).selectExpr(
        "cast(o_orderkey as string) as id",
        f"{_money('discounted div 100')} as total_principal_received",
        f"{_money('taxed div 100')} as total_interest_received",
        f"{_money('returned * 1500')} as total_late_fee_received",
        f"{_money('total')} as total_payment",
        f"{_money('largest div 8')} as last_payment_amount",
        f"""case when o_orderkey % 41 = 0 then '13-2015' when o_orderkey % 43 = 0 then '2015'
            else {month} end as last_payment_date""",
        f"if(o_orderstatus = 'F', null, {month}) as next_payment_date",
    )


def balanced_repayment(
    spark: SparkSession, sf_dir: str, per_member: bool = False
) -> DataFrame:
    """Repayments whose parts sum to the total, except for every third loan."""
    off = "if(cast(id as bigint) % 3 = 0, 1, 0)"
    return loan_repayment(spark, sf_dir, per_member).selectExpr(
        "id",
        f"""cast(total_payment - total_late_fee_received - {off} as {MONEY})
            as total_principal_received""",
        f"cast(0 as {MONEY}) as total_interest_received",
        "total_late_fee_received",
        "total_payment",
        "last_payment_amount",
        "last_payment_date",
        "next_payment_date",
    )


def loan_defaulters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Credit record of a member, counted over the line items of all their orders."""
    by_order = _by_order(
        spark,
        sf_dir,
        "count_if(returned) as late",
        "count_if(returned and l_linenumber = 7) as records",
        "count_if(l_quantity >= 49) as bankruptcies",
        "count_if(tax = 8) as inquiries",
    )
    counts = (
        table(spark, sf_dir, "orders")
        .join(by_order, "o_orderkey")
        .groupBy("o_custkey")
        .sum("late", "records", "bankruptcies", "inquiries")
        .toDF("k", "late", "records", "bankruptcies", "inquiries")
    )
    return counts.selectExpr(
        "cast(k as string) as member_id",
        "cast(late % 8 as string) as delinq_2_years",
        f"cast(late % 8 * 50 as {MONEY}) as delinq_amount",
        "cast(records % 7 as string) as public_record",
        "cast(bankruptcies % 3 as string) as public_record_bankruptcies",
        "cast(inquiries % 7 as string) as inquiry_last_6_months",
        "'0.0' as total_rec_late_fee",
        "if(late % 8 > 0, cast(k % 120 as string), null) as months_since_last_delinq",
        "if(records % 7 > 0, cast(k % 120 as string), null) as months_since_last_record",
    )


def messy_defaulters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Credit records with text that is no count, or not a whole one."""
    clean = loan_defaulters(spark, sf_dir)
    text = """case when cast(member_id as bigint) % 17 = 0 then 'abc'
                   when cast(member_id as bigint) % 19 = 0 then '1.5'
                   else delinq_2_years end as delinq_2_years"""
    return clean.selectExpr(*[text if c == "delinq_2_years" else c for c in clean.columns])


def snapshot(spark: SparkSession, sf_dir: str, day: int) -> DataFrame:
    """Customers on day 0, 1 or 2, with changed, missing, new and returning ones."""
    base = table(spark, sf_dir, "customer")
    if day == 0:
        return base
    suffix = "_1" if day == 1 else "_1_2"
    gone = "c_custkey % 13 = 0" if day == 1 else "c_custkey % 13 = 0 and c_custkey % 26 <> 0"
    columns = ["c_name", "c_nationkey", "c_acctbal"]
    kept = base.filter(f"not ({gone})").selectExpr(
        "c_custkey",
        *columns,
        f"""if(c_custkey % 10 = 0 and c_custkey % 26 <> 0, concat(c_mktsegment, '{suffix}'),
               c_mktsegment) as c_mktsegment""",
    )
    new = base.filter("c_custkey % 25 = 0").selectExpr(
        "c_custkey + 1000000 as c_custkey", *columns, "c_mktsegment"
    )
    return kept.unionByName(new)


def text_repayment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repayments as raw text, some with amounts that no money column can hold."""
    odd = """case when cast(id as bigint) % 11 = 0 then 'NaN'
                  when cast(id as bigint) % 13 = 0 then '1e30'
                  when cast(id as bigint) % 17 = 0 then '12345678901234567890'
                  when cast(id as bigint) % 19 = 0 then '12345678901234567890123456789012'
                  else cast(total_payment as string) end as total_payment"""
    tiny = """if(cast(id as bigint) % 7 = 0, '0.0000004', cast(total_interest_received as string))
              as total_interest_received"""
    changed = {"total_payment": odd, "total_interest_received": tiny}
    balanced = balanced_repayment(spark, sf_dir)
    return balanced.selectExpr(
        *[changed.get(c, f"cast({c} as string) as {c}") for c in balanced.columns]
    )
