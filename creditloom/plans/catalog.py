"""Queries over the test tables, one or more per operator.

Each takes a session and a table folder and returns a DataFrame. Decimals leave as
doubles and timestamps as text, so that results compare across engines.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from creditloom.operators import cleaning, history, quality, scoring, timeline
from creditloom.operators.quality import Rule
from creditloom.plans import derived, jobs, rules
from creditloom.sources import history_store, tables
from creditloom.sources.slice_store import Store
from creditloom.sources.staging import stage, stage_path

Query = Callable[[SparkSession, str], DataFrame]

CATALOG: dict[str, Query] = {}

DAYS = ("2024-01-01 00:00:00", "2024-01-02 00:00:00", "2024-01-03 00:00:00")


def query(fn: Query) -> Query:
    CATALOG[fn.__name__] = fn
    return fn


def portable(df: DataFrame) -> DataFrame:
    """Decimals and floats as doubles, timestamps as text."""

    def plain(field: T.StructField) -> Column:
        c = F.col(field.name)
        if isinstance(field.dataType, T.DecimalType | T.FloatType):
            return c.cast("double").alias(field.name)
        if isinstance(field.dataType, T.TimestampType | T.TimestampNTZType):
            return F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(field.name)
        return c

    return df.select(*[plain(f) for f in df.schema.fields])


# --- scoring ------------------------------------------------------------------------


def _score(spark: SparkSession, sf_dir: str, grain: str) -> DataFrame:
    loans = derived.loans if grain == "loan" else derived.member_loans
    return scoring.score(
        derived.loan_repayment(spark, sf_dir, grain == "member"),
        loans(spark, sf_dir),
        derived.members(spark, sf_dir),
        cleaning.credit_counts(derived.loan_defaulters(spark, sf_dir)),
        None,
        grain=grain,
    )


def _points(spark: SparkSession, sf_dir: str, grain: str = "member") -> DataFrame:
    loans = derived.loans if grain == "loan" else derived.member_loans
    late, records = cleaning.split_defaulters(derived.loan_defaulters(spark, sf_dir))
    return scoring.all_points(
        derived.loan_repayment(spark, sf_dir, grain == "member"),
        loans(spark, sf_dir),
        derived.members(spark, sf_dir),
        records,
        late,
        grain=grain,
    )


@query
def flagship_loan_grade(spark: SparkSession, sf_dir: str) -> DataFrame:
    return portable(_score(spark, sf_dir, "member"))


@query
def loan_grain_grade(spark: SparkSession, sf_dir: str) -> DataFrame:
    return portable(_score(spark, sf_dir, "loan"))


@query
def grade_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.distribution(_score(spark, sf_dir, "member"))


@query
def payment_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.payment_history(
        derived.loan_repayment(spark, sf_dir), derived.loans(spark, sf_dir)
    ).select("id", "member_id", "last_payment_pts", "total_payment_pts")


@query
def default_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return portable(
        _points(spark, sf_dir).select(
            "member_id", "last_payment_pts", "total_payment_pts",
            "delinq_pts", "public_records_pts", "public_bankruptcies_pts", "enq_pts",
        )
    )


@query
def health_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return portable(
        _points(spark, sf_dir, "loan").select(
            "id", "member_id", "loan_status_pts", "home_pts", "credit_limit_pts", "grade_pts"
        )
    )


@query
def composite_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return portable(scoring.composite(_points(spark, sf_dir, "loan")))


@query
def grade_cut(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Range of scores behind each letter."""
    scored = _score(spark, sf_dir, "loan")
    return portable(
        scored.groupBy("loan_final_grade").agg(
            F.min("loan_score").alias("lowest"),
            F.max("loan_score").alias("highest"),
            F.sum("loan_score").alias("total"),
            F.count(F.lit(1)).alias("loans"),
        )
    )


# Stages of scoring as views, and SQL that begins at one of them.


def _stage_sql(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    late, records = cleaning.split_defaulters(derived.loan_defaulters(spark, sf_dir))
    tables.register_views(
        scoring.stages(
            derived.loan_repayment(spark, sf_dir),
            derived.loans(spark, sf_dir),
            derived.members(spark, sf_dir),
            records,
            late,
        )
    )
    return portable(spark.sql(sql))


@query
def stage_payment_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stage_sql(
        spark,
        sf_dir,
        """select loan_status, count(*) as loans, sum(last_payment_pts) as last_pts,
                  sum(total_payment_pts) as total_pts
           from payment_history group by loan_status""",
    )


@query
def stage_defaulters_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stage_sql(
        spark,
        sf_dir,
        """select id, last_payment_pts + total_payment_pts as paid_pts,
                  delinq_pts + public_records_pts + public_bankruptcies_pts + enq_pts as record_pts
           from defaulters_score""",
    )


@query
def stage_overall_member_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stage_sql(
        spark,
        sf_dir,
        """select id, member_id, cast((last_payment_pts + total_payment_pts) * 0.20 as double)
                    as payment_history_pts,
                  cast((delinq_pts + public_records_pts + public_bankruptcies_pts + enq_pts) * 0.45
                    as double) as defaulters_history_pts
           from overall_member_score""",
    )


@query
def stage_loan_score_eval(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stage_sql(
        spark,
        sf_dir,
        """select loan_final_grade, count(member_id) as loans, min(loan_score) as least,
                  max(loan_score) as most
           from loan_score_eval group by loan_final_grade""",
    )


@query
def grades_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flagship from tables in buckets by member, scored without a shuffle."""
    late, records = cleaning.split_defaulters(derived.loan_defaulters(spark, sf_dir))
    processed = {
        "loan_repayment": derived.loan_repayment(spark, sf_dir, per_member=True),
        "loans": derived.member_loans(spark, sf_dir),
        "members": derived.members(spark, sf_dir),
        "defaulter_details": records,
        "delinq_details": late,
    }
    path = stage_path(spark, "buckets")
    prefix = "scoring_" + path.rsplit("-", 1)[1]
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    names = jobs.bucket_scoring_tables(processed, path, prefix, buckets)
    points = scoring.points_of(*[spark.table(n) for n in names.values()])
    return portable(scoring.graded(scoring.composite(points)))


# --- data quality: single checks ------------------------------------------------------


@query
def dq_float(spark: SparkSession, sf_dir: str) -> DataFrame:
    event = F.col("event_id")
    amount = (
        F.when(event % 29 == 0, "n/a")
        .when(event % 31 == 0, F.concat(F.get_json_object("props", "$.k"), F.lit("x1")))
        .when(event % 37 == 0, F.lit(None))
        .otherwise(F.col("value").cast("string"))
    )
    events = derived.table(spark, sf_dir, "events").select("event_id", amount.alias("amount"))
    return quality.failed_rows(events, Rule("F", "float_check", ("amount",)))


@query
def dq_int(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = derived.messy_defaulters(spark, sf_dir).select("member_id", "delinq_2_years")
    return quality.failed_rows(counts, Rule("I", "int_check", ("delinq_2_years",)))


@query
def dq_int_truncating(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The shipped rule: text like ``1.5`` is a count, ``abc`` is not."""
    counts = derived.messy_defaulters(spark, sf_dir)
    return quality.failure_details(counts, [rules.rule("R2")]).select(
        "member_id", "delinq_2_years", "rule_id", "failed_column"
    )


@query
def dq_max_len(spark: SparkSession, sf_dir: str) -> DataFrame:
    states = derived.members(spark, sf_dir).select("member_id", "address_state")
    return quality.failed_rows(states, Rule("S", "field_value_check", ("address_state",)))


@query
def dq_grade_len(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Grades of which some hold a sub-grade by mistake."""
    key = F.col("member_id").cast("bigint")
    grades = derived.members(spark, sf_dir).select(
        "member_id",
        F.when(key % 23 == 0, F.col("sub_grade")).otherwise(F.col("grade")).alias("grade"),
    )
    return quality.failed_rows(grades, rules.rule("R4"))


@query
def dq_exact_len(spark: SparkSession, sf_dir: str) -> DataFrame:
    zips = derived.members(spark, sf_dir).select("member_id", "zip_code")
    return quality.failed_rows(zips, rules.rule("R5"))


@query
def dq_duplicate_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = derived.table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_returnflag"
    )
    return quality.repeated_rows(lines, ["l_orderkey", "l_linenumber"])


@query
def dq_duplicate_single(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The shipped rule on loans: nearly all rows, as members have several loans."""
    return portable(
        quality.failed_rows(derived.loans(spark, sf_dir), rules.rule("R6")).select(
            "id", "member_id", "funded_amount"
        )
    )


@query
def dq_duplicate_metric(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.metrics(derived.loans(spark, sf_dir), [rules.rule("R6")]).select(
        "field", "check", "total_rows", "failed_rows", "percentage"
    )


@query
def dq_allowed_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    allowed = ["1-URGENT", "2-HIGH", "3-MEDIUM", "5-LOW"]
    orders = derived.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    check = Rule(
        "V", "allowed_values_check", ("o_orderpriority",), params={"allowed_values": allowed}
    )
    return quality.failed_rows(orders, check)


@query
def dq_allowed_values_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Allowed values that are the keys of another table."""
    known = derived.table(spark, sf_dir, "customer").filter("c_custkey % 7 <> 0").select("c_custkey")
    orders = derived.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    check = Rule(
        "V", "allowed_values_check", ("o_custkey",), params={"allowed_values": known}
    )
    return quality.failed_rows(orders, check)


@query
def dq_calculation_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sums over raw text: exact to the last digit, and no amount stops the check."""
    repaid = derived.text_repayment(spark, sf_dir)
    return quality.failed_rows(repaid, rules.rule("R8")).select(
        "id", "total_principal_received", "total_interest_received", "total_payment"
    )


@query
def dq_calculation(spark: SparkSession, sf_dir: str) -> DataFrame:
    repaid = derived.balanced_repayment(spark, sf_dir)
    return portable(
        quality.failed_rows(repaid, rules.rule("R8")).select(
            "id", "total_principal_received", "total_late_fee_received", "total_payment"
        )
    )


@query
def dq_month_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    repaid = derived.loan_repayment(spark, sf_dir)
    return quality.failure_details(repaid, [rules.rule("R9")]).select(
        "id", "last_payment_date", "next_payment_date", "failed_column"
    )


@query
def dq_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = derived.table(spark, sf_dir, "labels").select("doc_id", "quality")
    documents = derived.table(spark, sf_dir, "documents").select("doc_id", "lang", "source")
    labelled = documents.join(labels, "doc_id", "left")
    return quality.failed_rows(labelled, Rule("N", "null_check", ("quality",))).select(
        "doc_id", "lang", "source"
    )


# --- data quality: whole tables -------------------------------------------------------


@query
def dq_annotate(spark: SparkSession, sf_dir: str) -> DataFrame:
    fails = F.transform(quality.FAILS, lambda f: F.concat(f.rule_id, F.lit(":"), f.failed_column))
    marked = quality.annotate(derived.loans(spark, sf_dir), rules.BY_TABLE[rules.LOANS])
    return marked.select(
        "id", F.size(quality.FAILS).alias("n_fails"), F.array_join(fails, ",").alias("fails")
    )


@query
def dq_failed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return portable(quality.failed_rows(derived.loans(spark, sf_dir), rules.rule("R10")))


@query
def dq_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    members = derived.members(spark, sf_dir)
    return quality.failure_details(members, rules.BY_TABLE[rules.MEMBERS]).select(
        "member_id", *quality.DETAIL_COLUMNS
    )


@query
def dq_details_loans(spark: SparkSession, sf_dir: str) -> DataFrame:
    loans = derived.loans(spark, sf_dir)
    return quality.failure_details(loans, rules.BY_TABLE[rules.LOANS]).select(
        "id", "member_id", "rule_id", "check_type", "failed_column"
    )


@query
def dq_bad_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    members = derived.members(spark, sf_dir)
    return portable(quality.bad_rows(members, rules.BY_TABLE[rules.MEMBERS]))


def _line_rule() -> Rule:
    modes = ["A", "N", "R"]
    return Rule("L", "allowed_values_check", ("mode",), params={"allowed_values": modes})


def _lines(spark: SparkSession, sf_dir: str, key: Column) -> DataFrame:
    """Line items, a few of them with a mode that is not allowed."""
    odd = (F.col("l_partkey") * 7 + F.col("l_suppkey")) % 61 == 0
    return derived.table(spark, sf_dir, "lineitem").select(
        key.alias("order_key"),
        "l_linenumber",
        "l_partkey",
        F.when(odd, F.concat("l_returnflag", F.lit("?"))).otherwise(F.col("l_returnflag")).alias("mode"),
    )


def _some_null_key() -> Column:
    key = F.col("l_orderkey")
    return F.when(key % 10 != 0, key)


@query
def dq_clean_keyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _lines(spark, sf_dir, F.col("l_orderkey"))
    return quality.split(lines, [_line_rule()], ["order_key"]).clean


@query
def dq_clean_nullsafe(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _lines(spark, sf_dir, _some_null_key())
    return quality.split(lines, [_line_rule()], ["order_key"]).clean


@query
def dq_clean_keyed_compat(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _lines(spark, sf_dir, _some_null_key())
    return quality.split(lines, [_line_rule()], ["order_key"], compat=True).clean


def _line_modes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Few columns, hence many copies of each row."""
    return _lines(spark, sf_dir, F.col("l_orderkey")).select("l_linenumber", "mode")


@query
def dq_clean_unkeyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.split(_line_modes(spark, sf_dir), [_line_rule()]).clean


@query
def dq_clean_unkeyed_compat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.split(_line_modes(spark, sf_dir), [_line_rule()], compat=True).clean


@query
def dq_audit_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _lines(spark, sf_dir, F.col("l_orderkey"))
    return quality.split(lines, [_line_rule()], ["order_key"]).audit


@query
def dq_metrics_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.metrics(derived.loans(spark, sf_dir), rules.BY_TABLE[rules.LOANS])


@query
def dq_metrics_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.metrics(derived.members(spark, sf_dir), rules.BY_TABLE[rules.MEMBERS])


# --- history --------------------------------------------------------------------------

KEYS = ["c_custkey"]
TRACKED = ["c_custkey", "c_name", "c_nationkey", "c_mktsegment"]


def _history(spark: SparkSession, sf_dir: str, day: int) -> DataFrame:
    """History after a day; each earlier day's is written before the next is applied."""
    past = None
    for n in range(day + 1):
        batch = derived.snapshot(spark, sf_dir, n)
        past = history.apply_batch(past, batch, KEYS, DAYS[n], TRACKED)
        if n < day:
            past = stage(past, "history")
    return past


@query
def scd2_initial(spark: SparkSession, sf_dir: str) -> DataFrame:
    return portable(_history(spark, sf_dir, 0))


@query
def scd2_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    now = history.current(_history(spark, sf_dir, 0))
    batch = derived.snapshot(spark, sf_dir, 1)
    return portable(history.changes(now, batch, KEYS, DAYS[1], TRACKED))


@query
def scd2_apply(spark: SparkSession, sf_dir: str) -> DataFrame:
    return portable(_history(spark, sf_dir, 1))


@query
def scd2_second_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return portable(_history(spark, sf_dir, 2))


@query
def scd2_reactivate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records that came back after they had been deleted in the source."""
    past = _history(spark, sf_dir, 2)
    ended = past.filter("is_deleted_in_source").select(*KEYS, F.col("valid_to").alias("left_at"))
    back = past.filter("is_current").select(
        *KEYS, "c_mktsegment", F.col("valid_from").alias("back_at")
    )
    return portable(back.join(ended, KEYS))


@query
def scd2_repeat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Day 2 delivered twice: versions per state, the same as after one delivery."""
    past = _history(spark, sf_dir, 2)
    again = history.apply_batch(
        past, derived.snapshot(spark, sf_dir, 2), KEYS, "2024-01-04 00:00:00", TRACKED
    )
    return portable(
        again.groupBy("is_current", "is_deleted_in_source", "valid_from", "valid_to").agg(
            F.count(F.lit(1)).alias("versions")
        )
    )


@query
def scd2_held(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Day 1 with some of its missing records held, so that they stay current."""
    now = history.current(_history(spark, sf_dir, 0))
    held = derived.table(spark, sf_dir, "customer").filter("c_custkey % 26 = 0").select(*KEYS)
    batch = derived.snapshot(spark, sf_dir, 1)
    moved = history.advance(now, batch, KEYS, DAYS[1], TRACKED, held_keys=held)
    return portable(
        moved.select("c_custkey", "c_mktsegment", "is_current", "is_deleted_in_source", "valid_to")
    )


@query
def scd2_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The current slice after day 2, through tables on disk."""
    path = stage_path(spark, "history")
    for n in range(3):
        batch = derived.snapshot(spark, sf_dir, n)
        if n == 0:
            versions = history.initial(batch, KEYS, DAYS[0], TRACKED)
        else:
            before = history_store.read_current(spark, path, n - 1)
            versions = history.advance(before, batch, KEYS, DAYS[n], TRACKED)
        history_store.publish(versions, path, n)
    return portable(history_store.read_current(spark, path, 2))


@query
def scd2_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What was valid between day 1 and day 2."""
    past = _history(spark, sf_dir, 2)
    return portable(history.as_of(past, "2024-01-02 12:00:00").select(*TRACKED, "valid_from"))


def _customers(spark: SparkSession) -> Store:
    """A history in slices, none of it stored yet."""
    path = stage_path(spark, "customers")
    return Store(spark, path, derived.COLUMNS["customer"], tuple(KEYS))


@query
def scd2_partial_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two batches of some records each, merged into the slices that hold their keys."""
    past = _customers(spark)
    past.apply(0, derived.snapshot(spark, sf_dir, 0), DAYS[0], tracked=TRACKED)
    for n in (1, 2):
        some = derived.snapshot(spark, sf_dir, n).filter(f"c_custkey % 7 = {n}")
        past.apply(n, some, DAYS[n], tracked=TRACKED, partial=True)
    return portable(past.read_history(2))


@query
def scd2_versions_in_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The records of two days in one batch, so that most keys come twice."""
    past = _customers(spark)
    past.apply(0, derived.snapshot(spark, sf_dir, 0), DAYS[0], tracked=TRACKED)
    days = [
        derived.snapshot(spark, sf_dir, n).withColumn("at", F.lit(DAYS[n])) for n in (2, 1)
    ]
    both = days[0].unionByName(days[1])
    past.apply(1, both, at="at", tracked=TRACKED, partial=True)
    return portable(past.read_history(1))


@query
def scd2_late_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Day 1 delivered after day 2: the same history as in order."""
    past = _customers(spark)
    for batch, day in enumerate((0, 2, 1)):
        past.apply(batch, derived.snapshot(spark, sf_dir, day), DAYS[day], tracked=TRACKED)
    return portable(past.read_history(2))


@query
def scd2_gained_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second batch whose records have one more column and a wider one."""
    path = stage_path(spark, "customers")
    first = derived.snapshot(spark, sf_dir, 0).select("c_custkey", "c_name", "c_nationkey")
    past = Store(spark, path, "c_custkey bigint, c_name string, c_nationkey int", tuple(KEYS))
    past.apply(0, first, DAYS[0])
    second = derived.snapshot(spark, sf_dir, 1).select(
        "c_custkey",
        F.when(F.col("c_custkey") % 10 == 0, "renamed").otherwise(F.col("c_name")).alias("c_name"),
        F.col("c_nationkey").cast("long").alias("c_nationkey"),
        "c_mktsegment",
    )
    past = past.evolved(0, second.schema)
    past.apply(1, second, DAYS[1])
    return portable(past.read_history(1).drop("row_hash", "sk_id"))


@query
def scd2_observed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The history of all three days from their observations, at once."""
    seen = [
        timeline.observe(derived.snapshot(spark, sf_dir, n), DAYS[n], TRACKED) for n in (2, 0, 1)
    ]
    return portable(timeline.history_of(seen[0].unionByName(seen[1]).unionByName(seen[2]), KEYS, DAYS))


@query
def scd2_compat_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derived.members(spark, sf_dir).select(
        "member_id",
        history.row_hash(["home_ownership", "grade", "sub_grade"], compat=True).alias("row_hash"),
    )


# --- cleaning -------------------------------------------------------------------------


@query
def clean_term_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    loans = derived.loans(spark, sf_dir).select("id", "term")
    return cleaning.with_years(loans)


@query
def clean_purpose(spark: SparkSession, sf_dir: str) -> DataFrame:
    loans = derived.loans(spark, sf_dir).select("id", "purpose")
    return cleaning.to_vocabulary(loans, "purpose", cleaning.PURPOSES)


@query
def clean_loans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return portable(cleaning.clean_loans(derived.loans(spark, sf_dir), DAYS[0]))


@query
def clean_repayment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return portable(cleaning.clean_repayment(derived.loan_repayment(spark, sf_dir), DAYS[0]))


@query
def clean_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    return portable(cleaning.clean_members(derived.members(spark, sf_dir), DAYS[0]))


@query
def clean_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _line_modes(spark, sf_dir).dropDuplicates()


@query
def split_delinquencies(spark: SparkSession, sf_dir: str) -> DataFrame:
    late, _ = cleaning.split_defaulters(derived.messy_defaulters(spark, sf_dir))
    return portable(late)


@query
def split_defaulters(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, records = cleaning.split_defaulters(derived.messy_defaulters(spark, sf_dir))
    return portable(records)


# --- sources and sinks ----------------------------------------------------------------


@query
def typed_reads_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Processed tables written, read back by type and joined in SQL."""
    late, records = cleaning.split_defaulters(derived.loan_defaulters(spark, sf_dir))
    written = {
        "members": derived.members(spark, sf_dir),
        "loans": derived.loans(spark, sf_dir),
        "loan_repayment": derived.loan_repayment(spark, sf_dir),
        "delinq_details": late,
        "defaulter_details": records,
    }
    root = stage_path(spark, "processed")
    for name, df in written.items():
        tables.write_table(df, "parquet", f"{root}/{name}")
    tables.register_views(
        {
            "members": tables.read_members(spark, f"{root}/members"),
            "loans": tables.read_loans(spark, f"{root}/loans"),
            "loan_repayment": tables.read_loan_repayment(spark, f"{root}/loan_repayment"),
            "delinq_details": tables.read_delinquencies(spark, f"{root}/delinq_details"),
            "defaulter_details": tables.read_defaulters(spark, f"{root}/defaulter_details"),
        }
    )
    return portable(
        spark.sql(
            """
            select m.grade, count(*) as loans, sum(r.total_payment) as repaid,
                   sum(d.delinq_2_years) as delinquencies, sum(f.public_record) as records
            from loan_repayment r
            join loans l on l.id = r.id
            join members m on m.member_id = l.member_id
            join delinq_details d on d.member_id = l.member_id
            join defaulter_details f on f.member_id = l.member_id
            group by m.grade
            """
        )
    )


@query
def rejects_by_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rejects written by rule, read back from the folders."""
    path = stage_path(spark, "rejects")
    found = quality.split(derived.members(spark, sf_dir), rules.BY_TABLE[rules.MEMBERS], ["member_id"])
    tables.write_table(found.detail, "parquet", path, partition_by="rule_id")
    rejects = tables.read_table(spark, "parquet", path)
    return rejects.groupBy("rule_id", "check_type", "failed_column").agg(
        F.count(F.lit(1)).alias("rejects")
    )


@query
def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Members written as CSV with a header and read back by column name."""
    path = stage_path(spark, "csv")
    members = derived.members(spark, sf_dir)
    tables.write_table(members.select(*reversed(members.columns)), "csv", path)
    return portable(tables.read_members(spark, path, "csv"))


@query
def csv_positional(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The schema bound by position on files without a header."""
    path = stage_path(spark, "csv")
    orders = derived.table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    tables.write_table(orders, "csv", path, options={"header": "false"})
    return portable(
        tables.read_table(
            spark, "csv", path, "id bigint, price decimal(18,2), status string", positional=True
        )
    )


@query
def csv_malformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text that is no number becomes null in a typed read."""
    path = stage_path(spark, "csv")
    key = F.col("o_orderkey")
    orders = derived.table(spark, sf_dir, "orders").select(
        key,
        F.when(key % 41 == 0, "oops").otherwise(F.col("o_custkey").cast("string")).alias("customer"),
    )
    tables.write_table(orders, "csv", path)
    return tables.read_table(spark, "csv", path, "o_orderkey bigint, customer bigint")


RESCUE = "o_orderkey bigint, customer bigint, price decimal(18,2), placed date"


def _odd_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as text, of which some fields do not fit their type."""
    return derived.table(spark, sf_dir, "orders").selectExpr(
        "cast(o_orderkey as string) as o_orderkey",
        "if(o_orderkey % 41 = 0, 'oops', cast(o_custkey as string)) as customer",
        """case when o_orderkey % 43 = 0 then '12 EUR' when o_orderkey % 47 = 0 then ''
                else cast(cast(o_totalprice as decimal(18,2)) as string) end as price""",
        "if(o_orderkey % 53 = 0, '31.12.1999', date_format(o_orderdate, 'yyyy-MM-dd')) as placed",
    )


def _rescued(read: DataFrame) -> DataFrame:
    return read.select(
        "o_orderkey", "customer", F.explode_outer("rescued").alias("field", "given")
    )


@query
def csv_rescued(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a typed read by name made null, by field."""
    path = stage_path(spark, "csv")
    odd = _odd_orders(spark, sf_dir)
    tables.write_table(odd.select(*reversed(odd.columns)), "csv", path)
    return _rescued(tables.read_table(spark, "csv", path, RESCUE, rescued="rescued"))


@query
def json_rescued(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = stage_path(spark, "json")
    tables.write_table(_odd_orders(spark, sf_dir), "jsonl", path)
    read = tables.read_table(
        spark, "jsonl", path, RESCUE, tables.read_options("jsonl"), rescued="rescued"
    )
    return _rescued(read)


@query
def csv_corrupt_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The malformed lines themselves, kept by a positional read."""
    path = stage_path(spark, "csv")
    key = F.col("o_orderkey")
    orders = derived.table(spark, sf_dir, "orders").select(
        key, F.when(key % 41 == 0, "oops").otherwise(F.col("o_custkey").cast("string"))
    )
    tables.write_table(orders, "csv", path, options={"header": "false"})
    read = tables.read_table(
        spark,
        "csv",
        path,
        "o_orderkey bigint, customer bigint, line string",
        {"columnNameOfCorruptRecord": "line"},
        positional=True,
    )
    # Parsed once into a table: Spark refuses to filter on the raw line alone.
    return stage(read, "csv-lines").filter("line is not null")


@query
def json_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = stage_path(spark, "json")
    events = derived.table(spark, sf_dir, "events").select(
        "event_id", "ts", "user_id", "event_type", "value", "props"
    )
    tables.write_table(events, "jsonl", path)
    return portable(
        tables.read_table(spark, "jsonl", path, events.schema, tables.read_options("jsonl"))
    )


DOCUMENTS_A_FILE = 10_000
"""About so many events are one file of JSON documents, so that no value grows with the table."""


@query
def json_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as JSON documents that span lines, read by the multi-line preset."""
    path = stage_path(spark, "json")
    events = derived.table(spark, sf_dir, "events").select("event_id", "user_id", "event_type")
    shown = F.to_json(F.struct("*"), {"pretty": "true"}).alias("value")
    # A file is one array of documents, in a folder of its own; each task reads one.
    parts = max(1, -(-events.count() // DOCUMENTS_A_FILE))
    files = events.groupBy(F.pmod(F.xxhash64("event_id"), F.lit(parts)).alias("file")).agg(
        F.concat(F.lit("["), F.array_join(F.collect_list(shown), ",\n"), F.lit("]")).alias("value")
    )
    files.write.partitionBy("file").text(path)
    read = tables.read_table(
        spark, "json", path, events.schema, tables.read_options("json")
    )
    return read.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("events"), F.count_distinct("user_id").alias("users")
    )


def _partitioned_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = stage_path(spark, "parquet")
    orders = derived.table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus"
    )
    tables.write_table(orders, "parquet", path, partition_by=["o_orderstatus"])
    return tables.read_table(spark, "parquet", path, options=tables.read_options("parquet"))


@query
def parquet_partitioned_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Written by partition and read back from all folders."""
    return _partitioned_orders(spark, sf_dir)


@query
def parquet_one_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A filter on the partition reads its folder alone."""
    return _partitioned_orders(spark, sf_dir).filter(F.col("o_orderstatus") == "F")


@query
def parquet_merged_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two writes, the second with a new column, appended to one table."""
    path = stage_path(spark, "parquet")
    customers = derived.table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    suppliers = derived.table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("c_custkey"), F.col("s_name").alias("supplier")
    )
    tables.write_table(customers, "parquet", path)
    tables.write_table(suppliers, "parquet", path, mode="append")
    return tables.read_table(
        spark, "parquet", path, options=tables.read_options("parquet")
    ).select("c_custkey", "c_mktsegment", "supplier")


# --- whole jobs -----------------------------------------------------------------------


@query
def job_grades(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All four tables from raw files to graded loans."""
    root = stage_path(spark, "batch")
    arriving = {
        "members": derived.members(spark, sf_dir),
        "loans": derived.member_loans(spark, sf_dir),
        "loan_repayment": derived.balanced_repayment(spark, sf_dir, per_member=True),
        "loan_defaulters": derived.messy_defaulters(spark, sf_dir),
    }
    raw = {}
    for name, df in arriving.items():
        tables.write_table(df, "parquet", f"{root}/raw/{name}")
        raw[name] = jobs.read_raw(spark, "parquet", f"{root}/raw/{name}")
    return portable(jobs.run_batch(spark, raw, root, 0, DAYS[0]))


@query
def job_members_processed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One table: checked, versioned, cleaned and written."""
    root = stage_path(spark, "members")
    now = jobs.ingest("members", derived.members(spark, sf_dir), root, 0, DAYS[0])
    jobs.process("members", now, root, 0, DAYS[0])
    return portable(
        tables.read_table(spark, "parquet", jobs.processed_path(root, "members", 0)).select(
            "member_id", "emp_length", "address_state", "annual_income", "ingestion_date"
        )
    )


@query
def job_members_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with CSV as the format of processed tables, read back by type."""
    root = stage_path(spark, "members")
    now = jobs.ingest("members", derived.members(spark, sf_dir), root, 0, DAYS[0])
    jobs.process("members", now, root, 0, DAYS[0], "csv")
    members = jobs.read_processed(spark, root, "members", 0, "csv")
    return portable(members.select("member_id", "emp_length", "address_state", "annual_income"))


@query
def job_grades_from_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The distribution of grades after three batches, kept up by changes alone."""
    root = stage_path(spark, "grades")
    arriving = {
        "members": derived.members(spark, sf_dir),
        "loans": derived.member_loans(spark, sf_dir),
        "loan_repayment": derived.balanced_repayment(spark, sf_dir, per_member=True),
        "loan_defaulters": derived.messy_defaulters(spark, sf_dir),
    }
    status = F.when(F.col("loan_status") == "Current", "Fully Paid").otherwise(F.col("loan_status"))
    paid = F.when(F.col("id") % 5 == 0, F.lit(1)).otherwise(F.col("last_payment_amount"))
    # Derived once: a batch reads its tables several times.
    whole = {name: stage(df, "raw") for name, df in arriving.items()}
    kind = whole["loan_repayment"].schema["last_payment_amount"].dataType
    earlier = {  # what the first two batches have in place of the last one's tables
        0: {
            "members": whole["members"].filter("member_id % 13 <> 0"),
            "loans": whole["loans"].withColumn("loan_status", status),
        },
        1: {
            "loans": whole["loans"].filter("id % 17 <> 0"),
            "loan_repayment": whole["loan_repayment"].withColumn(
                "last_payment_amount", paid.cast(kind)
            ),
        },
    }
    for n in range(3):
        raw = {**whole, **earlier.get(n, {})}
        # No table waits for another's small jobs.
        with ThreadPoolExecutor(len(raw)) as pool:
            for done in [pool.submit(jobs.ingest, t, df, root, n, DAYS[n]) for t, df in raw.items()]:
                done.result()
        grades = jobs.regrade(spark, root, n, DAYS[n])
    return grades


@query
def job_unstorable_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Amounts that pass as numbers but fit no money column are rejected, never nulled."""
    root = stage_path(spark, "repayment")
    jobs.ingest("loan_repayment", derived.text_repayment(spark, sf_dir), root, 0, DAYS[0])
    rejects = jobs.read_rejects(spark, root, "loan_repayment", 0)
    return rejects.filter("rule_id = 'K3'").select("id", "total_payment", "failed_column")


@query
def rejects_when_none(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rejects of a batch of good members, and how many became current."""
    root = stage_path(spark, "members")
    members = quality.split(
        derived.members(spark, sf_dir), jobs.table_rules("members"), ["member_id"]
    ).clean
    now = jobs.ingest("members", members, root, 0, DAYS[0])
    rejects = jobs.read_rejects(spark, root, "members", 0)
    return now.agg(F.count(F.lit(1)).alias("members")).withColumn(
        "rejects", rejects.agg(F.count(F.lit(1))).scalar()
    )


@query
def job_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row counts that the job stores for each batch."""
    root = stage_path(spark, "members")
    jobs.ingest("members", derived.members(spark, sf_dir), root, 0, DAYS[0])
    return tables.read_table(spark, "parquet", jobs.audit_path(root, "members", 0))


@query
def job_duplicates_across_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loans in three batches, of whose members no one may have two: what was rejected for
    that in all batches together, and what stayed."""
    root = stage_path(spark, "loans")
    # Two loans of a member come a batch apart; other members have one.
    loans = derived.loans(spark, sf_dir).filter("id % 8 < 2 or id % 11 = 0")
    for n in range(3):
        batch = loans.filter(f"id % 3 = {n}")
        now = jobs.ingest("loans", batch, root, n, DAYS[n], partial=True, once=True)
    rejects = [jobs.read_rejects(spark, root, "loans", n) for n in range(3)]
    found = rejects[0].unionByName(rejects[1]).unionByName(rejects[2])
    twice = found.filter("rule_id = 'R6'").select("id", "member_id", F.lit("rejected").alias("state"))
    return twice.distinct().unionByName(now.select("id", "member_id", F.lit("kept").alias("state")))


def _two_batches(spark: SparkSession, sf_dir: str) -> str:
    """Loans in two batches from CSV; loans without a line item leave in the second."""
    root = stage_path(spark, "loans")
    first = derived.member_loans(spark, sf_dir)
    shipped = derived.table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("id")
    )
    second = first.join(shipped, "id", "left_semi").withColumn(
        "loan_status",
        F.when(F.col("loan_status") == "Current", "Fully Paid").otherwise(F.col("loan_status")),
    )
    for batch, loans in enumerate((first, second)):
        path = stage_path(spark, "loans-raw")
        tables.write_table(loans, "csv", path)
        jobs.ingest("loans", jobs.read_raw(spark, "csv", path), root, batch, DAYS[batch])
    return root


@query
def job_loans_two_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = _two_batches(spark, sf_dir)
    past = jobs.store(spark, root, "loans").read_history(1)
    return portable(
        past.select(
            "id", "loan_status", "funded_amount", "valid_from", "valid_to",
            "is_current", "is_deleted_in_source",
        )
    )


@query
def job_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the second batch changed, as the job stores it."""
    root = _two_batches(spark, sf_dir)
    changes = tables.read_table(spark, "parquet", jobs.changes_path(root, "loans", 1))
    return changes.select("id", "loan_status", "change_type", "is_current")
