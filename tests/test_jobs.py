"""Raw files to graded loans, over two batches."""

from __future__ import annotations

import pytest

from creditloom.operators import history, quality, scoring
from creditloom.plans import catalog, jobs
from creditloom.sources import tables
from creditloom.sources.tables import SCHEMAS

DAY = ["2024-01-01 00:00:00", "2024-01-02 00:00:00"]

MEMBER = dict(
    emp_title="t", emp_length="10+ years", home_ownership="OWN", annual_income="50000",
    address_state="NY", zip_code="12345", address_country="US", grade="A", sub_grade="A2",
    verification_status="Verified", total_high_credit_limit="6000",
    application_type="Individual", join_annual_income=None, verification_status_joint=None,
)
LOAN = dict(
    loan_amount="1000", funded_amount="1000", term=" 36 months", interest_rate="10.5",
    installment="100", issue_month_year="Dec-2015", loan_status="Current", purpose="car", title="car",
)
PAID = dict(
    total_principal_received="400", total_interest_received="90", total_late_fee_received="10",
    total_payment="500", last_payment_amount="100", last_payment_date="Dec-2015", next_payment_date=None,
)
CREDIT = dict(
    delinq_2_years="0.0", delinq_amount="0", public_record="0.0", public_record_bankruptcies="0.0",
    inquiry_last_6_months="1.0", total_rec_late_fee="0.0", months_since_last_delinq=None,
    months_since_last_record=None,
)


def names(table):
    return [f.name for f in tables.as_schema(SCHEMAS[table]).fields]


def write_raw(spark, root, batch, members, loans, paid, credit):
    """Raw CSV files as they arrive: everything text, header first."""
    out = {}
    for table, rows in (
        ("members", members), ("loans", loans), ("loan_repayment", paid), ("loan_defaulters", credit)
    ):
        columns = names(table)
        df = spark.createDataFrame(
            [tuple(r.get(c) for c in columns) for r in rows], ", ".join(f"{c} string" for c in columns)
        )
        path = f"{root}/raw/{table}/{batch}"
        tables.write_table(df, "csv", path)
        out[table] = jobs.read_raw(spark, "csv", path)
    return out


def member(i, **changes):
    return {"member_id": f"m{i}", **MEMBER, **changes}


def loan(i, **changes):
    return {"id": f"l{i}", "member_id": f"m{i}", **LOAN, **changes}


def paid(i, **changes):
    return {"id": f"l{i}", **PAID, **changes}


def credit(i, **changes):
    return {"member_id": f"m{i}", **CREDIT, **changes}


def rejects(spark, root, table, batch):
    df = spark.read.parquet(jobs.rejects_path(root, table, batch))
    key = jobs.TABLES[table].keys[0]
    return sorted((r[key] or "", r.rule_id, r.failed_column) for r in df.collect())


@pytest.fixture(scope="module")
def two_batches(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("job"))
    n = range(1, 9)
    first = write_raw(
        spark, root, 0,
        [member(i) for i in n] + [member(9, zip_code="1"), member(10), member(10), member(None, member_id=None)],
        [loan(i) for i in n if i != 2] + [loan(2, loan_amount="a lot"), loan(11), loan(12, member_id="m11")],
        [paid(i) for i in n if i != 3] + [paid(3, total_payment="501"), paid(13, last_payment_date="2015")],
        [credit(i) for i in n if i != 4] + [credit(4, delinq_2_years="abc")],
    )
    graded = [jobs.run_batch(spark, first, root, 0, DAY[0])]
    second = write_raw(
        spark, root, 1,
        [member(i) for i in n if i != 5] + [member(5, grade="A1")],          # m5 is rejected
        [loan(i) for i in n if i not in (2, 6)] + [loan(2, loan_status="Fully Paid")],  # l6 leaves
        [paid(i) for i in n],
        [credit(i) for i in n],
    )
    graded.append(jobs.run_batch(spark, second, root, 1, DAY[1]))
    return root, graded


def test_first_batch(spark, two_batches):
    root, graded = two_batches
    # 2: malformed amount, 3: wrong total, 4: malformed count.
    assert sorted(r.member_id for r in graded[0].collect()) == ["m1", "m5", "m6", "m7", "m8"]
    assert {(str(r.loan_score), r.loan_final_grade) for r in graded[0].collect()} == {("2371.0000", "B")}


def test_rejects(spark, two_batches):
    root, _ = two_batches
    assert rejects(spark, root, "members", 0) == [
        ("", "K1", "member_id"), ("m10", "R6", "member_id"), ("m9", "R5", "zip_code")
    ]
    assert rejects(spark, root, "loans", 0) == [
        ("l11", "R6", "member_id"), ("l12", "R6", "member_id"), ("l2", "R1", "loan_amount")
    ]
    assert rejects(spark, root, "loan_repayment", 0) == [
        ("l13", "R9", "last_payment_date"), ("l3", "R8", "total_payment")
    ]
    assert rejects(spark, root, "loan_defaulters", 0) == [("m4", "R2", "delinq_2_years")]


def test_second_batch(spark, two_batches):
    root, graded = two_batches
    # m5 is rejected and so drops out; l6 has left.
    assert sorted(r.member_id for r in graded[1].collect()) == ["m1", "m2", "m3", "m4", "m7", "m8"]
    past = jobs.store(spark, root, "members").read_history(1)
    spans = {r.member_id: (r.is_current, r.is_deleted_in_source) for r in past.collect()}
    assert spans["m5"] == (False, True)
    assert history.current(past).count() == 7


def test_batches_can_be_repeated(spark, two_batches):
    root, graded = two_batches
    raw = jobs.read_raw(spark, "csv", f"{root}/raw/loans/1")
    before = sorted(map(str, jobs.store(spark, root, "loans").read_history(1).collect()))
    jobs.ingest("loans", raw, root, 1, DAY[1])
    after = sorted(map(str, jobs.store(spark, root, "loans").read_history(1).collect()))
    assert before == after


def test_rejected_keys_can_be_held(spark, two_batches, tmp_path):
    root, _ = two_batches
    other = str(tmp_path)
    for batch in (0, 1):
        raw = jobs.read_raw(spark, "csv", f"{root}/raw/members/{batch}")
        now = jobs.ingest("members", raw, other, batch, DAY[batch], hold_rejected=True)
    assert sorted(r.member_id for r in now.collect()) == [f"m{i}" for i in range(1, 9)]


def test_processed_tables(spark, two_batches):
    root, _ = two_batches
    members = spark.read.parquet(jobs.processed_path(root, "members", 0))
    assert {r.emp_length for r in members.collect()} == {10}
    assert set(history.META).isdisjoint(members.columns)
    loans = spark.read.parquet(jobs.processed_path(root, "loans", 0))
    assert {r.term_years for r in loans.collect()} == {3}
    late = spark.read.parquet(jobs.processed_path(root, "delinq_details", 0))
    assert late.columns == names("delinq_details")


def test_a_batch_cannot_start_over(spark, two_batches):
    """The history under the root ends with batch 1; only 1 again or 2 may come."""
    root, _ = two_batches
    rows = spark.createDataFrame([], SCHEMAS["members"])
    for batch in (0, 3):
        with pytest.raises(ValueError, match="cannot follow"):
            jobs.ingest("members", rows, root, batch, "2024-02-01 00:00:00")


def test_no_rejects_can_be_read(spark, tmp_path):
    rows = spark.createDataFrame([], SCHEMAS["members"])
    jobs.ingest("members", rows, str(tmp_path), 0, "2024-02-01 00:00:00")
    empty = jobs.read_rejects(spark, str(tmp_path), "members", 0)
    assert empty.count() == 0 and set(quality.DETAIL_COLUMNS) <= set(empty.columns)


def text_loans(spark, rows):
    schema = ", ".join(f"{c} string" for c in names("loans"))
    return spark.createDataFrame([tuple(r.get(c) for c in names("loans")) for r in rows], schema)


@pytest.mark.parametrize("cut", [1, 2, 5])
def test_rejects_do_not_depend_on_how_rows_are_cut(spark, tmp_path, cut):
    """Key l3 comes three times, member m8 has three loans, and l9 is bad besides."""
    rows = [loan(n) for n in range(8)]
    rows += [loan(3, loan_status="Fully Paid"), loan(3, purpose="yacht")]
    rows += [loan(n, member_id="m8") for n in (20, 21, 22)]
    rows += [loan(9, purpose="yacht"), loan(9, member_id="m30"), loan(4), loan(40, member_id=None)]
    root, size = str(tmp_path), -(-len(rows) // cut)
    for n in range(cut):
        part = text_loans(spark, rows[n * size : (n + 1) * size])
        for _ in range(2):  # a batch that is run again changes nothing
            now = jobs.ingest("loans", part, root, n, f"2024-02-0{n + 1}", partial=True, once=True)
    found = set()
    for n in range(cut):
        for r in jobs.read_rejects(spark, root, "loans", n).collect():
            found.add((r.id, r.member_id, r.loan_status, r.purpose, r.rule_id, r.failed_column))
    whole = quality.split(text_loans(spark, rows), jobs.table_rules("loans"), ["id"])
    want = {
        (r.id, r.member_id, r.loan_status, r.purpose, r.rule_id, r.failed_column)
        for r in whole.detail.collect()
    }
    assert found == want and len(want) > 10
    assert {r.id for r in now.collect()} == {r.id for r in whole.clean.collect()}


def test_counts_are_those_of_what_was_written(spark, tmp_path):
    rows = [loan(1), loan(2, purpose="yacht"), loan(2, purpose="yacht"), loan(3)]
    now = jobs.ingest("loans", text_loans(spark, rows), str(tmp_path), 0, DAY[0])
    audit = spark.read.parquet(jobs.audit_path(str(tmp_path), "loans", 0)).first()
    assert audit.asDict() == {"raw_rows": 4, "clean_rows": 2, "bad_rows": 1}
    assert now.count() == 2


def test_processed_tables_as_csv(spark, two_batches, tmp_path):
    root, graded = two_batches
    for name in jobs.TABLES:
        now = jobs.store(spark, root, name).read_current(0)
        jobs.process(name, now, str(tmp_path), 0, DAY[0], "csv")
    again = jobs.grade(spark, str(tmp_path), 0, fmt="csv")
    assert sorted(map(str, again.collect())) == sorted(map(str, graded[0].collect()))


def test_distribution_follows_changes(spark, two_batches):
    root, graded = two_batches
    for batch in (0, 1):
        counts = jobs.regrade(spark, root, batch, DAY[batch])
        want = scoring.distribution(graded[batch])
        assert sorted(map(str, counts.collect())) == sorted(map(str, want.collect()))


def exchanges(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.count("Exchange hashpartitioning")


def test_bucketed_tables_are_scored_without_a_shuffle(spark, two_batches, tmp_path):
    root, graded = two_batches
    tidy = {
        name: jobs.read_processed(spark, root, name, 0)
        for name in ("loan_repayment", "loans", "members", "defaulter_details", "delinq_details")
    }
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        tables_of = jobs.bucket_scoring_tables(tidy, f"{tmp_path}/b", "scoring_test", 4)
        points = scoring.points_of(*[spark.table(t) for t in tables_of.values()])
        scored = scoring.graded(scoring.composite(points))
        plain = scoring.score(*tidy.values())
        assert exchanges(scored) == 0 and exchanges(plain) > 0
        assert sorted(map(str, scored.collect())) == sorted(map(str, graded[0].collect()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        for t in tables_of.values():
            spark.sql(f"drop table if exists {t}")


def test_batches_of_the_grades_query_read_written_tables(spark, monkeypatch):
    """What a batch reads several times is derived from the large tables once."""
    read = {}

    def ingest(name, raw, root, batch, as_of):
        read[name, batch] = raw.inputFiles()

    monkeypatch.setattr(jobs, "ingest", ingest)
    monkeypatch.setattr(jobs, "regrade", lambda *_: None)
    catalog.job_grades_from_changes(spark, "/root/testdata/sf0.001")
    assert len(read) == 12
    assert not [name for name, files in read.items() if any("testdata" in f for f in files)]
