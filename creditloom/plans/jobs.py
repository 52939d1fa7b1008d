"""Whole-table jobs: raw rows to history, processed tables and graded loans.

Every step ends in a written table and the next one starts from it, so the plan of a
step stays short and a lost executor costs re-reading files only. A batch can be run
again: each of its folders is replaced by the same rows.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from creditloom.functions.checks import DUPLICATE
from creditloom.operators import cleaning, history, quality, scoring
from creditloom.operators.keyed import DEFAULT_POLICY, KeyedPolicy
from creditloom.plans import rules
from creditloom.sources.slice_store import KEEP, Deliveries, Store
from creditloom.sources.staging import scope, stage
from creditloom.sources.tables import (
    PRESETS,
    SCHEMAS,
    as_schema,
    cast_by_name,
    read_logical,
    read_options,
    read_table,
    write_bucketed,
    write_table,
)


@dataclass(frozen=True)
class TableJob:
    """How one raw table is checked, tracked and cleaned."""

    rules_of: str
    keys: tuple[str, ...]
    clean: Callable[[DataFrame, str | datetime], dict[str, DataFrame]]


def _clean_defaulters(df: DataFrame, _: str | datetime) -> dict[str, DataFrame]:
    late, records = cleaning.split_defaulters(df)
    return {"delinq_details": late, "defaulter_details": records}


TABLES = {
    "members": TableJob(
        rules.MEMBERS,
        ("member_id",),
        lambda df, as_of: {"members": cleaning.clean_members(df, as_of)},
    ),
    "loans": TableJob(
        rules.LOANS,
        ("id",),
        lambda df, as_of: {"loans": cleaning.clean_loans(df, as_of)},
    ),
    "loan_repayment": TableJob(
        rules.REPAYMENT,
        ("id",),
        lambda df, as_of: {"loan_repayment": cleaning.clean_repayment(df, as_of)},
    ),
    "loan_defaulters": TableJob(rules.DEFAULTERS, ("member_id",), _clean_defaulters),
}


def read_raw(spark: SparkSession, fmt: str, path: str) -> DataFrame:
    """A raw table with every field as it was written, so that checks see it.

    Text formats are parsed once into a staged table, since checking reads the rows
    several times.
    """
    options = read_options(fmt) if fmt in PRESETS else None
    raw = read_table(spark, fmt, path, options=options)
    return stage(raw, "raw") if fmt in ("csv", "json", "jsonl") else raw


def history_path(root: str, name: str) -> str:
    return f"{root}/history/{name}"


def rejects_path(root: str, name: str, batch: int) -> str:
    return f"{root}/rejects/{name}/batch={batch}"


def audit_path(root: str, name: str, batch: int) -> str:
    return f"{root}/audit/{name}/batch={batch}"


def metrics_path(root: str, name: str, batch: int) -> str:
    return f"{root}/metrics/{name}/batch={batch}"


def changes_path(root: str, name: str, batch: int) -> str:
    return f"{history_path(root, name)}/changes/batch={batch}"


def store(spark: SparkSession, root: str, name: str) -> Store:
    """The stored history of a table."""
    return Store(spark, history_path(root, name), SCHEMAS[name], TABLES[name].keys)


def read_rejects(spark: SparkSession, root: str, name: str, batch: int) -> DataFrame:
    """The rejects of a batch; a batch without any gives an empty table."""
    path = rejects_path(root, name, batch)
    try:
        return read_table(spark, "parquet", path)
    except AnalysisException as error:
        if error.getCondition() != "UNABLE_TO_INFER_SCHEMA":
            raise
    columns = [f.name for f in as_schema(SCHEMAS[name]).fields]
    columns += [c for c in quality.DETAIL_COLUMNS if c != "rule_id"] + ["rule_id"]
    return spark.createDataFrame([], ", ".join(f"{c} string" for c in columns))


def processed_path(root: str, name: str, batch: int) -> str:
    return f"{root}/processed/{name}/batch={batch}"


def curated_path(root: str, batch: int) -> str:
    return f"{root}/curated/batch={batch}"


def table_rules(name: str) -> list[quality.Rule]:
    """The shipped rules of a table, those its key needs to have a history, and one that
    rejects what its columns cannot hold, so that no cast makes a value null."""
    job = TABLES[name]
    shipped = rules.BY_TABLE[job.rules_of]
    unique = {c for r in shipped if r.check_type == DUPLICATE for c in r.columns}
    repeats = tuple(k for k in job.keys if k not in unique)
    numbers = {c for r in shipped if r.check_type == "float_check" for c in r.columns}
    columns: dict[tuple[str, bool], list[str]] = {}
    for column in as_schema(SCHEMAS[name]).fields:
        kind = column.dataType.simpleString()
        if kind != "string":
            columns.setdefault((kind, column.name in numbers), []).append(column.name)
    return [
        *shipped,
        quality.Rule("K1", "null_check", job.keys, "Key should not be null"),
        quality.Rule("K2", DUPLICATE, repeats, "Key should occur once"),
        *[
            quality.Rule(
                "K3",
                "storable_check",
                tuple(held),
                f"Value should fit {kind}",
                params={"type": kind, "numbers_only": checked},
            )
            for (kind, checked), held in columns.items()
        ],
    ]


def ingest(
    name: str,
    raw: DataFrame,
    root: str,
    batch: int,
    as_of: str | datetime,
    hold_rejected: bool = False,
    partial: bool = False,
    once: bool = False,
    policy: KeyedPolicy = DEFAULT_POLICY,
    keep: int = KEEP,
) -> DataFrame:
    """Check a snapshot and bring the history up to date.

    Rejects, row counts, metrics and (after the first batch) the changes are written beside
    it. A batch follows the last one or replaces it; any other number is refused. Its moment
    ``as_of`` may lie before that of earlier ones.
    Returns the new current versions. A key rejected today counts as deleted in the
    source unless ``hold_rejected`` keeps its last good version. With ``partial`` the
    rows are new and changed records only, and no key counts as deleted; only the slices of
    the history that hold their keys are read and written. The state of the last ``keep``
    batches stays readable.

    With ``once`` (for partial batches) every row is one of its own, and the duplicate checks
    see the rows of all batches: the rows of earlier ones that turn out to be duplicates are
    rejected now and deleted, so all rejects together do not depend on how rows are cut
    into batches.
    """
    spark, keys = raw.sparkSession, list(TABLES[name].keys)
    past = store(spark, root, name)
    stored = past.last_batch()
    if stored is not None and batch not in (stored, stored + 1):
        raise ValueError(f"{name}: batch {batch} cannot follow batch {stored} under {root}")
    if once and not partial:
        raise ValueError("only rows of partial batches can be rows of their own")
    checks = table_rules(name)
    with scope(spark):
        met = _met_before(raw, checks, root, name, batch) if once else {}
        values = {c: rows.select(c).distinct() for c, rows in met.items()}
        result = quality.split(raw, checks, keys, policy=policy, known=values)
        detail, gone = result.detail, None
        if once:
            late, gone = _turned_out(met, checks, keys, raw.columns)
            detail = detail.unionByName(late).dropDuplicates()
        # Balanced by rule: few files per folder, and a rule that rejects much is split.
        write_table(
            detail.hint("rebalance", "rule_id"),
            "parquet",
            rejects_path(root, name, batch),
            "overwrite",
            "rule_id",
        )
        write_table(result.metrics, "parquet", metrics_path(root, name, batch), "overwrite")
        counts = Observation(f"{name}-{batch}")
        snapshot = cast_by_name(result.observed_clean(counts), SCHEMAS[name])
        held = result.bad.select(*keys) if hold_rejected and batch > 0 else None
        past.apply(
            batch, snapshot, as_of, held_keys=held, gone_keys=gone, partial=partial, keep=keep
        )
        rejects = read_rejects(spark, root, name, batch)
        bad = rejects.select(*[c for c in raw.columns if c in rejects.columns]).distinct()
        audit = bad.agg(
            F.lit(counts.get["raw_rows"]).alias("raw_rows"),
            F.lit(counts.get["clean_rows"]).alias("clean_rows"),
            F.count(F.lit(1)).alias("bad_rows"),
        )
        write_table(audit, "parquet", audit_path(root, name, batch), "overwrite")
    return past.read_current(batch)


def _met_before(
    raw: DataFrame, checks: list[quality.Rule], root: str, name: str, batch: int
) -> dict[str, DataFrame]:
    """By each column under a duplicate check, the earlier rows that share a value with the
    batch; the rows of the batch are kept for later ones."""
    columns = {c for r in checks if r.check_type == DUPLICATE for c in r.columns}
    met = {}
    for column in sorted(columns.intersection(raw.columns)):
        path = f"{history_path(root, name)}/delivered/{column}"
        log = Deliveries(raw.sparkSession, path, column, raw.schema)
        met[column] = log.met(batch, raw)
        log.add(batch, raw)
    return met


def _turned_out(
    met: Mapping[str, DataFrame],
    checks: list[quality.Rule],
    keys: list[str],
    columns: list[str],
) -> tuple[DataFrame, DataFrame]:
    """Why earlier rows are rejected now, and the keys of these rows; staged.

    Rows that shared their value with another before were rejected then.
    """
    details = []
    for column, rows in met.items():
        rules_of = [r for r in checks if r.check_type == DUPLICATE and column in r.columns]
        single = rows.groupBy(column).agg(F.count(F.lit(1)).alias("_n")).filter("_n = 1")
        fresh = rows.join(single.select(column), column, "left_semi").select(*columns)
        why = [
            F.struct(
                F.lit(r.rule_id).alias("rule_id"),
                F.lit(r.check_type).alias("check_type"),
                F.lit(r.description).alias("check_description"),
                F.lit(column).alias("failed_column"),
            )
            for r in rules_of
        ]
        details.append(fresh.select(*columns, F.inline(F.array(*why))))
    detail = details[0]
    for more in details[1:]:
        detail = detail.unionByName(more)
    detail = stage(detail, "turned-out")
    return detail, stage(detail.select(*keys).distinct(), "gone-keys")


def process(
    name: str,
    current: DataFrame,
    root: str,
    batch: int,
    as_of: str | datetime,
    fmt: str = "parquet",
) -> None:
    """Clean the current slice of a table and write the processed table(s), as CSV if wanted."""
    rows = current.drop(*history.META)
    for target, df in TABLES[name].clean(rows, as_of).items():
        write_table(df, fmt, processed_path(root, target, batch), "overwrite")


def read_processed(
    spark: SparkSession, root: str, name: str, batch: int, fmt: str = "parquet"
) -> DataFrame:
    """A processed table; CSV has no types, so it gets those of the table's columns."""
    path = processed_path(root, name, batch)
    return spark.read.parquet(path) if fmt == "parquet" else read_logical(spark, name, path, fmt)


def grade(
    spark: SparkSession,
    root: str,
    batch: int,
    params: scoring.ScoreParams = scoring.DEFAULT_PARAMS,
    grain: str = "member",
    fmt: str = "parquet",
) -> DataFrame:
    """Score the processed tables of a batch and write the graded loans."""

    def processed(name: str) -> DataFrame:
        return read_processed(spark, root, name, batch, fmt)

    graded = scoring.score(
        processed("loan_repayment"),
        processed("loans"),
        processed("members"),
        processed("defaulter_details"),
        processed("delinq_details"),
        params,
        grain,
    )
    write_table(graded, "parquet", curated_path(root, batch), "overwrite")
    return spark.read.parquet(curated_path(root, batch))


def bucket_scoring_tables(
    tables: Mapping[str, DataFrame],
    path: str,
    prefix: str,
    buckets: int,
    params: scoring.ScoreParams = scoring.DEFAULT_PARAMS,
) -> dict[str, str]:
    """Write what scoring joins in buckets by member; returns the names of the tables.

    ``tables`` are the processed ones. Loans meet their repayment here, once. Scoring the
    written tables (``scoring.points_of``) then shuffles nothing, however often it is done.
    """
    scored = {
        "payments": scoring.payment_history(tables["loan_repayment"], tables["loans"], params),
        **{n: tables[n] for n in ("members", "defaulter_details", "delinq_details")},
    }
    names = {}
    for name, df in scored.items():
        names[name] = f"{prefix}_{name}"
        write_bucketed(df, names[name], f"{path}/{name}", ["member_id"], buckets)
    return names


def grades_store(spark: SparkSession, root: str, graded: DataFrame) -> Store:
    """The history of grades, one for each member."""
    record = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in graded.schema.fields)
    return Store(spark, history_path(root, "grades"), record, ("member_id",))


def distribution_path(root: str, batch: int) -> str:
    return f"{root}/distribution/batch={batch}"


def regrade(
    spark: SparkSession,
    root: str,
    batch: int,
    as_of: str | datetime,
    params: scoring.ScoreParams = scoring.DEFAULT_PARAMS,
) -> DataFrame:
    """The distribution of grades after a batch, from what the batch changed.

    Members of whom no record changed keep their grade. The others are scored again, and their
    old and new letters are taken from the last distribution and added to it. Batch 0 scores
    all members. Every table must have been ingested up to this batch.
    """
    with scope(spark):
        touched = None if batch == 0 else _touched_members(spark, root, batch)
        rows = {}
        for name in TABLES:
            now = store(spark, root, name).read_current(batch).drop(*history.META)
            if touched is not None and "member_id" in now.columns:
                now = now.join(touched, "member_id", "left_semi")
            rows[name] = now
        if touched is not None:  # repayments name their loan
            rows["loan_repayment"] = rows["loan_repayment"].join(
                rows["loans"].select("id"), "id", "left_semi"
            )
        tidy = {}
        for name, job in TABLES.items():
            tidy.update(job.clean(rows[name], as_of))
        graded = scoring.score(
            tidy["loan_repayment"],
            tidy["loans"],
            tidy["members"],
            tidy["defaulter_details"],
            tidy["delinq_details"],
            params,
        )
        grades = grades_store(spark, root, graded)
        grades.apply(batch, graded, as_of, gone_keys=touched, partial=touched is not None)
    if touched is None:
        counts = scoring.distribution(grades.read_current(0))
    else:
        before = spark.read.parquet(distribution_path(root, batch - 1))
        counts = scoring.moved_distribution(before, grades.read_changes(batch))
    write_table(counts.coalesce(1), "parquet", distribution_path(root, batch), "overwrite")
    return spark.read.parquet(distribution_path(root, batch))


def _touched_members(spark: SparkSession, root: str, batch: int) -> DataFrame:
    """Members of whom a batch changed any record; staged."""
    changed = {name: store(spark, root, name).read_changes(batch) for name in TABLES}
    paid = changed["loan_repayment"].select("id").distinct()
    loans = store(spark, root, "loans").read_current(batch)
    touched = loans.join(paid, "id", "left_semi").select("member_id")
    for name in ("members", "loans", "loan_defaulters"):
        touched = touched.unionByName(changed[name].select("member_id"))
    return stage(touched.filter("member_id is not null").distinct(), "touched-members")


def run_batch(
    spark: SparkSession,
    raw: Mapping[str, DataFrame],
    root: str,
    batch: int,
    as_of: str | datetime,
    params: scoring.ScoreParams = scoring.DEFAULT_PARAMS,
    hold_rejected: bool = False,
    policy: KeyedPolicy = DEFAULT_POLICY,
) -> DataFrame:
    """One batch over all four tables; returns the graded loans.

    The tables do not depend on each other until they are scored, so their jobs are
    submitted side by side and fill each other's idle task slots.
    """

    def prepare(name: str) -> None:
        current = ingest(name, raw[name], root, batch, as_of, hold_rejected, policy=policy)
        process(name, current, root, batch, as_of)

    with ThreadPoolExecutor(len(TABLES)) as pool:
        for done in [pool.submit(prepare, name) for name in TABLES]:
            done.result()
    return grade(spark, root, batch, params)
