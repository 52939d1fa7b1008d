"""Data-quality checks: flag rows, split a table into clean and bad, explain, measure."""

from __future__ import annotations

import json
from collections import defaultdict
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import cached_property, reduce
from operator import or_
from typing import Any

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from creditloom.functions.checks import ALLOWED, CALCULATION, DUPLICATE, LABELS, ROW_CHECKS
from creditloom.operators.keyed import (
    DEFAULT_POLICY,
    ROWS,
    KeyedPolicy,
    flag_rows,
    has_key,
    key_facts,
    repeated_keys,
)

DETAIL_COLUMNS = ("rule_id", "check_type", "check_description", "failed_column")
FAILS = "_fails"
TEXT_NUMBER = "decimal(38,18)"


@dataclass(frozen=True)
class Rule:
    """One check over one or more columns of one or more tables."""

    rule_id: str
    check_type: str
    columns: tuple[str, ...]
    description: str = ""
    threshold: float | None = None
    tables: tuple[str, ...] = ()
    params: Mapping[str, Any] = field(default_factory=dict)

    def __post_init__(self) -> None:
        if self.check_type not in LABELS:
            raise ValueError(f"unknown check type: {self.check_type}")
        object.__setattr__(self, "columns", tuple(c.strip() for c in self.columns))

    def predicate(self, column: str, schema: T.StructType) -> Column:
        """True where a value of ``column`` fails; not for duplicate checks."""
        params = dict(self.params)
        if self.check_type == CALCULATION:
            terms = [column, *params.get("dependent_columns", ())]
            absent = [c for c in terms if c not in schema.names]
            if absent:
                raise ValueError(f"{self.rule_id}: no such columns: {absent}")
            if any(isinstance(schema[c].dataType, T.StringType) for c in terms):
                params.setdefault("read_as", TEXT_NUMBER)
        return ROW_CHECKS[self.check_type](column, **params)


def parse_rules(entries: Iterable[Mapping[str, Any]]) -> list[Rule]:
    """Rules from decoded JSON objects; keys without a field of their own are params."""
    rules = []
    for entry in entries:
        rest = dict(entry)
        rules.append(
            Rule(
                rule_id=rest.pop("rule_id", ""),
                check_type=rest.pop("type"),
                columns=tuple(rest.pop("columns", ())),
                description=rest.pop("check", ""),
                threshold=rest.pop("threshold", None),
                tables=tuple(rest.pop("tables", ())),
                params=rest,
            )
        )
    return rules


def load_rules(path: str) -> list[Rule]:
    """Rules from a JSON file holding a list of rule objects."""
    with open(path, encoding="utf-8") as handle:
        return parse_rules(json.load(handle))


def rules_by_table(rules: Iterable[Rule]) -> dict[str, list[Rule]]:
    out: dict[str, list[Rule]] = defaultdict(list)
    for rule in rules:
        for table in rule.tables:
            out[table].append(rule)
    return dict(out)


def applicable(
    df: DataFrame, rules: Iterable[Rule], strict: bool = False
) -> tuple[list[tuple[Rule, str]], list[tuple[str, str]]]:
    """(rule, column) pairs the table has, and the (rule id, column) pairs it lacks."""
    present = set(df.columns)
    usable, skipped = [], []
    for rule in rules:
        for column in rule.columns:
            if column in present:
                usable.append((rule, column))
            else:
                skipped.append((rule.rule_id, column))
    if strict and skipped:
        raise ValueError(f"rules name columns the table does not have: {skipped}")
    return usable, skipped


@dataclass(frozen=True)
class _Checked:
    """A table whose every check is available as a row predicate."""

    df: DataFrame
    columns: list[str]
    checks: list[tuple[Rule, str, Column]]

    @property
    def failed(self) -> Column:
        if not self.checks:
            return F.lit(False)
        return reduce(or_, [F.coalesce(p, F.lit(False)) for _, _, p in self.checks])

    @property
    def fails(self) -> Column:
        """Array of one struct per failed check."""
        marks = [
            F.when(
                predicate,
                F.struct(
                    F.lit(rule.rule_id).alias("rule_id"),
                    F.lit(rule.check_type).alias("check_type"),
                    F.lit(rule.description).alias("check_description"),
                    F.lit(column).alias("failed_column"),
                ),
            )
            for rule, column, predicate in self.checks
        ]
        if not marks:
            kind = ", ".join(f"{name}: string" for name in DETAIL_COLUMNS)
            return F.array().cast(f"array<struct<{kind}>>")
        return F.array_compact(F.array(*marks))


def _check(
    df: DataFrame,
    rules: Iterable[Rule],
    strict: bool = False,
    policy: KeyedPolicy = DEFAULT_POLICY,
    known: Mapping[str, DataFrame] | None = None,
) -> _Checked:
    nested = [f.name for f in df.schema.fields if isinstance(f.dataType, T.MapType)]
    if nested:
        raise ValueError(f"map columns cannot be compared for distinct rows: {nested}")
    usable, _ = applicable(df, rules, strict)
    out, predicates = _row_predicates(df, usable, policy)
    flags = {}
    for n, (rule, column) in enumerate(usable):
        if rule.check_type != DUPLICATE:
            continue
        if column not in flags:
            flags[column] = f"_repeated_{len(flags)}"
            repeated = repeated_keys(df, [column])
            if known and column in known:
                # Each of these values is one that this table repeats.
                earlier = known[column].select(column).join(key_facts(df, [column]), column)
                repeated = repeated.unionByName(earlier).groupBy(column).agg(F.max(ROWS).alias(ROWS))
            out = flag_rows(out, repeated, [column], flags[column], policy)
        predicates[n] = F.col(flags[column])
    checks = [(rule, column, predicates[n]) for n, (rule, column) in enumerate(usable)]
    return _Checked(out, df.columns, checks)


def _row_predicates(
    df: DataFrame, usable: list[tuple[Rule, str]], policy: KeyedPolicy = DEFAULT_POLICY
) -> tuple[DataFrame, dict[int, Column]]:
    """Predicates of the row checks by position, and the table they apply to.

    Allowed values come as a list, which is one expression whatever its length, or as a
    table of one column, which may be large. The table is read as the checked column's type
    and met by key; as with a list, a null in it means that nothing fails.
    """
    out, predicates = df, {}
    for n, (rule, column) in enumerate(usable):
        values = rule.params.get("allowed_values", ())
        if rule.check_type == DUPLICATE:
            continue
        if rule.check_type == ALLOWED and isinstance(values, DataFrame):
            flag, kind = f"_known_{n}", df.schema[column].dataType
            listed = values.select(F.col(values.columns[0]).try_cast(kind).alias(column))
            out = flag_rows(out, key_facts(listed, [column]), [column], flag, policy)
            nulls = values.agg(F.count_if(F.col(values.columns[0]).isNull())).scalar()
            predicates[n] = F.col(column).isNotNull() & ~F.col(flag) & (nulls == 0)
        else:
            predicates[n] = rule.predicate(column, df.schema)
    return out, predicates


def annotate(
    df: DataFrame,
    rules: Iterable[Rule],
    strict: bool = False,
    policy: KeyedPolicy = DEFAULT_POLICY,
) -> DataFrame:
    """Add ``_fails``: an array with one struct for every check the row fails."""
    checked = _check(df, rules, strict, policy)
    return checked.df.select(*checked.columns, checked.fails.alias(FAILS))


def _bad(checked: _Checked) -> DataFrame:
    return checked.df.filter(checked.failed).select(*checked.columns).dropDuplicates()


def _details(checked: _Checked) -> DataFrame:
    # Equal rows fail alike, so each distinct row travels once, whatever it fails.
    bad = checked.df.filter(checked.failed).select(*checked.columns, checked.fails.alias(FAILS))
    distinct = bad.dropDuplicates(checked.columns)
    return distinct.select(*checked.columns, F.inline(F.array_distinct(FAILS)))


def failed_rows(
    df: DataFrame, rule: Rule, policy: KeyedPolicy = DEFAULT_POLICY
) -> DataFrame:
    """Distinct rows failing one rule in at least one of its columns."""
    return _bad(_check(df, [rule], policy=policy))


def bad_rows(
    df: DataFrame, rules: Iterable[Rule], policy: KeyedPolicy = DEFAULT_POLICY
) -> DataFrame:
    """Distinct rows failing any rule; a row failing many appears once."""
    return _bad(_check(df, rules, policy=policy))


def failure_details(
    df: DataFrame, rules: Iterable[Rule], policy: KeyedPolicy = DEFAULT_POLICY
) -> DataFrame:
    """One row per distinct bad row and failed check, saying which check and column."""
    return _details(_check(df, rules, policy=policy))


def repeated_rows(
    df: DataFrame, keys: Sequence[str], policy: KeyedPolicy = DEFAULT_POLICY
) -> DataFrame:
    """All rows whose (possibly composite) key occurs more than once."""
    flagged = flag_rows(df, repeated_keys(df, keys), keys, "_repeated", policy)
    return flagged.filter("_repeated").drop("_repeated")


class DqResult:
    """Outcome of :func:`split`; each part is planned when first asked for."""

    def __init__(
        self,
        df: DataFrame,
        rules: list[Rule],
        checked: _Checked,
        clean: DataFrame,
        judged: tuple[DataFrame, Column] | None,
    ) -> None:
        self._df, self._rules, self._checked = df, rules, checked
        self.clean, self._judged = clean, judged

    @cached_property
    def bad(self) -> DataFrame:
        return _bad(self._checked)

    @cached_property
    def detail(self) -> DataFrame:
        return _details(self._checked)

    @cached_property
    def metrics(self) -> DataFrame:
        return metrics(self._df, self._rules)

    @cached_property
    def audit(self) -> DataFrame:
        if self._judged is None:
            return audit(self._df, self.clean, self.bad)
        # One pass: bad rows are told apart in the same aggregation, after a partial one.
        rows, keep = self._judged
        bad = F.when(self._checked.failed, F.struct(*self._checked.columns))
        return rows.agg(
            F.count(F.lit(1)).alias("raw_rows"),
            F.count_if(keep).alias("clean_rows"),
            F.count_distinct(bad).alias("bad_rows"),
        )

    def observed_clean(self, observation: Observation) -> DataFrame:
        """``clean``, counting ``raw_rows`` and ``clean_rows`` where its rows are written.

        Write it without a shuffle behind: then a task counts when it has written its rows, and
        one that is tried again does not count twice.
        """
        if self._judged is None:
            raise ValueError("only a keyed or plain split tells its rows apart in one pass")
        rows, keep = self._judged
        marked = rows.select(*self._checked.columns, keep.alias("_keep"))
        counted = marked.observe(
            observation,
            F.count(F.lit(1)).alias("raw_rows"),
            F.count_if("_keep").alias("clean_rows"),
        )
        return counted.filter("_keep").drop("_keep")

    @cached_property
    def skipped(self) -> list[tuple[str, str]]:
        """(rule id, column) pairs the table has no column for."""
        return applicable(self._df, self._rules)[1]


def split(
    df: DataFrame,
    rules: Iterable[Rule],
    keys: Sequence[str] | None = None,
    compat: bool = False,
    strict: bool = False,
    policy: KeyedPolicy = DEFAULT_POLICY,
    known: Mapping[str, DataFrame] | None = None,
) -> DqResult:
    """Separate clean from bad rows.

    Without ``keys`` a row is clean when it fails no check. With ``keys`` it must
    also share its key with no bad row; a row lacking a key shares it with none, so
    it is judged by itself.

    ``compat`` follows the older conventions: a keyed split keeps every row that
    lacks a key, and an unkeyed split removes only one copy of each bad row.

    ``known`` holds, by column, values that rows outside ``df`` have: under a duplicate check a
    row that has one of them fails.
    """
    rules = list(rules)
    checked = _check(df, rules, strict, policy, known)
    if compat and not keys:
        return DqResult(df, rules, checked, _clean_minus_one_copy(checked), None)
    judged = _judged_by_key(checked, list(keys), compat, policy) if keys else (
        checked.df, ~checked.failed
    )
    rows, keep = judged
    return DqResult(df, rules, checked, rows.filter(keep).select(*checked.columns), judged)


def _judged_by_key(
    checked: _Checked, keys: list[str], compat: bool, policy: KeyedPolicy
) -> tuple[DataFrame, Column]:
    """The checked rows, and which of them stay."""
    failed = checked.failed
    rows = checked.df
    # When the key itself is under a duplicate check, every row of a shared key is bad
    # already and no good row can be left to reject.
    unshared = any(rule.check_type == DUPLICATE and [c] == keys for rule, c, _ in checked.checks)
    if not unshared and checked.checks:
        mixed = (
            key_facts(rows, keys, F.count_if(failed).alias("_bad"))
            .filter((F.col("_bad") > 0) & (F.col("_bad") < F.col(ROWS)))
        )
        rows = flag_rows(rows, mixed, keys, "_shared", policy)
        failed = failed | F.col("_shared")
    keep = ~failed
    if compat:
        keep = keep | ~has_key(keys)
    return rows, keep


COPIES_PER_TASK = 100_000


def _clean_minus_one_copy(checked: _Checked) -> DataFrame:
    """Good rows, and all but one copy of each bad row.

    Only bad rows are grouped. The surplus copies of a row are produced in chunks
    spread over the tasks, so a row with very many copies does not burden one.
    """
    columns = checked.columns
    good = checked.df.filter(~checked.failed).select(*columns)
    surplus = (
        checked.df.filter(checked.failed)
        .groupBy(*columns)
        .agg((F.count(F.lit(1)) - 1).alias("_left"))
        .filter("_left > 0")
        .withColumn("_first", F.explode(F.sequence(F.lit(0), F.col("_left") - 1, F.lit(COPIES_PER_TASK))))
        .repartition(*columns, "_first")
        .withColumn("_size", F.least(F.lit(COPIES_PER_TASK), F.col("_left") - F.col("_first")))
        .withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_size"))))
        .select(*columns)
    )
    return good.unionByName(surplus)


def audit(raw: DataFrame, clean: DataFrame, bad: DataFrame) -> DataFrame:
    """One row: ``raw_rows``, ``clean_rows`` and (distinct) ``bad_rows``."""

    def rows(df: DataFrame) -> Column:
        return df.agg(F.count(F.lit(1))).scalar()

    return raw.sparkSession.range(1).select(
        rows(raw).alias("raw_rows"), rows(clean).alias("clean_rows"), rows(bad).alias("bad_rows")
    )


def metrics(df: DataFrame, rules: Iterable[Rule]) -> DataFrame:
    """One row per rule and column with its failure count, share and verdict.

    All row checks share one aggregation pass. A duplicate check counts repeated
    *keys* (the null key too) and takes one thin aggregation per column.
    """
    usable, _ = applicable(df, rules)
    row_checks = [(r, c) for r, c in usable if r.check_type != DUPLICATE]
    key_checks = [(r, c) for r, c in usable if r.check_type == DUPLICATE]

    def report(totals: DataFrame, pairs: list[tuple[Rule, str]]) -> DataFrame:
        lines = F.array(
            *[
                F.struct(
                    F.lit(r.rule_id).alias("rule_id"),
                    F.lit(r.check_type).alias("check_type"),
                    F.lit(c).alias("field"),
                    F.lit(LABELS[r.check_type]).alias("check"),
                    F.lit(r.threshold).cast("double").alias("threshold"),
                    F.col(f"_failed_{i}").alias("failed_rows"),
                )
                for i, (r, c) in enumerate(pairs)
            ]
        )
        return totals.select("total_rows", F.inline(lines))

    parts = []
    if row_checks:
        rows, predicates = _row_predicates(df, row_checks)
        counts = [F.count_if(p).alias(f"_failed_{i}") for i, p in predicates.items()]
        parts.append(
            report(rows.agg(F.count(F.lit(1)).alias("total_rows"), *counts), row_checks)
        )
    for pair in key_checks:
        per_key = df.groupBy(pair[1]).agg(F.count(F.lit(1)).alias(ROWS))
        totals = per_key.agg(
            F.coalesce(F.sum(ROWS), F.lit(0)).alias("total_rows"),
            F.count_if(F.col(ROWS) > 1).alias("_failed_0"),
        )
        parts.append(report(totals, [pair]))
    if not parts:
        empty = (
            "rule_id string, check_type string, field string, check string, total_rows bigint, "
            "failed_rows bigint, percentage double, threshold double, passed boolean"
        )
        return df.sparkSession.createDataFrame([], empty)
    share = F.when(
        F.col("total_rows") > 0, F.col("failed_rows") / F.col("total_rows")
    ).otherwise(F.lit(0.0))
    return (
        reduce(DataFrame.unionByName, parts)
        .withColumn("percentage", share)
        .withColumn("passed", (F.lit(1.0) - F.col("percentage")) >= F.col("threshold"))
        .select(
            "rule_id", "check_type", "field", "check", "total_rows", "failed_rows",
            "percentage", "threshold", "passed",
        )
    )


def measure(df: DataFrame, check_type: str, column: str, **params: Any) -> dict[str, Any]:
    """Run one check on one column now; the counts as a dictionary."""
    rule = Rule("", check_type, (column,), params=params)
    wanted = ("field", "check", "total_rows", "failed_rows", "percentage")
    line = metrics(df, [rule]).select(*wanted).first()
    if line is None:
        raise ValueError(f"no column {column!r} in the table")
    return line.asDict()
