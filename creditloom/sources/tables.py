"""Generic table input and output, format presets and the schemas of the loan tables."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Reader options per format. ``json`` reads documents that span lines
# (one file is then one task); ``jsonl`` reads one object per line and splits.
PRESETS: dict[str, dict[str, str]] = {
    "csv": {"header": "true", "inferSchema": "false"},
    "json": {"multiLine": "true"},
    "jsonl": {"multiLine": "false"},
    "parquet": {"mergeSchema": "true"},
    "delta": {},
}

# Columns of the tables in file order. Money is decimal, so that sums
# compare exactly.
SCHEMAS: dict[str, str] = {
    "members": """
        member_id string, emp_title string, emp_length string, home_ownership string,
        annual_income decimal(18,2), address_state string, zip_code string,
        address_country string, grade string, sub_grade string,
        verification_status string, total_high_credit_limit decimal(18,2),
        application_type string, join_annual_income decimal(18,2),
        verification_status_joint string""",
    "loans": """
        id string, member_id string, loan_amount decimal(18,2),
        funded_amount decimal(18,2), term string, interest_rate double,
        installment decimal(18,2), issue_month_year string, loan_status string,
        purpose string, title string""",
    "loan_repayment": """
        id string, total_principal_received decimal(18,2),
        total_interest_received decimal(18,2), total_late_fee_received decimal(18,2),
        total_payment decimal(18,2), last_payment_amount decimal(18,2),
        last_payment_date string, next_payment_date string""",
    "loan_defaulters": """
        member_id string, delinq_2_years string, delinq_amount decimal(18,2),
        public_record string, public_record_bankruptcies string,
        inquiry_last_6_months string, total_rec_late_fee string,
        months_since_last_delinq string, months_since_last_record string""",
    "delinq_details": """
        member_id string, delinq_2_years int, delinq_amount decimal(18,2),
        months_since_last_delinq int""",
    "defaulter_details": """
        member_id string, public_record int, public_record_bankruptcies int,
        months_since_last_record int, inquiry_last_6_months int""",
}


def read_options(fmt: str) -> dict[str, str]:
    """Reader options of a format; ValueError for one that has none."""
    if fmt not in PRESETS:
        raise ValueError(f"unsupported format: {fmt}")
    return dict(PRESETS[fmt])


def as_schema(schema: str | T.StructType) -> T.StructType:
    return schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)


def read_table(
    spark: SparkSession,
    fmt: str,
    path: str,
    schema: str | T.StructType | None = None,
    options: Mapping[str, str] | None = None,
    positional: bool = False,
    rescued: str | None = None,
) -> DataFrame:
    """Read any Spark format.

    CSV with a schema: the header names the columns, every field is scanned as text
    and cast by name, and a malformed field becomes null. ``positional`` binds the
    schema by column order instead and takes every line, a header too, as data.

    ``rescued`` names a column for what a read of CSV or JSON by name and type cannot hold: a map
    from field names to the text of values that became null, null where all was well. A line
    of another shape than the header, or one that is no JSON, is there as a whole
    under ``LINE``.
    """
    chosen = dict(options or {})
    if rescued is not None:
        return _read_rescued(spark, fmt, path, schema, chosen, rescued)
    reader = spark.read.format("json" if fmt == "jsonl" else fmt)
    if fmt == "csv" and schema is not None:
        if not positional:
            chosen["header"] = "true"
            return cast_by_name(reader.options(**chosen).load(path), schema)
        chosen["header"] = "false"
    if schema is not None:
        reader = reader.schema(as_schema(schema))
    return reader.options(**chosen).load(path)


LINE = "_line"
"""Under this name a whole line is rescued; no field of the input may be called so."""


def _read_rescued(
    spark: SparkSession,
    fmt: str,
    path: str,
    schema: str | T.StructType | None,
    options: dict[str, str],
    rescued: str,
) -> DataFrame:
    if schema is None or fmt not in ("csv", "json", "jsonl"):
        raise ValueError("only typed reads of csv and json can rescue fields")
    if fmt == "csv":
        # Fields are named by the header of the files, which may order them otherwise.
        options["header"] = "true"
        names = spark.read.format("csv").options(**options).load(path).columns
    else:
        names = [f.name for f in as_schema(schema).fields]
    text = T.StructType([T.StructField(n, T.StringType()) for n in (*names, LINE)])
    options["columnNameOfCorruptRecord"] = LINE
    reader = spark.read.format("csv" if fmt == "csv" else "json").schema(text)
    return cast_by_name(reader.options(**options).load(path), schema, rescued)


def cast_by_name(
    df: DataFrame, schema: str | T.StructType, rescued: str | None = None
) -> DataFrame:
    """Select the columns of a schema by name; values that do not fit become null.

    Their text is kept by name in the map ``rescued``, if such a column is named, together
    with the ``LINE`` that could not be read, if there is one.
    """
    fields = as_schema(schema).fields
    absent = [f.name for f in fields if f.name not in df.columns]
    if absent:
        raise ValueError(f"columns missing from the input: {absent}")
    typed = [F.col(f.name).try_cast(f.dataType).alias(f.name) for f in fields]
    if rescued is None:
        return df.select(*typed)

    def lost(name: str, gone: Column) -> Column:
        return F.when(
            gone, F.struct(F.lit(name).alias("name"), F.col(name).cast("string").alias("text"))
        )

    found = [
        lost(f.name, F.col(f.name).isNotNull() & F.col(f.name).try_cast(f.dataType).isNull())
        for f in fields
    ]
    if LINE in df.columns:
        found.append(lost(LINE, F.col(LINE).isNotNull()))
    entries = F.array_compact(F.array(*found))
    kept = F.when(F.size(entries) > 0, F.map_from_entries(entries))
    return df.select(*typed, kept.alias(rescued))


def read_logical(
    spark: SparkSession, name: str, path: str, fmt: str = "parquet"
) -> DataFrame:
    """One of the loan tables with its declared types, bound by column name.

    The types are known, so no file's footer is read before the scan; a column that a file lacks is
    null in its rows.
    """
    return read_table(spark, fmt, path, SCHEMAS[name], read_options(fmt))


def read_members(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return read_logical(spark, "members", path, fmt)


def read_loans(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return read_logical(spark, "loans", path, fmt)


def read_loan_repayment(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return read_logical(spark, "loan_repayment", path, fmt)


def read_delinquencies(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return read_logical(spark, "delinq_details", path, fmt)


def read_defaulters(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return read_logical(spark, "defaulter_details", path, fmt)


def register_views(tables: Mapping[str, DataFrame]) -> None:
    """Make tables available to SQL under the given names."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)


MODES = ("overwrite", "append", "ignore", "error")


def write_bucketed(
    df: DataFrame, table: str, path: str, columns: Sequence[str], buckets: int
) -> None:
    """Write a catalogue table in sorted buckets, so that joins on ``columns`` need no shuffle.

    Tables that are joined must have the same number of buckets. An earlier table of the name
    is replaced.
    """
    by = list(columns)
    dealt = df.repartition(buckets, *by)  # one file a bucket
    writer = dealt.write.mode("overwrite").format("parquet").option("path", path)
    writer.bucketBy(buckets, *by).sortBy(*by).saveAsTable(table)


def write_table(
    df: DataFrame,
    fmt: str,
    path: str,
    mode: str = "error",
    partition_by: Sequence[str] | str | None = None,
    options: Mapping[str, str] | None = None,
) -> None:
    """Write any Spark format; CSV gets a header line, Delta may gain columns."""
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, not {mode!r}")
    chosen = {"csv": {"header": "true"}, "delta": {"mergeSchema": "true"}}.get(fmt, {})
    writer = df.write.format("json" if fmt == "jsonl" else fmt).mode(mode)
    writer = writer.options(**{**chosen, **(options or {})})
    if partition_by:
        columns: Iterable[str] = [partition_by] if isinstance(partition_by, str) else partition_by
        writer = writer.partitionBy(*columns)
    writer.save(path)
