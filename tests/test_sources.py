from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from creditloom.plans import catalog
from creditloom.sources import schemas, staging, tables
from creditloom.sources.staging import stage_path


@pytest.fixture
def people(spark):
    return spark.createDataFrame([("jack", 20), ("john", 30)], "name string, age int")


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_csv_by_position(spark, people, tmp_path):
    people.write.csv(f"{tmp_path}/c")
    got = tables.read_table(
        spark, "csv", f"{tmp_path}/c", people.schema, tables.read_options("csv"), positional=True
    )
    assert got.schema == people.schema
    assert rows(got) == rows(people)


def test_csv_by_name(spark, people, tmp_path):
    tables.write_table(people, "csv", f"{tmp_path}/c")
    got = tables.read_table(spark, "csv", f"{tmp_path}/c", "age int, name string")
    assert got.columns == ["age", "name"]
    assert rows(got) == [(20, "jack"), (30, "john")]
    with pytest.raises(ValueError, match="columns missing"):
        tables.read_table(spark, "csv", f"{tmp_path}/c", "nope int")


def test_csv_by_position_takes_the_header_as_data(spark, people, tmp_path):
    tables.write_table(people, "csv", f"{tmp_path}/c")
    got = tables.read_table(spark, "csv", f"{tmp_path}/c", "name string, age int", positional=True)
    assert ("name", None) in [tuple(r) for r in got.collect()]


def test_csv_without_schema(spark, people, tmp_path):
    tables.write_table(people, "csv", f"{tmp_path}/c")
    got = tables.read_table(spark, "csv", f"{tmp_path}/c", options=tables.read_options("csv"))
    assert got.dtypes == [("name", "string"), ("age", "string")]


def test_csv_reads_only_wanted_columns(spark, people, tmp_path):
    tables.write_table(people, "csv", f"{tmp_path}/c")
    got = tables.read_table(spark, "csv", f"{tmp_path}/c", "name string, age int").select("age")
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<age:string>" in plan


def test_json(spark, tmp_path):
    (tmp_path / "many.json").write_text(json.dumps([{"a": 1}, {"a": 2}], indent=2))
    got = tables.read_table(spark, "json", f"{tmp_path}/many.json", "a int", tables.read_options("json"))
    assert rows(got) == [(1,), (2,)]
    tables.write_table(got, "jsonl", f"{tmp_path}/lines")
    back = tables.read_table(spark, "jsonl", f"{tmp_path}/lines", "a int", tables.read_options("jsonl"))
    assert rows(back) == [(1,), (2,)]


def test_presets():
    assert tables.read_options("csv") == {"header": "true", "inferSchema": "false"}
    assert tables.read_options("parquet") == {"mergeSchema": "true"}
    assert tables.read_options("delta") == {}
    with pytest.raises(ValueError, match="unsupported format: xml"):
        tables.read_options("xml")
    tables.read_options("csv")["header"] = "false"
    assert tables.PRESETS["csv"]["header"] == "true"


def test_modes(spark, people, tmp_path):
    path = f"{tmp_path}/p"
    tables.write_table(people, "parquet", path)
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        tables.write_table(people, "parquet", path, "error")
    tables.write_table(people, "parquet", path, "ignore")
    assert spark.read.parquet(path).count() == 2
    tables.write_table(people, "parquet", path, "append")
    assert spark.read.parquet(path).count() == 4
    tables.write_table(people, "parquet", path, "overwrite")
    assert spark.read.parquet(path).count() == 2
    with pytest.raises(ValueError, match="mode"):
        tables.write_table(people, "parquet", path, "upsert")


@pytest.mark.parametrize("by", ["name", ["name"]])
def test_partitions(spark, people, tmp_path, by):
    tables.write_table(people, "parquet", f"{tmp_path}/p", partition_by=by)
    got = spark.read.parquet(f"{tmp_path}/p").filter(F.col("name") == "jack")
    assert rows(got) == [(20, "jack")]
    assert "PartitionFilters: [isnotnull(name" in got._jdf.queryExecution().executedPlan().toString()


def test_views(spark, people):
    tables.register_views({"people": people})
    assert spark.sql("select max(age) from people").first()[0] == 30
    spark.catalog.dropTempView("people")


def test_staged_tables(spark, people):
    staged = staging.stage(people, "t")
    assert staged.schema == people.schema
    assert rows(staged) == rows(people)
    empty = staging.stage(people.filter("age > 99"), "t")
    assert empty.isEmpty() and empty.columns == people.columns


def test_stage_folder_follows_the_setting(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured is None:
        assert staging.stage_root(spark) == spark.sparkContext.getCheckpointDir()
    else:
        assert staging.stage_root(spark) == configured.rstrip("/")
    assert staging.stage_path(spark, "a") != staging.stage_path(spark, "a")


class FakeContext:
    def __init__(self, master):
        self.master, self.folder, self.applicationId = master, None, f"app-{master}"

    def getCheckpointDir(self):
        return self.folder


class FakeSession:
    def __init__(self, master, configured=None):
        self.sparkContext, self.conf = FakeContext(master), {"spark.checkpoint.dir": configured}


def test_stage_folder_when_nothing_is_set(monkeypatch, tmp_path):
    monkeypatch.setattr(staging.tempfile, "mkdtemp", lambda prefix: f"{tmp_path}/{prefix}1")
    assert staging.stage_root(FakeSession("local[2]")) == f"{tmp_path}/creditloom-1"
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        staging.stage_root(FakeSession("yarn"))
    assert staging.stage_root(FakeSession("yarn", "hdfs://shared/tmp/")) == "hdfs://shared/tmp"


def test_json_documents_bound_their_files(spark, monkeypatch):
    """The number of files follows the number of events, so none grows with the table."""
    paths = []

    def noted(*args):
        paths.append(stage_path(*args))
        return paths[-1]

    monkeypatch.setattr(catalog, "stage_path", noted)
    monkeypatch.setattr(catalog, "DOCUMENTS_A_FILE", 5, raising=False)
    catalog.json_documents(spark, "/root/testdata/sf0.001").collect()
    counts = spark.read.json(paths[0], multiLine=True).groupBy("file").count().collect()
    sizes = [r["count"] for r in counts]
    assert max(sizes) <= 5 * 5 and len(sizes) > 64


def test_rescued_fields_of_csv_and_json(spark, tmp_path):
    (tmp_path / "a.csv").write_text("n,id,day\n1.5,1,2024-01-01\n,2,yesterday\n7,3\n8,4,2024-01-02,x\n")
    schema = "id int, n int, day date"
    read = tables.read_table(spark, "csv", f"{tmp_path}/a.csv", schema, rescued="r").collect()
    got = {r.id: (r.n, str(r.day), r.r) for r in read}
    assert got[1] == (None, "2024-01-01", {"n": "1.5"})
    assert got[2] == (None, "None", {"day": "yesterday"})
    assert got[3] == (7, "None", {"_line": "7,3"})
    assert got[4] == (8, "2024-01-02", {"_line": "8,4,2024-01-02,x"})
    lines = ['{"id": 1, "n": "many", "day": null}', '{"id": 2, "n": {"a": 1}}', "{nonsense"]
    (tmp_path / "a.json").write_text("\n".join(lines))
    options = tables.read_options("jsonl")
    read = tables.read_table(spark, "jsonl", f"{tmp_path}/a.json", schema, options, rescued="r")
    got = [(r.id, r.n, r.r) for r in read.collect()]
    assert got == [
        (1, None, {"n": "many"}),
        (2, None, {"n": '{"a": 1}'}),
        (None, None, {"_line": "{nonsense"}),
    ]
    with pytest.raises(ValueError, match="typed"):
        tables.read_table(spark, "parquet", str(tmp_path), schema, rescued="r")


def test_typed_reads_start_no_job_for_footers(spark, tmp_path):
    columns = tables.SCHEMAS["delinq_details"]
    rows = spark.createDataFrame([("m1", 1, None, 2)], columns)
    rows.write.parquet(f"{tmp_path}/t")
    rows.drop("months_since_last_delinq").write.mode("append").parquet(f"{tmp_path}/t")
    group = "footers"
    spark.sparkContext.setJobGroup(group, "")
    read = tables.read_delinquencies(spark, f"{tmp_path}/t")
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup(group)
    assert sorted(r.months_since_last_delinq or 0 for r in read.collect()) == [0, 2]


@pytest.mark.parametrize(
    "old,new,want",
    [
        ("int", "bigint", "bigint"),
        ("bigint", "int", "bigint"),
        ("float", "double", "double"),
        ("decimal(10,2)", "decimal(12,4)", "decimal(12,4)"),
        ("decimal(10,2)", "bigint", "decimal(21,2)"),
        ("date", "timestamp_ntz", "timestamp_ntz"),
    ],
)
def test_types_are_widened(spark, old, new, want):
    both = schemas.reconcile(
        tables.as_schema(f"a {old}, b string"), tables.as_schema(f"a {new}, c int")
    )
    assert both.simpleString() == f"struct<a:{want},b:string,c:int>"


@pytest.mark.parametrize("old,new", [("int", "string"), ("boolean", "int"), ("bigint", "double")])
def test_types_without_a_common_one_are_refused(spark, old, new):
    with pytest.raises(ValueError, match="no common type"):
        schemas.reconcile(tables.as_schema(f"a {old}"), tables.as_schema(f"a {new}"))
