from __future__ import annotations

from creditloom.operators import history
from creditloom.plans import jobs
from creditloom.streaming.incremental import follow
from tests.test_jobs import loan, names

DAYS = ["2024-01-01 00:00:00", "2024-01-02 00:00:00", "2024-01-03 00:00:00"]


def drop_file(spark, folder, n, rows):
    columns = names("loans")
    df = spark.createDataFrame(
        [tuple(r.get(c) for c in columns) for r in rows], ", ".join(f"{c} string" for c in columns)
    )
    df.coalesce(1).write.json(f"{folder}/drop={n}")


def test_each_drop_becomes_a_batch(spark, tmp_path):
    drops, root, checkpoint = f"{tmp_path}/drops", f"{tmp_path}/root", f"{tmp_path}/checkpoint"
    schema = ", ".join(f"{c} string" for c in names("loans"))

    def run():
        stream = (
            spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(f"{drops}/*")
        )
        query = follow("loans", stream, root, checkpoint, lambda n: DAYS[n])
        query.awaitTermination(120)
        assert query.exception() is None

    drop_file(spark, drops, 0, [loan(1), loan(2), loan(3, purpose="yacht")])
    run()
    drop_file(spark, drops, 1, [loan(2, loan_status="Fully Paid"), loan(4)])
    run()
    run()  # nothing new arrived
    past = jobs.store(spark, root, "loans").read_history(1)
    assert sorted((r.id, r.loan_status, r.is_current) for r in past.collect()) == [
        ("l1", "Current", True), ("l2", "Current", False), ("l2", "Fully Paid", True), ("l4", "Current", True)
    ]
    assert history.as_of(past, DAYS[0]).count() == 2
    rejects = spark.read.parquet(jobs.rejects_path(root, "loans", 0)).collect()
    assert [(r.id, r.rule_id) for r in rejects] == [("l3", "R7")]
