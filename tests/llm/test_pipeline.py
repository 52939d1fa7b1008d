"""Each stage of the pipeline on the smallest documents, against plain Python."""

from __future__ import annotations

from collections import Counter

import corpus_pipeline
from creditloom.llm import mixing, toxicity
from tests.llm.test_dedup import plain_classes, plain_exact
from tests.llm.test_packing import check_places

SF_DIR = "/root/testdata/sf0.001"


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns = docs.columns
    given = {}
    for name, step in corpus_pipeline.STAGES:
        given[name] = [r.asDict() for r in docs.collect()]
        path = f"{tmp_path}/{name}"
        step(spark, docs, SF_DIR).write.parquet(path)
        docs = spark.read.parquet(path)
        if name != "packing":
            assert docs.columns == columns
    names = list(given)
    out = {name: given[following] for name, following in zip(names, names[1:])}

    judged = toxicity.judge(
        spark.read.parquet(f"{SF_DIR}/documents.parquet"),
        spark.read.parquet(f"{SF_DIR}/labels.parquet"),
    ).collect()
    assert {r["doc_id"] for r in out["toxicity"]} == {r.doc_id for r in judged if not r.predicted}

    kept = {keep for _, keep, _ in plain_exact([(r["doc_id"], r["text"]) for r in given["exact_dedup"]])}
    assert sorted(r["doc_id"] for r in out["exact_dedup"]) == sorted(kept)

    texts = [r["text"] for r in given["near_dedup"]]
    left = {r["doc_id"] for r in out["near_dedup"]}
    for members in plain_classes(texts):
        assert sum(given["near_dedup"][i]["doc_id"] in left for i in members) == 1

    taken = Counter()
    for r in out["mixing"]:
        taken[r["source"]] += len(mixing_words(r["text"]))
    targets = {
        r.source: r.target
        for r in mixing.mix(spark.createDataFrame(given["mixing"], docs_schema(spark))).collect()
    }
    longest = Counter()
    for r in given["mixing"]:
        longest[r["source"]] = max(longest[r["source"]], len(mixing_words(r["text"])))
    assert all(abs(taken[s] - t) <= longest[s] / 2 + 0.5 for s, t in targets.items())
    texts = {(r["doc_id"], r["text"]) for r in given["mixing"]}
    assert {(r["doc_id"], r["text"]) for r in out["mixing"]} <= texts  # none is cut

    rows = docs.collect()
    assert sum(r.piece == 0 for r in rows) == len(given["packing"])
    check_places(rows)


def test_run_handles_odd_tables(spark, tmp_path, clashing, documents):
    """Empty, null and repeated rows, and columns that clash, through all stages."""
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    odd = [None, "", " ", "same words", "same words", "Same Words", "é\u2028 ü", "x " * 5000]
    rows = [(n, t, [None, "a", "b"][n % 3]) for n, t in enumerate(odd)]
    rows += [(None, "no id", "a"), (3, "same words", "a"), (3, "same words", "a")]
    for name, docs in (("none", documents([])), ("odd", clashing(documents(rows)))):
        docs.write.parquet(f"{tmp_path}/{name}/documents.parquet")
        labels.write.parquet(f"{tmp_path}/{name}/labels.parquet")
        packed = corpus_pipeline.run(spark, f"{tmp_path}/{name}").collect()
        check_places(packed)
        ids = {r.doc_id for r in packed}
        assert ids <= {r[0] for r in rows} if name == "odd" else not packed
        if name == "odd":  # copies went, what is alone stayed
            assert 5 in ids and not ids & {3, 4} and 7 in ids and None in ids


def mixing_words(text):
    import re

    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def docs_schema(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet").schema
