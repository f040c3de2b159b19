import os
import shutil

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from weblattice.llm import decontaminate, ngram_join, secrets
from weblattice.llm.common import written

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    """The smallest tables with planted rows of each kind beside them."""
    out = tmp_path_factory.mktemp("tables")
    return str(out)


def planted(spark, folder):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    item = spark.read.parquet(f"{SMALL}/benchmark.parquet").orderBy("item_id").first()["text"]
    long = docs.where("length(text) > 2500 and lang = 'en'").orderBy("doc_id").first()["text"].replace("idiot", "onth")
    rows = [(9001, "Here and there onth. " + item + " erth thand of the.", "en", "s", 1), (9002, long + " and more erth", "en", "s", 1),
            (9003, long + " and more onth", "en", "s", 1), (9004, None, None, None, None), (9005, "", "en", "s", 0),
            (None, "thand erth of the", "en", "s", 1), (9006, "oner and that token = 'f33e61083db5dbdf4bd2369d2f80176e' thand", "en", "s", 1)]
    docs.unionByName(spark.createDataFrame(rows, docs.schema)).withColumn("component_id", F.lit("extra")) \
        .write.mode("overwrite").parquet(f"{folder}/documents.parquet")
    for t in ("labels", "benchmark"):
        if not os.path.exists(f"{folder}/{t}.parquet"):
            shutil.copy(f"{SMALL}/{t}.parquet", f"{folder}/{t}.parquet")
    return spark.read.parquet(f"{folder}/documents.parquet")


def test_each_stage_does_its_work_on_its_input(spark, folder):
    docs = planted(spark, folder)
    columns = docs.columns
    truth = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{SMALL}/labels.parquet").collect()}
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["toxicity", "ngram_jaccard", "decontamination", "secrets", "bpe"]

    clean = written(stages["toxicity"](spark, docs, folder), "t1")
    assert clean.columns == columns
    kept = {r["doc_id"] for r in clean.select("doc_id").collect()}
    assert {9001, 9004, 9005, None} <= kept
    good = [i for i, v in truth.items() if v == 0]
    assert sum(i in kept for i in good) >= 0.9 * len(good)

    one = written(stages["ngram_jaccard"](spark, clean, folder), "t2")
    assert one.columns == columns
    classes = ngram_join.classes(clean, ngram_join.Measure()).where("doc_id is not null").collect()
    assert sorted(r["doc_id"] for r in one.select("doc_id").collect() if r["doc_id"] is not None) == \
        sorted({r["component_id"] for r in classes})
    both = {r["doc_id"] for r in one.select("doc_id").collect()} & {9002, 9003}
    assert len(both) <= 1

    bench = spark.read.parquet(f"{folder}/benchmark.parquet")
    pure = written(stages["decontamination"](spark, one, folder), "t3")
    found = {r["doc_id"] for r in decontaminate.matches(one, bench).collect()}
    assert 9001 in found and pure.columns == columns
    assert {r["doc_id"] for r in pure.select("doc_id").collect()} == {r["doc_id"] for r in one.select("doc_id").collect()} - found

    safe = written(stages["secrets"](spark, pure, folder), "t4")
    assert safe.columns == columns and safe.count() == pure.count()
    before = {r["doc_id"]: r["text"] for r in pure.collect()}
    for r in safe.collect():
        assert not secrets.base_spans(r["text"] or "")
        if "[SECRET]" not in (r["text"] or ""):
            assert r["text"] == before[r["doc_id"]]

    ids = stages["bpe"](spark, safe, folder).collect()
    assert sorted(str(r["doc_id"]) for r in ids) == sorted(str(i) for i in before)


def test_run_equals_its_stages(spark, folder):
    docs = planted(spark, folder)
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        docs = written(stage(spark, docs, folder), f"s{k}")
    assert sorted(map(str, corpus_pipeline.run(spark, folder).collect())) == sorted(map(str, docs.collect()))


def test_empty_documents(spark, tmp_path):
    for t in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{SMALL}/{t}.parquet").limit(0).write.parquet(f"{tmp_path}/{t}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
